"""What the package needs from a Spark session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("floodplan")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, as named in ``spark.checkpoint.dir``.

    On one machine without that setting a new temporary folder takes its place; on a
    cluster a missing setting is an error, because other machines could not read it.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="floodplan-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Compute a frame once and keep it as a table in the shared folder.

    For a frame that is read several times. Its lineage is cut: neither a second reader
    nor a lost executor computes it again. A later step reads only the columns it needs,
    and Spark knows the true size of the table when it picks a join.

    The tables of an application lie together in one folder; its job calls ``forget`` at
    its end.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder in whatever store holds it; False if there was none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Delete the tables this application has settled; frames that read them end here."""
    delete_folder(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
