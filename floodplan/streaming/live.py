"""The live map's state: each city's latest values, and the largest count of all.

The stream keeps the latest values of every city and tells, batch by batch, which changed.
These are put into a table by buckets of cities. A batch writes the buckets it touches anew
under its own number and a list of which batch holds each bucket, so readers never see half a
batch, untouched buckets keep their files, and a repeated batch writes the same again. Counts
only grow, so the largest is one number that is carried from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from floodplan.session import delete_folder
from floodplan.streaming.updates import intensity, latest_by_city

BUCKETS = 64
CITIES = "city_id bigint, city_name string, refugees bigint, change bigint"
#: Which batch holds each bucket; bucket -1 is the batch itself, with the largest count.
VERSIONS = "bucket int, version bigint, largest bigint"


def _versions(spark: SparkSession, folder: str, batch: int) -> tuple[dict[int, int], int]:
    """Bucket to the batch that holds it, and the largest count, after a batch."""
    if batch < 0:
        return {}, 0
    rows = spark.read.schema(VERSIONS).parquet(f"{folder}/versions/{batch}").collect()
    largest = [r["largest"] for r in rows if r["bucket"] == -1]
    if not largest:
        raise ValueError(f"{folder} holds no state after batch {batch}")
    return {r["bucket"]: r["version"] for r in rows if r["bucket"] >= 0}, largest[0]


def _cities(spark: SparkSession, folder: str, versions: dict[int, int]) -> DataFrame:
    paths = [f"{folder}/cities/{version}/bucket={bucket}" for bucket, version in sorted(versions.items())]
    return spark.read.schema(CITIES).parquet(*paths) if paths else spark.createDataFrame([], CITIES)


class LiveMap:
    """The work of one batch of changed cities."""

    def __init__(self, folder: str, buckets: int = BUCKETS):
        if buckets < 1:
            raise ValueError("there must be a bucket")
        self.folder = folder
        self.buckets = buckets

    def __call__(self, changed: DataFrame, batch: int) -> None:
        spark, folder = changed.sparkSession, self.folder
        before, largest = _versions(spark, folder, batch - 1)
        bucket = F.pmod(F.xxhash64("city_id"), F.lit(self.buckets)).cast("int")
        work = f"{folder}/work/{batch % 2}"
        rows = changed.select(*[c.split()[0] for c in CITIES.split(", ")], bucket.alias("bucket"))
        rows.write.mode("overwrite").parquet(work)
        rows = spark.read.schema(rows.schema).parquet(work)
        told = rows.groupBy("bucket").agg(F.max("refugees").alias("largest")).collect()
        touched = {r["bucket"] for r in told}
        old = _cities(spark, folder, {b: v for b, v in before.items() if b in touched}).alias("old")
        stay = old.join(rows.select("city_id").alias("new"), F.expr("old.city_id <=> new.city_id"), "left_anti")
        if touched:
            both = stay.withColumn("bucket", bucket).unionByName(rows)
            # A bucket is a bounded share of the cities, one row each: one file in one task.
            dealt = both.repartition(len(touched), "bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/cities/{batch}")
        after = before | {b: batch for b in touched}
        largest = max([largest, *(r["largest"] for r in told if r["largest"] is not None)])
        state = [(-1, batch, largest), *((b, v, None) for b, v in sorted(after.items()))]
        spark.createDataFrame(state, VERSIONS).coalesce(1).write.mode("overwrite").parquet(
            f"{folder}/versions/{batch}"
        )
        self._clear(spark, batch)

    def _clear(self, spark: SparkSession, batch: int) -> None:
        """Delete what no batch that may still be read or repeated needs: that is the last three."""
        if batch < 3:
            return
        (old, _), (kept, _) = (_versions(spark, self.folder, batch - k) for k in (3, 2))
        for bucket, version in old.items():
            if kept[bucket] != version:
                delete_folder(spark, f"{self.folder}/cities/{version}/bucket={bucket}")
        # What a repeated batch needs to know of this one stays: it is the list before it.
        delete_folder(spark, f"{self.folder}/versions/{batch - 4}")


def keep_live(
    updates: DataFrame, folder: str, order: tuple[str, ...] = ("event_id",), buckets: int = BUCKETS
) -> DataStreamWriter:
    """A writer of the latest values of a stream of updates; the caller starts it.

    ``order`` are the columns by which an update is later than another, in whatever order
    they come in. Updates without a city count as one city's.
    """
    return (
        latest_by_city(updates, order)
        .writeStream.outputMode("update")
        .foreachBatch(LiveMap(folder, buckets).__call__)
        .option("checkpointLocation", f"{folder}/checkpoint")
    )


def last_batch(spark: SparkSession, folder: str) -> int:
    """The newest batch whose state is whole, or -1."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/versions/*/_SUCCESS")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return max([int(status.getPath().getParent().getName()) for status in found or []], default=-1)


def live_cities(spark: SparkSession, folder: str) -> DataFrame:
    """Each city's latest count and change, as ``latest_by_city`` over all updates so far."""
    return _cities(spark, folder, _versions(spark, folder, last_batch(spark, folder))[0])


def live_intensity(spark: SparkSession, folder: str) -> DataFrame:
    """As ``city_intensity``, by the largest count that the state carries."""
    versions, largest = _versions(spark, folder, last_batch(spark, folder))
    return intensity(_cities(spark, folder, versions), F.lit(largest))
