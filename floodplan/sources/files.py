"""Files and tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodplan.functions.parsing import parse_id
from floodplan.sources import schemas


def _checked(df: DataFrame, schema) -> DataFrame:
    """Select the schema's columns in its types; a missing column is an error."""
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_nodes(spark: SparkSession, path: str, format: str = "orc") -> DataFrame:
    """Map nodes, ways and relations.

    The files' own types are read and cast: maps store coordinates as decimals.
    """
    return _checked(spark.read.format(format).load(path), schemas.NODES)


def read_elevation(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Elevation samples; the path may be a glob."""
    return _checked(spark.read.format(format).load(path), schemas.ELEVATION)


def _cities(features: DataFrame) -> DataFrame:
    """Cities of a variant ``feature``: id, name, population and the whole feature, uncut.

    A feature without id, name or population is skipped.
    """
    field = lambda name, type: F.variant_get("feature", f"$.properties.{name}", type)
    cities = features.select(
        parse_id(field("geoname_id", "string")).alias("city_id"),
        field("name", "string").alias("name"),
        field("population", "bigint").alias("population"),
        "feature",
    )
    return cities.filter(
        F.col("city_id").isNotNull()
        & (F.col("city_id") >= 0)
        & F.col("name").isNotNull()
        & F.col("population").isNotNull()
        & (F.col("population") >= 0)
    )


def read_city_features(spark: SparkSession, path: str) -> DataFrame:
    """Cities of GeoJSON FeatureCollections: id, name, population and the feature.

    The feature is a variant, whatever properties and geometry it has. A document that is
    broken or no FeatureCollection is an error. A collection is one JSON document, which one
    task has to parse; its cities are spread evenly right after. Files of records are
    divisible, see ``read_city_records``.
    """
    document = (
        spark.read.format("json")
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("singleVariantColumn", "document")
        .load(path)
    )
    kind = F.try_variant_get("document", "$.type", "string")
    wrong = F.raise_error(F.concat(F.lit("no FeatureCollection but "), F.coalesce(kind, F.lit("none"))))
    listed = F.variant_get("document", "$.features", "array<variant>")
    features = document.select(
        F.explode(F.when(kind == "FeatureCollection", listed).otherwise(wrong)).alias("feature")
    )
    return _cities(features).repartition(spark.sparkContext.defaultParallelism)


def read_city_records(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """The same from files of one feature a record, which many tasks read at once.

    Records end with line feeds, or begin with the record separator (``"\\x1e"``) and may
    then take several lines. Empty records are skipped; one that is no JSON or no Feature is
    an error.
    """
    records = spark.read.text(path, lineSep=separator).select(
        F.trim(F.translate("value", "\x1e\r\n\t", "    ")).alias("value")
    )
    # Line breaks only stand between the parts of a record: inside a string JSON escapes them.
    feature = F.col("feature")
    kind = F.try_variant_get(feature, "$.type", "string")
    wrong = F.raise_error(F.concat(F.lit("no Feature but "), F.coalesce(kind, F.lit("none"))))
    parsed = records.filter("value <> ''").select(F.parse_json("value").alias("feature"))
    return _cities(parsed.select(F.when(kind == "Feature", feature).otherwise(wrong).alias("feature")))


def write_plan(plan: DataFrame, path: str) -> None:
    """The relocation plan as ORC, in order of place, replacing what was there."""
    # The flooded id makes equal place names divisible between tasks.
    ordered = plan.orderBy("place", "destination", "flood_id")
    ordered.select("place", "num_evacuees", "destination").write.mode("overwrite").orc(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("place string, num_evacuees double, destination string").orc(path)


def read_plan_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The written plan with each row's ``position``, from 1, in the order of the files.

    Rows are numbered within their file, and files by how many rows lie in those before.
    """
    rows = read_plan(spark, path).select(
        "*", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("row")
    )
    # One row for each file.
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("file", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("file").orderBy("row"))
    return (
        rows.withColumn("within", within)
        .join(starts, "file")
        .withColumn("position", F.col("before") + F.col("within"))
        .drop("file", "row", "within", "before")
    )


def write_destinations(change: DataFrame, path: str) -> None:
    """The destinations' change of population as ORC, replacing what was there."""
    change.write.mode("overwrite").orc(path)


def write_bucketed(
    df: DataFrame, table: str, buckets: int, path: str | None = None, key: str = "cell"
) -> DataFrame:
    """Store a table in sorted buckets of a key, so that later joins on it need no shuffle.

    Rows go to the task of their bucket first, so each bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)
