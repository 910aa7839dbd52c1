"""Words, keys and settings that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words made of digits, ASCII letters and anything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows that one Arrow batch hands to Python; texts may be long.
BATCH_ROWS = 128


def small_batches(spark: SparkSession) -> None:
    """For jobs that hand whole texts to Python: few rows a batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` does just that where all is ASCII."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def ascii_words(text: Column) -> Column:
    """The words of a text in lower case; none for null."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1)
    return F.filter(parts, lambda w: w != "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def same_document(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on (doc_id, text_key), where null ids are equal too."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def with_row(docs: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one struct beside new columns, so that no names can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *[c.alias(name) for name, c in columns.items()])
