"""An equi-join that stays balanced when few keys own most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARES = 1000


def heavy_keys(sizes: DataFrame, keys: list[str], shares: int = SHARES) -> DataFrame:
    """The keys with more than 1/``shares`` of all rows, and the parts each is cut in.

    The number of all rows is part of the plan; no job runs here.
    """
    total = sizes.agg(F.sum("n").cast("double")).scalar()
    found = sizes.select(*keys, (F.col("n") * shares / total).alias("over"))
    return found.filter(F.col("over") > 1).select(*keys, F.ceil("over").cast("int").alias("parts"))


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread_by: str,
    sizes: DataFrame,
    how: str = "inner",
    shares: int = SHARES,
) -> DataFrame:
    """``rows`` joined with ``lookup``, which has at most one row per key.

    ``sizes`` has the keys of ``rows`` and their number of rows ``n``. A key with more than 1/``shares`` of all rows is heavy. Its rows are cut
    into parts by a hash of ``spread_by`` (stable, so a repeated task sends each row to
    the same part), and its lookup row is copied once per part. At most ``shares`` keys
    can each own more than 1/``shares`` of the rows, so the list of heavy keys, which is
    all that is broadcast, has a fixed bound, and so has the number of copies.
    """
    heavy = F.broadcast(heavy_keys(sizes, keys, shares))
    part = F.pmod(F.xxhash64(spread_by), F.coalesce("parts", F.lit(1))).cast("int")
    spread = rows.join(heavy, keys, "left").withColumn("part", part).drop("parts")
    copies = (
        lookup.join(heavy, keys, "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
        .drop("parts")
    )
    return spread.join(copies, [*keys, "part"], how).drop("part")
