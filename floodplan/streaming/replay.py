"""The tracker's rules over a finite table of arrivals.

Every arrival adds to its city's total and to its recent change; when it leaves the
trailing window, it is taken off the change again. Each of the two is one update.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.functions.checks import check_window
from floodplan.session import settle

# What orders the moves of a city. At equal times what leaves (0) goes before what
# arrives (1).
ORDER = ("at_ms", "arrival", "event_id")
MOVE = ("city_id", "city_name", "event_id", "refugees", "at_ms", "arrival")
#: Moves in a range of a finite table, about; a row takes some hundred bytes when sorted.
ROWS_PER_RANGE = 2_000_000


def moves(events: DataFrame, window_seconds: int) -> DataFrame:
    """Two rows per arrival: the arrival (1) and its leaving the window (0)."""
    length = check_window(window_seconds) * 1000
    at = F.unix_millis(F.col("ts").cast("timestamp"))

    def move(at: Column, arrival: int) -> Column:
        return F.struct(at.alias("at_ms"), F.lit(arrival).alias("arrival"))

    both = F.array(move(at, 1), move(at + length, 0))
    return events.select("city_id", "city_name", "event_id", "refugees", F.inline(both))


def running_updates(
    moves: DataFrame,
    before: DataFrame | None = None,
    partitions: int | None = None,
    keep: Callable[[DataFrame], DataFrame] = settle,
) -> DataFrame:
    """One update per move: city, time, total and change after it.

    A running sum per city would put a whole city into one task. Here the moves of all
    cities are sorted into ranges of equal size, wherever that cuts a city; each range
    sums up on its own and starts from what the city's earlier ranges add up to, and
    from ``before`` (city_id, city_name, refugees, change), if given.
    """
    session = moves.sparkSession
    partitions = partitions or int(session.conf.get("spark.sql.shuffle.partitions"))
    # Kept, so that every reader sees a row in the same range.
    ranges = keep(
        moves.select(*MOVE)
        .repartitionByRange(partitions, "city_id", *ORDER)
        .withColumn("range", F.spark_partition_id())
    )
    is_arrival = F.col("arrival") == 1
    arrived = F.when(is_arrival, F.col("refugees"))
    moved = F.when(is_arrival, F.col("refugees")).otherwise(-F.col("refugees"))
    named = F.when(is_arrival, F.col("city_name"))

    # One row per city and range: as many as cities, and one more for each cut.
    earlier = (
        Window.partitionBy("city_id")
        .orderBy("range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        ranges.groupBy("city_id", "range")
        .agg(
            F.sum(arrived).alias("arrived"),
            F.sum(moved).alias("moved"),
            F.max_by(named, F.when(is_arrival, F.struct(*ORDER))).alias("named"),
        )
        .select(
            "city_id",
            "range",
            F.coalesce(F.sum("arrived").over(earlier), F.lit(0)).alias("arrived_before"),
            F.coalesce(F.sum("moved").over(earlier), F.lit(0)).alias("moved_before"),
            F.last("named", ignorenulls=True).over(earlier).alias("named_before"),
        )
    )
    if before is not None:
        carried = carried.join(before, "city_id", "left").select(
            "city_id",
            "range",
            (F.col("arrived_before") + F.coalesce("refugees", F.lit(0))).alias("arrived_before"),
            (F.col("moved_before") + F.coalesce("change", F.lit(0))).alias("moved_before"),
            F.coalesce("named_before", "city_name").alias("named_before"),
        )
    so_far = (
        Window.partitionBy("city_id", "range")
        .orderBy(*ORDER)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.coalesce(F.sum(arrived).over(so_far), F.lit(0)) + F.col("arrived_before")
    return ranges.join(carried, ["city_id", "range"]).select(
        "city_id",
        F.coalesce(F.last(named, ignorenulls=True).over(so_far), "named_before").alias("city_name"),
        *ORDER,
        total.alias("refugees"),
        (F.sum(moved).over(so_far) + F.col("moved_before")).alias("change"),
    )


def range_count(arrivals: int, least: int, rows: int = ROWS_PER_RANGE) -> int:
    """Ranges for so many arrivals of two moves each: they grow with the data, not in size."""
    return max(1, least, -(-2 * arrivals // rows))


def tracker_batch(
    events: DataFrame, window_seconds: int, partitions: int | None = None
) -> DataFrame:
    """All updates of a finite table of arrivals, in any order.

    Without a number of ranges the arrivals are counted first, which reads none of their
    columns, and there are at least as many ranges as shuffle partitions.
    """
    both = moves(events, window_seconds)
    if partitions is None:
        least = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        partitions = range_count(events.count(), least)
    return running_updates(both, partitions=partitions)
