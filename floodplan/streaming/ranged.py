"""The tracker for streams in which one city may be most of the stream.

Each batch is summed up in ranges that cut through cities, as in ``replay``, so no city
is ever the work of one task. State is two tables, the cities and what has yet to leave
the window, read from the batch before and written for the batch after. That costs a
rewrite of both per batch, so it pays for large batches; for small ones that must react
at once, use ``tracker``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from floodplan.functions.checks import check_window
from floodplan.streaming.replay import MOVE, ORDER, running_updates
from floodplan.streaming.tracker import parse_events

CITIES = "city_id bigint, city_name string, refugees bigint, change bigint"
PENDING = "city_id bigint, city_name string, event_id bigint, refugees bigint, at_ms bigint"
PROGRESS = "batch bigint, until_ms bigint"


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RangedTracker:
    """The work of one batch. A batch that is repeated reads and writes the same again.

    State lies in two places in turn: a batch reads the one and overwrites the other, so
    what it reads outlives its failure.
    """

    def __init__(
        self, window_seconds: int, folder: str, publish: Callable[[DataFrame], None] | None = None
    ):
        self.window_ms = check_window(window_seconds) * 1000
        self.folder = folder
        self.publish = publish

    def _state(self, batch: int, table: str) -> str:
        return f"{self.folder}/state-{batch % 2}/{table}"

    def _before(self, arrivals: DataFrame, batch: int) -> tuple[DataFrame, DataFrame, int]:
        """(cities, pending, time reached) after the batch before."""
        spark = arrivals.sparkSession
        if batch == 0:
            return spark.createDataFrame([], CITIES), spark.createDataFrame([], PENDING), 0
        path = self._state(batch - 1, "progress")
        progress = spark.read.schema(PROGRESS).parquet(path).first()
        if progress is None or progress["batch"] != batch - 1:
            raise ValueError(f"{path} is not the state after batch {batch - 1}")
        cities = spark.read.schema(CITIES).parquet(self._state(batch - 1, "cities"))
        pending = spark.read.schema(PENDING).parquet(self._state(batch - 1, "pending"))
        return cities, pending, progress["until_ms"]

    def __call__(self, rows: DataFrame, batch: int) -> None:
        arrivals = _kept(
            rows.select(
                "city_id",
                "city_name",
                "event_id",
                "refugees",
                F.unix_millis("ts").alias("at_ms"),
            ),
            f"{self.folder}/work/arrivals",
        )
        cities, pending, reached = self._before(arrivals, batch)
        newest = arrivals.agg(F.max("at_ms")).first()[0]
        until = reached if newest is None else max(reached, newest)
        leaving = pending.unionByName(
            arrivals.withColumn("at_ms", F.col("at_ms") + self.window_ms)
        )
        due = leaving.filter(F.col("at_ms") <= until).withColumn("arrival", F.lit(0))
        moves = due.unionByName(arrivals.withColumn("arrival", F.lit(1))).select(*MOVE)
        updates = _kept(
            running_updates(moves, cities, keep=lambda df: _kept(df, f"{self.folder}/work/ranges")),
            f"{self.folder}/updates/batch={batch}",
        )
        if self.publish:
            self.publish(updates)
        last = F.max_by(F.struct("city_name", "refugees", "change"), F.struct(*ORDER))
        latest = updates.groupBy("city_id").agg(last.alias("city")).select("city_id", "city.*")
        unchanged = cities.join(latest, "city_id", "left_anti")
        _kept(unchanged.unionByName(latest), self._state(batch, "cities"))
        _kept(leaving.filter(F.col("at_ms") > until), self._state(batch, "pending"))
        progress = arrivals.sparkSession.createDataFrame([(batch, until)], PROGRESS)
        _kept(progress, self._state(batch, "progress"))


def track_in_ranges(
    arrivals: DataFrame,
    window_seconds: int,
    folder: str,
    publish: Callable[[DataFrame], None] | None = None,
) -> DataStreamWriter:
    """A writer of all updates to ``<folder>/updates``; the caller starts it.

    ``arrivals`` has ts, city_id, city_name, refugees and event_id. Time is event time:
    a batch takes off the change all that leaves the window up to its newest arrival.
    Late arrivals count; they are never dropped. ``publish`` is given each batch's
    updates, and given them again if the batch is repeated.
    """
    tracker = RangedTracker(window_seconds, folder, publish)
    return arrivals.writeStream.foreachBatch(tracker.__call__).option(
        "checkpointLocation", f"{folder}/checkpoint"
    )


def track_messages(
    messages: DataFrame,
    window_seconds: int,
    folder: str,
    publish: Callable[[DataFrame], None] | None = None,
) -> DataStreamWriter:
    """The same from messages, which are read once: malformed ones go to ``<folder>/malformed``.

    One query splits every batch and writes both parts under its number, so after a failure
    they agree: each message is in one of them, and once.
    """
    tracker = RangedTracker(window_seconds, folder, publish)

    def split(batch_rows: DataFrame, batch: int) -> None:
        kept = _kept(batch_rows, f"{folder}/work/messages")
        arrivals, malformed = parse_events(kept)
        malformed.write.mode("overwrite").parquet(f"{folder}/malformed/batch={batch}")
        tracker(arrivals, batch)

    return messages.writeStream.foreachBatch(split).option(
        "checkpointLocation", f"{folder}/checkpoint"
    )


def read_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """All malformed messages set aside so far."""
    return spark.read.parquet(f"{folder}/malformed").drop("batch")


def read_updates(spark: SparkSession, folder: str) -> DataFrame:
    """All updates written so far."""
    return spark.read.parquet(f"{folder}/updates").drop("batch")
