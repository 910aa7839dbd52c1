"""The live tracker: a stream of arrivals in, a stream of updates out."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import floodplan
from floodplan.functions.checks import check_window
from floodplan.sources import schemas

UPDATES = (
    "city_id bigint, city_name string, at_ms bigint, arrival int, event_id bigint, "
    "refugees bigint, change bigint"
)
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Cities are dealt to so many groups; one call and one state entry serve a whole group.
BUCKETS = 1024
# What has yet to leave the window lies in chunks of at most so many rows, each one state entry.
CHUNK_ROWS = 10_000
PENDING = ("at_ms", "event_id", "refugees", "city_id")
EVENT_TIME, PROCESSING_TIME = "EventTime", "ProcessingTime"


def parse_events(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(arrivals, malformed messages) of JSON texts in ``value``.

    Further columns pass through. A message that is no JSON object, or lacks one of the
    fields, is malformed: it is set aside and does not stop the stream.
    """
    parsed = messages.withColumn("event", F.from_json("value", schemas.EVENT))
    fields = [f"event.{name}" for name in schemas.EVENT.names]
    complete = F.lit(True)
    for field in fields:
        complete = complete & F.col(field).isNotNull()
    rest = [c for c in messages.columns if c not in ("key", "value")]
    good = parsed.filter(complete).select(
        *rest,
        F.timestamp_millis("event.timestamp").alias("ts"),
        "event.city_id",
        "event.city_name",
        "event.refugees",
    )
    return good, parsed.filter(~complete).select(*messages.columns)


def encode_updates(updates: DataFrame) -> DataFrame:
    """Updates as messages: the city id as key, the update as JSON."""
    value = F.to_json(F.struct(*schemas.UPDATE.names)).alias("value")
    rest = [c for c in updates.columns if c not in schemas.UPDATE.names]
    return updates.select(F.col("city_id").cast("string").alias("key"), value, *rest)


def _column(frames: list[pd.DataFrame], name: str) -> np.ndarray:
    return np.concatenate([frame[name].to_numpy() for frame in frames])


@dataclass
class Bucket:
    """What is known of a group of cities: the content of its value state.

    Cities lie in order of id. ``firsts`` has the time at which the first row of each
    chunk leaves the window.
    """

    city_id: np.ndarray
    city_name: np.ndarray
    refugees: np.ndarray
    change: np.ndarray
    timer_ms: int
    chunks: list[int]
    firsts: list[int]

    @classmethod
    def of(cls, stored: tuple | None) -> Bucket:
        ids, names, refugees, change, timer_ms, chunks, firsts = stored or ([], [], [], [], -1, [], [])
        numbers = [np.array(list(v), "int64") for v in (ids, refugees, change)]
        return cls(
            numbers[0], np.array(list(names), object), *numbers[1:], timer_ms, list(chunks), list(firsts)
        )

    def stored(self) -> tuple:
        columns = (self.city_id, self.city_name, self.refugees, self.change)
        return (*[c.tolist() for c in columns], self.timer_ms, self.chunks, self.firsts)

    def place(self, city_id: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.city_id, city_id)

    def add(self, city_id: np.ndarray) -> None:
        """Cities not known so far start without name and arrivals."""
        new = np.setdiff1d(city_id, self.city_id)
        at = self.place(new)
        self.city_id = np.insert(self.city_id, at, new)
        self.city_name = np.insert(self.city_name, at, "")
        self.refugees, self.change = np.insert(self.refugees, at, 0), np.insert(self.change, at, 0)


class RefugeeTracker(StatefulProcessor):
    """Per city the total of all arrivals and the sum of those in the trailing window.

    A key is a city or a group of cities. Its state is every city's name, total and change,
    and what has yet to leave the window, in order of time in chunks of limited size. A
    batch reads the chunks in which something may fall due and rewrites what is left of them
    with what it adds, so its work grows with its rows and the group's cities, not with the
    rows in the window, and calls to the state store grow with keys, not with cities.
    """

    def __init__(self, window_seconds: int, time_mode: str, chunk_rows: int = CHUNK_ROWS):
        self.window_ms = check_window(window_seconds) * 1000
        self.time_mode = time_mode
        self.chunk_rows = chunk_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.known = handle.getValueState(
            "bucket",
            "city_id array<bigint>, city_name array<string>, refugees array<bigint>, "
            "change array<bigint>, timer_ms bigint, chunks array<bigint>, firsts array<bigint>",
        )
        self.pending = handle.getMapState(
            "pending", "chunk bigint", ", ".join(f"{name} array<bigint>" for name in PENDING)
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frames = [frame[~frame["clock"].to_numpy(bool)] for frame in rows]
        if not sum(map(len, frames)):
            return
        arrived = np.stack([_column(frames, c).astype("int64") for c in PENDING])
        now = self._now(timerValues)
        if self.time_mode == PROCESSING_TIME:
            arrived[0] = now
        bucket = Bucket.of(self.known.get())
        bucket.add(arrived[3])
        # What comes after its window has passed leaves at once; an arrival may also leave
        # again within the same batch.
        until = np.full(len(bucket.city_id), now, "int64")
        np.maximum.at(until, bucket.place(arrived[3]), arrived[0])
        leaving = arrived.copy()
        leaving[0] += self.window_ms
        due = self._take_due(bucket, leaving, until)
        yield from self._apply(bucket, due, arrived, _column(frames, "city_name"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored = self.known.get()
        if stored is None:
            return
        bucket = Bucket.of(stored)
        if bucket.timer_ms == expiredTimerInfo.getExpiryTimeInMs():
            bucket.timer_ms = -1
        until = np.full(len(bucket.city_id), self._now(timerValues), "int64")
        none = np.empty((len(PENDING), 0), "int64")
        due = self._take_due(bucket, none, until)
        yield from self._apply(bucket, due, none, np.empty(0, object))

    def close(self) -> None:
        """Nothing to do: the checkpoint owns the state."""

    def _now(self, timerValues) -> int:
        if self.time_mode == PROCESSING_TIME:
            return timerValues.getCurrentProcessingTimeInMs()
        return timerValues.getCurrentWatermarkInMs()

    def _apply(
        self, bucket: Bucket, due: np.ndarray, arrived: np.ndarray, names: np.ndarray
    ) -> Iterator[pd.DataFrame]:
        """Emit one update per move, in order within a city, and store what comes of them."""
        moves = np.hstack([due, arrived])
        arrival = np.repeat([0, 1], [due.shape[1], arrived.shape[1]]).astype("int32")
        order = np.lexsort((moves[1], arrival, moves[0], moves[3]))
        (at_ms, event_id, amount, city_id), arrival = moves[:, order], arrival[order]
        n = len(order)
        begins = np.flatnonzero(np.diff(city_id, prepend=city_id[:1] - 1))
        length = np.diff(begins, append=n)
        place = bucket.place(city_id[begins])

        def running(amount: np.ndarray, before: np.ndarray) -> np.ndarray:
            """Sums within each city, on from what it had."""
            total = np.cumsum(amount)
            return total + np.repeat(before[place] - (total[begins] - amount[begins]), length)

        refugees = running(np.where(arrival == 1, amount, 0), bucket.refugees)
        change = running(np.where(arrival == 1, amount, -amount), bucket.change)
        # A city goes by the name in its latest arrival, at first the stored one.
        told = np.concatenate([np.full(due.shape[1], None, object), names])[order]
        latest = np.maximum.accumulate(np.where(arrival == 1, np.arange(n), -1))
        stored = np.repeat(bucket.city_name[place], length)
        named = np.where(latest < np.repeat(begins, length), stored, told[latest])
        ends = begins + length - 1
        bucket.city_name[place] = named[ends]
        bucket.refugees[place], bucket.change[place] = refugees[ends], change[ends]
        self._set_timer(bucket)
        self.known.update(bucket.stored())
        if n:
            yield pd.DataFrame(
                {
                    "city_id": city_id,
                    "city_name": named,
                    "at_ms": at_ms,
                    "arrival": arrival,
                    "event_id": event_id,
                    "refugees": refugees,
                    "change": change,
                }
            )

    def _take_due(self, bucket: Bucket, leaving: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Of ``leaving`` and the chunks, what leaves up to its city's time; the rest is kept."""
        reach = int(until.max(initial=0))
        read = [c for c, first in zip(bucket.chunks, bucket.firsts) if first <= reach]
        rows = np.hstack([leaving, *[np.array(self.pending.getValue((c,)), "int64") for c in read]])
        for chunk in read:
            self.pending.removeKey((chunk,))
        kept = [(c, first) for c, first in zip(bucket.chunks, bucket.firsts) if first > reach]
        due = rows[0] <= until[bucket.place(rows[3])]
        rest = rows[:, ~due]
        rest = rest[:, np.argsort(rest[0], kind="stable")]
        number = max(bucket.chunks, default=0)
        for start in range(0, rest.shape[1], self.chunk_rows):
            number += 1
            chunk = rest[:, start : start + self.chunk_rows]
            self.pending.updateValue((number,), tuple(chunk.tolist()))
            kept.append((number, int(chunk[0, 0])))
        bucket.chunks, bucket.firsts = [c for c, _ in kept], [first for _, first in kept]
        return rows[:, due]

    def _set_timer(self, bucket: Bucket) -> None:
        """Keep one timer per key, for the first row that has yet to leave."""
        first = min(bucket.firsts, default=-1)
        if first != bucket.timer_ms:
            if bucket.timer_ms >= 0:
                self.handle.deleteTimer(bucket.timer_ms)
            if first >= 0:
                self.handle.registerTimer(first)
            bucket.timer_ms = first


def track_refugees(
    arrivals: DataFrame,
    window_seconds: int,
    time_mode: str = EVENT_TIME,
    watermark: str = "1 millisecond",
    buckets: int = BUCKETS,
) -> DataFrame:
    """One update per arrival, and one more when it leaves the window.

    ``arrivals`` has ts, city_id, city_name, refugees and event_id, which orders equal
    times. In event time an arrival counts however late it is: only the rows that move the
    clock carry a time that Spark may find late, and they carry nothing else. An arrival
    later than ``watermark`` behind the newest is told after what was told already, and if
    its window has passed it leaves at once. Totals don't depend on batches. In processing
    time updates follow the clock; keep the trigger well below the window.

    The arrivals of one city are one sequence, so a batch's rows of a city meet in one
    task; the source's limit per trigger bounds them, and they are summed as arrays. Cities
    are dealt to ``buckets`` groups, which a checkpoint keeps for good: a batch costs a few
    calls to the state store for each group, however many cities it has.
    """
    check_window(window_seconds)
    if time_mode not in (EVENT_TIME, PROCESSING_TIME):
        raise ValueError(f"time_mode must be EventTime or ProcessingTime, not {time_mode!r}")
    # The processor travels with its code, so executors need not have the package.
    cloudpickle.register_pickle_by_value(floodplan)
    session = arrivals.sparkSession
    session.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    keyed = arrivals.select(
        "ts", F.unix_millis("ts").alias("at_ms"), "city_id", "city_name", "refugees", "event_id"
    )
    if time_mode == EVENT_TIME:
        both = keyed.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("clock"))
        keyed = both.withColumn("ts", F.when(F.col("clock"), F.col("ts")))
        keyed = keyed.withWatermark("ts", watermark)
    else:
        keyed = keyed.withColumn("clock", F.lit(False))
    keyed = keyed.withColumn("bucket", F.pmod(F.xxhash64("city_id"), F.lit(buckets)).cast("int"))
    return keyed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=RefugeeTracker(window_seconds, time_mode),
        outputStructType=UPDATES,
        outputMode="Append",
        timeMode=time_mode,
    )
