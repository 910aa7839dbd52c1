import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from floodplan.sources.messages import read_message_files, write_message_files
from floodplan.streaming.job import updates_of
from floodplan.streaming.ranged import RangedTracker, read_updates, track_in_ranges
from floodplan.streaming.replay import range_count, tracker_batch
from floodplan.streaming.tracker import (
    EVENT_TIME,
    PROCESSING_TIME,
    STATE_STORE,
    UPDATES,
    RefugeeTracker,
    track_refugees,
)

EVENTS = "event_id bigint, ts timestamp, city_id bigint, city_name string, refugees bigint"


def events(spark, rows):
    """Rows of (event_id, seconds, city_id, refugees)."""
    frame = spark.createDataFrame(rows, "event_id bigint, s double, city_id bigint, refugees bigint")
    return frame.select(
        "event_id",
        F.timestamp_millis((F.col("s") * 1000).cast("bigint")).alias("ts"),
        "city_id",
        F.concat(F.lit("City "), "city_id", F.lit("."), "event_id").alias("city_name"),
        "refugees",
    )


def replay(rows, window_seconds):
    """The same rules, one arrival at a time."""
    moves = sorted(
        [(int(s * 1000), 1, e, c, n) for e, s, c, n in rows]
        + [(int(s * 1000) + window_seconds * 1000, 0, e, c, n) for e, s, c, n in rows]
    )
    totals, changes, names, out = {}, {}, {}, set()
    for at, arrival, event, city, n in moves:
        if arrival:
            totals[city] = totals.get(city, 0) + n
            names[city] = f"City {city}.{event}"
        changes[city] = changes.get(city, 0) + (n if arrival else -n)
        out.add((city, names[city], at, arrival, event, totals[city], changes[city]))
    return out


START = 1000.0
ROWS = [
    (1, START + 0.0, 7, 10),
    (2, START + 3.0, 7, 7),
    (3, START + 3.0, 7, 2),
    (4, START + 10.0, 7, 4),
    (5, START + 20.0, 7, 1),
    (6, START + 20.0, 8, 5),
    (7, START + 40.5, 7, 6),
    (8, START + 41.0, 8, 0),
    (9, START + 90.0, 9, 3),
]


def as_set(frame):
    columns = [part.split()[0] for part in UPDATES.split(", ")]
    return {tuple(r) for r in frame.select(*columns).collect()}


def test_batch_equals_replay(spark):
    for partitions in (None, 1, 3, 8, 64):
        frame = tracker_batch(events(spark, ROWS), 10, partitions)
        assert as_set(frame) == replay(ROWS, 10)


def test_ranges_grow_with_the_data():
    assert range_count(0, 4) == 4
    assert range_count(5, 1, rows=3) == 4
    assert range_count(10**12, 200) == 10**6


def test_batch_cuts_one_city_into_ranges(spark):
    rows = [(i, float(i // 3), i % 50 if i % 3 else 1, i % 11) for i in range(3000)]
    frame = tracker_batch(events(spark, rows), 60, 16)
    assert as_set(frame) == replay(rows, 60)


def emitted(rows, window_seconds):
    """What a stream has emitted when its input ends.

    What leaves the window does so once the watermark, just below the newest time, or an
    arrival in the same city has passed.
    """
    newest = max(int(s * 1000) for _, s, _, _ in rows)
    last = {}
    for _, s, city, _ in rows:
        last[city] = max(last.get(city, 0), int(s * 1000))
    return {
        u
        for u in replay(rows, window_seconds)
        if u[3] == 1 or u[2] < newest or u[2] <= last[u[0]]
    }


def write_slices(spark, rows, bounds, path):
    """One JSON file per slice of time, in order."""
    frame = events(spark, rows)
    at = F.unix_millis("ts") / 1000
    for low, high in zip(bounds, bounds[1:]):
        frame.filter((at >= low) & (at < high)).coalesce(1).write.mode("append").json(path)


def test_arrival_drains_what_has_left(spark, tmp_path):
    """Within one batch, what left the window before an arrival is off its change."""
    write_slices(spark, ROWS, [0, 2000], f"{tmp_path}/in")
    stream = spark.readStream.schema(EVENTS).json(f"{tmp_path}/in")
    query = (
        track_refugees(stream, 10)
        .writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = as_set(spark.read.parquet(f"{tmp_path}/out"))
    assert found == emitted(ROWS, 10)


def test_restart_and_small_chunks(spark, tmp_path):
    """Two runs over growing input, with state in many chunks, equal one replay."""
    rows = [(i, START + i / 4, 1 if i % 3 == 0 else i % 5, i % 7) for i in range(400)]
    source, sink = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def run():
        stream = (
            spark.readStream.schema(EVENTS)
            .option("maxFilesPerTrigger", 1)
            .json(source)
            .withColumns({"at_ms": F.unix_millis("ts"), "clock": F.lit(False)})
            .withWatermark("ts", "1 millisecond")
        )
        updates = stream.groupBy("city_id").transformWithStateInPandas(
            statefulProcessor=RefugeeTracker(30, EVENT_TIME, chunk_rows=3),
            outputStructType=UPDATES,
            outputMode="Append",
            timeMode=EVENT_TIME,
        )
        query = (
            updates.writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", f"{tmp_path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    write_slices(spark, rows, [0, START + 40, START + 60], source)
    run()
    write_slices(spark, rows, [START + 60, START + 70, START + 1000], source)
    run()
    found = as_set(spark.read.parquet(sink))
    assert found == emitted(rows, 30)


def test_late_arrivals_count_whatever_the_batches(spark, tmp_path):
    """One file a batch; some arrivals are four batches late, one after its window."""
    on_time = [(i, START + 20 * i, 1 + i % 2, 10) for i in range(1, 6)]
    late = [(20, START + 1, 1, 100), (21, START + 95, 2, 7)]
    for row in on_time + late:
        events(spark, [row]).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    writer = track_refugees(stream, 30).writeStream.format("parquet")
    writer = writer.option("path", f"{tmp_path}/out")
    writer = writer.option("checkpointLocation", f"{tmp_path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    told = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.event_id for r in told.filter("arrival = 1").collect()) == [1, 2, 3, 4, 5, 20, 21]
    totals = told.groupBy("city_id").agg(F.max("refugees").alias("n")).collect()
    assert {r.city_id: r.n for r in totals} == {1: 120, 2: 37}


def test_malformed_message_does_not_stop_the_stream(spark, tmp_path):
    lines = [
        '{"key": "1", "value": "{\\"timestamp\\":1000,\\"city_id\\":1,\\"city_name\\":\\"a\\",\\"refugees\\":4}", "event_id": 1}',
        '{"key": "1", "value": "broken", "event_id": 2}',
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    messages = read_message_files(spark, f"{tmp_path}/in")
    updates, malformed = updates_of(messages, 10, EVENT_TIME, "1 millisecond")
    for frame, name in ((updates, "updates"), (malformed, "bad")):
        writer = write_message_files(frame, f"{tmp_path}/{name}", f"{tmp_path}/{name}-checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.json(f"{tmp_path}/updates").select("key").collect()[0][0] == "1"
    assert [r["value"] for r in spark.read.json(f"{tmp_path}/bad").collect()] == ["broken"]


def test_ranged_stream_restarts_and_repeats(spark, tmp_path):
    """A third of the rows is one city; some come late; the last batch runs twice."""
    rows = [(i, START + i / 4, 1 if i % 3 == 0 else i % 5, i % 7) for i in range(400)]
    source, folder = f"{tmp_path}/in", f"{tmp_path}/tracker"
    published = []

    def run():
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(source)
        writer = track_in_ranges(stream, 30, folder, lambda df: published.append(df.count()))
        writer.trigger(availableNow=True).start().awaitTermination()

    write_slices(spark, rows, [0, START + 40, START + 60], source)
    run()
    write_slices(spark, rows, [START + 60, START + 1000], source)
    run()
    newest = max(int(s * 1000) for _, s, _, _ in rows)
    expected = {u for u in replay(rows, 30) if u[2] <= newest}
    assert as_set(read_updates(spark, folder)) == expected
    assert len(published) == 3 and sum(published) == len(expected)

    last = events(spark, [r for r in rows if r[1] >= START + 60])
    RangedTracker(30, folder)(last, 2)
    assert as_set(read_updates(spark, folder)) == expected

    late = events(spark, [(1000, START + 1, 1, 100)])
    RangedTracker(30, folder)(late, 3)
    found = {u for u in as_set(read_updates(spark, folder)) if u[4] == 1000}
    total = sum(n for _, _, city, n in rows if city == 1) + 100
    assert {(u[3], u[5]) for u in found} == {(1, total), (0, total)}

    with pytest.raises(ValueError):
        RangedTracker(30, folder)(late, 9)


def test_processing_time(spark, tmp_path):
    """Every arrival is counted at once and leaves after the window, by the clock."""
    write_slices(spark, ROWS, [0, 2000], f"{tmp_path}/in")
    stream = spark.readStream.schema(EVENTS).json(f"{tmp_path}/in")
    query = (
        track_refugees(stream, 2, PROCESSING_TIME)
        .writeStream.format("memory")
        .queryName("by_clock")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(processingTime="500 milliseconds")
        .start()
    )
    try:
        deadline = time.time() + 90
        while time.time() < deadline and spark.table("by_clock").count() < 2 * len(ROWS):
            time.sleep(1)
    finally:
        query.stop()
    found = spark.table("by_clock")
    assert found.groupBy("arrival").count().orderBy("arrival").collect() == [
        (0, len(ROWS)),
        (1, len(ROWS)),
    ]
    last = found.groupBy("city_id").agg(F.max("refugees"), F.min("change")).collect()
    assert {tuple(r) for r in last} == {(7, 30, 0), (8, 5, 0), (9, 3, 0)}


def test_bad_arguments(spark):
    stream = events(spark, ROWS)
    with pytest.raises(ValueError):
        track_refugees(stream, 0)
    with pytest.raises(ValueError):
        track_refugees(stream, 5, "x")


class Told:
    """The state and the clock of one key, counting calls."""

    def __init__(self):
        self.value, self.chunks, self.calls = None, {}, 0

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def getValue(self, key):
        self.calls += 1
        return self.chunks[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.chunks[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.chunks[key]

    def registerTimer(self, _):
        self.calls += 1

    deleteTimer = registerTimer

    def getCurrentWatermarkInMs(self):
        return 0


@pytest.mark.parametrize("chunk_rows", [7, 10_000])
def test_calls_to_the_store_do_not_grow_with_cities(chunk_rows):
    """A group of 300 cities, three arrivals each, in two batches."""
    rows = [(i, START + i / 10, i % 300, i % 7) for i in range(900)]
    state, tracker, told = Told(), RefugeeTracker(30, EVENT_TIME, chunk_rows), set()
    tracker.init(state)
    for part in (rows[:400], rows[400:]):
        frame = pd.DataFrame(
            [(False, int(s * 1000), c, f"City {c}.{e}", n, e) for e, s, c, n in part],
            columns=["clock", "at_ms", "city_id", "city_name", "refugees", "event_id"],
        )
        for found in tracker.handleInputRows((0,), iter([frame]), state):
            told |= set(found[[c.split()[0] for c in UPDATES.split(", ")]].itertuples(index=False, name=None))
    last = {c: int(s * 1000) for _, s, c, _ in rows}
    assert told == {u for u in replay(rows, 30) if u[2] <= last[u[0]]}
    assert state.calls < (40 if chunk_rows > 900 else 400)


def test_many_cities_in_a_group(spark, tmp_path):
    """Groups of some cities, in batches and with a restart, equal one replay."""
    rows = [(i, START + i / 4, i % 50, i % 7) for i in range(400)]
    for bounds in ([0, START + 40, START + 60], [START + 60, START + 70, START + 1000]):
        write_slices(spark, rows, bounds, f"{tmp_path}/in")
        stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
        writer = track_refugees(stream, 30, buckets=3).writeStream.format("parquet")
        writer = writer.option("path", f"{tmp_path}/out")
        writer = writer.option("checkpointLocation", f"{tmp_path}/checkpoint")
        writer.trigger(availableNow=True).start().awaitTermination()
    assert as_set(spark.read.parquet(f"{tmp_path}/out")) == emitted(rows, 30)
