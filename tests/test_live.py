"""The live map's state over several batches."""

import os
import random

import pytest

from floodplan.streaming import live
from floodplan.streaming.updates import city_intensity


def rows(table):
    return sorted(map(str, table.collect()))


def files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{folder}/cities") for f in names if f.endswith(".parquet")}


def test_batches(spark, tmp_path):
    rng, folder, known = random.Random(1), str(tmp_path), {}
    state = live.LiveMap(folder, buckets=6)
    assert live.last_batch(spark, folder) == -1 and not rows(live.live_cities(spark, folder))
    for batch in range(7):
        changed = {c: (f"n{batch}", known.get(c, ("", 0, 0))[1] + rng.randrange(9), rng.randrange(5)) for c in rng.sample([None, *range(9)], 2)}
        if batch == 4:
            changed = {}
        table = spark.createDataFrame([(c, *v) for c, v in changed.items()], live.CITIES)
        before = files(folder)
        state(table, batch)
        if batch == 3:
            state(table, batch)  # repeated after a failure
        known |= changed
        want = spark.createDataFrame([(c, *v) for c, v in known.items()], live.CITIES)
        assert live.last_batch(spark, folder) == batch
        assert rows(live.live_cities(spark, folder)) == rows(want)
        assert rows(live.live_intensity(spark, folder)) == rows(city_intensity(want))
        # What the batch didn't touch was not written again.
        assert len(files(folder) - before) <= len(changed)
    # Old versions go.
    assert len(files(folder)) < 2 * len(known) + 6
    assert len(os.listdir(f"{folder}/versions")) <= 4


def test_state_must_follow(spark, tmp_path):
    state = live.LiveMap(str(tmp_path))
    with pytest.raises(Exception):
        state(spark.createDataFrame([], live.CITIES), 5)
    with pytest.raises(ValueError):
        live.LiveMap(str(tmp_path), 0)
