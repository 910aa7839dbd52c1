"""The physical plans that the operators are meant to have."""

import re

import pytest

import __spark_entry__ as entry
from floodplan.operators import elevation as E
from floodplan.operators import nearest as N
from floodplan.operators import places as P
from floodplan.plans import pipeline as L
from floodplan.session import settle
from floodplan.sources import fixtures
from floodplan.sources.files import read_elevation, read_nodes, write_bucketed

SF_DIR = "/root/testdata/sf0.001"
PRODUCTS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    nodes, samples = f"{folder}/nodes", f"{folder}/samples"
    fixtures.nodes(spark, SF_DIR).write.orc(nodes)
    fixtures.elevation(spark, SF_DIR).write.parquet(samples)
    return nodes, samples


@pytest.fixture
def no_broadcast(spark):
    """Plans as large inputs get them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_map_scan_is_filtered_and_nothing_moves(spark, files):
    found = plan(P.complete_places(P.extract_tags(read_nodes(spark, files[0]))))
    assert "EqualTo(type,node)" in found and "Exchange" not in found
    assert "Exchange" in plan(P.extract_tags(read_nodes(spark, files[0]), method="pivot"))


def test_samples_are_reduced_before_they_move(spark, files):
    samples = read_elevation(spark, files[1])
    found = plan(E.min_elevation(samples))
    assert found.index("Exchange") < found.index("partial_min")
    window = plan(E.min_elevation(samples, method="window"))
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit[^\n]*Partial", window)


@pytest.fixture
def settled(monkeypatch):
    """The plans of all frames that are kept on the way, in order."""
    plans = []

    def record(df):
        plans.append(plan(df))
        return settle(df)

    for module in (N, L):
        monkeypatch.setattr(module, "settle", record)
    return plans


def test_no_products_and_no_python(spark, no_broadcast, settled):
    terrain = entry._terrain(spark, SF_DIR)
    for searches in (L.EXHAUSTIVE, L.RING):
        settled.append(plan(L.evacuation_plan(terrain, 20, searches)))
    flood, safe, _ = entry._sides(spark, SF_DIR)
    for search in (N.Search(), N.Search("ring", rings=(0, 2))):
        settled.append(plan(N.nearest_city(flood, safe, search)))
    assert len(settled) > 20
    assert not [name for name in (*PRODUCTS, *PYTHON) for found in settled if name in found]


def test_candidates_are_pruned_where_they_were_joined(spark, no_broadcast, settled):
    """The window over a block's candidates reads the join's partitions as they are."""
    flood, safe, _ = entry._sides(spark, SF_DIR)
    N.nearest_city(flood, safe)
    lines = settled[-1].splitlines()
    windows = [i for i, line in enumerate(lines) if "+- Window [min(farthest" in line]
    assert len(windows) == len(N.level_shifts(7)) - 1
    for i in windows:
        below = [re.sub(r"^[\s:+\-*()\d]*", "", line).split()[0] for line in lines[i + 1 : i + 4]]
        assert below == ["Sort", "Project", "SortMergeJoin"]


def test_buckets_join_without_exchange(spark, tmp_path, no_broadcast):
    frames = [spark.range(100).selectExpr("id AS cell", f"id AS {name}") for name in "ab"]
    tables = [write_bucketed(f, f"bucketed_{i}", 4, f"{tmp_path}/{i}") for i, f in enumerate(frames)]
    assert "Exchange" not in plan(E.with_elevation(*tables, method="bucketed"))


def test_tracker_shuffles_its_rows_twice_in_all(spark, no_broadcast):
    """Once into ranges, once to meet what is carried; the window needs no third."""
    found = plan(entry.batch_updates(spark, SF_DIR))
    window = found.index("Window [")
    assert found[window:].index("SortMergeJoin") < found[window:].index("Exchange")
