from pyspark.sql import functions as F

from floodplan.functions.parsing import parse_population, parse_size
from floodplan.operators import places as P
from floodplan.sources import fixtures
from floodplan.sources.schemas import NODES

SF_DIR = "/root/testdata/sf0.001"


def node(id, type="node", lat=1.0, lon=1.0, **tags):
    return (id, type, lat, lon, tags)


def ids(frame, column="id"):
    return sorted(r[0] for r in frame.select(column).collect())


def test_population_text(spark):
    texts = ["1234", " 12 ", "1234.5", "-7", "+7", "1,234", "12 km", "", "9999999999", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r[0] for r in frame.select(parse_population(F.col("t"))).collect()]
    assert found == [1234, 12, 1234, -7, 7, None, None, None, None, None]
    sizes = [r[0] for r in frame.select(parse_size(F.col("t"))).collect()]
    assert sizes[0] == 1234.0 and sizes[2] == 1234.5 and sizes[5] is None


def test_complete_places_and_split(spark):
    elements = spark.createDataFrame(
        [
            node(1, place="city", population="5", name="a"),
            node(2, place="city", name="no population"),
            node(3, place="hamlet", population="5"),
            node(4, place="halmet", population="5"),
            node(5, harbour="yes"),
            node(6, harbour="no"),
            node(7, place="town", population="5", harbour="yes"),
            node(8, place="town", population="5", harbour="no"),
            node(9, type="way", place="city", population="5"),
            node(10, note="x"),
        ],
        NODES,
    )
    tagged = P.extract_tags(elements)
    assert ids(tagged) == [1, 2, 3, 4, 5, 6, 7, 8]
    complete = P.with_cells(P.complete_places(tagged))
    assert ids(complete) == [1, 4, 5, 7, 8]
    places, harbours = P.split_harbours(complete)
    assert ids(places) == [1, 4]
    assert ids(harbours, "harbour_id") == [5, 7]
    wider = P.complete_places(tagged, (*P.PLACE_TYPES, "hamlet"))
    assert ids(wider) == [1, 3, 4, 5, 7, 8]


def test_repeated_id_keeps_one_row(spark):
    rows = [node(1, place="city", population=p, name="a") for p in ("7", "5", "6")]
    complete = P.with_cells(P.extract_tags(spark.createDataFrame(rows, NODES)))
    found = P.places(complete).collect()
    assert [(r["id"], r["population"]) for r in found] == [(1, "5")]


def test_lookup_equals_pivot(spark):
    nodes = fixtures.nodes(spark, SF_DIR)
    lookup, pivot = (P.extract_tags(nodes, method=m) for m in ("lookup", "pivot"))
    assert lookup.exceptAll(pivot).count() == 0 == pivot.exceptAll(lookup).count()
