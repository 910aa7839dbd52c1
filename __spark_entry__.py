"""Queries over the given tables, one or more per operator, and the SQL they must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from floodplan.functions.grid import ROUGH_RES, cell, centre, grid_distance, k_ring
from floodplan.functions.parsing import parse_population, parse_size
from floodplan.operators import elevation as E
from floodplan.operators import nearest as N
from floodplan.operators import places as P
from floodplan.operators.planet import SHEETS, nearest_on_earth
from floodplan.operators.sample import city_weight, evacuating, weighted_sample
from floodplan.plans import curve as C
from floodplan.plans import evacuation as V
from floodplan.plans import pipeline as L
from floodplan.session import settle, shared_dir
from floodplan.sources import fixtures
from floodplan.sources.files import (
    read_city_features,
    read_city_records,
    read_elevation,
    read_nodes,
    read_plan,
    read_plan_in_order,
    write_bucketed,
    write_destinations,
    write_plan,
)
from floodplan.sources.messages import read_message_files, write_message_files
from floodplan.streaming import updates as U
from floodplan.streaming.job import enriched_updates
from floodplan.streaming.live import keep_live, live_cities, live_intensity
from floodplan.streaming.ranged import (
    read_malformed,
    read_updates,
    track_in_ranges,
    track_messages,
)
from floodplan.streaming.replay import tracker_batch
from floodplan.streaming.tracker import encode_updates, parse_events, track_refugees

try:
    import corpus_pipeline
    from floodplan.llm import queries as llm_queries
except ImportError as missing:
    if missing.name not in ("corpus_pipeline", "floodplan.llm"):
        raise
    corpus_pipeline = llm_queries = None

RISE = oracle_queries.RISE
WINDOW_SECONDS = oracle_queries.WINDOW_SECONDS
FEATURES_PER_FILE = 500

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.extract_tags(fixtures.nodes(spark, sf_dir))


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.complete_places(_tagged(spark, sf_dir))


def _celled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_cells(_complete(spark, sf_dir))


def _terrain(spark: SparkSession, sf_dir: str) -> L.Terrain:
    return L.survey_terrain(fixtures.nodes(spark, sf_dir), fixtures.elevation(spark, sf_dir))


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    terrain = _terrain(spark, sf_dir)
    return (
        E.flooded(terrain.places, RISE),
        E.safe_cities(terrain.places, RISE),
        terrain.harbours,
    )


def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.refuge_options(*_sides(spark, sf_dir))


def _plan(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return L.evacuation_plan(_terrain(spark, sf_dir), RISE, **how)


def osm_nodes(spark, sf_dir):
    return P.only_nodes(fixtures.nodes(spark, sf_dir)).select("id", "lat", "lon")


def tag_rows(spark, sf_dir):
    return P.tag_rows(fixtures.nodes(spark, sf_dir))


def tags_pivot(spark, sf_dir):
    return P.extract_tags(fixtures.nodes(spark, sf_dir), method="pivot")


def harbours(spark, sf_dir):
    return P.split_harbours(_celled(spark, sf_dir))[1]


def places(spark, sf_dir):
    return P.split_harbours(_celled(spark, sf_dir))[0]


def population_parsed(spark, sf_dir):
    text = F.col("population")
    return _tagged(spark, sf_dir).select(
        "id", parse_population(text).alias("evacuees"), parse_size(text).alias("size")
    )


def cells_fine(spark, sf_dir):
    return _tagged(spark, sf_dir).select("id", cell(F.col("lat"), F.col("lon")).alias("cell"))


def cells_rough(spark, sf_dir):
    rough = cell(F.col("lat"), F.col("lon"), ROUGH_RES)
    return _tagged(spark, sf_dir).select("id", rough.alias("cell"))


def k_ring_cells(spark, sf_dir):
    ring = F.explode(k_ring(F.col("rough"), 1))
    return _celled(spark, sf_dir).select("id", ring.alias("neighbour"))


def grid_distances(spark, sf_dir):
    """Every complete node and the one with the next id."""
    here = _celled(spark, sf_dir).select("id", "cell")
    there = here.select((F.col("id") - 1).alias("id"), F.col("cell").alias("next_cell"))
    pair = (F.col("cell"), F.col("next_cell"))
    return here.join(there, "id").select(
        "id",
        grid_distance(*pair).alias("distance"),
        grid_distance(*pair, max_distance=1000).alias("bounded_distance"),
    )


def min_elevation_groupby(spark, sf_dir):
    return E.min_elevation(fixtures.elevation(spark, sf_dir))


def min_elevation_window(spark, sf_dir):
    return E.min_elevation(fixtures.elevation(spark, sf_dir), method="window")


def places_elevated(spark, sf_dir):
    return E.with_elevation(places(spark, sf_dir), min_elevation_groupby(spark, sf_dir))


def places_elevated_bucketed(spark, sf_dir):
    tables = [
        write_bucketed(df, f"{name}_{uuid.uuid4().hex}", 8, _scratch(spark, name))
        for name, df in (
            ("places", places(spark, sf_dir)),
            ("lowest", min_elevation_groupby(spark, sf_dir)),
        )
    ]
    return E.with_elevation(*tables, method="bucketed")


def flooded(spark, sf_dir):
    return E.flooded(places_elevated(spark, sf_dir), RISE)


def safe_cities(spark, sf_dir):
    return E.safe_cities(places_elevated(spark, sf_dir), RISE)


def nearest_city_exhaustive(spark, sf_dir):
    flood, safe, _ = _sides(spark, sf_dir)
    return N.nearest_city(flood, safe)


def nearest_harbour_exhaustive(spark, sf_dir):
    flood, _, harbour = _sides(spark, sf_dir)
    return N.nearest_harbour(flood, harbour)


def nearest_city_ring(spark, sf_dir):
    flood, safe, _ = _sides(spark, sf_dir)
    return N.nearest_city(flood, safe, N.Search("ring"))


def nearest_city_bounded(spark, sf_dir):
    flood, safe, _ = _sides(spark, sf_dir)
    return N.nearest_city(flood, safe, N.Search(max_distance=oracle_queries.MAX_DISTANCE))


def nodes_orc(spark, sf_dir):
    """The map written as ORC and read back."""
    path = _scratch(spark, "nodes")
    fixtures.nodes(spark, sf_dir).write.orc(path)
    return P.extract_tags(read_nodes(spark, path))


def elevation_parquet(spark, sf_dir):
    """The lowest samples of several folders that one glob names."""
    path = _scratch(spark, "samples")
    samples = fixtures.elevation(spark, sf_dir)
    samples.withColumn("tile", F.floor(F.col("lat") / 20)).write.partitionBy("tile").parquet(path)
    return E.min_elevation(read_elevation(spark, f"{path}/tile=*"))


def nearest_harbour_ring(spark, sf_dir):
    flood, _, harbour = _sides(spark, sf_dir)
    return N.nearest_harbour(flood, harbour, N.Search("ring", fallback=False))


def nearest_city_rings(spark, sf_dir):
    flood, safe, _ = _sides(spark, sf_dir)
    return N.nearest_city(flood, safe, N.Search("ring", rings=(1, 2, 4)))


def _around_the_edge(rows: DataFrame) -> DataFrame:
    """The same map turned until some of its cities lie across the edge of the sheet."""
    turned = F.pmod(F.col("lon") + oracle_queries.TURN + 180, F.lit(360)) - 180
    return rows.withColumn("lon", turned)


def _planet_terrain(spark: SparkSession, sf_dir: str) -> L.Terrain:
    frames = [_around_the_edge(f(spark, sf_dir)) for f in (fixtures.nodes, fixtures.elevation)]
    return L.survey_terrain(*frames, sheets=SHEETS)


def nearest_city_planet(spark, sf_dir):
    """By great circles, on a map that crosses the edge of the sheet."""
    terrain = _planet_terrain(spark, sf_dir)
    flood, safe = E.flooded(terrain.places, RISE), E.safe_cities(terrain.places, RISE)
    return N.nearest_city(flood, safe, find=nearest_on_earth)


def relocation_plan_planet(spark, sf_dir):
    return L.evacuation_plan(_planet_terrain(spark, sf_dir), RISE, find=nearest_on_earth)


def cell_centres(spark, sf_dir):
    """The middle of every place's cell on the sheets of the whole earth."""
    lat, lon = centre(F.col("cell"), sheets=SHEETS)
    cells = P.with_cells(_around_the_edge(_complete(spark, sf_dir)), sheets=SHEETS)
    return cells.select("id", "cell", F.round(lat, 9).alias("centre_lat"), F.round(lon, 9).alias("centre_lon"))


def near_harbour(spark, sf_dir):
    return V.split_by_refuge(_options(spark, sf_dir))[0]


def near_city(spark, sf_dir):
    return V.split_by_refuge(_options(spark, sf_dir))[1]


def relocation_plan_ring(spark, sf_dir):
    return _plan(spark, sf_dir, searches=L.RING)


def relocation_plan_by_id(spark, sf_dir):
    return _plan(spark, sf_dir, place_key="id")


def relocation_plan_minus_one(spark, sf_dir):
    return _plan(spark, sf_dir, searches=L.RING, missing_harbour="nearest")


def plan_orc_roundtrip(spark, sf_dir):
    path = _scratch(spark, "plan")
    write_plan(settle(_plan(spark, sf_dir)), path)
    return read_plan(spark, path)


def plan_order(spark, sf_dir):
    """The written plan with the position of each row."""
    path = _scratch(spark, "ordered")
    write_plan(settle(_plan(spark, sf_dir)), path)
    return read_plan_in_order(spark, path)


def _rounded(change: DataFrame) -> DataFrame:
    return change.withColumns(
        {c: F.round(c, 6) for c in ("old_population", "new_population")}
    )


def destinations_orc_roundtrip(spark, sf_dir):
    path = _scratch(spark, "destinations")
    write_destinations(V.destination_change(_plan(spark, sf_dir)), path)
    return _rounded(spark.read.orc(path))


def destination_change(spark, sf_dir):
    return _rounded(V.destination_change(_plan(spark, sf_dir)))


def destination_change_by_id(spark, sf_dir):
    return _rounded(V.destination_change(_plan(spark, sf_dir, place_key="id"), "id"))


def total_evacuees(spark, sf_dir):
    return V.total_evacuees(_plan(spark, sf_dir))


def evacuation_totals(spark, sf_dir):
    return L.evacuation_totals(_terrain(spark, sf_dir), list(oracle_queries.RISES))


def relocation_plans_by_rise(spark, sf_dir):
    """The plan of every whole rise up to 95 m, from one search; a row for each range of rises."""
    terrain = _terrain(spark, sf_dir)
    plans = C.plans_by_rise(terrain.places, terrain.harbours)
    return plans.withColumn("rise", F.explode(F.sequence("low", "high"))).drop(*C.RANGE)


def evacuation_curve(spark, sf_dir):
    terrain = _terrain(spark, sf_dir)
    return C.evacuation_curve(C.plans_by_rise(terrain.places, terrain.harbours))


def unassigned(spark, sf_dir):
    """Flooded rows that a ring search without fallback leaves without a city."""
    flood, safe, harbour = _sides(spark, sf_dir)
    narrow = N.Search("ring", fallback=False)
    options = N.refuge_options(flood, safe, harbour, narrow, narrow, place_key="id")
    return V.unassigned(flood, V.relocation_plan(options), place_key="id")


def batch_updates(spark, sf_dir):
    return tracker_batch(fixtures.refugee_events(spark, sf_dir), WINDOW_SECONDS)


def _messages(events: DataFrame) -> DataFrame:
    """Arrivals as a topic's messages, and their time."""
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    body = F.to_json(F.struct(at.alias("timestamp"), "city_id", "city_name", "refugees"))
    return events.select(
        at.alias("at_ms"),
        F.col("city_id").cast("string").alias("key"),
        body.alias("value"),
        "event_id",
    )


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own: a stream keeps its number of partitions for good."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
        "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
    }.items():
        session.conf.set(key, value)
    return session


def _halves(spark: SparkSession, sf_dir: str, source: str, files: int):
    """Write the messages in order of time, so many files in each half; stops after each half."""
    ranges = settle(
        _messages(fixtures.refugee_events(spark, sf_dir))
        .repartitionByRange(2 * files, "at_ms", "event_id")
        .withColumn("range", F.spark_partition_id())
    )
    for number in range(2 * files):
        rows = ranges.filter(F.col("range") == number).drop("range", "at_ms")
        rows.coalesce(1).write.mode("append").json(source)
        if number % files == files - 1:
            yield


def tracker_stream(spark, sf_dir):
    """All updates of a stream of 12 batches that is stopped halfway and started again."""
    spark = _stream_session(spark)
    source, sink = _scratch(spark, "messages"), _scratch(spark, "updates")
    checkpoint = _scratch(spark, "checkpoint")
    for _ in _halves(spark, sf_dir, source, 6):
        arrivals, _ = parse_events(read_message_files(spark, source, max_files=1))
        updates = track_refugees(arrivals, WINDOW_SECONDS)
        writer = write_message_files(updates, sink, checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(updates.schema).json(sink)


def tracker_stream_unordered(spark, sf_dir):
    """Each city's arrivals and total after a stream of 24 batches in no order of time."""
    spark = _stream_session(spark)
    source, sink = _scratch(spark, "messages"), _scratch(spark, "updates")
    messages = _messages(fixtures.refugee_events(spark, sf_dir)).drop("at_ms")
    junk = messages.filter("event_id % 100 = 7").withColumn("value", F.left("value", F.lit(20)))
    messages.unionByName(junk).repartition(24, "event_id").write.json(source)
    arrivals, _ = parse_events(read_message_files(spark, source, max_files=1))
    updates = track_refugees(arrivals, WINDOW_SECONDS)
    writer = write_message_files(updates, sink, _scratch(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    told = spark.read.schema(updates.schema).json(sink).filter("arrival = 1")
    return told.groupBy("city_id").agg(
        F.count("*").alias("n_arrivals"),
        F.countDistinct("event_id").alias("n_events"),
        F.max("refugees").alias("refugees"),
    )


def tracker_stream_ranged(spark, sf_dir):
    """The same stream in six batches, each cut into ranges instead of cities."""
    spark = _stream_session(spark)
    source, folder = _scratch(spark, "messages"), _scratch(spark, "ranged")
    for _ in _halves(spark, sf_dir, source, 3):
        arrivals, _ = parse_events(read_message_files(spark, source, max_files=1))
        writer = track_in_ranges(arrivals, WINDOW_SECONDS, folder)
        writer.trigger(availableNow=True).start().awaitTermination()
    return read_updates(spark, folder)


def messages_split_stream(spark, sf_dir):
    """Where each message went, of a stream whose second batch fails once and is repeated."""
    spark = _stream_session(spark)
    source, folder = _scratch(spark, "messages"), _scratch(spark, "split")
    messages = _messages(fixtures.refugee_events(spark, sf_dir)).drop("at_ms")
    cut = F.when(F.col("event_id") % 100 == 7, F.left("value", F.lit(20))).otherwise(F.col("value"))
    messages.withColumn("value", cut).repartition(4, "event_id").write.json(source)
    failures = []

    def publish(updates: DataFrame) -> None:
        failures.append(None)
        if len(failures) == 2:
            raise RuntimeError("the sink is away")

    for _ in range(2):
        stream = read_message_files(spark, source, max_files=1)
        query = track_messages(stream, WINDOW_SECONDS, folder, publish).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if len(failures) != 2:
                raise
    good = read_updates(spark, folder).filter("arrival = 1").select("event_id", F.lit(False).alias("malformed"))
    return good.union(read_malformed(spark, folder).select("event_id", F.lit(True)))


def updates_json(spark, sf_dir):
    messages = encode_updates(batch_updates(spark, sf_dir))
    parsed = U.parse_updates(messages)
    return parsed.select(F.col("city_id").cast("string").alias("key"), *parsed.columns)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cities as JSON features; every third has an area, all have a property of their own."""
    ring = "array(array(0.0, 0.0), array(1.0, 0.0), array(1.0, 1.0), array(0.0, 0.0))"
    area = f"to_json(named_struct('type', 'Polygon', 'coordinates', array({ring})))"
    spot = "to_json(named_struct('type', 'Point', 'coordinates', array(0.0, 0.0)))"
    number = F.col("geoname_id").cast("bigint")
    properties = F.to_json(
        F.struct("geoname_id", "name", "population", F.concat(F.lit("R"), number % 7).alias("region"))
    )
    geometry = F.when(number % 3 == 0, F.expr(area)).otherwise(F.expr(spot))
    text = F.concat(
        F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}")
    )
    return fixtures.cities(spark, sf_dir).select(number.alias("number"), text.alias("value"))


def _city_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cities as features: written as GeoJSON collections and read back."""
    start, end = F.lit('{"type":"FeatureCollection","features":['), F.lit("]}")
    collections = (
        _features(spark, sf_dir)
        .groupBy((F.col("number") / FEATURES_PER_FILE).cast("bigint").alias("file"))
        .agg(F.concat(start, F.array_join(F.collect_list("value"), ","), end).alias("value"))
    )
    path = _scratch(spark, "cities")
    collections.write.partitionBy("file").text(path)
    return read_city_features(spark, path)


def city_records(spark, sf_dir):
    """The cities of files with one feature a record, with what only the whole feature holds."""
    path = _scratch(spark, "records")
    _features(spark, sf_dir).select(F.concat(F.lit("\x1e"), "value").alias("value")).write.text(path)
    return read_city_records(spark, path).select("city_id", "name", "population", *_of_feature())


def _of_feature() -> list:
    """Parts of a feature beyond id, name and population."""
    part = lambda path, type: F.try_variant_get("feature", path, type)
    return [
        part("$.properties.region", "string").alias("region"),
        part("$.geometry.type", "string").alias("geometry"),
        part("$.geometry.coordinates[0][2][1]", "double").alias("corner"),
    ]


def city_features(spark, sf_dir):
    return _city_table(spark, sf_dir).select("city_id", "name", "population")


def large_cities(spark, sf_dir):
    return U.large_cities(city_features(spark, sf_dir))


def updates_enriched(spark, sf_dir):
    return U.enrich_updates(batch_updates(spark, sf_dir), large_cities(spark, sf_dir))


def updates_enriched_stream(spark, sf_dir):
    """The consumer on a stream of updates; some name an unknown city or none, some are junk."""
    spark = _stream_session(spark)
    source, sink = _scratch(spark, "topic"), _scratch(spark, "enriched")
    city = F.expr(
        "CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN city_id + 1000000000 ELSE city_id END"
    )
    messages = encode_updates(batch_updates(spark, sf_dir).withColumn("city_id", city))
    value = F.when(F.col("event_id") % 50 == 2, "no update").otherwise(F.col("value"))
    messages.withColumn("value", value).write.json(source)
    cities = settle(U.large_cities(_city_table(spark, sf_dir)))
    stream = read_message_files(spark, source, schema=messages.schema)
    enriched = enriched_updates(stream, cities).select(
        "count",
        "change",
        "city_id",
        "at_ms",
        "arrival",
        "event_id",
        "name",
        "population",
        "feature",
    )
    writer = write_message_files(enriched, sink, _scratch(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    told = spark.read.schema(enriched.schema).json(sink)
    return told.select("*", *_of_feature()).drop("feature")


def malformed_messages(spark, sf_dir):
    """What is set aside where one message in a hundred is cut short."""
    messages = _messages(fixtures.refugee_events(spark, sf_dir)).drop("at_ms")
    cut = F.when(F.col("event_id") % 100 == 7, F.left("value", F.lit(20))).otherwise(F.col("value"))
    _, malformed = parse_events(messages.withColumn("value", cut))
    return malformed.select("key", "event_id", F.length("value").alias("n_chars"))


def city_latest(spark, sf_dir):
    return U.latest_by_city(batch_updates(spark, sf_dir), ("at_ms", "arrival", "event_id"))


def city_intensity(spark, sf_dir):
    found = U.city_intensity(settle(city_latest(spark, sf_dir)))
    return found.withColumns({c: F.round(c, 6) for c in ("count_scale", "change_scale")})


def _live(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, str]:
    """The live map after 20 batches of updates in order of time, stopped halfway."""
    spark = _stream_session(spark)
    source, folder = _scratch(spark, "topic"), _scratch(spark, "live")
    messages = encode_updates(batch_updates(spark, sf_dir))
    order = ("at_ms", "arrival", "event_id")
    ranges = settle(messages.repartitionByRange(20, *order).withColumn("half", F.spark_partition_id() >= 10))
    for half in (False, True):
        rows = ranges.filter(F.col("half") == half).drop("half").repartitionByRange(10, *order)
        rows.write.mode("append").json(source)
        stream = read_message_files(spark, source, max_files=1, schema=messages.schema)
        writer = keep_live(U.parse_updates(stream), folder, order, buckets=8)
        writer.trigger(availableNow=True).start().awaitTermination()
    return spark, folder


def city_latest_stream(spark, sf_dir):
    return live_cities(*_live(spark, sf_dir))


def city_intensity_stream(spark, sf_dir):
    found = live_intensity(*_live(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in ("count_scale", "change_scale")})


def sampled_cities(spark, sf_dir):
    cities = fixtures.cities(spark, sf_dir).select(
        F.col("geoname_id").cast("bigint").alias("city_id"), "population"
    )
    drawn = weighted_sample(
        U.large_cities(cities),
        city_weight(F.col("population")),
        oracle_queries.SAMPLE_SIZE,
        oracle_queries.SAMPLE_SEED,
        "city_id",
    )
    return drawn.withColumn("evacuating", evacuating(F.col("population")))


def entry(spark: SparkSession) -> DataFrame:
    """The relocation plan for a rise of 20 m."""
    return _plan(spark, "/root/testdata/sf0.001")


def own_queries() -> dict[str, Query]:
    """Those of the flood analytics."""
    return {
        "osm_nodes": osm_nodes,
        "tag_rows": tag_rows,
        "tags_lookup": _tagged,
        "tags_pivot": tags_pivot,
        "complete_places": _complete,
        "harbours": harbours,
        "places": places,
        "population_parsed": population_parsed,
        "cells_fine": cells_fine,
        "cells_rough": cells_rough,
        "k_ring_cells": k_ring_cells,
        "grid_distances": grid_distances,
        "min_elevation_groupby": min_elevation_groupby,
        "min_elevation_window": min_elevation_window,
        "places_elevated": places_elevated,
        "places_elevated_bucketed": places_elevated_bucketed,
        "flooded": flooded,
        "safe_cities": safe_cities,
        "nearest_city_exhaustive": nearest_city_exhaustive,
        "nearest_harbour_exhaustive": nearest_harbour_exhaustive,
        "nearest_city_ring": nearest_city_ring,
        "nearest_harbour_ring": nearest_harbour_ring,
        "nearest_city_rings": nearest_city_rings,
        "refuge_options": _options,
        "nearest_city_planet": nearest_city_planet,
        "relocation_plan_planet": relocation_plan_planet,
        "cell_centres": cell_centres,
        "near_harbour": near_harbour,
        "near_city": near_city,
        "relocation_plan": _plan,
        "relocation_plan_ring": relocation_plan_ring,
        "relocation_plan_by_id": relocation_plan_by_id,
        "relocation_plan_minus_one": relocation_plan_minus_one,
        "plan_orc_roundtrip": plan_orc_roundtrip,
        "plan_order": plan_order,
        "destinations_orc_roundtrip": destinations_orc_roundtrip,
        "destination_change": destination_change,
        "destination_change_by_id": destination_change_by_id,
        "total_evacuees": total_evacuees,
        "evacuation_totals": evacuation_totals,
        "relocation_plans_by_rise": relocation_plans_by_rise,
        "evacuation_curve": evacuation_curve,
        "unassigned": unassigned,
        "tracker_batch": batch_updates,
        "tracker_stream": tracker_stream,
        "tracker_stream_unordered": tracker_stream_unordered,
        "tracker_stream_ranged": tracker_stream_ranged,
        "messages_split_stream": messages_split_stream,
        "updates_json": updates_json,
        "updates_enriched": updates_enriched,
        "updates_enriched_stream": updates_enriched_stream,
        "malformed_messages": malformed_messages,
        "nearest_city_bounded": nearest_city_bounded,
        "nodes_orc": nodes_orc,
        "elevation_parquet": elevation_parquet,
        "city_latest": city_latest,
        "city_intensity": city_intensity,
        "city_latest_stream": city_latest_stream,
        "city_intensity_stream": city_intensity_stream,
        "large_cities": large_cities,
        "city_features": city_features,
        "city_records": city_records,
        "weighted_sample": sampled_cities,
    }


def queries() -> dict[str, Query]:
    found = own_queries()
    if llm_queries:
        found |= llm_queries.queries()
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_queries.oracle_sql()
    if llm_queries:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
