"""The SQL that each query of ``__spark_entry__`` must agree with, for DuckDB.

Written from the rules, not from the Spark code: cells come from rounding three axes,
and nearest places from comparing all pairs, which is fine for a check.
"""

from __future__ import annotations

import math

from floodplan.sources import fixtures

RISE = 20
RISES = (10, 20, 30, 50)
WINDOW_SECONDS = 86_400
SAMPLE_SIZE = 10
SAMPLE_SEED = 7
LARGE_POPULATION = 400_000
MAX_DISTANCE = 300
TURN = 27.25


def _edge(res: int) -> float:
    return math.sqrt(2 * 4250546.8477 / 7**res / (3 * math.sqrt(3)))


def _meridian(x: str) -> str:
    """That of the 15 degrees that hold a longitude."""
    return f"(least(greatest(floor(({x} + 180) / 15e0), 0), 23) * 15e0 - 172.5e0)"


def _cell(lat: str, lon: str, res: int, sheets: bool = False) -> str:
    edge = _edge(res)
    x = f"(6371.0088e0 * radians({lon}) * cos(radians({lat})))"
    if sheets:
        m = _meridian(lon)
        x = f"(6371.0088e0 * radians({m} + ({lon} - {m}) * cos(radians({lat}))))"
    y = f"(6371.0088e0 * radians({lat}))"
    fq = f"(({x} * sqrt(3e0) / 3e0 - {y} / 3e0) / CAST({edge!r} AS DOUBLE))"
    fr = f"((2e0 * {y} / 3e0) / CAST({edge!r} AS DOUBLE))"
    fs = f"(-{fq} - {fr})"
    rq, rr, rs = (f"CAST(floor({v} + 0.5e0) AS BIGINT)" for v in (fq, fr, fs))
    eq, er, es = (f"abs({a} - {b})" for a, b in ((rq, fq), (rr, fr), (rs, fs)))
    q = f"(CASE WHEN {eq} > {er} AND {eq} > {es} THEN -{rr} - {rs} ELSE {rq} END)"
    r = f"(CASE WHEN NOT ({eq} > {er} AND {eq} > {es}) AND {er} > {es} THEN -{rq} - {rs} ELSE {rr} END)"
    return f"(({res}::BIGINT * 268435456 + {q} + 134217728) * 268435456 + {r} + 134217728)"


def _steps(a: str, b: str) -> str:
    dq = f"(({a} // 268435456) % 268435456 - ({b} // 268435456) % 268435456)"
    dr = f"({a} % 268435456 - {b} % 268435456)"
    return f"CAST((abs({dq}) + abs({dr}) + abs({dq} + {dr})) // 2 AS INTEGER)"


def _centre(cell: str, res: int) -> tuple[str, str]:
    """Latitude and longitude of the middle of a cell on the sheets of the whole earth."""
    degree = 6371.0088 * math.pi / 180
    q = f"(({cell} // 268435456) % 268435456 - 134217728)"
    r = f"({cell} % 268435456 - 134217728)"
    lat = f"greatest(least({r} * CAST({1.5 * _edge(res) / degree!r} AS DOUBLE), 90), -90)"
    x = f"(({q} + {r} / 2e0) * CAST({math.sqrt(3) * _edge(res) / degree!r} AS DOUBLE))"
    m = _meridian(x)
    return lat, f"({m} + greatest(least(({x} - {m}) / cos(radians({lat})), 7.5e0), -7.5e0))"


def _metres(a: str, b: str) -> str:
    """Great-circle distance by haversines."""
    la, lb, oa, ob = (f"radians({t}.centre_{c})" for c in ("lat", "lon") for t in (a, b))
    h = f"pow(sin(({la} - {lb}) / 2), 2) + cos({la}) * cos({lb}) * pow(sin(({oa} - {ob}) / 2), 2)"
    return f"CAST(round(12742017.6e0 * asin(least(1e0, sqrt({h})))) AS BIGINT)"


def _population(text: str) -> str:
    return (
        f"TRY_CAST(nullif(regexp_extract(trim({text}), '^([+-]?[0-9]+)([.][0-9]*)?$', 1), '')"
        " AS INTEGER)"
    )


# Every step as a named query; a later one may read any earlier one.
STEPS = {
    "osm_flat": fixtures.OSM_FLAT.format(customer="customer", supplier="supplier"),
    "samples": fixtures.ELEVATION.format(orders="orders", osm_flat="osm_flat"),
    "refugee_events": fixtures.REFUGEE_EVENTS.format(events="events"),
    "cities": fixtures.CITIES.format(customer="customer"),
    "tagged": """
        SELECT id, lat, lon, name, place, population, harbour FROM osm_flat
        WHERE type = 'node' AND coalesce(name, place, population, harbour) IS NOT NULL""",
    "complete": """
        SELECT * FROM tagged
        WHERE (place IN ('city', 'town', 'village', 'halmet') AND population IS NOT NULL)
          OR harbour = 'yes'""",
    "celled": f"""
        SELECT *, {_cell('lat', 'lon', 7)} AS cell, {_cell('lat', 'lon', 1)} AS rough
        FROM complete""",
    "harbours": """
        SELECT id AS harbour_id, name AS harbour, cell, rough FROM celled
        WHERE harbour = 'yes'""",
    "places": """
        SELECT id, name, population, place, cell, rough FROM celled WHERE harbour IS NULL""",
    "lowest": f"""
        SELECT cell, min(elevation) AS elevation
        FROM (SELECT {_cell('lat', 'lon', 7)} AS cell, elevation FROM samples) GROUP BY cell""",
    "elevated": """
        SELECT p.*, l.elevation FROM places p JOIN lowest l ON p.cell = l.cell""",
    "rises": f"SELECT unnest([{', '.join(map(str, RISES))}]) AS rise",
    "all_flooded": f"""
        SELECT rise, name AS place, id AS flood_id, {_population('population')} AS num_evacuees,
          cell, rough
        FROM elevated, rises WHERE elevation <= rise AND name IS NOT NULL""",
    "all_safe": """
        SELECT rise, name AS destination, id AS destination_id,
          TRY_CAST(population AS DOUBLE) AS safe_population, cell, rough
        FROM elevated, rises
        WHERE elevation > rise AND place = 'city' AND name IS NOT NULL""",
    "flooded": f"SELECT * EXCLUDE (rise) FROM all_flooded WHERE rise = {RISE}",
    "safe": f"SELECT * EXCLUDE (rise) FROM all_safe WHERE rise = {RISE}",
    "city_pairs": f"""
        SELECT f.rise, f.place, f.flood_id, f.num_evacuees, s.destination, s.destination_id,
          s.safe_population, {_steps('f.cell', 's.cell')} AS distance,
          {_steps('f.rough', 's.rough')} AS rough_distance
        FROM all_flooded f JOIN all_safe s ON f.rise = s.rise""",
    "harbour_pairs": f"""
        SELECT f.rise, f.place, f.flood_id, h.harbour_id,
          {_steps('f.cell', 'h.cell')} AS distance,
          {_steps('f.rough', 'h.rough')} AS rough_distance
        FROM all_flooded f, harbours h""",
}


STEPS["planet_nodes"] = f"""
    SELECT * REPLACE ((lon + {TURN} + 180) % 360 - 180 AS lon) FROM complete"""
STEPS["planet_cells"] = f"""
    SELECT *, {_cell('lat', 'lon', 7, True)} AS cell FROM planet_nodes"""
STEPS["planet_centres"] = f"""
    SELECT *, {_centre('cell', 7)[0]} AS centre_lat, {_centre('cell', 7)[1]} AS centre_lon
    FROM planet_cells"""
STEPS["planet_lowest"] = f"""
    SELECT cell, min(elevation) AS elevation FROM (
      SELECT {_cell('lat', 'lon', 7, True)} AS cell, elevation
      FROM (SELECT * REPLACE ((lon + {TURN} + 180) % 360 - 180 AS lon) FROM samples)) GROUP BY cell"""
STEPS["planet_elevated"] = """
    SELECT p.*, l.elevation FROM planet_centres p JOIN planet_lowest l ON p.cell = l.cell
    WHERE harbour IS NULL AND name IS NOT NULL"""
STEPS["planet_cities"] = f"""
    SELECT f.name AS place, f.id AS flood_id, {_population('f.population')} AS num_evacuees,
      s.name AS destination, s.id AS destination_id, TRY_CAST(s.population AS DOUBLE) AS safe_population,
      {_metres('f', 's')} AS city_distance
    FROM planet_elevated f JOIN planet_elevated s
    ON f.elevation <= {RISE} AND s.elevation > {RISE} AND s.place = 'city'
    QUALIFY row_number() OVER (
      PARTITION BY f.name ORDER BY {_metres('f', 's')}, f.id, s.id) = 1"""
STEPS["planet_harbours"] = f"""
    SELECT f.name AS place, min({_metres('f', 'h')}) AS harbour_distance
    FROM planet_elevated f JOIN planet_centres h ON f.elevation <= {RISE} AND h.harbour = 'yes'
    GROUP BY f.name"""
STEPS["planet_options"] = f"""
    SELECT {RISE} AS rise, c.*, h.harbour_distance
    FROM planet_cities c LEFT JOIN planet_harbours h ON c.place = h.place"""


def _reach(pairs: str, rings: tuple[int, ...] | None, fallback: bool) -> str:
    """The pairs that a search looks at."""
    if rings is None:
        return f"SELECT * FROM {pairs}"
    first = "CASE " + " ".join(f"WHEN min_rough <= {k} THEN {k}" for k in rings)
    first += f" ELSE {100_000 if fallback else -1} END"
    return f"""
        SELECT * EXCLUDE (min_rough) FROM (
          SELECT *, min(rough_distance) OVER (PARTITION BY rise, flood_id) AS min_rough
          FROM {pairs}) WHERE rough_distance <= {first}"""


def _city(key: str, rings=None, fallback=True) -> str:
    return f"""
        SELECT rise, place, flood_id, num_evacuees, destination, destination_id, safe_population,
          distance AS city_distance
        FROM ({_reach('city_pairs', rings, fallback)})
        QUALIFY row_number() OVER (
          PARTITION BY rise, {key} ORDER BY distance, flood_id, destination_id) = 1"""


def _harbour(key: str, rings=None, fallback=False) -> str:
    return f"""
        SELECT rise, place, flood_id, distance AS harbour_distance, harbour_id
        FROM ({_reach('harbour_pairs', rings, fallback)})
        QUALIFY row_number() OVER (
          PARTITION BY rise, {key} ORDER BY distance, flood_id, harbour_id) = 1"""


def _options(key: str, rings=None) -> str:
    return f"""
        SELECT c.*, h.harbour_distance
        FROM ({_city(key, rings)}) c LEFT JOIN ({_harbour(key, rings)}) h
        ON c.rise = h.rise AND c.{key} = h.{key}"""


def _plan(options: str, missing: str = "false") -> str:
    near = f"coalesce(harbour_distance <= city_distance, {missing})"
    return f"""
        SELECT rise, place, flood_id, num_evacuees * 0.75e0 AS num_evacuees, destination,
          destination_id, safe_population FROM {options} WHERE {near}
        UNION ALL
        SELECT rise, place, flood_id, num_evacuees * 0.25e0, 'Waterworld', NULL, 0e0
        FROM {options} WHERE {near}
        UNION ALL
        SELECT rise, place, flood_id, num_evacuees * 1e0, destination, destination_id,
          safe_population FROM {options} WHERE NOT {near}"""


def _every_rise(text: str) -> str:
    """The same over all rises up to 95 m."""
    for step in ("all_flooded", "all_safe", "city_pairs", "harbour_pairs"):
        text = text.replace(step, f"every_{step}")
    return text.replace(", rises", ", every_rise")


STEPS["every_rise"] = "SELECT unnest(range(96))::INT AS rise"
for _step in ("all_flooded", "all_safe", "city_pairs", "harbour_pairs"):
    STEPS[f"every_{_step}"] = _every_rise(STEPS[_step])
STEPS["every_options"] = _every_rise(_options("place"))
STEPS["every_plan"] = _plan("every_options")
STEPS["options"] = _options("place")
STEPS["options_ring"] = _options("place", (1,))
STEPS["options_id"] = _options("flood_id")
STEPS["plan"] = _plan("options")
STEPS["plan_ring"] = _plan("options_ring")
STEPS["plan_id"] = _plan("options_id")
STEPS["plan_minus_one"] = _plan("options_ring", "true")
STEPS["moves"] = f"""
    SELECT city_id, city_name, event_id, epoch_us(ts) // 1000 AS at_ms, 1 AS arrival, refugees
    FROM refugee_events
    UNION ALL
    SELECT city_id, city_name, event_id, epoch_us(ts) // 1000 + {WINDOW_SECONDS * 1000}, 0, refugees
    FROM refugee_events"""
STEPS["updates"] = """
    SELECT city_id, city_name, at_ms, arrival, event_id,
      CAST(sum(CASE WHEN arrival = 1 THEN refugees ELSE 0 END) OVER past AS BIGINT) AS refugees,
      CAST(sum(CASE WHEN arrival = 1 THEN refugees ELSE -refugees END) OVER past AS BIGINT)
        AS change
    FROM moves
    WINDOW past AS (PARTITION BY city_id ORDER BY at_ms, arrival, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
STEPS["large_cities"] = f"""
    SELECT CAST(geoname_id AS BIGINT) AS city_id, name, population FROM cities
    WHERE population > {LARGE_POPULATION}"""
STEPS["features"] = """
    SELECT CAST(geoname_id AS BIGINT) AS city_id, name, population,
      concat('R', CAST(geoname_id AS BIGINT) % 7) AS region,
      CASE WHEN CAST(geoname_id AS BIGINT) % 3 = 0 THEN 'Polygon' ELSE 'Point' END AS geometry,
      CASE WHEN CAST(geoname_id AS BIGINT) % 3 = 0 THEN 1e0 END AS corner
    FROM cities"""
STEPS["latest"] = """
    SELECT city_id, arg_max(city_name, (at_ms, arrival, event_id)) AS city_name,
      arg_max(refugees, (at_ms, arrival, event_id)) AS refugees,
      arg_max(change, (at_ms, arrival, event_id)) AS change
    FROM updates GROUP BY city_id"""


def _at_rise(step: str, columns: str = "* EXCLUDE (rise)") -> str:
    return f"SELECT {columns} FROM {step} WHERE rise = {RISE}"


def _tag_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT id, lat, lon, '{key}' AS key, {key} AS value FROM tagged WHERE {key} IS NOT NULL"
        for key in ("name", "place", "population", "harbour")
    )


def _neighbours() -> str:
    offsets = ", ".join(
        f"({dq}, {dr})" for dq in (-1, 0, 1) for dr in (-1, 0, 1) if abs(dq + dr) <= 1
    )
    return f"""
        SELECT id, rough + dq * 268435456 + dr AS neighbour
        FROM celled, (VALUES {offsets}) AS ring(dq, dr)"""


def _change(step: str, by: str) -> str:
    return f"""
        SELECT {by}, round(avg(safe_population), 6) AS old_population,
          round(avg(safe_population) + sum(num_evacuees), 6) AS new_population
        FROM {step} WHERE rise = {RISE} GROUP BY {by}"""


PLAN_COLUMNS = "place, flood_id, num_evacuees, destination, destination_id, safe_population"
MOVE_COLUMNS = "city_id, city_name, at_ms, arrival, event_id, refugees, change"

FINAL = {
    "osm_nodes": "SELECT id, lat, lon FROM osm_flat WHERE type = 'node'",
    "tag_rows": _tag_rows(),
    "tags_lookup": "SELECT * FROM tagged",
    "tags_pivot": "SELECT * FROM tagged",
    "complete_places": "SELECT * FROM complete",
    "harbours": "SELECT * FROM harbours",
    "places": "SELECT * FROM places",
    "population_parsed": f"""
        SELECT id, {_population('population')} AS evacuees,
          TRY_CAST(population AS DOUBLE) AS size FROM tagged""",
    "cells_fine": f"SELECT id, {_cell('lat', 'lon', 7)} AS cell FROM tagged",
    "cells_rough": f"SELECT id, {_cell('lat', 'lon', 1)} AS cell FROM tagged",
    "k_ring_cells": _neighbours(),
    "grid_distances": f"""
        SELECT a.id, {_steps('a.cell', 'b.cell')} AS distance,
          CASE WHEN {_steps('a.cell', 'b.cell')} <= 1000 THEN {_steps('a.cell', 'b.cell')} END
            AS bounded_distance
        FROM celled a JOIN celled b ON b.id = a.id + 1""",
    "min_elevation_groupby": "SELECT * FROM lowest",
    "min_elevation_window": "SELECT * FROM lowest",
    "places_elevated": "SELECT * FROM elevated",
    "places_elevated_bucketed": "SELECT * FROM elevated",
    "flooded": "SELECT * FROM flooded",
    "safe_cities": "SELECT * FROM safe",
    "nearest_city_exhaustive": _at_rise(f"({_city('place')})"),
    "nearest_harbour_exhaustive": _at_rise(f"({_harbour('place')})"),
    "nearest_city_ring": _at_rise(f"({_city('place', (1,))})"),
    "nearest_harbour_ring": _at_rise(f"({_harbour('place', (1,))})"),
    "nearest_city_rings": _at_rise(f"({_city('place', (1, 2, 4))})"),
    "refuge_options": _at_rise("options"),
    "nearest_city_planet": "SELECT * FROM planet_cities",
    "relocation_plan_planet": f"SELECT {PLAN_COLUMNS} FROM ({_plan('planet_options')})",
    "cell_centres": """
        SELECT id, cell, round(centre_lat, 9) AS centre_lat, round(centre_lon, 9) AS centre_lon
        FROM planet_centres""",
    "near_harbour": _at_rise("options")
    + " AND coalesce(harbour_distance <= city_distance, false)",
    "near_city": _at_rise("options")
    + " AND NOT coalesce(harbour_distance <= city_distance, false)",
    "relocation_plan": _at_rise("plan", PLAN_COLUMNS),
    "relocation_plan_ring": _at_rise("plan_ring", PLAN_COLUMNS),
    "relocation_plan_by_id": _at_rise("plan_id", PLAN_COLUMNS),
    "relocation_plan_minus_one": _at_rise("plan_minus_one", PLAN_COLUMNS),
    "plan_orc_roundtrip": _at_rise("plan", "place, num_evacuees, destination"),
    "plan_order": f"""
        SELECT place, num_evacuees, destination,
          row_number() OVER (ORDER BY place, destination, flood_id) AS position
        FROM plan WHERE rise = {RISE}""",
    "destinations_orc_roundtrip": _change("plan", "destination"),
    "destination_change": _change("plan", "destination"),
    "destination_change_by_id": _change("plan_id", "destination, destination_id"),
    "total_evacuees": f"SELECT sum(num_evacuees) AS total_evacuees FROM plan WHERE rise = {RISE}",
    "evacuation_totals": """
        SELECT rise, sum(num_evacuees) AS total_evacuees FROM plan GROUP BY rise""",
    "relocation_plans_by_rise": f"SELECT rise, {PLAN_COLUMNS} FROM every_plan",
    "evacuation_curve": """
        SELECT rise, coalesce(sum(num_evacuees), 0) AS total_evacuees
        FROM every_rise LEFT JOIN every_plan USING (rise) GROUP BY rise""",
    "unassigned": f"""
        SELECT f.* FROM flooded f WHERE flood_id NOT IN (
          SELECT flood_id FROM city_pairs WHERE rise = {RISE} AND rough_distance <= 1)""",
    "tracker_batch": f"SELECT {MOVE_COLUMNS} FROM updates",
    "tracker_stream": f"SELECT {MOVE_COLUMNS} FROM updates u "
    "WHERE arrival = 1 OR at_ms < (SELECT max(epoch_us(ts) // 1000) FROM refugee_events) OR "
    "at_ms <= (SELECT max(epoch_us(ts) // 1000) FROM refugee_events e WHERE e.city_id = u.city_id)",
    "tracker_stream_unordered": "SELECT city_id, count(*) AS n_arrivals, "
    "count(DISTINCT event_id) AS n_events, sum(refugees)::BIGINT AS refugees "
    "FROM refugee_events GROUP BY city_id",
    "tracker_stream_ranged": f"SELECT {MOVE_COLUMNS} FROM updates "
    "WHERE at_ms <= (SELECT max(epoch_us(ts) // 1000) FROM refugee_events)",
    "updates_json": """
        SELECT CAST(city_id AS VARCHAR) AS key, city_id, city_name, refugees, change, at_ms,
          arrival, event_id FROM updates""",
    "updates_enriched": """
        SELECT u.refugees AS count, u.change, u.city_id, u.at_ms, u.arrival, u.event_id,
          c.name, c.population
        FROM updates u LEFT JOIN large_cities c ON c.city_id = u.city_id""",
    "updates_enriched_stream": """
        SELECT u.refugees AS count, u.change, u.city AS city_id, u.at_ms, u.arrival, u.event_id,
          c.name, c.population, c.region, c.geometry, c.corner
        FROM (
          SELECT *, CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN city_id + 1000000000
            ELSE city_id END AS city
          FROM updates WHERE event_id % 50 <> 2) u
        LEFT JOIN (SELECT f.* FROM features f JOIN large_cities USING (city_id)) c ON c.city_id = u.city""",
    "messages_split_stream": """
        SELECT event_id, event_id % 100 = 7 AS malformed FROM refugee_events""",
    "malformed_messages": """
        SELECT CAST(city_id AS VARCHAR) AS key, event_id, 20 AS n_chars
        FROM refugee_events WHERE event_id % 100 = 7""",
    "nearest_city_bounded": _at_rise(
        f"({_city('place').replace('FROM city_pairs', f'FROM city_pairs WHERE distance <= {MAX_DISTANCE}')})"
    ),
    "nodes_orc": "SELECT * FROM tagged",
    "elevation_parquet": "SELECT * FROM lowest",
    "city_latest": "SELECT * FROM latest",
    "city_intensity": """
        SELECT city_id, city_name, refugees, change,
          round(refugees / (SELECT max(refugees) FROM latest)::DOUBLE, 6) AS count_scale,
          round(coalesce(change / refugees::DOUBLE, 0), 6) AS change_scale
        FROM latest WHERE refugees > 0""",
    "city_latest_stream": "SELECT * FROM latest",
    "city_records": "SELECT * FROM features",
    "large_cities": "SELECT * FROM large_cities",
    "city_features": """
        SELECT CAST(geoname_id AS BIGINT) AS city_id, name, population FROM cities""",
    "weighted_sample": f"""
        SELECT CAST(geoname_id AS BIGINT) AS city_id, population,
          population // 4 AS evacuating
        FROM (
          SELECT *, (('0x' || substring(md5('{SAMPLE_SEED}:' || geoname_id), 1, 13))::BIGINT
            + 0.5e0) / 4503599627370496e0 AS u
          FROM cities WHERE population > {LARGE_POPULATION})
        ORDER BY -ln(u) / (population * floor(sqrt(population))), geoname_id::BIGINT
        LIMIT {SAMPLE_SIZE}""",
}
FINAL["city_intensity_stream"] = FINAL["city_intensity"]


def oracle_sql() -> dict[str, str]:
    """Each final query behind the steps it reads."""
    texts = {}
    for name, final in FINAL.items():
        needed, text = [], final
        for step in reversed(STEPS):
            if step in text:
                needed.append(step)
                text += STEPS[step]
        steps = ",\n".join(f"{step} AS ({STEPS[step]})" for step in reversed(needed))
        texts[name] = f"WITH {steps}\n{final}" if steps else final
    return texts
