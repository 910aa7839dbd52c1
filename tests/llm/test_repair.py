"""Repairs against a search over all edits, whole reports against a plain loop."""

import heapq
import random
import zlib

import pytest
from plain import sha
from pyspark import cloudpickle

import floodplan
from floodplan.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, conv string, key string"
BLANKS = " \t\n\x0b\f\r"


def cheapest(rows):
    """(cost, audit) of rows (initial, symbol class) by Dijkstra over (place, state, letters)."""
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, letters, place, state = heapq.heappop(heap)
        if place == len(rows) and state in (0, 3):
            return cost, letters
        if (place, state) in done:
            continue
        done.add((place, state))
        legal = {0: "su", 1: "u", 2: "a", 3: "u"}[state]
        to = {"s": 1, "u": 2, "a": 3}
        given = "a" if state == 2 else "u"
        heapq.heappush(heap, (cost + 5, letters + "I", place, to[given]))
        if place < len(rows):
            initial, fault = rows[place]
            extra = 5 if fault == "truncated" else 0
            heapq.heappush(heap, (cost + 2, letters + "D", place + 1, state))
            if fault not in ("blank", "duplicate"):
                heapq.heappush(heap, (cost + 1 + extra, letters + "R", place + 1, to[given]))
                if initial and initial in legal:
                    heapq.heappush(heap, (cost + extra, letters + "K", place + 1, to[initial]))
    raise AssertionError


def plain(turns):
    """What repair_report returns, as a dict by conv_id."""
    import hashlib

    convs = {}
    for conv, turn, role, text, *_ in turns:
        rows = convs.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if how == 0:
            continue
        text = "" if how == 1 else text.translate(str.maketrans("", "", ".!?")) if how == 2 else text
        rows += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    found = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.rstrip(BLANKS)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None
            faults.append(fault or ("truncated" if body[-1] not in ".!?" else "sound"))
            seen.add((role, text))
        initials = [r[1][:1] for r in rows]
        cost, audit = cheapest(list(zip(initials, faults)))
        lines, state, place = [], 0, 0
        for letter in audit:
            given = "assistant" if state == 2 else "user"
            if letter != "I":
                _, role, text = rows[place]
                place += 1
            if letter == "D":
                continue
            role = role if letter == "K" else given
            lines.append(f"{role}:{'' if letter == 'I' else text}")
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found[conv] = (gaps, *count, illegal, cost, audit, sha("\n".join(lines)))
    return found


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()


def reported(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = repair.repair_report(table).collect()
    assert len(found) == len({r.conv_id for r in found})
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found}


def test_node_costs_match_a_search():
    random.seed(2)
    classes = {"d": ("x", "blank")} | {s: (s, "sound") for s in "suax"} | {s.upper(): (s, "truncated") for s in "suax"}
    for _ in range(3000):
        signature = "".join(random.choices("suaxdSUAXuaua", k=random.randrange(0, 9)))
        costs, cells = repair.Suffixes().of(signature[::-1])
        letters, left = repair.audit(cells[0])
        assert (costs[0], letters) == cheapest([classes[s] for s in signature]), signature
        assert left == -1


def test_suffixes_are_shared(monkeypatch):
    made = []
    whole = repair.node_before
    monkeypatch.setattr(repair, "node_before", lambda s, n: made.append(s) or whole(s, n))
    found = repair.Suffixes()
    for backwards in sorted(["uaua", "uauaua", "uauaus", "uaX", "aaua"]):
        found.of(backwards)
    assert len(made) == len({w[:k] for w in ["uaua", "uauaua", "uauaus", "uaX", "aaua"] for k in range(1, len(w) + 1)})


def some_rows():
    random.seed(11)
    texts = ["Yes.", "Well, no!", "cut of", "", " \n", "What? ", "Good.", None, "x\t", "Long one. " * 300]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usr", "Assistant"]
    rows = []
    for conv in [*range(60), None]:
        for turn in random.choices([None, *range(-2, 14)], k=random.randrange(1, 15)):
            rows.append((conv, turn, random.choice(roles), random.choice(texts), "clash", "k"))
    return rows + rows[:20] + [(900, k, "user", "Same.", "", "") for k in range(40)] + [(901, 7, "user", "A.", "", "")] * 30


def test_report(spark):
    rows = some_rows()
    assert reported(spark, rows) == plain(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_segments_change_nothing(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "SEGMENT", size)
    rows = some_rows()
    assert reported(spark, rows) == plain(rows)


@pytest.mark.parametrize("size", [1, 3, 7])
def test_costs_of_several_segments(spark, monkeypatch, size):
    """Workers cut by ``SEGMENT`` too: there the code comes along, as on executors without the package."""
    registered = floodplan.__name__ in cloudpickle.list_registry_pickle_by_value()
    cloudpickle.register_pickle_by_value(floodplan)
    try:
        monkeypatch.setattr(repair, "SEGMENT", size)
        rows = some_rows()
        assert reported(spark, rows) == plain(rows)
    finally:
        if not registered:
            cloudpickle.unregister_pickle_by_value(floodplan)


def test_a_conversation_longer_than_a_segment(spark):
    """Its cost is that of all its rows; every row must go or is repeated, so it is known."""
    conv = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 > 4)
    rows = [(conv, 0, "user", "A.", "", "")] * (2 * repair.SEGMENT + 5)
    found = reported(spark, rows)[conv]
    assert found[:6] == (0, 0, len(rows) - 1, 0, len(rows) - 1, 2 * len(rows))
    assert found[6] == "D" * len(rows)


def test_large_turns_beside_null(spark):
    random.seed(8)
    rows = [(c, (1 << 53) + k if k % 3 else None, "user", f"{k}.", "", "") for c in range(6) for k in range(30)]
    rows += [(50, turn, "user", "A.", "", "") for turn in (-(1 << 62), (1 << 62) - 1)]
    assert reported(spark, rows) == plain(rows)


def test_one_conversation_in_several_ranges(spark):
    random.seed(4)
    rows = [
        (1, k, random.choice(["user", "assistant"]), random.choice(["a.", "b", f"{k}!"]), "", "") for k in range(3000)
    ]
    assert reported(spark, rows) == plain(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    empty = (0, 0, 0, 0, 0, 0, "", sha(""))
    assert reported(spark, [(gone, 0, "user", "A.", "", "")]) == {gone: empty}
    assert reported(spark, []) == {}


def test_repaired_rows(spark):
    rows = some_rows()
    edits = repair.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    audits = {}
    for e in edits:
        audits.setdefault(e.conv_id, []).append(e)
    want = plain(rows)
    for conv, found in audits.items():
        assert "".join(e.letter for e in found) == want[conv][6]
        assert sha("\n".join(f"{e.role}:{e.text}" for e in found if e.letter != "D")) == want[conv][7]
