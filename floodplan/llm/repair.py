"""Conversation structure repair by an automaton that shares suffixes.

A conversation's rows become a signature, one symbol a row: the role's initial and whether
the row is sound, truncated or must go. What the cheapest edits cost from a row on depends
only on the rest of the signature and on where the conversation stands in the grammar
``(s?(ua)+)?``. So a node stands for a suffix; distinct signatures are sorted by their
reverse, which brings equal suffixes together, and each node's costs and best audits are
computed once for all conversations that end so. Audits share their ends as linked cells.

A very long conversation is cut into segments. Each gives a matrix of costs between grammar
states, these combine from the end, and then every segment is repaired on its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.session import settle

#: Rows in a segment, at most.
SEGMENT = 32_768
#: What separates words; a row of nothing else is blank.
BLANKS = " \t\n\x0b\f\r"
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Grammar states: nothing yet, after system, after user, after assistant.
STATES = range(4)
#: The state after a kept initial, and after the role that may be inserted or given.
KEPT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
GIVEN = (2, 2, 3, 2)
NAMES = {2: "user", 3: "assistant"}
INITIAL = {1: "s", 2: "u", 3: "a"}
#: Symbols: an initial, in capitals if the row is truncated, or a row that must go.
GONE = "d"
OTHER = "x"
NEVER = 1 << 60
#: A segment of a whole conversation ends where nothing may follow.
END = ""

Node = tuple[tuple[int, ...], tuple]


def _insertions(costs: list[int], cells: list, tied: list[str]) -> Node:
    """A node's costs once rows may be inserted before what it begins with.

    ``tied`` has the letter each state's best edit begins with; equal costs go to the
    least letter, and no two edits of a state begin with the same.
    """
    for _ in range(3):
        for q in STATES:
            value = INSERT + costs[GIVEN[q]]
            if value < costs[q] or (value == costs[q] and "I" <= tied[q] and value < NEVER):
                costs[q], cells[q], tied[q] = value, ("I", cells[GIVEN[q]]), "I"
    return tuple(costs), tuple(cells)


def last_node(end: str = END) -> Node:
    """The node of the empty suffix. ``end`` has the costs of the segment after, if any."""
    if end == END:
        return _insertions([0, NEVER, NEVER, 0], [None] * 4, [""] * 4)
    return tuple(map(int, end.split(","))), tuple((q, None) for q in STATES)


def node_before(symbol: str, after: Node) -> Node:
    """The node of a suffix with one more row in front."""
    costs, cells = after
    extra = TRUNCATED if symbol.isupper() else 0
    initial = symbol.lower()
    best, chosen, tied = [], [], []
    for q in STATES:
        options = [(DELETE + costs[q], "D", cells[q])]
        if symbol != GONE:
            kept = KEPT.get((q, initial))
            if kept:
                options.append((KEEP + extra + costs[kept], "K", cells[kept]))
            options.append((REROLE + extra + costs[GIVEN[q]], "R", cells[GIVEN[q]]))
        cost, letter, rest = min(options, key=lambda o: o[:2])
        best.append(min(cost, NEVER))
        chosen.append((letter, rest))
        tied.append(letter)
    # An inserted row leads to a state of this node, whose own cell it goes on with.
    return _insertions(best, chosen, tied)


class Suffixes:
    """The nodes on the way of one signature, from its end; a shared end is kept."""

    def __init__(self, end: str = END):
        self.signature, self.nodes = "", [last_node(end)]

    def of(self, backwards: str) -> Node:
        """The node of a signature, given from its end."""
        shared = 0
        for a, b in zip(self.signature, backwards):
            if a != b:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in backwards[shared:]:
            self.nodes.append(node_before(symbol, self.nodes[-1]))
        self.signature = backwards
        return self.nodes[-1]


def audit(cell) -> tuple[str, int]:
    """The letters of a chain of cells, and the state in which it leaves, -1 at the end."""
    letters = []
    while cell is not None:
        if isinstance(cell[0], int):
            return "".join(letters), cell[0]
        letters.append(cell[0])
        cell = cell[1]
    return "".join(letters), -1


def _conv(conv_id: Column) -> Column:
    """A key that is never null and differs for every id."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def damaged(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copy): ``turns`` with rows dropped, emptied, repeated and so on.

    What happens to a row goes by a hash of its conv_id and turn; nulls count as one space.
    """
    space = F.lit(" ")
    name = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    how = F.crc32(F.concat_ws(":", *name).cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(how == 1, "").when(how == 2, F.translate(text, ".!?", "")).otherwise(text)
    one, two = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return turns.filter(how != 0).select(
        _conv(F.col("conv_id")).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(how == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        text.alias("text"),
        F.explode(F.when(how == 3, two).otherwise(one)).alias("copy"),
    )


ORDER = ("turn", "role", "key")


def _slim(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, key, n, blank, truncated, first): equal rows once, without texts."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    last = F.substring(stripped, -1, 1)
    equal = (
        rows.select(
            "conv",
            "turn",
            "role",
            F.unhex(F.md5("text")).alias("key"),
            (stripped == "").alias("blank"),
            (~last.isin(".", "!", "?")).alias("truncated"),
        )
        .groupBy("conv", *ORDER, "blank", "truncated")
        .agg(F.count("*").alias("n"))
    )
    # Nulls are the first turn; a minimum would leave them out.
    seen = equal.groupBy("conv", "role", "key").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("seen")
    )
    return equal.join(seen, ["conv", "role", "key"]).select(
        *equal.columns, F.col("turn").eqNullSafe(F.col("seen.turn")).alias("first")
    )


SEGMENTS = (
    "conv string, part int, no int, turn long, role string, key binary, n long, signature string, blank long, "
    "duplicate long, truncated long, illegal long, opens string, closes string, first_turn long, last_turn long, "
    "turns long"
)


def _segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted slim rows to segments: at most ``SEGMENT`` rows of one conversation each."""
    names = [field.split()[0] for field in SEGMENTS.split(", ")]
    now: dict | None = None
    number = 0

    def closed(segment: dict) -> dict:
        return segment | {"signature": "".join(segment["signature"])}

    for batch in batches:
        done = []
        for conv, turn, known, role, key, blank, truncated, n, first, part in batch[
            ["conv", "turn", "known", "role", "key", "blank", "truncated", "n", "first", "part"]
        ].itertuples(index=False):
            turn = int(turn) if known else None
            initial = role[:1]
            while n:
                if now is None or now["conv"] != conv or now["n"] >= SEGMENT:
                    if now is not None:
                        done.append(closed(now))
                    number += 1
                    now = dict.fromkeys(names, 0) | {"conv": conv, "part": part, "no": number, "signature": []}
                    now |= {"turn": turn, "role": role, "key": key, "opens": initial, "closes": None}
                    now |= {"first_turn": None, "last_turn": None}
                some = min(n, SEGMENT - now["n"])
                fresh = 0 if blank or not first else 1
                symbol = initial if initial in ("s", "u", "a") else OTHER
                now["signature"].append((symbol.upper() if truncated else symbol) * fresh + GONE * (some - fresh))
                now["blank"] += some if blank else 0
                now["duplicate"] += 0 if blank else some - fresh
                now["truncated"] += fresh if truncated else 0
                now["illegal"] += (some - 1) + (now["closes"] is not None and now["closes"] + initial not in LEGAL)
                now["closes"] = initial
                if turn is not None and turn != now["last_turn"]:
                    now["turns"] += 1
                    now["last_turn"] = turn
                    now["first_turn"] = turn if now["first_turn"] is None else now["first_turn"]
                now["n"] += some
                n, first = n - some, False
        yield pd.DataFrame(done, columns=names).astype({"turn": "Int64", "first_turn": "Int64", "last_turn": "Int64"})
    if now is not None:
        yield pd.DataFrame([closed(now)], columns=names).astype(
            {"turn": "Int64", "first_turn": "Int64", "last_turn": "Int64"}
        )


def segments(rows: DataFrame) -> DataFrame:
    """The damaged rows' segments, settled; a conversation may lie in several ranges."""
    order = ("conv", *ORDER)
    ranges = _slim(rows).repartitionByRange(*order).sortWithinPartitions(*order)
    # Beside nulls pandas would make doubles of turns.
    told = ranges.withColumns(
        {"part": F.spark_partition_id(), "known": F.col("turn").isNotNull(), "turn": F.coalesce("turn", F.lit(0))}
    )
    return settle(told.mapInPandas(_segments, SEGMENTS))


SOLVED = "ending string, signature string, costs array<long>, audits array<string>, leaves array<int>"


def _solver(states: tuple[int, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ending, suffixes = None, None
        for batch in batches:
            found = []
            for end, backwards in zip(batch["ending"], batch["backwards"]):
                if suffixes is None or end != ending:
                    ending, suffixes = end, Suffixes(end)
                costs, cells = suffixes.of(backwards)
                ways = [audit(cells[q]) for q in states]
                found.append(
                    (end, backwards[::-1], [costs[q] for q in states], [a for a, _ in ways], [q for _, q in ways])
                )
            yield pd.DataFrame(found, columns=["ending", "signature", "costs", "audits", "leaves"])

    return run


def solved(asked: DataFrame, states: tuple[int, ...]) -> DataFrame:
    """The cheapest edits of distinct (ending, signature), from each of the states.

    Signatures are dealt in ranges of their reverse, so those in a task share their ends.
    """
    backwards = asked.distinct().select("ending", F.reverse("signature").alias("backwards"))
    order = ("ending", "backwards")
    return backwards.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_solver(states), SOLVED)


def _unit(q: int) -> str:
    return ",".join("0" if q == other else str(NEVER) for other in STATES)


def _endings(group: pd.DataFrame) -> pd.DataFrame:
    """What each segment of a conversation is followed by: the matrices combined from the end.

    ``after`` is what the ending leaves out of the costs of all that follows.
    """
    group = group.sort_values(["part", "no"], ascending=False)
    costs, found, after = list(last_node()[0]), [], []
    for place, row in enumerate(group.itertuples()):
        least = min(costs)
        # The last segment ends as a whole conversation does; equal endings are solved once,
        # so they have differences of costs only.
        found.append(END if place == 0 else ",".join(str(c - least) for c in costs))
        after.append(least + (after[-1] if after else 0))
        through = list(last_node()[0]) if place == 0 else [c - least for c in costs]
        matrix = [row.matrix[4 * q : 4 * q + 4] for q in STATES]
        costs = [min(min(int(matrix[q][p]) + through[p] for p in STATES), NEVER) for q in STATES]
    place = {c: group[c] for c in ("conv", "part", "no")}
    return pd.DataFrame(place | {"ending": found, "after": after})


def _entries(group: pd.DataFrame) -> pd.DataFrame:
    """The grammar state in which each segment of a conversation is entered."""
    group = group.sort_values(["part", "no"])
    state, found = 0, []
    for leaves in group["leaves"]:
        found.append(state)
        state = max(0, int(leaves[state]))
    return pd.DataFrame({"conv": group["conv"], "part": group["part"], "no": group["no"], "state": found})


def audits(found: DataFrame) -> DataFrame:
    """(conv, part, no, turn, role, key, audit, cost) of settled segments.

    ``cost`` is that from the segment on, so a conversation's is that of its first.
    """
    place = ["conv", "part", "no"]
    count = found.groupBy("conv").agg(F.count("*").alias("parts"))
    several = count.filter("parts > 1").select("conv")
    columns = [*place, *ORDER, "audit", "cost"]
    whole = found.join(several, "conv", "left_anti").withColumn("ending", F.lit(END))
    ways = solved(whole.select("ending", "signature"), (0,))
    plain = whole.join(ways, ["ending", "signature"]).select(
        *place, *ORDER, F.col("audits")[0].alias("audit"), F.col("costs")[0].alias("cost")
    )
    if several.isEmpty():
        return plain.select(*columns)
    cut = settle(found.join(several, "conv", "left_semi").select(*place, *ORDER, "signature"))
    units = F.explode(F.array(*[F.lit(_unit(q)) for q in STATES])).alias("ending")
    through = solved(cut.select(units, "signature"), tuple(STATES))
    row = F.array_sort(F.collect_list(F.struct("ending", "costs")))
    number = {_unit(q): q for q in STATES}
    place_of = F.create_map(*[F.lit(x) for pair in sorted(number.items()) for x in pair])
    listed = through.withColumn("ending", place_of[F.col("ending")]).groupBy("signature").agg(row.alias("m"))
    # From state (row) to state (column).
    matrix = F.flatten(F.transform(F.array(*map(F.lit, STATES)), lambda q: F.transform("m", lambda e: e["costs"][q])))
    endings = (
        cut.join(listed.select("signature", matrix.alias("matrix")), "signature")
        .select(*place, "matrix")
        .groupBy("conv")
        .applyInPandas(_endings, "conv string, part int, no int, ending string, after long")
    )
    ended = settle(cut.join(endings, place))
    ways = settle(solved(ended.select("ending", "signature"), tuple(STATES)))
    joined = ended.join(ways, ["ending", "signature"])
    states = joined.select(*place, "leaves").groupBy("conv").applyInPandas(
        _entries, "conv string, part int, no int, state int"
    )
    cost = F.col("costs")[F.col("state")] + F.col("after")
    long = joined.join(states, place).select(
        *place, *ORDER, F.col("audits")[F.col("state")].alias("audit"), cost.alias("cost")
    )
    return plain.select(*columns).union(long.select(*columns))


EDITED = "conv string, letter string, role string, text string"


def _edited(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(conv, letter, role, text) of every edit in order, from rows and audits sorted together."""
    conv, state, letters = None, 0, iter("")

    def inserted() -> Iterator[tuple]:
        """Insertions up to the next row's letter, which is returned."""
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            state = GIVEN[state]
            yield conv, "I", NAMES[state], ""
        return None

    for batch in batches:
        for row in batch[["conv", "role", "text", "audit"]].itertuples(index=False):
            if row.audit is not None:
                if row.conv != conv:
                    yield from inserted()
                    conv, state = row.conv, 0
                letters = chain(letters, row.audit)
                continue
            letter = yield from inserted()
            if letter == "D":
                yield conv, "D", None, None
                continue
            state = KEPT[state, row.role[:1]] if letter == "K" else GIVEN[state]
            yield conv, letter, row.role if letter == "K" else NAMES[state], row.text
    yield from inserted()


def _listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows: list[tuple] = []
    for edit in _edited(batches):
        rows.append(edit)
        if len(rows) == 1000:
            yield pd.DataFrame(rows, columns=["conv", "letter", "role", "text"])
            rows = []
    yield pd.DataFrame(rows, columns=["conv", "letter", "role", "text"])


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A conversation's digest grows with its rows; no conversation is ever held."""
    conv, state, lines, done = None, sha256(), 0, []
    for name, letter, role, text in _edited(batches):
        if name != conv:
            if conv is not None:
                done.append((conv, state.hexdigest()))
            conv, state, lines = name, sha256(), 0
            if len(done) >= 1000:
                yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])
                done = []
        if letter != "D":
            state.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            lines += 1
    if conv is not None:
        done.append((conv, state.hexdigest()))
    yield pd.DataFrame(done, columns=["conv", "repaired_sha256"])


def _together(rows: DataFrame, ways: DataFrame) -> DataFrame:
    """Texts and audits of each conversation in one stream, every audit before its rows.

    Only what is moved here holds texts. A digest runs over a conversation from its first
    row to its last, so one task reads it; it keeps no more than a segment's letters.
    """
    texts = rows.select(
        "conv", "turn", "role", F.unhex(F.md5("text")).alias("key"), F.lit(1 << 30).alias("part"),
        F.lit(0).alias("no"), "text", F.lit(None).cast("string").alias("audit"),
    )
    marks = ways.select(
        "conv", "turn", "role", "key", "part", "no", F.lit(None).cast("string").alias("text"), "audit"
    )
    order = ("conv", *ORDER, "part", "no")
    return texts.union(marks).repartition("conv").sortWithinPartitions(*order).select("conv", "role", "text", "audit")


def repaired(turns: DataFrame) -> DataFrame:
    """(conv_id, letter, role, text): every edit of the damaged ``turns``, in order within a conv_id.

    K keeps a row, R gives it another role, I inserts one, D deletes one (no role or text).
    """
    rows = damaged(turns)
    edits = _together(rows, audits(segments(rows))).mapInPandas(_listed, EDITED)
    return edits.select(_id(turns), "letter", "role", "text")


def _id(turns: DataFrame) -> Column:
    named = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30))
    return named.cast(turns.schema["conv_id"].dataType).alias("conv_id")


def repair_report(turns: DataFrame) -> DataFrame:
    """What was wrong with every conversation after damage, and its cheapest repair.

    Columns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256, one row for each conv_id of ``turns`` (conv_id, turn, role, text),
    among them null. Rows go by turn, nulls first; those of one turn by role, then by a
    hash of the text. A null role or text is one space. Repeated rows are duplicates of the
    first, wherever they stand. Equal costs go to the least audit. Texts of any length are
    read whole. An empty table gives no rows. Other columns don't matter.
    """
    rows = damaged(turns)
    found = segments(rows)
    ways = settle(audits(found))
    following = Window.partitionBy("conv").orderBy("part", "no")
    closes, last_turn = (F.lag(c).over(following) for c in ("closes", "last_turn"))
    joint = F.concat(closes, F.col("opens"))
    counted = (
        found.select(
            "*",
            F.when(joint.isNotNull() & ~joint.isin(*LEGAL), 1).otherwise(0).alias("torn"),
            F.when(F.col("first_turn") == last_turn, 1).otherwise(0).alias("shared"),
        )
        .groupBy("conv")
        .agg(
            # In this order nothing on the way is larger than the result.
            (F.max("last_turn") - F.min("first_turn") - (F.sum("turns") - F.sum("shared") - 1)).alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
            (F.sum("illegal") + F.sum("torn")).alias("illegal"),
        )
    )
    place = F.struct("part", "no")
    edits = ways.groupBy("conv").agg(
        F.min_by("cost", place).alias("cost"),
        F.array_join(F.array_sort(F.collect_list(F.struct("part", "no", "audit")))["audit"], "").alias("audit"),
    )
    digests = _together(rows, ways).mapInPandas(_digests, "conv string, repaired_sha256 string")
    every = turns.select(_conv(F.col("conv_id")).alias("conv")).distinct()
    joined = every.join(counted, "conv", "left").join(edits, "conv", "left").join(digests, "conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        _id(turns),
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
