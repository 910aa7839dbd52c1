"""Near-duplicates by SimHash fingerprints, compared exactly in tiles.

Distinct fingerprints are laid out in tiles by the population counts of their parts. Two
fingerprints within the radius have counts that differ by no more than the radius in sum,
so only tile pairs that near are compared, each by exclusive-or and bit counts in numpy.
No link between fingerprints is missed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from floodplan.llm.components import components, forest
from floodplan.llm.text import with_row
from floodplan.session import settle

SEED = 42
#: Bytes of a text that are cut into words at once.
PIECE = 1 << 20
#: Rows of a tile that are compared at once with the other tile.
ROWS = 256


@dataclass(frozen=True)
class Scheme:
    """How texts are fingerprinted and when fingerprints are near."""

    #: Words in a shingle.
    shingle: int = 3
    #: Fingerprints have 64 bits times this.
    width: int = 1
    #: Near fingerprints differ in so many bits at most.
    radius: int = 3
    #: Fingerprints in a tile, about.
    tile: int = 1024
    #: Parts of a fingerprint whose population counts place it in a tile.
    parts: int = 4
    #: Population counts are taken in bands of so many.
    band: int = 1
    #: If given, texts whose numbers of distinct shingles exclude this similarity are not
    #: compared: of sets with that similarity, the smaller has at least that share of the larger.
    similarity: float | None = None

    @property
    def base(self) -> int:
        return 64 * self.width // self.parts // self.band + 1

    def step(self, shingles: int) -> int:
        """Similar texts have equal or neighbouring steps; one without shingles has step 0."""
        if self.similarity is None or not shingles:
            return 0
        # A little wider than asked, so that rounding parts nothing.
        return 1 + math.floor(math.log(shingles) / (1e-4 - math.log(self.similarity)))


#: 64 bits of 3-word shingles, 3 bits apart.
NARROW = Scheme()
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in blocks, so that a huge text needs little memory."""
    start = 0
    while start < len(text):
        cut = _SPACE.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end].split()
        start = end


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th word of each hash: the hash itself, then independent functions of it."""
    if not k:
        return hashes
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(text: str | None, n: int) -> Iterator[list[bytes]]:
    """The shingles of a text in blocks, repeats included."""
    total, tail = 0, []
    for block in word_blocks((text or "").encode("utf-8", "surrogatepass").lower()):
        words = tail + block
        runs = list(map(b" ".join, zip(*(words[i:] for i in range(n)))))
        if runs:
            total += len(runs)
            yield runs
        tail = words[-(n - 1) :]
    if not total and tail:
        yield [b" ".join(tail)]


def _hashes(runs: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(r, SEED) for r in runs], np.uint64)


def profile(text: str | None, scheme: Scheme = NARROW) -> tuple[np.ndarray, int]:
    """SimHash of the text's shingles, repeats included, as words of 64 bits, and its step.

    A text of fewer words has one shingle, the whole; one without words gives zero. The
    first word takes a shingle's hash, further words take it mixed.
    """
    ones, total = np.zeros((scheme.width, 64), np.int64), 0
    distinct = np.zeros(0, np.uint64)
    for runs in _runs(text, scheme.shingle):
        hashes = _hashes(runs)
        for k in range(scheme.width):
            octets = _mixed(hashes, k).view(np.uint8).reshape(-1, 8)
            ones[k] += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        if scheme.similarity is not None:
            distinct = np.union1d(distinct, hashes)
        total += len(runs)
    words = np.packbits(2 * ones > total, axis=1, bitorder="little").view(np.int64)[:, 0]
    return words, scheme.step(len(distinct))


def profiles(scheme: Scheme):
    """A column function: (print, step) of a text."""

    @pandas_udf("print array<bigint>, step int")
    def of(text: pd.Series) -> pd.DataFrame:
        found = [profile(t, scheme) for t in text]
        return pd.DataFrame(
            {"print": pd.Series([p for p, _ in found], dtype=object), "step": [s for _, s in found]}
        )

    return of


def _counts(scheme: Scheme) -> list:
    """The band of the population count of each part of a fingerprint."""
    if scheme.parts == 1:
        words = [F.bit_count(F.col("print")[k]) for k in range(scheme.width)]
        return [F.floor(reduce(lambda x, y: x + y, words) / scheme.band).cast("int")]
    bits = 64 * scheme.width // scheme.parts
    low = F.lit((1 << bits) - 1)
    return [
        F.floor(
            F.bit_count(
                F.shiftrightunsigned(F.col("print")[i * bits // 64], i * bits % 64).bitwiseAND(low)
            )
            / scheme.band
        ).cast("int")
        for i in range(scheme.parts)
    ]


def _key(counts: list, scheme: Scheme) -> F.Column:
    return reduce(lambda key, c: key * scheme.base + c, counts, F.lit(0))


def tiles(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, part, ids, prints): fingerprints by step and counts, about ``tile`` in each.

    A column ``label``, if any, is gathered as ``labels``.
    """
    place = _key([F.col("step"), *_counts(scheme)], scheme)
    more = [c for c in prints.columns if c == "label"]
    keyed = prints.select("id", "print", *more, place.alias("key"))
    parts = keyed.groupBy("key").agg(F.ceil(F.count("*") / scheme.tile).alias("parts"))
    spread = keyed.join(parts, "key").withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    )
    rows = F.collect_list(F.struct("id", "print", *more)).alias("rows")
    return (
        spread.groupBy("key", "part")
        .agg(rows)
        .select(
            "key",
            "part",
            F.col("rows.id").alias("ids"),
            F.flatten("rows.print").alias("prints"),
            *[F.col(f"rows.{c}").alias(f"{c}s") for c in more],
        )
    )


def _near_keys(keys: DataFrame, scheme: Scheme) -> DataFrame:
    """(key, other): keys that may hold near fingerprints, each pair once.

    Their steps are neighbours and their counts differ by at most the radius in sum. Keys
    are at most 17^4 for four quarters, or 17 for each step of 256 bits, whatever the data.
    """
    r, parts, base = scheme.radius, scheme.parts, scheme.base
    gap = lambda d: max(0, (abs(d) - 1) * scheme.band + 1) if d else 0
    reach = range(-(r // scheme.band) - 1, r // scheme.band + 2)
    steps = (0,) if scheme.similarity is None else (0, 1)
    shifts = [
        d
        for d in product(steps, *[reach] * parts)
        if sum(map(gap, d[1:])) <= r and d >= (0,) * (parts + 1)
    ]
    shift = F.explode(F.array(*[F.array(*map(F.lit, d)) for d in shifts])).alias("shift")
    step = F.floor(F.col("key") / base**parts).cast("int") + F.col("shift")[0]
    counts = [
        F.pmod(F.floor(F.col("key") / base ** (parts - 1 - i)), F.lit(base)).cast("int")
        + F.col("shift")[i + 1]
        for i in range(parts)
    ]
    inside = reduce(lambda x, y: x & y, [c.between(0, base - 1) for c in counts])
    other = _key([step, *counts], scheme).alias("other")
    return keys.select("key", shift).filter(inside).select("key", other)


def near_blocks(
    a: np.ndarray, b: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs of rows of ``a`` and ``b`` that differ in ``radius`` bits or fewer.

    Bits differing in sum by no more leave some word with no more than its share. Pairs come
    by rows of ``a``, so that those of a large group are never held together.
    """
    share = radius // a.shape[1]
    for start in range(0, len(a), ROWS):
        rows = a[start : start + ROWS]
        hits = []
        for k in range(a.shape[1]):
            apart = np.bitwise_count(rows[:, k, None] ^ b[None, :, k])
            hits.append(np.flatnonzero(apart <= share))
        i, j = np.divmod(np.unique(np.concatenate(hits)), len(b))
        near = np.bitwise_count(rows[i] ^ b[j]).sum(axis=1, dtype=np.int64) <= radius
        yield i[near] + start, j[near]


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``near_blocks``."""
    return tuple(np.concatenate(x) for x in zip(*near_blocks(a, b, radius)))


def _compare(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(name) for name in batch.schema.names}
            found: list[tuple] = [(np.zeros(0, np.int64),) * 2]
            for k in range(len(batch)):
                a, b = (
                    at[c][k].values.to_numpy().view(np.uint64).reshape(-1, scheme.width)
                    for c in ("prints", "others")
                )
                i, j = near_pairs(a, b, scheme.radius)
                if len(i):
                    found.append(
                        forest(at["ids"][k].values.to_numpy(), at["other_ids"][k].values.to_numpy(), i, j)
                    )
            ends = [pa.array(np.concatenate(e), pa.int64()) for e in zip(*found)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return run


def links(prints: DataFrame, scheme: Scheme = NARROW) -> DataFrame:
    """Links (a, b) between ids that connect all fingerprints within the radius.

    A tile pair gives a spanning forest of its links, at most one link for each of its
    fingerprints, so a large group doesn't emit all its pairs.
    """
    packs = settle(tiles(prints, scheme))
    near = _near_keys(packs.select("key").distinct(), scheme)
    others = packs.toDF("other", "other_part", "other_ids", "others")
    pairs = (
        packs.join(near, "key")
        .join(others, "other")
        .filter("key <> other OR part <= other_part")
        .select("ids", "prints", "other_ids", "others")
    )
    return pairs.mapInArrow(_compare(scheme), "a long, b long")


def _labelled(prints: DataFrame, scheme: Scheme) -> DataFrame:
    """(print, step, root, component_id) for a settled table (doc_id, print, step)."""
    first = settle(
        prints.groupBy("print", "step")
        .agg(F.min("doc_id").alias("first_id"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    near = links(first, scheme)
    if scheme.similarity is not None:
        # Equal fingerprints are linked whatever their steps, of which there are few.
        equal = first.select("id", F.min("id").over(Window.partitionBy("print")).alias("b"))
        near = near.union(equal.filter("id <> b"))
    root = components(near)
    joined = first.join(root, F.col("id") == F.col("node"), "left").select(
        "print", "step", "first_id", F.coalesce("component", "id").alias("root")
    )
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return joined.join(smallest, "root").select("print", "step", "root", "component_id")


def simhash_components(docs: DataFrame, scheme: Scheme = NARROW) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row for each row of ``docs``.

    Null and empty texts have the fingerprint zero and so form one group. Repeated rows are
    linked like any copies. A null doc_id takes part and never names a component, unless
    the component has no other. An empty table gives no rows.
    """
    prints = settle(
        docs.select("doc_id", profiles(scheme)("text").alias("p")).select("doc_id", "p.print", "p.step")
    )
    digits = [F.lpad(F.lower(F.hex(F.col("print")[k])), 16, "0") for k in range(scheme.width)]
    return prints.join(_labelled(prints, scheme), ["print", "step"]).select(
        "doc_id", F.concat(*digits).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, scheme: Scheme = NARROW) -> DataFrame:
    """One row of each group: that with the smallest doc_id. All columns are kept.

    Null and empty texts count as copies of each other, as above.
    """
    rows = settle(
        with_row(
            docs,
            rid=F.monotonically_increasing_id(),
            doc_id=F.col("doc_id"),
            p=profiles(scheme)("text"),
        )
    )
    prints = rows.select("rid", "doc_id", "p.print", "p.step")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    kept = (
        prints.join(_labelled(prints, scheme), ["print", "step"])
        .groupBy("root")
        .agg(F.min_by("rid", order).alias("rid"))
    )
    return rows.join(kept.select("rid"), "rid", "left_semi").select("row.*")
