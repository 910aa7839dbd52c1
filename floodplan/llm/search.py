"""Ranked lexical search: documents grouped by the mask of an item's terms that they hold.

Documents become blocks: which of the asked terms each holds, how often, and its length.
For an item, the bits of its terms in a block give every document a mask; documents of one
mask share a bound, the sum of their terms' largest contributions in the block. Masks are
evaluated from the highest bound down, until ten documents score above what is left. The
bounds are safe, so the ranking is exact.

Items are the stated query set and come in packs of limited size; documents come in blocks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from floodplan.session import settle

TOP = 10
#: Documents in a block, and postings after which a block ends early.
BLOCK, POSTINGS = 2048, 1 << 20
#: Bytes of the texts of one pack of items; a longer item is a pack of its own.
PACK_BYTES = 8 << 20
#: Bytes of a text that are cut into terms at once.
PIECE = 1 << 20
#: Masks that are evaluated at once.
STEP = 16
NO_ID = np.iinfo(np.int64).max
#: Term characters in lower case, all others as spaces.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def term_blocks(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in blocks, so that a huge text needs little memory."""
    folded = (text or "").encode("utf-8", "surrogatepass").translate(FOLDED)
    start = 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


class _Block:
    """Documents, and the terms asked for that they hold."""

    def __init__(self):
        self.docs, self.lengths, self.places, self.terms, self.times = [], [], [], [], []
        self.n_docs = self.n_terms = 0

    def add(self, doc_id: int | None, text: str | None, known: dict[bytes, int]) -> None:
        found, n = Counter(), 0
        for terms in term_blocks(text):
            n += len(terms)
            found.update(map(known.get, terms))
        found.pop(None, None)
        self.n_docs += n > 0
        self.n_terms += n
        if found:
            self.places.extend([len(self.docs)] * len(found))
            self.terms.extend(found.keys())
            self.times.extend(found.values())
            self.docs.append(doc_id)
            self.lengths.append(n)

    def batch(self) -> pa.RecordBatch:
        """One row: postings by term, then by place of the document."""
        terms, places = np.array(self.terms, np.int32), np.array(self.places, np.int32)
        order = np.lexsort((places, terms))
        distinct, counts = np.unique(terms, return_counts=True)
        columns = {
            "n_docs": pa.array([self.n_docs], pa.int64()),
            "n_terms": pa.array([self.n_terms], pa.int64()),
            "docs": pa.array([self.docs], pa.list_(pa.int64())),
            "lengths": pa.array([self.lengths], pa.list_(pa.int64())),
            "terms": pa.array([distinct], pa.list_(pa.int32())),
            "counts": pa.array([counts], pa.list_(pa.int64())),
            "places": pa.array([places[order]], pa.list_(pa.int32())),
            "times": pa.array([np.array(self.times, np.int64)[order]], pa.list_(pa.int64())),
        }
        return pa.RecordBatch.from_pydict(columns)


BLOCKS = (
    "n_docs long, n_terms long, docs array<long>, lengths array<long>, terms array<int>, "
    "counts array<long>, places array<int>, times array<long>"
)


def blocks(docs: DataFrame, vocabulary) -> DataFrame:
    """``docs`` as blocks of postings of the broadcast vocabulary (term to number)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = vocabulary.value, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                block.add(doc_id.as_py(), text.as_py(), known)
                if len(block.docs) >= BLOCK or len(block.terms) >= POSTINGS:
                    yield block.batch()
                    block = _Block()
        if block.n_docs:
            yield block.batch()

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def masks(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct masks as rows of bits, number of each column's mask) of terms by documents."""
    packed = np.ascontiguousarray(np.packbits(held, axis=0).T)
    _, first, number = np.unique(
        packed.view(np.dtype((np.void, packed.shape[1]))).ravel(), return_index=True, return_inverse=True
    )
    return held[:, first].T, number


class Ranking:
    """The best documents of one item so far: highest score first, then smallest id."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids = top, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """What a document must reach to enter."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]


def rank_block(
    ranking: Ranking, held: np.ndarray, parts: np.ndarray, weights: np.ndarray, best: np.ndarray, ids: np.ndarray
) -> int:
    """Enter a block's documents into an item's ranking; returns how many were scored.

    ``held`` and ``parts`` are terms by documents, ``best`` the terms' largest parts.
    """
    distinct, number = masks(held)
    bound = distinct.astype(np.int64) @ (weights * best)
    order = np.argsort(-bound, kind="stable")
    by_mask = np.argsort(number, kind="stable")
    starts = np.searchsorted(number[by_mask], np.arange(len(bound) + 1))
    scored = 0
    for k in range(0, len(order), STEP):
        some = order[k : k + STEP]
        some = some[bound[some] >= ranking.least]
        if not len(some):
            break
        docs = np.concatenate([by_mask[starts[m] : starts[m + 1]] for m in some])
        ranking.add(weights @ parts[:, docs], ids[docs])
        scored += len(docs)
    return scored


def _rank(query, top: int):
    """Best documents of every item of a pack over a task's blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, n_docs, n_terms = query.value
        rankings = {item: Ranking(top) for item in items}
        for batch in batches:
            for row in range(len(batch)):
                at = {c: batch.column(c)[row].values for c in batch.schema.names if c not in ("n_docs", "n_terms")}
                ids = at["docs"].fill_null(NO_ID).to_numpy(zero_copy_only=False)
                lengths, terms, counts = (at[c].to_numpy() for c in ("lengths", "terms", "counts"))
                if not len(terms):
                    continue
                places, times = at["places"].to_numpy(), at["times"].to_numpy()
                m = 10 + (90 * lengths * n_docs) // n_terms
                part = (1_000_000_000 * times) // (1000 * times + 8 * m[places])
                starts = np.cumsum(counts) - counts
                best = np.maximum.reduceat(part, starts)
                for item, wanted in items.items():
                    lines = np.searchsorted(terms, wanted)
                    lines = lines[(lines < len(terms)) & (terms[np.minimum(lines, len(terms) - 1)] == wanted)]
                    if not len(lines):
                        continue
                    # Only the postings of the item's own terms become a table.
                    size = counts[lines]
                    at_line = np.repeat(np.arange(len(lines)), size)
                    posting = np.arange(size.sum()) + np.repeat(starts[lines] - (np.cumsum(size) - size), size)
                    parts = np.zeros((len(lines), len(ids)), np.int64)
                    held = np.zeros(parts.shape, np.uint8)
                    parts[at_line, places[posting]] = part[posting]
                    held[at_line, places[posting]] = 1
                    rank_block(rankings[item], held, parts, weights[terms[lines]], best[lines], ids)
        found = [(i, d, s) for i, r in rankings.items() for d, s in zip(r.ids.tolist(), r.scores.tolist())]
        columns = list(zip(*found)) or [(), (), ()]
        columns[1] = [None if d == NO_ID else d for d in columns[1]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return run


def _packed(items: DataFrame) -> tuple[DataFrame, int]:
    """The items with a pack number; no pack of several items is above twice its size."""
    sized = items.withColumn("bytes", F.octet_length("text"))
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    n = max(1, -(-total // PACK_BYTES))
    while True:
        packed = sized.withColumn("pack", F.pmod(F.xxhash64("item"), F.lit(n)).cast("int"))
        largest = packed.groupBy("pack").agg(F.sum("bytes").alias("all"), F.count("*").alias("n"))
        if largest.filter((F.col("all") > 2 * PACK_BYTES) & (F.col("n") > 1)).isEmpty():
            return packed, n
        n *= 2


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents with a score above 0.

    Items are the distinct rows (item_id, text); two texts of one id are ranked apart, and
    so is a missing id. Each row of ``docs`` (doc_id long, text) is a document of its own.
    Null and empty texts hold no term and are never found. Equal scores go by ascending
    doc_id, nulls last. Whole texts of any length are read, in pieces. An empty table on
    either side gives no rows. Other columns, whatever their names, don't matter.
    """
    spark = docs.sparkSession
    numbered = settle(
        items.select("item_id", F.col("text").alias("text"))
        .filter(F.col("text").isNotNull())
        .distinct()
        .withColumn("item", F.monotonically_increasing_id())
    )
    packed, n_packs = _packed(numbered)
    found = None
    for pack in range(n_packs):
        terms: dict[int, set] = {}
        for row in packed.filter(F.col("pack") == pack).select("item", "text").collect():
            terms[row["item"]] = {t for part in term_blocks(row["text"]) for t in part}
        vocabulary = {t: k for k, t in enumerate(sorted(set().union(*terms.values())))}
        index = settle(blocks(docs, spark.sparkContext.broadcast(vocabulary)))
        n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        n_docs, n_terms = n_docs or 0, n_terms or 1
        ratio = F.lit(2.0 * n_docs + 2) / (2 * F.sum("counts") + 1)
        known = (
            index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
            .select("t.*")
            .groupBy("terms")
            .agg(F.floor(1000 * F.ln(ratio)).alias("weight"))
        )
        weights = np.zeros(len(vocabulary) + 1, np.int64)
        for row in known.collect():
            weights[row["terms"]] = row["weight"]
        wanted = {i: np.array(sorted(vocabulary[t] for t in ts), np.int32) for i, ts in terms.items()}
        query = spark.sparkContext.broadcast((wanted, weights, n_docs, n_terms))
        part = index.mapInArrow(_rank(query, top), "item long, doc_id long, score long")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
