"""Document fingerprints that add: a sum over paragraphs of wide vectors, modulo 2^32.

A paragraph is a line. Its vector has 8 lanes of its SHA-256, and 128 lanes that add 1 or -1
for each of its words, by the bits of a hash of the word and the two before it. A document's
fingerprint is the sum of its paragraphs' vectors modulo 2^32: their order doesn't matter,
and putting in or taking out a paragraph adds or subtracts its vector. The first lanes tell
equal multisets of paragraphs; products of the others estimate how much two have in common.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import md5, sha256
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType

from floodplan.llm.text import with_row
from floodplan.session import settle

STRONG, SIGNS = 8, 128
LANES = STRONG + SIGNS
#: Words that are hashed at once.
WORDS = 1 << 16


def _runs(line: bytes) -> Iterator[bytes]:
    """Every word of a line with up to two words before it."""
    words = line.split()
    yield from (b" ".join(words[:k]) for k in range(1, min(3, len(words) + 1)))
    yield from map(b" ".join, zip(words, islice(words, 1, None), islice(words, 2, None)))


def vector(text: str) -> np.ndarray:
    """The sum of the vectors of a text's lines, each lane as a signed 32-bit number."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    total = np.zeros(LANES, np.int64)
    for start in range(0, len(lines), WORDS):
        digests = b"".join([sha256(line).digest() for line in lines[start : start + WORDS]])
        total[:STRONG] += np.frombuffer(digests, ">u4").reshape(-1, STRONG).sum(axis=0, dtype=np.int64)
    runs = (run for line in lines for run in _runs(line))
    while some := b"".join([md5(run).digest() for run in islice(runs, WORDS)]):
        bits = np.unpackbits(np.frombuffer(some, np.uint8).reshape(-1, 16)[:, : SIGNS // 8], axis=1)
        total[STRONG:] += 2 * bits.sum(axis=0, dtype=np.int64) - len(bits)
    return total.astype(np.int32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: twice the product of the signed lanes over the sum of their squares."""
    x, y = a[STRONG:].astype(np.int64), b[STRONG:].astype(np.int64)
    squares = int((x * x + y * y).sum())
    if not squares:
        return float((a == b).all())
    return min(1.0, max(0.0, 2 * int((x * y).sum()) / squares))


def edited_text(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the following text."""
    share = len(text) // 4
    return text[: len(text) - share] + following[:share]


def edited_vector(before: np.ndarray, text: str, edited: str) -> np.ndarray:
    """The vector after an edit: only the lines from the first changed one on are hashed."""
    keep = len(text) - len(text) // 4
    line = text.rfind("\n", 0, keep) + 1
    return before - vector(text[line:]) + vector(edited[line:])


def digits(lanes: Column) -> Column:
    """The fingerprint as text: 8 hexadecimal digits a lane."""
    return F.array_join(
        F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(F.pmod(x.cast("long"), F.lit(1 << 32)))), 8, "0")), ""
    )


@pandas_udf(ArrayType(IntegerType()))
def lanes(text: pd.Series) -> pd.Series:
    """The fingerprint's lanes; a null text is an empty one."""
    return pd.Series([vector(t or "") for t in text], index=text.index, dtype=object)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(row, lanes): each row of ``docs`` as a struct, and its text's fingerprint."""
    return with_row(docs, lanes=lanes("text"))


def with_edits(prints: DataFrame, edits: DataFrame) -> DataFrame:
    """Fingerprints (doc_id, lanes) after edits (doc_id, paragraph, change).

    ``change`` is 1 for a paragraph put in and -1 for one taken out; neither the document's
    text nor the order of edits is needed. An edited id that ``prints`` lacks begins without
    any paragraph. Edits are added up in the map tasks, so a document may own most of them.
    Null ids are an id like any other; a null paragraph or change does nothing.
    """
    hashed = edits.filter("paragraph IS NOT NULL AND change IS NOT NULL").select(
        "doc_id", lanes("paragraph").alias("lanes"), F.col("change").cast("long").alias("change")
    )
    all_rows = prints.select("doc_id", "lanes", F.lit(1).cast("long").alias("change")).union(hashed)
    wrapped = [
        (F.pmod(F.sum(F.col("lanes")[k].cast("long") * F.col("change")) + (1 << 31), F.lit(1 << 32)) - (1 << 31))
        .cast("int")
        .alias(f"lane_{k}")
        for k in range(LANES)
    ]
    summed = all_rows.groupBy("doc_id").agg(*wrapped)
    return summed.select("doc_id", F.array(*[f"lane_{k}" for k in range(LANES)]).alias("lanes"))


ROWS = (
    "doc_id long, n_chars long, edited_sha256 string, lanes array<int>, edited_lanes array<int>, "
    "near_edited double, near_next double, part int, edge int, text string"
)
FIRST, LAST = 1, 2


def _row(doc_id, text: str, own: np.ndarray, following: str, next_own: np.ndarray, part: int) -> tuple:
    edited = edited_text(text, following)
    new = edited_vector(own, text, edited)
    return (
        *(doc_id, len(text), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()),
        *(own, new, likeness(own, new), likeness(own, next_own), part, 0, None),
    )


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [field.split()[0] for field in ROWS.split(", ")]
    found = pd.DataFrame(rows, columns=names)
    return found.astype({"doc_id": "Int64", "n_chars": "Int64", "part": int, "edge": int})


def _in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a sorted range; its first and its last document are given out with their texts."""
    part, before = TaskContext.get().partitionId(), None

    def edge(doc_id, text: str, which: int) -> tuple:
        return (doc_id, None, None, None, None, None, None, part, which, text)

    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
            text = text or ""
            own = vector(text)
            rows.append(_row(*before, text, own, part) if before else edge(doc_id, text, FIRST))
            before = (doc_id, text, own)
        yield _frame(rows)
    if before:
        yield _frame([edge(before[0], before[1], LAST)])


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = batch["doc_id"].astype("Int64")
        yield _frame(
            [_row(i, t, vector(t), n, vector(n), 0) for i, t, n in zip(ids, batch["text"], batch["next_text"])]
        )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, and that of its text edited with the next document's.

    Columns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next, a row for each row of ``docs`` (doc_id long, text). The next document is that
    with the next greater doc_id, nulls first; equal ids go by a hash of their texts, so
    repeated rows follow each other. The last one's next is the first, a single one's is
    itself. A null text is an empty one, a text without line ends is one paragraph. Whole
    texts are moved once, into ranges of equal size whatever ids repeat; only each range's
    first and last document are looked at again. Other columns don't matter.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("at"))
    ranges = keyed.repartitionByRange("doc_id", "key", "at").sortWithinPartitions("doc_id", "key", "at")
    found = settle(ranges.select("doc_id", "text").mapInPandas(_in_order, ROWS))
    edges = found.filter("edge > 0")
    firsts = edges.filter(F.col("edge") == FIRST).select("part", F.col("text").alias("next_text"))
    # One number for each range that holds documents, no texts.
    whole = Window.orderBy("part")
    follows = firsts.select(
        "part",
        F.coalesce(F.lead("part").over(whole), F.first("part").over(whole)).alias("next_part"),
    )
    lasts = edges.filter(F.col("edge") == LAST).select("part", "doc_id", "text").join(follows, "part")
    pairs = lasts.join(firsts.withColumnRenamed("part", "next_part"), "next_part")
    across = pairs.select("doc_id", "text", "next_text").mapInPandas(_across, ROWS)
    return found.filter("edge = 0").union(across).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        digits(F.col("lanes")).alias("fingerprint"),
        digits(F.col("edited_lanes")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
