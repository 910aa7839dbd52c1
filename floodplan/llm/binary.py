"""Token ids of documents as fixed-length sequences in training order.

Every document's ids are cut into sequences of one length. A keyed Feistel permutation over
the sequences' numbers, walked on until it lands below their count, gives each a slot. Slots
are dealt to shards by range and every sequence takes as many bytes, so that a reader finds
any slot by arithmetic and can go on from where it stopped.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from floodplan.llm.text import text_hash
from floodplan.session import settle, shared_dir

#: Ids in a sequence; sequences in a shard; the id that fills up, which no vocabulary has.
LENGTH, SHARD, PAD = 256, 4096, 65535
KEY, TURNS = 20_240_601, 6
#: Sequences that are put into one Arrow batch; bytes of records in a task, about.
SLICE, TASK_BYTES = 16_384, 64_000_000
#: The white space of the pattern, which is Unicode's and not that of ``str.split``.
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Before the last of several spaces that something follows, where the pattern ends a token.
_CUT = re.compile(rf"(?<=[{_SPACES}])(?=[{_SPACES}][^{_SPACES}])")


@cache
def _encoding(path: str, ahead: bool = True):
    """The byte pair encoding of a file of ranks, read once in each process.

    Without ``ahead`` its pattern doesn't look ahead, so that it is matched in linear time
    and much faster. Between cuts its ids are the same.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = public_tokenizers.PATTERN
    if not ahead:
        pattern = pattern.replace(r"|\s+(?!\S)|\s+", r"|\s+")
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Ids of texts, as bytes of 16-bit numbers."""

    def __init__(self, path: str):
        self.encode = _encoding(path, ahead=False).encode_ordinary

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join([array("H", self.encode(part)).tobytes() for part in _CUT.split(text)])


def feistel(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """A permutation of range(count), evaluated at some of its numbers."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(xxhash.xxh64_intdigest(f"{key}:{turn}".encode())) for turn in range(TURNS)]
    left_out = np.arange(len(numbers))
    slots = numbers.astype(np.uint64)
    while len(left_out):
        x = slots[left_out]
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        slots[left_out] = left << np.uint64(half) | right
        left_out = left_out[slots[left_out] >= count]
    return slots.astype(np.int64)


def _in_order(docs: DataFrame) -> DataFrame:
    """The rows in ranges of (doc_id, hash of the text), nulls first, and sorted within them.

    However the input is split, the order is the same, as rows alike in both are equal. What
    they are parted by is their place, so that copies of one row don't share a range.
    """
    key = ("doc_id", "text_key", "place")
    rows = docs.select(
        "doc_id",
        "text",
        text_hash(F.col("text")).alias("text_key"),
        F.monotonically_increasing_id().alias("place"),
    )
    return rows.repartitionByRange(*key).sortWithinPartitions(*key)


def _tokenized(docs: DataFrame, path: str, length: int) -> DataFrame:
    """(task, first, doc_id, n_sequences, n_tokens, ids), a settled table.

    ``first`` is the number of a document's first sequence among those of its task, and
    tasks are numbered in the order of ``_in_order``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, first = Tokens(path), 0
        task = TaskContext.get().partitionId()
        for batch in batches:
            ids = [tokens.of(t) for t in batch.column("text").to_pylist()]
            count = np.array([len(i) // 2 for i in ids], np.int64)
            sequences = -(-count // length)
            firsts = first + np.concatenate([[0], np.cumsum(sequences)])
            first = int(firsts[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), task), pa.int32()),
                    pa.array(firsts[:-1], pa.int64()),
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sequences, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["task", "first", "doc_id", "n_sequences", "n_tokens", "ids"],
            )

    kind = "task int, first long, doc_id long, n_sequences long, n_tokens long, ids binary"
    found = _in_order(docs).select("doc_id", "text").mapInArrow(run, kind)
    spark = docs.sparkSession
    # As ``settle``, compressed harder: the ids are most of what this operator keeps.
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    found.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(found.schema).parquet(folder)


def _records(ids: list[bytes], rows: np.ndarray, within: np.ndarray, size: int) -> bytes:
    """The records of consecutive sequences: (document, number within it) of each."""
    documents, starts = np.unique(rows, return_index=True)
    ends = [*starts[1:], len(rows)]
    parts = []
    for document, start, end in zip(documents, starts, ends):
        first, last = int(within[start]), int(within[end - 1]) + 1
        parts.append(ids[document][first * size : last * size].ljust((last - first) * size, b"\xff"))
    return b"".join(parts)


def training_order(docs: DataFrame, path: str, length: int = LENGTH, shard: int = SHARD, key: int = KEY) -> DataFrame:
    """(slot, shard, place, doc_id, sequence, n_tokens, record), in order of slots.

    ``record`` has ``length`` ids as 16-bit numbers, low byte first, the last of a document
    filled up with PAD. Slots are 0 to the number of sequences less one, each once. They
    depend on the rows alone, not on files or partitions. A null or empty text has no
    sequences; repeated rows have their own; a null doc_id stays null.
    """
    tokens = _tokenized(docs, path, length)
    # A row for each task that tokenized; as a table its true size decides how it is joined.
    sizes = tokens.groupBy("task").agg(F.sum("n_sequences").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), "n"))
    count = offsets.agg(F.sum("n")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids").to_pylist()
            sequences = batch.column("n_sequences").to_numpy()
            first = batch.column("first").to_numpy()
            tokens_of = batch.column("n_tokens").to_numpy()
            starts = np.cumsum(sequences) - sequences
            for low in range(0, int(sequences.sum()), SLICE):
                at = np.arange(low, min(low + SLICE, int(sequences.sum())))
                rows = np.searchsorted(starts, at, side="right") - 1
                within = at - starts[rows]
                slots = feistel(first[rows] + within, count, key)
                data = _records(ids, rows, within, 2 * length)
                bounds = np.arange(len(at) + 1, dtype=np.int32) * 2 * length
                records = pa.Array.from_buffers(
                    pa.binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
                )
                left = tokens_of[rows] - within * length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(slots, pa.int64()),
                        pa.array(slots // shard, pa.int64()),
                        pa.array((slots % shard).astype(np.int32), pa.int32()),
                        batch.column("doc_id").take(pa.array(rows)),
                        pa.array(within, pa.int64()),
                        pa.array(np.minimum(left, length).astype(np.int32), pa.int32()),
                        records,
                    ],
                    ["slot", "shard", "place", "doc_id", "sequence", "n_tokens", "record"],
                )

    numbered = (
        tokens.filter("n_sequences > 0")
        .join(offsets.drop("n"), "task")
        .select((F.col("first") + F.col("offset")).alias("first"), "doc_id", "n_sequences", "n_tokens", "ids")
    )
    kind = "slot long, shard long, place int, doc_id long, sequence long, n_tokens int, record binary"
    placed = numbered.mapInArrow(run, kind)
    # Slots are a permutation, so shards are even and their ranges are known beforehand.
    shards = max(1, -(-count // shard))
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(shards, max(least, -(-count * 2 * length // TASK_BYTES)))
    part = F.floor(F.col("shard") * parts / shards).cast("int")
    return placed.repartitionById(parts, part).sortWithinPartitions("shard", "place")


def stride(length: int = LENGTH) -> int:
    """Bytes of a record in a shard: its ids and one that ends it."""
    return 2 * length + 1


def write_shards(ordered: DataFrame, path: str) -> None:
    """A folder for each shard with one file of records in order of their slots.

    Spark's writer commits a file whole or not at all, on any file system it knows. A
    record's bytes are followed by a line end, which its length includes.
    """
    ordered.select("shard", F.col("record").cast("string").alias("value")).write.partitionBy("shard").text(path)


def read_from(spark: SparkSession, path: str, slot: int, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """(slot, record) from ``slot`` on: whole shards before it are not opened."""
    first, size = slot // shard, stride(length)
    files = spark.read.format("binaryFile").load(path).filter(F.col("shard") >= first)
    places = F.sequence(F.lit(0), (F.length("content") / size).cast("int") - 1)
    return (
        files.select("shard", "content", F.explode(places).alias("place"))
        .select(
            (F.col("shard") * shard + F.col("place")).alias("slot"),
            F.substring("content", F.col("place") * size + 1, F.lit(2 * length)).alias("record"),
        )
        .filter(F.col("slot") >= slot)
    )
