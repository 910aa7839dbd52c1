"""Additive fingerprints against plain sums, edits against whole texts."""

import random
from collections import Counter
from hashlib import md5, sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from floodplan.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, key string, at int, part int"


def plain(text):
    """Lanes by adding one paragraph and one word after the other."""
    lanes = [0] * fp.LANES
    for line in (text or "").encode().split(b"\n"):
        digest = sha256(line).digest()
        for k in range(8):
            lanes[k] += int.from_bytes(digest[4 * k : 4 * k + 4], "big")
        words = line.split()
        for k in range(len(words)):
            bits = int.from_bytes(md5(b" ".join(words[max(0, k - 2) : k + 1])).digest(), "big")
            for j in range(128):
                lanes[8 + j] += 1 if bits >> (127 - j) & 1 else -1
    return "".join(f"{x % 2**32:08x}" for x in lanes)


def near(a, b):
    x, y = ([(int(s[8 * k : 8 * k + 8], 16) + 2**31) % 2**32 - 2**31 for k in range(8, fp.LANES)] for s in (a, b))
    squares = sum(p * p for p in x + y)
    return min(1.0, max(0.0, 2 * sum(p * q for p, q in zip(x, y)) / squares)) if squares else float(a == b)


def some_docs():
    random.seed(3)
    word = [f"w{k}é" for k in range(60)]
    docs = []
    for k in range(150):
        lines = [" ".join(random.choices(word, k=random.randrange(0, 12))) for _ in range(random.randrange(1, 8))]
        docs.append((k * 3, "\n".join(lines)))
    docs += [(1000, None), (1001, ""), (1002, "x"), (1003, "\n\n"), (1004, "𝄞" * 9), (1005, " \t"), (1006, "one line")]
    docs += [docs[4]] * 30 + [(7, "tie a b c d"), (7, "tie e f"), (None, "no id here"), (2000, "long one. " * 40_000)]
    return docs


def rows(table):
    return Counter(
        (r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
        for r in table.collect()
    )


def expected(spark, docs):
    keyed = spark.createDataFrame(docs, "doc_id long, text string").withColumn("k", F.xxhash64("text")).collect()
    order = sorted(keyed, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.k))
    found = []
    for here, after in zip(order, order[1:] + order[:1]):
        text, following = here.text or "", after.text or ""
        share = len(text) // 4
        edited = text[: len(text) - share] + following[:share]
        a, b, c = plain(text), plain(edited), plain(following)
        found.append((here.doc_id, len(text), sha256(edited.encode()).hexdigest(), a, b, near(a, b), near(a, c)))
    return Counter(found)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_edited(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = some_docs()
        table = spark.createDataFrame([(*d, "k", 1, 2) for d in docs], SCHEMA).repartition(5)
        assert rows(fp.edited_fingerprints(table)) == expected(spark, docs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_single_and_empty(spark):
    docs = [(5, "only one\nof its kind")]
    table = spark.createDataFrame([(*docs[0], "", 0, 0)], SCHEMA)
    assert rows(fp.edited_fingerprints(table)) == expected(spark, docs)
    assert not rows(fp.edited_fingerprints(table.limit(0)))


def test_order_of_paragraphs_does_not_matter():
    lines = [f"line {k} of some text" for k in range(20)] * 2
    a = fp.vector("\n".join(lines))
    random.shuffle(lines)
    assert (a == fp.vector("\n".join(lines))).all()
    assert (a != fp.vector("\n".join(lines[1:]))).any()


def test_blocks_change_nothing(monkeypatch):
    text = "\n".join(f"a b c d {k} e" for k in range(50))
    whole = fp.vector(text)
    monkeypatch.setattr(fp, "WORDS", 3)
    assert (fp.vector(text) == whole).all()


def test_lanes_wrap():
    total = np.full(fp.LANES, 2**31 - 1, np.int32)
    assert (total + np.int32(1) == -(2**31)).all()


def test_edits_without_texts(spark):
    docs = [(1, "a b\nc d\ne f"), (2, "x\nx\ny"), (3, "kept"), (None, "n")]
    table = spark.createDataFrame([(*d, "", 0, 0) for d in docs], SCHEMA)
    prints = fp.fingerprints(table).select("row.doc_id", "lanes")
    edits = [(1, "c d", -1), (1, "new one", 1), (2, "x", -1), (None, "m", 1), (9, "first", 1), (3, None, 1), (3, "q", None)]
    after = fp.with_edits(prints, spark.createDataFrame(edits, "doc_id long, paragraph string, change int"))
    found = {r.doc_id: r.p for r in after.select("doc_id", fp.digits(F.col("lanes")).alias("p")).collect()}
    assert found == {
        1: plain("e f\nnew one\na b"),
        2: plain("y\nx"),
        3: plain("kept"),
        None: plain("n\nm"),
        9: plain("first"),
    }
