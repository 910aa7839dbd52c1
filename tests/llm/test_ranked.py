"""Ranked search against a score for every pair."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from plain import words

from floodplan.llm import search

DOCS = "doc_id long, text string, item_id string, score long, lengths int"


def plain(docs, items, top=10):
    counted = [(d[0], Counter(words(d[1]))) for d in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_words = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in {tuple(i[:2]) for i in items}:
        scores = []
        for doc_id, c in counted:
            score = 0
            for t in set(words(text)) & c.keys():
                w = math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * c.total() * n_docs) // n_words
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        found += [(item_id, k + 1, d, -s) for k, (s, _, d) in enumerate(scores[:top])]
    return Counter(found)


def case(seed, n=300):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["É", "straße", "N0"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [
        (k, " ".join(random.choices(vocabulary, weights, k=random.choice([1, 3, 8, 30, 200]))), "x", 1, 2)
        for k in range(n)
    ]
    docs += docs[:15] + [(500, docs[0][1], "", 0, 0), (None, docs[1][1], "", 0, 0), (501, None, "", 0, 0)]
    docs += [(502, "", "", 0, 0), (503, "-- ..", "", 0, 0), (504, "W1 w1 W2" * 3, "", 0, 0), (505, "w3 " * 90_000, "", 0, 0)]
    items = [(str(k), " ".join(random.choices(vocabulary, k=random.choice([1, 2, 6, 80])))) for k in range(12)]
    items += [items[0], ("0", "w5 w6"), (None, "w7"), ("e", ""), ("n", None), ("f", "unknown words"), ("c", "W1, W2!")]
    return docs, items


def found(spark, docs, items, **how):
    left = spark.createDataFrame(docs, DOCS).repartition(5)
    right = spark.createDataFrame([(*i, "t") for i in items], "item_id string, text string, term string")
    return Counter(tuple(r) for r in search.ranked(left, right, **how).collect())


@pytest.mark.parametrize("block, step, pack", [(2048, 16, 8 << 20), (7, 1, 900), (40, 3, 300)])
def test_ranked(spark, monkeypatch, block, step, pack):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "STEP", step)
    monkeypatch.setattr(search, "PACK_BYTES", pack)
    monkeypatch.setattr(search, "PIECE", 64)
    docs, items = case(block)
    assert found(spark, docs, items) == plain(docs, items)


def test_top(spark):
    docs, items = case(5, 60)
    assert found(spark, docs, items, top=3) == plain(docs, items, 3)


def test_empty(spark):
    docs, items = case(6, 20)
    assert not found(spark, [], items)
    assert not found(spark, docs, [])


def test_masks_left_are_not_scored():
    random.seed(1)
    held = np.array([[random.random() < 0.5 for _ in range(1000)] for _ in range(8)], np.uint8)
    parts = held.astype(np.int64) * 500
    weights = np.array([1 << k for k in range(8)], np.int64)
    ranking = search.Ranking(10)
    scored = search.rank_block(ranking, held, parts, weights, parts.max(axis=1), np.arange(1000))
    scores = weights @ parts
    best = sorted(zip(-scores, range(1000)))[:10]
    assert list(zip(-ranking.scores, ranking.ids)) == best
    assert scored < 200


def test_more_than_64_terms_and_no_match():
    held = np.eye(70, 90, dtype=np.uint8)
    distinct, number = search.masks(held)
    assert len(distinct) == 71
    assert (distinct[number] == held.T).all()
