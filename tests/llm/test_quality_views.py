"""Both views of a document, their fit against plain counts, and labels nobody has seen."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from floodplan.llm import quality

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, row int, score int"


def test_page_view_is_blind_to_the_text(spark):
    table = spark.createDataFrame([(i, t, "en", "web", 0, 0) for i, t in enumerate(["a", None, "word " * 900])], DOCS)
    assert table.select(quality.page_features()).distinct().count() == 1
    other = spark.createDataFrame([(1, "a", None, "web", 0, 0), (1, "a", "en", None, 0, 0)], DOCS)
    assert table.union(other).select(quality.page_features()).distinct().count() == 3


def test_words_are_features():
    of = lambda t: {b for b in quality.text_features(t) if b >= quality.BUCKETS}
    assert of("Some words") == of("words some words") != of("some other")
    assert of(None) == of("") == of(" \n") == set()
    assert len(of("x y " * 400_000)) == 2


def test_fit_against_plain_counts(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.labelled(docs, labels)
    views = quality._fit(rows, None, None)
    seen = [r for r in rows.collect() if r.quality is not None and not r.held]
    for name, view in zip(("text", "page"), views):
        counts, totals = (Counter(), Counter()), Counter(r.quality for r in seen)
        for r in seen:
            counts[r.quality].update(r[f"{name}_features"])
        want = np.zeros(quality.BUCKETS + quality.WORDS)
        for b in set(counts[0]) | set(counts[1]):
            bad, good = counts[0][b], counts[1][b]
            odds = math.log((good + 1) / (totals[1] + 2)) - math.log((bad + 1) / (totals[0] + 2))
            sure = abs(odds) >= quality.ERRORS * math.sqrt(1 / (good + 1) + 1 / (bad + 1))
            want[b] = odds if b < quality.BUCKETS or sure else 0.0
        assert np.allclose(view.odds, want)


def test_labels_kept_from_the_fit(spark):
    """A fifth of the labels is used neither for counts nor for calibration."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    aside = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    found = quality.quality_scores(docs, labels.filter(~aside)).join(labels.filter(aside), "doc_id").collect()
    wrong = [r.doc_id for r in found if r.kept != bool(r.quality)]
    assert len(found) >= 50 and len(wrong) <= len(found) // 10


def test_odd_rows(spark):
    table = [(1, None, None, None, 1, 1), (1, None, None, None, 1, 1), (2, "", "en", "web", 1, 1), (None, "é " * 9, "en", "web", 1, 1)]
    docs = spark.createDataFrame(table, DOCS)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (7, 1)], "doc_id long, quality int")
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == 4 and {round(r.score, 9) for r in found} == {0.5}
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert quality.keep_good(docs.limit(0), labels).count() == 0


def test_labels_are_not_broadcast(spark, monkeypatch, capsys):
    """They grow with the documents: few are joined as many are."""
    monkeypatch.setattr(quality, "settle", lambda df: df)
    docs = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    quality.labelled(docs, labels).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
