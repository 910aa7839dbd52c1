"""Quality of documents by co-training two classifiers that see different things.

One sees the text's content: its words, marks, capitals, digits, repetition. The other sees
what is known of the page: source, language and both together. Each is a naive Bayes classifier
over features hashed to a fixed number of buckets, fitted by counts over all rows; buckets of
words count only where good and bad differ by more than chance. In every round
each is calibrated on labelled rows kept aside, and labels those unlabelled rows it is sure
of for the other. At the end the calibrated views are combined.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType

from floodplan.session import settle

BUCKETS = 4096
#: More buckets for the words of texts.
WORDS = 16384
#: A word's log odds count from so many standard errors on.
ERRORS = 3.0
ROUNDS = 3
#: A view labels rows for the other above this probability, or below its complement.
SURE = 0.95
#: Weight of such a label against a given one.
PSEUDO_WEIGHT = 0.3
#: Documents are kept from this probability of good quality on.
KEEP = 0.5
#: One in so many labelled documents is for calibration.
FOLDS = 4
_LETTERS = bytes(range(97, 123)) + bytes(range(65, 91)) + bytes(range(48, 58)) + bytes(range(128, 256))


def _bucket(share: float) -> int:
    """Shares in steps of a factor of two; 0 is none and 9 all."""
    return 0 if share <= 0 else max(1, 9 + math.ceil(math.log2(share)))


def _hashed(features: set[tuple]) -> list[int]:
    import xxhash

    return sorted({xxhash.xxh32_intdigest(repr(f).encode()) % BUCKETS for f in features})


def text_features(text: str | None) -> list[int]:
    """Buckets of what a text's content shows and of its words; null and empty are a feature of their own."""
    words = (text or "").split()
    if not words:
        return _hashed({("empty",)})
    n = len(words)
    raw = text.encode("utf-8", "surrogatepass")
    upper = len(raw) - len(raw.translate(None, bytes(range(65, 91))))
    digits = len(raw) - len(raw.translate(None, bytes(range(48, 58))))
    marks = Counter(m[:4] for m in raw.translate(None, _LETTERS).split())
    lines = text.split("\n")
    found = {
        ("upper", _bucket(upper / len(raw))),
        ("digits", _bucket(digits / len(raw))),
        ("marked", _bucket(sum(marks.values()) / n)),
        ("same next", _bucket(sum(map(eq, words, words[1:])) / n)),
        ("distinct", _bucket(len(set(words)) / n), n.bit_length() // 2),
        ("word length", min(30, len(raw) // n)),
        ("repeated lines", _bucket(1 - len(set(lines)) / len(lines))),
    }
    for mark, count in marks.items():
        share = _bucket(count / n)
        if share > 2:
            found.add(("mark", mark, share))
    return _hashed(found) + sorted({BUCKETS + crc32(w) % WORDS for w in set(raw.lower().split())})


@pandas_udf(ArrayType(IntegerType()))
def _text_features(text: pd.Series) -> pd.Series:
    return pd.Series([text_features(t) for t in text], index=text.index, dtype=object)


def page_features() -> Column:
    """Buckets of source, language and both; nulls are values like any other."""
    each = [("source",), ("lang",), ("source", "lang")]
    hashed = lambda names: F.xxhash64(F.lit(" ".join(names)), *[F.col(n).cast("string") for n in names])
    return F.array(*[F.pmod(hashed(names), F.lit(BUCKETS)).cast("int") for names in each])


@dataclass
class View:
    """Log odds of each bucket, and the line that turns their sum into a log odds."""

    odds: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def logits(self, features: pd.Series) -> np.ndarray:
        return self.slope * self.raw(features) + self.shift

    def raw(self, features: pd.Series) -> np.ndarray:
        return np.array([self._sum(np.asarray(f, np.int64)) for f in features], float)

    def _sum(self, buckets: np.ndarray) -> float:
        """Words, which hang together, count with the mean of their log odds."""
        odds = self.odds[buckets]
        words = buckets >= BUCKETS
        return odds[~words].sum() + (odds[words].mean() if words.any() else 0.0)


@dataclass
class Classifier:
    text: View
    page: View
    prior: float

    def combined(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        return _probability(text + page - self.prior)


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_features, page_features, quality, held), a settled table.

    ``quality`` is the mean of a document's labels, null without one or if they are even.
    Labels grow with the documents, so both are shuffled whatever their size.
    """
    mean = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("mean"))
    known = mean.select(
        F.col("doc_id").alias("label_id"),
        F.when(F.col("mean") > 0.5, 1).when(F.col("mean") < 0.5, 0).alias("quality"),
    )
    seen = docs.select("doc_id", _text_features("text").alias("text_features"), page_features().alias("page_features"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    return settle(
        seen.join(known.hint("merge"), F.col("doc_id") == F.col("label_id"), "left").select(
            "doc_id", "text_features", "page_features", "quality", held.alias("held")
        )
    )


def _surely(view: View | None, features: str) -> Column:
    """1 or 0 where a view is sure, else null."""
    if view is None:
        return F.lit(None).cast("int")

    @pandas_udf(IntegerType())
    def told(found: pd.Series) -> pd.Series:
        p = _probability(view.logits(found))
        sure = np.where(p >= SURE, 1.0, np.where(p <= 1 - SURE, 0.0, np.nan))
        return pd.Series(sure, index=found.index).astype("Int32")

    return told(features)


def _fit(rows: DataFrame, text: View | None, page: View | None) -> tuple[View, View]:
    """Both views from the labels for training and what the other view was sure of."""
    train = rows.filter("quality IS NULL OR NOT held")
    given = F.col("quality").isNotNull()
    each = []
    for name, other in (("text", _surely(page, "page_features")), ("page", _surely(text, "text_features"))):
        label = F.coalesce("quality", other)
        each.append(
            train.select(
                F.lit(name).alias("view"),
                F.array_append(f"{name}_features", F.lit(-1)).alias("features"),
                label.alias("label"),
                F.when(given, 1.0).otherwise(PSEUDO_WEIGHT).alias("weight"),
            ).filter("label IS NOT NULL")
        )
    counts = (
        each[0]
        .union(each[1])
        .select("view", F.explode("features").alias("bucket"), "label", "weight")
        .groupBy("view", "bucket")
        .agg(
            F.sum(F.when(F.col("label") == 1, F.col("weight")).otherwise(0.0)).alias("good"),
            F.sum(F.when(F.col("label") == 0, F.col("weight")).otherwise(0.0)).alias("bad"),
        )
        .toPandas()  # a row for each bucket of each view at most
    )
    views = []
    for name in ("text", "page"):
        mine = counts[counts["view"] == name]
        total = mine[mine["bucket"] == -1]
        good, bad = np.zeros(BUCKETS + WORDS), np.zeros(BUCKETS + WORDS)
        some = mine[mine["bucket"] >= 0]
        good[some["bucket"]], bad[some["bucket"]] = some["good"], some["bad"]
        n_good, n_bad = total["good"].sum(), total["bad"].sum()
        odds = np.log((good + 1) / (n_good + 2)) - np.log((bad + 1) / (n_bad + 2))
        odds[good + bad == 0] = 0.0
        chance = np.abs(odds) < ERRORS * np.sqrt(1 / (good + 1) + 1 / (bad + 1))
        odds[BUCKETS:][chance[BUCKETS:]] = 0.0
        views.append(View(odds))
    return tuple(views)


def _line(x: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic regression by Newton's method, slightly regularised."""
    n_good, n_bad = good.sum(), bad.sum()
    target_good, target_bad = (n_good + 1) / (n_good + 2), 1 / (n_bad + 2)
    weight = good + bad
    target = (good * target_good + bad * target_bad) / np.maximum(weight, 1e-9)
    design = np.stack([x, np.ones_like(x)], axis=1)
    theta = np.array([0.0, math.log((n_good + 1) / (n_bad + 1))])
    for _ in range(50):
        p = _probability(design @ theta)
        slope = design.T @ (weight * (target - p)) - 1e-3 * theta * [1, 0]
        bend = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(bend, slope)
        theta = theta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 0.0)), float(theta[1])


def _step(view: View):
    """A column function: the view's score in steps of a tenth."""

    @pandas_udf(DoubleType())
    def step(found: pd.Series) -> pd.Series:
        return pd.Series(np.round(np.clip(view.raw(found), -60, 60), 1), index=found.index)

    return step


def _calibrate(rows: DataFrame, views: tuple[View, View]) -> Classifier:
    """Each view's line by all labelled rows kept aside, counted in steps of its score."""
    kept = rows.filter("quality IS NOT NULL AND held")
    each = []
    for name, view in zip(("text", "page"), views):
        x = _step(view)(f"{name}_features").alias("x")
        each.append(kept.select(F.lit(name).alias("view"), x, "quality"))
    counts = (
        each[0]
        .union(each[1])
        .groupBy("view", "x")
        .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
        .toPandas()  # 1,201 rows for each view at most
    )
    for name, view in zip(("text", "page"), views):
        mine = counts[counts["view"] == name]
        view.slope, view.shift = _line(*(mine[c].to_numpy(float) for c in ("x", "good", "bad")))
    text = counts[counts["view"] == "text"]
    prior = math.log((text["good"].sum() + 1) / (text["bad"].sum() + 1))
    return Classifier(*views, prior)


def co_train(rows: DataFrame, rounds: int = ROUNDS) -> Classifier:
    """The classifier after some rounds on a table of ``labelled``.

    Without any label all probabilities are a half.
    """
    model = _calibrate(rows, _fit(rows, None, None))
    for _ in range(rounds - 1):
        model = _calibrate(rows, _fit(rows, model.text, model.page))
    return model


def _scores(model: Classifier):
    kind = "text double, page double, score double"

    @pandas_udf(kind)
    def scores(text: pd.Series, page: pd.Series) -> pd.DataFrame:
        a, b = model.text.logits(text), model.page.logits(page)
        return pd.DataFrame(
            {"text": _probability(a), "page": _probability(b), "score": model.combined(a, b)}
        )

    return scores


def quality_scores(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, p_text, p_page, score, kept), a row for each row of ``docs``.

    ``score`` is the probability of good quality. Nulls in text, source and lang are values
    of their own; labels of unknown documents and null labels count for nothing. Repeated
    rows count as often as they occur.
    """
    rows = labelled(docs, labels)
    found = _scores(co_train(rows, rounds))("text_features", "page_features")
    return rows.select("doc_id", found.alias("p")).select(
        "doc_id",
        F.col("p.text").alias("p_text"),
        F.col("p.page").alias("p_page"),
        F.col("p.score").alias("score"),
        (F.col("p.score") >= KEEP).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The documents with a score of KEEP or more, with all their columns."""
    model = co_train(labelled(docs, labels), rounds)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = _scores(model)(_text_features("text"), page_features())
    return docs.select(row, found["score"].alias("score")).filter(F.col("score") >= KEEP).select("row.*")
