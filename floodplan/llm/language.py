"""Language of texts by words first, and by ever shorter character n-grams for other words.

Words of all training documents are counted by language. Known words score by their log
frequency in each language. A word that isn't known is scored by the mean of its n-grams of
the greatest length of which any is known. A price for each step down would be the same for
all languages and so change nothing.

``language_id`` knows every word and n-gram counted: the most frequent words are sent to the
tasks, all others are joined with the tables of counts. ``train`` makes a bounded model.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from floodplan.session import settle

UNKNOWN = "und"
#: Sizes of the model, which is sent to every task.
WORDS, GRAMS = 60_000, 30_000
LONGEST = 5
REMEMBERED = 200_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    if not text or not any(map(str.isalpha, text)):
        return []
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """The n-grams of a word with marked ends."""
    word = f"<{word}>"
    return [word[i : i + n] for i in range(len(word) - n + 1)]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Words by language of a task, handed on before they are too many."""
    counts: dict[str, Counter] = {}

    def flush() -> pd.DataFrame:
        rows = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
        counts.clear()
        return pd.DataFrame(rows, columns=["lang", "word", "n"])

    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"]):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > REMEMBERED:
            yield flush()
    yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over all rows (text, lang)."""
    counted = docs.select("text", "lang").mapInPandas(_count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Rows of ``logs``, a column for each language, by word and by n-gram of each length."""

    langs: list[str]
    words: dict[str, int]
    grams: list[dict[str, int]]
    logs: np.ndarray

    def rows(self, word: str) -> list[int]:
        """The rows whose mean is a word's score; none if nothing about it is known."""
        row = self.words.get(word)
        if row is not None:
            return [row]
        for n in range(LONGEST, 0, -1):
            known = [g for g in map(self.grams[n - 1].get, grams_of(word, n)) if g is not None]
            if known:
                return known
        return []


def _logs(counts: pd.DataFrame, key: str, langs: list[str], totals: pd.Series) -> pd.DataFrame:
    """Smoothed log frequencies from rows (key, lang, n)."""
    table = counts.pivot_table(index=key, columns="lang", values="n", aggfunc="sum", fill_value=0)
    table = table.reindex(columns=langs, fill_value=0).astype(float)
    return np.log((table + 0.5) / (totals[langs].to_numpy(float) + 0.5 * max(len(table), 1)))


def _frequent(counts: DataFrame, key: str, most: int) -> pd.DataFrame:
    """Rows of the ``most`` most frequent keys over all languages."""
    top = counts.groupBy(key).agg(F.sum("n").alias("all")).orderBy(F.desc("all"), key).limit(most)
    return counts.join(top.select(key), key).toPandas()


def _grams(n: int) -> Column:
    """``grams_of`` a column ``word``."""
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    places = F.sequence(F.lit(1), F.length(marked) - n + 1)
    return F.filter(
        F.transform(places, lambda i: F.substring(marked, i, F.lit(n))), lambda g: F.length(g) == n
    )


def train(docs: DataFrame, most_words: int = WORDS, most_grams: int = GRAMS) -> Model:
    """A model of all rows (text, lang) with a language.

    The counts cover every row. The model keeps the most frequent words and, of each
    length, n-grams; both bounds are parameters.
    """
    counts = settle(word_counts(docs.filter("lang IS NOT NULL")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).toPandas().set_index("lang")["n"]
    langs = sorted(totals.index)
    if not langs:
        return Model([], {}, [{}] * LONGEST, np.zeros((0, 0)))
    tables = [_logs(_frequent(counts, "word", most_words), "word", langs, totals)]
    for n in range(1, LONGEST + 1):
        by_gram = (
            counts.select("lang", "n", F.explode(_grams(n)).alias("gram"))
            .groupBy("lang", "gram")
            .agg(F.sum("n").alias("n"))
        )
        found = _frequent(settle(by_gram), "gram", most_grams)
        sums = found.groupby("lang")["n"].sum().reindex(langs, fill_value=0)
        tables.append(_logs(found, "gram", langs, sums))
    ends = np.cumsum([0, *(len(t) for t in tables)])
    rows = [{key: start + i for i, key in enumerate(t.index)} for start, t in zip(ends.tolist(), tables)]
    return Model(langs, rows[0], rows[1:], np.concatenate([t.to_numpy() for t in tables]))


class _Rows(dict):
    """Rows of each word, looked up once."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = self.model.rows(word)
        return found


def _total(counts: Counter, rows: _Rows) -> np.ndarray:
    """Sum of the scores of a text's words in each language."""
    total, every = np.zeros(len(rows.model.langs)), list(counts.items())
    for start in range(0, len(every), 4096):
        at, weights = [], []
        for word, n in every[start : start + 4096]:
            found = rows[word]
            if len(found) == 1:
                at.append(found[0])
                weights.append(n)
            elif found:
                at.extend(found)
                weights.extend([n / len(found)] * len(found))
        total += np.array(weights, float) @ rows.model.logs[np.array(at, np.int64)]
    return total


def predictor(spark, model: Model):
    """A column function: text to (lang, score)."""
    sent = spark.sparkContext.broadcast(model)
    kind = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])

    @pandas_udf(kind)
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows, langs = _Rows(sent.value), sent.value.langs
        for text in texts:
            found = []
            for t in text:
                words = Counter(words_of(t))
                if not words or not langs:
                    found.append((UNKNOWN, 0.0))
                    continue
                total = _total(words, rows)
                odds = np.exp(total - total.max())
                best = int(total.argmax())
                found.append((langs[best], float(odds[best] / odds.sum())))
            yield pd.DataFrame(found, columns=["lang", "score"])

    return predict


def _by_key(counts: DataFrame, key: str, langs: list[str], totals: list[int] | None = None) -> DataFrame:
    """(key, all, logs): sum and smoothed log frequencies in each language of every key."""
    by = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) for x in langs]
    table = settle(counts.groupBy(key).agg(F.array(*by).alias("ns"), F.sum("n").alias("all")))
    size = table.count()
    if totals is None:
        sums = table.agg(*[F.sum(F.col("ns")[i]) for i in range(len(langs))]).first()
        totals = [n or 0 for n in sums]
    logs = [
        F.log((F.col("ns")[i] + 0.5) / F.lit(float(n) + 0.5 * max(size, 1))) for i, n in enumerate(totals)
    ]
    return table.select(key, "all", F.array(*logs).alias("logs"))


def _sums(logs: Column, langs: list[str], of=F.sum) -> Column:
    return F.array(*[of(logs[i]) for i in range(len(langs))])


def unseen_logs(words: DataFrame, counts: DataFrame, langs: list[str]) -> DataFrame:
    """(word, logs) of words that were never counted, by the longest n-grams of which any was.

    Of the counted words' n-grams, only those that the words have are looked at, but all are
    counted. A word without any known n-gram is left out.
    """
    left, found = settle(words), []
    for n in range(LONGEST, 0, -1):
        if left.isEmpty():
            break
        cut = counts.select("lang", "n", F.explode(_grams(n)).alias("gram"))
        known = _by_key(cut.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram", langs)
        mine = left.select("word", F.explode(_grams(n)).alias("gram"))
        scored = mine.join(known, "gram").groupBy("word").agg(_sums(F.col("logs"), langs, F.avg).alias("logs"))
        found.append(settle(scored))
        left = settle(left.join(found[-1], "word", "left_anti"))
    none = words.select("word", F.lit(None).cast("array<double>").alias("logs")).limit(0)
    for table in found:
        none = none.union(table)
    return none


def _scan(spark, words: dict[str, int], logs: np.ndarray):
    """A column function: (total, rest, any) of a text; rest are the words not sent along."""
    sent = spark.sparkContext.broadcast((words, logs))

    @pandas_udf("total array<double>, rest array<struct<word: string, times: long>>, any boolean")
    def scan(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, logs = sent.value
        for text in texts:
            found = []
            for t in text:
                total, at, times, rest = np.zeros(logs.shape[1]), [], [], []
                counts = Counter(words_of(t))
                for word, n in counts.items():
                    row = known.get(word)
                    if row is None:
                        rest.append({"word": word, "times": n})
                    else:
                        at.append(row)
                        times.append(n)
                for start in range(0, len(at), 4096):
                    total += np.array(times[start : start + 4096], float) @ logs[at[start : start + 4096]]
                found.append((total, rest, bool(counts)))
            yield pd.DataFrame(found, columns=["total", "rest", "any"])

    return scan


def language_id(docs: DataFrame, sent_words: int = WORDS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row for each row of ``docs``.

    The model learns from documents that aren't held out and have a language, and knows all
    their words; ``sent_words`` of them are sent to the tasks, which changes no result. A text
    that is null or has no letter gets ``und`` and score 0; so does any if nothing could be
    learned. Ties go to the language that sorts first. A null doc_id isn't held out.
    """
    spark = docs.sparkSession
    learned = docs.filter(~held_out(F.col("doc_id"))).filter("lang IS NOT NULL")
    counts = settle(word_counts(learned))
    of_lang = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(of_lang)
    if not langs:
        return docs.select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
        )
    known = _by_key(counts, "word", langs, [of_lang[x] for x in langs])
    top = known.orderBy(F.desc("all"), "word").limit(sent_words).select("word", "logs").toPandas()
    logs = np.array(top["logs"].tolist(), float).reshape(-1, len(langs))
    scan = _scan(spark, {w: i for i, w in enumerate(top["word"])}, logs)
    rows = settle(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            scan("text").alias("s"),
        ).select("rid", "doc_id", "held_out", "s.*")
    )
    rest = rows.select("rid", F.explode("rest").alias("w")).select("rid", "w.word", "w.times")
    asked = settle(rest.select("word").distinct())
    seen = known.select("word", "logs").join(asked, "word", "left_semi")
    unseen = unseen_logs(asked.join(known, "word", "left_anti"), counts, langs)
    more = (
        rest.join(seen.union(unseen), "word")
        .select("rid", F.transform("logs", lambda x: x * F.col("times")).alias("logs"))
        .groupBy("rid")
        .agg(_sums(F.col("logs"), langs).alias("more"))
    )
    whole = F.zip_with("total", F.coalesce("more", F.array(*[F.lit(0.0)] * len(langs))), lambda x, y: x + y)
    most = F.array_max("whole")
    odds = F.aggregate("whole", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("most")))
    best = F.get(F.array(*map(F.lit, langs)), (F.array_position("whole", F.col("most")) - 1).cast("int"))
    return (
        rows.drop("rest")
        .join(more, "rid", "left")
        .select("doc_id", "held_out", "any", whole.alias("whole"))
        .withColumn("most", most)
        .select(
            "doc_id",
            "held_out",
            F.when(F.col("any"), best).otherwise(UNKNOWN).alias("lang_pred"),
            F.when(F.col("any"), 1.0 / odds).otherwise(0.0).alias("score"),
        )
    )
