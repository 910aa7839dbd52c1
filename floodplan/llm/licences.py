"""Licence notices and whole licence texts, found through a positional index.

A licence is a list of clauses, each with a phrase that must stand in it word for word. A
scan of each text keeps the licence words and their positions. Document frequencies over all
documents say which word of a phrase is the rarest: under it the index lists the clause's
postings, relative to it. In every file only its words of that kind, those of the highest
IDF in their phrases, are looked up. Where the whole phrase stands around such a word, the
clause's other postings are intersected with the file's by relative position, and the IDF of
those met is the clause's share. A whole licence is told by the share of all its clauses.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodplan.llm.licence_texts import NOTICES, WHOLE
from floodplan.llm.text import SEPARATORS, ascii_words
from floodplan.session import settle

#: Labels and phrases of the contract, whose places are counted.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
#: A licence beyond those is told from this share of its words' IDF on.
SHARE = 0.5


def plain_words(text: str) -> list[str]:
    """The words of a licence, as ``ascii_words`` cuts a text."""
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(SEPARATORS, lower) if w]


@dataclass(frozen=True)
class Clause:
    words: tuple[str, ...]
    #: Words that must stand consecutively, and the place of their first one in the clause.
    phrase: tuple[str, ...]
    start: int

    @classmethod
    def marked(cls, line: str) -> Clause:
        """A clause whose phrase stands between asterisks."""
        before, phrase, after = (plain_words(part) for part in line.split("*"))
        return cls((*before, *phrase, *after), tuple(phrase), len(before))


@dataclass(frozen=True)
class Licence:
    """The first clause is mandatory: without it a licence is never told."""

    label: str
    clauses: tuple[Clause, ...]

    @classmethod
    def marked(cls, label: str, text: str) -> Licence:
        return cls(label, tuple(Clause.marked(line) for line in text.splitlines() if line.strip()))

    @property
    def base(self) -> bool:
        return len(self.clauses) == 1 and " ".join(self.clauses[0].phrase) == BASE.get(self.label)


LICENCES = tuple(Licence.marked(label, text) for label, text in {**NOTICES, **WHOLE}.items())


def _licence_words(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n_words, hits): the licence words of every text and their positions."""
    hit = lambda w, i: F.when(w.isin(vocabulary), F.struct(w.alias("word"), i.alias("place")))
    words = docs.select("doc_id", ascii_words(F.col("text")).alias("words"))
    return settle(
        words.select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            F.array_compact(F.transform("words", hit)).alias("hits"),
        )
    )


def inverse_frequencies(found: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """The licence words' IDF over all documents, 1 at least: one number for each word of the licences."""
    counts = (
        found.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").count()
    )
    n, df = found.count(), {r["word"]: r["count"] for r in counts.collect()}
    return {w: 1 + math.log((n + 1) / (df.get(w, 0) + 1)) for w in vocabulary}


def _array(items) -> str:
    return f"array({', '.join(items)})"


def _index(clauses: list[Clause], idf: dict[str, float]) -> tuple[list[str], Column]:
    """The looked-up words, and a map from each to the clauses whose phrase it is the rarest of.

    A posting is ``word:place``, the place counted from the looked-up word.
    """
    lists: dict[str, list[str]] = {}
    for number, clause in enumerate(clauses):
        rarest = max(range(len(clause.phrase)), key=lambda k: (idf[clause.phrase[k]], -k))
        at = clause.start + rarest
        phrase = [f"'{w}:{k - rarest}'" for k, w in enumerate(clause.phrase)]
        postings = [
            f"named_struct('posting', '{w}:{k - at}', 'idf', {idf[w]!r}D)" for k, w in enumerate(clause.words)
        ]
        lists.setdefault(clause.phrase[rarest], []).append(
            f"named_struct('clause', {number}, 'rarest', {rarest}, 'phrase', {_array(phrase)}, "
            f"'postings', {_array(postings)}, 'idf', {_weight(clause, idf)!r}D)"
        )
    pairs = (f"'{word}', {_array(entries)}" for word, entries in lists.items())
    return sorted(lists), F.expr(f"map({', '.join(pairs)})")


def _weight(clause: Clause, idf: dict[str, float]) -> float:
    return _total(idf[w] for w in clause.words)


def _total(numbers) -> float:
    """Added one by one as ``_sum`` does, so that a whole clause or licence has a share of just 1."""
    return reduce(float.__add__, numbers, 0.0)


def _sum(items: Column) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda total, x: total + x)


def _met(index: Column, widest: int):
    """For a hit's number, (clause, start of its phrase, share) of the clauses found around it."""

    def clause_found(clause: Column, near: Column, place: Column) -> Column:
        met = F.filter(clause["postings"], lambda p: F.array_contains(near, p["posting"]))
        stands = F.size(F.array_except(clause["phrase"], near)) == 0
        return F.when(
            stands,
            F.struct(
                clause["clause"].alias("clause"),
                (place - clause["rarest"]).alias("start"),
                (_sum(F.transform(met, lambda p: p["idf"])) / clause["idf"]).alias("share"),
            ),
        )

    def around(j: Column) -> Column:
        at = F.get("hits", j)
        near = F.transform(
            F.slice("hits", F.greatest(F.lit(1), j + 2 - widest), 2 * widest),
            lambda h: F.concat_ws(":", h["word"], (h["place"] - at["place"]).cast("string")),
        )
        return F.flatten(
            F.transform(
                F.array(near),
                lambda n: F.array_compact(
                    F.transform(F.element_at(index, at["word"]), lambda c: clause_found(c, n, at["place"]))
                ),
            )
        )

    return around


def _told(licences: tuple[Licence, ...], idf: dict[str, float]) -> Column:
    """(label, base, share, first_word, last_word) of each licence told by the column ``met``."""
    entries, number = [], 0
    for licence in licences:
        weights = [_weight(c, idf) for c in licence.clauses]
        clauses = [
            f"named_struct('clause', {number + k}, 'idf', {w!r}D)" for k, w in enumerate(weights)
        ]
        entries.append(
            f"named_struct('label', '{licence.label}', 'base', {str(licence.base).lower()}, "
            f"'first', {number}, 'idf', {_total(weights)!r}D, 'clauses', {_array(clauses)})"
        )
        number += len(weights)

    def judged(licence: Column) -> Column:
        first, end = licence["first"], licence["first"] + F.size(licence["clauses"])
        mine = F.filter("met", lambda m: (m["clause"] >= first) & (m["clause"] < end))
        best = lambda c: F.array_max(
            F.transform(F.filter("met", lambda m: m["clause"] == c["clause"]), lambda m: m["share"])
        )
        shares = F.transform(licence["clauses"], lambda c: c["idf"] * F.coalesce(best(c), F.lit(0.0)))
        starts = F.transform(mine, lambda m: m["start"])
        return F.struct(
            licence["label"].alias("label"),
            licence["base"].alias("base"),
            (_sum(shares) / licence["idf"]).alias("share"),
            F.array_min(starts).alias("first_word"),
            F.array_max(starts).alias("last_word"),
            F.exists("met", lambda m: m["clause"] == first).alias("mandatory"),
        )

    every = F.transform(F.expr(_array(entries)), judged)
    told = F.filter(every, lambda x: x["mandatory"] & (x["base"] | (x["share"] >= SHARE)))
    kept = ("label", "base", "share", "first_word", "last_word")
    return F.when(F.size("met") > 0, F.transform(told, lambda x: F.struct(*[x[c].alias(c) for c in kept])))


def licence_scan(docs: DataFrame, licences: tuple[Licence, ...] = LICENCES) -> DataFrame:
    """A row for each row of ``docs``, repeated ones too.

    doc_id, n_words, n_base, first_word, last_word (places of the base phrases), base_labels,
    labels (those of the other licences too), score (the largest share of a licence told, 0
    without a label) and licences: label, base, share, first_word and last_word (places of the
    phrases found) of each licence told. A base licence is told by its phrase, any other if its
    first clause's phrase stands and its share is ``SHARE`` or more; a clause counts with its
    best place, wherever it stands. A null text is empty: it has no words and no labels. Every
    place counts; overlaps do too. Words of a text are one array in its task, so a text may have
    as many as fit there. Other columns of ``docs`` are not read.
    """
    clauses = [c for licence in licences for c in licence.clauses]
    vocabulary = sorted({w for c in clauses for w in c.words})
    found = _licence_words(docs, vocabulary)
    idf = inverse_frequencies(found, vocabulary)
    rarest, index = _index(clauses, idf)
    widest = max(len(c.words) for c in clauses)
    looked_up = F.array_compact(F.transform("hits", lambda h, j: F.when(h["word"].isin(rarest), j)))
    met = F.flatten(F.transform("looked_up", _met(index, widest)))
    base, number = [], 0
    for licence in licences:
        base += [number] if licence.base else []
        number += len(licence.clauses)
    none = "array<struct<label:string,base:boolean,share:double,first_word:int,last_word:int>>"
    names = lambda told: F.array_join(F.array_sort(F.array_distinct(told["label"])), ",")
    return (
        found.withColumn("looked_up", looked_up)
        .select("doc_id", "n_words", met.alias("met"))
        .select(
            "doc_id",
            "n_words",
            F.transform(F.filter("met", lambda m: m["clause"].isin(base)), lambda m: m["start"]).alias("starts"),
            F.coalesce(_told(licences, idf), F.array().cast(none)).alias("licences"),
        )
        .select(
            "doc_id",
            "n_words",
            F.size("starts").cast("long").alias("n_base"),
            F.array_min("starts").cast("long").alias("first_word"),
            F.array_max("starts").cast("long").alias("last_word"),
            names(F.filter("licences", lambda x: x["base"])).alias("base_labels"),
            names(F.col("licences")).alias("labels"),
            F.coalesce(F.array_max("licences.share"), F.lit(0.0)).alias("score"),
            "licences",
        )
    )
