"""Benchmark passages in documents, found through a positional inverted index.

The index keeps the words of every document by position. Counts of all terms over all
documents say which term of a window is the rarest; the lists of these terms, (document,
place) by term, are stored. Each of their places brings along what stands around it, so that
the lists of the window's other terms, moved by their distance from the rarest, are
intersected with it in place: a run of equal words as long as the window is an exact match,
and a window whose terms stand near in another order is a proximity match.

A text's words lie in one array, so a text may have as many as fit into a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.llm.text import ascii_words, same_document, text_hash
from floodplan.operators.skew import heavy_keys
from floodplan.session import settle

WINDOW = 10
#: Share of a window's terms that make a proximity match.
NEAR = 0.8


def positional_index(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_words, words): the word at each position. A table in the shared
    folder, one row for each row of ``docs``."""
    found = docs.select(
        "doc_id", text_hash(F.col("text")).alias("text_key"), ascii_words(F.col("text")).alias("words")
    )
    return settle(found.withColumn("n_words", F.size("words").cast("long")))


def postings(index: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc_id, text_key, place) of all occurrences of some ``terms``, a stored table.

    Spark sends the terms to all tasks if their table is small, and else sorts both sides.
    """
    places = index.select("doc_id", "text_key", F.posexplode("words").alias("place", "term"))
    return settle(places.join(terms, "term").select("term", "doc_id", "text_key", "place"))


def _in_context(index: DataFrame, listed: DataFrame, span: int) -> DataFrame:
    """(doc_id, text_key, place, term, around) of all places listed.

    Words move as one string, which takes less room than an array; no word holds a space."""
    places = listed.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))
    texts = index.select("doc_id", "text_key", F.array_join("words", " ").alias("content"))
    # Split as an argument of ``transform``, once a text and not once a place.
    at = F.transform(
        F.array(F.split("content", " ")),
        lambda words: F.transform(
            F.col("places"), lambda p: F.struct(p.alias("place"), _around(words, p, span).alias("around"))
        ),
    )
    found = texts.join(places, same_document(texts, places)).select(
        texts["doc_id"], texts["text_key"], F.explode(F.flatten(at)).alias("at")
    )
    return found.select(
        "doc_id", "text_key", "at.place", "at.around", F.get("at.around", F.lit(span - 1)).alias("term")
    )


def _around(words: Column, place: Column, span: int) -> Column:
    """The words from ``span`` - 1 before a place to as many after it, null outside."""
    return F.transform(
        F.sequence(F.lit(1 - span), F.lit(span - 1)), lambda d: F.get(words, place + d)
    )


def anchors(
    index: DataFrame, benchmark: DataFrame, span: int = WINDOW, unnamed: bool = False
) -> DataFrame:
    """(term, item_id, context, length): the rarest term of every window and its neighbours.

    Rarest by its count over all documents; ties go to the smaller term and place. Texts
    that share an id have windows of their own. Items without an id count if ``unnamed``.
    """
    counts = index.select(F.explode("words").alias("term")).groupBy("term").count()
    items = (
        (benchmark if unnamed else benchmark.filter("item_id IS NOT NULL"))
        .select("item_id", ascii_words(F.col("text")).alias("words"))
        .filter(F.size("words") > 0)
        .distinct()
    )
    length = F.least(F.size("words"), F.lit(span))
    starts = F.sequence(F.lit(0), F.size("words") - length)
    content = F.sha2(F.array_join("words", " ").cast("binary"), 256).alias("content")
    windows = items.select(
        "item_id", content, "words", length.alias("length"), F.explode(starts).alias("start")
    )
    places = windows.select(
        "*", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("place")
    ).withColumn("term", F.get("words", F.col("place")))
    rank = F.struct(F.coalesce("count", F.lit(0)).alias("n"), "term", "place")
    return (
        places.join(counts, "term", "left")
        .withColumn("around", _around(F.col("words"), F.col("place"), span))
        .groupBy("item_id", "content", "start", "length")
        .agg(F.min_by(F.struct("term", "around"), rank).alias("best"))
        .select(
            F.col("best.term").alias("term"),
            "item_id",
            F.col("best.around").alias("context"),
            "length",
        )
        .distinct()
    )


def matches(
    index: DataFrame,
    benchmark: DataFrame,
    span: int = WINDOW,
    near: float = NEAR,
    unnamed: bool = False,
) -> DataFrame:
    """(doc_id, text_key, item_id, kind, first, last): places of exact and proximity matches.

    ``first`` and ``last`` are word positions; an exact match is a run of words that equal an
    item's around one anchor, and so overlaps the run around the next.
    """
    found = settle(anchors(index, benchmark, span, unnamed))
    listed = postings(index, found.select("term").distinct())
    # A term with more than its share of places is dealt out, its windows copied to each part.
    heavy = F.broadcast(heavy_keys(listed.groupBy("term").agg(F.count("*").alias("n")), ["term"]))
    parts = F.coalesce("parts", F.lit(1))
    part = F.pmod(F.xxhash64("doc_id", "text_key", "place"), parts).cast("int")
    dealt = _in_context(index, listed, span).join(heavy, "term", "left").withColumn("part", part).drop("parts")
    copied = (
        found.join(heavy, "term", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("parts")
    )
    equal = F.zip_with("around", "context", lambda x, y: F.coalesce(x == y, F.lit(False)))
    run = lambda part: F.when(
        F.array_position(part, F.lit(False)) == 0, F.lit(span - 1)
    ).otherwise(F.array_position(part, F.lit(False)) - 1)
    shared = F.size(F.array_intersect(F.array_compact("around"), F.array_compact("context")))
    joined = (
        dealt.join(copied, ["term", "part"])
        .withColumn("equal", equal)
        .withColumn("left", run(F.reverse(F.slice("equal", 1, span - 1))).cast("int"))
        .withColumn("right", run(F.slice("equal", span + 1, span - 1)).cast("int"))
        .withColumn("exact", F.col("left") + F.col("right") + 1 >= F.col("length"))
        .filter(F.col("exact") | (shared >= near * F.size(F.array_distinct(F.array_compact("context")))))
    )
    return joined.select(
        "doc_id",
        "text_key",
        "item_id",
        F.when(F.col("exact"), "exact").otherwise("proximity").alias("kind"),
        F.when(F.col("exact"), F.col("place") - F.col("left")).otherwise(F.col("place")).alias("first"),
        F.when(F.col("exact"), F.col("place") + F.col("right")).otherwise(F.col("place")).alias("last"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, span: int = WINDOW, unnamed: bool = False
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated, n_near).

    A row for each row of ``docs``. ``n_hit`` counts the words inside any occurrence of a
    window, ``n_near`` the items with a proximity match only. A null or empty text has no
    words; neither has an item, which then occurs nowhere. Items without an id are left out; if ``unnamed``, they count
    as one item that ``items_sha256`` doesn't list.
    Equal texts with equal ids are searched together and give equal rows.
    """
    index = positional_index(docs)
    found = settle(matches(index, benchmark, span, unnamed=unnamed).distinct())
    key = ["doc_id", "text_key"]
    exact = found.filter("kind = 'exact'")
    before = Window.partitionBy(*key).orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    hit = (
        exact.groupBy(*key, "first")
        .agg(F.max("last").alias("last"))
        .withColumn("seen", F.coalesce(F.max("last").over(before), F.lit(-1)))
        .withColumn("new", F.greatest(F.lit(0), F.col("last") - F.greatest("first", F.col("seen") + 1) + 1))
        .groupBy(*key)
        .agg(F.sum("new").alias("n_hit"))
    )
    items = (
        found.groupBy(*key, "item_id")
        .agg(F.bool_or(F.col("kind") == "exact").alias("exact"))
        .groupBy(*key)
        .agg(
            F.count_if("exact").alias("n_items"),
            F.count_if(~F.col("exact")).alias("n_near"),
            F.collect_list(F.when(F.col("exact"), F.col("item_id").cast("string"))).alias("ids"),
        )
    )
    a, b, c = index.alias("a"), items.alias("b"), hit.alias("c")
    on = lambda x, y: (
        F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id"))
        & (F.col(f"{x}.text_key") == F.col(f"{y}.text_key"))
    )
    joined = b.join(c, on("b", "c"), "left").select("b.*", "n_hit").alias("d")
    ids = F.array_join(F.sort_array(F.coalesce("ids", F.array().cast("array<string>"))), ",")
    zero = F.lit(0).cast("long")
    return a.join(joined, on("a", "d"), "left").select(
        "a.doc_id",
        "a.text_key",
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
        F.coalesce("n_near", zero).alias("n_near"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = WINDOW) -> DataFrame:
    """The documents that hold no window of the benchmark, with all their columns.

    Items without an id count like any.
    """
    index = positional_index(docs)
    found = matches(index, benchmark, span, unnamed=True).filter("kind = 'exact'")
    bad = settle(found.select("doc_id", "text_key").distinct())
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        "doc_id",
        text_hash(F.col("text")).alias("text_key"),
    )
    return rows.join(bad, same_document(rows, bad), "left_anti").select("row.*")
