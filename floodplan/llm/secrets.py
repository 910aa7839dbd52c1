"""Secrets in texts, and weak credential parts that only count together.

Assignments, access identifiers and long hex strings are secrets by themselves. A user or
client name, or an unmarked key, is only a candidate: it is reported if its complement (for
a name a secret, for a key an identifier or an endpoint) stands within the same scope. The
two are linked by an interval join on bins as wide as the scope.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from floodplan.llm.text import text_hash
from floodplan.session import settle

#: Code points within which complementary parts count as one credential.
SCOPE = 200
MASK = "[SECRET]"
#: Code points of a block from which a masked text is put together.
BLOCK = 1000


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Group that must have ``least`` characters.
    group: int
    least: int
    #: Secret by itself.
    base: bool
    #: What it is for its complement.
    role: str


#: Patterns and lengths of the contract's three kinds, in its order, then
#: those of parts.
KINDS = (
    Kind(
        "assign",
        r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        True,
        "secret",
    ),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20, True, "identifier"),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, True, "secret"),
    Kind(
        "name",
        r"""((?i)client_?id|user_?name|user_?id|login|account_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""",
        2,
        3,
        False,
        "identifier",
    ),
    Kind("key", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}", 0, 32, False, "secret"),
    Kind("endpoint", r"""[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+""", 0, 8, False, "endpoint"),
)
#: A text without any of these has nothing to report.
HINT = (
    r"""(?i)password|passwd|secret|token|api_?key|akia|[0-9a-f]{24}|client_?id|user_?name|"""
    r"""user_?id|login|account_?id|://"""
)


def _matches(kind: Kind, number: int) -> Column:
    """The matches of a kind as (kind, k, gap, length, checked): code points before each
    since the last one, of the whole and of the group that is checked."""
    pattern = F.lit(kind.pattern)
    pieces = F.split("text", kind.pattern, -1)
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    group = F.regexp_extract_all("text", pattern, F.lit(kind.group))
    return F.transform(
        F.arrays_zip(whole.alias("w"), group.alias("g"), F.slice(pieces, 1, F.size(whole)).alias("p")),
        lambda m, k: F.struct(
            F.lit(number).alias("kind"),
            k.alias("k"),
            F.length(m["p"]).alias("gap"),
            F.length(m["w"]).alias("length"),
            F.length(m["g"]).alias("checked"),
        ),
    )


def _scanned(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text_key, found), a settled table with a row for each row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_hash(F.col("text")).alias("text_key"))
    found = F.when(
        F.col("text").rlike(HINT), F.concat(*[_matches(kind, i) for i, kind in enumerate(KINDS)])
    )
    return settle(
        rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text_key", found.alias("found"))
    )


def _spans(scanned: DataFrame) -> DataFrame:
    """(rid, kind, start, end) of all that is long enough, base or not."""
    each = scanned.select("rid", F.inline("found"))
    order = Window.partitionBy("rid", "kind").orderBy("k")
    end = F.sum(F.col("gap") + F.col("length")).over(order)
    least = F.lit(0)
    for i, kind in enumerate(KINDS):
        least = F.when(F.col("kind") == i, kind.least).otherwise(least)
    return (
        each.withColumn("end", end)
        .filter(F.col("checked") >= least)
        .select("rid", "kind", (F.col("end") - F.col("length")).alias("start"), "end")
    )


def _is(test) -> Column:
    return F.col("kind").isin([i for i, kind in enumerate(KINDS) if test(kind)])


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """The weak names and keys whose complement is within the scope.

    A bin keeps the first start and last end of its spans of a role, which is all that a
    candidate needs of it; no pairs are made.
    """
    bins = lambda first, last: F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope)))
    offered = (
        spans.withColumn("of_secret", _is(lambda k: k.role == "secret"))
        .withColumn("bin", bins(F.col("start"), F.col("end")))
        .groupBy("rid", "of_secret", "bin")
        .agg(F.min("start").alias("low"), F.max("end").alias("high"))
    )
    before = Window.partitionBy("rid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    covered = F.max(F.when(_is(lambda k: k.base), F.col("end"))).over(before)
    weak = (
        spans.withColumn("covered", F.coalesce(covered, F.lit(0)))
        .filter(_is(lambda k: k.name in ("name", "key")) & (F.col("covered") < F.col("end")))
        .withColumn("of_secret", _is(lambda k: k.name == "name"))
        .select("*", bins(F.col("start") - scope, F.col("end") + scope).alias("bin"))
    )
    near = (F.col("low") <= F.col("end") + scope) & (F.col("high") >= F.col("start") - scope)
    return (
        weak.join(offered, ["rid", "of_secret", "bin"])
        .filter(near)
        .select("rid", "kind", "start", "end")
        .distinct()
    )


def secret_spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """A row for each row of ``docs``: doc_id, text_key and ``spans``, an array of (start,
    kind, end) in order, kind being the place in KINDS. Positions are code points, the end
    exclusive. A null text is empty and has none, as has any text without a match.
    """
    scanned = _scanned(docs)
    spans = settle(_spans(scanned))
    told = spans.filter(_is(lambda k: k.base)).union(_linked(spans, scope))
    listed = told.groupBy("rid").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )
    nothing = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return scanned.join(listed, "rid", "left").select(
        "doc_id", "text_key", F.coalesce("spans", nothing).alias("spans")
    )


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(kind.name) for kind in KINDS])
    each = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, each), ",")


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (as text); see secret_spans."""
    found = secret_spans(docs, scope)
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda n: F.size(F.filter("spans", lambda s: s["kind"] == n)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
    )


def _without(text: Column, masked: Column) -> Column:
    """A text with MASK in place of spans (start, end), sorted and apart.

    Finding a place in a text takes as long as the place is far in. So the text is cut into
    blocks once, and what lies between spans is put together from parts of blocks.
    """
    least, most = F.least, F.greatest

    def between(all: Column, i: Column) -> Column:
        spans, size = all["spans"], F.size(all["spans"])
        low = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(spans, i - 1)["end"])
        high = F.when(i == size, all["n"]).otherwise(F.get(spans, i)["start"])

        def part(block: Column) -> Column:
            first = most(low, block * BLOCK)
            count = least(high, (block + 1) * BLOCK) - first
            return F.substring(F.get(all["blocks"], block.cast("int")), (first - block * BLOCK + 1).cast("int"), count.cast("int"))

        blocks = F.sequence(F.floor(low / BLOCK), F.floor((high - 1) / BLOCK))
        return F.when(high > low, F.array_join(F.transform(blocks, part), "")).otherwise("")

    whole = F.struct(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)).alias("blocks"),
        masked.alias("spans"),
        F.length(text).cast("long").alias("n"),
    )
    # As an element of an array it is computed once, not for every span.
    return F.transform(
        F.array(whole),
        lambda all: F.array_join(F.transform(F.sequence(F.lit(0), F.size(all["spans"])), lambda i: between(all, i)), MASK),
    )[0]


def mask_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """All documents and columns, each secret in ``text`` replaced by MASK, n_chars by the
    new length. Spans that overlap or touch are masked as one. A null text stays null."""
    found = secret_spans(docs, scope).filter(F.size("spans") > 0).distinct()
    key = ("doc_id", "text_key")
    each = found.select(*key, F.explode("spans").alias("span")).select(*key, "span.start", "span.end")
    order = Window.partitionBy(*key).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.when(reached >= F.col("start"), 0).otherwise(1)
    kept = (
        each.withColumn("apart", apart)
        .withColumn("group", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*key, "group")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("masked"))
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("row_id"),
        text_hash(F.col("text")).alias("row_key"),
    )
    joined = rows.join(
        kept, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key")), "left"
    )
    text = F.col("row.text")
    clean = F.when(F.col("masked").isNotNull(), _without(text, F.col("masked"))).otherwise(text)
    new = {"text": clean, "n_chars": F.length(clean)}
    return joined.select(
        *[
            (new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`")).alias(c)
            for c in docs.columns
        ]
    )
