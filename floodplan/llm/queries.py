"""One query for each operator of this package, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodplan.llm import binary, chat, covertree, decontaminate, fingerprints, language, licences
from floodplan.llm import pieces, quality, repair, search, secrets, simhash
from floodplan.llm.text import small_batches

PIECES, RANKS = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark, sf_dir):
    small_batches(spark)
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


def op2_licences(spark, sf_dir):
    return licences.licence_scan(_table(spark, sf_dir, "documents")).drop("licences")


def op3_pieces(spark, sf_dir):
    """Every document's pieces as a digest, and whether they decode to its text."""
    small_batches(spark)
    found = pieces.encode_documents(_table(spark, sf_dir, "documents"), vocabulary(PIECES))
    return found.select("doc_id", "n_tokens", pieces.digest(F.col("ids")).alias("ids_sha256"), "exact")


def op4_embeddings(spark, sf_dir):
    small_batches(spark)
    return covertree.embedding_components(_table(spark, sf_dir, "embeddings"))


def op5_decontamination(spark, sf_dir):
    docs, benchmark = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contamination(docs, benchmark, unnamed=True).drop("text_key", "n_near")


def op6_chat(spark, sf_dir):
    return chat.chat_texts(_table(spark, sf_dir, "conversations"))


def op7_quality(spark, sf_dir):
    small_batches(spark)
    docs, labels = (_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.quality_scores(docs, labels)


def op8_secrets(spark, sf_dir):
    return secrets.secret_report(_table(spark, sf_dir, "documents"))


def op9_training_order(spark, sf_dir):
    small_batches(spark)
    return binary.training_order(_table(spark, sf_dir, "documents"), vocabulary(RANKS))


def op10_language(spark, sf_dir):
    small_batches(spark)
    return language.language_id(_table(spark, sf_dir, "documents"))


def op11_repair(spark, sf_dir):
    return repair.repair_report(_table(spark, sf_dir, "conversations"))


def op12_search(spark, sf_dir):
    small_batches(spark)
    return search.ranked(*(_table(spark, sf_dir, t) for t in ("documents", "benchmark")))


def op13_fingerprints(spark, sf_dir):
    small_batches(spark)
    return fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_simhash,
            op2_licences,
            op3_pieces,
            op4_embeddings,
            op5_decontamination,
            op6_chat,
            op7_quality,
            op8_secrets,
            op9_training_order,
            op10_language,
            op11_repair,
            op12_search,
            op13_fingerprints,
        )
    }


WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)


#: Rows after damage, their faults, then from the last row to the first the cheapest edits
#: from each grammar state as (cost, letters); a list's least struct is the cheapest, ties
#: by letters.
REPAIR_SQL = """
    WITH RECURSIVE h AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
        FROM conversations
    ),
    bits AS (
        SELECT name, n, v FROM (SELECT DISTINCT name, length(name) AS size FROM h), LATERAL (SELECT 0) t(n),
            LATERAL (SELECT 4294967295) u(v)
        UNION ALL
        SELECT name, n + 1, list_reduce([xor(v, ascii(name[n + 1])), 1, 2, 3, 4, 5, 6, 7, 8],
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
        FROM bits WHERE n < length(name)
    ),
    crc AS (SELECT name, xor(v, 4294967295) % 20 AS how FROM bits WHERE n = length(name)),
    r AS (
        SELECT conv_id, turn, CASE how WHEN 4 THEN 'user' ELSE role END AS role,
            CASE how WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
        FROM h JOIN crc USING (name), unnest(CASE how WHEN 3 THEN [0, 1] ELSE [0] END) t(copy) WHERE how <> 0
    ),
    s AS (
        SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again
        FROM r
    ),
    f AS (
        SELECT *, left(role, 1) AS c, body = '' AS blank, body <> '' AND again > 1 AS duplicate,
            body <> '' AND again = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
        FROM s
    ),
    way AS (
        SELECT conv_id, max(i) + 1 AS i, {'c': 0, 'a': ''} AS q0, {'c': 10, 'a': 'II'} AS q1,
            {'c': 5, 'a': 'I'} AS q2, {'c': 0, 'a': ''} AS q3
        FROM f GROUP BY conv_id
        UNION ALL
        SELECT conv_id, i,
            list_min([b0, {'c': b2.c + 5, 'a': 'I' || b2.a}, {'c': b3.c + 10, 'a': 'II' || b3.a}]),
            list_min([b1, {'c': b2.c + 5, 'a': 'I' || b2.a}, {'c': b3.c + 10, 'a': 'II' || b3.a}]),
            list_min([b2, {'c': b3.c + 5, 'a': 'I' || b3.a}]),
            list_min([b3, {'c': b2.c + 5, 'a': 'I' || b2.a}])
        FROM (
            SELECT f.conv_id, f.i,
                list_min([{'c': q0.c + 2, 'a': 'D' || q0.a}, {'c': q2.c + 1 + x, 'a': 'R' || q2.a},
                    {'c': CASE f.c WHEN 's' THEN q1.c WHEN 'u' THEN q2.c ELSE 1000000000 END + x,
                     'a': 'K' || CASE f.c WHEN 's' THEN q1.a ELSE q2.a END}]) AS b0,
                list_min([{'c': q1.c + 2, 'a': 'D' || q1.a}, {'c': q2.c + 1 + x, 'a': 'R' || q2.a},
                    {'c': CASE f.c WHEN 'u' THEN q2.c ELSE 1000000000 END + x, 'a': 'K' || q2.a}]) AS b1,
                list_min([{'c': q2.c + 2, 'a': 'D' || q2.a}, {'c': q3.c + 1 + x, 'a': 'R' || q3.a},
                    {'c': CASE f.c WHEN 'a' THEN q3.c ELSE 1000000000 END + x, 'a': 'K' || q3.a}]) AS b2,
                list_min([{'c': q3.c + 2, 'a': 'D' || q3.a}, {'c': q2.c + 1 + x, 'a': 'R' || q2.a},
                    {'c': CASE f.c WHEN 'u' THEN q2.c ELSE 1000000000 END + x, 'a': 'K' || q2.a}]) AS b3
            FROM way JOIN (
                SELECT *, CASE WHEN blank OR duplicate THEN 1000000000 WHEN truncated THEN 5 ELSE 0 END AS x FROM f
            ) f ON f.conv_id IS NOT DISTINCT FROM way.conv_id AND f.i = way.i - 1
        )
    ),
    best AS (SELECT conv_id, q0.c AS cost, q0.a AS audit FROM way WHERE i = 1),
    walk AS (
        SELECT conv_id, audit, 1 AS p, 0 AS i, 0 AS q, '' AS letter, NULL::VARCHAR AS role, NULL::VARCHAR AS text
        FROM best
        UNION ALL
        SELECT w.conv_id, audit, p + 1, w.i + (audit[p] <> 'I')::INT,
            CASE WHEN audit[p] = 'D' THEN q WHEN audit[p] = 'K' AND f.c = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END,
            audit[p],
            CASE WHEN audit[p] = 'K' THEN f.role WHEN q = 2 THEN 'assistant' ELSE 'user' END,
            CASE WHEN audit[p] = 'I' THEN '' ELSE f.text END
        FROM walk w LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
        WHERE p <= length(audit)
    ),
    mended AS (
        SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY p) AS lines
        FROM walk WHERE letter IN ('K', 'R', 'I') GROUP BY conv_id
    ),
    counts AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
            count(*) FILTER (truncated) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM f GROUP BY conv_id
    )
    SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
        coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
        coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) e
    LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM e.conv_id
    LEFT JOIN mended ON mended.conv_id IS NOT DISTINCT FROM e.conv_id"""

SEARCH_SQL = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS_SQL} AS w FROM documents),
    total AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0),
    i AS (SELECT DISTINCT item_id, text FROM benchmark),
    t AS (
        SELECT DISTINCT item_id, text, term FROM (SELECT item_id, text, unnest({WORDS_SQL}) AS term FROM i)
    ),
    p AS (
        SELECT r, doc_id, len(w)::BIGINT AS n, term, count(*)::BIGINT AS tf
        FROM (SELECT r, doc_id, w, unnest(w) AS term FROM d)
        WHERE term IN (SELECT term FROM t) GROUP BY ALL
    ),
    weight AS (
        SELECT term, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
        FROM p, total GROUP BY term, n_docs
    ),
    scored AS (
        SELECT item_id, text, r, doc_id,
            sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_words))))::BIGINT AS score
        FROM t JOIN p USING (term) JOIN weight USING (term), total GROUP BY item_id, text, r, doc_id
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS place
        FROM scored WHERE score > 0
    )
    SELECT item_id, place::INT AS rank, doc_id, score FROM placed WHERE place <= 10"""

FINGERPRINT_SQL = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r FROM documents
    ),
    e AS (
        SELECT a.doc_id, a.r, b.r AS next_r, a.t, length(a.t) AS n,
            left(a.t, length(a.t) - length(a.t) // 4) || left(b.t, length(a.t) // 4) AS edited
        FROM d a JOIN d b ON b.r = a.r % (SELECT count(*) FROM d) + 1
    ),
    line AS (
        SELECT r, 0 AS v, unnest(string_split(t, chr(10))) AS p FROM e
        UNION ALL SELECT r, 1, unnest(string_split(edited, chr(10))) FROM e
    ),
    strong AS (
        SELECT r, v, k, sum(('0x' || substr(h, 1 + 8 * k, 8))::BIGINT) % 4294967296 AS lane
        FROM (SELECT r, v, sha256(p) AS h FROM line), unnest(range(8)) t(k) GROUP BY r, v, k
    ),
    run AS (
        SELECT r, v, ('0x' || left(h, 16))::UBIGINT AS high, ('0x' || right(h, 16))::UBIGINT AS low
        FROM (
            SELECT r, v, md5(array_to_string(w[greatest(1, j - 2) : j], ' ')) AS h
            FROM (SELECT r, v, regexp_extract_all(p, '[^\x20\x09-\x0D]+') AS w FROM line),
                unnest(range(1, len(w) + 1)) t(j)
        )
    ),
    sign AS (
        SELECT r, v, 8 + k AS k, sum(2 * ((CASE WHEN k < 64 THEN high ELSE low END >> (63 - k % 64)) & 1)::BIGINT - 1)::BIGINT
            AS lane
        FROM run, unnest(range(128)) t(k) GROUP BY r, v, k
    ),
    place AS (SELECT r, v, k FROM e, unnest([0, 1]) s(v), unnest(range(136)) t(k)),
    lane AS (
        SELECT r, v, k, coalesce(strong.lane, sign.lane, 0)::BIGINT AS lane
        FROM place LEFT JOIN strong USING (r, v, k) LEFT JOIN sign USING (r, v, k)
    ),
    print AS (
        SELECT r, v, string_agg(lower(lpad(to_hex((lane + 4294967296) % 4294967296), 8, '0')), '' ORDER BY k) AS print,
            list(lane ORDER BY k) AS l
        FROM lane GROUP BY r, v
    ),
    matched AS (
        SELECT e.*, a.print AS x, b.print AS y, c.print AS z, a.l[9:] AS la, b.l[9:] AS lb, c.l[9:] AS lc
        FROM e JOIN print a ON a.r = e.r AND a.v = 0 JOIN print b ON b.r = e.r AND b.v = 1
        JOIN print c ON c.r = e.next_r AND c.v = 0
    ),
    near AS (
        SELECT *,
            list_sum(list_transform(list_zip(la, lb), lambda p: p[1] * p[2]))::BIGINT AS dot_e,
            list_sum(list_transform(list_zip(la, lc), lambda p: p[1] * p[2]))::BIGINT AS dot_n,
            list_sum(list_transform(list_zip(la, lb), lambda p: p[1] * p[1] + p[2] * p[2]))::BIGINT AS sq_e,
            list_sum(list_transform(list_zip(la, lc), lambda p: p[1] * p[1] + p[2] * p[2]))::BIGINT AS sq_n
        FROM matched
    )
    SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, x AS fingerprint, y AS edited_fingerprint,
        CASE WHEN sq_e = 0 THEN (x = y)::INT::DOUBLE
            ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, (2 * dot_e)::DOUBLE / sq_e)) END AS near_edited,
        CASE WHEN sq_n = 0 THEN (x = z)::INT::DOUBLE
            ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE, (2 * dot_n)::DOUBLE / sq_n)) END AS near_next
    FROM near"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of those queries that SQL can express."""
    return {
        "op4_embeddings": """
            WITH RECURSIVE v AS (
                SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
                WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            ),
            link AS (
                SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
                ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
                WHERE list_cosine_similarity(a.e, b.e) >= 0.98
            ),
            reach AS (
                SELECT vec_id AS a, vec_id AS b FROM embeddings
                UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
            ),
            lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
            SELECT a AS vec_id, (SELECT count(*) FROM link WHERE link.a = lowest.a) AS n_links,
                component_id, a = component_id AS kept
            FROM lowest""",
        "op5_decontamination": f"""
            WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
            i AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
            win AS (
                SELECT DISTINCT item_id, least(10, len(w)) AS n, w[s : s + least(10, len(w)) - 1] AS win
                FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(s) WHERE len(w) > 0
            ),
            dwin AS (
                SELECT doc_id, n, s, w[s : s + n - 1] AS win
                FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) t(s)
            ),
            hit AS (SELECT doc_id, item_id, s, n FROM dwin JOIN win USING (n, win)),
            items AS (
                SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
                FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
            ),
            words AS (
                SELECT doc_id, count(DISTINCT p) AS n_hit
                FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id
            )
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
                coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
                coalesce(n_hit, 0) > 0 AS contaminated
            FROM d LEFT JOIN items USING (doc_id) LEFT JOIN words USING (doc_id)""",
        "op6_chat": f"""
            WITH c AS (
                SELECT conv_id, list({{'r': role, 't': text}} ORDER BY turn) AS turns
                FROM conversations GROUP BY conv_id
            ),
            shorter AS (
                SELECT DISTINCT turns[1 : n] AS turns FROM c, unnest(range(1, len(turns))) t(n)
            ),
            whole AS (
                SELECT turns, min(conv_id) AS conv_id, count(*) AS n_equal FROM c GROUP BY turns
            )
            SELECT conv_id, len(turns)::BIGINT AS n_turns, n_equal,
                list_aggregate(
                    list_transform(turns, lambda x: '{chat.START}' || replace(x.r, '<|', '< |') || chr(10)
                        || replace(x.t, '<|', '< |') || '{chat.END}' || chr(10)),
                    'string_agg', '') AS chat
            FROM whole ANTI JOIN shorter USING (turns)""",
        "op11_repair": REPAIR_SQL,
        "op12_search": SEARCH_SQL,
        "op13_fingerprints": FINGERPRINT_SQL,
    }
