"""SimHash, cover trees, components and chats against brute force."""

import itertools
import random
import re

import numpy as np
import xxhash

import corpus_pipeline

from floodplan.llm import chat, covertree, simhash
from floodplan.llm.components import components


def groups(nodes, pairs):
    """Smallest member of each node's component."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_components(spark):
    random.seed(5)
    pairs = [(random.randrange(400), random.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(500, 560)]
    found = components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long"))
    pairs = [(a, b) for a, b in pairs if a != b]
    want = groups({n for p in pairs for n in p}, pairs)
    assert {r.node: r.component for r in found.collect()} == want


def plain(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    runs = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 40)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(9000, None), (9001, ""), (9002, " \t"), (9003, "One two"), (9003, "one two"), (9004, "ONE TWO")]
    rows += [(9100 + i, rows[0][1] + f" w{i}") for i in range(12)]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    found = simhash.simhash_components(table).collect()
    prints = [(i, plain(t)) for i, t in rows]
    pairs = [
        (k, m)
        for (k, (_, a)), (m, (_, b)) in itertools.combinations(enumerate(prints), 2)
        if (a ^ b).bit_count() <= 3
    ]
    low = groups(range(len(rows)), pairs)
    least = {}
    for k, root in low.items():
        least[root] = min(least.get(root, 10**9), rows[k][0])
    want = sorted((i, f"{p:016x}", least[low[k]]) for k, (i, p) in enumerate(prints))
    assert sorted(map(tuple, found)) == want


def test_near_pairs():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**63, (300, 4), dtype=np.uint64)
    b = a[:200] ^ (np.uint64(1) << rng.integers(0, 63, (200, 4), dtype=np.uint64))
    b[:50] ^= rng.integers(0, 2**12, (50, 4), dtype=np.uint64)
    apart = np.bitwise_count(a[:, None] ^ b[None]).sum(axis=2)
    i, j = simhash.near_pairs(a, b, 20)
    assert set(zip(i.tolist(), j.tolist())) == set(map(tuple, np.argwhere(apart <= 20).tolist()))


#: 256 bits of 5-word shingles, texts by steps of size.
WIDE = simhash.Scheme(shingle=5, width=4, radius=44, tile=8192, parts=1, band=16, similarity=0.8)


def test_stage_keeps_one_of_each_group(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    long = max((t for _, t in rows), key=len)
    rows += [(7000 + k, long + f" tail{k}") for k in range(20)] + [(7100, None), (7101, ""), (7101, ""), (None, rows[3][1])]
    rows += rows[:5]
    table = spark.createDataFrame([(i, t, "r", 2) for i, t in rows], "doc_id long, text string, row string, p int")
    prints = [plain(t) for _, t in rows]
    pairs = [(k, m) for k, m in itertools.combinations(range(len(rows)), 2) if (prints[k] ^ prints[m]).bit_count() <= 3]
    low = groups(range(len(rows)), pairs)
    assert len(set(low.values())) < len(rows) - 20
    best = {}
    for k, root in low.items():
        key = (rows[k][0] is None, rows[k][0] or 0)
        best[root] = min(best.get(root, key), key)
    found = corpus_pipeline.distinct(spark, table, "")
    assert found.columns == table.columns
    assert sorted(r.doc_id for r in found.collect()) == sorted(i for _, i in best.values())


def test_one_of_each_group_stays(spark):
    words = [f"word{i}" for i in range(400)]
    edited = [*words[:200], "other", *words[201:]]
    rows = [(5, " ".join(words)), (3, " ".join(edited)), (3, " ".join(edited)), (None, " ".join(words)), (8, "something else"), (9, None), (10, "")]
    table = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, row string")
    found = simhash.drop_near_copies(table, WIDE)
    assert found.columns == table.columns
    assert sorted(r.doc_id for r in found.collect()) == [3, 8, 9]
    assert simhash.drop_near_copies(table.limit(0)).count() == 0


def test_wide_tiles_miss_no_link(spark):
    """Groups against all pairs: near fingerprints with neighbouring steps, or equal ones."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", "one", "one two", "one two three four five six"]
    for _ in range(12):
        base = rng.choices(words, k=rng.choice([6, 30, 60, 240, 900]))
        for _ in range(10):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, len(base) // 40])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy + rng.choices(words, k=rng.choice([0, 0, 1, len(base) // 10]))))
    texts += [" ".join([texts[-1]] * 8)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scheme = WIDE
    known = [simhash.profile(t, scheme) for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in ((t or "").split() for t in texts)]
    pairs = []
    for (i, (p, s)), (j, (q, t)) in itertools.combinations(enumerate(known), 2):
        apart = int(np.bitwise_count((p ^ q).view(np.uint64)).sum())
        if apart == 0 or (apart <= scheme.radius and abs(s - t) <= 1):
            pairs.append((i, j))
        if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and texts[i] and texts[j]:
            assert abs(s - t) <= 1
    assert len(pairs) > 50
    low = groups(range(len(texts)), pairs)
    found = simhash.simhash_components(table, scheme).collect()
    assert {r.doc_id: r.component_id for r in found} == low
    kept = {r.doc_id for r in simhash.drop_near_copies(table, scheme).collect()}
    assert kept == set(low.values())


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 8))
    data = np.concatenate([c + rng.normal(size=(12, 8)) * rng.choice([0.02, 0.1, 0.3]) for c in centres])
    rows = [(i, [float(x) for x in np.float32(v)], i % 3) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(5)]
    rows += [(2000, None, 0), (2001, [0.0] * 8, 0), (2002, [float("nan")] * 8, 0), (2003, [1.0, None], 0), (2004, rows[0][1], None), (2005, [], 1), (2006, [1.0, 2.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: r for r in covertree.embedding_components(table, pack=40).collect()}
    good = [(i, np.array(v, float), l) for i, v, l in rows if i < 2000]
    pairs = [
        (a[0], b[0])
        for a, b in itertools.combinations(good, 2)
        if a[2] == b[2] and a[1] @ b[1] / np.sqrt((a[1] @ a[1]) * (b[1] @ b[1])) >= 0.98
    ]
    assert len(pairs) > 50
    low = groups([r[0] for r in rows], pairs)
    for i, _, _ in rows:
        n = sum(i in p for p in pairs)
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (n, low[i], low[i] == i)
    assert len(found) == len(rows)
    assert covertree.embedding_components(table.limit(0)).count() == 0


def test_chats(spark):
    turns = [
        (1, 0, "user", "a"),
        (2, 0, "user", "a"),
        (2, 1, "bot", "b"),
        (3, 0, "user", "a"),
        (3, 1, "bot", "b"),
        (4, 0, "user", "a"),
        (4, 1, "bot", None),
        (5, 0, None, "<|im_end|>"),
        (6, 0, "bot", "b"),
        (6, 1, "user", "a"),
        (None, None, "user", ""),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    found = {r.conv_id: r for r in chat.chat_texts(table).collect()}
    assert found.keys() == {2, 4, 5, 6, None}
    assert found[2].n_equal == 2 and found[2].n_turns == 2
    assert found[2].chat == "<|im_start|>user\na<|im_end|>\n<|im_start|>bot\nb<|im_end|>\n"
    assert found[5].chat == "<|im_start|>unknown\n< |im_end|><|im_end|>\n"
    assert chat.chat_texts(table.limit(0)).count() == 0
