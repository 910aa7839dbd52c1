"""Pieces, token files, languages, quality and the pipeline."""

import random

import numpy as np
import pytest

import corpus_pipeline
from floodplan.llm import binary, language, pieces, quality
from floodplan.llm.queries import PIECES, RANKS, queries, vocabulary

SF_DIR = "/root/testdata/sf0.001"
ODD = [(1, "a"), (2, None), (3, ""), (4, "  two  spaces \n\ttab"), (5, "▁ mark 日本 \U0001f600é\x00"), (5, "x" * 900), (None, "the " * 400)]


def longest_last(model, text):
    """Pieces of the best segmentation of a marked text, ties to the longest last piece, by search."""
    best = [(0.0, (), ())]
    for j in range(1, len(text) + 1):
        ways = []
        for i in range(max(0, j - model.longest), j):
            score, piece = model.score.get(text[i:j], (None, None))
            if score is None and i == j - 1:
                char = pieces.SPACE if text[i] == pieces.LITERAL else text[i]
                score, piece = model.unknown, tuple(model.byte[b] for b in char.encode())
            if score is not None:
                total, lengths, ids = best[i]
                ways.append((total + score, (j - i, *lengths), (ids, piece)))
        best.append(max(ways, key=lambda w: w[:2]))
    found, ids = [], best[-1][2]
    while ids:
        ids, piece = ids
        found[:0] = piece if isinstance(piece, tuple) else [piece]
    return found


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(vocabulary(PIECES))


def test_best_segmentation(model):
    words = pieces.Words(model)
    random.seed(2)
    for k in range(60):
        letters = ["a", "th", " ", "  ", "é", "\n", "in", "▁", "zq"] if k % 2 else "aethin"
        text = "".join(random.choice(letters) for _ in range(random.randint(1, 150)))
        whole = pieces.marked(text, True)
        best = pieces.traced(model, whole, pieces.best_paths(model, whole, 0, len(whole))[1], 0, len(whole))
        size = random.choice([16, 23, 40])
        chunks = [
            pieces.Chunk(model, text[a : a + size + model.longest - 1], min(size, len(text) - a), a == 0)
            for a in range(0, len(text), size)
        ]
        start = np.full(model.longest, pieces.LOWEST)
        start[0] = 0.0
        ways = pieces.scan(start, [c.matrix() for c in chunks])
        states = pieces.passed([c.entries(w) for c, w in zip(chunks, ways)])
        cut = np.concatenate([c.ids(words, *s) for c, s in zip(chunks, states)])
        fast = pieces.encode_texts(words, [whole])[0]
        assert best == cut.tolist() == fast.tolist() == longest_last(model, whole)


def test_words_are_cut_where_no_piece_crosses(model):
    random.seed(10)
    for _ in range(300):
        text = pieces.marked("".join(random.choices("ab,.\n 1²é_▁\u0301ßx", k=30)), True)
        parts = pieces.split_words(model, text)
        assert "".join(parts) == text
        assert not any(a[-1] + b[0] in model.joined for a, b in zip(parts, parts[1:]))


def test_products_are_scans(model):
    random.seed(8)
    text = "".join(random.choice("ab=-") for _ in range(1500))
    chunks = [pieces.Chunk(model, text[a : a + 35], min(20, 1500 - a), a == 0) for a in range(0, 1500, 20)]
    matrices = [c.matrix() for c in chunks]
    start = np.full(model.longest, pieces.LOWEST)
    start[0] = 0.0
    whole = pieces.scan(start, [*matrices, matrices[0]])
    for cut in (1, 30, 74):
        after = (start[:, None] + pieces.product(matrices[:cut])).max(axis=0)
        assert (after - after.max() == whole[cut]).all()


def test_words_together(model):
    random.seed(9)
    letters = ["a", "b", "é", "日", "th", "ing", "=", "zq", "\n", "\U0001f600"]
    words = {"▁" + "".join(random.choices(letters, k=random.randint(0, 20))) for _ in range(800)}
    words = sorted(words)
    assert pieces.segmented(model, words) == [pieces._alone(model, w) for w in words]
    for word, ids in zip(words[:200], pieces.segmented(model, words)):
        assert np.frombuffer(ids, np.int32).tolist() == longest_last(model, word)


TIED = ["abababab" * 40, "==========-----" * 30, "x" * 500, "aaaa" * 99, "zqzqzqzqxxyy" * 40, "\n" * 300]


@pytest.mark.parametrize("chunk", [33, 50, 64, 32_768])
def test_chunks_change_nothing(spark, model, monkeypatch, chunk):
    monkeypatch.setattr(pieces, "SPAN", 3)
    texts = [*TIED, " ".join(TIED), "x y " * 200 + TIED[1]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pieces.encode_documents(table, vocabulary(PIECES), chunk=chunk).collect()}
    for k, text in enumerate(texts):
        assert found[k].exact
        assert list(found[k].ids) == longest_last(model, pieces.marked(text, True))


def test_pieces_round_trip(spark):
    import sentencepiece

    table = spark.createDataFrame([(i, t, [1]) for i, t in ODD], "doc_id long, text string, ids array<int>")
    found = pieces.encode_documents(table, vocabulary(PIECES), chunk=64).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    assert len(found) == len(ODD)
    for r in found:
        assert r.exact is (None if r.doc_id == 2 else True)
        if r.doc_id in (1, 3, 4):
            assert model.decode(r.ids) == dict(ODD)[r.doc_id]
    assert pieces.encode_documents(table.limit(0), vocabulary(PIECES)).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 100, 1025])
def test_permutation(count):
    slots = binary.feistel(np.arange(count), count)
    assert sorted(slots.tolist()) == list(range(count))
    if count > 50:
        assert slots.tolist() != list(range(count))
        assert (slots != binary.feistel(np.arange(count), count, key=1)).any()


def test_training_order(spark, tmp_path):
    table = spark.createDataFrame(ODD, "doc_id long, text string")
    kept = binary.training_order(table, vocabulary(RANKS), length=8, shard=16)
    rows = kept.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    encode = binary._encoding(vocabulary(RANKS)).encode_ordinary
    for doc, text in ODD:
        if doc in (1, 4, None):
            mine = sorted((r.sequence, bytes(r.record)) for r in rows if r.doc_id == doc)
            ids = np.frombuffer(b"".join(x for _, x in mine), np.uint16)
            assert ids[ids != binary.PAD].tolist() == encode(text)
    binary.write_shards(kept, str(tmp_path / "shards"))
    back = binary.read_from(spark, str(tmp_path / "shards"), 20, length=8, shard=16).collect()
    want = {r.slot: bytes(r.record) for r in rows if r.slot >= 20}
    assert {r.slot: bytes(r.record) for r in back} == want
    assert binary.training_order(table.limit(0), vocabulary(RANKS)).count() == 0


def test_language(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.language_id(table).toPandas().merge(table.select("doc_id", "lang").toPandas())
    held = found[found.held_out]
    assert 0.2 < len(held) / len(found) < 0.3
    assert (held.lang == held.lang_pred).mean() > 0.97


def test_language_of_odd_rows(spark):
    rows = [(0, "the cat", "en"), (1, "le chat", "fr"), (2, None, "en"), (3, "12 !", None), (4, "catx", None), (None, "chats", "fr")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(table)
    guess = table.select("doc_id", language.predictor(spark, model)("text").alias("g")).collect()
    got = {r.doc_id: r.g.lang for r in guess}
    assert (got[0], got[1], got[2], got[3], got[None]) == ("en", "fr", "und", "und", "fr")
    none = language.language_id(table.limit(0))
    assert none.count() == 0
    assert language.train(table.filter("lang IS NULL")).langs == []


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.labelled(docs, labels)
    found = quality.quality_scores(docs, labels).toPandas()
    held = rows.filter("held").select("doc_id").toPandas()
    judged = found.merge(labels.toPandas()).merge(held)
    assert ((judged.score >= 0.5) == (judged.quality == 1)).mean() > 0.93
    assert (found.kept == (found.score >= quality.KEEP)).all()


def test_quality_of_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "s", "en"), (None, "fine words here", "s", "en"), (2, "x", "s", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality_scores(docs, none).count() == 4
    some = spark.createDataFrame([(2, 1), (2, None), (None, 0), (7, 0)], "doc_id long, quality int")
    assert quality.keep_good(docs, some).columns == docs.columns
    assert quality.quality_scores(docs.limit(0), some).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = corpus_pipeline.run(spark, SF_DIR)
    ids = [r.doc_id for r in found.select("doc_id").collect()]
    assert 0.5 * docs.count() < len(ids) == len(set(ids)) <= docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "benchmark", "secrets", "tokens"]
    assert len(queries()) == 13
