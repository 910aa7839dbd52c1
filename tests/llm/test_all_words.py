"""Language of texts by all words counted, against a model without bounds."""

import pytest

from floodplan.llm import language

MANY = 10**6


@pytest.mark.parametrize("sent", [0, 5, 60_000])
def test_no_word_is_left_out(spark, sent):
    rows = [(r.doc_id, r.text[:400], r.lang) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()]
    rows += [(None, None, "en"), (9001, "", "fr"), (9002, "12 !", None), (9003, "zzqx \u0416\u0416", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(table.filter(~language.held_out(table.doc_id)), MANY, MANY)
    guess = language.predictor(spark, model)("text")
    want = {r.doc_id: r.g for r in table.select("doc_id", guess.alias("g")).collect()}
    found = language.language_id(table, sent).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.lang_pred == want[r.doc_id].lang
        assert r.score == pytest.approx(want[r.doc_id].score, abs=1e-6)


def test_a_rare_language_keeps_its_words(spark, monkeypatch):
    """The words of a small language count, however many more frequent ones another has."""
    monkeypatch.setattr(language, "WORDS", 50)
    monkeypatch.setattr(language, "GRAMS", 50)
    ids = [r.i for r in spark.range(400).filter(~language.held_out(language.F.col("id"))).select(language.F.col("id").alias("i")).collect()]
    big = " ".join(f"{a}{b}{c}o" for a in "bcdfg" for b in "aeiou" for c in "klmnp")
    rows = [(i, big, "big") for i in ids[:200]] + [(ids[200], "bakoh cemoh", "small")]
    held = next(i for i in range(1000, 1100) if i not in ids and spark.range(i, i + 1).filter(language.held_out(language.F.col("id"))).count())
    table = spark.createDataFrame([*rows, (held, "bakoh cemoh", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.language_id(table, 50).collect()}
    assert found[held] == found[ids[200]] == "small"
