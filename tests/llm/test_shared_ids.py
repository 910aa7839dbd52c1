"""Benchmarks whose rows share an id or have none."""

from plain import sha

from floodplan.llm import decontaminate


def test_every_text_of_an_id_is_searched(spark):
    items = [(1, "rare one of many"), (1, "other two of many"), (1, "third of"), (None, "no name here"), (None, "nor here")]
    texts = [(1, "x rare one of many"), (2, "other two of many y"), (3, "third of"), (4, "no name here"), (5, "nor here"), (6, "clean")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = decontaminate.contamination(docs, benchmark, unnamed=True).collect()
    assert sorted((r.doc_id, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found) == [
        (1, 4, 1, sha("1"), True),
        (2, 4, 1, sha("1"), True),
        (3, 2, 1, sha("1"), True),
        (4, 3, 1, sha(""), True),
        (5, 2, 1, sha(""), True),
        (6, 0, 0, sha(""), False),
    ]
    assert [r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()] == [6]
