"""Labels that hold nothing but scaled copies of one vector."""

from floodplan.llm import covertree


def test_scaled_copies(spark):
    v = [0.3, -1.7, 0.9, 2.1]
    rows = [(10 * label + k, [2.0**k * x for x in v], label) for label, n in ((1, 2), (2, 5)) for k in range(n)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted(map(tuple, covertree.embedding_components(table).collect()))
    sizes = {1: 2, 2: 5}
    assert found == [(i, sizes[label] - 1, 10 * label, i == 10 * label) for i, _, label in rows]
    tree = covertree.CoverTree(covertree.unit(covertree.np.array([v, v, v])))
    assert sorted(tree.order.tolist()) == [0, 1, 2]
