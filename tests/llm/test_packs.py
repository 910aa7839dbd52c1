"""Packs of vectors: near ones lie together, and far ones are never paired."""

import numpy as np

from floodplan.llm import covertree


def clusters(spark, n, size, dim=24):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(n, dim))
    data = np.repeat(centres, size, axis=0) + rng.normal(size=(n * size, dim)) * 0.01
    rows = [(i, [float(x) for x in v], 1, 7) for i, v in enumerate(data)]
    # Columns of the result's own names, with other contents.
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links int")


def test_far_clusters_make_no_pairs(spark):
    vectors = clusters(spark, 12, 60).selectExpr(
        "vec_id AS id", "1L AS copies", "label", "size(embedding) AS dim", "embedding AS vector"
    )
    packs = covertree.settle(covertree._packs(vectors, 64))
    held = packs.select("pack", "ids").collect()
    near = covertree.near_packs(packs, 0.2).collect()
    assert sorted(i for r in held for i in r.ids) == list(range(720))
    assert len(near) == len({(r.pack_a, r.pack_b) for r in near})
    cluster = {r.pack: {i // 60 for i in r.ids} for r in held}
    assert all(cluster[r.pack_a] & cluster[r.pack_b] for r in near)
    paired = {(r.pack_a, r.pack_b) for r in near}
    for a in cluster:
        for b in cluster:
            assert a > b or not cluster[a] & cluster[b] or (a, b) in paired


def test_clusters_are_components(spark):
    found = covertree.embedding_components(clusters(spark, 10, 40), pack=16).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == [
        (i, 39, i // 40 * 40, i % 40 == 0) for i in range(400)
    ]


def test_a_tree_survives_being_kept():
    points = covertree.unit(np.random.default_rng(5).normal(size=(90, 6)))
    tree = covertree.CoverTree(points)
    again = covertree.CoverTree.kept(tree.points, *tree.flat())
    pairs = {tuple(p) for p in np.transpose(covertree.candidates(again, again, 0.7))}
    near = np.transpose((covertree.chords(tree.points, tree.points) <= 0.7).nonzero())
    assert {tuple(p) for p in near} <= pairs
    assert pairs == {tuple(p) for p in np.transpose(covertree.candidates(tree, tree, 0.7))}
