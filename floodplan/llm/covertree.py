"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Vectors of a label lie in packs of bounded size, each among those nearest to one of the
label's pivots. A pack is a cover tree, built once: nested nets of its unit vectors with radii
that halve, in farthest-first order, so that every net is a prefix of the next. Two trees are
descended together; a pair of nodes whose distance, less both covering radii, is above the
threshold's chord is dropped with all below it. Whole packs are tested first in the same way,
by their distances from the pivots; only pairs that pass are given their vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from floodplan.llm.components import components, forest
from floodplan.session import settle

THRESHOLD = 0.98
#: Vectors in a pack, about.
PACK = 512
#: Pivots of a label, at least; large labels have the square root of the number of their packs.
#: They are the farthest apart among so many times as many drawn vectors.
PIVOTS, DRAWN = 16, 16
#: Tasks that a label's pairs of packs are dealt to.
SALTS = 32
#: What rounding may add to a distance; candidates are checked exactly afterwards.
SLACK = 1e-6
#: Vectors are compared within these; what is kept of a pack's tree.
GROUP, TREE = ["label", "dim"], ("sizes", "parents", "cover")


def usable(vector: F.Column, label: F.Column) -> F.Column:
    """Whether a vector can be linked at all."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(
        label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class CoverTree:
    """The nets of one pack. ``order`` is farthest-first; level k is order[: sizes[k]]."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        order, reach = [0], [np.inf]
        near = chords(points, points[:1])[:, 0]
        near[order] = -1.0
        while len(order) < n:
            k = int(near.argmax())
            order.append(k)
            reach.append(near[k])
            near = np.minimum(near, chords(points, points[k : k + 1])[:, 0])
            near[order] = -1.0
        self.order = np.array(order)
        self.points = points[self.order]
        reach = np.array(reach)
        radii = [2.0 / 2**k for k in range(6)]
        self.sizes = [*(max(1, int((reach > r).sum())) for r in radii), n]
        self.parents, self.cover = [], []
        between = chords(self.points, self.points)
        for size, finer in zip(self.sizes, self.sizes[1:]):
            self.parents.append(between[:finer, :size].argmin(axis=1))
        top = np.arange(n)  # the node of the level that each point lies below
        for level in range(len(self.sizes) - 1, -1, -1):
            if level < len(self.sizes) - 1:
                top = self.parents[level][top]
            radius = np.zeros(self.sizes[level])
            np.maximum.at(radius, top, between[np.arange(n), top])
            self.cover.insert(0, radius)

    @classmethod
    def kept(cls, points: np.ndarray, sizes: list[int], parents: np.ndarray, cover: np.ndarray) -> CoverTree:
        """A tree from its points in ``order`` and what ``flat`` told of it."""
        tree = cls.__new__(cls)
        tree.points, tree.sizes, tree.order = points, sizes, np.arange(len(points))
        tree.parents = np.split(parents, np.cumsum(sizes[1:])[:-1])
        tree.cover = np.split(cover, np.cumsum(sizes)[:-1])
        return tree

    def flat(self) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Sizes of the nets, parents by level and covering radii by level."""
        return self.sizes, np.concatenate(self.parents), np.concatenate(self.cover)


def candidates(a: CoverTree, b: CoverTree, chord: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in ``order``) of all pairs of points that are ``chord`` apart or nearer."""
    alive = np.ones((a.sizes[0], b.sizes[0]), bool)
    for level in range(len(a.sizes)):
        if level:
            alive = alive[np.ix_(a.parents[level - 1], b.parents[level - 1])]
        rows, columns = alive.any(axis=1).nonzero()[0], alive.any(axis=0).nonzero()[0]
        if not len(rows):
            break
        apart = chords(a.points[rows], b.points[columns])
        reach = a.cover[level][rows][:, None] + b.cover[level][columns][None, :]
        near = apart <= chord + reach + SLACK
        kept = np.zeros_like(alive)
        kept[np.ix_(rows, columns)] = near
        alive = alive & kept
    return alive.nonzero()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _nets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pivots of each label, in farthest-first order among the vectors drawn."""
    for batch in batches:
        found = []
        for i in range(len(batch)):
            raw = _matrix(batch.column("drawn")[i].values, batch.column("dim")[i].as_py())
            points, chosen = unit(raw), [0]
            near = chords(points, points[:1])[:, 0]
            while len(chosen) < batch.column("wanted")[i].as_py() and near.max() > SLACK:
                chosen.append(int(near.argmax()))
                near = np.minimum(near, chords(points, points[chosen[-1] :][:1])[:, 0])
            found.append(raw[chosen].ravel())
        columns = [batch.column("label"), batch.column("dim"), pa.array(found, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["label", "dim", "pivots"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every vector with the number of its nearest pivot, equal ones by the smaller number."""
    for batch in batches:
        for i in range(len(batch)):
            at = {name: batch.column(name)[i] for name in batch.schema.names}
            dim = at["dim"].as_py()
            vectors = _matrix(at["vectors"].values, dim)
            cell = chords(unit(vectors), unit(_matrix(at["pivots"].values, dim))).argmin(axis=1)
            n = len(vectors)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * dim, pa.int32()), at["vectors"].values)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at["label"].as_py()] * n, batch.column("label").type),
                    pa.array(np.full(n, dim), pa.int32()),
                    pa.array(cell, pa.int32()),
                    at["ids"].values,
                    at["copies"].values,
                    rows,
                ],
                ["label", "dim", "cell", "id", "copies", "vector"],
            )


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs in the order of their trees, these trees, and the smallest and largest distance
    of each pack from its label's pivots."""
    for batch in batches:
        found: dict[str, list] = {n: [] for n in ("ids", "copies", "vectors", *TREE, "low", "high")}
        for i in range(len(batch)):
            at = {name: batch.column(name)[i] for name in batch.schema.names}
            dim = at["dim"].as_py()
            raw = _matrix(at["vectors"].values, dim)
            points = unit(raw)
            tree = CoverTree(points)
            apart = chords(points, unit(_matrix(at["pivots"].values, dim)))
            values = (
                at["ids"].values.to_numpy()[tree.order],
                at["copies"].values.to_numpy()[tree.order],
                raw[tree.order].ravel(),
                *tree.flat(),
                apart.min(axis=0),
                apart.max(axis=0),
            )
            for name, value in zip(found, values):
                found[name].append(value)
        whole = {"ids", "copies", "sizes", "parents"}
        columns = [
            pa.array(values, pa.list_(pa.int64() if name in whole else pa.float64()))
            for name, values in found.items()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("dim"), *columns], ["label", "dim", *found]
        )


def _compare(threshold: float):
    chord = float(np.sqrt(2.0 - 2.0 * threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for i in range(len(batch)):
                at = {name: batch.column(name)[i] for name in batch.schema.names}
                dim, same = at["dim"].as_py(), at["same"].as_py()
                sides = []
                for end in "ab":
                    if end == "b" and same:
                        sides.append(sides[0])
                        break
                    raw = _matrix(at[f"vectors_{end}"].values, dim)
                    ids, copies, sizes, parents, cover = (
                        at[f"{name}_{end}"].values.to_numpy() for name in ("ids", "copies", *TREE)
                    )
                    tree = CoverTree.kept(unit(raw), sizes.tolist(), parents, cover)
                    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
                    norms = np.sqrt((raw * raw).sum(axis=1))
                    sides.append((tree, raw, norms, ids, copies))
                (ta, va, na, ia, ca), (tb, vb, nb, ib, cb) = sides
                p, q = candidates(ta, tb, chord)
                cosine = (va[p] * vb[q]).sum(axis=1) / (na[p] * nb[q])
                good = (cosine >= threshold) & ~((p == q) if same else np.zeros(len(p), bool))
                if not good.any():
                    continue
                close = np.zeros((len(ia), len(ib)), bool)
                close[p[good], q[good]] = True
                a, b = forest(ia, ib, p[good], q[good])
                found.append((a, b, np.zeros(len(a), np.int64)))
                nothing = np.full(len(ia), -1)
                found.append((ia, nothing, close @ cb))
                if not same:
                    found.append((ib, np.full(len(ib), -1), ca @ close))
            columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["a", "b", "partners"]
            )

    return run


def _grouped(vectors: DataFrame, by: list[str], pivots: DataFrame) -> DataFrame:
    """One row a group: its ids, copies, vectors end to end, and its label's pivots."""
    return (
        vectors.groupBy(*by)
        .agg(F.collect_list(F.struct("id", "copies", "vector")).alias("rows"))
        .join(pivots, GROUP)
        .select(
            *GROUP,
            F.col("rows.id").alias("ids"),
            F.col("rows.copies").alias("copies"),
            F.flatten("rows.vector").alias("vectors"),
            "pivots",
        )
    )


def _packs(vectors: DataFrame, pack: int) -> DataFrame:
    """Distinct vectors (id, copies) as packs: trees, with their distances from pivots."""
    label = dict(vectors.dtypes)["label"]
    order = F.xxhash64("id", F.lit(1))
    sized = vectors.groupBy(*GROUP).agg(F.ceil(F.count("*") / pack).alias("parts"))
    dealt = vectors.join(sized, GROUP).withColumn("part", F.pmod(order, F.col("parts")))
    wanted = F.greatest(F.lit(PIVOTS), F.ceil(F.sqrt("parts")))
    bucket = F.pmod(F.xxhash64("id"), DRAWN * wanted)
    drawn = (
        dealt.groupBy(*GROUP, wanted.cast("int").alias("wanted"), bucket.alias("bucket"))
        .agg(F.min_by("vector", F.struct(order, "id")).alias("vector"))
        .groupBy(*GROUP, "wanted")
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "vector"))).alias("found"))
        .select(*GROUP, "wanted", F.flatten("found.vector").alias("drawn"))
    )
    pivots = settle(drawn.mapInArrow(_nets, f"label {label}, dim int, pivots array<double>"))
    schema = f"label {label}, dim int, cell int, id long, copies long, vector array<double>"
    celled = settle(_grouped(dealt, [*GROUP, "part"], pivots).mapInArrow(_cells, schema))
    cells = celled.groupBy(*GROUP, "cell").agg(F.ceil(F.count("*") / pack).alias("parts"))
    near = celled.join(cells, [*GROUP, "cell"]).withColumn("part", F.pmod(order, F.col("parts")))
    schema = (
        f"label {label}, dim int, ids array<long>, copies array<long>, vectors array<double>, "
        "sizes array<long>, parents array<long>, cover array<double>, low array<double>, high array<double>"
    )
    found = _grouped(near, [*GROUP, "cell", "part"], pivots).mapInArrow(_trees, schema)
    return found.withColumn("pack", F.monotonically_increasing_id())


def near_packs(packs: DataFrame, chord: float) -> DataFrame:
    """(pack_a, pack_b) of a label that may hold vectors ``chord`` apart, each pair once.

    Only the distances from pivots are compared here, in parts of a label."""
    short = packs.select(*GROUP, "pack", "low", "high")
    a, b = (short.toDF(*GROUP, *[f"{c}_{end}" for c in ("pack", "low", "high")]) for end in "ab")
    a = a.withColumn("salt", F.pmod(F.xxhash64("pack_a"), F.lit(SALTS)))
    b = b.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    apart = F.exists(
        F.arrays_zip("low_a", "high_a", "low_b", "high_b"),
        lambda d: (d["low_a"] > d["high_b"] + chord + SLACK) | (d["low_b"] > d["high_a"] + chord + SLACK),
    )
    pairs = a.join(b, [*GROUP, "salt"]).filter((F.col("pack_a") <= F.col("pack_b")) & ~apart)
    return pairs.select("pack_a", "pack_b")


def embedding_components(
    vectors: DataFrame, threshold: float = THRESHOLD, pack: int = PACK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors``.

    Rows (vec_id, embedding, label) are compared when labels are equal and vectors have as
    many components. A null, zero or empty vector, one with a null or non-finite component
    and one without a label link with nothing. Equal vectors are compared once and counted
    as often as they occur. Repeated vec_ids are rows of their own. A null vec_id names a
    component only if that has no other.
    """
    chord = float(np.sqrt(2.0 - 2.0 * threshold))
    rows = vectors.select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("vector"),
        "label",
        F.size("embedding").alias("dim"),
        usable(F.col("embedding"), F.col("label")).alias("usable"),
    )
    group = [*GROUP, "vector"]
    good = rows.filter("usable").select("vec_id", *group)
    distinct = settle(
        good.groupBy(*group)
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    packs = settle(_packs(distinct.drop("first_id"), pack))
    held = ("pack", "vectors", "ids", "copies", *TREE)
    a, b = (packs.select(*held, "dim").toDF(*[f"{c}_{end}" for c in held], "dim") for end in "ab")
    pairs = (
        settle(near_packs(packs, chord))
        .join(a, "pack_a")
        .join(b.drop("dim"), "pack_b")
        .withColumn("same", F.col("pack_a") == F.col("pack_b"))
        .drop("pack_a", "pack_b")
    )
    found = settle(pairs.mapInArrow(_compare(threshold), "a long, b long, partners long"))
    partners = found.filter("b < 0").groupBy("a").agg(F.sum("partners").alias("partners"))
    root = components(found.filter("b >= 0").select("a", "b"))
    labelled = settle(
        distinct.join(partners, F.col("id") == F.col("a"), "left")
        .join(root, F.col("id") == F.col("node"), "left")
        .select(
            *group,
            "first_id",
            (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("root"),
        )
    )
    named = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = labelled.join(named, "root").select(*group, "n_links", "component_id")
    alone = rows.filter("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return (
        good.join(linked, group)
        .select("vec_id", "n_links", "component_id")
        .union(alone)
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
