"""Embedding near-dedup: exact threshold pairs by dual cover-tree traversal.

Vectors are compared only within a label.  On unit vectors ``cosine >= t`` is
``distance <= sqrt(2 - 2t)``.  Equal vectors of a label collapse first (with their
count and least id), so a vector that holds a third of all rows costs nothing.

Top level: centres from a bounded sample; every distinct vector goes to its
nearest centre of its label, and each cell keeps its covering radius.  Two
cells can hold a link only if ``d(centres) <= r1 + r2 + eps``; only those cell
pairs are joined.  A large cell is cut into blocks by hash.  Within a pair of
blocks a task builds two cover trees (nested levels, radii halving) and walks
them together: a pair of nodes whose centres are further apart than the sum of
their covering radii plus eps is dropped with everything below it.  Surviving
leaf pairs are verified by the cosine in double precision.

A task returns, per vector, the number of links it saw, and for connectivity a
spanning forest of them, never all pairs of a group.

Defined cases: a NULL label compares with nothing; vectors that are NULL, empty, zero or
hold NULL or non-finite components link with nothing; vectors of different length
never link; every row gets an output row (a NULL id: its component is NULL and
it links with nothing); repeated rows with one id count as other vectors, and different
vectors with one id have links of their own (classes of equal vectors are told apart by
label and hashes, never by id).

Where vectors spread evenly over many dimensions all distances are alike and no bound
separates two nodes: then every pair of a label is compared, in products of leaves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .vectors import as_doubles, bounded_sample, matrix, units, usable

THRESHOLD = 0.98
SAMPLE_ROWS = 4_000
#: Vectors of a block and of a leaf: a task holds two blocks, and a pair of leaves is one matrix product.
BLOCK_ROWS = 6_000
LEAF_POINTS = 256


class CoverTree:
    """Nested levels over unit vectors; a node is (centre row, covering radius, children or member rows)."""

    def __init__(self, x: np.ndarray, leaf_points: int = LEAF_POINTS):
        self.x, self.leaf = x, leaf_points
        self.root = self._node(np.arange(len(x)), 2.0)

    def _node(self, rows, scale):
        centre = rows[0]
        d = _distance(self.x[rows], self.x[centre][None])[:, 0]
        radius = float(d.max())
        while scale > radius and scale > 1e-6:
            scale /= 2                                   # levels that would have one node
        if len(rows) <= self.leaf or radius < 1e-6:
            return centre, radius, None, rows
        # next level: a net of radius ``scale``, the parent's centre first; the rest goes to the nearest net point
        net, gap = [centre], d.copy()
        while len(net) < 64:
            far = int(np.argmax(gap))
            if gap[far] <= scale:
                break
            net.append(rows[far])
            gap = np.minimum(gap, _distance(self.x[rows], self.x[rows[far]][None])[:, 0])
        if len(net) == 1:
            net.append(rows[int(np.argmax(d))])
        of = np.argmin(_distance(self.x[rows], self.x[net]), 1)
        kids = [self._node(rows[of == j], scale / 2) for j in range(len(net)) if (of == j).any()]
        return (centre, radius, kids, None) if len(kids) > 1 else (centre, radius, None, rows)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)))


def dual_links(a: CoverTree, b: CoverTree, same: bool, threshold: float):
    """Yields (rows of a, rows of b) arrays of linked pairs; in one tree each pair once, no self pairs."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-7
    todo = [(a.root, b.root)]
    while todo:
        p, q = todo.pop()
        one = same and p is q
        if not one and _distance(a.x[p[0]][None], b.x[q[0]][None])[0, 0] > p[1] + q[1] + eps:
            continue
        if p[2] is None and q[2] is None:
            sims = a.x[p[3]] @ b.x[q[3]].T
            i, j = np.nonzero(sims >= threshold)
            if one:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield p[3][i], q[3][j]
            continue
        if one:
            kids = p[2]
            todo += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
            continue
        if q[2] is None or (p[2] is not None and p[1] >= q[1]):
            split, other, left = p[2], q, True
        else:
            split, other, left = q[2], p, False
        tx, ox = (a.x, b.x) if left else (b.x, a.x)
        near = _distance(tx[[s[0] for s in split]], ox[other[0]][None])[:, 0] <= np.array([s[1] for s in split]) + other[1] + eps
        todo += [(s, other) if left else (other, s) for s, ok in zip(split, near) if ok]


def _forest(ids_a, ids_b):
    """Spanning forest of pairs: (member, least id of its part)."""
    root: dict[int, int] = {}

    def find(v):
        while root.setdefault(v, v) != v:
            root[v] = root[root[v]]
            v = root[v]
        return v

    for u, v in zip(ids_a, ids_b):
        u, v = find(u), find(v)
        if u != v:
            root[max(u, v)] = min(u, v)
    return [(v, find(v)) for v in list(root)]


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS,
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per row of ``embeddings``: vec_id, n_links, component_id, kept."""
    spark = embeddings.sparkSession
    rows = stored(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", as_doubles().alias("v"),
                                    (usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).alias("ok"))
                  .withColumn("v", F.when(F.col("ok"), F.transform("v", lambda c: c + F.lit(0.0))))
                  .withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64(F.lit(7), F.col("v"))), "emb-rows")
    # equal vectors collapse: one representative with weight
    kind = ["label", "h1", "h2"]
    # ``cls`` is a number of its own, written once: ids may stand on several vectors
    classes = stored(rows.where("ok").groupBy(*kind).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                     .withColumn("cls", F.monotonically_increasing_id()), "emb-classes")
    reps = stored(rows.where("ok").join(classes.select(F.col("rep").alias("vec_id"), *kind, "copies", "cls"), ["vec_id", *kind])
                  .dropDuplicates(["vec_id", *kind]).select("cls", "label", "copies", "v"), "emb-reps")
    # centres from a bounded sample, at most one per block of rows of the label; else the origin (radius 1 covers all)
    sample = bounded_sample(reps, "cls", sample_rows).select("label", "v").collect()
    total = reps.count()
    by_label: dict = {}
    for r in sample:
        by_label.setdefault((r["label"], len(r["v"])), []).append(r["v"])
    centres = {}
    for key, vs in by_label.items():
        x = units(matrix(vs))
        want = max(1, int(len(x) / max(1, len(sample)) * total / block_rows))
        net, gap = [0], _distance(x, x[:1])[:, 0]
        while len(net) < min(want, len(x)) and gap.max() > 0.25:
            net.append(int(np.argmax(gap)))
            gap = np.minimum(gap, _distance(x, x[net[-1:]])[:, 0])
        centres[key] = x[net]
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("cell int, away double")
    def place(label: pd.Series, v: pd.Series) -> pd.DataFrame:
        cell, away = np.zeros(len(label), np.int32), np.ones(len(label))
        for (key, n), at in pd.Series(np.arange(len(label))).groupby([label.to_numpy(), v.map(len).to_numpy()]).groups.items():
            at, c = np.asarray(at), shared.value.get((key, n))
            if c is not None:
                d = _distance(units(matrix(v.iloc[at])), c)
                cell[at] = np.argmin(d, 1)
                away[at] = d.min(1)
        return pd.DataFrame({"cell": cell, "away": away})

    placed = stored(reps.withColumn("p", place("label", "v")).select("cls", "label", "copies", "v", F.size("v").alias("dim"), "p.cell", "p.away"), "emb-placed")
    cells = stored(placed.groupBy("label", "dim", "cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n"))
                   .withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int")), "emb-cells")
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-7

    @F.pandas_udf("double")
    def apart(label: pd.Series, dim: pd.Series, c1: pd.Series, c2: pd.Series) -> pd.Series:
        out = np.zeros(len(label))
        for i, (key, n, a, b) in enumerate(zip(label, dim, c1, c2)):
            c = shared.value.get((key, n))
            if c is not None:
                out[i] = _distance(c[a][None], c[b][None])[0, 0]
        return pd.Series(out)

    other = cells.select("label", "dim", F.col("cell").alias("cell2"), F.col("radius").alias("radius2"), F.col("blocks").alias("blocks2"))
    near = (cells.join(other, ["label", "dim"]).where("cell <= cell2")
            .where(apart("label", "dim", "cell", "cell2") <= F.col("radius") + F.col("radius2") + eps)
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("block2", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1)))
            .where("cell < cell2 or block <= block2"))
    near = stored(near.select("label", "dim", "cell", "block", "cell2", "block2"), "emb-near")
    blocks = (placed.join(cells.select("label", "dim", "cell", "blocks"), ["label", "dim", "cell"])
              .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
              .select("cls", "copies", "v", "label", "dim", "cell", "block"))
    key = ["label", "dim", "cell", "block", "cell2", "block2"]
    left = blocks.join(near, ["label", "dim", "cell", "block"]).select(*key, "cls", "copies", "v", F.lit(0).alias("side"))
    right = (blocks.withColumnsRenamed({"cell": "cell2", "block": "block2"})
             .join(near.where("cell <> cell2 or block <> block2"), ["label", "dim", "cell2", "block2"])
             .select(*key, "cls", "copies", "v", F.lit(1).alias("side")))

    def link(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["side", "cls"])
        a = g[g["side"] == 0]
        same = len(a) == len(g)
        b = a if same else g[g["side"] == 1]
        ta = CoverTree(units(matrix(a["v"])))
        tb = ta if same else CoverTree(units(matrix(b["v"])))
        ia, ib, wa, wb = a["cls"].to_numpy(), b["cls"].to_numpy(), a["copies"].to_numpy(), b["copies"].to_numpy()
        na, nb, us, vs = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64), [], []
        for i, j in dual_links(ta, tb, same, threshold):
            np.add.at(na, i, wb[j])
            np.add.at(na if same else nb, j, wa[i])
            us.append(ia[i])
            vs.append(ib[j])
        tree = _forest(np.concatenate(us).tolist(), np.concatenate(vs).tolist()) if us else []
        out = [pd.DataFrame({"cls": ia[na > 0], "links": na[na > 0], "to": -1})]
        if not same:
            out.append(pd.DataFrame({"cls": ib[nb > 0], "links": nb[nb > 0], "to": -1}))
        if tree:
            out.append(pd.DataFrame(tree, columns=["cls", "to"]).assign(links=0))
        return pd.concat(out)[["cls", "links", "to"]]

    found = stored(left.unionByName(right).groupBy(*key).applyInPandas(link, "cls long, links long, to long"), "emb-links")
    n = found.groupBy("cls").agg(F.sum("links").alias("links"))
    # classes of a component, then its smallest id
    comp = components(found.where("links = 0 and cls <> to"), "cls", "to").withColumnsRenamed({"node": "cls", "component": "part"})
    comp = stored(comp.join(classes.select("cls", "rep"), "cls"), "emb-parts")
    comp = comp.join(comp.groupBy("part").agg(F.min("rep").alias("component")), "part").select("cls", "component")
    of = (classes.join(n, "cls", "left").join(comp, "cls", "left")
          .select(*kind, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    of = stored(of, "emb-components")
    out = rows.select("vec_id", "label", "h1", "h2", "ok").join(of.withColumn("ok", F.lit(True)), [*kind, "ok"], "left")
    comp_id = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"),
                      F.coalesce(F.col("vec_id") == comp_id, F.lit(True)).alias("kept"))
