"""Approximate nearest neighbours: hierarchical k-means, best-bin-first.

The tree is fitted on a bounded sample (``sample_rows``); every row of the
table is assigned to a leaf.  A query walks the tree with a priority queue of
nodes ordered by distance to their centres and visits the nearest leaves
first.  How many *sampled-row shares* of the index it must visit is
calibrated: on held-back sample vectors the visits are widened until the mean
recall against brute force over the sample reaches ``target_recall``.

Search is a join of (query, leaf) with the leaf's rows.  Large leaves (one
vector may hold a third of all rows) are cut into blocks of ``block_rows`` by
hash, and so are the queries of a leaf, so no task gets a whole hot leaf;
every block returns its own k best and a window per query ranks those.
Cosines are computed in double precision on the original vectors.  The tree's
size depends on ``sample_rows`` only; it is broadcast, as are the leaf counts.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part; vectors of another length than the most frequent one
in the sample take no part; fewer candidates than k: all of them; equal scores
go to the smaller id; a row is no candidate of a query with the same id; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import as_doubles, bounded_sample, matrix, units, usable

SAMPLE_ROWS = 8_000
LEAF_ROWS = 100
BRANCH = 12
TARGET_RECALL = 0.97
BLOCK_ROWS = 2_000
BLOCK_QUERIES = 500


class KMeansTree:
    """Centres of a k-means tree on unit vectors; leaves are numbered."""

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF_ROWS, branch: int = BRANCH, seed: int = 11):
        self.branch, self.leaf_rows, self.rng = branch, leaf_rows, np.random.default_rng(seed)
        self.children: list[tuple[np.ndarray, np.ndarray] | None] = []   # (centres, child nodes) or None for a leaf
        self.leaf_of: list[int] = []
        self.n_leaves = 0
        self.root = self._grow(x, 0)

    def _grow(self, x, depth):
        node = len(self.children)
        self.children.append(None)
        self.leaf_of.append(-1)
        centres, of = self._kmeans(x) if len(x) > self.leaf_rows and depth < 12 else (None, None)
        if centres is None:
            self.leaf_of[node] = self.n_leaves
            self.n_leaves += 1
            return node
        kids = np.array([self._grow(x[of == j], depth + 1) for j in range(len(centres))])
        self.children[node] = centres, kids
        return node

    def _kmeans(self, x, rounds: int = 8):
        distinct = np.unique(x, axis=0)
        k = min(self.branch, len(distinct))
        if k < 2:
            return None, None
        c = distinct[self.rng.choice(len(distinct), k, replace=False)]
        for _ in range(rounds):
            of = np.argmax(x @ c.T, 1)
            c = np.stack([x[of == j].mean(0) if (of == j).any() else c[j] for j in range(k)])
            n = np.sqrt((c * c).sum(1, keepdims=True))
            c = np.where(n > 1e-12, c / np.maximum(n, 1e-12), c)
        of = np.argmax(x @ c.T, 1)
        used = np.unique(of)
        if len(used) < 2:
            return None, None
        return c[used], np.searchsorted(used, of)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector by greedy descent."""
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                out[rows] = self.leaf_of[node]
                continue
            centres, kids = self.children[node]
            of = np.argmax(x[rows] @ centres.T, 1)
            todo += [(kids[j], rows[of == j]) for j in np.unique(of)]
        return out

    def visit(self, q: np.ndarray, share: float, weight: np.ndarray) -> list[int]:
        """Leaves in best-bin-first order until ``share`` of ``weight`` is covered."""
        queue, got, leaves, tick = [(0.0, 0, self.root)], 0.0, [], 0
        while queue:
            _, _, node = heapq.heappop(queue)
            if self.children[node] is None:
                leaf = self.leaf_of[node]
                leaves.append(leaf)
                got += weight[leaf]
                if got >= share:
                    break
                continue
            centres, kids = self.children[node]
            for d, kid in zip(1 - centres @ q, kids):
                tick += 1
                heapq.heappush(queue, (float(d), tick, int(kid)))
        return leaves


def calibrate(tree: KMeansTree, x: np.ndarray, queries: np.ndarray, k: int, target: float) -> float:
    """Least share of the sample to visit for the target mean recall at k, with some reserve."""
    of = tree.assign(x)
    weight = np.bincount(of, minlength=tree.n_leaves) / max(1, len(x))
    if len(x) <= k or tree.n_leaves == 1 or not len(queries):
        return 1.0
    sims = queries @ x.T
    best = np.argsort(-sims, 1, kind="stable")[:, :k]
    orders = [tree.visit(q, 2.0, weight) for q in queries]
    share = 0.02
    while share < 1:
        hit = 0
        for order, truth in zip(orders, best):
            upto = int(np.searchsorted(np.cumsum(weight[order]), share)) + 1
            hit += int(np.isin(of[truth], order[:upto]).sum())
        if hit >= target * best.size:
            break
        share *= 1.25
    return min(1.0, share)


def build(vectors: DataFrame, k: int, sample_rows: int = SAMPLE_ROWS, target_recall: float = TARGET_RECALL):
    """(tree, share, dimension) from a bounded sample of usable vectors, else None."""
    rows = [r[0] for r in bounded_sample(vectors, "vec_id", sample_rows).select("v").toLocalIterator()]
    if not rows:
        return None
    dim = Counter(map(len, rows)).most_common(1)[0][0]
    x = units(matrix([r for r in rows if len(r) == dim]))
    held = max(1, min(200, len(x) // 10))
    # held-back vectors are no part of the calibrated set, but the tree is the whole sample's
    tree = KMeansTree(x)
    return tree, calibrate(tree, x[held:], x[:held], k, target_recall), dim


def search(embeddings: DataFrame, queries: DataFrame, k: int = 5, target_recall: float = TARGET_RECALL,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query row."""
    spark = embeddings.sparkSession
    shape = "query_id long, rank int, vec_id long, score double"
    rows = stored(embeddings.where(usable() & F.col("vec_id").isNotNull())
                  .select(F.col("vec_id").cast("long").alias("vec_id"), as_doubles().alias("v")), "ann-rows")
    asked = queries.where(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("query_id"), as_doubles().alias("q"))
    made = build(rows, k, sample_rows, target_recall)
    if made is None:
        return spark.createDataFrame([], shape)
    tree, share, dim = made
    shared = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("int")
    def leaf(v: pd.Series) -> pd.Series:
        return pd.Series(shared.value.assign(units(matrix(v))).astype(np.int32))

    index = stored(rows.where(F.size("v") == dim).withColumn("leaf", leaf("v")), "ann-index")
    counts = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}    # bounded: leaves of the tree
    total = sum(counts.values())
    weight = np.array([counts.get(i, 0) / total for i in range(tree.n_leaves)])
    blocks = np.array([max(1, -(-counts.get(i, 0) // BLOCK_ROWS)) for i in range(tree.n_leaves)])
    at_least = (k + 1) / total

    @F.pandas_udf("array<int>")
    def leaves(q: pd.Series) -> pd.Series:
        t = shared.value
        return pd.Series([np.array(t.visit(x, max(share, at_least), weight), np.int32) for x in units(matrix(q))])

    n_blocks = F.element_at(F.lit([int(b) for b in blocks]), F.col("leaf") + 1)
    visits = (asked.where(F.size("q") == dim).withColumn("leaf", F.explode(leaves("q")))
              .withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1))))
    visits = stored(visits, "ann-visits")
    asked_of = {(r["leaf"]): r["n"] for r in visits.where("block = 0").groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [max(1, -(-asked_of.get(i, 0) // BLOCK_QUERIES)) for i in range(tree.n_leaves)]
    n_parts = F.element_at(F.lit(parts), F.col("leaf") + 1)
    left = visits.withColumn("part", F.pmod(F.xxhash64("query_id"), n_parts).cast("int"))
    right = (index.withColumn("block", F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        x, ids, out = units(matrix(b["v"])), b["vec_id"].to_numpy(), []
        for i in range(0, len(a), 256):
            q = a.iloc[i:i + 256]
            sims = np.clip(units(matrix(q["q"])) @ x.T, -1, 1)
            for qid, s in zip(q["query_id"], sims):
                s = np.where(ids == qid, -np.inf, s)
                few = np.flatnonzero(s >= np.partition(s, -min(k, len(s)))[-min(k, len(s))])
                few = few[np.isfinite(s[few])]
                few = few[np.lexsort((ids[few], -s[few]))][:k]
                out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[few], "score": s[few]}))
        return pd.concat(out, ignore_index=True)

    key = ["leaf", "block", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(best, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
