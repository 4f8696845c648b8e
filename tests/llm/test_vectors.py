import numpy as np
import pytest

from sitelens.llm import ann, embedding_dedup
from tests.llm.util import SMALL, component_ids

SHAPE = "vec_id long, embedding array<float>, label int"


def table_of(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def cosines(rows):
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def clustered(n, seed=1, dim=8, noise=0.05):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dim))
    return [(i, (centres[i % 6] + noise * r.normal(size=dim)).astype(np.float32).tolist(), int(i % 2)) for i in range(n)]


BAD = [(900, None, 0), (901, [], 0), (902, [0.0] * 8, 0), (903, [float("nan")] + [1.0] * 7, 0), (904, [None] + [1.0] * 7, 1), (905, [float("inf")] * 8, 1)]


@pytest.mark.parametrize("block", [1500, 20])
def test_embedding_links_match_brute_force(spark, monkeypatch, block):
    rows = clustered(150) + [(500 + i, clustered(150)[7][1], 1) for i in range(40)]    # one vector 41 times
    monkeypatch.setattr(embedding_dedup, "LEAF_POINTS", 4)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table_of(spark, rows + BAD + [(906, rows[0][1], None)]), 0.98, block_rows=block).collect()}
    sims = cosines(rows)
    links = [(rows[i][0], rows[j][0]) for i in range(len(rows)) for j in range(i) if rows[i][2] == rows[j][2] and sims[i, j] >= 0.98]
    want = component_ids([r[0] for r in rows], links)
    n = {r[0]: 0 for r in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(links) > 500
    for i in n:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (n[i], want[i], want[i] == i), i
    for i in [b[0] for b in BAD] + [906]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_repeated_ids_and_clashing_columns(spark):
    """Vectors are what links: two of them with one id have links of their own."""
    near = [1.0, 0.05, 0.0]
    rows = [(1, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, near, 0), (2, near, 0), (3, [0.0, 0.0, 1.0], 0), (3, [0.0, 0.0, 1.0], 1)]
    df = spark.createDataFrame([(*r, 7, 8, 9, 10) for r in rows], SHAPE + ", cls long, rep long, cell int, n_links long")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True), (3, 0, 3, True)]


def test_cover_tree_finds_every_pair_once():
    x = embedding_dedup.units(np.random.default_rng(3).normal(size=(300, 3)))
    a, b = embedding_dedup.CoverTree(x, 8), embedding_dedup.CoverTree(x[:120].copy(), 8)
    for t in (0.9, 0.999):
        inside = sorted(tuple(sorted(p)) for i, j in embedding_dedup.dual_links(a, a, True, t) for p in zip(i.tolist(), j.tolist()))
        assert inside == [(i, j) for i in range(300) for j in range(i + 1, 300) if x[i] @ x[j] >= t]
        across = sorted(p for i, j in embedding_dedup.dual_links(a, b, False, t) for p in zip(i.tolist(), j.tolist()))
        assert across == [(i, j) for i in range(300) for j in range(120) if x[i] @ x[j] >= t]


def test_embedding_dedup_of_empty_table(spark):
    assert embedding_dedup.near_duplicates(table_of(spark, []).limit(0)).count() == 0
    only_bad = embedding_dedup.near_duplicates(table_of(spark, BAD)).collect()
    assert len(only_bad) == len(BAD) and all(r["kept"] for r in only_bad)


def brute_nearest(rows, q, k):
    sims = cosines(rows)
    i = [r[0] for r in rows].index(q)
    order = sorted((j for j in range(len(rows)) if rows[j][0] != q), key=lambda j: (-sims[i, j], rows[j][0]))
    return [(rows[j][0], sims[i, j]) for j in order[:k]]


def test_nearest_neighbours_recall_and_scores(spark):
    rows = clustered(600, seed=5, dim=16, noise=0.8)
    df = table_of(spark, rows + [(900 + i, b[1], b[2]) for i, b in enumerate(BAD)])
    found = ann.search(df, df.where("vec_id % 10 = 0"), k=5).collect()
    hit = 0
    for q in range(0, 600, 10):
        truth = dict(brute_nearest(rows, q, 5))
        mine = sorted((r for r in found if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert [r["score"] for r in mine] == sorted((r["score"] for r in mine), reverse=True)
        hit += sum(r["vec_id"] in truth for r in mine)
        for r in mine:
            if r["vec_id"] in truth:
                assert r["score"] == pytest.approx(truth[r["vec_id"]], abs=1e-12)
    assert hit / 300 >= 0.9
    assert {r["query_id"] for r in found} == set(range(0, 600, 10))


def test_few_candidates_ties_and_hot_vector(spark, monkeypatch):
    few = table_of(spark, [(50, [1.0, 0.0], 0), (3, [1.0, 1.0], 0), (2, [2.0, 2.0], 0)])
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(few, few.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [(50, 1, 2), (50, 2, 3)]
    monkeypatch.setattr(ann, "BLOCK_ROWS", 30)
    hot = table_of(spark, [(i, [1.0, 2.0, 3.0], 0) for i in range(200)] + [(200 + i, [float(i), 1.0, 0.0], 0) for i in range(30)])
    got = [r["vec_id"] for r in ann.search(hot, hot.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [1, 2, 3, 4, 5]
    assert ann.search(few.limit(0), few.limit(0)).count() == 0


def test_calibrated_recall_on_the_given_table(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    found = ann.search(df, df.where("vec_id % 50 = 0")).collect()
    truth = {q: {v for v, _ in brute_nearest(rows, q, 5)} for q in {r["query_id"] for r in found}}
    assert sum(r["vec_id"] in truth[r["query_id"]] for r in found) / sum(map(len, truth.values())) >= 0.9
