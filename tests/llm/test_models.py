import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import language, quality
from sitelens.llm.common import crc_mod, fresh_name
from tests.llm.util import by_id, docs_df

DATA = "/root/testdata/sf0.01"


def test_crc_of_the_id_as_text(spark):
    got = {r["id"]: r["m"] for r in spark.range(20).select("id", crc_mod("id", 5).alias("m")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 for i in range(20)}


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n1 = y.sum()
    return (order[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    held = crc_mod("doc_id", 5) == 0
    got = quality.score(docs, quality.train(docs, labels, ~held)).where(held).join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert auc(got["score"].to_numpy(), got["quality"].to_numpy()) > 0.95
    good = got[got["quality"] == 1]
    assert (good["predicted"] == 1).mean() > 0.97


def test_quality_is_the_pairwise_sum():
    """The linear-time form equals the sum over all pairs of features."""
    r = np.random.default_rng(1)
    m = quality.FactorisationMachine()
    m.v = r.normal(size=m.v.shape).astype(np.float32)
    m.w = r.normal(size=m.w.shape).astype(np.float32)
    part = quality.features("some words, some WORDS!\nand 12 more", 30)
    x = np.zeros(len(m.w))
    x[part[0]] = part[1]
    x[quality._SLOTS:] = m._scaled(part[2])
    at = np.flatnonzero(x)
    z = m.w0 + m.w @ x + sum(float(m.v[i] @ m.v[j]) * x[i] * x[j] for k, i in enumerate(at) for j in at[:k])
    assert m.score([part])[0] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-3)


def test_quality_defined_cases(spark):
    docs = docs_df(spark, [(1, None), (2, ""), (3, "a"), (None, "b c"), (3, "a")] + [(10 + i, f"good words number {i}") for i in range(20)] + [(40 + i, "$$$ ###") for i in range(20)])
    docs = docs.withColumn("score", F.lit("x")).withColumn("fm_score", F.lit(1))
    labels = spark.createDataFrame([(10 + i, 1, 0) for i in range(20)] + [(40 + i, 0, 0) for i in range(20)] + [(None, 1, 0), (5, None, 0), (40, 0, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score(docs, quality.train(docs, labels, F.lit(True))).collect()
    assert len(rows) == 45 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert {r["predicted"] for r in rows if (r["doc_id"] or 0) >= 40} == {0}
    assert {r["predicted"] for r in rows if 10 <= (r["doc_id"] or 0) < 30} == {1}
    none = quality.score(docs, quality.train(docs, labels.limit(0), F.lit(True))).select("score").distinct().collect()
    assert [r["score"] for r in none] == [0.5]
    ones = quality.score(docs, quality.train(docs, labels.where("quality = 1"), F.lit(True))).select("score").distinct().collect()
    assert [r["score"] for r in ones] == [1.0]
    assert quality.score(docs.limit(0), quality.FactorisationMachine()).count() == 0
    assert quality.score(docs.drop("n_chars"), quality.FactorisationMachine()).count() == 45


def test_quality_fit_is_bounded_and_repeatable(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (quality.train(docs, labels, F.lit(True), max_train_rows=50) for _ in range(2))
    assert np.array_equal(a.w, b.w) and np.array_equal(a.v, b.v)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = crc_mod("doc_id", 4) == 2
    got = language.identify(docs, language.train(docs, ~held)).where(held).select("lang", "lang_pred", "score").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_language_mixture_selects_the_languages_of_a_text():
    r = np.random.default_rng(2)
    texts = {"aa": "".join(r.choice(list("abc "), 4000)), "zz": "".join(r.choice(list("xyz "), 4000)), "mm": "".join(r.choice(list("klm "), 4000))}
    names = sorted(texts)
    counts = np.full((language.BUCKETS, 3), 0.05)
    for i, n in enumerate(names):
        counts[:, i] += np.bincount(language._trigrams(language._bytes([texts[n]])[0]), minlength=language.BUCKETS)
    logp = np.log(counts / counts.sum(0)).astype(np.float32)
    best, share = language.infer([texts["zz"][:300], texts["aa"][:300] + " " + texts["zz"][:100], texts["mm"][:40]], logp)
    assert [names[i] for i in best] == ["zz", "aa", "mm"]
    assert share[0] == pytest.approx(1.0) and 0.6 < share[1] < 0.9
    alone = language.infer([texts["aa"][:300] + " " + texts["zz"][:100]], logp)
    assert alone[1][0] == pytest.approx(share[1], abs=1e-5)             # neighbours in a batch do not matter


def test_language_defined_cases(spark):
    rows = [(i, "la le les des " * 5, "fr") for i in range(8)] + [(20 + i, "the of and to " * 5, "en") for i in range(8)]
    docs = docs_df(spark, rows + [(50, None, None), (51, "", "en"), (52, "123 !!", "en"), (54, "\u00b2\u00bd \u2460 \u2163", "en"), (None, "the of", None), (53, "the of and", None)]).withColumn("lang_pred", F.lit("x"))
    got = by_id(language.identify(docs, language.train(docs, F.lit(True))))
    assert [got[i]["lang_pred"] for i in (50, 51, 52, 54)] == ["und"] * 4
    assert got[53]["lang_pred"] == "en" and got[None]["lang_pred"] == "en" and got[3]["lang_pred"] == "fr"
    none = language.identify(docs, language.train(docs, F.lit(False))).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in none] == [("und", 0.0)]
    assert language.identify(docs.limit(0), ([], np.zeros((language.BUCKETS, 0), np.float32))).count() == 0


def test_fresh_names(spark):
    assert fresh_name(spark.range(1).withColumn("A", F.lit(1)).withColumn("a_1", F.lit(1)), "a") == "a_2"
