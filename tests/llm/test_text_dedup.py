import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import bytehash, jaccard_join, suffix_array, suffix_dedup
from sitelens.llm.common import components
from tests.llm.util import SMALL, by_id, component_ids, docs_df, repeated_bytes, shingles, similar_pairs


def naive_order(raw):
    return sorted(range(len(raw)), key=lambda i: raw[i:])


@pytest.mark.parametrize("small_alphabet", [2, 1024])
def test_suffix_array_and_common_prefixes(monkeypatch, small_alphabet):
    monkeypatch.setattr(suffix_array, "_SMALL", small_alphabet)
    rng = random.Random(5)
    for _ in range(120):
        raw = bytes(rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 50)))
        buf = np.frombuffer(raw, np.uint8)
        sa = suffix_array.suffix_array(buf, 256)
        assert sa.tolist() == naive_order(raw)
        lcp = suffix_array.permuted_lcp(buf, sa)
        for r in range(1, len(raw)):
            a, b = raw[sa[r]:], raw[sa[r - 1]:]
            want = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[sa[r]] == want


def check_removal(rows, raws, size):
    gone = repeated_bytes(raws, size)
    for d, raw in raws.items():
        flags = gone[d]
        kept = bytes(c for c, g in zip(raw, flags) if not g)
        spans = sum(1 for i, g in enumerate(flags) if g and (i == 0 or not flags[i - 1]))
        r = rows[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(raw), sum(flags), spans), d
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert bytes(r["kept"]) == kept


def test_removal_matches_brute_force_on_planted_repeats(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    passage = " ".join(word() for _ in range(40))
    texts = {}
    for i in range(60):
        body = " ".join(word() for _ in range(rng.randint(0, 60)))
        if i % 3 == 0:
            body += " " + passage[rng.randint(0, 20):] + " " + " ".join(word() for _ in range(10))
        texts[i] = body
    texts[60], texts[61] = texts[5], texts[5]                # copies
    texts[62] = "ab" * 300                                   # repeats inside one text
    texts[63] = ""
    texts[64] = "x" * 59
    df = docs_df(spark, list(texts.items()) + [(65, None)])
    raws = {d: t.encode() for d, t in texts.items()} | {65: b""}
    for most in (256, 3):                                    # 3: the passage's anchors are split
        rows = by_id(suffix_dedup.remove_repeats(df, min_bytes=60, most_regions=most, with_bytes=True))
        check_removal(rows, raws, 60)


def test_removal_of_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    raws = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    check_removal(by_id(suffix_dedup.remove_repeats(docs, with_bytes=True)), raws, 400)


def test_removal_of_repeated_rows_null_ids_and_empty_table(spark):
    long = "0123456789" * 3 + "abcdefghijklmnopqrstuvwxyz" * 2
    df = docs_df(spark, [(1, long), (1, long), (None, long + "!"), (None, "short")]).withColumn("lo", F.lit(1)).withColumn("key", F.lit("x"))
    rows = suffix_dedup.remove_repeats(df, min_bytes=20).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in rows) == [(-1, 0), (-1, len(long)), (1, len(long)), (1, len(long))]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_very_long_text_is_cut_into_overlapping_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PIECE", 500)
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef") for _ in range(3000))
    parts = list(suffix_dedup._pieces([text.encode()], 60))
    assert parts[0][1] == 0 and all(p[1] % 500 == 0 for p in parts)
    starts = set()
    for _, off, raw in parts:
        starts |= set(range(off, off + len(raw) - 60 + 1))
    assert starts == set(range(3000 - 60 + 1))


def test_components_match_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(70)] + [(100, b) for b in range(101, 160)] + [(i, i + 1) for i in range(200, 240)]
    want = component_ids({x for p in links for x in p}, links)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links + [(7, 7), (None, 3)], "a long, b long")).collect()}
    assert all(got.get(i, i) == c for i, c in want.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_sets_of_whole_texts():
    texts = ["A b\tC d", "a B c D", "one two", "ONE  two ", "", " \n", "é É", "a b c a b c a b c"]
    got = bytehash.shingle_sets(texts, 3)
    assert [len(x) for x in got] == [len(shingles(t, 3)) for t in texts]
    assert got[0].tolist() == got[1].tolist() and got[2].tolist() == got[3].tolist()
    packed = bytehash.pack(got[7])
    assert bytehash.unpack(packed).tolist() == got[7].tolist()


@pytest.mark.parametrize("k,num", [(3, 90), (5, 80)])
def test_components_of_similar_documents_match_brute_force(spark, k, num):
    rng = random.Random(k)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 150))]
        for _ in range(rng.choice([1, 2, 5, 25])):
            t = list(base)
            for _ in range(rng.randint(0, 5)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((i, " ".join(t)))
            i += 1
    rows += [(i, rows[3][1]), (i + 1, rows[3][1].upper()), (i + 2, None), (i + 3, ""), (i + 4, " \t "), (i + 5, "w1"), (i + 6, "W1 ")]
    sets = {d: shingles(t, k) for d, t in rows}
    want = component_ids(sets, similar_pairs(sets, num, 100))
    got = by_id(jaccard_join.similarity_components(docs_df(spark, rows).withColumn("n", F.lit(1)), k, num, 100, bits=12))
    for d in sets:
        assert got[d]["n_shingles"] == len(sets[d])
        assert got[d]["component_id"] == want[d], d


def test_one_document_of_each_component_stays(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(4, text), (2, text + " end"), (9, "alone here"), (None, text), (7, None), (8, ""), (9, "alone here")]
    kept = jaccard_join.keep_one_per_component(docs_df(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 2), (False, 7), (False, 8), (False, 9), (True, 0)]


def test_different_texts_with_one_id_stay(spark):
    rows = [(1, "one text of its own"), (1, "quite another one here"), (2, "and a third of no relation"), (1, "one text of its own")]
    kept = jaccard_join.keep_one_per_component(docs_df(spark, rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(set(rows))


def test_number_of_matches_follows_cost():
    assert jaccard_join.choose_matches(np.array([0.0, 0, 0, 0, 0]), 2) == 1
    # frequent shingles in the prefix: more matches are asked for as long as that saves candidates
    assert jaccard_join.choose_matches(np.array([50.0, 50, 1, 1, 1]), 2) > 1
    assert jaccard_join.choose_matches(np.array([5.0]), 1) == 1


def test_empty_table_and_bad_threshold(spark):
    empty = docs_df(spark, [(1, "x")]).limit(0)
    assert jaccard_join.similarity_components(empty).count() == 0
    with pytest.raises(ValueError):
        jaccard_join.similarity_components(empty, num=101, den=100)
