import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import exact_dedup, importance, prefix_trie, queries
from tests.conftest import state_lists
from tests.llm.util import SMALL

TURNS = "conv_id long, turn long, role string, text string"


# --- prefix trie ---

def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))

    def content(r):
        return hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()

    own = {c: [(r[2], r[3]) for r in sorted(t, key=lambda r: (r[0], r[1], r[2], content(r)))] for c, t in convs.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[:len(p)] == p]
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], sum(kids[q] == 0 for q in under),
                    sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in under if q),
                    hashlib.sha256(",".join(map(str, sorted(c for c in cs if paths[c] == p))).encode()).hexdigest()))
    return out


def trie_rows(spark, rows, schema=TURNS):
    out = prefix_trie.build(spark.createDataFrame(rows, schema))
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return [tuple(r) for r in out.collect()]


def key(r):
    return tuple(-1 if x is None else x for x in r)


def test_trie_equals_brute_force_over_many_shards_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 40)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rng = random.Random(3)
    rows = []
    for c in range(90):
        n = 30 if c in (10, 11, 12) else rng.randint(1, 12)
        base = 0 if c % 3 else c                                 # a third share a long common beginning
        rows += [(c, t, rng.choice(["user", None, ""]) if t > 14 else "user", f"é{base if c not in (10, 11, 12) else 7}:{t // 2}") for t in range(n)]
    rows += [(500 + c, t, "a", "same") for c in range(20) for t in range(3)]     # one conversation many times
    rows += [(None, 1, "a", "lost"), (7, None, "sys", "first"), (7, None, "sys", "first"), (8, 2, None, None), (8, 2, "", "")]
    rng.shuffle(rows)
    assert sorted(map(key, trie_rows(spark, rows))) == sorted(map(key, brute_trie(rows)))


def test_trie_small_cases(spark):
    assert trie_rows(spark, []) == []
    # turn 1 of 3 is dropped if its head is longer than the conversation and 0 is absent: a turnless member of the root
    c = next(c for c in range(1, 50) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "x" * 100_000)]
    assert trie_rows(spark, rows) == brute_trie(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    long = [(5, t, "user", "y" * 70_000 + str(t)) for t in range(3)] + [(10, t, "user", "y" * 70_000 + str(t)) for t in range(3)]
    assert sorted(map(key, trie_rows(spark, long))) == sorted(map(key, brute_trie(long)))
    extra = spark.createDataFrame([(5, 0, "u", "t", 1, 2, 3)], TURNS + ", depth long, k1 long, rank long")
    assert [tuple(r) for r in prefix_trie.build(extra).collect()] and prefix_trie.build(extra).count() == 2


def test_trie_key_collisions_are_found_and_mended(spark, monkeypatch):
    rows = [(c, t, "u", f"{c % 7}{t}") for c in range(0, 100, 5) for t in range(3)]
    real, seeds = prefix_trie._prefixes, []

    def weak(rebuilt, seed):
        seeds.append(seed)
        got = real(rebuilt, seed)
        if seed == 0:       # all second turns get one key
            got = got.withColumn("k1", F.when(F.col("depth") == 2, 1).otherwise(F.col("k1"))).withColumn("k2", F.when(F.col("depth") == 2, 1).otherwise(F.col("k2")))
        return got

    monkeypatch.setattr(prefix_trie, "_prefixes", weak)
    assert sorted(map(key, trie_rows(spark, rows))) == sorted(map(key, brute_trie(rows)))
    assert seeds == [0, 1]


def test_slot_table_is_minimal_perfect_and_verified():
    rng = np.random.default_rng(1)
    k1, k2 = rng.integers(-2**63, 2**63 - 1, 5000), rng.integers(0, 3, 5000)
    table = prefix_trie.SlotTable(k1, k2)
    assert sorted(table.slots(k1, k2).tolist()) == list(range(5000))
    assert (table.slots(k1, k2 + 3) == -1).all() and len(prefix_trie.SlotTable(k1[:0], k2[:0]).slots(k1, k2)) == 5000


# --- exact dedup ---

def brute_dedup(rows):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[t or ""].append((d is not None, d or 0, i, d))
    out = []
    for t, g in groups.items():
        sha = hashlib.sha256(t.encode()).hexdigest()
        keep = max(g)
        out += [(d, keep[3], len(g), False, sha) for *_, d in sorted(g)[:-1]] + [(keep[3], keep[3], len(g), True, sha)]
    return Counter(out)


def dedup_rows(spark, path, **kw):
    out = exact_dedup.deduplicate(spark, path, **kw).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return Counter(tuple(r) for r in out.collect())


def write(spark, path, rows, mode="append", files=1, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    if extra:
        df = df.withColumns({c: F.lit("x") for c in ("file", "row", "digest", "n", "content", "keeper")})
    df.repartition(files).write.mode(mode).parquet(path)


ROWS = [(i, f"text {i % 6}") for i in range(40)] + [(50, None), (51, ""), (None, "text 1"), (None, None), (7, "alone"), (39, "text 3"), (60, "A"), (61, "a"),
                                                    (62, "x" * 200_000), (63, "x" * 200_000), (64, "x" * 199_999 + "y")]


def weak_digest(content):
    return F.substring(exact_dedup.sha256_digest(content), 1, 0)


@pytest.mark.parametrize("digest", [exact_dedup.sha256_digest, weak_digest])
def test_dedup_over_batches_equals_brute_force(spark, tmp_dir, digest):
    write(spark, f"{tmp_dir}/t", ROWS, files=5, extra=True)
    assert dedup_rows(spark, f"{tmp_dir}/t", digest=digest, files_per_batch=2) == brute_dedup(ROWS)


def test_dedup_state_is_kept_between_calls(spark, tmp_dir):
    path, checkpoint = f"{tmp_dir}/t", f"{tmp_dir}/state"
    write(spark, path, ROWS)
    assert dedup_rows(spark, path, checkpoint=checkpoint) == brute_dedup(ROWS)
    more = [(100, "text 1"), (101, "new"), (102, None)]
    write(spark, path, more)
    assert dedup_rows(spark, path, checkpoint=checkpoint) == brute_dedup(ROWS + more)
    state = exact_dedup.classes(spark, checkpoint)
    assert state.agg(F.sum("n")).first()[0] == len(ROWS + more) and state.select("digest").distinct().count() == state.count()


def test_dedup_bitmap_passes_all_hits_and_few_others(spark, monkeypatch):
    rows = spark.range(20_000).select("id", exact_dedup.sha256_digest(F.col("id").cast("string")).alias("digest"))
    for most, low, high in ((1 << 28, 500, 2_500), (1 << 15, 500, 2_500)):
        monkeypatch.setattr(exact_dedup, "MAX_BITS", most)
        near = exact_dedup._near_hits(rows, rows.where("id % 40 = 0").select("digest")).select("id")
        assert near.where("id % 40 = 0").count() == 500 and low <= near.count() <= high
    assert exact_dedup._near_hits(rows, rows.limit(0).select("digest")).count() == 0


def test_dedup_state_takes_no_disk_in_advance(spark, tmp_dir):
    write(spark, f"{tmp_dir}/t", ROWS)
    since = time.time() - 1
    exact_dedup.advance(spark, f"{tmp_dir}/t", f"{tmp_dir}/state")
    sizes = state_lists(spark, since)
    assert sizes and max(sizes) < 1 << 20


def test_dedup_of_an_empty_table(spark, tmp_dir):
    write(spark, f"{tmp_dir}/t", [])
    assert dedup_rows(spark, f"{tmp_dir}/t") == Counter()


# --- importance resampling ---

def brute_features(text, max_n):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute_importance(docs, target, max_n, buckets, seed, min_words, percent):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in brute_features(t, max_n)[1])

    s, t = counts([x for _, x in docs]), counts(target)
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(buckets)]
    rows = []
    for d, text in docs:
        words, fs = brute_features(text, max_n)
        w = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    best = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(best[:len(best) * percent // 100])}
    return [(*r[:4], rank.get(r[0])) for r in rows]


@pytest.mark.parametrize("max_n", [1, 3])
def test_importance_equals_brute_force(spark, max_n):
    rng = random.Random(2)
    vocabulary = ["Alpha", "beta", "été", "x1", "漢字", "don't", "gamma-delta", "ÀB", "Z"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, " ,;\t\x00 \x7f"), (103, "word " * 30_000), (None, "beta " * 40)]
    target = ["Alpha beta été", None, "", "漢字 beta beta x1"]
    frame = spark.createDataFrame([(d, t, "clash", 1) for d, t in docs], "doc_id long, text string, weight string, score long").repartition(4)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(frame, wanted, max_n=max_n, buckets=64, seed=5, min_words=10, percent=30)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    assert sorted(map(key, map(tuple, got.collect()))) == sorted(map(key, brute_importance(docs, target, max_n, 64, 5, 10, 30)))


def test_importance_of_repeated_rows_ties_and_empty_tables(spark):
    schema = "doc_id long, text string"
    same = spark.createDataFrame([(1, "a b c")] * 4 + [(2, "a b")], schema)
    got = sorted(map(key, map(tuple, importance.resample(same, same.limit(0), min_words=1, percent=60).collect())))
    assert sorted(r[4] for r in got) == [-1, -1, 1, 2, 3]
    assert importance.resample(same.limit(0), same).collect() == []


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_exact_dedup", "op13_importance_resampling"])
def test_new_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    plan, sql = queries.QUERIES[name]
    df = plan(spark, SMALL)
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()
    assert sorted(map(key, map(tuple, df.collect()))) == sorted(map(key, want))
