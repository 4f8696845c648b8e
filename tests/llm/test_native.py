"""Operators on DataFrame functions only, url rules and SentencePiece."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitelens.llm import mixing, pii, sentencepiece, url_filter
from sitelens.llm.queries import URL_RULES
from tests.llm.util import SMALL, base_spans, by_id, docs_df

DATA = "/root/testdata/sf0.01"


def text_of_spans(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_entities_match_plain_expressions(spark):
    rng = random.Random(6)
    bits = ["a.b+c@d.e", "x@y", "@", "1.2.3.4.5.6.7.8", "300.1.1.1", "0255.1.1.1", "1..2.3.4", "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1112",
            "12345678901234567890123", "+1 (555) 010-9999", "+12", "+1234567890123456", "é", "𝒳", "- ", "9", "..", "0 0", "a@b.co+q@r.s", "+", "7", "\n", "word "]
    texts = {i: "".join(rng.choice(bits) + rng.choice(["", " ", "", "-"]) for _ in range(rng.randint(0, 14))) for i in range(400)}
    got = by_id(pii.find_pii(docs_df(spark, list(texts.items()) + [(999, None)]), ["doc_id"]))
    for i, t in texts.items():
        want = base_spans(t)
        assert text_of_spans([tuple(s) for s in got[i]["base"]]) == text_of_spans(want), t
        assert got[i]["n_ip"] == sum(k == "ip" for k, _, _ in want)
        assert [tuple(s) for s in got[i]["spans"]][:len(want)] == want
    assert got[999]["base"] == [] and got[999]["spans"] == []


def test_base_entities_of_the_given_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = {r["doc_id"]: base_spans(r["text"]) for r in docs.collect()}
    got = by_id(pii.find_pii(docs, ["doc_id"]))
    assert {i: [tuple(s) for s in got[i]["base"]] for i in want} == want


def test_very_long_words_and_digit_runs(spark):
    texts = {1: "a" * 200_000, 2: "1" * 200_000, 3: "1 " * 60_000, 4: "+" * 50_000, 5: "1." * 50_000, 6: "a.b-" * 50_000 + "@", 7: "f" * 100_000}
    got = by_id(pii.find_pii(docs_df(spark, list(texts.items())), ["doc_id"]))
    assert [got[i]["base"] for i in (1, 2, 3, 4, 6, 7)] == [[]] * 6
    assert len(got[5]["base"]) == 12_500


def test_patterns_find_unseen_identifiers(spark):
    """Cards after 'account no' teach the pattern; a number after it that is no card is found everywhere."""
    good = [c for c in (str(4_111_111_111_110_000 + i) for i in range(300)) if base_spans(c)]
    rows = [(i, f"please use account no {c} today") for i, c in enumerate(good)]
    rows += [(100, "see account no 7788-1234 now"), (101, "ref 7788-1234."), (102, "in year 20242025 it was"), (103, None)]
    got = by_id(pii.find_pii(docs_df(spark, rows), ["doc_id"]))
    assert len(good) == 30
    assert [tuple(s) for s in got[100]["spans"]] == [("ctx", 15, 24)]
    assert [tuple(s) for s in got[101]["spans"]] == [("ctx", 4, 13)]
    assert got[102]["spans"] == []
    assert all(got[i]["n_card"] == 1 and len(got[i]["spans"]) == 1 for i in range(len(good)))


def test_every_base_entity_teaches_the_words_before_it(spark):
    """E-mails, phones and spaced cards are seeds; any token, or run of tokens with digits, after their patterns is found."""
    cards = [c for c in (f"4111 1111 1111 {1000 + i}" for i in range(200)) if base_spans(c)]
    rows = [(i, f"then write to name.{i % 100}@mail5.example.com today") for i in range(20)]
    rows += [(100 + i, f"or just call: +1 (743) 555-38{10 + i} today") for i in range(20)] + [(200 + i, f"take card no {c} today") for i, c in enumerate(cards)]
    rows += [(900, "then write to jsmith today"), (901, "or just call:5550 1234 99 today"), (902, 'the card no "77-88" 12 today'), (903, "jsmith has 5550 1234 99 or 99 12")]
    got = by_id(pii.find_pii(docs_df(spark, rows), ["doc_id"]))
    assert len(cards) >= 10
    found = {i: [t[a:b] for k, a, b in (tuple(s) for s in got[i]["spans"]) if k == "ctx"] for i, t in rows}
    assert found[900] == ["jsmith"] and found[901] == ["5550 1234 99"] and found[902] == ["77-88"] and found[903] == ["5550 1234 99"]
    assert not any(v for i, v in found.items() if i < 900)


CHAIN = (50, 40, 30, 22)


def _chain_rows(chain=CHAIN):
    """Cards teach pattern 0; what is found by pattern i stands after pattern i + 1, too."""
    cards = [c for c in (str(4_111_111_111_110_000 + i) for i in range(600)) if base_spans(c)]
    rows = [f"please use step0 key {c} today" for c in cards]
    for i, size in enumerate(chain):
        rows += [f"see step{i} key id{i}-{n}77 now" for n in range(size)] + [f"and step{i + 1} key id{i}-{n}77 too" for n in range(size)]
    # a common pair of words before three cards and very many plain words, and one before words that are known
    rows += [f"it was of the {c} end" for c in cards[:3]] + [f"it was of the word{'abcdefghij'[n % 10]}{'klmnopqrst'[n // 10]} end" for n in range(90)]
    return list(enumerate(rows))


def test_bootstrap_goes_on_until_nothing_is_new(spark):
    rows = _chain_rows()
    got = by_id(pii.find_pii(docs_df(spark, rows), ["doc_id"]))
    found = {t[a:b] for i, t in rows for k, a, b in (tuple(s) for s in got[i]["spans"]) if k == "ctx"}
    assert found == {f"id{i}-{n}77" for i, size in enumerate(CHAIN) for n in range(size)}


def test_patterns_left_out_by_their_count_could_not_be_trusted(spark, monkeypatch):
    rows = _chain_rows(CHAIN[:1])
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    docs = table.unionByName(docs_df(spark, [(10_000 + i, t) for i, t in rows]).select("doc_id", "text")).cache()

    def spans():
        return {i: [tuple(s) for s in r["spans"]] for i, r in by_id(pii.find_pii(docs, ["doc_id"])).items()}

    left = {"_hopeful": [], "_may_be_trusted": []}
    for name, real in [(n, getattr(pii, n)) for n in left]:
        def counted(patterns, *rest, name=name, real=real):
            some = real(patterns, *rest)
            left[name].append(patterns.select("pattern").distinct().count() - some.count())
            return some
        monkeypatch.setattr(pii, name, counted)
    monkeypatch.setattr(pii, "RANGES", 4)
    pruned = spans()
    assert max(left["_hopeful"]) > 0 and max(left["_may_be_trusted"]) > 0
    for name in left:
        monkeypatch.setattr(pii, name, lambda patterns, *rest: patterns.select("pattern").distinct())
    assert pruned == spans()


def test_redaction_replaces_spans_and_keeps_columns(spark):
    rows = [(1, "mail a@b.co or 10.0.0.1 é"), (2, "nothing"), (3, None), (4, "key " + "ab" * 16)]
    docs = docs_df(spark, rows).withColumn("spans", F.lit(5)).withColumn("base", F.lit("x")).drop("spans", "base")
    got = by_id(pii.redact(docs))
    assert got[1]["text"] == "mail [email] or [ip] é" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "nothing" and got[3]["text"] is None and got[4]["text"] == "key [secret]"
    assert pii.redact(docs.limit(0)).count() == 0


def _rows_of_text_moved(df):
    """Rows that the executed plan of ``df`` moved in shuffles whose rows hold a text."""
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(p.plan())
        elif name == "Exchange" and re.search(r"\b(__)?text#", p.output().toString()):
            n += p.metrics().get("shuffleRecordsWritten").get().value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def test_only_texts_with_found_spans_are_moved(spark, monkeypatch):
    """Without broadcasts by size, a document without a found identifier moves in no join, and every one is there."""
    cards = [c for c in (str(4_111_111_111_110_000 + i) for i in range(300)) if base_spans(c)]
    rows = [(i, f"please use account no {c} today") for i, c in enumerate(cards)]
    rows += [(100, "see account no 7788-1234 now"), (101, "ref 7788-1234.")] + [(1000 + i, f"plain text {i}") for i in range(500)]
    looked = []
    real = pii._told_apart
    monkeypatch.setattr(pii, "_told_apart", lambda texts, few: looked.append(real(texts, few)) or looked[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        clean = pii.redact(docs_df(spark, rows + [(101, None), (1000, "plain text 0")]))
        got = sorted((r["doc_id"], r["text"] or "") for r in clean.collect())
        assert _rows_of_text_moved(clean) == 2
        # the pattern's own cards and one number, the number wherever it stands, and its marks
        assert [x.where("__may").count() for x in looked] == [len(cards) + 1, 2, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = [(i, "please use account no [card] today") for i in range(len(cards))] + [(100, "see account no [ctx] now"), (101, "ref [ctx].")]
    assert got == sorted(want + [(i, t) for i, t in rows if i >= 1000] + [(101, ""), (1000, "plain text 0")])


def test_rows_that_share_a_slot_are_left_to_the_join(spark, monkeypatch):
    """Negative, large and 64 bits apart: no row of the few is told apart, with many slots hardly another one is."""
    rows = spark.range(0, 3000).select(F.expr("CASE WHEN id % 3 = 0 THEN id * 8589934592 WHEN id % 3 = 1 THEN -id ELSE id END").alias("__row"))
    few = rows.where("__row % 7 = 0")
    for slots, most in ((1 << 22, 5), (128, 3000)):
        monkeypatch.setattr(pii, "SLOTS", slots)
        may = {r["__row"]: r["__may"] for r in pii._told_apart(rows, few).collect()}
        assert len(may) == rows.distinct().count()
        assert all(may[r["__row"]] for r in few.collect())
        assert sum(may.values()) <= few.count() + most
    assert not any(r["__may"] for r in pii._told_apart(rows, few.limit(0)).collect())


def brute_targets(sizes, shares=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: shares[i % 3] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_w = sum(w[s] for s in names if s not in full)
        out = {s: 3 * sizes[s] if s in full else left * w[s] / open_w for s in names}
        over = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not over:
            return out
        full |= over


def mixed_rows(seed=3, n=400):
    rng = random.Random(seed)
    src = ["b", "a", "é", "Z", None, "tiny"]
    return [(i, " ".join(["w"] * rng.choice([0, 1, 5, 30])) if i % 17 else None, "en", "tiny" if i == 7 else src[rng.randrange(5)]) for i in range(n)] + [(3, "w w", "en", "a")] * 3


@pytest.mark.parametrize("edge", [20_000, 5])
def test_mix_meets_targets(spark, monkeypatch, edge):
    monkeypatch.setattr(mixing, "EDGE_ROWS", edge)
    monkeypatch.setattr(mixing, "RANGES", 8)
    rows = mixed_rows()
    got = mixing.mix(docs_df(spark, rows).withColumn("size", F.lit("x")).withColumn("tie", F.lit(0))).collect()
    size = lambda t: len((t or "").split())
    total = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + size(r[1])
    want, taken = brute_targets(total), {}
    assert len(got) == len(rows)
    for g in got:
        assert g["source_size"] == total[g["source"]] and g["target"] == pytest.approx(want[g["source"]])
        assert g["taken"] <= 3 * g["size"] and (g["size"] == 0 or g["taken"] % g["size"] == 0)
        taken[g["source"]] = taken.get(g["source"], 0) + g["taken"]
    for s in total:
        assert abs(taken[s] - want[s]) <= 30 * 4
    again = mixing.mix(docs_df(spark, rows[::-1])).collect()
    assert sorted((g["doc_id"], g["size"], g["taken"]) for g in got) == sorted((g["doc_id"], g["size"], g["taken"]) for g in again)


def test_mix_takes_complete_epochs_first_and_prefers_quality(spark):
    rows = [(i, "w " * 10, "en", "a") for i in range(200)] + [(1000 + i, "w " * 10, "en", s) for i in range(600) for s in ("b", "c")]
    docs = docs_df(spark, rows).withColumn("q", (F.col("doc_id") % 2).cast("double") * 9 + 0.1)
    got = [r for r in mixing.mix(docs, F.col("q")).collect()]
    a = [g for g in got if g["source"] == "a"]
    assert {g["copies"] for g in a} == {3}                       # the share is above three times the source
    c = [g for g in got if g["source"] == "c" and g["copies"]]
    assert sum(g["doc_id"] % 2 for g in c) / len(c) > 0.7


def test_mixed_rows_and_empty_table(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, labels=labels).collect() if r["copies"]}
    out = mixing.mixed(docs, labels)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == want
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0), labels).count() == 0


URLS = [None, "", "no scheme", "http://", "http://ORG/", "https://a.Example.ORG/es/x?y=/z", "http://example.org/en/12#/q", "http://example.org", "http://myexample.org/en/1",
        "ftp://x.com/de/", "http://x.com/fr/de", "http://x.com/de", "http://com//de/", "http://a.b.com?x/fr/", "http://u@org:80/", "http://.org/a", "http://x.org./a", "a://b://c.org/d"]


def test_trie_matches_a_scan_of_the_rules(spark):
    rules = URL_RULES + [url_filter.Rule("block", "com", "/fr/d"), url_filter.Rule("allow", "com", "/fr/d"), url_filter.Rule("block", "b.com", ""), url_filter.Rule("block", None, "/")]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = by_id(url_filter.filter_urls(df, rules), "page_id")
    for i, u in enumerate(URLS):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [r for r in rules if r.host and host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict), default=None)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        assert got[i]["rule"] == (best.host + best.path if best else None), u
        assert got[i]["verdict"] == (best.verdict if best else "allow")
    assert url_filter.filter_urls(df.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        url_filter.filter_urls(df, rules, default="maybe")


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.PieceTable.load()


HARD = ["", "a", " ", "   ", "Hello  world", "tab\tand\nline ", "é　x y", "日本語テキスト", "x" * 500, "ab " * 50, "▁mark", "🙂 ok", "the" * 40, "1234567890" * 10]


def test_encoding_equals_the_library(pieces):
    import sentencepiece as library
    model = library.SentencePieceProcessor(model_file=sentencepiece.MODEL_FILE)
    rng = random.Random(8)
    texts = HARD + ["".join(rng.choice("abcdeé  \n.▁日") for _ in range(rng.randint(1, 90))) for _ in range(300)]
    for t, ids in zip(texts, sentencepiece.encode_texts(texts, pieces)):
        assert ids.tolist() == model.encode(t), t
        assert sentencepiece.decode_ids(ids, pieces) == t.replace("▁", " ")


def test_single_and_bulk_folds_agree(pieces, monkeypatch):
    words = ["▁there", "▁other", "thingly", "▁éxyz"]
    bulk = sentencepiece.encode_words(words, pieces)
    monkeypatch.setattr(sentencepiece, "LONG_WORD", 0)
    alone = sentencepiece.encode_words(words, pieces)
    assert {w: x.tolist() for w, x in bulk.items()} == {w: x.tolist() for w, x in alone.items()}


def test_viterbi_fold_of_a_unigram_table():
    table = sentencepiece.PieceTable(["<unk>", "▁", "a", "b", "ab", "ba", "▁ab", "aba"], [0, -1.5, -1.1, -1.2, -1.6, -0.9, -2.4, -3.5], ["other"] + ["normal"] * 7, bpe=False)
    best = {}

    def walk(word, at, ids, total):
        if at == len(word):
            if word not in best or total > best[word][0] + 1e-12:
                best[word] = (total, ids)
            return
        for j in range(at + 1, len(word) + 1):
            p = table.ids.get(word[at:j])
            if p is not None:
                walk(word, j, ids + [p], total + table.score[p])

    words = ["▁abab", "▁ba", "abaab", "▁a"]
    got = sentencepiece.encode_words(words, table)
    for w in words:
        walk(w, 0, [], 0.0)
        assert sum(table.score[i] for i in got[w]) == pytest.approx(best[w][0]), w
    assert sentencepiece.encode_words(["axb"], table)["axb"].tolist() == [2, 0, 3]


def test_known_words_are_kept_in_flat_arrays(pieces):
    known = sentencepiece.Known()
    texts = ["", "one two one", "\U0001f9ff\x00 two " + "x" * 60, " two"]
    first = sentencepiece.encode_texts(texts, pieces, known)
    again = sentencepiece.encode_texts(texts[::-1], pieces, known)
    assert [x.tolist() for x in first] == [x.tolist() for x in again[::-1]]
    assert [sentencepiece.decode_ids(x, pieces) for x in first] == texts
    # one number a word, and no array of its own
    words = {w for t in texts for w in sentencepiece.words_of(t)}
    assert set(known.number) == words and sorted(known.number.values()) == list(range(len(words)))
    assert len(known.size) == len(words) and known.size.sum() == len(known.ids)


def test_encode_and_decode_tables(spark, pieces):
    docs = docs_df(spark, [(i, t) for i, t in enumerate(HARD)] + [(99, None), (99, None)]).withColumn("decoded", F.lit(1)).withColumn("ids", F.lit("x"))
    got = sentencepiece.encode_with_check(docs, pieces).collect()
    assert len(got) == len(HARD) + 2 and all(r["round_trip"] == (sentencepiece.MARK not in (r["text"] or "")) for r in got)
    # the mark of a blank in a text comes back as a blank
    lost = sentencepiece.encode_with_check(docs_df(spark, [(1, f"a{sentencepiece.MARK}b"), (2, "a b")]), pieces)
    assert {r["doc_id"]: r["round_trip"] for r in lost.collect()} == {1: False, 2: True}
    assert [len(r["ids"]) for r in got if r["doc_id"] == 99] == [0, 0]
    odd = spark.createDataFrame([(1, None), (2, [-5, 10**6, 413])], "k int, ids array<int>")
    assert [r["text"] for r in sentencepiece.decode(odd, pieces).orderBy("k").collect()] == ["", pieces.back[413].decode().strip()]
    assert sentencepiece.encode(docs.limit(0), pieces).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 4 <= len(P.STAGES) <= 5
    for name, stage in P.STAGES:
        out = stage(spark, docs, SMALL)
        if name != P.STAGES[-1][0]:
            assert out.columns == docs.columns, name
    done = P.run(spark, SMALL).collect()
    assert done and all(r["round_trip"] for r in done)
    assert not [r for r in done if base_spans(r["text"])]
    assert np.isin([r["doc_id"] for r in done], [r["doc_id"] for r in docs.select("doc_id").collect()]).all()
