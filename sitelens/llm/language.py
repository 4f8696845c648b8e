"""Language ID by multilingual mixture inference.

Every learned language has a distribution over hashed byte trigrams of the
lower-cased text.  A document is a mixture: each word was written in one
language, expectation-maximisation estimates the proportions from the words'
trigram likelihoods, and languages leave the set one by one, least proportion
first, as long as the likelihood penalised by ``penalty * ln(words)`` per
language does not get worse.  The language with the largest proportion in the set
is predicted; the score is its proportion.

Counts are learned from a bounded sample: an expected ``max_docs`` documents
shared evenly by the languages (hash of doc_id below a rate per language);
at most ``max_langs`` languages, the most frequent.  The model, languages x
2**16 floats, is broadcast.  Prediction is a map over whole texts.

Defined cases: NULL text, or text without a letter: ``und`` with score 0; a
NULL lang teaches nothing; nothing learned: ``und`` with score 0 everywhere;
ties go to the language that is first by code point.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh_name, slices

BUCKETS = 1 << 16
MAX_DOCS = 4_000
MAX_LANGS = 256
UNDETERMINED = "und"


def _trigrams(buf: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that starts at each byte (the last two are padded)."""
    b = np.concatenate([buf, np.full(2, 32, np.uint8)]).astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.uint16)


def _bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the lower-cased texts, each framed by blanks; start of each text)."""
    raw = [b" " + t.lower().encode("utf-8", "surrogatepass") + b" " for t in texts]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in raw])[:-1]]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), starts


def train(docs: DataFrame, allowed: Column, max_docs: int = MAX_DOCS, max_langs: int = MAX_LANGS):
    """(languages in code point order, log likelihoods float32 [buckets, languages])."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.coalesce(allowed, F.lit(False)))
    langs = sorted(known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect(), key=lambda r: r["lang"].encode())
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    per = max_docs / len(langs)
    rate = F.lit(0.0)
    for r in langs:
        rate = F.when(F.col("lang") == r["lang"], F.lit(float(min(1.0, per / r["count"])))).otherwise(rate)
    u = F.xxhash64(F.lit("lang-sample"), F.col("doc_id")).bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                if text:
                    buf, _ = _bytes([text])
                    seen[lang] = seen.get(lang, 0) + np.bincount(_trigrams(buf), minlength=BUCKETS)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": n[at].astype(np.int64)})

    counted = (known.where(u < rate).select("lang", "text").mapInPandas(count, "lang string, bucket int, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())  # bounded: languages x buckets
    names = [r["lang"] for r in langs]
    table = np.full((BUCKETS, len(names)), 0.05)
    table[counted["bucket"].to_numpy(int), counted["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(int)] += counted["n"].to_numpy(float)
    return names, np.log(table / table.sum(0)).astype(np.float32)


def _em(like: np.ndarray, doc: np.ndarray, starts: np.ndarray, n: np.ndarray, active: np.ndarray, rounds: int):
    """(proportions, log likelihood less the words' maxima) of each document over its active languages."""
    pi = active / active.sum(1, keepdims=True)
    for _ in range(rounds):
        r = like * pi[doc]
        r /= np.maximum(r.sum(1), 1e-30)[:, None]
        pi = np.add.reduceat(r, starts) / n[:, None]
    total = np.maximum((like * pi[doc]).sum(1), 1e-30)
    return pi, np.add.reduceat(np.log(total), starts)


def infer(texts: list[str], logp: np.ndarray, penalty: float = 3.0, rounds: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """(language index, its proportion) of each text; every text must be non-empty."""
    buf, begin = _bytes(texts)
    blank = (buf <= 32)
    word = blank & ~np.append(blank[1:], True)          # a word starts at the blank before it
    word[begin] = True
    first = np.flatnonzero(word)
    grams = logp[_trigrams(buf)]
    grams[np.append(begin[1:], len(buf)) - 1] = 0        # these would reach into the next text
    ll = np.add.reduceat(grams, first).astype(np.float32)
    like = np.exp(np.maximum(ll - ll.max(1, keepdims=True), -60))
    starts = np.searchsorted(first, begin)
    n = np.diff(np.append(starts, len(first))).astype(np.float64)
    doc = np.repeat(np.arange(len(texts)), n.astype(np.int64))
    k = logp.shape[1]
    active = np.ones((len(texts), k), np.float32)
    pi, fit = _em(like, doc, starts, n, active, rounds)
    cost = penalty * np.log(n + 1)
    going = np.ones(len(texts), bool)
    for left in range(k - 1, 0, -1):
        # drop the least proportion (of ties the last language) and keep the smaller set if it is no worse
        weakest = k - 1 - np.argmin(np.where(active > 0, pi, np.inf)[:, ::-1], axis=1)
        fewer = active.copy()
        fewer[np.arange(len(texts)), weakest] = 0
        todo = np.flatnonzero(going)
        if not len(todo):
            break
        keep = going[doc]
        sub_n = n[todo]
        sub_starts = np.concatenate([[0], np.cumsum(sub_n)[:-1]]).astype(np.int64)
        p2, f2 = _em(like[keep], np.repeat(np.arange(len(todo)), sub_n.astype(np.int64)), sub_starts, sub_n, fewer[todo], rounds if left > 1 else 1)
        better = f2 + cost[todo] >= fit[todo]
        done = todo[better]
        active[done], pi[done], fit[done] = fewer[done], p2[better], f2[better]
        going[todo[~better]] = False
    best = np.argmax(pi, axis=1)
    return best, pi[np.arange(len(texts)), best]


def identify(docs: DataFrame, model, penalty: float = 3.0) -> DataFrame:
    """``docs`` plus lang_pred and score (existing columns of those names are replaced)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def judge(text: pd.Series) -> pd.DataFrame:
        names, logp = shared.value
        pred, score = np.full(len(text), UNDETERMINED, object), np.zeros(len(text))
        usable = [i for i, t in enumerate(text) if t and any(map(str.isalpha, t))] if names else []
        lengths = np.array([len(text.iloc[i]) for i in usable], np.int64)
        for a, b in slices(lengths, 1_000_000):
            rows = usable[a:b]
            best, p = infer([text.iloc[i] for i in rows], logp, penalty)
            pred[rows], score[rows] = np.array(names, object)[best], np.clip(p, 0, 1)
        return pd.DataFrame({"lang_pred": pred, "score": score})

    name = fresh_name(docs, "lang_found")
    out = docs.withColumn(name, judge(F.col("text")))
    return out.withColumns({"lang_pred": F.col(name)["lang_pred"], "score": F.col(name)["score"]}).drop(name)
