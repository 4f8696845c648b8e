"""Quality classifier: a factorisation machine over words, structure and metadata.

Features of a document: words hashed to ``2**HASH_BITS`` slots (weight
``1 + ln tf``, scaled to length 1), structure statistics of the whole text
(lengths, line and word repetition, character classes, punctuation) and the
metadata column ``n_chars``.  The score is
``sigmoid(w0 + sum w_i x_i + 1/2 sum_f((sum v_if x_i)^2 - sum (v_if x_i)^2))``:
the sum-of-squares identity makes it linear in the number of features.

The model is fitted in one task on a bounded sample: at most
``max_train_rows`` labelled documents, those with the least hash of doc_id
among the allowed rows.  Its size depends on HASH_BITS and RANK only, and it is broadcast.
Scoring is a map over whole texts; nothing is shuffled.

Defined cases: NULL text counts as empty; empty texts get the score of their
structure features alone; NULL n_chars counts as the text's own length; NULL
labels or ids teach nothing; several labels of one document: the least counts.
Without a usable label of both kinds the score is the share of ones (0.5 if
there is none) for every document.
"""

from __future__ import annotations

import pickle
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, fresh_name

HASH_BITS = 14
RANK = 8
MAX_TRAIN_ROWS = 6_000
THRESHOLD = 0.3
EPOCHS = 25
_SLOTS = 1 << HASH_BITS
_PUNCT = b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"

# byte classes: 0 other, 1 upper, 2 lower, 3 digit, 4 blank, 5 newline, 6 non-ASCII, 7.. one per punctuation mark
_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[[9, 32]], _CLASS[[10, 13]], _CLASS[128:] = 1, 2, 3, 4, 5, 6
for _i, _c in enumerate(_PUNCT):
    _CLASS[_c] = 7 + _i
N_DENSE = 8 + 7 + len(_PUNCT)


def features(text: str | None, n_chars) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots int32, values float32, dense float32) of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    tf = Counter(words)
    slots: dict[int, float] = {}
    for w, n in tf.items():
        h = zlib.crc32(w.encode("utf-8", "surrogatepass")) % _SLOTS
        slots[h] = slots.get(h, 0) + n
    ids = np.fromiter(slots.keys(), np.int32, len(slots))
    vals = 1 + np.log(np.fromiter(slots.values(), np.float32, len(slots))) if slots else np.zeros(0, np.float32)
    norm = float(np.sqrt((vals * vals).sum())) or 1.0
    lines = text.split("\n")
    classes = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=7 + len(_PUNCT)) / max(1, len(raw))
    claimed = len(text) if n_chars is None or n_chars != n_chars else float(n_chars)
    dense = np.array([np.log1p(len(text)), np.log1p(len(words)), len(text) / (1 + len(words)), len(tf) / max(1, len(words)),
                      1 - len(set(lines)) / len(lines), max(tf.values(), default=0) / max(1, len(words)),
                      np.log1p(max(0.0, claimed)), np.log1p(abs(claimed - len(text)))])
    return ids, (vals / norm).astype(np.float32), np.concatenate([dense, classes]).astype(np.float32)


def _sparse(parts):
    """Concatenated (ids, vals, starts of each row); an empty row gets one zero entry."""
    ids = [p[0] if len(p[0]) else np.zeros(1, np.int32) for p in parts]
    vals = [p[1] if len(p[0]) else np.zeros(1, np.float32) for p in parts]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])[:-1]]).astype(np.int64)
    return np.concatenate(ids), np.concatenate(vals), starts


class FactorisationMachine:
    """w0, w and V over [hashed words | standardised dense features]."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.w0, self.share = 0.0, None
        self.w = np.zeros(_SLOTS + N_DENSE, np.float32)
        self.v = r.normal(0, 0.03, (_SLOTS + N_DENSE, RANK)).astype(np.float32)
        self.mean, self.std = np.zeros(N_DENSE, np.float32), np.ones(N_DENSE, np.float32)

    def _scaled(self, dense):
        return np.clip((dense - self.mean) / self.std, -5, 5) / np.sqrt(N_DENSE)

    def _forward(self, ids, vals, starts, x):
        vx = self.v[ids] * vals[:, None]
        vd = self.v[_SLOTS:]
        total = np.add.reduceat(vx, starts) + x @ vd
        squares = np.add.reduceat((vx * vx).sum(1), starts) + (x * x) @ (vd * vd).sum(1)
        z = self.w0 + np.add.reduceat(self.w[ids] * vals, starts) + x @ self.w[_SLOTS:] + 0.5 * ((total * total).sum(1) - squares)
        return z, total, vx

    def score(self, parts) -> np.ndarray:
        if self.share is not None:
            return np.full(len(parts), self.share)
        ids, vals, starts = _sparse(parts)
        z = self._forward(ids, vals, starts, self._scaled(np.stack([p[2] for p in parts])))[0]
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))

    def fit(self, parts, y, epochs: int = EPOCHS, rate: float = 0.05, l2: float = 1e-4, seed: int = 5):
        y = np.asarray(y, np.float32)
        if len(y) == 0 or y.min() == y.max():
            self.share = float(y.mean()) if len(y) else 0.5
            return self
        dense = np.stack([p[2] for p in parts])
        self.mean, self.std = dense.mean(0), np.maximum(dense.std(0), 1e-4)
        x_all = self._scaled(dense)
        self.w0 = float(np.log(y.mean() / (1 - y.mean())))
        gw, gv = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)
        r = np.random.default_rng(seed)
        for _ in range(epochs):
            order = r.permutation(len(y))
            for rows in np.array_split(order, max(1, len(y) // 128)):
                ids, vals, starts = _sparse([parts[i] for i in rows])
                x = x_all[rows]
                z, total, vx = self._forward(ids, vals, starts, x)
                err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
                of = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(ids))))
                touched, at = np.unique(ids, return_inverse=True)
                e = (err[of] * vals)
                dw = np.bincount(at, e, len(touched)) + l2 * self.w[touched]
                dv = np.stack([np.bincount(at, e * (total[of, f] - vx[:, f]), len(touched)) for f in range(RANK)], 1) + l2 * self.v[touched]
                gw[touched] += dw ** 2
                gv[touched] += dv ** 2
                self.w[touched] -= rate * dw / np.sqrt(gw[touched])
                self.v[touched] -= rate * dv / np.sqrt(gv[touched])
                d, vd = slice(_SLOTS, None), self.v[_SLOTS:]
                dw = err @ x + l2 * self.w[d]
                dv = x.T @ (err[:, None] * total) - ((err @ (x * x))[:, None] * vd) + l2 * vd
                gw[d] += dw ** 2
                gv[d] += dv ** 2
                self.w[d] -= rate * dw / np.sqrt(gw[d])
                self.v[d] -= rate * dv / np.sqrt(gv[d])
                self.w0 -= rate * float(err.sum())
        return self


def train(docs: DataFrame, labels: DataFrame, allowed: Column, max_train_rows: int = MAX_TRAIN_ROWS) -> FactorisationMachine:
    """Fit on at most ``max_train_rows`` labelled documents for which ``allowed`` (over doc_id) holds."""
    picked = (labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & allowed)
              .groupBy("doc_id").agg(F.min("quality").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))  # bounded: broadcast below
    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    rows = docs.select("doc_id", "text", n_chars.alias("n_chars")).join(F.broadcast(picked), "doc_id")

    def extract(batches):
        for b in batches:
            out = [features(t, n) for t, n in zip(b["text"], b["n_chars"])]
            yield pd.DataFrame({"doc_id": b["doc_id"], "y": b["y"], "f": [pickle.dumps(x) for x in out]})

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["doc_id", "f"]).assign(k=[zlib.crc32(x) for x in group.drop_duplicates(["doc_id", "f"])["f"]]).sort_values(["doc_id", "k"])
        model = FactorisationMachine().fit([pickle.loads(x) for x in group["f"]], group["y"].to_numpy())
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    made = (rows.mapInPandas(extract, "doc_id long, y int, f binary")
            .groupBy(F.lit(0).alias("one")).applyInPandas(fit, "model binary").first())
    return pickle.loads(made[0]) if made else FactorisationMachine().fit([], [])


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus score and predicted (existing columns of those names are replaced)."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(text: pd.Series, n_chars: pd.Series) -> pd.Series:
        out = np.empty(len(text))
        for i in range(0, len(text), 500):
            parts = [features(t, n) for t, n in zip(text[i:i + 500], n_chars[i:i + 500])]
            out[i:i + 500] = shared.value.score(parts)
        return pd.Series(out)

    n_chars = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    name = fresh_name(docs, "fm_score")
    return (docs.withColumn(name, judge(F.col("text"), n_chars))
            .withColumn("score", F.col(name)).drop(name)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
