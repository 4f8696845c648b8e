"""Importance resampling towards a target distribution, on Arrow kernels.

Features of a text are the runs of 1 to ``max_n`` consecutive words, repeats
counted, hashed into ``buckets``.  A bucket's gain is the scaled log ratio of its
add-one shares in the target texts and in all documents; a document's weight is
the sum over its features.  A Gumbel number made from the seed and the id is
added, and the highest scores are drawn, which samples without replacement in
proportion to exp(weight).

Each Arrow batch is lower-cased (``ascii_lower``), cut (``split_pattern_regex``),
flattened (``list_flatten``) and its words numbered (``dictionary_encode``).  An
n-gram is a pair: the number of the (n-1)-gram at a position and, by a shifted
view, the number of the word after it.  Only distinct pairs are hashed, each CRC
going on from that of its (n-1)-gram; gains are fetched by ``take`` and added up
by document from one running sum.

Both passes are narrow (no text is shuffled).  A task of the counting pass sends
at most ``buckets`` rows; the driver sees ``buckets`` counts and gains, a bound
given by the parameter.  Ranks come from a range-partitioned numbering.

Defined cases: a NULL or empty text has no words, weight 0 and is never drawn
unless ``min_words`` is 0; a NULL id hashes as the empty text and sorts first;
repeated rows are documents of their own (equal scores rank by id, then in
stored order); empty tables give an empty result, or gains from the add-one
counts alone; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sequence import number_rows
from .common import bounded_batches, stored

#: Everything between two words, after lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Scores are integers: natural logarithms in thousandths.
SCALE = 1000.0


def word_numbers(texts: pa.Array):
    """(distinct words, number of every word, row of every word); a NULL text has none."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    words, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(words, "")     # a text that begins or ends with a separator
    coded = words.filter(real).dictionary_encode()
    return (coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            rows.filter(real).to_numpy(zero_copy_only=False).astype(np.int64))


def feature_buckets(texts: pa.Array, max_n: int, buckets: int):
    """(bucket of every feature, row of every feature, words by row); features go by n, then by position."""
    vocabulary, number, row = word_numbers(texts)
    words = [w.as_buffer().to_pybytes() for w in vocabulary]
    crc = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
    grams, found, rows = number, [(crc % buckets)[number]], [row]
    for n in range(2, max_n + 1):
        last = n - 1                                     # distance of the last word from the first
        inside = row[:-last] == row[last:] if len(row) > last else np.zeros(0, bool)
        starts = np.flatnonzero(inside)
        pair = grams[starts] * len(words) + number[starts + last]
        distinct, which = np.unique(pair, return_inverse=True)
        crc = np.fromiter((zlib.crc32(b" " + words[p % len(words)], int(crc[p // len(words)])) for p in distinct.tolist()),
                          np.int64, len(distinct))
        found.append((crc % buckets)[which])
        rows.append(row[starts])
        # numbers of the n-grams by start; places without one are never looked at again
        grams = np.zeros(len(number), np.int64)
        grams[starts] = which
    return np.concatenate(found), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def bucket_counts(texts: DataFrame, max_n: int, buckets: int) -> DataFrame:
    """(bucket, n) of the features of all rows of ``texts`` (text); a task sends each bucket once at most."""
    def count(batches):
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(feature_buckets(b.column(0), max_n, buckets)[0], minlength=buckets)
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(n[hit], pa.int64())], ["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, max_n: int, buckets: int) -> np.ndarray:
    """Gain of every bucket: floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets))))."""
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for texts, into in ((source, s), (target, t)):
        for r in bucket_counts(texts, max_n, buckets).collect():      # at most ``buckets`` rows
            into[r["bucket"]] = r["n"]
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(SCALE * math.log(float(b + 1) * all_s / (float(a + 1) * all_t))) for a, b in zip(s.tolist(), t.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, max_n: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    table = pa.array(gain)

    def add_up(batches):
        for b in batches:
            found, rows, words = feature_buckets(b.column(1), max_n, len(gain))
            order = np.argsort(rows, kind="stable")
            total = np.concatenate([[0], np.cumsum(pc.take(table, pa.array(found[order])).to_numpy())])
            n = np.bincount(rows, minlength=b.num_rows)
            ends = np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array((total[ends] - total[ends - n]).astype(np.int64))],
                ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(add_up, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = 10_000, seed: int = 2024,
             min_words: int = 20, percent: int = 10) -> DataFrame:
    """Every row of ``docs`` as (doc_id, n_features, weight, score, rank); rank is NULL where not drawn.

    Of the documents with ``min_words`` words or more, ``percent`` per cent (rounded down) are drawn.
    """
    bounded_batches(docs.sparkSession)
    w = weigh(docs, gains(docs, target, max_n, buckets), max_n)
    seeded = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    u = (F.conv(F.substring(seeded, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    score = F.col("weight") + F.floor(F.lit(-SCALE) * F.log(-F.log(u)))
    # written once: the order of equal rows is fixed
    scored = stored(w.select("doc_id", "n_words", "n_features", "weight", score.cast("long").alias("score"),
                             F.monotonically_increasing_id().alias("row")), "importance-scores")
    may = F.col("n_words") >= min_words
    draw = scored.where(may).count() * percent // 100
    ranked = number_rows(scored.where(may), [F.desc("score"), F.asc_nulls_first("doc_id"), "row"], "rank")
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    return (ranked.select(*out, F.when(F.col("rank") <= draw, F.col("rank")).alias("rank"))
            .unionByName(scored.where(~may).select(*out, none)))
