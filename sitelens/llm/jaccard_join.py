"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of k-word shingles; two link when
``den * |A n B| >= num * |A u B|``.  Shingles are ordered by an estimated
frequency (a sketch over all documents), rarest first.  If two sets are
similar enough, their prefixes of length ``n - ceil(t n) + l`` share at least
``l`` shingles.  Every document chooses its own ``l``: it lengthens the prefix
while the estimated cost of candidates falls; a pair is verified only if its
prefixes share ``min(l_x, l_y)`` shingles or more, the shingles left after
its first common one are enough, and parity signatures do not show too many
differences.  Each of these is a necessary condition: no link is lost.

Equal sets collapse first.  Within the postings of a shingle not all pairs are
made: one member is compared with the others, links are
contracted to components, and only postings that still hold different
components go on, with geometrically more pivots and pairs across components
only.  So every pair that might join two components is verified, and a large
group of near copies costs a few comparisons per member.

Defined cases: NULL, empty or blank texts have an empty set, link with nothing
and are their own component; fewer than k words: the whole sequence is the one
shingle; a NULL doc_id links with nothing and has a NULL component; repeated rows
with one id count as one document for links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.session import drop_unused

from .bytehash import pack, shingle_sets, shingle_stream, unpack
from .common import bounded_batches, components, discard, slices, stored
from .sketch import member_filter, slot_counts

SKETCH_BITS = 20
MAX_MATCHES = 4
#: Longs in a set's parity signature.
SIGNATURE = 16
#: Cost of fetching and verifying a candidate, in postings read.
VERIFY_COST = 8.0


def _sets_of(batches, k: int, grams: bool):
    """Batches of (doc_id, text) -> batches of ``shingle_table``."""
    for b in batches:
        texts = [t or "" for t in b["text"]]
        for i, j in slices(np.array([len(t) for t in texts])):
            sets = shingle_sets(texts[i:j], k)
            raw = [pack(s) for s in sets]
            f = [np.frombuffer(hashlib.blake2b(r, digest_size=16).digest(), "<i8") for r in raw]
            out = pd.DataFrame({"doc_id": b["doc_id"].iloc[i:j].to_numpy(), "n": np.array([len(s) for s in sets], np.int64),
                                "f1": [x[0] for x in f], "f2": [x[1] for x in f]})
            yield out.assign(grams=raw) if grams else out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def shingle_table(docs: DataFrame, k: int, grams: bool = False) -> DataFrame:
    """(doc_id, n, f1, f2): set size and 128-bit fingerprint of the set; with ``grams`` its packed sorted hashes."""
    return _texts(docs).mapInPandas(lambda batches: _sets_of(batches, k, grams),
                                    "doc_id long, n long, f1 long, f2 long" + (", grams binary" if grams else ""))


def choose_matches(freq: np.ndarray, base: int, most: int = MAX_MATCHES) -> int:
    """The l of least estimated cost: postings read plus candidates (at most their sum / l) verified."""
    best, cost, upto = 1, None, np.cumsum(freq[:base + most - 1], dtype=np.float64)
    for l in range(1, most + 1):
        if base + l - 1 > len(freq):
            break
        c = upto[base + l - 2] * (1 + VERIFY_COST / l)
        if cost is None or c < cost:
            best, cost = l, c
    return best


def frequency_levels(docs: DataFrame, k: int, bits: int) -> np.ndarray:
    """Estimated shingle frequency per hash slot over all documents, as powers of sqrt(2): an order needs one byte."""
    def values(b):
        texts = [t or "" for t in b["text"]]
        parts = [shingle_stream(texts[i:j], k) for i, j in slices(np.array([len(t) for t in texts]))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    counts = slot_counts(docs.select("text"), values, bits)
    # what is left above the noise of the slots
    return np.minimum(255, 2 * np.log2(np.maximum(1, counts - np.median(counts) + 1))).astype(np.uint8)


def prefixes(docs: DataFrame, k: int, num: int, den: int, bits: int) -> DataFrame:
    """(doc_id, n, f1, f2, matches, prefix, parity) of non-empty sets, each with its own number of matches.

    parity: per hash slot whether it holds an odd number of shingles.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs, k, bits))
    mask = np.uint64((1 << bits) - 1)

    def extract(batches):
        # sets and prefixes in one Python worker per task
        for b in _sets_of(batches, k, True):
            b = b[b["n"] > 0]
            if b.empty:
                continue
            matches, prefix, parity = [], [], []
            for raw, n in zip(b["grams"], b["n"]):
                g = unpack(raw)
                odd = (np.bincount((g >> np.uint64(20)).astype(np.int64) % (64 * SIGNATURE), minlength=64 * SIGNATURE) & 1).astype(np.uint8)
                parity.append(np.packbits(odd).view("<i8"))
                lv = shared.value[(g & mask).astype(np.int64)]
                order = np.lexsort((g, lv))
                base = n - (num * n + den - 1) // den + 1
                m = choose_matches(2.0 ** (lv[order].astype(np.float64) / 2) - 1, base)
                matches.append(m)
                prefix.append(g[order[:base + m - 1]].astype(np.int64))
            yield b[["doc_id", "n", "f1", "f2"]].assign(matches=np.array(matches, np.int32), prefix=prefix, parity=parity)

    return _texts(docs).mapInPandas(
        extract, "doc_id long, n long, f1 long, f2 long, matches int, prefix array<long>, parity array<long>")


def _common(a: bytes, b: bytes) -> int:
    both = np.concatenate([unpack(a), unpack(b)])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def verify(pairs: DataFrame, pre: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """The (x, y) of ``pairs`` that share enough prefix shingles and then really link."""
    # sort-merge joins at every size: a hot pivot is split, and no side is broadcast by a size that may grow
    def asked(rows: DataFrame, s: str):
        return member_filter(rows.select(F.xxhash64(s).alias("h")).distinct())

    def side(rows: DataFrame, s: str, **columns: str) -> DataFrame:
        some = pre.where(asked(rows, s)(F.xxhash64("doc_id")))
        return some.select(F.col("doc_id").alias(s), *[F.col(c).alias(name) for name, c in columns.items()]).hint("merge")

    # every slot whose parity differs holds a shingle that only one of the sets has
    differ = F.aggregate(F.zip_with("qx", "qy", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    close = F.lit(num + den) * differ <= F.lit(den - num) * (F.col("nx") + F.col("ny"))
    # signatures first: prefixes, several times as long, move only for pairs that these leave
    near = pairs.join(side(pairs, "x", mx="matches", nx="n", qx="parity"), "x").join(side(pairs, "y", my="matches", ny="n", qy="parity"), "y")
    near = stored(near.where(close).select("x", "y", F.least("mx", "my").alias("need")), "jac-close")
    cand = stored(near.join(side(near, "x", px="prefix"), "x").join(side(near, "y", py="prefix"), "y")
                  .where(F.size(F.array_intersect("px", "py")) >= F.col("need")).select("x", "y"), "jac-candidates")
    discard(near)

    if cand.isEmpty():
        return cand

    def grams(s: str) -> DataFrame:
        # sets are made again for the documents asked for; no set of all documents is stored or shuffled
        some = docs.where(asked(cand, s)(F.xxhash64(F.col("doc_id").cast("long"))))
        return shingle_table(some, k, grams=True).select(F.col("doc_id").alias(s), F.col("n").alias(f"n{s}"), F.col("grams").alias(f"g{s}")).hint("merge")

    @F.pandas_udf("long")
    def common(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_common(x, y) for x, y in zip(a, b)], dtype="int64")

    return (cand.join(grams("y"), "y").join(grams("x"), "x").withColumn("both", common("gx", "gy"))
            .where(F.lit(den) * F.col("both") >= F.lit(num) * (F.col("nx") + F.col("ny") - F.col("both"))).select("x", "y"))


def similarity_components(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, bits: int = SKETCH_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_copies (rows with the same set)."""
    if not 0 < num <= den:
        raise ValueError("the threshold must be in (0, 1]")
    bounded_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sets = stored(shingle_table(docs, k), "jac-sets")
    kind = ["n", "f1", "f2"]
    classes = stored(sets.where("n > 0 and doc_id is not null").groupBy(*kind).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "jac-classes")
    pre = stored(prefixes(docs.where(F.col("doc_id").isNotNull()), k, num, den, bits)
                 .join(classes.withColumnRenamed("rep", "doc_id").select("doc_id", *kind), ["doc_id", *kind], "left_semi")
                 .dropDuplicates(["doc_id", *kind]), "jac-prefixes")
    # postings of shingles that occur in two prefixes or more
    tokens = pre.select(F.explode("prefix").alias("token"))
    posts = stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "jac-postings")
    twice = member_filter(posts.select(F.col("token").alias("h")))
    big = F.lit(1 << 62)
    def rank(col: str):
        return F.xxhash64(F.lit(5), F.col(col)).bitwiseAND(big - 1) / big

    index = stored(pre.select("doc_id", "n", F.posexplode("prefix").alias("pos", "token")).where(twice("token")).join(posts, "token")
                   .withColumn("room", F.col("n") - F.col("pos")).drop("pos").withColumn("h", rank("doc_id")), "jac-index")

    def possible():
        # at a pair's first common shingle no more than min(room) can be common; a pair that fails there fails everywhere
        return F.lit(num) * (F.col("n") + F.col("pn")) <= F.lit(num + den) * F.least("room", "proom")

    def pairs_of(rows: DataFrame) -> DataFrame:
        """Distinct (x, y) of members and pivots; x has the lower hash."""
        first = F.struct("h", "doc_id") < F.struct(rank("p").alias("h"), F.col("p").alias("doc_id"))
        return rows.select(F.when(first, F.col("doc_id")).otherwise(F.col("p")).alias("x"), F.when(first, F.col("p")).otherwise(F.col("doc_id")).alias("y")).distinct()

    # the first pivot of a posting is the member with most room
    pivots = index.groupBy("token").agg(F.max(F.struct("room", -F.col("h"), "doc_id", "n")).alias("p"))
    pivots = stored(pivots.select("token", F.col("p.doc_id").alias("p"), F.col("p.n").alias("pn"), F.col("p.room").alias("proom")), "jac-pivots")
    pairs = stored(pairs_of(index.join(pivots, "token").where((F.col("doc_id") != F.col("p")) & possible())), "jac-pairs")
    seen = pairs
    discard(posts, pivots)
    links = stored(verify(pairs, pre, docs, k, num, den), "jac-links")
    comp = stored(components(links, "x", "y"), "jac-components")
    discard(links)
    whole = index                                           # the files behind ``index``
    index = index.where("df > 2")                           # the others are done
    lower, upper = 0.0, 8.0
    while True:
        now = (index.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id")))
        # postings of more than two members whose members are in different components, and that have pivots left
        still = stored(now.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.max("df").alias("of"))
                       .where((F.col("lo") < F.col("hi")) & (F.col("of") > lower)).select("token"), "jac-open")
        if still.isEmpty():
            break
        now = stored(now.join(still, "token").withColumn("at", F.col("h") * F.col("df")).where(F.col("at") >= lower), "jac-round")
        discard(whole, still)
        whole = now
        turn = now.where(F.col("at") < upper).select("token", F.col("doc_id").alias("p"), F.col("n").alias("pn"), F.col("room").alias("proom"), F.col("c").alias("pc"), F.col("h").alias("ph"))
        fresh = pairs_of(now.join(turn, "token").where((F.col("c") != F.col("pc")) & possible() & (F.struct("h", "doc_id") > F.struct("ph", "p"))))
        fresh = stored(fresh.join(seen, ["x", "y"], "left_anti"), "jac-pairs")
        if not fresh.isEmpty():
            more = stored(verify(fresh, pre, docs, k, num, den), "jac-links")
            both = stored(seen.unionByName(fresh), "jac-seen")
            discard(seen, fresh)
            seen = both
            if not more.isEmpty():
                joined = stored(components(comp.select(F.col("node").alias("x"), F.col("component").alias("y")).unionByName(more), "x", "y"), "jac-components")
                discard(comp, more)
                comp = joined
        index = now.select(*index.columns)                  # done postings stay done
        lower, upper = upper, upper * 32
    discard(whole, still, seen, pre)
    # what was moved for the links goes before a caller moves texts
    drop_unused(docs.sparkSession)
    out = sets.join(classes, kind, "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"),
                      F.coalesce("copies", F.lit(1)).alias("n_copies"))


def keep_one_per_component(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the least of its component; of rows with one id and equal texts one stays.

    Rows with a NULL doc_id stay.  Different texts with one id share their links, so they stay or go together.
    """
    rows = similarity_components(docs, k, num, den).where("doc_id = component_id")
    kept = stored(rows.groupBy(F.col("doc_id").alias("__kept")).agg(F.count(F.lit(1)).alias("__rows")), "jac-kept")
    same = F.col("doc_id").cast("long") == F.col("__kept")
    once = docs.join(kept.where("__rows = 1"), same, "left_semi")
    repeated = docs.join(kept.where("__rows > 1"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated).unionByName(docs.where(F.col("doc_id").isNull()))
