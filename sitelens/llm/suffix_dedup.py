"""Suffix-array dedup: removal of every byte covered by a repeated string.

A string of ``min_bytes`` bytes is repeated when it also starts anywhere else,
in the same document or another; matches do not cross documents.

1.  Winnowing.  The least hash among the ``GRAM``-grams of a window is the
    window's anchor.  Equal windows have equal anchors, so only windows whose
    anchor occurs twice can be repeated.  Consecutive windows with one anchor are one
    region; a region is kept as two hashes and coordinates, no text moves.
2.  Regions are counted by (anchor, region hash), pre-aggregated.  An anchor that occurs
    once is done: nothing repeats.  A region that occurs twice repeats as a whole.
3.  Different regions of one anchor go, one copy each with its count, to a
    shard given by the anchor.  Parts of regions whose windows cannot repeat (the
    bytes that neighbouring windows share occur once) are left out.  Of the
    rest the shard builds a suffix array by induced sorting, permuted common
    prefixes, and so the classes of equal windows; windows in a class with two
    or more starts are repeated.
4.  An anchor with more than ``most_regions`` different regions (a passage in
    many contexts) is split: its regions are cut into narrower ranges of windows,
    keyed by the bytes that all windows of a range share, and counted again.
    The narrowest range is one window, which its hash decides.

Every window start belongs to exactly one region, so no start meets itself.

Defined cases: NULL text is empty; texts shorter than ``min_bytes`` keep all;
copies of a document remove each other whole; repeated rows are documents like
any other; a NULL doc_id stays NULL.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytehash import RangeHash, mix
from .common import bounded_batches, slices, stored, text_of
from .sketch import member_filter
from .suffix_array import permuted_lcp, suffix_array

MIN_BYTES = 400
GRAM = 32
MOST_REGIONS = 256
#: Window starts in a region at each level of splitting; the last is a single window.
WIDTHS = (1 << 30, 44, 6, 1)
SHARD_BYTES = 1_000_000
#: Window starts that a shard's filter takes together.
FILTER_WIDTH = 44
_PIECE = 1 << 24
_POS_BITS = np.uint64(26)
_SEPARATOR = 0xFF                     # in no UTF-8 text


def _regions(buf: np.ndarray, begin: np.ndarray, min_bytes: int):
    """(first start, last start, anchor, anchor hash, region hash) of all regions in concatenated texts."""
    gram = min(GRAM, min_bytes)
    n, w = len(buf), min_bytes - gram + 1
    none = np.zeros(0, np.int64)
    if n < min_bytes:
        return none, none, none, none, none
    hashes = RangeHash(buf)
    at = np.arange(n - gram + 1)
    h = hashes.of(at, at + gram)
    v = (h >> _POS_BITS << _POS_BITS) | at.astype(np.uint64)
    rows = -(-len(v) // w)
    grid = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    grid[:len(v)] = v
    grid = grid.reshape(rows, w)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.ascontiguousarray(np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1]).ravel()
    m = np.minimum(behind[:n - min_bytes + 1], ahead[w - 1:w - 1 + n - min_bytes + 1])   # least gram of each window
    valid = np.ones(n + 1, bool)
    for b, e in zip(begin[:-1], begin[1:]):
        valid[max(b, e - min_bytes + 1):e] = False
    valid = valid[:len(m)]
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (m[1:] != m[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | new[1:]
    lo, hi = np.flatnonzero(new), np.flatnonzero(last)
    anchor = (m[lo] & np.uint64((1 << int(_POS_BITS)) - 1)).astype(np.int64)
    key = mix(h[anchor])
    # the anchor's offset in the region belongs to the region's identity
    body = mix(hashes.of(lo, hi + min_bytes) + (anchor - lo).astype(np.uint64))
    return lo, hi, anchor, key.view(np.int64), body.view(np.int64)


def _pieces(raws, min_bytes):
    """(row, offset, bytes): whole texts, very long ones in pieces that overlap by a window."""
    for i, raw in enumerate(raws):
        if len(raw) < min_bytes:
            continue
        for off in range(0, max(1, len(raw) - min_bytes + 1), _PIECE):
            yield i, off, raw[off:off + _PIECE + min_bytes - 1]


def find_regions(docs: DataFrame, min_bytes: int) -> DataFrame:
    """(d, h, lo, hi, zero, key, body) of every region of every text; zero: its anchor."""
    def extract(batches):
        for b in batches:
            parts = list(_pieces([t.encode("utf-8", "surrogatepass") for t in b["text"]], min_bytes))
            for i, j in slices(np.array([len(p[2]) for p in parts], np.int64)):
                some = parts[i:j]
                begin = np.concatenate([[0], np.cumsum([len(p[2]) for p in some])])
                lo, hi, anchor, key, body = _regions(np.frombuffer(b"".join(p[2] for p in some), np.uint8), begin, min_bytes)
                of = np.searchsorted(begin, lo, side="right") - 1
                shift = np.array([p[1] for p in some], np.int64)[of] - begin[of]
                row = np.array([p[0] for p in some], np.int64)[of]
                yield pd.DataFrame({"d": b["d"].to_numpy()[row], "h": b["h"].to_numpy()[row], "lo": lo + shift, "hi": hi + shift, "zero": anchor + shift, "key": key, "body": body})

    return docs.select("d", "h", "text").mapInPandas(extract, "d long, h long, lo long, hi long, zero long, key long, body long")


def repeated_starts(regions: list[bytes], counts: np.ndarray, min_bytes: int) -> list[np.ndarray]:
    """Per region: mask over its window starts, true where the window has another start."""
    buf = np.frombuffer(bytes([_SEPARATOR]).join([*regions, b""]), np.uint8)
    sa = suffix_array(buf, 256)
    size = np.array([len(r) for r in regions], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    starts = size - min_bytes + 1
    weight = np.zeros(len(buf), np.int64)
    for b, n, c in zip(begin, starts, counts):
        weight[b:b + n] = c
    group = np.cumsum(permuted_lcp(buf, sa)[sa] < min_bytes) - 1
    many = np.bincount(group, weight[sa]) >= 2
    hit = np.zeros(len(buf), bool)
    hit[sa] = many[group]
    return [hit[b:b + n] for b, n in zip(begin, starts)]


def possible_parts(regions: list[bytes], key: np.ndarray, anchor: np.ndarray, counts: np.ndarray, min_bytes: int, width: int):
    """(region, first start, last start) of the parts of regions whose windows can be repeated.

    Windows are taken in ranges of ``width`` starts at fixed distances from the anchor.  The bytes
    that all windows of a range share must occur twice with the anchor, else none of them repeats.
    """
    size = np.array([len(r) for r in regions], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    starts = size - min_bytes + 1
    first = -(anchor // width)                              # range numbers, counted from the anchor
    last = (starts - 1 - anchor) // width
    first = np.where(first * width + anchor > 0, first - 1, first)
    n = last - first + 1
    region = np.repeat(np.arange(len(regions)), n)
    number = np.arange(len(region)) - np.repeat(np.cumsum(n) - n, n) + first[region]
    u = anchor[region] + number * width
    lo, hi = np.maximum(u, 0), np.minimum(u + width, starts[region]) - 1
    h = RangeHash(np.frombuffer(b"".join(regions), np.uint8)).of(begin[region] + u + width - 1, begin[region] + u + min_bytes)
    code = mix(h + mix(key[region].astype(np.uint64) + mix(number.astype(np.uint64))))
    _, at = np.unique(code, return_inverse=True)
    ok = np.bincount(at, counts[region])[at] >= 2
    region, lo, hi = region[ok], lo[ok], hi[ok]
    # neighbouring ranges of one region are one part
    new = np.ones(len(region), bool)
    new[1:] = (region[1:] != region[:-1]) | (lo[1:] != hi[:-1] + 1)
    end = np.append(np.flatnonzero(new)[1:], len(region)) - 1 if len(region) else np.zeros(0, np.int64)
    return region[new], lo[new], hi[end]


def _runs(mask: np.ndarray):
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2] - 1


def _with_text(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` rows (text, d, h) joined with ``wanted`` rows collected per document."""
    maybe = member_filter(wanted.select(F.xxhash64("d", "h").alias("h")))
    per = wanted.groupBy("d", "h").agg(F.collect_list(F.struct(*[c for c in wanted.columns if c not in ("d", "h")])).alias("items"))
    # equal rows with one id are one text here, reduced in each task before the shuffle
    once = docs.where(maybe(F.xxhash64("d", "h"))).select("d", "h", "text").dropDuplicates(["d", "h"])
    return once.join(per, ["d", "h"])


def repeated_ranges(docs: DataFrame, min_bytes: int = MIN_BYTES, most_regions: int = MOST_REGIONS) -> DataFrame:
    """(d, h, ranges): ranges of window starts that are repeated, for ``docs`` (d, h, text); a document may have several rows."""
    found = stored(find_regions(docs.where(F.octet_length("text") >= min_bytes), min_bytes), "sfx-regions")
    item = found.select("key", "body", "d", "h", "lo", "hi", "zero", F.lit(1).cast("long").alias("n"))
    answers, parents = [], []           # per level: answers by (key, body) relative to the region; the link to the level above
    for level in range(len(WIDTHS)):
        one = item.groupBy("key", "body").agg(F.sum("n").alias("n"), F.min(F.struct("d", "h", "lo", "hi", "zero")).alias("at"))
        one = stored(one.select("key", "body", "n", "at.*"), "sfx-classes")
        keys = stored(one.groupBy("key").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).where("total > 1"), "sfx-keys")
        cls = stored(one.join(keys, "key").where("n > 1 or kinds > 1"), "sfx-open")
        whole = cls.where("n > 1").select("key", "body", F.lit(0).cast("long").alias("lo"), (F.col("hi") - F.col("lo")).alias("hi"))
        last = level == len(WIDTHS) - 1
        few = cls.where("kinds > 1" + ("" if last else f" and kinds <= {most_regions}"))
        answers.append(stored(whole.unionByName(_shards(docs, few, min_bytes)), "sfx-answers"))
        if last:
            break
        hot = cls.where(f"kinds > {most_regions}")      # regions that repeat as a whole still count for the others
        if hot.isEmpty():
            break
        narrower = stored(_split(docs, hot, min_bytes, WIDTHS[level + 1]), "sfx-split")
        parents.append(narrower)
        item = narrower.select("key", "body", "d", "h", "lo", "hi", "zero", "n")
    for level in range(len(answers) - 1, 0, -1):
        up = (parents[level - 1].join(_merged(answers[level]), ["key", "body"])
              .select(F.col("key0").alias("key"), F.col("body0").alias("body"), F.inline(_moved("rel"))))
        answers[level - 1] = stored(answers[level - 1].unionByName(up), "sfx-answers")
    # written before the join, so both sides are plain shuffles and AQE splits a region with very many places
    done = stored(_merged(answers[0]), "sfx-runs")
    return found.join(done, ["key", "body"]).select("d", "h", _moved("lo").alias("ranges"))


def _merged(answers: DataFrame) -> DataFrame:
    """(key, body, runs): all answers of a region as maximal runs in one row, so each of its places meets one row."""
    inside = Window.partitionBy("key", "body").orderBy("lo", "hi")        # one region
    reached = F.max("hi").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    marked = answers.withColumn("new", F.when(F.col("lo") <= reached + 1, 0).otherwise(1))
    run = F.sum("new").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    runs = marked.withColumn("run", run).groupBy("key", "body", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return runs.groupBy("key", "body").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))


def _moved(by: str):
    return F.transform("runs", lambda r: F.struct((F.col(by) + r["lo"]).alias("lo"), (F.col(by) + r["hi"]).alias("hi")))


def _shards(docs: DataFrame, classes: DataFrame, min_bytes: int) -> DataFrame:
    """Answers (key, body, lo, hi) for regions whose windows a suffix array compares."""
    classes = stored(classes.select("key", "body", "n", "d", "h", "lo", "hi", "zero"), "sfx-few")
    size = classes.agg(F.sum(F.col("hi") - F.col("lo") + min_bytes)).first()[0]
    if not size:
        return classes.select("key", "body", "lo", "hi")
    n_shards = max(1, -(-size // SHARD_BYTES))

    def cut(batches):
        for b in batches:
            out = {"key": [], "body": [], "n": [], "anchor": [], "bytes": []}
            for text, items in zip(b["text"], b["items"]):
                raw = text.encode("utf-8", "surrogatepass")
                for x in items:
                    out["key"].append(x["key"])
                    out["body"].append(x["body"])
                    out["n"].append(x["n"])
                    out["anchor"].append(x["zero"] - x["lo"])
                    out["bytes"].append(raw[x["lo"]:x["hi"] + min_bytes])
            yield pd.DataFrame(out)

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        regions, n = list(g["bytes"]), g["n"].to_numpy(np.int64)
        which, first, last = possible_parts(regions, g["key"].to_numpy(np.int64), g["anchor"].to_numpy(np.int64), n, min_bytes, min(FILTER_WIDTH, min_bytes // 2))
        key, body, lo, hi = [], [], [], []
        if len(which):
            masks = repeated_starts([regions[r][a:z + min_bytes] for r, a, z in zip(which, first, last)], n[which], min_bytes)
            keys, bodies = g["key"].to_numpy(), g["body"].to_numpy()
            for r, a, m in zip(which, first, masks):
                if n[r] < 2:                             # else the whole region is answered
                    for x, y in zip(*_runs(m)):
                        key.append(keys[r])
                        body.append(bodies[r])
                        lo.append(a + x)
                        hi.append(a + y)
        return pd.DataFrame({"key": np.array(key, np.int64), "body": np.array(body, np.int64), "lo": np.array(lo, np.int64), "hi": np.array(hi, np.int64)})

    rows = _with_text(docs, classes).mapInPandas(cut, "key long, body long, n long, anchor long, bytes binary")
    return (rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(int(n_shards)))).groupBy("shard")
            .applyInPandas(compare, "key long, body long, lo long, hi long"))


def _split(docs: DataFrame, classes: DataFrame, min_bytes: int, width: int) -> DataFrame:
    """Regions cut into ranges of at most ``width`` starts, keyed by the bytes their windows share.

    Ranges begin at fixed distances from the anchor, so equal windows fall into ranges with one key.
    """
    def digest(*parts: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)

    def eight(x) -> bytes:
        return int(x).to_bytes(8, "little", signed=True)

    def cut(batches):
        for b in batches:
            out = []
            for d, h, text, items in zip(b["d"], b["h"], b["text"], b["items"]):
                raw = text.encode("utf-8", "surrogatepass")
                for x in items:
                    lo, hi, zero = int(x["lo"]), int(x["hi"]), int(x["zero"])
                    for u in range(lo - (lo - zero) % width, hi + 1, width):
                        a, z = max(u, lo), min(u + width - 1, hi)
                        key = digest(eight(x["key"]), eight(u - zero), raw[u + width - 1:u + min_bytes])
                        body = digest(eight(a - u), raw[a:z + min_bytes])
                        out.append((key, body, d, h, a, z, zero, x["n"], x["key"], x["body"], a - lo))
            yield pd.DataFrame(out, columns=["key", "body", "d", "h", "lo", "hi", "zero", "n", "key0", "body0", "rel"])

    rows = _with_text(docs, classes.select("d", "h", "key", "body", "n", "lo", "hi", "zero"))
    return rows.mapInPandas(cut, "key long, body long, d long, h long, lo long, hi long, zero long, n long, key0 long, body0 long, rel long")


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, most_regions: int = MOST_REGIONS, with_bytes: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept: the remaining bytes)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("h"))
    ranges = repeated_ranges(rows, min_bytes, most_regions)
    per = stored(ranges.groupBy("d", "h").agg(F.flatten(F.collect_set("ranges")).alias("ranges")), "sfx-ranges")
    maybe = member_filter(per.select(F.xxhash64("d", "h").alias("h")))
    shape = "n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")

    @F.pandas_udf(shape)
    def remove(text: pd.Series, ranges: pd.Series) -> pd.DataFrame:
        out = []
        for t, spans in zip(text, ranges):
            raw = t.encode("utf-8", "surrogatepass")
            edge = np.zeros(len(raw) + 1, np.int64)
            for x in (spans if spans is not None else ()):
                edge[x["lo"]] += 1
                edge[min(len(raw), x["hi"] + min_bytes)] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out.append((int(gone.sum()), len(_runs(gone)[0]), hashlib.sha256(kept).hexdigest()) + ((kept,) if with_bytes else ()))
        return pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes)

    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    flag = F.xxhash64("d", "h")
    cut = (rows.where(maybe(flag)).join(per, ["d", "h"], "left").withColumn("r", remove("text", "ranges")).select("doc_id", n_bytes, "r.*"))
    zero = F.lit(0).cast("long")
    same = rows.where(~maybe(flag)).select("doc_id", n_bytes, zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
                                           *([F.encode("text", "utf-8").alias("kept")] if with_bytes else []))
    return cut.unionByName(same)
