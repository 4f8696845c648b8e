"""A count sketch of fixed size, summed over all rows in the tasks and then by slot range."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_CHUNKS = 64


def slot_counts(df: DataFrame, values, bits: int) -> np.ndarray:
    """Occurrences per slot (value mod 2**bits) over all rows of ``df``.

    ``values(pandas batch)`` gives an integer array.  Each task adds up one array of 2**bits
    counters; these are summed per slot range.  What reaches the driver is 2**bits numbers.
    """
    size = 1 << bits
    step = size // _CHUNKS

    def count(batches):
        n, seen = np.zeros(size, np.int64), False
        for b in batches:
            v = values(b)
            if len(v):
                seen = True
                n += np.bincount((v & np.uint64(size - 1)).astype(np.int64), minlength=size)
        if seen:
            yield pd.DataFrame({"chunk": np.arange(_CHUNKS, dtype=np.int32), "n": [n[i * step:(i + 1) * step].astype("<i4").tobytes() for i in range(_CHUNKS)]})

    def add(g: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(step, np.int64)
        for raw in g["n"]:
            total += np.frombuffer(raw, "<i4")
        return pd.DataFrame({"chunk": g["chunk"].iloc[:1], "n": [total.tobytes()]})

    rows = (df.mapInPandas(count, "chunk int, n binary").groupBy("chunk").applyInPandas(add, "chunk int, n binary").collect())
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["chunk"] * step:(r["chunk"] + 1) * step] = np.frombuffer(r["n"], np.int64)
    return out


def member_filter(ids: DataFrame, bits: int = 24):
    """A column function ``maybe(hash)`` that holds for every hash in ``ids`` (one long column ``h``).

    A bitmap of fixed size (2**bits bits) goes to the tasks, so a join needs to shuffle only the
    rows that can match; false positives are left to the join.
    """
    mask, part = np.uint64((1 << bits) - 1), (1 << bits) // 8 // _CHUNKS

    def slots(h: pd.Series) -> np.ndarray:
        return (h.to_numpy(np.int64).view(np.uint64) & mask).astype(np.int64)

    def collect(batches):
        seen = np.zeros(1 << bits, bool)
        for b in batches:
            seen[slots(b["h"])] = True
        if seen.any():
            packed = np.packbits(seen)
            yield pd.DataFrame({"chunk": np.arange(_CHUNKS, dtype=np.int32), "bits": [packed[i * part:(i + 1) * part].tobytes() for i in range(_CHUNKS)]})

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(part, np.uint8)
        for raw in g["bits"]:
            out |= np.frombuffer(raw, np.uint8)
        return pd.DataFrame({"chunk": g["chunk"].iloc[:1], "bits": [out.tobytes()]})

    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for r in ids.mapInPandas(collect, "chunk int, bits binary").groupBy("chunk").applyInPandas(merge, "chunk int, bits binary").collect():
        bitmap[r["chunk"] * part:(r["chunk"] + 1) * part] = np.frombuffer(r["bits"], np.uint8)
    shared = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        at = slots(h)
        return pd.Series((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0)

    return maybe
