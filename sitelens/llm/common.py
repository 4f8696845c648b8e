"""Shared helpers of the training-data operators.

Intermediate tables go to the folder that ``spark.checkpoint.dir`` names
(``session.scratch_path``), so a lost executor never loses them.
"""

from __future__ import annotations

import gc

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitelens.session import remove_folder, scratch_path

#: Longest slice (bytes of text) that a task works on at once.
SLICE_BYTES = 500_000
#: Rows and bytes that go to a Python worker at once (the defaults are 10,000 rows of any size).
ARROW_ROWS, ARROW_BYTES = 500, 4_000_000


def bounded_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of long texts; settings made by the user stay."""
    for key, default, bound in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", ARROW_ROWS),
                                ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", ARROW_BYTES)):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, str(bound))


#: Folders written in the scopes that are open, innermost last.
_OPEN: list[list[str]] = []


class Scratch:
    """The folders that :func:`stored` writes while a ``with`` block of this object runs.

    ``release`` deletes them by Spark's file system; do so once what reads them has been written elsewhere.
    Shuffle files go when nothing in the driver refers to their plans any more; ``release`` has it look now,
    as it otherwise does every half hour (spark.cleaner.periodicGC.interval).
    """

    def __init__(self):
        self.paths: list[str] = []

    def __enter__(self):
        _OPEN.append(self.paths)
        return self

    def __exit__(self, *_):
        _OPEN.pop()

    def release(self, spark: SparkSession) -> None:
        if not self.paths:
            return
        while self.paths:
            remove_folder(spark, self.paths.pop())
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back.

    Unlike a checkpoint the table read back carries no partitioning, so a
    later join shuffles both sides and AQE may split a hot key.  Its size is
    known to the planner.  ``compression``: a Parquet codec other than the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(StructType(df.schema.fields)).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Delete the files of frames that :func:`stored` gave; nothing that reads them may run later."""
    for df in frames:
        path = None if df is None else df.__dict__.pop("_stored_at", None)
        if path:
            remove_folder(df.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that does not clash (case-insensitively) with ``df``'s."""
    have = {c.lower() for c in df.columns}
    name, k = stem, 0
    while name.lower() in have:
        k += 1
        name = f"{stem}_{k}"
    return name


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(modulus)


def slices(lengths: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges whose summed lengths stay near ``limit`` (one row at least)."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge table of longs.

    Alternating star contraction: each round points every node at the least
    id of its neighbourhood.  Minima are pre-aggregated before the shuffle and
    stored before the join, so a node with very many links is split by AQE.
    Returns (node, component) for nodes that have a link; component = least
    id of the component.  Null ends and self links are ignored.
    """
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
         .distinct())
    e = stored(e, "cc-edges")

    def mark(x: DataFrame):
        r = x.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = stored(both.groupBy("u").agg(F.min("v").alias("m0"))
                       .select("u", F.least("u", "m0").alias("m")), "cc-least")
        large = stored(both.join(first, "u").where("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        old, e = e, stored(small, "cc-small")
        discard(old, first, large, least)
        now = mark(e)
        if now == before:
            break
        before = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
