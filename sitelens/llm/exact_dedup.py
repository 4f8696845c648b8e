"""Exact deduplication by a stream with disk-backed keyed state.

A Structured Streaming query reads the Parquet files of a table in micro-batches
and keeps one state entry per digest of the text, in RocksDB, without watermark
and without expiry: the number of rows seen, and the row that stays so far as its
stable identifier and content locator (file and row number in it).  Rows of one
digest are added up in every task before they are shuffled, so a text that a third
of all rows share reaches its key as one row per task and micro-batch.  Progress
and state live below ``spark.checkpoint.dir`` (or at ``checkpoint``): a later call
with the same checkpoint reads only files that came since.

A digest seen more than once is a hit.  Its rows are compared byte by byte with the
content at the locator of the row that stays; rows that differ (a collision of
digests) form classes by their whole bytes instead.  Hits are written once and
joined by digest; AQE splits a digest with very many rows.  Texts of rows without a
hit stay where they are read: a bitmap of the hits' digests (``BITS_PER_HIT`` bits each,
``MAX_BITS`` in all, so 32 MB at most) is broadcast, and only rows that meet a bit move.

Defined cases: a NULL text is empty and equal to empty texts; of equal texts the row
with the largest id stays, a NULL id is the smallest, and of repeated rows with one
id the last by file and row number stays, so just one row of a class is kept;
an empty table gives an empty result; other columns, whatever their names, are
ignored.  Files must not be changed or removed while the checkpoint is in use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stored, text_of

#: Bytes of files that a micro-batch takes.
BYTES_PER_BATCH = 64 << 30
#: Native memory of all state stores of an executor; the rest of the state stays on disk.
STATE_MEMORY_MB = 256
#: Size of the bitmap of hits; a fuller one lets more rows without a hit pass, which the join drops.
BITS_PER_HIT, MAX_BITS = 16, 1 << 28
_PAGE = 1 << 15          # bits that bitmap_construct_agg holds
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": str(STATE_MEMORY_MB),
    # else each store, one a shuffle partition, holds 4 MB of disk in advance for its list of files
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256_digest(content: Column) -> Column:
    return F.unhex(F.sha2(content.cast("binary"), 256))


def _located(rows: DataFrame, content: Callable[[], Column], digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, content, digest, file, row) of a file table or stream."""
    return rows.select("doc_id", content().alias("content"), digest(content()).alias("digest"),
                       F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def _near_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows whose digest may be in ``hits``."""
    bits = _PAGE
    wanted = min(MAX_BITS, BITS_PER_HIT * hits.count())
    while bits < wanted:
        bits *= 2
    at = F.pmod(F.xxhash64("digest"), F.lit(bits))
    page, place = F.shiftright(at, 15).alias("page"), at.bitwiseAND(F.lit(_PAGE - 1))
    pages = hits.select(page, place.alias("place")).groupBy("page").agg(F.bitmap_construct_agg("place").alias("bitmap"))
    byte = F.conv(F.hex(F.substring("bitmap", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(place, F.lit(8)))), F.lit(2)) == 1
    # at most MAX_BITS / _PAGE pages of 4 KB
    near = rows.withColumn("page", page).join(F.broadcast(pages), "page").where(hit)
    return near.select(*rows.columns)


def advance(spark: SparkSession, path: str, checkpoint: str, content=text_of, digest=sha256_digest,
            files_per_batch: int | None = None) -> None:
    """Take all files that came below ``path`` since the last call into the state at ``checkpoint``."""
    schema = spark.read.parquet(path).schema
    session = spark.newSession()
    for key, value in _STATE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    reader = session.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader.option("maxBytesPerTrigger", BYTES_PER_BATCH)
    # as a pattern the path may be a folder or a single file
    path = path.rstrip("/")
    rows = _located(reader.parquet(f"{path[:-1]}[{path[-1]}]"), content, digest)
    state = rows.groupBy("digest").agg(F.count(F.lit(1)), F.max(F.struct("doc_id", "file", "row")))
    query = (state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def classes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state as a table: (digest, n, keep_id, keep_file, keep_row)."""
    state = spark.read.format("statestore").load(checkpoint)
    n, keep = (F.col("value").getField(f) for f in state.schema["value"].dataType.names)
    return state.select(F.col("key.digest").alias("digest"), n.alias("n"), keep["doc_id"].alias("keep_id"),
                        keep["file"].alias("keep_file"), keep["row"].alias("keep_row"))


def deduplicate(spark: SparkSession, path: str, content=text_of, digest=sha256_digest, checkpoint: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """Every row of the table at ``path`` as (doc_id, keep_id, group_size, kept, text_sha256, file, row).

    ``content`` gives the text that is compared, ``digest`` the state's key of it.
    """
    fresh = checkpoint is None
    checkpoint = checkpoint or scratch_path(spark, "dedup-state")
    source = spark.read.parquet(path)
    if fresh and not source.inputFiles():
        seen = source.limit(0).select("doc_id", F.lit(None).cast("binary").alias("digest"))
        known = seen.select("digest", F.lit(0).cast("long").alias("n"), F.col("doc_id").alias("keep_id"), F.lit("").alias("keep_file"),
                            F.lit(0).cast("long").alias("keep_row"))
    else:
        advance(spark, path, checkpoint, content, digest, files_per_batch)
        known = classes(spark, checkpoint)
    hits = stored(known.where("n > 1"), "dedup-hits")
    rows = _located(source, content, digest)
    here = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    texts = stored(_near_hits(rows, hits).join(hits, "digest").select("digest", "doc_id", "file", "row", "content", here.alias("keeper")), "dedup-texts")
    keepers = texts.where("keeper").select("digest", F.col("content").cast("binary").alias("keep_bytes"))
    checked = texts.join(keepers, "digest", "left")
    same = F.coalesce(F.col("content").cast("binary") == F.col("keep_bytes"), F.lit(False))
    other = stored(checked.where(~same).select("digest", "doc_id", "file", "row", F.col("content").cast("binary").alias("content")), "dedup-other")
    out = rows.select("doc_id", "digest", "file", "row", F.sha2(F.col("content").cast("binary"), 256).alias("text_sha256")).join(hits, "digest", "left")
    size, keep_id = F.coalesce("n", F.lit(1).cast("long")), F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    kept = F.col("n").isNull() | here
    if not other.isEmpty():
        # rows whose digest is that of another text: classes by their bytes
        by_bytes = other.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("o_n"), F.max(F.struct("doc_id", "file", "row")).alias("o_keep"))
        moved = other.join(by_bytes, ["digest", "content"]).select("file", "row", "o_n", "o_keep")
        less = other.groupBy("digest").agg(F.count(F.lit(1)).alias("gone"))
        out = out.join(less, "digest", "left").join(moved, ["file", "row"], "left")
        is_other = F.col("o_n").isNotNull()
        size = F.when(is_other, F.col("o_n")).otherwise(size - F.coalesce("gone", F.lit(0)))
        keep_id = F.when(is_other, F.col("o_keep.doc_id")).otherwise(keep_id)
        kept = F.when(is_other, (F.col("o_keep.file") == F.col("file")) & (F.col("o_keep.row") == F.col("row"))).otherwise(kept)
    return out.select("doc_id", keep_id.alias("keep_id"), size.cast("long").alias("group_size"), kept.alias("kept"), "text_sha256", "file", "row")
