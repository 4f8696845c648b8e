"""Incremental ingest of stored responses with Structured Streaming.

New response files -> T1 -> T2 -> the tables of U1, giving the same rows as the
batch path.  The mobile and the desktop responses are two streams that meet in a
full outer join by run (run_id, url).  The join's keyed state, in RocksDB below the
query's checkpoint, holds a response until ``max_wait_seconds`` after it came: what a
micro-batch writes grows with its own responses, not with those that wait.  A run is
assembled with the micro-batch in which both of its responses are there.  A
response that stays alone leaves the join when its wait is over, and the run ends with
the missing response as its error text.

The join's time is the time of arrival (the micro-batch's own, kept in its log, so a
replay sees the same), not ``fetched_at``: responses of any age may come in any
order, and none is dropped as too old.

A run that is in the tables is never assembled again.  A response that comes for it is
written to ``late_responses``.  Runs are looked up in the days within ``keep_days`` of
the micro-batch's responses.

``foreachBatch`` is at-least-once: every load is named by the query's id and the
batch id and committed once (:mod:`sitelens.sources.ledger`), so a replayed batch adds nothing
and another query's output is never touched.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.assemble import STRATEGIES, assemble_pairs, assemble_with_summaries
from ..session import drop_unused, path_exists, remove_folder, write_once
from ..sinks.writers import write_assembled
from ..sources.ledger import is_committed
from ..sources.tables import read_table

#: How long a response waits for its partner, and how far apart the responses of a run may be fetched.
MAX_WAIT_SECONDS, KEEP_DAYS = 24 * 3600, 30
LATE_TABLE = "late_responses"
_COLUMNS = schemas.RAW_RESPONSES.fieldNames()
_FLUSHED = "flushed.json"
#: Folder of a checkpoint with the joined rows of a micro-batch, for as long as it is worked on.
_KEPT = "micro-batch"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # else each store, four a shuffle partition, holds 4 MB of disk in advance for its list of files
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # a micro-batch uploads its changes, snapshots follow in the background
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # the state holds bodies
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # one store a shuffle partition, not four: each is opened, committed and synced in every micro-batch
    # (a checkpoint keeps the format it began with)
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # the stores of an executor share their memory: one that may fill it with its own new rows leaves the others
    # none, and these flush a few rows at a time, stall and merge files over and over
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
}
_ADAPTIVE = "spark.sql.adaptive.enabled"


def _paired(responses: DataFrame, max_wait_seconds: float) -> DataFrame:
    """Stream of (first, second): a mobile and a desktop response of one run, or one that stayed alone."""
    came = responses.withColumn("came", F.current_timestamp()).withWatermark("came", "0 seconds")
    first, second = STRATEGIES
    is_second = F.col("strategy").eqNullSafe(second)
    sides = [came.filter(~is_second), came.filter(is_second)]
    a, b = (x.select(F.struct(*_COLUMNS, "came").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in ("run_id", "url", "strategy", "came")])
            for x, n in zip(sides, ("first", "second")))
    wait = F.expr(f"INTERVAL {float(max_wait_seconds)} SECONDS")
    same_run = F.col("first_run_id").eqNullSafe(F.col("second_run_id")) & F.col("first_url").eqNullSafe(F.col("second_url"))
    near = (F.col("first_came") >= F.col("second_came") - wait) & (F.col("first_came") <= F.col("second_came") + wait)
    # a response of neither strategy stays alone; said of both sides at once, or it would not wait
    proper = F.concat_ws("|", "first_strategy", "second_strategy") == f"{first}|{second}"
    return a.join(b, same_run & near & proper, "full_outer").select("first", "second")


def _sides(pairs: DataFrame, *columns: str, **more) -> DataFrame:
    """``columns`` of every response of the pairs, and ``more`` of its pair; only what is asked for is read of the files."""
    first, second = (pairs.filter(F.col(x).isNotNull()).select(*[F.col(f"{x}.{c}").alias(c) for c in columns], *[v.alias(n) for n, v in more.items()])
                     for x in ("first", "second"))
    return first.unionByName(second)


def _known_runs(spark: SparkSession, out_base: str, responses: DataFrame, keep_days: int) -> DataFrame:
    """(run_id, url) of the stored audits of the days around the responses' times."""
    audits = read_table(spark, out_base, "audits")
    lo, hi, some = responses.agg(F.to_date(F.min("fetched_at")), F.to_date(F.max("fetched_at")), F.max(F.col("fetched_at").isNull())).first()
    if some is None:
        audits = audits.limit(0)  # no responses, nothing to look up
    elif lo is not None:
        # rows without time have no day
        around = F.col("day").between(F.date_sub(F.lit(lo), keep_days), F.date_add(F.lit(hi), keep_days))
        audits = audits.filter(around | F.col("day").isNull())
    return audits.select(F.col("id").alias("run_id"), "url").distinct()


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of a checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_stream(spark: SparkSession, raw_path: str, out_base: str, checkpoint: str,
                  fmt: str = "parquet", max_files_per_trigger: int | None = None,
                  available_now: bool = True, max_wait_seconds: float = MAX_WAIT_SECONDS,
                  keep_days: int = KEEP_DAYS):
    """Start the ingest query; returns the ``StreamingQuery``.

    A response whose wait is over leaves with the first micro-batch after the one that
    moved the clock past it.
    """
    if path_exists(spark, f"{checkpoint}/{_FLUSHED}"):
        raise ValueError("the runs of this checkpoint were ended by flush_pending; use a new one")
    reader = spark.readStream.schema(schemas.RAW_RESPONSES).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))

    adaptive = spark.conf.get(_ADAPTIVE)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Spark turns this off for the stream, whose join is planned by now; without it nothing is gathered
        # by day before it is written, and each task writes a file a day
        off = session.conf.get(_ADAPTIVE)
        session.conf.set(_ADAPTIVE, adaptive)
        try:
            ingest(session, batch, batch_id)
        finally:
            session.conf.set(_ADAPTIVE, off)

    def ingest(session: SparkSession, batch: DataFrame, batch_id: int) -> None:
        load = f"load-{query_id(spark, checkpoint)}-{batch_id}"
        if is_committed(session, out_base, load):
            # a replay still has to bring the state to its next version
            batch.write.format("noop").mode("overwrite").save()
            return
        # the join runs once: its rows are kept in files, which hold repeated text once and give keys without bodies
        kept = f"{checkpoint}/{_KEPT}"
        batch.write.mode("overwrite").option("compression", "zstd").parquet(kept)
        held = []
        try:
            batch = session.read.schema(batch.schema).parquet(kept)
            # keys only: bodies meet the stored runs just where some of the batch are among them
            keys = _sides(batch, "run_id", "url", "fetched_at")
            known = _known_runs(session, out_base, keys, keep_days).select(
                F.col("run_id").alias("__run"), F.col("url").alias("__url"), F.lit(True).alias("__known"))
            same_run = F.col("run_id").eqNullSafe(F.col("__run")) & F.col("url").eqNullSafe(F.col("__url"))
            held.append(hits := known.join(keys, same_run, "left_semi").persist())
            # runs of several rows, and those that are there
            rows = batch.select(*[F.coalesce(f"first.{c}", f"second.{c}").alias(n) for c, n in (("run_id", "__run"), ("url", "__url"))])
            several = rows.groupBy("__run", "__url").count().filter("count > 1").drop("count")
            held.append(apart := several.unionByName(hits.drop("__known")).distinct().persist())
            if apart.count() == 0:
                both = assemble_pairs(batch)
            else:
                run = [F.coalesce(f"first.{c}", f"second.{c}").eqNullSafe(F.col(n)) for c, n in (("run_id", "__run"), ("url", "__url"))]
                # the last to come of a pair: the one that is late if the run is there already
                came = _sides(batch.join(apart, run, "left_semi"), *_COLUMNS, "came", newest=F.greatest("first.came", "second.came"))
                marked = came.join(hits, same_run, "left")
                late = marked.filter("__known AND came = newest").select(*_COLUMNS).distinct()
                if not late.isEmpty():
                    late.write.mode("overwrite").parquet(f"{out_base}/{LATE_TABLE}/load={load}")
                new = marked.filter("__known IS NULL").select(*_COLUMNS)
                both = assemble_pairs(batch.join(apart, run, "left_anti")).unionByName(assemble_with_summaries(new))
            write_assembled(both, out_base, load)
        finally:
            for x in held:
                x.unpersist()
            remove_folder(session, kept)
            # the shuffle files of earlier micro-batches go now, not at the next periodic look
            drop_unused(session)

    w = _paired(reader.load(raw_path), max_wait_seconds).writeStream.foreachBatch(per_batch)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    # the query takes a copy of the session's settings when it starts
    before = {k: spark.conf.get(k, None) for k in _STATE_CONF}
    for k, v in _STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return w.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def pending_responses(spark: SparkSession, out_base: str, checkpoint: str, keep_days: int = KEEP_DAYS) -> DataFrame:
    """The responses in the state of a stopped query whose run is in no table yet."""
    sides = [spark.read.format("statestore").option("joinSide", side).load(checkpoint).select(f"value.{name}.*")
             for side, name in (("left", "first"), ("right", "second"))]
    held = sides[0].unionByName(sides[1]).select(*_COLUMNS)
    known = _known_runs(spark, out_base, held, keep_days)
    same = held["run_id"].eqNullSafe(known["run_id"]) & held["url"].eqNullSafe(known["url"])
    return held.join(known, same, "left_anti")


def flush_pending(spark: SparkSession, out_base: str, checkpoint: str) -> None:
    """End the runs that still wait in the state of a stopped query; the missing response
    becomes the audit's error text.  The checkpoint cannot be used again; repeating it adds nothing."""
    write_once(spark, f"{checkpoint}/{_FLUSHED}", "{}\n")
    left = pending_responses(spark, out_base, checkpoint)
    write_assembled(assemble_with_summaries(left), out_base, f"load-{query_id(spark, checkpoint)}-rest")


def late_responses(spark: SparkSession, out_base: str) -> DataFrame:
    """The responses that came after their run had ended."""
    path = f"{out_base}/{LATE_TABLE}"
    if not path_exists(spark, path):
        return schemas.empty_frame(spark, schemas.RAW_RESPONSES)
    return spark.read.schema(schemas.RAW_RESPONSES).parquet(path)


def read_ingested(spark: SparkSession, out_base: str, table: str = "audit_summaries") -> DataFrame:
    """The appended table as one DataFrame."""
    return read_table(spark, out_base, table).drop("day")
