"""Audit-shaped tables derived from the driver's generic tables.

The driver ships ``events(event_id, ts, user_id, event_type, value, props)``
and ``pages(page_id, url, html)``.  ``user_id`` plays the site, an ``error``
event a failed audit, and the newest ``ts`` the clock.  Spark derives the
audit tables from those files in one pass and writes them once per Spark
application to the shared work folder (:func:`stored_tables`), laid out as a deployment
keeps them; reports read the stored tables, whose size grows with the input.

The column rules are fixed values shared with the SQL oracle; keep them equal.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as X

# Fixed values of the proxy (shared with the oracle SQL).
UF_PAIRS = "acalamapbacedfesgomamgmsmtpapbpeprpirjrnrorrrsscsesptosp"
NO_STATE_MOD, NO_STATE_REM = 10, 7
URL_PREFIX = "https://www.cidade"
IBGE_BASE = 1000000
# (column, multiplier of event_id, multiplier of user_id, NULL when event_id % m == 0)
SCORE_RULES = [
    ("mobile_performance", 37, 0, 41),
    ("mobile_accessibility", 53, 1, 43),
    ("mobile_best_practices", 17, 0, None),
    ("mobile_seo", 19, 5, None),
    ("desktop_performance", 29, 3, None),
    ("desktop_accessibility", 31, 7, 47),
    ("desktop_best_practices", 23, 0, None),
    ("desktop_seo", 13, 1, None),
]
# (column, operator, constant) applied to ``value``
VITAL_RULES = [
    ("mobile_fcp", "*", 10), ("mobile_lcp", "*", 15), ("mobile_cls", "/", 1000), ("mobile_fid", "*", 1),
    ("desktop_fcp", "*", 5), ("desktop_lcp", "*", 8), ("desktop_cls", "/", 2000), ("desktop_fid", "/", 2),
]


DRIVER_SCHEMAS = {"events": schemas.EVENTS, "pages": schemas.PAGES}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events columns the proxy uses.

    A table stored as fewer files than cores (the driver's tables are one
    file, one row group) scans as that many tasks; then the rows are
    hash-spread by ``event_id`` (the run) over the default parallelism so the
    per-row work runs on every core.  Inputs of many files are left alone.
    """
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    cores = spark.sparkContext.defaultParallelism
    if _input_files(spark, sf_dir) < cores:
        ev = ev.repartition(cores, "event_id")
    return ev


@functools.lru_cache(maxsize=16)
def _input_files(spark: SparkSession, sf_dir: str) -> int:
    return len(table(spark, sf_dir, "events").inputFiles())


def site_url(user_id: Column) -> Column:
    uf = F.substr(F.lit(UF_PAIRS), F.lit(1) + F.lit(2) * (user_id % 28), F.lit(2))
    uid = user_id.cast("string")
    return F.when(user_id % NO_STATE_MOD == NO_STATE_REM,
                  F.concat(F.lit(URL_PREFIX), uid, F.lit(".gov.br/"))) \
        .otherwise(F.concat(F.lit(URL_PREFIX), uid, F.lit("."), uf, F.lit(".gov.br/")))


def _pct(e: Column) -> Column:
    return (e % 101).cast("double") / 100


def derived_summaries_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``audit_summaries`` plus the ``user_id`` it came from, derived from events."""
    ev = events(spark, sf_dir)
    eid, uid, err = F.col("event_id"), F.col("user_id"), F.col("event_type") == "error"
    cols = [eid.alias("id"), site_url(uid).alias("url"), F.col("ts").alias("timestamp")]
    for name, a, b, null_mod in SCORE_RULES:
        expr = eid * a + uid * b if b else eid * a
        bad = err if null_mod is None else (err | (eid % null_mod == 0))
        cols.append(F.when(~bad, _pct(expr)).alias(name))
    v = F.col("value")
    for name, op, k in VITAL_RULES:
        expr = v * k if op == "*" else v / k
        cols.append(F.when(~err, expr).alias(name))
    cols += [
        err.alias("has_errors"),
        F.when(err, F.concat(F.lit("HTTP "), (F.lit(500) + eid % 4).cast("string"),
                             F.lit(": k="), F.get_json_object("props", "$.k"))).alias("error_message"),
        F.col("ts").alias("created_at"),
        uid.alias("user_id"),
    ]
    return ev.select(*cols)


def long_metrics_from(summaries_with_user: DataFrame) -> DataFrame:
    """``psi_metrics``: the summaries in long layout, ibge_code from the site."""
    from ..operators.assemble import to_long_metrics
    s = summaries_with_user.withColumn(
        "ibge_code", (F.lit(IBGE_BASE) + F.col("user_id")).cast("string"))
    return to_long_metrics(s, ibge_code="ibge_code")


_STORED: dict = {}
_CLOCK: dict = {}


def _app_key(spark: SparkSession, sf_dir: str) -> tuple:
    # paths and the clock are plain values, valid for every session of the app
    return spark.sparkContext.applicationId, sf_dir


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Paths of the derived tables, written once per Spark application."""
    key = _app_key(spark, sf_dir)
    if key not in _STORED:
        _STORED[key] = _write_stored_tables(spark, sf_dir)
    return _STORED[key]


def _write_stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Write the derived tables into the shared work folder.

    Layout as a deployment keeps them: ``audits`` and ``audit_summaries``
    partitioned by ``day`` (time-window reports prune partitions),
    ``psi_metrics`` and ``raw_responses`` as plain files, the responses of one
    run in one of them: writing by day would sort the bodies of a whole task.  Reports then read stored Parquet tables
    with pushed filters and pruned columns instead of re-deriving them.
    """
    from ..session import run_concurrently, scratch_path
    base = scratch_path(spark, "proxy-tables")
    ext = derived_summaries_ext(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    # REBALANCE: AQE sizes the write tasks — small days share files, a hot day
    # is split over several tasks instead of landing in one
    summ = ext.select(*schemas.AUDIT_SUMMARIES.fieldNames(), "day").hint("rebalance", "day")
    summ.write.partitionBy("day").parquet(f"{base}/audit_summaries")
    audits_cols = ["id", "url", "timestamp", "error_message",
                   F.lit(0).cast("long").alias("retry_count"), "created_at", "day"]
    # the other tables come from the stored summaries (one pass over events);
    # their three writes are independent jobs, submitted together
    stored = spark.read.schema(schemas.T.StructType(schemas.AUDIT_SUMMARIES.fields + [_DAY])) \
        .parquet(f"{base}/audit_summaries")
    # the stored summaries are read day by day, so the responses need no shuffle and
    # lie in the order of their days; both responses of a run come from one summary row
    run_concurrently([
        lambda: stored.select(*audits_cols).write.partitionBy("day").parquet(f"{base}/audits"),
        lambda: long_metrics_from(stored.withColumn("user_id", site_key("url")))
        .write.parquet(f"{base}/psi_metrics"),
        lambda: raw_responses_from(stored).write.option("compression", "zstd").parquet(f"{base}/raw_responses"),
    ])
    return {n: f"{base}/{n}" for n in ("audit_summaries", "audits", "psi_metrics", "raw_responses")}


_DAY = schemas.T.StructField("day", schemas.T.DateType())


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored ``audit_summaries`` (the day partition column left out)."""
    path = stored_tables(spark, sf_dir)["audit_summaries"]
    return spark.read.schema(schemas.T.StructType(schemas.AUDIT_SUMMARIES.fields + [_DAY])) \
        .parquet(path).select(*schemas.AUDIT_SUMMARIES.fieldNames())


AUDITS_STORED = schemas.T.StructType([schemas.AUDITS[c] for c in (
    "id", "url", "timestamp", "error_message", "retry_count", "created_at")] + [_DAY])


def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored ``audits`` without the response documents, with its ``day``
    partition column (time-window operators prune on it)."""
    return spark.read.schema(AUDITS_STORED).parquet(stored_tables(spark, sf_dir)["audits"])


def psi_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.PSI_METRICS).parquet(stored_tables(spark, sf_dir)["psi_metrics"])


def raw_responses_path(spark: SparkSession, sf_dir: str) -> str:
    return stored_tables(spark, sf_dir)["raw_responses"]


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses, two per event (see :func:`raw_responses_from`)."""
    return spark.read.schema(schemas.RAW_RESPONSES).parquet(raw_responses_path(spark, sf_dir))


def replayed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``psi_metrics`` where the newest day was loaded twice (a replayed load)."""
    m = psi_metrics(spark, sf_dir)
    last_day = F.to_date(as_of(spark, sf_dir))
    return m.unionByName(m.filter(F.to_date("timestamp") == last_day))


def raw_responses_from(s: DataFrame) -> DataFrame:
    """Two responses per summary row, built from the summary columns.

    For a failed event the mobile response carries HTTP 500-503 and an error
    body while the desktop response succeeds, so the all-or-nothing rule of
    assembly is visible.
    """
    from ..operators.assemble import CATEGORY_COLUMNS, VITAL_AUDITS, response_body
    code = F.lit(500) + F.col("id") % 4
    msg = F.regexp_extract(F.col("error_message"), r": (k=.*)$", 1)
    err_body = F.to_json(F.struct(F.struct(code.cast("long").alias("code"),
                                           msg.alias("message")).alias("error")))
    bodies, per_strategy = [], []
    for strategy in ("mobile", "desktop"):
        p = f"{strategy}_"
        ok_body = response_body(
            F.col("url"), F.col("_fetch"),
            {name: F.col(p + c) for name, c in CATEGORY_COLUMNS},
            {name: F.col(p + c) for name, c in VITAL_AUDITS},
        )
        failed = F.col("has_errors") & F.lit(strategy == "mobile")
        bodies.append(F.when(failed, err_body).otherwise(ok_body).alias(f"_{p}body"))
        per_strategy.append(F.struct(
            F.lit(strategy).alias("strategy"),
            F.when(failed, code).otherwise(F.lit(200)).cast("int").alias("status_code"),
            F.when(failed, F.lit("Internal Server Error")).otherwise(F.lit("OK")).alias("reason"),
            F.lit(None).cast("string").alias("failure"),
            F.col(f"_{p}body").alias("body")))
    # the bodies are made in a projection (compiled, their time formatted once), and both responses
    # of an event come from one scan (Generate, no union of two reads)
    made = s.withColumn("_fetch", X.iso_text("timestamp")).select("*", *bodies)
    return made.select(F.col("id").alias("run_id"), "url", F.col("timestamp").alias("fetched_at"),
                       F.inline(F.array(*per_strategy))) \
        .select(*schemas.RAW_RESPONSES.fieldNames())


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site list for skip lists: the distinct urls of the summaries."""
    return summaries(spark, sf_dir).select("url").distinct()


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url")


def _max_ts(spark: SparkSession, sf_dir: str):
    key = _app_key(spark, sf_dir)
    if key not in _CLOCK:
        _CLOCK[key] = table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    return _CLOCK[key]


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """The clock of the proxy: the newest event time, as a literal.

    One scalar is read on the driver (bounded), so later time filters are
    plain literals that reach the Parquet scan as pushed filters.
    """
    return X.as_time(_max_ts(spark, sf_dir))


def as_of_value(spark: SparkSession, sf_dir: str):
    return _max_ts(spark, sf_dir)


# Fixed values of the quarantine proxy (shared with the oracle SQL).
FIRST_UPDATE_DAYS_BEFORE = 3
STATUS_CHANGE_HOURS_AFTER = 1
STATUS_BY_SITE_MOD = 5
STATUS_BY_SITE = [(0, "investigating"), (1, "wrong_url"), (2, "resolved"), (3, "removed")]
STATUS_NOTE_PREFIX = "status set to "
SITE_KEY_PATTERN = r"cidade([0-9]+)"


def site_key(url) -> Column:
    return F.regexp_extract(X._c(url), SITE_KEY_PATTERN, 1).cast("long")


def _store(df: DataFrame) -> DataFrame:
    """Append-only table rows as written: a checkpoint in the shared folder."""
    from ..session import work_root
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)


@functools.lru_cache(maxsize=8)
def quarantine_steps(spark: SparkSession, sf_dir: str) -> dict:
    """The quarantine table after the proxy's history of changes, stored.

    1. update at ``as_of - 3 days`` (audits up to then) on an empty table;
    2. update at ``as_of``;
    3. status changes one hour later by site number % 5 (U3), then removals (U4).
    Every step appends rows numbered after the previous maximum id.
    """
    import datetime as dt

    from ..operators import quarantine as Q
    a = audits(spark, sf_dir)
    t2 = _max_ts(spark, sf_dir)
    t1 = t2 - dt.timedelta(days=FIRST_UPDATE_DAYS_BEFORE)
    t3 = t2 + dt.timedelta(hours=STATUS_CHANGE_HOURS_AFTER)
    empty = schemas.empty_frame(spark, schemas.QUARANTINE)
    rows1 = _store(Q.update_quarantine(a, empty, t1))
    q1 = rows1
    changes2 = Q.quarantine_changes(a, q1, t2)
    rows2 = _store(Q.update_quarantine(a, q1, t2))
    q2 = q1.unionByName(rows2)
    key = site_key("url") % STATUS_BY_SITE_MOD
    status = F.lit(None).cast("string")
    for rem, st in reversed(STATUS_BY_SITE):
        status = F.when(key == rem, F.lit(st)).otherwise(status)
    cur2 = Q.current_one(q2).select("url", status.alias("status"))
    set_changes = cur2.filter(F.col("status").isin(*schemas.QUARANTINE_STATUSES)) \
        .withColumn("notes", F.concat(F.lit(STATUS_NOTE_PREFIX), F.col("status")))
    rows3 = _store(Q.set_quarantine_status(q2, set_changes, t3, strict=False))  # domain filtered
    q3 = q2.unionByName(rows3)
    removals = cur2.filter(F.col("status") == schemas.REMOVED_STATUS).select("url")
    rows4 = _store(Q.remove_from_quarantine(q3, removals, t3))
    q4 = q3.unionByName(rows4)
    return {"t1": t1, "t2": t2, "t3": t3, "rows1": rows1, "changes2": changes2,
            "rows2": rows2, "rows3": rows3, "rows4": rows4, "q2": q2, "q3": q3,
            "set_changes": set_changes, "removals": removals, "quarantine": q4}


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_steps(spark, sf_dir)["quarantine"]


def reset_caches(keep_tables: bool = False) -> None:
    """Forget the memoised clock and stored tables (bench isolation); with
    ``keep_tables`` the stored derived tables, the quarantine history and the
    clock (an input, like "now" in production) stay."""
    if not keep_tables:
        _CLOCK.clear()
        quarantine_steps.cache_clear()
        _input_files.cache_clear()
        _STORED.clear()
