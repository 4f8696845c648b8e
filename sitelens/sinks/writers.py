"""Sinks (K1-K8) and the audit append.

Unbounded outputs (ranking, quarantine list, metric exports) are written as
partitioned JSON-lines / CSV / Parquet folders by all tasks in parallel;
only outputs bounded by a fixed ``n`` (the latest-audits document) are
gathered into one document.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as X
from ..operators import filters as FL
from ..operators import metrics as M
from ..operators import ranking as R
from ..operators.assemble import assemble_with_summaries, audits_with_summaries
from ..operators.quarantine import quarantine_current
from ..session import matches, path_exists, run_concurrently
from ..sources.ledger import commit_load, is_committed, new_load, open_ledger


def _iso_lit(t) -> F.Column:
    if isinstance(t, dt.datetime):
        return F.lit(t.isoformat())
    return X.iso_text(X.as_time(t))


def _iso_cols(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: X.iso_text(c) for c in cols})


def append_audits(audits: DataFrame, base: str) -> dict[str, str]:
    """Append audits and their summaries (T2), each document parsed once.

    Both tables are partitioned by ``day`` of the audit, so time-window
    reports prune folders, and below it by ``load``, one name per append;
    REBALANCE lets AQE size the write tasks.  The load is committed last, for
    both tables at once (:mod:`sitelens.sources.ledger`).
    """
    return write_assembled(audits_with_summaries(audits), base, new_load())


def append_responses(raw: DataFrame, base: str) -> dict[str, str]:
    """U1 from stored responses: audits and summaries written from one pass
    (``assemble_with_summaries``: each response body parsed once).  Audits keep
    their ``run_id`` as id; ``run_batch`` numbers its audits anew."""
    return write_assembled(assemble_with_summaries(raw), base, new_load())


def write_assembled(both: DataFrame, base: str, load: str) -> dict[str, str]:
    """Write the rows of ``assemble_with_summaries`` to both tables as one load.

    Repeating a committed load writes nothing; one that was cut short is replaced.

    ``both`` is computed once and its bodies are kept nowhere else: the files of the audits hold the
    summary columns, too, and the summaries are written from these columns of the load's audits.
    """
    spark = both.sparkSession
    paths = {"audits": f"{base}/audits", "audit_summaries": f"{base}/audit_summaries"}
    if is_committed(spark, base, load):
        return paths
    open_ledger(spark, base)
    extra = [c for c in schemas.AUDIT_SUMMARIES.fieldNames() if c not in schemas.AUDITS.fieldNames()]
    _write_days(both.select(*schemas.AUDITS.fieldNames(), *extra), paths["audits"], load)
    _write_days(_written(spark, paths["audits"], load, schemas.AUDIT_SUMMARIES), paths["audit_summaries"], load)
    commit_load(spark, base, load, _written_days(spark, paths["audit_summaries"], load))
    return paths


#: Rows of a Parquet page: what a look-up of one url reads of a file that holds it.
PAGE_ROWS = 500
_ID_DAY = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])


def _write_days(rows: DataFrame, path: str, load: str) -> None:
    # only the folders of this load are replaced, so a repeated write adds nothing;
    # sorted by url, with a Bloom filter and small pages, a file is passed over or
    # entered at the pages of the url that a look-up asks for
    rows.withColumn("day", X.day("timestamp")).withColumn("load", F.lit(load)) \
        .hint("rebalance", "day").sortWithinPartitions("day", "load", "url") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd") \
        .option("parquet.bloom.filter.enabled#url", "true") \
        .option("parquet.bloom.filter.adaptive.enabled", "true") \
        .option("parquet.page.row.count.limit", str(PAGE_ROWS)) \
        .partitionBy("day", "load").parquet(path)


def _written(spark, path: str, load: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in the files of one load."""
    files = f"{path}/day=*/load={load}"
    if not matches(spark, files):
        return schemas.empty_frame(spark, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(files).select(*schema.fieldNames())


def _written_days(spark, path: str, load: str) -> list:
    """(day, rows) of the files of one load (Parquet footers; one row per day)."""
    rows = _written(spark, path, load, _ID_DAY)
    return [tuple(r) for r in rows.groupBy("day").agg(F.count(F.lit(1))).collect()]


def export_audits_parquet(audits: DataFrame, out: str, incremental: bool = False) -> str:
    """K1 + X6: url, timestamp, error_message, retry_count in one folder per day.

    ``incremental``: ``out`` is an earlier export of the same append-only
    table, so a day whose number of rows there is the right one is kept, and
    only the other days are written, whoever appended to them.
    """
    return _export_days(audits, ["url", "timestamp", "error_message", "retry_count"], out, incremental)


def export_summaries_parquet(summaries: DataFrame, out: str, incremental: bool = False) -> str:
    """K2: every summary column; ``incremental`` as in K1, in one folder per day."""
    columns = schemas.AUDIT_SUMMARIES.fieldNames()
    if incremental:
        return _export_days(summaries, columns, out, True)
    summaries.select(*columns).write.mode("overwrite").parquet(out)
    return out


def _export_days(table: DataFrame, columns: list[str], out: str, incremental: bool) -> str:
    spark = table.sparkSession
    date = X.day("timestamp").alias("date")
    rows = table.select(*columns, date)
    if incremental and path_exists(spark, out):
        day = F.col("day").alias("date") if "day" in table.columns else date
        now = table.groupBy(day).agg(F.count(F.lit(1)).alias("n"))
        have = spark.read.schema(rows.schema).parquet(out).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
        # one row per day at most; rows without time are a day of their own
        both = now.alias("a").join(have.alias("b"), F.col("a.date").eqNullSafe(F.col("b.date")), "full")
        stale = both.where(~F.col("a.n").eqNullSafe(F.col("b.n"))) \
            .select(F.coalesce("a.date", "b.date").alias("date"), F.col("a.n").alias("n")).collect()
        # a day that is gone means writing everything
        if all(r["n"] is not None for r in stale):
            if not stale:
                return out

            def among(col):
                return col.isin([r["date"] for r in stale if r["date"] is not None]) | \
                    (col.isNull() if any(r["date"] is None for r in stale) else F.lit(False))

            kept = table.filter(among(F.col("day"))) if "day" in table.columns else table
            kept.select(*columns, date).filter(among(F.col("date"))).hint("rebalance", "date") \
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("date").parquet(out)
            return out
    rows.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(out)
    return out


def export_latest_json(summaries: DataFrame, out: str, generated_at, n: int = 1000,
                       day_counts: DataFrame | None = None) -> str:
    """K3: one document {last_updated, total_sites, audits[<= n, newest first]}.

    ``n`` bounds the rows gathered into the document's single task; with
    ``day_counts`` only the newest day folders are read.
    """
    rows = R.latest_audits(summaries, n, day_counts)
    item = F.struct(F.col("timestamp").alias("__ts"), F.col("url").alias("__url"),
                    "url", X.iso_text("timestamp").alias("timestamp"), "mobile_performance",
                    "desktop_performance", "mobile_accessibility", "desktop_accessibility",
                    "has_errors", "error_message")
    doc = rows.agg(F.count(F.lit(1)).alias("total_sites"),
                   F.sort_array(F.collect_list(item), asc=False).alias("audits"))
    doc = doc.select(_iso_lit(generated_at).alias("last_updated"), "total_sites",
                     F.transform("audits", lambda s: s.dropFields("__ts", "__url")).alias("audits"))
    doc.select(F.to_json(F.struct("*")).alias("value")).coalesce(1) \
        .write.mode("overwrite").text(out)
    return out


def export_metrics_json(summaries: DataFrame, out: str, generated_at) -> str:
    """K4: A1 + generated_at as one JSON record."""
    return write_metrics_json(M.aggregated_metrics(summaries), out, generated_at)


def write_metrics_json(metrics: DataFrame, out: str, generated_at) -> str:
    """K4 over an A1 row that is there (e.g. from partials)."""
    metrics.withColumn("generated_at", _iso_lit(generated_at)) \
        .coalesce(1).write.mode("overwrite").json(out)
    return out


def quarantine_sites(current: DataFrame) -> DataFrame:
    """F7 rows with ISO text timestamps, as the exports carry them."""
    return _iso_cols(FL.list_quarantined(current), "first_failure", "last_failure", "created_at")


def export_quarantine_json(current: DataFrame, out: str, generated_at) -> dict[str, str]:
    """K5: ``stats`` (A6, one record) and ``sites`` (F7, JSON lines), both
    stamped with the same ``generated_at``."""
    g = _iso_lit(generated_at)
    M.quarantine_stats(current).withColumn("generated_at", g).coalesce(1) \
        .write.mode("overwrite").json(f"{out}/stats")
    quarantine_sites(current).withColumn("generated_at", g) \
        .write.mode("overwrite").json(f"{out}/sites")
    return {"stats": f"{out}/stats", "sites": f"{out}/sites"}


def export_quarantine_csv(current: DataFrame, out: str) -> str:
    """K6: F7 as CSV with a header; an empty list gives empty output, no header."""
    sites = quarantine_sites(current)
    empty = sites.limit(1).count() == 0  # bounded check
    sites.write.mode("overwrite").option("header", not empty).csv(out)
    return out


def export_metrics(metrics: DataFrame, out: str, formats=("csv", "json")) -> dict[str, str]:
    """K8: the seven export columns as CSV (missing -> '') and JSON lines."""
    cols = ["url", "performance", "accessibility", "seo", "bestPractices", "timestamp",
            "ibge_code"]
    rows = _iso_cols(metrics.select(*cols), "timestamp")
    paths = {}
    if "csv" in formats:
        rows.write.mode("overwrite").option("header", True).option("nullValue", "") \
            .csv(f"{out}/csv")
        paths["csv"] = f"{out}/csv"
    if "json" in formats:
        rows.write.mode("overwrite").json(f"{out}/json")
        paths["json"] = f"{out}/json"
    return paths


def export_dashboard(summaries: DataFrame, quarantine: DataFrame, out: str,
                     generated_at, latest: DataFrame | None = None,
                     partials: DataFrame | None = None) -> dict:
    """K7: summary, ranking, top50, worst50, by-state and quarantine datasets,
    all stamped with one ``generated_at``.  The ranking is numbered once (from
    a checkpoint of its rows in the shared folder) and reused for the top and
    bottom lists."""
    g = _iso_lit(generated_at)
    paths, jobs = {}, []

    def put(name, df, one=False):
        d = df.withColumn("generated_at", g)
        jobs.append(lambda: (d.coalesce(1) if one else d).write.mode("overwrite")
                    .json(f"{out}/{name}"))
        paths[name] = f"{out}/{name}"

    # maintained per-day partials when given (no scan of the whole history)
    summary = (M.aggregated_metrics_from_partials(partials) if partials is not None
               else M.aggregated_metrics(summaries))
    put("summary", summary, one=True)
    # the maintained W1 table when given (no scan of the whole history)
    ranking = (R.site_ranking_from_latest(latest) if latest is not None
               else R.site_ranking(summaries))
    sites = Observation()  # the number of sites is counted while they are written
    put("ranking", _iso_cols(ranking.observe(sites, F.count(F.lit(1)).alias("n")), "timestamp"))
    put("top50", _iso_cols(R.top_sites(ranking, 50), "timestamp"), one=True)
    put("worst50", _iso_cols(R.bottom_sites(ranking, 50), "timestamp"), one=True)
    put("by-state", M.metrics_by_state_from_partials(partials) if partials is not None
        else M.metrics_by_state(summaries))
    cur = quarantine_current(quarantine)
    put("quarantine/stats", M.quarantine_stats(cur), one=True)
    put("quarantine/sites", quarantine_sites(cur))
    # the datasets are independent: submit the writes as concurrent jobs
    run_concurrently(jobs)
    return {"generated_at": _iso_text_value(generated_at), "files": paths,
            "total_sites": sites.get["n"]}


def _iso_text_value(t) -> str:
    return t.isoformat() if isinstance(t, dt.datetime) else str(t)
