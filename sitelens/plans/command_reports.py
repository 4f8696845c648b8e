"""The daily commands run over stored tables with a history, with SQL oracles.

The stored tables hold every run of the proxy in two loads, and a third load of
responses that carry no time: their audits are errors without a timestamp.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as X
from ..operators import metrics as M
from ..operators import quarantine as Q
from ..operators import ranking as R
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import proxy as P
from ..sources.tables import read_table
from ..sources.url_index import find_url_stored, temporal_evolution_stored
from ..sources.versions import published_folder
from . import batch as B
from . import oracle as O
from .io_reports import APPEND_SPLIT_DAYS, METRICS_JSON_SCHEMA, ROUNDED_METRICS, metrics_sql, sql_iso
from .quarantine_reports import qsql
from .reports import DIGITS, REPORTS, TREND_URL, WILD_PATTERN, report, rounded, sql_state_group

TIMELESS_MOD = 97
_BASES: dict = {}


def stored_base(spark, sf) -> str:
    """Base folder of the stored tables, written once per Spark application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BASES:
        base = scratch_path(spark, "deployed")
        raw = P.raw_responses(spark, sf)
        split = X.minus_days(P.as_of(spark, sf), APPEND_SPLIT_DAYS)
        W.append_responses(raw.filter(F.col("fetched_at") < split), base)
        B.maintained_tables(spark, base)
        W.append_responses(raw.filter(F.col("fetched_at") >= split), base)
        timeless = raw.filter(F.col("run_id") % TIMELESS_MOD == 0).withColumns(
            {"run_id": -F.col("run_id"), "fetched_at": F.lit(None).cast(schemas.TS)})
        W.append_responses(timeless, base)
        _BASES[key] = base
    return _BASES[key]


_ALL = ("all_summaries AS (SELECT * FROM summaries UNION ALL BY NAME SELECT -id AS id, url, true AS has_errors, "
        f"'Request error: missing mobile response' AS error_message FROM summaries WHERE id % {TIMELESS_MOD} = 0)")


def _by_state_sql(more: str = "") -> str:
    return ("SELECT " + sql_state_group() + " AS state, count(*) AS site_count, "
            f"round(avg(mobile_performance), {DIGITS}) AS avg_performance, "
            f"round(avg(mobile_accessibility), {DIGITS}) AS avg_accessibility{more} FROM all_summaries "
            f"WHERE NOT has_errors AND {sql_state_group()} <> '' GROUP BY 1")


@report("metrics_command", O.sql(metrics_sql("all_summaries"), _ALL))
def q_metrics_command(spark, sf):
    return rounded(B.run_metrics(spark, stored_base(spark, sf)), *ROUNDED_METRICS)


@report("metrics_command_by_state", O.sql(_by_state_sql(), _ALL))
def q_metrics_command_by_state(spark, sf):
    return rounded(B.run_metrics(spark, stored_base(spark, sf), by_state=True), "avg_performance", "avg_accessibility")


@report("stats_command", O.sql(
    "SELECT count(*) AS total_audits, count(error_message) AS total_errors, "
    "round((count(*) - count(error_message)) / count(*) * 100, 1) AS success_pct FROM all_summaries", _ALL))
def q_stats_command(spark, sf):
    return B.run_stats(spark, stored_base(spark, sf))["stats"]


@report("stats_command_recent", O.sql(
    f"SELECT url, \"timestamp\", CASE WHEN error_message IS NULL THEN '{X.STATUS_OK_MARK}' ELSE '{X.STATUS_FAIL_MARK}' END "
    "AS status FROM summaries ORDER BY \"timestamp\" DESC, id DESC LIMIT 10"))
def q_stats_command_recent(spark, sf):
    return B.run_stats(spark, stored_base(spark, sf))["recent"]


_DASHBOARDS: dict = {}


def _dashboard(spark, sf, name: str, schema: T.StructType):
    base = stored_base(spark, sf)
    if base not in _DASHBOARDS:
        out = scratch_path(spark, "dashboard-published")
        B.run_dashboard_export(spark, base, out, P.as_of_value(spark, sf))
        _DASHBOARDS[base] = published_folder(spark, out)
    return spark.read.schema(schema).json(f"{_DASHBOARDS[base]}/{name}")


@report("dashboard_summary", O.sql(metrics_sql("all_summaries", f", {sql_iso(O.AS_OF)} AS generated_at"), _ALL))
def q_dashboard_summary(spark, sf):
    return rounded(_dashboard(spark, sf, "summary", METRICS_JSON_SCHEMA), *ROUNDED_METRICS)


_STATE_ROW = T.StructType([T.StructField("state", T.StringType()), T.StructField("site_count", T.LongType()),
                           T.StructField("avg_performance", T.DoubleType()), T.StructField("avg_accessibility", T.DoubleType()),
                           T.StructField("generated_at", T.StringType())])


@report("dashboard_by_state", O.sql(_by_state_sql(f", {sql_iso(O.AS_OF)} AS generated_at"), _ALL))
def q_dashboard_by_state(spark, sf):
    return rounded(_dashboard(spark, sf, "by-state", _STATE_ROW), "avg_performance", "avg_accessibility")


@report("overview_from_partials", O.sql(
    "SELECT 2 * count(*) AS total_records, max(\"timestamp\") AS latest_timestamp, true AS urls_within_bound FROM all_summaries", _ALL))
def q_overview_from_partials(spark, sf):
    """The estimate of distinct urls against the exact number, within four standard errors."""
    base = stored_base(spark, sf)
    near = M.metrics_overview_from_partials(B.read_partials(spark, base))
    exact = read_table(spark, base, "audit_summaries").select("url").distinct().count()
    return near.select("total_records", "latest_timestamp", (F.abs(F.col("unique_urls") - exact) <= 0.032 * exact).alias("urls_within_bound"))


@report("performance_trend_maintained", REPORTS["performance_trend"][1])
def q_performance_trend_maintained(spark, sf):
    return M.performance_trend_from_state(B.maintained_tables(spark, stored_base(spark, sf)).trends)


@report("find_url_stored", O.sql(
    f"SELECT {O.SUMMARY_COLUMNS} FROM summaries WHERE url LIKE '%{WILD_PATTERN}%' UNION ALL BY NAME "
    f"SELECT * FROM all_summaries WHERE id < 0 AND url LIKE '%{WILD_PATTERN}%'", _ALL))
def q_find_url_stored(spark, sf):
    return find_url_stored(spark, stored_base(spark, sf), WILD_PATTERN)


@report("temporal_evolution_stored", REPORTS["temporal_evolution"][1])
def q_temporal_evolution_stored(spark, sf):
    return temporal_evolution_stored(spark, stored_base(spark, sf), TREND_URL)


@report("bottom_sites_from_latest", REPORTS["bottom_sites"][1])
def q_bottom_sites_from_latest(spark, sf):
    return R.bottom_sites_from_latest(B.read_latest(spark, stored_base(spark, sf)), 50)


@report("quarantine_commands", qsql("SELECT * FROM quarantine"))
def q_quarantine_commands(spark, sf):
    """Update, update, set status and remove as commands; every version of the table."""
    base = scratch_path(spark, "quarantine-commands")
    raw = P.raw_responses(spark, sf)
    W.append_responses(raw, base)
    st = P.quarantine_steps(spark, sf)
    for t in (st["t1"], st["t2"]):
        B.run_quarantine_update(spark, base, t)
    B.run_set_status(spark, base, st["set_changes"], st["t3"])
    B.run_remove(spark, base, st["removals"], st["t3"])
    return read_table(spark, base, "quarantine").select(*Q.QUARANTINE_COLUMNS)
