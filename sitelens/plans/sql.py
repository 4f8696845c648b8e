"""SQL over the registered audit tables with bound parameters and the domain's rules.

:func:`register_functions` makes the scalar rules (X1-X11) SQL functions and the reports A1, A3 and
W3 over the registered tables table functions.

Values are bound as literals by Spark (never spliced into the text): str,
int, float, None and datetime.  A datetime binds as its ISO wall-clock text,
which Spark casts when it meets a TIMESTAMP_NTZ column (zone-free).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..functions import scalars as X
from ..operators import ranking as R
from ..operators.metrics import MEAN_COLS, STD_COLS
from ..sources.tables import register_tables


def _bind(v):
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


_HOST = (r"lower(regexp_replace(regexp_replace(regexp_extract(url, r'^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), "
         r"r'^.*@', ''), r':[0-9]*$', ''))")


def _site_name_sql() -> str:
    name = f"replace({_HOST}, 'www.', '')"
    for suffix in X.NAME_SUFFIXES:
        name = f"regexp_replace({name}, r'{suffix.replace('.', chr(92) + '.')}$', '')"
    return f"CASE WHEN {_HOST} <> '' THEN {name} ELSE url END"


def _badge_sql(good: str, fine: str, poor: str) -> str:
    return (f"CASE WHEN score >= {X.BADGE_EXCELLENT} THEN '{good}' WHEN score >= {X.BADGE_GOOD} THEN '{fine}' "
            f"ELSE '{poor}' END")


_STATE = f"upper(regexp_extract({{}}, r'{X.STATE_PATTERN.replace('{', '{{').replace('}', '}}')}', 1))"
_GOOD, _OK, _BAD = X.SCORE_BANDS
_SECONDS = "date_format(t, \"yyyy-MM-dd'T'HH:mm:ss\")"

#: name -> (parameters, result, body); the same rules as in :mod:`sitelens.functions.scalars`.
SCALAR_FUNCTIONS = {
    "state_from_url": ("url STRING", "STRING", _STATE.format("url")),
    "state_label": ("url STRING", "STRING", f"CASE WHEN {_STATE.format('lower(url)')} <> '' THEN {_STATE.format('lower(url)')} ELSE '{X.NO_STATE}' END"),
    "site_name": ("url STRING", "STRING", _site_name_sql()),
    "normalize_url": ("url STRING", "STRING", "regexp_replace(url, '/+$', '') || '/'"),
    "is_valid_url": ("url STRING", "BOOLEAN", f"coalesce(url RLIKE r'{X.VALID_URL_PATTERN}', false)"),
    "audit_day": ("t TIMESTAMP_NTZ", "DATE", "to_date(t)"),
    "score_percent": ("score DOUBLE", "DOUBLE", "round(coalesce(score, 0D) * 100, 1)"),
    "iso_text": ("t TIMESTAMP_NTZ", "STRING",
                 f"CASE WHEN date_format(t, 'SSSSSS') = '000000' THEN {_SECONDS} ELSE {_SECONDS} || '.' || date_format(t, 'SSSSSS') END"),
    "score_band": ("score DOUBLE", "STRING",
                   f"CASE WHEN score >= {X.BAND_GOOD} THEN '{_GOOD}' WHEN score >= {X.BAND_OK} THEN '{_OK}' WHEN score IS NOT NULL THEN '{_BAD}' END"),
    "badge_class": ("score DOUBLE", "STRING", _badge_sql("excellent", "good", "poor")),
    "badge_text": ("score DOUBLE", "STRING", _badge_sql(*(X.BADGE_TEXT[k] for k in ("excellent", "good", "poor")))),
    "status_mark": ("error STRING", "STRING", f"CASE WHEN error IS NULL THEN '{X.STATUS_OK_MARK}' ELSE '{X.STATUS_FAIL_MARK}' END"),
}

_MEANS = "".join(f", avg({c}) AS avg_{c}" for c in MEAN_COLS) + "".join(f", stddev_samp({c}) AS std_{c}" for c in STD_COLS)
#: Reports over the registered tables, without parameters.
TABLE_FUNCTIONS = {
    "aggregated_metrics": (
        "SELECT total_audits, successful_audits, failed_audits, if(total_audits > 0, successful_audits / total_audits, 0D) AS success_rate, "
        "if(total_audits > 0, failed_audits / total_audits, 0D) AS error_rate, * EXCEPT (total_audits, successful_audits, failed_audits) FROM ("
        f"SELECT count(*) AS total_audits, count_if(NOT has_errors) AS successful_audits, count_if(has_errors) AS failed_audits{_MEANS}, "
        "min(mobile_performance) AS min_mobile_performance, max(mobile_performance) AS max_mobile_performance FROM audit_summaries)"),
    "metrics_by_state": (
        "SELECT state_from_url(url) AS state, count(*) AS site_count, avg(mobile_performance) AS avg_performance, "
        "avg(mobile_accessibility) AS avg_accessibility FROM audit_summaries WHERE NOT has_errors AND state_from_url(url) <> '' "
        "GROUP BY state_from_url(url)"),
    # numbered without a window over all rows when the tables were registered
    "site_ranking": "SELECT * FROM site_ranking_rows",
}


def register_functions(spark: SparkSession) -> None:
    """Create the SQL functions of the session; the tables must be registered.

    ``site_ranking()`` answers from the ranking (W3) of the ``audit_summaries`` registered now.
    """
    for name, (params, result, body) in SCALAR_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {result} RETURN {body}")
    if not spark.catalog.tableExists("audit_summaries"):
        return
    R.site_ranking(spark.table("audit_summaries")).createOrReplaceTempView("site_ranking_rows")
    for name, body in TABLE_FUNCTIONS.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.sql(body).schema)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({columns}) RETURN {body}")


def run_sql(spark: SparkSession, sql: str, args: dict | list | None = None,
            tables: dict[str, DataFrame] | None = None, base: str | None = None) -> DataFrame:
    """``spark.sql`` after binding the audit tables by name."""
    if tables or base:
        register_tables(spark, base=base, frames=tables)
    if args is None:
        return spark.sql(sql)
    if isinstance(args, dict):
        bound = {k: _bind(v) for k, v in args.items()}
    else:
        bound = [_bind(v) for v in args]
    return spark.sql(sql, args=bound)
