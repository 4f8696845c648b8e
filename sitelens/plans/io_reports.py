"""Reports that go through files: sources, assembly, sinks, streaming, SQL.

Each writes what Spark derives from the driver tables into a fresh folder
below the shared work folder (``spark.checkpoint.dir``), reads it back with
the library's readers and returns the read-back rows, so the oracle checks
the whole write/read path.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as X
from ..operators import assemble as A
from ..operators import metrics as M
from ..operators import quality as QL
from ..operators import ranking as R
from ..operators.quarantine import quarantine_current
from ..session import scratch_path
from ..sinks import writers as W
from ..sources import files as S
from ..sources import proxy as P
from ..sources.tables import register_tables
from ..streaming import ingest as ST
from . import oracle as O
from .batch import maintained_tables
from .quarantine_reports import Q_CTES, qsql
from .reports import (DIGITS, SQL_LATEST, SQL_LATEST_STRATEGY, SQL_RANKING, report, rounded,
                      sql_site_name, sql_state_group, sql_state_label)
from .sql import register_functions, run_sql

SITE_LIST_COLUMN = "Endereço Eletrônico"
STREAM_FILES, STREAM_FILES_PER_TRIGGER = 8, 4
APPEND_SPLIT_DAYS = 15
SQL_SINCE_DAYS = 7


def sql_iso(col: str) -> str:
    return (f"CASE WHEN strftime({col}, '%f') = '000000' THEN strftime({col}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') END")


_VALID = "'" + X.VALID_URL_PATTERN + "'"


# ---------------------------------------------------------------------------
# Sources and url rules
# ---------------------------------------------------------------------------

@report("valid_urls", O.sql(
    f"SELECT trim(url) AS url FROM pages WHERE url IS NOT NULL AND trim(url) <> '' "
    f"AND regexp_matches(trim(url), {_VALID})"))
def q_valid_urls(spark, sf):
    path = scratch_path(spark, "site-list")
    P.page_urls(spark, sf).select(F.col("url").alias(SITE_LIST_COLUMN), "page_id") \
        .write.option("header", True).csv(path)
    return S.read_site_list(spark, path, SITE_LIST_COLUMN).select("url")


@report("site_list_rows", O.sql(
    "SELECT trim(url) AS url FROM pages WHERE page_id % 4 IN (0, 3) AND url IS NOT NULL AND trim(url) <> '' "
    f"AND regexp_matches(trim(url), {_VALID})"))
def q_site_list_rows(spark, sf):
    """S1 with padded, invalid and empty values and notes that hold quotes, commas and line breaks."""
    path = scratch_path(spark, "site-list-rows")
    kind, url = F.col("page_id") % 4, F.col("url")
    value = (F.when(kind == 0, F.concat(F.lit(" \t"), url, F.lit(" "))).when(kind == 1, F.concat(F.lit("no url "), F.col("page_id").cast("string")))
             .when(kind == 2, F.lit("")).otherwise(url))
    note = F.concat(F.lit('said "x", twice\n'), url, F.lit(",\n"))
    P.page_urls(spark, sf).select(note.alias("Observação"), value.alias(SITE_LIST_COLUMN), "page_id").write.option("header", True) \
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return S.read_site_list(spark, path, SITE_LIST_COLUMN).select("url")


@report("normalized_urls", O.sql(
    "SELECT page_id, url, regexp_replace(url, '/+$', '') || '/' AS normalized FROM pages"))
def q_normalized_urls(spark, sf):
    return P.page_urls(spark, sf).select("page_id", "url", X.normalize_url("url").alias("normalized"))


@report("site_names", O.sql(
    f"SELECT page_id, url, {sql_site_name()} AS name, {sql_state_label()} AS state FROM pages"))
def q_site_names(spark, sf):
    return P.page_urls(spark, sf).select("page_id", "url", X.site_name("url").alias("name"),
                                         X.state_label("url").alias("state"))


# ---------------------------------------------------------------------------
# Ingest from stored responses
# ---------------------------------------------------------------------------

def _stored_raw(spark, sf, name="raw-responses", files=STREAM_FILES):
    """Stored responses as files: the two responses of a run may land in different ones."""
    path = scratch_path(spark, name)
    P.raw_responses(spark, sf).repartition(files, "run_id", "strategy") \
        .write.option("compression", "zstd").parquet(path)
    return path


@report("assemble_audits", O.sql(
    "SELECT id, url, \"timestamp\", error_message, CAST(0 AS BIGINT) AS retry_count, "
    "\"timestamp\" AS created_at, NOT has_errors AS has_mobile_result, "
    "NOT has_errors AS has_desktop_result FROM summaries"))
def q_assemble_audits(spark, sf):
    raw = S.read_raw_responses(spark, P.raw_responses_path(spark, sf))
    a = A.assemble_audits(raw)
    return a.select("id", "url", "timestamp", "error_message", "retry_count", "created_at",
                    F.col("mobile_result").isNotNull().alias("has_mobile_result"),
                    F.col("desktop_result").isNotNull().alias("has_desktop_result"))


@report("summarize_audits", O.sql("SELECT * FROM summaries"))
def q_summarize_audits(spark, sf):
    # one parse of each body, as in ingest; T2 over stored documents gives the same (tests)
    both = A.assemble_with_summaries(P.raw_responses(spark, sf))
    return both.select(*schemas.AUDIT_SUMMARIES.fieldNames())


@report("response_validation", O.sql(
    "SELECT strategy, outcome, count(*) AS n FROM (SELECT 'mobile' AS strategy, CASE WHEN has_errors "
    "THEN 'http_error' ELSE 'ok' END AS outcome FROM summaries UNION ALL SELECT 'desktop', 'ok' "
    "FROM summaries) GROUP BY strategy, outcome"))
def q_response_validation(spark, sf):
    v = A.validate_responses(P.raw_responses(spark, sf))
    return v.groupBy("strategy", "outcome").agg(F.count(F.lit(1)).alias("n"))


# mobile responses of run id % 6: what came instead, its outcome and its error text
_BROKEN = [(1, {"failure": "timeout", "reason": "slow"}, "transport_error", f"{A.TIMEOUT_PREFIX}slow"),
           (2, {"failure": "request", "reason": "refused"}, "transport_error", f"{A.REQUEST_PREFIX}refused"),
           (3, {"body": "{not json"}, "invalid_body", f"{A.VALIDATION_PREFIX}{A.VALIDATION_TEXT}"),
           (4, {"status_code": 302, "reason": "Found", "body": ""}, "http_error", f"{A.HTTP_PREFIX}302: Found"),
           (5, {"failure": "dns"}, "transport_error", "OK")]
_BROKEN_MOD = 6


def _broken_responses(spark, sf):
    """Stored responses in which the mobile ones of successful runs fail in every way."""
    raw = P.raw_responses(spark, sf)
    for rem, values, _, _ in _BROKEN:
        hit = (F.col("run_id") % _BROKEN_MOD == rem) & (F.col("strategy") == "mobile") & (F.col("status_code") == 200)
        # the status is a condition of its own, so it is set last
        for c, v in sorted(values.items(), key=lambda x: x[0] == "status_code"):
            raw = raw.withColumn(c, F.when(hit, F.lit(v)).otherwise(F.col(c)))
    return raw


def _broken_case(column: int) -> str:
    return "CASE" + "".join(f" WHEN id % {_BROKEN_MOD} = {b[0]} THEN '{b[column]}'" for b in _BROKEN)


@report("response_outcomes", O.sql(
    f"SELECT id AS run_id, 'mobile' AS strategy, CASE WHEN has_errors THEN 'http_error' ELSE {_broken_case(2)} ELSE 'ok' END END AS outcome, "
    f"CASE WHEN has_errors THEN error_message ELSE {_broken_case(3)} END END AS problem FROM summaries "
    "UNION ALL SELECT id, 'desktop', 'ok', NULL FROM summaries"))
def q_response_outcomes(spark, sf):
    """Every outcome and error text."""
    return A.validate_responses(_broken_responses(spark, sf)).select("run_id", "strategy", "outcome", "problem")


@report("assembled_outcomes", O.sql(
    f"SELECT id, url, \"timestamp\", CASE WHEN has_errors THEN error_message ELSE {_broken_case(3)} END END AS error_message, "
    + ", ".join(f"CASE WHEN id % {_BROKEN_MOD} = 0 THEN {c} END AS {c}" for c in schemas.SCORE_COLUMNS + schemas.VITAL_COLUMNS)
    + " FROM summaries"))
def q_assembled_outcomes(spark, sf):
    """T1 and T2 over responses that fail in every way: all or nothing, and the values of the stored documents."""
    audits = A.assemble_audits(_broken_responses(spark, sf))
    return A.summarize_audits(audits).select("id", "url", "timestamp", "error_message", *schemas.SCORE_COLUMNS, *schemas.VITAL_COLUMNS)


@report("appended_audits", O.sql("SELECT * FROM summaries"))
def q_appended_audits(spark, sf):
    base = scratch_path(spark, "tables")
    raw = P.raw_responses(spark, sf)
    split = X.minus_days(P.as_of(spark, sf), APPEND_SPLIT_DAYS)
    W.append_responses(raw.filter(F.col("fetched_at") < split), base)
    W.append_responses(raw.filter(F.col("fetched_at") >= split), base)
    return spark.read.schema(schemas.AUDIT_SUMMARIES).parquet(f"{base}/audit_summaries") \
        .select(*schemas.AUDIT_SUMMARIES.fieldNames())


@report("dashboard_after_history", O.sql("SELECT * FROM ranking", SQL_LATEST + ",\n" + SQL_RANKING))
def q_dashboard_after_history(spark, sf):
    """The dashboard's ranking from the maintained table, after two loads it did not make itself."""
    base = scratch_path(spark, "history")
    raw = P.raw_responses(spark, sf)
    split = X.minus_days(P.as_of(spark, sf), APPEND_SPLIT_DAYS)
    W.append_responses(raw.filter(F.col("fetched_at") < split), base)
    maintained_tables(spark, base)
    W.append_responses(raw.filter(F.col("fetched_at") >= split), base)
    return R.site_ranking_from_latest(maintained_tables(spark, base).latest)


@report("stream_equals_batch", O.sql("SELECT * FROM summaries"))
def q_stream_equals_batch(spark, sf):
    raw_path = _stored_raw(spark, sf, "stream-input")
    out = scratch_path(spark, "stream-output")
    q = ST.ingest_stream(spark, raw_path, out, scratch_path(spark, "stream-checkpoint"),
                         max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return ST.read_ingested(spark, out)


# ---------------------------------------------------------------------------
# Sinks read back (K1-K8)
# ---------------------------------------------------------------------------

@report("audits_by_day", O.sql(
    "SELECT url, \"timestamp\", error_message, retry_count, CAST(\"timestamp\" AS DATE) AS date "
    "FROM audits"))
def q_audits_by_day(spark, sf):
    out = W.export_audits_parquet(P.audits(spark, sf), scratch_path(spark, "audits-by-day"))
    schema = T.StructType([schemas.AUDITS["url"], schemas.AUDITS["timestamp"],
                           schemas.AUDITS["error_message"], schemas.AUDITS["retry_count"],
                           T.StructField("date", T.DateType())])
    return spark.read.schema(schema).parquet(out)


@report("summaries_parquet", O.sql("SELECT * FROM summaries"))
def q_summaries_parquet(spark, sf):
    out = W.export_summaries_parquet(P.summaries(spark, sf), scratch_path(spark, "summaries"))
    return spark.read.schema(schemas.AUDIT_SUMMARIES).parquet(out)


_LATEST_ITEM = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("timestamp", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in ("mobile_performance", "desktop_performance",
                                                 "mobile_accessibility", "desktop_accessibility")],
    T.StructField("has_errors", T.BooleanType()), T.StructField("error_message", T.StringType())])
_LATEST_DOC = T.StructType([T.StructField("last_updated", T.StringType()),
                            T.StructField("total_sites", T.LongType()),
                            T.StructField("audits", T.ArrayType(_LATEST_ITEM))])


@report("latest_json", O.sql(
    f"SELECT url, {sql_iso('\"timestamp\"')} AS \"timestamp\", mobile_performance, "
    "desktop_performance, mobile_accessibility, desktop_accessibility, has_errors, error_message, "
    f"(SELECT count(*) FROM l) AS total_sites, {sql_iso(O.AS_OF)} AS last_updated FROM l",
    "l AS (SELECT * FROM summaries ORDER BY \"timestamp\" DESC, id DESC LIMIT 1000)"))
def q_latest_json(spark, sf):
    out = W.export_latest_json(P.summaries(spark, sf), scratch_path(spark, "latest-json"),
                               P.as_of_value(spark, sf), 1000)
    doc = spark.read.schema(_LATEST_DOC).json(out)
    return doc.select("last_updated", "total_sites", F.inline("audits"))


_COUNTS = ("total_audits", "successful_audits", "failed_audits")
_METRIC_NAMES = (["success_rate", "error_rate"] + [f"avg_{c}" for c in M.MEAN_COLS] + [f"std_{c}" for c in M.STD_COLS]
                 + ["min_mobile_performance", "max_mobile_performance"])
METRICS_JSON_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS]
                                   + [T.StructField(c, T.DoubleType()) for c in _METRIC_NAMES]
                                   + [T.StructField("generated_at", T.StringType())])
ROUNDED_METRICS = [c for c in _METRIC_NAMES if c.startswith(("avg_", "std_"))]


def metrics_sql(table: str, more: str = "") -> str:
    """A1 + A2 of a summaries table."""
    return (
        "SELECT count(*) AS total_audits, CAST(count_if(NOT has_errors) AS BIGINT) AS successful_audits, "
        "CAST(count_if(has_errors) AS BIGINT) AS failed_audits, "
        "CASE WHEN count(*) > 0 THEN count_if(NOT has_errors) / count(*) ELSE 0.0 END AS success_rate, "
        "CASE WHEN count(*) > 0 THEN count_if(has_errors) / count(*) ELSE 0.0 END AS error_rate, "
        + ", ".join(f"round({'avg' if c.startswith('avg_') else 'stddev_samp'}({c[4:]}), {DIGITS}) AS {c}"
                    for c in ROUNDED_METRICS)
        + ", min(mobile_performance) AS min_mobile_performance, "
        f"max(mobile_performance) AS max_mobile_performance{more} FROM {table}")


@report("metrics_json", O.sql(metrics_sql("summaries", f", {sql_iso(O.AS_OF)} AS generated_at")))
def q_metrics_json(spark, sf):
    out = W.export_metrics_json(P.summaries(spark, sf), scratch_path(spark, "metrics-json"),
                                P.as_of_value(spark, sf))
    return rounded(spark.read.schema(METRICS_JSON_SCHEMA).json(out), *ROUNDED_METRICS)


_SITE_FIELDS = [("url", T.StringType()), ("first_failure", T.StringType()),
                ("last_failure", T.StringType()), ("consecutive_failures", T.LongType()),
                ("last_error", T.StringType()), ("status", T.StringType()),
                ("notes", T.StringType()), ("created_at", T.StringType())]
_SITES_SQL = (
    f"SELECT url, {sql_iso('first_failure')} AS first_failure, {sql_iso('last_failure')} AS "
    "last_failure, consecutive_failures, last_error_message AS last_error, status, notes, "
    f"{sql_iso('created_at')} AS created_at FROM qcur WHERE status <> '{schemas.REMOVED_STATUS}'")


@report("quarantine_json", qsql(
    f"SELECT *, {sql_iso(O.AS_OF)} AS generated_at FROM ({_SITES_SQL})"))
def q_quarantine_json(spark, sf):
    cur = quarantine_current(P.quarantine(spark, sf))
    paths = W.export_quarantine_json(cur, scratch_path(spark, "quarantine-json"),
                                     P.as_of_value(spark, sf))
    schema = T.StructType([T.StructField(n, t) for n, t in _SITE_FIELDS]
                          + [T.StructField("generated_at", T.StringType())])
    return spark.read.schema(schema).json(paths["sites"])


@report("quarantine_json_stats", qsql(
    "SELECT count(*) AS total, " + ", ".join(f"CAST(count_if(status = '{s}') AS BIGINT) AS {s}" for s in schemas.QUARANTINE_STATUSES)
    + ", coalesce(round(avg(consecutive_failures), 1), 0.0) AS avg_failures, coalesce(max(consecutive_failures), 0) AS max_failures, "
    f"{sql_iso(O.AS_OF)} AS generated_at FROM qcur WHERE status <> '{schemas.REMOVED_STATUS}'"))
def q_quarantine_json_stats(spark, sf):
    cur = quarantine_current(P.quarantine(spark, sf))
    paths = W.export_quarantine_json(cur, scratch_path(spark, "quarantine-json"), P.as_of_value(spark, sf))
    schema = T.StructType([T.StructField(n, T.DoubleType() if n == "avg_failures" else T.LongType())
                           for n in ("total", *schemas.QUARANTINE_STATUSES, "avg_failures", "max_failures")]
                          + [T.StructField("generated_at", T.StringType())])
    return spark.read.schema(schema).json(paths["stats"])


@report("quarantine_csv", qsql(_SITES_SQL))
def q_quarantine_csv(spark, sf):
    cur = quarantine_current(P.quarantine(spark, sf))
    out = W.export_quarantine_csv(cur, scratch_path(spark, "quarantine-csv"))
    schema = T.StructType([T.StructField(n, t) for n, t in _SITE_FIELDS])
    return spark.read.schema(schema).option("header", True).csv(out)


@report("metrics_export", O.sql(
    "SELECT url, \"timestamp\", strategy, ibge_code, performance, accessibility, seo, "
    "\"bestPractices\" FROM (SELECT url, CAST(" + sql_iso('"timestamp"') + " AS TIMESTAMP) AS "
    "\"timestamp\", CAST(NULL AS VARCHAR) AS strategy, ibge_code, performance, accessibility, seo, "
    "\"bestPractices\" FROM latest_s)", SQL_LATEST_STRATEGY))
def q_metrics_export(spark, sf):
    latest = R.latest_per_site_strategy(P.psi_metrics(spark, sf))
    paths = W.export_metrics(latest, scratch_path(spark, "metrics-export"))
    return S.read_metrics_json(spark, paths["json"], multi_line=False)


@report("metrics_csv", O.sql(
    "SELECT url, performance, accessibility, seo, \"bestPractices\", " + sql_iso('"timestamp"') + " AS \"timestamp\", ibge_code "
    "FROM latest_s", SQL_LATEST_STRATEGY))
def q_metrics_csv(spark, sf):
    latest = R.latest_per_site_strategy(P.psi_metrics(spark, sf))
    paths = W.export_metrics(latest, scratch_path(spark, "metrics-csv"), formats=("csv",))
    scores = ("performance", "accessibility", "seo", "bestPractices")
    columns = ["url", *scores, "timestamp", "ibge_code"]
    schema = T.StructType([T.StructField(c, T.DoubleType() if c in scores else T.StringType()) for c in columns])
    return spark.read.schema(schema).option("header", True).csv(paths["csv"])


_DASH = [("summary", "SELECT 1"), ("ranking", "SELECT * FROM ranking"),
         ("top50", "SELECT * FROM ranking ORDER BY rank LIMIT 50"),
         ("worst50", "SELECT * FROM ranking ORDER BY score, rank LIMIT 50"),
         ("by-state", "SELECT DISTINCT upper(regexp_extract(url, '" + X.STATE_PATTERN
          + "', 1)) AS s FROM summaries WHERE NOT has_errors AND upper(regexp_extract(url, '"
          + X.STATE_PATTERN + "', 1)) <> ''"),
         ("quarantine/stats", "SELECT 1"),
         ("quarantine/sites", f"SELECT * FROM qcur WHERE status <> '{schemas.REMOVED_STATUS}'")]


@report("dashboard_bundle", O.sql(
    " UNION ALL ".join(f"SELECT '{n}' AS dataset, (SELECT count(*) FROM ({q})) AS n_rows"
                       for n, q in _DASH),
    SQL_LATEST + ",\n" + SQL_RANKING + ",\n" + Q_CTES))
def q_dashboard_bundle(spark, sf):
    paths = W.export_dashboard(P.summaries(spark, sf), P.quarantine(spark, sf),
                               scratch_path(spark, "dashboard"), P.as_of_value(spark, sf))["files"]
    # one JSON record per line: count lines (no schema inference needed)
    parts = [spark.read.text(p).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(n).alias("dataset"), "n_rows") for n, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------------------
# SQL surface and quality checks
# ---------------------------------------------------------------------------

RUN_SQL_TEXT = ("SELECT strategy, count(*) AS n, round(avg(performance), 6) AS avg_performance "
                "FROM psi_metrics WHERE `timestamp` >= :since AND url LIKE :pattern "
                "GROUP BY strategy")


@report("run_sql", O.sql(
    "SELECT strategy, count(*) AS n, round(avg(performance), 6) AS avg_performance FROM psi_metrics "
    f"WHERE \"timestamp\" >= {O.AS_OF} - INTERVAL {SQL_SINCE_DAYS} DAY AND url LIKE '%.gov.br/' "
    "GROUP BY strategy"))
def q_run_sql(spark, sf):
    since = P.as_of_value(spark, sf) - dt.timedelta(days=SQL_SINCE_DAYS)
    return run_sql(spark, RUN_SQL_TEXT, {"since": since, "pattern": "%.gov.br/"},
                   tables={"psi_metrics": P.psi_metrics(spark, sf)})


RULES_SQL = ("SELECT r.url, r.rank, r.score, site_name(r.url) AS site, state_label(r.url) AS label, "
             "badge_class(r.score) AS badge, score_band(r.score / 100) AS band, s.site_count, "
             "round(s.avg_performance, 6) AS state_performance, (SELECT total_audits FROM aggregated_metrics()) AS total_audits, "
             "(SELECT round(avg_mobile_seo, 6) FROM aggregated_metrics()) AS avg_mobile_seo "
             "FROM site_ranking() r LEFT JOIN metrics_by_state() s ON s.state = state_from_url(r.url) "
             "WHERE is_valid_url(r.url) AND normalize_url(r.url) = r.url")


@report("sql_functions", O.sql(
    f"SELECT r.url, r.rank, r.score, {sql_site_name('r.url')} AS site, {sql_state_label('r.url')} AS label, "
    f"CASE WHEN r.score >= {X.BADGE_EXCELLENT} THEN 'excellent' WHEN r.score >= {X.BADGE_GOOD} THEN 'good' ELSE 'poor' END AS badge, "
    f"CASE WHEN r.score / 100 >= {X.BAND_GOOD} THEN 'good' WHEN r.score / 100 >= {X.BAND_OK} THEN 'ok' ELSE 'bad' END AS band, "
    "s.site_count, s.state_performance, m.total_audits, m.avg_mobile_seo FROM ranking r LEFT JOIN ("
    f"SELECT {sql_state_group()} AS state, count(*) AS site_count, round(avg(mobile_performance), 6) AS state_performance "
    f"FROM summaries WHERE NOT has_errors GROUP BY 1 HAVING {sql_state_group()} <> '') s ON s.state = {sql_state_group('r.url')}, "
    "(SELECT count(*) AS total_audits, round(avg(mobile_seo), 6) AS avg_mobile_seo FROM summaries) m",
    SQL_LATEST + ",\n" + SQL_RANKING))
def q_sql_functions(spark, sf):
    register_tables(spark, frames={"audit_summaries": P.summaries(spark, sf)})
    register_functions(spark)
    return run_sql(spark, RULES_SQL)


@report("null_checks", O.sql(
    "SELECT CAST(count_if(url IS NULL) AS BIGINT) AS null_url, "
    "CAST(count_if(\"timestamp\" IS NULL) AS BIGINT) AS null_timestamp, count(*) AS total_rows "
    "FROM psi_metrics"))
def q_null_checks(spark, sf):
    return QL.null_counts(P.psi_metrics(spark, sf), ("url", "timestamp"))


@report("null_checks_found", O.sql(
    "SELECT CAST(count_if(performance IS NULL) AS BIGINT) AS null_url, CAST(count_if(seo = 0) AS BIGINT) AS null_timestamp, "
    "count(*) AS total_rows FROM psi_metrics"))
def q_null_checks_found(spark, sf):
    """Q1 over a table that lacks some urls and timestamps."""
    m = P.psi_metrics(spark, sf)
    return QL.null_counts(m.withColumns({"url": F.when(F.col("performance").isNotNull(), F.col("url")),
                                         "timestamp": F.when(~F.coalesce(F.col("seo") == 0, F.lit(False)), F.col("timestamp"))}), ("url", "timestamp"))


_DUCK_TO_SPARK = ("CASE {t} WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' "
                  "WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
                  "WHEN 'BOOLEAN' THEN 'boolean' WHEN 'INTEGER' THEN 'int' ELSE lower({t}) END")


def _schema_check_sql() -> str:
    parts = []
    for f in schemas.AUDIT_SUMMARIES.fields:
        col = f'"{f.name}"'
        actual = _DUCK_TO_SPARK.format(t=f"typeof(any_value({col}))")
        nulls = f"CAST(count_if({col} IS NULL) AS BIGINT)"
        parts.append(
            f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS expected_type, "
            f"{actual} AS actual_type, {str(f.nullable).upper()} AS nullable, {nulls} AS null_count, "
            f"({actual} = '{f.dataType.simpleString()}' AND ({str(f.nullable).upper()} OR "
            f"{nulls} = 0)) AS ok FROM summaries")
    return " UNION ALL ".join(parts)


@report("schema_check", O.sql(_schema_check_sql()))
def q_schema_check(spark, sf):
    return QL.schema_check(P.summaries(spark, sf), schemas.AUDIT_SUMMARIES)
