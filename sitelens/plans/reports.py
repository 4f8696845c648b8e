"""Named reports over the driver tables: the Spark plan and its SQL oracle.

Each report reads the whole driver tables (through the proxy views) and runs
the library operators on them.  ``REPORTS[name] = (plan, oracle_sql)`` where
``plan(spark, sf_dir) -> DataFrame``.  Means are rounded to 6 decimals on
both sides so that summation order cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import filters as FL
from ..operators import metrics as M
from ..operators import ranking as R
from ..sources import proxy as P
from . import oracle as O

Plan = Callable[[SparkSession, str], DataFrame]
REPORTS: dict[str, tuple[Plan, str | None]] = {}

DIGITS = 6
TREND_URL = "https://www.cidade1.al.gov.br"
SEARCH_TERM, SEARCH_STATE = " Cidade1 ", "AL"
FIND_PATTERN = "cidade12"
WILD_PATTERN = "cidade_2%.s_.gov"
FILTER_QUERY = "12"
STRATEGY_ARG = "Mobile"


def report(name: str, oracle: str | None):
    def deco(fn: Plan) -> Plan:
        REPORTS[name] = (fn, oracle)
        return fn
    return deco


def rounded(df: DataFrame, *cols: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def r6(expr: str) -> str:
    return f"round({expr}, {DIGITS})"


# ---------------------------------------------------------------------------
# SQL fragments shared by several oracles
# ---------------------------------------------------------------------------

def sql_state_group(col: str = "url") -> str:
    return f"upper(regexp_extract({col}, '{X.STATE_PATTERN}', 1))"


def sql_state_label(col: str = "url") -> str:
    s = f"upper(regexp_extract(lower({col}), '{X.STATE_PATTERN}', 1))"
    return f"CASE WHEN {s} <> '' THEN {s} ELSE '{X.NO_STATE}' END"


def sql_site_name(col: str = "url") -> str:
    auth = f"regexp_extract({col}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
    host = f"lower(regexp_replace(regexp_replace({auth}, '^.*@', ''), ':[0-9]*$', ''))"
    name = f"replace({host}, 'www.', '')"
    for suffix in X.NAME_SUFFIXES:
        name = (f"(CASE WHEN suffix({name}, '{suffix}') "
                f"THEN left({name}, length({name}) - {len(suffix)}) ELSE {name} END)")
    return f"CASE WHEN {host} <> '' THEN {name} ELSE {col} END"


SQL_LATEST = ("latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
              "(PARTITION BY url ORDER BY \"timestamp\" DESC, id DESC) AS rn FROM summaries "
              "WHERE NOT has_errors) WHERE rn = 1)")
SQL_RANKING = (
    "ranking AS (SELECT url, " + sql_site_name() + " AS name, " + sql_state_label()
    + " AS state, \"timestamp\", round(coalesce(mobile_accessibility, 0) * 100, 1) AS score, "
    "round(coalesce(mobile_performance, 0) * 100, 1) AS performance, "
    "round(coalesce(mobile_seo, 0) * 100, 1) AS seo, "
    "round(coalesce(mobile_best_practices, 0) * 100, 1) AS best_practices, "
    "round(desktop_accessibility * 100, 1) AS desktop_accessibility, "
    "round(desktop_performance * 100, 1) AS desktop_performance, "
    "mobile_fcp AS fcp, mobile_lcp AS lcp, mobile_cls AS cls, "
    "CAST(row_number() OVER (ORDER BY mobile_accessibility DESC NULLS LAST, url) AS BIGINT) AS rank "
    "FROM latest)")
SQL_LATEST_STRATEGY = (
    "latest_s AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url, "
    "strategy ORDER BY \"timestamp\" DESC, performance DESC NULLS LAST, accessibility DESC NULLS "
    "LAST, seo DESC NULLS LAST, \"bestPractices\" DESC NULLS LAST) AS rn FROM psi_metrics) "
    "WHERE rn = 1)")


def _band_sql(col: str) -> str:
    return (f"CASE WHEN {col} >= {X.BAND_GOOD} THEN 'good' WHEN {col} >= {X.BAND_OK} THEN 'ok' "
            f"WHEN {col} IS NOT NULL THEN 'bad' END")


# ---------------------------------------------------------------------------
# Aggregates (A*)
# ---------------------------------------------------------------------------

@report("metrics_by_state", O.sql(
    f"SELECT state, count(*) AS site_count, {r6('avg(mobile_performance)')} AS avg_performance, "
    f"{r6('avg(mobile_accessibility)')} AS avg_accessibility FROM (SELECT "
    f"{sql_state_group()} AS state, mobile_performance, mobile_accessibility FROM summaries "
    "WHERE NOT has_errors) WHERE state <> '' GROUP BY state "
    "ORDER BY avg_performance DESC NULLS LAST, state"))
def q_metrics_by_state(spark, sf):
    return rounded(M.metrics_by_state(P.summaries(spark, sf)), "avg_performance",
                   "avg_accessibility")


@report("aggregated_metrics", O.sql(
    "SELECT count(*) AS total_audits, CAST(count_if(NOT has_errors) AS BIGINT) AS successful_audits, "
    "CAST(count_if(has_errors) AS BIGINT) AS failed_audits, "
    "CASE WHEN count(*) > 0 THEN count_if(NOT has_errors) / count(*) ELSE 0.0 END AS success_rate, "
    "CASE WHEN count(*) > 0 THEN count_if(has_errors) / count(*) ELSE 0.0 END AS error_rate, "
    + ", ".join(f"{r6(f'avg({c})')} AS avg_{c}" for c in M.MEAN_COLS)
    + f", {r6('stddev_samp(mobile_performance)')} AS std_mobile_performance, "
    f"{r6('stddev_samp(desktop_performance)')} AS std_desktop_performance, "
    "min(mobile_performance) AS min_mobile_performance, "
    "max(mobile_performance) AS max_mobile_performance FROM summaries"))
def q_aggregated_metrics(spark, sf):
    return rounded(M.aggregated_metrics(P.summaries(spark, sf)),
                   *[f"avg_{c}" for c in M.MEAN_COLS], "std_mobile_performance",
                   "std_desktop_performance")


@report("audit_stats", O.sql(
    "SELECT count(*) AS total_audits, count(error_message) AS total_errors, "
    "CASE WHEN count(*) > 0 THEN round((count(*) - count(error_message)) / count(*) * 100, 1) "
    "ELSE 0.0 END AS success_pct FROM audits"))
def q_audit_stats(spark, sf):
    return M.audit_stats(P.audits(spark, sf))


@report("batch_counts", O.sql(
    "SELECT CAST(\"timestamp\" AS DATE) AS run_date, count(*) AS processed, "
    "count(error_message) AS errors FROM audits GROUP BY 1"))
def q_batch_counts(spark, sf):
    return M.batch_counts(P.audits(spark, sf))


@report("performance_trend", O.sql(
    "SELECT url, arg_min(mobile_performance, {'t': \"timestamp\", 'i': id}) AS first_performance, "
    "arg_max(mobile_performance, {'t': \"timestamp\", 'i': id}) AS last_performance, "
    "count(*) AS n_audits, arg_max(mobile_performance, {'t': \"timestamp\", 'i': id}) > "
    "arg_min(mobile_performance, {'t': \"timestamp\", 'i': id}) AS improved FROM summaries "
    "WHERE NOT has_errors AND mobile_performance IS NOT NULL GROUP BY url"))
def q_performance_trend(spark, sf):
    return M.performance_trend(P.summaries(spark, sf))


@report("metrics_overview", O.sql(
    "SELECT count(*) AS total_records, max(\"timestamp\") AS latest_timestamp, "
    "count(DISTINCT url) AS unique_urls FROM psi_metrics"))
def q_metrics_overview(spark, sf):
    return M.metrics_overview(P.psi_metrics(spark, sf))


_AVG3 = ("round(avg(performance), 3) AS avg_performance, round(avg(accessibility), 3) AS "
         "avg_accessibility, round(avg(seo), 3) AS avg_seo, round(avg(\"bestPractices\"), 3) AS "
         "avg_best_practices, count(*) AS record_count")


@report("avg_scores_all", O.sql(f"SELECT 'all' AS strategy_summary, {_AVG3} FROM psi_metrics"))
def q_avg_scores_all(spark, sf):
    return M.avg_scores(P.psi_metrics(spark, sf), "all")


@report("avg_scores_by_strategy", O.sql(
    f"SELECT strategy, {_AVG3} FROM psi_metrics WHERE lower(strategy) = lower('{STRATEGY_ARG}') "
    "GROUP BY strategy"))
def q_avg_scores_by_strategy(spark, sf):
    return M.avg_scores(P.psi_metrics(spark, sf), STRATEGY_ARG)


@report("score_distribution", O.sql(
    "SELECT metric, band, count(*) AS n FROM (SELECT metric, " + _band_sql("score")
    + " AS band FROM (" + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, \"{m}\" AS score FROM psi_metrics"
        for m in ["performance", "accessibility", "seo", "bestPractices"])
    + ")) WHERE band IS NOT NULL GROUP BY metric, band"))
def q_score_distribution(spark, sf):
    return M.score_distribution(P.psi_metrics(spark, sf))


@report("duplicate_keys", O.sql(
    "SELECT url, \"timestamp\", strategy, count(*) AS n FROM replayed "
    "GROUP BY url, \"timestamp\", strategy HAVING count(*) > 1",
    "replayed AS (SELECT * FROM psi_metrics UNION ALL SELECT * FROM psi_metrics "
    f"WHERE CAST(\"timestamp\" AS DATE) = CAST({O.AS_OF} AS DATE))"))
def q_duplicate_keys(spark, sf):
    return M.duplicate_keys(P.replayed_metrics(spark, sf))


# ---------------------------------------------------------------------------
# Filters (F*)
# ---------------------------------------------------------------------------

@report("temporal_evolution", O.sql(
    "SELECT \"timestamp\", mobile_performance, desktop_performance, mobile_accessibility, "
    f"desktop_accessibility FROM summaries WHERE url IN ('{TREND_URL}', '{TREND_URL}/') "
    "AND NOT has_errors ORDER BY \"timestamp\""))
def q_temporal_evolution(spark, sf):
    return FL.temporal_evolution(P.summaries(spark, sf), TREND_URL)


@report("find_url", O.sql(
    f"SELECT * FROM psi_metrics WHERE url LIKE '%{FIND_PATTERN}%' ORDER BY \"timestamp\" DESC"))
def q_find_url(spark, sf):
    return FL.find_url(P.psi_metrics(spark, sf), FIND_PATTERN)


@report("find_url_wildcards", O.sql(
    f"SELECT * FROM psi_metrics WHERE url LIKE '%{WILD_PATTERN}%' ORDER BY \"timestamp\" DESC"))
def q_find_url_wildcards(spark, sf):
    return FL.find_url(P.psi_metrics(spark, sf), WILD_PATTERN)


@report("filter_metrics", O.sql(
    f"SELECT * FROM psi_metrics WHERE contains(lower(url), '{FILTER_QUERY.lower()}') "
    f"OR contains(coalesce(ibge_code, ''), '{FILTER_QUERY.lower()}')"))
def q_filter_metrics(spark, sf):
    return FL.filter_metrics(P.psi_metrics(spark, sf), FILTER_QUERY)


@report("recently_audited", O.sql(
    f"SELECT DISTINCT url FROM audits WHERE \"timestamp\" > {O.AS_OF} - INTERVAL 24 HOUR "
    f"AND \"timestamp\" <= {O.AS_OF} AND error_message IS NULL"))
def q_recently_audited(spark, sf):
    return FL.recently_audited_urls(P.audits(spark, sf), P.as_of(spark, sf), 24)


# ---------------------------------------------------------------------------
# Windows, ranking and top-k (W*, L*)
# ---------------------------------------------------------------------------

@report("worst_performing", O.sql(
    "SELECT url, mobile_performance, desktop_performance, mobile_accessibility, \"timestamp\" "
    "FROM summaries WHERE NOT has_errors AND mobile_performance IS NOT NULL "
    "ORDER BY mobile_performance, url, id LIMIT 10"))
def q_worst_performing(spark, sf):
    return R.worst_performing(P.summaries(spark, sf), 10)


@report("best_accessibility", O.sql(
    "SELECT url, mobile_accessibility, desktop_accessibility, mobile_performance, \"timestamp\" "
    "FROM summaries WHERE NOT has_errors AND mobile_accessibility IS NOT NULL "
    "ORDER BY mobile_accessibility DESC, url, id LIMIT 10"))
def q_best_accessibility(spark, sf):
    return R.best_accessibility(P.summaries(spark, sf), 10)


@report("recent_audits", O.sql(
    "SELECT url, \"timestamp\", CASE WHEN error_message IS NULL THEN '"
    + X.STATUS_OK_MARK + "' ELSE '" + X.STATUS_FAIL_MARK + "' END AS status FROM audits "
    "ORDER BY \"timestamp\" DESC, id DESC LIMIT 10"))
def q_recent_audits(spark, sf):
    return R.recent_audits(P.audits(spark, sf), 10)


@report("latest_audits", O.sql(
    "SELECT url, \"timestamp\", mobile_performance, desktop_performance, mobile_accessibility, "
    "desktop_accessibility, has_errors, error_message FROM summaries "
    "ORDER BY \"timestamp\" DESC, id DESC LIMIT 1000"))
def q_latest_audits(spark, sf):
    return R.latest_audits(P.summaries(spark, sf), 1000)


@report("latest_per_site", O.sql("SELECT * FROM latest", SQL_LATEST))
def q_latest_per_site(spark, sf):
    return R.latest_per_site(P.summaries(spark, sf))


@report("site_ranking", O.sql("SELECT * FROM ranking", SQL_LATEST + ",\n" + SQL_RANKING))
def q_site_ranking(spark, sf):
    return R.site_ranking(P.summaries(spark, sf))


@report("top_sites", O.sql("SELECT * FROM ranking ORDER BY rank LIMIT 50",
                           SQL_LATEST + ",\n" + SQL_RANKING))
def q_top_sites(spark, sf):
    s = P.summaries(spark, sf).select("id", "has_errors", *R.RANKING_SOURCE_COLUMNS)
    return R.top_sites_from_latest(R.latest_per_site(s), 50)


@report("bottom_sites", O.sql("SELECT * FROM ranking ORDER BY score, rank LIMIT 50",
                              SQL_LATEST + ",\n" + SQL_RANKING))
def q_bottom_sites(spark, sf):
    return R.bottom_sites(R.site_ranking(P.summaries(spark, sf)), 50)


@report("score_badges", O.sql(
    f"SELECT url, rank, score, CASE WHEN score >= {X.BADGE_EXCELLENT} THEN 'excellent' "
    f"WHEN score >= {X.BADGE_GOOD} THEN 'good' ELSE 'poor' END AS badge, "
    f"CASE WHEN score >= {X.BADGE_EXCELLENT} THEN '{X.BADGE_TEXT['excellent']}' "
    f"WHEN score >= {X.BADGE_GOOD} THEN '{X.BADGE_TEXT['good']}' "
    f"ELSE '{X.BADGE_TEXT['poor']}' END AS badge_text FROM ranking",
    SQL_LATEST + ",\n" + SQL_RANKING))
def q_score_badges(spark, sf):
    return R.score_badges(R.site_ranking(P.summaries(spark, sf)))


_TERM = SEARCH_TERM.strip().lower()


@report("search_sites", O.sql(
    f"SELECT * FROM ranking WHERE state = '{SEARCH_STATE}' AND (contains(lower(name), '{_TERM}') "
    f"OR contains(lower(state), '{_TERM}') OR contains(lower(url), '{_TERM}'))",
    SQL_LATEST + ",\n" + SQL_RANKING))
def q_search_sites(spark, sf):
    return FL.search_sites(R.site_ranking(P.summaries(spark, sf)), term=SEARCH_TERM,
                           state=SEARCH_STATE)


@report("available_states", O.sql(
    "SELECT DISTINCT state FROM ranking WHERE state IS NOT NULL AND state NOT IN ('', 'N/A') "
    "ORDER BY state", SQL_LATEST + ",\n" + SQL_RANKING))
def q_available_states(spark, sf):
    return M.available_states(R.ranked_states(P.summaries(spark, sf)))


@report("latest_per_site_strategy", O.sql("SELECT * FROM latest_s", SQL_LATEST_STRATEGY))
def q_latest_per_site_strategy(spark, sf):
    return R.latest_per_site_strategy(P.psi_metrics(spark, sf))


@report("list_worst", O.sql(
    "SELECT url, strategy, \"timestamp\", performance FROM latest_s WHERE performance IS NOT NULL "
    "ORDER BY performance, url, strategy LIMIT 10", SQL_LATEST_STRATEGY))
def q_list_worst(spark, sf):
    return R.list_worst(P.psi_metrics(spark, sf), "performance", 10, "all")


@report("sort_metrics", O.sql(
    "SELECT * FROM psi_metrics ORDER BY performance DESC NULLS LAST, url, \"timestamp\", strategy"))
def q_sort_metrics(spark, sf):
    return R.sort_metrics(P.psi_metrics(spark, sf), "performance", ascending=False)


@report("long_metrics", O.sql("SELECT * FROM psi_metrics"))
def q_long_metrics(spark, sf):
    return P.psi_metrics(spark, sf)


# ---------------------------------------------------------------------------
# The same operators through their at-scale plans (same oracles)
# ---------------------------------------------------------------------------

INCREMENTAL_SPLIT_DAYS = 15


@report("aggregated_metrics_from_partials", REPORTS["aggregated_metrics"][1])
def q_aggregated_metrics_from_partials(spark, sf):
    """A1 combined from mergeable per-(day, state) partials."""
    p = M.daily_partials(P.summaries(spark, sf))
    return rounded(M.aggregated_metrics_from_partials(p),
                   *[f"avg_{c}" for c in M.MEAN_COLS], "std_mobile_performance",
                   "std_desktop_performance")


@report("metrics_by_state_from_partials", REPORTS["metrics_by_state"][1])
def q_metrics_by_state_from_partials(spark, sf):
    """A3 combined from mergeable per-(day, state) partials."""
    p = M.daily_partials(P.summaries(spark, sf))
    return rounded(M.metrics_by_state_from_partials(p), "avg_performance", "avg_accessibility")


@report("site_ranking_incremental", REPORTS["site_ranking"][1])
def q_site_ranking_incremental(spark, sf):
    """W3 from a latest-per-site result maintained in two steps (older history,
    then the newest days) instead of one pass over all history."""
    s = P.summaries(spark, sf)
    split = X.minus_days(P.as_of(spark, sf), INCREMENTAL_SPLIT_DAYS)
    latest = R.update_latest(R.latest_per_site(s.filter(F.col("timestamp") < split)),
                             s.filter(F.col("timestamp") >= split))
    return R.site_ranking_from_latest(latest)
