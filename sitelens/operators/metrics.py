"""Aggregate reports.

Every aggregate here has a partial (map-side) form in Spark's HashAggregate,
so a hot group — one state or one url holding a third of all rows — is
pre-aggregated in every task and reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as X
from .filters import not_error, within_days


def _rate(part, total) -> F.Column:
    # ANSI mode raises on x/0: guard the empty table
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def aggregated_metrics(summaries: DataFrame) -> DataFrame:
    """A1 + A2: one row over all audits (no error filter, not per site)."""
    means = [("avg_mobile_performance", "mobile_performance"),
             ("avg_desktop_performance", "desktop_performance"),
             ("avg_mobile_accessibility", "mobile_accessibility"),
             ("avg_desktop_accessibility", "desktop_accessibility"),
             ("avg_mobile_seo", "mobile_seo"), ("avg_desktop_seo", "desktop_seo"),
             ("avg_mobile_best_practices", "mobile_best_practices"),
             ("avg_desktop_best_practices", "desktop_best_practices")]
    agg = summaries.agg(
        F.count(F.lit(1)).alias("total_audits"),
        F.count_if(~F.col("has_errors")).alias("successful_audits"),
        F.count_if(F.col("has_errors")).alias("failed_audits"),
        *[F.avg(c).alias(a) for a, c in means],
        F.stddev_samp("mobile_performance").alias("std_mobile_performance"),
        F.stddev_samp("desktop_performance").alias("std_desktop_performance"),
        F.min("mobile_performance").alias("min_mobile_performance"),
        F.max("mobile_performance").alias("max_mobile_performance"),
    )
    t = F.col("total_audits")
    return agg.select(
        "total_audits", "successful_audits", "failed_audits",
        _rate(F.col("successful_audits"), t).alias("success_rate"),
        _rate(F.col("failed_audits"), t).alias("error_rate"),
        *[a for a, _ in means],
        "std_mobile_performance", "std_desktop_performance",
        "min_mobile_performance", "max_mobile_performance")


def metrics_by_state(summaries: DataFrame) -> DataFrame:
    """A3: successful audits with a state; ``site_count`` counts audits."""
    return (summaries.filter(not_error())
            .select(X.state_from_url("url").alias("state"),
                    "mobile_performance", "mobile_accessibility")
            .filter(F.col("state") != "")
            .groupBy("state")
            .agg(F.count(F.lit(1)).alias("site_count"),
                 F.avg("mobile_performance").alias("avg_performance"),
                 F.avg("mobile_accessibility").alias("avg_accessibility"))
            .orderBy(F.desc_nulls_last("avg_performance"), F.asc("state")))


def audit_stats(audits: DataFrame) -> DataFrame:
    """A4: total, errors and success percentage (one decimal)."""
    return audit_stats_from_counts(audits.agg(F.count(F.lit(1)).alias("total"),
                                              F.count("error_message").alias("errors")))


def audit_stats_from_counts(counts: DataFrame) -> DataFrame:
    """A4 from one row of ``total`` and ``errors`` (NULL: none)."""
    t, e = (F.coalesce(c, F.lit(0)).cast("long") for c in ("total", "errors"))
    return counts.select(t.alias("total_audits"), e.alias("total_errors"),
                         F.when(t > 0, F.round((t - e) / t * 100, 1)).otherwise(F.lit(0.0))
                         .alias("success_pct"))


def failing_urls(audits: DataFrame, as_of, min_failures: int = 3) -> DataFrame:
    """A5 + A14: failures per url in the last ``2*min_failures`` days.

    Counts failed audits in the window (a success in between does not reset
    the count).  ``last_error`` is the text of the newest failure.
    """
    lookback_days = int(min_failures * 2)
    t = X.as_time(as_of)
    f = within_days(audits, X.minus_days(t, lookback_days), t).filter(
        F.col("error_message").isNotNull()
                      & (F.col("timestamp") >= X.minus_days(t, lookback_days))
                      & (F.col("timestamp") <= t))
    return (f.groupBy("url")
            .agg(F.min("timestamp").alias("first_failure"),
                 F.max("timestamp").alias("last_failure"),
                 F.count(F.lit(1)).alias("failure_count"),
                 F.max_by("error_message", F.struct("timestamp", "id")).alias("last_error"))
            .filter(F.col("failure_count") >= int(min_failures)))


def quarantine_stats(current: DataFrame) -> DataFrame:
    """Counts per status, mean (one decimal) and max failures; zeros if empty."""
    active = current.filter(F.col("status") != schemas.REMOVED_STATUS)
    s = F.col("status")
    return active.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(s == st).alias(st) for st in schemas.QUARANTINE_STATUSES],
        F.coalesce(F.round(F.avg("consecutive_failures"), 1), F.lit(0.0)).alias("avg_failures"),
        F.coalesce(F.max("consecutive_failures"), F.lit(0).cast("long")).alias("max_failures"))


def metrics_overview(metrics: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Record count, newest timestamp, distinct urls.

    Exact by default (two-level distinct aggregation).  ``approximate`` uses a
    HyperLogLog++ sketch (``rsd`` relative error) whose partial state is a few
    KB per task, for dashboards over very large histories.
    """
    distinct = (F.approx_count_distinct("url", rsd) if approximate
                else F.countDistinct("url"))
    return metrics.agg(F.count(F.lit(1)).alias("total_records"),
                       F.max("timestamp").alias("latest_timestamp"),
                       distinct.alias("unique_urls"))


def _score_means():
    return [F.round(F.avg("performance"), 3).alias("avg_performance"),
            F.round(F.avg("accessibility"), 3).alias("avg_accessibility"),
            F.round(F.avg("seo"), 3).alias("avg_seo"),
            F.round(F.avg("bestPractices"), 3).alias("avg_best_practices"),
            F.count(F.lit(1)).alias("record_count")]


def avg_scores(metrics: DataFrame, strategy: str = "all") -> DataFrame:
    """Mean scores (3 decimals) over all rows or per matching strategy."""
    if strategy == "all":
        return metrics.agg(*_score_means()).select(
            F.lit("all").alias("strategy_summary"), "*")
    return (metrics.filter(F.lower("strategy") == F.lower(F.lit(strategy)))
            .groupBy("strategy").agg(*_score_means()))


def score_distribution(metrics: DataFrame, names=None) -> DataFrame:
    """A10 + X9: rows per (metric, band); NULL scores are skipped."""
    names = names or schemas.LONG_METRIC_NAMES
    # one row per task reaches the shuffle: a count for every (metric, band)
    keys = [(n, b) for n in names for b in X.SCORE_BANDS]
    counts = metrics.agg(*[F.count_if(X.score_band(F.col(n).cast("double")) == b).alias(f"{n}/{b}")
                           for n, b in keys])
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.lit(b).alias("band"),
                              F.col(f"`{n}/{b}`").alias("n")) for n, b in keys])
    return counts.select(F.inline(rows)).filter(F.col("n") > 0)


def duplicate_keys(metrics: DataFrame, keys=("url", "timestamp", "strategy")) -> DataFrame:
    """Key groups that occur more than once."""
    return (metrics.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def available_states(ranking: DataFrame) -> DataFrame:
    """Distinct states without NULL, '' and 'N/A', ascending.

    Only ``state`` is read, so any rows of the ranked sites will do
    (``ranking.ranked_states`` needs no ranking).
    """
    return (ranking.select("state")
            .filter(F.col("state").isNotNull() & ~F.col("state").isin("", X.NO_STATE))
            .distinct().orderBy("state"))


def trend_state(summaries: DataFrame) -> DataFrame:
    """One mergeable row per url: its first and last (timestamp, id, mobile performance) and their number."""
    ok = summaries.filter(not_error() & F.col("mobile_performance").isNotNull())
    at = F.struct("timestamp", "id", "mobile_performance")
    # a row without time is neither first nor last while there is one with time
    timed = F.when(F.col("timestamp").isNotNull(), at)
    return ok.groupBy("url").agg(F.coalesce(F.min(timed), F.min(at)).alias("first"),
                                 F.coalesce(F.max(timed), F.max(at)).alias("last"),
                                 F.count(F.lit(1)).alias("n_audits"))


def merge_trends(states: DataFrame) -> DataFrame:
    """Rows of :func:`trend_state` from several loads as one row per url."""
    timed = {c: F.when(F.col(f"{c}.timestamp").isNotNull(), F.col(c)) for c in ("first", "last")}
    return states.groupBy("url").agg(F.coalesce(F.min(timed["first"]), F.min("first")).alias("first"),
                                     F.coalesce(F.max(timed["last"]), F.max("last")).alias("last"),
                                     F.sum("n_audits").alias("n_audits"))


def performance_trend(summaries: DataFrame) -> DataFrame:
    """First and last mobile performance of every url; improved if last > first."""
    return performance_trend_from_state(trend_state(summaries))


def performance_trend_from_state(state: DataFrame) -> DataFrame:
    """A13 from :func:`trend_state` rows, one per url."""
    first, last = F.col("first.mobile_performance"), F.col("last.mobile_performance")
    return state.select("url", first.alias("first_performance"), last.alias("last_performance"), "n_audits",
                        (last > first).alias("improved"))


def batch_counts(audits: DataFrame, run_col=None) -> DataFrame:
    """Processed and error totals per run (default: per day of audit)."""
    run = run_col if run_col is not None else X.day("timestamp").alias("run_date")
    return audits.groupBy(run).agg(F.count(F.lit(1)).alias("processed"),
                                   F.count("error_message").alias("errors"))


# ---------------------------------------------------------------------------
# Mergeable per-day partials: A1 and A3 without scanning the whole history
# ---------------------------------------------------------------------------

MEAN_COLS = ["mobile_performance", "desktop_performance", "mobile_accessibility",
              "desktop_accessibility", "mobile_seo", "desktop_seo", "mobile_best_practices",
              "desktop_best_practices"]
STD_COLS = ["mobile_performance", "desktop_performance"]
#: Log2 of the registers of a url sketch: a standard error of 0.8 %, 8 KB per day and state at most.
URL_SKETCH_BITS = 14


def daily_partials(summaries: DataFrame) -> DataFrame:
    """One mergeable row per (day, state): counts, sums, M2 and min/max.

    A1 and A3 over any set of days are exact combinations of these rows
    (sums add; M2 merges with the parallel-variance formula), so a dashboard
    reads one row per day and state instead of every audit.
    """
    ok = ~F.col("has_errors")
    aggs = [F.count(F.lit(1)).alias("n_all"), F.count_if(ok).alias("n_ok"),
            F.count_if(F.col("has_errors")).alias("n_err")]
    for c in MEAN_COLS:
        aggs += [F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"s_{c}")]
    for c in STD_COLS:
        aggs.append((F.var_pop(c) * F.count(c)).alias(f"m2_{c}"))
    aggs += [F.min("mobile_performance").alias("min_mp"), F.max("mobile_performance").alias("max_mp"),
             F.max("timestamp").alias("max_ts"), F.hll_sketch_agg("url", URL_SKETCH_BITS).alias("urls")]
    # A3 inputs: successful audits only
    ok_perf = F.when(ok, F.col("mobile_performance"))
    ok_acc = F.when(ok, F.col("mobile_accessibility"))
    aggs += [F.count(ok_perf).alias("n_ok_perf"), F.sum(ok_perf).alias("s_ok_perf"),
             F.count(ok_acc).alias("n_ok_acc"), F.sum(ok_acc).alias("s_ok_acc")]
    return summaries.groupBy(X.day("timestamp").alias("day"),
                             X.state_from_url("url").alias("state")).agg(*aggs)


def merge_partials(partials: DataFrame) -> DataFrame:
    """Rows of :func:`daily_partials` from several loads as one row per (day, state)."""
    keys = ("day", "state")
    aggs = []
    for c in partials.columns:
        if c.startswith("m2_"):
            s, n = F.col(f"s_{c[3:]}"), F.col(f"n_{c[3:]}")
            between = F.sum(F.pow(s, 2) / n) - F.pow(F.sum(s), 2) / F.sum(n)
            # one row stays as it is
            aggs.append((F.sum(c) + F.when(F.count(c) > 1, F.greatest(between, F.lit(0.0))).otherwise(0.0)).alias(c))
        elif c not in keys:
            f = {"min_mp": F.min, "max_mp": F.max, "max_ts": F.max, "urls": F.hll_union_agg}.get(c, F.sum)
            aggs.append(f(c).alias(c))
    return partials.groupBy(*keys).agg(*aggs).select(*partials.columns)


def aggregated_metrics_from_partials(partials: DataFrame) -> DataFrame:
    """A1 + A2 from :func:`daily_partials` rows (same columns as A1), one aggregate.

    M2 of the union = sum(M2_i) + sum(n_i * (mean_i - mean)^2), and the second
    term is sum(s_i^2 / n_i) - S^2 / N: plain sums, so no second pass or join.
    """
    sums = [F.sum("n_all").alias("total_audits"), F.sum("n_ok").alias("successful_audits"),
            F.sum("n_err").alias("failed_audits")]
    for c in MEAN_COLS:
        sums += [F.sum(f"n_{c}").alias(f"N_{c}"), F.sum(f"s_{c}").alias(f"S_{c}")]
    for c in STD_COLS:
        sums += [F.sum(f"m2_{c}").alias(f"M2a_{c}"),
                 F.sum(F.pow(F.col(f"s_{c}"), 2) / F.col(f"n_{c}")).alias(f"Q_{c}")]
    sums += [F.min("min_mp").alias("min_mobile_performance"),
             F.max("max_mp").alias("max_mobile_performance")]
    g = partials.agg(*sums)
    t = F.col("total_audits")
    out = [F.coalesce(t, F.lit(0)).cast("long").alias("total_audits"),
           F.coalesce(F.col("successful_audits"), F.lit(0)).cast("long").alias("successful_audits"),
           F.coalesce(F.col("failed_audits"), F.lit(0)).cast("long").alias("failed_audits")]
    out += [F.when(t > 0, F.col("successful_audits") / t).otherwise(F.lit(0.0)).alias("success_rate"),
            F.when(t > 0, F.col("failed_audits") / t).otherwise(F.lit(0.0)).alias("error_rate")]
    out += [(F.col(f"S_{c}") / F.col(f"N_{c}")).alias(f"avg_{c}") for c in MEAN_COLS]
    for c in STD_COLS:
        n, total = F.col(f"N_{c}"), F.col(f"S_{c}")
        m2_total = F.col(f"M2a_{c}") + F.col(f"Q_{c}") - F.pow(total, 2) / n
        out.append(F.when(n > 1, F.sqrt(F.greatest(m2_total, F.lit(0.0)) / (n - 1)))
                   .alias(f"std_{c}"))
    out += ["min_mobile_performance", "max_mobile_performance"]
    return g.select(*out)


def metrics_overview_from_partials(partials: DataFrame) -> DataFrame:
    """A7 of the long layout (two records per audit) from :func:`daily_partials` rows.

    ``unique_urls`` is estimated from the union of the days' sketches (standard error
    0.8 %); the other columns are exact.  No history is read.
    """
    return partials.agg(
        (F.coalesce(F.sum("n_all"), F.lit(0)) * 2).cast("long").alias("total_records"),
        F.max("max_ts").alias("latest_timestamp"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("urls")), F.lit(0)).cast("long").alias("unique_urls"))


def metrics_by_state_from_partials(partials: DataFrame) -> DataFrame:
    """A3 from :func:`daily_partials` rows (same columns and order as A3)."""
    return (partials.filter(F.col("state") != "")
            .groupBy("state")
            .agg(F.sum("n_ok").alias("site_count"),
                 (F.sum("s_ok_perf") / F.sum("n_ok_perf")).alias("avg_performance"),
                 (F.sum("s_ok_acc") / F.sum("n_ok_acc")).alias("avg_accessibility"))
            .filter(F.col("site_count") > 0)
            .orderBy(F.desc_nulls_last("avg_performance"), F.asc("state")))
