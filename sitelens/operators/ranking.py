"""Latest-per-site, ranking, top-k and sorting.

Top-k reports end in ``orderBy(...).limit(n)``, which Spark plans as
``TakeOrderedAndProject``: every task keeps its own n best rows and only
those reach the final merge.  Every ordered limit has a total order (url, id
as last keys) so equal scores give the same rows on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as X
from .filters import not_error
from .sequence import number_rows

# Names of the summary columns behind the ranking, and of the sortable ones.
RANKING_SOURCE_COLUMNS = ["url", "timestamp", "mobile_accessibility", "mobile_performance",
                          "mobile_seo", "mobile_best_practices", "desktop_accessibility",
                          "desktop_performance", "mobile_fcp", "mobile_lcp", "mobile_cls"]
SORTABLE_METRIC_COLUMNS = ["url", "performance", "accessibility", "seo", "bestPractices",
                           "timestamp"]


def latest_per_site(summaries: DataFrame) -> DataFrame:
    """Newest successful audit of every url (filter first, then window).

    ``row_number() = 1`` is planned with WindowGroupLimit: each task keeps one
    row per url before the shuffle, so a url with many audits costs one row
    per task in the exchange.
    """
    w = Window.partitionBy("url").orderBy(F.desc("timestamp"), F.desc("id"))
    return (summaries.filter(not_error())
            .withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def update_latest(previous_latest: DataFrame, new_summaries: DataFrame) -> DataFrame:
    """W1 maintained incrementally: the newest successful audit per url of
    (previous result ∪ new audits).

    "Newest by (timestamp, id)" is an associative max, so this equals W1 over
    the whole history while reading only the previous result (one row per
    site) and the new day.  Daily ranking and dashboard cost then grows with
    the number of sites, not with years of history.
    """
    return latest_per_site(previous_latest.unionByName(
        new_summaries.select(*previous_latest.columns)))


def latest_per_site_strategy(metrics: DataFrame, strategy: str | None = None) -> DataFrame:
    """Newest row per (url, strategy); the strategy filter comes first."""
    m = metrics
    if strategy and strategy != "all":
        m = m.filter(F.lower("strategy") == F.lower(F.lit(strategy)))
    w = Window.partitionBy("url", "strategy").orderBy(
        F.desc("timestamp"), *[F.desc_nulls_last(c) for c in schemas.LONG_METRIC_NAMES])
    return m.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def ranking_rows(latest: DataFrame) -> DataFrame:
    """Display columns of the ranking (X2, X3, X7) for W1 rows, without rank."""
    return latest.select(
        "url", X.site_name("url").alias("name"), X.state_label("url").alias("state"),
        "timestamp",
        X.score_percent("mobile_accessibility").alias("score"),
        X.score_percent("mobile_performance").alias("performance"),
        X.score_percent("mobile_seo").alias("seo"),
        X.score_percent("mobile_best_practices").alias("best_practices"),
        X.score_percent("desktop_accessibility", null_as_zero=False).alias("desktop_accessibility"),
        X.score_percent("desktop_performance", null_as_zero=False).alias("desktop_performance"),
        F.col("mobile_fcp").alias("fcp"), F.col("mobile_lcp").alias("lcp"),
        F.col("mobile_cls").alias("cls"),
        F.col("mobile_accessibility").alias("__order_score"))


def rank_order() -> list:
    """Ranking order: best mobile accessibility first, url breaks ties."""
    return [F.desc_nulls_last("__order_score"), F.asc("url")]


def site_ranking(summaries: DataFrame) -> DataFrame:
    """Latest successful audit per site, best mobile accessibility first.

    ``rank`` is the 1-based position (no shared ranks); equal scores are
    ordered by url.  Numbered by :func:`number_rows`, so no single task holds
    the whole ranking.
    """
    latest = latest_per_site(summaries.select("id", "has_errors", *RANKING_SOURCE_COLUMNS))
    return site_ranking_from_latest(latest)


def site_ranking_from_latest(latest: DataFrame) -> DataFrame:
    """W3 over an already computed W1 result (e.g. the maintained latest table)."""
    return number_rows(ranking_rows(latest), rank_order(), col="rank").drop("__order_score")


def ranked_states(summaries: DataFrame) -> DataFrame:
    """The state of every ranked site (repeated): a site is ranked if one of its audits succeeded."""
    return summaries.filter(not_error()).select(X.state_label("url").alias("state"))


def top_sites(ranking: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` of the ranking."""
    return ranking.orderBy("rank").limit(n)


def top_sites_from_latest(latest: DataFrame, n: int = 50) -> DataFrame:
    """L5 out of W1 rows: only the ``n`` best are taken and numbered (one array of ``n`` rows)."""
    best = ranking_rows(latest).orderBy(*rank_order()).limit(n)
    score, cols = F.col("__order_score"), [c for c in best.columns if c != "__order_score"]
    row = F.struct(score.isNull().alias("__none"), (-score).alias("__low"), F.col("url").alias("__url"),
                   F.struct(*cols).alias("site"))
    ordered = best.agg(F.sort_array(F.collect_list(row)).alias("sites"))
    return (ordered.select(F.posexplode("sites").alias("pos", "of"))
            .select("of.site.*", (F.col("pos") + 1).cast("long").alias("rank")))


def bottom_sites(ranking: DataFrame, n: int = 50) -> DataFrame:
    """Lowest rounded score first, ties kept in ranking order."""
    return ranking.orderBy(F.asc("score"), F.asc("rank")).limit(n)


def bottom_sites_from_latest(latest: DataFrame, n: int = 50) -> DataFrame:
    """L6 out of W1 rows, without ranking every site.

    The ``n`` lowest are taken by a top-k.  Their places among all sites cut the ranking
    order into ``n + 1`` parts; one aggregate counts the sites of each part, and a
    site's rank is one more than the counts of the parts before its own.  The ``n`` keys
    (a bound given by the caller) are read on the driver and become literals.
    """
    rows = ranking_rows(latest)
    # equal scores in ranking order
    lowest = rows.orderBy(F.asc("score"), *rank_order()).limit(n)
    keys = [(r["__order_score"], r["url"]) for r in lowest.select("__order_score", "url").collect()]
    keys.sort(key=lambda k: (k[0] is None, -(k[0] or 0.0), k[1]))
    if not keys:
        return rows.drop("__order_score").withColumn("rank", F.lit(None).cast("long"))
    # (no score, score with its sign turned, url) sorts as the ranking does
    own = F.struct(F.col("__order_score").isNull().alias("none"), F.coalesce(-F.col("__order_score"), F.lit(0.0)).alias("low"), F.col("url").alias("url"))
    cuts = F.array(*[F.struct(F.lit(s is None).alias("none"), F.lit(0.0 if s is None else -float(s)).alias("low"), F.lit(u).alias("url"))
                     for s, u in keys])
    part = F.size(F.filter(cuts, lambda c: c < own))
    counts = {r["part"]: r["n"] for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    ranks, before = [], 0
    for k in range(len(keys)):
        before += counts.get(k, 0)
        ranks.append(before)         # the site itself is the last of its part
    place = F.array_position(F.transform(cuts, lambda c: c["url"]), F.col("url"))
    rank = F.element_at(F.array(*[F.lit(r) for r in ranks]), place.cast("int")).cast("long")
    # taken again: after a late change of the input the keys would not fit
    chosen = rows.filter(F.col("url").isin([u for _, u in keys]))
    return chosen.withColumn("rank", rank).orderBy(F.asc("score"), F.asc("rank")).drop("__order_score")


def score_badges(ranking: DataFrame) -> DataFrame:
    """X10 on the ranking: class and text of every site's 0..100 score."""
    return ranking.select("url", "rank", "score", X.badge_class("score").alias("badge"),
                          X.badge_text("score").alias("badge_text"))


def worst_performing(summaries: DataFrame, limit: int = 10) -> DataFrame:
    """L1: audits (a site may repeat) with the lowest mobile performance."""
    return (summaries.filter(not_error() & F.col("mobile_performance").isNotNull())
            .orderBy(F.asc("mobile_performance"), F.asc("url"), F.asc("id"))
            .limit(limit)
            .select("url", "mobile_performance", "desktop_performance",
                    "mobile_accessibility", "timestamp"))


def best_accessibility(summaries: DataFrame, limit: int = 10) -> DataFrame:
    """L2: audits with the highest mobile accessibility."""
    return (summaries.filter(not_error() & F.col("mobile_accessibility").isNotNull())
            .orderBy(F.desc("mobile_accessibility"), F.asc("url"), F.asc("id"))
            .limit(limit)
            .select("url", "mobile_accessibility", "desktop_accessibility",
                    "mobile_performance", "timestamp"))


def newest_days(df: DataFrame, day_counts: DataFrame | None, n: int) -> DataFrame:
    """Keep only the newest days that together hold at least ``n`` rows.

    ``day_counts(day, n)`` (e.g. from the per-day partials) is one row per day,
    so the cut-off is found on a table bounded by the number of days and read
    as one scalar; the ``day`` filter then prunes partition folders.  Exact:
    the ``n`` newest rows all lie on or after that day.  Without counts or a
    ``day`` column the input is returned as is.
    """
    if day_counts is None or "day" not in df.columns:
        return df
    upto = Window.orderBy(F.desc("day")).rowsBetween(Window.unboundedPreceding, 0)
    per_day = day_counts.groupBy("day").agg(F.sum("n").alias("n"))
    cut = (per_day.withColumn("cum", F.sum("n").over(upto))
           .filter(F.col("cum") >= n).agg(F.max("day")).first()[0])
    return df if cut is None else df.filter(F.col("day") >= F.lit(cut))


def recent_audits(audits: DataFrame, n: int = 10, day_counts: DataFrame | None = None) -> DataFrame:
    """L3 + X11: newest audits with a status mark."""
    return (newest_days(audits, day_counts, n)
            .orderBy(F.desc("timestamp"), F.desc("id")).limit(n)
            .select("url", "timestamp", X.status_mark("error_message").alias("status")))


def latest_audits(summaries: DataFrame, n: int = 1000,
                  day_counts: DataFrame | None = None) -> DataFrame:
    """L4: newest ``n`` summary rows, errors included, not per site (with
    ``day_counts`` only the newest days are scanned, see :func:`newest_days`)."""
    return (newest_days(summaries, day_counts, n)
            .orderBy(F.desc("timestamp"), F.desc("id")).limit(n)
            .select("url", "timestamp", "mobile_performance", "desktop_performance",
                    "mobile_accessibility", "desktop_accessibility", "has_errors",
                    "error_message"))


def list_worst(metrics: DataFrame, metric: str, n: int, strategy: str = "all") -> DataFrame:
    """Latest row per (url, strategy), lowest ``metric`` first, ``n`` rows."""
    if metric not in schemas.LONG_METRIC_NAMES:
        raise ValueError(f"metric must be one of {schemas.LONG_METRIC_NAMES}")
    if not isinstance(n, int) or n <= 0:
        raise ValueError("n must be a positive integer")
    latest = latest_per_site_strategy(metrics, strategy)
    return (latest.filter(F.col(metric).isNotNull())
            .orderBy(F.asc(metric), F.asc("url"), F.asc("strategy"))
            .limit(n)
            .select("url", "strategy", "timestamp", metric))


def sort_metrics(metrics: DataFrame, column: str, ascending: bool = True) -> DataFrame:
    """Sort by one of six columns in either direction (NULLs last)."""
    if column not in SORTABLE_METRIC_COLUMNS:
        raise ValueError(f"column must be one of {SORTABLE_METRIC_COLUMNS}")
    first = F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)
    return metrics.orderBy(first, F.asc("url"), F.asc("timestamp"), F.asc("strategy"))
