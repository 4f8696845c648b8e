"""Filters, predicates and skip lists.

Simple predicates are written as Column expressions so Catalyst can push them
into the Parquet scan; set differences are anti joins whose strategy
(broadcast or shuffle) AQE picks from the measured size of the skip side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as X


def not_error(col: str = "has_errors") -> Column:
    """``NOT has_errors``; a NULL flag is excluded (three-valued logic)."""
    return ~F.col(col)


def within_days(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Partition pruning: when the table is partitioned by ``day``, keep only
    the days that can hold rows between ``lo`` and ``hi`` (literals fold, so
    the scan lists only those folders).  The exact time filter still applies.
    A table stored without day folders reads ``day`` as NULL and keeps all rows."""
    if "day" not in df.columns:
        return df
    d = F.col("day")
    return df.filter(d.isNull() | ((d >= F.to_date(lo)) & (d <= F.to_date(hi))))


def recently_audited_urls(audits: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """F1 + X14: distinct urls audited without error in the last ``hours``.

    Strictly after ``as_of - hours``; failed audits are not skipped (retried).
    """
    t = X.as_time(as_of)
    return (within_days(audits, X.minus_hours(t, hours), t)
            .filter((F.col("timestamp") > X.minus_hours(t, hours))
                          & (F.col("timestamp") <= t)
                          & F.col("error_message").isNull())
            .select("url").distinct())


def quarantine_skip_urls(current: DataFrame) -> DataFrame:
    """urls whose current status asks the collector to skip them."""
    return current.filter(F.col("status").isin(*schemas.SKIP_STATUSES)).select("url")


def exclude_urls(sites: DataFrame, skip: DataFrame, normalize: bool = True) -> DataFrame:
    """sites not in the skip set (anti join, order and duplicates kept).

    With ``normalize`` both sides compare on X4 (trailing slash), so a root url
    written without '/' is still skipped.
    """
    key = "__skip_key"
    k = X.normalize_url("url") if normalize else F.col("url")
    s = skip.select((X.normalize_url("url") if normalize else F.col("url")).alias(key)).distinct()
    return sites.withColumn(key, k).join(s, on=key, how="left_anti").drop(key)


def skip_list(audits: DataFrame, as_of, hours: float = 24,
              current_quarantine: DataFrame | None = None) -> DataFrame:
    """F1 (off when ``hours <= 0``) united with F3 when a quarantine is given."""
    parts = []
    if hours > 0:
        parts.append(recently_audited_urls(audits, as_of, hours))
    if current_quarantine is not None:
        parts.append(quarantine_skip_urls(current_quarantine))
    if not parts:
        return schemas.empty_frame(audits.sparkSession, T.StructType([T.StructField("url", T.StringType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def urls_to_audit(sites: DataFrame, audits: DataFrame, as_of, hours: float = 24,
                  current_quarantine: DataFrame | None = None) -> DataFrame:
    """F2 + J2: the site list minus everything the skip list names."""
    return exclude_urls(sites, skip_list(audits, as_of, hours, current_quarantine))


def url_like(pattern: str, ignore_case: bool = False) -> Column:
    """Whether url is LIKE '%p%': ``%`` and ``_`` in the pattern are wildcards, a backslash is an ordinary
    character.  Without wildcards the optimizer turns LIKE into a plain search."""
    like = "%" + pattern.replace("\\", "\\\\") + "%"
    return F.col("url").ilike(like) if ignore_case else F.col("url").like(like)


def find_url(metrics: DataFrame, pattern: str, ignore_case: bool = False) -> DataFrame:
    """rows whose url is LIKE '%p%' (:func:`url_like`), newest first."""
    return metrics.filter(url_like(pattern, ignore_case)).orderBy(F.desc_nulls_last("timestamp"))


def search_sites(ranking: DataFrame, term: str | None = None, state: str | None = None,
                 population: str | None = None) -> DataFrame:
    """state and population equality, then a trimmed lower-case substring
    over name, state or url.  Empty arguments do not filter."""
    out = ranking
    if state:
        out = out.filter(F.col("state") == state)
    if population:
        if "population" not in ranking.columns:
            return out.limit(0)
        out = out.filter(F.col("population") == population)
    t = (term or "").strip().lower()
    if t:
        lit = F.lit(t)
        out = out.filter(F.contains(F.lower("name"), lit) | F.contains(F.lower("state"), lit)
                         | F.coalesce(F.contains(F.lower("url"), lit), F.lit(False)))
    return out


def filter_metrics(metrics: DataFrame, q: str) -> DataFrame:
    """lower-case url substring OR ibge_code substring (missing code = '')."""
    q = (q or "").lower()
    lit = F.lit(q)
    return metrics.filter(F.contains(F.lower("url"), lit)
                          | F.contains(F.coalesce(F.col("ibge_code"), F.lit("")), lit))


def list_quarantined(current: DataFrame, status: str | None = None,
                     min_failures: int = 0) -> DataFrame:
    """current quarantine rows except removed ones, most failures first."""
    q = current.filter((F.col("consecutive_failures") >= min_failures)
                       & (F.col("status") != schemas.REMOVED_STATUS))
    if status:
        q = q.filter(F.col("status") == status)
    return (q.select("url", "first_failure", "last_failure", "consecutive_failures",
                     F.col("last_error_message").alias("last_error"), "status", "notes",
                     "created_at")
            .orderBy(F.desc_nulls_last("consecutive_failures"), F.desc_nulls_last("last_failure"),
                     F.asc("url")))


def temporal_evolution(summaries: DataFrame, url: str) -> DataFrame:
    """F8: successful audits of one url (with or without trailing '/'), oldest first."""
    normalized = url.rstrip("/") + "/"
    return (summaries.filter(F.col("url").isin(url, normalized) & not_error())
            .select("timestamp", "mobile_performance", "desktop_performance",
                    "mobile_accessibility", "desktop_accessibility")
            .orderBy(F.asc_nulls_last("timestamp")))
