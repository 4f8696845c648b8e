"""Index of the urls of the stored audits: trigram -> url, for LIKE '%p%' over all history.

History is far longer than the list of its sites.  The index holds every distinct
url once and every three characters of it (lower case), sorted by trigram, so a
pattern reads the pages of its own trigrams, keeps the urls that have them all,
and compares only these with the pattern.  History is then read for a few
urls, which its Bloom filters and pages sorted by url answer.

The index is a version with the names of the loads it covers
(:mod:`sitelens.sources.versions`).  Loads that came since are read for their urls before use; a version
is written only if one of these is new.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import filters as FL
from ..session import read_text
from .ledger import committed_loads
from .tables import read_table
from .versions import commit_next, entry_path, newest_number

LOG, FOLDER = "url_index_log", "url_index"
GRAM = 3
#: Urls up to which history is asked by value; more are joined.  The rows are the same.
MOST_VALUES = 1_000


def _grams(url) -> F.Column:
    low = F.lower(url)
    starts = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM))))


def _current(spark: SparkSession, base: str) -> tuple[int, dict]:
    number = newest_number(spark, f"{base}/{LOG}")
    return number, json.loads(read_text(spark, entry_path(f"{base}/{LOG}", number))) if number else {"folder": None, "loads": []}


def refresh_url_index(spark: SparkSession, base: str) -> str | None:
    """Bring the index up to the committed loads; returns its folder (None: there are no loads)."""
    base = base.rstrip("/")
    loads = committed_loads(spark, base)
    if not loads:
        return None
    while True:
        number, now = _current(spark, base)
        new = sorted(set(loads) - set(now["loads"]))
        if not new:
            return f"{base}/{FOLDER}/{now['folder']}"
        urls = read_table(spark, base, "audit_summaries", new).select("url").where("url IS NOT NULL").distinct()
        folder = now["folder"]
        if folder is not None:
            known = spark.read.schema("url string").parquet(f"{base}/{FOLDER}/{folder}/urls")
            urls = urls.join(known, "url", "left_anti")
        if folder is None or not urls.isEmpty():
            folder = f"version-{uuid.uuid4().hex[:12]}"
            if now["folder"] is not None:
                urls = urls.unionByName(known)
            path = f"{base}/{FOLDER}/{folder}"
            urls.write.parquet(f"{path}/urls")
            urls = spark.read.schema("url string").parquet(f"{path}/urls")
            # by (gram, url): a trigram that all urls share is split over tasks
            urls.select(F.explode(_grams(F.col("url"))).alias("gram"), "url") \
                .repartitionByRange("gram", "url").sortWithinPartitions("gram", "url") \
                .write.option("parquet.page.row.count.limit", "2000").parquet(f"{path}/grams")
        if commit_next(spark, f"{base}/{LOG}", number, folder, loads=now["loads"] + new):
            return f"{base}/{FOLDER}/{folder}"


def urls_like(spark: SparkSession, base: str, pattern: str, ignore_case: bool = False) -> DataFrame:
    """(url) of the stored audits LIKE '%pattern%' (see :func:`sitelens.operators.filters.find_url`)."""
    folder = refresh_url_index(spark, base)
    if folder is None:
        return read_table(spark, base, "audit_summaries").select("url").limit(0)
    runs = [r.lower() for r in re.split("[%_]", pattern)]
    grams = sorted({r[i:i + GRAM] for r in runs for i in range(len(r) - GRAM + 1)})
    if grams:
        found = spark.read.schema("gram string, url string").parquet(f"{folder}/grams").where(F.col("gram").isin(grams))
        urls = found.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).select("url")
    else:
        urls = spark.read.schema("url string").parquet(f"{folder}/urls")
    return urls.where(FL.url_like(pattern, ignore_case))


def _of_urls(rows: DataFrame, urls: DataFrame) -> DataFrame:
    few = [r["url"] for r in urls.limit(MOST_VALUES + 1).collect()]
    if len(few) <= MOST_VALUES:
        return rows.where(F.col("url").isin(few)) if few else rows.limit(0)
    return rows.join(urls, "url", "left_semi").select(*rows.columns)


def find_url_stored(spark: SparkSession, base: str, pattern: str, ignore_case: bool = False,
                    table: str = "audit_summaries") -> DataFrame:
    """F4 over stored history: its rows whose url is LIKE '%pattern%', newest first."""
    rows = _of_urls(read_table(spark, base, table).drop("day"), urls_like(spark, base, pattern, ignore_case))
    return rows.orderBy(F.desc_nulls_last("timestamp"))


def temporal_evolution_stored(spark: SparkSession, base: str, url: str) -> DataFrame:
    """F8 over stored history: an equality on url, which reaches the files' Bloom filters and pages."""
    return FL.temporal_evolution(read_table(spark, base, "audit_summaries"), url)
