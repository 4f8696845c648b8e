"""The daily batch run as one Spark job composition.

Site list -> skip list (recent successes, optionally quarantined sites) ->
the stored responses of the sites still to audit -> append audits and
summaries -> exports.  Every step is a DataFrame plan; the only values on the
driver are the batch counts.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as X
from ..operators import filters as FL
from ..operators import metrics as M
from ..operators.assemble import assemble_with_summaries
from ..operators import quarantine as Q
from ..operators import ranking as R
from ..operators.quarantine import next_id, quarantine_current
from ..operators.ranking import latest_per_site, update_latest
from ..operators.sequence import number_in_place
from ..session import child_names, path_exists, read_text, run_concurrently, work_root, write_once
from ..sinks import writers as W
from ..sources import files as S
from ..sources.ledger import committed_loads, load_days, new_load
from ..sources.tables import read_table
from ..sources.versions import change_quarantine, publish


def run_batch(spark: SparkSession, base: str, sites_csv: str, responses: DataFrame, as_of,
              url_column: str = "url", skip_recent_hours: float = 24,
              skip_quarantined: bool = True, out_dir: str | None = None) -> DataFrame:
    """Run one batch; returns ``processed`` and ``errors`` of the appended audits.

    ``responses`` are the stored responses of this run (S2); only those of
    sites on the list and not skipped are appended.  With ``out_dir`` the
    audit Parquet per day (K1), the summaries (K2) and the latest-audits
    document (K3) are written there.
    """
    sites = S.read_site_list(spark, sites_csv, url_column)
    audits = read_table(spark, base, "audits")
    current = quarantine_current(read_table(spark, base, "quarantine")) if skip_quarantined else None
    todo = FL.urls_to_audit(sites, audits, as_of, skip_recent_hours, current)
    key = "__url_key"
    wanted = todo.select(X.normalize_url("url").alias(key)).distinct()
    batch = (responses.withColumn(key, X.normalize_url("url"))
             .join(wanted, on=key, how="left_semi").drop(key))
    # staged once with new ids (W5); the skip list reads the table this run appends to
    staged = number_in_place(assemble_with_summaries(batch).drop("id"), "id",
                             next_id(read_table(spark, base, "audit_summaries")))
    W.write_assembled(staged, base, new_load())
    maintained_tables(spark, base)
    if out_dir:
        summaries = read_table(spark, base, "audit_summaries")  # with its day folders
        W.export_audits_parquet(read_table(spark, base, "audits"), f"{out_dir}/audits", incremental=True)
        W.export_summaries_parquet(summaries, f"{out_dir}/audit_summaries", incremental=True)
        counts = load_days(spark, base).select("day", "n")
        W.export_latest_json(summaries, f"{out_dir}/latest_audits", as_of, day_counts=counts)
    return M.batch_counts(staged, F.lit("batch").alias("run"))


MAINTAINED = "maintained"
_COVERED = "covered.json"


def _version(spark: SparkSession, base: str) -> str | None:
    """The newest version that was written to its end (``covered.json`` is its last file)."""
    root = f"{base}/{MAINTAINED}"
    for name in reversed(child_names(spark, root)):
        if path_exists(spark, f"{root}/{name}/{_COVERED}"):
            return name
    return None


class Maintained(NamedTuple):
    """Latest audit per site (W1), partials per day and state (A1, A3, A7), first and last audit per site."""

    latest: DataFrame
    partials: DataFrame
    trends: DataFrame


def maintained_tables(spark: SparkSession, base: str) -> Maintained:
    """The maintained tables, complete.

    A version records the names of the loads it covers.  Committed loads never
    change, so only the loads that came since, whoever appended them, are read
    and merged into the version before; the result is written as a new version.
    A version that a crash cut short is never read, and the next call starts from the
    one before.  Tables without a ledger are computed whole and not stored.
    """
    loads = committed_loads(spark, base)
    columns = schemas.AUDIT_SUMMARIES.fieldNames()
    if loads is None:
        rows = read_table(spark, base, "audit_summaries").select(*columns)
        return Maintained(latest_per_site(rows), M.daily_partials(rows), M.trend_state(rows))
    root, name = f"{base}/{MAINTAINED}", _version(spark, base)
    none = schemas.empty_frame(spark, schemas.AUDIT_SUMMARIES)
    kinds = Maintained(none.schema, M.daily_partials(none).schema, M.trend_state(none).schema)

    def version_tables(version: str) -> Maintained:
        return Maintained(*[spark.read.schema(sch).parquet(f"{root}/{version}/{kind}")
                            for kind, sch in zip(Maintained._fields, kinds)])

    if name is None:
        covered, before = set(), Maintained(*[schemas.empty_frame(spark, sch) for sch in kinds])
    else:
        covered, before = set(json.loads(read_text(spark, f"{root}/{name}/{_COVERED}"))), version_tables(name)
    new = sorted(set(loads) - covered)
    if not new and name is not None:
        return before
    fresh = read_table(spark, base, "audit_summaries", new).select(*columns)
    # names sort by time, so the newest complete version is the last one
    version = f"v-{int(name.split('-')[1]) + 1 if name else 1:012d}-{uuid.uuid4().hex[:8]}"
    after = Maintained(update_latest(before.latest, fresh),
                       M.merge_partials(before.partials.unionByName(M.daily_partials(fresh))),
                       M.merge_trends(before.trends.unionByName(M.trend_state(fresh))))
    run_concurrently([lambda kind=kind, rows=rows: rows.write.parquet(f"{root}/{version}/{kind}")
                      for kind, rows in zip(Maintained._fields, after)])
    write_once(spark, f"{root}/{version}/{_COVERED}", json.dumps(sorted(covered | set(new))))
    return version_tables(version)


def read_partials(spark: SparkSession, base: str) -> DataFrame:
    return maintained_tables(spark, base).partials


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """The maintained latest-per-site table."""
    return maintained_tables(spark, base).latest


def run_quarantine_update(spark: SparkSession, base: str, as_of, min_days: int = 3) -> DataFrame:
    """The quarantine update command: U2 over the stored tables, committed as the next
    version of the quarantine; returns added, updated and total_checked."""
    audits = read_table(spark, base, "audits")
    work_root(spark)

    def change(table: DataFrame):
        # counts and rows come from the same change set
        changes = Q.quarantine_changes(audits, table, as_of, min_days).checkpoint(eager=True)
        return Q.rows_of_changes(changes, table, as_of), Q.update_stats(changes)

    return change_quarantine(spark, base, change)


def run_set_status(spark: SparkSession, base: str, changes: DataFrame, as_of) -> DataFrame:
    """The set-status command: U3 over the stored quarantine; ``changes`` are (url, status[, notes]).

    Returns every requested url with ``found``: an unknown url is reported and changes nothing.
    A status outside the domain raises ``ValueError`` before anything is written.
    """
    return _change_urls(spark, base, changes, lambda table: Q.set_quarantine_status(table, changes, as_of))


def run_remove(spark: SparkSession, base: str, urls: DataFrame, as_of) -> DataFrame:
    """The remove command: U4 over the stored quarantine; returns every requested url with ``found``."""
    return _change_urls(spark, base, urls, lambda table: Q.remove_from_quarantine(table, urls, as_of))


def _change_urls(spark: SparkSession, base: str, asked: DataFrame, rows_of) -> DataFrame:
    work_root(spark)

    def change(table: DataFrame):
        rows = rows_of(table).checkpoint(eager=True)
        done = rows.select("url", F.lit(True).alias("found"))
        return rows, (asked.select("url").distinct().join(done, "url", "left")
                      .select("url", F.coalesce("found", F.lit(False)).alias("found")))

    return change_quarantine(spark, base, change)


def run_metrics(spark: SparkSession, base: str, by_state: bool = False, worst: int = 0, best: int = 0,
                out_dir: str | None = None, generated_at=None) -> DataFrame:
    """The metrics command over the stored tables: per state (A3), the ``worst`` audits (L1), the
    ``best`` ones (L2), or, without a choice, all history (A1; with ``out_dir`` exported as K4, too).

    A1 and A3 come from the maintained partials: one row per day and state is read.
    """
    columns = schemas.AUDIT_SUMMARIES.fieldNames()
    if by_state:
        return M.metrics_by_state_from_partials(read_partials(spark, base))
    if worst > 0:
        return R.worst_performing(read_table(spark, base, "audit_summaries").select(*columns), worst)
    if best > 0:
        return R.best_accessibility(read_table(spark, base, "audit_summaries").select(*columns), best)
    metrics = M.aggregated_metrics_from_partials(read_partials(spark, base))
    if out_dir:
        W.write_metrics_json(metrics, out_dir, generated_at)
    return metrics


def run_stats(spark: SparkSession, base: str, n: int = 10) -> dict[str, DataFrame]:
    """The stats command over the stored tables: ``stats`` (A4) from the maintained partials, and
    ``recent`` (L3), for which only the newest days are read."""
    total = read_partials(spark, base).agg(F.sum("n_all").alias("total"), F.sum("n_err").alias("errors"))
    counts = None if committed_loads(spark, base) is None else load_days(spark, base).select("day", "n")
    return {"stats": M.audit_stats_from_counts(total),
            "recent": R.recent_audits(read_table(spark, base, "audits"), n, counts)}


def run_dashboard_export(spark: SparkSession, base: str, out_dir: str, generated_at) -> dict:
    """The dashboard export command (K7) over the stored tables; the ranking,
    summary and per-state lists come from the maintained latest-per-site and
    per-day partial tables, which are brought up to date first.  The export is a new version below
    ``out_dir``, switched to when all its files are there (``versions.published_folder``)."""
    summaries = read_table(spark, base, "audit_summaries").select(
        *schemas.AUDIT_SUMMARIES.fieldNames())
    tables = maintained_tables(spark, base)
    quarantine = read_table(spark, base, "quarantine")
    return publish(spark, out_dir, lambda folder: W.export_dashboard(
        summaries, quarantine, folder, generated_at, latest=tables.latest, partials=tables.partials))
