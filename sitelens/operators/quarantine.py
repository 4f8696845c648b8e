"""Versioned quarantine of failing sites.

The table is append-only: every change is a new row with ``version + 1``;
the current state is the highest version per url.  Updates are whole
DataFrames (one join, one append) instead of one lookup per url.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as X
from .metrics import failing_urls
from .sequence import number_rows

QUARANTINE_COLUMNS = schemas.QUARANTINE.fieldNames()


def quarantine_current(quarantine: DataFrame) -> DataFrame:
    """Rows holding the highest version of their url.

    Same tie rule as a join with ``MAX(version) GROUP BY url``: several rows
    with the top version all survive.  ``rank() = 1`` gets WindowGroupLimit,
    which drops lower versions before the shuffle.
    """
    w = Window.partitionBy("url").orderBy(F.desc("version"))
    return quarantine.withColumn("__r", F.rank().over(w)).filter(F.col("__r") == 1).drop("__r")


def current_one(quarantine: DataFrame) -> DataFrame:
    """One current row per url (highest version, then highest id)."""
    w = Window.partitionBy("url").orderBy(F.desc("version"), F.desc("id"))
    return quarantine.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") == 1).drop("__r")


def next_version(quarantine: DataFrame) -> DataFrame:
    """``version + 1`` of every known url."""
    return quarantine.groupBy("url").agg((F.max("version") + 1).alias("next_version"))


def next_id(existing: DataFrame) -> int:
    """``MAX(id) + 1`` of a table (1 when empty): one aggregate over one column."""
    return int(existing.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).cast("long")).first()[0])


def assign_ids(new_rows: DataFrame, existing: DataFrame, order_cols=("url",)) -> DataFrame:
    """Consecutive ids after ``MAX(id)`` of ``existing``, in ``order_cols`` order.

    ``MAX(id) + 1`` is one aggregate read as a single scalar (partial max per
    task), then a plain number for the numbering.
    """
    return number_rows(new_rows, [F.asc(c) for c in order_cols], col="id", start=next_id(existing))


def quarantine_as_of(quarantine: DataFrame, t) -> DataFrame:
    """The current state as it was at time ``t`` (time travel by valid_from)."""
    return quarantine_current(quarantine.filter(F.col("valid_from") <= X.as_time(t)))


def _finish(rows: DataFrame, quarantine: DataFrame, as_of) -> DataFrame:
    t = X.as_time(as_of)
    with_time = rows.withColumn("valid_from", t).withColumn("created_at", t)
    numbered = assign_ids(with_time, quarantine)
    return numbered.select(*[F.col(c).cast(f.dataType).alias(c)
                             for c, f in zip(QUARANTINE_COLUMNS, schemas.QUARANTINE.fields)])


def quarantine_changes(audits: DataFrame, quarantine: DataFrame, as_of,
                       min_days: int = 3) -> DataFrame:
    """Every failing url (A5) next to its current quarantine row, with the
    decision ``change`` in ('added', 'updated', 'unchanged')."""
    fails = failing_urls(audits, as_of, min_days)
    cur = current_one(quarantine).select(
        "url", F.col("version").alias("cur_version"),
        F.col("consecutive_failures").alias("cur_failures"),
        F.col("first_failure").alias("cur_first"), F.col("status").alias("cur_status"))
    j = fails.join(cur, "url", "left")
    change = (F.when(F.col("cur_version").isNull(), F.lit("added"))
              .when(~F.col("cur_failures").eqNullSafe(F.col("failure_count")), F.lit("updated"))
              .otherwise(F.lit("unchanged")))
    return j.withColumn("change", change)


def update_quarantine(audits: DataFrame, quarantine: DataFrame, as_of,
                      min_days: int = 3) -> DataFrame:
    """Rows to append after one quarantine update at ``as_of``.

    New url: version 1, status 'quarantined'.  Known url with a different
    failure count: version + 1 keeping the original first_failure and the
    current status, notes reset to NULL.  Same count: no row.  The rows are
    numbered (W5) from a checkpoint of themselves in the shared folder and the
    id start is a plain number, so the result no longer reads the table it was
    computed from: appending it to that table is safe.
    """
    return rows_of_changes(quarantine_changes(audits, quarantine, as_of, min_days), quarantine, as_of)


def rows_of_changes(changes: DataFrame, quarantine: DataFrame, as_of) -> DataFrame:
    """The rows that a set of changes (:func:`quarantine_changes`) appends."""
    c = changes.filter(F.col("change") != "unchanged")
    added = F.col("change") == "added"
    rows = c.select(
        "url",
        F.when(added, F.col("first_failure")).otherwise(F.col("cur_first")).alias("first_failure"),
        "last_failure",
        F.col("failure_count").alias("consecutive_failures"),
        F.col("last_error").alias("last_error_message"),
        F.when(added, F.lit("quarantined")).otherwise(F.col("cur_status")).alias("status"),
        F.lit(None).cast("string").alias("notes"),
        F.when(added, F.lit(1)).otherwise(F.col("cur_version") + 1).cast("long").alias("version"))
    return _finish(rows, quarantine, as_of)


def update_stats(changes: DataFrame) -> DataFrame:
    """U2 statistics: added, updated, total_checked."""
    ch = F.col("change")
    return changes.agg(F.count_if(ch == "added").alias("added"),
                       F.count_if(ch == "updated").alias("updated"),
                       F.count(F.lit(1)).alias("total_checked"))


def status_violations(changes: DataFrame, allowed=None) -> DataFrame:
    """Q3: requested changes whose status is outside the allowed domain."""
    allowed = allowed or schemas.QUARANTINE_STATUSES
    return changes.filter(F.col("status").isNull() | ~F.col("status").isin(*allowed))


def set_quarantine_status(quarantine: DataFrame, changes: DataFrame, as_of,
                          strict: bool = True) -> DataFrame:
    """Append version + 1 with the new status and notes (NULL notes too).

    ``changes(url, status[, notes])`` holds one change per url.  Unknown urls
    give no row.  With ``strict`` a status outside the four allowed values
    raises ``ValueError`` (a bounded check: at most one row is read).
    """
    if strict and status_violations(changes).limit(1).count() > 0:
        raise ValueError(f"status must be one of {schemas.QUARANTINE_STATUSES}")
    ch = changes.select("url", F.col("status").alias("new_status"),
                        (F.col("notes") if "notes" in changes.columns
                         else F.lit(None).cast("string")).alias("new_notes"))
    ch = ch.filter(F.col("new_status").isin(*schemas.QUARANTINE_STATUSES))
    return _apply(quarantine, ch, as_of)


def remove_from_quarantine(quarantine: DataFrame, urls: DataFrame, as_of) -> DataFrame:
    """U4: tombstone rows (status 'removed', fixed note) for known urls."""
    ch = urls.select("url").distinct().select(
        "url", F.lit(schemas.REMOVED_STATUS).alias("new_status"),
        F.lit(schemas.REMOVED_NOTE).alias("new_notes"))
    return _apply(quarantine, ch, as_of)


def _apply(quarantine: DataFrame, ch: DataFrame, as_of) -> DataFrame:
    cur = current_one(quarantine)
    rows = cur.join(ch, "url", "inner").select(
        "url", "first_failure", "last_failure", "consecutive_failures", "last_error_message",
        F.col("new_status").alias("status"), F.col("new_notes").alias("notes"),
        (F.col("version") + 1).alias("version"))
    return _finish(rows, quarantine, as_of)
