"""Quarantine reports over the proxy's quarantine history, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import filters as FL
from ..operators import metrics as M
from ..operators import quarantine as Q
from ..sources import proxy as P
from . import oracle as O
from .reports import report

T1 = f"(SELECT as_of - INTERVAL {P.FIRST_UPDATE_DAYS_BEFORE} DAY FROM clock)"
T2 = O.AS_OF
T3 = f"(SELECT as_of + INTERVAL {P.STATUS_CHANGE_HOURS_AFTER} HOUR FROM clock)"
MIN_DAYS = 3
_ALLOWED = ", ".join(f"'{s}'" for s in schemas.QUARANTINE_STATUSES)


def _fail(name: str, t: str) -> str:
    return (f"{name} AS (SELECT url, min(\"timestamp\") AS first_failure, "
            "max(\"timestamp\") AS last_failure, count(*) AS failure_count, "
            "arg_max(error_message, {'t': \"timestamp\", 'i': id}) AS last_error FROM audits "
            f"WHERE error_message IS NOT NULL AND \"timestamp\" >= {t} - INTERVAL {2 * MIN_DAYS} DAY "
            f"AND \"timestamp\" <= {t} GROUP BY url HAVING count(*) >= {MIN_DAYS})")


def _cur_one(name: str, src: str) -> str:
    return (f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY url "
            f"ORDER BY version DESC, id DESC) AS rn FROM {src}) WHERE rn = 1)")


def _next_id(src: str, order: str) -> str:
    return (f"CAST((SELECT coalesce(max(id), 0) FROM {src}) + row_number() OVER (ORDER BY {order})"
            " AS BIGINT) AS id")


_case_status = "CASE CAST(regexp_extract(url, '" + P.SITE_KEY_PATTERN + "', 1) AS BIGINT) % " + \
    str(P.STATUS_BY_SITE_MOD) + "".join(f" WHEN {r} THEN '{s}'" for r, s in P.STATUS_BY_SITE) + " END"

Q_CTES = ",\n".join([
    _fail("fail1", T1),
    "q1 AS (SELECT CAST(row_number() OVER (ORDER BY url) AS BIGINT) AS id, url, first_failure, "
    "last_failure, failure_count AS consecutive_failures, last_error AS last_error_message, "
    "'quarantined' AS status, CAST(NULL AS VARCHAR) AS notes, CAST(1 AS BIGINT) AS version, "
    f"{T1} AS valid_from, {T1} AS created_at FROM fail1)",
    _cur_one("cur1", "q1"),
    _fail("fail2", T2),
    "j2 AS (SELECT f.*, c.version AS cur_version, c.consecutive_failures AS cur_failures, "
    "c.first_failure AS cur_first, c.status AS cur_status, CASE WHEN c.version IS NULL THEN 'added' "
    "WHEN c.consecutive_failures IS DISTINCT FROM f.failure_count THEN 'updated' "
    "ELSE 'unchanged' END AS change FROM fail2 f LEFT JOIN cur1 c ON f.url = c.url)",
    "rows2 AS (SELECT " + _next_id("q1", "url") + ", url, CASE WHEN change = 'added' THEN "
    "first_failure ELSE cur_first END AS first_failure, last_failure, failure_count AS "
    "consecutive_failures, last_error AS last_error_message, CASE WHEN change = 'added' THEN "
    "'quarantined' ELSE cur_status END AS status, CAST(NULL AS VARCHAR) AS notes, "
    "CAST(CASE WHEN change = 'added' THEN 1 ELSE cur_version + 1 END AS BIGINT) AS version, "
    f"{T2} AS valid_from, {T2} AS created_at FROM j2 WHERE change <> 'unchanged')",
    "q2 AS (SELECT * FROM q1 UNION ALL SELECT * FROM rows2)",
    _cur_one("cur2", "q2"),
    f"chg AS (SELECT url, {_case_status} AS status FROM cur2)",
    "rows3 AS (SELECT " + _next_id("q2", "c.url") + ", c.url, c.first_failure, c.last_failure, "
    "c.consecutive_failures, c.last_error_message, h.status, "
    f"'{P.STATUS_NOTE_PREFIX}' || h.status AS notes, c.version + 1 AS version, "
    f"{T3} AS valid_from, {T3} AS created_at FROM cur2 c JOIN chg h ON c.url = h.url "
    f"WHERE h.status IN ({_ALLOWED}))",
    "q3 AS (SELECT * FROM q2 UNION ALL SELECT * FROM rows3)",
    _cur_one("cur3", "q3"),
    "rows4 AS (SELECT " + _next_id("q3", "c.url") + ", c.url, c.first_failure, c.last_failure, "
    f"c.consecutive_failures, c.last_error_message, '{schemas.REMOVED_STATUS}' AS status, "
    f"'{schemas.REMOVED_NOTE}' AS notes, c.version + 1 AS version, {T3} AS valid_from, "
    f"{T3} AS created_at FROM cur3 c JOIN (SELECT DISTINCT url FROM chg WHERE status = "
    f"'{schemas.REMOVED_STATUS}') r ON c.url = r.url)",
    "quarantine AS (SELECT * FROM q3 UNION ALL SELECT * FROM rows4)",
    "qcur AS (SELECT * EXCLUDE (rk) FROM (SELECT *, rank() OVER (PARTITION BY url ORDER BY "
    "version DESC) AS rk FROM quarantine) WHERE rk = 1)",
])


def qsql(body: str, more: str = "") -> str:
    return O.sql(body, Q_CTES + (",\n" + more if more else ""))


def _steps(spark, sf):
    return P.quarantine_steps(spark, sf)


@report("failing_urls", O.sql(
    "SELECT * FROM fail", _fail("fail", T2)))
def q_failing_urls(spark, sf):
    return M.failing_urls(P.audits(spark, sf), P.as_of(spark, sf), MIN_DAYS)


@report("quarantine_update", qsql("SELECT * FROM rows2"))
def q_quarantine_update(spark, sf):
    """U2 at ``as_of`` over the stored table of the first update (computed fresh)."""
    st = _steps(spark, sf)
    return Q.update_quarantine(P.audits(spark, sf), st["rows1"], st["t2"])


@report("quarantine_update_stats", qsql(
    "SELECT CAST(count_if(change = 'added') AS BIGINT) AS added, "
    "CAST(count_if(change = 'updated') AS BIGINT) AS updated, count(*) AS total_checked FROM j2"))
def q_quarantine_update_stats(spark, sf):
    return Q.update_stats(_steps(spark, sf)["changes2"])


@report("quarantine_table", qsql("SELECT * FROM quarantine"))
def q_quarantine_table(spark, sf):
    return P.quarantine(spark, sf)


@report("quarantine_current", qsql("SELECT * FROM qcur"))
def q_quarantine_current(spark, sf):
    return Q.quarantine_current(P.quarantine(spark, sf))


@report("quarantine_as_of", qsql(
    "SELECT * EXCLUDE (rk) FROM (SELECT *, rank() OVER (PARTITION BY url ORDER BY version DESC) "
    f"AS rk FROM quarantine WHERE valid_from <= {T2}) WHERE rk = 1"))
def q_quarantine_as_of(spark, sf):
    return Q.quarantine_as_of(P.quarantine(spark, sf), _steps(spark, sf)["t2"])


@report("quarantine_next_version", qsql(
    "SELECT url, max(version) + 1 AS next_version FROM quarantine GROUP BY url"))
def q_quarantine_next_version(spark, sf):
    return Q.next_version(P.quarantine(spark, sf))


@report("quarantine_list", qsql(
    "SELECT url, first_failure, last_failure, consecutive_failures, last_error_message AS "
    "last_error, status, notes, created_at FROM qcur WHERE consecutive_failures >= 0 AND "
    f"status <> '{schemas.REMOVED_STATUS}' ORDER BY consecutive_failures DESC, last_failure DESC, url"))
def q_quarantine_list(spark, sf):
    return FL.list_quarantined(Q.quarantine_current(P.quarantine(spark, sf)))


@report("quarantine_stats", qsql(
    "SELECT count(*) AS total, "
    + ", ".join(f"CAST(count_if(status = '{s}') AS BIGINT) AS {s}"
                for s in schemas.QUARANTINE_STATUSES)
    + ", coalesce(round(avg(consecutive_failures), 1), 0.0) AS avg_failures, "
    f"coalesce(max(consecutive_failures), 0) AS max_failures FROM qcur "
    f"WHERE status <> '{schemas.REMOVED_STATUS}'"))
def q_quarantine_stats(spark, sf):
    return M.quarantine_stats(Q.quarantine_current(P.quarantine(spark, sf)))


@report("quarantine_skip", qsql(
    "SELECT url FROM qcur WHERE status IN ("
    + ", ".join(f"'{s}'" for s in schemas.SKIP_STATUSES) + ")"))
def q_quarantine_skip(spark, sf):
    return FL.quarantine_skip_urls(Q.quarantine_current(P.quarantine(spark, sf)))


@report("quarantine_set_status", qsql("SELECT * FROM rows3"))
def q_quarantine_set_status(spark, sf):
    """U3 over the stored table after both updates (computed fresh)."""
    st = _steps(spark, sf)
    return Q.set_quarantine_status(st["q2"], st["set_changes"], st["t3"])


@report("quarantine_remove", qsql("SELECT * FROM rows4"))
def q_quarantine_remove(spark, sf):
    """U4 over the stored table after the status changes (computed fresh)."""
    st = _steps(spark, sf)
    return Q.remove_from_quarantine(st["q3"], st["removals"], st["t3"])


@report("status_domain", qsql(
    f"SELECT status, count(*) AS n, status IN ({_ALLOWED}, '{schemas.REMOVED_STATUS}') AS valid "
    "FROM quarantine GROUP BY status"))
def q_status_domain(spark, sf):
    q = P.quarantine(spark, sf)
    allowed = schemas.QUARANTINE_STATUSES + [schemas.REMOVED_STATUS]
    return q.groupBy("status").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("valid", F.col("status").isin(*allowed))


@report("skip_list_applied", qsql(
    "SELECT url FROM (SELECT DISTINCT url FROM summaries) s WHERE NOT EXISTS (SELECT 1 FROM ("
    f"SELECT url FROM audits WHERE \"timestamp\" > {T2} - INTERVAL 24 HOUR AND \"timestamp\" <= {T2} "
    "AND error_message IS NULL UNION ALL SELECT url FROM qcur WHERE status IN ("
    + ", ".join(f"'{s}'" for s in schemas.SKIP_STATUSES) + ")) k "
    "WHERE regexp_replace(k.url, '/+$', '') || '/' = regexp_replace(s.url, '/+$', '') || '/')"))
def q_skip_list_applied(spark, sf):
    cur = Q.quarantine_current(P.quarantine(spark, sf))
    return FL.urls_to_audit(P.sites(spark, sf), P.audits(spark, sf), P.as_of(spark, sf), 24,
                            current_quarantine=cur)
