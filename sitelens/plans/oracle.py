"""DuckDB SQL for the proxy tables, used as the independent oracle.

The CTEs below restate the proxy rules of :mod:`sitelens.sources.proxy` in
SQL over the driver's pre-registered views (``events``, ``pages``).  Every
oracle query is ``WITH <prelude> <query>``; unused CTEs are never run.
"""

from __future__ import annotations

from ..sources import proxy as P


def _score_sql(a: int, b: int, null_mod) -> str:
    e = f"event_id * {a}" + (f" + user_id * {b}" if b else "")
    bad = "event_type = 'error'" + (f" OR event_id % {null_mod} = 0" if null_mod else "")
    return f"CASE WHEN NOT ({bad}) THEN CAST(({e}) % 101 AS DOUBLE) / 100 END"


def _summaries_cte() -> str:
    uf = (f"substring('{P.UF_PAIRS}', 1 + 2 * (user_id % 28), 2)")
    uid = "CAST(user_id AS VARCHAR)"
    url = (f"CASE WHEN user_id % {P.NO_STATE_MOD} = {P.NO_STATE_REM} "
           f"THEN '{P.URL_PREFIX}' || {uid} || '.gov.br/' "
           f"ELSE '{P.URL_PREFIX}' || {uid} || '.' || {uf} || '.gov.br/' END")
    cols = ["event_id AS id", f"{url} AS url", 'ts AS "timestamp"']
    for name, a, b, null_mod in P.SCORE_RULES:
        cols.append(f"{_score_sql(a, b, null_mod)} AS {name}")
    for name, op, k in P.VITAL_RULES:
        cols.append(f"CASE WHEN NOT (event_type = 'error') THEN value {op} {k} END AS {name}")
    cols += [
        "event_type = 'error' AS has_errors",
        "CASE WHEN event_type = 'error' THEN 'HTTP ' || CAST(500 + event_id % 4 AS VARCHAR)"
        " || ': k=' || json_extract_string(props, '$.k') END AS error_message",
        "ts AS created_at",
        "user_id",
    ]
    return "summaries_ext AS (SELECT " + ", ".join(cols) + " FROM events)"


SUMMARY_COLUMNS = ("id, url, \"timestamp\", mobile_performance, mobile_accessibility, "
                   "mobile_best_practices, mobile_seo, desktop_performance, desktop_accessibility, "
                   "desktop_best_practices, desktop_seo, mobile_fcp, mobile_lcp, mobile_cls, "
                   "mobile_fid, desktop_fcp, desktop_lcp, desktop_cls, desktop_fid, has_errors, "
                   "error_message, created_at")


def _long(side: str) -> str:
    return (f"SELECT url, \"timestamp\", '{side}' AS strategy, "
            f"CAST({P.IBGE_BASE} + user_id AS VARCHAR) AS ibge_code, "
            f"{side}_performance AS performance, {side}_accessibility AS accessibility, "
            f"{side}_seo AS seo, {side}_best_practices AS \"bestPractices\" FROM summaries_ext")


PRELUDE = ",\n".join([
    _summaries_cte(),
    f"summaries AS (SELECT {SUMMARY_COLUMNS} FROM summaries_ext)",
    "audits AS (SELECT id, url, \"timestamp\", error_message, CAST(0 AS BIGINT) AS retry_count,"
    " created_at FROM summaries)",
    f"psi_metrics AS ({_long('mobile')} UNION ALL {_long('desktop')})",
    "clock AS (SELECT max(ts) AS as_of FROM events)",
])

AS_OF = "(SELECT as_of FROM clock)"


def sql(body: str, extra_ctes: str = "") -> str:
    """``WITH`` the prelude (and extra CTEs) followed by ``body``."""
    ctes = PRELUDE + (",\n" + extra_ctes if extra_ctes else "")
    return f"WITH {ctes}\n{body}"
