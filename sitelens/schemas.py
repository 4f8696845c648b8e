"""Declared table schemas.  Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, I = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType()
TS = T.TimestampNTZType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


# Site list: ``url`` plus the optional columns of a municipal register.
SITES = T.StructType([_f("url", S), _f("name", S), _f("uf", S), _f("ibge_code", S), _f("note", S)])

# Stored API responses, one per (run, url, strategy).  ``failure`` is NULL for a
# completed HTTP exchange, else 'timeout' / 'request' / any other text.
RAW_RESPONSES = T.StructType([
    _f("run_id", L), _f("url", S), _f("strategy", S), _f("fetched_at", TS),
    _f("status_code", I), _f("reason", S), _f("failure", S), _f("body", S),
])

AUDITS = T.StructType([
    _f("id", L), _f("url", S, False), _f("timestamp", TS, False),
    _f("mobile_result", S), _f("desktop_result", S), _f("error_message", S),
    _f("retry_count", L), _f("created_at", TS),
])

SCORE_COLUMNS = [
    f"{side}_{m}" for side in ("mobile", "desktop")
    for m in ("performance", "accessibility", "best_practices", "seo")
]
VITAL_COLUMNS = [f"{side}_{m}" for side in ("mobile", "desktop") for m in ("fcp", "lcp", "cls", "fid")]

AUDIT_SUMMARIES = T.StructType(
    [_f("id", L), _f("url", S, False), _f("timestamp", TS, False)]
    + [_f(c, D) for c in SCORE_COLUMNS]
    + [_f(c, D) for c in VITAL_COLUMNS]
    + [_f("has_errors", B), _f("error_message", S), _f("created_at", TS)]
)

PSI_METRICS = T.StructType([
    _f("url", S), _f("timestamp", TS), _f("strategy", S), _f("ibge_code", S),
    _f("performance", D), _f("accessibility", D), _f("seo", D), _f("bestPractices", D),
])

QUARANTINE = T.StructType([
    _f("id", L), _f("url", S, False), _f("first_failure", TS, False), _f("last_failure", TS, False),
    _f("consecutive_failures", L), _f("last_error_message", S), _f("status", S),
    _f("notes", S), _f("version", L), _f("valid_from", TS), _f("created_at", TS),
])

# Long metrics as found in a JSON array export (timestamps are ISO text with Z).
METRICS_JSON = T.StructType([
    _f("url", S), _f("performance", D), _f("accessibility", D), _f("seo", D),
    _f("bestPractices", D), _f("timestamp", S), _f("strategy", S), _f("ibge_code", S),
])

# Response body: the parts an operator reads or validates.  Unknown fields are
# ignored; numbers are read as text, so that one that is no number can be told from none.
_TEXTS = T.MapType(S, S)
_CATEGORY = T.StructType([_f("id", S), _f("title", S), _f("description", S), _f("score", S)])
_AUDIT_ITEM = T.StructType([_f("id", S), _f("title", S), _f("description", S), _f("score", S),
                            _f("numericValue", S)])
RESPONSE_BODY = T.StructType([
    _f("id", S),
    _f("analysisUTCTimestamp", S),
    _f("version", _TEXTS),
    _f("lighthouseResult", T.StructType([
        _f("requestedUrl", S), _f("finalUrl", S), _f("lighthouseVersion", S),
        _f("userAgent", S), _f("fetchTime", S), _f("environment", _TEXTS),
        _f("configSettings", _TEXTS),
        _f("categories", T.MapType(S, _CATEGORY)),
        _f("audits", T.MapType(S, _AUDIT_ITEM)),
    ])),
])

# Fixed values of the domain.
QUARANTINE_STATUSES = ["quarantined", "investigating", "resolved", "wrong_url"]
REMOVED_STATUS = "removed"
REMOVED_NOTE = "Removed from quarantine"
SKIP_STATUSES = ["quarantined", "wrong_url"]
LONG_METRIC_NAMES = ["performance", "accessibility", "seo", "bestPractices"]


def empty_frame(spark, schema: T.StructType):
    """An empty DataFrame of ``schema`` planned in the JVM (no Python worker)."""
    from pyspark.sql import functions as F
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


# Driver tables as stored (declared, so reading them runs no inference job).
EVENTS = T.StructType([_f("event_id", L), _f("ts", TS), _f("user_id", L), _f("event_type", S),
                       _f("value", D), _f("props", S)])
PAGES = T.StructType([_f("page_id", L), _f("url", S), _f("html", S)])
