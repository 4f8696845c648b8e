"""From stored API responses to audits, summaries and the long metric layout.

T1  assemble_audits     pair the mobile and desktop response of one run
T1+T2 assemble_with_summaries  both in one pass, each body parsed once (assemble_pairs: of paired responses)
T1b response_error      error text of one response
T2  summarize_audits    scores and vitals out of the stored documents
T3  to_long_metrics     wide summary -> one row per strategy
Q5  validate_responses  classify every response, bad ones become error rows
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import scalars as X

# Strategies, document field names and error texts.
STRATEGIES = ["mobile", "desktop"]
# category name in the document -> column suffix
CATEGORY_COLUMNS = [("performance", "performance"), ("accessibility", "accessibility"),
                    ("best-practices", "best_practices"), ("seo", "seo")]
# audit name in the document -> column suffix (fid comes from max-potential-fid)
VITAL_AUDITS = [("first-contentful-paint", "fcp"), ("largest-contentful-paint", "lcp"),
                ("cumulative-layout-shift", "cls"), ("max-potential-fid", "fid")]
HTTP_PREFIX, TIMEOUT_PREFIX = "HTTP ", "Timeout: "
REQUEST_PREFIX, VALIDATION_PREFIX = "Request error: ", "Validation error: "
# error texts taken from a body are cut to so many characters (the domain's own rule)
BODY_SNIPPET = 200
VALIDATION_TEXT = "response body does not match the expected schema"
# fields that a usable response must have
REQUIRED_TOP = ["id", "analysisUTCTimestamp", "version"]
REQUIRED_RESULT = ["requestedUrl", "finalUrl", "lighthouseVersion", "userAgent", "fetchTime",
                   "environment", "configSettings", "categories", "audits"]
REQUIRED_URLS = ["requestedUrl", "finalUrl"]
REQUIRED_ITEM = ["id", "title", "description"]


def response_body(url: Column, fetch: Column, categories: dict, audits: dict) -> Column:
    """JSON text of a successful response document with the given values (``fetch``: its time as ISO text)."""

    def items(values: dict, field: str) -> Column:
        return F.create_map(*[x for name, v in values.items() for x in (
            F.lit(name), F.struct(*[F.lit(name).alias(c) for c in REQUIRED_ITEM], v.alias(field)))])

    settings = F.create_map(F.lit("locale"), F.lit("en"))
    return F.to_json(F.struct(
        url.alias("id"), fetch.alias("analysisUTCTimestamp"),
        F.create_map(F.lit("major"), F.lit("1")).alias("version"),
        F.struct(url.alias("requestedUrl"), url.alias("finalUrl"),
                 F.lit("1.0").alias("lighthouseVersion"), F.lit("agent").alias("userAgent"),
                 fetch.alias("fetchTime"), settings.alias("environment"),
                 settings.alias("configSettings"), items(categories, "score").alias("categories"),
                 items(audits, "numericValue").alias("audits")).alias("lighthouseResult")))


def parse_body(body) -> Column:
    """Parsed response document; unknown fields ignored, bad text -> no result."""
    return F.from_json(X._c(body), schemas.RESPONSE_BODY, {"mode": "PERMISSIVE"})


def usable_body(body) -> Column:
    """Q5: whether a parsed body has every required field and only numbers as scores."""
    doc, res = body, body.getField("lighthouseResult")
    ok = F.lit(True)
    for name in REQUIRED_TOP:
        ok &= doc.getField(name).isNotNull()
    for name in REQUIRED_RESULT:
        ok &= res.getField(name).isNotNull()
    for url in [doc.getField("id"), *[res.getField(name) for name in REQUIRED_URLS]]:
        ok &= X.is_valid_url(url)

    def numbers(items: Column, *fields: str) -> Column:
        def good(item):
            fine = item.isNotNull()
            for name in REQUIRED_ITEM:
                fine &= item.getField(name).isNotNull()
            for name in fields:
                v = item.getField(name)
                fine &= v.isNull() | v.try_cast("double").isNotNull()
            return fine
        return F.forall(F.map_values(items), good)

    ok &= numbers(res.getField("categories"), "score")
    ok &= numbers(res.getField("audits"), "score", "numericValue")
    return F.coalesce(ok, F.lit(False))


def is_http_error(code: Column) -> Column:
    """Any completed exchange whose status is not 2xx."""
    return code.isNotNull() & ~code.between(200, 299)


DOCUMENT = "_doc"


def with_documents(rows: DataFrame, bodies: dict[str, str]) -> DataFrame:
    """``rows`` with a parsed document (X12) per entry of ``bodies`` (new column -> text column).

    The documents pass through a Generate of one row, which the optimizer never
    merges with the projections above it.  As plain columns they would be put
    back into every expression that uses them, and parsed again in each.
    """
    docs = F.struct(*[parse_body(text).alias(name) for name, text in bodies.items()])
    return rows.select("*", F.inline(F.array(docs)))


def response_error(status_code="status_code", failure="failure", reason="reason",
                   body="body", document=DOCUMENT) -> Column:
    """Error text of one response, NULL when the response is usable.

    ``document`` is the parsed ``body`` (:func:`with_documents`).
    """
    code, fail, why, text = (X._c(c) for c in (status_code, failure, reason, body))
    # an error object without a message gives the whole body; an error that is
    # no object, like any other body, gives its first characters
    error = F.get_json_object(text, "$.error")
    detail = F.when(error.startswith("{"),
                    F.coalesce(F.get_json_object(text, "$.error.message"), text)) \
        .otherwise(F.substring(text, 1, BODY_SNIPPET))
    detail = F.coalesce(F.nullif(detail, F.lit("")), why, F.lit(""))
    usable = usable_body(X._c(document))
    return (F.when(fail == "timeout", F.concat(F.lit(TIMEOUT_PREFIX), F.coalesce(why, F.lit(""))))
            .when(fail == "request", F.concat(F.lit(REQUEST_PREFIX), F.coalesce(why, F.lit(""))))
            .when(fail.isNotNull(), F.coalesce(why, fail))
            .when(is_http_error(code), F.concat(F.lit(HTTP_PREFIX), code.cast("string"), F.lit(": "), detail))
            .when(~usable,
                  F.concat(F.lit(VALIDATION_PREFIX), F.lit(VALIDATION_TEXT))))


def validate_responses(raw: DataFrame) -> DataFrame:
    """Q5: every response with ``outcome`` and ``problem``; nothing is dropped."""
    err = response_error()
    outcome = (F.when(F.col("failure").isNotNull(), F.lit("transport_error"))
               .when(is_http_error(F.col("status_code")), F.lit("http_error"))
               .when(err.isNotNull(), F.lit("invalid_body"))
               .otherwise(F.lit("ok")))
    judged = with_documents(raw, {DOCUMENT: "body"})
    return judged.select(*raw.columns, outcome.alias("outcome"), err.alias("problem"))


#: Responses of a partition in which runs are grouped, which sorts it (about 150 MB of bodies).
RUN_ROWS = 100_000
_RESPONSE = ["status_code", "reason", "failure", "body"]


def _by_run(r: DataFrame):
    """Groups of (run_id, url).  A group holds two bodies, so combining before
    the shuffle would only sort every body once more; the rows are dealt out
    first, and both aggregation steps follow in one stage.  The number of partitions
    follows the number of responses, so that a task's sort does not grow with them."""
    keys, parts = ("run_id", "url"), -(-r.count() // RUN_ROWS)
    few = parts <= int(r.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (r.repartition(*keys) if few else r.repartition(parts, *keys)).groupBy(*keys)


def _judged_runs(raw: DataFrame) -> DataFrame:
    """One row per run: ``timestamp`` and, per strategy, the newest response (``_mobile``), their number
    (``_mobile_n``), its parsed document (``_mobile_doc``) and error text (``_mobile_err``).

    Only the stored columns move; bodies are parsed once, in the groups.
    """
    aggs = [F.min("fetched_at").alias("timestamp")]
    for s in STRATEGIES:
        when_s = F.when(F.col("strategy") == s, F.col("fetched_at"))
        aggs += [F.max_by(F.struct(*_RESPONSE), when_s).alias(f"_{s}"), F.count(when_s).alias(f"_{s}_n")]
    return _judged(_by_run(raw.select("run_id", "url", "strategy", "fetched_at", *_RESPONSE)).agg(*aggs))


def _judged(g: DataFrame) -> DataFrame:
    """Runs with their newest responses and, of each, the parsed document and the error text."""
    # one row out of a Generate, as in with_documents
    docs = F.transform(F.array(*[f"_{s}.body" for s in STRATEGIES]), parse_body)
    judged = g.select("*", F.inline(F.array(F.struct(docs.alias("_docs")))))
    judged = judged.withColumns({f"_{s}{DOCUMENT}": F.col("_docs")[i] for i, s in enumerate(STRATEGIES)})
    return judged.select("*", *[response_error(f"_{s}.status_code", f"_{s}.failure", f"_{s}.reason", f"_{s}.body",
                                               f"_{s}{DOCUMENT}").alias(f"_{s}_err") for s in STRATEGIES])


def _audit_columns(created_at) -> tuple[Column, list]:
    errs = [F.when(F.col(f"_{s}_n") == 0, F.lit(f"{REQUEST_PREFIX}missing {s} response"))
            .otherwise(F.col(f"_{s}_err")) for s in STRATEGIES]
    error_message = F.coalesce(*errs)
    ok = error_message.isNull()
    cols = [
        F.col("run_id").alias("id"), F.col("url"), F.col("timestamp"),
        F.when(ok, F.col("_mobile.body")).alias("mobile_result"),
        F.when(ok, F.col("_desktop.body")).alias("desktop_result"),
        error_message.alias("error_message"),
        F.lit(0).cast("long").alias("retry_count"),
        (X.as_time(created_at) if created_at is not None else F.col("timestamp")).alias("created_at"),
    ]
    return ok, cols


def assemble_with_summaries(raw: DataFrame, created_at=None) -> DataFrame:
    """T1 and T2 in one pass: every audit column plus every summary column.

    Each newest response is parsed once, after the shuffle: the same document
    (:func:`with_documents`) decides validity (T1b) and yields the four scores and
    four vitals (X12), so only stored columns travel through the (run_id, url) exchange.  The
    audits table is ``select(AUDITS)`` of the result and the summaries table
    ``select(AUDIT_SUMMARIES)``, with the same values as T2 over the stored
    documents.
    """
    return _summarized(_judged_runs(raw), created_at)


def assemble_pairs(pairs: DataFrame, created_at=None) -> DataFrame:
    """:func:`assemble_with_summaries` of runs whose responses lie side by side: the structs ``first`` and
    ``second`` of a row, either may be NULL.  A run has one row, and a row one response of a strategy at most.

    The groups are there already, so no body moves and none is sorted.
    """
    sides = ("first", "second")
    cols = [F.coalesce(*[f"{x}.{c}" for x in sides]).alias(c) for c in ("run_id", "url")]
    cols.append(F.least(*[f"{x}.fetched_at" for x in sides]).alias("timestamp"))
    for s in STRATEGIES:
        # as in the groups, a response without time is none
        one = F.coalesce(*[F.when((F.col(f"{x}.strategy") == s) & F.col(f"{x}.fetched_at").isNotNull(),
                                  F.struct(*[f"{x}.{c}" for c in _RESPONSE])) for x in sides])
        cols += [one.alias(f"_{s}"), one.isNotNull().cast("long").alias(f"_{s}_n")]
    return _summarized(_judged(pairs.select(*cols)), created_at)


def _summarized(g: DataFrame, created_at) -> DataFrame:
    """Every audit and summary column of judged runs."""
    ok, cols = _audit_columns(created_at)
    parsed = {s: F.col(f"_{s}{DOCUMENT}") for s in STRATEGIES}
    for s in STRATEGIES:
        for name, suffix in CATEGORY_COLUMNS:
            cols.append(F.when(ok, X.category_score(parsed[s], name)).alias(f"{s}_{suffix}"))
    for s in STRATEGIES:
        for name, suffix in VITAL_AUDITS:
            cols.append(F.when(ok, X.audit_value(parsed[s], name)).alias(f"{s}_{suffix}"))
    cols.append((~ok).alias("has_errors"))
    return g.select(*cols)


def assemble_audits(raw: DataFrame, created_at=None) -> DataFrame:
    """One audit per (run, url) out of its mobile and desktop responses.

    All or nothing: if either response failed both documents are NULL and the
    error text is the mobile one first, else the desktop one.  A missing
    response counts as a failure.  Repeated responses of one strategy: the
    newest wins.  One shuffle on (run_id, url); every group holds two rows.
    """
    _, cols = _audit_columns(created_at)
    return _judged_runs(raw).select(*cols)


def audits_with_summaries(audits: DataFrame) -> DataFrame:
    """Every audit column plus every summary column (narrow, no shuffle, each document parsed once)."""
    cols = [F.col(c) for c in schemas.AUDITS.fieldNames() if c in audits.columns]
    names = {s: f"_{s}{DOCUMENT}" for s in STRATEGIES}
    parsed = {s: F.col(name) for s, name in names.items()}
    for s in STRATEGIES:
        for name, suffix in CATEGORY_COLUMNS:
            cols.append(X.category_score(parsed[s], name).alias(f"{s}_{suffix}"))
    for s in STRATEGIES:
        for name, suffix in VITAL_AUDITS:
            cols.append(X.audit_value(parsed[s], name).alias(f"{s}_{suffix}"))
    cols.append(F.col("error_message").isNotNull().alias("has_errors"))
    return with_documents(audits, {name: f"{s}_result" for s, name in names.items()}).select(*cols)


def summarize_audits(audits: DataFrame) -> DataFrame:
    """The wide summary row of every audit."""
    return audits_with_summaries(audits).select(*schemas.AUDIT_SUMMARIES.fieldNames())


def to_long_metrics(summaries: DataFrame, ibge_code: str | None = None) -> DataFrame:
    """One row per (audit, strategy) with the four category scores.

    A Generate node over the scan — no shuffle, no second read.
    """
    code = F.col(ibge_code) if ibge_code else F.lit(None).cast("string")
    pairs = [F.struct(F.lit(s).alias("strategy"),
                      F.col(f"{s}_performance").alias("performance"),
                      F.col(f"{s}_accessibility").alias("accessibility"),
                      F.col(f"{s}_seo").alias("seo"),
                      F.col(f"{s}_best_practices").alias("bestPractices")) for s in STRATEGIES]
    return summaries.select("url", "timestamp", code.alias("ibge_code"),
                            F.inline(F.array(*pairs))) \
        .select(*schemas.PSI_METRICS.fieldNames())
