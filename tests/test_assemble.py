"""Assembly from stored responses (T1, T1b, T2, T3, Q5) — D12 and the mocked-API scenarios."""

import datetime as dt
import json

from sitelens import schemas
from sitelens.operators import assemble as A
from tests.conftest import NOW


PERF, ACC, SEO, BP = 0.62, 0.71, 0.94, 0.58


def ok_body(perf=PERF, acc=ACC, seo=SEO, bp=BP, fcp=812.5, lcp=1640.0, cls=0.03, fid=47.0,
            drop_category=None, drop=(), **replaced):
    """A response body; ``drop`` names fields left out, ``replaced`` sets fields of the result."""
    cats = {"performance": perf, "accessibility": acc, "seo": seo, "best-practices": bp}
    if drop_category:
        cats.pop(drop_category)
    vitals = {"first-contentful-paint": fcp, "largest-contentful-paint": lcp,
              "cumulative-layout-shift": cls, "max-potential-fid": fid}
    item = {k: k for k in A.REQUIRED_ITEM}
    result = {k: "https://site.example/" for k in A.REQUIRED_RESULT}
    result |= {"environment": {}, "configSettings": {},
               "categories": {k: item | {"score": v} for k, v in cats.items()},
               "audits": {k: item | {"numericValue": v} for k, v in vitals.items()}} | replaced
    doc = {"id": "https://site.example/", "analysisUTCTimestamp": "t", "version": {},
           "lighthouseResult": {k: v for k, v in result.items() if k not in drop}}
    return json.dumps({k: v for k, v in doc.items() if k not in drop})


def raw(spark, rows):
    """rows: (run_id, url, strategy, status, reason, failure, body)"""
    return spark.createDataFrame(
        [(r, u, s, NOW + dt.timedelta(seconds=i), c, why, f, b)
         for i, (r, u, s, c, why, f, b) in enumerate(rows)], schemas.RAW_RESPONSES)


def test_successful_run_gives_one_audit_and_summary(spark):
    rows = [(1, "https://a/", "mobile", 200, "OK", None, ok_body()),
            (1, "https://a/", "desktop", 200, "OK", None, ok_body(perf=0.5))]
    a = A.assemble_audits(raw(spark, rows))
    r = a.first()
    assert a.count() == 1 and r.error_message is None and r.timestamp == NOW
    s = A.summarize_audits(a).first()
    assert (s.mobile_performance, s.desktop_performance, s.mobile_best_practices, s.mobile_fid) == \
        (PERF, 0.5, BP, 47.0)
    assert s.has_errors is False


def test_all_or_nothing_and_error_texts(spark):
    err = json.dumps({"error": {"code": 429, "message": "Quota exceeded"}})
    rows = [
        (1, "https://a/", "mobile", 429, "Too Many Requests", None, err),
        (1, "https://a/", "desktop", 200, "OK", None, ok_body()),
        (2, "https://b/", "mobile", 200, "OK", None, ok_body()),
        (2, "https://b/", "desktop", 500, "Internal Server Error", None, "<html>" + "x" * 300),
        (3, "https://c/", "mobile", None, "read timed out", "timeout", None),
        (3, "https://c/", "desktop", 200, "OK", None, ok_body()),
        (4, "https://d/", "mobile", 200, "OK", None, "{not json"),
        (4, "https://d/", "desktop", 200, "OK", None, ok_body()),
        (5, "https://e/", "mobile", None, "connection refused", "request", None),
        (5, "https://e/", "desktop", 503, "Service Unavailable", None, ""),
        (6, "https://f/", "mobile", 200, "OK", None, ok_body()),
    ]
    out = {r.url: r for r in A.assemble_audits(raw(spark, rows)).collect()}
    assert out["https://a/"].error_message == "HTTP 429: Quota exceeded"
    assert out["https://a/"].mobile_result is None and out["https://a/"].desktop_result is None
    assert out["https://b/"].error_message == "HTTP 500: <html>" + "x" * 194
    assert out["https://c/"].error_message == "Timeout: read timed out"
    assert out["https://d/"].error_message.startswith("Validation error: ")
    assert out["https://e/"].error_message == "Request error: connection refused"
    assert out["https://f/"].error_message == "Request error: missing desktop response"
    s = {r.url: r for r in A.summarize_audits(A.assemble_audits(raw(spark, rows))).collect()}
    assert s["https://a/"].has_errors and s["https://a/"].mobile_performance is None


def test_missing_category_gives_null_score(spark):
    rows = [(1, "https://a/", "mobile", 200, "OK", None, ok_body(drop_category="seo")),
            (1, "https://a/", "desktop", 200, "OK", None, ok_body())]
    s = A.summarize_audits(A.assemble_audits(raw(spark, rows))).first()
    assert s.mobile_seo is None and s.desktop_seo == SEO and not s.has_errors


def test_newest_response_of_a_strategy_wins(spark):
    rows = [(1, "https://a/", "mobile", 500, "err", None, "{}"),
            (1, "https://a/", "mobile", 200, "OK", None, ok_body(perf=0.3)),
            (1, "https://a/", "desktop", 200, "OK", None, ok_body())]
    s = A.summarize_audits(A.assemble_audits(raw(spark, rows))).first()
    assert s.mobile_performance == 0.3 and not s.has_errors


def test_validation_outcomes(spark):
    rows = [(1, "u", "mobile", 200, "OK", None, ok_body()),
            (1, "u", "desktop", 200, "OK", None, "[]"),
            (2, "v", "mobile", 404, "Not Found", None, "{}"),
            (2, "v", "desktop", None, "boom", "timeout", None)]
    got = sorted((r.strategy, r.outcome) for r in A.validate_responses(raw(spark, rows)).collect())
    assert got == [("desktop", "invalid_body"), ("desktop", "transport_error"),
                   ("mobile", "http_error"), ("mobile", "ok")]


def test_five_ok_two_failing_sites(spark):
    rows = []
    for i in range(7):
        bad = i >= 5
        rows.append((i, f"https://s{i}/", "mobile", 500 if bad else 200, "x", None,
                     "{}" if bad else ok_body()))
        rows.append((i, f"https://s{i}/", "desktop", 200, "OK", None, ok_body()))
    s = A.summarize_audits(A.assemble_audits(raw(spark, rows)))
    assert s.count() == 7 and s.filter("has_errors").count() == 2


def test_long_metrics_two_rows_per_audit(spark):
    rows = [(1, "https://a/", "mobile", 200, "OK", None, ok_body()),
            (1, "https://a/", "desktop", 200, "OK", None, ok_body(perf=0.1))]
    long = A.to_long_metrics(A.summarize_audits(A.assemble_audits(raw(spark, rows))))
    got = sorted((r.strategy, r.performance, r.bestPractices) for r in long.collect())
    assert got == [("desktop", 0.1, BP), ("mobile", PERF, BP)]


def test_fused_assembly_equals_t2_of_t1(spark):
    err = json.dumps({"error": {"code": 429, "message": "Quota exceeded"}})
    rows = [(1, "https://a/", "mobile", 429, "x", None, err),
            (1, "https://a/", "desktop", 200, "OK", None, ok_body()),
            (2, "https://b/", "mobile", 200, "OK", None, ok_body(drop_category="seo")),
            (2, "https://b/", "desktop", 200, "OK", None, ok_body(perf=0.2, fid=9.5)),
            (3, "https://c/", "mobile", 200, "OK", None, "{broken"),
            (3, "https://c/", "desktop", 200, "OK", None, ok_body()),
            (4, "https://d/", "mobile", 200, "OK", None, ok_body())]
    r = raw(spark, rows)
    fused = A.assemble_with_summaries(r)
    two_step = A.assemble_audits(r)
    assert fused.select(*schemas.AUDITS.fieldNames()).exceptAll(two_step).count() == 0
    summ = A.summarize_audits(two_step)
    got = fused.select(*schemas.AUDIT_SUMMARIES.fieldNames())
    assert got.count() == 4
    assert got.exceptAll(summ).count() == 0 and summ.exceptAll(got).count() == 0


def test_required_fields_types_and_status(spark):
    good = ok_body()
    bodies = [(200, ok_body(drop=(f,))) for f in [*A.REQUIRED_TOP, *A.REQUIRED_RESULT]]
    bodies += [(200, ok_body(perf="abc")), (200, ok_body(fcp="abc")), (200, ok_body(finalUrl="no url")),
               (200, ok_body(environment="text")), (200, '{"lighthouseResult":{}}'), (200, None), (200, "")]
    bad = len(bodies)
    bodies += [(302, good), (100, good), (204, good), (200, ok_body(perf=None)), (200, ok_body(perf="0.5"))]
    v = A.validate_responses(raw(spark, [(i, "https://a/", "mobile", c, "Found", None, b)
                                         for i, (c, b) in enumerate(bodies)]))
    got = [r.outcome for r in v.orderBy("run_id").collect()]
    assert got == ["invalid_body"] * bad + ["http_error"] * 2 + ["ok"] * 3


def test_error_text_of_an_error_that_is_no_object(spark):
    body = json.dumps({"error": "y" * 500})
    rows = [(1, "https://a/", "mobile", 500, "x", None, body),
            (2, "https://b/", "mobile", 500, "x", None, json.dumps({"error": {"code": 1}}))]
    got = {r.url: r.problem for r in A.validate_responses(raw(spark, rows)).collect()}
    assert got["https://a/"] == "HTTP 500: " + body[:200]
    assert got["https://b/"] == 'HTTP 500: {"error": {"code": 1}}'
