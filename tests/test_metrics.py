"""Aggregates A1-A15 on hand-made rows (D6, D11, D14 and the feature scenarios)."""

import datetime as dt

import pytest

from sitelens.operators import metrics as M
from tests.conftest import NOW, audits_df, summaries_df, summary_row


def _rows(n=100):
    # every 10th audit an error that still carries scores
    out = []
    for i in range(n):
        out.append(summary_row(
            i + 1, f"https://site{i % 7}.sp.gov.br/", NOW - dt.timedelta(hours=i),
            has_errors=(i % 10 == 0), error="boom" if i % 10 == 0 else None,
            mobile_performance=0.5 + (i % 50) / 100, desktop_performance=0.6 + (i % 40) / 100,
            mobile_accessibility=0.7 + (i % 30) / 100, desktop_accessibility=0.8 + (i % 20) / 100))
    return out


def test_aggregated_metrics_counts_all_audits(spark):
    r = M.aggregated_metrics(summaries_df(spark, _rows())).first()
    assert r.total_audits == 100 and r.failed_audits == 10 and r.successful_audits == 90
    assert r.success_rate == pytest.approx(0.9) and r.error_rate == pytest.approx(0.1)
    assert r.min_mobile_performance <= r.avg_mobile_performance <= r.max_mobile_performance
    assert r.std_mobile_performance > 0


def test_aggregated_metrics_null_flag_counts_in_neither(spark):
    rows = [summary_row(1, "https://a.sp.gov.br/", NOW, has_errors=None),
            summary_row(2, "https://b.sp.gov.br/", NOW, has_errors=True)]
    r = M.aggregated_metrics(summaries_df(spark, rows)).first()
    assert (r.total_audits, r.successful_audits, r.failed_audits) == (2, 0, 1)


def test_aggregated_metrics_empty_gives_zero_counts_null_means(spark):
    r = M.aggregated_metrics(summaries_df(spark, [])).first()
    assert (r.total_audits, r.successful_audits, r.failed_audits) == (0, 0, 0)
    assert r.success_rate == 0.0 and r.error_rate == 0.0
    assert r.avg_mobile_performance is None


def test_metrics_by_state_order_and_audit_count(spark):
    states = ["sp", "rj", "mg", "ba", "rs"]
    rows, k = [], 0
    for i, uf in enumerate(states):
        for j in range(10):
            k += 1
            rows.append(summary_row(k, f"https://municipio{j}.{uf}.gov.br", NOW,
                                    mobile_performance=0.5 + 0.1 * i,
                                    mobile_accessibility=0.7 + 0.05 * i))
    rows.append(summary_row(999, "https://semuf.gov.br", NOW, mobile_performance=1.0))
    rows.append(summary_row(998, "https://x.sp.gov.br", NOW, has_errors=True, mobile_performance=0.0))
    out = M.metrics_by_state(summaries_df(spark, rows)).collect()
    assert [r.state for r in out] == ["RS", "BA", "MG", "RJ", "SP"]
    assert all(r.site_count == 10 for r in out)


def test_failing_urls_window_and_threshold(spark):
    rows = [(i, "https://down.sp.gov.br/", NOW - dt.timedelta(days=i), "Connection timeout")
            for i in range(5)]
    rows += [(10, "https://flaky.sp.gov.br/", NOW, "x"), (11, "https://flaky.sp.gov.br/",
                                                         NOW - dt.timedelta(days=3), "y")]
    rows += [(20, "https://old.sp.gov.br/", NOW - dt.timedelta(days=10 + i), "z") for i in range(4)]
    out = {r.url: r for r in M.failing_urls(audits_df(spark, rows), NOW, 3).collect()}
    assert set(out) == {"https://down.sp.gov.br/"}
    r = out["https://down.sp.gov.br/"]
    assert r.failure_count == 5 and r.last_failure == NOW and r.last_error == "Connection timeout"


def test_failing_urls_counts_failures_not_streaks(spark):
    # a success between failures does not reset the count
    rows = [(1, "u", NOW - dt.timedelta(days=1), "a"), (2, "u", NOW - dt.timedelta(days=2), None),
            (3, "u", NOW - dt.timedelta(days=3), "b"), (4, "u", NOW - dt.timedelta(days=4), "c")]
    r = M.failing_urls(audits_df(spark, rows), NOW, 3).first()
    assert r.failure_count == 3 and r.last_error == "a"


def test_quarantine_stats_empty_is_zeros(spark):
    from sitelens import schemas
    r = M.quarantine_stats(schemas.empty_frame(spark, schemas.QUARANTINE)).first()
    assert tuple(r) == (0, 0, 0, 0, 0, 0.0, 0)


def test_score_distribution_bands_sum_to_non_null(spark):
    from sitelens.operators.assemble import to_long_metrics
    rows = _rows(40) + [summary_row(500, "https://n.sp.gov.br/", NOW)]
    long = to_long_metrics(summaries_df(spark, rows))
    dist = M.score_distribution(long).collect()
    per_metric = {}
    for r in dist:
        per_metric[r.metric] = per_metric.get(r.metric, 0) + r.n
    non_null = long.filter("performance IS NOT NULL").count()
    assert per_metric["performance"] == non_null


def test_performance_trend_improves(spark):
    rows = [summary_row(i, "https://t.sp.gov.br/", NOW - dt.timedelta(days=30 - i),
                        mobile_performance=0.5 + 0.015 * i) for i in range(30)]
    r = M.performance_trend(summaries_df(spark, rows)).first()
    assert r.improved and r.n_audits == 30 and r.last_performance > r.first_performance


def test_avg_scores_strategy_case_insensitive(spark):
    from sitelens.operators.assemble import to_long_metrics
    long = to_long_metrics(summaries_df(spark, _rows(20)))
    assert M.avg_scores(long, "MOBILE").first().strategy == "mobile"
    assert M.avg_scores(long).first().record_count == 40


def test_duplicate_keys(spark):
    from sitelens.operators.assemble import to_long_metrics
    s = summaries_df(spark, _rows(5))
    long = to_long_metrics(s)
    assert M.duplicate_keys(long).count() == 0
    assert M.duplicate_keys(long.unionByName(long.limit(3))).count() == 3


def test_audit_stats_and_batch_counts(spark):
    rows = [(i, f"u{i}", NOW - dt.timedelta(days=i % 2), "e" if i < 3 else None) for i in range(8)]
    a = audits_df(spark, rows)
    r = M.audit_stats(a).first()
    assert (r.total_audits, r.total_errors, r.success_pct) == (8, 3, 62.5)
    assert sorted((x.processed, x.errors) for x in M.batch_counts(a).collect()) == [(4, 1), (4, 2)]


def test_metrics_overview_exact_and_approximate(spark):
    from sitelens.operators.assemble import to_long_metrics
    long = to_long_metrics(summaries_df(spark, _rows(100)))
    exact = M.metrics_overview(long).first()
    approx = M.metrics_overview(long, approximate=True).first()
    assert exact.total_records == 200 and exact.unique_urls == 7
    assert approx.unique_urls == 7


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


def _assert_rows_close(r1, r2):
    assert r1.__fields__ == r2.__fields__
    for f in r1.__fields__:
        v1, v2 = r1[f], r2[f]
        assert (_close(v1, v2) if isinstance(v1, float) or isinstance(v2, float) else v1 == v2), f


@pytest.mark.parametrize("source", ["fixture", "driver"])
def test_partials_combine_to_direct_aggregates(spark, source):
    if source == "fixture":
        rows = _rows(100) + [summary_row(500, "https://n.rj.gov.br/", NOW, has_errors=None,
                                         mobile_performance=0.3)]
        s = summaries_df(spark, rows)
    else:
        from sitelens.sources import proxy as P
        s = P.summaries(spark, "/root/testdata/sf0.01")
    p = M.daily_partials(s)
    _assert_rows_close(M.aggregated_metrics_from_partials(p).first(),
                       M.aggregated_metrics(s).first())
    direct = M.metrics_by_state(s).collect()
    merged = M.metrics_by_state_from_partials(p).collect()
    assert [r.state for r in merged] == [r.state for r in direct]
    for a, b in zip(merged, direct):
        _assert_rows_close(a, b)


def test_partials_on_empty_input(spark):
    s = summaries_df(spark, [])
    r = M.aggregated_metrics_from_partials(M.daily_partials(s)).first()
    assert (r.total_audits, r.successful_audits, r.failed_audits, r.success_rate) == (0, 0, 0, 0.0)
    assert r.avg_mobile_performance is None and r.std_mobile_performance is None
    assert M.metrics_by_state_from_partials(M.daily_partials(s)).count() == 0
