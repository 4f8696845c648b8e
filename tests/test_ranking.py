"""Latest-per-site, ranking, top-k and the distributed numbering."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitelens.operators import ranking as R
from sitelens.operators.sequence import number_rows
from tests.conftest import NOW, summaries_df, summary_row


def _fifty(spark):
    rows = [summary_row(i + 1, f"https://cidade{i}.sp.gov.br/", NOW,
                        mobile_accessibility=0.3 + (i / 50) * 0.6, mobile_performance=0.5)
            for i in range(50)]
    # older audits of the same sites must not win
    rows += [summary_row(100 + i, f"https://cidade{i}.sp.gov.br/", NOW - dt.timedelta(days=1),
                         mobile_accessibility=1.0) for i in range(50)]
    return summaries_df(spark, rows)


def test_ranking_unique_urls_descending_scores(spark):
    out = R.site_ranking(_fifty(spark)).orderBy("rank").collect()
    assert len(out) == 50 and len({r.url for r in out}) == 50
    assert [r.rank for r in out] == list(range(1, 51))
    scores = [r.score for r in out]
    assert scores == sorted(scores, reverse=True)
    assert out[0].name == "cidade49.sp" and out[0].state == "SP"


def test_latest_per_site_skips_errors_and_breaks_ties_by_id(spark):
    rows = [summary_row(1, "u", NOW, mobile_performance=0.1),
            summary_row(2, "u", NOW, mobile_performance=0.2),
            summary_row(3, "u", NOW + dt.timedelta(hours=1), has_errors=True),
            summary_row(4, "u", NOW + dt.timedelta(hours=2), has_errors=None)]
    r = R.latest_per_site(summaries_df(spark, rows)).collect()
    assert [x.id for x in r] == [2]


def test_number_rows_over_many_partitions(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 7).alias("g"), F.col("id").alias("k")).repartition(6)
    out = number_rows(df, [F.desc("g"), F.asc("k")], col="n", start=11)
    got = sorted((r.g, r.k, r.n) for r in out.collect())
    expected = sorted(((g, k) for g, k in ((i % 7, i) for i in range(5000))),
                      key=lambda t: (-t[0], t[1]))
    want = sorted((g, k, i + 11) for i, (g, k) in enumerate(expected))
    assert got == want


def test_number_rows_hot_value(spark):
    # one sort value holds a third of the rows: the distributed path still splits it
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("v"),
        F.col("id").alias("k"))
    out = number_rows(df, [F.asc("v"), F.asc("k")], col="n")
    ns = sorted(r.n for r in out.collect())
    assert ns == list(range(1, 3001))


def test_top_and_bottom_sites(spark):
    ranking = R.site_ranking(_fifty(spark))
    top = R.top_sites(ranking, 5).collect()
    assert [r.rank for r in top] == [1, 2, 3, 4, 5]
    bottom = R.bottom_sites(ranking, 3).collect()
    assert [r.rank for r in bottom] == [50, 49, 48]


def test_top_sites_from_latest_is_the_head_of_the_ranking(spark):
    scores = [0.9, None, 0.4, 0.9, 0.0, None, 0.7]
    s = summaries_df(spark, [summary_row(i, f"https://s{9 - i}.sp.gov.br/", NOW, mobile_accessibility=x)
                             for i, x in enumerate(scores)])
    ranking = R.site_ranking(s)
    for n in (3, 6, 50):
        want = {tuple(r) for r in R.top_sites(ranking, n).collect()}
        got = R.top_sites_from_latest(R.latest_per_site(s), n)
        assert {tuple(r) for r in got.select(*ranking.columns).collect()} == want
    assert R.top_sites_from_latest(s.limit(0), 5).count() == 0


def test_worst_and_best_lists(spark):
    rows = [summary_row(i, f"u{i}", NOW, mobile_performance=i / 10, mobile_accessibility=i / 10)
            for i in range(1, 8)]
    rows.append(summary_row(99, "err", NOW, has_errors=True, mobile_performance=0.0))
    rows.append(summary_row(98, "nul", NOW))
    s = summaries_df(spark, rows)
    assert [r.url for r in R.worst_performing(s, 3).collect()] == ["u1", "u2", "u3"]
    assert [r.url for r in R.best_accessibility(s, 2).collect()] == ["u7", "u6"]


def test_list_worst_validates_arguments(spark):
    with pytest.raises(ValueError):
        R.list_worst(spark.range(1), "speed", 3)
    with pytest.raises(ValueError):
        R.list_worst(spark.range(1), "performance", 0)


def test_sort_metrics_nulls_last(spark):
    from sitelens.operators.assemble import to_long_metrics
    rows = [summary_row(1, "a", NOW, mobile_performance=None, desktop_performance=0.2),
            summary_row(2, "b", NOW, mobile_performance=0.9, desktop_performance=0.1)]
    long = to_long_metrics(summaries_df(spark, rows))
    vals = [r.performance for r in R.sort_metrics(long, "performance", True).collect()]
    assert vals == [0.1, 0.2, 0.9, None]


def test_temporal_evolution_accepts_both_url_forms(spark):
    from sitelens.operators import filters as FL
    rows = [summary_row(i, "https://t.sp.gov.br/" if i % 2 else "https://t.sp.gov.br",
                        NOW - dt.timedelta(days=30 - i), mobile_performance=0.5 + 0.015 * i)
            for i in range(30)]
    rows.append(summary_row(99, "https://t.sp.gov.br/", NOW, has_errors=True))
    ev = FL.temporal_evolution(summaries_df(spark, rows), "https://t.sp.gov.br").collect()
    assert len(ev) == 30 and ev[-1].mobile_performance > ev[0].mobile_performance


def test_search_sites_filters(spark):
    from sitelens.operators import filters as FL
    ranking = R.site_ranking(_fifty(spark))
    assert FL.search_sites(ranking, term="  CIDADE4 ", state="SP").count() == 11
    assert FL.search_sites(ranking, state="RJ").count() == 0
    assert FL.search_sites(ranking).count() == 50
    assert FL.search_sites(ranking, population="big").count() == 0
    with_pop = ranking.withColumn("population", F.when(F.col("rank") <= 5, "big").otherwise("small"))
    assert FL.search_sites(with_pop, population="big").count() == 5


def test_find_url_case_flag(spark):
    from sitelens.operators import filters as FL
    from sitelens.operators.assemble import to_long_metrics
    long = to_long_metrics(summaries_df(spark, [summary_row(1, "https://Cidade.sp.gov.br/", NOW)]))
    assert FL.find_url(long, "cidade").count() == 0
    assert FL.find_url(long, "cidade", ignore_case=True).count() == 2


def test_find_url_wildcards(spark):
    from sitelens.operators import filters as FL
    urls = ["https://a1.gov.br/x", "https://a22.gov.br/x", "https://b.gov.br/100%", "https://c\\d.gov.br/"]
    long = spark.createDataFrame([(u, NOW) for u in urls] + [(None, NOW)], "url string, timestamp timestamp_ntz")
    found = lambda p, **kw: sorted(urls.index(r.url) for r in FL.find_url(long, p, **kw).collect())
    assert found("a_.gov") == [0] and found("a%.gov") == [0, 1] and found("A__.GOV", ignore_case=True) == [1]
    assert found("c\\d") == [3] and found("") == [0, 1, 2, 3] and found("0%") == [2]
    p = FL.find_url(long, "gov")._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(url" in p and " LIKE " not in p


def test_ranking_null_and_zero_scores(spark):
    # D3: a NULL mobile score is 0.0 and ranks last; D4: desktop NULL stays NULL, 0.0 stays 0.0
    rows = [summary_row(1, "https://a.sp.gov.br/", NOW, mobile_accessibility=None,
                        desktop_accessibility=0.0, desktop_performance=None),
            summary_row(2, "https://b.sp.gov.br/", NOW, mobile_accessibility=0.0,
                        desktop_accessibility=None, desktop_performance=0.5),
            summary_row(3, "https://c.sp.gov.br/", NOW, mobile_accessibility=0.9)]
    out = {r.url: r for r in R.site_ranking(summaries_df(spark, rows)).collect()}
    a, b, c = out["https://a.sp.gov.br/"], out["https://b.sp.gov.br/"], out["https://c.sp.gov.br/"]
    assert (c.rank, b.rank, a.rank) == (1, 2, 3)
    assert a.score == 0.0 and a.performance == 0.0
    assert a.desktop_accessibility == 0.0 and a.desktop_performance is None
    assert b.desktop_accessibility is None and b.desktop_performance == 50.0


def test_operators_on_empty_input(spark):
    from sitelens import schemas
    from sitelens.operators import assemble as A
    from sitelens.operators import filters as FL
    from sitelens.operators import metrics as M
    from sitelens.operators import quarantine as Q
    s = summaries_df(spark, [])
    a = s.select("id", "url", "timestamp", "error_message",
                 F.lit(0).cast("long").alias("retry_count"), "created_at")
    long = A.to_long_metrics(s)
    q = schemas.empty_frame(spark, schemas.QUARANTINE)
    raw = schemas.empty_frame(spark, schemas.RAW_RESPONSES)
    empties = [
        R.latest_per_site(s), R.site_ranking(s), R.worst_performing(s), R.best_accessibility(s),
        R.recent_audits(a), R.latest_audits(s), R.latest_per_site_strategy(long),
        R.list_worst(long, "seo", 5), R.sort_metrics(long, "url"),
        M.metrics_by_state(s), M.failing_urls(a, NOW), M.performance_trend(s),
        M.score_distribution(long), M.duplicate_keys(long), M.batch_counts(a),
        FL.recently_audited_urls(a, NOW), FL.find_url(long, "x"), FL.filter_metrics(long, "x"),
        FL.temporal_evolution(s, "https://x"), FL.list_quarantined(Q.quarantine_current(q)),
        Q.update_quarantine(a, q, NOW), A.assemble_audits(raw),
        A.summarize_audits(A.assemble_audits(raw)),
    ]
    for df in empties:
        assert df.count() == 0
    ones = [M.aggregated_metrics(s), M.audit_stats(a), M.quarantine_stats(q),
            M.metrics_overview(long), M.avg_scores(long)]
    for df in ones:
        assert df.count() == 1
    assert tuple(M.audit_stats(a).first()) == (0, 0, 0.0)


def test_incremental_latest_equals_full_history(spark):
    rows = [summary_row(i, f"https://s{i % 9}.sp.gov.br/", NOW - dt.timedelta(hours=i),
                        has_errors=(i % 7 == 0), mobile_accessibility=(i % 10) / 10)
            for i in range(1, 120)]
    s = summaries_df(spark, rows)
    older = s.filter(F.col("timestamp") < NOW - dt.timedelta(hours=60))
    newer = s.filter(F.col("timestamp") >= NOW - dt.timedelta(hours=60))
    step1 = R.update_latest(R.latest_per_site(older), newer.filter(F.col("id") % 2 == 0))
    step2 = R.update_latest(step1, newer.filter(F.col("id") % 2 == 1))
    full = R.latest_per_site(s)
    assert step2.exceptAll(full).count() == 0 and full.exceptAll(step2).count() == 0
    a = R.site_ranking(s).collect()
    b = R.site_ranking_from_latest(step2).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


@pytest.mark.parametrize("n", [1, 5, 12, 40])
def test_latest_audits_with_day_cutoff_is_exact(spark, n):
    from sitelens.operators import metrics as M
    rows = [summary_row(i, f"https://s{i % 4}.sp.gov.br/", NOW - dt.timedelta(hours=7 * i),
                        has_errors=(i % 5 == 0), mobile_performance=0.5) for i in range(30)]
    s = summaries_df(spark, rows).withColumn("day", F.to_date("timestamp"))
    counts = M.daily_partials(s).select("day", F.col("n_all").alias("n"))
    plain = R.latest_audits(s, n).collect()
    cut = R.latest_audits(s, n, day_counts=counts).collect()
    assert cut == plain and len(plain) == min(n, 30)
    assert R.recent_audits(s, n, day_counts=counts).collect() == R.recent_audits(s, n).collect()
    if n <= 5:  # few rows needed: only the newest day(s) survive the cut-off
        assert R.newest_days(s, counts, n).count() < 30


def test_bottom_sites_ranks_without_ranking_all(spark):
    scores = [None, 0.0, 0.1234, 0.12341, 0.1234, 0.5, None, 0.9, 0.0, 0.5]
    rows = [summary_row(i, f"https://s{i}.sp.gov.br/", NOW, mobile_accessibility=s) for i, s in enumerate(scores)]
    latest = R.latest_per_site(summaries_df(spark, rows))
    ranking = R.site_ranking_from_latest(latest)
    for n in (1, 3, 6, 10, 50):
        assert R.bottom_sites_from_latest(latest, n).collect() == R.bottom_sites(ranking, n).collect()
    p = R.bottom_sites_from_latest(latest, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in p.split("WindowGroupLimit")[-1].split("Scan")[-1] and "SortMergeJoin" not in p
    empty = R.bottom_sites_from_latest(latest.limit(0), 3)
    assert empty.columns == ranking.columns and empty.collect() == []
