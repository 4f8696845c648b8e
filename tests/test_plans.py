"""Plan shapes the scale design relies on, checked on the formatted physical plans."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from sitelens.operators import metrics as M
from sitelens.operators import ranking as R
from sitelens.plans.registry import all_reports
from tests.conftest import NOW, summaries_df, summary_row

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def reports():
    return {name: plan for name, (plan, _) in all_reports().items()}


def test_by_state_pushes_filter_prunes_columns_and_aggregates_partially(spark, reports):
    p = plan(reports["metrics_by_state"](spark, SF))
    assert "PushedFilters: [IsNotNull(has_errors)" in p and "Not(EqualTo(has_errors,true))" in p
    assert "ReadSchema: struct<url:string,mobile_performance:double,mobile_accessibility:double," \
           "has_errors:boolean>" in p
    assert "partial_avg" in p and "partial_count" in p


def test_time_windows_prune_day_partitions(spark, reports):
    for name in ("failing_urls", "recently_audited"):
        p = plan(reports[name](spark, SF))
        part = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters:")]
        assert part and ">= 2024-" in part[0] and "<= 2024-" in part[0], (name, part)


def test_latest_per_site_limits_before_the_shuffle(spark, reports):
    p = plan(reports["latest_per_site"](spark, SF))
    head, _, tail = p.partition("Exchange")
    assert "WindowGroupLimit" in tail  # below the exchange: per-task limit
    assert "WindowGroupLimit" in head  # above it: final limit


def test_top_k_is_take_ordered(spark, reports):
    for name in ("worst_performing", "best_accessibility", "list_worst", "latest_audits"):
        assert "TakeOrderedAndProject" in plan(reports[name](spark, SF)), name


def test_bodies_are_dealt_out_before_they_are_sorted(spark, reports):
    for name in ("assemble_audits", "summarize_audits"):
        p = plan(reports[name](spark, SF))
        tree = p[:p.index("\n\n")].splitlines()
        names = [ln.split("- ")[-1].split(" (")[0].lstrip("* ") for ln in tree if "- " in ln]
        assert names.count("Exchange") == 1 and names.count("Sort") <= 1, (name, names)
        assert "Sort" not in names[names.index("Exchange"):], (name, names)


def test_top_sites_and_states_number_nothing(spark, reports):
    p = plan(reports["top_sites"](spark, SF))
    assert "TakeOrderedAndProject" in p and "ExistingRDD" not in p
    p = plan(reports["available_states"](spark, SF))
    assert "Window" not in p and "ExistingRDD" not in p


@pytest.mark.parametrize("name", sorted(all_reports()))
def test_no_cartesian_no_python_in_any_report(spark, reports, name):
    p = plan(reports[name](spark, SF))
    for bad in FORBIDDEN:
        assert bad not in p, (name, bad)


def test_hot_url_with_a_third_of_rows(spark):
    # one url holds a third of all audits: results stay whole and exact
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        url = "https://hot.sp.gov.br/" if hot else f"https://s{i}.rj.gov.br/"
        rows.append(summary_row(i + 1, url, NOW - dt.timedelta(minutes=i),
                                mobile_performance=(i % 100) / 100, mobile_accessibility=0.5))
    s = summaries_df(spark, rows).repartition(8)
    latest = {r.url: r.id for r in R.latest_per_site(s).collect()}
    assert latest["https://hot.sp.gov.br/"] == 1 and len(latest) == 401
    by_state = {r.state: r.site_count for r in M.metrics_by_state(s).collect()}
    assert by_state == {"SP": 200, "RJ": 400}
    trend = M.performance_trend(s.filter(F.col("url") == "https://hot.sp.gov.br/")).first()
    assert trend.n_audits == 200


def test_each_body_is_parsed_once(spark):
    from sitelens import schemas
    from sitelens.operators import assemble as A
    raw = schemas.empty_frame(spark, schemas.RAW_RESPONSES)
    audits = schemas.empty_frame(spark, schemas.AUDITS)
    # a real relation, so nothing is folded away
    raw, audits = (spark.createDataFrame(x.rdd, x.schema) for x in (raw, audits))
    for frame, parses in ((A.assemble_audits(raw), 1), (A.assemble_with_summaries(raw), 1),
                          (A.validate_responses(raw), 1), (A.summarize_audits(audits), 2)):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert text.count("from_json(") == parses, text
