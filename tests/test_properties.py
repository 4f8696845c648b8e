"""Property tests for the helpers the scale design rests on."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitelens.operators import metrics as M
from sitelens.operators import ranking as R
from sitelens.operators.sequence import number_rows
from tests.conftest import NOW, summaries_df, summary_row

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(
    st.tuples(st.integers(0, 6),            # site
              st.integers(0, 200),          # hours ago
              st.booleans(),                # error
              st.one_of(st.none(), st.integers(0, 100))),  # score * 100
    min_size=0, max_size=60)


def _summaries(spark, rows):
    return summaries_df(spark, [
        summary_row(i + 1, f"https://s{site}.{'sp' if site % 2 else 'rj'}.gov.br/",
                    NOW - dt.timedelta(hours=h), has_errors=err,
                    mobile_performance=None if sc is None else sc / 100,
                    mobile_accessibility=None if sc is None else (100 - sc) / 100,
                    desktop_performance=0.5)
        for i, (site, h, err, sc) in enumerate(rows)])


@SETTINGS
@given(keys=st.lists(st.integers(0, 5), min_size=0, max_size=80),
       start=st.integers(-3, 50))
def test_number_rows_is_a_consecutive_total_order(spark, keys, start):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    out = number_rows(df, [F.desc("k"), F.asc("i")], col="n", start=start).collect()
    expected = sorted(((k, i) for i, k in enumerate(keys)), key=lambda t: (-t[0], t[1]))
    got = sorted(((r.k, r.i, r.n) for r in out), key=lambda t: t[2])
    assert [(k, i) for k, i, _ in got] == expected
    assert [n for _, _, n in got] == list(range(start, start + len(keys)))


@SETTINGS
@given(rows=rows_st, cut=st.integers(0, 200))
def test_incremental_latest_equals_full(spark, rows, cut):
    s = _summaries(spark, rows)
    split = NOW - dt.timedelta(hours=cut)
    inc = R.update_latest(R.latest_per_site(s.filter(F.col("timestamp") < split)),
                          s.filter(F.col("timestamp") >= split))
    full = R.latest_per_site(s)
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


@SETTINGS
@given(rows=rows_st)
def test_partials_merge_equals_direct(spark, rows):
    s = _summaries(spark, rows)
    a = M.aggregated_metrics_from_partials(M.daily_partials(s)).first().asDict()
    b = M.aggregated_metrics(s).first().asDict()
    for k in b:
        x, y = a[k], b[k]
        if isinstance(y, float) or isinstance(x, float):
            assert (x is None and y is None) or abs(x - y) <= 1e-9, k
        else:
            assert x == y, k
    st_a = [(r.state, r.site_count) for r in M.metrics_by_state_from_partials(M.daily_partials(s)).collect()]
    st_b = [(r.state, r.site_count) for r in M.metrics_by_state(s).collect()]
    assert sorted(st_a) == sorted(st_b)
