"""Commands over stored tables: versions of the quarantine, published exports, metrics and stats."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import metrics as M
from sitelens.operators import ranking as R
from sitelens.plans import batch as B
from sitelens.session import child_names, run_concurrently
from sitelens.sinks import writers as W
from sitelens.sources import versions as V
from sitelens.sources.tables import read_table, register_tables
from tests.conftest import NOW, summaries_df, summary_row
from tests.test_assemble import ok_body


def stored(spark, base, sites=6, days=4):
    """Every odd site fails on all days."""
    rows = []
    for d in range(days):
        for i in range(sites):
            for s in ("mobile", "desktop"):
                bad = i % 2 and s == "mobile"
                rows.append((d * 100 + i, f"https://s{i}.sp.gov.br/", s, NOW - dt.timedelta(days=d), 503 if bad else 200,
                             "x", None, "{}" if bad else ok_body(perf=(i + d) / 20)))
    W.append_responses(spark.createDataFrame(rows, schemas.RAW_RESPONSES), base)


def quarantine(spark, base):
    return sorted((r.id, r.url, r.version, r.status) for r in read_table(spark, base, "quarantine").collect())


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "url string, status string, notes string")


U1, U3, U5 = (f"https://s{i}.sp.gov.br/" for i in (1, 3, 5))


def test_quarantine_commands(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    stored(spark, base)
    assert B.run_quarantine_update(spark, base, NOW).first().added == 3
    got = B.run_set_status(spark, base, changes(spark, (U1, "resolved", "ok"), ("https://none/", "resolved", None)), NOW)
    assert {r.url: r.found for r in got.collect()} == {U1: True, "https://none/": False}
    got = B.run_remove(spark, base, changes(spark, (U3, None, None), ("https://none/", None, None)), NOW)
    assert {r.url: r.found for r in got.collect()} == {U3: True, "https://none/": False}
    want = [(1, U1, 1, "quarantined"), (2, U3, 1, "quarantined"), (3, U5, 1, "quarantined"), (4, U1, 2, "resolved"), (5, U3, 2, "removed")]
    assert quarantine(spark, base) == want
    versions = child_names(spark, f"{base}/{V.QUARANTINE_LOG}")
    assert len(versions) == 3
    # nothing to change: no version; a wrong status: nothing written
    B.run_quarantine_update(spark, base, NOW)
    assert not B.run_remove(spark, base, changes(spark, ("https://none/", None, None)), NOW).first().found
    with pytest.raises(ValueError):
        B.run_set_status(spark, base, changes(spark, (U5, "gone", None)), NOW)
    assert child_names(spark, f"{base}/{V.QUARANTINE_LOG}") == versions and quarantine(spark, base) == want
    assert register_tables(spark, base)["quarantine_current"].count() == 3


def test_two_commands_started_together(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "t")
    stored(spark, base)
    B.run_quarantine_update(spark, base, NOW)
    both, real, calls = threading.Barrier(2, timeout=60), V.commit_next, []

    def together(spark, log, after, folder):
        calls.append(after)
        if len(calls) <= 2:        # both have read version 1 and written their rows
            both.wait()
        return real(spark, log, after, folder)

    monkeypatch.setattr(V, "commit_next", together)
    ch = [changes(spark, (U1, "resolved", "a"), (U3, "resolved", "a")), changes(spark, (U1, "wrong_url", "b"), (U5, "wrong_url", "b"))]
    run_concurrently([lambda c=c: B.run_set_status(spark, base, c, NOW) for c in ch])
    rows = quarantine(spark, base)
    assert sorted(calls) == [1, 1, 2]
    assert [r[0] for r in rows] == list(range(1, 8))                       # unique, consecutive ids
    assert sorted(r[2] for r in rows if r[1] == U1) == [1, 2, 3]           # consecutive versions
    assert {r[3] for r in rows if r[1] == U1 and r[2] > 1} == {"resolved", "wrong_url"}


def test_rows_of_another_writer_and_of_a_command_cut_short(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "t")
    old = [(7, U5, NOW, NOW, 3, "x", "quarantined", None, 4, NOW, NOW)]
    spark.createDataFrame(old, schemas.QUARANTINE).write.parquet(f"{base}/quarantine")
    with monkeypatch.context() as m:
        m.setattr(V, "commit_next", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            B.run_remove(spark, base, changes(spark, (U5, None, None)), NOW)
    assert quarantine(spark, base) == [(7, U5, 4, "quarantined")]
    B.run_remove(spark, base, changes(spark, (U5, None, None)), NOW)
    assert quarantine(spark, base) == [(7, U5, 4, "quarantined"), (8, U5, 5, "removed")]


def test_readers_see_whole_exports_only(spark, tmp_dir, monkeypatch):
    base, out = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "dash")
    stored(spark, base)
    assert V.published_folder(spark, out) is None
    first = B.run_dashboard_export(spark, base, out, NOW)
    seen = V.published_folder(spark, out)
    assert first["files"]["summary"].startswith(seen)
    with monkeypatch.context() as m:
        m.setattr(M, "quarantine_stats", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            B.run_dashboard_export(spark, base, out, NOW)
    assert V.published_folder(spark, out) == seen
    B.run_dashboard_export(spark, base, out, NOW)
    assert V.published_folder(spark, out) != seen and spark.read.json(f"{V.published_folder(spark, out)}/summary").count() == 1


def test_metrics_and_stats_commands(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    assert B.run_stats(spark, base)["stats"].first() == (0, 0, 0.0)
    stored(spark, base)
    rows = read_table(spark, base, "audit_summaries")
    assert B.run_metrics(spark, base, out_dir=f"{tmp_dir}/m", generated_at=NOW).first().asDict() == pytest.approx(M.aggregated_metrics(rows).first().asDict())
    assert spark.read.json(f"{tmp_dir}/m").first().total_audits == 24
    assert B.run_metrics(spark, base, by_state=True).collect() == M.metrics_by_state(rows).collect()
    assert B.run_metrics(spark, base, worst=3).collect() == R.worst_performing(rows, 3).collect()
    assert B.run_metrics(spark, base, best=3).collect() == R.best_accessibility(rows, 3).collect()
    s = B.run_stats(spark, base, 5)
    assert s["stats"].first() == M.audit_stats(rows).first()
    assert s["recent"].collect() == R.recent_audits(read_table(spark, base, "audits").drop("day"), 5).collect()


def test_summaries_export_writes_changed_days_only(spark, tmp_dir):
    out = os.path.join(tmp_dir, "days")

    def table(n, timeless=0):
        rows = [summary_row(i, f"https://s{i}/", NOW - dt.timedelta(days=i % 3 if i < 9 else 0)) for i in range(n)]
        df = summaries_df(spark, rows)
        late = df.limit(timeless).withColumns({"id": F.col("id") + 1000, "timestamp": F.lit(None).cast("timestamp_ntz")})
        return df.unionByName(late)

    def files():
        return {d: sorted(f for f in os.listdir(os.path.join(out, d)) if f.startswith("part-")) for d in os.listdir(out) if d.startswith("date=")}

    def ids():
        return sorted(r.id for r in spark.read.schema(schemas.AUDIT_SUMMARIES).parquet(out).collect())

    none = "date=__HIVE_DEFAULT_PARTITION__"
    steps = [(9, 0, None), (11, 0, {f"date={NOW.date()}"}), (11, 1, {none}), (11, 1, set()), (12, 2, {none, f"date={NOW.date()}"})]
    before = {}
    for n, timeless, changed in steps:
        W.export_summaries_parquet(table(n, timeless), out, incremental=True)
        after = files()
        assert changed is None or {d for d in after if after[d] != before.get(d)} == changed
        assert ids() == sorted(list(range(n)) + [1000 + i for i in range(timeless)])
        before = after
