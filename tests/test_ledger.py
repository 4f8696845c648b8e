"""Committed loads: both tables or neither, and maintained tables that cover exactly the committed loads."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import assemble as A
from sitelens.operators import metrics as M
from sitelens.operators import ranking as R
from sitelens.plans import batch as B
from sitelens.session import child_names, read_text, write_once
from sitelens.sinks import writers as W
from sitelens.sources import ledger as L
from sitelens.sources.tables import read_table
from tests.conftest import NOW
from tests.test_assemble import ok_body


def responses(spark, n, when=NOW, first=0, url="https://s{}.sp.gov.br/"):
    rows = [(first + i, url.format(i), s, when, 200, "OK", None, ok_body(perf=i / 100 % 1))
            for i in range(n) for s in A.STRATEGIES]
    return spark.createDataFrame(rows, schemas.RAW_RESPONSES)


def ids(spark, base, name="audit_summaries"):
    return sorted(r.id for r in read_table(spark, base, name).select("id").collect())


def same_as_full(spark, base):
    """The maintained tables against a scan of all history; returns the total of the partials."""
    rows = read_table(spark, base, "audit_summaries").select(*schemas.AUDIT_SUMMARIES.fieldNames())
    latest, partials, trends = B.maintained_tables(spark, base)
    assert sorted(M.performance_trend_from_state(trends).collect()) == sorted(M.performance_trend(rows).collect())
    exact = M.metrics_overview(A.to_long_metrics(rows)).first()
    near = M.metrics_overview_from_partials(partials).first()
    assert near[:2] == exact[:2] and abs(near.unique_urls - exact.unique_urls) <= 0.03 * exact.unique_urls
    full = R.latest_per_site(rows)
    assert latest.exceptAll(full).count() == 0 and full.exceptAll(latest).count() == 0
    a, b = M.aggregated_metrics_from_partials(partials).first(), M.aggregated_metrics(rows).first()
    assert a.asDict() == pytest.approx(b.asDict(), nan_ok=True, abs=1e-9)
    assert partials.groupBy("day", "state").count().where("count > 1").count() == 0
    return a.total_audits


def test_rows_without_time_are_covered_on_every_call(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    W.append_responses(responses(spark, 200), base)
    assert same_as_full(spark, base) == 200
    W.append_responses(responses(spark, 1, first=900).withColumn("fetched_at", F.lit(None).cast("timestamp_ntz")), base)
    versions = None
    for _ in range(4):
        assert same_as_full(spark, base) == 201
        names = child_names(spark, f"{base}/{B.MAINTAINED}")
        assert versions in (None, names)          # no new version without new loads
        versions = names
    # a second load without time, and one of a day that is there
    W.append_responses(responses(spark, 1, first=901).withColumn("fetched_at", F.lit(None).cast("timestamp_ntz")), base)
    W.append_responses(responses(spark, 3, first=950), base)
    assert same_as_full(spark, base) == 205
    days = {r.day: r.n for r in L.load_days(spark, base).groupBy("day").agg(F.sum("n").alias("n")).collect()}
    assert days == {None: 2, NOW.date(): 203}


def test_writer_killed_between_the_tables_shows_in_neither(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "t")
    real = W._write_days

    def dies(rows, path, load):
        if path.endswith("audit_summaries"):
            raise OSError("killed")
        real(rows, path, load)

    both = A.assemble_with_summaries(responses(spark, 3)).cache()
    # the very first load, then one after a committed load
    for name, before in (("load-a", []), ("load-b", [0, 1, 2])):
        monkeypatch.setattr(W, "_write_days", dies)
        with pytest.raises(OSError):
            W.write_assembled(both, base, name)
        monkeypatch.setattr(W, "_write_days", real)
        assert ids(spark, base) == ids(spark, base, "audits") == before
        assert same_as_full(spark, base) == len(before)
        W.write_assembled(both, base, name)       # the same load again
        W.write_assembled(both, base, name)       # and once more: nothing new
        assert ids(spark, base) == ids(spark, base, "audits") == sorted(before + [0, 1, 2])
        assert same_as_full(spark, base) == len(before) + 3


def test_maintained_version_cut_short_and_empty_load(spark, tmp_dir, monkeypatch):
    base = os.path.join(tmp_dir, "t")
    W.append_responses(responses(spark, 4), base)
    with monkeypatch.context() as m:
        m.setattr(B, "write_once", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            B.maintained_tables(spark, base)
    assert same_as_full(spark, base) == 4
    W.append_responses(responses(spark, 1).limit(0), base)
    assert same_as_full(spark, base) == 4
    W.append_responses(responses(spark, 2, NOW + dt.timedelta(days=1), 70), base)
    assert same_as_full(spark, base) == 6


def test_tables_of_another_writer_have_no_ledger(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    rows = A.summarize_audits(A.assemble_audits(responses(spark, 5)))
    rows.withColumn("day", F.to_date("timestamp")).write.partitionBy("day").parquet(f"{base}/audit_summaries")
    assert L.committed_loads(spark, base) is None and ids(spark, base) == list(range(5))
    assert same_as_full(spark, base) == 5 and child_names(spark, f"{base}/{B.MAINTAINED}") == []


def test_a_name_is_written_once(spark, tmp_dir):
    path = f"file://{tmp_dir}/x/one.json"
    assert write_once(spark, path, "é1") and not write_once(spark, path, "2")
    assert read_text(spark, path) == "é1" and child_names(spark, f"file://{tmp_dir}/x") == ["one.json"]


def test_a_load_is_computed_once_and_not_cached(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    # a value that differs each time it is computed
    both = A.assemble_with_summaries(responses(spark, 5)).withColumn("error_message", F.uuid())
    W.write_assembled(both, base, "load-a")
    audits, rows = (read_table(spark, base, name).select("id", "error_message") for name in ("audits", "audit_summaries"))
    assert rows.count() == 5 and audits.exceptAll(rows).isEmpty()
    assert not both.storageLevel.useMemory and not both.storageLevel.useDisk
