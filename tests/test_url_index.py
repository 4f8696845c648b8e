"""Look-ups by url and by pattern over stored history."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import filters as FL
from sitelens.session import child_names
from sitelens.sinks import writers as W
from sitelens.sources import url_index as U
from sitelens.sources.tables import read_table
from tests.conftest import NOW


def append(spark, base, urls, days, per_day=1):
    rows = spark.range(len(urls) * days * per_day).select(
        F.col("id"), F.element_at(F.array(*[F.lit(u) for u in urls]), (F.col("id") % len(urls) + 1).cast("int")).alias("url"),
        (F.lit(NOW).cast("timestamp_ntz") - F.make_interval(days=(F.col("id") % days).cast("int"))).alias("timestamp"),
        F.lit(None).cast("string").alias("error_message"))
    full = schemas.AUDITS.fieldNames()
    audits = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast(schemas.AUDITS[c].dataType).alias(c) for c in full])
    W.append_audits(audits, base)


def scanned(df):
    """Rows that the file scans of an executed plan put out."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            if name == "FileSourceScanExec":
                total += p.metrics().get("numOutputRows").get().value()
            children = p.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_one_url_reads_a_small_part_of_the_table(spark, tmp_dir):
    base = os.path.join(tmp_dir, "t")
    urls = [f"https://site{i:04d}.sp.gov.br/" for i in range(199)]          # 199: coprime to the days
    append(spark, base, urls, 4, 100)
    rows = read_table(spark, base, "audit_summaries")
    assert rows.count() == 79_600
    got = U.temporal_evolution_stored(spark, base, urls[7].rstrip("/"))
    assert got.count() == 400 and got.collect() == FL.temporal_evolution(rows, urls[7]).collect()
    assert scanned(U.temporal_evolution_stored(spark, base, urls[7])) < 0.1 * 79_600
    assert scanned(U.find_url_stored(spark, base, "site0007")) < 0.1 * 79_600
    assert U.temporal_evolution_stored(spark, base, "https://none/").count() == 0


PATTERNS = ["a1", "A1.gov", "a_.gov", "a%.gov", "%", "", "é", "gov.br/x", "none at all", "c\\d", "//a", "_", "0%"]


@pytest.mark.parametrize("most", [1_000, 0])
def test_patterns_equal_a_scan_over_loads(spark, tmp_dir, monkeypatch, most):
    monkeypatch.setattr(U, "MOST_VALUES", most)
    base = os.path.join(tmp_dir, "t")
    loads = [["https://a1.gov.br/x", "https://a22.gov.br/x", "x"], ["https://a1.gov.br/x"], ["https://É.gov.br/100%", "https://c\\d.gov.br/", "ab"]]
    assert U.find_url_stored(spark, base, "a1").count() == 0
    versions = []
    for urls in loads:
        append(spark, base, urls, 2, 2)
        rows = read_table(spark, base, "audit_summaries").drop("day")
        some = PATTERNS if urls is loads[-1] else PATTERNS[:3]
        for p in some:
            for ignore_case in (False, True):
                got, want = U.find_url_stored(spark, base, p, ignore_case), FL.find_url(rows, p, ignore_case)
                assert got.exceptAll(want).count() == 0 and got.count() == want.count(), (p, ignore_case)
        versions.append(len(child_names(spark, f"{base}/{U.FOLDER}")))
    assert versions == [1, 1, 2]            # the second load has no new url
