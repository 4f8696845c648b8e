"""Sources, sinks, SQL and streaming."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import assemble as A
from sitelens.operators import quality as QL
from sitelens.plans.sql import run_sql
from sitelens.sinks import writers as W
from sitelens.sources import files as S
from sitelens.sources.tables import read_table, register_tables
from sitelens.sources.versions import published_folder
from sitelens.streaming import ingest as ST
from tests.conftest import NOW, summaries_df, summary_row
from tests.test_assemble import ok_body


def test_site_list_real_header(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sites.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('"Nome do Município","UF","Código IBGE","Endereço Eletrônico","Observação"\n')
        f.write('"Cidade A","SP","1","https://www.a.sp.gov.br",""\n')
        f.write('"Cidade B","RJ","2","  https://b.rj.gov.br/  ",""\n')
        f.write('"Cidade C","MG","3","https://nao-existe.mg.gov.br",""\n')
        f.write('"Cidade D","BA","4","not_a_url",""\n')
        f.write('"Cidade E","RS","5","",""\n')
    urls = [r.url for r in S.read_site_list(spark, path, "Endereço Eletrônico")
            .orderBy("position").collect()]
    assert urls == ["https://www.a.sp.gov.br", "https://b.rj.gov.br/", "https://nao-existe.mg.gov.br"]
    assert S.read_site_list(spark, path, "url").count() == 0


def test_metrics_json_array(spark, tmp_dir):
    path = os.path.join(tmp_dir, "psi.json")
    with open(path, "w") as f:
        json.dump([{"url": "https://a/", "performance": 0.5, "accessibility": 0.9, "seo": 1,
                    "bestPractices": 0.7, "timestamp": "2024-05-01T10:00:00.000Z"},
                   {"url": "https://b/", "performance": None, "accessibility": 0.8, "seo": 0.9,
                    "bestPractices": 0.6, "timestamp": "2024-05-01T11:00:00Z"}], f, indent=2)
    rows = S.read_metrics_json(spark, path).orderBy("url").collect()
    assert [r.timestamp for r in rows] == [dt.datetime(2024, 5, 1, 10), dt.datetime(2024, 5, 1, 11)]
    assert rows[0].seo == 1.0 and rows[1].performance is None


def test_quarantine_csv_empty_has_no_header(spark, tmp_dir):
    out = W.export_quarantine_csv(schemas.empty_frame(spark, schemas.QUARANTINE),
                                  os.path.join(tmp_dir, "q"))
    text = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out)
                   if f.startswith("part-"))
    assert text == ""


def test_audits_parquet_per_day_and_latest_json(spark, tmp_dir):
    rows = [summary_row(i, f"https://s{i}/", NOW - dt.timedelta(days=i % 3),
                        mobile_performance=0.5) for i in range(9)]
    s = summaries_df(spark, rows)
    audits = s.select("id", "url", "timestamp", "error_message",
                      F.lit(0).cast("long").alias("retry_count"), "created_at")
    out = W.export_audits_parquet(audits, os.path.join(tmp_dir, "a"))
    assert sorted(d for d in os.listdir(out) if d.startswith("date=")) == \
        [f"date={(NOW - dt.timedelta(days=k)).date()}" for k in (2, 1, 0)]
    doc_path = W.export_latest_json(s, os.path.join(tmp_dir, "l"), NOW, n=4)
    text = "".join(open(os.path.join(doc_path, f)).read() for f in os.listdir(doc_path)
                   if f.startswith("part-"))
    doc = json.loads(text)
    assert doc["total_sites"] == 4 and doc["last_updated"] == NOW.isoformat()
    ts = [a["timestamp"] for a in doc["audits"]]
    assert ts == sorted(ts, reverse=True)


def test_incremental_audits_export_writes_changed_days_only(spark, tmp_dir):
    def audits(n):
        rows = [summary_row(i, f"https://s{i}/", NOW - dt.timedelta(days=i % 3 if i < 9 else 0)) for i in range(n)]
        return summaries_df(spark, rows).withColumn("retry_count", F.lit(0).cast("long"))

    out = os.path.join(tmp_dir, "days")

    def files():
        return {d: sorted(f for f in os.listdir(os.path.join(out, d)) if f.startswith("part-"))
                for d in os.listdir(out) if d.startswith("date=")}

    def urls():
        return sorted(r.url for r in spark.read.parquet(out).select("url").collect())

    W.export_audits_parquet(audits(9), out, incremental=True)
    before = files()
    W.export_audits_parquet(audits(11), out, incremental=True)
    after, today = files(), f"date={NOW.date()}"
    assert {d for d in after if after[d] != before[d]} == {today}
    assert urls() == sorted(f"https://s{i}/" for i in range(11))
    W.export_audits_parquet(audits(11), out, incremental=True)
    assert files() == after
    # days that are gone: everything is written anew
    W.export_audits_parquet(audits(1), out, incremental=True)
    assert urls() == ["https://s0/"] and set(files()) == {today}


def test_append_audits_and_register_tables_and_sql(spark, tmp_dir):
    rows = [(1, "https://a/", "mobile", NOW, 200, "OK", None, ok_body()),
            (1, "https://a/", "desktop", NOW, 200, "OK", None, ok_body())]
    raw = spark.createDataFrame(rows, schemas.RAW_RESPONSES)
    base = os.path.join(tmp_dir, "tables")
    W.append_audits(A.assemble_audits(raw), base)
    W.append_audits(A.assemble_audits(raw.withColumn("run_id", F.lit(2).cast("long"))), base)
    register_tables(spark, base=base)
    out = run_sql(spark, "SELECT count(*) AS n FROM audit_summaries WHERE url = :u AND "
                  "`timestamp` <= :t AND mobile_seo > ?".replace("?", ":s"),
                  {"u": "https://a/", "t": NOW, "s": 0.5}).first()
    assert out.n == 2
    assert run_sql(spark, "SELECT count(*) AS n FROM quarantine_current").first().n == 0


def test_stream_equals_batch(spark, tmp_dir):
    rows = []
    for i in range(12):
        for s in ("mobile", "desktop"):
            bad = (i % 4 == 0) and s == "mobile"
            rows.append((i, f"https://s{i}/", s, NOW + dt.timedelta(minutes=i),
                         500 if bad else 200, "x", None, "{}" if bad else ok_body(perf=i / 20)))
    raw = spark.createDataFrame(rows, schemas.RAW_RESPONSES)
    src = os.path.join(tmp_dir, "in")
    raw.repartition(4, "run_id").write.parquet(src)
    out = os.path.join(tmp_dir, "out")
    q = ST.ingest_stream(spark, src, out, os.path.join(tmp_dir, "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    streamed = ST.read_ingested(spark, out)
    batch = A.summarize_audits(A.assemble_audits(raw))
    assert streamed.count() == 12
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_quality_checks(spark):
    rows = [summary_row(1, "https://a/", NOW), summary_row(2, "https://b/", NOW)]
    s = summaries_df(spark, rows)
    assert tuple(QL.null_counts(s).first()) == (0, 0, 2)
    res = {r.column_name: r for r in QL.schema_check(s, schemas.AUDIT_SUMMARIES).collect()}
    assert all(r.ok for r in res.values())
    bad = QL.schema_check(s.withColumn("id", F.col("id").cast("int")), schemas.AUDIT_SUMMARIES)
    assert [r.column_name for r in bad.filter("NOT ok").collect()] == ["id"]


def _lines(path):
    return [json.loads(x) for f in sorted(os.listdir(path)) if f.startswith("part-")
            for x in open(os.path.join(path, f)) if x.strip()]


def test_dashboard_from_empty_tables(spark, tmp_dir):
    res = W.export_dashboard(summaries_df(spark, []), schemas.empty_frame(spark, schemas.QUARANTINE),
                             os.path.join(tmp_dir, "dash"), NOW)
    assert res["total_sites"] == 0 and res["generated_at"] == NOW.isoformat()
    assert sorted(res["files"]) == ["by-state", "quarantine/sites", "quarantine/stats", "ranking",
                                    "summary", "top50", "worst50"]
    summary = _lines(res["files"]["summary"])
    assert len(summary) == 1 and summary[0]["total_audits"] == 0
    assert "avg_mobile_performance" not in summary[0]  # NULL mean
    stats = _lines(res["files"]["quarantine/stats"])[0]
    assert stats["total"] == 0 and stats["avg_failures"] == 0.0
    assert _lines(res["files"]["ranking"]) == []


def test_metrics_export_csv_and_json(spark, tmp_dir):
    from sitelens.operators.assemble import to_long_metrics
    rows = [summary_row(1, "https://a/", NOW, mobile_performance=0.5)]
    long = to_long_metrics(summaries_df(spark, rows))
    paths = W.export_metrics(long, os.path.join(tmp_dir, "m"))
    csv_text = "".join(open(os.path.join(paths["csv"], f)).read()
                       for f in sorted(os.listdir(paths["csv"])) if f.startswith("part-"))
    assert "url,performance,accessibility,seo,bestPractices,timestamp,ibge_code" in csv_text
    assert "https://a/,0.5,,,," in csv_text
    back = S.read_metrics_json(spark, paths["json"], multi_line=False).collect()
    assert sorted(r.performance for r in back if r.performance is not None) == [0.5]


def test_sql_positional_parameters(spark):
    df = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS s")
    out = run_sql(spark, "SELECT count(*) AS n FROM t_pos WHERE id >= ? AND s <> ?",
                  [3, "5"], tables={"t_pos": df}).first()
    assert out.n == 6


def test_daily_batch_run(spark, tmp_dir):
    from sitelens.plans.batch import run_batch
    sites_csv = os.path.join(tmp_dir, "sites.csv")
    with open(sites_csv, "w") as f:
        f.write("url,name\nhttps://a.sp.gov.br,A\nhttps://b.sp.gov.br/,B\nhttps://c.sp.gov.br,C\n"
                "not_a_url,D\n")
    base = os.path.join(tmp_dir, "tables")

    def responses(run0, when, urls, failing=()):
        rows = []
        for i, u in enumerate(urls):
            for s in ("mobile", "desktop"):
                bad = u in failing and s == "mobile"
                rows.append((run0 + i, u, s, when, 500 if bad else 200, "x", None,
                             "{}" if bad else ok_body()))
        return spark.createDataFrame(rows, schemas.RAW_RESPONSES)

    day1 = NOW - dt.timedelta(days=1)
    urls = ["https://a.sp.gov.br/", "https://b.sp.gov.br/", "https://c.sp.gov.br/"]
    r1 = run_batch(spark, base, sites_csv, responses(1, day1, urls, {"https://c.sp.gov.br/"}),
                   day1, out_dir=os.path.join(tmp_dir, "out1")).first()
    assert (r1.processed, r1.errors) == (3, 1)
    # next run an hour later: a and b succeeded recently and are skipped, c is retried
    r2 = run_batch(spark, base, sites_csv, responses(10, day1 + dt.timedelta(hours=1), urls),
                   day1 + dt.timedelta(hours=1)).first()
    assert (r2.processed, r2.errors) == (1, 0)
    assert spark.read.parquet(os.path.join(tmp_dir, "out1", "audit_summaries")).count() == 3
    # the maintained latest table equals W1 over everything appended
    from sitelens.operators.ranking import latest_per_site
    from sitelens.plans.batch import read_latest
    from sitelens.sources.tables import read_table
    full = latest_per_site(read_table(spark, base, "audit_summaries")
                           .select(*schemas.AUDIT_SUMMARIES.fieldNames()))
    kept = read_latest(spark, base)
    assert kept.count() == 3 and kept.exceptAll(full).count() == 0
    # the maintained per-day partials give the same summary as the full scan
    from sitelens.operators import metrics as M
    from sitelens.plans.batch import read_partials
    all_s = read_table(spark, base, "audit_summaries").select(*schemas.AUDIT_SUMMARIES.fieldNames())
    a = M.aggregated_metrics_from_partials(read_partials(spark, base)).first()
    b = M.aggregated_metrics(all_s).first()
    assert (a.total_audits, a.failed_audits) == (b.total_audits, b.failed_audits) == (4, 1)
    assert abs(a.avg_mobile_performance - b.avg_mobile_performance) < 1e-12
    assert [r.state for r in M.metrics_by_state_from_partials(read_partials(spark, base)).collect()] \
        == [r.state for r in M.metrics_by_state(all_s).collect()]
    # a later day: only that day's partials are written, the earlier day stays
    day3 = day1 + dt.timedelta(days=2)
    r3 = run_batch(spark, base, sites_csv, responses(20, day3, urls), day3).first()
    assert (r3.processed, r3.errors) == (3, 0)
    p = read_partials(spark, base)
    assert sorted(r.day for r in p.select("day").distinct().collect()) == [day1.date(), day3.date()]
    assert M.aggregated_metrics_from_partials(p).first().total_audits == 7
    assert read_latest(spark, base).count() == 3


def test_quarantine_update_and_dashboard_commands(spark, tmp_dir):
    from sitelens.plans.batch import run_dashboard_export, run_quarantine_update
    base = os.path.join(tmp_dir, "tables")
    rows = []
    for d in range(5):
        for s in ("mobile", "desktop"):
            bad = s == "mobile"
            rows.append((d, "https://down.sp.gov.br/", s, NOW - dt.timedelta(days=d),
                         503 if bad else 200, "x", None, "{}" if bad else ok_body()))
            rows.append((100 + d, "https://up.sp.gov.br/", s, NOW - dt.timedelta(days=d), 200,
                         "OK", None, ok_body()))
    W.append_responses(spark.createDataFrame(rows, schemas.RAW_RESPONSES), base)
    s1 = run_quarantine_update(spark, base, NOW).first()
    assert (s1.added, s1.updated, s1.total_checked) == (1, 0, 1)
    s2 = run_quarantine_update(spark, base, NOW).first()
    assert (s2.added, s2.updated, s2.total_checked) == (0, 0, 1)
    q = read_table(spark, base, "quarantine")
    assert [(r.url, r.version, r.consecutive_failures) for r in q.collect()] == \
        [("https://down.sp.gov.br/", 1, 5)]
    res = run_dashboard_export(spark, base, os.path.join(tmp_dir, "dash"), NOW)
    assert res["total_sites"] == 1
    assert len(_lines(res["files"]["quarantine/sites"])) == 1


def _pair(run, url, when, **kw):
    return [(run, url, s, when, 200, "OK", None, ok_body(**kw)) for s in ("mobile", "desktop")]


def test_site_list_dialect(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sites.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('url,note\n"https://a/","said ""x"", twice"\nhttps://b/,"two\nhttps://not-a-row/,lines"\n'
                '\thttps://c/\u00a0,tab\n,empty\n')
    assert [r.url for r in S.read_site_list(spark, path).orderBy("position").collect()] == \
        ["https://a/", "https://b/", "https://c/"]


def test_stream_pairs_over_files_and_fresh_checkpoints(spark, tmp_dir):
    out, src = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "in")
    rows = _pair(1, "https://a/", NOW) + _pair(2, "https://b/", NOW)[:1]
    for r in rows:
        spark.createDataFrame([r], schemas.RAW_RESPONSES).coalesce(1).write.mode("append").parquet(src)
    ck = os.path.join(tmp_dir, "ck1")
    q = ST.ingest_stream(spark, src, out, ck, max_files_per_trigger=1)
    q.awaitTermination()
    got = ST.read_ingested(spark, out).collect()
    assert [(r.id, r.has_errors) for r in got] == [(1, False)]
    src2 = os.path.join(tmp_dir, "in2")
    spark.createDataFrame(_pair(3, "https://c/", NOW), schemas.RAW_RESPONSES).write.parquet(src2)
    ST.ingest_stream(spark, src2, out, os.path.join(tmp_dir, "ck2")).awaitTermination()
    assert sorted(r.id for r in ST.read_ingested(spark, out).collect()) == [1, 3]
    assert [(r.run_id, r.strategy, r.fetched_at) for r in ST.pending_responses(spark, out, ck).collect()] == [(2, "mobile", NOW)]
    for _ in range(2):
        ST.flush_pending(spark, out, ck)
        rest = {r.id: r.error_message for r in ST.read_ingested(spark, out).collect()}
        assert rest == {1: None, 3: None, 2: "Request error: missing desktop response"}
    with pytest.raises(ValueError):
        ST.ingest_stream(spark, src, out, ck)


def _drop_file(spark, rows, src):
    spark.createDataFrame(rows, schemas.RAW_RESPONSES).coalesce(1).write.mode("append").parquet(src)


def test_stream_reports_late_responses_and_ends_lone_ones(spark, tmp_dir):
    out, src, ck = (os.path.join(tmp_dir, x) for x in ("out", "in", "ck"))

    def run(rows):
        """Rows of state that the micro-batch of ``rows`` wrote."""
        _drop_file(spark, rows, src)
        q = ST.ingest_stream(spark, src, out, ck, max_wait_seconds=1)
        q.awaitTermination()
        return sum(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"])

    def errors():
        return {r.id: r.error_message for r in ST.read_ingested(spark, out).collect()}

    missing = "Request error: missing desktop response"
    a, b = _pair(1, "https://a/", NOW), _pair(2, "https://b/", NOW)
    many = [r for i in range(10, 60) for r in _pair(i, f"https://s{i}/", NOW)[:1]]
    # 50 runs and b wait; a is there; a response of neither strategy waits, too
    odd = [(3, "https://o/", "tablet", NOW, 200, "OK", None, ok_body())]
    assert run(a + b[:1] + many + odd) == 54
    assert errors() == {1: None}
    assert ST.pending_responses(spark, out, ck).count() == 52
    time.sleep(1.5)
    run(_pair(98, "https://n/", NOW))       # moves the clock
    time.sleep(1.5)
    assert run(_pair(99, "https://n/", NOW)) == 2
    assert errors() == {1: None, 2: missing, 3: "Request error: missing mobile response", 98: None, 99: None} | {i: missing for i in range(10, 60)}
    # a partner that comes after its run ended is late when its own wait is over
    run(b[1:])
    for i in (100, 101):
        time.sleep(1.5)
        run(_pair(i, "https://n/", NOW))
    assert [(r.run_id, r.strategy) for r in ST.late_responses(spark, out).collect()] == [(2, "desktop")]
    assert errors()[2] == missing and len(errors()) == ST.read_ingested(spark, out).count() == 57
    assert ST.pending_responses(spark, out, ck).count() == 0


def test_stream_reports_a_late_response_while_its_partner_is_in_the_state(spark, tmp_dir):
    out, src, ck = (os.path.join(tmp_dir, x) for x in ("out", "in", "ck"))
    many = [r for i in range(10, 60) for r in _pair(i, f"https://s{i}/", NOW)[:1]]
    late = [(1, "https://a/", "mobile", NOW + dt.timedelta(hours=1), 500, "x", None, "{}")]
    written = []
    for rows in (_pair(1, "https://a/", NOW) + many, late, many[:3]):
        _drop_file(spark, rows, src)
        q = ST.ingest_stream(spark, src, out, ck)
        q.awaitTermination()
        written.append(sum(p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["numInputRows"]))
    # state written: the responses of the micro-batch, not the 50 that wait
    assert written == [52, 1, 3]
    assert [(r.run_id, r.strategy, r.status_code) for r in ST.late_responses(spark, out).collect()] == [(1, "mobile", 500)]
    assert [(r.id, r.has_errors) for r in ST.read_ingested(spark, out).collect()] == [(1, False)]
    assert ST.pending_responses(spark, out, ck).count() == 53


def test_stream_replays_and_newest_response(spark, tmp_dir):
    out, src, ck = (os.path.join(tmp_dir, x) for x in ("out", "in", "ck"))
    old = [(1, "https://a/", "mobile", NOW, 500, "x", None, "{}")]
    _drop_file(spark, old, src)
    ST.ingest_stream(spark, src, out, ck).awaitTermination()
    _drop_file(spark, _pair(1, "https://a/", NOW + dt.timedelta(minutes=1), perf=0.25), src)
    ST.ingest_stream(spark, src, out, ck).awaitTermination()
    assert [(r.mobile_performance, r.has_errors) for r in ST.read_ingested(spark, out).collect()] == [(0.25, False)]
    # the last micro-batch once more, as after a crash before its end was recorded
    last = max(int(n) for n in os.listdir(os.path.join(ck, "commits")) if n.isdigit())
    for n in (str(last), f".{last}.crc"):
        os.remove(os.path.join(ck, "commits", n))
    ST.ingest_stream(spark, src, out, ck).awaitTermination()
    assert ST.read_ingested(spark, out).count() == 1 and ST.read_ingested(spark, out, "audits").count() == 1


def test_dashboard_covers_history_written_by_any_path(spark, tmp_dir):
    from sitelens.plans import batch as B
    base = "file://" + os.path.join(tmp_dir, "tables")
    sites_csv = os.path.join(tmp_dir, "sites.csv")
    with open(sites_csv, "w") as f:
        f.write("url\nhttps://s0/\nhttps://s1/\n")
    day = dt.timedelta(days=1)

    def frame(rows):
        return spark.createDataFrame(rows, schemas.RAW_RESPONSES)

    W.append_responses(frame([x for i in range(5) for x in _pair(i + 1, f"https://s{i}/", NOW - 3 * day)]), base)
    # one run id over two sites, and ids that repeat in the next run
    counts = [B.run_batch(spark, base, sites_csv, frame(_pair(1, "https://s0/", t) + _pair(1, "https://s1/", t)), t).first()
              for t in (NOW - 2 * day, NOW)]
    assert [(c.processed, c.errors) for c in counts] == [(2, 0), (2, 0)]
    ids = [r.id for r in ST.read_ingested(spark, base).collect()]
    assert sorted(ids) == list(range(1, 10))
    # a crash between the append and the update, and a version that was cut short
    W.append_responses(frame(_pair(50, "https://s9/", NOW)), base)
    spark.range(3).write.parquet(f"{base}/{B.MAINTAINED}/v-999999999999-x/latest")
    res = B.run_dashboard_export(spark, base, os.path.join(tmp_dir, "dash"), NOW)
    assert res["total_sites"] == 6 and published_folder(spark, os.path.join(tmp_dir, "dash")) in res["files"]["summary"]
    assert _lines(res["files"]["summary"])[0]["total_audits"] == 10
