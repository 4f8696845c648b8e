"""Steps whose memory, shuffles and files must not grow faster than the input."""
import datetime as dt
import os
import time

from sitelens import schemas
from sitelens.operators import assemble as A
from sitelens.sources import proxy as P
from sitelens.streaming import ingest as ST
from tests.conftest import NOW, state_lists


def _responses(spark, n, start=0):
    rows = [(i, f"https://s{i}.sp.gov.br/", s, NOW - dt.timedelta(days=i % 3), 500, "Internal Server Error", None, "{}")
            for i in range(start, start + n) for s in ("mobile", "desktop")]
    return spark.createDataFrame(rows, schemas.RAW_RESPONSES)


def test_partitions_of_runs_follow_their_number(spark, monkeypatch):
    monkeypatch.setattr(A, "RUN_ROWS", 10)
    assert A.assemble_audits(_responses(spark, 5)).count() == 5
    many = A.assemble_with_summaries(_responses(spark, 100))
    sizes = many.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == 20 and sum(sizes) == 100


def test_only_stored_columns_move_with_the_bodies(spark):
    plan = A.assemble_with_summaries(_responses(spark, 3))._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "from_json" not in below and "from_json" in plan


def test_stored_responses_are_not_sorted_by_day(spark, tmp_dir):
    rows = [(i, NOW - dt.timedelta(days=i % 5), i % 7, "error" if i % 4 == 0 else "view", float(i), '{"k": 1}') for i in range(40)]
    spark.createDataFrame(rows, schemas.EVENTS).write.parquet(f"{tmp_dir}/events.parquet")
    path = P.raw_responses_path(spark, tmp_dir)
    assert not [x for x in os.listdir(path.removeprefix("file:")) if x.startswith("day=")]
    raw = P.raw_responses(spark, tmp_dir)
    assert raw.count() == 80 and sorted(r.id for r in A.assemble_audits(raw).collect()) == list(range(40))


def test_stream_keeps_its_state_compressed_and_late_runs_apart(spark, tmp_dir):
    raw, out, at = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/at"
    for rows in (_responses(spark, 6), _responses(spark, 6, start=3)):
        rows.coalesce(1).write.mode("append").parquet(raw)
        ST.ingest_stream(spark, raw, out, at).awaitTermination()
    assert "stateStore.compression.codec\":\"zstd" in open(f"{at}/offsets/0").read()
    assert sorted(r.id for r in ST.read_ingested(spark, out).collect()) == list(range(9))


def test_stream_state_takes_no_disk_in_advance(spark, tmp_dir):
    _responses(spark, 6).coalesce(1).write.parquet(f"{tmp_dir}/raw")
    since = time.time() - 1
    ST.ingest_stream(spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/at").awaitTermination()
    sizes = state_lists(spark, since)
    assert sizes and max(sizes) < 1 << 20


def test_micro_batch_writes_few_files_and_keeps_one_store_a_partition(spark, tmp_dir):
    raw, out, at = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/at"
    _responses(spark, 60).coalesce(1).write.parquet(raw)
    q = ST.ingest_stream(spark, raw, out, at)
    q.awaitTermination()
    # three days: gathered by day, not a file of each task
    for table in ("audits", "audit_summaries"):
        files = [x for _, _, names in os.walk(f"{out}/{table}") for x in names if x.endswith(".parquet")]
        assert len(files) == 3, files
    state = q.recentProgress[0]["stateOperators"][0]
    assert state["customMetrics"] and state["numStateStoreInstances"] == state["numShufflePartitions"]
    assert not os.path.exists(f"{at}/{ST._KEPT}")
    assert ST.read_ingested(spark, out).count() == 60


def test_stream_goes_on_with_a_checkpoint_of_four_stores_a_partition(spark, tmp_dir, monkeypatch):
    raw, out, at = f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/at"
    rows = _responses(spark, 6)
    rows.filter("strategy = 'mobile' OR run_id > 2").coalesce(1).write.parquet(raw)
    with monkeypatch.context() as m:
        m.delitem(ST._STATE_CONF, "spark.sql.streaming.join.stateFormatVersion")
        ST.ingest_stream(spark, raw, out, at).awaitTermination()
    assert sorted(r.id for r in ST.read_ingested(spark, out).collect()) == [3, 4, 5]
    rows.filter("strategy = 'desktop' AND run_id < 2").coalesce(1).write.mode("append").parquet(raw)
    ST.ingest_stream(spark, raw, out, at).awaitTermination()
    assert sorted(r.id for r in ST.read_ingested(spark, out).collect()) == [0, 1, 3, 4, 5]
    assert [r.run_id for r in ST.pending_responses(spark, out, at).collect()] == [2]


def test_pairs_are_assembled_as_their_groups_are(spark):
    from pyspark.sql import functions as F
    from tests.test_assemble import ok_body
    def one(run, strategy, when, body=None, code=200):
        return (run, None if run == 6 else f"https://s{run}/", strategy, when, code, "why", None, ok_body() if body is None else body)

    later = NOW + dt.timedelta(hours=1)
    pairs = [(one(1, "mobile", later), one(1, "desktop", NOW)), (one(2, "mobile", NOW), None), (None, one(3, "desktop", NOW)),
             (one(4, "tablet", NOW), None), (one(5, "mobile", None), one(5, "desktop", NOW)), (one(6, "mobile", NOW), one(6, "desktop", later)),
             (one(None, "mobile", NOW, "{"), one(None, "desktop", NOW)), (one(7, "mobile", NOW, "{}", 503), one(7, "desktop", None)),
             (one(8, None, None), None)]
    kind = schemas.RAW_RESPONSES.simpleString()
    frame = spark.createDataFrame(pairs, f"first {kind}, second {kind}")
    raw = frame.select(F.inline(F.array_compact(F.array("first", "second"))))
    key = lambda r: (r.id is None, r.id or 0)
    assert sorted(A.assemble_pairs(frame).collect(), key=key) == sorted(A.assemble_with_summaries(raw).collect(), key=key)
