"""Versioned quarantine (J1, J3, W4, W5, U2-U5, F3, F7) on hand-made histories."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitelens import schemas
from sitelens.operators import filters as FL
from sitelens.operators import metrics as M
from sitelens.operators import quarantine as Q
from tests.conftest import NOW, audits_df


def _failing(spark, url="https://down.sp.gov.br/", days=5, start_id=1, until=NOW):
    return [(start_id + i, url, until - dt.timedelta(days=i), "Connection timeout")
            for i in range(days)]


def _q(spark, rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schemas.QUARANTINE.fields)
                                  for r in rows], schemas.QUARANTINE)


def _qrow(id, url, version, status="quarantined", failures=5, t=NOW, notes=None):
    return dict(id=id, url=url, first_failure=t, last_failure=t, consecutive_failures=failures,
                last_error_message="e", status=status, notes=notes, version=version,
                valid_from=t, created_at=t)


def test_update_adds_then_is_idempotent(spark):
    a = audits_df(spark, _failing(spark) + _failing(spark, "https://ok.sp.gov.br/", 2, 100))
    empty = schemas.empty_frame(spark, schemas.QUARANTINE)
    first = Q.update_quarantine(a, empty, NOW)
    rows = first.collect()
    assert [(r.url, r.version, r.status, r.id, r.consecutive_failures) for r in rows] == \
        [("https://down.sp.gov.br/", 1, "quarantined", 1, 5)]
    again = Q.update_quarantine(a, first, NOW)
    assert again.count() == 0  # same count -> no new version
    stats = Q.update_stats(Q.quarantine_changes(a, first, NOW)).first()
    assert (stats.added, stats.updated, stats.total_checked) == (0, 0, 1)


def test_update_new_count_keeps_first_failure_and_status(spark):
    t0 = NOW - dt.timedelta(days=20)
    q = _q(spark, [_qrow(7, "https://down.sp.gov.br/", 3, status="investigating", failures=9,
                         t=t0, notes="looking")])
    a = audits_df(spark, _failing(spark))
    r = Q.update_quarantine(a, q, NOW).first()
    assert (r.version, r.status, r.first_failure, r.notes, r.id, r.consecutive_failures) == \
        (4, "investigating", t0, None, 8, 5)


def test_removed_url_failing_again_stays_removed(spark):
    q = _q(spark, [_qrow(1, "https://down.sp.gov.br/", 1),
                   _qrow(2, "https://down.sp.gov.br/", 2, status="removed", failures=2)])
    r = Q.update_quarantine(audits_df(spark, _failing(spark)), q, NOW).first()
    assert (r.status, r.version) == ("removed", 3)


def test_current_keeps_duplicate_top_versions(spark):
    q = _q(spark, [_qrow(1, "u", 1), _qrow(2, "u", 2), _qrow(3, "u", 2), _qrow(4, "v", 1)])
    cur = Q.quarantine_current(q).collect()
    assert sorted(r.id for r in cur) == [2, 3, 4]
    assert sorted((r.url, r.next_version) for r in Q.next_version(q).collect()) == \
        [("u", 3), ("v", 2)]


def test_set_status_round_trip_and_skip_list(spark):
    q = _q(spark, [_qrow(1, "https://a.sp.gov.br/", 1), _qrow(2, "https://b.sp.gov.br/", 1)])
    ch = spark.createDataFrame([("https://a.sp.gov.br/", "resolved", None),
                                ("https://zzz.sp.gov.br/", "investigating", "n")],
                               "url string, status string, notes string")
    new = Q.set_quarantine_status(q, ch, NOW)
    rows = new.collect()
    assert [(r.url, r.status, r.version, r.id, r.notes) for r in rows] == \
        [("https://a.sp.gov.br/", "resolved", 2, 3, None)]
    cur = Q.quarantine_current(q.unionByName(new))
    assert sorted(r.url for r in FL.quarantine_skip_urls(cur).collect()) == ["https://b.sp.gov.br/"]


def test_set_status_rejects_unknown_status(spark):
    q = _q(spark, [_qrow(1, "u", 1)])
    bad = spark.createDataFrame([("u", "deleted")], "url string, status string")
    with pytest.raises(ValueError):
        Q.set_quarantine_status(q, bad, NOW)
    assert Q.status_violations(bad).count() == 1


def test_remove_is_tombstone_and_unknown_is_noop(spark):
    q = _q(spark, [_qrow(1, "u", 1)])
    urls = spark.createDataFrame([("u",), ("nope",)], "url string")
    r = Q.remove_from_quarantine(q, urls, NOW).collect()
    assert [(x.status, x.notes, x.version) for x in r] == [("removed", "Removed from quarantine", 2)]
    cur = Q.quarantine_current(q.unionByName(Q.remove_from_quarantine(q, urls, NOW)))
    assert FL.list_quarantined(cur).count() == 0
    assert M.quarantine_stats(cur).first().total == 0


def test_versions_strictly_increase(spark):
    a = audits_df(spark, _failing(spark, days=3))
    empty = schemas.empty_frame(spark, schemas.QUARANTINE)
    q = Q.update_quarantine(a, empty, NOW - dt.timedelta(days=1))
    q = q.unionByName(Q.update_quarantine(a, q, NOW))
    ch = spark.createDataFrame([("https://down.sp.gov.br/", "investigating")], "url string, status string")
    q = q.unionByName(Q.set_quarantine_status(q, ch, NOW))
    versions = [r.version for r in q.orderBy("id").collect()]
    assert versions == sorted(versions) and len(set(versions)) == len(versions)
    ids = [r.id for r in q.collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_list_and_stats_and_time_travel(spark):
    t1 = NOW - dt.timedelta(days=2)
    q = _q(spark, [_qrow(1, "a", 1, failures=3, t=t1), _qrow(2, "b", 1, "investigating", 7, t1),
                   _qrow(3, "a", 2, "wrong_url", 4), _qrow(4, "c", 1, "resolved", 5)])
    cur = Q.quarantine_current(q)
    lst = FL.list_quarantined(cur).collect()
    assert [r.url for r in lst] == ["b", "c", "a"] and lst[0].last_error == "e"
    assert [r.url for r in FL.list_quarantined(cur, status="resolved").collect()] == ["c"]
    s = M.quarantine_stats(cur).first()
    assert (s.total, s.investigating, s.wrong_url, s.resolved, s.max_failures) == (3, 1, 1, 1, 7)
    assert s.avg_failures == pytest.approx(5.3)
    past = Q.quarantine_as_of(q, t1).collect()
    assert sorted((r.url, r.status) for r in past) == [("a", "quarantined"), ("b", "investigating")]
    assert F is not None


def test_exact_stats_three_quarantined_two_investigating(spark):
    rows = [_qrow(i, f"u{i}", 1, "quarantined" if i < 3 else "investigating", 5) for i in range(5)]
    s = M.quarantine_stats(Q.quarantine_current(_q(spark, rows))).first()
    assert (s.total, s.quarantined, s.investigating, s.avg_failures, s.max_failures) == \
        (5, 3, 2, 5.0, 5)


def test_recovered_site_leaves_skip_list(spark):
    url = "https://recovered.sp.gov.br/"
    fails = [(i, url, NOW - dt.timedelta(days=i + 1), "down") for i in range(8)]
    a = audits_df(spark, fails + [(100, url, NOW, None)])
    q = Q.update_quarantine(a, schemas.empty_frame(spark, schemas.QUARANTINE), NOW)
    assert [r.url for r in FL.quarantine_skip_urls(Q.quarantine_current(q)).collect()] == [url]
    ch = spark.createDataFrame([(url, "resolved")], "url string, status string")
    q = q.unionByName(Q.set_quarantine_status(q, ch, NOW))
    assert FL.quarantine_skip_urls(Q.quarantine_current(q)).count() == 0
    # the recent success also keeps it out of the recently-failed skip list
    sites = spark.createDataFrame([(url.rstrip("/"),), ("https://other.sp.gov.br",)], "url string")
    todo = FL.urls_to_audit(sites, a, NOW, 24, Q.quarantine_current(q))
    assert [r.url for r in todo.collect()] == ["https://other.sp.gov.br"]
    assert FL.urls_to_audit(sites, a, NOW, 0).count() == 2  # hours <= 0: no skipping


def test_time_windows_on_a_table_without_day_folders(spark, tmp_dir):
    # a flat audits table read with the declared schema has day = NULL: nothing is lost
    from sitelens.sources.tables import read_table
    base = tmp_dir
    audits_df(spark, _failing(spark)).write.parquet(f"{base}/audits")
    a = read_table(spark, base, "audits")
    assert "day" in a.columns and a.filter("day IS NOT NULL").count() == 0
    assert M.failing_urls(a, NOW, 3).first().failure_count == 5
    assert FL.recently_audited_urls(a, NOW, 24 * 10).count() == 0  # all are failures
