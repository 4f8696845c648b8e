import datetime as dt
import glob
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from sitelens import schemas  # noqa: E402

NOW = dt.datetime(2024, 3, 1, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("sitelens-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sitelens-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sitelens-test-")


def state_lists(spark, since):
    """Bytes on disk of the lists of files (MANIFEST) of the RocksDB state stores opened since a time; one number a store."""
    local = os.environ.get("SPARK_LOCAL_DIRS") or spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())
    stats = [os.stat(p) for p in glob.glob(f"{local.split(',')[0]}/spark-*/**/MANIFEST-*", recursive=True)]
    return [s.st_blocks * 512 for s in stats if s.st_mtime >= since]


def summary_row(id, url, ts, has_errors=False, error=None, **scores):
    row = {f.name: None for f in schemas.AUDIT_SUMMARIES.fields}
    row.update(id=id, url=url, timestamp=ts, has_errors=has_errors, error_message=error,
               created_at=ts)
    row.update(scores)
    return row


def summaries_df(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.AUDIT_SUMMARIES.fields)
                                  for r in rows], schemas.AUDIT_SUMMARIES)


AUDIT_COLS = ["id", "url", "timestamp", "error_message", "retry_count", "created_at"]


def audits_df(spark, rows):
    """rows: (id, url, timestamp, error_message)"""
    return spark.createDataFrame(
        [(i, u, t, e, 0, t) for i, u, t, e in rows],
        "id long, url string, timestamp timestamp_ntz, error_message string, "
        "retry_count long, created_at timestamp_ntz")
