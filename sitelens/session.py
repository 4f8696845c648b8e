"""Session helpers: a tuned builder for local runs and the shared work folder.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it.  A private folder is created only for a
local-mode session where nothing is configured (tests, bench).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_CKPT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app_name: str = "sitelens",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """SparkSession with the settings the operators are designed for."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    b = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SITELENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # broadcast only what the planner can size; our own broadcasts are
        # of tables whose size is bounded by the number of partitions
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads the checkpoint folder the cluster names; only a local session with
    none configured gets a fresh private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get(_CKPT_CONF, None) or sc.getConf().get(_CKPT_CONF, None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder "
                "(e.g. on the cluster file system) before running sitelens jobs")
        conf = tempfile.mkdtemp(prefix="sitelens-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def _resolved(spark: SparkSession, path: str):
    """(file system, path) as Spark resolves them (never the driver's own disk,
    unless that is the default file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolved(spark, path)
    return fs.exists(p)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether any path fits a pattern of folders."""
    fs, p = _resolved(spark, pattern)
    return len(fs.globStatus(p) or []) > 0


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _resolved(spark, path)
    fs.mkdirs(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    fs, p = _resolved(spark, path)
    fs.delete(p, True)


def drop_unused(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing in the driver refers to any more, as it
    otherwise does every half hour (spark.cleaner.periodicGC.interval)."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder, empty if the folder is absent."""
    fs, p = _resolved(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    """The text of one small file."""
    fs, p = _resolved(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create one small file whole, unless its name is taken; says whether it was created.

    Written beside its place under a hidden name and renamed without
    overwriting, so nobody reads half of it and of two writers one fails.
    """
    jvm = spark.sparkContext._jvm
    fs, p = _resolved(spark, path)
    if fs.exists(p):
        return False
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
            .rename(fs.makeQualified(beside), fs.makeQualified(p), none)
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" in e.java_exception.toString():
            return False
        raise
    return True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared work folder."""
    root = work_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def run_concurrently(actions, max_workers: int = 4) -> list:
    """Submit independent Spark actions (callables) as concurrent jobs.

    Small jobs overlap instead of queueing one after another; on a cluster
    they share the executors under the scheduler.  Results come back in
    order; the first failure is raised.
    """
    from concurrent.futures import ThreadPoolExecutor
    actions = list(actions)
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(actions))) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]
