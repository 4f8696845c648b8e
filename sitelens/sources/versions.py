"""Numbered versions: changes of one table, or of one published folder, in a single order.

A log folder holds one small file per version, ``<number>.json``.  A writer reads
the newest number, prepares its files under a name of its own, and then creates
the file of the next number, which only one writer can (:func:`sitelens.session.write_once`).
Who comes second starts again from what the first one wrote, so no change is
computed from a state that is no longer the newest.  Files without a version are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..session import child_names, path_exists, read_text, write_once

ATTEMPTS = 20
QUARANTINE_LOG, QUARANTINE_LOADS = "quarantine_log", "quarantine_loads"
_ENDING = ".json"


def newest_number(spark: SparkSession, log: str) -> int:
    """The newest version's number, 0 if there is none."""
    return max((int(n[:-len(_ENDING)]) for n in child_names(spark, log)
                if n.endswith(_ENDING) and n[0] != "."), default=0)


def entry_path(log: str, number: int) -> str:
    return f"{log}/{number:012d}{_ENDING}"


def commit_next(spark: SparkSession, log: str, after: int, folder: str, **more) -> bool:
    """Make ``folder`` the version after ``after``; False if another writer made one first."""
    return write_once(spark, entry_path(log, after + 1), json.dumps({"folder": folder} | more) + "\n")


def newest_folder(spark: SparkSession, log: str) -> str | None:
    number = newest_number(spark, log)
    return json.loads(read_text(spark, entry_path(log, number)))["folder"] if number else None


def publish(spark: SparkSession, out: str, write: Callable[[str], object]):
    """Write a whole export into a fresh folder below ``out`` and then switch to it.

    ``write(folder)`` makes the files.  Readers ask :func:`published_folder`: they find the version
    before until all files of this one are there.
    """
    folder = f"{out.rstrip('/')}/version-{uuid.uuid4().hex[:12]}"
    result = write(folder)
    log = f"{out.rstrip('/')}/published"
    while not commit_next(spark, log, newest_number(spark, log), folder):
        pass
    return result


def published_folder(spark: SparkSession, out: str) -> str | None:
    """The folder of the newest whole export below ``out``, None before the first."""
    return newest_folder(spark, f"{out.rstrip('/')}/published")


def quarantine_table(spark: SparkSession, base: str) -> tuple[int, DataFrame]:
    """(newest version, rows) of the quarantine table of ``base``; rows another writer
    left in ``base/quarantine`` come before all versions."""
    base = base.rstrip("/")
    number = newest_number(spark, f"{base}/{QUARANTINE_LOG}")
    rows = schemas.empty_frame(spark, schemas.QUARANTINE)
    if path_exists(spark, f"{base}/quarantine"):
        rows = spark.read.schema(schemas.QUARANTINE).parquet(f"{base}/quarantine")
    if number:
        # one name per version; a version that comes now is left out, whole
        entries = spark.read.schema("folder string").json([entry_path(f"{base}/{QUARANTINE_LOG}", n) for n in range(1, number + 1)])
        folders = [f"{base}/{QUARANTINE_LOADS}/{r['folder']}" for r in entries.collect()]
        new = spark.read.schema(schemas.QUARANTINE).parquet(*folders)
        rows = rows.unionByName(new) if path_exists(spark, f"{base}/quarantine") else new
    return number, rows


def change_quarantine(spark: SparkSession, base: str,
                      change: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Append the rows of one command as the next version; returns the command's report.

    ``change(table)`` gives (rows to append, report), both computed from checkpoints.  It is asked
    again whenever another command's version came first, so ids stay unique and versions consecutive.
    A command without rows makes no version.
    """
    base = base.rstrip("/")
    for _ in range(ATTEMPTS):
        number, table = quarantine_table(spark, base)
        rows, result = change(table)
        if rows.isEmpty():
            return result
        folder = f"load-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{base}/{QUARANTINE_LOADS}/{folder}")
        if commit_next(spark, f"{base}/{QUARANTINE_LOG}", number, folder):
            return result
    raise RuntimeError(f"{ATTEMPTS} other commands came first each time")
