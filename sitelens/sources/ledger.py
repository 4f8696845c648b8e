"""Ledger of loads: which appends to a folder of tables are complete.

An append (U1) writes the files of all its tables below folders that carry its
name (``day=.../load=<name>``) and commits last, with one small file
``<base>/loads/<name>.json``: a line per day with its number of summaries.
:func:`sitelens.sources.tables.read_table` returns rows of committed loads only, so an append
that dies between its tables shows in neither, and the files it left are
replaced when the same load is written again.  A committed load never changes,
so derived tables keep the names of the loads they cover, and what they lack is
a difference of names, whatever the days or counts of the rows.

A folder without a ledger holds tables of another writer and is read whole.
Names are listed by the driver, one per append.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..session import child_names, make_folder, path_exists, write_once

LEDGER = "loads"
_ENDING = ".json"
LOAD_DAYS = T.StructType([T.StructField("load", T.StringType()), T.StructField("day", T.DateType()),
                          T.StructField("n", T.LongType())])


def new_load() -> str:
    """A fresh name for one append (never read as a number)."""
    return f"load-{uuid.uuid4().hex[:12]}"


def _folder(base: str) -> str:
    return f"{base.rstrip('/')}/{LEDGER}"


def open_ledger(spark: SparkSession, base: str) -> None:
    """From now on only committed loads of ``base`` are read (done before the first file is written)."""
    make_folder(spark, _folder(base))


def is_committed(spark: SparkSession, base: str, load: str) -> bool:
    return path_exists(spark, f"{_folder(base)}/{load}{_ENDING}")


def commit_load(spark: SparkSession, base: str, load: str, days: list) -> bool:
    """Commit ``load`` with its (day, rows) pairs; False if it was committed before."""
    lines = [json.dumps({"load": load, "day": None if d is None else d.isoformat(), "n": n})
             for d, n in days or [(None, 0)]]
    return write_once(spark, f"{_folder(base)}/{load}{_ENDING}", "\n".join(lines) + "\n")


def committed_loads(spark: SparkSession, base: str) -> list[str] | None:
    """Names of the committed loads, None for a folder without a ledger."""
    if not path_exists(spark, _folder(base)):
        return None
    return [n[:-len(_ENDING)] for n in child_names(spark, _folder(base))
            if n.endswith(_ENDING) and not n.startswith(".")]


def load_days(spark: SparkSession, base: str) -> DataFrame:
    """(load, day, n) of all committed loads: the summaries of every day without reading them."""
    if not committed_loads(spark, base):
        return schemas.empty_frame(spark, LOAD_DAYS)
    return spark.read.schema(LOAD_DAYS).json(_folder(base)).filter("n > 0")
