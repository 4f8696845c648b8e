"""Bind the audit tables by name for SQL (C1) and reports.

Tables live as Parquet folders below one base path (``audits``,
``audit_summaries``, ``quarantine``, optionally ``psi_metrics``); the
``quarantine_current`` view is the J1 window over ``quarantine``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..operators.quarantine import quarantine_current
from ..session import path_exists
from .ledger import committed_loads
from .versions import quarantine_table

TABLE_SCHEMAS = {
    "audits": schemas.AUDITS,
    "audit_summaries": schemas.AUDIT_SUMMARIES,
    "quarantine": schemas.QUARANTINE,
    "psi_metrics": schemas.PSI_METRICS,
}


DAY_PARTITIONED = {"audits", "audit_summaries"}
_DAY = T.StructField("day", T.DateType())
_LOAD = T.StructField("load", T.StringType())


def read_table(spark: SparkSession, base: str, name: str, loads: list[str] | None = None) -> DataFrame:
    """A table folder read with its declared schema (empty if the folder is absent).

    ``audits`` and ``audit_summaries`` keep their ``day`` partition column,
    which the time-window operators use to prune folders, and show committed
    loads only (``loads``: just these of them); ``quarantine`` shows committed
    versions.  Whether the folder
    is there is asked of Spark's file system, whatever form the path has.
    """
    if name == "quarantine":
        return quarantine_table(spark, base)[1]
    path = f"{base.rstrip('/')}/{name}"
    schema = TABLE_SCHEMAS[name]
    committed = None
    if name in DAY_PARTITIONED:
        schema = T.StructType(schema.fields + [_DAY])
        # asked before the files are listed: all files of these loads are there
        committed = committed_loads(spark, base)
    if not path_exists(spark, path):
        return schemas.empty_frame(spark, schema)
    if committed is None:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    wanted = committed if loads is None else sorted(set(loads) & set(committed))
    if not wanted:
        return schemas.empty_frame(spark, schema)
    rows = spark.read.schema(T.StructType(schema.fields + [_LOAD])).parquet(path)
    return rows.filter(rows["load"].isin(wanted)).select(*schema.fieldNames())


def register_tables(spark: SparkSession, base: str | None = None,
                    frames: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Create temp views for the audit tables and ``quarantine_current``.

    ``frames`` (name -> DataFrame) take precedence over folders under ``base``.
    """
    frames = dict(frames or {})
    if base:
        for name in TABLE_SCHEMAS:
            frames.setdefault(name, read_table(spark, base, name))
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    if "quarantine" in frames:
        cur = quarantine_current(frames["quarantine"])
        cur.createOrReplaceTempView("quarantine_current")
        frames["quarantine_current"] = cur
    return frames
