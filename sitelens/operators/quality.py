"""Data-quality checks (Q1-Q4).  Each is one pass over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .metrics import duplicate_keys  # noqa: F401  (Q2 is A11 that must be empty)
from .quarantine import status_violations  # noqa: F401  (Q3)


def null_counts(df: DataFrame, columns=("url", "timestamp")) -> DataFrame:
    """Q1: one row with ``null_<col>`` per column and ``total_rows``."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
                  F.count(F.lit(1)).alias("total_rows"))


def schema_check(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Q4: per expected column: declared and actual type, NULL count, verdict.

    Types come from the plan; NULL counts from one aggregate pass, so a
    NOT NULL column holding NULLs fails even when its type is right.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    present = [f for f in expected.fields if f.name in actual]
    counts = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f.name) for f in present]) \
        if present else df.limit(0).agg(F.count(F.lit(1)).alias("__none"))
    rows = []
    for f in expected.fields:
        has = f.name in actual
        nulls = F.col(f"`{f.name}`").cast("long") if has else F.lit(None).cast("long")
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("expected_type"),
            F.lit(actual.get(f.name)).cast("string").alias("actual_type"),
            F.lit(f.nullable).alias("nullable"),
            nulls.alias("null_count")))
    out = counts.select(F.inline(F.array(*rows)))
    ok = (F.col("actual_type") == F.col("expected_type")) & \
        (F.col("nullable") | (F.col("null_count") == 0))
    return out.withColumn("ok", F.coalesce(ok, F.lit(False)))
