"""Consecutive numbering in a total order without a single-task window.

``row_number()`` over a window with no partition moves every row into one
task.  Instead:

1. sort globally — a range-partitioned shuffle whose bounds come from a
   sample, so the work spreads over all tasks even when one sort value holds a
   third of the rows (the order key must be total, e.g. end with a unique key);
2. tag rows with ``monotonically_increasing_id`` (partition id in the high
   bits, position in the partition in the low 33 bits); ``start`` is a
   plain number evaluated once;
3. checkpoint into the shared folder named by ``spark.checkpoint.dir``, so the
   partition contents are fixed even if executors are lost or the plan is
   re-run (a re-sampled range bound would otherwise shift rows);
4. count rows per partition — one row per partition, a size bounded by the
   partition count — turn the counts into offsets and broadcast them as a
   local relation; number = start + offset + position.

The plan is the same at every size.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_root

_MID, _PID, _N, _OFF = "__seq_mid", "__seq_pid", "__seq_n", "__seq_off"
_OFFSETS = T.StructType([T.StructField(_PID, T.LongType(), False),
                         T.StructField(_OFF, T.LongType(), False)])


def number_rows(df: DataFrame, order_cols: list, col: str = "rank", start=1) -> DataFrame:
    """``df`` with ``col`` = start, start+1, ... following ``order_cols``.

    ``order_cols`` must be a total order.  ``start`` may be an int or a
    one-value Column (e.g. a scalar subquery for ``MAX(id) + 1``); it is
    evaluated once (a single scalar).
    """
    return number_in_place(df.orderBy(*order_cols), col, start)


def number_in_place(df: DataFrame, col: str, start=1) -> DataFrame:
    """``df`` with ``col`` = start, start+1, ... in the order its partitions
    hold the rows: no shuffle, and one stored copy of the rows."""
    spark = df.sparkSession
    work_root(spark)  # the cluster's checkpoint folder, or a local one in tests
    if not isinstance(start, int):
        start = int(spark.range(1).select(start.cast("long")).first()[0])
    fixed = df.withColumn(_MID, F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright(F.col(_MID), 33)
    counts = sorted((r[0], r[1]) for r in
                    fixed.groupBy(pid.alias(_PID)).agg(F.count(F.lit(1)).alias(_N)).collect())
    offsets, acc = [], 0
    for p, n in counts:  # at most one entry per partition
        offsets.append((int(p), acc))
        acc += int(n)
    # pandas + Arrow: a local relation built in the JVM, no Python worker
    off = spark.createDataFrame(pd.DataFrame(offsets or [(0, 0)], columns=[_PID, _OFF]), _OFFSETS)
    pos = F.col(_MID) - F.shiftleft(F.col(_PID), 33)
    out = (fixed.withColumn(_PID, pid)
           .join(F.broadcast(off), on=_PID, how="inner")
           .withColumn(col, (F.lit(start) + F.col(_OFF) + pos).cast("long")))
    return out.drop(_MID, _PID, _OFF)
