"""File sources (S1-S3): site lists, stored API responses, metric exports.

Every reader declares its schema; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import scalars as X


def read_site_list(spark: SparkSession, path: str, url_column: str = "url") -> DataFrame:
    """Urls of a CSV site list with a header row.

    Takes the named column, trims all white space, drops empty values and keeps
    rows with a valid url (X5); duplicates are kept.  A missing column gives no
    rows.  Quoted fields may hold commas, line breaks and doubled quotes.
    ``position`` is the row's place in the file order (for stable output).
    """
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .option("quote", '"').option("escape", '"').option("multiLine", True)
           .option("mode", "PERMISSIVE").option("inferSchema", False).csv(path))
    if url_column not in raw.columns:
        return schemas.empty_frame(spark, T.StructType([T.StructField("url", T.StringType()),
                                                        T.StructField("position", T.LongType())]))
    u = F.regexp_replace(F.col(f"`{url_column}`"), r"(?U)^\s+|\s+$", "")
    return (raw.select(u.alias("url"), F.monotonically_increasing_id().alias("position"))
            .filter(F.col("url").isNotNull() & (F.col("url") != "") & X.is_valid_url("url")))


def read_raw_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored responses, one JSON body per (run, url, strategy)."""
    reader = spark.read.schema(schemas.RAW_RESPONSES)
    return reader.json(path) if fmt == "json" else reader.format(fmt).load(path)


def read_metrics_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """S3: long metric records from a JSON array (``multi_line``) or JSON lines.

    Timestamps are ISO text, optionally ending in 'Z' (UTC), read as naive UTC.
    """
    raw = spark.read.schema(schemas.METRICS_JSON).option("multiLine", multi_line).json(path)
    ts = F.regexp_replace(F.col("timestamp"), "Z$", "").cast(T.TimestampNTZType())
    return raw.select("url", ts.alias("timestamp"), "strategy", "ibge_code", "performance",
                      "accessibility", "seo", "bestPractices")
