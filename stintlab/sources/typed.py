"""Typed tables in Parquet, by event and session.

A report over them reads the few columns it needs of the race sessions only, where text
tables are parsed whole. They hold every row; which rows a report can use is a filter on
typed columns, which the scan takes over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PARTS = ["event", "session"]

TYPED_LAPS = T.StructType(
    [
        T.StructField("driver", T.StringType()),
        T.StructField("lap_time", T.DoubleType()),
        T.StructField("stint", T.IntegerType()),
        T.StructField("lap", T.IntegerType()),
        T.StructField("total_laps", T.IntegerType()),
        T.StructField("compound", T.StringType()),
        T.StructField("tyre_age", T.IntegerType()),
        T.StructField("pit_out", T.StringType()),
    ]
)
TYPED_TELEMETRY = T.StructType(
    [
        T.StructField("driver", T.StringType()),
        T.StructField("acc_y", T.DoubleType()),
        T.StructField("brake", T.IntegerType()),
        T.StructField("rpm", T.DoubleType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("throttle", T.DoubleType()),
        T.StructField("rel_distance", T.StringType()),
    ]
)


def write_typed(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write typed rows by event and session.

    Rows of a session come together in few files; a session with a large share of them is
    split over tasks. ``mode="refresh"`` replaces the sessions that ``df`` has rows of and
    leaves the files of all others alone, so that a weekend can be added, or written again,
    without the rest of the season; a table that is not there yet is made.
    """
    out = df.hint("rebalance", *_PARTS).write.partitionBy(*_PARTS)
    if mode == "refresh":
        out = out.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        out = out.mode(mode).option("partitionOverwriteMode", "static")
    out.parquet(path)


def _read(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    parts = T.StructType([T.StructField(c, T.StringType()) for c in _PARTS])
    table = spark.read.schema(T.StructType([*columns, *parts])).parquet(path)
    # An empty name is no folder's name and comes back as NULL.
    named = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in _PARTS]
    return table.select(*named, *columns.names)


def read_typed_laps(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TYPED_LAPS)


def read_typed_telemetry(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TYPED_TELEMETRY)
