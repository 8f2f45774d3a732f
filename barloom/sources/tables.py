"""Scans of the given tables and of bar files (SRC1, SRC2, SRC3, SRC5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.plans.frame import cut_range

# Bar schema used everywhere in the library (ts is a wall-clock timestamp).
BAR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

# Raw platform bar file columns (CSV with a header), as written by the trading platform.
RAW_BAR_SCHEMA = T.StructType([
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("gateway_name", T.StringType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("turnover", T.DoubleType()),
    T.StructField("open_interest", T.DoubleType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_bar_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_BAR_SCHEMA) -> DataFrame:
    """SRC1: CSV bar scan with an explicit schema (no inference pass over the data)."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .csv(path))


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Parquet bar scan (the main format); partition pruning by symbol/date comes from the layout."""
    return spark.read.parquet(path)


def prune_columns(df: DataFrame, drop=("symbol", "exchange", "turnover", "open_interest")) -> DataFrame:
    """SRC2: drop metadata columns; with Parquet, Catalyst prunes them from the scan."""
    return df.drop(*[c for c in drop if c in df.columns])


def date_range(df: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """SRC3: inclusive [start, end] slice on the time column (pushed to the scan).

    A bare date as ``end`` keeps that whole day.  Indicators need warm-up rows
    before ``start``: see :func:`read_range`.
    """
    return cut_range(df, ts, start, end)


def read_range(df: DataFrame, start: str, end, rows: int, key: str = "symbol", ts: str = "ts",
               within_days: int | None = None) -> DataFrame:
    """SRC3: [start, end] and at least ``rows`` earlier rows of every key in it, without reading all history.

    The scan is cut at ``start`` minus a number of days (first guess: ``within_days``,
    or twice ``rows``), which reaches the source as a pushed filter; the days are
    doubled while a key has too few rows after the cut but has older ones.  Finite
    features with a lookback of ``rows`` then equal those on all history from
    ``start`` on (cut with :meth:`barloom.plans.frame.BarFrame.between`);
    recurrences need the whole series.
    """
    first = F.lit(start).cast("timestamp_ntz")
    days = within_days or max(1, 2 * rows)
    while True:
        low = first - F.make_dt_interval(F.lit(days))
        part = cut_range(df.where(F.col(ts) >= low), ts, None, end)
        early = part.groupBy(key).agg(F.sum((F.col(ts) < first).cast("long")).alias("n")).where(F.col("n") < rows)
        older = df.where(F.col(ts) < low).join(early.select(key), key, "left_semi")
        if older.isEmpty():
            return part
        days *= 2


def signal_table(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: a saved (ts, ret) signal series."""
    return spark.read.parquet(path).select(F.col("ts").cast("timestamp_ntz").alias("ts"),
                                           F.col("ret").cast("double").alias("ret"))
