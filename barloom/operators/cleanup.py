"""Projections, clean-up and filters (PRJ1–PRJ12, FLT1–FLT3, FLT5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OHLCV = ["open", "high", "low", "close", "volume", "open_interest"]
TARGETS = ["pos_change_signal", "net_pos_signal", "desired_pos_change", "desired_pos_rolling"]
PRICE_RENAMES = {"close_price": "close", "high_price": "high", "low_price": "low", "open_price": "open"}


def _drop(df: DataFrame, cols) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def drop_ohlcv_cols(df: DataFrame) -> DataFrame:
    """PRJ1: drop raw price/volume/open-interest columns."""
    return _drop(df, OHLCV)


def split_features_target(df: DataFrame, key=("symbol", "ts"), targets=TARGETS) -> tuple[DataFrame, DataFrame]:
    """PRJ2: X = all but the targets, y = the targets; both keep the key (no positional alignment)."""
    key = [k for k in key if k in df.columns]
    X = _drop(df, targets)
    y = df.select(*key, *[t for t in targets if t in df.columns])
    return X, y


def renaming(df: DataFrame, mapping=PRICE_RENAMES) -> DataFrame:
    """PRJ5: ``close_price`` → ``close`` etc."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep_essentials(df: DataFrame) -> DataFrame:
    """PRJ3: drop exchange/turnover/symbol, then rename the price columns."""
    return renaming(_drop(df, ["exchange", "turnover", "symbol"]))


def trim_df(df: DataFrame, keep_symbol: bool = False) -> DataFrame:
    """PRJ4: drop metadata columns; the symbol is optional."""
    out = _drop(df, ["exchange", "interval", "turnover", "datetime", "gateway_name"])
    return out if keep_symbol else _drop(out, ["symbol"])


def remove_infs_and_zeros(df: DataFrame, cols=None, eps: float = 1e-4) -> DataFrame:
    """PRJ6: replace ±inf and 0 by ``eps`` in numeric columns."""
    from pyspark.sql import types as T
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    bad = [float("inf"), float("-inf"), 0.0]
    return df.withColumns({c: F.when(F.col(c).isin(bad), F.lit(eps)).otherwise(F.col(c)) for c in cols})


def sort_columns(df: DataFrame, keep_first=()) -> DataFrame:
    """PRJ7: columns in name order (key columns may stay in front)."""
    rest = sorted(c for c in df.columns if c not in keep_first)
    return df.select(*keep_first, *rest)


def concat_columns(left: DataFrame, right: DataFrame, key=("symbol", "ts")) -> DataFrame:
    """PRJ8: column-wise concatenation of two tables by key (never by position)."""
    return left.join(right, list(key), "inner")


def to_string(df: DataFrame, cols) -> DataFrame:
    """PRJ9: cast to string."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def divide_means(df: DataFrame, a: str, b: str, group: str) -> DataFrame:
    """PRJ10: per group avg(a)/avg(b); groups with unequal counts of a and b are an error
    (``ok`` = false), as the reference raises on unequal list lengths."""
    return (df.groupBy(group)
            .agg(F.avg(a).alias("_ma"), F.avg(b).alias("_mb"),
                 (F.count(a) == F.count(b)).alias("ok"))
            .select(group, F.when(F.col("_mb") != 0, F.col("_ma") / F.col("_mb")).alias("mean_ratio"), "ok"))


CLASS_NUMBER = {"strong buy": 1, "strong sell": -1}


def class_to_number(c: str | Column, mapping=CLASS_NUMBER, default: int = 0) -> Column:
    """PRJ11: {'strong buy': 1, 'strong sell': -1, other: 0}."""
    cc = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[cc], F.lit(default))


def fill_sentinel(df: DataFrame, cols, sentinel: str = "_nan") -> DataFrame:
    """PRJ12: NULL → sentinel string."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(sentinel)) for c in cols})


def dropna_any(df: DataFrame, subset=None) -> DataFrame:
    """FLT1: drop rows with a NULL (or NaN) in any (given) column."""
    return df.na.drop("any", subset=subset)


def class_threshold_count(df: DataFrame, cls: str, value: str, prob: str, threshold: float, group=None) -> DataFrame:
    """FLT3: rows of one class above a probability threshold, and their count."""
    keys = [group] if group else []
    return (df.groupBy(*keys)
            .agg(F.count_if((F.col(cls) == value) & (F.col(prob) > threshold)).cast("long").alias("n_selected"),
                 F.count(F.lit(1)).cast("long").alias("n_rows")))


def row_slice(df: DataFrame, start: int, stop: int, rn: str = "rn") -> DataFrame:
    """FLT5: positional slice ``[start:stop]`` per key (0-based, stop exclusive) by row number."""
    return df.where((F.col(rn) > start) & (F.col(rn) <= stop))
