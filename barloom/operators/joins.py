"""Joins (J1–J5).  All are by key, never by position; Spark picks the strategy,
and small sides are broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 1_000_000


def _maybe_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only when the row count is known to be small (one cheap count)."""
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def align(y: DataFrame, X: DataFrame, key=("symbol", "ts")) -> DataFrame:
    """Y restricted to the keys of X (``y.loc[X.index]``): a left-semi join."""
    return y.join(X.select(*key), list(key), "left_semi")


def signal_lookup(bars: DataFrame, signals: DataFrame, key=("symbol", "ts"), value="ret", out=None) -> DataFrame:
    """Attach a saved signal by time, 0.0 where it is missing."""
    s = signals.select(*key, F.col(value).alias("_sig"))
    return bars.join(s, list(key), "left").withColumn(out or value, F.coalesce(F.col("_sig"), F.lit(0.0))).drop("_sig")


def dictionary_lookup(df: DataFrame, col: str, dictionary: DataFrame, unknown_code: int, out=None,
                      value_col="value", code_col="code") -> DataFrame:
    """Code of each value from a (value, code) dictionary; unknown values get ``unknown_code``."""
    d = _maybe_broadcast(dictionary.select(F.col(value_col).alias("_v"), F.col(code_col).alias("_code")))
    j = df.join(d, F.col(col) == F.col("_v"), "left")
    return j.withColumn(out or f"{col}_code", F.coalesce(F.col("_code"), F.lit(unknown_code))).drop("_v", "_code")


def attach_predictions(y: DataFrame, preds: DataFrame, key=("symbol", "ts")) -> DataFrame:
    """Predictions joined to targets by key."""
    return y.join(preds, list(key), "inner")


def with_parameter_grid(df: DataFrame, name: str, values: list) -> DataFrame:
    """One copy of each row per parameter value of a small, fixed grid
    (``explode`` of a literal array: the expansion is bounded by len(values))."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
