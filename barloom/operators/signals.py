"""Signals → positions (SIG1–SIG3) and PnL tables (PNL1–PNL4).

"Keep the last value" rules are forward fills, which run block-wise
(:meth:`BarFrame.ffill`), so one long series is not a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.finite import Feat, col
from barloom.plans.frame import BarFrame, Win


def two_model_gate(enter_cls="enter_cls", enter_p="enter_p", hold_cls="hold_cls", hold_p="hold_p",
                   threshold=0.8, out="gate") -> Column:
    """SIG1: long (1) if enter = 'strong buy' and hold = 'long hold', both with p > threshold;
    short (−1) mirrored ('strong sell', 'short hold'); else 0."""
    long_ = ((col(enter_cls) == "strong buy") & (col(enter_p) > threshold)
             & (col(hold_cls) == "long hold") & (col(hold_p) > threshold))
    short_ = ((col(enter_cls) == "strong sell") & (col(enter_p) > threshold)
              & (col(hold_cls) == "short hold") & (col(hold_p) > threshold))
    return F.when(long_, F.lit(1)).when(short_, F.lit(-1)).otherwise(F.lit(0)).alias(out)


def threshold_hold(fr: BarFrame, ret="ret", threshold=0.003, scale=1000.0, out="target") -> BarFrame:
    """SIG2: abs(ret) > threshold → target ret·scale; otherwise keep the last target (0 at start)."""
    sig = F.when(F.abs(col(ret)) > threshold, col(ret) * scale)
    fr = fr.ffill("_sig2", sig)
    return fr.with_df(fr.df.withColumn(out, F.coalesce(F.col("_sig2"), F.lit(0.0))).drop("_sig2"))


def latch(fr: BarFrame, signal="signal", on_value=10.0, off_value=0.0, out="position") -> BarFrame:
    """SIG3: signal 1 → on_value, −1 → off_value, else keep the last (off_value at start)."""
    sig = F.when(col(signal) == 1, F.lit(float(on_value))).when(col(signal) == -1, F.lit(float(off_value)))
    fr = fr.ffill("_sig3", sig)
    return fr.with_df(fr.df.withColumn(out, F.coalesce(F.col("_sig3"), F.lit(float(off_value)))).drop("_sig3"))


def model_return(fr: BarFrame, position="position", lag: int = 1, o="open", c="close",
                 out="pnl", cum_out="cum_pnl") -> BarFrame:
    """PNL1: bar return (c − o) × position (``lag=1``: position of the previous bar;
    ``lag=0``: same bar, as the reference does) and its running sum."""
    w = Win(fr.key, fr.block)
    pos = w.lag(col(position), lag) if lag else col(position)
    fr = fr.add(Feat([(out, F.coalesce(pos, F.lit(0.0)) * (col(c) - col(o)))], lag))
    return fr.cumsum(cum_out, F.col(out))


def pnl_with_costs(fr: BarFrame, position="position", c="close", rate=0.001, slippage=0.1,
                   size=100.0, out_prefix="") -> BarFrame:
    """PNL2: trade = Δposition; cost = |trade|·size·(price·rate + slippage);
    pnl = position₋₁·(c − c₋₁)·size − cost; plus running balance change."""
    w = Win(fr.key, fr.block)
    p = col(position)
    pp = F.coalesce(w.lag(p, 1), F.lit(0.0))
    trade = p - pp
    cost = F.abs(trade) * size * (col(c) * rate + slippage)
    gross = F.coalesce(pp * (col(c) - w.lag(col(c), 1)) * size, F.lit(0.0))
    pre = out_prefix
    fr = fr.add(Feat([(f"{pre}trade", trade), (f"{pre}cost", cost), (f"{pre}gross", gross),
                      (f"{pre}net", gross - cost)], 1))
    return fr.cumsum(f"{pre}cum_net", F.col(f"{pre}net"))


def daily_statistics(df: DataFrame, key="symbol", ts="ts", net="net", trade="trade",
                     capital=10_000_000.0, annual_days=240, extra_keys: list[str] | None = None) -> DataFrame:
    """PNL3: per key — end balance, total return, max drawdown, Sharpe of daily returns
    (mean/sd·√annual_days) and number of trades.

    Daily rows come from one aggregate; the running balance and its running max
    are windows over the (small) daily table per key.
    """
    keys = [key] + list(extra_keys or [])
    daily = (df.groupBy(*keys, F.to_date(F.col(ts)).alias("day"))
             .agg(F.sum(net).alias("day_net"),
                  F.sum(F.when(F.col(trade) != 0, 1).otherwise(0)).alias("day_trades")))
    wk = Window.partitionBy(*keys).orderBy("day")
    run = wk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = daily.withColumn("balance", F.lit(capital) + F.sum("day_net").over(run))
    daily = daily.withColumn("peak", F.greatest(F.max("balance").over(run), F.lit(capital)))
    daily = daily.withColumn("drawdown", F.col("balance") - F.col("peak"))
    prev_bal = F.coalesce(F.lag("balance").over(wk), F.lit(capital))
    daily = daily.withColumn("day_ret", F.col("day_net") / prev_bal)
    return daily.groupBy(*keys).agg(
        F.max_by("balance", "day").alias("end_balance"),
        ((F.max_by("balance", "day") / F.lit(capital)) - 1.0).alias("total_return"),
        F.min("drawdown").alias("max_drawdown"),
        F.when(F.stddev_samp("day_ret") > 0,
               F.avg("day_ret") / F.stddev_samp("day_ret") * math.sqrt(annual_days)).otherwise(0.0).alias("sharpe"),
        F.sum("day_trades").cast("long").alias("trade_count"),
        F.count(F.lit(1)).cast("long").alias("days"))
