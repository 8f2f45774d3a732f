"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

They read the given tables (or bars Spark derives from them) in full.  Double
outputs are rounded (see :func:`finish`) so that results compare exactly with
the SQL oracle in :mod:`barloom.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import finite as FI
from barloom.operators import labels as LB
from barloom.operators import signals as SG
from barloom.plans.frame import BarFrame, Win, sequence
from barloom.sources import bars as BS

# Block sizes used by the registered queries: small enough that the sf0.01
# fixtures (≈2,400 rows per symbol) span several blocks and scan blocks, so the
# halo and carry paths are what gets checked.
Q_BLOCK = 512
Q_SCAN = 128


def rnd(c: Column, d: int) -> Column:
    """Round and turn −0.0 into 0.0 (the SQL side does the same)."""
    return F.round(c, d) + F.lit(0.0)


def finish(df: DataFrame, digits: int = 6, per_col: dict | None = None) -> DataFrame:
    per_col = per_col or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(rnd(F.col(f.name), per_col.get(f.name, digits)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def daily_frame(spark: SparkSession, sf: str, block: int = Q_BLOCK, scan: int = Q_SCAN) -> BarFrame:
    return sequence(BS.bars_daily(spark, sf), block_rows=block, scan_rows=scan)


def hourly_filled(spark: SparkSession, sf: str, block: int = Q_BLOCK) -> BarFrame:
    return BS.gap_fill(BS.bars_hourly(spark, sf), "1 hour", block_rows=block)


# ---------------------------------------------------------------- flagship slice
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """events → hourly bars → gap fill → MOM/SMA/slope(7) → 10-bar forward log
    return → latch on the slope's sign → model return → totals per symbol."""
    fr = hourly_filled(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.mom(w, n=7, out="mom7"), FI.sma(w, n=7, out="sma7"),
                FI.linearreg_slope(w, n=7, out="slope7"), LB.forward_log_return(w, h=10, out="fwd10"))
    sig = F.when(F.col("slope7") > 1e-9, 1).when(F.col("slope7") < -1e-9, -1).otherwise(0)
    fr = fr.with_df(fr.df.withColumn("signal", sig))
    fr = SG.latch(fr, "signal", 10.0, 0.0, "position")
    fr = SG.model_return(fr, "position", lag=1, out="pnl", cum_out="cum_pnl")
    out = fr.df.groupBy("symbol").agg(
        F.count(F.lit(1)).cast("long").alias("n_bars"),
        F.sum(F.col("filled").cast("long")).cast("long").alias("n_filled"),
        F.sum("mom7").alias("sum_mom7"),
        F.avg("sma7").alias("avg_sma7"),
        F.avg("fwd10").alias("avg_fwd10"),
        F.sum("pnl").alias("total_pnl"),
        F.max_by("cum_pnl", "rn").alias("final_cum_pnl"),
        F.sum(F.when(F.col("position") > 0, 1).otherwise(0)).cast("long").alias("bars_long"))
    return finish(out, 4, {"avg_fwd10": 6})


QUERIES = {
    "flagship_hourly_latch_pnl": flagship,
}
