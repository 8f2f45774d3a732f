"""Bar frame: distributed row numbers, halo windows and block scans are exact."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import recurrent as RC
from barloom.plans.frame import Win, sequence
from barloom.sources import bars as BS
from conftest import SF_MID, SF_SMALL


def _series(spark, sf=SF_MID):
    return BS.ticks_orders_ohlc(spark, sf)


def test_range_row_numbers_equal_global_order(spark):
    t = _series(spark)
    fr = sequence(t, order=("ts", "seq"), rn_mode="range", partitions=7)
    ref = t.select("ts", "seq", F.row_number().over(Window.orderBy("ts", "seq")).alias("rn2"))
    j = fr.df.join(ref, ["ts", "seq"])
    assert j.where(F.col("rn") != F.col("rn2")).count() == 0
    assert j.count() == t.count()


def _finite(fr):
    w = Win(fr.key, fr.block)
    return fr.add(FI.sma(w, n=37), FI.wma(w, n=9), FI.stoch(w, fastk=14, slowk=3, slowd=3),
                  FI.aroonosc(w, n=14), FI.linearreg_slope(w, n=21), FI.cci(w, n=14), FI.mfi(w, n=14))


COLS = ["SMA_37", "WMA_9", "STOCH_14_3_3_slowk", "AROONOSC_14", "LINEARREG_SLOPE_21", "CCI_14", "MFI_14"]


def test_blocked_equals_unblocked_finite(spark):
    t = _series(spark)
    a = _finite(sequence(t, order=("ts", "seq"), block_rows=64, rn_mode="range")).df.select("rn", *COLS)
    b = _finite(sequence(t, order=("ts", "seq"), block_rows=1 << 20, rn_mode="window")).df.select("rn", *COLS)
    pa, pb = a.toPandas().sort_values("rn").reset_index(drop=True), b.toPandas().sort_values("rn").reset_index(drop=True)
    for c in COLS:
        assert pa[c].isna().equals(pb[c].isna()), c
        np.testing.assert_allclose(pa[c].to_numpy(float), pb[c].to_numpy(float), rtol=1e-9, atol=1e-7, equal_nan=True)


def _loop_ema(x, n, start=0):
    a = 2 / (n + 1)
    y = np.full(len(x), np.nan)
    y[start + n - 1] = x[start:start + n].mean()
    for i in range(start + n, len(x)):
        y[i] = y[i - 1] * (1 - a) + a * x[i]
    return y


def _loop_wilder(x, n, start):
    y = np.full(len(x), np.nan)
    y[start + n - 1] = x[start:start + n].mean()
    for i in range(start + n, len(x)):
        y[i] = (y[i - 1] * (n - 1) + x[i]) / n
    return y


def test_scans_match_loops_for_several_blocks(spark):
    t = _series(spark, SF_SMALL)
    for block, scan in [(16, 16), (256, 64), (4096, 512)]:
        fr = sequence(t, order=("ts", "seq"), block_rows=block, scan_rows=scan, rn_mode="range")
        fr = RC.rsi(RC.ema(fr, n=7), n=14)
        fr = RC.kama(fr, n=10)
        p = fr.df.select("rn", "close", "EMA_7", "RSI_14", "KAMA_10").toPandas().sort_values("rn")
        c = p.close.to_numpy()
        np.testing.assert_allclose(p.EMA_7.to_numpy(), _loop_ema(c, 7), rtol=1e-10, equal_nan=True)
        d = np.diff(c, prepend=np.nan)
        g, lo = np.where(d > 0, d, 0.0), np.where(d < 0, -d, 0.0)
        ag, al = _loop_wilder(g, 14, 1), _loop_wilder(lo, 14, 1)
        rsi = np.where(ag + al == 0, 0.0, 100 * ag / (ag + al))
        np.testing.assert_allclose(p.RSI_14.to_numpy(), rsi, rtol=1e-9, atol=1e-9, equal_nan=True)
        # KAMA loop
        n = 10
        k = np.full(len(c), np.nan)
        prev = c[n - 1]
        for i in range(n, len(c)):
            er_den = np.abs(np.diff(c[i - n:i + 1])).sum()
            er = 1.0 if er_den == 0 else min(1.0, abs(c[i] - c[i - n]) / er_den)
            sc = (er * (2 / 3 - 2 / 31) + 2 / 31) ** 2
            prev = prev + sc * (c[i] - prev)
            k[i] = prev
        np.testing.assert_allclose(p.KAMA_10.to_numpy(), k, rtol=1e-9, equal_nan=True)


def test_ffill_running_and_cumsum(spark):
    t = _series(spark, SF_SMALL)
    fr = sequence(t, order=("ts", "seq"), block_rows=32, scan_rows=8, rn_mode="range")
    fr = fr.ffill("ff", F.when(F.col("volume") > 40, F.col("close")))
    fr = fr.running("rmax", F.col("close"), "max")
    fr = fr.cumsum("cs", F.col("volume"))
    p = fr.df.select("rn", "close", "volume", "ff", "rmax", "cs").toPandas().sort_values("rn")
    exp_ff = p.close.where(p.volume > 40).ffill()
    assert np.allclose(p.ff.to_numpy(), exp_ff.to_numpy(), equal_nan=True)
    assert np.allclose(p.rmax.to_numpy(), p.close.cummax().to_numpy())
    assert np.allclose(p.cs.to_numpy(), p.volume.cumsum().to_numpy())


def test_feature_plan_fast_forms_match_sliding_frames(spark):
    """Running-sum / doubling-table forms of the feature plan equal the exact
    sliding-frame builders (same NULL warm-up, values to ~1e-9 relative)."""
    from barloom.plans import features as FP
    bases = ["APO", "AROONOSC", "STOCH_slowk", "STOCHF_fastk", "PPO", "ULTOSC", "WILLR", "MFI"] + FP.MATH
    out = {}
    for fast in (True, False):
        fr = sequence(BS.bars_daily(spark, SF_SMALL), block_rows=64)
        df = FP.generate_all_features(fr, [7, 17], bases, patterns=False, time=False, cycle=False,
                                      dropna=False, fast=fast).df.drop("blk", "sblk")
        out[fast] = df.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)
    a, b = out[True], out[False]
    assert list(a.columns) == list(b.columns)
    for c in a.columns:
        if c in ("symbol", "ts") or a[c].dtype == object:
            continue
        x, y = a[c].to_numpy(float), b[c].to_numpy(float)
        assert np.array_equal(np.isnan(x), np.isnan(y)), c
        m = ~np.isnan(x)
        assert np.all(np.abs(x[m] - y[m]) <= 1e-9 * np.maximum(1.0, np.abs(y[m])) + 1e-6), c
