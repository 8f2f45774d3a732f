"""Hand-made tables: exact values, zero denominators, symbols that must not mix, short series."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import recurrent as RC
from barloom.plans.frame import Win, sequence


def _bars(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _make(n=40, symbol="A", seed=1, const=False):
    rng = np.random.default_rng(seed)
    c = np.full(n, 10.0) if const else 100 + np.cumsum(rng.normal(0, 1, n))
    o = c if const else c + rng.normal(0, 0.5, n)
    h = np.maximum(o, c) + (0 if const else 0.3)
    lo = np.minimum(o, c) - (0 if const else 0.3)
    ts = pd.date_range("2024-01-01", periods=n, freq="min")
    return [dict(symbol=symbol, ts=t, open=float(a), high=float(b), low=float(d), close=float(e), volume=10.0)
            for t, a, b, d, e in zip(ts, o, h, lo, c)]


def test_constant_prices_give_zero_not_nan(spark):
    fr = sequence(_bars(spark, _make(40, const=True)))
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.willr(w, n=14), FI.stochf(w, fastk=5, fastd=3), FI.cci(w, n=14), FI.correl(w, n=10),
                FI.beta(w, n=5), FI.bop())
    fr = RC.rsi(fr, n=14)
    p = fr.df.toPandas()
    for c in ["WILLR_14", "STOCHF_5_3_fastk", "CCI_14", "CORREL_10", "BETA_5", "BOP", "RSI_14"]:
        v = p[c].dropna()
        assert len(v) > 0 and (v == 0).all(), c


def test_symbols_do_not_mix_and_row_order_is_irrelevant(spark):
    a, b = _make(40, "A", 1), _make(25, "B", 2)
    rows = a + b
    df1 = _bars(spark, rows)
    df2 = _bars(spark, list(reversed(rows)))
    def run(df):
        fr = sequence(df, block_rows=8, scan_rows=4)
        w = Win(fr.key, fr.block)
        fr = RC.ema(fr.add(FI.sma(w, n=5)), n=5)
        return fr.df.select("symbol", "ts", "SMA_5", "EMA_5").toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)
    x, y = run(df1), run(df2)
    pd.testing.assert_frame_equal(x, y)
    only_a = run(_bars(spark, a))
    np.testing.assert_allclose(x[x.symbol == "A"].EMA_5.to_numpy(), only_a.EMA_5.to_numpy(), equal_nan=True)


def test_series_shorter_than_lookback_is_all_null(spark):
    fr = sequence(_bars(spark, _make(10)))
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.sma(w, n=30), FI.willr(w, n=14))
    fr = RC.adx(RC.ema(fr, n=30), n=14)
    p = fr.df.toPandas()
    assert p[["SMA_30", "WILLR_14", "EMA_30", "ADX_14"]].isna().all().all()


def test_exact_sma_ema_values(spark):
    rows = _make(40)
    fr = sequence(_bars(spark, rows))
    w = Win(fr.key, fr.block)
    fr = RC.ema(fr.add(FI.sma(w, n=5)), n=5)
    p = fr.df.toPandas().sort_values("ts")
    c = np.array([r["close"] for r in rows])
    np.testing.assert_allclose(p.SMA_5.to_numpy()[4:], pd.Series(c).rolling(5).mean().to_numpy()[4:])
    e = [c[:5].mean()]
    for x in c[5:]:
        e.append(e[-1] * (1 - 1 / 3) + x / 3)
    np.testing.assert_allclose(p.EMA_5.to_numpy()[4:], np.array(e))
    assert p.SMA_5.isna().sum() == 4 and p.EMA_5.isna().sum() == 4


def test_no_look_ahead(spark):
    rows = _make(40)
    def run(rs):
        fr = sequence(_bars(spark, rs))
        w = Win(fr.key, fr.block)
        fr = RC.macd(RC.rsi(fr.add(FI.sma(w, n=5), FI.aroonosc(w, n=5)), n=7), fast=3, slow=6, signal=3)
        return fr.df.select("ts", "SMA_5", "AROONOSC_5", "RSI_7", "MACD_3_6_3_signal").toPandas().sort_values("ts").reset_index(drop=True)
    full, cut = run(rows), run(rows[:30])
    pd.testing.assert_frame_equal(full.iloc[:30].reset_index(drop=True), cut)
