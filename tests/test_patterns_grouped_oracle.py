"""Candle patterns on hand-made bars, grouped (non-linear) kernels, and a sample
of registered queries against their DuckDB oracle (as the driver does)."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import patterns as PT
from barloom.operators import grouped as GR
from barloom.plans.frame import Win, sequence
from conftest import SF_SMALL


def _bars(spark, ohlc):
    rows = []
    base = [(100, 101, 99, 100.5)] * 12  # 12 ordinary bars: averages for the rules
    for i, (o, h, lo, c) in enumerate(base + ohlc):
        rows.append(dict(symbol="A", ts=pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=i),
                         open=float(o), high=float(h), low=float(lo), close=float(c), volume=1.0))
    return spark.createDataFrame(pd.DataFrame(rows)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _last(spark, ohlc, name):
    fr = sequence(_bars(spark, ohlc))
    fr = fr.add(PT.pattern_feats(Win(fr.key, fr.block), [name]))
    return fr.df.orderBy(F.col("rn").desc()).first()[name]


def test_doji_and_near_miss(spark):
    assert _last(spark, [(100, 101, 99, 100.05)], "CDLDOJI") == 100
    assert _last(spark, [(100, 101, 99, 100.9)], "CDLDOJI") == 0


def test_engulfing(spark):
    assert _last(spark, [(100.5, 101, 99.8, 100), (99.6, 101.2, 99.5, 101)], "CDLENGULFING") == 100
    assert _last(spark, [(100.5, 101, 99.8, 100), (100.4, 100.6, 99.9, 100.1)], "CDLENGULFING") == 0


def test_matching_low_and_in_neck(spark):
    assert _last(spark, [(102, 102.2, 99.9, 100), (101, 101.2, 99.9, 100.01)], "CDLMATCHINGLOW") == 100
    # long black, then white opening under its low and closing just at its close
    assert _last(spark, [(104, 104.2, 99.8, 100), (99.0, 100.3, 98.9, 100.02)], "CDLINNECK") == -100
    assert _last(spark, [(104, 104.2, 99.8, 100), (99.0, 101.5, 98.9, 101.4)], "CDLINNECK") == 0


def test_grouped_blocks_match_whole_series(spark):
    from barloom.sources.bars import ticks_orders_ohlc
    t = ticks_orders_ohlc(spark, "/root/testdata/sf0.01")
    fr = sequence(t, order=("ts", "seq"), block_rows=1024, rn_mode="range")
    p = GR.parabolic_sar(GR.cycle_indicators(fr)).df.select("rn", "close", "high", "low", "SAR", "HT_DCPERIOD",
                                                             "HT_SINE_sine").toPandas().sort_values("rn")
    ht = GR.ht_kernel(p.close.to_numpy())
    sar = GR.sar_kernel(p.high.to_numpy(), p.low.to_numpy())
    np.testing.assert_allclose(p.HT_DCPERIOD.to_numpy(), ht["HT_DCPERIOD"], atol=1e-9, equal_nan=True)
    np.testing.assert_allclose(p.HT_SINE_sine.to_numpy(), ht["HT_SINE_sine"], atol=1e-9, equal_nan=True)
    np.testing.assert_allclose(p.SAR.to_numpy(), sar, atol=1e-9, equal_nan=True)


@pytest.mark.parametrize("holding,stop,signal", [(20, 0.02, "constant"), (3000, 0.9, "constant"), (700, 0.05, "sparse")])
def test_exits_equal_one_loop_over_many_blocks(spark, holding, stop, signal):
    """Positions held across blocks and out-of-phase time exits: every row equals the loop over the whole series."""
    rng = np.random.default_rng(3)
    n = 6000
    close = np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.004, n))), 2)
    sig = np.ones(n) if signal == "constant" else rng.choice([0, 0, 0, 1, -1], n)
    pdf = pd.DataFrame(dict(symbol="A", ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="m"), close=close, gate=sig))
    pdf.loc[::1500, "gate"] = np.nan
    fr = sequence(spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")), block_rows=512)
    got = GR.path_exits(fr, "gate", size=2.0, max_holding=holding, stop_pct=stop).df.orderBy("rn").toPandas().target.to_numpy()
    want, _ = GR.exits_run(pdf.gate.tolist(), close.tolist(), 0, None, 2.0, holding, stop)
    np.testing.assert_array_equal(got, want)


def test_sar_in_a_steady_trend(spark):
    """No reversal for many blocks: the state still arrives."""
    n = 3000
    base = np.linspace(100, 400, n)
    pdf = pd.DataFrame(dict(symbol="A", ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="m"), high=base + 1, low=base - 1))
    fr = sequence(spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz")), block_rows=512)
    got = GR.parabolic_sar(fr, warmup=16).df.orderBy("rn").toPandas().SAR.to_numpy()
    np.testing.assert_allclose(got, GR.sar_kernel(pdf.high, pdf.low), rtol=1e-11, equal_nan=True)


SAMPLE = ["flagship_hourly_latch_pnl", "w01_sma", "w02_ema", "w23_rsi", "w40_w41_adx_adxr", "k19_cdlengulfing",
          "agg2_gap_fill", "lab4_quantile_classes", "pnl3_daily_statistics", "tab4_quantile_transform_uniform",
          "cv1_time_series_folds", "st1_stream_tick_bars"]


def _norm(df):
    cols = sorted(df.columns)
    out = []
    for _, r in df.iterrows():
        vals = []
        for c in cols:
            v = r[c]
            if isinstance(v, np.generic):
                v = v.item()
            if v is None or (isinstance(v, float) and np.isnan(v)):
                vals.append("NULL")
            elif hasattr(v, "isoformat"):
                vals.append(pd.Timestamp(v).isoformat())
            else:
                vals.append(repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else repr(v))
        out.append("|".join(vals))
    return cols, sorted(out)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ["orders", "events", "customer", "part"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    o = con.execute(E.oracle_sql()[name]).df()
    assert _norm(s) == _norm(o)


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "total_pnl" in df.columns


def test_identical_three_crows(spark):
    bars = [(105, 105.2, 103.9, 104), (104, 104.1, 102.95, 103), (103, 103.1, 101.95, 102)]
    assert _last(spark, bars, "CDLIDENTICAL3CROWS") == -100
    near = [(105, 105.2, 103.9, 104), (104, 104.1, 102.95, 103), (103.5, 103.6, 101.95, 102)]
    assert _last(spark, near, "CDLIDENTICAL3CROWS") == 0


def test_upside_gap_two_crows(spark):
    bars = [(100, 102.1, 99.9, 102), (103, 103.2, 102.4, 102.6), (103.5, 103.6, 102.4, 102.5)]
    assert _last(spark, bars, "CDLUPSIDEGAP2CROWS") == -100
    near = [(100, 102.1, 99.9, 102), (103, 103.2, 102.4, 102.6), (103.5, 103.6, 101.8, 101.9)]
    assert _last(spark, near, "CDLUPSIDEGAP2CROWS") == 0


def test_ladder_bottom(spark):
    bars = [(103, 103.2, 101.8, 102), (102.5, 102.6, 101.3, 101.5), (102, 102.1, 100.8, 101),
            (101.5, 102.2, 100.3, 100.5), (101.8, 102.6, 101.7, 102.5)]
    assert _last(spark, bars, "CDLLADDERBOTTOM") == 100
    near = bars[:-1] + [(101.8, 102.3, 101.7, 102.1)]
    assert _last(spark, near, "CDLLADDERBOTTOM") == 0


def test_concealing_baby_swallow(spark):
    bars = [(104, 104.05, 102.95, 103), (103, 103.05, 101.95, 102), (101.5, 102.5, 100.9, 101),
            (102.8, 102.9, 100.5, 100.7)]
    assert _last(spark, bars, "CDLCONCEALBABYSWALL") == 100
    near = bars[:-1] + [(102.3, 102.4, 100.5, 100.7)]
    assert _last(spark, near, "CDLCONCEALBABYSWALL") == 0
