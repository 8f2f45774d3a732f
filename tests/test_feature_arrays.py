"""Array form of the feature plan: against the column form and against window loops, and its rank table."""

import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_streams_and_tables import make_bars, sdf

from barloom.functions import finite as FI
from barloom.plans import feature_arrays as FA
from barloom.plans import features as FP
from barloom.plans.frame import Win, sequence


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=70), st.integers(0, 10 ** 6))
def test_rank_sums_against_counting(values, seed):
    x, rng = np.array(values, float), np.random.default_rng(seed)
    lo = rng.integers(0, len(x) + 1, 40)
    hi = np.minimum(lo + rng.integers(0, len(x) + 1, 40), len(x))
    bound = rng.uniform(-6, 6, 40).round(int(rng.integers(0, 2)))
    count, total = FA.RankSums(x).upto(lo, hi, bound)
    for i in range(40):
        part = x[lo[i]:hi[i]]
        assert count[i] == (part <= bound[i]).sum() and total[i] == pytest.approx(part[part <= bound[i]].sum())


def test_cci_equals_the_window_form_and_costs_the_same_at_any_lag(spark):
    bars = make_bars(700, "AB")
    bars.loc[100:320, ["open", "high", "low", "close"]] = 50.0  # a constant stretch: 0
    fr = sequence(sdf(spark, bars), block_rows=256)
    got = FA.cci_blocks(fr, [7, 147]).df.select("symbol", "rn", "CCI_7", "CCI_147").toPandas().sort_values(["symbol", "rn"])
    w = Win(fr.key, fr.block)
    want = fr.add(FI.cci(w, n=7), FI.cci(w, n=147)).df.select("symbol", "rn", "CCI_7", "CCI_147").toPandas().sort_values(["symbol", "rn"])
    for c in ("CCI_7", "CCI_147"):
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-7, atol=1e-7, equal_nan=True)
    assert (got[(got.symbol == "A") & got.rn.between(260, 320)].CCI_147 == 0).all()
    tp = np.cumsum(np.random.default_rng(0).normal(0, 1, 4096)) + 100

    def seconds(n):
        t = time.perf_counter()
        for _ in range(20):
            FA.cci_values(FA.Windows(), tp, n)
        return time.perf_counter() - t

    seconds(7)
    assert seconds(147) < 2 * seconds(7)


@pytest.mark.parametrize("lags", [[7, 27], [2, 3, 60]])
def test_arrays_equal_columns(spark, lags):
    """Blocks of 128 rows: carries over blocks in all four passes, and windows that reach over several."""
    bars = make_bars(600, "AB")
    bars.loc[40:60, ["high", "low"]] = bars.loc[40:60, ["close", "close"]].to_numpy()  # no range
    fr = sequence(sdf(spark, bars[~((bars.symbol == "B") & (bars.index % 1000 > 820))]), block_rows=128, scan_rows=64)
    args = dict(patterns=False, time=False, cycle=False, dropna=False)
    pairs = [(b, n) for b in FP.VOLUME + FP.MOMENTUM + FP.MATH + FP.EXTRA for n in lags]
    a, b = (FP.generate_all_features(fr, pairs=pairs, arrays=x, **args).df.toPandas().sort_values(["symbol", "rn"]) for x in (True, False))
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    for c in a.columns[4:]:
        if a[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].to_numpy(), b[c].to_numpy(), rtol=1e-7, atol=1e-7, equal_nan=True, err_msg=c)


def test_all_lags_give_581_columns_in_one_plan(spark):
    bars = make_bars(1400, "A")
    fr = sequence(sdf(spark, bars))
    df = FP.generate_all_features(fr).df
    feats = [c for c in df.columns if c not in ("symbol", "ts", "rn", "blk", "sblk", "open", "high", "low", "close", "volume")]
    assert len(feats) == 581 and feats == sorted(feats)
    assert 0 < df.count() < 1400  # rows with a NULL are gone


def test_null_inside_a_series_raises(spark):
    bars = sdf(spark, make_bars(60, "A")).withColumn("close", F.when(F.col("ts") != pd.Timestamp("2024-01-02"), F.col("close")))
    with pytest.raises(Exception, match="NULL inside"):
        FP.generate_all_features(sequence(bars), pairs=[("RSI", 7)], patterns=False, time=False, cycle=False, arrays=True).df.count()
