"""All 61 candle patterns on random bars: the Spark rules against the second set
of rules (``plans/pattern_oracle.py``), and every pattern must fire."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import patterns as PT
from barloom.plans import pattern_oracle as PO
from barloom.plans.frame import Win, sequence

# Rare shapes after ordinary bars: (open, high, low, close) per bar (hand-made, fixed values).
RARE = {
    "CDL2CROWS": [(100, 103.2, 99.9, 103), (105, 105.2, 103.8, 104), (104.5, 104.6, 101.4, 101.5)],
    "CDL3BLACKCROWS": [(100, 103.1, 99.9, 103), (102.8, 102.9, 101.95, 102), (102.4, 102.5, 100.95, 101), (101.4, 101.5, 99.95, 100)],
    "CDL3STARSINSOUTH": [(110, 110.1, 88, 100), (103, 103.2, 92, 99), (98, 98.02, 96.98, 97)],
    "CDLBREAKAWAY": [(100, 100.2, 93.8, 94), (93, 93.3, 91.8, 92), (92, 92.8, 90.9, 91), (91, 92, 89.5, 90), (90, 93.9, 89.9, 93.5)],
    "CDLCONCEALBABYSWALL": [(104, 104.05, 102.95, 103), (103, 103.05, 101.95, 102), (101.5, 102.5, 100.9, 101), (102.8, 102.9, 100.5, 100.7)],
    "CDLMATHOLD": [(100, 106.2, 99.8, 106), (107, 107.2, 106.3, 106.5), (106.4, 106.5, 105.8, 106.0), (105.9, 106.0, 105.2, 105.4), (106, 108.2, 105.9, 108)],
    "CDLRISEFALL3METHODS": [(100, 106.2, 99.8, 106), (105, 105.1, 104.4, 104.5), (104.6, 104.7, 103.9, 104), (104, 104.1, 103.4, 103.5), (104, 107.2, 103.9, 107)],
    "CDLLADDERBOTTOM": [(103, 103.2, 101.8, 102), (102.5, 102.6, 101.3, 101.5), (102, 102.1, 100.8, 101), (101.5, 102.2, 100.3, 100.5),
                        (101.8, 102.6, 101.7, 102.5)],
    "CDLIDENTICAL3CROWS": [(105, 105.2, 103.9, 104), (104, 104.1, 102.95, 103), (103, 103.1, 101.95, 102)],
    "CDLUPSIDEGAP2CROWS": [(100, 102.1, 99.9, 102), (103, 103.2, 102.4, 102.6), (103.5, 103.6, 102.4, 102.5)],
    "CDLINNECK": [(104, 104.2, 99.8, 100), (99.0, 100.3, 98.9, 100.02)],
    "CDLABANDONEDBABY": [(100, 103.2, 99.9, 103), (104, 104.2, 103.8, 104.02), (103.5, 103.6, 100.4, 100.5)],
    "CDL3LINESTRIKE": [(100, 101.1, 99.9, 101), (100.5, 102.1, 100.4, 102), (101.5, 103.1, 101.4, 103), (103.5, 103.6, 99.4, 99.5)],
}


def random_bars(n=6000, seed=5):
    """Bars on a coarse price grid, so that equal prices, gaps, dojis and nested bars are common."""
    rng = np.random.default_rng(seed)
    rows, last = [], (100.0, 101.0, 99.0, 100.5)
    names = list(RARE)
    while len(rows) < n:
        if rng.random() < 0.01:
            shape = RARE[names[rng.integers(len(names))]]
            rows += [(100.0, 101.0, 99.0, 100.5)] * 12 + [tuple(map(float, b)) for b in shape]
            last = rows[-1]
            continue
        o = last[rng.integers(4)] + rng.choice([0, 0, 0.02, -0.02, 0.5, -0.5, 1, -1, 2, -2])
        c = o + rng.choice([0, 0.05, 0.2, 0.5, 1, 2, 4]) * rng.choice([-1, 1])
        if rng.random() < 0.2:
            c = last[rng.integers(4)]
        h = max(o, c) + rng.choice([0, 0, 0.02, 0.3, 1, 3])
        lo = min(o, c) - rng.choice([0, 0, 0.02, 0.3, 1, 3])
        if not 20 < lo < 300:
            o, h, lo, c = 100.0, 101.0, 99.0, 100.5
        last = (round(o, 2), round(h, 2), round(lo, 2), round(c, 2))
        rows.append(last)
    return rows[:n]


@pytest.fixture(scope="module")
def bars():
    parts = []
    for k, sym in enumerate("AB"):
        df = pd.DataFrame(random_bars(seed=5 + k), columns=["open", "high", "low", "close"])
        parts.append(df.assign(symbol=sym, rn=np.arange(1, len(df) + 1)))
    df = pd.concat(parts, ignore_index=True)
    return df.assign(ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(df.rn, unit="m"))


def test_all_patterns_agree_and_fire(spark, bars):
    con = duckdb.connect()
    con.register("bars", bars)
    sql = f"WITH {', '.join(PO.pattern_ctes(PO.NAMES, 'bars'))} SELECT symbol, rn, {', '.join(PO.NAMES)} FROM pat ORDER BY symbol, rn"
    want = con.execute(sql).df()
    assert PO.NAMES == PT.ALL_PATTERNS
    fr = sequence(spark.createDataFrame(bars.drop(columns="rn")).withColumn("ts", F.col("ts").cast("timestamp_ntz")), block_rows=1024)
    fr = fr.add(PT.pattern_feats(Win(fr.key, fr.block)))
    got = fr.df.select("symbol", "rn", *PO.NAMES).toPandas().sort_values(["symbol", "rn"]).reset_index(drop=True)
    differ = [n for n in PO.NAMES if not got[n].fillna(-1).astype(int).equals(want[n].fillna(-1).astype(int))]
    assert differ == []
    assert [n for n in PO.NAMES if not (want[n].fillna(0) != 0).any()] == []
    # and every pattern is absent most of the time (its near misses)
    assert [n for n in PO.NAMES if (want[n].fillna(0) != 0).mean() > 0.6] == []
