"""Streams against batch, resumed scans, long carries, hot values, and small contracts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import recurrent as RC
from barloom.operators import aggregates as AG
from barloom.operators import grouped as GR
from barloom.operators import labels as LB
from barloom.operators import learning as LN
from barloom.operators import tabular as TAB
from barloom.plans import features as FP
from barloom.plans import frame as FRAME
from barloom.plans.frame import Win, sequence
from barloom.sources import tables as TB
from barloom.streaming import bars as ST


def make_bars(n=900, symbols="AB", seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for s in symbols:
        c = 100 + np.cumsum(rng.normal(0, 1, n))
        o = c + rng.normal(0, 0.5, n)
        out.append(pd.DataFrame(dict(symbol=s, ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="h"), open=o,
                                     high=np.maximum(o, c) + 1, low=np.minimum(o, c) - 1, close=c, volume=rng.integers(1, 9, n) * 1.0)))
    return pd.concat(out, ignore_index=True)


def sdf(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def plan(fr):
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.wma(w, n=30), FI.ultosc(w))
    fr = RC.ema(fr, n=147)
    fr = RC.rsi(fr, n=14)
    fr = RC.adx(fr, n=14)
    return RC.macd(fr, fast=12, slow=26, signal=9)


COLS = ["WMA_30", "ULTOSC_7_14_28", "EMA_147", "RSI_14", "ADX_14", "MACD_12_26_9_hist"]


def test_stream_batches_equal_one_batch(spark):
    bars = make_bars(500)
    full = plan(sequence(sdf(spark, bars), block_rows=256)).df
    cols = [c for c in COLS if c in full.columns]
    assert "EMA_147" in cols and "ADX_14" in cols
    want = full.select("symbol", "ts", *cols).toPandas().sort_values(["symbol", "ts"])
    times = sorted(bars.ts.unique())
    cuts = [times[0], times[60], times[61], times[300], times[-1] + pd.Timedelta("1h")]
    fs = ST.FeatureStream(spark, plan, buffer=128, block_rows=256)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = bars[(bars.ts >= a) & (bars.ts < b)].sample(frac=1, random_state=k)  # rows in no order
        if k == 2:
            fs = ST.FeatureStream(spark, plan, buffer=128, base=fs.base, block_rows=256)  # a restart
        fs.process(sdf(spark, part), k)
        if k == 1:
            fs.process(sdf(spark, part), k)  # a batch that runs again
    got = spark.read.parquet(fs.out).select("symbol", "ts", *cols).toPandas().sort_values(["symbol", "ts"])
    assert len(got) == len(want)
    for c in cols:
        np.testing.assert_allclose(got[c].to_numpy(float), want[c].to_numpy(float), rtol=1e-9, atol=1e-9, equal_nan=True)
    with pytest.raises(ValueError, match="buffer"):
        ST.FeatureStream(spark, plan, buffer=8, block_rows=256).process(sdf(spark, bars[:50]), 0)


def test_stateful_exits_in_small_chunks(spark):
    rng = np.random.default_rng(2)
    n = 1200
    df = pd.DataFrame(dict(event_id=np.arange(n), ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 300, n) * 10, unit="m"),
                           user_id=1, event_type="x", value=np.round(50 + np.cumsum(rng.normal(0, 1, n)), 2), props=""))
    path = ST.scratch(spark, "chunks")
    first = df.ts < df.ts.median()
    for part in (df[first], df[~first]):
        sdf(spark, part.sample(frac=1, random_state=1)).coalesce(1).select(*ST.EVENT_SCHEMA.fieldNames()).write.mode("append").parquet(path)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "50")
    try:
        ticks = ST.event_stream(spark, path, 1).select("event_id", F.col("event_type").alias("symbol"), "ts", F.col("value").alias("close"),
                                                       F.when(F.col("value") > 52, 1).when(F.col("value") < 48, -1).otherwise(0).alias("signal"))
        out = spark.read.parquet(ST.run_to_table(ST.stateful_exits(ticks, size=1.0, max_holding=7, stop_pct=0.03), "chunks"))
        got = out.toPandas().set_index("event_id").target
    finally:
        spark.conf.set(key, old)
    s = df.sort_values(["ts", "event_id"])
    sig = np.where(s.value > 52, 1, np.where(s.value < 48, -1, 0))
    want = pd.Series(GR.exits_run(sig.tolist(), s.value.tolist(), 0, None, 1.0, 7, 0.03)[0], index=s.event_id)
    want = want[(s.ts < s.ts.max() - pd.Timedelta("1h")).to_numpy()]
    assert got.sort_index().tolist() == want.sort_index().tolist()


def test_exits_hold_bounded_arrays(spark, monkeypatch):
    """A symbol's rows go to the state and leave it in bounded pieces, whatever a micro-batch brings; gaps in ids, times and values."""
    assert ST.HELD_ROWS <= 1_000_000 and not hasattr(ST, "GroupStateTimeout")
    monkeypatch.setattr(ST, "HELD_ROWS", 100)
    sent = []
    handle = type("Handle", (), {"registerTimer": lambda self, t: None})()
    store: dict = {}
    state = type("State", (), {"updateValue": lambda self, k, v: (sent.append(len(v[0]) // ST.HELD.itemsize), store.__setitem__(k, v)),
                               "getValue": lambda self, k: store[k], "removeKey": lambda self, k: store.pop(k)})()
    end = type("End", (), {"exists": lambda self: "at" in store, "get": lambda self: store["at"], "update": lambda self, v: store.__setitem__("at", v)})()
    p = ST.Exits("symbol", "event_id", 1.0, 7, 0.03)
    p.handle, p.held, p.at = handle, state, end
    rng = np.random.default_rng(6)
    n = 5000
    df = pd.DataFrame(dict(row_us=rng.integers(0, 90, n) * 600_000_000, no_seq=False, row_seq=rng.permutation(n), row_signal=rng.integers(-1, 2, n) * 1.0,
                           row_close=50 + np.cumsum(rng.normal(0, 1, n))))
    times = lambda ms: type("Times", (), {"getCurrentWatermarkInMs": lambda self: ms})()
    chunks = lambda d: iter([d[i:i + 30] for i in range(0, len(d), 30)])
    out = [*p.handleInputRows(("x",), chunks(df), times(0))]
    assert not out and max(sent) <= 130
    for mark in (7_200_000, 30_000_000, 30_600_000, 1 << 40):
        out += p.handleExpiredTimer(("x",), times(mark), None)
    assert max(map(len, out)) <= 100 + max(np.bincount(df.row_us // 3_600_000_000))
    got = pd.concat(out)
    s = df.sort_values(["row_us", "row_seq"])
    assert got.event_id.tolist() == s.row_seq.tolist() and got.us.tolist() == s.row_us.tolist()
    assert got.target.tolist() == GR.exits_run(s.row_signal.tolist(), s.row_close.tolist(), 0, None, 1.0, 7, 0.03)[0].tolist()


def test_exits_with_gaps(spark):
    """Rows without a time never come due, rows without an id come last at their time, a missing signal keeps the position."""
    t = lambda h: pd.Timestamp("2024-01-01") + pd.Timedelta(hours=h)
    rows = [(1, t(1), 60.0), (None, t(1), 30.0), (2, None, 70.0), (3, t(2), None), (4, t(2), 55.0), (5, t(9), 1.0), (None, t(3), 70.0)]
    folder = ST.scratch(spark, "gaps")
    (spark.createDataFrame([(i, None if s is None else s.to_pydatetime(), 1, "x", v, "") for i, s, v in rows],
                           "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
     .withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(folder))
    ticks = ST.event_stream(spark, folder, 1).select("event_id", F.col("event_type").alias("symbol"), "ts", F.col("value").alias("close"),
                                                     F.when(F.col("value") > 50, 1).when(F.col("value") < 40, -1).alias("signal"))
    out = spark.read.parquet(ST.run_to_table(ST.stateful_exits(ticks, max_holding=9, stop_pct=0.9), "gaps"))
    got = {(r["event_id"], r["ts"].hour): r["target"] for r in out.collect()}
    assert got == {(1, 1): 1.0, (None, 1): -1.0, (3, 2): -1.0, (4, 2): 1.0, (None, 3): 1.0}


def test_carries_over_groups_of_blocks(spark, monkeypatch):
    """One symbol over many small groups of blocks, three levels deep."""
    monkeypatch.setattr(FRAME, "CARRY_GROUP", 3)
    bars = make_bars(700, "A")
    bars.loc[::7, "open"] = np.nan
    df = sdf(spark, bars).withColumn("open", F.when(~F.isnan("open"), F.col("open")))
    small = sequence(df, block_rows=64, scan_rows=16)
    whole = sequence(df, block_rows=4096, scan_rows=1024)
    for fr in (small, whole):
        fr = RC.ema(fr.cumsum("cs", F.col("close")), n=37).ffill("ff", F.col("open")).running("mx", F.col("close"), "max")
        out = fr.df.orderBy("rn").select("cs", "EMA_37", "ff", "mx").toPandas()
        if fr.scan_block == 16:
            first = out
    np.testing.assert_allclose(first.to_numpy(float), out.to_numpy(float), rtol=1e-11, equal_nan=True)
    np.testing.assert_allclose(first.ff.to_numpy(float), bars.open.ffill().to_numpy(), equal_nan=True)


def test_period_one_and_missing_values(spark):
    bars = make_bars(40, "A")
    fr = sequence(sdf(spark, bars), block_rows=64, scan_rows=16)
    fr = RC.macd(RC.plus_dm(RC.atr(RC.ema(fr, n=1), n=1), n=1), fast=3, slow=5, signal=1)
    out = fr.df.orderBy("rn").toPandas()
    np.testing.assert_allclose(out.EMA_1, bars.close)
    np.testing.assert_allclose(out.MACD_3_5_1_hist.dropna(), 0, atol=1e-12)
    tr = np.maximum(bars.high - bars.low, np.maximum((bars.high - bars.close.shift()).abs(), (bars.low - bars.close.shift()).abs()))
    np.testing.assert_allclose(out.ATR_1[1:], tr[1:])
    gap = sdf(spark, bars).withColumn("close", F.when(F.col("ts") != F.lit("2024-01-01 20:00:00").cast("timestamp_ntz"), F.col("close")))
    with pytest.raises(Exception, match="NULL inside the series"):
        RC.ema(sequence(gap, block_rows=64, scan_rows=16), n=3).df.collect()


def test_quantiles_ranks_and_bins_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([np.zeros(500), rng.normal(0, 1, 501)])
    pdf = pd.DataFrame(dict(symbol="A", v=v, y=rng.integers(0, 3, len(v))))
    df = spark.createDataFrame(pdf)
    qs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.9, 1.0]
    got = {r["q_index"]: r["value"] for r in LB.exact_quantiles(df, "v", qs).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(qs))], np.quantile(v, qs))
    qq = AG.qq_table(df, "v").orderBy("i").toPandas()
    np.testing.assert_allclose(qq.ordered_value, np.sort(v))
    mi = LN.mutual_information(df, ["v"], "y", 7).first()["mutual_information"]
    s = pdf.sort_values(["v", "y"]).reset_index(drop=True)
    t = pd.crosstab(s.index * 7 // len(s), s.y).to_numpy() / len(s)
    want = sum(p * np.log(p / (t[i].sum() * t[:, j].sum())) for i in range(len(t)) for j, p in enumerate(t[i]) if p)
    assert mi == pytest.approx(want)


def test_class_weights_count_the_null_class(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    got = {r["c"]: r["weight"] for r in AG.class_weights(df, "c", "balanced").collect()}
    assert got == {"a": 0.75, None: 1.5}


def test_feature_names(spark):
    fr = sequence(sdf(spark, make_bars(120, "A")), block_rows=256)
    text = "2_CDLDOJI,0_MACDHISTFIX_5,1_STOCHF_7fastk,3_time_hour,4_MACDHIST_8"
    out = FP.features_for_names(fr, text, pattern_wma=None)
    names = FP.parse_feature_names(text)
    assert names == ["MACDHISTFIX_5", "STOCHF_7fastk", "CDLDOJI", "time_hour", "MACDHIST_8"]
    assert out.df.columns[-5:] == names and out.df.count() > 50
    for bad in ("0_NOPE_7", "RSI_x", "0_RSI_7,0_MOM_7", "0_RSI_7,MOM_7"):
        with pytest.raises(ValueError):
            FP.features_for_names(fr, bad)


def test_label_encoder_unseen_and_missing(spark):
    fit = spark.createDataFrame([("b",), ("a",)], "c string")
    use = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    got = {r["c"]: r["c_code"] for r in TAB.apply_label_encoder(use, "c", TAB.fit_label_encoder(fit, "c")).collect()}
    assert got == {"a": 0, "b": 1, None: 2, "z": 3}
    vec = TAB.one_hot_vector(use.where("c IS NOT NULL"), "c", TAB.fit_categories(fit, "c"))
    assert {r["c"]: r["c_vec"].toArray().tolist() for r in vec.collect()} == {"a": [1, 0], "b": [0, 1], "z": [0, 0]}
    with pytest.raises(ValueError):
        TAB.fit_one_hot(use, "c", max_categories=2)


def test_read_range_finds_enough_earlier_rows(spark):
    day = lambda s: pd.Timestamp(s)
    rows = [("A", day("2024-01-01") + pd.Timedelta(days=i)) for i in range(100)] + [("B", day("2020-01-01")), ("B", day("2024-04-01"))]
    df = sdf(spark, pd.DataFrame(rows, columns=["symbol", "ts"]))
    got = TB.read_range(df, "2024-04-01", "2024-04-03", rows=1, within_days=1).groupBy("symbol").count().collect()
    counts = {r["symbol"]: r["count"] for r in got}
    assert counts["B"] == 2 and counts["A"] >= 4


def test_adaboost_votes_stay_with_their_rows(spark):
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 2))
    pdf = pd.DataFrame(dict(a=x[:, 0], b=x[:, 1], label=(np.abs(x[:, 0]) + np.abs(x[:, 1]) > 1.4).astype(float), y=x[:, 0] ** 2 + x[:, 1]))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(pdf)).repartition(4)
    models = LN.adaboost_fit(df, n_rounds=6, max_depth=2)
    pred = LN.adaboost_predict(models, df, [0.0, 1.0])
    assert LN.accuracy(pred) > max(pdf.label.mean(), 1 - pdf.label.mean()) + 0.1
    reg = LN.adaboost_regress_predict(LN.adaboost_regress_fit(df, label="y", n_rounds=5), df)
    assert LN.r2(reg, "y") > 0.5
