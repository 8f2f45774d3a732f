"""Keyed state of non-linear recurrences, initial state, counts of late rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_streams_and_tables import make_bars, sdf

from barloom.operators import grouped as GR
from barloom.plans import features as FP
from barloom.plans.frame import sequence
from barloom.streaming import bars as ST
from barloom.streaming import live as LV


def batch(spark, bars):
    return (GR.parabolic_sar(GR.cycle_indicators(sequence(sdf(spark, bars), block_rows=256))).df
            .select("symbol", "ts", "rn", *LV.OUTPUTS).toPandas())


def compare(got, want, cols, **tol):
    m = got.merge(want, on=["symbol", "ts"], suffixes=("", "_want"))
    assert len(m) == len(got)
    for c in cols:
        np.testing.assert_allclose(m[c].to_numpy(float), m[c + "_want"].to_numpy(float), equal_nan=True, **tol)


def run(spark, folder, base, initial=None, files=1):
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", files).parquet(folder)
    with LV.state_store(spark):
        q = (LV.live_loops(stream, initial).writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(f"{base}/out").toPandas()


def test_live_loops_equal_batch_over_uneven_batches_and_a_restart(spark):
    bars = make_bars(420, "ABC")
    times = sorted(bars.ts.unique())
    cuts = [times[0], times[1], times[37], times[300], times[-1] + pd.Timedelta("1h")]  # the first batch: one bar a symbol
    folder, base = ST.scratch(spark, "live-in"), ST.scratch(spark, "live")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = bars[(bars.ts >= a) & (bars.ts < b)]
        again = bars[(bars.ts < a) & (bars.ts >= a - pd.Timedelta("2h"))] if k > 1 else part[:0]  # repeated, late bars
        sdf(spark, pd.concat([part, again, part[:1]]).sample(frac=1, random_state=k)).coalesce(1).write.mode("append").parquet(folder)
        if k == 1:
            run(spark, folder, base)  # the query ends; a new one goes on from its checkpoint
    got = run(spark, folder, base)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    assert len(got) == len(bars) and not got.duplicated(["symbol", "ts"]).any()
    want = batch(spark, bars)
    compare(got, want, ["rn", *LV.OUTPUTS], rtol=0, atol=0)
    # per symbol 2 + 2 late bars, and one repeated row in each of 4 batches for the first symbol
    assert got.groupby("symbol").late.max().to_dict() == {"A": 8, "B": 4, "C": 4}


@pytest.mark.parametrize("seen", [1, 2, 50, 300])
def test_initial_state_from_history(spark, seen):
    bars = make_bars(360, "AB")
    times = sorted(bars.ts.unique())
    old, new = bars[bars.ts < times[seen]], bars[bars.ts >= times[seen]]
    new = new[~((new.symbol == "B") & (new.ts < times[310]))] if seen == 300 else new
    folder, base = ST.scratch(spark, "init-in"), ST.scratch(spark, "init")
    sdf(spark, new).coalesce(1).write.parquet(folder)
    initial = LV.loop_state(sdf(spark, old), block_rows=64)
    assert initial.count() == 2
    got = run(spark, folder, base, initial)
    want = batch(spark, pd.concat([old, new]))
    assert len(got) == len(new)
    compare(got, want, ["rn", *LV.OUTPUTS], rtol=1e-9, atol=1e-9)


def test_named_features_with_cycles_equal_batch(spark):
    bars = make_bars(260, "AB")
    names = "0_HT_SINEsine,1_RSI_14,2_HT_TRENDLINE,3_SMA_X"
    with pytest.raises(ValueError, match="unknown"):
        LV.named_features(sdf(spark, bars), names)
    names = names.replace(",3_SMA_X", ",3_ROC_7")
    start = sorted(bars.ts.unique())[100]
    folder = ST.scratch(spark, "names-in")
    sdf(spark, bars[bars.ts >= start]).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    fs = LV.named_features(stream, names, sdf(spark, bars[bars.ts < start]), buffer=64, block_rows=256)
    cols = ["HT_SINEsine", "RSI_14", "HT_TRENDLINE", "ROC_7"]
    got = spark.read.parquet(fs.out).select("symbol", "ts", *cols).toPandas()
    want = FP.features_for_names(sequence(sdf(spark, bars), block_rows=256), names, dropna=False).df.select("symbol", "ts", *cols).toPandas()
    assert len(got) == 2 * 160
    compare(got, want, cols, rtol=1e-9, atol=1e-9)
    with pytest.raises(ValueError, match="whole series"):  # without the state's columns the loop needs its series
        ST.FeatureStream(spark, lambda fr: FP.features_for_names(fr, names), block_rows=256).process(sdf(spark, bars[:80]), 0)


def test_late_and_repeated_rows_are_counted(spark):
    folder = ST.scratch(spark, "late-in")
    hours = [[0, 1, 2, 2], [30, 31], [32, 5], [40, 3, 33]]  # the watermark that drops is that of the batch before
    for k, part in enumerate(hours):
        rows = pd.DataFrame(dict(event_id=[100 * k + i for i in range(len(part))], ts=pd.Timestamp("2024-01-01") + pd.to_timedelta(part, unit="h"),
                                 user_id=1, event_type="x", value=1.0, props=""))
        sdf(spark, rows).coalesce(1).select(*ST.EVENT_SCHEMA.fieldNames()).write.mode("append").parquet(folder)
    once = ST.dedup_within_watermark(ST.event_stream(spark, folder, 1), keys=("ts",), delay="2 hours")
    out, counts = ST.run_counted(once.select("event_id"), "late")
    kept = sorted(r[0] for r in spark.read.parquet(out).collect())
    assert counts["read"] == 11 and counts["repeated"] == 1 and counts["late"] == 1
    assert 201 in kept and 301 not in kept
    assert len(kept) + counts["late"] + counts["repeated"] == counts["read"]


def test_event_files_hold_and_repeat(spark, monkeypatch):
    monkeypatch.setattr(ST, "FILE_ROWS", 100)
    path, files = ST.event_files(spark, "/root/testdata/sf0.001", 3, held=F.col("event_id") % 10 == 3, twice=F.col("event_id") % 7 == 0)
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    n, twice = ev.count(), ev.where("event_id % 7 = 0 and event_id % 10 <> 3").count()
    assert files == -(-n // 300) and spark.read.parquet(path).count() == n + twice
