"""Streaming queries: each runs a stream over the ``events`` file with
``availableNow`` into parquet under the checkpoint folder and returns the result
table; the oracles are the batch SQL of the same computation."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import recurrent as RC
from barloom.plans.frame import Win
from barloom.plans.queries import finish
from barloom.plans import sqlkit as SK
from barloom.plans.sqlkit import G, LAG, R, W
from barloom.sources import bars as BS
from barloom.sources import tables as TB
from barloom.streaming import bars as ST
from barloom.streaming import live as LV

CLOSE = "close"
SPARK: dict = {}
SQL: dict = {}


def reg(qid, sql=None):
    def deco(fn):
        SPARK[qid] = fn
        if sql is not None:
            SQL[qid] = sql
        return fn
    return deco


_CLOSED_BARS = """SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS ts,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS ts_end,
  arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close,
  CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2
  HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""


def feed(spark, sf):
    """The events as a stream of several slices of days, two per trigger."""
    path, files = ST.event_files(spark, sf)
    return ST.event_stream(spark, path, 2 * files)


@reg("st1_stream_tick_bars", f"SELECT symbol, ts, ts_end, {', '.join(f'{R(c, 6)} AS {c}' for c in ['open', 'high', 'low', 'close', 'volume'])} FROM ({_CLOSED_BARS})")
def q_st1(spark, sf):
    path = ST.run_to_table(ST.tick_bars(feed(spark, sf)), "st1")
    return finish(spark.read.parquet(path), 6)


def _features(fr):
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.sma(w, n=7), FI.mom(w, n=7))
    fr = RC.ema(fr, n=37)
    fr = RC.rsi(fr, n=14)
    return RC.adx(fr, n=7)


_ST2_SQL = (
    f"WITH RECURSIVE b AS ({_CLOSED_BARS}), bd AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM b), "
    "d AS (SELECT *, close - lag(close) OVER w AS dx, high - lag(high) OVER w AS up, lag(low) OVER w - low AS dn, lag(close) OVER w AS pc "
    "FROM bd WINDOW w AS (PARTITION BY symbol ORDER BY rn)), "
    "pre AS (SELECT *, CASE WHEN up > 0 AND up > dn THEN up ELSE 0.0 END AS pdm, CASE WHEN dn > 0 AND dn > up THEN dn ELSE 0.0 END AS mdm, "
    "CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM d), "
    + ", ".join(x.strip() for x in (
        SK.ema("e", "pre", "close", 37), SK.wilder_mean("ag", "pre", "greatest(dx, 0.0)", 14, 2), SK.wilder_mean("al", "pre", "greatest(-dx, 0.0)", 14, 2),
        SK.wilder_sum("sp", "pre", "pdm", 7, 2), SK.wilder_sum("sm", "pre", "mdm", 7, 2), SK.wilder_sum("st", "pre", "tr", 7, 2)))
    + ", di AS (SELECT symbol, rn, CASE WHEN st <> 0 THEN sp * 100.0 / st ELSE 0.0 END AS p, CASE WHEN st <> 0 THEN sm * 100.0 / st ELSE 0.0 END AS m "
      "FROM sp JOIN sm USING (symbol, rn) JOIN st USING (symbol, rn)), "
      "dxx AS (SELECT symbol, rn, CASE WHEN rn > 7 THEN coalesce(last_value(CASE WHEN rn > 7 AND p + m <> 0 THEN abs(p - m) * 100.0 / (p + m) END IGNORE NULLS) "
      "OVER (PARTITION BY symbol ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) END AS dxv FROM di), "
    + SK.wilder_mean("ax", "dxx", "dxv", 7, 8).strip()
    + f", f AS (SELECT symbol, rn, ts, {G(6, f'avg(close) {W(7)}')} AS SMA_7, {G(7, f'close - {LAG(CLOSE, 7)}')} AS MOM_7 FROM bd WINDOW w AS (PARTITION BY symbol ORDER BY rn)), "
      "r AS (SELECT f.*, e.e, ax.ax, CASE WHEN ag IS NOT NULL THEN CASE WHEN ag + al <> 0 THEN ag * 100.0 / (ag + al) ELSE 0.0 END END AS rsi "
      "FROM f JOIN e USING (symbol, rn) JOIN ag USING (symbol, rn) JOIN al USING (symbol, rn) JOIN ax USING (symbol, rn)) "
    f"SELECT symbol, ts, {R('SMA_7', 6)} AS SMA_7, {R('MOM_7', 6)} AS MOM_7, {R('e', 6)} AS EMA_37, {R('rsi', 6)} AS RSI_14, {R('ax', 6)} AS ADX_7, "
    "CASE WHEN rsi > 55 THEN 1.0 WHEN rsi < 45 THEN -1.0 ELSE 0.0 END AS prediction FROM r WHERE ts >= TIMESTAMP '2024-01-07'")


@reg("st2_st3_st6_stream_features", _ST2_SQL)
def q_st2(spark, sf):
    """Warm-up from the bars before 2024-01-07 (ST6), then every later closed bar from the stream (ST2), scored by a
    saved pipeline (ST3)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    rule = SQLTransformer(statement="SELECT *, CASE WHEN RSI_14 > 55 THEN 1D WHEN RSI_14 < 45 THEN -1D ELSE 0D END AS prediction FROM __THIS__")
    start = F.lit("2024-01-07").cast("timestamp_ntz")
    history = BS.bars_hourly(spark, sf).where(F.col("ts") < start)
    fs = ST.FeatureStream(spark, _features, buffer=64, model=Pipeline(stages=[rule]).fit(spark.range(0)), block_rows=512)
    fs.seed(history)
    bars = ST.tick_bars(feed(spark, sf).where(F.col("ts") >= start))
    path = fs.run(bars)
    return finish(spark.read.parquet(path).select("symbol", "ts", "SMA_7", "MOM_7", "EMA_37", "RSI_14", "ADX_7", "prediction"), 6)


from barloom.plans.sqlkit import exits_recursive  # noqa: E402

_ST4_SQL = ("WITH RECURSIVE src AS (SELECT event_type AS symbol, event_id, ts, value AS close, "
            "CASE WHEN value > 60 THEN 1 WHEN value < 40 THEN -1 ELSE 0 END AS signal, "
            "row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events), "
            f"{exits_recursive('ex', 'src', 10.0, 20, 0.05).strip()} "
            "SELECT src.symbol, src.event_id, src.ts, ex.last AS target FROM ex JOIN src USING (symbol, rn) "
            "WHERE epoch_ms(src.ts) < (SELECT epoch_ms(max(ts)) FROM events) - 3600000")


@reg("st4_stateful_exits", _ST4_SQL)
def q_st4(spark, sf):
    ticks = feed(spark, sf).select("event_id", F.col("event_type").alias("symbol"), "ts", F.col("value").alias("close"),
                                   F.when(F.col("value") > 60, 1).when(F.col("value") < 40, -1).otherwise(0).alias("signal"))
    out = ST.stateful_exits(ticks, "signal", size=10.0, max_holding=20, stop_pct=0.05)
    return spark.read.parquet(ST.run_to_table(out, "st4"))


_SIG = ("SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS ts, avg(value) / 100.0 AS ret FROM events "
        "GROUP BY 1, 2 HAVING count(*) >= 3")


@reg("st5_stream_static_lookup", f"WITH s AS ({_SIG}) SELECT e.event_id, {R('coalesce(s.ret, 0.0)', 8)} AS ret FROM events e "
     "LEFT JOIN s ON s.symbol = e.event_type AND s.ts = time_bucket(INTERVAL 1 HOUR, e.ts)")
def q_st5(spark, sf):
    ev = TB.table(spark, sf, "events")
    sig = (ev.groupBy(F.col("event_type").alias("symbol"), F.window("ts", "1 hour").start.alias("ts"))
           .agg((F.avg("value") / 100.0).alias("ret"), F.count(F.lit(1)).alias("n")).where("n >= 3").drop("n"))
    stream = feed(spark, sf).select("event_id", F.col("event_type").alias("symbol"),
                                               F.window("ts", "1 hour").start.alias("ts"))
    out = ST.signal_lookup_stream(stream, sig).select("event_id", "ret")
    return finish(spark.read.parquet(ST.run_to_table(out, "st5")), 8)


@reg("st7_dedup_within_watermark", "SELECT event_type, CAST(count(*) AS BIGINT) AS kept FROM (SELECT DISTINCT event_type, user_id, "
     "time_bucket(INTERVAL 1 HOUR, ts) AS hour FROM events) GROUP BY event_type")
def q_st7(spark, sf):
    s = feed(spark, sf).withColumn("hour", F.window("ts", "1 hour").start)
    d = ST.dedup_within_watermark(s, keys=("event_type", "user_id", "hour"), delay="2 hours")
    t = spark.read.parquet(ST.run_to_table(d.select("event_type", "user_id", "hour"), "st7"))
    return t.groupBy("event_type").agg(F.count(F.lit(1)).cast("long").alias("kept"))


_SPLIT = "2024-01-07"
_LIVE_BD = f"b AS ({_CLOSED_BARS}), bd AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM b)"
_CYCLE_SRC = (
    "sm AS (SELECT symbol, rn, ts, close AS price, CASE WHEN rn > 3 THEN (4 * close + 3 * lag(close, 1) OVER w "
    "+ 2 * lag(close, 2) OVER w + lag(close, 3) OVER w) / 10.0 ELSE 0.0 END AS s FROM bd WINDOW w AS (PARTITION BY symbol ORDER BY rn)), "
    "src AS (SELECT symbol, rn, ts, price, list_reverse(list(s) OVER back) AS sl, list_reverse(list(price) OVER back) AS pl FROM sm "
    "WINDOW back AS (PARTITION BY symbol ORDER BY rn ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)), "
    f"{SK.cycle_recursive('cy', 'src').strip()}")
_SAR_SRC = (
    "hl AS (SELECT symbol, rn, ts, high, low, lag(high) OVER (PARTITION BY symbol ORDER BY rn) AS hp, "
    "lag(low) OVER (PARTITION BY symbol ORDER BY rn) AS lp FROM bd), "
    f"{SK.sar_recursive('sr', 'hl').strip()}")
#: Column: SQL value, earlier rows it needs, decimals.
_LIVE_OUT = {"HT_DCPERIOD": ("sp", 32, 6), "HT_DCPHASE": ("phase", 63, 4), "HT_PHASOR_inphase": ("inph", 32, 4),
             "HT_PHASOR_quadrature": ("quad", 32, 4), "HT_SINE_sine": ("sine", 63, 4), "HT_SINE_leadsine": ("lead", 63, 4),
             "HT_TRENDMODE": ("CAST(trend AS DOUBLE)", 63, 4), "MAMA_mama": ("mama", 32, 4), "MAMA_fama": ("fama", 32, 4)}


@reg("st2_st6_live_cycle_mama_sar", f"WITH RECURSIVE {_LIVE_BD}, {_CYCLE_SRC}, {_SAR_SRC} SELECT src.symbol, src.ts, "
     + ", ".join(f"{R(f'CASE WHEN cy.rn > {lb} THEN {e} END', d)} AS {n}" for n, (e, lb, d) in _LIVE_OUT.items())
     + f", {R('sr.sar_out', 4)} AS SAR FROM cy JOIN src USING (symbol, rn) LEFT JOIN sr USING (symbol, rn) WHERE src.ts >= TIMESTAMP '{_SPLIT}'")
def q_live_loops(spark, sf):
    """Keyed state that starts from the bars before the split (initial state) and takes every later closed bar."""
    start = F.lit(_SPLIT).cast("timestamp_ntz")
    initial = LV.loop_state(BS.bars_hourly(spark, sf).where(F.col("ts") < start), block_rows=512)
    bars = ST.tick_bars(feed(spark, sf).where(F.col("ts") >= start))
    with LV.state_store(spark):
        path = ST.run_to_table(LV.live_loops(bars, initial), "live")
    return finish(spark.read.parquet(path).select("symbol", "ts", *_LIVE_OUT, "SAR"), 4, {"HT_DCPERIOD": 6})


_NAMES = "0_HT_SINEsine,1_RSI_14,2_HT_TRENDMODE,3_MOM_7,4_HT_DCPERIOD,5_HT_PHASORquadrature"


@reg("fp4_live_feature_names", f"WITH RECURSIVE {_LIVE_BD}, {_CYCLE_SRC}, "
     "d AS (SELECT *, close - lag(close) OVER w AS dx, close - lag(close, 7) OVER w AS mom FROM bd WINDOW w AS (PARTITION BY symbol ORDER BY rn)), "
     f"{SK.wilder_mean('ag', 'd', 'greatest(dx, 0.0)', 14, 2).strip()}, {SK.wilder_mean('al', 'd', 'greatest(-dx, 0.0)', 14, 2).strip()} "
     f"SELECT d.symbol, d.ts, {R('CASE WHEN d.rn > 63 THEN sine END', 4)} AS HT_SINEsine, "
     f"{R('CASE WHEN ag IS NOT NULL THEN CASE WHEN ag + al <> 0 THEN ag * 100.0 / (ag + al) ELSE 0.0 END END', 6)} AS RSI_14, "
     f"{R('CASE WHEN d.rn > 63 THEN CAST(trend AS DOUBLE) END', 4)} AS HT_TRENDMODE, {R('mom', 6)} AS MOM_7, "
     f"{R('CASE WHEN d.rn > 32 THEN sp END', 6)} AS HT_DCPERIOD, {R('CASE WHEN d.rn > 32 THEN quad END', 4)} AS HT_PHASORquadrature "
     f"FROM d JOIN cy USING (symbol, rn) JOIN ag USING (symbol, rn) JOIN al USING (symbol, rn) WHERE d.ts >= TIMESTAMP '{_SPLIT}'")
def q_live_names(spark, sf):
    """A saved feature list with cycle names, scored bar by bar after a warm-up from history."""
    start = F.lit(_SPLIT).cast("timestamp_ntz")
    history = BS.bars_hourly(spark, sf).where(F.col("ts") < start)
    bars = ST.tick_bars(feed(spark, sf).where(F.col("ts") >= start))
    fs = LV.named_features(bars, _NAMES, history, buffer=128, block_rows=512)
    cols = [n.split("_", 1)[1] for n in _NAMES.split(",")]
    return finish(spark.read.parquet(fs.out).select("symbol", "ts", *cols), 4, {c: 6 for c in ("RSI_14", "MOM_7", "HT_DCPERIOD")})


_LATE_PARTS = 4
_LATE_SQL = f"""WITH d AS (SELECT event_id, ts, date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), CAST(ts AS DATE)) AS day,
    event_id % 10 = 3 AS held, event_id % 7 = 0 AS twice FROM events),
  n AS (SELECT max(day) + 1 AS n FROM d),
  w AS (SELECT (epoch_ms(max(ts)) - 7200000) * 1000 AS us FROM d, n WHERE NOT held AND day < {_LATE_PARTS - 1} * n // {_LATE_PARTS})
SELECT CAST(count(*) FILTER (WHERE NOT held OR epoch_us(ts) > us) AS BIGINT) AS kept,
  CAST(count(*) FILTER (WHERE twice AND NOT held) AS BIGINT) AS repeated,
  CAST(count(*) FILTER (WHERE held AND epoch_us(ts) <= us) AS BIGINT) AS late FROM d, w"""


@reg("st7_late_and_repeated_counts", _LATE_SQL)
def q_late(spark, sf):
    """A feed that sends some rows twice and holds others back to its end: rows kept, dropped as repeated, dropped as late."""
    path, files = ST.event_files(spark, sf, _LATE_PARTS, held=F.col("event_id") % 10 == 3, twice=F.col("event_id") % 7 == 0)
    once = ST.dedup_within_watermark(ST.event_stream(spark, path, files), keys=("event_id",), delay="2 hours")
    out, counts = ST.run_counted(once.select("event_id"), "st7-late")
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("kept")).select(
        "kept", F.lit(counts["repeated"]).cast("long").alias("repeated"), F.lit(counts["late"]).cast("long").alias("late"))
