"""Table-operator queries (sources, clean-up, filters, joins, aggregates, time
features, labels, signals, PnL, top-k), each with a DuckDB oracle."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import timefeat as TF
from barloom.operators import aggregates as AG
from barloom.operators import cleanup as CL
from barloom.operators import joins as JN
from barloom.operators import labels as LB
from barloom.operators import signals as SG
from barloom.plans.frame import Win, sequence
from barloom.plans.oracle import BARS_DAILY, DAILY_CTES, HOURLY_FILLED_CTES
from barloom.plans.queries import Q_BLOCK, daily_frame, finish, hourly_filled
from barloom.plans.sqlkit import DIV, G, LAG, LEAD, R, W
from barloom.sources import bars as BS
from barloom.sources import tables as TB

SPARK: dict = {}
SQL: dict = {}
CLOSE = "close"
WINDOW = "WINDOW w AS (PARTITION BY symbol ORDER BY rn)"


def reg(qid, sql):
    def deco(fn):
        SPARK[qid] = fn
        SQL[qid] = sql
        return fn
    return deco


def rsel(cols: dict) -> str:
    """SELECT list with rounding: {name: (expr, digits|None)}."""
    return ", ".join(f"{R(e, d) if d is not None else e} AS {n}" for n, (e, d) in cols.items())


# ------------------------------------------------------------------ fixtures
def platform_bars(spark, sf):
    """Hourly bars in the trading platform's raw layout (derived from events)."""
    b = BS.bars_hourly(spark, sf)
    return b.select(F.col("ts").alias("datetime"), "symbol", F.lit("SIM").alias("exchange"),
                    F.lit("1h").alias("interval"), F.lit("SIM").alias("gateway_name"),
                    F.col("open").alias("open_price"), F.col("high").alias("high_price"),
                    F.col("low").alias("low_price"), F.col("close").alias("close_price"),
                    "volume", "turnover", F.col("volume").alias("open_interest"))


PLATFORM_SQL = f"""SELECT ts AS datetime, symbol, 'SIM' AS exchange, '1h' AS interval, 'SIM' AS gateway_name,
  open AS open_price, high AS high_price, low AS low_price, close AS close_price, volume, turnover,
  volume AS open_interest FROM ({__import__('barloom.plans.oracle', fromlist=['x']).BARS_HOURLY})"""


def labelled_daily(spark, sf):
    """bars_daily + LAB1, LAB3 and LAB4 classes (the y table of the reference)."""
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(LB.forward_log_return(w, h=10, out="target_10_ret"), LB.desired_position(w, lag=10, multiplier=10.0))
    df = LB.quantile_classes(fr.df, "desired_pos_change", LB.CHANGE_CLASSES, out="pos_change_signal")
    df = LB.quantile_classes(df, "desired_pos_rolling", LB.ROLLING_CLASSES, out="net_pos_signal")
    return df


LAB_CTES = f"""{DAILY_CTES},
lab0 AS (SELECT *,
  CASE WHEN close > 0 AND {LEAD('close', 10)} > 0 THEN ln({LEAD('close', 10)} / close) END AS target_10_ret,
  CASE WHEN close > 0 AND {LEAD('close', 10)} > 0 THEN ln({LEAD('close', 10)} / close) * 1000.0 END AS desired_pos_change
  FROM bd {WINDOW}),
lab1 AS (SELECT *, {G(9, f"sum(desired_pos_change) {W(10)}")} AS desired_pos_rolling FROM lab0 {WINDOW}),
cuts AS (SELECT symbol, quantile_cont(desired_pos_change, [0.2, 0.4, 0.6, 0.8]) AS c5,
                quantile_cont(desired_pos_rolling, [1.0/3, 2.0/3]) AS c3 FROM lab1 GROUP BY symbol),
lab AS (SELECT l.*,
  CASE WHEN desired_pos_change IS NULL THEN NULL WHEN desired_pos_change <= c5[1] THEN 'strong sell'
       WHEN desired_pos_change <= c5[2] THEN 'sell' WHEN desired_pos_change <= c5[3] THEN 'meh'
       WHEN desired_pos_change <= c5[4] THEN 'buy' ELSE 'strong buy' END AS pos_change_signal,
  CASE WHEN desired_pos_rolling IS NULL THEN NULL WHEN desired_pos_rolling <= c3[1] THEN 'short hold'
       WHEN desired_pos_rolling <= c3[2] THEN 'no hold' ELSE 'long hold' END AS net_pos_signal
  FROM lab1 l JOIN cuts USING (symbol))"""


# =================================================================== sources
@reg("src2_prune_columns", f"SELECT datetime, interval, gateway_name, {rsel({c: (c, 6) for c in ['open_price', 'high_price', 'low_price', 'close_price', 'volume']})} FROM ({PLATFORM_SQL})")
def q_src2(spark, sf):
    return finish(TB.prune_columns(platform_bars(spark, sf)).drop("exchange"), 6)


@reg("src3_date_range_with_warmup", f"WITH {DAILY_CTES}, f AS (SELECT symbol, ts, {G(36, f'avg(close) {W(37)}')} AS SMA_37 "
     f"FROM bd {WINDOW}) SELECT symbol, ts, {R('SMA_37', 4)} AS SMA_37 FROM f "
     f"WHERE ts BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'")
def q_src3(spark, sf):
    fr = sequence(TB.read_range(BS.bars_daily(spark, sf), "1997-01-01", "1997-12-31", rows=36), block_rows=Q_BLOCK)
    fr = fr.add(FI.sma(Win(fr.key, fr.block), n=37))
    return finish(fr.between("1997-01-01", "1997-12-31").select("symbol", "ts", "SMA_37"), 4)


@reg("src1_csv_bars", f"SELECT datetime, symbol, {rsel({c: (c, 6) for c in ['open_price', 'high_price', 'low_price', 'close_price', 'volume', 'turnover', 'open_interest']})} FROM ({PLATFORM_SQL})")
def q_src1(spark, sf):
    """SRC1: the platform bars written as a CSV with a header and scanned with the explicit schema."""
    from barloom.streaming.bars import scratch
    path = scratch(spark, "csv")
    (platform_bars(spark, sf).select(*[f.name for f in TB.RAW_BAR_SCHEMA.fields])
     .write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return finish(TB.read_bar_csv(spark, path).drop("exchange", "interval", "gateway_name"), 6)


@reg("src5_signal_table", f"SELECT ts, {R('avg(ln(close / open))', 8)} AS ret FROM ({BARS_DAILY}) GROUP BY ts")
def q_src5t(spark, sf):
    """SRC5: a saved (ts, ret) series read back."""
    from barloom.streaming.bars import scratch
    path = scratch(spark, "signals")
    BS.bars_daily(spark, sf).groupBy("ts").agg(F.avg(F.log(F.col("close") / F.col("open"))).alias("ret")).write.parquet(path)
    return finish(TB.signal_table(spark, path), 8)


@reg("agg1_resample_open_interest", "SELECT o_orderpriority AS symbol, time_bucket(INTERVAL 7 DAYS, o_orderdate, TIMESTAMP '1970-01-01') AS ts, "
     + ", ".join(f"{R(e, 4)} AS {n}" for n, e in (("open", "arg_min(o_totalprice, (o_orderdate, o_orderkey))"), ("high", "max(o_totalprice)"),
                                                  ("low", "min(o_totalprice)"), ("close", "arg_max(o_totalprice, (o_orderdate, o_orderkey))"),
                                                  ("volume", "CAST(sum(o_custkey) AS DOUBLE)"),
                                                  ("open_interest", "CAST(arg_max(o_custkey, (o_orderdate, o_orderkey)) AS DOUBLE)")))
     + " FROM orders GROUP BY 1, 2")
def q_agg1oi(spark, sf):
    """AGG1 with every optional column: volume summed, open interest last."""
    o = TB.table(spark, sf, "orders")
    b = BS.resample(o, "7 days", key="o_orderpriority", ts="o_orderdate", order="o_orderkey", open_col="o_totalprice", high="o_totalprice",
                    low="o_totalprice", close="o_totalprice", volume="o_custkey", open_interest="o_custkey")
    return finish(b.withColumn("open_interest", F.col("open_interest").cast("double")), 4)


@reg("w67_return_vector", f"WITH {DAILY_CTES}, m AS (SELECT *, (high + low) / 2 AS m FROM bd), r AS (SELECT *, CASE WHEN lag(m) OVER w <> 0 "
     f"THEN (m / lag(m) OVER w - 1.0) * 100.0 END AS r FROM m {WINDOW}), v AS (SELECT *, list(r) {W(30)} AS v FROM r {WINDOW}) "
     f"SELECT symbol, ts, CASE WHEN rn > 30 THEN CAST(len(v) AS DOUBLE) END AS n, {R('CASE WHEN rn > 30 THEN v[1] END', 8)} AS oldest, "
     f"{R('CASE WHEN rn > 30 THEN v[30] END', 8)} AS newest, {R('CASE WHEN rn > 30 THEN list_sum(v) END', 6)} AS total FROM v")
def q_w67(spark, sf):
    """The last 30 one-bar % returns of the median price as one array per row."""
    fr = daily_frame(spark, sf)
    fr = fr.add(FI.return_vector(Win(fr.key, fr.block), n=30))
    v = F.col("medret_vec")
    out = fr.df.select("symbol", "ts", F.when(v.isNotNull(), F.size(v)).cast("double").alias("n"), F.get(v, F.lit(0)).alias("oldest"),
                       F.get(v, F.lit(29)).alias("newest"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("total"))
    return finish(out, 8, {"total": 6})


_EV4H = """SELECT event_type AS symbol, time_bucket(INTERVAL 4 HOUR, ts) AS ts,
  arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume, sum(value) AS turnover
  FROM events GROUP BY 1, 2"""


@reg("src4_agg1_resample_ticks_4h", f"SELECT symbol, ts, {rsel({c: (c, 6) for c in ['open', 'high', 'low', 'close', 'volume', 'turnover']})} FROM ({_EV4H})")
def q_src4(spark, sf):
    ev = TB.table(spark, sf, "events")
    return finish(BS.resample_price(ev, "4 hours", "event_type", "ts", "value", order="event_id"), 6)


_SIG_SQL = f"SELECT symbol, ts, ln(close / open) AS ret FROM ({BARS_DAILY}) WHERE volume >= 5"


def _signals(spark, sf):
    b = BS.bars_daily(spark, sf)
    return b.where(F.col("volume") >= 5).select("symbol", "ts", F.log(F.col("close") / F.col("open")).alias("ret"))


@reg("src5_j2_signal_lookup", f"WITH {DAILY_CTES}, s AS ({_SIG_SQL}) SELECT b.symbol, b.ts, "
     f"{R('coalesce(s.ret, 0.0)', 8)} AS ret FROM bd b LEFT JOIN s ON s.symbol = b.symbol AND s.ts = b.ts")
def q_src5(spark, sf):
    return finish(JN.signal_lookup(BS.bars_daily(spark, sf), _signals(spark, sf)).select("symbol", "ts", "ret"), 8)


@reg("agg2_gap_fill", f"WITH {HOURLY_FILLED_CTES} SELECT symbol, ts, filled, {rsel({c: (c, 6) for c in ['open', 'high', 'low', 'close', 'volume']})} FROM hf")
def q_agg2(spark, sf):
    fr = hourly_filled(spark, sf)
    return finish(fr.df.select("symbol", "ts", "filled", "open", "high", "low", "close", "volume"), 6)


# ======================================================== projections / clean-up
@reg("prj1_drop_ohlcv_cols", f"WITH {DAILY_CTES} SELECT symbol, ts, {R(G(6, f'avg(close) {W(7)}'), 4)} AS SMA_7 FROM bd {WINDOW}")
def q_prj1(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.add(FI.sma(Win(fr.key, fr.block), n=7))
    return finish(CL.drop_ohlcv_cols(fr.data()).drop("rn"), 4)


@reg("prj2_split_features_target", f"WITH {LAB_CTES} SELECT symbol, ts, pos_change_signal, net_pos_signal, "
     f"{R('desired_pos_change', 6)} AS desired_pos_change, {R('desired_pos_rolling', 6)} AS desired_pos_rolling FROM lab")
def q_prj2(spark, sf):
    X, y = CL.split_features_target(labelled_daily(spark, sf))
    return finish(y, 6)


@reg("prj3_keep_essentials", f"SELECT datetime, interval, gateway_name, {rsel({'open': ('open_price', 6), 'high': ('high_price', 6), 'low': ('low_price', 6), 'close': ('close_price', 6), 'volume': ('volume', 6), 'open_interest': ('open_interest', 6)})} FROM ({PLATFORM_SQL})")
def q_prj3(spark, sf):
    return finish(CL.keep_essentials(platform_bars(spark, sf)), 6)


@reg("prj4_trim_df_keep_symbol", f"SELECT symbol, {rsel({'open_price': ('open_price', 6), 'high_price': ('high_price', 6), 'low_price': ('low_price', 6), 'close_price': ('close_price', 6), 'volume': ('volume', 6), 'open_interest': ('open_interest', 6)})} FROM ({PLATFORM_SQL})")
def q_prj4(spark, sf):
    return finish(CL.trim_df(platform_bars(spark, sf), keep_symbol=True), 6)


@reg("prj5_renaming", f"SELECT datetime, symbol, exchange, interval, gateway_name, {rsel({'open': ('open_price', 6), 'high': ('high_price', 6), 'low': ('low_price', 6), 'close': ('close_price', 6), 'volume': ('volume', 6), 'turnover': ('turnover', 6), 'open_interest': ('open_interest', 6)})} FROM ({PLATFORM_SQL})")
def q_prj5(spark, sf):
    return finish(CL.renaming(platform_bars(spark, sf)), 6)


_PRJ6_X = f"CASE WHEN {LAG('close', 1)} = close THEN 0.0 ELSE {DIV('1.0', f'close - {LAG(CLOSE, 1)}', 'NULL')} END"


@reg("prj6_remove_infs_and_zeros", f"WITH {DAILY_CTES}, a AS (SELECT symbol, ts, {_PRJ6_X} AS x FROM bd {WINDOW}) "
     f"SELECT symbol, ts, {R('CASE WHEN x = 0 THEN 0.0001 ELSE x END', 10)} AS x FROM a")
def q_prj6(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    prev = w.lag(F.col("close"), 1)
    x = F.when(prev == F.col("close"), F.lit(0.0)).otherwise(FI.sdiv(F.lit(1.0), F.col("close") - prev, None))
    fr = fr.add(FI.Feat([("x", x)], 1))
    return finish(CL.remove_infs_and_zeros(fr.df.select("symbol", "ts", "x"), ["x"]), 10)


@reg("prj7_sort_columns", f"WITH {DAILY_CTES} SELECT {rsel({'close': ('close', 4), 'high': ('high', 4), 'low': ('low', 4), 'open': ('open', 4)})}, symbol, ts, volume FROM bd")
def q_prj7(spark, sf):
    return finish(CL.sort_columns(BS.bars_daily(spark, sf)), 4)


_RET_SQL = f"SELECT symbol, ts, ln(close / open) AS ret FROM ({BARS_DAILY})"


@reg("prj8_concat_columns", f"WITH {DAILY_CTES}, s AS ({_RET_SQL}) SELECT b.symbol, b.ts, {R('b.close', 4)} AS close, "
     f"{R('s.ret', 8)} AS ret FROM bd b JOIN s ON s.symbol = b.symbol AND s.ts = b.ts")
def q_prj8(spark, sf):
    left = BS.bars_daily(spark, sf).select("symbol", "ts", "close")
    right = BS.bars_daily(spark, sf).select("symbol", "ts", F.log(F.col("close") / F.col("open")).alias("ret"))
    return finish(CL.concat_columns(left, right), 4, {"ret": 8})


@reg("prj9_to_string", "SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def q_prj9(spark, sf):
    c = TB.table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return CL.to_string(c, ["c_nationkey"])


@reg("prj10_divide_means", "SELECT o_orderpriority, "
     + R("CASE WHEN avg(o_custkey) <> 0 THEN avg(o_totalprice) / avg(o_custkey) END", 6)
     + " AS mean_ratio, count(o_totalprice) = count(o_custkey) AS ok FROM orders GROUP BY o_orderpriority")
def q_prj10(spark, sf):
    o = TB.table(spark, sf, "orders")
    return finish(CL.divide_means(o, "o_totalprice", "o_custkey", "o_orderpriority"), 6)


@reg("prj11_class_to_number", f"WITH {LAB_CTES} SELECT symbol, ts, CASE pos_change_signal WHEN 'strong buy' THEN 1 "
     f"WHEN 'strong sell' THEN -1 ELSE 0 END AS class_number FROM lab")
def q_prj11(spark, sf):
    df = labelled_daily(spark, sf)
    return df.select("symbol", "ts", CL.class_to_number("pos_change_signal").alias("class_number"))


@reg("prj12_fill_sentinel", f"WITH {LAB_CTES} SELECT symbol, ts, coalesce(net_pos_signal, '_nan') AS net_pos_signal FROM lab")
def q_prj12(spark, sf):
    return CL.fill_sentinel(labelled_daily(spark, sf).select("symbol", "ts", "net_pos_signal"), ["net_pos_signal"])


# ==================================================================== filters
@reg("flt1_dropna", f"WITH {DAILY_CTES}, a AS (SELECT symbol, ts, {G(36, f'avg(close) {W(37)}')} AS SMA_37, "
     f"{G(7, f'close - {LAG(CLOSE, 7)}')} AS MOM_7, "
     f"{LEAD('close', 10)} AS close_lead10 FROM bd {WINDOW}) "
     f"SELECT symbol, ts, {R('SMA_37', 4)} AS SMA_37, {R('MOM_7', 4)} AS MOM_7, {R('close_lead10', 4)} AS close_lead10 FROM a "
     f"WHERE SMA_37 IS NOT NULL AND MOM_7 IS NOT NULL AND close_lead10 IS NOT NULL")
def q_flt1(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.sma(w, n=37), FI.mom(w, n=7), FI.shift(w, "close", -10, "close_lead10"))
    return finish(CL.dropna_any(fr.df.select("symbol", "ts", "SMA_37", "MOM_7", "close_lead10")), 4)


@reg("flt2_drop_duplicate_bars", "SELECT DISTINCT symbol, ts, round(open, 6) + 0.0 AS open, round(close, 6) + 0.0 AS close "
     "FROM (SELECT event_type AS symbol, time_bucket(INTERVAL 1 DAY, ts) AS ts, "
     "CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END AS open, CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END AS close FROM events)")
def q_flt2(spark, sf):
    ev = TB.table(spark, sf, "events")
    d = ev.select(F.col("event_type").alias("symbol"), F.window("ts", "1 day").start.alias("ts"),
                  F.when(F.col("value") > 100, 1.0).otherwise(0.0).alias("open"),
                  F.when(F.col("value") > 50, 1.0).otherwise(0.0).alias("close"))
    return finish(BS.drop_duplicate_bars(d), 6)


@reg("flt3_class_threshold_count", f"WITH {LAB_CTES} SELECT symbol, CAST(count(*) FILTER (WHERE pos_change_signal = 'strong buy' "
     f"AND target_10_ret > 0.01) AS BIGINT) AS n_selected, CAST(count(*) AS BIGINT) AS n_rows FROM lab GROUP BY symbol")
def q_flt3(spark, sf):
    return CL.class_threshold_count(labelled_daily(spark, sf), "pos_change_signal", "strong buy", "target_10_ret", 0.01,
                                    group="symbol")


# US federal holidays by SQL rule, independent of the engine's calendar
_HOLIDAYS_SQL = """
SELECT CASE isodow(d) WHEN 6 THEN d - 1 WHEN 7 THEN d + 1 ELSE d END AS hd
FROM (SELECT make_date(y, m, k) AS d FROM range(1994, 2027) r(y), (VALUES (1, 1), (6, 19), (7, 4), (11, 11), (12, 25)) f(m, k) WHERE NOT (m = 6 AND y < 2021))
UNION ALL
SELECT CAST(make_date(y, m, 1) + CAST((dow - isodow(make_date(y, m, 1)) + 7) % 7 + 7 * (n - 1) AS INTEGER) AS DATE)
FROM range(1994, 2027) r(y), (VALUES (1, 1, 3), (2, 1, 3), (9, 1, 1), (10, 1, 2), (11, 4, 4)) w(m, dow, n)
UNION ALL
SELECT CAST(make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS DATE) FROM range(1994, 2027) r(y)"""


def _flt4_sql(source: str) -> str:
    return f"""
WITH d AS (SELECT *, CAST(ts AS DATE) AS day FROM ({source})),
s0 AS (SELECT symbol, day, min(ts) AS op, max(ts) AS cl FROM d GROUP BY symbol, day),
s AS (SELECT *, lead(day) OVER (PARTITION BY symbol ORDER BY day) AS nx,
                lag(day) OVER (PARTITION BY symbol ORDER BY day) AS pv FROM s0),
h AS ({_HOLIDAYS_SQL}),
f AS (SELECT s.*,
   EXISTS (SELECT 1 FROM h WHERE hd = s.day) AS is_holiday,
   EXISTS (SELECT 1 FROM h WHERE hd > s.day AND (CASE WHEN s.nx IS NULL THEN hd <= s.day + 7 ELSE hd < s.nx END)) AS last_day_before_holiday,
   EXISTS (SELECT 1 FROM h WHERE hd < s.day AND (CASE WHEN s.pv IS NULL THEN hd >= s.day - 7 ELSE hd > s.pv END)) AS first_day_after_holiday
   FROM s)
SELECT d.event_id, d.symbol, d.ts, is_holiday, last_day_before_holiday, first_day_after_holiday,
  (epoch_us(d.ts) - epoch_us(op)) / 60e6 < 10 AS within_open_10, (epoch_us(cl) - epoch_us(d.ts)) / 60e6 < 10 AS within_close_10,
  (epoch_us(d.ts) - epoch_us(op)) / 60e6 < 30 AS within_open_30, (epoch_us(cl) - epoch_us(d.ts)) / 60e6 < 30 AS within_close_30
FROM d JOIN f ON f.symbol = d.symbol AND f.day = d.day"""


def _flags(ticks):
    out = TF.calendar_flags(ticks, "symbol", "ts", minutes=(10, 30))
    return out.select("event_id", "symbol", "ts", "is_holiday", "last_day_before_holiday", "first_day_after_holiday",
                      "within_open_10", "within_close_10", "within_open_30", "within_close_30")


@reg("flt4_calendar_flags", _flt4_sql("SELECT event_id, event_type AS symbol, ts FROM events"))
def q_flt4(spark, sf):
    return _flags(TB.table(spark, sf, "events").select("event_id", F.col("event_type").alias("symbol"), "ts"))


@reg("flt4_calendar_flags_seven_years", _flt4_sql(
    "SELECT o_orderkey AS event_id, o_orderpriority || o_orderstatus || CAST(o_custkey % 10 AS VARCHAR) AS symbol, o_orderdate AS ts FROM orders"))
def q_flt4_orders(spark, sf):
    """Holiday flags over 1995–2001, with symbols thin enough to miss days around holidays."""
    key = F.concat("o_orderpriority", "o_orderstatus", (F.col("o_custkey") % 10).cast("string"))
    return _flags(TB.table(spark, sf, "orders").select(F.col("o_orderkey").alias("event_id"), key.alias("symbol"), F.col("o_orderdate").alias("ts")))


@reg("flt5_row_slice", f"WITH {DAILY_CTES} SELECT symbol, ts, rn, {R('close', 4)} AS close FROM bd WHERE rn > 500 AND rn <= 1000")
def q_flt5(spark, sf):
    fr = daily_frame(spark, sf)
    return finish(CL.row_slice(fr.df, 500, 1000).select("symbol", "ts", "rn", "close"), 4)


# ====================================================================== joins
@reg("j1_align_y_to_x", f"WITH {LAB_CTES}, x AS (SELECT symbol, ts FROM lab WHERE desired_pos_rolling IS NOT NULL) "
     f"SELECT symbol, ts, {R('target_10_ret', 8)} AS target_10_ret FROM lab WHERE (symbol, ts) IN (SELECT symbol, ts FROM x)")
def q_j1(spark, sf):
    lab = labelled_daily(spark, sf)
    X = lab.where(F.col("desired_pos_rolling").isNotNull()).select("symbol", "ts")
    return finish(JN.align(lab.select("symbol", "ts", "target_10_ret"), X), 8)


@reg("j3_dictionary_lookup", "WITH d AS (SELECT c_mktsegment AS v, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code "
     "FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey % 2 = 0)) "
     "SELECT c_custkey, c_mktsegment, coalesce(d.code, 99) AS c_mktsegment_code FROM customer LEFT JOIN d ON d.v = c_mktsegment")
def q_j3(spark, sf):
    from pyspark.sql import Window
    c = TB.table(spark, sf, "customer")
    fitted = c.where(F.col("c_custkey") % 2 == 0).select(F.col("c_mktsegment").alias("value")).distinct()
    d = fitted.withColumn("code", (F.dense_rank().over(Window.orderBy("value")) - 1).cast("int"))
    return JN.dictionary_lookup(c.select("c_custkey", "c_mktsegment"), "c_mktsegment", d, 99)


@reg("j4_attach_predictions", f"WITH {LAB_CTES} SELECT symbol, ts, pos_change_signal, "
     f"CASE WHEN {LAG('close', 1).replace('OVER w', 'OVER (PARTITION BY symbol ORDER BY rn)')} < close THEN 'buy' ELSE 'sell' END AS prediction "
     f"FROM lab WHERE pos_change_signal IS NOT NULL")
def q_j4(spark, sf):
    lab = labelled_daily(spark, sf)
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.Feat([("prediction", F.when(w.lag(F.col("close"), 1) < F.col("close"), "buy").otherwise("sell"))], 1))
    y = lab.where(F.col("pos_change_signal").isNotNull()).select("symbol", "ts", "pos_change_signal")
    return JN.attach_predictions(y, fr.df.select("symbol", "ts", "prediction"))


@reg("j5_parameter_grid_sweep", f"WITH {DAILY_CTES}, g AS (SELECT unnest([7, 17, 27]) AS n), "
     f"a AS (SELECT b.symbol, g.n, b.rn, b.close FROM bd b, g) "
     f"SELECT symbol, n, {R('avg(CASE WHEN rn > n THEN close END)', 4)} AS avg_close_after_warmup FROM a GROUP BY symbol, n")
def q_j5(spark, sf):
    fr = daily_frame(spark, sf)
    g = JN.with_parameter_grid(fr.df.select("symbol", "rn", "close"), "n", [7, 17, 27])
    return finish(g.groupBy("symbol", "n").agg(F.avg(F.when(F.col("rn") > F.col("n"), F.col("close")))
                                                .alias("avg_close_after_warmup")), 4)


# ================================================================= aggregates
@reg("agg3_value_counts", f"WITH {LAB_CTES} SELECT pos_change_signal, net_pos_signal, CAST(count(*) AS BIGINT) AS count "
     f"FROM lab GROUP BY 1, 2")
def q_agg3(spark, sf):
    return AG.value_counts(labelled_daily(spark, sf), "pos_change_signal", "net_pos_signal")


@reg("agg4_histogram", f"WITH {DAILY_CTES}, r AS (SELECT symbol, min(close) lo, max(close) hi FROM bd GROUP BY symbol), "
     "b AS (SELECT bd.symbol, CAST(CASE WHEN (hi - lo) / 20 = 0 THEN 0 ELSE least(floor((close - lo) / ((hi - lo) / 20)), 19) END AS INTEGER) AS bin, lo, hi "
     "FROM bd JOIN r USING (symbol)) "
     f"SELECT symbol, bin, CAST(count(*) AS BIGINT) AS count, {R('first(lo + bin * (hi - lo) / 20)', 4)} AS bin_start, "
     f"{R('first(lo + (bin + 1) * (hi - lo) / 20)', 4)} AS bin_end FROM b GROUP BY symbol, bin")
def q_agg4(spark, sf):
    return finish(AG.histogram(BS.bars_daily(spark, sf), "close", 20, group="symbol"), 4)


_A5 = ["open", "high", "low", "volume"]


@reg("agg5_correlation_row", f"WITH {DAILY_CTES} " + " UNION ALL ".join(
    f"SELECT symbol, '{c}' AS feature, {R(f'corr(close, {c})', 8)} AS corr FROM bd GROUP BY symbol" for c in _A5))
def q_agg5(spark, sf):
    return finish(AG.corr_row(BS.bars_daily(spark, sf), "close", _A5, group="symbol"), 8)


_AGG6_N = list(range(5, 50))
_AGG6_SQL = (
    f"WITH RECURSIVE {DAILY_CTES}, a AS (SELECT symbol, rn, {LEAD('close', 1)} / close - 1 AS fwd, CASE WHEN lag(close) OVER w IS NOT NULL THEN "
    "greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) END AS tr, "
    + ", ".join(f"{G(n - 1, f'regr_slope(close, rn) {W(n)}')} AS s{n}" for n in _AGG6_N) + f" FROM bd {WINDOW}), "
    "t AS (SELECT symbol, rn, [0.0::DOUBLE for k in range(45)] AS y FROM a WHERE rn = 1 UNION ALL "
    "SELECT a.symbol, a.rn, [y[k + 1] * (CASE WHEN a.rn <= k + 6 THEN 1.0 ELSE (k + 4.0) / (k + 5.0) END) + tr / (k + 5.0) for k in range(45)] "
    "FROM t JOIN a ON a.symbol = t.symbol AND a.rn = t.rn + 1) "
    + " UNION ALL ".join(f"SELECT symbol, {n} AS param, {R(f'corr(fwd, CASE WHEN rn > {n} AND y[{n - 4}] <> 0 THEN s{n} / y[{n - 4}] END)', 8)} AS corr "
                         "FROM a JOIN t USING (symbol, rn) GROUP BY symbol" for n in _AGG6_N))


@reg("agg6_corr_by_parameter", _AGG6_SQL)
def q_agg6(spark, sf):
    """AGG6: correlation of the next bar's return with slope(n)/ATR(n) for n = 5..49."""
    from barloom.functions import recurrent as RC
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    pc = w.lag(F.col("close"), 1)
    tr = F.when(pc.isNotNull(), F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - pc), F.abs(F.col("low") - pc)))
    fr = fr.add(FI.Feat([("fwd", w.lead(F.col("close"), 1) / F.col("close") - 1), ("tr", tr)], 1, 1),
                *[FI.linearreg_slope(w, n=n, out=f"s{n}") for n in _AGG6_N])
    fr = RC.smooth_many(fr, [(f"a{n}", F.col("tr"), 2, n, (n - 1) / n, 1.0 / n, 1.0 / n) for n in _AGG6_N])
    df = fr.df.withColumns({f"r{n}": FI.sdiv(F.col(f"s{n}"), F.col(f"a{n}"), None) for n in _AGG6_N})
    return finish(AG.corr_by_parameter(df, "fwd", {n: f"r{n}" for n in _AGG6_N}, group="symbol"), 8)


def _inv_norm_sql(p):
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02, 1.383577518672690e+02,
         -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02, 6.680131188771972e+01,
         -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00, -2.549732539343734e+00,
         4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]

    def poly(cs, x):
        acc = repr(cs[0])
        for k in cs[1:]:
            acc = f"(({acc}) * ({x}) + {k!r})"
        return acc
    ql = f"sqrt(-2 * ln({p}))"
    qh = f"sqrt(-2 * ln(1 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    return (f"CASE WHEN {p} <= 0 OR {p} >= 1 THEN NULL WHEN {p} < 0.02425 THEN {poly(c, ql)} / ({poly(d, ql)} * {ql} + 1) "
            f"WHEN {p} <= {1 - 0.02425!r} THEN {poly(a, r)} * {q} / ({poly(b, r)} * {r} + 1) "
            f"ELSE -{poly(c, qh)} / ({poly(d, qh)} * {qh} + 1) END")


@reg("agg7_qq_table", f"WITH {DAILY_CTES}, o AS (SELECT symbol, close, row_number() OVER (PARTITION BY symbol ORDER BY close) AS i, "
     "count(*) OVER (PARTITION BY symbol) AS n FROM bd), "
     "m AS (SELECT *, CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p FROM o) "
     f"SELECT symbol, i, {R('close', 4)} AS ordered_value, {R(_inv_norm_sql('p'), 8)} AS theoretical_quantile FROM m")
def q_agg7(spark, sf):
    out = AG.qq_table(BS.bars_daily(spark, sf), "close", "symbol")
    return finish(out, 8, {"ordered_value": 4})


@reg("agg8_run_lengths", f"WITH {DAILY_CTES}, s AS (SELECT *, CASE WHEN close >= open THEN 1 ELSE -1 END AS state FROM bd), "
     f"c AS (SELECT *, CASE WHEN lag(state) OVER w IS NULL OR lag(state) OVER w <> state THEN 1 ELSE 0 END AS chg FROM s {WINDOW}), "
     f"i AS (SELECT *, sum(chg) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM c {WINDOW}) "
     "SELECT symbol, min(ts) AS start, max(ts) AS \"end\", CAST(count(*) AS BIGINT) AS length, first(state) AS state FROM i GROUP BY symbol, island")
def q_agg8(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.with_columns(state=F.when(F.col("close") >= F.col("open"), 1).otherwise(-1))
    return AG.run_lengths(fr, "state")


@reg("agg9_class_weights", f"WITH {LAB_CTES}, c AS (SELECT pos_change_signal, count(*) AS k FROM lab GROUP BY 1), "
     "t AS (SELECT sum(k) AS n, count(*) AS m FROM c) "
     f"SELECT l.symbol, l.ts, l.pos_change_signal, {R('CAST(t.n AS DOUBLE) / (t.m * c.k)', 8)} AS weight "
     "FROM lab l JOIN c ON c.pos_change_signal IS NOT DISTINCT FROM l.pos_change_signal, t")
def q_agg9(spark, sf):
    lab = labelled_daily(spark, sf).select("symbol", "ts", "pos_change_signal")
    return finish(AG.class_weights(lab, "pos_change_signal", "balanced"), 8)


@reg("agg10_data_checks", f"WITH {LAB_CTES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*)', 8)} AS null_share, "
    f"CAST(count(DISTINCT {c}) AS BIGINT) AS distinct, count(DISTINCT {c}) <= 1 AS constant FROM lab"
    for c in ["target_10_ret", "pos_change_signal", "net_pos_signal", "volume"]))
def q_agg10(spark, sf):
    return finish(AG.data_checks(labelled_daily(spark, sf), ["target_10_ret", "pos_change_signal", "net_pos_signal", "volume"]), 8)


_CV_SQL = ("SELECT o_orderpriority AS candidate, avg(o_totalprice) / 1e6 AS mean_test_score FROM orders GROUP BY 1")


@reg("agg11_top1_rank_candidates", f"SELECT candidate, {R('mean_test_score', 8)} AS mean_test_score, "
     f"CAST(rank() OVER (ORDER BY mean_test_score DESC) AS INTEGER) AS rank_test_score FROM ({_CV_SQL})")
def q_agg11(spark, sf):
    o = TB.table(spark, sf, "orders")
    cv = o.groupBy(F.col("o_orderpriority").alias("candidate")).agg((F.avg("o_totalprice") / 1e6).alias("mean_test_score"))
    return finish(AG.rank_candidates(cv).orderBy(F.col("mean_test_score").desc()), 8)


# ============================================================= time features
@reg("t1_time_features", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS time_hour, CAST(minute(ts) AS INTEGER) AS time_minute, "
     "CAST(isodow(ts) - 1 AS INTEGER) AS time_day_of_week, CAST(day(ts) AS INTEGER) AS time_day_of_month FROM events")
def q_t1(spark, sf):
    ev = TB.table(spark, sf, "events")
    return ev.select("event_id", *[v.cast("int").alias(k) for k, v in TF.time_features("ts").items()])


_T2 = {"hour": ("hour(ts)", 24), "minute": ("minute(ts)", 60), "day_of_week": ("(isodow(ts) - 1)", 7),
       "day_of_month": ("day(ts)", 30)}


@reg("t2_cyclic_time_v1", "SELECT event_id, " + ", ".join(
    f"{R(f'{fn}(CAST({x} AS DOUBLE) / {p} * 2 * pi())', 10)} AS time_{k}_{fn}" for k, (x, p) in _T2.items() for fn in ("sin", "cos"))
    + " FROM events")
def q_t2(spark, sf):
    ev = TB.table(spark, sf, "events")
    return finish(ev.select("event_id", *[v.alias(k) for k, v in TF.cyclic_v1("ts").items()]), 10)


_T3P = {"day": ("day(o_orderdate)", 31), "dayofweek": ("(isodow(o_orderdate) - 1)", 6), "month": ("month(o_orderdate)", 12)}


@reg("t3_cyclic_time_v2", "WITH y AS (SELECT min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b FROM orders) SELECT o_orderkey, "
     + ", ".join(f"{R(f'{fn}(2 * pi() * {x} / {p})', 10)} AS ts_{k}_{fn}" for k, (x, p) in _T3P.items() for fn in ("sin", "cos"))
     + f", {R('CAST(year(o_orderdate) - a AS DOUBLE) / (b - a)', 10)} AS ts_year FROM orders, y")
def q_t3(spark, sf):
    o = TB.table(spark, sf, "orders")
    ymin, ymax = TF.fit_year_range(o, "o_orderdate")
    feats = TF.cyclic_v2("o_orderdate", ymin, ymax, prefix="ts")
    return finish(o.select("o_orderkey", *[v.alias(k) for k, v in feats.items()]), 10)


@reg("t4_parse_date", "SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS TIMESTAMP) AS parsed FROM orders")
def q_t4(spark, sf):
    o = TB.table(spark, sf, "orders")
    s = F.date_format("o_orderdate", "dd/MM/yyyy")
    return o.select("o_orderkey", TF.parse_date(s, "dd/MM/yyyy").alias("parsed"))


# ==================================================================== labels
@reg("lab1_forward_log_return", f"WITH {LAB_CTES} SELECT symbol, ts, {R('target_10_ret', 8)} AS target_10_ret FROM lab")
def q_lab1(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.add(LB.forward_log_return(Win(fr.key, fr.block), h=10, out="target_10_ret"))
    return finish(fr.df.select("symbol", "ts", "target_10_ret"), 8)


def _lab2_sql(lb=30, lf=5, up=0.02):
    leads = " AND ".join(f"lead(r, {k}) OVER w > {up}" for k in range(1, lf + 1))
    return (f"WITH {HOURLY_FILLED_CTES}, m AS (SELECT *, (high + low) / 2.0 AS med FROM hf), "
            f"r0 AS (SELECT *, CASE WHEN lag(med) OVER w <> 0 THEN (med / lag(med) OVER w - 1.0) * 100.0 END AS r FROM m {WINDOW}) "
            f"SELECT symbol, ts, CASE WHEN rn > {lb} AND lead(med, {lf}) OVER w IS NOT NULL THEN "
            f"CASE WHEN {leads} THEN 1.0 ELSE -1.0 END END AS updown_signal FROM r0 {WINDOW}")


@reg("lab2_updown_label", _lab2_sql())
def q_lab2(spark, sf):
    fr = hourly_filled(spark, sf)
    fr = fr.add(LB.updown_label(Win(fr.key, fr.block)))
    return fr.df.select("symbol", "ts", F.col("updown_signal").cast("double").alias("updown_signal"))


@reg("lab3_desired_position", f"WITH {LAB_CTES} SELECT symbol, ts, {R('desired_pos_change', 6)} AS desired_pos_change, "
     f"{R('desired_pos_rolling', 6)} AS desired_pos_rolling FROM lab")
def q_lab3(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.add(LB.desired_position(Win(fr.key, fr.block), lag=10, multiplier=10.0))
    return finish(fr.df.select("symbol", "ts", "desired_pos_change", "desired_pos_rolling"), 6)


@reg("lab4_quantile_classes", f"WITH {LAB_CTES} SELECT symbol, ts, pos_change_signal, net_pos_signal FROM lab")
def q_lab4(spark, sf):
    return labelled_daily(spark, sf).select("symbol", "ts", "pos_change_signal", "net_pos_signal")


def _lab5_sql():
    cols = ["r AS lookback0"] + [f"lag(r, {i}) OVER w AS lookback{i}" for i in range(1, 31)] + \
        [f"lead(r, {i}) OVER w AS lookforward{i}" for i in range(1, 6)]
    names = ["lookback0"] + [f"lookback{i}" for i in range(1, 31)] + [f"lookforward{i}" for i in range(1, 6)]
    return (f"WITH {HOURLY_FILLED_CTES}, m AS (SELECT *, (high + low) / 2.0 AS med FROM hf), "
            f"r0 AS (SELECT *, CASE WHEN lag(med) OVER w <> 0 THEN (med / lag(med) OVER w - 1.0) * 100.0 END AS r FROM m {WINDOW}), "
            f"x AS (SELECT symbol, ts, {', '.join(cols)} FROM r0 {WINDOW}) "
            f"SELECT symbol, ts, {', '.join(f'{R(n, 8)} AS {n}' for n in names)} FROM x")


@reg("lab5_lagged_returns", _lab5_sql())
def q_lab5(spark, sf):
    fr = hourly_filled(spark, sf)
    f = LB.lagged_returns(Win(fr.key, fr.block))
    fr = fr.add(f)
    return finish(fr.df.select("symbol", "ts", *f.outputs), 8)


# ================================================================ signals / PnL
@reg("sig1_two_model_gate", f"WITH {LAB_CTES} SELECT symbol, ts, CASE "
     "WHEN pos_change_signal = 'strong buy' AND target_10_ret > 0.0 AND net_pos_signal = 'long hold' AND desired_pos_rolling > 0.0 THEN 1 "
     "WHEN pos_change_signal = 'strong sell' AND target_10_ret < 0.0 AND net_pos_signal = 'short hold' AND desired_pos_rolling < 0.0 THEN -1 "
     "ELSE 0 END AS gate FROM lab")
def q_sig1(spark, sf):
    lab = labelled_daily(spark, sf)
    lab = lab.withColumns({"ep": F.when(F.col("pos_change_signal") == "strong buy", F.col("target_10_ret"))
                                  .otherwise(-F.col("target_10_ret")),
                           "hp": F.when(F.col("net_pos_signal") == "long hold", F.col("desired_pos_rolling"))
                                  .otherwise(-F.col("desired_pos_rolling"))})
    return lab.select("symbol", "ts", SG.two_model_gate("pos_change_signal", "ep", "net_pos_signal", "hp", 0.0))


_SIG2_SQL = (f"WITH {DAILY_CTES}, s AS (SELECT *, CASE WHEN abs(ln(close / open)) > 0.3 THEN ln(close / open) * 1000.0 END AS sig FROM bd) "
             f"SELECT symbol, ts, {R('coalesce(last_value(sig IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)', 6)} AS target FROM s {WINDOW}")


@reg("sig2_threshold_hold", _SIG2_SQL)
def q_sig2(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.with_columns(ret=F.log(F.col("close") / F.col("open")))
    fr = SG.threshold_hold(fr, "ret", 0.3, 1000.0, "target")
    return finish(fr.df.select("symbol", "ts", "target"), 6)


_LATCH_CTES = (f"{DAILY_CTES}, s AS (SELECT *, {G(6, f'regr_slope(close, rn) {W(7)}')} AS sl FROM bd {WINDOW}), "
               "t AS (SELECT *, CASE WHEN sl > 1e-9 THEN 10.0 WHEN sl < -1e-9 THEN 0.0 END AS sg FROM s), "
               f"p AS (SELECT *, coalesce(last_value(sg IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS position FROM t {WINDOW})")


def _latched(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.add(FI.linearreg_slope(Win(fr.key, fr.block), n=7, out="sl"))
    fr = fr.with_columns(signal=F.when(F.col("sl") > 1e-9, 1).when(F.col("sl") < -1e-9, -1).otherwise(0))
    return SG.latch(fr, "signal", 10.0, 0.0, "position")


@reg("sig3_latch", f"WITH {_LATCH_CTES} SELECT symbol, ts, position FROM p")
def q_sig3(spark, sf):
    return _latched(spark, sf).df.select("symbol", "ts", "position")


@reg("pnl1_model_return", f"WITH {_LATCH_CTES}, q AS (SELECT *, coalesce(lag(position) OVER w, 0.0) * (close - open) AS pnl FROM p {WINDOW}) "
     f"SELECT symbol, ts, {R('pnl', 4)} AS pnl, {R('sum(pnl) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS cum_pnl FROM q {WINDOW}")
def q_pnl1(spark, sf):
    fr = SG.model_return(_latched(spark, sf), "position", lag=1)
    return finish(fr.df.select("symbol", "ts", "pnl", "cum_pnl"), 4, {"cum_pnl": 2})


_PNL2_CTES = (f"{_LATCH_CTES}, q AS (SELECT *, position - coalesce(lag(position) OVER w, 0.0) AS trade, "
              "coalesce(coalesce(lag(position) OVER w, 0.0) * (close - lag(close) OVER w) * 100.0, 0.0) AS gross "
              f"FROM p {WINDOW}), q2 AS (SELECT *, abs(trade) * 100.0 * (close * 0.001 + 0.1) AS cost FROM q), "
              f"q3 AS (SELECT *, gross - cost AS net, sum(gross - cost) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_net FROM q2 {WINDOW})")


@reg("pnl2_costs", f"WITH {_PNL2_CTES} SELECT symbol, ts, {R('trade', 4)} AS trade, {R('cost', 4)} AS cost, "
     f"{R('gross', 4)} AS gross, {R('net', 4)} AS net, {R('cum_net', 2)} AS cum_net FROM q3")
def q_pnl2(spark, sf):
    fr = SG.pnl_with_costs(_latched(spark, sf), "position")
    return finish(fr.df.select("symbol", "ts", "trade", "cost", "gross", "net", "cum_net"), 4, {"cum_net": 2})


_PNL3_SQL = (f"WITH {_PNL2_CTES}, d AS (SELECT symbol, CAST(ts AS DATE) AS day, sum(net) AS day_net, "
             "sum(CASE WHEN trade <> 0 THEN 1 ELSE 0 END) AS day_trades FROM q3 GROUP BY 1, 2), "
             "b AS (SELECT *, 10000000.0 + sum(day_net) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance FROM d), "
             "c AS (SELECT *, balance - greatest(max(balance) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 10000000.0) AS drawdown, "
             "day_net / coalesce(lag(balance) OVER (PARTITION BY symbol ORDER BY day), 10000000.0) AS day_ret FROM b) "
             f"SELECT symbol, {R('arg_max(balance, day)', 2)} AS end_balance, {R('arg_max(balance, day) / 10000000.0 - 1.0', 8)} AS total_return, "
             f"{R('min(drawdown)', 2)} AS max_drawdown, {R(f'CASE WHEN stddev_samp(day_ret) > 0 THEN avg(day_ret) / stddev_samp(day_ret) * {math.sqrt(240)!r} ELSE 0.0 END', 6)} AS sharpe, "
             "CAST(sum(day_trades) AS BIGINT) AS trade_count, CAST(count(*) AS BIGINT) AS days FROM c GROUP BY symbol")


@reg("pnl3_daily_statistics", _PNL3_SQL)
def q_pnl3(spark, sf):
    fr = SG.pnl_with_costs(_latched(spark, sf), "position")
    out = SG.daily_statistics(fr.df, "symbol", "ts", "net", "trade")
    return finish(out, 2, {"total_return": 8, "sharpe": 6})


_SWEEP_TH, _SWEEP_LAG = [0.0, 1000.0, 5000.0, 10000.0], [1, 2, 3]


def _sweep_sql():
    parts = " UNION ALL ".join(
        f"SELECT symbol, {th!r} AS threshold, rn, open, close, coalesce(last_value(CASE WHEN sl > {th!r} THEN 10.0 "
        f"WHEN sl < -{th!r} THEN 0.0 END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS pos "
        f"FROM s {WINDOW}" for th in _SWEEP_TH)
    lags = " UNION ALL ".join(
        f"SELECT symbol, threshold, {k} AS lag, coalesce(lag(pos, {k}) OVER (PARTITION BY symbol, threshold ORDER BY rn), 0.0) * (close - open) AS pnl FROM u"
        for k in _SWEEP_LAG)
    return (f"WITH {DAILY_CTES}, s AS (SELECT *, {G(6, f'regr_slope(close, rn) {W(7)}')} AS sl FROM bd {WINDOW}), u AS ({parts}), x AS ({lags}), "
            "t AS (SELECT symbol, threshold, lag, sum(pnl) AS final_pnl, CASE WHEN stddev_samp(pnl) > 0 THEN avg(pnl) / stddev_samp(pnl) ELSE 0.0 END AS ratio "
            "FROM x GROUP BY ALL) "
            f"SELECT symbol, CAST(threshold AS DOUBLE) AS threshold, lag, {R('final_pnl', 1)} AS final_pnl, {R('ratio', 8)} AS ratio, "
            "row_number() OVER (PARTITION BY symbol ORDER BY round(ratio, 8) DESC, threshold, lag) = 1 AS best FROM t")


@reg("pnl4_parameter_sweep", _sweep_sql())
def q_pnl4(spark, sf):
    """Strategy sweep over two parameters (slope threshold, bars between signal and position): final PnL and mean/deviation
    ratio per combination, and the best combination by the ratio.  Thresholds are copies of the rows (``explode`` of
    a small grid, each keyed by it); lags are columns of one aggregate."""
    from pyspark.sql import Window
    from barloom.plans.frame import from_sequenced
    fr = daily_frame(spark, sf)
    fr = fr.add(FI.linearreg_slope(Win(fr.key, fr.block), n=7, out="sl"))
    g = JN.with_parameter_grid(fr.df.drop("blk", "sblk"), "threshold", _SWEEP_TH)
    g = g.withColumn("skey", F.concat_ws("|", "symbol", F.col("threshold").cast("string")))
    gfr = from_sequenced(g, key="skey", block_rows=Q_BLOCK, stats=None)
    th = F.col("threshold")
    gfr = gfr.with_columns(signal=F.when(F.col("sl") > th, 1).when(F.col("sl") < -th, -1).otherwise(0))
    gfr = SG.latch(gfr, "signal", 10.0, 0.0, "position")
    w = Win(gfr.key, gfr.block)
    gfr = gfr.add(FI.Feat([(f"pnl{k}", F.coalesce(w.lag(F.col("position"), k), F.lit(0.0)) * (F.col("close") - F.col("open")))
                           for k in _SWEEP_LAG], max(_SWEEP_LAG)))
    stats = F.array(*[F.struct(F.lit(k).alias("lag"), F.sum(f"pnl{k}").alias("final_pnl"),
                               F.when(F.stddev_samp(f"pnl{k}") > 0, F.avg(f"pnl{k}") / F.stddev_samp(f"pnl{k}")).otherwise(0.0).alias("ratio"))
                      for k in _SWEEP_LAG])
    out = gfr.df.groupBy("symbol", "threshold").agg(stats.alias("e")).select("symbol", "threshold", F.explode("e").alias("e")).select("symbol", "threshold", "e.*")
    out = finish(out, 8, {"final_pnl": 1})
    best = Window.partitionBy("symbol").orderBy(F.desc("ratio"), "threshold", "lag")  # one row per combination
    return out.withColumn("best", F.row_number().over(best) == 1)


# ===================================================================== top-k
@reg("top2_top_abs_after_first", f"WITH {DAILY_CTES}, r AS (SELECT symbol, ts, close - open AS v, "
     "row_number() OVER (PARTITION BY symbol ORDER BY abs(close - open) DESC, ts) AS rk FROM bd) "
     f"SELECT symbol, ts, {R('v', 4)} AS v, rk - 1 AS position FROM r WHERE rk BETWEEN 2 AND 6")
def q_top2(spark, sf):
    b = BS.bars_daily(spark, sf).select("symbol", "ts", (F.col("close") - F.col("open")).alias("v"))
    return finish(AG.top_abs_after_first(b, "v", "ts", 5, group="symbol").withColumn("position", F.col("position").cast("long")), 4)


@reg("top3_latest_per_symbol", f"WITH {DAILY_CTES} SELECT symbol, ts, {R('close', 4)} AS close, {R('volume', 4)} AS volume "
     "FROM bd WHERE (symbol, ts) IN (SELECT symbol, max(ts) FROM bd GROUP BY symbol)")
def q_top3(spark, sf):
    b = BS.bars_daily(spark, sf).select("symbol", "ts", "close", "volume")
    return finish(AG.latest_per_key(b, "symbol", "ts"), 4)
