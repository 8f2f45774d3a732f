"""Bars: resampling from ticks (SRC4/AGG1), gap fill (AGG2), de-duplication (FLT2)
and the bar fixtures derived from the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.frame import BarFrame, Stats, from_sequenced
from barloom.sources.tables import table

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(interval: str) -> int:
    """'1 hour' / '15 minutes' / '1 day' → seconds."""
    n, unit = interval.split()
    unit = unit.rstrip("s")
    return int(n) * _UNIT_SECONDS[unit]


def resample(ticks: DataFrame, interval: str, key: str = "symbol", ts: str = "ts", order: str | None = None,
             open_col: str = "open", high: str = "high", low: str = "low", close: str = "close",
             volume: str | None = "volume", open_interest: str | None = None,
             turnover: str | None = None) -> DataFrame:
    """AGG1 / SRC4: bars of ``interval`` — open first, high max, low min, close last,
    volume sum, open interest last.  ``order`` breaks ties within equal ``ts``.

    A hash aggregate on (key, window): partial aggregation runs before the shuffle.
    """
    ordc = F.struct(F.col(ts), F.col(order)) if order else F.col(ts)
    aggs = {"open": F.min_by(open_col, ordc), "high": F.max(high),
            "low": F.min(low), "close": F.max_by(close, ordc)}
    if volume:
        aggs["volume"] = F.sum(volume).cast("double")
    if turnover:
        aggs["turnover"] = F.sum(turnover).cast("double")
    if open_interest:
        aggs["open_interest"] = F.max_by(open_interest, ordc)
    return (ticks.groupBy(F.col(key).alias("symbol"), F.window(F.col(ts), interval).alias("_w"))
            .agg(*[v.alias(k) for k, v in aggs.items()])
            .select("symbol", F.col("_w.start").alias("ts"), *aggs.keys()))


def resample_price(ticks: DataFrame, interval: str, key: str, ts: str, price: str,
                   order: str | None = None, size: str | None = None) -> DataFrame:
    """Bars from a single price column (one tick per row): volume = number of ticks,
    turnover = sum of price (or price x size)."""
    t = ticks.select(F.col(key).alias("symbol"), F.col(ts).alias("ts"), F.col(price).alias("_p"),
                     *( [F.col(order).alias("_o")] if order else []),
                     (F.col(size).cast("double") if size else F.lit(1.0)).alias("_v"))
    t = t.withColumn("_to", F.col("_p") * F.col("_v") if size else F.col("_p"))
    return resample(t, interval, key="symbol", ts="ts", order="_o" if order else None,
                    open_col="_p", high="_p", low="_p", close="_p", volume="_v", turnover="_to")


def drop_duplicate_bars(bars: DataFrame, key: str = "symbol", ts: str = "ts") -> DataFrame:
    """FLT2: drop repeated bars.  Equal bars of different minutes are kept (ts is part of the row)."""
    return bars.dropDuplicates([c for c in bars.columns])


def _epoch():
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _to_micros(c):
    """Wall-clock microseconds of a timestamp_ntz (independent of the session time zone)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), c)


def _from_micros(c):
    return F.timestamp_add("MICROSECOND", c, _epoch())


def gap_fill(bars: DataFrame, interval: str, key: str = "symbol", ts: str = "ts",
             block_rows: int = 4096, chunk: int = 4096) -> BarFrame:
    """AGG2: complete the regular time grid per key between its first and last bar.

    Missing intervals take the last close in all four prices, volume 0 and
    ``filled = true``.  The grid is generated in bounded chunks (no per-key
    array of the whole range); its row number is arithmetic, so the result is
    already a :class:`BarFrame` and the forward fill is a block-wise scan.
    """
    step = interval_seconds(interval) * 1_000_000
    rng = bars.groupBy(F.col(key).alias("_k")).agg(_to_micros(F.min(ts)).alias("_t0"),
                                                  _to_micros(F.max(ts)).alias("_t1"))
    rng = rng.withColumn("_n", ((F.col("_t1") - F.col("_t0")) / F.lit(step)).cast("long") + 1)
    chunks = rng.select("_k", "_t0", "_n",
                        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1,
                                             F.lit(chunk).cast("long"))).alias("_c0"))
    chunks = chunks.repartition("_k", "_c0")  # a key's grid is not made by the task of its one row
    grid = chunks.select("_k", "_t0", F.explode(F.sequence(
        F.col("_c0"), F.least(F.col("_c0") + F.lit(chunk - 1), F.col("_n") - 1))).alias("_i"))
    grid = grid.select(F.col("_k").alias(key), _from_micros(F.col("_t0") + F.col("_i") * F.lit(step)).alias(ts),
                       (F.col("_i") + 1).alias("rn"))
    data_cols = [c for c in bars.columns if c not in (key, ts)]
    joined = grid.join(bars, [key, ts], "left")
    r = rng.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"), F.max("_n").alias("m")).first()
    stats = Stats(int(r["n"] or 0), int(r["k"] or 0), int(r["m"] or 0))
    fr = from_sequenced(joined, key=key, order=(ts,), block_rows=block_rows, stats=stats)
    fr = fr.ffill("_lc", F.col("close"))
    df = fr.df.withColumn("filled", F.col("close").isNull())
    for c in ("open", "high", "low", "close"):
        if c in data_cols:
            df = df.withColumn(c, F.coalesce(F.col(c), F.col("_lc")))
    for c in data_cols:
        if c not in ("open", "high", "low", "close"):
            df = df.withColumn(c, F.coalesce(F.col(c), F.lit(0).cast(bars.schema[c].dataType)))
    return fr.with_df(df.drop("_lc"))


# ------------------------------------------------------------------- fixtures
def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → hourly bars per event_type (open/close by event_id order)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return (ev.groupBy(F.col("event_type").alias("symbol"), F.window("ts", "1 hour").alias("_w"))
            .agg(F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"),
                 F.sum("value").alias("turnover"), F.count(F.lit(1)).cast("double").alias("volume"))
            .select("symbol", F.col("_w.start").alias("ts"), "open", "high", "low", "close",
                    "volume", "turnover"))


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → daily bars per o_orderpriority (open/close by o_orderkey order)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").alias("ts"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def ticks_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as one long tick series (symbol 'ALL'), order (o_orderdate, o_orderkey)."""
    o = table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    return o.select(F.lit("ALL").alias("symbol"), F.col("o_orderdate").alias("ts"),
                    F.col("o_orderkey").alias("seq"), p.alias("open"), p.alias("high"),
                    p.alias("low"), p.alias("close"), F.lit(1.0).alias("volume"))


def ticks_orders_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as one long bar series with distinct o/h/l/c derived from the order row."""
    o = table(spark, sf_dir, "orders")
    p = F.col("o_totalprice")
    spread = (F.col("o_custkey") % 97 + 1).cast("double")
    return o.select(F.lit("ALL").alias("symbol"), F.col("o_orderdate").alias("ts"),
                    F.col("o_orderkey").alias("seq"), (p - spread / 2).alias("open"),
                    (p + spread).alias("high"), (p - spread).alias("low"), p.alias("close"),
                    (F.col("o_custkey") % 50 + 1).cast("double").alias("volume"))


__all__ = ["resample", "resample_price", "gap_fill", "drop_duplicate_bars", "bars_hourly", "bars_daily",
           "ticks_orders", "ticks_orders_ohlc", "interval_seconds", "Stats"]
