"""Time features (T1–T4) and calendar/session flags (FLT4)."""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def time_features(ts="ts") -> dict:
    """Hour, minute, day of week (Monday = 0), day of month."""
    t = _c(ts)
    return {"time_hour": F.hour(t), "time_minute": F.minute(t),
            "time_day_of_week": F.weekday(t), "time_day_of_month": F.dayofmonth(t)}


CYCLE_V1 = {"hour": 24, "minute": 60, "day_of_week": 7, "day_of_month": 30}


def cyclic_v1(ts="ts") -> dict:
    """sin/cos(2π·x/p) for hour/24, minute/60, day of week/7, day of month/30."""
    t = _c(ts)
    parts = {"hour": F.hour(t), "minute": F.minute(t), "day_of_week": F.weekday(t), "day_of_month": F.dayofmonth(t)}
    out = {}
    for k, x in parts.items():
        ang = x.cast("double") / CYCLE_V1[k] * 2 * math.pi
        out[f"time_{k}_sin"] = F.sin(ang)
        out[f"time_{k}_cos"] = F.cos(ang)
    return out


def parse_date(c, fmt: str = "dd/MM/yyyy") -> Column:
    """T4: string → timestamp by format (NULL when it does not parse)."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def fit_year_range(df: DataFrame, ts: str) -> tuple[int, int]:
    """Year min/max of the fitted table (used by T3 on any later table)."""
    r = df.agg(F.min(F.year(ts)).alias("a"), F.max(F.year(ts)).alias("b")).first()
    return int(r["a"]), int(r["b"])


def cyclic_v2(ts: str, year_min: int, year_max: int, hours_secs: bool = False, prefix: str | None = None) -> dict:
    """day/31, day-of-week/6, month/12 on the circle, year min-max scaled with the
    fitted range; optionally hour/23 and minute/59 first."""
    t = _c(ts)
    p = prefix or ts
    two_pi = 2 * math.pi
    out = {}
    if hours_secs:
        out[f"{p}_hour_sin"] = F.sin(two_pi * F.hour(t) / 23)
        out[f"{p}_hour_cos"] = F.cos(two_pi * F.hour(t) / 23)
        out[f"{p}_minute_sin"] = F.sin(two_pi * F.minute(t) / 59)
        out[f"{p}_minute_cos"] = F.cos(two_pi * F.minute(t) / 59)
    out[f"{p}_day_sin"] = F.sin(two_pi * F.dayofmonth(t) / 31)
    out[f"{p}_day_cos"] = F.cos(two_pi * F.dayofmonth(t) / 31)
    out[f"{p}_dayofweek_sin"] = F.sin(two_pi * F.weekday(t) / 6)
    out[f"{p}_dayofweek_cos"] = F.cos(two_pi * F.weekday(t) / 6)
    out[f"{p}_month_sin"] = F.sin(two_pi * F.month(t) / 12)
    out[f"{p}_month_cos"] = F.cos(two_pi * F.month(t) / 12)
    span = year_max - year_min
    out[f"{p}_year"] = ((F.year(t) - F.lit(year_min)) / F.lit(span)) if span else F.lit(None).cast("double")
    return out


# ----------------------------------------------------------- calendar (FLT4)
def _nth_weekday(year, month, weekday, n):
    d = _dt.date(year, month, 1)
    shift = (weekday - d.weekday()) % 7
    return d + _dt.timedelta(days=shift + 7 * (n - 1))


def _last_weekday(year, month, weekday):
    d = _dt.date(year + (month // 12), month % 12 + 1, 1) - _dt.timedelta(days=1)
    return d - _dt.timedelta(days=(d.weekday() - weekday) % 7)


def _observed(d):
    if d.weekday() == 5:
        return d - _dt.timedelta(days=1)
    if d.weekday() == 6:
        return d + _dt.timedelta(days=1)
    return d


def us_holidays(year: int) -> list[_dt.date]:
    """US federal holidays of ``year`` by rule (observed dates)."""
    return sorted({
        _observed(_dt.date(year, 1, 1)),
        _nth_weekday(year, 1, 0, 3),          # Martin Luther King Jr. Day
        _nth_weekday(year, 2, 0, 3),          # Washington's Birthday
        _last_weekday(year, 5, 0),            # Memorial Day
        _observed(_dt.date(year, 6, 19)) if year >= 2021 else None,
        _observed(_dt.date(year, 7, 4)),
        _nth_weekday(year, 9, 0, 1),          # Labor Day
        _nth_weekday(year, 10, 0, 2),         # Columbus Day
        _observed(_dt.date(year, 11, 11)),
        _nth_weekday(year, 11, 3, 4),         # Thanksgiving
        _observed(_dt.date(year, 12, 25)),
    } - {None})


def holiday_calendar(spark: SparkSession, years) -> DataFrame:
    """Small calendar table (day, is_holiday) for the given years — ~11 rows per year."""
    rows = [(d,) for y in years for d in us_holidays(int(y))]
    return spark.createDataFrame(rows, "day date")


def calendar_flags(df: DataFrame, key="symbol", ts="ts", minutes=(10, 15, 20, 30)) -> DataFrame:
    """FLT4: within the first/last N minutes of the session (first/last bar of the
    day per key), holiday, last trading day before a holiday, first after one.

    Flags are computed on the per-(key, day) session table (one aggregate) and
    joined back; holidays are a literal array built by rule for the data's years."""
    d = df.withColumn("_day", F.to_date(_c(ts)))
    yr = d.agg(F.min(F.year("_day")).alias("a"), F.max(F.year("_day")).alias("b")).first()
    hols = [h for y in range(int(yr["a"]) - 1, int(yr["b"]) + 2) for h in us_holidays(y)]
    harr = F.array(*[F.lit(h) for h in hols])
    wd = Window.partitionBy(key).orderBy("_day")
    sess = (d.groupBy(key, "_day").agg(F.min(ts).alias("_open"), F.max(ts).alias("_close"))
            .withColumn("_next", F.lead("_day").over(wd)).withColumn("_prev", F.lag("_day").over(wd)))
    day, nxt, prv = F.col("_day"), F.col("_next"), F.col("_prev")
    sess = sess.select(
        key, "_day", "_open", "_close",
        F.array_contains(harr, day).alias("is_holiday"),
        F.exists(harr, lambda h: (h > day) & F.when(nxt.isNull(), h <= F.date_add(day, 7)).otherwise(h < nxt))
        .alias("last_day_before_holiday"),
        F.exists(harr, lambda h: (h < day) & F.when(prv.isNull(), h >= F.date_sub(day, 7)).otherwise(h > prv))
        .alias("first_day_after_holiday"))
    out = d.join(sess, [key, "_day"], "left")
    since = F.timestamp_diff("MICROSECOND", F.col("_open"), _c(ts)) / 60e6
    until = F.timestamp_diff("MICROSECOND", _c(ts), F.col("_close")) / 60e6
    for m in minutes:
        out = out.withColumn(f"within_open_{m}", since < m).withColumn(f"within_close_{m}", until < m)
    return out.drop("_day", "_open", "_close")
