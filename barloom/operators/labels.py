"""Labels and targets (LAB1–LAB5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.finite import Feat, col, guard, pct, sdiv
from barloom.plans.frame import BarFrame, Win
from barloom.session import reliable_checkpoint


def forward_log_return(w: Win, x="close", h=10, out=None) -> Feat:
    """LAB1: ln(x₊h / x); NULL where no future row exists (or a price ≤ 0)."""
    fut = w.lead(col(x), h)
    val = F.when((col(x) > 0) & (fut > 0), F.log(fut / col(x)))
    return Feat([(out or f"target_{h}_ret", val)], 0, h)


def updown_label(w: Win, h="high", l="low", lookback=30, lookforward=5, up_down_factor=2.0,
                 percent_factor=0.01, out="updown_signal") -> Feat:
    """LAB2: 1 if each of the next ``lookforward`` one-bar % returns of the median
    price exceeds ``up_down_factor·percent_factor`` (the 'down' test is implied), else −1.
    NULL where the lookback/lookforward rows do not exist."""
    m = "_lab2_m"
    r = "_lab2_r"
    up = up_down_factor * percent_factor
    conds = [w.lead(F.col(r), k) > up for k in range(1, lookforward + 1)]
    allup = conds[0]
    for c in conds[1:]:
        allup = allup & c
    have = w.lead(F.col(m), lookforward).isNotNull()
    val = F.when(have, F.when(allup, F.lit(1)).otherwise(F.lit(-1)))
    return Feat([(m, (col(h) + col(l)) / 2.0),
                 (r, pct(F.col(m), w.lag(F.col(m), 1))),
                 (out, guard(val, lookback))], lookback, lookforward)


def lagged_returns(w: Win, h="high", l="low", lookback=30, lookforward=5) -> Feat:
    """LAB5: 30 lagged and 5 forward one-bar % returns of the median price."""
    m = "_lab5_m"
    r = "_lab5_r"
    steps = [(m, (col(h) + col(l)) / 2.0),
             (r, pct(F.col(m), w.lag(F.col(m), 1)))]
    steps.append(("lookback0", F.col(r)))
    for i in range(1, lookback + 1):
        steps.append((f"lookback{i}", w.lag(F.col(r), i)))
    for i in range(1, lookforward + 1):
        steps.append((f"lookforward{i}", w.lead(F.col(r), i)))
    return Feat(steps, lookback + 1, lookforward)


def desired_position(w: Win, x="close", lag=10, multiplier=10.0) -> Feat:
    """LAB3: desired_pos_change = multiplier·100·ln(x₊lag/x); desired_pos_rolling =
    its sum over the last ``lag`` rows (NULL until ``lag`` values exist)."""
    fut = w.lead(col(x), lag)
    chg = F.when((col(x) > 0) & (fut > 0), F.log(fut / col(x)) * (multiplier * 100.0))
    return Feat([("desired_pos_change", chg),
                 ("desired_pos_rolling", guard(F.sum(F.col("desired_pos_change")).over(w.w(lag)), lag - 1))],
                lag - 1, lag)


CHANGE_CLASSES = ["strong sell", "sell", "meh", "buy", "strong buy"]
ROLLING_CLASSES = ["short hold", "no hold", "long hold"]


def small_table(df: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """``df`` with a broadcast hint if its rows, counted first, fit ``max_bytes``; else as it is
    (Spark then joins by shuffle and splits hot keys at run time)."""
    most = max_bytes // (16 + 24 * len(df.columns))
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def ranked_values(df: DataFrame, x: str, key: str) -> DataFrame:
    """(key, _v, _before, _upto, _n): every distinct non-null value with its ranks (_before, _upto] of _n.

    Values are counted first and only distinct ones are numbered (by the bar
    frame's distributed numbering), so a value held by half the rows is one row here.
    """
    from barloom.plans.frame import sequence

    counts = (df.select(F.col(key), F.col(x).cast("double").alias("_v")).where(F.col("_v").isNotNull())
              .groupBy(key, "_v").agg(F.count(F.lit(1)).alias("_c")))
    counts = reliable_checkpoint(counts)  # read for the numbering, the totals and the picks
    fr = sequence(counts, key=key, order=("_v",)).cumsum("_cum", F.col("_c"))
    upto = F.round("_cum").cast("long")
    rows = fr.df.select(key, "_v", (upto - F.col("_c")).alias("_before"), upto.alias("_upto"))
    total = counts.groupBy(key).agg(F.sum("_c").alias("_n"))  # one row per key
    return rows.join(small_table(total), key)


def exact_quantiles(df: DataFrame, x: str, qs: list[float], key: str = "symbol") -> DataFrame:
    """Exact interpolated quantiles of ``x`` per key: (key, q_index, value).

    The cut point of ``q`` lies between the ranks around ``q·(n−1)``; each distinct
    value (:func:`ranked_values`) keeps the wanted ranks that fall on it, and
    the two values per quantile are interpolated.  No group is gathered in one task.
    """
    rows = ranked_values(df, x, key)

    def ranks(i: int, q: float):
        low = F.floor(F.lit(float(q)) * (F.col("_n") - 1)) + 1
        return [F.struct(F.lit(i).alias("qi"), r.cast("long").alias("rank")) for r in (low, F.least(low + 1, F.col("_n")))]

    wanted = F.array(*[r for i, q in enumerate(qs) for r in ranks(i, q)])
    picks = rows.select(key, "_v", "_n", F.explode(F.filter(
        wanted, lambda p: (p["rank"] > F.col("_before")) & (p["rank"] <= F.col("_upto")))).alias("p"))
    q = F.element_at(F.array(*[F.lit(float(v)) for v in qs]), F.col("q_index") + 1)
    at = q * (F.col("_n") - 1)
    return (picks.select(key, "_v", "_n", F.col("p.qi").alias("q_index"), "p.rank")
            .groupBy(key, "q_index").agg(F.min_by("_v", "rank").alias("_a"), F.max_by("_v", "rank").alias("_b"), F.max("_n").alias("_n"))
            .select(key, "q_index", (F.col("_a") + (F.col("_b") - F.col("_a")) * (at - F.floor(at))).alias("value")))


def quantile_classes(df: DataFrame, x: str, names: list[str], key: str = "symbol", out: str | None = None) -> DataFrame:
    """LAB4: cut ``x`` at its exact per-key quantiles (len(names) equal-count bins,
    interpolated, right-closed) and name the bins."""
    k = len(names)
    qs = [i / k for i in range(1, k)]
    cuts = (exact_quantiles(df, x, qs, key).groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct("q_index", "value"))).alias("_c")))
    cuts = cuts.select(key, F.transform("_c", lambda e: e["value"]).alias("_cuts"))
    j = df.join(small_table(cuts), key, "left")  # one row per key
    expr = None
    for i in range(k - 1):
        cond = F.col(x) <= F.col("_cuts")[i]
        expr = F.when(cond, F.lit(names[i])) if expr is None else expr.when(cond, F.lit(names[i]))
    expr = expr.otherwise(F.lit(names[-1]))
    return j.withColumn(out or f"{x}_class", F.when(F.col(x).isNotNull(), expr)).drop("_cuts")


def add_labels(fr: BarFrame, h: int = 10) -> BarFrame:
    w = Win(fr.key, fr.block)
    return fr.add(forward_log_return(w, h=h))
