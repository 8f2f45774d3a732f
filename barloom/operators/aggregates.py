"""Aggregations (AGG3–AGG11) and sorts / top-k (TOP1–TOP3).

All aggregates are hash aggregates with partial (map-side) aggregation; orderings
that need a row position use the bar frame's distributed numbering instead of a
single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.finite import safe_corr
from barloom.operators.labels import ranked_values, small_table


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    """AGG3: frequency of each value (or value pair)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).cast("long").alias("count"))


def histogram(df: DataFrame, x: str, bins: int = 20, group: str | None = None) -> DataFrame:
    """AGG4: ``bins`` equal-width bins between min and max (max falls in the last bin)."""
    keys = [group] if group else []
    if keys:
        rng = df.groupBy(*keys).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
        j = df.join(small_table(rng), keys, "inner")  # one row per group
    else:
        r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        j = df.withColumn("_lo", F.lit(r["lo"])).withColumn("_hi", F.lit(r["hi"]))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(x) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    j = j.where(F.col(x).isNotNull()).withColumn("bin", b)
    return (j.groupBy(*keys, "bin")
            .agg(F.count(F.lit(1)).cast("long").alias("count"),
                 F.first(F.col("_lo") + F.col("bin") * width).alias("bin_start"),
                 F.first(F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end")))


def corr_row(df: DataFrame, target: str, cols: list[str], group: str | None = None) -> DataFrame:
    """AGG5: one row of the correlation matrix: corr(target, c) for each c (long form)."""
    return _corr_table(df, target, [(c, c) for c in cols], "feature", group)


def _corr_table(df: DataFrame, target: str, columns: list[tuple], name: str, group: str | None) -> DataFrame:
    """(group, name, corr): one aggregate with an expression per column, unpivoted afterwards."""
    keys = [group] if group else []
    wide = df.groupBy(*keys).agg(F.array(*[
        F.struct(F.lit(label).alias(name), safe_corr(F.col(target).cast("double"), F.col(c).cast("double")).alias("corr"))
        for label, c in columns]).alias("_e"))
    return wide.select(*keys, F.explode("_e").alias("_e")).select(*keys, "_e.*")


def corr_by_parameter(df: DataFrame, target: str, columns_by_param: dict, group: str | None = None) -> DataFrame:
    """AGG6: corr(feature(param), target) for each parameter value (columns already built)."""
    return _corr_table(df, target, list(columns_by_param.items()), "param", group)


def inverse_normal(p: Column) -> Column:
    """Φ⁻¹(p) by a rational approximation (relative error ≈ 1e-9), for 0 < p < 1."""
    # Fixed coefficients of the published rational approximation (Acklam).
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    plow = 0.02425

    def poly(cs, x):
        acc = F.lit(cs[0])
        for k in cs[1:]:
            acc = acc * x + F.lit(k)
        return acc

    q_lo = F.sqrt(-2 * F.log(p))
    lo = poly(c, q_lo) / (poly(d, q_lo) * q_lo + 1)
    q = p - 0.5
    r = q * q
    mid = poly(a, r) * q / (poly(b, r) * r + 1)
    q_hi = F.sqrt(-2 * F.log(1 - p))
    hi = -poly(c, q_hi) / (poly(d, q_hi) * q_hi + 1)
    return F.when((p <= 0) | (p >= 1), F.lit(None).cast("double")) \
        .when(p < plow, lo).when(p <= 1 - plow, mid).otherwise(hi)


def qq_table(df: DataFrame, x: str, group: str = "symbol") -> DataFrame:
    """AGG7: normal Q-Q table — ordered values against Φ⁻¹ of Filliben's plotting
    positions.  Distinct values are numbered with their counts, so neither a long
    group nor a value that repeats very often is one task."""
    t = ranked_values(df, x, group)
    t = t.withColumn("_c0", F.explode(F.sequence(F.col("_before") + 1, F.col("_upto"), F.lit(100_000).cast("long"))))
    # a value that repeats very often is dealt out in chunks of its ranks
    t = t.repartition(group, "_v", "_c0").withColumn(
        "rn", F.explode(F.sequence(F.col("_c0"), F.least(F.col("_c0") + 99_999, F.col("_upto")))))
    last = F.pow(F.lit(0.5), 1.0 / F.col("_n"))
    m = (F.when(F.col("rn") == F.col("_n"), last)
         .when(F.col("rn") == 1, 1 - last)
         .otherwise((F.col("rn") - 0.3175) / (F.col("_n") + 0.365)))
    return t.select(group, F.col("rn").alias("i"), F.col("_v").alias("ordered_value"),
                    inverse_normal(m).alias("theoretical_quantile"))


def run_lengths(fr, state: str, out_prefix: str = "run") -> DataFrame:
    """AGG8: consecutive equal ``state`` values → (key, start, end, length, state).
    Gaps-and-islands: a change flag, its running sum (block scan), then a group-by."""
    from barloom.functions.finite import Feat
    from barloom.plans.frame import Win
    w = Win(fr.key, fr.block)
    prev = w.lag(F.col(state), 1)
    fr = fr.add(Feat([("_chg", F.when(prev.isNull() | (prev != F.col(state)), 1).otherwise(0))], 1))
    fr = fr.cumsum("_island", F.col("_chg"))
    ts = fr.order[0]
    return (fr.df.groupBy(fr.key, "_island")
            .agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count(F.lit(1)).cast("long").alias("length"),
                 F.first(state).alias(state))
            .drop("_island"))


MANUAL_WEIGHTS = {"strong buy": 1.0, "strong sell": 1.0, "meh": 0.1, "buy": 0.5, "sell": 0.5}


def class_weights(df: DataFrame, cls: str, mode: str = "manual", mapping=MANUAL_WEIGHTS) -> DataFrame:
    """AGG9: per-row weight of the class: the manual map, or 'balanced' = n/(k·count)."""
    if mode == "manual":
        m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
        return df.withColumn("weight", F.coalesce(m[F.col(cls)], F.lit(1.0)))
    counts = df.groupBy(F.col(cls).alias("_cls")).agg(F.count(F.lit(1)).alias("_c"))   # one row per class, NULL is one
    allw = Window.partitionBy()
    cw = counts.select("_cls", (F.sum("_c").over(allw) / (F.count(F.lit(1)).over(allw) * F.col("_c"))).alias("weight"))
    return df.join(small_table(cw), F.col(cls).eqNullSafe(F.col("_cls")), "left").drop("_cls")


def data_checks(df: DataFrame, cols: list[str], target: str | None = None) -> DataFrame:
    """AGG10: per column — null share, distinct count (exact), constant flag; one aggregate."""
    n = F.count(F.lit(1))
    aggs = []
    for c in cols:
        aggs += [(F.sum(F.col(c).isNull().cast("long")) / n).alias(f"{c}__null_share"),
                 F.countDistinct(F.col(c)).alias(f"{c}__distinct")]
    row = df.agg(*aggs)
    stacked = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"{c}__null_share").cast("double").alias("null_share"),
                 F.col(f"{c}__distinct").cast("long").alias("distinct")) for c in cols])).alias("e")).select("e.*")
    return stacked.withColumn("constant", F.col("distinct") <= 1)


def rank_candidates(df: DataFrame, score: str = "mean_test_score") -> DataFrame:
    """AGG11: rank (1 = best, ties share the rank) by descending score.
    Candidate tables are small (one row per parameter set)."""
    return df.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.col(score).desc())).cast("int"))


def top_abs_after_first(df: DataFrame, value: str, index: str, k: int = 5, group: str | None = None) -> DataFrame:
    """TOP2: the ``k`` largest |value| after dropping the first-ranked one (positions 2..k+1)."""
    keys = [group] if group else []
    w = Window.partitionBy(*keys).orderBy(F.abs(F.col(value)).desc(), F.col(index))
    r = df.withColumn("_r", F.row_number().over(w))
    return r.where((F.col("_r") >= 2) & (F.col("_r") <= k + 1)).withColumn("position", F.col("_r") - 1).drop("_r")


def latest_per_key(df: DataFrame, key: str = "symbol", order: str = "ts") -> DataFrame:
    """TOP3: the last row of each key (``max_by`` over a struct of the row)."""
    other = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max_by(F.struct(*other), F.col(order)).alias("_r"))
            .select(key, "_r.*"))


