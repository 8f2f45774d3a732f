"""Tabular preprocessing, fit on one table and applied to any (TAB1–TAB10).

Each ``fit_*`` returns a small fitted state (a dict or a small DataFrame with one
row per category/quantile); each ``apply`` is a projection or a join with that
small table.  Exact medians/quantiles use the distributed numbering
(:func:`barloom.operators.labels.exact_quantiles`) — no column is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.aggregates import inverse_normal
from barloom.operators.labels import exact_quantiles
from barloom.session import reliable_checkpoint


def _stack(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) long form of numeric columns (only to give one sort several columns' quantiles)."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("e")).select("e.*")


def column_quantiles(df: DataFrame, cols: list[str], qs: list[float]) -> dict:
    """Exact interpolated quantiles per column → {column: [q...]} (small result)."""
    st = _stack(df, cols)
    rows = exact_quantiles(st, "value", qs, key="column").collect()  # columns × len(qs) rows
    out = {c: [None] * len(qs) for c in cols}
    for r in rows:
        out[r["column"]][r["q_index"]] = r["value"]
    return out


# ---------------------------------------------------------------- TAB1
def fit_variance_filter(df: DataFrame, cols: list[str], threshold: float = 0.0) -> list[str]:
    """TAB1: keep columns whose population variance exceeds ``threshold`` (one aggregate)."""
    r = df.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    return [c for c in cols if r[c] is not None and r[c] > threshold]


# ---------------------------------------------------------------- TAB2
def fit_imputer(df: DataFrame, cols: list[str], strategy: str = "mean", fill_value=0.0) -> dict:
    """TAB2: fill values per column — mean, median (exact), most_frequent (smallest
    among ties) or constant."""
    if strategy == "mean":
        r = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
        return {c: r[c] for c in cols}
    if strategy == "median":
        q = column_quantiles(df, cols, [0.5])
        return {c: q[c][0] for c in cols}
    if strategy == "most_frequent":
        st = _stack(df, cols).where(F.col("value").isNotNull())
        cnt = st.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = cnt.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("v"))
        return {r["column"]: r["v"] for r in best.collect()}  # one row per column
    if strategy == "constant":
        return {c: fill_value for c in cols}
    raise ValueError(strategy)


def apply_imputer(df: DataFrame, fills: dict, add_indicator: bool = True) -> DataFrame:
    out = {}
    for c, v in fills.items():
        if add_indicator:
            out[f"missingindicator_{c}"] = F.col(c).isNull()
        out[c] = F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
    return df.withColumns(out)


# ---------------------------------------------------------------- TAB3
def iterative_impute(df: DataFrame, cols: list[str], rounds: int = 10, tol: float = 1e-3, seed: int = 42,
                     num_trees: int = 20, max_depth: int = 5, log: list | None = None) -> DataFrame:
    """TAB3: chained imputation: each column with gaps is predicted from all others by extra trees.

    Starts from the means; columns go from the smallest to the largest share of gaps.  A column's new values are
    written before the next column is fitted, so work and lineage grow linearly with rounds times columns.  The
    rounds end after ``rounds``, or once no imputed value moved by more than ``tol`` times the largest observed
    absolute value of its column (a shrinking step, not a limit on rows); ``log`` takes each round's largest move.
    Given values stay as they are (as doubles); NaN is a gap.  A column without any value stays null and predicts
    nothing; a column alone has its mean; a table without rows gives none."""
    from barloom.operators import extra_trees as ET
    gap = {c: F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in cols}
    told = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(gap[c].cast("long")).alias(f"g{i}") for i, c in enumerate(cols)],
                  *[F.avg(F.when(~gap[c], F.col(c).cast("double"))).alias(f"m{i}") for i, c in enumerate(cols)],
                  *[F.max(F.when(~gap[c], F.abs(F.col(c).cast("double")))).alias(f"x{i}") for i, c in enumerate(cols)]).first()
    place = {c: i for i, c in enumerate(cols)}
    known = [c for c in cols if told[f"m{place[c]}"] is not None]
    gaps = sorted((c for c in known if told[f"g{place[c]}"]), key=lambda c: (told[f"g{place[c]}"], place[c]))
    mark = "_"
    while any(c.startswith((f"{mark}gap", f"{mark}was", f"{mark}guess")) for c in df.columns):
        mark += "_"
    flag, was = ({c: f"{mark}{n}{place[c]}" for c in gaps} for n in ("gap", "was"))
    cur = df.withColumns({flag[c]: gap[c] for c in gaps})
    cur = cur.withColumns({c: F.when(gap[c], F.lit(told[f"m{place[c]}"])).otherwise(F.col(c).cast("double")) for c in cols})
    if gaps and len(known) > 1:
        cur = reliable_checkpoint(cur)
        for _ in range(rounds):
            cur = cur.withColumns({was[c]: F.col(c) for c in gaps})
            for c in gaps:
                others = [o for o in known if o != c]
                forest = ET.fit(cur.where(~F.col(flag[c])), others, c, regression=True, n_trees=num_trees, max_depth=max_depth,
                                max_features="all", seed=seed)
                cur = (forest.transform(cur, f"{mark}guess")
                       .withColumn(c, F.when(F.col(flag[c]), F.col(f"{mark}guess")).otherwise(F.col(c))).drop(f"{mark}guess"))
                cur = reliable_checkpoint(cur)
            moves = cur.agg(*[F.max(F.when(F.col(flag[c]), F.abs(F.col(c) - F.col(was[c])))).alias(c) for c in gaps]).first()
            far = max(moves[c] / (told[f"x{place[c]}"] or 1.0) for c in gaps)
            cur = cur.drop(*was.values())
            if log is not None:
                log.append(far)
            if far < tol:
                break
    return cur.select(*df.columns)


# ---------------------------------------------------------------- TAB4
def fit_quantile_transform(df: DataFrame, cols: list[str], n_quantiles: int = 100) -> dict:
    """TAB4: ``n_quantiles`` exact quantiles per column (references evenly spaced in [0, 1])."""
    qs = [i / (n_quantiles - 1) for i in range(n_quantiles)]
    return {"quantiles": column_quantiles(df, cols, qs), "references": qs}


def _interp(x: Column, xs: list[float], ys: list[float]) -> Column:
    """Piecewise-linear interpolation (np.interp semantics) as a CASE chain."""
    expr = F.when(x <= xs[0], F.lit(ys[0]))
    for i in range(1, len(xs)):
        x0, x1, y0, y1 = xs[i - 1], xs[i], ys[i - 1], ys[i]
        seg = F.lit(y1) if x1 == x0 else F.lit(y0) + (x - F.lit(x0)) * ((y1 - y0) / (x1 - x0))
        expr = expr.when(x <= x1, seg)
    return expr.otherwise(F.lit(ys[-1]))


def apply_quantile_transform(df: DataFrame, state: dict, output: str = "uniform") -> DataFrame:
    """Map each value through the fitted quantiles to [0, 1]; ``normal`` then applies
    Φ⁻¹ (clipped away from 0 and 1 as usual)."""
    cols = list(state["quantiles"])
    df = df.withColumns({c: F.when(F.col(c).isNotNull(), _interp(F.col(c).cast("double"), qv, state["references"]))
                         for c, qv in state["quantiles"].items()})
    if output == "normal":  # a projection of its own, so the interpolation is evaluated once
        eps = 1e-7
        df = df.withColumns({f"_u_{c}": F.least(F.greatest(F.col(c), F.lit(eps)), F.lit(1 - eps)) for c in cols})
        df = df.withColumns({c: F.when(F.col(c).isNotNull(), inverse_normal(F.col(f"_u_{c}"))) for c in cols})
        df = df.drop(*[f"_u_{c}" for c in cols])
    return df


# ---------------------------------------------------------------- TAB5 / TAB6
def fit_standard_scaler(df: DataFrame, cols: list[str]) -> dict:
    """TAB5: mean and population standard deviation per column (one aggregate)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__m"), F.stddev_pop(c).alias(f"{c}__s")]
    r = df.agg(*aggs).first()
    return {c: (r[f"{c}__m"], r[f"{c}__s"]) for c in cols}


def apply_standard_scaler(df: DataFrame, state: dict) -> DataFrame:
    return df.withColumns({c: F.when(F.lit(s) != 0, (F.col(c) - F.lit(m)) / F.lit(s)).otherwise(F.col(c) - F.lit(m))
                           for c, (m, s) in state.items()})


def fit_robust_scaler(df: DataFrame, cols: list[str]) -> dict:
    """TAB6: exact median and inter-quartile range per column."""
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75])
    return {c: (v[1], v[2] - v[0]) for c, v in q.items()}


def apply_robust_scaler(df: DataFrame, state: dict) -> DataFrame:
    return df.withColumns({c: F.when(F.lit(iqr) != 0, (F.col(c) - F.lit(med)) / F.lit(iqr)).otherwise(F.col(c) - F.lit(med))
                           for c, (med, iqr) in state.items()})


# ---------------------------------------------------------------- TAB7 / TAB8 / TAB9
def _codes(d: DataFrame) -> DataFrame:
    """0-based codes of distinct sorted ``value`` rows, by the distributed numbering
    (high-cardinality columns never pass through one task)."""
    from barloom.plans.frame import sequence
    fr = sequence(d.withColumn("_k", F.lit(0)), key="_k", order=("value",))
    return fr.df.select("value", (F.col("rn") - 1).cast("int").alias("code"))


def fit_categories(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a categorical column with 0-based codes."""
    d = df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull()).distinct()
    return _codes(d)


def apply_ordinal(df: DataFrame, col: str, cats: DataFrame, unknown: int = -1, out: str | None = None) -> DataFrame:
    """TAB7: value → its code; unseen → ``unknown``."""
    from barloom.operators.joins import dictionary_lookup
    return dictionary_lookup(df, col, cats, unknown, out or f"{col}_ord")


def fit_one_hot(df: DataFrame, col: str, max_categories: int = 1000) -> list[str]:
    """Sorted categories for one column each; more than ``max_categories`` raise (use :func:`one_hot_vector`)."""
    rows = df.select(F.col(col).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct().limit(max_categories + 1).collect()
    if len(rows) > max_categories:
        raise ValueError(f"{col} has more than {max_categories} categories: use one_hot_vector")
    return sorted(r["v"] for r in rows)


def one_hot_vector(df: DataFrame, col: str, cats: DataFrame, out: str | None = None) -> DataFrame:
    """TAB8 for any number of categories: MLlib's encoder on the joined dictionary code; unseen values get no entry."""
    from pyspark.ml.feature import OneHotEncoder
    size = cats.count()
    coded = apply_ordinal(df, col, cats, size, "_ohe")  # the code after the last stands for unseen
    enc = OneHotEncoder(inputCol="_ohe", outputCol=out or f"{col}_vec", dropLast=True, handleInvalid="keep")
    # sizes come from the dictionary: 0..size, and the last (unseen) is dropped to all zeros
    known = cats.sparkSession.range(size + 1).select(F.col("id").cast("double").alias("_ohe"))
    model = enc.setHandleInvalid("error").fit(known)
    return model.transform(coded.withColumn("_ohe", F.col("_ohe").cast("double"))).drop("_ohe")


def apply_one_hot(df: DataFrame, col: str, categories: list[str]) -> DataFrame:
    """TAB8: one 0/1 column per fitted category; unseen values get all zeros."""
    return df.withColumns({f"{col}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in categories})


def fit_label_encoder(df: DataFrame, col: str) -> DataFrame:
    """TAB9: codes for sorted classes (NULL read as '_nan'); '_nan' gets max+1 when
    unseen and '_unk' max+2 (own codes, where the reference reused the largest)."""
    d = _codes(df.select(F.coalesce(F.col(col).cast("string"), F.lit("_nan")).alias("value")).distinct())
    mx = d.agg(F.max("code").alias("m"), F.max((F.col("value") == "_nan").cast("int")).alias("has_nan")).first()
    extra = []
    nxt = (mx["m"] if mx["m"] is not None else -1) + 1
    if not mx["has_nan"]:
        extra.append(("_nan", nxt))
        nxt += 1
    extra.append(("_unk", nxt))
    return d.unionByName(df.sparkSession.createDataFrame(extra, "value string, code int"))


def apply_label_encoder(df: DataFrame, col: str, enc: DataFrame, out: str | None = None) -> DataFrame:
    from barloom.operators.joins import _maybe_broadcast
    unk = enc.where(F.col("value") == "_unk").first()["code"]
    key = F.coalesce(F.col(col).cast("string"), F.lit("_nan"))
    e = _maybe_broadcast(enc.select(F.col("value").alias("_v"), F.col("code").alias("_c")))
    j = df.withColumn("_k", key).join(e, F.col("_k") == F.col("_v"), "left")
    return j.withColumn(out or f"{col}_code", F.coalesce(F.col("_c"), F.lit(unk))).drop("_k", "_v", "_c")


# ---------------------------------------------------------------- TAB10
class TabularTransformer:
    """TAB10: numeric (variance filter → imputer → quantile transform → scaler),
    categorical (one-hot / ordinal / label codes) and date columns (cyclic v2)."""

    def __init__(self, numeric=(), ohe=(), ordinal=(), label=(), dates=(), variance_threshold=0.0,
                 imputer="mean", quantile_output="normal", scaler=True, date_format="dd/MM/yyyy"):
        self.numeric, self.ohe, self.ordinal, self.label, self.dates = map(list, (numeric, ohe, ordinal, label, dates))
        self.variance_threshold, self.imputer = variance_threshold, imputer
        self.quantile_output, self.scaler, self.date_format = quantile_output, scaler, date_format

    def fit(self, df: DataFrame) -> "TabularTransformer":
        from barloom.functions.timefeat import fit_year_range, parse_date
        num = self.numeric
        if self.variance_threshold is not None and num:
            num = fit_variance_filter(df, num, self.variance_threshold)
        self.kept_ = num
        self.fills_ = fit_imputer(df, num, self.imputer) if (self.imputer and num) else {}
        imputed = apply_imputer(df, self.fills_, add_indicator=False) if self.fills_ else df
        self.qt_ = fit_quantile_transform(imputed, num) if (self.quantile_output and num) else None
        tq = apply_quantile_transform(imputed, self.qt_, self.quantile_output) if self.qt_ else imputed
        self.sc_ = fit_standard_scaler(tq, num) if (self.scaler and num) else None
        self.ohe_ = {c: fit_one_hot(df, c) for c in self.ohe}
        self.ord_ = {c: fit_categories(df, c).cache() for c in self.ordinal}
        self.lab_ = {c: fit_label_encoder(df, c).cache() for c in self.label}
        self.years_ = {c: fit_year_range(df.withColumn(c, parse_date(c, self.date_format)), c) for c in self.dates}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        from barloom.functions.timefeat import cyclic_v2, parse_date
        out = df
        if self.fills_:
            out = apply_imputer(out, self.fills_, add_indicator=True)
        if self.qt_:
            out = apply_quantile_transform(out, self.qt_, self.quantile_output)
        if self.sc_:
            out = apply_standard_scaler(out, self.sc_)
        for c, cats in self.ohe_.items():
            out = apply_one_hot(out, c, cats)
        for c, cats in self.ord_.items():
            out = apply_ordinal(out, c, cats)
        for c, enc in self.lab_.items():
            out = apply_label_encoder(out, c, enc)
        for c, (a, b) in self.years_.items():
            tmp = f"_{c}_ts"
            out = out.withColumn(tmp, parse_date(c, self.date_format))
            out = out.withColumns(cyclic_v2(tmp, a, b, prefix=c)).drop(tmp)
        return out

    def output_columns(self, df: DataFrame) -> list[str]:
        return self.transform(df).columns

    def vocabulary_sizes(self) -> dict:
        sizes = {c: len(v) for c, v in self.ohe_.items()}
        sizes.update({c: e.count() for c, e in self.lab_.items()})
        return sizes
