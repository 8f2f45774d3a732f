"""Queries for tabular preprocessing, selection, folds, models and metrics.

Deterministic tables (encodings, scalers, quantile maps, fold tables, metrics
on given predictions, selection statistics) have DuckDB oracles; model fits are
registered without one (rows-only check)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import recurrent as RC
from barloom.operators import learning as LN
from barloom.operators import tabular as TAB
from barloom.plans.frame import Win, sequence
from barloom.plans.oracle import DAILY_CTES
from barloom.plans.queries import daily_frame, finish
from barloom.plans import pattern_oracle as PO
from barloom.plans import sqlkit as SK
from barloom.plans.sqlkit import G, LAG, R, W
from barloom.plans.table_queries import LAB_CTES, _inv_norm_sql, labelled_daily
from barloom.sources import bars as BS
from barloom.sources import tables as TB

SPARK: dict = {}
SQL: dict = {}
CLOSE = "close"
WINDOW = "WINDOW w AS (PARTITION BY symbol ORDER BY rn)"


def reg(qid, sql=None):
    def deco(fn):
        SPARK[qid] = fn
        if sql is not None:
            SQL[qid] = sql
        return fn
    return deco


def customers(spark, sf):
    """customer with negative balances read as missing."""
    c = TB.table(spark, sf, "customer")
    return c.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))


CUST_SQL = "(SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)"

# ------------------------------------------------------------------ TAB
_TAB1_COLS = ["p_size", "p_retailprice"]


@reg("tab1_variance_filter", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {R(f'var_pop({c})', 4)} AS variance, var_pop({c}) > 0.0 AS kept FROM part"
    for c in _TAB1_COLS))
def q_tab1(spark, sf):
    p = TB.table(spark, sf, "part")
    kept = TAB.fit_variance_filter(p, _TAB1_COLS, 0.0)
    st = p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                      for c in _TAB1_COLS])).alias("e"))
    out = st.groupBy(F.col("e.column").alias("column")).agg(F.var_pop("e.v").alias("variance"))
    return finish(out.withColumn("kept", F.col("column").isin(kept)), 4)


@reg("tab2_simple_imputer", f"WITH c AS {CUST_SQL}, s AS (SELECT avg(c_acctbal) AS m, quantile_cont(c_acctbal, 0.5) AS md FROM c) "
     f"SELECT c_custkey, {R('coalesce(c_acctbal, s.m)', 6)} AS c_acctbal_mean, {R('coalesce(c_acctbal, s.md)', 6)} AS c_acctbal_median, "
     "c_acctbal IS NULL AS missingindicator_c_acctbal FROM c, s")
def q_tab2(spark, sf):
    c = customers(spark, sf).select("c_custkey", "c_acctbal")
    mean = TAB.fit_imputer(c, ["c_acctbal"], "mean")["c_acctbal"]
    med = TAB.fit_imputer(c, ["c_acctbal"], "median")["c_acctbal"]
    out = TAB.apply_imputer(c, {"c_acctbal": mean}).withColumnRenamed("c_acctbal", "c_acctbal_mean")
    out = out.join(TAB.apply_imputer(c, {"c_acctbal": med}, add_indicator=False)
                   .withColumnRenamed("c_acctbal", "c_acctbal_median"), "c_custkey")
    return finish(out, 6)


@reg("tab3_iterative_imputer")
def q_tab3(spark, sf):
    c = customers(spark, sf).select("c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey"),
                                    "c_acctbal", F.length("c_mktsegment").cast("double").alias("seg_len"))
    return TAB.iterative_impute(c, ["c_acctbal", "c_nationkey", "seg_len"], num_trees=10)


def _interp_sql(x, qcol, n):
    parts = [f"WHEN {x} <= {qcol}[1] THEN 0.0"]
    for i in range(2, n + 1):
        y0, y1 = (i - 2) / (n - 1), (i - 1) / (n - 1)
        parts.append(f"WHEN {x} <= {qcol}[{i}] THEN (CASE WHEN {qcol}[{i}] = {qcol}[{i - 1}] THEN {y1!r} "
                     f"ELSE {y0!r} + ({x} - {qcol}[{i - 1}]) * ({y1 - y0!r} / ({qcol}[{i}] - {qcol}[{i - 1}])) END)")
    return "(CASE " + " ".join(parts) + " ELSE 1.0 END)"


_QS = "[" + ", ".join(repr(i / 99) for i in range(100)) + "]"


@reg("tab4_quantile_transform_uniform", f"WITH q AS (SELECT quantile_cont(p_retailprice, {_QS}) AS qs FROM part) "
     f"SELECT p_partkey, {R(_interp_sql('p_retailprice', 'qs', 100), 8)} AS p_retailprice FROM part, q")
def q_tab4(spark, sf):
    p = TB.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    st = TAB.fit_quantile_transform(p, ["p_retailprice"], 100)
    return finish(TAB.apply_quantile_transform(p, st, "uniform"), 8)


@reg("tab4_quantile_transform_normal", f"WITH q AS (SELECT quantile_cont(p_retailprice, {_QS}) AS qs FROM part), "
     f"u AS (SELECT p_partkey, least(greatest({_interp_sql('p_retailprice', 'qs', 100)}, 1e-7), 1 - 1e-7) AS u FROM part, q) "
     f"SELECT p_partkey, {R(_inv_norm_sql('u'), 6)} AS p_retailprice FROM u")
def q_tab4n(spark, sf):
    p = TB.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    st = TAB.fit_quantile_transform(p, ["p_retailprice"], 100)
    return finish(TAB.apply_quantile_transform(p, st, "normal"), 6)


@reg("tab5_standard_scaler", f"WITH s AS (SELECT avg(p_retailprice) AS m, stddev_pop(p_retailprice) AS sd FROM part) "
     f"SELECT p_partkey, {R('(p_retailprice - m) / sd', 8)} AS p_retailprice FROM part, s")
def q_tab5(spark, sf):
    p = TB.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return finish(TAB.apply_standard_scaler(p, TAB.fit_standard_scaler(p, ["p_retailprice"])), 8)


@reg("tab6_robust_scaler", "WITH s AS (SELECT quantile_cont(p_retailprice, [0.25, 0.5, 0.75]) AS q FROM part) "
     f"SELECT p_partkey, {R('(p_retailprice - q[2]) / (q[3] - q[1])', 8)} AS p_retailprice FROM part, s")
def q_tab6(spark, sf):
    p = TB.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    return finish(TAB.apply_robust_scaler(p, TAB.fit_robust_scaler(p, ["p_retailprice"])), 8)


@reg("tab7_ordinal_encoding", "WITH d AS (SELECT c_mktsegment AS v, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code "
     "FROM (SELECT DISTINCT c_mktsegment FROM customer)) SELECT c_custkey, code AS c_mktsegment_ord FROM customer JOIN d ON d.v = c_mktsegment")
def q_tab7(spark, sf):
    c = TB.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return TAB.apply_ordinal(c, "c_mktsegment", TAB.fit_categories(c, "c_mktsegment")).drop("c_mktsegment")


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@reg("tab8_one_hot", "SELECT p_partkey, " + ", ".join(
    f"CAST(p_type = '{t}' AS INTEGER) AS p_type_{t}" for t in _TYPES) + " FROM part")
def q_tab8(spark, sf):
    p = TB.table(spark, sf, "part").select("p_partkey", "p_type")
    return TAB.apply_one_hot(p, "p_type", TAB.fit_one_hot(p, "p_type")).drop("p_type")


_BRANDS = "(SELECT p_partkey, p_size, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS p_brand FROM part)"


@reg("tab9_label_encoding_nan_unk", f"WITH b AS {_BRANDS}, f AS (SELECT DISTINCT p_brand AS v FROM b WHERE p_size <= 10 AND p_brand <> (SELECT min(p_brand) FROM part)), "
     "d AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM f), m AS (SELECT max(code) AS mx FROM d) "
     "SELECT p_partkey, CASE WHEN p_brand IS NULL THEN mx + 1 WHEN d.code IS NULL THEN mx + 2 ELSE d.code END AS p_brand_code "
     "FROM b LEFT JOIN d ON d.v = p_brand, m")
def q_tab9(spark, sf):
    """The first brand is never seen when fitting (``_unk``), every seventh brand is missing when applying (``_nan``)."""
    p = TB.table(spark, sf, "part").select("p_partkey", "p_size", F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).alias("p_brand"))
    low = TB.table(spark, sf, "part").agg(F.min("p_brand")).first()[0]
    enc = TAB.fit_label_encoder(p.where((F.col("p_size") <= 10) & (F.col("p_brand") != low)), "p_brand")
    return TAB.apply_label_encoder(p, "p_brand", enc).select("p_partkey", F.col("p_brand_code").cast("int"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _circle_sql(name, part, period):
    return ", ".join(f"{R(f'{f}(2 * pi() * {part} / {period}.0)', 6)} AS since_{name}_{f}" for f in ("sin", "cos"))


_TAB10_SQL = (
    "WITH c AS (SELECT * REPLACE (CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal), "
    "make_date(CAST(1990 + c_nationkey AS INTEGER), CAST(c_custkey % 12 + 1 AS INTEGER), 1) AS d FROM customer), "
    "m AS (SELECT avg(c_acctbal) AS m FROM c), i AS (SELECT c.*, c_acctbal IS NULL AS gap, coalesce(c_acctbal, m) AS x FROM c, m), "
    f"q AS (SELECT quantile_cont(x, {_QS}) AS qs FROM i), "
    f"p AS (SELECT i.*, least(greatest({_interp_sql('x', 'qs', 100)}, 1e-7), 1 - 1e-7) AS u FROM i, q), "
    f"z AS (SELECT p.*, {_inv_norm_sql('u')} AS normal FROM p), s AS (SELECT avg(normal) AS zm, stddev_pop(normal) AS zs FROM z), "
    "k AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS v FROM customer)), "
    "y AS (SELECT min(year(d)) AS y0, max(year(d)) AS y1 FROM c) "
    f"SELECT z.* EXCLUDE (d, gap, x, u, normal) REPLACE ({R('(normal - zm) / zs', 6)} AS c_acctbal), strftime(d, '%d/%m/%Y') AS since, "
    "gap AS missingindicator_c_acctbal, " + ", ".join(f"CAST(c_mktsegment = '{v}' AS INTEGER) AS c_mktsegment_{v}" for v in _SEGMENTS)
    + ", code AS c_nationkey_code, " + _circle_sql("day", "day(d)", 31) + ", " + _circle_sql("dayofweek", "(isodow(d) - 1)", 6) + ", "
    + _circle_sql("month", "month(d)", 12) + f", {R('(year(d) - y0) / CAST(y1 - y0 AS DOUBLE)', 6)} AS since_year "
    "FROM z JOIN k ON k.v = CAST(c_nationkey AS VARCHAR), s, y")


@reg("tab10_tabular_transformer", _TAB10_SQL)
def q_tab10(spark, sf):
    c = customers(spark, sf).withColumn("since", F.date_format(F.make_date(
        F.lit(1990) + F.col("c_nationkey"), (F.col("c_custkey") % 12) + 1, F.lit(1)), "dd/MM/yyyy"))
    tt = TAB.TabularTransformer(numeric=["c_acctbal"], ohe=["c_mktsegment"], label=["c_nationkey"], dates=["since"]).fit(c)
    return finish(tt.transform(c), 6)


# ------------------------------------------------------------- folds (CV1–CV3)
def _events_frame(spark, sf):
    ev = TB.table(spark, sf, "events").select(F.lit("ALL").alias("symbol"), "ts", "event_id", "value")
    return sequence(ev, order=("ts", "event_id"))


@reg("cv1_time_series_folds", "WITH e AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS rn FROM events), "
     "n AS (SELECT max(rn) AS n, max(rn) // 6 AS t FROM e), f AS (SELECT unnest(range(5)) AS fold), "
     "x AS (SELECT fold, rn, CASE WHEN rn <= n - (5 - fold) * t THEN 'train' WHEN rn <= n - (5 - fold) * t + t THEN 'test' END AS role FROM e, n, f) "
     "SELECT CAST(fold AS INTEGER) AS fold, role, CAST(count(*) AS BIGINT) AS rows, min(rn) AS first_rn, max(rn) AS last_rn "
     "FROM x WHERE role IS NOT NULL GROUP BY fold, role")
def q_cv1(spark, sf):
    fr = _events_frame(spark, sf)
    return LN.fold_table(fr.df, 5, n_rows=fr.stats.n_rows)


@reg("cv2_stratified_folds", "SELECT c_custkey, CAST(floor((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) * 5 "
     "/ count(*) OVER (PARTITION BY c_mktsegment)) AS INTEGER) AS fold FROM customer")
def q_cv2(spark, sf):
    c = TB.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return LN.stratified_folds(c, "c_mktsegment", 5, "c_custkey").select("c_custkey", "fold")


@reg("cv3_ordered_holdout", "WITH e AS (SELECT row_number() OVER (ORDER BY ts, event_id) AS rn FROM events), n AS (SELECT max(rn) AS n FROM e) "
     "SELECT CASE WHEN rn > n - ceil(n * 0.35) THEN 'test' ELSE 'train' END AS role, CAST(count(*) AS BIGINT) AS rows FROM e, n GROUP BY 1")
def q_cv3(spark, sf):
    fr = _events_frame(spark, sf)
    return LN.ordered_holdout(fr.df, 0.35).groupBy("role").agg(F.count(F.lit(1)).cast("long").alias("rows"))


# ------------------------------------------------------------- ML table
FEATS = ["RSI_14", "ROC_7", "MOM_7", "WILLR_14", "LINEARREG_SLOPE_14"]


_FEAT_SQL = (f"close, volume, {G(7, f'CASE WHEN {LAG(CLOSE, 7)} <> 0 THEN (close / {LAG(CLOSE, 7)} - 1.0) * 100.0 ELSE 0.0 END')} AS ROC_7, "
             f"{G(7, f'close - {LAG(CLOSE, 7)}')} AS MOM_7, "
             f"{G(13, f'CASE WHEN max(high) {W(14)} <> min(low) {W(14)} THEN -100.0 * (max(high) {W(14)} - close) / (max(high) {W(14)} - min(low) {W(14)}) ELSE 0.0 END')} AS WILLR_14")


def ml_table(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.roc(w, n=7), FI.mom(w, n=7), FI.willr(w, n=14), FI.linearreg_slope(w, n=14))
    fr = RC.rsi(fr, n=14)
    lab = labelled_daily(spark, sf).select("symbol", "ts", "pos_change_signal", "target_10_ret")
    df = fr.df.select("symbol", "ts", "rn", *FEATS).join(lab, ["symbol", "ts"]).na.drop("any")
    df = LN.label_indexer("pos_change_signal").fit(df).transform(df)
    # reused by several fits in one query: keep it (lost blocks are recomputed)
    return VectorAssembler(inputCols=FEATS, outputCol="features").transform(df).cache()


def _split(df):
    h = LN.ordered_holdout(df, 0.35, key="symbol")
    return h.where("role = 'train'"), h.where("role = 'test'")


def _fit_predict(kind, task="classification", **params):
    def q(spark, sf):
        df = ml_table(spark, sf)
        label = "label" if task == "classification" else "target_10_ret"
        tr, te = _split(df)
        if kind != "RandomForest":  # its bootstrap draws rows by partition
            tr = LN.fit_rows(tr)
        m = LN.make_estimator(kind, task, label=label, **params).fit(tr)
        return m.transform(te).select("symbol", "ts", "prediction")
    return q


SPARK["ml1_decision_tree"] = _fit_predict("DecisionTree", maxDepth=5)
SPARK["ml2_random_forest"] = _fit_predict("RandomForest", numTrees=20, maxDepth=5)
SPARK["ml3_extra_trees"] = _fit_predict("ExtraTrees", numTrees=20, maxDepth=5)
SPARK["ml5_gradient_boosting_regressor"] = _fit_predict("GradientBoosting", "regression", maxIter=10, maxDepth=3)
SPARK["ml7_logistic_regression"] = _fit_predict("Linear", maxIter=20)


@reg("ml3_extra_trees_random_cuts")
def q_ml3_random_cuts(spark, sf):
    """ML3 proper: cuts drawn inside the node's box, level by level."""
    from barloom.operators import extra_trees as ET
    tr, te = _split(ml_table(spark, sf))
    forest = ET.fit(tr, FEATS, "label", n_trees=20, max_depth=5)
    return forest.transform(te.select("symbol", "ts", *FEATS)).select("symbol", "ts", "prediction", "probability")


def _ml_ctes():
    """ml_table in SQL: ``x`` (features, class number ``label``, target, role of the ordered hold-out) and its train rows ``tr``."""
    recs = [SK.wilder_mean("ag", "pre", "greatest(dx, 0.0)", 14, 2), SK.wilder_mean("al", "pre", "greatest(-dx, 0.0)", 14, 2)]
    whole = " AND ".join(f"{c} IS NOT NULL" for c in [*FEATS, "pos_change_signal", "target_10_ret"])
    return (f"{LAB_CTES}, pre AS (SELECT *, close - {LAG(CLOSE, 1)} AS dx FROM bd {WINDOW}), " + ", ".join(r.strip() for r in recs)
            + f", f AS (SELECT symbol, ts, rn, {_FEAT_SQL}, {G(13, f'regr_slope(close, rn) {W(14)}')} AS LINEARREG_SLOPE_14 FROM bd {WINDOW}), "
            "m0 AS (SELECT f.*, pos_change_signal, target_10_ret, CASE WHEN ag.ag IS NOT NULL THEN CASE WHEN ag.ag + al.al <> 0 "
            "THEN ag.ag * 100.0 / (ag.ag + al.al) ELSE 0.0 END END AS RSI_14 FROM f JOIN lab USING (symbol, ts) "
            "JOIN ag ON ag.symbol = f.symbol AND ag.rn = f.rn JOIN al ON al.symbol = f.symbol AND al.rn = f.rn), "
            f"m1 AS (SELECT *, dense_rank() OVER (ORDER BY pos_change_signal) - 1.0 AS label, max(rn) OVER (PARTITION BY symbol) AS n FROM m0 WHERE {whole}), "
            "x AS (SELECT *, rn > n - ceil(n * 0.35) AS held FROM m1), tr AS (SELECT * FROM x WHERE NOT held)")


def _nb_sql():
    """Gaussian naive Bayes: class means and variances (a billionth of the largest feature variance added), then Bayes' rule."""
    stat = ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in FEATS)
    eps = "greatest(" + ", ".join(f"var_pop({c})" for c in FEATS) + ")"
    dens = " + ".join(f"(ln(2 * pi() * (v_{c} + e)) + pow(x.{c} - m_{c}, 2) / (v_{c} + e))" for c in FEATS)
    return (f"WITH RECURSIVE {_ml_ctes()}, e AS (SELECT 1e-9 * {eps} AS e FROM tr), "
            f"c AS (SELECT label AS cls, ln(count(*) / (SELECT count(*) FROM tr)) AS prior, {stat} FROM tr GROUP BY label), "
            f"s AS (SELECT x.symbol, x.ts, cls, prior - 0.5 * ({dens}) AS lp FROM x, c, e WHERE held), "
            "p AS (SELECT symbol, ts, cls, exp(lp - max(lp) OVER (PARTITION BY symbol, ts)) AS q FROM s) "
            f"SELECT symbol, ts, max_by(cls, q) AS prediction, {R('max(q) / sum(q)', 6)} AS proba FROM p GROUP BY symbol, ts")


@reg("ml6_gaussian_naive_bayes", _nb_sql())
def q_ml6(spark, sf):
    """ML6 with EV4: the class and its probability (EV4), against Bayes' rule in SQL."""
    tr, te = _split(ml_table(spark, sf))
    m = LN.make_estimator("GaussianNB").fit(tr)
    return finish(LN.predict_with_proba(m, te).select("symbol", "ts", "prediction", "proba"), 6)


def _normal_equations_sql():
    """Least squares by elimination on the centred covariances of the train rows, one step a CTE."""
    k = len(FEATS)
    cov = ", ".join([f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) AS a{i}_{j}" for i, a in enumerate(FEATS) for j, b in enumerate(FEATS)]
                    + [f"covar_pop({a}, target_10_ret) / stddev_pop({a}) AS a{i}_{k}" for i, a in enumerate(FEATS)]
                    + [f"avg({a}) AS m{i}, stddev_pop({a}) AS d{i}" for i, a in enumerate(FEATS)] + ["avg(target_10_ret) AS my"])
    ctes, last, rest = [f"g0 AS (SELECT {cov} FROM tr)"], "g0", ", ".join([f"m{i}, d{i}" for i in range(k)] + ["my"])
    for p in range(k):  # column p goes from every row but p
        cells = [f"a{i}_{j} - a{i}_{p} / a{p}_{p} * a{p}_{j} AS a{i}_{j}" if i != p else f"a{i}_{j}" for i in range(k) for j in range(k + 1)]
        ctes.append(f"g{p + 1} AS (SELECT {', '.join(cells)}, {rest} FROM {last})")
        last = f"g{p + 1}"
    fit = " + ".join(f"a{i}_{k} / a{i}_{i} * (x.{c} - m{i}) / d{i}" for i, c in enumerate(FEATS))
    return f"WITH RECURSIVE {_ml_ctes()}, {', '.join(ctes)} SELECT symbol, ts, {R(f'my + {fit}', 7)} AS prediction FROM x, {last} WHERE held"


@reg("ml7_linear_regression", _normal_equations_sql())
def q_ml7_linear(spark, sf):
    tr, te = _split(ml_table(spark, sf))
    m = LN.make_estimator("Linear", "regression", label="target_10_ret").fit(tr)
    return finish(m.transform(te).select("symbol", "ts", "prediction"), 7)


@reg("ml5_softmax_boosting")
def q_ml5_softmax(spark, sf):
    """ML5 for all classes at once: histograms, one softmax."""
    from barloom.operators import boosting as GB
    tr, te = _split(ml_table(spark, sf))
    model = GB.fit(tr, FEATS, "label", rounds=20, max_depth=3)
    return model.transform(te.select("symbol", "ts", *FEATS)).select("symbol", "ts", "prediction", "probability")


@reg("ml4_adaboost")
def q_ml4(spark, sf):
    df = ml_table(spark, sf)
    tr, te = _split(df)
    models = LN.adaboost_fit(tr.cache(), n_rounds=10, max_depth=2)
    labels = [r[0] for r in tr.select("label").distinct().collect()]
    return LN.adaboost_predict(models, te, labels).select("symbol", "ts", "prediction")


@reg("ml8_class_sample_weights", f"WITH {LAB_CTES} SELECT symbol, ts, CASE pos_change_signal WHEN 'strong buy' THEN 1.0 "
     "WHEN 'strong sell' THEN 1.0 WHEN 'meh' THEN 0.1 WHEN 'buy' THEN 0.5 WHEN 'sell' THEN 0.5 ELSE 1.0 END AS weight FROM lab")
def q_ml8(spark, sf):
    lab = labelled_daily(spark, sf).select("symbol", "ts", "pos_change_signal")
    from barloom.operators.aggregates import MANUAL_WEIGHTS, class_weights
    return class_weights(lab, "pos_change_signal", "manual", MANUAL_WEIGHTS).select("symbol", "ts", "weight")


# ------------------------------------------------------------- CV4–CV8
#: Splits and trees of the registered searches (the reference: 5 splits, 600 trees).
CV_SPLITS = 5


def _cv_setup(spark, sf):
    df = ml_table(spark, sf).drop("rn")
    fr = sequence(df.withColumn("_k", F.lit(0)), key="_k", order=("ts", "symbol"))
    data = fr.df.drop("blk", "sblk", "_k").cache()
    return data, CV_SPLITS


def _rf(**p):
    return LN.make_estimator("RandomForest", "classification", numTrees=p.get("numTrees", 10), maxDepth=p.get("maxDepth", 3))


@reg("cv4_cv7_grid_search_results")
def q_cv4(spark, sf):
    data, folds = _cv_setup(spark, sf)
    return LN.cross_validate(_rf, data, folds, LN.grid({"maxDepth": [3, 5], "numTrees": [5, 10]}))


@reg("cv5_randomized_search")
def q_cv5(spark, sf):
    data, folds = _cv_setup(spark, sf)
    return LN.cross_validate(_rf, data, folds, LN.random_candidates({"maxDepth": [2, 3, 4, 5], "numTrees": [5, 10]}, 5, 42))


#: Draws of the randomised search (the reference's number) and the grid they come from.
CV5_DRAWS = 100
CV5_GRID = {"max_depth": [1, 2, 3, 4, 5, 6], "n_trees": [5, 10], "max_features": ["sqrt", "log2", "all"], "min_split": [2.0, 10.0, 50.0, 100.0]}


@reg("cv2_cv5_search_100_draws_on_stratified_folds")
def q_cv5_100(spark, sf):
    """100 draws x 5 stratified folds: all forests grown and scored together on one staged table."""
    from barloom.operators import extra_trees as ET
    data, folds = _cv_setup(spark, sf)
    parts = LN.stratified_folds(data.withColumnRenamed("rn", "at"), "label", folds, "at")
    return ET.search(parts, FEATS, "label", "fold", LN.random_candidates(CV5_GRID, CV5_DRAWS, 42), seed=42)


@reg("cv2_cv4_grid_search_on_stratified_folds")
def q_cv2_search(spark, sf):
    """MLlib trees on stratified folds, trials submitted in parallel under a bound."""
    data, folds = _cv_setup(spark, sf)
    parts = LN.stratified_folds(data.withColumnRenamed("rn", "at"), "label", folds, "at").cache()
    make = lambda **p: LN.make_estimator("DecisionTree", "classification", **p)
    return LN.cross_validate_folds(make, parts, "fold", LN.grid({"maxDepth": [2, 4, 6], "minInstancesPerNode": [1, 20]}), parallelism=4)


@reg("cv6_successive_halving")
def q_cv6(spark, sf):
    data, folds = _cv_setup(spark, sf)
    return LN.successive_halving(_rf, data, folds, LN.grid({"maxDepth": [2, 4, 6]}), factor=3, min_fraction=1 / 3)


@reg("cv8_validation_curve")
def q_cv8(spark, sf):
    data, folds = _cv_setup(spark, sf)
    return LN.validation_curve(_rf, data, folds, "maxDepth", list(range(1, 47, 5)))


# ------------------------------------------------------------- EV
_PRED_SQL = (f"WITH {LAB_CTES}, p AS (SELECT symbol, ts, pos_change_signal AS label, CASE WHEN lag(close) OVER "
             "(PARTITION BY symbol ORDER BY rn) < close THEN 'buy' ELSE 'sell' END AS prediction FROM lab WHERE pos_change_signal IS NOT NULL)")


def _preds(spark, sf):
    lab = labelled_daily(spark, sf)
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.Feat([("prediction", F.when(w.lag(F.col("close"), 1) < F.col("close"), "buy").otherwise("sell"))], 1))
    y = lab.where(F.col("pos_change_signal").isNotNull()).select("symbol", "ts", F.col("pos_change_signal").alias("label"))
    return y.join(fr.df.select("symbol", "ts", "prediction"), ["symbol", "ts"])


@reg("ev1_accuracy", f"{_PRED_SQL} SELECT symbol, {R('avg(CAST(label = prediction AS DOUBLE))', 8)} AS accuracy FROM p GROUP BY symbol")
def q_ev1(spark, sf):
    p = _preds(spark, sf)
    return finish(p.groupBy("symbol").agg(LN.accuracy_of().alias("accuracy")), 8)


@reg("ev1_r2_score", f"WITH {DAILY_CTES}, p AS (SELECT symbol, close AS y, {G(6, f'avg(close) {W(7)}')} AS yhat FROM bd {WINDOW}) "
     f"SELECT symbol, {R('1 - sum(pow(y - yhat, 2)) / (var_pop(y) * count(*))', 8)} AS r2 FROM p WHERE yhat IS NOT NULL GROUP BY symbol")
def q_ev1r2(spark, sf):
    fr = daily_frame(spark, sf)
    fr = fr.add(FI.sma(Win(fr.key, fr.block), n=7, out="yhat"))
    p = fr.df.where(F.col("yhat").isNotNull())
    return finish(p.groupBy("symbol").agg(LN.r2_of("close", "yhat").alias("r2")), 8)


@reg("ev2_classification_report", f"{_PRED_SQL}, c AS (SELECT label AS l, prediction AS pr, count(*) AS n FROM p GROUP BY 1, 2), "
     "sup AS (SELECT l AS cls, sum(n) AS support FROM c GROUP BY 1), prd AS (SELECT pr AS cls, sum(n) AS predicted FROM c GROUP BY 1), "
     "tp AS (SELECT l AS cls, n AS tp FROM c WHERE l = pr), "
     "t AS (SELECT coalesce(sup.cls, prd.cls) AS cls, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted, coalesce(tp, 0) AS tp "
     "FROM sup FULL JOIN prd ON sup.cls = prd.cls LEFT JOIN tp ON tp.cls = coalesce(sup.cls, prd.cls)), "
     "m AS (SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS pr, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM t) "
     f"SELECT cls, {R('pr', 8)} AS precision, {R('rc', 8)} AS recall, {R('CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END', 8)} AS f1, "
     "CAST(support AS BIGINT) AS support FROM m")
def q_ev2(spark, sf):
    return finish(LN.classification_report(_preds(spark, sf)), 8)


@reg("ev3_permutation_importance")
def q_ev3(spark, sf):
    df = ml_table(spark, sf)
    tr, te = _split(df)
    m = LN.make_estimator("RandomForest", numTrees=10, maxDepth=4).fit(tr)
    return LN.permutation_importance(m, te.drop("features", "rn"), FEATS, key=("ts", "symbol"))


@reg("ev4_predict_proba")
def q_ev4(spark, sf):
    df = ml_table(spark, sf)
    tr, te = _split(df)
    m = LN.make_estimator("RandomForest", numTrees=10, maxDepth=4).fit(tr)
    return LN.predict_with_proba(m, te).select("symbol", "ts", "prediction", "proba")


# ------------------------------------------------------------- SEL
_SEL1_RANGES = [(4, 10), (10, 20), (20, 30), (30, 40), (40, 50), (50, 100), (100, 200), (200, 300)]
_SEL1_IND = ["RSI", "ATR", "ADX", "LINEARREG_SLOPE", "MOM"]


def _sel1_periods(per_range: int = 2, seed: int = 42) -> list[int]:
    """A fixed seeded sample of the periods of each range."""
    import random
    rnd = random.Random(seed)
    return sorted(p for lo, hi in _SEL1_RANGES for p in rnd.sample(range(lo, hi), per_range))


def _sel1_sql():
    """All recurrences of all periods as lists carried by one row-by-row loop."""
    P = _sel1_periods()
    n = len(P)
    ps, ks = "[" + ", ".join(f"{p}.0" for p in P) + "]", f"range(1, {n + 1})"
    zero = f"[0.0::DOUBLE for k in {ks}]"

    def mean(y, x, first):  # Wilder mean from row p * mult + add: seed of p values
        mult, add = first
        return (f"[CASE WHEN rn < p[k] * {mult} + {add} THEN 0.0 WHEN rn <= p[k] * {mult} + {add} + p[k] - 1 THEN {y}[k] + {x} / p[k] "
                f"ELSE {y}[k] * (p[k] - 1) / p[k] + {x} / p[k] END for k in {ks}]")

    def total(y, x):
        return f"[CASE WHEN rn < 2 THEN 0.0 WHEN rn <= p[k] THEN {y}[k] + {x} ELSE {y}[k] * (p[k] - 1) / p[k] + {x} END for k in {ks}]"
    di = "(CASE WHEN t2[k] <> 0 THEN {}[k] * 100.0 / t2[k] ELSE 0.0 END)"
    up, dn = di.format("s2"), di.format("m2")
    start = ", ".join(f"{zero} AS {c}" for c in ("ag", "al", "tra", "sp", "sm", "st", "dx", "ax"))
    step = (f"SELECT symbol, rn, ag2 AS ag, al2 AS al, tra2 AS tra, s2 AS sp, m2 AS sm, t2 AS st, dx2 AS dx, {mean('ax', 'dx2[k]', (1, 1))} AS ax FROM ("
            f"SELECT *, [CASE WHEN rn <= p[k] THEN 0.0 WHEN {up} + {dn} <> 0 THEN abs({up} - {dn}) * 100.0 / ({up} + {dn}) ELSE dx[k] END for k in {ks}] AS dx2 FROM ("
            f"SELECT *, {mean('ag', 'g', (0, 2))} AS ag2, {mean('al', 'l', (0, 2))} AS al2, {mean('tra', 'tr', (0, 2))} AS tra2, "
            f"{total('sp', 'pdm')} AS s2, {total('sm', 'mdm')} AS m2, {total('st', 'tr')} AS t2 FROM ("
            f"SELECT d.symbol, d.rn, d.g, d.l, d.tr, d.pdm, d.mdm, {ps} AS p, r.* EXCLUDE (symbol, rn) FROM rec r JOIN d ON d.symbol = r.symbol AND d.rn = r.rn + 1)))")
    value = {"RSI": lambda i, p: f"CASE WHEN rn > {p} THEN CASE WHEN ag[{i}] + al[{i}] <> 0 THEN ag[{i}] * 100.0 / (ag[{i}] + al[{i}]) ELSE 0.0 END END",
             "ATR": lambda i, p: f"CASE WHEN rn > {p} THEN tra[{i}] END", "ADX": lambda i, p: f"CASE WHEN rn >= {2 * p} THEN ax[{i}] END",
             "LINEARREG_SLOPE": lambda i, p: f"sl{p}", "MOM": lambda i, p: f"mo{p}"}
    cols = ", ".join(f"{G(p - 1, f'regr_slope(close, rn) {W(p)}')} AS sl{p}, {G(p, f'close - {LAG(CLOSE, p)}')} AS mo{p}" for p in P)
    uni = " UNION ALL ".join(f"SELECT symbol, '{ind}' AS indicator, {p} AS period, corr(fwd, {value[ind](i + 1, p)}) AS c FROM x GROUP BY symbol"
                             for ind in _SEL1_IND for i, p in enumerate(P))
    ranges = ", ".join(f"({lo}, {hi})" for lo, hi in _SEL1_RANGES)
    return (f"WITH RECURSIVE {DAILY_CTES}, d0 AS (SELECT *, close - lag(close) OVER w AS dc, high - lag(high) OVER w AS up, lag(low) OVER w - low AS dn, "
            f"lag(close) OVER w AS pc FROM bd {WINDOW}), "
            "d AS (SELECT symbol, rn, greatest(dc, 0.0) AS g, greatest(-dc, 0.0) AS l, CASE WHEN up > 0 AND up > dn THEN up ELSE 0.0 END AS pdm, "
            "CASE WHEN dn > 0 AND dn > up THEN dn ELSE 0.0 END AS mdm, CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr FROM d0), "
            f"rec AS (SELECT DISTINCT symbol, CAST(1 AS BIGINT) AS rn, {start} FROM bd UNION ALL {step}), "
            f"f AS (SELECT symbol, rn, lead(close, 10) OVER w / close - 1 AS fwd, {cols} FROM bd {WINDOW}), "
            f"x AS (SELECT * FROM f JOIN rec USING (symbol, rn)), u AS ({uni}), r AS (SELECT * FROM (VALUES {ranges}) t(lo, hi)), "
            "k AS (SELECT u.*, lo, hi, row_number() OVER (PARTITION BY symbol, indicator, lo ORDER BY abs(c) DESC, period) AS rk "
            "FROM u JOIN r ON period >= lo AND period < hi) "
            f"SELECT symbol, indicator, lo AS range_lo, hi AS range_hi, period, {R('c', 7)} AS corr FROM k WHERE rk = 1")


@reg("sel1_indicator_tuning", _sel1_sql())
def q_sel1(spark, sf):
    """SEL1: RSI, ATR, ADX, LINEARREG_SLOPE and MOM over the eight period ranges (two sampled periods each)."""
    from barloom.plans import features as FP
    P = _sel1_periods()
    fr = sequence(BS.bars_daily(spark, sf))
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.Feat([("fwd", w.lead(F.col("close"), 10) / F.col("close") - 1)], 0, 10))
    made = FP.generate_all_features(fr.drop("fwd"), patterns=False, time=False, cycle=False, dropna=False, sort=False,
                                    pairs=[(i, p) for i in _SEL1_IND for p in P])
    df = made.df.join(fr.df.select("symbol", "rn", "fwd"), ["symbol", "rn"])
    out = LN.best_period_by_correlation(df, "fwd", {(i, p): f"{i}_{p}" for i in _SEL1_IND for p in P}, _SEL1_RANGES, key="symbol")
    return finish(out, 7)


def _sel1_rank_sql():
    """Spearman by SQL's own ranks: rows with both values, mean rank of equal values, Pearson of the ranks."""
    P = _sel1_periods()
    cols = ", ".join(f"{G(p, f'close - {LAG(CLOSE, p)}')} AS MOM_{p}, "
                     f"{G(p, f'CASE WHEN {LAG(CLOSE, p)} <> 0 THEN (close / {LAG(CLOSE, p)} - 1.0) * 100.0 ELSE 0.0 END')} AS ROC_{p}" for p in P)
    uni = " UNION ALL ".join(f"SELECT symbol, '{i}' AS indicator, {p} AS period, {i}_{p} AS v, fwd FROM f WHERE {i}_{p} IS NOT NULL AND fwd IS NOT NULL"
                             for i in ("MOM", "ROC") for p in P)
    mean = ("rank() OVER (PARTITION BY symbol, indicator, period ORDER BY {0}) + (count(*) OVER (PARTITION BY symbol, indicator, period, {0}) - 1) / 2.0 AS r{0}")
    ranges = ", ".join(f"({lo}, {hi})" for lo, hi in _SEL1_RANGES)
    return (f"WITH {DAILY_CTES}, f AS (SELECT symbol, rn, lead(close, 10) OVER w / close - 1 AS fwd, {cols} FROM bd {WINDOW}), l AS ({uni}), "
            f"q AS (SELECT *, {mean.format('v')}, {mean.format('fwd')} FROM l), u AS (SELECT symbol, indicator, period, corr(rv, rfwd) AS c FROM q GROUP BY ALL), "
            f"r AS (SELECT * FROM (VALUES {ranges}) t(lo, hi)), "
            "k AS (SELECT u.*, lo, hi, row_number() OVER (PARTITION BY symbol, indicator, lo ORDER BY round(abs(c), 9) DESC, period) AS rk "
            "FROM u JOIN r ON period >= lo AND period < hi) "
            f"SELECT symbol, indicator, lo AS range_lo, hi AS range_hi, period, {R('c', 7)} AS corr FROM k WHERE rk = 1")


@reg("sel1_rank_correlation", _sel1_rank_sql())
def q_sel1_rank(spark, sf):
    """SEL1 with rank correlation: MOM and ROC over the eight period ranges, all candidates ranked in one numbering."""
    P = _sel1_periods()
    fr = sequence(BS.bars_daily(spark, sf))
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.Feat([("fwd", w.lead(F.col("close"), 10) / F.col("close") - 1)], 0, 10))
    fr = fr.add(*[make(w, n=p) for p in P for make in (FI.mom, FI.roc)])
    out = LN.best_period_by_correlation(fr.df, "fwd", {(i, p): f"{i}_{p}" for i in ("MOM", "ROC") for p in P}, _SEL1_RANGES, key="symbol", method="rank")
    return finish(out, 7)


_SEL2 = ["open", "high", "low", "close", "volume"]


def _sel2_sql():
    """The greedy walk in column order, spelled out: a column stays if no kept one before it correlates above 0.95."""
    ctes = [f"c AS (SELECT {', '.join(f'abs(corr({a}, {b})) > 0.95 AS x_{a}_{b}' for i, a in enumerate(_SEL2) for b in _SEL2[i + 1:])} FROM bd)"]
    prev = "c"
    for i, b in enumerate(_SEL2):
        clash = " OR ".join(f"(k_{a} AND x_{a}_{b})" for a in _SEL2[:i]) or "FALSE"
        ctes.append(f"s{i} AS (SELECT *, NOT ({clash}) AS k_{b} FROM {prev})")
        prev = f"s{i}"
    return (f"WITH {DAILY_CTES}, {', '.join(ctes)} "
            + " UNION ALL ".join(f"SELECT '{c}' AS feature, k_{c} AS kept FROM {prev}" for c in _SEL2))


@reg("sel2_prune_correlated", _sel2_sql())
def q_sel2(spark, sf):
    kept = LN.prune_correlated(BS.bars_daily(spark, sf), _SEL2, 0.95)
    return spark.createDataFrame([(c, c in kept) for c in _SEL2], "feature string, kept boolean")


def _sel3_sql(step=10, top=5):
    return (f"WITH s AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, o_totalprice AS p FROM orders), "
            f"t AS (SELECT rn, ln(lead(p, {step}) OVER (ORDER BY rn) / p) AS y FROM s), "
            f"x AS (SELECT row_number() OVER (ORDER BY rn) AS i, y FROM t WHERE (rn - 1) % {step} = 0 AND y IS NOT NULL), "
            "n AS (SELECT count(*) AS n, avg(y) AS m FROM x), "
            "K AS (SELECT least(CAST(floor(10 * log10(n)) AS INTEGER), n - 1) AS k FROM n), "
            "lags AS (SELECT unnest(range(1, (SELECT k FROM K) + 1)) AS k), "
            "c0 AS (SELECT sum((y - m) * (y - m)) AS c0 FROM x, n), "
            "ck AS (SELECT lags.k, sum((a.y - n.m) * (b.y - n.m)) AS c FROM lags, x a JOIN x b ON b.i = a.i - lags.k, n GROUP BY lags.k), "
            f"r AS (SELECT k, c / c0 AS acf FROM ck, c0) SELECT CAST(k AS INTEGER) AS lag, {R('acf', 8)} AS acf FROM r "
            f"ORDER BY abs(acf) DESC, k LIMIT {top}")


@reg("sel3_acf_top_lags", _sel3_sql())
def q_sel3(spark, sf):
    """ACF of the 10-bar forward log return of the order series, sampled every 10 rows
    (robust scaling is affine, so it leaves the ACF unchanged)."""
    from barloom.sources.bars import ticks_orders
    from barloom.operators.labels import forward_log_return
    fr = sequence(ticks_orders(spark, sf), order=("ts", "seq"))
    fr = fr.add(forward_log_return(Win(fr.key, fr.block), h=10, out="y"))
    top = LN.acf_top_lags(fr, "y", 10, 5)
    return finish(spark.createDataFrame([(int(k), float(v)) for k, v in top], "lag int, acf double"), 8)


@reg("sel4_lagged_targets", f"WITH {DAILY_CTES}, a AS (SELECT symbol, ts, rn, CASE WHEN close > 0 AND {LAG('close', 10)} > 0 "
     f"THEN ln(close / {LAG('close', 10)}) END AS lr FROM bd {WINDOW}) SELECT symbol, ts, "
     + ", ".join(f"{R(LAG('lr', k * 10), 8)} AS lagged_target_{k * 10}" for k in (1, 2, 3)) + f" FROM a {WINDOW}")
def q_sel4(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(*[FI.log_return(w, "close", 10, k * 10, f"lagged_target_{k * 10}") for k in (1, 2, 3)])
    return finish(fr.df.select("symbol", "ts", *[f"lagged_target_{k * 10}" for k in (1, 2, 3)]), 8)


@reg("sel5_recursive_elimination_cv")
def q_sel5(spark, sf):
    data, folds = _cv_setup(spark, sf)
    best, score = LN.rfe_cv(data.drop("features").cache(), FEATS, step=1, n_splits=folds, num_trees=5, min_features=2)
    return spark.createDataFrame([(c, c in best) for c in FEATS], "feature string, selected boolean")


@reg("sel6_select_by_importance")
def q_sel6(spark, sf):
    df = ml_table(spark, sf)
    m = LN.make_estimator("RandomForest", numTrees=10, maxDepth=4).fit(df)
    slicer, names = LN.select_by_importance(m, FEATS)
    return spark.createDataFrame([(c, c in names) for c in FEATS], "feature string, selected boolean")


#: Features that both sides compute by the same operations (equal bits, so equal bins).
_SEL7_ALL = ["ROC_7", "MOM_7", "WILLR_14", "volume", "close"]


def _sel7_sql(names, bins=10):
    uni = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, pos_change_signal AS y FROM x" for c in names)
    return (f"WITH {LAB_CTES}, f AS (SELECT symbol, ts, {_FEAT_SQL} FROM bd {WINDOW}), "
            "x AS (SELECT f.*, pos_change_signal FROM f JOIN lab USING (symbol, ts) WHERE pos_change_signal IS NOT NULL), "
            f"s AS ({uni}), b AS (SELECT feature, y, CAST(floor((row_number() OVER (PARTITION BY feature ORDER BY v, y) - 1) * {bins} "
            "/ count(*) OVER (PARTITION BY feature)) AS INTEGER) AS bin FROM s WHERE v IS NOT NULL), "
            "j AS (SELECT feature, bin, y, count(*) AS nxy FROM b GROUP BY 1, 2, 3), "
            "k AS (SELECT *, sum(nxy) OVER (PARTITION BY feature) AS n, sum(nxy) OVER (PARTITION BY feature, bin) AS nx, "
            "sum(nxy) OVER (PARTITION BY feature, y) AS ny FROM j) "
            f"SELECT feature, {R('sum(nxy / n * ln(nxy * n / (nx * ny)))', 8)} AS mutual_information FROM k GROUP BY feature")


def _sel7_table(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.roc(w, n=7), FI.mom(w, n=7), FI.willr(w, n=14))
    lab = labelled_daily(spark, sf).select("symbol", "ts", "pos_change_signal").where(F.col("pos_change_signal").isNotNull())
    return fr.df.join(lab, ["symbol", "ts"])


@reg("sel7_mutual_information", _sel7_sql(["ROC_7", "MOM_7"]))
def q_sel7(spark, sf):
    return finish(LN.mutual_information(_sel7_table(spark, sf), ["ROC_7", "MOM_7"], "pos_change_signal", 10), 8)


@reg("sel7_k_best", f"WITH mi AS ({_sel7_sql(_SEL7_ALL)}) SELECT feature, mutual_information, "
     "CAST(row_number() OVER (ORDER BY mutual_information DESC, feature) AS INTEGER) AS rank FROM mi QUALIFY rank <= 3")
def q_sel7_k(spark, sf):
    """SEL7 in full: the three features that tell most about the class."""
    out = LN.select_k_best(_sel7_table(spark, sf), _SEL7_ALL, "pos_change_signal", 3)
    return finish(out, 8)


@reg("sel8_pca")
def q_sel8(spark, sf):
    df = ml_table(spark, sf)
    m = LN.pca_features(df, FEATS, k=3)
    from pyspark.ml.functions import vector_to_array
    return m.transform(df).select("symbol", "ts", vector_to_array("pca").alias("pca"))


def _pca_sql(names, k):
    """Leading components of the correlation matrix: squared until one direction is left, then taken off and again."""
    n, t = len(names), len(names) ** 2
    square = f"[list_sum([m[(t // {n}) * {n} + j + 1] * m[j * {n} + t % {n} + 1] for j in range({n})]) for t in range({t})]"
    steps = [f"a0 AS (SELECT [{', '.join(f'corr({a}, {b})' for a in names for b in names)}] AS a FROM x)"]
    for c in range(1, k + 1):
        steps += [f"p{c} AS (SELECT 0 AS step, a AS m FROM a{c - 1} UNION ALL SELECT step + 1, "
                  f"[v / list_sum([sq[j * {n + 1} + 1] for j in range({n})]) for v in sq] FROM (SELECT step, {square} AS sq FROM p{c} WHERE step < 16))",
                  f"e{c} AS (SELECT m, list_sum([a[t + 1] * m[t + 1] for t in range({t})]) AS l, "
                  f"list_position([m[j * {n + 1} + 1] for j in range({n})], list_max([m[j * {n + 1} + 1] for j in range({n})])) - 1 AS top "
                  f"FROM p{c}, a{c - 1} WHERE step = 16)",
                  f"a{c} AS (SELECT [a[t + 1] - l * m[t + 1] for t in range({t})] AS a FROM a{c - 1}, e{c})"]
    rows = " UNION ALL ".join(f"SELECT {c} AS component, '{f}' AS feature, {R(f'm[{i * n} + top + 1] / sqrt(m[top * {n + 1} + 1])', 5)} AS loading, "
                              f"{R(f'l / {n}.0', 6)} AS explained_variance FROM e{c}" for c in range(1, k + 1) for i, f in enumerate(names))
    live = " AND ".join(f"{c} IS NOT NULL" for c in names)
    return (f"WITH RECURSIVE {DAILY_CTES}, f AS (SELECT symbol, ts, {_FEAT_SQL} FROM bd {WINDOW}), x AS (SELECT * FROM f WHERE {live}), "
            + ", ".join(steps) + f" SELECT * FROM ({rows})")


@reg("sel8_pca_components", _pca_sql(_SEL7_ALL, 3))
def q_sel8_components(spark, sf):
    """SEL8 by its closed form: loadings (the largest of a component positive) and shares of the variance."""
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    df = fr.add(FI.roc(w, n=7), FI.mom(w, n=7), FI.willr(w, n=14)).df.dropna(subset=_SEL7_ALL)
    return finish(LN.pca_components(LN.pca_features(df, _SEL7_ALL, k=3), _SEL7_ALL), 6, {"loading": 5})


# ------------------------------------------------------------- FP / SNK
@reg("fp1_generate_all_features")
def q_fp1(spark, sf):
    """FP1: all 581 columns of the 15 lags, patterns smoothed by WMA(300), cycle and time fields, rows with a NULL dropped."""
    from barloom.plans import features as FP
    return FP.generate_all_features(sequence(BS.bars_daily(spark, sf))).df.drop("blk", "sblk")


#: One column of each kind of table behind FP1: SQL over the window ``w``, earlier rows it needs, decimals.
_FP1_SAMPLE = {
    "MOM_147": (f"close - {LAG('close', 147)}", 147, 6),
    **{f"CCI_{n}": (f"CASE WHEN list_sum([abs(x - sm{n}) for x in l{n}]) = 0 OR tp = sm{n} THEN 0.0 "
                    f"ELSE (tp - sm{n}) / (0.015 * list_sum([abs(x - sm{n}) for x in l{n}]) / {n}.0) END", n - 1, 5) for n in (7, 147)},
    "WILLR_107": (f"CASE WHEN max(high) {W(107)} <> min(low) {W(107)} THEN -100.0 * (max(high) {W(107)} - close) / (max(high) {W(107)} - min(low) {W(107)}) ELSE 0.0 END", 106, 6),
    "STDDEV_97": (f"stddev_pop(close) {W(97)}", 96, 3),
    "APO_127": (f"avg(close) {W(127)} - avg(close) {W(254)}", 253, 6),
    "LINEARREG_SLOPE_137": (f"regr_slope(close, rn) {W(137)}", 136, 4),
    "MFI_57": (f"CASE WHEN sum(pf + nf) {W(57)} < 1.0 THEN 0.0 ELSE sum(pf) {W(57)} * 100.0 / sum(pf + nf) {W(57)} END", 57, 5),
}
_FP1_RECS = [SK.wilder_mean("ag", "pre", "greatest(dx, 0.0)", 147, 2), SK.wilder_mean("al", "pre", "greatest(-dx, 0.0)", 147, 2),
             SK.wilder_mean("atr", "pre", "tr", 117, 2), SK.ema("es", "pre", "close", 134), SK.ema("ef", "pre", "close", 67, start=68)]
_FP1_SQL = (
    f"WITH RECURSIVE {DAILY_CTES}, p0 AS (SELECT *, (high + low + close) / 3.0 AS tp, {LAG('close', 1)} AS pc FROM bd {WINDOW}), "
    f"pre AS (SELECT *, close - pc AS dx, CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr, "
    f"CASE WHEN tp > {LAG('tp', 1)} THEN tp * volume ELSE 0.0 END AS pf, CASE WHEN tp < {LAG('tp', 1)} THEN tp * volume ELSE 0.0 END AS nf, "
    + ", ".join(f"avg(tp) {W(n)} AS sm{n}, list(tp) {W(n)} AS l{n}" for n in (7, 147)) + f" FROM p0 {WINDOW}), "
    + ", ".join(r.strip() for r in _FP1_RECS)
    + ", mm AS (SELECT pre.symbol, pre.rn, ef.ef - es.es AS m FROM pre JOIN es USING (symbol, rn) JOIN ef USING (symbol, rn)), "
    + SK.ema("sg", "mm", "m", 33, start=134).strip()
    + ", j AS (SELECT pre.*, ag.ag, al.al, atr.atr, sg.sg FROM pre JOIN ag USING (symbol, rn) JOIN al USING (symbol, rn) "
      "JOIN atr USING (symbol, rn) JOIN sg USING (symbol, rn)) SELECT symbol, ts, "
    + ", ".join(f"{R(G(lb, e), d)} AS {n}" for n, (e, lb, d) in _FP1_SAMPLE.items())
    + f", {R('CASE WHEN ag IS NOT NULL THEN CASE WHEN ag + al <> 0 THEN ag * 100.0 / (ag + al) ELSE 0.0 END END', 6)} AS RSI_147, "
    f"{R(G(117, 'atr'), 6)} AS ATR_117, {R('CASE WHEN rn >= 166 THEN sg END', 5)} AS MACDSIGNAL_67 FROM j {WINDOW}")


@reg("fp1_all_lags_column_sample", _FP1_SQL)
def q_fp1_sample(spark, sf):
    """FP1's lag families at all 15 lags (no patterns, rows kept); columns of every kind against SQL."""
    from barloom.plans import features as FP
    fr = FP.generate_all_features(daily_frame(spark, sf), patterns=False, time=False, cycle=False, dropna=False)
    digits = {n: d for n, (_, _, d) in _FP1_SAMPLE.items()}
    return finish(fr.df.select("symbol", "ts", *_FP1_SAMPLE, "RSI_147", "ATR_117", "MACDSIGNAL_67"), 6, {**digits, "MACDSIGNAL_67": 5})


_FP2_NAMES = "3_LINEARREG_SLOPE_17,0_RSI_7,1_STOCH_7slowk,2_time_day_of_month,4_CDLENGULFING,5_MACDHIST_7,"
_FP2_K = "CASE WHEN rn > 6 THEN CASE WHEN max(high) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) <> min(low) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) THEN (close - min(low) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) * 100.0 / (max(high) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) - min(low) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) ELSE 0.0 END END"


def _fp2_sql():
    recs = [SK.wilder_mean("ag", "pre", "greatest(dx, 0.0)", 7, 2), SK.wilder_mean("al", "pre", "greatest(-dx, 0.0)", 7, 2),
            SK.ema("es", "pre", "close", 14), SK.ema("ef", "pre", "close", 7, start=8)]
    return (f"WITH RECURSIVE {DAILY_CTES}, {', '.join(PO.pattern_ctes(['CDLENGULFING'], 'bd'))}, "
            f"pre AS (SELECT *, {LAG('close', 1)} AS pc, close - {LAG('close', 1)} AS dx, {_FP2_K} AS k FROM bd {WINDOW}), "
            + ", ".join(r.strip() for r in recs)
            + ", mm AS (SELECT pre.symbol, pre.rn, ef.ef - es.es AS m FROM pre JOIN es USING (symbol, rn) JOIN ef USING (symbol, rn)), "
            + SK.ema("sg", "mm", "m", 3, start=14).strip()
            + f", j AS (SELECT pre.*, ag.ag, al.al, mm.m, sg.sg, pat.CDLENGULFING AS eng FROM pre JOIN ag USING (symbol, rn) JOIN al USING (symbol, rn) "
              "JOIN mm USING (symbol, rn) JOIN sg USING (symbol, rn) JOIN pat USING (symbol, rn)), "
              f"k2 AS (SELECT *, avg(k) {W(3)} AS sk FROM j {WINDOW}) "
            f"SELECT symbol, ts, {R('CASE WHEN ag IS NOT NULL THEN CASE WHEN ag + al <> 0 THEN ag * 100.0 / (ag + al) ELSE 0.0 END END', 6)} AS RSI_7, "
            f"{R(G(10, 'sk'), 6)} AS STOCH_7slowk, CAST(day(ts) AS INTEGER) AS time_day_of_month, "
            f"{R(G(16, f'regr_slope(close, rn) {W(17)}'), 5)} AS LINEARREG_SLOPE_17, CAST(eng AS DOUBLE) AS CDLENGULFING, "
            f"{R('CASE WHEN rn >= 16 THEN m - sg END', 3)} AS MACDHIST_7 FROM k2 {WINDOW}")


@reg("fp2_fp3_features_from_names", _fp2_sql())
def q_fp2(spark, sf):
    """FP2/FP3: exactly the features of a saved name list, in its order, pattern values raw as in the live path."""
    from barloom.plans import features as FP
    fr = FP.features_for_names(daily_frame(spark, sf), _FP2_NAMES, pattern_wma=None, dropna=False)
    names = FP.parse_feature_names(_FP2_NAMES)
    out = fr.df.select("symbol", "ts", *names).withColumn("time_day_of_month", F.col("time_day_of_month").cast("int"))
    out = out.withColumn("CDLENGULFING", F.col("CDLENGULFING").cast("double"))
    return finish(out, 6, {"LINEARREG_SLOPE_17": 5, "MACDHIST_7": 3})


@reg("snk1_snk5_save_and_reload", f"WITH {LAB_CTES} SELECT symbol, ts, {R('close', 4)} AS close, pos_change_signal, "
     f"{R('desired_pos_change', 6)} AS desired_pos_change, '0_close,' AS names FROM lab")
def q_snk(spark, sf):
    """SNK1/SNK5: X, y and feature names written under the checkpoint folder, and all read back."""
    from barloom.operators.cleanup import split_features_target
    from barloom.sources import sinks
    from barloom.streaming.bars import scratch
    lab = labelled_daily(spark, sf)
    X, y = split_features_target(lab.select("symbol", "ts", "close", "pos_change_signal", "desired_pos_change"))
    base = scratch(spark, "snk")
    sinks.save_xy(X, y, base, "2024-01-01")
    sinks.save_feature_names(spark, ["close"], f"{base}/names")
    text = sinks.feature_names_text([r["name"] for r in spark.read.parquet(f"{base}/names").orderBy("idx").collect()])
    back = spark.read.parquet(f"{base}/X").where("run_date = '2024-01-01'").join(spark.read.parquet(f"{base}/y"), ["symbol", "ts"])
    return finish(back.select("symbol", "ts", "close", "pos_change_signal", "desired_pos_change", F.lit(text).alias("names")), 6, {"close": 4})


_CV_TABLE = ("SELECT CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS candidate, o_orderpriority AS params, "
             "[avg(o_totalprice) FILTER (WHERE o_orderkey % 3 = 0) / 1e6, avg(o_totalprice) FILTER (WHERE o_orderkey % 3 = 1) / 1e6, "
             "avg(o_totalprice) FILTER (WHERE o_orderkey % 3 = 2) / 1e6] AS s FROM orders GROUP BY o_orderpriority")


@reg("cv7_snk2_result_table", f"WITH c AS ({_CV_TABLE}), m AS (SELECT *, (s[1] + s[2] + s[3]) / 3 AS m FROM c) "
     f"SELECT candidate, params, {R('m', 8)} AS mean_test_score, {R('sqrt((pow(s[1] - m, 2) + pow(s[2] - m, 2) + pow(s[3] - m, 2)) / 3)', 8)} AS std_test_score, "
     "CAST(rank() OVER (ORDER BY m DESC) AS INTEGER) AS rank_test_score FROM m")
def q_cv7(spark, sf):
    """CV7/SNK2: the result table of given split scores (three groups of orders as splits, one candidate per priority),
    saved and read back."""
    from pyspark.sql import Window
    from barloom.sources import sinks
    from barloom.streaming.bars import scratch
    o = TB.table(spark, sf, "orders")
    part = [(F.avg(F.when(F.col("o_orderkey") % 3 == i, F.col("o_totalprice"))) / 1e6) for i in range(3)]
    t = o.groupBy(F.col("o_orderpriority").alias("params")).agg(F.array(*part).alias("split_test_scores"))
    t = t.withColumn("candidate", (F.row_number().over(Window.orderBy("params")) - 1).cast("int"))  # one row per candidate
    path = scratch(spark, "cv")
    sinks.save_cv_results(LN.summarise_cv(t), path)
    return finish(spark.read.parquet(path).select("candidate", "params", "mean_test_score", "std_test_score", "rank_test_score"), 8)


@reg("snk3_run_summary", "SELECT o_orderstatus AS model, " + R("max(o_totalprice)", 4) + " AS best_score, CAST(count(*) AS VARCHAR) AS best_params "
     "FROM orders GROUP BY o_orderstatus")
def q_snk3(spark, sf):
    """SNK3: a run summary (best score and parameters per model; here per order status) saved and read back."""
    from barloom.sources import sinks
    from barloom.streaming.bars import scratch
    o = TB.table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("m"), F.count(F.lit(1)).alias("n"))
    path = scratch(spark, "summary")
    sinks.save_run_summary(spark, [(r["o_orderstatus"], float(r["m"]), str(r["n"])) for r in o.collect()], path)  # one row per model
    return finish(spark.read.parquet(path), 4)


@reg("snk4_model_save_load", f"WITH s AS (SELECT avg(p_retailprice) AS m, stddev_samp(p_retailprice) AS sd FROM part) "
     f"SELECT p_partkey, {R('(p_retailprice - m) / sd', 8)} AS scaled FROM part, s")
def q_snk4(spark, sf):
    """SNK4: a fitted pipeline saved, loaded and applied."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array
    from barloom.sources import sinks
    from barloom.streaming.bars import scratch
    p = TB.table(spark, sf, "part").select("p_partkey", "p_retailprice")
    model = Pipeline(stages=[VectorAssembler(inputCols=["p_retailprice"], outputCol="v"),
                             StandardScaler(inputCol="v", outputCol="s", withMean=True)]).fit(p)
    path = scratch(spark, "model")
    sinks.save_model(model, path)
    out = sinks.load_model(path).transform(p)
    return finish(out.select("p_partkey", vector_to_array("s")[0].alias("scaled")), 8)


# ------------------------------------------------------------- regressors and the other model forms
SPARK["ml1_decision_tree_regressor"] = _fit_predict("DecisionTree", "regression", maxDepth=5)
SPARK["ml2_random_forest_regressor"] = _fit_predict("RandomForest", "regression", numTrees=20, maxDepth=5)
SPARK["ml3_extra_trees_regressor"] = _fit_predict("ExtraTrees", "regression", numTrees=20, maxDepth=5)
SPARK["ml5_gradient_boosting_one_vs_rest"] = _fit_predict("GradientBoosting", multiclass=True, maxIter=3, maxDepth=2)


@reg("ml4_adaboost_regressor")
def q_ml4r(spark, sf):
    tr, te = _split(ml_table(spark, sf))
    models = LN.adaboost_regress_fit(tr, label="target_10_ret", n_rounds=5)
    return LN.adaboost_regress_predict(models, te).select("symbol", "ts", "prediction")
