"""Selection, tuning, learning and evaluation (SEL1–SEL8, ML1–ML8, CV1–CV8, EV1–EV4).

Models are MLlib estimators (distributed fitting); folds, metrics and selection
statistics are DataFrame aggregates.  Substitutes where MLlib has no exact
counterpart are named in each docstring (extra trees, AdaBoost, multiclass
boosting).
"""

from __future__ import annotations

import itertools
import math
import random

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.finite import safe_corr
from barloom.operators.labels import small_table
from barloom.session import dealt_by_rows, default_parallelism, reliable_checkpoint

#: Rows of one task of an MLlib fit's passes.
FIT_ROWS = 100_000

# ------------------------------------------------------------------ ML1–ML7
MODEL_COMBOS = {
    "DecisionTree": (DecisionTreeClassifier, DecisionTreeRegressor),            # ML1
    "RandomForest": (RandomForestClassifier, RandomForestRegressor),            # ML2
    "ExtraTrees": (RandomForestClassifier, RandomForestRegressor),              # ML3 (nearest form)
    "GradientBoosting": (GBTClassifier, GBTRegressor),                           # ML5
}


def fit_rows(df: DataFrame) -> DataFrame:
    """The rows of a fit, dealt by their number over two tasks a core or more.  Not for bootstraps, which draw by partition."""
    return dealt_by_rows(df, FIT_ROWS, at_least=2 * default_parallelism(df.sparkSession))


def make_estimator(kind: str, task: str = "classification", features="features", label="label",
                   weight: str | None = None, seed: int = 42, **params):
    """An MLlib estimator for a reference model name.

    ExtraTrees → random forest without bootstrap, all features per split choice
    ``sqrt`` and few bins (MLlib has no randomised split thresholds).
    GradientBoosting for >2 classes → OneVsRest of binary GBT.
    GaussianNB → NaiveBayes(modelType='gaussian').  Linear/Logistic regression."""
    common = dict(featuresCol=features, labelCol=label)
    if kind == "GaussianNB":
        est = NaiveBayes(modelType="gaussian", **common)
    elif kind == "Linear":
        est = (LogisticRegression if task == "classification" else LinearRegression)(**common)
    elif kind == "ExtraTrees":
        cls = MODEL_COMBOS[kind][0 if task == "classification" else 1]
        est = cls(bootstrap=False, featureSubsetStrategy="sqrt", maxBins=8, seed=seed, **common)
    elif kind == "GradientBoosting" and task == "classification" and params.pop("multiclass", False):
        est = OneVsRest(classifier=GBTClassifier(seed=seed), **common)
    else:
        cls = MODEL_COMBOS[kind][0 if task == "classification" else 1]
        est = cls(seed=seed, **common)
    if weight and est.hasParam("weightCol"):
        est = est.setWeightCol(weight)
    for k, v in params.items():
        if est.hasParam(k):
            est.set(est.getParam(k), v)
    return est


def adaboost_fit(df: DataFrame, features="features", label="label", n_rounds: int = 10, max_depth: int = 1,
                 n_classes: int | None = None, seed: int = 42):
    """ML4: SAMME boosting with weighted MLlib decision trees (one distributed fit per round).

    The weights are written to the checkpoint folder after each round, so a round
    reads them instead of running all earlier models again.  Returns [(alpha, model)]."""
    k = n_classes or df.agg(F.countDistinct(label)).first()[0]
    cur = fit_rows(df).withColumn("_w", F.lit(1.0))
    models = []
    for i in range(n_rounds):
        m = DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="_w", maxDepth=max_depth, seed=seed,
                                   predictionCol=f"_p{i}", probabilityCol=f"_pp{i}", rawPredictionCol=f"_rp{i}").fit(cur)
        miss = F.col(f"_p{i}") != F.col(label)
        pred = m.transform(cur)
        e = pred.agg((F.sum(F.when(miss, F.col("_w")).otherwise(0.0)) / F.sum("_w")).alias("e")).first()["e"]
        err = min(max(e, 1e-10), 1 - 1e-10)
        alpha = math.log((1 - err) / err) + math.log(k - 1)
        models.append((alpha, m))
        if err >= 1 - 1.0 / k:
            break
        cur = reliable_checkpoint(pred.withColumn("_w", F.when(miss, F.col("_w") * math.exp(alpha)).otherwise(F.col("_w")))
                                  .drop(f"_p{i}", f"_pp{i}", f"_rp{i}"))
    return models


def _votes(models, df: DataFrame) -> DataFrame:
    """Every model's prediction as a column of its own (``_p0``, ``_p1``, …): no row is matched to another."""
    for i, (_, m) in enumerate(models):
        df = m.transform(df).drop(f"_pp{i}", f"_rp{i}")
    return df


def adaboost_predict(models, df: DataFrame, label_values: list[float], out="prediction") -> DataFrame:
    """The label with the largest sum of alphas (ties: the first of ``label_values``)."""
    score = {v: sum((F.when(F.col(f"_p{i}") == v, F.lit(a)).otherwise(0.0) for i, (a, _) in enumerate(models)), F.lit(0.0))
             for v in label_values}
    best = F.greatest(*score.values(), F.lit(-1.0))
    pick = F.coalesce(*[F.when(sc == best, F.lit(float(v))) for v, sc in score.items()])
    return _votes(models, df).withColumn(out, pick).drop(*[f"_p{i}" for i in range(len(models))])


def adaboost_regress_fit(df: DataFrame, features="features", label="label", n_rounds: int = 10, max_depth: int = 3, seed: int = 42):
    """ML4, regression: AdaBoost.R2 (linear loss) with weighted MLlib regression trees.  Returns [(log 1/beta, model)]."""
    cur, models = fit_rows(df).withColumn("_w", F.lit(1.0)), []
    for i in range(n_rounds):
        m = DecisionTreeRegressor(featuresCol=features, labelCol=label, weightCol="_w", maxDepth=max_depth, seed=seed,
                                  predictionCol=f"_p{i}").fit(cur)
        pred = m.transform(cur).withColumn("_e", F.abs(F.col(f"_p{i}") - F.col(label)))
        r = pred.agg(F.max("_e").alias("most"), F.sum(F.col("_e") * F.col("_w")).alias("e"), F.sum("_w").alias("w")).first()
        loss = r["e"] / (r["w"] * r["most"]) if r["most"] else 0.0
        if loss >= 0.5 and models:
            break
        beta = max(loss, 1e-10) / (1 - min(loss, 1 - 1e-10))
        models.append((math.log(1 / beta), m))
        if loss <= 0 or loss >= 0.5:
            break
        w = F.col("_w") * F.pow(F.lit(beta), 1 - F.col("_e") / r["most"])
        cur = reliable_checkpoint(pred.withColumn("_w", w).drop("_e", f"_p{i}"))
    return models


def adaboost_regress_predict(models, df: DataFrame, out="prediction") -> DataFrame:
    """The weighted median of the models' predictions."""
    half = 0.5 * sum(a for a, _ in models)
    sorted_ = F.array_sort(F.array(*[F.struct(F.col(f"_p{i}").alias("p"), F.lit(float(a)).alias("a")) for i, (a, _) in enumerate(models)]))
    pick = F.aggregate(sorted_, F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("p")), lambda acc, e: F.struct(
        (acc["s"] + e["a"]).alias("s"), F.when(acc["p"].isNull() & (acc["s"] + e["a"] >= half), e["p"]).otherwise(acc["p"]).alias("p")))
    return _votes(models, df).withColumn(out, pick["p"]).drop(*[f"_p{i}" for i in range(len(models))])


def class_sample_weights(df: DataFrame, cls: str, mapping: dict | None = None) -> DataFrame:
    """ML8: ``weight`` column from a class map (manual) or balanced counts."""
    from barloom.operators.aggregates import class_weights
    return class_weights(df, cls, "manual" if mapping else "balanced", mapping or {})


# -------------------------------------------------------------- CV1–CV3 folds
def fold_bounds(n_rows: int, n_splits: int = 5) -> list[tuple[int, int]]:
    """CV1: (last train row, last test row) of each expanding split: test size ⌊n/(k+1)⌋, the last split ends at n."""
    t = n_rows // (n_splits + 1)
    return [(n_rows - (n_splits - i) * t, n_rows - (n_splits - i - 1) * t) for i in range(n_splits)]


def time_series_folds(df: DataFrame, n_splits: int = 5, rn: str = "rn", n_rows: int | None = None) -> DataFrame:
    """CV1: ``fold`` = the split that tests the row (NULL for the rows before the first test part).
    A split trains on all rows before its test part, so one number per row says it all."""
    bounds = fold_bounds(n_rows or df.agg(F.max(rn)).first()[0], n_splits)
    fold = F.lit(None).cast("int")
    for i, (a, b) in enumerate(bounds):
        fold = F.when((F.col(rn) > a) & (F.col(rn) <= b), F.lit(i)).otherwise(fold)
    return df.withColumn("fold", fold.cast("int"))


def fold_table(df: DataFrame, n_splits: int = 5, rn: str = "rn", n_rows: int | None = None) -> DataFrame:
    """(fold, role, rows, first_rn, last_rn): counted once per fold, train parts as running sums over the folds."""
    parts = (time_series_folds(df, n_splits, rn, n_rows).groupBy(F.coalesce("fold", F.lit(-1)).alias("fold"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min(rn).alias("first_rn"), F.max(rn).alias("last_rn")))
    before = Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)  # one row per fold
    both = parts.select("fold", F.array(
        F.struct(F.lit("test").alias("role"), "rows", "first_rn", "last_rn"),
        F.struct(F.lit("train").alias("role"), F.sum("rows").over(before).alias("rows"), F.min("first_rn").over(before).alias("first_rn"),
                 F.max("last_rn").over(before).alias("last_rn"))).alias("e"))
    return both.where("fold >= 0").select("fold", F.explode("e").alias("e")).select("fold", "e.*").where("rows > 0")


def stratified_folds(df: DataFrame, cls: str, k: int = 5, order: str = "rn") -> DataFrame:
    """CV2: per class, rows in order are cut into k contiguous parts (sizes differ by ≤ 1).
    Positions come from the distributed numbering, so a large class is not one task."""
    from barloom.plans.frame import sequence
    fr = sequence(df, key=cls, order=(order,))
    n = df.groupBy(cls).agg(F.count(F.lit(1)).alias("_n"))   # one row per class
    out = fr.df.join(small_table(n), cls).withColumn("fold", F.floor((F.col("rn") - 1) * k / F.col("_n")).cast("int"))
    return out.drop("rn", "blk", "sblk", "_n")


def ordered_holdout(df: DataFrame, test_fraction: float = 0.2, rn: str = "rn", key: str | None = None) -> DataFrame:
    """CV3: last ⌈fraction·n⌉ rows (per key) are test, the rest train."""
    if key:
        n = df.groupBy(key).agg(F.max(rn).alias("_n"))   # one row per key
        d = df.join(small_table(n), key)
    else:
        d = df.withColumn("_n", F.lit(df.agg(F.max(rn)).first()[0]))
    cut = F.col("_n") - F.ceil(F.col("_n") * test_fraction)
    return d.withColumn("role", F.when(F.col(rn) > cut, "test").otherwise("train")).drop("_n")


# ---------------------------------------------------------- EV1, EV2, EV4
def accuracy_of(label="label", prediction="prediction") -> Column:
    """EV1 (classification) as an aggregate expression, e.g. per symbol."""
    return F.avg((F.col(label) == F.col(prediction)).cast("double"))


def r2_of(label="label", prediction="prediction") -> Column:
    """EV1 (regression), 1 − SS_res/SS_tot, as an aggregate expression; NULL for a constant label."""
    return 1 - F.try_divide(F.sum(F.pow(F.col(label) - F.col(prediction), 2)), F.var_pop(label) * F.count(F.lit(1)))


def accuracy(pred: DataFrame, label="label", prediction="prediction") -> float:
    """EV1 (classification)."""
    return pred.agg(accuracy_of(label, prediction)).first()[0]


def r2(pred: DataFrame, label="label", prediction="prediction") -> float:
    """EV1 (regression); NaN for a constant label."""
    value = pred.agg(r2_of(label, prediction)).first()[0]
    return float("nan") if value is None else value


def classification_report(pred: DataFrame, label="label", prediction="prediction") -> DataFrame:
    """EV2: per class precision, recall, F1 and support from one contingency aggregate."""
    c = pred.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    tp = c.where(F.col("l") == F.col("p")).select(F.col("l").alias("cls"), F.col("n").alias("tp"))
    sup = c.groupBy(F.col("l").alias("cls")).agg(F.sum("n").alias("support"))
    prd = c.groupBy(F.col("p").alias("cls")).agg(F.sum("n").alias("predicted"))
    t = sup.join(prd, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    return t.select("cls", prec.alias("precision"), rec.alias("recall"),
                    F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0).alias("f1"),
                    F.col("support").cast("long"))


def predict_with_proba(model, df: DataFrame, prob_col="probability") -> DataFrame:
    """EV4: prediction plus the probability of the predicted class."""
    out = model.transform(df)
    if prob_col in out.columns:
        arr = vector_to_array(F.col(prob_col))
        out = out.withColumn("proba", F.array_max(arr))
    return out


def permutation_importance(model, df: DataFrame, feature_cols: list[str], label="label", seed: int = 42,
                           assembler_out="features", key="rn") -> DataFrame:
    """EV3: accuracy drop when one feature is shuffled — the column is re-paired with
    another row by a seeded random order (a sort + join on position, no collect).
    ``key``: the column(s) that order all rows uniquely."""
    from barloom.plans.frame import sequence
    va = VectorAssembler(inputCols=feature_cols, outputCol=assembler_out)
    base = accuracy(model.transform(va.transform(df)), label)
    # one numbering in row order and one in a seeded random order serve all features
    orig = sequence(df.withColumn("_k", F.lit(0)), key="_k", order=(key,) if isinstance(key, str) else tuple(key)).df.drop("blk", "sblk", "_k")
    orig = reliable_checkpoint(orig)
    mixed = sequence(orig.select(F.lit(0).alias("_k"), *feature_cols, F.xxhash64(F.lit(seed), "rn").alias("_r"), F.col("rn").alias("_o")),
                     key="_k", order=("_r", "_o")).df.select("rn", *[F.col(c).alias(f"_x_{c}") for c in feature_cols])
    both = reliable_checkpoint(orig.join(mixed, "rn"))
    rows = []
    for c in feature_cols:
        acc = accuracy(model.transform(va.transform(both.withColumn(c, F.col(f"_x_{c}")))), label)
        rows.append((c, float(base - acc)))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


# ---------------------------------------------------------- CV4–CV8
def grid(param_grid: dict) -> list[dict]:
    keys = sorted(param_grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[param_grid[k] for k in keys])]


def random_candidates(param_grid: dict, n_iter: int = 100, seed: int = 42) -> list[dict]:
    """CV5: seeded sample (without replacement) of the grid."""
    g = grid(param_grid)
    rnd = random.Random(seed)
    return g if len(g) <= n_iter else rnd.sample(g, n_iter)


def cross_validate(make, df: DataFrame, n_splits: int, candidates: list[dict], label="label",
                   metric="accuracy", rn: str = "rn", n_rows: int | None = None) -> DataFrame:
    """CV4/CV7: fit each candidate on each expanding split's train rows, score on its test rows.

    The splits are ranges of the row number (:func:`fold_bounds`), so train and test
    rows are plain filters.  Returns the CV result table: candidate, params, split
    scores, mean, std, rank.  ``make(**params)`` builds the estimator."""
    import time as _t
    score = accuracy if metric == "accuracy" else r2
    bounds = fold_bounds(n_rows or df.agg(F.max(rn)).first()[0], n_splits)
    rows = []
    for ci, params in enumerate(candidates):
        scores, fit_t, score_t = [], [], []
        for last_train, last_test in bounds:
            t0 = _t.time()
            m = make(**params).fit(df.where(F.col(rn) <= last_train))
            t1 = _t.time()
            scores.append(score(m.transform(df.where((F.col(rn) > last_train) & (F.col(rn) <= last_test))), label))
            score_t.append(_t.time() - t1)
            fit_t.append(t1 - t0)
        rows.append((ci, str(params), float(sum(fit_t) / len(fit_t)), float(sum(score_t) / len(score_t)),
                     [float(s) for s in scores]))
    t = df.sparkSession.createDataFrame(rows, "candidate int, params string, mean_fit_time double, mean_score_time double, "
                                              "split_test_scores array<double>")
    return summarise_cv(t)


def cross_validate_folds(make, df: DataFrame, fold: str, candidates: list[dict], label="label", metric="accuracy",
                         parallelism: int = 4) -> DataFrame:
    """CV2 with CV4/CV5: each candidate is fitted on all folds of column ``fold`` but one and scored on that one.

    A row with a null fold trains always.  At most ``parallelism`` fits are submitted at a time, so small
    trials share the cluster and the driver holds a bounded number of models.  For forests of many draws see
    :func:`barloom.operators.extra_trees.search`, which grows all of them in the same passes."""
    from concurrent.futures import ThreadPoolExecutor

    score = accuracy if metric == "accuracy" else r2
    folds = sorted(r[0] for r in df.select(fold).distinct().collect() if r[0] is not None)

    def trial(job: tuple[int, int]) -> float:
        params, k = candidates[job[0]], folds[job[1]]
        model = make(**params).fit(df.where(F.col(fold).isNull() | (F.col(fold) != k)))
        return float(score(model.transform(df.where(F.col(fold) == k)), label))

    jobs = [(c, k) for c in range(len(candidates)) for k in range(len(folds))]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = dict(zip(jobs, pool.map(trial, jobs)))
    rows = [(c, str(p), [scores[c, k] for k in range(len(folds))]) for c, p in enumerate(candidates)]
    return summarise_cv(df.sparkSession.createDataFrame(rows, "candidate int, params string, split_test_scores array<double>"))


def summarise_cv(t: DataFrame) -> DataFrame:
    """CV7: mean, population standard deviation and rank (1 = best mean) of the split scores."""
    s = F.col("split_test_scores")
    t = t.withColumn("mean_test_score", F.aggregate(s, F.lit(0.0), lambda a, x: a + x) / F.size(s))
    t = t.withColumn("std_test_score", F.sqrt(F.aggregate(
        s, F.lit(0.0), lambda a, x: a + (x - F.col("mean_test_score")) * (x - F.col("mean_test_score"))) / F.size(s)))
    return t.withColumn("rank_test_score", F.rank().over(Window.orderBy(F.col("mean_test_score").desc())).cast("int"))


def successive_halving(make, df: DataFrame, n_splits: int, candidates: list[dict], label="label",
                       factor: int = 3, min_fraction: float = 1 / 9, seed: int = 42) -> DataFrame:
    """CV6: rounds on growing seeded row samples; each round keeps the best 1/factor."""
    cur, frac, rnd = list(candidates), min_fraction, 0
    result = None
    while cur:
        sample = df.sample(False, min(frac, 1.0), seed + rnd) if frac < 1 else df
        res = cross_validate(make, sample, n_splits, cur, label).withColumn("round", F.lit(rnd))
        result = res if result is None else result.unionByName(res)
        if len(cur) == 1 or frac >= 1:
            break
        keep = max(1, len(cur) // factor)
        best = [r["candidate"] for r in res.orderBy(F.col("mean_test_score").desc()).limit(keep).collect()]
        cur = [cur[i] for i in best]
        frac, rnd = frac * factor, rnd + 1
    return result


#: Depth beyond which MLlib grows no tree.
MLLIB_DEPTH = 30


def validation_curve(make, df, n_splits: int, param: str, values: list, label="label", parallelism: int = 4) -> DataFrame:
    """CV8: CV score for each value of one parameter, over expanding splits; at most ``parallelism`` fits at a time.

    ``maxDepth`` values over MLlib's limit take the score of that limit, which is the same model's as long as none
    of its trees reaches the limit; where one does, their score is null."""
    from concurrent.futures import ThreadPoolExecutor

    deepest = lambda m: max(t.depth for t in getattr(m, "trees", [m]))
    fitted = [min(v, MLLIB_DEPTH) if param == "maxDepth" else v for v in values]
    bounds = fold_bounds(df.agg(F.max("rn")).first()[0], n_splits)

    def trial(job) -> tuple[float, bool]:
        value, (last_train, last_test) = job
        m = make(**{param: value}).fit(df.where(F.col("rn") <= last_train))
        score = accuracy(m.transform(df.where((F.col("rn") > last_train) & (F.col("rn") <= last_test))), label)
        return float(score), param == "maxDepth" and deepest(m) >= MLLIB_DEPTH

    jobs = [(v, b) for v in dict.fromkeys(fitted) for b in bounds]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = dict(zip(jobs, pool.map(trial, jobs)))
    rows = [(i, str({param: v}), [scores[f, b][0] if v == f or not scores[f, b][1] else None for b in bounds])
            for i, (v, f) in enumerate(zip(values, fitted))]
    return summarise_cv(df.sparkSession.createDataFrame(rows, "candidate int, params string, split_test_scores array<double>"))


# ---------------------------------------------------------- SEL
def _pearson_per_candidate(df: DataFrame, target: str, candidates: dict, keys: list[str]) -> DataFrame:
    wide = df.groupBy(*keys).agg(F.array(*[
        F.struct(F.lit(ind).alias("indicator"), F.lit(p).alias("period"), safe_corr(F.col(target).cast("double"), F.col(c).cast("double")).alias("corr"))
        for (ind, p), c in candidates.items()]).alias("e"))  # one expression per column: rows are not copied
    return wide.select(*keys, F.explode("e").alias("e")).select(*keys, "e.*")


def rank_correlations(df: DataFrame, target: str, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys…, ``at``, ``corr``): Spearman correlation of each column (``at``: its place in ``columns``) with the target.

    Rows where either value is missing are left out for that column; equal values share their mean rank.  All
    columns, and the target beside each of them, are ranked in one distributed numbering: equal (value, target)
    pairs are counted first and the distinct values numbered with their counts, so neither a long column nor a
    frequent value is one task.  A column without spread, or with one row, has no correlation (null)."""
    from barloom.plans.frame import sequence
    keys = list(keys)
    each = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    pairs = (df.select(*keys, F.col(target).cast("double").alias("t"), F.explode(each).alias("e")).select(*keys, "e.at", "e.v", "t")
             .where("v IS NOT NULL AND t IS NOT NULL AND NOT isnan(v) AND NOT isnan(t)")
             .groupBy(*keys, "at", "v", "t").agg(F.count(F.lit(1)).alias("n")))
    group = F.to_json(F.struct(*keys, "at"), {"ignoreNullFields": "false"})
    pairs = reliable_checkpoint(pairs.select(*keys, "at", group.alias("g"), "v", "t", "n"))
    sides = F.array(*[F.struct(F.concat("g", F.lit(s)).alias("s"), F.col(s).alias("x")) for s in ("v", "t")])
    counts = pairs.select("n", F.explode(sides).alias("e")).groupBy("e.s", "e.x").agg(F.sum("n").alias("c"))
    ranks = sequence(counts, key="s", order=("x",)).cumsum("upto", F.col("c")).df.select("s", "x", (F.col("upto") - (F.col("c") - 1) / 2).alias("r"))
    for s in ("v", "t"):
        of = ranks.select(F.col("s").alias(f"_s{s}"), F.col("x").alias(f"_x{s}"), F.col("r").alias(f"r{s}"))
        pairs = pairs.join(of, (F.concat("g", F.lit(s)) == F.col(f"_s{s}")) & (F.col(s) == F.col(f"_x{s}"))).drop(f"_s{s}", f"_x{s}")
    sums = pairs.groupBy(*keys, "at").agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * a * b).alias(o) for o, a, b in (
        ("sx", F.col("rv"), F.lit(1.0)), ("sy", F.col("rt"), F.lit(1.0)), ("xx", F.col("rv"), F.col("rv")), ("yy", F.col("rt"), F.col("rt")),
        ("xy", F.col("rv"), F.col("rt")))])
    spread = (F.col("xx") - F.col("sx") * F.col("sx") / F.col("n")) * (F.col("yy") - F.col("sy") * F.col("sy") / F.col("n"))
    corr = F.when(spread > 1e-9, (F.col("xy") - F.col("sx") * F.col("sy") / F.col("n")) / F.sqrt(spread))
    return sums.select(*keys, "at", corr.alias("corr"))


def best_period_by_correlation(df: DataFrame, target: str, candidates: dict, ranges: list[tuple], key=None, method: str = "pearson") -> DataFrame:
    """SEL1: ``candidates`` = {(indicator, period): column}.  For each indicator and
    period range, the period with the largest absolute correlation with the target:
    ``method`` "pearson", or "rank" for Spearman's (:func:`rank_correlations`)."""
    keys = [key] if key else []
    if method == "pearson":
        c = _pearson_per_candidate(df, target, candidates, keys)
    elif method == "rank":
        names = F.array(*[F.struct(F.lit(ind).alias("indicator"), F.lit(p).alias("period")) for ind, p in candidates])
        c = rank_correlations(df, target, list(candidates.values()), keys).withColumn("e", names[F.col("at")]).select(*keys, "e.*", "corr")
    else:
        raise ValueError(method)
    rng = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi")) for a, b in ranges])
    c = c.select("*", F.explode(rng).alias("r")).where((F.col("period") >= F.col("r.lo")) & (F.col("period") < F.col("r.hi")))
    w = Window.partitionBy(*keys, "indicator", "r").orderBy(F.abs("corr").desc(), "period")
    return (c.withColumn("_k", F.row_number().over(w)).where("_k = 1")
            .select(*keys, "indicator", F.col("r.lo").alias("range_lo"), F.col("r.hi").alias("range_hi"), "period", "corr"))


def prune_correlated(df: DataFrame, cols: list[str], max_corr: float = 0.95) -> list[str]:
    """SEL2: the correlation matrix of the assembled columns (rows without NULLs; k² numbers),
    then a greedy walk in column order: drop a column correlated above the limit with
    one already kept.  A constant column correlates with nothing."""
    from pyspark.ml.stat import Correlation
    rows = df.select(*cols).na.drop("any")
    if len(cols) < 2 or rows.isEmpty():
        return list(cols)
    m = Correlation.corr(VectorAssembler(inputCols=cols, outputCol="_v").transform(rows).select("_v"), "_v").first()[0].toArray()
    kept: list[int] = []
    for i in range(len(cols)):
        if all(not abs(m[i][k]) > max_corr for k in kept):
            kept.append(i)
    return [cols[i] for i in kept]


def acf_top_lags(fr, x: str, step: int, top: int = 5):
    """SEL3: autocorrelation of ``x`` sampled every ``step`` rows; the ``top`` lags by
    |acf| after lag 0.  max lag = min(⌊10·log10 n⌋, n − 1).  The sampled series is
    numbered again (distributed), lags are window lags, sums are one aggregate."""
    from barloom.functions.finite import Feat
    from barloom.plans.frame import Win, sequence
    s = fr.df.where(((F.col("rn") - 1) % step) == 0).where(F.col(x).isNotNull()).select(fr.key, F.col(x).alias("_x"), "rn")
    sfr = sequence(s, key=fr.key, order=("rn",))
    n = sfr.stats.n_rows
    K = min(int(10 * math.log10(max(n, 1))), n - 1)
    mean = sfr.df.agg(F.avg("_x")).first()[0]
    w = Win(sfr.key, sfr.block)
    d = F.col("_x") - F.lit(mean)
    sfr = sfr.add(Feat([("_d", d)] + [(f"_p{k}", F.col("_d") * w.lag(F.col("_d"), k)) for k in range(1, K + 1)], K))
    r = sfr.df.agg(F.sum(F.col("_d") * F.col("_d")).alias("c0"), *[F.sum(f"_p{k}").alias(f"c{k}") for k in range(1, K + 1)]).first()
    acf = [(k, (r[f"c{k}"] or 0.0) / r["c0"]) for k in range(1, K + 1)]
    return sorted(acf, key=lambda t: (-abs(t[1]), t[0]))[:top]


def rfe_cv(df: DataFrame, feature_cols: list[str], label="label", step: int = 5, n_splits: int | None = None,
           seed: int = 42, num_trees: int = 20, min_features: int = 1):
    """SEL5: recursive elimination: fit a forest, drop the ``step`` least important
    features, score by CV, keep the best set."""
    best, best_score, cur = list(feature_cols), -1.0, list(feature_cols)
    while len(cur) >= min_features:
        va = VectorAssembler(inputCols=cur, outputCol="features")
        data = va.transform(df)
        def make(**p):
            return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=num_trees, seed=seed)
        cv = cross_validate(make, data, n_splits, [{}], label) if n_splits else None
        score = cv.first()["mean_test_score"] if cv is not None else 0.0
        if score > best_score:
            best, best_score = list(cur), score
        if len(cur) <= min_features:
            break
        m = make().fit(data)
        imp = m.featureImportances.toArray()
        order = sorted(range(len(cur)), key=lambda i: imp[i])
        drop = set(order[:min(step, len(cur) - min_features)])
        cur = [c for i, c in enumerate(cur) if i not in drop]
    return best, best_score


def select_by_importance(model, feature_cols: list[str], threshold: float | None = None, input_col="features",
                         output_col="selected"):
    """SEL6: keep features whose importance ≥ threshold (default: the mean) → VectorSlicer."""
    imp = model.featureImportances.toArray()
    th = threshold if threshold is not None else float(imp.mean())
    idx = [i for i, v in enumerate(imp) if v >= th]
    return VectorSlicer(inputCol=input_col, outputCol=output_col, indices=idx), [feature_cols[i] for i in idx]


def mutual_information(df: DataFrame, feature_cols: list[str], label: str, bins: int = 10) -> DataFrame:
    """SEL7: binned mutual information of each feature with the label (nats): equal-count
    bins of the rows in (value, label) order, a contingency aggregate, Σ p·ln(p/(p_x·p_y)).

    Distinct (feature, value, label) triples are counted first; one that spans
    several bins is divided among them by its ranks, so a value held by many rows
    is one row here."""
    from barloom.plans.frame import sequence
    st = df.select(F.col(label).alias("_y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in feature_cols])).alias("e"))
    counts = (st.where(F.col("e.v").isNotNull()).groupBy("e.feature", "e.v", "_y").agg(F.count(F.lit(1)).alias("_c")))
    fr = sequence(counts, key="feature", order=("v", "_y")).cumsum("_cum", F.col("_c"))
    total = counts.groupBy("feature").agg(F.sum("_c").alias("n"))  # one row per feature
    r = fr.df.join(F.broadcast(total), "feature").withColumn("_hi", F.round("_cum").cast("long"))
    r = r.withColumn("_lo", F.col("_hi") - F.col("_c"))  # ranks _lo .. _hi - 1
    first, last = F.floor(F.col("_lo") * bins / F.col("n")), F.floor((F.col("_hi") - 1) * bins / F.col("n"))
    r = r.withColumn("_b", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    part = (F.least(F.col("_hi"), F.ceil((F.col("_b") + 1) * F.col("n") / bins))
            - F.greatest(F.col("_lo"), F.ceil(F.col("_b") * F.col("n") / bins)))
    joint = r.groupBy("feature", "_b", "_y").agg(F.sum(part).alias("nxy"), F.first("n").alias("n"))  # bins x labels rows per feature
    joint = (joint.withColumn("nx", F.sum("nxy").over(Window.partitionBy("feature", "_b")))
             .withColumn("ny", F.sum("nxy").over(Window.partitionBy("feature", "_y"))))
    term = (F.col("nxy") / F.col("n")) * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return joint.groupBy("feature").agg(F.sum(term).alias("mutual_information"))


def select_k_best(df: DataFrame, feature_cols: list[str], label: str, k: int = 10, bins: int = 10) -> DataFrame:
    """SEL7: the ``k`` features with the largest mutual information: (feature, mutual_information, rank from 1).
    Scores equal to nine decimals are ordered by name; fewer than ``k`` features: all."""
    score = mutual_information(df, feature_cols, label, bins)   # one row per feature
    w = Window.orderBy(F.round("mutual_information", 9).desc(), "feature")
    return score.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pca_features(df: DataFrame, feature_cols: list[str], k: int = 10, out="pca"):
    """SEL8: centre and scale, then MLlib PCA with k components."""
    va = VectorAssembler(inputCols=feature_cols, outputCol="_raw")
    sc = StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True)
    p = PCA(k=k, inputCol="_std", outputCol=out)
    return Pipeline(stages=[va, sc, p]).fit(df)


def pca_components(model, feature_cols: list[str]) -> DataFrame:
    """component (from 1), feature, loading, explained_variance of a fitted :func:`pca_features`.

    A component's sign is arbitrary: its largest loading is made positive.
    """
    pca = model.stages[-1]
    load, share = pca.pc.toArray(), pca.explainedVariance.toArray()
    rows = []
    for c in range(load.shape[1]):
        v = load[:, c]
        v = v if v[abs(v).argmax()] > 0 else -v
        rows += [(c + 1, f, float(x), float(share[c])) for f, x in zip(feature_cols, v)]
    return SparkSession.getActiveSession().createDataFrame(rows, "component int, feature string, loading double, explained_variance double")


def label_indexer(col: str, out: str = "label"):
    return StringIndexer(inputCol=col, outputCol=out, handleInvalid="keep", stringOrderType="alphabetAsc")
