"""Chained imputation, rank correlation, k best and the validation curve."""

import numpy as np
import pandas as pd
import pytest

from barloom.operators import learning as LN
from barloom.operators import tabular as TAB


def gappy(n=500, seed=2):
    """Any one column tells the others; each has gaps, c the most, and every row has a value."""
    rng = np.random.default_rng(seed)
    a = rng.uniform(-3, 3, n)
    full = pd.DataFrame({"a": a, "b": 2 * a + 1, "c": a ** 3})
    hole = np.column_stack([rng.random(n) < p for p in (0.05, 0.1, 0.25)])
    hole[hole.all(1)] = False
    holes = full.mask(hole)
    return full, holes


def test_chained_imputer_finds_a_dependence(spark):
    full, holes = gappy()
    df = spark.createDataFrame(holes.assign(i=range(len(holes)), _gap0="x", nothing=None).astype({"nothing": "float64"}))
    log = []
    out = TAB.iterative_impute(df, ["c", "a", "b", "nothing"], rounds=8, tol=0.05, max_depth=6, num_trees=10, log=log)
    assert out.columns == df.columns
    got = out.orderBy("i").toPandas()
    assert got["nothing"].isna().all() and (got["_gap0"] == "x").all()
    assert 2 <= len(log) < 8 and log[-1] < 0.05 <= log[-2]
    for c in "abc":
        gap = holes[c].isna()
        assert (got[c][~gap] == holes[c][~gap]).all()
        error = ((got[c] - full[c])[gap] ** 2).mean() ** 0.5
        blind = ((holes[c].mean() - full[c])[gap] ** 2).mean() ** 0.5
        assert error < 0.25 * blind, (c, error, blind)


def test_chained_imputer_odd_tables(spark):
    kinds = "a double, b double, k string"
    assert TAB.iterative_impute(spark.createDataFrame([], kinds), ["a", "b"]).collect() == []
    one = TAB.iterative_impute(spark.createDataFrame([(1.0, None, "x"), (None, None, "y"), (3.0, None, None)], kinds), ["a"]).collect()
    assert sorted(r["a"] for r in one) == [1.0, 2.0, 3.0]
    whole = [(1.0, 2.0, "x"), (1.0, 2.0, "x")]
    assert [tuple(r) for r in TAB.iterative_impute(spark.createDataFrame(whole, kinds), ["a", "b"]).collect()] == whole


def test_rank_correlation_equals_pandas(spark):
    rng = np.random.default_rng(4)
    n = 400
    pdf = pd.DataFrame({"k": rng.choice(["x", "y"], n), "t": rng.integers(0, 30, n).astype(float), "flat": 1.0})
    pdf["u"] = np.exp(pdf["t"] / 4) + rng.normal(0, 20, n)
    pdf["few"] = rng.integers(0, 3, n).astype(float)
    pdf.loc[pdf.index % 7 == 0, "u"] = np.nan
    pdf.loc[pdf.index % 11 == 0, "t"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    names = ["u", "few", "flat"]
    got = {(r["k"], names[r["at"]]): r["corr"] for r in LN.rank_correlations(df, "t", names, ["k"]).collect()}
    for k, part in pdf.groupby("k"):
        for c in names[:2]:
            both = part[["t", c]].dropna().rank()
            assert got[k, c] == pytest.approx(both["t"].corr(both[c]), abs=1e-12)
        assert got[k, "flat"] is None
    best = LN.best_period_by_correlation(df, "t", {("I", 5): "few", ("I", 6): "u"}, [(4, 10)], method="rank").collect()
    assert [(r["indicator"], r["period"]) for r in best] == [("I", 6)]
    assert LN.rank_correlations(df.limit(0), "t", names, ["k"]).collect() == []
    with pytest.raises(ValueError):
        LN.best_period_by_correlation(df, "t", {("I", 5): "few"}, [(4, 10)], method="other")


def test_k_best(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 600)
    pdf = pd.DataFrame({"noise": rng.normal(size=600), "all": y + rng.normal(0, 0.01, 600), "some": y + rng.normal(0, 1, 600), "y": y})
    best = LN.select_k_best(spark.createDataFrame(pdf), ["noise", "some", "all"], "y", 2)
    assert [(r["feature"], r["rank"]) for r in best.orderBy("rank").collect()] == [("all", 1), ("some", 2)]


def test_validation_curve_beyond_the_limit(spark, monkeypatch):
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(6)
    n = 240
    pdf = pd.DataFrame({"rn": range(1, n + 1), "x": rng.normal(size=n)})
    pdf["label"] = (pdf["x"] > 0).astype(float)
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.createDataFrame(pdf))
    make = lambda **p: LN.make_estimator("DecisionTree", "classification", **p)
    curve = {r["params"]: r for r in LN.validation_curve(make, df, 2, "maxDepth", [1, 31, 46]).collect()}
    assert curve["{'maxDepth': 46}"]["split_test_scores"] == curve["{'maxDepth': 31}"]["split_test_scores"]
    assert curve["{'maxDepth': 1}"]["mean_test_score"] > 0.9
    monkeypatch.setattr(LN, "MLLIB_DEPTH", 1)  # every tree reaches it
    curve = {r["params"]: r for r in LN.validation_curve(make, df, 2, "maxDepth", [1, 46]).collect()}
    assert curve["{'maxDepth': 1}"]["mean_test_score"] > 0.9
    assert curve["{'maxDepth': 46}"]["split_test_scores"] == [None, None] and curve["{'maxDepth': 46}"]["mean_test_score"] is None


def test_fits_are_dealt_by_rows(spark, monkeypatch):
    """A fit's passes have as many tasks as the train rows ask for, not the ML table's partitions; a bootstrap keeps its partitions."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.sql import functions as F
    from barloom.operators import learning as LN
    from barloom.plans import learning_queries as LQ
    rows = spark.range(1, 401).select(F.lit("A").alias("symbol"), F.col("id").alias("rn"), F.col("id").alias("ts"), (F.col("id") % 7).cast("double").alias("a"),
                                      (F.col("id") % 3).cast("double").alias("label"))
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows).repartition(30).cache()
    monkeypatch.setattr(LQ, "ml_table", lambda spark, sf: data)
    dealt, make = [], LN.make_estimator

    def spy(*a, **p):
        est = make(*a, **p)
        fit = est.fit
        est.fit = lambda df: dealt.append(df.rdd.getNumPartitions()) or fit(df)
        return est
    monkeypatch.setattr(LN, "make_estimator", spy)
    monkeypatch.setattr(LN, "default_parallelism", lambda spark: 1)
    for kind, more in (("GradientBoosting", dict(multiclass=True)), ("DecisionTree", {}), ("RandomForest", {})):
        assert LQ._fit_predict(kind, maxDepth=2, **more)(spark, "").count() == 140
    assert dealt == [2, 2, 30]
