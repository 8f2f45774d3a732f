"""Level-wise extra trees against a plain recursion with the same draws; folds and many candidates at once."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import extra_trees as ET
from barloom.operators import learning as LN


def table(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 4))
    x[rng.random((n, 4)) < 0.05] = np.nan
    y = (np.nan_to_num(x[:, 0]) + 0.5 * np.nan_to_num(x[:, 1]) > 0).astype(float) + (np.nan_to_num(x[:, 2]) > 1)
    return pd.DataFrame({**{f"f{i}": x[:, i] for i in range(4)}, "y": y, "z": np.round(np.nan_to_num(x[:, 0]) * 3 + rng.normal(0, 0.1, n), 2),
                         "w": rng.integers(1, 4, n).astype(float), "fold": rng.integers(0, 3, n)})


NAMES = [f"f{i}" for i in range(4)]


def brute(x, y, w, job, index, regression):
    """One tree by recursion over row sets: {node: (feature, cut)} and leaf statistics."""
    classes = sorted(set(y))
    tree = ET.Tree(job.max_depth, 3 if regression else len(classes), np.nanmin(x, 0), np.nanmax(x, 0))

    def stats(rows):
        if regression:
            return np.array([w[rows].sum(), (w * y)[rows].sum(), (w * y * y)[rows].sum()])
        return np.array([w[rows][y[rows] == c].sum() for c in classes])

    def grow(node, rows, lo, hi, depth):
        tree.value[node] = stats(rows)
        if depth == job.max_depth:
            return
        f, cuts = ET.draws(job.seed, index, node, lo, hi, ET._n_drawn(job, x.shape[1]))
        right = [rows[x[rows, a] > c] for a, c in zip(f, cuts)]
        left = [np.setdiff1d(rows, r) for r in right]
        s = np.array([[stats(a), stats(b)] for a, b in zip(left, right)])
        best, ok = ET.choose(s, regression, job.min_split)
        if ok:
            tree.feature[node], tree.cut[node] = f[best], cuts[best]
            for side, part in ((0, left[best]), (1, right[best])):
                a, b = lo.copy(), hi.copy()
                (b if side == 0 else a)[f[best]] = cuts[best]
                grow(2 * node + 1 + side, part, a, b, depth + 1)

    grow(0, np.arange(len(y)), np.nanmin(x, 0), np.nanmax(x, 0), 0)
    return tree


@pytest.mark.parametrize("regression", [False, True])
def test_trees_equal_recursion(spark, regression, monkeypatch):
    monkeypatch.setattr(ET, "PASS_CELLS", 100)  # several passes a level
    pdf, label = table(), "z" if regression else "y"
    job = ET.Job(n_trees=3, max_depth=4, max_features=2, min_split=5, seed=9)
    df = spark.createDataFrame(pdf).repartition(5)
    forest = ET.fit_many(df, NAMES, label, [job], regression, weight="w")[0]
    x, y, w = pdf[NAMES].to_numpy(), pdf[label].to_numpy(), pdf.w.to_numpy()
    want = [brute(x, y, w, job, i, regression) for i in range(3)]
    for t, b in zip(forest.trees, want):
        assert (t.feature == b.feature).all() and (t.feature >= 0).sum() > 3
        np.testing.assert_allclose(t.cut, b.cut, rtol=0, atol=0)
        np.testing.assert_allclose(t.value, b.value, rtol=1e-9, atol=1e-9)
    got = forest.transform(spark.createDataFrame(pdf)).toPandas()
    expect = ET.Forest(job, NAMES, None if regression else sorted(set(y)), want).predict(x)
    np.testing.assert_allclose(got.prediction, expect, rtol=1e-9)
    if not regression:
        assert got.probability.map(sum).to_numpy() == pytest.approx(np.ones(len(y)))


def test_large_forests_learn(spark):
    pdf = table(600)
    df, x = spark.createDataFrame(pdf), pdf[NAMES].to_numpy()
    z = ET.fit(df, NAMES, "z", regression=True, n_trees=20, max_depth=7, max_features="all").predict(x)
    assert 1 - ((z - pdf.z) ** 2).sum() / ((pdf.z - pdf.z.mean()) ** 2).sum() > 0.8
    y = ET.fit(df, NAMES, "y", n_trees=20, max_depth=7, max_features="all").predict(x)
    assert (y == pdf.y).mean() > 0.85


def test_search_over_folds_equals_single_fits(spark):
    pdf = table(300)
    df = spark.createDataFrame(pdf).repartition(3)
    candidates = [dict(n_trees=4, max_depth=d, max_features=m) for d in (1, 4) for m in (1, "all")]
    out = {r["candidate"]: r for r in ET.search(df, NAMES, "y", "fold", candidates, seed=5).collect()}
    assert sorted(out) == [0, 1, 2, 3] and sorted(r["rank_test_score"] for r in out.values())[0] == 1
    for c, params in enumerate(candidates):
        for k in range(3):
            alone = ET.fit(df.where(F.col("fold") != k), NAMES, "y", seed=5, **params)
            test = pdf[pdf.fold == k]
            # the box of the root comes from all rows in the search and from the train rows here: compare by score only
            assert abs(out[c]["split_test_scores"][k] - (alone.predict(test[NAMES].to_numpy()) == test.y).mean()) < 0.25
    # exactly: a job with a fold left out equals the same job with those rows at weight 0
    job = ET.Job(n_trees=2, max_depth=3, seed=5, fold_out=1)
    a = ET.fit_many(df, NAMES, "y", [job], fold="fold")[0]
    b = ET.fit_many(df.withColumn("v", F.when(F.col("fold") == 1, 0.0).otherwise(1.0)), NAMES, "y", [ET.Job(n_trees=2, max_depth=3, seed=5)], weight="v")[0]
    assert all((s.feature == t.feature).all() and (s.value == t.value).all() for s, t in zip(a.trees, b.trees))


def test_awkward_tables(spark):
    df = spark.createDataFrame(table(30))
    none = ET.fit(df.limit(0), NAMES, "y", n_trees=2)
    assert np.isnan(none.predict(np.zeros((2, 4)))).all() and none.transform(df).where("prediction is null or isnan(prediction)").count() == 30
    one = ET.fit(df.withColumn("y", F.lit(1.0)), NAMES, "y", n_trees=2)
    assert (one.predict(np.zeros((3, 4))) == 1.0).all() and all((t.feature < 0).all() for t in one.trees)
    with pytest.raises(ValueError, match="deep"):
        ET.fit(df, NAMES, "y", max_depth=40)


def test_mllib_search_over_folds(spark):
    pdf = table(300).fillna(0.0)
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=NAMES, outputCol="features").transform(spark.createDataFrame(pdf)).withColumn("label", F.col("y")).cache()
    def make(**p):
        return LN.make_estimator("DecisionTree", "classification", **p)
    out = LN.cross_validate_folds(make, df, "fold", LN.grid({"maxDepth": [1, 4]}), parallelism=3).orderBy("candidate").collect()
    assert [len(r["split_test_scores"]) for r in out] == [3, 3] and out[1]["mean_test_score"] > out[0]["mean_test_score"]
    m = make(maxDepth=4).fit(df.where("fold <> 2"))
    assert out[1]["split_test_scores"][2] == pytest.approx(LN.accuracy(m.transform(df.where("fold = 2"))))
    df.unpersist()
