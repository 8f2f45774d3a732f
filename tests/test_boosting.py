"""Softmax boosting against a plain loop over row sets."""

import numpy as np
import pandas as pd
import pytest

from barloom.operators import boosting as GB

NAMES = ["f0", "f1", "f2"]


def table(n=600, seed=5):
    rng = np.random.default_rng(seed)
    x = np.clip(np.round(2 * rng.normal(0, 1, (n, 3))) / 2, -2, 2)  # few and frequent values: every cut between two is a bin's
    x[rng.random((n, 3)) < 0.04] = np.nan
    z = np.nan_to_num(x)
    y = np.where(z[:, 0] + z[:, 1] > 0.7, 2.0, np.where(z[:, 1] * z[:, 2] > 0.2, 7.0, 1.0))
    return pd.DataFrame({**{f: x[:, i] for i, f in enumerate(NAMES)}, "y": y, "w": rng.integers(0, 4, n).astype(float)})


def brute(x, y, w, rounds, depth, rate, l2, min_leaf):
    """Scores of the training rows, and the loss before each round: every cut between two values is tried on row sets."""
    x, y, w = x[w > 0], y[w > 0], w[w > 0]
    x = np.where(np.isnan(x), -np.inf, x)
    classes = sorted(set(y))
    s = np.tile(np.log([w[y == c].sum() / w.sum() for c in classes]), (len(y), 1))
    losses = []
    for _ in range(rounds):
        p = np.exp(s) / np.exp(s).sum(1, keepdims=True)
        losses.append(-sum(a * np.log(b[classes.index(c)]) for a, b, c in zip(w, p, y)) / w.sum())
        step = np.zeros_like(s)
        for k, c in enumerate(classes):
            g, h = (p[:, k] - (y == c)) * w, p[:, k] * (1 - p[:, k]) * w

            def grow(rows, left):
                best = (1e-12, None)
                if left:
                    for f in range(x.shape[1]):
                        for cut in sorted(set(x[:, f]))[:-1]:
                            a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                            if min(w[a].sum(), w[b].sum()) < min_leaf or min(h[a].sum(), h[b].sum()) < GB.MIN_HESSIAN:
                                continue
                            gain = sum(g[r].sum() ** 2 / (h[r].sum() + l2) * i for r, i in ((a, 1), (b, 1), (rows, -1)))
                            if gain > best[0] + 1e-9 * abs(gain):
                                best = (gain, (a, b))
                if best[1] is None:
                    step[rows, k] = -rate * g[rows].sum() / (h[rows].sum() + l2)
                else:
                    for part in best[1]:
                        grow(part, left - 1)

            grow(np.arange(len(y)), depth)
        s = s + step
    return classes, np.exp(s) / np.exp(s).sum(1, keepdims=True), losses


@pytest.mark.parametrize("cells", [2_000_000, 500])
def test_equals_row_sets(spark, cells, monkeypatch):
    monkeypatch.setattr(GB, "PASS_CELLS", cells)  # several passes a level
    monkeypatch.setattr(GB, "STAGE_ROUNDS", 2)
    pdf = table()
    model = GB.fit(spark.createDataFrame(pdf).repartition(5), NAMES, "y", rounds=5, max_depth=2, learning_rate=0.3, l2=0.5, min_leaf=15,
                   weight="w")
    classes, p, losses = brute(pdf[NAMES].to_numpy(), pdf["y"].to_numpy(), pdf["w"].to_numpy(), 5, 2, 0.3, 0.5, 15)
    assert model.classes == classes
    assert np.allclose(model.losses, losses, atol=1e-10)
    assert losses == sorted(losses, reverse=True)
    kept = pdf[pdf["w"] > 0].reset_index(drop=True)
    got = model.transform(spark.createDataFrame(kept.reset_index(names="i"))).orderBy("i").toPandas()
    assert np.allclose(np.stack(got["probability"]), p, atol=1e-9)
    assert (got["prediction"] == np.array(classes)[p.argmax(1)]).all()


def test_odd_tables(spark):
    kinds = "a double, y double, prediction_ string"
    none = GB.fit(spark.createDataFrame([], kinds), ["a"], "y", rounds=2)
    assert none.classes == [] and none.rounds == []
    one = GB.fit(spark.createDataFrame([(1.0, 3.0, "x"), (2.0, None, "x"), (None, 3.0, None)], kinds), ["a"], "y", rounds=2)
    r = one.transform(spark.createDataFrame([(None, None, "x")], kinds)).first()
    assert (r["prediction"], r["probability"], r["prediction_"]) == (3.0, [1.0], "x")
    rows = [(float(i % 2) if i % 3 else None, float(i % 2), None) for i in range(200)]
    two = GB.fit(spark.createDataFrame(rows, kinds), ["a"], "y", rounds=3, learning_rate=0.5)
    assert two.losses[0] > two.losses[-1]
    flat = GB.fit(spark.createDataFrame([(None, float(i % 2), None) for i in range(50)], kinds), ["a"], "y", rounds=2)
    assert flat.transform(spark.createDataFrame([(5.0, None, None)], kinds)).first()["probability"] == pytest.approx([0.5, 0.5])
    with pytest.raises(ValueError):
        GB.fit(spark.createDataFrame(rows, kinds), ["a"], "y", max_depth=99)


def test_passes_are_dealt_by_rows(spark, monkeypatch):
    """The tasks of a pass follow the table's rows, not how it came or the session's shuffle partitions; the model stays."""
    pdf = table()
    kept, dealt = GB.reliable_checkpoint, []
    monkeypatch.setattr(GB, "reliable_checkpoint", lambda df: dealt.append(df.rdd.getNumPartitions()) or kept(df))
    few = GB.fit(spark.createDataFrame(pdf).repartition(40), NAMES, "y", rounds=2, max_depth=2, weight="w")
    assert dealt == [1]
    monkeypatch.setattr(GB, "TASK_ROWS", 150)
    many = GB.fit(spark.createDataFrame(pdf).repartition(40), NAMES, "y", rounds=2, max_depth=2, weight="w")
    assert dealt == [1, 4]
    x = pdf[NAMES].to_numpy()
    assert np.allclose(few.losses, many.losses) and np.allclose(few.scores(x), many.scores(x))
