"""ML5: gradient boosting over histograms with one softmax for all classes.

Features are cut once into at most ``max_bins`` bins (quantiles from one mergeable
aggregate) and staged as bytes beside the rows' raw scores.  A round grows one
regression tree per class on the softmax gradients; a level of all classes' trees is one
pass: tasks walk their rows down the trees, add up (gradient, hessian, weight) per open
node, feature and bin, the arrays are summed per (class, node) and the best cut is chosen
there, so only one cut per open node reaches the driver.  Wide levels go in several passes
of ``PASS_CELLS`` numbers.  Scores are staged anew every ``STAGE_ROUNDS`` rounds, so a
pass walks a bounded number of trees and a lost executor reads files.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.extra_trees import _matrix, descend
from barloom.session import dealt_by_rows, reliable_checkpoint, shuffle_partitions

#: Histogram numbers of one pass in a task.
PASS_CELLS = 2_000_000
#: Rows of one task of a pass; a small table is not dealt over the session's shuffle partitions.
TASK_ROWS = 10_000
#: Rounds after which the raw scores are written again.
STAGE_ROUNDS = 10
MAX_DEPTH, MAX_CLASSES, MAX_BINS = 12, 200, 255
#: A leaf's least sum of hessians.
MIN_HESSIAN = 1e-3


@dataclass
class Tree:
    """Heap order: children of node i are 2i + 1 (x <= cut, or no value) and 2i + 2; ``bin`` is the cut's bin."""

    feature: np.ndarray
    cut: np.ndarray
    bin: np.ndarray
    value: np.ndarray

    @classmethod
    def leaf(cls, depth: int) -> "Tree":
        n = (1 << (depth + 1)) - 1
        return cls(np.full(n, -1, "int32"), np.zeros(n), np.zeros(n), np.zeros(n))


@dataclass
class Boosted:
    """A fitted model: start scores (log class shares), one tree per round and class, the loss before each round."""

    features: list[str]
    classes: list[float]
    depth: int
    start: np.ndarray
    rounds: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.start, (len(x), 1))
        for trees in self.rounds:
            for k, t in enumerate(trees):
                out[:, k] += t.value[descend(x, t.feature, t.cut, self.depth)]
        return out

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """``df`` with the likeliest class (ties: the smallest) and the classes' probabilities in the order of ``classes``."""
        names, model = list(df.columns), df.sparkSession.sparkContext.broadcast(self)  # rounds x classes small trees

        def run(batches):
            m = model.value
            for b in batches:
                p = softmax(m.scores(_matrix(b, m.features)))
                best = np.array(m.classes)[p.argmax(1)] if m.classes else np.full(len(p), np.nan)
                ends = pa.array(np.arange(len(p) + 1, dtype="int32") * p.shape[1])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(best, pa.float64()), pa.ListArray.from_arrays(ends, pa.array(p.ravel()))],
                                                 names=[*names, prediction, probability])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(run, f"{kinds}, `{prediction}` double, `{probability}` array<double>")


def softmax(s: np.ndarray) -> np.ndarray:
    if not s.shape[1]:
        return s
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def best_cut(h: np.ndarray, l2: float, min_leaf: float) -> tuple[int, int, float]:
    """(feature, bin, gain) of the best cut of a node from its (feature, bin, 3) sums; feature −1 if none gains.

    Cut j sends bins 0 .. j left; ties go to the smallest feature, then the smallest bin."""
    left = h.cumsum(1)[:, :-1]
    total = h.sum(1, keepdims=True)
    right = total - left

    def part(s):
        return s[..., 0] ** 2 / (s[..., 1] + l2 + 1e-300)

    gain = part(left) + part(right) - part(total)
    ok = (left[..., 2] >= min_leaf) & (right[..., 2] >= min_leaf) & (left[..., 1] >= MIN_HESSIAN) & (right[..., 1] >= MIN_HESSIAN)
    gain = np.where(ok, gain, -np.inf)
    if not gain.size:
        return -1, 0, 0.0
    top = float(gain.max())
    if not top > 1e-12:
        return -1, 0, 0.0
    # sums come in any order, so equal gains may differ in their last digits
    at = int(np.flatnonzero(gain.ravel() >= top - 1e-9 * abs(top))[0])
    return at // gain.shape[1], at % gain.shape[1], top


def bin_cuts(df: DataFrame, features: list[str], max_bins: int) -> list[np.ndarray]:
    """Per feature the ascending cuts between its bins: minus infinity (only missing values go left of it), then
    distinct quantiles below the largest value.

    ``percentile_approx`` merges sketches of a fixed size; with at most that many distinct values a column's
    cuts are values of its own at exact ranks."""
    qs = [i / max_bins for i in range(1, max_bins)]
    cols = [F.when(~F.isnan(f), F.col(f)) for f in features]
    r = df.agg(*[F.percentile_approx(c, qs, 100 * max_bins).alias(f"q{i}") for i, c in enumerate(cols)],
               *[F.max(c).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return [np.array([-np.inf, *sorted({q for q in r[f"q{i}"] or [] if q < r[f"m{i}"]})]) for i in range(len(features))]


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin j holds cuts[j - 1] < x <= cuts[j]; no value (or minus infinity) is bin 0."""
    out = np.zeros(x.shape, "uint8")
    for i, c in enumerate(cuts):
        out[:, i] = np.where(np.isnan(x[:, i]), 0, np.searchsorted(c, x[:, i], "left"))
    return out


def fit(df: DataFrame, features: list[str], label: str, rounds: int = 20, max_depth: int = 3, learning_rate: float = 0.1, l2: float = 0.0,
        min_leaf: float = 20.0, max_bins: int = MAX_BINS, weight: str | None = None) -> Boosted:
    """Fit on the rows of ``df`` with a label (rows without one are ignored).

    Class labels are numbers, at most ``MAX_CLASSES`` of them; a missing feature value lies below all others;
    weights must not be negative.  ``min_leaf`` bounds a leaf's weight from below.  One class, or a table without
    rows, gives a model of start scores alone.
    """
    if not 0 < max_depth <= MAX_DEPTH:
        raise ValueError(f"trees are 1 to {MAX_DEPTH} deep")
    if not 2 <= max_bins <= MAX_BINS:
        raise ValueError(f"2 to {MAX_BINS} bins")
    cols = [F.col(f).cast("double").alias(f) for f in features]
    rows = df.where(F.col(label).isNotNull()).select(*cols, F.col(label).cast("double").alias("_y"),
                                                     (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("_w"))
    shares = rows.groupBy("_y").agg(F.sum("_w").alias("w"), F.count(F.lit(1)).alias("n")).where("w > 0").limit(MAX_CLASSES + 1).collect()
    if len(shares) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    n_rows = sum(r["n"] for r in shares)
    shares = sorted((r["_y"], r["w"]) for r in shares)
    classes = [y for y, _ in shares]
    total = sum(w for _, w in shares)
    model = Boosted(list(features), classes, max_depth, np.log(np.array([w for _, w in shares]) / total) if shares else np.zeros(0))
    if len(classes) < 2 or not features:
        return model
    cuts = bin_cuts(rows, features, max_bins)
    start, known, n_f = model.start, np.array(classes), len(features)

    def first(batches):
        for b in batches:
            x, y, w = _matrix(b, features), *(b.column(n_f + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x, y, w = x[w > 0], y[w > 0], w[w > 0]
            yield _rows(_bins(x, cuts), np.searchsorted(known, y), w, np.tile(start, (len(x), 1)))

    data = reliable_checkpoint(dealt_by_rows(rows, TASK_ROWS, n_rows).mapInArrow(first, STAGED))
    fresh: list[list[Tree]] = []  # rounds that the staged scores do not hold yet
    for r in range(rounds):
        trees = [Tree.leaf(max_depth) for _ in classes]
        opened = [(k, 0) for k in range(len(classes))]
        for depth in range(max_depth):
            todo, opened = opened, []
            per = n_f * (max(map(len, cuts)) + 1) * 3
            while todo:
                n = max(1, PASS_CELLS // per)
                opened += _grow(data, cuts, fresh, trees, todo[:n], depth, max_depth, learning_rate, l2, min_leaf,
                                model.losses if depth == 0 and len(model.losses) == r else None)
                todo = todo[n:]
        model.rounds.append(trees)
        fresh.append(trees)
        if len(fresh) == STAGE_ROUNDS and r + 1 < rounds:
            data, fresh = _restage(data, fresh, max_depth), []
    return model


#: Staged rows: bins and raw scores as bytes, class number, weight.
STAGED = "bins binary, y int, w double, s binary"


def _rows(bins: np.ndarray, y: np.ndarray, w: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in bins], pa.binary()), pa.array(y, pa.int32()), pa.array(w, pa.float64()),
                                       pa.array([a.tobytes() for a in s], pa.binary())], names=["bins", "y", "w", "s"])


def _read(b: pa.RecordBatch, rounds: list[list[Tree]], depth: int):
    """Bins, class numbers, weights and scores of a batch, with the trees added that the scores lack."""
    n = b.num_rows
    bins = np.frombuffer(b"".join(b.column(0).to_pylist()), "u1").reshape(n, -1)
    s = np.frombuffer(b"".join(b.column(3).to_pylist())).reshape(n, -1).copy()
    for trees in rounds:
        for k, t in enumerate(trees):
            s[:, k] += t.value[descend(bins, t.feature, t.bin, depth)]
    return bins, b.column(1).to_numpy(), b.column(2).to_numpy(), s


def _restage(data: DataFrame, fresh: list[list[Tree]], depth: int) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows:
                yield _rows(*_read(b, fresh, depth))
    return reliable_checkpoint(data.mapInArrow(run, STAGED))


def _grow(data: DataFrame, cuts: list[np.ndarray], fresh: list[list[Tree]], trees: list[Tree], opened: list[tuple[int, int]], depth: int,
          max_depth: int, rate: float, l2: float, min_leaf: float, losses: list[float] | None) -> list[tuple[int, int]]:
    """Cut the open (class, node) pairs; returns their children.  ``losses``: takes the mean log loss, if given."""
    n_f, n_b = len(cuts), max(map(len, cuts)) + 1
    nodes: dict[int, list[int]] = {}
    for k, node in opened:
        nodes.setdefault(k, []).append(node)
    with_loss = losses is not None

    def count(batches):
        sums = {k: np.zeros(len(v) * n_f * n_b * 3) for k, v in nodes.items()}
        loss = np.zeros(2)
        for b in batches:
            if not b.num_rows:
                continue
            bins, y, w, s = _read(b, fresh, max_depth)
            p = softmax(s)
            if with_loss:
                loss += [-(w * np.log(np.maximum(p[np.arange(len(y)), y], 1e-300))).sum(), w.sum()]
            for k, own in nodes.items():
                slot = np.full(len(trees[k].feature), -1, "int64")
                slot[own] = np.arange(len(own))
                at = slot[descend(bins, trees[k].feature, trees[k].bin, depth)]
                here = np.flatnonzero(at >= 0)
                q = p[here, k]
                cell = ((at[here][:, None] * n_f + np.arange(n_f)) * n_b + bins[here]) * 3
                for c, v in enumerate(((q - (y[here] == k)) * w[here], q * (1 - q) * w[here], w[here])):
                    sums[k] += np.bincount((cell + c).ravel(), np.repeat(v, n_f), len(sums[k]))
        size = n_f * n_b * 3
        out = [(k, node, sums[k][i * size:(i + 1) * size].tobytes()) for k, own in nodes.items() for i, node in enumerate(own)
               if sums[k][i * size:(i + 1) * size].any()]
        if with_loss and loss[1]:
            out.append((-1, 0, loss.tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                              pa.array([o[2] for o in out], pa.binary())], names=["k", "node", "s"])

    def decide(batches):
        """Sum the arrays of one (class, node) after the other (rows come sorted) and choose its cut."""
        at, held = None, None
        for b in batches:
            for k, node, s in zip(*(c.to_pylist() for c in b.columns)):
                s = np.frombuffer(s)
                if (k, node) == at:
                    held += s
                    continue
                if at is not None:
                    yield decided(at, held)
                at, held = (k, node), s.copy()
        if at is not None:
            yield decided(at, held)

    def decided(at, s):
        k, node = at
        if k < 0:
            f, j, sides = -1, 0, np.r_[s[0], s[1], 0.0]
        else:
            h = s.reshape(n_f, n_b, 3)
            f, j, _ = best_cut(h, l2, min_leaf)
            g = max(f, 0)
            sides = np.r_[h[0].sum(0), h[g, :j + 1].sum(0)]
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([node], pa.int32()), pa.array([f], pa.int32()), pa.array([j], pa.int32()),
                                           pa.array([sides.tolist()], pa.list_(pa.float64()))], names=["k", "node", "f", "j", "sides"])

    tasks = min(len(opened), shuffle_partitions(data.sparkSession))
    found = (data.mapInArrow(count, "k int, node int, s binary").repartition(tasks, "k", "node").sortWithinPartitions("k", "node")
             .mapInArrow(decide, "k int, node int, f int, j int, sides array<double>").collect())  # one cut per open node
    children = []
    for r in found:
        if r["k"] < 0:
            losses.append(r["sides"][0] / r["sides"][1])
            continue
        t, node, s = trees[r["k"]], r["node"], np.array(r["sides"])
        t.value[node] = _leaf(s[:3], rate, l2)
        if r["f"] < 0:
            continue
        t.feature[node], t.bin[node], t.cut[node] = r["f"], r["j"], cuts[r["f"]][r["j"]]
        for side, part in ((1, s[3:]), (2, s[:3] - s[3:])):
            t.value[2 * node + side] = _leaf(part, rate, l2)
            children.append((r["k"], 2 * node + side))
    return sorted(children)


def _leaf(s: np.ndarray, rate: float, l2: float) -> float:
    return -rate * s[0] / (s[1] + l2) if s[1] + l2 > 0 else 0.0
