"""ML3, CV2, CV5: extremely randomised trees, grown level by level, many forests in the same passes.

At a node some features are drawn, each with one random cut inside the node's box (the
range that the cuts above leave of the feature); the best of them by impurity splits the node.
Draws are a function of (seed, tree, node), so a model does not depend on partitions.

A level of all trees is one pass: tasks walk their rows down every tree and add up the
statistics of the open nodes' drawn cuts (one array a tree and task), the arrays are summed by tree,
and only the chosen splits come back.  The trees of many candidates and folds are grown side by
side on one staged table: a tree that leaves fold j out gives its rows no weight, and nothing is
binned or read again per candidate.  A pass takes as many trees as fit ``PASS_CELLS`` numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import reliable_checkpoint

#: Statistics of all trees of one pass, in numbers; trees beyond go into further passes.
PASS_CELLS = 2_000_000
MAX_DEPTH, MAX_CLASSES = 14, 200
GAIN = 1e-12


@dataclass(frozen=True)
class Job:
    """One forest: its size and growth, and the fold it must not see (None: all rows)."""

    n_trees: int = 20
    max_depth: int = 5
    max_features: int | str = "sqrt"
    min_split: float = 2.0
    seed: int = 42
    fold_out: int | None = None


class Tree:
    """A binary tree in heap order: children of node i are 2i + 1 (x <= cut, or no value) and 2i + 2."""

    def __init__(self, depth: int, cells: int, lo: np.ndarray, hi: np.ndarray):
        n = (1 << (depth + 1)) - 1
        self.feature, self.cut = np.full(n, -1, "int32"), np.zeros(n)
        self.value = np.zeros((n, cells))
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {0: (lo, hi)}  # node: its box


def draws(seed: int, tree: int, node: int, lo: np.ndarray, hi: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``k`` features and a cut for each inside the node's box."""
    rng = np.random.default_rng([seed, tree, node])
    f = rng.permutation(len(lo))[:k]
    return f, lo[f] + rng.random(k) * (hi[f] - lo[f])


def descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, depth: int) -> np.ndarray:
    """Heap node that each row reaches (it stays where a node has no split)."""
    node, rows = np.zeros(len(x), "int64"), np.arange(len(x))
    for _ in range(depth):
        f = feature[node]
        right = x[rows, np.maximum(f, 0)] > cut[node]
        node = np.where(f < 0, node, 2 * node + 1 + right)
    return node


def impurity(s: np.ndarray, regression: bool) -> np.ndarray:
    """Weighted impurity from class weights (Gini) or (weight, sum, sum of squares)."""
    if regression:
        w = s[..., 0]
        return s[..., 2] - np.divide(s[..., 1] ** 2, w, out=np.zeros_like(w), where=w > 0)
    w = s.sum(-1)
    return w - np.divide((s ** 2).sum(-1), w, out=np.zeros_like(w), where=w > 0)


def weight_of(s: np.ndarray, regression: bool) -> np.ndarray:
    return s[..., 0] if regression else s.sum(-1)


def choose(s: np.ndarray, regression: bool, min_split: float) -> tuple[int, bool]:
    """The drawn cut with the largest gain from statistics (cut, side, cell); whether it splits the node."""
    total = s[0].sum(0)
    gain = impurity(total, regression) - impurity(s, regression).sum(-1)
    both = (weight_of(s, regression) > 0).all(-1)
    gain = np.where(both, gain, -np.inf)
    best = int(gain.argmax())
    enough = weight_of(total, regression) >= min_split
    return best, bool(enough and gain[best] > GAIN * max(float(impurity(total, regression)), 1e-300) and gain[best] > 0)


@dataclass
class Forest:
    """A fitted forest: per tree the heap arrays, and the label values of the cells."""

    job: Job
    features: list[str]
    classes: list | None  # None: regression
    trees: list[Tree] = field(default_factory=list)

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Mean class shares over the trees (rows, classes), or the mean prediction (rows, 1)."""
        out = 0.0
        for t in self.trees:
            v = t.value[descend(x, t.feature, t.cut, self.job.max_depth)]
            out = out + (v[:, 1:2] / np.maximum(v[:, :1], 1e-300) if self.classes is None else v / np.maximum(v.sum(1, keepdims=True), 1e-300))
        return out / max(len(self.trees), 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        v = self.votes(x)
        if self.classes is None:
            return v[:, 0]
        return np.array(self.classes, float)[v.argmax(1)] if self.classes else np.full(len(x), np.nan)

    def transform(self, df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
        """``df`` with the prediction and, for classes, the array of shares in the order of ``classes``."""
        names, shares = list(df.columns), self.classes is not None

        def run(batches):
            for b in batches:
                x = _matrix(b, self.features)
                v = self.votes(x)
                cols = [*b.columns, pa.array(self.predict(x))]
                if shares:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype="int32") * v.shape[1]), pa.array(v.ravel())))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, prediction, *([probability] if shares else [])])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        return df.mapInArrow(run, f"{kinds}, `{prediction}` double" + f", `{probability}` array<double>" * shares)


def _matrix(b: pa.RecordBatch, features: list[str]) -> np.ndarray:
    cols = [b.column(b.schema.get_field_index(f)).to_numpy(zero_copy_only=False).astype(float) for f in features]
    return np.column_stack(cols) if cols else np.empty((b.num_rows, 0))


def _n_drawn(job: Job, n_features: int) -> int:
    k = {"sqrt": int(np.sqrt(n_features)), "log2": int(np.log2(max(n_features, 1))), "all": n_features}.get(job.max_features, job.max_features)
    return min(max(int(k), 1), n_features)


def fit_many(df: DataFrame, features: list[str], label: str, jobs: list[Job], regression: bool = False, weight: str | None = None,
             fold: str | None = None) -> list[Forest]:
    """Grow the forests of all jobs on the rows of ``df`` with a label (rows without one are ignored).

    A missing feature value goes left; weights must not be negative.  Class labels are numbers,
    at most ``MAX_CLASSES`` of them; trees are at most ``MAX_DEPTH`` deep.  An empty table gives trees of one
    empty leaf, whose prediction is NaN.
    """
    if any(j.max_depth > MAX_DEPTH for j in jobs):
        raise ValueError(f"trees are at most {MAX_DEPTH} deep")
    cols = [F.col(f).cast("double").alias(f) for f in features]
    rows = reliable_checkpoint(df.where(F.col(label).isNotNull()).select(
        *cols, F.col(label).cast("double").alias("_y"), (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("_w"),
        (F.lit(-1) if fold is None else F.coalesce(F.col(fold), F.lit(-1))).cast("int").alias("_fold")))
    ends = rows.agg(*[g(F.when(~F.isnan(f), F.col(f))).alias(f"{n}{i}") for i, f in enumerate(features) for n, g in (("lo", F.min), ("hi", F.max))]).first()
    lo, hi = (np.array([ends[f"{n}{i}"] or 0.0 for i in range(len(features))], float) for n in ("lo", "hi"))
    classes = None
    if not regression:
        classes = sorted(r[0] for r in rows.select("_y").distinct().limit(MAX_CLASSES + 1).collect())
        if len(classes) > MAX_CLASSES:
            raise ValueError(f"more than {MAX_CLASSES} classes")
    cells = 3 if regression else max(len(classes), 1)
    forests = [Forest(j, features, classes, [Tree(j.max_depth, cells, lo, hi) for _ in range(j.n_trees)]) for j in jobs]
    for depth in range(max((j.max_depth for j in jobs), default=0)):
        todo = [(f, i) for f in forests if depth < f.job.max_depth for i, t in enumerate(f.trees) if t.open]
        while todo:
            size, n = 0, 0
            while n < len(todo) and (n == 0 or size <= PASS_CELLS):
                f, i = todo[n]
                size += len(f.trees[i].open) * _n_drawn(f.job, len(features)) * 2 * cells
                n += 1
            _grow(rows, features, classes, todo[:n], depth, cells)
            todo = todo[n:]
    return forests


def _grow(rows: DataFrame, features: list[str], classes: list | None, batch: list[tuple[Forest, int]], depth: int, cells: int) -> None:
    """One level of a batch of trees: draw, count, choose, split."""
    regression, plans = classes is None, []
    for f, i in batch:
        t, k = f.trees[i], _n_drawn(f.job, len(features))
        nodes = sorted(t.open)
        drawn = [draws(f.job.seed, i, node, *t.open[node], k) for node in nodes]
        slot = np.full(len(t.feature), -1, "int32")
        slot[nodes] = np.arange(len(nodes))
        plans.append((t.feature, t.cut, slot, np.array([d[0] for d in drawn]), np.array([d[1] for d in drawn]),
                      -2 if f.job.fold_out is None else f.job.fold_out))
    shared = rows.sparkSession.sparkContext.broadcast((plans, None if regression else np.array(classes, float)))

    def count(batches):
        todo, known = shared.value
        sums = [np.zeros(len(p[3]) * p[3].shape[1] * 2 * cells) for p in todo]
        for b in batches:
            x, y = _matrix(b, features), b.column(len(features)).to_numpy(zero_copy_only=False)
            w, out = (b.column(len(features) + i).to_numpy(zero_copy_only=False) for i in (1, 2))
            if regression:
                parts = [(0, w), (1, w * y), (2, w * y * y)]
            else:
                parts = [(np.searchsorted(known, y), w)]
            for s, (feature, cut, slot, drawn, cuts, fold) in zip(sums, todo):
                at = slot[descend(x, feature, cut, depth)]
                here = np.flatnonzero((at >= 0) & (out != fold))
                place = at[here]
                k = drawn.shape[1]
                right = x[here[:, None], drawn[place]] > cuts[place]
                cell = ((place[:, None] * k + np.arange(k)) * 2 + right) * cells
                for c, v in parts:
                    to = cell + (c if isinstance(c, int) else c[here][:, None])
                    s += np.bincount(to.ravel(), np.repeat(v[here], k), len(s))
        if any(s.any() for s in sums):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())],
                                             names=["tree", "s"])

    def total(batches):
        """Sum the arrays of one tree after the other (rows come sorted by tree)."""
        tree, held = None, None
        for b in batches:
            for t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                s = np.frombuffer(s)
                if t != tree:
                    if tree is not None:
                        yield decided(tree, held)
                    tree, held = t, s.copy()
                else:
                    held += s
        if tree is not None:
            yield decided(tree, held)

    settings = [f.job.min_split for f, _ in batch]

    def decided(tree, s):
        """Per open node: the chosen cut's place (-1: none), its two sides' statistics and the node's."""
        n, k = shared.value[0][tree][3].shape
        s = s.reshape(n, k, 2, cells)
        best, sides = np.full(n, -1, "int32"), np.zeros((n, 2, cells))
        for i in range(n):
            b, ok = choose(s[i], regression, settings[tree])
            best[i], sides[i] = b if ok else -1, s[i, b]
        return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([best.tobytes()]), pa.array([sides.tobytes()])],
                                          names=["tree", "best", "sides"])

    found = (rows.mapInArrow(count, "tree int, s binary").repartition("tree").sortWithinPartitions("tree")
             .mapInArrow(total, "tree int, best binary, sides binary").collect())  # a few numbers per open node
    by_tree = {r["tree"]: r for r in found}
    for n, ((f, i), plan) in enumerate(zip(batch, plans)):
        t, nodes = f.trees[i], sorted(f.trees[i].open)
        boxes, t.open = t.open, {}
        if n not in by_tree:
            continue
        best = np.frombuffer(by_tree[n]["best"], "int32")
        sides = np.frombuffer(by_tree[n]["sides"]).reshape(len(nodes), 2, cells)
        for j, node in enumerate(nodes):
            t.value[node] = sides[j].sum(0)
            if best[j] < 0:
                continue
            feature, cut = int(plan[3][j][best[j]]), float(plan[4][j][best[j]])
            t.feature[node], t.cut[node] = feature, cut
            for side in (0, 1):
                child, (lo, hi) = 2 * node + 1 + side, boxes[node]
                lo, hi = lo.copy(), hi.copy()
                (hi if side == 0 else lo)[feature] = cut
                t.value[child], t.open[child] = sides[j, side], (lo, hi)
    shared.destroy()


def fit(df: DataFrame, features: list[str], label: str, regression: bool = False, weight: str | None = None, **job) -> Forest:
    """ML3: one forest of extremely randomised trees."""
    return fit_many(df, features, label, [Job(**job)], regression, weight)[0]


def search(df: DataFrame, features: list[str], label: str, fold: str, candidates: list[dict], seed: int = 42) -> DataFrame:
    """CV2 with CV4/CV5: every candidate on every fold of column ``fold``, all forests grown and scored together.

    ``candidates`` hold the fields of :class:`Job`.  A row with a null fold trains always and is never scored.
    Returns the CV result table: candidate, params, split scores (accuracy), mean, std, rank.
    """
    from barloom.operators.learning import summarise_cv

    data = reliable_checkpoint(df.where(F.col(label).isNotNull()).select(
        *[F.col(f).cast("double").alias(f) for f in features], F.col(label).cast("double").alias("_label"), F.col(fold).cast("int").alias("_part")))
    folds = sorted(r[0] for r in data.select("_part").distinct().collect() if r[0] is not None)
    jobs = [Job(**{"seed": seed, **c}, fold_out=k) for c in candidates for k in folds]
    forests = data.sparkSession.sparkContext.broadcast(fit_many(data, features, "_label", jobs, fold="_part"))

    def score(batches):
        right, rows = np.zeros(len(jobs), "int64"), np.zeros(len(jobs), "int64")
        for b in batches:
            x, y = _matrix(b, features), b.column(len(features)).to_numpy(zero_copy_only=False)
            part = np.array(b.column(len(features) + 1).to_pylist(), float)
            for i, f in enumerate(forests.value):
                own = part == f.job.fold_out
                if own.any():
                    right[i] += int((f.predict(x[own]) == y[own]).sum())
                    rows[i] += int(own.sum())
        yield pa.RecordBatch.from_arrays([pa.array(range(len(jobs)), pa.int32()), pa.array(right), pa.array(rows)], names=["job", "right", "rows"])

    got = data.mapInArrow(score, "job int, right long, rows long").groupBy("job").agg(F.sum("right").alias("right"), F.sum("rows").alias("rows"))
    n = len(folds)
    names = F.array(*[F.lit(str(c)) for c in candidates])
    per = (got.select(F.floor(F.col("job") / n).cast("int").alias("candidate"), (F.col("job") % n).alias("k"),
                      (F.col("right") / F.col("rows")).alias("score"))
           .groupBy("candidate").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "score"))), lambda e: e["score"]).alias("split_test_scores")))
    return summarise_cv(per.select("candidate", names[F.col("candidate")].alias("params"), "split_test_scores"))
