"""Exact top-k search by inner product with a pivot-distance index.

Vectors are lifted to a sphere-like embedding in which a larger inner product is
a smaller distance: x' = (x, sqrt(M - |x|^2)) with M the largest squared norm and
q' = (q, 0), so |q' - x'|^2 = |q|^2 + M - 2 q.x.  Every x' is keyed by its nearest
pivot and its distance to it; sorted by that key the vectors form annuli (blocks
of ``block_rows`` rows with a distance interval around one pivot).  An annulus also
keeps its interval of distances to every other pivot.

Queries are worked on in blocks that are near each other.  A block first reads the
annuli at its own distance around its nearest pivots, which gives each query a k-th
best score and so a radius.  By the triangle inequality an annulus beyond that radius
around any pivot holds nothing better: a range join on (pivot, distance) finds the
annuli that the radius reaches around their own pivot, the other pivots' intervals
discard more, and only what is left is written down.  These are read in rounds, the
nearest first, each four times as many as before; the radius shrinks between rounds,
and the search ends when no annulus is left within it.  Scores are exact integers.

Pivots are fitted on a bounded sample (``sample`` rows); every row is indexed.
The bounds hold for any pivots, so the result is exact whatever the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import arrow_rows, drop_staged, grouped_batches, staged

#: Distance cells per pivot of the range join.
CELLS = 32


def grid_vector(embedding: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component as double; null if the vector takes no part."""
    ok = F.col(embedding).isNotNull() & F.forall(
        F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(ok, F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * scale).cast("double")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(sq, 0))


def fit_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first pivots of a sample; starts at the row farthest from its mean."""
    if not len(sample):
        return sample
    far = ((sample - sample.mean(0)) ** 2).sum(1)
    picked = []
    for _ in range(min(n, len(sample))):
        i = int(np.argmax(far))
        if picked and far[i] <= 0:
            break
        picked.append(i)
        d = ((sample - sample[i]) ** 2).sum(1)
        far = d if len(picked) == 1 else np.minimum(far, d)
    return sample[picked]


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.c_[x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))]


def _key_rows(pivots: np.ndarray, top: float | None):
    """(vec_id, v) to (pivot, dist, vec_id, v); ``top`` lifts candidates, None a query (last component 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1))
            d = _distance(np.c_[x, np.zeros(len(x))] if top is None else _lift(x, top), pivots)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(near.astype("int32")), pa.array(d[np.arange(len(d)), near]), b.column(0), b.column(1)],
                names=["pivot", "dist", "vec_id", "v"])

    return run


def _cut_annuli(block_rows: int, pivots: np.ndarray, top: float):
    """Sorted rows of one range to blocks of one pivot and at most ``block_rows`` rows, with their interval at each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped_batches(batches, "pivot"):
            for lo in range(0, len(t), block_rows):
                part = t.slice(lo, block_rows).combine_chunks()
                d = part.column("dist").to_numpy()
                ids = part.column("vec_id").to_numpy().astype("<i8")
                m = _matrix(part.column("v").combine_chunks()).astype("<f8")
                every = _distance(_lift(m, top), pivots)
                yield pa.RecordBatch.from_arrays(
                    [part.column("pivot").slice(0, 1).combine_chunks(), pa.array([d[0]]), pa.array([d[-1]]),
                     pa.array([every.min(0).tolist()]), pa.array([every.max(0).tolist()]),
                     pa.array([ids.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                    names=["pivot", "lo", "hi", "a_near", "a_far", "ids", "m"])

    return run


def _query_blocks(pivots: np.ndarray, block_queries: int):
    """Queries sorted by nearest pivot to blocks, with each pivot's distance interval."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            while b.num_rows:
                room = block_queries - sum(h.num_rows for h in held)
                held.append(b.slice(0, room))
                b = b.slice(min(room, b.num_rows))
                if sum(h.num_rows for h in held) == block_queries:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(batches):
            for part in t.to_batches():
                q = _matrix(part.column(part.schema.get_field_index("v"))).astype("<f8")
                ids = part.column(part.schema.get_field_index("vec_id")).to_numpy().astype("<i8")
                d = _distance(np.c_[q, np.zeros(len(q))], pivots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.tobytes()], pa.binary()), pa.array([q.tobytes()], pa.binary()),
                     pa.array([d.min(0).tolist()]), pa.array([d.max(0).tolist()]),
                     pa.array([float((q * q).sum(1).max())]), pa.array([ids.tolist()])],
                    names=["qids", "qm", "near", "far", "q_sq", "id_list"])

    return run


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products (int64 arithmetic where doubles could round)."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    return (q @ x.T).astype("int64") if bound < 2 ** 53 else q.astype("int64") @ x.T.astype("int64")


def _search(k: int):
    """Pairs of a query block and an annulus to each query's best rows in it.

    A row with a known k-th score (``floor``, in the order of ``qids``) returns
    only vectors that reach it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                qids, ids = np.frombuffer(r["qids"], "<i8"), np.frombuffer(r["ids"], "<i8")
                q = np.frombuffer(r["qm"], "<f8").reshape(len(qids), -1)
                x = np.frombuffer(r["m"], "<f8").reshape(len(ids), -1)
                floor = None if r["floor"] is None else np.array(r["floor"], "int64")
                for lo in range(0, len(qids), 256):
                    got = []
                    part = _scores(q[lo:lo + 256], x)
                    for i, row in enumerate(part):
                        ok = ids != qids[lo + i]
                        if floor is not None:
                            ok &= row >= floor[lo + i]
                        at = np.flatnonzero(ok)
                        if len(at) > 4 * k:
                            cut = np.partition(row[at], len(at) - k)[len(at) - k]
                            at = at[row[at] >= cut]
                        at = at[np.lexsort((ids[at], -row[at]))[:k]]
                        got.append((np.full(len(at), qids[lo + i]), ids[at], row[at]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*got)],
                                                     names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, n_pivots: int = 64, sample: int = 4096,
          block_rows: int = 512, block_queries: int = 128, first: int = 4, report: list | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` largest inner products.

    Both frames hold ``vec_id`` long and ``v`` array<double> of integers (null
    or empty: takes no part); other columns are ignored.  Only vectors of the query's
    dimension are candidates; every row with the query's own ``vec_id`` is left out.
    Ties go to the smaller ``vec_id``.  Every row counts: a candidate stored n times
    may hold n ranks, and a query id that occurs n times has one ranking over the
    scores of all its rows.  Fewer candidates than ``k`` give fewer rows; empty tables
    give none.  ``report`` receives (dimension, pairs of block and annulus read, all
    such pairs) per dimension.  The search runs here; the result is read from files.
    """
    spark = vectors.sparkSession
    usable = (F.size("v") > 0) & F.col("vec_id").isNotNull()
    rows = vectors.where(usable).select("vec_id", "v")
    asked = queries.where(usable).select("vec_id", "v")
    dims = rows.select(F.size("v").alias("dim")).distinct().join(asked.select(F.size("v").alias("dim")), "dim", "left_semi")
    out = None
    with arrow_rows(spark, 64):  # a row of the search holds two blocks
        for dim, in dims.orderBy("dim").collect():
            part = _top_k_dim(rows.where(F.size("v") == dim), asked.where(F.size("v") == dim), dim,
                              k, n_pivots, sample, block_rows, block_queries, first, report)
            out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return _best(out, k).select("query_id", "rank", "vec_id", "score")


def _best(some: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; equal rows each hold a rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return some.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _nearest_annuli(blocks: DataFrame, index: DataFrame, live: list[int], first: int) -> DataFrame:
    """qb, annulus: around each of a block's ``first`` nearest pivots, the annuli at and beyond its distance."""
    middle = F.transform("near", lambda x, i: F.struct(((x + F.col("far")[i]) / 2).alias("pos"), i.alias("pivot")))
    usable = F.filter(middle, lambda s: F.array_contains(F.array(*[F.lit(p) for p in live]), s["pivot"]))
    probes = (blocks.select("qb", F.explode(F.slice(F.array_sort(usable), 1, first)).alias("s"))
              .select("s.pivot", "s.pos", F.lit(None).cast("long").alias("annulus"), "qb"))
    marks = index.select("pivot", F.col("lo").alias("pos"), "annulus", F.lit(None).cast("long").alias("qb")).unionByName(probes)
    up = Window.partitionBy("pivot").orderBy("pos", F.col("qb").isNotNull(), "annulus", "qb")
    down = Window.partitionBy("pivot").orderBy(F.desc("pos"), F.col("qb").isNotNull().desc(), F.desc("annulus"), F.desc("qb"))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    met = marks.select("qb", F.last("annulus", True).over(up.rowsBetween(*so_far)).alias("below"),
                       F.last("annulus", True).over(down.rowsBetween(*so_far)).alias("above")).where("qb IS NOT NULL")
    return (met.select("qb", F.explode(F.array("below", "above")).alias("annulus"))
            .where("annulus IS NOT NULL").distinct())


def _within_radius(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """qb, annulus, gap: annuli that may hold a vector within a block's ``radius`` of one of its queries.

    A range join on (pivot, cell of the distance); a pair is met in the first cell
    that both sides have.  ``gap`` is the largest lower bound over all pivots.
    """
    rings = index.groupBy("pivot").agg(F.min("lo").alias("p_lo"), F.max("hi").alias("p_hi"))  # a row per pivot

    def cell(x: Column) -> Column:
        width = F.greatest((F.col("p_hi") - F.col("p_lo")) / CELLS, F.lit(1e-9))
        return F.least(F.greatest(F.floor((x - F.col("p_lo")) / width), F.lit(0)), F.lit(CELLS - 1)).cast("int")

    rims = (index.select("annulus", "pivot", "lo", "hi", "a_near", "a_far").join(F.broadcast(rings), "pivot")
            .withColumn("a_cell", cell(F.col("lo")))
            .withColumn("cell", F.explode(F.sequence(F.col("a_cell"), cell(F.col("hi"))))).drop("p_lo", "p_hi"))
    reach = (blocks.select("qb", "radius", "near", "far", F.posexplode(F.arrays_zip("near", "far")).alias("pivot", "d"))
             .withColumn("from", F.col("d.near") - F.col("radius")).withColumn("to", F.col("d.far") + F.col("radius"))
             .join(F.broadcast(rings), "pivot").where("to >= p_lo AND from <= p_hi")
             .withColumn("b_cell", cell(F.col("from")))
             .withColumn("cell", F.explode(F.sequence(F.col("b_cell"), cell(F.col("to"))))).drop("p_lo", "p_hi", "d"))
    bounds = F.transform(F.arrays_zip("a_near", "a_far", "near", "far"),
                         lambda z: F.greatest(z["a_near"] - z["far"], z["near"] - z["a_far"], F.lit(0.0)))
    met = reach.join(rims, ["pivot", "cell"]).where("cell = greatest(a_cell, b_cell) AND lo <= to AND hi >= from")
    return met.withColumn("gap", F.array_max(bounds)).where("gap <= radius").select("qb", "annulus", "gap")


def _top_k_dim(rows: DataFrame, asked: DataFrame, dim: int, k: int, n_pivots: int, sample: int,
               block_rows: int, block_queries: int, first: int, report: list | None) -> DataFrame:
    """query_id, vec_id, score: rows of one dimension, each query's ``k`` best among them."""
    spark = rows.sparkSession
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    top = rows.agg(F.max(square)).first()[0] or 0.0
    # the bounded sample: the rows with the smallest hashes, whatever the table's size
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").collect()
    pivots = fit_pivots(_lift(np.array([r[0] for r in picked], "float64").reshape(len(picked), dim), top), n_pivots)
    keyed = rows.mapInArrow(_key_rows(pivots, top), "pivot int, dist double, vec_id long, v array<double>")
    index = staged(
        keyed.repartitionByRange("pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id")
        .mapInArrow(_cut_annuli(block_rows, pivots, top),
                    "pivot int, lo double, hi double, a_near array<double>, a_far array<double>, ids binary, m binary")
        .withColumn("annulus", F.monotonically_increasing_id()), "annuli")
    near = (asked.mapInArrow(_key_rows(pivots, None), "pivot int, dist double, vec_id long, v array<double>")
            .repartitionByRange("pivot", "dist", "vec_id").sortWithinPartitions("pivot", "dist", "vec_id"))
    tasks = max(1, asked.count() // block_queries)  # a task has a block's queries at least
    blocks = staged(near.select("vec_id", "v").coalesce(tasks).mapInArrow(
        _query_blocks(pivots, block_queries),
        "qids binary, qm binary, near array<double>, far array<double>, q_sq double, id_list array<long>")
        .withColumn("qb", F.monotonically_increasing_id()), "queries")
    live = sorted(r["pivot"] for r in index.select("pivot").distinct().collect())  # at most n_pivots

    def search(pairs: DataFrame, floors: DataFrame | None) -> DataFrame:
        """Each query's best rows in the annuli of ``pairs``, those found before included."""
        floor = F.lit(None).cast("array<long>").alias("floor") if floors is None else F.col("floor")
        pairs = pairs.select("qb", "annulus") if floors is None else pairs.join(floors, "qb").select("qb", "annulus", "floor")
        both = (pairs.join(blocks.select("qb", "qids", "qm"), "qb").join(index.select("annulus", "ids", "m"), "annulus")
                .select("qids", "qm", "ids", "m", floor))
        return both.mapInArrow(_search(k), "query_id long, vec_id long, score long")

    def known(found: DataFrame) -> DataFrame:
        """qb, floor, radius: each query's k-th score so far in the order of its block, and how far a better row may be."""
        kth = found.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        least = F.coalesce("kth", F.lit(-(2 ** 62)).cast("long"))
        ids = blocks.select("qb", "q_sq", F.posexplode("id_list").alias("at", "query_id")).join(kth, "query_id", "left")
        # a row at distance g scores (|q|^2 + M - g^2) / 2 at most; a little slack covers rounding
        slack, eps = 1e-9 * (4 * top + 1) + 1, 1e-7 * (1 + top ** 0.5)
        square_radius = F.first("q_sq") + F.lit(float(top)) - 2 * (F.min(least) - F.lit(slack))
        return ids.groupBy("qb").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("at", least.alias("kth")))), lambda s: s["kth"]).alias("floor"),
            (F.sqrt(F.greatest(square_radius, F.lit(0.0))) + F.lit(eps)).alias("radius"))

    start = staged(_nearest_annuli(blocks, index, live, first), "start")
    found = staged(_best(search(start, None), k), "found")
    floors = staged(known(found), "floors")
    rest = (_within_radius(blocks.join(floors.select("qb", "radius"), "qb"), index).join(start, ["qb", "annulus"], "left_anti"))
    ring = Window.partitionBy("qb").orderBy("gap", "annulus")
    rest = staged(rest.withColumn("ring", F.row_number().over(ring)), "rest")
    read, done, size = start.count(), 0, 4 * first
    while True:
        left = rest.where(F.col("ring") > done).join(floors, "qb").where("gap <= radius").select("qb", "annulus", "ring")
        if left.isEmpty():
            break
        now = left.where(F.col("ring") <= done + size)
        read += now.count() if report is not None else 0
        more = search(now, floors.select("qb", "floor"))
        old = found, floors
        found = staged(_best(found.select("query_id", "vec_id", "score").unionByName(more), k), "found")
        floors = staged(known(found), "floors")
        for table in old:
            drop_staged(spark, table)
        done, size = done + size, 4 * size
    if report is not None:
        report.append((dim, read, blocks.count() * index.count()))
    for table in (start, rest, floors, blocks, index):
        drop_staged(spark, table)
    return found.select("query_id", "vec_id", "score")
