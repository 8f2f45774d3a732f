"""The bar frame: ordered series spread over many tasks.

Every indicator in this library is ordered (per ``key``, by ``order``).  A plain
``Window.partitionBy(key)`` puts a whole series into one task, which does not
scale when one symbol holds a large share of the rows.  A :class:`BarFrame`
therefore carries three helper columns:

``rn``    1-based row number within the key (dense, total order),
``blk``   ``(rn-1) div block`` — the unit of parallel work,
``sblk``  ``(rn-1) div scan_block`` — the unit of the block-wise scans.

Operator classes (see README):

* finite windows (depend on the last ``k`` rows): rows are copied into the next
  block(s) as a *halo*; windows run per ``(key, blk)``; halo copies are dropped.
* linear recurrences ``y_t = d_t * y_{t-1} + x_t`` (EMA, Wilder sums, cumulative
  sums, KAMA): an associative block scan — in-block window sums in the log
  domain, a carry fold over the small per-block table, and a join back.
* forward fill and running extrema: the same scan shape with ``last``/``max``.

How ``rn`` is found depends on the key sizes (see :func:`sequence`); the
windows and scans are the same either way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from typing import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import default_parallelism, reliable_checkpoint, shuffle_partitions

# Broadcast a per-block table only below this many bytes (rows from the frame's stats x columns).
BROADCAST_BYTES = 32 << 20
# Scan block: in-block weights exp(-S) must stay inside double range: |S| <= 600.
MAX_LOG_SPAN = 600.0
# Blocks whose carries are folded in one row; longer series fold groups of blocks first.
CARRY_GROUP = 1024


@dataclass(frozen=True)
class Stats:
    n_rows: int
    n_keys: int
    max_rows: int


@dataclass(frozen=True)
class BarFrame:
    df: DataFrame
    key: str = "symbol"
    order: tuple = ("ts",)
    block: int = 4096                 # rows per block (power of two)
    scan_block: int = 512             # rows per scan block (power of two, divides block)
    stats: Stats | None = None
    depth: int = 0                    # scan stages since the frame was last materialised
    reach: int = 0                    # earlier rows that all finite stages so far read together
    resume: bool = False              # rows flagged ``_old`` carry results of earlier scans, see :meth:`resumed`

    # ------------------------------------------------------------------ basics
    @property
    def columns(self) -> list[str]:
        return self.df.columns

    def with_df(self, df: DataFrame) -> "BarFrame":
        return replace(self, df=df)

    def select(self, *cols) -> DataFrame:
        return self.df.select(*cols)

    def data(self, drop_helpers: bool = True) -> DataFrame:
        """The frame as a plain DataFrame (helper columns removed)."""
        if not drop_helpers:
            return self.df
        return self.df.drop("blk", "sblk")

    def _small_join(self, big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
        """Join a per-block table back; broadcast only when its bytes are bounded
        (same rows either way)."""
        s = self.stats
        if s is not None:
            rows = s.n_rows // self.scan_block + s.n_keys + 1
            if rows * 16 * (len(small.columns) + 2) <= BROADCAST_BYTES:
                small = F.broadcast(small)
        return big.join(small, on=on, how=how)

    def _carries(self, tbl: DataFrame, fold: Callable, zero: Column, value: str) -> DataFrame:
        """(key, sblk, carry): the fold of ``value`` over all earlier blocks of a key.

        ``fold(acc, value)`` must be associative in the sense that folding a group's
        total equals folding its blocks.  A row holds at most ``CARRY_GROUP``
        blocks: groups are totalled first, their totals carried the same way, and
        each group's blocks start from its carry, so no task holds a long series.
        """
        key = self.key
        blocks = (self.stats.max_rows if self.stats else 1 << 62) // self.scan_block + 2

        def level(rows: DataFrame, idx: str, n_blocks: int) -> DataFrame:
            """rows (key, idx, v) to (key, idx, carry)."""
            many = n_blocks > CARRY_GROUP
            group = F.floor(F.col(idx) / CARRY_GROUP).cast("long") if many else F.lit(0).cast("long")
            packed = (rows.groupBy(key, group.alias("_g"))
                      .agg(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col("v").alias("v")))).alias("_b")))
            if many:
                total = F.aggregate("_b", zero, lambda acc, e: fold(acc, e["v"]))
                up = level(packed.select(key, "_g", total.alias("v")), "_g", -(-n_blocks // CARRY_GROUP) + 1)
                packed = packed.join(up.withColumnRenamed("carry", "_s"), [key, "_g"])
            else:
                packed = packed.withColumn("_s", zero)
            run = F.aggregate(
                "_b", F.struct(F.col("_s").alias("c"), F.slice(F.array(F.struct(F.lit(0).cast("long").alias("i"), F.col("_s").alias("c"))), 1, 0).alias("out")),
                lambda acc, e: F.struct(fold(acc["c"], e["v"]).alias("c"),
                                        F.concat(acc["out"], F.array(F.struct(e["i"].alias("i"), acc["c"].alias("c")))).alias("out")))
            return packed.select(key, F.explode(run["out"]).alias("o")).select(
                key, F.col("o.i").alias(idx), F.col("o.c").alias("carry"))

        return level(tbl.select(key, "sblk", F.col(value).alias("v")), "sblk", blocks)

    # ----------------------------------------------------------- finite windows
    def finite(self, steps: Sequence[tuple[str, Column]], halo: int, ahead: int = 0) -> "BarFrame":
        """Add window columns that need at most ``halo`` earlier (``ahead`` later) rows.

        ``steps`` are evaluated in order (later steps may use earlier ones) and
        must use :class:`Win` specs.  Exact: rows of neighbouring blocks are
        copied in as halo, so every window sees the rows it would see unblocked.
        """
        df = self.df
        L = self.block
        if halo > 0 or ahead > 0:
            r0 = F.col("rn") - F.lit(1)
            last_target = F.floor((r0 + F.lit(int(halo))) / F.lit(L)).cast("long")
            first_target = F.greatest(F.lit(0).cast("long"),
                                      F.floor((r0 - F.lit(int(ahead))) / F.lit(L)).cast("long"))
            ex = df.select("*", F.explode(F.sequence(first_target, last_target)).alias("_tb"))
        else:
            ex = df.withColumn("_tb", F.col("blk"))
        for level in _levels(steps):
            ex = ex.withColumns(level)
        if halo > 0 or ahead > 0:
            ex = ex.where(F.col("_tb") == F.col("blk"))
        # keep the (key, block) clustering visible to the planner: rename, do not recompute
        out = ex.drop("blk").withColumnRenamed("_tb", "blk")
        return replace(self, reach=self.reach + int(halo), df=out.select(*[c for c in df.columns], *[c for c in out.columns if c not in df.columns]))

    def add(self, *feats) -> "BarFrame":
        """Add finite features (objects with ``steps``, ``halo``, ``ahead``) in one stage."""
        steps, seen = [], set()
        halo = ahead = 0
        for f in feats:
            halo = max(halo, f.halo)
            ahead = max(ahead, getattr(f, "ahead", 0))
            for name, col in f.steps:
                if name in seen or name in self.df.columns:
                    continue
                seen.add(name)
                steps.append((name, col))
        return self.finite(steps, halo, ahead)

    def drop(self, *cols) -> "BarFrame":
        return self.with_df(self.df.drop(*cols))

    def with_columns(self, **cols) -> "BarFrame":
        return self.with_df(self.df.withColumns(cols))

    # ------------------------------------------------------------- linear scan
    def resumed(self) -> "BarFrame":
        """A frame that goes on where an earlier one ended.

        Rows flagged ``_old`` were seen before; ``_last_old`` flags the last of them per
        key.  Every scan keeps its result in a column ``_kept_<name>``; where the
        old rows bring that column, the scan starts from its value on the last old
        row and old rows keep theirs.  Finite windows need ``reach`` old rows."""
        return replace(self, resume=True)

    def _start_from_kept(self, df: DataFrame, out: str, x: Column, rest: Column) -> Column:
        kept = f"_kept_{out}"
        if not self.resume or kept not in df.columns:
            return x
        return F.when(F.col("_last_old"), F.col(kept)).when(F.col("_old"), rest).otherwise(x)

    def _keep(self, df: DataFrame, outs: list[str]) -> DataFrame:
        if not self.resume:
            return df
        have = [o for o in outs if f"_kept_{o}" in df.columns]
        df = df.withColumns({o: F.when(F.col("_old"), F.col(f"_kept_{o}")).otherwise(F.col(o)) for o in have})
        return df.withColumns({f"_kept_{o}": F.col(o) for o in outs})

    def _stage_input(self) -> DataFrame:
        """Input of a scan stage.  A stage reads its input twice (window pass and
        per-block table), so after an earlier stage the frame is written to the
        reliable checkpoint folder: plans and recomputation stay linear in the
        number of stages, and a lost executor re-reads instead of recomputing."""
        if self.depth >= 1:
            return reliable_checkpoint(self.df)
        return self.df

    def scan(self, out: str, x: Column, d, d_min: float | None = None, d_from: int | None = None) -> "BarFrame":
        """``out = y`` with ``y_t = d_t * y_{t-1} + x_t`` and ``y = 0`` before the first row.

        ``d`` is a float in [0, 1] or a Column in (0, 1] that never falls below
        ``d_min``.  With a float ``d`` and ``d_from``, ``d = 1`` for ``rn < d_from``
        (closed form, no extra pass).  NULL ``x`` counts as 0; the smoothers of
        :mod:`barloom.functions.recurrent` reject NULLs inside a series.
        """
        return self.scan_many([dict(out=out, x=x, d=d, d_min=d_min, d_from=d_from)])

    def scan_many(self, specs: list[dict]) -> "BarFrame":
        """Several independent scans (see :meth:`scan`) in one pass: one window
        node, one per-block aggregate, one carry fold and one join."""
        key, Ls = self.key, self.scan_block
        df = self._stage_input()
        run = Window.partitionBy(key, "blk", "sblk").orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        pos = (F.col("rn") - F.lit(1)) % F.lit(Ls)  # position inside the scan block
        # d = 0 keeps no memory: y is the input (before ``d_from`` at most the seed row is not 0)
        direct = {sp["out"]: F.coalesce(sp["x"].cast("double"), F.lit(0.0)) for sp in specs
                  if not isinstance(sp["d"], Column) and float(sp["d"]) == 0.0}
        specs = [sp for sp in specs if sp["out"] not in direct]
        if direct:
            df = df.withColumns(direct)
        if not specs:
            return replace(self, df=df)
        aggs, maps, finals, tmp = [], [], {}, []
        logs, log_windows, scaled, sums = {}, {}, {}, {}
        for i, sp in enumerate(specs):
            out, d, d_from = sp["out"], sp["d"], sp.get("d_from")
            const = not isinstance(d, Column)
            low = float(d) if const else sp.get("d_min")
            if low is None or low <= 0.0:
                raise ValueError("a varying d needs a d_min above 0")
            if Ls * abs(math.log(low)) > MAX_LOG_SPAN:
                raise ValueError(f"decay {low} too fast for scan block {Ls}")
            x = F.coalesce(self._start_from_kept(df, out, sp["x"].cast("double"), F.lit(0.0)), F.lit(0.0))
            S, xe, u, C = (f"_s{i}_{n}" for n in ("S", "xe", "u", "C"))
            tmp += [S, xe, u, C]
            if not const:
                log_windows[S] = F.sum(F.log(d.cast("double"))).over(run)
            elif d == 1.0:
                logs[S] = F.lit(0.0)
            elif d_from is not None and d_from > 1:
                first = F.greatest(F.col("rn") - pos, F.lit(int(d_from)).cast("long"))
                logs[S] = F.greatest(F.lit(0).cast("long"), F.col("rn") - first + 1).cast("double") * F.lit(math.log(d))
            else:
                logs[S] = (pos + F.lit(1)).cast("double") * F.lit(math.log(d))
            scaled[xe] = x * F.exp(-F.col(S))
            sums[u] = F.sum(F.col(xe)).over(run)
            # per scan block: its map of the carry, y_end = D * carry + B
            aggs += [F.sum(F.col(xe)).alias(f"_a{i}u"), F.min(F.col(S)).alias(f"_a{i}S")]
            D = F.exp(F.col(f"_a{i}S"))
            maps.append(F.struct((D * F.col(f"_a{i}u")).alias("b"), D.alias("d")))
            finals[out] = F.exp(F.col(S)) * (F.col(u) + F.coalesce(F.col(C), F.lit(0.0)))
        for phase in (logs, log_windows, scaled, sums):
            if phase:
                df = df.withColumns(phase)
        none = F.array(*[F.struct(F.lit(0.0).alias("b"), F.lit(1.0).alias("d")) for _ in specs])
        tbl = df.groupBy(key, "blk", "sblk").agg(*aggs).select(key, "sblk", F.array(*maps).alias("_v"))
        carry = self._carries(tbl, lambda acc, v: F.zip_with(acc, v, lambda p, q: F.struct(
            (p["b"] * q["d"] + q["b"]).alias("b"), (p["d"] * q["d"]).alias("d"))), none, "_v")
        tbl = carry.select(key, "sblk", *[F.col("carry")[i]["b"].alias(f"_s{i}_C") for i in range(len(specs))])
        df = self._small_join(df, tbl, [key, "sblk"]).withColumns(finals)
        return replace(self, df=self._keep(df.drop(*tmp), list(finals)), depth=self.depth + 1)

    def cumsum(self, out: str, x: Column) -> "BarFrame":
        """Running sum from the first row of the key (class C)."""
        return self.scan(out, x, 1.0)

    # ----------------------------------------------------- fill / running extrema
    def ffill(self, out: str, x: Column) -> "BarFrame":
        """Last non-null value of ``x`` up to each row (forward fill), block-wise."""
        return self._assoc_many([(out, x, "last")])

    def running(self, out: str, x: Column, how: str = "max") -> "BarFrame":
        """Running max/min of ``x`` from the first row of the key."""
        return self._assoc_many([(out, x, how)])

    def ffill_many(self, cols: dict) -> "BarFrame":
        """Several forward fills ({out: column}) in one pass."""
        return self._assoc_many([(o, x, "last") for o, x in cols.items()])

    def _assoc_many(self, specs) -> "BarFrame":
        """Running ``last`` (non-null), ``max`` or ``min``: in-block windows, and the carry of earlier blocks."""
        key = self.key
        df = self._stage_input()
        run = Window.partitionBy(key, "blk", "sblk").orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        merge = {"last": lambda old, new: F.coalesce(new, old), "max": lambda old, new: F.greatest(old, new),
                 "min": lambda old, new: F.least(old, new)}
        df = df.withColumns({f"_f{i}x": self._start_from_kept(df, out, x, F.lit(None)) for i, (out, x, _) in enumerate(specs)})
        inner, aggs, finals, tmp = {}, [], {}, []
        for i, (out, _, how) in enumerate(specs):
            xi, inn, c = f"_f{i}x", f"_f{i}in", f"_f{i}c"
            tmp += [xi, inn, c]
            if how == "last":
                inner[inn] = F.last(xi, ignorenulls=True).over(run)
                aggs.append(F.max_by(xi, F.when(F.col(xi).isNotNull(), F.col("rn"))).alias(f"_f{i}v"))
            elif how in ("max", "min"):
                agg = F.max if how == "max" else F.min
                inner[inn] = agg(xi).over(run)
                aggs.append(agg(xi).alias(f"_f{i}v"))
            else:
                raise ValueError(how)
            finals[out] = merge[how](F.col(c), F.col(inn))
        df = df.withColumns(inner)
        tbl = df.groupBy(key, "blk", "sblk").agg(*aggs)
        kinds = {f.name: f.dataType for f in tbl.schema}
        names = [f"_f{i}v" for i in range(len(specs))]
        tbl = tbl.select(key, "sblk", F.struct(*names).alias("_v"))
        none = F.struct(*[F.lit(None).cast(kinds[n]).alias(n) for n in names])
        carry = self._carries(tbl, lambda acc, v: F.struct(*[
            merge[how](acc[n], v[n]).alias(n) for n, (_, _, how) in zip(names, specs)]), none, "_v")
        tbl = carry.select(key, "sblk", *[F.col("carry")[n].alias(f"_f{i}c") for i, n in enumerate(names)])
        df = self._small_join(df, tbl, [key, "sblk"]).withColumns(finals)
        return replace(self, df=self._keep(df.drop(*tmp), list(finals)), depth=self.depth + 1)

    # ------------------------------------------------------------------ slicing
    def between(self, start=None, end=None) -> DataFrame:
        """Cut to [start, end] after the features were built; an ``end`` without a
        time of day keeps that whole day.  Scans that should not read all history
        are cut before, see :func:`barloom.sources.tables.read_range`."""
        return cut_range(self.df, self.order[0], start, end)


def cut_range(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows of [start, end]; a bare date as ``end`` keeps that whole day."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        last = F.lit(end).cast("timestamp_ntz")
        bare = isinstance(end, str) and len(end.strip()) <= 10
        df = df.where(F.col(ts) < last + F.expr("INTERVAL 1 DAY")) if bare else df.where(F.col(ts) <= last)
    return df


def _reads(col: Column) -> set[str]:
    """Names of the columns an expression reads (from its SQL text, which is never shortened)."""
    import re as _re
    return set(_re.findall(r"[A-Za-z_][A-Za-z0-9_]*", col._jc.node().sql() if hasattr(col, "_jc") else str(col)))


def _levels(steps):
    """Group ordered (name, Column) steps into batches for ``withColumns``; a new
    batch starts when a step refers to a column defined in the current batch.
    Keeps the plan shallow (one projection per batch, not per column)."""
    out, cur = [], {}
    for name, col in steps:
        if cur and not cur.keys().isdisjoint(_reads(col)):
            out.append(cur)
            cur = {}
        cur[name] = col
    if cur:
        out.append(cur)
    return out


# ---------------------------------------------------------------------- windows
class Win:
    """Window specs used by finite builders inside :meth:`BarFrame.finite`."""

    def __init__(self, key: str = "symbol", block: int = 4096):
        self.key = key
        self.block = block
        self.o = Window.partitionBy(key, "_tb").orderBy("rn")

    def w(self, n: int):
        """Frame of the last ``n`` rows including the current one."""
        return self.o.rowsBetween(-(int(n) - 1), Window.currentRow)

    def span(self, lo: int, hi: int):
        return self.o.rowsBetween(lo, hi)

    def lag(self, c, k: int = 1) -> Column:
        return F.lag(c, int(k)).over(self.o)

    def lead(self, c, k: int = 1) -> Column:
        return F.lead(c, int(k)).over(self.o)

    @property
    def pos(self) -> Column:
        """Row position relative to the target block start (small, for weights)."""
        return (F.col("rn") - F.col("_tb") * F.lit(self.block)).cast("double")


def win(frame_or_key, block: int = 4096) -> Win:
    if isinstance(frame_or_key, BarFrame):
        return Win(frame_or_key.key, frame_or_key.block)
    return Win(frame_or_key, block)


# ------------------------------------------------------------------- sequencing
def _pow2_floor(n: int) -> int:
    return 1 << (max(1, int(n)).bit_length() - 1)


def frame_stats(df: DataFrame, key: str) -> Stats:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    r = per_key.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.max("n").alias("m")).first()
    return Stats(int(r["n"] or 0), int(r["k"] or 0), int(r["m"] or 0))


def sequence(df: DataFrame, key: str = "symbol", order: Iterable[str] = ("ts",),
             block_rows: int = 4096, scan_rows: int = 512, rn_mode: str = "auto",
             partitions: int | None = None) -> BarFrame:
    """Number rows per key in ``order`` and attach block columns.

    Windows always run per ``(key, block)`` with a halo, so long series are
    spread over tasks and in-window positions stay small.  ``rn_mode`` picks how
    the row number itself is found:

    ``"window"`` — ``row_number`` per key (one task per key: for many short keys);
    ``"range"``  — range partitioning + per-partition offsets (no task holds a key);
    ``"auto"``   — ``"range"`` when one key holds more rows than a task should
    (``> n_rows / parallelism`` and ``> 4 * block_rows``).
    ``(key, *order)`` must be unique.
    """
    order = tuple(order)
    spark = df.sparkSession
    stats = frame_stats(df, key)
    par = default_parallelism(spark)
    if rn_mode == "auto":
        rn_mode = "range" if stats.max_rows > max(4 * block_rows, stats.n_rows // max(par, 1)) else "window"
    L = _pow2_floor(block_rows)
    Ls = min(_pow2_floor(scan_rows), L)

    if rn_mode == "window":
        o = Window.partitionBy(key).orderBy(*order)
        out = df.withColumn("rn", F.row_number().over(o).cast("long"))
    elif rn_mode == "range":
        # Row numbers without a single-task sort: range-partition by (key, order),
        # sort inside partitions, take a per-partition id, fix the layout by a
        # reliable checkpoint, then add per-(partition, key) offsets.
        P = partitions or max(shuffle_partitions(spark), par,
                              int(math.ceil(stats.n_rows / 2_000_000)))
        ranged = (df.repartitionByRange(P, key, *order)
                  .sortWithinPartitions(key, *order)
                  .withColumn("_mid", F.monotonically_increasing_id()))
        ranged = reliable_checkpoint(ranged)
        pid = F.shiftright(F.col("_mid"), 33)
        st = ranged.groupBy(pid.alias("_pid"), F.col(key)).agg(
            F.min("_mid").alias("_m0"), F.count(F.lit(1)).alias("_n"))
        wo = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        st = st.select(key, "_pid", "_m0", F.coalesce(F.sum("_n").over(wo), F.lit(0)).alias("_off"))
        # at most one row per (partition, key): P + n_keys rows
        small = st if (P + stats.n_keys) * 64 > BROADCAST_BYTES else F.broadcast(st)
        out = (ranged.withColumn("_pid", pid).join(small, [key, "_pid"])
               .withColumn("rn", (F.col("_mid") - F.col("_m0") + F.col("_off") + 1).cast("long"))
               .drop("_pid", "_mid", "_m0", "_off"))
    else:
        raise ValueError(rn_mode)
    out = out.withColumn("blk", F.floor((F.col("rn") - 1) / F.lit(L)).cast("long"))
    out = out.withColumn("sblk", F.floor((F.col("rn") - 1) / F.lit(Ls)).cast("long"))
    return BarFrame(out, key=key, order=order, block=L, scan_block=Ls, stats=stats)


def from_sequenced(df: DataFrame, key: str = "symbol", order=("ts",), block_rows: int = 4096,
                   scan_rows: int = 512, stats: Stats | None = None) -> BarFrame:
    """Wrap a DataFrame that already has a dense 1-based ``rn`` (e.g. a regular time grid)."""
    L = _pow2_floor(block_rows)
    Ls = min(_pow2_floor(scan_rows), L)
    out = df.withColumn("blk", F.floor((F.col("rn") - 1) / F.lit(L)).cast("long"))
    out = out.withColumn("sblk", F.floor((F.col("rn") - 1) / F.lit(Ls)).cast("long"))
    return BarFrame(out, key=key, order=tuple(order), block=L, scan_block=Ls, stats=stats)
