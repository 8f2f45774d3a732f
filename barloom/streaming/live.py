"""Non-linear recurrences in a stream (ST2, ST6, FP4): cycle family, MAMA and SAR per symbol.

``live_loops`` is a keyed stateful operator (``transformWithStateInPandas``).  A symbol's
state holds the end states of the same kernels that the batch blocks run
(:mod:`barloom.operators.grouped`) and its last bars, so a micro-batch goes on where the
last one ended and no series is read again.  ``loop_state`` makes the initial state from a
history table with the batch path: one row per symbol, whatever the history's length.

The operator's columns go into a :class:`barloom.streaming.bars.FeatureStream` beside the bars; batch
builders take columns that are there instead of building them, so a feature list
with ``HT_``, MAMA or SAR names gives in a stream what it gives in batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barloom.operators.grouped import CYCLE, CYCLE_HALO, cycle_run, end_states, sar_run
from barloom.plans.frame import sequence
from barloom.streaming.bars import FeatureStream, event_time, state_store, wall_clock

PRICES = ("open", "high", "low", "close", "volume")
OUTPUTS = (*CYCLE, "SAR")
WARMUP = 512

_LONGS, _DOUBLES = T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())
#: Bars seen and late ones so far, the kernels' end states, and the last bars by column.
STATE = T.StructType([
    T.StructField("seen", T.LongType()), T.StructField("late", T.LongType()), T.StructField("cycle", _DOUBLES),
    T.StructField("sar", _DOUBLES), T.StructField("us", _LONGS), *[T.StructField(c, _DOUBLES) for c in PRICES]])


def _cycle_kernel(data: dict, first: int, start: int, state):
    return cycle_run(data["close"], first, start, state)


def _sar_kernel(data: dict, first: int, start: int, state):
    sar, end = sar_run(data["high"].tolist(), data["low"].tolist(), start, state)
    return {"SAR": sar}, end


class LiveLoops(StatefulProcessor):
    """The loops of one symbol, a micro-batch of bars at a time."""

    def __init__(self, key: str, kept: int):
        self.key, self.kept = key, max(kept, CYCLE_HALO)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("loops", STATE)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for r in initialState[[f.name for f in STATE]].itertuples(index=False):
            self.state.update(tuple(x.tolist() if isinstance(x, np.ndarray) else x for x in r))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [p for p in rows if len(p)]
        if not parts:  # a symbol that only the initial state has
            return
        seen, late, cycle, sar, us, *old = self.state.get() if self.state.exists() else (0, 0, None, None, [], *[[]] * len(PRICES))
        given = pd.concat(parts, ignore_index=True).sort_values("bar_us", kind="stable")
        last = us[-1] if us else -1 << 62
        new = given[(given["bar_us"] > last) & ~given["bar_us"].duplicated()]
        late += len(given) - len(new)
        n_old, n = len(us), len(new)
        data = {c: np.r_[np.array(o, float), new[c].to_numpy(float)] for c, o in zip(PRICES, old)}
        times = [*us, *new["bar_us"].tolist()]
        out = new[["bar_us", *PRICES]].copy()
        if n:
            got, cycle = cycle_run(data["close"], seen - n_old, n_old, cycle)
            sar_values, state = sar_run(data["high"].tolist(), data["low"].tolist(), n_old, sar)
            sar = None if seen + n < 2 else state  # the first direction needs two bars
            for c in CYCLE:
                out[c] = got[c]
            out["SAR"] = sar_values
        else:
            out = out.assign(**{c: pd.Series(dtype=float) for c in OUTPUTS})
        out.insert(0, self.key, [key[0]] * n)
        out["rn"] = np.arange(seen + 1, seen + n + 1, dtype="int64")
        out["late"] = late
        self.state.update((int(seen + n), int(late), _floats(cycle), _floats(sar), [int(x) for x in times[-self.kept:]],
                           *[_floats(data[c][-self.kept:]) for c in PRICES]))
        yield out


def _floats(values) -> list[float] | None:
    return None if values is None else [float(x) for x in values]


def loop_state(history: DataFrame, key: str = "symbol", ts: str = "ts", kept: int = CYCLE_HALO, block_rows: int = 4096) -> DataFrame:
    """ST6: the state of :func:`live_loops` after all bars of ``history``, one row per symbol.

    The kernels run block by block over tasks as in batch; only their end states and the last ``kept`` bars remain.
    """
    kept = max(kept, CYCLE_HALO)
    fr = sequence(history.select(key, ts, *PRICES), key=key, order=(ts,), block_rows=block_rows)
    cycle = end_states(fr, _cycle_kernel, ["close"], CYCLE, max(WARMUP, CYCLE_HALO))
    sar = end_states(fr, _sar_kernel, ["high", "low"], ["SAR"], WARMUP)
    rows = fr.df.withColumn("bar_us", F.unix_micros(event_time(F.col(ts))))
    count = rows.groupBy(key).agg(F.max("rn").alias("seen"))
    last = (rows.join(count, key).where(F.col("rn") > F.col("seen") - kept)
            .groupBy(key, "seen").agg(F.array_sort(F.collect_list(F.struct("rn", F.col("bar_us").alias("us"), *PRICES))).alias("b")))
    return (last.join(cycle.withColumnRenamed("end", "cycle"), key).join(sar.withColumnRenamed("end", "sar"), key)
            .select(key, "seen", F.lit(0).cast("long").alias("late"), "cycle",
                    F.when(F.col("seen") >= 2, F.col("sar")).alias("sar"), F.col("b.us").alias("us"),
                    *[F.transform(F.col(f"b.{c}"), lambda x: x.cast("double")).alias(c) for c in PRICES]))


def live_loops(bars: DataFrame, initial: DataFrame | None = None, key: str = "symbol", ts: str = "ts",
               kept: int = CYCLE_HALO) -> DataFrame:
    """Bars of a stream with the columns of the cycle family, MAMA, SAR, ``rn`` and ``late``.

    Bars must come in time order per symbol over micro-batches (closed windows do), in
    any order inside one.  A bar that is not later than the last one seen is dropped and counted in ``late``
    (the symbol's count so far).  ``initial`` is a :func:`loop_state`; it is used when the query starts on an
    empty checkpoint.  One micro-batch's bars of a symbol are in memory at a time.
    Columns are null before their lookback.  Needs :func:`state_store`.
    """
    kind = bars.schema[key].dataType.simpleString()
    doubles = "".join(f", {c} double" for c in (*PRICES, *OUTPUTS))
    src = bars.select(key, F.unix_micros(event_time(F.col(ts))).alias("bar_us"), *[F.col(c).cast("double").alias(c) for c in PRICES])
    out = src.groupBy(key).transformWithStateInPandas(
        LiveLoops(key, kept), outputStructType=f"`{key}` {kind}, bar_us long{doubles}, rn long, late long", outputMode="Append",
        timeMode="None", initialState=None if initial is None else initial.groupBy(key))
    return out.select(key, wall_clock(F.timestamp_micros("bar_us")).alias(ts), *PRICES,
                      *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in OUTPUTS], "rn", "late")


def named_features(bars: DataFrame, names: str, history: DataFrame | None = None, buffer: int = 600, model=None,
                   base: str | None = None, block_rows: int = 4096, pattern_wma: int | None = 300) -> FeatureStream:
    """FP4: the features of a saved name list (FP2) for every new bar of a stream, scored by ``model``.

    Lists with cycle names get them from :func:`live_loops`, all others from the batch builders on the buffered bars;
    ``history`` warms both up.  Runs what the stream offers (availableNow) and returns the
    :class:`FeatureStream`, whose ``out`` folder holds the rows; the same ``base`` goes on after a restart.
    """
    from barloom.plans.features import features_for_names, parse_feature_names, plan_for_names

    cyclic = bool(plan_for_names(parse_feature_names(names))["cycle"])
    fs = FeatureStream(bars.sparkSession, lambda fr: features_for_names(fr, names, pattern_wma=pattern_wma, dropna=False),
                       buffer=buffer, model=model, base=base, block_rows=block_rows, extra=OUTPUTS if cyclic else ())
    fresh = not fs.started()
    if fresh and history is not None:
        fs.seed(history)
    if cyclic:
        bars = live_loops(bars, None if history is None else loop_state(history, fs.key, fs.ts, block_rows=block_rows), fs.key, fs.ts)
    with state_store(bars.sparkSession):
        fs.run(bars)
    return fs
