"""Non-linear recurrences (class N): parabolic SAR (W13), the Hilbert-transform
cycle family (W14, W48–W52), MAMA/FAMA (W8) and path-dependent exits (SIG4).

These have no associative form, so a small loop runs per (key, block); a task
never holds a series.  They are exact at any length: a block's loop takes the
state before its first row and returns the state after its last.  Every block
first runs from a guess (the state a loop reaches over ``warmup`` earlier rows);
then each block's end state is compared with the next block's start state, and only
the blocks that differ run again from the right state, until none does
(:func:`run_blocks`).  The guess is right almost everywhere, so there are few
rounds; in the worst case (a position held over many blocks) the right state
moves on by one block a round.

States are compared to a relative 1e-12, which only matters for the cycle family:
its start is forgotten geometrically, so equal paths may keep differing in the last bits.
"""

from __future__ import annotations

import math
from typing import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.plans.frame import BarFrame
from barloom.session import reliable_checkpoint

# A kernel: (columns, index of the series' first row relative to row 0, first own row, state or None)
# -> (outputs from the first own row on, state after the last row).  None: the series starts here.
Kernel = Callable[[dict, int, int, "list[float] | None"], "tuple[dict, list[float]]"]


# ------------------------------------------------------------------ kernels
def sar_run(high, low, start: int, state, accel: float = 0.02, maximum: float = 0.2):
    """Wilder parabolic SAR from row ``start``; state (long?, next SAR, extreme, factor).
    At a series start the first direction comes from −DM against +DM at the second row."""
    n = len(high)
    out = np.full(n - start, np.nan)
    t0 = start
    if state is None:
        if n < 2:
            return out, [math.nan] * 4
        up, dn = high[1] - high[0], low[0] - low[1]
        is_long = not (dn > up and dn > 0)
        ep, sar, af, t0 = (high[1], low[0], accel, 1) if is_long else (low[1], high[0], accel, 1)
    else:
        is_long, sar, ep, af = state[0] > 0, state[1], state[2], state[3]
    for t in range(t0, n):
        hp, lp, h, lo = high[t - 1], low[t - 1], high[t], low[t]
        turned = lo <= sar if is_long else h >= sar
        if turned:
            is_long = not is_long
            sar = min(ep, lp, lo) if is_long else max(ep, hp, h)
            af, ep = accel, (h if is_long else lo)
        elif is_long and h > ep or not is_long and lo < ep:
            ep = h if is_long else lo
            af = min(af + accel, maximum)
        out[t - start] = sar
        sar = sar + af * (ep - sar)
        sar = min(sar, lp, lo) if is_long else max(sar, hp, h)
    return out, [float(is_long), sar, ep, af]


def sar_kernel(high, low, accel: float = 0.02, maximum: float = 0.2) -> np.ndarray:
    """SAR of a whole series."""
    return sar_run(list(high), list(low), 0, None, accel, maximum)[0]


CYCLE = ["HT_DCPERIOD", "HT_DCPHASE", "HT_PHASOR_inphase", "HT_PHASOR_quadrature", "HT_SINE_sine",
         "HT_SINE_leadsine", "HT_TRENDMODE", "HT_TRENDLINE", "MAMA_mama", "MAMA_fama"]
CYCLE_HALO = 64  # earlier prices the loop reads: 50 for a cycle, 3 for their smoothing, 6 for the filters
_ANGLES = [np.radians(360.0 * np.arange(n) / n) if n else np.zeros(0) for n in range(52)]
_SIN, _COS = [np.sin(a) for a in _ANGLES], [np.cos(a) for a in _ANGLES]


def cycle_run(price: np.ndarray, first: int, start: int, state, fast: float = 0.5, slow: float = 0.05):
    """Hilbert-transform cycle measures (Ehlers) and MESA adaptive averages from row ``start``.

    ``first``: rows of the series before row 0.  State: six values each of the detrender, quadrature and
    in-phase parts, three instantaneous trends, the smoothed products, period, phase, trend days, averages.
    """
    n = len(price)
    s = np.zeros(n)
    s[3:] = (4 * price[3:] + 3 * price[2:-1] + 2 * price[1:-2] + price[:-3]) / 10.0
    pad = 6
    hist = [[0.0] * pad, [0.0] * pad, [0.0] * pad, [0.0] * 3] if state is None else [
        list(state[0:6]), list(state[6:12]), list(state[12:18]), list(state[18:21])]
    de, q1, i1, trend_price = hist
    (i2, q2, re, im, per, sp, prev_phase, prev_sine, prev_lead, days, mama, fama, prev_angle) = (
        [0.0] * 13 if state is None else state[21:34])
    out = {k: np.full(n - start, np.nan) for k in CYCLE}

    def hilbert(a, b, c, d, adj):
        return (0.0962 * a + 0.5769 * b - 0.5769 * c - 0.0962 * d) * adj

    for t in range(start, n):
        g = first + t  # row number in the series, from 0
        adj = 0.075 * per + 0.54
        full = g >= 6
        d = hilbert(s[t], s[t - 2], s[t - 4], s[t - 6], adj) if full else 0.0
        q = hilbert(d, de[-2], de[-4], de[-6], adj) if full else 0.0
        i = de[-3] if g >= 3 else 0.0
        ji = hilbert(i, i1[-2], i1[-4], i1[-6], adj) if full else 0.0
        jq = hilbert(q, q1[-2], q1[-4], q1[-6], adj) if full else 0.0
        for lst, v in ((de, d), (q1, q), (i1, i)):
            lst.append(v)
            del lst[0]
        i2n, q2n = 0.2 * (i - jq) + 0.8 * i2, 0.2 * (q + ji) + 0.8 * q2
        re = 0.2 * (i2n * i2 + q2n * q2) + 0.8 * re
        im = 0.2 * (i2n * q2 - q2n * i2) + 0.8 * im
        i2, q2 = i2n, q2n
        before = per
        if im != 0.0 and re != 0.0:
            a = math.degrees(math.atan(im / re))
            if a != 0.0:
                per = 360.0 / a
        if before > 0:
            per = min(max(per, 0.67 * before), 1.5 * before)
        per = 0.2 * min(max(per, 6.0), 50.0) + 0.8 * before
        sp = 0.33 * per + 0.67 * sp
        # dominant cycle phase over the smoothed price
        cycle = int(sp + 0.5)
        m = min(cycle, g + 1)
        back = s[t - m + 1:t + 1][::-1]
        rp, ip = float(_SIN[cycle][:m] @ back), float(_COS[cycle][:m] @ back)
        phase = math.degrees(math.atan(rp / ip)) if abs(ip) > 0.001 else (90.0 if rp >= 0 else -90.0)
        phase += 90.0
        if sp > 0:
            phase += 360.0 / sp
        if ip < 0:
            phase += 180.0
        if phase > 315.0:
            phase -= 360.0
        sine, lead = math.sin(math.radians(phase)), math.sin(math.radians(phase + 45.0))
        # instantaneous trend: mean price over the dominant cycle, then WMA(4)
        now = float(price[t - min(max(cycle, 1), g + 1) + 1:t + 1].mean())
        line = (4 * now + 3 * trend_price[-1] + 2 * trend_price[-2] + trend_price[-3]) / 10.0
        trend_price.append(now)
        del trend_price[0]
        # trend or cycle mode
        crossed = g > 0 and ((sine > lead and prev_sine <= prev_lead) or (sine < lead and prev_sine >= prev_lead))
        days = 0.0 if crossed else days + 1
        trend = 0 if days < 0.5 * sp else 1
        if sp > 0 and 0.67 * 360.0 / sp < phase - prev_phase < 1.5 * 360.0 / sp:
            trend = 0
        if line != 0 and abs((s[t] - line) / line) >= 0.015:
            trend = 1
        prev_phase, prev_sine, prev_lead = phase, sine, lead
        angle = math.degrees(math.atan(q / i)) if i != 0 else 0.0
        alpha = max(fast / max(1.0, prev_angle - angle), slow)
        prev_angle = angle
        mama = alpha * price[t] + (1 - alpha) * mama if g > 0 else price[t]
        fama = 0.5 * alpha * mama + (1 - 0.5 * alpha) * fama if g > 0 else price[t]
        if g >= 32:
            for k, v in (("HT_DCPERIOD", sp), ("HT_PHASOR_inphase", i), ("HT_PHASOR_quadrature", q),
                         ("MAMA_mama", mama), ("MAMA_fama", fama)):
                out[k][t - start] = v
        if g >= 63:
            for k, v in (("HT_DCPHASE", phase), ("HT_SINE_sine", sine), ("HT_SINE_leadsine", lead),
                         ("HT_TRENDMODE", trend), ("HT_TRENDLINE", line)):
                out[k][t - start] = v
    return out, [float(x) for x in (*de, *q1, *i1, *trend_price, i2, q2, re, im, per, sp, prev_phase, prev_sine,
                                    prev_lead, days, mama, fama, prev_angle)]


def ht_kernel(price) -> dict:
    """Cycle measures and adaptive averages of a whole series."""
    return cycle_run(np.asarray(price, float), 0, 0, None)[0]


def exits_run(signal, close, start: int, state, size: float, max_holding: int, stop_pct: float):
    """SIG4 from row ``start``: per bar the target from the signal (1 long, −1 short, else keep); flat after
    ``max_holding`` bars in the position; flat when the close passes the entry price by ``stop_pct``
    against the position.  State (position, entry price, bars held); flat has one state."""
    last, entry, bars = state or (0.0, 0.0, 0.0)
    target = np.zeros(len(close) - start)
    for t in range(start, len(close)):
        c = close[t]
        new = size if signal[t] == 1 else -size if signal[t] == -1 else last
        if last != 0 and bars >= max_holding:
            new = 0.0
        if last > 0 and c <= entry * (1 - stop_pct) or last < 0 and c >= entry * (1 + stop_pct):
            new = 0.0
        if new == 0:
            entry, bars = 0.0, 0.0
        elif last == 0 or (new > 0) != (last > 0):
            entry, bars = c, 0.0
        else:
            bars += 1
        target[t - start] = last = new
    return target, [float(last), float(entry), float(bars)]


# ------------------------------------------------------------- Spark wiring
def _packed(fr: BarFrame, halo: int, cols: list[str]) -> DataFrame:
    """One row per (key, block): its rows and ``halo`` earlier ones, in order."""
    L = fr.block
    last = F.floor((F.col("rn") - 1 + int(halo)) / F.lit(L)).cast("long")
    rows = fr.df.select(fr.key, F.explode(F.sequence(F.col("blk"), last)).alias("_tb"),
                        F.struct("rn", *[F.col(c).cast("double").alias(c) for c in cols]).alias("r"))
    return rows.groupBy(fr.key, "_tb").agg(F.array_sort(F.collect_list("r")).alias("rows"))


def _same(a: str, b: str) -> Column:
    """Equal states, to a relative 1e-12 (NaN equals NaN)."""
    near = F.zip_with(a, b, lambda x, y: F.isnan(x) & F.isnan(y) | (
        F.abs(x - y) <= F.greatest(F.lit(1.0), F.abs(x), F.abs(y)) * 1e-12))
    return F.forall(near, lambda x: F.coalesce(x, F.lit(False)))


def _settle(fr: BarFrame, kernel: Kernel, cols: list[str], outs: list[str], warmup: int,
            max_rounds: int | None = None) -> tuple[list[DataFrame], DataFrame]:
    """Run a loop over every block until the block borders agree.

    Returns the runs (key, _tb, start, end, out; the first over all blocks, later ones over those that had to
    run again) and per block its final start and end state with the run (``ver``) it comes from."""
    if fr.resume:
        raise ValueError("a non-linear recurrence needs its whole series: build it in batch, or take its columns from "
                         "barloom.streaming.live in a stream")
    key, L = fr.key, fr.block
    packed = reliable_checkpoint(_packed(fr, warmup, cols))
    kind = fr.df.schema[key].dataType.simpleString()
    row = ", ".join(["rn:bigint", *[f"{o}:double" for o in outs]])
    schema = f"`{key}` {kind}, _tb bigint, start array<double>, end array<double>, out array<struct<{row}>>"

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                flat = one.column(2).flatten()
                rn = flat.field("rn").to_numpy()
                data = {c: np.array(flat.field(c).to_pylist(), float) for c in cols}
                own, first = int(np.searchsorted(rn, one.column(1)[0].as_py() * L + 1)), int(rn[0]) - 1
                start = one.column(3)[0].as_py() if b.num_columns > 3 else None
                if start is None and own:
                    start = kernel({c: v[:own] for c, v in data.items()}, 0, 0, None)[1]
                got, end = kernel(data, first, own, start)
                cells = pa.StructArray.from_arrays(
                    [pa.array(rn[own:]), *[pa.array(got[o], from_pandas=True) for o in outs]], names=["rn", *outs])
                state = pa.list_(pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(1), pa.array([start], state), pa.array([end], state),
                     pa.ListArray.from_arrays(pa.array([0, len(cells)], pa.int32()), cells)],
                    names=[key, "_tb", "start", "end", "out"])

    versions = [reliable_checkpoint(packed.mapInArrow(run, schema))]
    states = versions[0].select(key, "_tb", "start", "end", F.lit(0).alias("ver"))
    while max_rounds is None or len(versions) <= max_rounds:
        before = states.select(key, (F.col("_tb") + 1).alias("_tb"), F.col("end").alias("want"))
        todo = reliable_checkpoint(states.join(before, [key, "_tb"]).where(~_same("start", "want"))
                                   .select(key, "_tb", "want"))
        if todo.isEmpty():
            break
        again = reliable_checkpoint(packed.join(todo, [key, "_tb"]).select(key, "_tb", "rows", "want").mapInArrow(run, schema))
        versions.append(again)
        new = again.select(key, "_tb", "start", "end", F.lit(len(versions) - 1).alias("ver"))
        states = reliable_checkpoint(states.join(new, [key, "_tb"], "left_anti").unionByName(new))
    return versions, states


def run_blocks(fr: BarFrame, kernel: Kernel, cols: list[str], outs: list[str], warmup: int,
               max_rounds: int | None = None) -> DataFrame:
    """(key, rn, outs) of a loop over every series, block by block (see the module text)."""
    key = fr.key
    versions, states = _settle(fr, kernel, cols, outs, warmup, max_rounds)
    cells = None
    for ver, part in enumerate(versions):
        part = part.select(key, "_tb", F.lit(ver).alias("ver"), "out")
        cells = part if cells is None else cells.unionByName(part)
    if len(versions) > 1:
        cells = cells.join(states.select(key, "_tb", "ver"), [key, "_tb", "ver"])
    return cells.select(key, F.explode("out").alias("o")).select(key, "o.*")


def end_states(fr: BarFrame, kernel: Kernel, cols: list[str], outs: list[str], warmup: int) -> DataFrame:
    """(key, end): the loop's state after the last row of every series, found block by block."""
    states = _settle(fr, kernel, cols, outs, warmup)[1]
    return states.groupBy(fr.key).agg(F.max_by("end", "_tb").alias("end"))


def cycle_indicators(fr: BarFrame, price: str = "close", warmup: int = 512) -> BarFrame:
    """Hilbert-transform family and MAMA/FAMA.  Columns that the frame already has (from a
    stream's state) stay."""
    if set(CYCLE) <= set(fr.df.columns):
        return fr

    def kernel(data, first, start, state):
        return cycle_run(data[price], first, start, state)

    out = run_blocks(fr, kernel, [price], CYCLE, max(warmup, CYCLE_HALO))
    return fr.with_df(fr.df.join(out, [fr.key, "rn"], "left"))


def parabolic_sar(fr: BarFrame, accel: float = 0.02, maximum: float = 0.2, warmup: int = 512,
                  out: str = "SAR") -> BarFrame:
    """Wilder SAR.  A column that the frame already has (from a stream's state) stays."""
    if out in fr.df.columns:
        return fr

    def kernel(data, first, start, state):
        sar, end = sar_run(data["high"].tolist(), data["low"].tolist(), start, state, accel, maximum)
        return {out: sar}, end

    res = run_blocks(fr, kernel, ["high", "low"], [out], max(warmup, 2))
    return fr.with_df(fr.df.join(res, [fr.key, "rn"], "left"))


def path_exits(fr: BarFrame, signal: str = "gate", size: float = 1.0, max_holding: int = 20,
               stop_pct: float = 0.02, warmup: int = 512, out: str = "target") -> BarFrame:
    """SIG4: target position with time exit and stop."""
    def kernel(data, first, start, state):
        tgt, end = exits_run(data[signal].tolist(), data["close"].tolist(), start, state, size, max_holding, stop_pct)
        return {out: tgt}, end

    res = run_blocks(fr, kernel, [signal, "close"], [out], warmup)
    return fr.with_df(fr.df.join(res, [fr.key, "rn"], "left"))
