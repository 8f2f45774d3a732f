"""FP1 by arrays: all lags of all families in a few passes over blocks.

The column form (:mod:`barloom.plans.features`) has one expression per (indicator, lag), so
planning and code generation grow with the lags.  Here a block of rows with its halo is one
Arrow value; numpy builds every lag of a family from shared tables (running sums,
doubling tables, a rank table) and hands back one array a row.

* Finite windows: differences of running sums, doubling tables for extremes, and for the CCI's
  mean absolute deviation a :class:`RankSums` table, whose cost does not depend on the window.
* Linear recurrences: all smoothers advance together, a vector a row.  A block's effect on a
  vector is ``y -> D*y + B``; the small (D, B) tables are folded over blocks by the frame's
  carries, so no task sees more than a block, at any series length.

Passes: (1) B and D of the first smoothers; (2) with their carries, the last DX of each
block; (3) with it, B and D of the smoothers on smoothers; (4) all values.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.grouped import _packed
from barloom.plans.frame import BarFrame
from barloom.session import reliable_checkpoint

COLS = ["open", "high", "low", "close", "volume"]
TINY = 1e-12


class RankSums:
    """Count and sum of the values below a bound in any stretch of a sequence (a wavelet matrix over ranks).

    One level per bit of the rank: each keeps how many elements, and what sum, go to the zero side up to every place.
    A query walks the levels, whatever the length of its stretch.
    """

    def __init__(self, x: np.ndarray):
        order = np.argsort(x, kind="stable")
        rank = np.empty(len(x), "int64")
        rank[order] = np.arange(len(x))
        self.sorted, self.levels = x[order], []
        for b in reversed(range(int(len(x)).bit_length())):
            zero = (rank >> b) & 1 == 0
            self.levels.append((b, np.r_[0, np.cumsum(zero)], np.r_[0.0, np.cumsum(np.where(zero, x, 0.0))]))
            sides = np.argsort(~zero, kind="stable")
            rank, x = rank[sides], x[sides]

    def upto(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of the values of [lo, hi) that are at most ``bound``."""
        r = np.searchsorted(self.sorted, bound, side="right")
        count, total = np.zeros(len(lo), "int64"), np.zeros(len(lo))
        for b, zeros, sums in self.levels:
            one = (r >> b) & 1 == 1
            zl, zh = zeros[lo], zeros[hi]
            count += np.where(one, zh - zl, 0)
            total += np.where(one, sums[hi] - sums[lo], 0.0)
            lo, hi = np.where(one, zeros[-1] + lo - zl, zl), np.where(one, zeros[-1] + hi - zh, zh)
        return count, total


def _shift(x: np.ndarray, k: int, fill: float = np.nan) -> np.ndarray:
    out = np.full(len(x), fill)
    if k < len(x):
        out[k:] = x[:len(x) - k]
    return out


def _ratio(a: np.ndarray, b: np.ndarray, zero: float = 0.0) -> np.ndarray:
    """a / b, ``zero`` where b is 0."""
    return np.divide(a, b, out=np.full(len(a), zero), where=b != 0)


class Windows:
    """Window sums, extremes and mean deviations of one block (halo rows included), tables shared by all lags."""

    def __init__(self):
        self.tables: dict = {}

    def sum(self, name: str, x: np.ndarray, n: int) -> np.ndarray:
        if name not in self.tables:
            self.tables[name] = np.r_[0.0, np.cumsum(np.nan_to_num(x))]
        run = self.tables[name]
        at = np.arange(len(x))
        return run[at + 1] - run[np.maximum(at + 1 - n, 0)]

    def extreme(self, name: str, x: np.ndarray, n: int, place: bool = False) -> np.ndarray:
        """Maximum of the last ``n`` values, or the latest row (counted here from 0) that holds it."""
        key = (name, "max")
        levels = self.tables.setdefault(key, [(x, np.arange(len(x), dtype=float))])

        def merge(a, b):
            older = b[0] > a[0]
            return np.where(older, b[0], a[0]), np.where(older, b[1], a[1])

        def back(t, k):
            return _shift(t[0], k, -np.inf), _shift(t[1], k, -1.0)

        j = n.bit_length() - 1
        while len(levels) <= j:
            levels.append(merge(levels[-1], back(levels[-1], 1 << (len(levels) - 1))))
        got = merge(levels[j], back(levels[j], n - (1 << j))) if n > 1 << j else levels[j]
        return got[1] if place else got[0]

    def deviation(self, name: str, x: np.ndarray, n: int, mean: np.ndarray) -> np.ndarray:
        """Mean absolute deviation of the last ``n`` values from ``mean``."""
        key = (name, "rank")
        if key not in self.tables:
            self.tables[key] = RankSums(x)
        at = np.arange(len(x))
        lo = np.maximum(at + 1 - n, 0)
        count, below = self.tables[key].upto(lo, at + 1, mean)
        return (mean * count - below + (self.sum(name, x, n) - below) - mean * (np.minimum(at + 1, n) - count)) / n


def cci_values(w: Windows, tp: np.ndarray, n: int) -> np.ndarray:
    """CCI: distance from the moving mean over .015 times the mean absolute deviation from it; 0 if either is 0."""
    base = tp[0]
    x = tp - base
    mean = w.sum("tp", x, n) / n
    dev, off = w.deviation("tp", x, n, mean), x - mean
    still = TINY * max(float(np.abs(tp).max()), 1e-300)
    flat = (dev <= still) | (np.abs(off) <= still)
    return np.where(flat, 0.0, _ratio(off, dev * 0.015))


def finite_values(d: dict, rn: np.ndarray, by_lag: dict) -> dict[str, np.ndarray]:
    """Class-F features of FP1 of one block: name → values (NaN before the lookback)."""
    o, h, l, c, v = (d[k] for k in COLS)
    w, out = Windows(), {}
    pc, tp = _shift(c, 1), (h + l + c) / 3.0
    at = np.arange(len(c), dtype=float)
    cx, hx, lx = c - c[0], h - h[0], l - l[0]
    first = rn == 1
    with np.errstate(all="ignore"):
        rx, ry = _ratio(h, _shift(h, 1), np.nan) - 1.0, _ratio(l, _shift(l, 1), np.nan) - 1.0
    bp, tr1 = c - np.fmin(l, pc), np.fmax(h, pc) - np.fmin(l, pc)
    tr = np.where(np.isnan(pc), np.nan, np.maximum(h - l, np.maximum(np.abs(h - pc), np.abs(l - pc))))
    before = _shift(tp, 1)
    pf, nf = np.where(tp > before, tp * v, 0.0), np.where(tp < before, tp * v, 0.0)

    def put(name, after, x):
        out[name] = np.where(rn > after, x, np.nan)

    def mean(name, x, n):
        return w.sum(name, x, n) / n

    def spread(name, x, n):
        """Population variance, and the mean square it is a part of."""
        m, sq = mean(name, x, n), mean(name + "2", x * x, n)
        return sq - m * m, np.abs(sq)

    for n, want in by_lag.items():
        half = int(n / 2)
        if "ROC" in want:
            put(f"ROC_{n}", n, np.where(_shift(c, n) == 0, 0.0, 100.0 * (_ratio(c, _shift(c, n), 1.0) - 1.0)))
        if "MOM" in want:
            put(f"MOM_{n}", n, c - _shift(c, n))
        if "TRANGE" in want:
            put(f"TRANGE_{n}", 1, tr)
        if "CCI" in want:
            put(f"CCI_{n}", n - 1, cci_values(w, tp, n))
        if want & {"APO", "PPO"}:
            fast, slow = c[0] + mean("c", cx, n), c[0] + mean("c", cx, 2 * n)
            if "APO" in want:
                put(f"APO_{n}", 2 * n - 1, fast - slow)
            if "PPO" in want:
                put(f"PPO_{n}", 2 * n - 1, _ratio((fast - slow) * 100.0, slow))
        if want & {"STDDEV", "VAR"}:
            var, size = spread("c", cx, n)
            var = np.where(var <= size * TINY, 0.0, var)
            if "VAR" in want:
                put(f"VAR_{n}", n - 1, var)
            if "STDDEV" in want:
                put(f"STDDEV_{n}", n - 1, np.sqrt(var))
        if want & {"LINEARREG", "LINEARREG_ANGLE", "LINEARREG_INTERCEPT", "LINEARREG_SLOPE", "TSF"}:
            # x counts 0..n-1 inside the window, whose mean and variance are known
            mid, var_x = (n - 1) / 2.0, (n * n - 1) / 12.0
            mean_c = mean("c", cx, n)
            slope = ((w.sum("pc", at * cx, n) / n - (at - (n - 1)) * mean_c) - mid * mean_c) / var_x
            start = c[0] + mean_c - slope * mid
            for name, x in (("LINEARREG", start + slope * (n - 1)), ("LINEARREG_SLOPE", slope), ("LINEARREG_INTERCEPT", start),
                            ("LINEARREG_ANGLE", np.degrees(np.arctan(slope))), ("TSF", start + slope * n)):
                if name in want:
                    put(f"{name}_{n}", n - 1, x)
        if "CORREL" in want:
            (vh, sh), (vl, sl) = spread("h", hx, n), spread("l", lx, n)
            cov = mean("hl", hx * lx, n) - mean("h", hx, n) * mean("l", lx, n)
            ok = (vh > sh * TINY) & (vl > sl * TINY)
            put(f"CORREL_{n}", n - 1, np.where(ok, cov / np.sqrt(np.where(ok, vh * vl, 1.0)), 0.0))
        if "BETA" in want:
            x, y = np.nan_to_num(rx), np.nan_to_num(ry)
            vx, sx = spread("rx", x, n)
            cov = mean("rxy", x * y, n) - mean("rx", x, n) * mean("ry", y, n)
            put(f"BETA_{n}", n, np.where(vx > sx * TINY, _ratio(cov, vx), 0.0))
        if "ULTOSC" in want:
            part = [_ratio(w.sum("bp", bp, m), w.sum("tr1", tr1, m)) for m in (n, 2 * n, 3 * n)]
            put(f"ULTOSC_{n}", 3 * n, (part[0] * 4.0 + part[1] * 2.0 + part[2]) * (100.0 / 7.0))
        if "MFI" in want:
            p, q = w.sum("pf", pf, n), w.sum("nf", nf, n)
            put(f"MFI_{n}", n, np.where(p + q < 1.0, 0.0, _ratio(p * 100.0, p + q)))
        if "AROONOSC" in want:
            up, down = w.extreme("h", h, n + 1, True), w.extreme("-l", -l, n + 1, True)
            put(f"AROONOSC_{n}", n, (up - down) * (100.0 / n))
        if want & {"WILLR", "STOCH_slowk", "STOCHF_fastk"}:
            hh, ll = w.extreme("h", h, n), -w.extreme("-l", -l, n)
            k = _ratio((c - ll) * 100.0, hh - ll)
            if "WILLR" in want:
                put(f"WILLR_{n}", n - 1, _ratio((hh - c) * -100.0, hh - ll))
            if "STOCHF_fastk" in want:
                put(f"STOCHF_{n}fastk", n - 1 + half - 1, k)
            if "STOCH_slowk" in want:
                put(f"STOCH_{n}slowk", n - 1 + 2 * (half - 1), w.sum(f"k{n}", k, half) / half)
    # inputs of the recurrences
    up, dn = h - _shift(h, 1), _shift(l, 1) - l
    out.update({"_g": np.maximum(c - pc, 0.0), "_l": np.maximum(pc - c, 0.0),
                "_pdm": np.where((up > 0) & (up > dn), up, 0.0), "_mdm": np.where((dn > 0) & (dn > up), dn, 0.0),
                "_tr": np.where(first, np.nan, tr), "_clvv": _ratio((c - l) - (h - c), h - l) * v, "_c": c})
    return out


# ------------------------------------------------------------------ recurrences
#: A smoother: input, first row with it, seed rows, decay, weight of the seed rows, weight after.
Spec = tuple[str, int, int, float, float, float]


def _mean_spec(x: str, n: int, start: int) -> Spec:
    return (x, start, n, (n - 1) / n, 1.0 / n, 1.0 / n)


def _ema_spec(x: str, n: int, start: int, alpha: float | None = None) -> Spec:
    a = 2.0 / (n + 1) if alpha is None else alpha
    return (x, start, n, 1.0 - a, 1.0 / n, a)


def first_specs(by_lag: dict) -> dict[str, Spec]:
    out = {}
    for n, want in by_lag.items():
        if want & {"RSI", "CMO", "STOCHRSI_k"}:
            out[f"ag{n}"], out[f"al{n}"] = _mean_spec("_g", n, 2), _mean_spec("_l", n, 2)
        if want & {"PLUS_DM", "MINUS_DM", "DX", "ADX", "ADXR"}:
            for k, x in (("sp", "_pdm"), ("sm", "_mdm"), ("st", "_tr")):
                out[f"{k}{n}"] = (x, 2, n - 1, (n - 1) / n, 1.0, 1.0)
        if want & {"ATR", "NATR"}:
            out[f"atr{n}"] = _mean_spec("_tr", n, 2)
        if want & {"MACDSIGNAL", "MACDHIST"}:
            out[f"ms{n}"], out[f"mf{n}"] = _ema_spec("_c", 2 * n, 1), _ema_spec("_c", n, n + 1)
        if want & {"MACDSIGNALFIX", "MACDHISTFIX"}:
            out["xs"], out["xf"] = _ema_spec("_c", 26, 1, 0.075), _ema_spec("_c", 12, 15, 0.15)
        if "ADOSC" in want:
            out["ad"] = ("_clvv", 1, 1, 1.0, 1.0, 1.0)
    return out


def second_specs(by_lag: dict) -> dict[str, Spec]:
    out = {}
    for n, want in by_lag.items():
        if want & {"ADX", "ADXR"}:
            out[f"adx{n}"] = _mean_spec(f"dx{n}", n, n + 1)
        if want & {"MACDSIGNAL", "MACDHIST"}:
            out[f"mg{n}"] = _ema_spec(f"mm{n}", int(n / 2), 2 * n)
        if want & {"MACDSIGNALFIX", "MACDHISTFIX"}:
            out[f"xg{n}"] = _ema_spec("mx", n, 26)
        if "ADOSC" in want:
            for k, m in (("af", n), ("as", 3 * n)):
                a = 2.0 / (m + 1)
                out[f"{k}{n}"] = ("ad", 1, 1, 1.0 - a, 1.0, a)
    return out


class Smoothers:
    """All smoothers of a level over a block's own rows."""

    def __init__(self, specs: dict[str, Spec], data: dict, rn: np.ndarray):
        self.names, self.rn = list(specs), rn
        start, seed, decay, w_seed, w_after = (np.array([s[i] for s in specs.values()], float) for i in range(1, 6))
        self.seed_end = start + seed - 1
        r = rn[:, None]
        x = np.column_stack([data[s[0]] for s in specs.values()]) if specs else np.empty((len(rn), 0))
        if np.isnan(x[np.broadcast_to(r >= start, x.shape)]).any():
            raise ValueError("NULL inside a series: a smoother cannot skip a bar")
        self.x = np.where(r < start, 0.0, np.nan_to_num(x) * np.where(r <= self.seed_end, w_seed, w_after))
        self.d = np.where(r <= self.seed_end, 1.0, decay)

    def run(self, carry: np.ndarray) -> np.ndarray:
        y = np.empty_like(self.x)
        for t in range(len(self.x)):
            carry = self.d[t] * carry + self.x[t]
            y[t] = carry
        return y

    def effect(self) -> tuple[np.ndarray, np.ndarray]:
        """(B, D) of ``carry -> D * carry + B`` over the block."""
        y = self.run(np.zeros(len(self.names)))
        return y[-1], self.d.prod(axis=0)

    def values(self, carry: np.ndarray) -> dict[str, np.ndarray]:
        """Values by name, NaN before each smoother's seed is complete."""
        y = self.run(carry)
        return {k: np.where(self.rn >= self.seed_end[i], y[:, i], np.nan) for i, k in enumerate(self.names)}


def _dx_lags(by_lag: dict) -> list[int]:
    return [n for n, want in by_lag.items() if want & {"DX", "ADX", "ADXR"}]


def _raw_dx(y: dict, rn: np.ndarray, n: int) -> np.ndarray:
    p, m = _ratio(y[f"sp{n}"] * 100.0, y[f"st{n}"]), _ratio(y[f"sm{n}"] * 100.0, y[f"st{n}"])
    ok = (rn > n) & (p + m != 0)
    return np.where(ok, _ratio(np.abs(p - m) * 100.0, np.where(ok, p + m, 1.0)), np.nan)


def _fill(x: np.ndarray, before: float) -> np.ndarray:
    """Last value that is not NaN, ``before`` at the start."""
    at = np.maximum.accumulate(np.where(np.isnan(x), -1, np.arange(len(x))))
    return np.where(at >= 0, x[np.maximum(at, 0)], before)


class LagKernel:
    """The passes over one block (see the module text)."""

    def __init__(self, by_lag: dict):
        self.by_lag = by_lag
        self.first, self.second, self.dx = first_specs(by_lag), second_specs(by_lag), _dx_lags(by_lag)
        self.names = self._names()

    def _names(self) -> list[str]:
        """Columns of the result, found on a tiny block."""
        d = {k: np.arange(1.0, 4.0) for k in COLS}
        return list(self.values(d, np.arange(1, 4), 0, np.zeros(len(self.first)), np.full(len(self.dx), np.nan), np.zeros(len(self.second))))

    def _first(self, d, rn, own):
        fin = finite_values(d, rn, self.by_lag)
        fin = {k: x[own:] for k, x in fin.items()}
        return fin, Smoothers(self.first, fin, rn[own:])

    def _derived(self, y: dict, rn: np.ndarray, last_dx: np.ndarray) -> dict:
        out = {"ad": y.get("ad")}
        for i, n in enumerate(self.dx):
            filled = _fill(_raw_dx(y, rn, n), last_dx[i])
            out[f"dx{n}"] = np.where(rn > n, np.nan_to_num(filled), np.nan)
        for n in self.by_lag:
            if f"ms{n}" in y:
                out[f"mm{n}"] = y[f"mf{n}"] - y[f"ms{n}"]
        if "xs" in y:
            out["mx"] = y["xf"] - y["xs"]
        return out

    def effect1(self, d, rn, own):
        return self._first(d, rn, own)[1].effect()

    def last_dx(self, d, rn, own, carry1):
        y, r = self._first(d, rn, own)[1].values(carry1), rn[own:]
        return np.array([_fill(_raw_dx(y, r, n), np.nan)[-1] for n in self.dx], float)

    def effect2(self, d, rn, own, carry1, last_dx):
        y, r = self._first(d, rn, own)[1].values(carry1), rn[own:]
        return Smoothers(self.second, self._derived(y, r, last_dx), r).effect()

    def values(self, d, rn, own, carry1, last_dx, carry2) -> dict[str, np.ndarray]:
        """All columns of the block's own rows; names with a leading underscore feed the last window stage."""
        fin, smooth = self._first(d, rn, own)
        y, r = smooth.values(carry1), rn[own:]
        mid = self._derived(y, r, last_dx)
        z = Smoothers(self.second, mid, r).values(carry2)
        out = {k: x for k, x in fin.items() if not k.startswith("_")}

        def put(name, after, x):
            out[name] = np.where(r > after, x, np.nan)

        for n, want in self.by_lag.items():
            if f"ag{n}" in y:
                ag, al = y[f"ag{n}"], y[f"al{n}"]
                known = np.where(np.isnan(ag), np.nan, 1.0)
                rsi = known * _ratio(ag * 100.0, ag + al)
                if "RSI" in want:
                    out[f"RSI_{n}"] = rsi
                if "CMO" in want:
                    out[f"CMO_{n}"] = known * _ratio((ag - al) * 100.0, ag + al)
                if "STOCHRSI_k" in want:
                    out[f"_rsi{n}"] = rsi
            if "PLUS_DM" in want:
                out[f"PLUS_DM_{n}"] = y[f"sp{n}"]
            if "MINUS_DM" in want:
                out[f"MINUS_DM_{n}"] = y[f"sm{n}"]
            if "ATR" in want:
                out[f"ATR_{n}"] = y[f"atr{n}"]
            if "NATR" in want:
                out[f"NATR_{n}"] = np.where(np.isnan(y[f"atr{n}"]), np.nan, _ratio(y[f"atr{n}"] * 100.0, fin["_c"]))
            if "DX" in want:
                out[f"DX_{n}"] = mid[f"dx{n}"]
            if "ADX" in want:
                out[f"ADX_{n}"] = z[f"adx{n}"]
            if "ADXR" in want:
                out[f"_adx{n}"] = z[f"adx{n}"]
            half = int(n / 2)
            if "MACDSIGNAL" in want:
                put(f"MACDSIGNAL_{n}", 2 * n + half - 2, z[f"mg{n}"])
            if "MACDHIST" in want:
                put(f"MACDHIST_{n}", 2 * n + half - 2, mid[f"mm{n}"] - z[f"mg{n}"])
            if "MACDSIGNALFIX" in want:
                put(f"MACDSIGNALFIX_{n}", 26 + n - 2, z[f"xg{n}"])
            if "MACDHISTFIX" in want:
                put(f"MACDHISTFIX_{n}", 26 + n - 2, mid["mx"] - z[f"xg{n}"])
            if "ADOSC" in want:
                put(f"ADOSC_{n}", 3 * n - 1, z[f"af{n}"] - z[f"as{n}"])
        return out


# ------------------------------------------------------------------ Spark wiring
def _passes(packed: DataFrame, key: str, L: int, schema: str, fn) -> DataFrame:
    """One row per block through ``fn(columns, rn, own, carries)``, which gives a list of Arrow arrays."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                one = b.slice(i, 1)
                flat = one.column(2).flatten()
                rn = flat.field("rn").to_numpy()
                data = {c: np.array(flat.field(c).to_pylist(), float) for c in COLS}
                own = int(np.searchsorted(rn, one.column(1)[0].as_py() * L + 1))
                if own == len(rn):  # only the halo of a block after the series' end
                    continue
                carries = [np.array(one.column(j)[0].as_py(), float) for j in range(3, b.num_columns)]
                yield from fn(one, data, rn, own, carries)

    return packed.mapInArrow(run, schema)


def _list(x) -> pa.Array:
    return pa.array([x], pa.list_(pa.float64()), from_pandas=True)


def array_features(fr: BarFrame, by_lag: dict[int, set[str]]) -> tuple[DataFrame, list[str]]:
    """(key, rn, f) with the features of every lag in the array ``f``, and the names of its places."""
    key, L = fr.key, fr.block
    kernel = LagKernel(by_lag)
    halo = 3 * max(by_lag, default=0) + 1
    packed = reliable_checkpoint(_packed(fr, halo, COLS))
    kind = fr.df.schema[key].dataType.simpleString()
    blocks = replace(fr, scan_block=L)
    head = f"`{key}` {kind}, sblk bigint, "

    def joined(rows: DataFrame, *tables: DataFrame) -> DataFrame:
        for t in tables:
            rows = blocks._small_join(rows, t.withColumnRenamed("sblk", "_tb"), [key, "_tb"])
        return rows

    def folded(effects: DataFrame, size: int, name: str) -> DataFrame:
        """Carry into every block from (b, d) per block."""
        pairs = effects.select(key, "sblk", F.zip_with("b", "d", lambda b, d: F.struct(b.alias("b"), d.alias("d"))).alias("v"))
        none = F.array_repeat(F.struct(F.lit(0.0).alias("b"), F.lit(1.0).alias("d")), size)
        carry = blocks._carries(pairs, lambda acc, v: F.zip_with(acc, v, lambda p, q: F.struct(
            (p["b"] * q["d"] + q["b"]).alias("b"), (p["d"] * q["d"]).alias("d"))), none, "v")
        return reliable_checkpoint(carry.select(key, "sblk", F.transform("carry", lambda c: c["b"]).alias(name)))

    def effect(step):
        def fn(one, data, rn, own, carries):
            b, d = step(data, rn, own, *carries)
            yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), _list(b), _list(d)], names=[key, "sblk", "b", "d"])
        return fn

    schema = head + "b array<double>, d array<double>"
    c1 = folded(_passes(packed, key, L, schema, effect(kernel.effect1)), len(kernel.first), "c1")

    def last(one, data, rn, own, carries):
        yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), _list(kernel.last_dx(data, rn, own, *carries))], names=[key, "sblk", "v"])

    dx = _passes(joined(packed, c1), key, L, head + "v array<double>", last)
    empty = F.array_repeat(F.lit(None).cast("double"), len(kernel.dx))
    dx = blocks._carries(dx, lambda acc, v: F.zip_with(acc, v, lambda p, q: F.coalesce(q, p)), empty, "v")
    dx = reliable_checkpoint(dx.select(key, "sblk", F.transform("carry", lambda c: F.coalesce(c, F.lit(float("nan")))).alias("dx")))
    c2 = folded(_passes(joined(packed, c1, dx), key, L, schema, effect(kernel.effect2)), len(kernel.second), "c2")

    def final(one, data, rn, own, carries):
        got = kernel.values(data, rn, own, *carries)
        rows = len(rn) - own
        cells = np.column_stack([got[k] for k in kernel.names]) if kernel.names else np.empty((rows, 0))
        offsets = np.arange(rows + 1, dtype="int32") * len(kernel.names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([one.column(0)[0].as_py()] * rows, one.schema.field(0).type), pa.array(rn[own:]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells.ravel(), from_pandas=True))], names=[key, "rn", "f"])

    out = _passes(joined(packed, c1, dx, c2), key, L, f"`{key}` {kind}, rn bigint, f array<double>", final)
    return out, kernel.names


def cci_blocks(fr: BarFrame, n: int | list[int] = 14) -> BarFrame:
    """W29 at any windows: ``CCI_<n>`` columns whose cost does not grow with ``n`` (exact as :func:`finite.cci`)."""
    lags = [n] if isinstance(n, int) else list(n)
    got, names = array_features(fr, {m: {"CCI"} for m in lags})
    cols = got.selectExpr(f"`{fr.key}`", "rn", *[f"f[{i}] AS `{k}`" for i, k in enumerate(names)])
    return replace(fr.with_df(fr.df.join(cols, [fr.key, "rn"], "left")), reach=fr.reach + max(lags) - 1)
