"""Feature plans (FP1–FP4): all batch features for a list of lags, or only the
features named in a list such as ``12_RSI_37``.

One plan for the whole family, in a few stages that share work across lags:

1. one finite-window stage (halo = the largest lookback): every class-F
   indicator for every lag, the 61 patterns and their WMA(300), the inputs of
   the recurrences (gains/losses, ±DM, true range, CLV·volume) and time fields;
2. one scan pass for all first-level recurrences of all lags (Wilder sums and
   means, MACD EMAs, the A/D line);
3. a finite stage for the values built on them (RSI, CMO, ±DI, DX, StochRSI, …);
4. one forward-fill pass (DX repeats its last value on a zero denominator);
5. one scan pass for the second-level recurrences (ADX, MACD signals, ADOSC EMAs);
6. a finite stage for ADXR and the final differences.

Scan passes materialise their input in the checkpoint folder (see
:meth:`BarFrame._stage_input`), so the plan stays linear in the number of stages.
The batch and the live/stream path use this one definition (FP4).
"""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import patterns as PT
from barloom.functions import timefeat as TF
from barloom.functions.finite import Feat, pct, sdiv
from barloom.plans.frame import BarFrame, Win

LAGS = list(range(7, 150, 10))  # fixed reference setting: 7, 17, …, 147

MOMENTUM = ["ROC", "MOM", "PLUS_DM", "MINUS_DM", "ADX", "ADXR", "APO", "AROONOSC", "CCI", "CMO", "DX",
            "STOCH_slowk", "STOCHF_fastk", "MACDSIGNAL", "MACDSIGNALFIX", "PPO", "RSI", "ULTOSC", "WILLR",
            "STOCHRSI_k", "NATR", "ATR", "TRANGE"]
VOLUME = ["ADOSC", "MFI"]
MATH = ["BETA", "CORREL", "LINEARREG", "LINEARREG_ANGLE", "LINEARREG_INTERCEPT", "LINEARREG_SLOPE",
        "STDDEV", "TSF", "VAR"]
CYCLE = ["HT_TRENDLINE", "HT_TRENDMODE", "HT_DCPERIOD", "HT_DCPHASE", "HT_PHASORinphase", "HT_SINEsine"]
CYCLE_OUTPUTS = [*CYCLE, "HT_PHASORquadrature", "HT_SINEleadsine"]
EXTRA = ["MACDHIST", "MACDHISTFIX"]  # live names only
RSI_BASED, ATR_BASED = {"RSI", "CMO", "STOCHRSI_k"}, {"ATR", "NATR"}
DI_BASED = {"PLUS_DM", "MINUS_DM", "DX", "ADX", "ADXR"}
TIME = ["time_hour", "time_minute", "time_day_of_week", "time_day_of_month"]


def feature_name(base: str, lag: int) -> str:
    """Column name used by the batch generator for indicator ``base`` at ``lag``."""
    if base.endswith(("_slowk", "_fastk", "_k")) and base.split("_")[0] in ("STOCH", "STOCHF", "STOCHRSI"):
        head, tail = base.split("_", 1)
        return f"{head}_{lag}{tail}"
    return f"{base}_{lag}"


def _rn():
    return F.col("rn")


def _finite_stage(w: Win, lags, at, patterns: list[str], pattern_wma: int | None):
    """Class-F features (``at(n)``: the bases wanted at lag n) plus recurrence inputs (one halo stage)."""
    c, h, l, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume")
    pc = w.lag(c, 1)
    up = h - w.lag(h, 1)
    dn = w.lag(l, 1) - l
    steps = [("_dc", c - pc), ("_g", F.greatest(c - pc, F.lit(0.0))), ("_l", F.greatest(pc - c, F.lit(0.0))),
             ("_pdm", F.when((up > 0) & (up > dn), up).otherwise(F.lit(0.0))),
             ("_mdm", F.when((dn > 0) & (dn > up), dn).otherwise(F.lit(0.0))),
             ("_tr", F.when(pc.isNotNull(), F.greatest(h - l, F.abs(h - pc), F.abs(l - pc)))),
             ("_clvv", sdiv((c - l) - (h - c), h - l) * v)]
    feats = [Feat(steps, 1)]
    for n in lags:
        half, want = int(n / 2), at(n)
        if "ROC" in want: feats.append(FI.roc(w, n=n, out=f"ROC_{n}"))
        if "MOM" in want: feats.append(FI.mom(w, n=n, out=f"MOM_{n}"))
        if "APO" in want: feats.append(FI.apo(w, fast=n, slow=2 * n, out=f"APO_{n}"))
        if "PPO" in want: feats.append(FI.ppo(w, fast=n, slow=2 * n, out=f"PPO_{n}"))
        if "AROONOSC" in want: feats.append(FI.aroonosc(w, n=n, out=f"AROONOSC_{n}"))
        if "CCI" in want: feats.append(FI.cci(w, n=n, out=f"CCI_{n}"))
        if "STOCH_slowk" in want:
            f = FI.stoch(w, fastk=n, slowk=half, slowd=half, prefix=f"_st{n}")
            feats.append(Feat(f.steps + [(f"STOCH_{n}slowk", F.col(f"_st{n}_slowk"))], f.halo))
        if "STOCHF_fastk" in want:
            f = FI.stochf(w, fastk=n, fastd=half, prefix=f"_sf{n}")
            feats.append(Feat(f.steps + [(f"STOCHF_{n}fastk", F.col(f"_sf{n}_fastk"))], f.halo))
        if "ULTOSC" in want: feats.append(FI.ultosc(w, p1=n, p2=2 * n, p3=3 * n, out=f"ULTOSC_{n}"))
        if "WILLR" in want: feats.append(FI.willr(w, n=n, out=f"WILLR_{n}"))
        if "TRANGE" in want: feats.append(FI.trange(w, out=f"TRANGE_{n}"))
        if "MFI" in want: feats.append(FI.mfi(w, n=n, out=f"MFI_{n}"))
        if "BETA" in want: feats.append(FI.beta(w, n=n, out=f"BETA_{n}"))
        if "CORREL" in want: feats.append(FI.correl(w, n=n, out=f"CORREL_{n}"))
        if "LINEARREG" in want: feats.append(FI.linearreg(w, n=n, out=f"LINEARREG_{n}"))
        if "LINEARREG_ANGLE" in want: feats.append(FI.linearreg_angle(w, n=n, out=f"LINEARREG_ANGLE_{n}"))
        if "LINEARREG_INTERCEPT" in want: feats.append(FI.linearreg_intercept(w, n=n, out=f"LINEARREG_INTERCEPT_{n}"))
        if "LINEARREG_SLOPE" in want: feats.append(FI.linearreg_slope(w, n=n, out=f"LINEARREG_SLOPE_{n}"))
        if "STDDEV" in want: feats.append(FI.stddev(w, n=n, out=f"STDDEV_{n}"))
        if "TSF" in want: feats.append(FI.tsf(w, n=n, out=f"TSF_{n}"))
        if "VAR" in want: feats.append(FI.var(w, n=n, out=f"VAR_{n}"))
    if patterns:
        raw = PT.pattern_feats(w, patterns)
        if pattern_wma is None:
            feats.append(raw)
            return FI.combine(*feats)
        renamed = [(f"_raw_{n}" if n in patterns else n, col) for n, col in raw.steps]
        feats.append(Feat(renamed, raw.halo))
        p = w.pos
        wm = []
        for name in patterns:
            x = F.col(f"_raw_{name}").cast("double")
            s1 = F.sum(x * p).over(w.w(pattern_wma))
            s0 = F.sum(x).over(w.w(pattern_wma))
            val = (s1 - (p - F.lit(float(pattern_wma))) * s0) / F.lit(pattern_wma * (pattern_wma + 1) / 2.0)
            wm.append((name, F.when(_rn() > PT.lookback(name) + pattern_wma - 1, val)))
        feats.append(Feat(wm, raw.halo + pattern_wma - 1))
    return FI.combine(*feats)


class _Fast:
    """Running sums per (key, block) partition and lag differences for window sums,
    doubling tables for window max/min: O(1) or O(log n) per row instead of
    Spark's O(n) re-evaluation of a bounded sliding frame.  Inputs are centred on
    the partition's first value, so the running sums stay small."""

    def __init__(self, w: Win):
        self.w = w
        self.run = w.o.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.full = w.o.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        self.levels = [[], [], [], []]     # centring, running sums, doubling levels, results
        self.names = set()

    def _add(self, lvl, name, col):
        if name not in self.names:
            self.names.add(name)
            self.levels[lvl].append((name, col))
        return F.col(name)

    def centred(self, x: str) -> str:
        c0 = self._add(0, f"_c0_{x}", F.first(F.col(x), ignorenulls=True).over(self.full))
        self._add(0, f"_cx_{x}", F.col(x) - c0)
        return f"_cx_{x}"

    def R(self, name: str, expr) -> str:
        """Running sum of ``expr`` (registered under ``name``)."""
        self._add(1, f"_R_{name}", F.sum(expr).over(self.run))
        return f"_R_{name}"

    def S(self, rname: str, n: int):
        """Sum over the last n rows from a running sum (lag difference)."""
        r = F.col(rname)
        return r - F.coalesce(F.lag(r, int(n)).over(self.w.o), F.lit(0.0))

    def ext(self, x: str, n: int, how: str):
        """Max/min over the last n rows from a doubling table."""
        agg = F.greatest if how == "max" else F.least
        j = max(0, int(n).bit_length() - 1)
        for k in range(1, j + 1):
            prev = F.col(f"_D{how}_{x}_{k - 1}") if k > 1 else F.col(x)
            self._add(2, f"_D{how}_{x}_{k}", agg(prev, F.lag(prev, 1 << (k - 1)).over(self.w.o)))
        m = F.col(f"_D{how}_{x}_{j}") if j else F.col(x)
        return agg(m, F.lag(m, int(n) - (1 << j)).over(self.w.o)) if n > (1 << j) else m

    def steps(self):
        # doubling levels depend on each other: one level per table depth
        out = list(self.levels[0]) + list(self.levels[1])
        by_depth = {}
        for name, col in self.levels[2]:
            by_depth.setdefault(int(name.rsplit("_", 1)[1]), []).append((name, col))
        for d in sorted(by_depth):
            out += by_depth[d]
        return out


def _fast_family(w: Win, lags, at, fast: _Fast):
    """Fast forms of the sum/moment/extreme based class-F features of FP1."""
    out = []
    pos = w.pos
    cx = F.col(fast.centred("close"))
    c0 = F.col("_c0_close")
    Rc = fast.R("c", cx)
    Rc2 = fast.R("c2", cx * cx)
    Rp = fast.R("p", pos)
    Rp2 = fast.R("p2", pos * pos)
    Rpc = fast.R("pc", pos * cx)
    rn = _rn()
    eps = 1e-12

    def mean(rname, n):
        return fast.S(rname, n) / float(n)

    def var_of(r1, r2, n):
        m = fast.S(r1, n) / float(n)
        return fast.S(r2, n) / float(n) - m * m

    for n in lags:
        want = at(n)
        if want & {"APO", "PPO"}:
            sf, ss = c0 + mean(Rc, n), c0 + mean(Rc, 2 * n)
            if "APO" in want:
                out.append((f"APO_{n}", F.when(rn > 2 * n - 1, sf - ss)))
            if "PPO" in want:
                out.append((f"PPO_{n}", F.when(rn > 2 * n - 1, sdiv((sf - ss) * 100.0, ss))))
        if want & {"STDDEV", "VAR"}:
            v = var_of(Rc, Rc2, n)
            scale = mean(Rc2, n)
            v = F.when(v <= F.abs(scale) * eps, F.lit(0.0)).otherwise(v)
            if "VAR" in want:
                out.append((f"VAR_{n}", F.when(rn > n - 1, v)))
            if "STDDEV" in want:
                out.append((f"STDDEV_{n}", F.when(rn > n - 1, F.sqrt(v))))
        if want & {"LINEARREG", "LINEARREG_ANGLE", "LINEARREG_INTERCEPT", "LINEARREG_SLOPE", "TSF"}:
            mp, mc = mean(Rp, n), mean(Rc, n)
            cov = mean(Rpc, n) - mp * mc
            vp = mean(Rp2, n) - mp * mp
            slope = F.try_divide(cov, vp)
            icpt = c0 + mc - slope * mp
            g = rn > n - 1
            if "LINEARREG" in want:
                out.append((f"LINEARREG_{n}", F.when(g, icpt + slope * pos)))
            if "LINEARREG_SLOPE" in want:
                out.append((f"LINEARREG_SLOPE_{n}", F.when(g, slope)))
            if "LINEARREG_ANGLE" in want:
                out.append((f"LINEARREG_ANGLE_{n}", F.when(g, F.degrees(F.atan(slope)))))
            if "LINEARREG_INTERCEPT" in want:
                out.append((f"LINEARREG_INTERCEPT_{n}", F.when(g, icpt + slope * (pos - float(n - 1)))))
            if "TSF" in want:
                out.append((f"TSF_{n}", F.when(g, icpt + slope * (pos + 1.0))))
        if "CORREL" in want:
            hx, lx = F.col(fast.centred("high")), F.col(fast.centred("low"))
            Rh, Rl = fast.R("h", hx), fast.R("l", lx)
            Rh2, Rl2, Rhl = fast.R("h2", hx * hx), fast.R("l2", lx * lx), fast.R("hl", hx * lx)
            vh, vl = var_of(Rh, Rh2, n), var_of(Rl, Rl2, n)
            cov = mean(Rhl, n) - mean(Rh, n) * mean(Rl, n)
            ok = (vh > F.abs(mean(Rh2, n)) * eps) & (vl > F.abs(mean(Rl2, n)) * eps)
            out.append((f"CORREL_{n}", F.when(rn > n - 1, F.when(ok, cov / F.sqrt(vh * vl)).otherwise(0.0))))
        if "BETA" in want:
            Rx, Ry = fast.R("rx", F.col("_rx")), fast.R("ry", F.col("_ry"))
            Rxx, Rxy = fast.R("rxx", F.col("_rx") * F.col("_rx")), fast.R("rxy", F.col("_rx") * F.col("_ry"))
            vx = var_of(Rx, Rxx, n)
            cov = mean(Rxy, n) - mean(Rx, n) * mean(Ry, n)
            out.append((f"BETA_{n}", F.when(rn > n, F.when(vx > F.abs(mean(Rxx, n)) * eps, cov / vx).otherwise(0.0))))
        if "ULTOSC" in want:
            Rb, Rt = fast.R("bp", F.col("_bp")), fast.R("tr1", F.col("_tr1"))
            def av(m):
                return sdiv(fast.S(Rb, m), fast.S(Rt, m))
            out.append((f"ULTOSC_{n}", F.when(rn > 3 * n, (av(n) * 4.0 + av(2 * n) * 2.0 + av(3 * n)) * (100.0 / 7.0))))
        if "MFI" in want:
            Rpf, Rnf = fast.R("pf", F.col("_pf")), fast.R("nf", F.col("_nf"))
            P, N = fast.S(Rpf, n), fast.S(Rnf, n)
            out.append((f"MFI_{n}", F.when(rn > n, F.when(P + N < 1.0, F.lit(0.0)).otherwise(P * 100.0 / (P + N)))))
        if "AROONOSC" in want:
            # bars since the extreme over n+1 rows (ties → latest): max of (value, rn) structs
            up = fast.ext("_hk", n + 1, "max").getField("r")
            dn = fast.ext("_lk", n + 1, "max").getField("r")
            val = ((F.lit(float(n)) - (rn - up)) - (F.lit(float(n)) - (rn - dn))) * (100.0 / n)
            out.append((f"AROONOSC_{n}", F.when(rn > n, val)))
        if want & {"WILLR", "STOCH_slowk", "STOCHF_fastk"}:
            hh, ll = fast.ext("high", n, "max"), fast.ext("low", n, "min")
            k = sdiv((F.col("close") - ll) * 100.0, hh - ll)
            if "WILLR" in want:
                out.append((f"WILLR_{n}", F.when(rn > n - 1, sdiv((hh - F.col("close")) * -100.0, hh - ll))))
            if want & {"STOCH_slowk", "STOCHF_fastk"}:
                out.append((f"_fk{n}", F.when(rn > n - 1, k)))
    return out


def _finite_stage_fast(w: Win, lags, at, patterns: list[str], pattern_wma: int | None):
    """Class-F features of FP1 with running-sum / doubling forms where the window
    is long; lag-based and small features use the exact builders."""
    base = _finite_stage(w, lags, lambda n: at(n) & {"ROC", "MOM", "CCI", "TRANGE"}, [], pattern_wma)
    c, h, l, v = F.col("close"), F.col("high"), F.col("low"), F.col("volume")
    pc = w.lag(c, 1)
    tp = (h + l + c) / 3.0
    pre = [("_rx", sdiv(h, w.lag(h, 1), None) - 1.0), ("_ry", sdiv(l, w.lag(l, 1), None) - 1.0),
           ("_bp", c - F.least(l, pc)), ("_tr1", F.greatest(h, pc) - F.least(l, pc)),
           ("_tpf", tp), ("_hk", F.struct(h.alias("v"), _rn().alias("r"))),
           ("_lk", F.struct((-l).alias("v"), _rn().alias("r")))]
    flows = [("_pf", F.when(F.col("_tpf") > w.lag(F.col("_tpf"), 1), F.col("_tpf") * v).otherwise(0.0)),
             ("_nf", F.when(F.col("_tpf") < w.lag(F.col("_tpf"), 1), F.col("_tpf") * v).otherwise(0.0))]
    fast = _Fast(w)
    res = _fast_family(w, lags, at, fast)
    steps = list(base.steps) + pre + flows + fast.steps() + res
    # stochastic smoothing of the fast %K with running sums (values are 0..100)
    fast2 = _Fast(w)
    sm = []
    for n in lags:
        half, want = int(n / 2), at(n)
        if want & {"STOCH_slowk", "STOCHF_fastk"}:
            Rk = fast2.R(f"fk{n}", F.col(f"_fk{n}"))
            if "STOCHF_fastk" in want:
                sm.append((f"STOCHF_{n}fastk", F.when(_rn() > n - 1 + half - 1, F.col(f"_fk{n}"))))
            if "STOCH_slowk" in want:
                sm.append((f"_sk{n}", fast2.S(Rk, half) / float(half)))
    steps += fast2.steps() + sm
    for n in lags:
        half = int(n / 2)
        if "STOCH_slowk" in at(n):
            # slow %K is reported once slow %D (an SMA of it over ``half`` rows) exists
            steps.append((f"STOCH_{n}slowk", F.when(_rn() > n - 1 + 2 * (half - 1), F.col(f"_sk{n}"))))
    halo = 3 * max(lags, default=0) + 1
    feats = [Feat(steps, max(halo, base.halo))]
    if patterns:
        raw = PT.pattern_feats(w, patterns)
        if pattern_wma is None:
            feats.append(raw)
            return FI.combine(*feats)
        renamed = [(f"_raw_{n}" if n in patterns else n, col) for n, col in raw.steps]
        fp = _Fast(w)
        p = w.pos
        wm = []
        for name in patterns:
            x = F.col(f"_raw_{name}").cast("double")
            R0, R1 = fp.R(f"k0_{name}", x), fp.R(f"k1_{name}", x * p)
            s1, s0 = fp.S(R1, pattern_wma), fp.S(R0, pattern_wma)
            val = (s1 - (p - float(pattern_wma)) * s0) / (pattern_wma * (pattern_wma + 1) / 2.0)
            wm.append((name, F.when(_rn() > PT.lookback(name) + pattern_wma - 1, val)))
        feats.append(Feat(renamed + fp.steps() + wm, raw.halo + pattern_wma - 1))
    return FI.combine(*feats)


def generate_all_features(fr: BarFrame, lags=LAGS, bases=None, patterns: bool | list[str] = True, time: bool | list[str] = True,
                          cycle: bool | list[str] = True, pattern_wma: int | None = 300, dropna: bool = True,
                          sort: bool = True, fast: bool = True, pairs: list[tuple[str, int]] | None = None,
                          arrays: bool | None = None) -> BarFrame:
    """FP1: every batch feature of the reference for ``lags`` (581 columns for the default lags).

    ``fast``: long sums/moments/extremes by running sums and doubling tables
    (agree with the sliding-frame builders to ~1e-9 relative); ``False`` uses the
    exact sliding-frame builders throughout.  ``pairs`` = [(base, lag)] builds just
    these instead of all bases at all lags; ``patterns``, ``time`` and ``cycle`` may be
    lists of names; ``pattern_wma=None`` gives the raw pattern values.

    ``arrays``: build all lags in a few passes over blocks (:mod:`barloom.plans.feature_arrays`)
    instead of one expression per indicator and lag; the default does so from four
    lags on, where planning would take longer than the work.  Resumed frames (streams) use columns."""
    if pairs is None:
        all_bases = set(bases or (VOLUME + MOMENTUM + MATH))
        by_lag = {n: all_bases for n in lags}
    else:
        by_lag = {}
        for base, n in pairs:
            by_lag.setdefault(n, set()).add(base)
        lags = sorted(by_lag)
    want = set().union(*by_lag.values()) if by_lag else set()

    def at(n: int) -> set[str]:
        return by_lag[n]

    names = PT.ALL_PATTERNS if patterns is True else list(patterns or [])
    w = Win(fr.key, fr.block)
    stage = _finite_stage_fast if fast else _finite_stage
    if arrays is None:
        arrays = fast and not fr.resume and len(lags) >= 4
    if arrays and fr.resume:
        raise ValueError("a resumed frame builds its features by columns")
    fr = fr.add(stage(w, [] if arrays else lags, at, names, pattern_wma))
    if cycle:
        from barloom.operators.grouped import CYCLE as CYCLE_RAW, cycle_indicators
        fr = cycle_indicators(fr)
        keep_ht = CYCLE if cycle is True else cycle
        df = fr.df.withColumnsRenamed({c: c.replace("HT_PHASOR_", "HT_PHASOR").replace("HT_SINE_", "HT_SINE") for c in CYCLE_RAW})
        fr = fr.with_df(df.drop(*[c for c in (*CYCLE_OUTPUTS, "MAMA_mama", "MAMA_fama") if c not in keep_ht]))
    if time:
        fields = TF.time_features(fr.order[0])
        fr = fr.with_columns(**{k: v for k, v in fields.items() if time is True or k in time})

    if arrays:
        return _finish(_array_stage(fr, w, by_lag), dropna, sort)

    # ---- stage 2: first-level recurrences for all lags in one pass
    from barloom.functions.recurrent import smooth_many, _ema_spec, _wmean_spec, _wsum_spec
    specs, everything = [], want
    for n in lags:
        want = at(n)
        need_rsi, need_di, need_atr = want & RSI_BASED, want & DI_BASED, want & ATR_BASED
        if need_rsi:
            specs += [_wmean_spec(f"_ag{n}", "_g", n, 2), _wmean_spec(f"_al{n}", "_l", n, 2)]
        if need_di:
            specs += [_wsum_spec(f"_sp{n}", "_pdm", n, 2), _wsum_spec(f"_sm{n}", "_mdm", n, 2),
                      _wsum_spec(f"_stt{n}", "_tr", n, 2)]
        if need_atr:
            specs.append(_wmean_spec(f"_atr{n}", "_tr", n, 2))
        if want & {"MACDSIGNAL", "MACDHIST"}:
            f, s = n, 2 * n
            af, as_ = 2.0 / (f + 1), 2.0 / (s + 1)
            specs += [(f"_mes{n}", F.col("close"), 1, s, 1.0 - as_, 1.0 / s, as_),
                      (f"_mef{n}", F.col("close"), s - f + 1, f, 1.0 - af, 1.0 / f, af)]
    want = everything
    if want & {"MACDSIGNALFIX", "MACDHISTFIX"}:
        specs += [("_mxs", F.col("close"), 1, 26, 1.0 - 0.075, 1.0 / 26, 0.075),
                  ("_mxf", F.col("close"), 15, 12, 1.0 - 0.15, 1.0 / 12, 0.15)]
    if "ADOSC" in want:
        specs.append(("_ad", F.col("_clvv"), 1, 1, 1.0, 1.0, 1.0))
    if specs:
        fr = smooth_many(fr, specs)

    # ---- stage 3: values on the first-level recurrences
    steps = []
    for n in lags:
        want, g = at(n), _rn() > n
        need_rsi, need_di, need_atr = want & RSI_BASED, want & DI_BASED, want & ATR_BASED
        if need_rsi:
            ag, al = F.col(f"_ag{n}"), F.col(f"_al{n}")
            steps.append((f"_rsi{n}", F.when(ag.isNotNull(), sdiv(ag * 100.0, ag + al))))
            if "RSI" in want:
                steps.append((f"RSI_{n}", F.col(f"_rsi{n}")))
            if "CMO" in want:
                steps.append((f"CMO_{n}", F.when(ag.isNotNull(), sdiv((ag - al) * 100.0, ag + al))))
            if "STOCHRSI_k" in want:
                r = F.col(f"_rsi{n}")
                hi, lo = F.max(r).over(w.w(3)), F.min(r).over(w.w(3))
                steps.append((f"STOCHRSI_{n}k", F.when(_rn() > n + 3 - 1 + 3 - 1, sdiv((r - lo) * 100.0, hi - lo))))
        if need_di:
            sp, sm, st = F.col(f"_sp{n}"), F.col(f"_sm{n}"), F.col(f"_stt{n}")
            if "PLUS_DM" in want:
                steps.append((f"PLUS_DM_{n}", sp))
            if "MINUS_DM" in want:
                steps.append((f"MINUS_DM_{n}", sm))
            pdi = F.when(g, sdiv(sp * 100.0, st))
            mdi = F.when(g, sdiv(sm * 100.0, st))
            steps.append((f"_dxr{n}", F.when(pdi + mdi != 0, F.abs(pdi - mdi) * 100.0 / (pdi + mdi))))
        if need_atr:
            if "ATR" in want:
                steps.append((f"ATR_{n}", F.col(f"_atr{n}")))
            if "NATR" in want:
                steps.append((f"NATR_{n}", sdiv(F.col(f"_atr{n}") * 100.0, F.col("close"))))
        if want & {"MACDSIGNAL", "MACDHIST"}:
            steps.append((f"_mm{n}", F.col(f"_mef{n}") - F.col(f"_mes{n}")))
    want = everything
    if want & {"MACDSIGNALFIX", "MACDHISTFIX"}:
        steps.append(("_mmx", F.col("_mxf") - F.col("_mxs")))
    if steps:
        fr = fr.add(Feat(steps, 2 if "STOCHRSI_k" in want else 0))

    # ---- stage 4: DX repeats its previous value when the denominator is 0
    di_lags = [n for n in lags if at(n) & DI_BASED]
    if di_lags:
        fr = fr.ffill_many({f"_dxf{n}": F.col(f"_dxr{n}") for n in di_lags})
        fr = fr.with_columns(**{f"_dx{n}": F.when(_rn() > n, F.coalesce(F.col(f"_dxf{n}"), F.lit(0.0)))
                                for n in di_lags})

    # ---- stage 5: second-level recurrences
    specs = []
    for n in lags:
        want = at(n)
        if want & {"ADX", "ADXR"}:
            specs.append(_wmean_spec(f"_adx{n}", f"_dx{n}", n, n + 1))
        if want & {"MACDSIGNAL", "MACDHIST"}:
            specs.append(_ema_spec(f"_msg{n}", f"_mm{n}", int(n / 2), start=2 * n))
        if want & {"MACDSIGNALFIX", "MACDHISTFIX"}:
            specs.append(_ema_spec(f"_mxg{n}", "_mmx", n, start=26))
        if "ADOSC" in want:
            fa, sa = 2.0 / (n + 1), 2.0 / (3 * n + 1)
            specs += [(f"_aof{n}", F.col("_ad"), 1, 1, 1.0 - fa, 1.0, fa),
                      (f"_aos{n}", F.col("_ad"), 1, 1, 1.0 - sa, 1.0, sa)]
    if specs:
        fr = smooth_many(fr, specs)

    # ---- stage 6: final columns
    steps, halo = [], 0
    for n in lags:
        want = at(n)
        if "DX" in want:
            steps.append((f"DX_{n}", F.col(f"_dx{n}")))
        if "ADX" in want:
            steps.append((f"ADX_{n}", F.col(f"_adx{n}")))
        if "ADXR" in want:
            steps.append((f"ADXR_{n}", F.when(_rn() > 3 * n - 2, (F.col(f"_adx{n}") + w.lag(F.col(f"_adx{n}"), n - 1)) / 2.0)))
            halo = max(halo, n - 1)
        if "MACDSIGNAL" in want:
            steps.append((f"MACDSIGNAL_{n}", F.when(_rn() >= 2 * n + int(n / 2) - 1, F.col(f"_msg{n}"))))
        if "MACDSIGNALFIX" in want:
            steps.append((f"MACDSIGNALFIX_{n}", F.when(_rn() >= 26 + n - 1, F.col(f"_mxg{n}"))))
        if "MACDHIST" in want:
            steps.append((f"MACDHIST_{n}", F.when(_rn() >= 2 * n + int(n / 2) - 1, F.col(f"_mm{n}") - F.col(f"_msg{n}"))))
        if "MACDHISTFIX" in want:
            steps.append((f"MACDHISTFIX_{n}", F.when(_rn() >= 26 + n - 1, F.col("_mmx") - F.col(f"_mxg{n}"))))
        if "ADOSC" in want:
            steps.append((f"ADOSC_{n}", F.when(_rn() > 3 * n - 1, F.col(f"_aof{n}") - F.col(f"_aos{n}"))))
    if steps:
        fr = fr.add(Feat(steps, halo))

    return _finish(fr, dropna, sort)


def _array_stage(fr: BarFrame, w: Win, by_lag: dict[int, set[str]]) -> BarFrame:
    """Columns of all lags from one array a row; windows over recurrences (ADXR, stochastic RSI) come last."""
    from barloom.plans.feature_arrays import array_features

    got, names = array_features(fr, by_lag)
    cols = got.selectExpr(f"`{fr.key}`", "rn", *[f"f[{i}] AS `{n}`" for i, n in enumerate(names)])
    fr = fr.with_df(fr.df.join(cols, [fr.key, "rn"], "left"))
    steps, halo = [], 0
    for n, want in by_lag.items():
        if "ADXR" in want:
            x = F.col(f"_adx{n}")
            steps.append((f"ADXR_{n}", F.when(_rn() > 3 * n - 2, (x + w.lag(x, n - 1)) / 2.0)))
            halo = max(halo, n - 1)
        if "STOCHRSI_k" in want:
            r = F.col(f"_rsi{n}")
            hi, lo = F.max(r).over(w.w(3)), F.min(r).over(w.w(3))
            steps.append((f"STOCHRSI_{n}k", F.when(_rn() > n + 4, sdiv((r - lo) * 100.0, hi - lo))))
            halo = max(halo, 2)
    return fr.add(Feat(steps, halo)) if steps else fr


def _finish(fr: BarFrame, dropna: bool, sort: bool) -> BarFrame:
    """Bars and features only; rows with a NULL dropped and columns in order of name on request."""
    keep = [fr.key, *fr.order, "rn", "blk", "sblk", "open", "high", "low", "close", "volume"]
    feats = [c for c in fr.df.columns if not c.startswith("_") and c not in keep
             and not re.fullmatch(r"(o|c|h|l|bd|us|ls|rg|ab|ar|as|ar5)\d", c)]
    carried = [c for c in fr.df.columns if c.startswith("_kept_") or c in ("_old", "_last_old")]  # of a resumed frame
    df = fr.df.select(*[c for c in keep if c in fr.df.columns], *feats, *carried)
    if dropna:
        df = df.na.drop("any", subset=feats)
    if sort:
        df = df.select(*[c for c in keep if c in df.columns], *sorted(feats), *carried)
    return fr.with_df(df)


# ------------------------------------------------------------------ FP2 / FP3
NAME_RE = re.compile(r"(?:(\d+)_)?(\w+?)")
LAGGED_RE = re.compile(r"([A-Z_]+?)_(\d+)(slowk|fastk|k)?")


def parse_feature_names(text: str) -> list[str]:
    """FP2: ``idx_NAME`` entries (comma or newline separated) → column names in the order of idx.

    Without indexes the order is that of the list.  Repeated or mixed indexes raise."""
    found = []
    for tok in filter(None, (t.strip() for t in re.split(r"[,\n]+", text))):
        m = NAME_RE.fullmatch(tok)
        if not m:
            raise ValueError(f"bad feature name {tok!r}")
        found.append((int(m[1]) if m[1] else None, m[2]))
    idx = [i for i, _ in found if i is not None]
    if len(idx) not in (0, len(found)) or len(set(idx)) != len(idx):
        raise ValueError("feature indexes must be given for all names or none, each once")
    return [n for _, n in sorted(found, key=lambda f: f[0] or 0)]


def plan_for_names(names: list[str]) -> dict:
    """FP3: what :func:`generate_all_features` must build for these columns; unknown names raise."""
    plan = {"pairs": [], "patterns": [], "time": [], "cycle": []}
    for name in names:
        if name in PT.ALL_PATTERNS:
            plan["patterns"].append(name)
        elif name in TIME:
            plan["time"].append(name)
        elif name in CYCLE_OUTPUTS:
            plan["cycle"].append(name)
        else:
            m = LAGGED_RE.fullmatch(name)
            base = f"{m[1]}_{m[3]}" if m and m[3] else m[1] if m else None
            if base not in VOLUME + MOMENTUM + MATH + EXTRA or int(m[2]) < 2:
                raise ValueError(f"unknown feature {name!r}")
            plan["pairs"].append((base, int(m[2])))
    return plan


def features_for_names(fr: BarFrame, text: str, pattern_wma: int | None = 300, dropna: bool = True) -> BarFrame:
    """Exactly the features named in ``text`` (the list written at training time), in its order.

    ``pattern_wma=None`` feeds the raw pattern values, as the live path does."""
    names = parse_feature_names(text)
    given = [c for c in fr.df.columns]
    out = generate_all_features(fr, pattern_wma=pattern_wma, dropna=False, sort=False, **plan_for_names(names))
    carried = [c for c in out.df.columns if c.startswith("_kept_")]  # of a resumed frame: its scans go on from these
    df = out.df.select(*[c for c in given if c in out.df.columns and c not in names and c not in carried],
                       *dict.fromkeys(names), *carried)
    return out.with_df(df.na.drop("any", subset=names) if dropna else df)
