"""Row-wise (class X) and finite-window (class F) indicators.

Each builder returns a :class:`Feat`: ordered ``(name, Column)`` steps plus the
number of earlier rows (``halo``) the last step needs.  Add them to a frame with
``BarFrame.add(...)``; all windows of one ``add`` share one partitioning and
sort.  Outputs are NULL until ``LB`` earlier rows exist (``rn > LB``), because
Spark would otherwise return partial-frame values.

Notation: ``c, h, l, o, v`` = close, high, low, open, volume.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.plans.frame import Win



def _rn() -> Column:
    return F.col("rn")


@dataclass
class Feat:
    steps: list = field(default_factory=list)
    halo: int = 0
    ahead: int = 0

    @property
    def outputs(self) -> list[str]:
        return [n for n, _ in self.steps if not n.startswith("_")]

    def __add__(self, other: "Feat") -> "Feat":
        return Feat(self.steps + other.steps, max(self.halo, other.halo), max(self.ahead, other.ahead))


def combine(*feats: Feat) -> Feat:
    out = Feat()
    for f in feats:
        out = out + f
    return out


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def guard(value: Column, lb: int) -> Column:
    """NULL until ``lb`` earlier rows exist."""
    return F.when(_rn() > F.lit(int(lb)), value)


def sdiv(a: Column, b: Column, zero=0.0) -> Column:
    """a / b, with ``zero`` (a value or None) when b = 0."""
    z = F.lit(zero) if zero is not None else F.lit(None).cast("double")
    return F.when(b != 0, a / b).otherwise(z)


def pct(a: Column, b: Column, zero=None) -> Column:
    """100·(a/b − 1), with ``zero`` (a value or None) when b = 0."""
    z = F.lit(zero) if zero is not None else F.lit(None).cast("double")
    return F.when(b != 0, (a / b - 1.0) * 100.0).otherwise(z)


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate expression; NULL (not an error) when a
    variance is 0 — ``corr`` itself divides by zero under ANSI mode."""
    xm = F.when(y.isNotNull(), x)   # pairwise-complete rows, as corr uses
    ym = F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def _nm(name, default):
    return name or default


# ============================================================== class X (row-wise)
def avgprice(o="open", h="high", l="low", c="close", out="AVGPRICE") -> Feat:
    return Feat([(out, (col(o) + col(h) + col(l) + col(c)) / 4.0)])


def medprice(h="high", l="low", out="MEDPRICE") -> Feat:
    return Feat([(out, (col(h) + col(l)) / 2.0)])


def typprice(h="high", l="low", c="close", out="TYPPRICE") -> Feat:
    return Feat([(out, (col(h) + col(l) + col(c)) / 3.0)])


def wclprice(h="high", l="low", c="close", out="WCLPRICE") -> Feat:
    return Feat([(out, (col(h) + col(l) + col(c) * 2.0) / 4.0)])


def bop(o="open", h="high", l="low", c="close", out="BOP") -> Feat:
    return Feat([(out, sdiv(col(c) - col(o), col(h) - col(l)))])


# domain of each math transform; outside it the result is NULL (never NaN)
_MATH = {
    "ACOS": (F.acos, lambda x: (x >= -1) & (x <= 1)),
    "ASIN": (F.asin, lambda x: (x >= -1) & (x <= 1)),
    "ATAN": (F.atan, None),
    "CEIL": (lambda x: F.ceil(x).cast("double"), None),
    "COS": (F.cos, None),
    "COSH": (F.cosh, lambda x: F.abs(x) <= 700),
    "EXP": (F.exp, lambda x: x <= 700),
    "FLOOR": (lambda x: F.floor(x).cast("double"), None),
    "LN": (F.log, lambda x: x > 0),
    "LOG10": (F.log10, lambda x: x > 0),
    "SIN": (F.sin, None),
    "SINH": (F.sinh, lambda x: F.abs(x) <= 700),
    "SQRT": (F.sqrt, lambda x: x >= 0),
    "TAN": (F.tan, None),
    "TANH": (F.tanh, None),
}


def math_transform(name: str, x="close", out=None) -> Feat:
    fn, dom = _MATH[name.upper()]
    xc = col(x)
    val = fn(xc) if dom is None else F.when(dom(xc), fn(xc))
    return Feat([(_nm(out, name.upper()), val)])


def math_operator(name: str, a="high", b="low", out=None) -> Feat:
    a, b = col(a), col(b)
    name = name.upper()
    val = {"ADD": a + b, "SUB": a - b, "MULT": a * b, "DIV": sdiv(a, b, None)}[name]
    return Feat([(_nm(out, name), val)])


# ============================================================ class F (finite windows)
def sma(w: Win, x="close", n=30, out=None) -> Feat:
    return Feat([(_nm(out, f"SMA_{n}"), guard(F.avg(col(x)).over(w.w(n)), n - 1))], n - 1)


def wma(w: Win, x="close", n=30, out=None) -> Feat:
    """Σ k·x_k / (n(n+1)/2) via two window sums over block-local positions."""
    p = w.pos
    s1 = F.sum(col(x) * p).over(w.w(n))
    s0 = F.sum(col(x)).over(w.w(n))
    val = (s1 - (p - F.lit(float(n))) * s0) / F.lit(n * (n + 1) / 2.0)
    return Feat([(_nm(out, f"WMA_{n}"), guard(val, n - 1))], n - 1)


def trima(w: Win, x="close", n=30, out=None) -> Feat:
    if n % 2:
        a = b = (n + 1) // 2
    else:
        a, b = n // 2, n // 2 + 1
    tmp = f"_trima1_{x}_{n}"
    return Feat([(tmp, F.avg(col(x)).over(w.w(a))),
                 (_nm(out, f"TRIMA_{n}"), guard(F.avg(F.col(tmp)).over(w.w(b)), n - 1))], n - 1)


def bbands(w: Win, x="close", n=5, nbdevup=2.0, nbdevdn=2.0, prefix=None) -> Feat:
    p = prefix or f"BBANDS_{n}"
    m = F.avg(col(x)).over(w.w(n))
    sd = F.stddev_pop(col(x)).over(w.w(n))
    return Feat([(f"{p}_upper", guard(m + sd * nbdevup, n - 1)),
                 (f"{p}_middle", guard(m, n - 1)),
                 (f"{p}_lower", guard(m - sd * nbdevdn, n - 1))], n - 1)


def midpoint(w: Win, x="close", n=14, out=None) -> Feat:
    v = (F.max(col(x)).over(w.w(n)) + F.min(col(x)).over(w.w(n))) / 2.0
    return Feat([(_nm(out, f"MIDPOINT_{n}"), guard(v, n - 1))], n - 1)


def midprice(w: Win, h="high", l="low", n=14, out=None) -> Feat:
    v = (F.max(col(h)).over(w.w(n)) + F.min(col(l)).over(w.w(n))) / 2.0
    return Feat([(_nm(out, f"MIDPRICE_{n}"), guard(v, n - 1))], n - 1)


def mom(w: Win, x="close", n=10, out=None) -> Feat:
    return Feat([(_nm(out, f"MOM_{n}"), guard(col(x) - w.lag(col(x), n), n))], n)


def roc(w: Win, x="close", n=10, out=None) -> Feat:
    prev = w.lag(col(x), n)
    return Feat([(_nm(out, f"ROC_{n}"), guard(pct(col(x), prev, 0.0), n))], n)


def rocr(w: Win, x="close", n=10, out=None) -> Feat:
    prev = w.lag(col(x), n)
    return Feat([(_nm(out, f"ROCR_{n}"), guard(sdiv(col(x), prev), n))], n)


def apo(w: Win, x="close", fast=12, slow=26, out=None) -> Feat:
    lb = max(fast, slow) - 1
    v = F.avg(col(x)).over(w.w(fast)) - F.avg(col(x)).over(w.w(slow))
    return Feat([(_nm(out, f"APO_{fast}_{slow}"), guard(v, lb))], lb)


def ppo(w: Win, x="close", fast=12, slow=26, out=None) -> Feat:
    lb = max(fast, slow) - 1
    s = F.avg(col(x)).over(w.w(slow))
    v = sdiv((F.avg(col(x)).over(w.w(fast)) - s) * 100.0, s)
    return Feat([(_nm(out, f"PPO_{fast}_{slow}"), guard(v, lb))], lb)


def macdext_sma(w: Win, x="close", fast=12, slow=26, signal=9, prefix=None) -> Feat:
    """MACD with simple moving averages (MACDEXT with SMA types)."""
    p = prefix or f"MACDEXT_{fast}_{slow}_{signal}"
    lb = max(fast, slow) - 1 + signal - 1
    m = f"_{p}_m"
    return Feat([(m, F.avg(col(x)).over(w.w(fast)) - F.avg(col(x)).over(w.w(slow))),
                 (f"{p}_signal", guard(F.avg(F.col(m)).over(w.w(signal)), lb)),
                 (f"{p}_macd", guard(F.col(m), lb)),
                 (f"{p}_hist", guard(F.col(m) - F.avg(F.col(m)).over(w.w(signal)), lb))], lb)


def _fastk(w: Win, h, l, c, n):
    hh = F.max(col(h)).over(w.w(n))
    ll = F.min(col(l)).over(w.w(n))
    return sdiv((col(c) - ll) * 100.0, hh - ll)


def stochf(w: Win, h="high", l="low", c="close", fastk=5, fastd=3, prefix=None) -> Feat:
    p = prefix or f"STOCHF_{fastk}_{fastd}"
    lb = fastk - 1 + fastd - 1
    k = f"_{p}_k"
    return Feat([(k, _fastk(w, h, l, c, fastk)),
                 (f"{p}_fastk", guard(F.col(k), lb)),
                 (f"{p}_fastd", guard(F.avg(F.col(k)).over(w.w(fastd)), lb))], lb)


def stoch(w: Win, h="high", l="low", c="close", fastk=5, slowk=3, slowd=3, prefix=None) -> Feat:
    p = prefix or f"STOCH_{fastk}_{slowk}_{slowd}"
    lb = fastk - 1 + slowk - 1 + slowd - 1
    k, sk = f"_{p}_k", f"_{p}_sk"
    return Feat([(k, _fastk(w, h, l, c, fastk)),
                 (sk, F.avg(F.col(k)).over(w.w(slowk))),
                 (f"{p}_slowk", guard(F.col(sk), lb)),
                 (f"{p}_slowd", guard(F.avg(F.col(sk)).over(w.w(slowd)), lb))], lb)


def willr(w: Win, h="high", l="low", c="close", n=14, out=None) -> Feat:
    hh = F.max(col(h)).over(w.w(n))
    ll = F.min(col(l)).over(w.w(n))
    return Feat([(_nm(out, f"WILLR_{n}"), guard(sdiv((hh - col(c)) * -100.0, hh - ll), n - 1))], n - 1)


def cci(w: Win, h="high", l="low", c="close", n=14, out=None) -> Feat:
    tp = f"_tp_{h}_{l}_{c}"
    sm = F.avg(F.col(tp)).over(w.w(n))
    lst = F.collect_list(F.col(tp)).over(w.w(n))
    mad = F.aggregate(lst, F.lit(0.0), lambda acc, v: acc + F.abs(v - sm)) / F.lit(float(n))
    val = F.when((mad == 0) | (F.col(tp) - sm == 0), F.lit(0.0)).otherwise((F.col(tp) - sm) / (mad * 0.015))
    return Feat([(tp, (col(h) + col(l) + col(c)) / 3.0),
                 (_nm(out, f"CCI_{n}"), guard(val, n - 1))], n - 1)


def _bars_since_extreme(w: Win, x: Column, n: int, highest: bool) -> Column:
    key = F.struct(x if highest else -x, _rn())
    at = F.max_by(_rn(), key).over(w.span(-n, 0))
    return _rn() - at


def aroon(w: Win, h="high", l="low", n=14, prefix=None) -> Feat:
    p = prefix or f"AROON_{n}"
    up = (F.lit(float(n)) - _bars_since_extreme(w, col(h), n, True)) * (100.0 / n)
    dn = (F.lit(float(n)) - _bars_since_extreme(w, col(l), n, False)) * (100.0 / n)
    return Feat([(f"{p}_aroondown", guard(dn, n)), (f"{p}_aroonup", guard(up, n))], n)


def aroonosc(w: Win, h="high", l="low", n=14, out=None) -> Feat:
    up = (F.lit(float(n)) - _bars_since_extreme(w, col(h), n, True)) * (100.0 / n)
    dn = (F.lit(float(n)) - _bars_since_extreme(w, col(l), n, False)) * (100.0 / n)
    return Feat([(_nm(out, f"AROONOSC_{n}"), guard(up - dn, n))], n)


def mfi(w: Win, h="high", l="low", c="close", v="volume", n=14, out=None) -> Feat:
    tp = f"_tp_{h}_{l}_{c}"
    prev = w.lag(F.col(tp), 1)
    flow = F.col(tp) * col(v)
    pos = F.sum(F.when(F.col(tp) > prev, flow).otherwise(0.0)).over(w.w(n))
    neg = F.sum(F.when(F.col(tp) < prev, flow).otherwise(0.0)).over(w.w(n))
    val = F.when(pos + neg < 1.0, F.lit(0.0)).otherwise(pos * 100.0 / (pos + neg))
    return Feat([(tp, (col(h) + col(l) + col(c)) / 3.0), (_nm(out, f"MFI_{n}"), guard(val, n))], n)


def trange(w: Win, h="high", l="low", c="close", out="TRANGE") -> Feat:
    pc = w.lag(col(c), 1)
    v = F.greatest(col(h) - col(l), F.abs(col(h) - pc), F.abs(col(l) - pc))
    return Feat([(out, guard(v, 1))], 1)


def ultosc(w: Win, h="high", l="low", c="close", p1=7, p2=14, p3=28, out=None) -> Feat:
    pc = w.lag(col(c), 1)
    bp, tr = f"_uo_bp_{c}", f"_uo_tr_{c}"
    lb = max(p1, p2, p3)

    def avg(n):
        return sdiv(F.sum(F.col(bp)).over(w.w(n)), F.sum(F.col(tr)).over(w.w(n)))

    val = (avg(p1) * 4.0 + avg(p2) * 2.0 + avg(p3)) * (100.0 / 7.0)
    return Feat([(bp, col(c) - F.least(col(l), pc)),
                 (tr, F.greatest(col(h), pc) - F.least(col(l), pc)),
                 (_nm(out, f"ULTOSC_{p1}_{p2}_{p3}"), guard(val, lb))], lb)


def beta(w: Win, x="high", y="low", n=5, out=None) -> Feat:
    rx, ry = f"_ret_{x}", f"_ret_{y}"
    px, py = w.lag(col(x), 1), w.lag(col(y), 1)
    rxm = F.when(F.col(ry).isNotNull(), F.col(rx))
    vx = F.var_pop(rxm).over(w.w(n))
    slope = F.try_divide(F.covar_pop(F.col(ry), rxm).over(w.w(n)), vx)
    val = F.when(vx > 0, slope).otherwise(0.0)
    return Feat([(rx, sdiv(col(x), px, None) - 1.0), (ry, sdiv(col(y), py, None) - 1.0),
                 (_nm(out, f"BETA_{n}"), guard(val, n))], n)


def correl(w: Win, x="high", y="low", n=30, out=None) -> Feat:
    sx = F.stddev_pop(col(x)).over(w.w(n))
    sy = F.stddev_pop(col(y)).over(w.w(n))
    cv = F.covar_pop(col(x), col(y)).over(w.w(n))
    val = F.when((sx > 0) & (sy > 0), F.try_divide(cv, sx * sy)).otherwise(0.0)
    return Feat([(_nm(out, f"CORREL_{n}"), guard(val, n - 1))], n - 1)


def _regr(w: Win, x, n):
    """Least-squares line of x on the block-local position over the last n rows
    (covariance / variance, so a degenerate window gives NULL, not an error)."""
    p = w.pos
    pm = F.when(col(x).isNotNull(), p)   # pairwise-complete rows
    slope = F.try_divide(F.covar_pop(col(x), pm).over(w.w(n)), F.var_pop(pm).over(w.w(n)))
    icpt = F.avg(col(x)).over(w.w(n)) - slope * F.avg(pm).over(w.w(n))
    return slope, icpt, p


def linearreg(w: Win, x="close", n=14, out=None) -> Feat:
    s, i, p = _regr(w, x, n)
    return Feat([(_nm(out, f"LINEARREG_{n}"), guard(i + s * p, n - 1))], n - 1)


def linearreg_slope(w: Win, x="close", n=14, out=None) -> Feat:
    s, _, _ = _regr(w, x, n)
    return Feat([(_nm(out, f"LINEARREG_SLOPE_{n}"), guard(s, n - 1))], n - 1)


def linearreg_angle(w: Win, x="close", n=14, out=None) -> Feat:
    s, _, _ = _regr(w, x, n)
    return Feat([(_nm(out, f"LINEARREG_ANGLE_{n}"), guard(F.degrees(F.atan(s)), n - 1))], n - 1)


def linearreg_intercept(w: Win, x="close", n=14, out=None) -> Feat:
    s, i, p = _regr(w, x, n)
    return Feat([(_nm(out, f"LINEARREG_INTERCEPT_{n}"), guard(i + s * (p - float(n - 1)), n - 1))], n - 1)


def tsf(w: Win, x="close", n=14, out=None) -> Feat:
    s, i, p = _regr(w, x, n)
    return Feat([(_nm(out, f"TSF_{n}"), guard(i + s * (p + 1.0), n - 1))], n - 1)


def stddev(w: Win, x="close", n=5, nbdev=1.0, out=None) -> Feat:
    return Feat([(_nm(out, f"STDDEV_{n}"), guard(F.stddev_pop(col(x)).over(w.w(n)) * nbdev, n - 1))], n - 1)


def var(w: Win, x="close", n=5, out=None) -> Feat:
    return Feat([(_nm(out, f"VAR_{n}"), guard(F.var_pop(col(x)).over(w.w(n)), n - 1))], n - 1)


def rmax(w: Win, x="close", n=30, out=None) -> Feat:
    return Feat([(_nm(out, f"MAX_{n}"), guard(F.max(col(x)).over(w.w(n)), n - 1))], n - 1)


def rmin(w: Win, x="close", n=30, out=None) -> Feat:
    return Feat([(_nm(out, f"MIN_{n}"), guard(F.min(col(x)).over(w.w(n)), n - 1))], n - 1)


def minmax(w: Win, x="close", n=30, prefix=None) -> Feat:
    p = prefix or f"MINMAX_{n}"
    return Feat([(f"{p}_min", guard(F.min(col(x)).over(w.w(n)), n - 1)),
                 (f"{p}_max", guard(F.max(col(x)).over(w.w(n)), n - 1))], n - 1)


def _argext(w: Win, x, n, highest):
    key = F.struct(col(x) if highest else -col(x), _rn())
    return F.max_by(_rn(), key).over(w.w(n)) - 1  # 0-based absolute index, ties -> latest


def maxindex(w: Win, x="close", n=30, out=None) -> Feat:
    return Feat([(_nm(out, f"MAXINDEX_{n}"), guard(_argext(w, x, n, True), n - 1))], n - 1)


def minindex(w: Win, x="close", n=30, out=None) -> Feat:
    return Feat([(_nm(out, f"MININDEX_{n}"), guard(_argext(w, x, n, False), n - 1))], n - 1)


def minmaxindex(w: Win, x="close", n=30, prefix=None) -> Feat:
    p = prefix or f"MINMAXINDEX_{n}"
    return Feat([(f"{p}_minidx", guard(_argext(w, x, n, False), n - 1)),
                 (f"{p}_maxidx", guard(_argext(w, x, n, True), n - 1))], n - 1)


def rsum(w: Win, x="close", n=30, out=None) -> Feat:
    return Feat([(_nm(out, f"SUM_{n}"), guard(F.sum(col(x)).over(w.w(n)), n - 1))], n - 1)


def pct_change(w: Win, x="close", k=10, out=None) -> Feat:
    prev = w.lag(col(x), k)
    return Feat([(_nm(out, f"{x}_change"), guard(sdiv(col(x), prev, None) - 1.0, k))], k)


def shift(w: Win, x="close", k=1, out=None) -> Feat:
    """K > 0 = value k rows back (lag); k < 0 = value -k rows ahead (lead)."""
    if k >= 0:
        return Feat([(_nm(out, f"{x}_lag{k}"), w.lag(col(x), k))], k)
    return Feat([(_nm(out, f"{x}_lead{-k}"), w.lead(col(x), -k))], 0, -k)


def return_vector(w: Win, h="high", l="low", n=30, out="medret_vec") -> Feat:
    """Last ``n`` one-bar % returns of the median price, oldest first."""
    m = (col(h) + col(l)) / 2.0
    r = f"_medret_{n}"
    prev = w.lag(m, 1)
    return Feat([(r, pct(m, prev)),
                 (out, guard(F.collect_list(F.col(r)).over(w.w(n)), n))], n)


def log_return(w: Win, x="close", length=1, offset=0, out=None) -> Feat:
    """ln(x / x₋length), shifted by ``offset`` rows (negative = future)."""
    lr = f"_lr_{x}_{length}"
    prev = w.lag(col(x), length)
    base = F.when((col(x) > 0) & (prev > 0), F.log(col(x) / prev))
    name = _nm(out, f"LOGRET_{length}_{offset}")
    if offset > 0:
        return Feat([(lr, base), (name, w.lag(F.col(lr), offset))], length + offset)
    if offset < 0:
        return Feat([(lr, base), (name, w.lead(F.col(lr), -offset))], length, -offset)
    return Feat([(name, base)], length)


def residual_ratio(w: Win, x="close", n=25, m=25, prefix=None) -> Feat:
    """Σ over ``m`` rows of (x − LINEARREG_n)² and (x − SMA_n)², and their ratio."""
    p = prefix or f"RSS_{n}_{m}"
    s, i, pos = _regr(w, x, n)
    e1, e2 = f"_{p}_e1", f"_{p}_e2"
    lb = n - 1 + m - 1
    return Feat([(e1, guard(F.pow(col(x) - (i + s * pos), 2), n - 1)),
                 (e2, guard(F.pow(col(x) - F.avg(col(x)).over(w.w(n)), 2), n - 1)),
                 (f"{p}_reg", guard(F.sum(F.col(e1)).over(w.w(m)), lb)),
                 (f"{p}_sma", guard(F.sum(F.col(e2)).over(w.w(m)), lb)),
                 (f"{p}_ratio", guard(sdiv(F.sum(F.col(e1)).over(w.w(m)), F.sum(F.col(e2)).over(w.w(m)), None), lb))],
                lb)


def trend_score(w: Win, x="close", n=25, out=None) -> Feat:
    """10000 · slope · R² of x/x_first against 1..n."""
    p = w.pos
    first = F.first(col(x)).over(w.w(n))
    pm = F.when(col(x).isNotNull(), p)
    slope = F.try_divide(F.covar_pop(col(x), pm).over(w.w(n)), F.var_pop(pm).over(w.w(n)))
    r2 = F.pow(F.try_divide(F.covar_pop(col(x), pm).over(w.w(n)),
                            F.stddev_pop(col(x)).over(w.w(n)) * F.stddev_pop(pm).over(w.w(n))), 2)
    val = sdiv(slope, first, None) * F.coalesce(r2, F.lit(0.0)) * 10000.0
    return Feat([(_nm(out, f"TREND_{n}"), guard(val, n - 1))], n - 1)


def diff_ratio(w: Win, x="close", k=10, out=None) -> Feat:
    """(x − x₋k) / x."""
    return Feat([(_nm(out, f"DIFFR_{k}"), guard(sdiv(col(x) - w.lag(col(x), k), col(x), None), k))], k)


def rolling_sum(w: Win, x, n=10, out=None) -> Feat:
    """Rolling sum (e.g. of predictions)."""
    return Feat([(_nm(out, f"{x}_rsum{n}"), guard(F.sum(col(x)).over(w.w(n)), n - 1))], n - 1)
