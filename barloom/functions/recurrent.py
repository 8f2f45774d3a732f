"""Recurrent indicators (classes C and L) built on the block-wise linear scan.

Every smoother here is ``y_t = d_t·y_{t-1} + x_t``.  Seeds (an SMA of the
first n values, a sum of the first n−1, or the first value) are part of the
same scan: during the seed rows ``d = 1`` and the contribution is the seed
weight times the input; afterwards ``d`` and the weight are the smoother's.
So one scan per smoothed series, no extra pass for the seed.

Functions take and return a :class:`BarFrame`.  ``start`` is the first row
(1-based ``rn``) where the input is defined; each output is NULL before its
lookback.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.finite import Feat, col, pct, sdiv
from barloom.plans.frame import BarFrame, Win


def _rn() -> Column:
    return F.col("rn")


def smooth_many(fr: BarFrame, specs: list[tuple]) -> BarFrame:
    """Several independent seeded smoothers in one scan pass.

    A NULL at or after ``start`` raises: a smoother cannot skip a bar silently.
    Each spec is ``(out, x, start, seed_len, d, w_seed, w_after)``; output is
    defined from ``start + seed_len − 1``."""
    rn = _rn()
    scans, posts = [], []
    for out, x, start, seed_len, d, w_seed, w_after in specs:
        seed_end = start + seed_len - 1
        known = F.when(col(x).isNull(), F.raise_error(F.lit(f"NULL inside the series of {out}"))).otherwise(col(x))
        contrib = (F.when(rn < start, F.lit(0.0))
                   .when(rn <= seed_end, known * F.lit(float(w_seed)))
                   .otherwise(known * F.lit(float(w_after))))
        tmp = f"_{out}_raw"
        scans.append(dict(out=tmp, x=contrib, d=float(d), d_from=None if d == 1.0 else seed_end + 1))
        posts.append((out, seed_end, tmp))
    fr = fr.scan_many(scans)
    df = fr.df.withColumns({out: F.when(rn >= seed_end, F.col(tmp)) for out, seed_end, tmp in posts})
    return fr.with_df(df.drop(*[tmp for _, _, tmp in posts]))


def smooth(fr: BarFrame, out: str, x: Column, start: int, seed_len: int, d: float,
           w_seed: float, w_after: float) -> BarFrame:
    """Generic seeded smoother; output defined from ``start + seed_len − 1``."""
    return smooth_many(fr, [(out, x, start, seed_len, d, w_seed, w_after)])


def _ema_spec(out, x, n, start=1, alpha=None):
    a = alpha if alpha is not None else 2.0 / (n + 1)
    return (out, col(x), start, n, 1.0 - a, 1.0 / n, a)


def _wmean_spec(out, x, n, start=1):
    return (out, col(x), start, n, (n - 1) / n, 1.0 / n, 1.0 / n)


def _wsum_spec(out, x, n, start=1):
    return (out, col(x), start, n - 1, (n - 1) / n, 1.0, 1.0)


def ema(fr: BarFrame, x="close", n=30, out=None, start=1, alpha=None) -> BarFrame:
    """W2 EMA(n): α = 2/(n+1) (or given), seeded by the SMA of the first n values."""
    a = alpha if alpha is not None else 2.0 / (n + 1)
    return smooth(fr, out or f"EMA_{n}", col(x), start, n, 1.0 - a, 1.0 / n, a)


def wilder_mean(fr: BarFrame, x, n, out, start=1) -> BarFrame:
    """Wilder average: seed = mean of first n, then (y·(n−1) + x)/n."""
    return smooth(fr, out, col(x), start, n, (n - 1) / n, 1.0 / n, 1.0 / n)


def wilder_sum(fr: BarFrame, x, n, out, start=1) -> BarFrame:
    """Wilder running sum: seed = sum of first n−1, then y − y/n + x."""
    return smooth(fr, out, col(x), start, n - 1, (n - 1) / n, 1.0, 1.0)


def dema(fr: BarFrame, x="close", n=30, out=None) -> BarFrame:
    """2·E − E(E)."""
    e1, e2 = f"_dema1_{n}", f"_dema2_{n}"
    fr = ema(fr, x, n, e1)
    fr = ema(fr, e1, n, e2, start=n)
    return fr.with_df(fr.df.withColumn(out or f"DEMA_{n}", F.col(e1) * 2.0 - F.col(e2)).drop(e1, e2))


def tema(fr: BarFrame, x="close", n=30, out=None) -> BarFrame:
    """3·E − 3·E² + E³ (nested EMAs)."""
    e1, e2, e3 = f"_tema1_{n}", f"_tema2_{n}", f"_tema3_{n}"
    fr = ema(fr, x, n, e1)
    fr = ema(fr, e1, n, e2, start=n)
    fr = ema(fr, e2, n, e3, start=2 * n - 1)
    v = F.col(e1) * 3.0 - F.col(e2) * 3.0 + F.col(e3)
    return fr.with_df(fr.df.withColumn(out or f"TEMA_{n}", v).drop(e1, e2, e3))


def t3(fr: BarFrame, x="close", n=5, vfactor=0.7, out=None) -> BarFrame:
    """Six chained EMAs combined with Tillson's coefficients."""
    v = vfactor
    c1 = -v ** 3
    c2 = 3 * v ** 2 + 3 * v ** 3
    c3 = -6 * v ** 2 - 3 * v - 3 * v ** 3
    c4 = 1 + 3 * v + v ** 3 + 3 * v ** 2
    names = [f"_t3e{i}_{n}" for i in range(1, 7)]
    src, start = x, 1
    for nm in names:
        fr = ema(fr, src, n, nm, start=start)
        src, start = nm, start + n - 1
    e3, e4, e5, e6 = (F.col(names[i]) for i in (2, 3, 4, 5))
    val = e6 * c1 + e5 * c2 + e4 * c3 + e3 * c4
    return fr.with_df(fr.df.withColumn(out or f"T3_{n}", val).drop(*names))


def trix(fr: BarFrame, x="close", n=30, out=None) -> BarFrame:
    """1-bar rate of change (%) of the triple EMA."""
    names = [f"_trix{i}_{n}" for i in (1, 2, 3)]
    src, start = x, 1
    for nm in names:
        fr = ema(fr, src, n, nm, start=start)
        src, start = nm, start + n - 1
    w = Win(fr.key, fr.block)
    e3 = F.col(names[2])
    prev = w.lag(e3, 1)
    lb = 3 * (n - 1) + 1
    val = F.when(_rn() > lb, pct(e3, prev, 0.0))
    fr = fr.add(Feat([(out or f"TRIX_{n}", val)], 1))
    return fr.drop(*names)


def kama(fr: BarFrame, x="close", n=30, out=None) -> BarFrame:
    """Kaufman adaptive MA; seed = x at row n, output from row n+1."""
    w = Win(fr.key, fr.block)
    xc = col(x)
    ad = f"_kama_ad_{n}"
    er = f"_kama_er_{n}"
    fr = fr.add(Feat([(ad, F.abs(xc - w.lag(xc, 1))),
                      (er, F.when(_rn() > n, F.least(F.lit(1.0), sdiv(F.abs(xc - w.lag(xc, n)),
                                                                        F.sum(F.col(ad)).over(w.w(n)), 1.0))))], n))
    fast, slow = 2.0 / 3.0, 2.0 / 31.0
    sc = F.pow(F.col(er) * (fast - slow) + slow, 2)
    rn = _rn()
    contrib = F.when(rn < n, F.lit(0.0)).when(rn == n, xc).otherwise(sc * xc)
    d = F.when(rn > n, F.lit(1.0) - sc).otherwise(F.lit(1.0))
    raw = f"_kama_raw_{n}"
    fr = fr.scan(raw, contrib, d, d_min=1.0 - fast ** 2)
    return fr.with_df(fr.df.withColumn(out or f"KAMA_{n}", F.when(rn > n, F.col(raw))).drop(ad, er, raw))


def macd(fr: BarFrame, x="close", fast=12, slow=26, signal=9, prefix=None,
         alpha_fast=None, alpha_slow=None) -> BarFrame:
    """Both EMAs start at row ``slow`` (fast seeded by the SMA of the
    ``fast`` rows ending there); signal = EMA(signal) of the MACD line."""
    if fast > slow:
        fast, slow = slow, fast
    p = prefix or f"MACD_{fast}_{slow}_{signal}"
    af = alpha_fast if alpha_fast is not None else 2.0 / (fast + 1)
    as_ = alpha_slow if alpha_slow is not None else 2.0 / (slow + 1)
    ef, es, m = f"_{p}_ef", f"_{p}_es", f"_{p}_m"
    fr = smooth_many(fr, [(es, col(x), 1, slow, 1.0 - as_, 1.0 / slow, as_),
                          (ef, col(x), slow - fast + 1, fast, 1.0 - af, 1.0 / fast, af)])
    fr = fr.with_df(fr.df.withColumn(m, F.col(ef) - F.col(es)))
    sg = f"_{p}_sig"
    fr = ema(fr, m, signal, sg, start=slow)
    lb_row = slow + signal - 1
    g = F.col("rn") >= lb_row
    df = (fr.df.withColumn(f"{p}_macd", F.when(g, F.col(m)))
          .withColumn(f"{p}_signal", F.when(g, F.col(sg)))
          .withColumn(f"{p}_hist", F.when(g, F.col(m) - F.col(sg)))
          .drop(ef, es, m, sg))
    return fr.with_df(df)


def macdfix(fr: BarFrame, x="close", signal=9, prefix=None) -> BarFrame:
    """MACD 12/26 with fixed α 0.15 / 0.075."""
    return macd(fr, x, 12, 26, signal, prefix or f"MACDFIX_{signal}", alpha_fast=0.15, alpha_slow=0.075)


def _gain_loss(fr: BarFrame, x, tag):
    w = Win(fr.key, fr.block)
    dx = col(x) - w.lag(col(x), 1)
    g, l_ = f"_g_{tag}", f"_l_{tag}"
    fr = fr.add(Feat([(g, F.greatest(dx, F.lit(0.0))), (l_, F.greatest(-dx, F.lit(0.0)))], 1))
    return fr, g, l_


def rsi(fr: BarFrame, x="close", n=14, out=None) -> BarFrame:
    """Wilder RSI; 0 when gains and losses are both 0."""
    fr, g, l_ = _gain_loss(fr, x, f"rsi{n}")
    ag, al = f"_ag_rsi{n}", f"_al_rsi{n}"
    fr = smooth_many(fr, [_wmean_spec(ag, g, n, 2), _wmean_spec(al, l_, n, 2)])
    val = sdiv(F.col(ag) * 100.0, F.col(ag) + F.col(al))
    return fr.with_df(fr.df.withColumn(out or f"RSI_{n}", F.when(F.col(ag).isNotNull(), val))
                      .drop(g, l_, ag, al))


def cmo(fr: BarFrame, x="close", n=14, out=None) -> BarFrame:
    """100·(G − L)/(G + L) with RSI's smoothing."""
    fr, g, l_ = _gain_loss(fr, x, f"cmo{n}")
    ag, al = f"_ag_cmo{n}", f"_al_cmo{n}"
    fr = smooth_many(fr, [_wmean_spec(ag, g, n, 2), _wmean_spec(al, l_, n, 2)])
    val = sdiv((F.col(ag) - F.col(al)) * 100.0, F.col(ag) + F.col(al))
    return fr.with_df(fr.df.withColumn(out or f"CMO_{n}", F.when(F.col(ag).isNotNull(), val))
                      .drop(g, l_, ag, al))


def stochrsi(fr: BarFrame, x="close", n=14, fastk=5, fastd=3, prefix=None) -> BarFrame:
    """Fast stochastic of RSI(n); both outputs from row n + fastk + fastd − 1."""
    p = prefix or f"STOCHRSI_{n}_{fastk}_{fastd}"
    r = f"_{p}_rsi"
    fr = rsi(fr, x, n, r)
    w = Win(fr.key, fr.block)
    hi = F.max(F.col(r)).over(w.w(fastk))
    lo = F.min(F.col(r)).over(w.w(fastk))
    k = f"_{p}_k"
    lb = n + fastk - 1 + fastd - 1
    fr = fr.add(Feat([(k, F.when(_rn() > n + fastk - 1, sdiv((F.col(r) - lo) * 100.0, hi - lo))),
                      (f"{p}_fastk", F.when(_rn() > lb, F.col(k))),
                      (f"{p}_fastd", F.when(_rn() > lb, F.avg(F.col(k)).over(w.w(fastd))))],
                     fastk - 1 + fastd - 1))
    return fr.drop(r, k)


def _dm_tr(fr: BarFrame, h, l, c, tag):
    w = Win(fr.key, fr.block)
    up = col(h) - w.lag(col(h), 1)
    dn = w.lag(col(l), 1) - col(l)
    pdm, mdm, tr = f"_pdm_{tag}", f"_mdm_{tag}", f"_tr_{tag}"
    pc = w.lag(col(c), 1)
    fr = fr.add(Feat([
        (pdm, F.when((up > 0) & (up > dn), up).otherwise(F.lit(0.0))),
        (mdm, F.when((dn > 0) & (dn > up), dn).otherwise(F.lit(0.0))),
        (tr, F.when(pc.isNotNull(), F.greatest(col(h) - col(l), F.abs(col(h) - pc), F.abs(col(l) - pc))))], 1))
    return fr, pdm, mdm, tr


def plus_dm(fr: BarFrame, h="high", l="low", n=14, out=None) -> BarFrame:
    """Wilder sum of +DM, seeded by the sum of the first n−1."""
    fr, pdm, mdm, tr = _dm_tr(fr, h, l, "close" if "close" in fr.columns else h, f"pdm{n}")
    fr = wilder_sum(fr, pdm, n, out or f"PLUS_DM_{n}", start=2)
    return fr.drop(pdm, mdm, tr)


def minus_dm(fr: BarFrame, h="high", l="low", n=14, out=None) -> BarFrame:
    """Mirrored."""
    fr, pdm, mdm, tr = _dm_tr(fr, h, l, "close" if "close" in fr.columns else h, f"mdm{n}")
    fr = wilder_sum(fr, mdm, n, out or f"MINUS_DM_{n}", start=2)
    return fr.drop(pdm, mdm, tr)


def _di_parts(fr: BarFrame, h, l, c, n, tag):
    fr, pdm, mdm, tr = _dm_tr(fr, h, l, c, tag)
    sp, sm, st = f"_sp_{tag}", f"_sm_{tag}", f"_st_{tag}"
    fr = smooth_many(fr, [_wsum_spec(sp, pdm, n, 2), _wsum_spec(sm, mdm, n, 2), _wsum_spec(st, tr, n, 2)])
    g = _rn() > n
    pdi = F.when(g, sdiv(F.col(sp) * 100.0, F.col(st)))
    mdi = F.when(g, sdiv(F.col(sm) * 100.0, F.col(st)))
    return fr, pdi, mdi, [pdm, mdm, tr, sp, sm, st]


def plus_di(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """100·(+DM sum)/(TR sum), from row n+1."""
    fr, pdi, _, tmp = _di_parts(fr, h, l, c, n, f"pdi{n}")
    return fr.with_df(fr.df.withColumn(out or f"PLUS_DI_{n}", pdi).drop(*tmp))


def minus_di(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """Mirrored."""
    fr, _, mdi, tmp = _di_parts(fr, h, l, c, n, f"mdi{n}")
    return fr.with_df(fr.df.withColumn(out or f"MINUS_DI_{n}", mdi).drop(*tmp))


def _dx(fr: BarFrame, h, l, c, n, out):
    fr, pdi, mdi, tmp = _di_parts(fr, h, l, c, n, f"dx{n}")
    raw = f"_{out}_raw"
    den = pdi + mdi
    fr = fr.with_df(fr.df.withColumn(raw, F.when(den != 0, F.abs(pdi - mdi) * 100.0 / den)).drop(*tmp))
    # a zero denominator repeats the previous value (0 before any)
    fr = fr.ffill(f"_{out}_ff", F.col(raw))
    val = F.when(_rn() > n, F.coalesce(F.col(f"_{out}_ff"), F.lit(0.0)))
    return fr.with_df(fr.df.withColumn(out, val).drop(raw, f"_{out}_ff"))


def dx(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """100·|+DI − −DI|/(+DI + −DI), from row n+1."""
    return _dx(fr, h, l, c, n, out or f"DX_{n}")


def adx(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """Wilder mean of DX seeded by the mean of the first n DX values (from row 2n)."""
    d = f"_adx_dx_{n}"
    fr = _dx(fr, h, l, c, n, d)
    fr = wilder_mean(fr, d, n, out or f"ADX_{n}", start=n + 1)
    return fr.drop(d)


def adxr(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """(ADX + ADX n−1 rows back)/2, from row 3n−1."""
    a = f"_adxr_adx_{n}"
    fr = adx(fr, h, l, c, n, a)
    w = Win(fr.key, fr.block)
    val = F.when(_rn() > 3 * n - 2, (F.col(a) + w.lag(F.col(a), n - 1)) / 2.0)
    fr = fr.add(Feat([(out or f"ADXR_{n}", val)], n - 1))
    return fr.drop(a)


def atr(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """Wilder mean of true range, seeded by the mean of TR over rows 2..n+1."""
    w = Win(fr.key, fr.block)
    pc = w.lag(col(c), 1)
    tr = f"_atr_tr_{n}"
    fr = fr.add(Feat([(tr, F.when(pc.isNotNull(), F.greatest(col(h) - col(l), F.abs(col(h) - pc),
                                                            F.abs(col(l) - pc))))], 1))
    fr = wilder_mean(fr, tr, n, out or f"ATR_{n}", start=2)
    return fr.drop(tr)


def natr(fr: BarFrame, h="high", l="low", c="close", n=14, out=None) -> BarFrame:
    """100·ATR/close."""
    a = f"_natr_atr_{n}"
    fr = atr(fr, h, l, c, n, a)
    return fr.with_df(fr.df.withColumn(out or f"NATR_{n}", sdiv(F.col(a) * 100.0, col(c))).drop(a))


def ad(fr: BarFrame, h="high", l="low", c="close", v="volume", out="AD") -> BarFrame:
    """Σ ((c−l)−(h−c))/(h−l)·v, bars with h = l add 0."""
    clv = sdiv((col(c) - col(l)) - (col(h) - col(c)), col(h) - col(l)) * col(v)
    return fr.cumsum(out, clv)


def adosc(fr: BarFrame, h="high", l="low", c="close", v="volume", fast=3, slow=10, out=None) -> BarFrame:
    """EMA_fast(AD) − EMA_slow(AD), both seeded with the first AD value; from row ``slow``."""
    a = f"_adosc_ad_{fast}_{slow}"
    fr = ad(fr, h, l, c, v, a)
    ef, es = f"_adosc_f_{fast}", f"_adosc_s_{slow}"
    af, as_ = 2.0 / (fast + 1), 2.0 / (slow + 1)
    fr = smooth_many(fr, [(ef, F.col(a), 1, 1, 1.0 - af, 1.0, af), (es, F.col(a), 1, 1, 1.0 - as_, 1.0, as_)])
    lb = max(fast, slow) - 1
    val = F.when(_rn() > lb, F.col(ef) - F.col(es))
    return fr.with_df(fr.df.withColumn(out or f"ADOSC_{fast}_{slow}", val).drop(a, ef, es))


def obv(fr: BarFrame, c="close", v="volume", out="OBV") -> BarFrame:
    """Starts at the first volume, then ± volume by the sign of the close change."""
    w = Win(fr.key, fr.block)
    s = f"_obv_s"
    fr = fr.add(Feat([(s, F.when(_rn() == 1, col(v)).otherwise(F.signum(col(c) - w.lag(col(c), 1)) * col(v)))], 1))
    fr = fr.cumsum(out, F.col(s))
    return fr.drop(s)


def cumulative_sum(fr: BarFrame, x, out=None) -> BarFrame:
    """Running sum from the first row."""
    return fr.cumsum(out or f"{x}_cumsum", col(x))


def slope_atr_ratio(fr: BarFrame, n=14, c="close", out=None) -> BarFrame:
    """LINEARREG_SLOPE(n) / ATR(n)."""
    from barloom.functions.finite import linearreg_slope
    w = Win(fr.key, fr.block)
    s, a = f"_sar_slope_{n}", f"_sar_atr_{n}"
    fr = fr.add(linearreg_slope(w, c, n, s))
    fr = atr(fr, n=n, out=a)
    return fr.with_df(fr.df.withColumn(out or f"SLOPE_ATR_{n}", sdiv(F.col(s), F.col(a), None)).drop(s, a))
