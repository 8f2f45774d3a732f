"""Small helpers for writing the DuckDB oracle SQL (strings only)."""

from __future__ import annotations


def W(n: int) -> str:
    """Frame of the last n rows over the named window ``w``."""
    return f"OVER (w ROWS BETWEEN {int(n) - 1} PRECEDING AND CURRENT ROW)"


def WR(lo: int, hi: int = 0) -> str:
    """Frame from ``lo`` rows back to ``hi`` rows back (0 = current row)."""
    hi_s = "CURRENT ROW" if hi == 0 else f"{int(hi)} PRECEDING"
    return f"OVER (w ROWS BETWEEN {int(lo)} PRECEDING AND {hi_s})"


def G(lb: int, e: str) -> str:
    """NULL until lb earlier rows exist."""
    return f"(CASE WHEN rn > {int(lb)} THEN {e} END)"


def DIV(a: str, b: str, z: str = "0.0") -> str:
    return f"(CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) ELSE {z} END)"


def LAG(x: str, k: int) -> str:
    return f"lag({x}, {int(k)}) OVER w"


def LEAD(x: str, k: int) -> str:
    return f"lead({x}, {int(k)}) OVER w"


def R(expr: str, d: int) -> str:
    return f"(round({expr}, {d}) + 0.0)"


def recur(name: str, src: str, x: str, d: str, out_when: str | None = None) -> str:
    """CTEs computing ``y = d·y₋₁ + x`` row by row per symbol (a loop over rn).

    Produces ``{name}(symbol, rn, {name})``; ``x`` and ``d`` are SQL over ``src``.
    """
    cond = out_when or "TRUE"
    return f"""
{name}_i AS (SELECT symbol, rn, coalesce({x}, 0.0) AS x, {d} AS d FROM {src}),
{name}_r AS (SELECT symbol, rn, x AS y FROM {name}_i WHERE rn = 1
  UNION ALL
  SELECT i.symbol, i.rn, r.y * i.d + i.x FROM {name}_r r JOIN {name}_i i ON i.symbol = r.symbol AND i.rn = r.rn + 1),
{name} AS (SELECT symbol, rn, CASE WHEN {cond} THEN y END AS {name} FROM {name}_r)"""


def smooth(name: str, src: str, x: str, start: int, seed_len: int, d: float, w_seed: float,
           w_after: float) -> str:
    """Seeded smoother as a loop: seed rows accumulate w_seed·x with d = 1."""
    seed_end = start + seed_len - 1
    xx = (f"CASE WHEN rn < {start} THEN 0.0 WHEN rn <= {seed_end} THEN ({x}) * {w_seed!r} "
          f"ELSE ({x}) * {w_after!r} END")
    dd = f"CASE WHEN rn <= {seed_end} THEN 1.0 ELSE {d!r} END"
    return recur(name, src, xx, dd, f"rn >= {seed_end}")


def ema(name: str, src: str, x: str, n: int, start: int = 1, alpha: float | None = None) -> str:
    a = alpha if alpha is not None else 2.0 / (n + 1)
    return smooth(name, src, x, start, n, 1.0 - a, 1.0 / n, a)


def wilder_mean(name, src, x, n, start=1):
    return smooth(name, src, x, start, n, (n - 1) / n, 1.0 / n, 1.0 / n)


def wilder_sum(name, src, x, n, start=1):
    return smooth(name, src, x, start, n - 1, (n - 1) / n, 1.0, 1.0)


def exits_recursive(name: str, src: str, size: float, max_holding: int, stop_pct: float) -> str:
    """Path-dependent exits as a row-by-row loop: state (last, entry, bars) per symbol.
    ``src`` has (symbol, rn, close, signal)."""
    def step(last, entry, bars):
        n1 = f"(CASE WHEN s.signal = 1 THEN {size!r} WHEN s.signal = -1 THEN {-size!r} ELSE {last} END)"
        n2 = f"(CASE WHEN {last} <> 0 AND {bars} >= {max_holding} THEN 0.0 ELSE {n1} END)"
        n3 = (f"(CASE WHEN {last} > 0 AND s.close <= {entry} * {1 - stop_pct!r} THEN 0.0 "
              f"WHEN {last} < 0 AND s.close >= {entry} * {1 + stop_pct!r} THEN 0.0 ELSE {n2} END)")
        opened = f"({n3} <> 0 AND ({last} = 0 OR sign({n3}) <> sign({last})))"
        return (f"{n3} AS last, CASE WHEN {opened} THEN s.close ELSE {entry} END AS entry, "
                f"CASE WHEN {opened} THEN 0 WHEN {n3} <> 0 THEN {bars} + 1 ELSE {bars} END AS bars")
    return f"""
{name} AS (
  SELECT s.symbol, s.rn, {step('0.0', '0.0', '0')} FROM {src} s WHERE s.rn = 1
  UNION ALL
  SELECT s.symbol, s.rn, {step('r.last', 'r.entry', 'r.bars')}
  FROM {name} r JOIN {src} s ON s.symbol = r.symbol AND s.rn = r.rn + 1)"""


def sar_recursive(name: str, src: str, accel: float = 0.02, maximum: float = 0.2) -> str:
    """Parabolic SAR as a row-by-row loop over (symbol, rn, high, low, hp, lp) where
    hp/lp are the previous bar's high/low.  State: is_long, next sar, ep, af."""
    def step(L, S, E, A):
        rl = f"({L} AND s.low <= {S})"
        rs = f"((NOT {L}) AND s.high >= {S})"
        out = f"(CASE WHEN {rl} THEN greatest({E}, s.hp, s.high) WHEN {rs} THEN least({E}, s.lp, s.low) ELSE {S} END)"
        nl = f"(CASE WHEN {rl} THEN false WHEN {rs} THEN true ELSE {L} END)"
        grow = f"(({L} AND s.high > {E}) OR ((NOT {L}) AND s.low < {E}))"
        ne = (f"(CASE WHEN {rl} THEN s.low WHEN {rs} THEN s.high WHEN {L} AND s.high > {E} THEN s.high "
              f"WHEN (NOT {L}) AND s.low < {E} THEN s.low ELSE {E} END)")
        na = f"(CASE WHEN {rl} OR {rs} THEN {accel!r} WHEN {grow} THEN least({A} + {accel!r}, {maximum!r}) ELSE {A} END)"
        raw = f"({out} + {na} * ({ne} - {out}))"
        nxt = (f"(CASE WHEN {rl} THEN greatest({raw}, s.hp, s.high) WHEN {rs} THEN least({raw}, s.lp, s.low) "
               f"WHEN {L} THEN least({raw}, s.lp, s.low) ELSE greatest({raw}, s.hp, s.high) END)")
        return f"{out} AS sar_out, {nl} AS is_long, {nxt} AS sar, {ne} AS ep, {na} AS af"
    init_long = "(NOT ((s.lp - s.low) > (s.high - s.hp) AND (s.lp - s.low) > 0))"
    init_s = f"(CASE WHEN {init_long} THEN s.lp ELSE s.hp END)"
    init_e = f"(CASE WHEN {init_long} THEN s.high ELSE s.low END)"
    return f"""
{name} AS (
  SELECT s.symbol, s.rn, {step(init_long, init_s, init_e, repr(accel))} FROM {src} s WHERE s.rn = 2
  UNION ALL
  SELECT s.symbol, s.rn, {step('r.is_long', 'r.sar', 'r.ep', 'r.af')}
  FROM {name} r JOIN {src} s ON s.symbol = r.symbol AND s.rn = r.rn + 1)"""


def cycle_recursive(name: str, src: str, fast: float = 0.5, slow: float = 0.05) -> str:
    """Hilbert-transform cycle measures and MAMA/FAMA as a row-by-row loop.

    ``src``: (symbol, rn, price, sl, pl) with the last 50 smoothed and raw prices, newest
    first.  State lists hold the values of earlier rows, newest first.
    """
    def hilbert(now, past):
        return f"((0.0962 * {now} + 0.5769 * {past}[2] - 0.5769 * {past}[4] - 0.0962 * {past}[6]) * adj)"

    six, three = "[0.0, 0.0, 0.0, 0.0, 0.0, 0.0]::DOUBLE[]", "[0.0, 0.0, 0.0]::DOUBLE[]"
    zero = ", ".join(f"0.0::DOUBLE AS {c}" for c in ("i2", "q2", "re", "im", "per", "sp", "phase", "sine", "lead", "days", "mama", "fama",
                                                     "angle", "inph", "quad", "line"))
    layers = [
        f"SELECT s.*, r.* EXCLUDE (symbol, rn), 0.075 * r.per + 0.54 AS adj FROM {name} r JOIN {src} s ON s.symbol = r.symbol AND s.rn = r.rn + 1",
        "SELECT *, CASE WHEN rn > 6 THEN (0.0962 * sl[1] + 0.5769 * sl[3] - 0.5769 * sl[5] - 0.0962 * sl[7]) * adj ELSE 0.0 END AS d FROM ({})",
        f"SELECT *, CASE WHEN rn > 6 THEN {hilbert('d', 'de')} ELSE 0.0 END AS q, CASE WHEN rn > 3 THEN de[3] ELSE 0.0 END AS i FROM ({{}})",
        f"SELECT *, CASE WHEN rn > 6 THEN {hilbert('i', 'il')} ELSE 0.0 END AS ji, CASE WHEN rn > 6 THEN {hilbert('q', 'ql')} ELSE 0.0 END AS jq FROM ({{}})",
        "SELECT *, 0.2 * (i - jq) + 0.8 * i2 AS i2n, 0.2 * (q + ji) + 0.8 * q2 AS q2n FROM ({})",
        "SELECT *, 0.2 * (i2n * i2 + q2n * q2) + 0.8 * re AS ren, 0.2 * (i2n * q2 - q2n * i2) + 0.8 * im AS imn FROM ({})",
        "SELECT *, CASE WHEN imn <> 0 AND ren <> 0 AND degrees(atan(imn / ren)) <> 0 THEN 360.0 / degrees(atan(imn / ren)) ELSE per END AS p1 FROM ({})",
        "SELECT *, CASE WHEN per > 0 THEN least(greatest(p1, 0.67 * per), 1.5 * per) ELSE p1 END AS p2 FROM ({})",
        "SELECT *, 0.2 * least(greatest(p2, 6.0), 50.0) + 0.8 * per AS pern FROM ({})",
        "SELECT *, 0.33 * pern + 0.67 * sp AS spn FROM ({})",
        "SELECT *, CAST(floor(spn + 0.5) AS INTEGER) AS cyc FROM ({})",
        "SELECT *, least(cyc, rn) AS m FROM ({})",
        "SELECT *, coalesce(list_sum([sin(radians(360.0 * k / cyc)) * sl[k + 1] for k in range(0, m)]), 0.0) AS rp, "
        "coalesce(list_sum([cos(radians(360.0 * k / cyc)) * sl[k + 1] for k in range(0, m)]), 0.0) AS ip, "
        "list_avg(pl[1:least(greatest(cyc, 1), rn)]) AS trend_now FROM ({})",
        "SELECT *, CASE WHEN abs(ip) > 0.001 THEN degrees(atan(rp / ip)) WHEN rp >= 0 THEN 90.0 ELSE -90.0 END + 90.0 "
        "+ CASE WHEN spn > 0 THEN 360.0 / spn ELSE 0.0 END + CASE WHEN ip < 0 THEN 180.0 ELSE 0.0 END AS ph, "
        "(4 * trend_now + 3 * tp[1] + 2 * tp[2] + tp[3]) / 10.0 AS linen, CASE WHEN i <> 0 THEN degrees(atan(q / i)) ELSE 0.0 END AS anglen FROM ({})",
        f"SELECT *, CASE WHEN ph > 315 THEN ph - 360.0 ELSE ph END AS phasen, greatest({fast!r} / greatest(1.0, angle - anglen), {slow!r}) AS alpha FROM ({{}})",
        "SELECT *, sin(radians(phasen)) AS sinen, sin(radians(phasen + 45.0)) AS leadn, "
        "CASE WHEN rn > 1 THEN alpha * price + (1 - alpha) * mama ELSE price END AS maman FROM ({})",
        "SELECT *, CASE WHEN rn > 1 AND ((sinen > leadn AND sine <= lead) OR (sinen < leadn AND sine >= lead)) THEN 0.0 ELSE days + 1 END AS daysn, "
        "CASE WHEN rn > 1 THEN 0.5 * alpha * maman + (1 - 0.5 * alpha) * fama ELSE price END AS faman FROM ({})",
        "SELECT symbol, rn, [d] || de[1:5] AS de, [q] || ql[1:5] AS ql, [i] || il[1:5] AS il, [trend_now] || tp[1:2] AS tp, "
        "i2n AS i2, q2n AS q2, ren AS re, imn AS im, pern AS per, spn AS sp, phasen AS phase, sinen AS sine, leadn AS lead, daysn AS days, "
        "maman AS mama, faman AS fama, anglen AS angle, i AS inph, q AS quad, linen AS line, "
        "CASE WHEN linen <> 0 AND abs((sl[1] - linen) / linen) >= 0.015 THEN 1 "
        "WHEN spn > 0 AND phasen - phase > 0.67 * 360.0 / spn AND phasen - phase < 1.5 * 360.0 / spn THEN 0 "
        "WHEN daysn < 0.5 * spn THEN 0 ELSE 1 END AS trend FROM ({})"]
    step = layers[0]
    for layer in layers[1:]:
        step = layer.format(step)
    return f"""
{name} AS (
  SELECT DISTINCT symbol, CAST(0 AS BIGINT) AS rn, {six} AS de, {six} AS ql, {six} AS il, {three} AS tp, {zero}, 0 AS trend FROM {src}
  UNION ALL {step})"""
