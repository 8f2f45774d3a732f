"""The 61 candle patterns a second time, as DuckDB SQL.

without the Spark rules of ``functions/patterns.py``: the queries' oracles and the
random-bar tests compare the two.  A bar is a struct of its prices, parts
(B body, U upper and D lower shadow, R range) and averages over the bars before
it (mB, mR, mS over ten bars, m5 over five).
"""

from __future__ import annotations

BARS_BACK = 6


class Bar:
    """SQL fragments about the bar ``k`` rows before the current one."""

    def __init__(self, k: int):
        for f in ("o", "h", "l", "c", "B", "U", "D", "R", "mB", "mR", "mS", "m5"):
            setattr(self, f, f"p{k}.{f}")
        self.white, self.black = f"{self.c} >= {self.o}", f"{self.c} < {self.o}"
        self.colour = f"if({self.c} >= {self.o}, 100, -100)"
        self.long, self.short = f"{self.B} > {self.mB}", f"{self.B} <= {self.mB}"
        self.doji = f"{self.B} <= {self.mR} * 0.1"
        self.top, self.bottom = f"greatest({self.o}, {self.c})", f"least({self.o}, {self.c})"
        self.near, self.far, self.equal = f"{self.m5} * 0.2", f"{self.m5} * 0.6", f"{self.m5} * 0.05"
        self.tiny_up, self.tiny_down = f"{self.U} < {self.mR} * 0.1", f"{self.D} < {self.mR} * 0.1"
        self.small_up, self.small_down = f"{self.U} < {self.mS} / 2", f"{self.D} < {self.mS} / 2"
        self.tall_up, self.tall_down = f"{self.U} > {self.B}", f"{self.D} > {self.B}"


def every(*conditions: str) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def either(*conditions: str) -> str:
    return " OR ".join(f"({c})" for c in conditions)


def no(condition: str) -> str:
    return f"NOT ({condition})"


def within(x: str, bar: Bar) -> str:
    """Strictly inside a bar's body."""
    return every(f"{x} > {bar.bottom}", f"{x} < {bar.top}")


def body_inside(inner: Bar, outer: Bar) -> str:
    return every(f"{inner.top} < {outer.top}", f"{inner.bottom} > {outer.bottom}")


def gap_up(a: Bar, b: Bar) -> str:
    return f"{b.bottom} > {a.top}"


def gap_down(a: Bar, b: Bar) -> str:
    return f"{b.top} < {a.bottom}"


def opposite(a: Bar, b: Bar) -> str:
    return f"({a.white}) <> ({b.white})"


def rising(*xs: str) -> str:
    return every(*[f"{b} > {a}" for a, b in zip(xs, xs[1:])])


def falling(*xs: str) -> str:
    return every(*[f"{b} < {a}" for a, b in zip(xs, xs[1:])])


def same(x: str, y: str, bar: Bar) -> str:
    return f"abs({x} - {y}) <= {bar.equal}"


def around_body(x: str, bar: Bar) -> str:
    """In or near a bar's body."""
    return f"{x} BETWEEN {bar.bottom} - {bar.near} AND {bar.top} + {bar.near}"


def from_white_body(x: str, bar: Bar) -> str:
    """Above a white bar's open, at most near its close."""
    return every(f"{x} > {bar.o}", f"{x} <= {bar.c} + {bar.near}")


def both_colours(bar: Bar, if_white: str, if_black: str) -> str:
    return f"CASE WHEN {bar.white} THEN {if_white} ELSE {if_black} END"


def _one_bar(a: Bar) -> dict:
    belt = both_colours(a, a.tiny_down, a.tiny_up)
    return {
        "CDLBELTHOLD": (every(a.long, belt), a.colour),
        "CDLCLOSINGMARUBOZU": (every(a.long, both_colours(a, a.tiny_up, a.tiny_down)), a.colour),
        "CDLDOJI": (a.doji, "100"),
        "CDLDRAGONFLYDOJI": (every(a.doji, a.tiny_up, no(a.tiny_down)), "100"),
        "CDLGRAVESTONEDOJI": (every(a.doji, a.tiny_down, no(a.tiny_up)), "100"),
        "CDLHIGHWAVE": (every(a.short, f"{a.U} > 2 * {a.B}", f"{a.D} > 2 * {a.B}"), a.colour),
        "CDLLONGLEGGEDDOJI": (every(a.doji, either(a.tall_up, a.tall_down)), "100"),
        "CDLLONGLINE": (every(a.long, a.small_up, a.small_down), a.colour),
        "CDLMARUBOZU": (every(a.long, a.tiny_up, a.tiny_down), a.colour),
        "CDLRICKSHAWMAN": (every(a.doji, a.tall_up, a.tall_down, f"{a.bottom} <= {a.l} + {a.R} / 2 + {a.near}",
                                 f"{a.top} >= {a.l} + {a.R} / 2 - {a.near}"), "100"),
        "CDLSHORTLINE": (every(a.short, a.small_up, a.small_down), a.colour),
        "CDLSPINNINGTOP": (every(a.short, a.tall_up, a.tall_down), a.colour),
        "CDLTAKURI": (every(a.doji, a.tiny_up, f"{a.D} > 2 * {a.B}"), "100"),
    }


def _two_bars(a: Bar, b: Bar) -> dict:
    kick = every(opposite(a, b), a.long, b.long, a.tiny_up, a.tiny_down, b.tiny_up, b.tiny_down,
                 both_colours(b, f"{b.l} > {a.h}", f"{b.h} < {a.l}"))
    hammer = every(b.short, b.tall_down, b.tiny_up)
    spike = every(b.short, b.tall_up, b.tiny_down)
    under = every(a.black, a.long, b.white, f"{b.o} < {a.l}")
    return {
        "CDLCOUNTERATTACK": (every(a.long, b.long, opposite(a, b), same(b.c, a.c, a)), b.colour),
        "CDLDARKCLOUDCOVER": (every(a.white, a.long, b.black, f"{b.o} > {a.h}", f"{b.c} < {a.c} - {a.B} / 2", f"{b.c} > {a.o}"), "-100"),
        "CDLDOJISTAR": (every(a.long, b.doji, both_colours(a, gap_up(a, b), gap_down(a, b))), f"-({a.colour})"),
        "CDLENGULFING": (every(opposite(a, b), f"{b.top} >= {a.top}", f"{b.bottom} <= {a.bottom}",
                               either(f"{b.top} > {a.top}", f"{b.bottom} < {a.bottom}")), b.colour),
        "CDLHAMMER": (every(hammer, f"{b.bottom} <= {a.l} + {a.near}"), "100"),
        "CDLHANGINGMAN": (every(hammer, f"{b.bottom} >= {a.h} - {a.near}"), "-100"),
        "CDLHARAMI": (every(a.long, b.short, body_inside(b, a)), f"-({a.colour})"),
        "CDLHARAMICROSS": (every(a.long, b.doji, body_inside(b, a)), f"-({a.colour})"),
        "CDLHOMINGPIGEON": (every(a.black, b.black, a.long, b.short, body_inside(b, a)), "100"),
        "CDLINNECK": (every(under, f"{b.c} BETWEEN {a.c} AND {a.c} + {a.equal}"), "-100"),
        "CDLINVERTEDHAMMER": (every(spike, gap_down(a, b)), "100"),
        "CDLKICKING": (kick, b.colour),
        "CDLKICKINGBYLENGTH": (kick, f"if({b.B} > {a.B}, {b.colour}, {a.colour})"),
        "CDLMATCHINGLOW": (every(a.black, b.black, same(b.c, a.c, a)), "100"),
        "CDLONNECK": (every(under, same(b.c, a.l, a)), "-100"),
        "CDLPIERCING": (every(under, b.long, f"{b.c} > {a.c} + {a.B} / 2", f"{b.c} < {a.o}"), "100"),
        "CDLSEPARATINGLINES": (every(opposite(a, b), same(b.o, a.o, a), b.long, both_colours(b, b.tiny_down, b.tiny_up)), b.colour),
        "CDLSHOOTINGSTAR": (every(spike, gap_up(a, b)), "-100"),
        "CDLTHRUSTING": (every(under, f"{b.c} > {a.c} + {a.equal}", f"{b.c} <= {a.c} + {a.B} / 2"), "-100"),
    }


def _three_bars(a: Bar, b: Bar, c: Bar) -> dict:
    star_up, star_down = every(a.white, a.long, gap_up(a, b)), every(a.black, a.long, gap_down(a, b))
    drop = every(c.black, no(c.short), f"{c.c} < {a.c} - 0.3 * {a.B}")
    lift = every(c.white, no(c.short), f"{c.c} > {a.c} + 0.3 * {a.B}")
    climb = every(a.white, b.white, c.white, rising(a.c, b.c, c.c))
    crows = every(a.black, b.black, c.black, a.tiny_down, b.tiny_down, c.tiny_down, falling(a.c, b.c, c.c))
    side = every(b.white, c.white, f"abs({c.B} - {b.B}) < {b.near}", f"abs({c.o} - {b.o}) < {b.equal}")
    alike = f"abs({b.B} - {c.B}) < {b.near}"
    dojis = every(a.doji, b.doji, c.doji)
    baby = every(a.long, b.doji, no(c.short))
    return {
        "CDL2CROWS": (every(a.white, a.long, b.black, gap_up(a, b), c.black, within(c.o, b), within(c.c, a)), "-100"),
        "CDL3INSIDE": (every(a.long, b.short, body_inside(b, a),
                             both_colours(a, every(c.black, f"{c.c} < {a.o}"), every(c.white, f"{c.c} > {a.o}"))), f"-({a.colour})"),
        "CDL3OUTSIDE": (both_colours(b, every(a.black, f"{b.c} > {a.o}", f"{b.o} < {a.c}", f"{c.c} > {b.c}"),
                                     every(a.white, f"{b.o} > {a.c}", f"{b.c} < {a.o}", f"{c.c} < {b.c}")), b.colour),
        # the second bar opens inside the first's upper range, as published
        "CDL3STARSINSOUTH": (every(a.black, b.black, c.black, a.long, a.tall_down, f"{b.B} < {a.B}", f"{b.o} > {a.c}", f"{b.o} <= {a.h}",
                                   f"{b.l} > {a.l}", no(b.tiny_down), c.short, c.tiny_up, c.tiny_down, f"{c.h} < {b.h}", f"{c.l} > {b.l}"), "100"),
        "CDL3WHITESOLDIERS": (every(climb, a.tiny_up, b.tiny_up, c.tiny_up, from_white_body(b.o, a), from_white_body(c.o, b),
                                    f"{b.B} > {a.B} - {a.far}", f"{c.B} > {b.B} - {b.far}", no(c.short)), "100"),
        "CDLABANDONEDBABY": (every(baby, both_colours(
            a, every(c.black, f"{b.l} > {a.h}", f"{c.h} < {b.l}", f"{c.c} < {a.c} - 0.3 * {a.B}"),
            every(c.white, f"{b.h} < {a.l}", f"{c.l} > {b.h}", f"{c.c} > {a.c} + 0.3 * {a.B}"))), c.colour),
        "CDLADVANCEBLOCK": (every(climb, a.long, a.small_up, from_white_body(b.o, a), from_white_body(c.o, b),
                                  either(falling(a.B, b.B, c.B), f"{c.U} > {b.U}", f"{b.U} > {a.U}")), "-100"),
        "CDLEVENINGDOJISTAR": (every(star_up, b.doji, drop), "-100"),
        "CDLEVENINGSTAR": (every(star_up, b.short, drop), "-100"),
        "CDLMORNINGDOJISTAR": (every(star_down, b.doji, lift), "100"),
        "CDLMORNINGSTAR": (every(star_down, b.short, lift), "100"),
        "CDLGAPSIDESIDEWHITE": (every(side, either(every(gap_up(a, b), gap_up(a, c)), every(gap_down(a, b), gap_down(a, c)))),
                                f"if({gap_up(a, b)}, 100, -100)"),
        "CDLIDENTICAL3CROWS": (every(crows, same(b.o, a.c, a), same(c.o, b.c, b)), "-100"),
        "CDLSTALLEDPATTERN": (every(climb, a.long, b.long, b.tiny_up, from_white_body(b.o, a), c.short,
                                    f"{c.o} >= {b.c} - {c.B} - {b.near}"), "-100"),
        "CDLSTICKSANDWICH": (every(a.black, b.white, c.black, f"{b.l} > {a.c}", same(c.c, a.c, a)), "100"),
        "CDLTASUKIGAP": (every(opposite(b, c), within(c.o, b), alike, both_colours(
            b, every(gap_up(a, b), f"{c.c} < {b.o}", f"{c.c} > {a.top}"),
            every(gap_down(a, b), f"{c.c} > {b.o}", f"{c.c} < {a.bottom}"))), b.colour),
        "CDLTRISTAR": (every(dojis, either(every(gap_up(a, b), f"{c.top} < {b.top}"), every(gap_down(a, b), f"{c.bottom} > {b.bottom}"))),
                       f"if({gap_up(a, b)}, -100, 100)"),
        "CDLUNIQUE3RIVER": (every(a.black, a.long, b.black, f"{b.c} > {a.c}", f"{b.o} <= {a.o}", f"{b.l} < {a.l}",
                                  c.short, c.white, f"{c.o} > {b.l}"), "100"),
        "CDLUPSIDEGAP2CROWS": (every(a.white, a.long, b.short, b.black, gap_up(a, b), c.black, f"{c.o} > {b.o}", f"{c.c} < {b.c}",
                                     f"{c.c} > {a.c}"), "-100"),
        "CDLXSIDEGAP3METHODS": (every(f"({a.white}) = ({b.white})", opposite(b, c), within(c.o, b), within(c.c, a),
                                      both_colours(a, gap_up(a, b), gap_down(a, b))), a.colour),
    }


def _four_bars(a: Bar, b: Bar, c: Bar, d: Bar) -> dict:
    return {
        "CDL3BLACKCROWS": (every(a.white, b.black, c.black, d.black, b.tiny_down, c.tiny_down, d.tiny_down, falling(b.c, c.c, d.c),
                                 within(c.o, b), within(d.o, c), f"{b.c} < {a.h}"), "-100"),
        "CDL3LINESTRIKE": (every(f"({a.white}) = ({b.white})", f"({b.white}) = ({c.white})", opposite(c, d),
                                 around_body(b.o, a), around_body(c.o, b),
                                 both_colours(a, every(rising(a.c, b.c, c.c), f"{d.o} > {c.c}", f"{d.c} < {a.o}"),
                                              every(falling(a.c, b.c, c.c), f"{d.o} < {c.c}", f"{d.c} > {a.o}"))), a.colour),
        "CDLCONCEALBABYSWALL": (every(a.black, b.black, c.black, d.black, a.tiny_up, a.tiny_down, b.tiny_up, b.tiny_down,
                                      gap_down(b, c), f"{c.h} > {b.c}", f"{d.h} > {c.h}", f"{d.l} < {c.l}"), "100"),
    }


def _five_bars(a: Bar, b: Bar, c: Bar, d: Bar, e: Bar) -> dict:
    middle = (b, c, d)
    inside_first = every(*[every(f"{x.top} < {a.h}", f"{x.bottom} > {a.l}") for x in middle])
    small = every(*[x.short for x in middle])
    return {
        "CDLBREAKAWAY": (every(a.long, f"({a.white}) = ({b.white})", f"({b.white}) = ({d.white})", opposite(d, e), both_colours(
            a, every(gap_up(a, b), rising(b.h, c.h, d.h), rising(b.l, c.l, d.l), f"{e.c} < {b.o}", f"{e.c} > {a.c}"),
            every(gap_down(a, b), falling(b.h, c.h, d.h), falling(b.l, c.l, d.l), f"{e.c} > {b.o}", f"{e.c} < {a.c}"))), e.colour),
        "CDLLADDERBOTTOM": (every(a.black, b.black, c.black, falling(a.o, b.o, c.o), falling(a.c, b.c, c.c), d.black, no(d.tiny_up),
                                  e.white, f"{e.o} > {d.o}", f"{e.c} > {d.h}"), "100"),
        "CDLMATHOLD": (every(a.white, a.long, b.black, small, gap_up(a, b), falling(b.top, c.top, d.top),
                             f"{c.bottom} > {a.c} - {a.B} / 2", f"{d.bottom} > {a.c} - {a.B} / 2",
                             e.white, f"{e.o} > {d.c}", f"{e.c} > greatest({b.h}, {c.h}, {d.h})"), "100"),
        "CDLRISEFALL3METHODS": (every(a.long, small, e.long, f"({a.white}) = ({e.white})", opposite(a, b), opposite(a, c), opposite(a, d),
                                      inside_first, both_colours(a, every(falling(b.c, c.c, d.c), f"{e.o} > {d.c}", f"{e.c} > {a.c}"),
                                                                 every(rising(b.c, c.c, d.c), f"{e.o} < {d.c}", f"{e.c} < {a.c}"))), a.colour),
    }


def _line(n: int) -> list[Bar]:
    return [Bar(k) for k in range(n - 1, -1, -1)]


RULES = {name: (n, *rule) for n, made in ((1, _one_bar), (2, _two_bars), (3, _three_bars), (4, _four_bars), (5, _five_bars))
         for name, rule in made(*_line(n)).items()}


def _hikkake(n: int) -> str:
    """+1 / −1 where the pattern itself ends (n bars), else 0."""
    bars = _line(n)
    nested = every(*[every(f"{y.h} < {x.h}", f"{y.l} > {x.l}") for x, y in zip(bars[:-2], bars[1:-1])])
    last, ref = bars[-1], bars[-2]
    low = f"{ref.c} <= {ref.l} + 0.2 * {ref.R}" if n == 4 else "TRUE"
    high = f"{ref.c} >= {ref.h} - 0.2 * {ref.R}" if n == 4 else "TRUE"
    return (f"CASE WHEN {every(nested, low, f'{last.h} < {ref.h}', f'{last.l} < {ref.l}')} THEN 1 "
            f"WHEN {every(nested, high, f'{last.h} > {ref.h}', f'{last.l} > {ref.l}')} THEN -1 ELSE 0 END")


HIKKAKE = {"CDLHIKKAKE": 3, "CDLHIKKAKEMOD": 4}
NAMES = sorted([*RULES, *HIKKAKE])


def bars_of(name: str) -> int:
    return HIKKAKE[name] if name in HIKKAKE else RULES[name][0]


def pattern_ctes(names: list[str], source: str) -> list[str]:
    """CTEs from ``source`` (symbol, ts, rn, open, high, low, close) to ``pat`` (with a column per name, NULL before its lookback)."""
    w = "PARTITION BY symbol ORDER BY rn"
    ctes = [
        f"cb0 AS (SELECT symbol, ts, rn, open AS o, high AS h, low AS l, close AS c, abs(close - open) AS B, "
        f"high - greatest(open, close) AS U, least(open, close) - low AS D, high - low AS R FROM {source})",
        f"cb1 AS (SELECT symbol, ts, rn, {{'o': o, 'h': h, 'l': l, 'c': c, 'B': B, 'U': U, 'D': D, 'R': R, "
        "'mB': avg(B) OVER ten, 'mR': avg(R) OVER ten, 'mS': avg(U + D) OVER ten, 'm5': avg(R) OVER five} AS p0 FROM cb0 "
        f"WINDOW ten AS ({w} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), five AS ({w} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING))",
        "cb2 AS (SELECT *, " + ", ".join(f"lag(p0, {k}) OVER ({w}) AS p{k}" for k in range(1, BARS_BACK + 1)) + " FROM cb1)"]
    flags = [n for n in names if n in HIKKAKE]
    ctes.append("cb3 AS (SELECT *" + "".join(f", {_hikkake(HIKKAKE[n])} AS f_{n}" for n in flags) + " FROM cb2)")
    ctes.append("cb4 AS (SELECT *" + "".join(f", lag(f_{n}, {j}) OVER ({w}) AS f{j}_{n}" for n in flags for j in (1, 2, 3)) + " FROM cb3)")
    out = []
    for n in names:
        if n in HIKKAKE:
            # the newest pattern of the last three bars, confirmed by the first close beyond its inner bar
            value = f"WHEN f_{n} <> 0 THEN 100 * f_{n} "
            for j in (1, 2, 3):
                newest = every(*[f"f{i}_{n} = 0" for i in range(1, j)], f"f{j}_{n} <> 0")
                closes = [f"p{i}.c" for i in range(1, j)]
                up = every(f"p0.c > p{j + 1}.h", *[f"{c} <= p{j + 1}.h" for c in closes])
                down = every(f"p0.c < p{j + 1}.l", *[f"{c} >= p{j + 1}.l" for c in closes])
                value += f"WHEN {newest} THEN CASE WHEN f{j}_{n} > 0 AND {up} THEN 200 WHEN f{j}_{n} < 0 AND {down} THEN -200 ELSE 0 END "
            value = f"CASE {value} ELSE 0 END"
        else:
            _, condition, result = RULES[n]
            value = f"CASE WHEN {condition} THEN {result} ELSE 0 END"
        out.append(f"CASE WHEN rn > {10 + bars_of(n) - 1} THEN CAST({value} AS INTEGER) END AS {n}")
    ctes.append(f"pat AS (SELECT symbol, ts, rn, {', '.join(out)} FROM cb4)")
    return ctes
