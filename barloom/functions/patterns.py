"""Candle patterns K1–K61 and their WMA smoothing.

Per bar ``k`` rows back (suffix ``k``; 0 = current bar) the helpers are:
``o c h l`` prices, ``bd`` body |c−o|, ``us`` upper shadow, ``ls`` lower
shadow, ``rg`` range h−l, and averages over the bars *before* that bar:
``ab`` (body, 10 bars), ``ar`` (range, 10), ``as`` (shadows, 10), ``ar5``
(range, 5).  The helpers are window columns computed once per frame; each
pattern is one boolean rule over them that returns 0 or ±100 (±200 for
hikkake confirmations).

Fixed thresholds (published candle conventions used by the rules):
long body > avg10(body); very long > 3·avg10(body); short ≤ avg10(body);
doji ≤ 0.1·avg10(range); short shadow < avg10(shadows)/2;
very short shadow < 0.1·avg10(range); long shadow > own body;
very long shadow > 2·own body; near 0.2·avg5(range); far 0.6·avg5(range);
equal 0.05·avg5(range).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.finite import Feat
from barloom.plans.frame import Win

MAXLAG = 6          # deepest bar referenced by a rule (hikkake confirmation)
AVG_BARS = 10


# ------------------------------------------------------------- rule vocabulary
def WH(k): return f"(c{k} >= o{k})"                 # white
def BK(k): return f"(c{k} < o{k})"                  # black
def COL(k): return f"(CASE WHEN c{k} >= o{k} THEN 100 ELSE -100 END)"
def LONG(k): return f"(bd{k} > ab{k})"
def VLONG(k): return f"(bd{k} > 3 * ab{k})"
def SHORT(k): return f"(bd{k} <= ab{k})"
def DOJI(k): return f"(bd{k} <= 0.1 * ar{k})"
def SSH(x, k): return f"({x}{k} < as{k} / 2)"       # short shadow
def VSSH(x, k): return f"({x}{k} < 0.1 * ar{k})"    # very short shadow
def LSH(x, k): return f"({x}{k} > bd{k})"           # long shadow
def VLSH(x, k): return f"({x}{k} > 2 * bd{k})"      # very long shadow
def NEAR(k): return f"(0.2 * ar5{k})"
def FAR(k): return f"(0.6 * ar5{k})"
def EQ(k): return f"(0.05 * ar5{k})"
def TOP(k): return f"greatest(o{k}, c{k})"
def BOT(k): return f"least(o{k}, c{k})"
def GAPUP(a, b): return f"({BOT(b)} > {TOP(a)})"    # body of bar b above body of earlier bar a
def GAPDN(a, b): return f"({TOP(b)} < {BOT(a)})"
def RGAPUP(a, b): return f"(l{b} > h{a})"
def RGAPDN(a, b): return f"(h{b} < l{a})"
def INBODY(x, k): return f"({x} > {BOT(k)} AND {x} < {TOP(k)})"


def AND(*xs): return "(" + " AND ".join(xs) + ")"
def OR(*xs): return "(" + " OR ".join(xs) + ")"
def IF(cond, val): return f"(CASE WHEN {cond} THEN {val} ELSE 0 END)"
def IF2(c1, v1, c2, v2): return f"(CASE WHEN {c1} THEN {v1} WHEN {c2} THEN {v2} ELSE 0 END)"


# ------------------------------------------------------------------- the rules
def _rules() -> dict:
    R = {}
    # K1: 1st long white; 2nd black gapping up; 3rd black opens in 2nd body, closes in 1st body
    R["CDL2CROWS"] = (3, IF(AND(WH(2), LONG(2), BK(1), GAPUP(2, 1), BK(0), INBODY("o0", 1),
                                INBODY("c0", 2)), -100))
    # K2
    R["CDL3BLACKCROWS"] = (4, IF(AND(WH(3), BK(2), BK(1), BK(0), VSSH("ls", 2), VSSH("ls", 1), VSSH("ls", 0),
                                     "c1 < c2", "c0 < c1", INBODY("o1", 2), INBODY("o0", 1), "c2 < h3"), -100))
    # K3
    R["CDL3INSIDE"] = (3, IF(AND(LONG(2), SHORT(1), f"{TOP(1)} < {TOP(2)}", f"{BOT(1)} > {BOT(2)}",
                                 OR(AND(WH(2), BK(0), "c0 < o2"), AND(BK(2), WH(0), "c0 > o2"))),
                             f"-{COL(2)}"))
    # K4
    R["CDL3LINESTRIKE"] = (4, IF(OR(
        AND(WH(3), WH(2), WH(1), "c2 > c3", "c1 > c2", f"o2 >= {BOT(3)} - {NEAR(3)}", f"o2 <= {TOP(3)} + {NEAR(3)}",
            f"o1 >= {BOT(2)} - {NEAR(2)}", f"o1 <= {TOP(2)} + {NEAR(2)}", BK(0), "o0 > c1", "c0 < o3"),
        AND(BK(3), BK(2), BK(1), "c2 < c3", "c1 < c2", f"o2 >= {BOT(3)} - {NEAR(3)}", f"o2 <= {TOP(3)} + {NEAR(3)}",
            f"o1 >= {BOT(2)} - {NEAR(2)}", f"o1 <= {TOP(2)} + {NEAR(2)}", WH(0), "o0 < c1", "c0 > o3")),
        COL(3)))
    # K5
    R["CDL3OUTSIDE"] = (3, IF(OR(AND(BK(2), WH(1), "c1 > o2", "o1 < c2", "c0 > c1"),
                                 AND(WH(2), BK(1), "o1 > c2", "c1 < o2", "c0 < c1")), COL(1)))
    # K6
    R["CDL3STARSINSOUTH"] = (3, IF(AND(BK(2), BK(1), BK(0), LONG(2), LSH("ls", 2), "bd1 < bd2", "o1 > c2",
                                       "o1 <= h2", "l1 > l2", f"NOT {VSSH('ls', 1)}", SHORT(0), VSSH("ls", 0),
                                       VSSH("us", 0), "l0 > l1", "h0 < h1"), 100))
    # K7
    R["CDL3WHITESOLDIERS"] = (3, IF(AND(WH(2), WH(1), WH(0), VSSH("us", 2), VSSH("us", 1), VSSH("us", 0),
                                        "c1 > c2", "c0 > c1", "o1 > o2", f"o1 <= c2 + {NEAR(2)}", "o0 > o1",
                                        f"o0 <= c1 + {NEAR(1)}", f"bd1 > bd2 - {FAR(2)}", f"bd0 > bd1 - {FAR(1)}",
                                        f"NOT {SHORT(0)}"), 100))
    # K8
    R["CDLABANDONEDBABY"] = (3, IF(AND(LONG(2), DOJI(1), f"NOT {SHORT(0)}", OR(
        AND(WH(2), RGAPUP(2, 1), BK(0), RGAPDN(1, 0), "c0 < c2 - bd2 * 0.3"),
        AND(BK(2), RGAPDN(2, 1), WH(0), RGAPUP(1, 0), "c0 > c2 + bd2 * 0.3"))), COL(0)))
    # K9
    R["CDLADVANCEBLOCK"] = (3, IF(AND(WH(2), WH(1), WH(0), "c1 > c2", "c0 > c1", "o1 > o2",
                                      f"o1 <= c2 + {NEAR(2)}", "o0 > o1", f"o0 <= c1 + {NEAR(1)}", LONG(2),
                                      SSH("us", 2), OR(AND("bd1 < bd2", "bd0 < bd1"), "us0 > us1", "us1 > us2")),
                                  -100))
    # K10
    R["CDLBELTHOLD"] = (1, IF(AND(LONG(0), OR(AND(WH(0), VSSH("ls", 0)), AND(BK(0), VSSH("us", 0)))), COL(0)))
    # K11
    R["CDLBREAKAWAY"] = (5, IF(AND(LONG(4), OR(
        AND(BK(4), BK(3), BK(1), WH(0), GAPDN(4, 3), "h2 < h3", "l2 < l3", "h1 < h2", "l1 < l2",
            "c0 > o3", "c0 < c4"),
        AND(WH(4), WH(3), WH(1), BK(0), GAPUP(4, 3), "h2 > h3", "l2 > l3", "h1 > h2", "l1 > l2",
            "c0 < o3", "c0 > c4"))), COL(0)))
    # K12
    R["CDLCLOSINGMARUBOZU"] = (1, IF(AND(LONG(0), OR(AND(WH(0), VSSH("us", 0)), AND(BK(0), VSSH("ls", 0)))), COL(0)))
    # K13
    R["CDLCONCEALBABYSWALL"] = (4, IF(AND(BK(3), BK(2), BK(1), BK(0), VSSH("ls", 3), VSSH("us", 3),
                                          VSSH("ls", 2), VSSH("us", 2), GAPDN(2, 1), "h1 > c2",
                                          "h0 > h1", "l0 < l1"), 100))
    # K14
    R["CDLCOUNTERATTACK"] = (2, IF(AND(LONG(1), LONG(0), f"{WH(1)} <> {WH(0)}", f"abs(c0 - c1) <= {EQ(1)}"), COL(0)))
    # K15
    R["CDLDARKCLOUDCOVER"] = (2, IF(AND(WH(1), LONG(1), BK(0), "o0 > h1", "c0 > o1", "c0 < c1 - bd1 * 0.5"), -100))
    # K16
    R["CDLDOJI"] = (1, IF(DOJI(0), 100))
    # K17
    R["CDLDOJISTAR"] = (2, IF(AND(LONG(1), DOJI(0), OR(AND(WH(1), GAPUP(1, 0)), AND(BK(1), GAPDN(1, 0)))),
                              f"-{COL(1)}"))
    # K18
    R["CDLDRAGONFLYDOJI"] = (1, IF(AND(DOJI(0), VSSH("us", 0), f"NOT {VSSH('ls', 0)}"), 100))
    # K19
    R["CDLENGULFING"] = (2, IF(AND(f"{WH(1)} <> {WH(0)}", f"{TOP(0)} >= {TOP(1)}", f"{BOT(0)} <= {BOT(1)}",
                                   OR(f"{TOP(0)} > {TOP(1)}", f"{BOT(0)} < {BOT(1)}")), COL(0)))
    # K20
    R["CDLEVENINGDOJISTAR"] = (3, IF(AND(WH(2), LONG(2), DOJI(1), GAPUP(2, 1), BK(0), f"NOT {SHORT(0)}",
                                         "c0 < c2 - bd2 * 0.3"), -100))
    # K21
    R["CDLEVENINGSTAR"] = (3, IF(AND(WH(2), LONG(2), SHORT(1), GAPUP(2, 1), BK(0), f"NOT {SHORT(0)}",
                                     "c0 < c2 - bd2 * 0.3"), -100))
    # K22
    R["CDLGAPSIDESIDEWHITE"] = (3, IF2(
        AND(WH(1), WH(0), GAPUP(2, 1), GAPUP(2, 0), f"abs(bd0 - bd1) < {NEAR(1)}", f"abs(o0 - o1) < {EQ(1)}"), 100,
        AND(WH(1), WH(0), GAPDN(2, 1), GAPDN(2, 0), f"abs(bd0 - bd1) < {NEAR(1)}", f"abs(o0 - o1) < {EQ(1)}"), -100))
    # K23
    R["CDLGRAVESTONEDOJI"] = (1, IF(AND(DOJI(0), VSSH("ls", 0), f"NOT {VSSH('us', 0)}"), 100))
    # K24
    R["CDLHAMMER"] = (2, IF(AND(SHORT(0), LSH("ls", 0), VSSH("us", 0), f"{BOT(0)} <= l1 + {NEAR(1)}"), 100))
    # K25
    R["CDLHANGINGMAN"] = (2, IF(AND(SHORT(0), LSH("ls", 0), VSSH("us", 0), f"{BOT(0)} >= h1 - {NEAR(1)}"), -100))
    # K26
    R["CDLHARAMI"] = (2, IF(AND(LONG(1), SHORT(0), f"{TOP(0)} < {TOP(1)}", f"{BOT(0)} > {BOT(1)}"), f"-{COL(1)}"))
    # K27
    R["CDLHARAMICROSS"] = (2, IF(AND(LONG(1), DOJI(0), f"{TOP(0)} < {TOP(1)}", f"{BOT(0)} > {BOT(1)}"), f"-{COL(1)}"))
    # K28
    R["CDLHIGHWAVE"] = (1, IF(AND(SHORT(0), VLSH("us", 0), VLSH("ls", 0)), COL(0)))
    # K31
    R["CDLHOMINGPIGEON"] = (2, IF(AND(BK(1), BK(0), LONG(1), SHORT(0), "o0 < o1", "c0 > c1"), 100))
    # K32
    R["CDLIDENTICAL3CROWS"] = (3, IF(AND(BK(2), BK(1), BK(0), VSSH("ls", 2), VSSH("ls", 1), VSSH("ls", 0),
                                         "c1 < c2", "c0 < c1", f"abs(o1 - c2) <= {EQ(2)}",
                                         f"abs(o0 - c1) <= {EQ(1)}"), -100))
    # K33
    R["CDLINNECK"] = (2, IF(AND(BK(1), LONG(1), WH(0), "o0 < l1", "c0 >= c1", f"c0 <= c1 + {EQ(1)}"), -100))
    # K34
    R["CDLINVERTEDHAMMER"] = (2, IF(AND(SHORT(0), LSH("us", 0), VSSH("ls", 0), GAPDN(1, 0)), 100))
    # K35
    R["CDLKICKING"] = (2, IF(AND(f"{WH(1)} <> {WH(0)}", LONG(1), LONG(0), VSSH("us", 1), VSSH("ls", 1),
                                 VSSH("us", 0), VSSH("ls", 0),
                                 OR(AND(BK(1), RGAPUP(1, 0)), AND(WH(1), RGAPDN(1, 0)))), COL(0)))
    # K36
    R["CDLKICKINGBYLENGTH"] = (2, IF(AND(f"{WH(1)} <> {WH(0)}", LONG(1), LONG(0), VSSH("us", 1), VSSH("ls", 1),
                                         VSSH("us", 0), VSSH("ls", 0),
                                         OR(AND(BK(1), RGAPUP(1, 0)), AND(WH(1), RGAPDN(1, 0)))),
                                     f"(CASE WHEN bd0 > bd1 THEN {COL(0)} ELSE {COL(1)} END)"))
    # K37
    R["CDLLADDERBOTTOM"] = (5, IF(AND(BK(4), BK(3), BK(2), "o3 < o4", "o2 < o3", "c3 < c4", "c2 < c3",
                                      BK(1), f"NOT {VSSH('us', 1)}", WH(0), "o0 > o1", "c0 > h1"), 100))
    # K38
    R["CDLLONGLEGGEDDOJI"] = (1, IF(AND(DOJI(0), OR(LSH("us", 0), LSH("ls", 0))), 100))
    # K39
    R["CDLLONGLINE"] = (1, IF(AND(LONG(0), SSH("us", 0), SSH("ls", 0)), COL(0)))
    # K40
    R["CDLMARUBOZU"] = (1, IF(AND(LONG(0), VSSH("us", 0), VSSH("ls", 0)), COL(0)))
    # K41
    R["CDLMATCHINGLOW"] = (2, IF(AND(BK(1), BK(0), f"abs(c0 - c1) <= {EQ(1)}"), 100))
    # K42
    R["CDLMATHOLD"] = (5, IF(AND(WH(4), LONG(4), BK(3), SHORT(3), GAPUP(4, 3), SHORT(2), SHORT(1),
                                 f"{TOP(2)} < {TOP(3)}", f"{TOP(1)} < {TOP(2)}",
                                 f"{BOT(2)} > c4 - bd4 * 0.5", f"{BOT(1)} > c4 - bd4 * 0.5",
                                 WH(0), "o0 > c1", "c0 > greatest(h3, h2, h1)"), 100))
    # K43
    R["CDLMORNINGDOJISTAR"] = (3, IF(AND(BK(2), LONG(2), DOJI(1), GAPDN(2, 1), WH(0), f"NOT {SHORT(0)}",
                                         "c0 > c2 + bd2 * 0.3"), 100))
    # K44
    R["CDLMORNINGSTAR"] = (3, IF(AND(BK(2), LONG(2), SHORT(1), GAPDN(2, 1), WH(0), f"NOT {SHORT(0)}",
                                     "c0 > c2 + bd2 * 0.3"), 100))
    # K45
    R["CDLONNECK"] = (2, IF(AND(BK(1), LONG(1), WH(0), "o0 < l1", f"abs(c0 - l1) <= {EQ(1)}"), -100))
    # K46
    R["CDLPIERCING"] = (2, IF(AND(BK(1), LONG(1), WH(0), LONG(0), "o0 < l1", "c0 < o1", "c0 > c1 + bd1 * 0.5"), 100))
    # K47
    R["CDLRICKSHAWMAN"] = (1, IF(AND(DOJI(0), LSH("us", 0), LSH("ls", 0),
                                     f"least(o0, c0) <= l0 + rg0 / 2 + {NEAR(0)}",
                                     f"greatest(o0, c0) >= l0 + rg0 / 2 - {NEAR(0)}"), 100))
    # K48
    R["CDLRISEFALL3METHODS"] = (5, IF(OR(
        AND(WH(4), LONG(4), SHORT(3), SHORT(2), SHORT(1), BK(3), BK(2), BK(1), LONG(0), WH(0),
            f"{TOP(3)} < h4", f"{BOT(3)} > l4", f"{TOP(2)} < h4", f"{BOT(2)} > l4", f"{TOP(1)} < h4", f"{BOT(1)} > l4",
            "c2 < c3", "c1 < c2", "o0 > c1", "c0 > c4"),
        AND(BK(4), LONG(4), SHORT(3), SHORT(2), SHORT(1), WH(3), WH(2), WH(1), LONG(0), BK(0),
            f"{TOP(3)} < h4", f"{BOT(3)} > l4", f"{TOP(2)} < h4", f"{BOT(2)} > l4", f"{TOP(1)} < h4", f"{BOT(1)} > l4",
            "c2 > c3", "c1 > c2", "o0 < c1", "c0 < c4")), COL(4)))
    # K49
    R["CDLSEPARATINGLINES"] = (2, IF(AND(f"{WH(1)} <> {WH(0)}", f"abs(o0 - o1) <= {EQ(1)}", LONG(0),
                                         OR(AND(WH(0), VSSH("ls", 0)), AND(BK(0), VSSH("us", 0)))), COL(0)))
    # K50
    R["CDLSHOOTINGSTAR"] = (2, IF(AND(SHORT(0), LSH("us", 0), VSSH("ls", 0), GAPUP(1, 0)), -100))
    # K51
    R["CDLSHORTLINE"] = (1, IF(AND(SHORT(0), SSH("us", 0), SSH("ls", 0)), COL(0)))
    # K52
    R["CDLSPINNINGTOP"] = (1, IF(AND(SHORT(0), "us0 > bd0", "ls0 > bd0"), COL(0)))
    # K53
    R["CDLSTALLEDPATTERN"] = (3, IF(AND(WH(2), WH(1), WH(0), "c1 > c2", "c0 > c1", LONG(2), LONG(1),
                                        VSSH("us", 1), "o1 > o2", f"o1 <= c2 + {NEAR(2)}", SHORT(0),
                                        f"o0 >= c1 - bd0 - {NEAR(1)}"), -100))
    # K54
    R["CDLSTICKSANDWICH"] = (3, IF(AND(BK(2), WH(1), BK(0), "l1 > c2", f"abs(c0 - c2) <= {EQ(2)}"), 100))
    # K55
    R["CDLTAKURI"] = (1, IF(AND(DOJI(0), VSSH("us", 0), VLSH("ls", 0)), 100))
    # K56
    R["CDLTASUKIGAP"] = (3, IF(OR(
        AND(GAPUP(2, 1), WH(1), BK(0), INBODY("o0", 1), "c0 < o1", f"c0 > {TOP(2)}", f"abs(bd1 - bd0) < {NEAR(1)}"),
        AND(GAPDN(2, 1), BK(1), WH(0), INBODY("o0", 1), "c0 > o1", f"c0 < {BOT(2)}", f"abs(bd1 - bd0) < {NEAR(1)}")),
        COL(1)))
    # K57
    R["CDLTHRUSTING"] = (2, IF(AND(BK(1), LONG(1), WH(0), "o0 < l1", f"c0 > c1 + {EQ(1)}",
                                   "c0 <= c1 + bd1 * 0.5"), -100))
    # K58
    R["CDLTRISTAR"] = (3, IF2(AND(DOJI(2), DOJI(1), DOJI(0), GAPUP(2, 1), f"{TOP(0)} < {TOP(1)}"), -100,
                              AND(DOJI(2), DOJI(1), DOJI(0), GAPDN(2, 1), f"{BOT(0)} > {BOT(1)}"), 100))
    # K59
    R["CDLUNIQUE3RIVER"] = (3, IF(AND(BK(2), LONG(2), BK(1), "c1 > c2", "o1 <= o2", "l1 < l2", SHORT(0), WH(0),
                                      "o0 > l1"), 100))
    # K60
    R["CDLUPSIDEGAP2CROWS"] = (3, IF(AND(WH(2), LONG(2), BK(1), SHORT(1), GAPUP(2, 1), BK(0), "o0 > o1",
                                         "c0 < c1", "c0 > c2"), -100))
    # K61
    R["CDLXSIDEGAP3METHODS"] = (3, IF(OR(
        AND(WH(2), WH(1), BK(0), GAPUP(2, 1), INBODY("o0", 1), INBODY("c0", 2)),
        AND(BK(2), BK(1), WH(0), GAPDN(2, 1), INBODY("o0", 1), INBODY("c0", 2))), COL(2)))
    return R


# hikkake: a pattern bar (inside bar then a break) and its confirmation within 3 bars
HIKKAKE_BASE = ("(CASE WHEN h1 < h2 AND l1 > l2 AND h0 < h1 AND l0 < l1 THEN 1 "
                "WHEN h1 < h2 AND l1 > l2 AND h0 > h1 AND l0 > l1 THEN -1 ELSE 0 END)")
HIKKAKEMOD_BASE = ("(CASE WHEN h2 < h3 AND l2 > l3 AND h1 < h2 AND l1 > l2 AND c1 <= l1 + 0.2 * rg1 "
                   "AND h0 < h1 AND l0 < l1 THEN 1 "
                   "WHEN h2 < h3 AND l2 > l3 AND h1 < h2 AND l1 > l2 AND c1 >= h1 - 0.2 * rg1 "
                   "AND h0 > h1 AND l0 > l1 THEN -1 ELSE 0 END)")


def hikkake_confirm(base: str, ref_back: int) -> str:
    """Value at the current bar given the base flag column ``base`` and its lags
    ``base1..base3``: ±100 on a pattern bar; ±200 on the first bar within 3
    bars after a pattern whose close passes the reference (inside) bar's high
    (bullish) or low (bearish); the most recent pattern wins."""
    parts = [f"WHEN {base}0 <> 0 THEN {base}0 * 100"]
    for j in (1, 2, 3):
        newer = " AND ".join([f"{base}{i} = 0" for i in range(1, j)]) or "TRUE"
        rk = j + ref_back
        notyet_up = " AND ".join([f"c{i} <= h{rk}" for i in range(1, j)]) or "TRUE"
        notyet_dn = " AND ".join([f"c{i} >= l{rk}" for i in range(1, j)]) or "TRUE"
        parts.append(f"WHEN {base}{j} = 1 AND {newer} AND c0 > h{rk} AND {notyet_up} THEN 200")
        parts.append(f"WHEN {base}{j} = -1 AND {newer} AND c0 < l{rk} AND {notyet_dn} THEN -200")
    return "(CASE " + " ".join(parts) + " ELSE 0 END)"


RULES = _rules()
# (bars, base expression, reference bar offset from the pattern bar)
HIKKAKE = {"CDLHIKKAKE": (3, HIKKAKE_BASE, 1), "CDLHIKKAKEMOD": (4, HIKKAKEMOD_BASE, 1)}
ALL_PATTERNS = sorted(list(RULES) + list(HIKKAKE))


def lookback(name: str) -> int:
    bars = RULES[name][0] if name in RULES else HIKKAKE[name][0]
    return AVG_BARS + bars - 1


# ------------------------------------------------------------- Spark builders
HELPER_BASE = ["o", "c", "h", "l", "bd", "us", "ls", "rg", "ab", "ar", "as", "ar5"]


def helper_feat(w: Win, o="open", h="high", l="low", c="close") -> Feat:
    """Per-bar helper columns (suffix 0) and their lags (suffix 1..MAXLAG)."""
    oc, hc, lc, cc = F.col(o), F.col(h), F.col(l), F.col(c)
    prev10 = w.span(-AVG_BARS, -1)
    prev5 = w.span(-5, -1)
    steps = [("o0", oc), ("c0", cc), ("h0", hc), ("l0", lc),
             ("bd0", F.abs(cc - oc)), ("us0", hc - F.greatest(oc, cc)), ("ls0", F.least(oc, cc) - lc),
             ("rg0", hc - lc)]
    steps += [("ab0", F.avg(F.col("bd0")).over(prev10)), ("ar0", F.avg(F.col("rg0")).over(prev10)),
              ("as0", F.avg(F.col("us0") + F.col("ls0")).over(prev10)), ("ar50", F.avg(F.col("rg0")).over(prev5))]
    for k in range(1, MAXLAG + 1):
        for b in HELPER_BASE:
            steps.append((f"{b}{k}", w.lag(F.col(f"{b}0"), k)))
    return Feat(steps, AVG_BARS + MAXLAG)


def pattern_feats(w: Win, names=None) -> Feat:
    """Raw pattern columns (0/±100, NULL until the pattern's lookback)."""
    names = names or ALL_PATTERNS
    f = helper_feat(w)
    steps = list(f.steps)
    for n in names:
        if n in HIKKAKE:
            bars, base, ref = HIKKAKE[n]
            bname = f"_{n}_b"
            steps.append((f"{bname}0", F.expr(base)))
            for j in (1, 2, 3):
                steps.append((f"{bname}{j}", w.lag(F.col(f"{bname}0"), j)))
            expr = hikkake_confirm(bname, ref)
        else:
            expr = RULES[n][1]
        steps.append((n, F.when(F.col("rn") > lookback(n), F.expr(expr).cast("int"))))
    return Feat(steps, AVG_BARS + MAXLAG + 3)


HELPER_COLUMNS = [f"{b}{k}" for k in range(0, MAXLAG + 1) for b in HELPER_BASE]


def pattern_wma_feats(w: Win, names=None, n: int = 300) -> Feat:
    """WMA(n) of each pattern column (class F, lookback pattern LB + n − 1).

    Pattern values are small integers and positions are block-local, so running
    sums of x and x·position are exact; each window sum is a lag difference
    (O(1) per row instead of re-reading n rows)."""
    from pyspark.sql import Window
    names = names or ALL_PATTERNS
    p = w.pos
    run = w.o.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps, finals = [], []
    for name in names:
        x = F.col(name).cast("double")
        r0, r1 = f"_pw0_{name}", f"_pw1_{name}"
        steps += [(r0, F.sum(x).over(run)), (r1, F.sum(x * p).over(run))]
        s0 = F.col(r0) - F.coalesce(F.lag(F.col(r0), n).over(w.o), F.lit(0.0))
        s1 = F.col(r1) - F.coalesce(F.lag(F.col(r1), n).over(w.o), F.lit(0.0))
        val = (s1 - (p - F.lit(float(n))) * s0) / F.lit(n * (n + 1) / 2.0)
        finals.append((f"{name}_wma{n}", F.when(F.col("rn") > lookback(name) + n - 1, val)))
    return Feat(steps + finals, n)
