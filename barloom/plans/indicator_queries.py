"""Indicator queries over the daily bar fixture, each with its DuckDB oracle.

Spark side: ``bars_daily`` → :func:`sequence` (blocks of 512 rows, scan blocks
of 128, so the halo and carry paths are exercised) → builder → rounded outputs.
SQL side: the textbook definition — window functions over one partition per
symbol, lag expansions for weighted sums, and row-by-row recursive CTEs for
recurrences.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import finite as FI
from barloom.functions import recurrent as RC
from barloom.plans.frame import Win
from barloom.plans.oracle import DAILY_CTES
from barloom.plans.queries import daily_frame, finish
from barloom.plans.sqlkit import DIV, G, LAG, R, W, WR
from barloom.plans import sqlkit as SK

SPARK: dict = {}
SQL: dict = {}

CLOSE = "close"
WINDOW = "WINDOW w AS (PARTITION BY symbol ORDER BY rn)"


def _q(build, cols, digits, per_col):
    def q(spark, sf):
        fr = daily_frame(spark, sf)
        fr = build(fr)
        return finish(fr.df.select("symbol", "ts", *cols), digits, per_col)
    return q


def _fsql(layers, cols, digits, per_col=None):
    per_col = per_col or {}
    ctes, prev = [DAILY_CTES], "bd"
    for i, layer in enumerate(layers):
        body = ", ".join(f"{e} AS {n}" for n, e in layer)
        ctes.append(f"l{i} AS (SELECT *, {body} FROM {prev} {WINDOW})")
        prev = f"l{i}"
    sel = ", ".join(f"{R(c, per_col.get(c, digits))} AS {c}" for c in cols)
    return f"WITH {', '.join(ctes)} SELECT symbol, ts, {sel} FROM {prev}"


def finite_case(qid, feats, layers, cols, digits=4, per_col=None):
    """Register a finite-window query: ``feats(w)`` → list of Feat; ``layers`` = SQL."""
    def build(fr):
        return fr.add(*feats(Win(fr.key, fr.block)))
    SPARK[qid] = _q(build, cols, digits, per_col)
    SQL[qid] = _fsql(layers, cols, digits, per_col)


def recur_case(qid, build, sql, cols, digits=4, per_col=None):
    """Register a recurrence query; ``sql`` returns (symbol, ts, cols) unrounded."""
    per_col = per_col or {}
    SPARK[qid] = _q(build, cols, digits, per_col)
    sel = ", ".join(f"{R(c, per_col.get(c, digits))} AS {c}" for c in cols)
    SQL[qid] = f"SELECT symbol, ts, {sel} FROM ({sql}) t"


def _wsum_lags(x, n):
    """Σ_{k=1..n} k·x_{t−n+k} written as lags."""
    return " + ".join(f"{n - j} * {LAG(x, j) if j else x}" for j in range(n))


# ===================================================================== class X
finite_case("x1_x4_price_transforms",
            lambda w: [FI.avgprice(), FI.medprice(), FI.typprice(), FI.wclprice(), FI.bop()],
            [[("AVGPRICE", "(open + high + low + close) / 4.0"), ("MEDPRICE", "(high + low) / 2.0"),
              ("TYPPRICE", "(high + low + close) / 3.0"), ("WCLPRICE", "(high + low + 2.0 * close) / 4.0"),
              ("BOP", DIV("close - open", "high - low"))]],
            ["AVGPRICE", "MEDPRICE", "TYPPRICE", "WCLPRICE", "BOP"], 4, {"BOP": 8})

_MATH_SQL = {
    "ACOS": "CASE WHEN x BETWEEN -1 AND 1 THEN acos(x) END", "ASIN": "CASE WHEN x BETWEEN -1 AND 1 THEN asin(x) END",
    "ATAN": "atan(x)", "CEIL": "CAST(ceil(x) AS DOUBLE)", "COS": "cos(x)",
    "COSH": "CASE WHEN abs(x) <= 700 THEN (exp(x) + exp(-x)) / 2 END", "EXP": "CASE WHEN x <= 700 THEN exp(x) END",
    "FLOOR": "CAST(floor(x) AS DOUBLE)", "LN": "CASE WHEN x > 0 THEN ln(x) END",
    "LOG10": "CASE WHEN x > 0 THEN log10(x) END", "SIN": "sin(x)",
    "SINH": "CASE WHEN abs(x) <= 700 THEN (exp(x) - exp(-x)) / 2 END",
    "SQRT": "CASE WHEN x >= 0 THEN sqrt(x) END", "TAN": "tan(x)", "TANH": "tanh(x)",
}


def _math_build(fr):
    fr = fr.with_columns(x=(F.col("close") - F.lit(250000.0)) / F.lit(250000.0))
    feats = [FI.math_transform(n, "x", out=n) for n in _MATH_SQL]
    return fr.add(*feats)


SPARK["x6_math_transforms"] = _q(_math_build, list(_MATH_SQL), 8, None)
SQL["x6_math_transforms"] = _fsql(
    [[("x", "(close - 250000.0) / 250000.0")], [(k, v) for k, v in _MATH_SQL.items()]],
    list(_MATH_SQL), 8)

finite_case("x7_math_operators",
            lambda w: [FI.math_operator(n) for n in ("ADD", "SUB", "MULT", "DIV")],
            [[("ADD", "high + low"), ("SUB", "high - low"), ("MULT", "high * low"),
              ("DIV", DIV("high", "low", "NULL"))]],
            ["ADD", "SUB", "MULT", "DIV"], 4, {"MULT": -2, "DIV": 8})

# ===================================================================== class F
finite_case("w01_sma", lambda w: [FI.sma(w, n=7), FI.sma(w, n=37)],
            [[("SMA_7", G(6, f"avg(close) {W(7)}")), ("SMA_37", G(36, f"avg(close) {W(37)}"))]],
            ["SMA_7", "SMA_37"])

finite_case("w03_wma", lambda w: [FI.wma(w, n=9), FI.wma(w, n=37)],
            [[("WMA_9", G(8, f"({_wsum_lags('close', 9)}) / 45.0")),
              ("WMA_37", G(36, f"({_wsum_lags('close', 37)}) / 703.0"))]],
            ["WMA_9", "WMA_37"], 4)

finite_case("w06_trima", lambda w: [FI.trima(w, n=9), FI.trima(w, n=18)],
            [[("t9", f"avg(close) {W(5)}"), ("t18", f"avg(close) {W(9)}")],
             [("TRIMA_9", G(8, f"avg(t9) {W(5)}")), ("TRIMA_18", G(17, f"avg(t18) {W(10)}"))]],
            ["TRIMA_9", "TRIMA_18"])

finite_case("w10_bbands", lambda w: [FI.bbands(w, n=5)],
            [[("BBANDS_5_upper", G(4, f"avg(close) {W(5)} + 2.0 * stddev_pop(close) {W(5)}")),
              ("BBANDS_5_middle", G(4, f"avg(close) {W(5)}")),
              ("BBANDS_5_lower", G(4, f"avg(close) {W(5)} - 2.0 * stddev_pop(close) {W(5)}"))]],
            ["BBANDS_5_upper", "BBANDS_5_middle", "BBANDS_5_lower"], 3)

finite_case("w11_w12_midpoint_midprice", lambda w: [FI.midpoint(w, n=14), FI.midprice(w, n=14)],
            [[("MIDPOINT_14", G(13, f"(max(close) {W(14)} + min(close) {W(14)}) / 2.0")),
              ("MIDPRICE_14", G(13, f"(max(high) {W(14)} + min(low) {W(14)}) / 2.0"))]],
            ["MIDPOINT_14", "MIDPRICE_14"])

finite_case("w16_macdext_sma", lambda w: [FI.macdext_sma(w, fast=7, slow=17, signal=5)],
            [[("m", f"avg(close) {W(7)} - avg(close) {W(17)}")],
             [("MACDEXT_7_17_5_macd", G(20, "m")), ("MACDEXT_7_17_5_signal", G(20, f"avg(m) {W(5)}")),
              ("MACDEXT_7_17_5_hist", G(20, f"m - avg(m) {W(5)}"))]],
            ["MACDEXT_7_17_5_macd", "MACDEXT_7_17_5_signal", "MACDEXT_7_17_5_hist"], 3)

finite_case("w18_w19_apo_ppo", lambda w: [FI.apo(w, fast=7, slow=14), FI.ppo(w, fast=7, slow=14)],
            [[("APO_7_14", G(13, f"avg(close) {W(7)} - avg(close) {W(14)}")),
              ("PPO_7_14", G(13, DIV(f"(avg(close) {W(7)} - avg(close) {W(14)}) * 100.0", f"avg(close) {W(14)}")))]],
            ["APO_7_14", "PPO_7_14"], 4, {"PPO_7_14": 6})

finite_case("w20_w22_mom_roc_rocr", lambda w: [FI.mom(w, n=7), FI.roc(w, n=7), FI.rocr(w, n=37)],
            [[("MOM_7", G(7, f"close - {LAG('close', 7)}")),
              ("ROC_7", G(7, f"CASE WHEN {LAG('close', 7)} <> 0 THEN (close / {LAG('close', 7)} - 1.0) * 100.0 ELSE 0.0 END")),
              ("ROCR_37", G(37, DIV("close", LAG('close', 37))))]],
            ["MOM_7", "ROC_7", "ROCR_37"], 4, {"ROC_7": 6, "ROCR_37": 8})


def _fastk_sql(n):
    return DIV(f"(close - min(low) {W(n)}) * 100.0", f"max(high) {W(n)} - min(low) {W(n)}")


finite_case("w25_stoch", lambda w: [FI.stoch(w, fastk=7, slowk=3, slowd=3)],
            [[("k", _fastk_sql(7))], [("sk", f"avg(k) {W(3)}")],
             [("STOCH_7_3_3_slowk", G(10, "sk")), ("STOCH_7_3_3_slowd", G(10, f"avg(sk) {W(3)}"))]],
            ["STOCH_7_3_3_slowk", "STOCH_7_3_3_slowd"], 6)

finite_case("w26_stochf", lambda w: [FI.stochf(w, fastk=7, fastd=3)],
            [[("k", _fastk_sql(7))],
             [("STOCHF_7_3_fastk", G(8, "k")), ("STOCHF_7_3_fastd", G(8, f"avg(k) {W(3)}"))]],
            ["STOCHF_7_3_fastk", "STOCHF_7_3_fastd"], 6)

finite_case("w28_willr", lambda w: [FI.willr(w, n=14)],
            [[("WILLR_14", G(13, DIV(f"(max(high) {W(14)} - close) * -100.0", f"max(high) {W(14)} - min(low) {W(14)}")))]],
            ["WILLR_14"], 6)


def _cci_sql(n):
    mad = " + ".join(f"abs({LAG('tp', j) if j else 'tp'} - sm)" for j in range(n))
    return [[("tp", "(high + low + close) / 3.0")], [("sm", f"avg(tp) {W(n)}")],
            [(f"CCI_{n}", G(n - 1, f"CASE WHEN ({mad}) = 0 OR tp - sm = 0 THEN 0.0 "
                                    f"ELSE (tp - sm) / (0.015 * ({mad}) / {n}.0) END"))]]


finite_case("w29_cci", lambda w: [FI.cci(w, n=14)], _cci_sql(14), ["CCI_14"], 5)


def _q_cci(spark, sf):
    """By rank tables per block: the cost does not grow with the window."""
    from barloom.plans.feature_arrays import cci_blocks
    return finish(cci_blocks(daily_frame(spark, sf), 14).df.select("symbol", "ts", "CCI_14"), 5)


SPARK["w29_cci"] = _q_cci


def _aroon_sql(n):
    up = f"(max({{'v': high, 'r': rn}}) {WR(n)}).r"
    dn = f"(max({{'v': -low, 'r': rn}}) {WR(n)}).r"
    return up, dn


_au, _ad = _aroon_sql(14)
finite_case("w30_w31_aroon_aroonosc", lambda w: [FI.aroon(w, n=14), FI.aroonosc(w, n=14)],
            [[("AROON_14_aroondown", G(14, f"(14.0 - (rn - {_ad})) * (100.0 / 14)")),
              ("AROON_14_aroonup", G(14, f"(14.0 - (rn - {_au})) * (100.0 / 14)"))],
             [("AROONOSC_14", "AROON_14_aroonup - AROON_14_aroondown")]],
            ["AROON_14_aroondown", "AROON_14_aroonup", "AROONOSC_14"], 6)

finite_case("w32_mfi", lambda w: [FI.mfi(w, n=14)],
            [[("tp", "(high + low + close) / 3.0")],
             [("pf", f"CASE WHEN tp > {LAG('tp', 1)} THEN tp * volume ELSE 0.0 END"),
              ("nf", f"CASE WHEN tp < {LAG('tp', 1)} THEN tp * volume ELSE 0.0 END")],
             [("MFI_14", G(14, f"CASE WHEN sum(pf) {W(14)} + sum(nf) {W(14)} < 1.0 THEN 0.0 "
                              f"ELSE sum(pf) {W(14)} * 100.0 / (sum(pf) {W(14)} + sum(nf) {W(14)}) END"))]],
            ["MFI_14"], 6)

finite_case("w34_ultosc", lambda w: [FI.ultosc(w, p1=7, p2=14, p3=28)],
            [[("pc", LAG("close", 1))],
             [("bp", "close - least(low, pc)"), ("tr", "greatest(high, pc) - least(low, pc)")],
             [("ULTOSC_7_14_28", G(28, f"({DIV(f'sum(bp) {W(7)}', f'sum(tr) {W(7)}')} * 4.0 + "
                                      f"{DIV(f'sum(bp) {W(14)}', f'sum(tr) {W(14)}')} * 2.0 + "
                                      f"{DIV(f'sum(bp) {W(28)}', f'sum(tr) {W(28)}')}) * (100.0 / 7.0)"))]],
            ["ULTOSC_7_14_28"], 6)

finite_case("w42_trange", lambda w: [FI.trange(w)],
            [[("TRANGE", G(1, f"greatest(high - low, abs(high - {LAG('close', 1)}), abs(low - {LAG('close', 1)}))"))]],
            ["TRANGE"])

finite_case("w53_beta", lambda w: [FI.beta(w, n=7)],
            [[("rx", DIV("high", LAG("high", 1), "NULL") + " - 1.0"), ("ry", DIV("low", LAG("low", 1), "NULL") + " - 1.0")],
             [("BETA_7", G(7, f"CASE WHEN var_pop(rx) {W(7)} > 0 THEN regr_slope(ry, rx) {W(7)} ELSE 0.0 END"))]],
            ["BETA_7"], 6)

finite_case("w54_correl", lambda w: [FI.correl(w, n=17)],
            [[("CORREL_17", G(16, f"CASE WHEN stddev_pop(high) {W(17)} > 0 AND stddev_pop(low) {W(17)} > 0 "
                                 f"THEN corr(high, low) {W(17)} ELSE 0.0 END"))]],
            ["CORREL_17"], 6)

_SL, _IC = f"regr_slope(close, rn) {W(14)}", f"regr_intercept(close, rn) {W(14)}"
finite_case("w55_w58_w60_linearreg_family",
            lambda w: [FI.linearreg(w, n=14), FI.linearreg_slope(w, n=14), FI.linearreg_angle(w, n=14),
                       FI.linearreg_intercept(w, n=14), FI.tsf(w, n=14)],
            [[("LINEARREG_14", G(13, f"{_IC} + {_SL} * rn")),
              ("LINEARREG_SLOPE_14", G(13, _SL)),
              ("LINEARREG_ANGLE_14", G(13, f"degrees(atan({_SL}))")),
              ("LINEARREG_INTERCEPT_14", G(13, f"{_IC} + {_SL} * (rn - 13)")),
              ("TSF_14", G(13, f"{_IC} + {_SL} * (rn + 1)"))]],
            ["LINEARREG_14", "LINEARREG_SLOPE_14", "LINEARREG_ANGLE_14", "LINEARREG_INTERCEPT_14", "TSF_14"], 2,
            {"LINEARREG_ANGLE_14": 6})

finite_case("w59_w61_stddev_var", lambda w: [FI.stddev(w, n=7), FI.var(w, n=7)],
            [[("STDDEV_7", G(6, f"stddev_pop(close) {W(7)}")), ("VAR_7", G(6, f"var_pop(close) {W(7)}"))]],
            ["STDDEV_7", "VAR_7"], 3, {"VAR_7": -3})

finite_case("w62_w64_max_min_sum",
            lambda w: [FI.rmax(w, n=7), FI.rmin(w, n=7), FI.minmax(w, n=17), FI.rsum(w, n=7)],
            [[("MAX_7", G(6, f"max(close) {W(7)}")), ("MIN_7", G(6, f"min(close) {W(7)}")),
              ("MINMAX_17_min", G(16, f"min(close) {W(17)}")), ("MINMAX_17_max", G(16, f"max(close) {W(17)}")),
              ("SUM_7", G(6, f"sum(close) {W(7)}"))]],
            ["MAX_7", "MIN_7", "MINMAX_17_min", "MINMAX_17_max", "SUM_7"], 3)

finite_case("w63_extreme_index",
            lambda w: [FI.maxindex(w, n=7), FI.minindex(w, n=7), FI.minmaxindex(w, n=17)],
            [[("MAXINDEX_7", G(6, f"(max({{'v': close, 'r': rn}}) {W(7)}).r - 1")),
              ("MININDEX_7", G(6, f"(max({{'v': -close, 'r': rn}}) {W(7)}).r - 1")),
              ("MINMAXINDEX_17_minidx", G(16, f"(max({{'v': -close, 'r': rn}}) {W(17)}).r - 1")),
              ("MINMAXINDEX_17_maxidx", G(16, f"(max({{'v': close, 'r': rn}}) {W(17)}).r - 1"))]],
            ["MAXINDEX_7", "MININDEX_7", "MINMAXINDEX_17_minidx", "MINMAXINDEX_17_maxidx"], 0)

finite_case("w65_pct_change",
            lambda w: [FI.pct_change(w, c, 10) for c in ("open", "high", "low", "close", "volume")],
            [[(f"{c}_change", G(10, DIV(c, LAG(c, 10), "NULL") + " - 1.0")) for c in ("open", "high", "low", "close", "volume")]],
            [f"{c}_change" for c in ("open", "high", "low", "close", "volume")], 8)

finite_case("w66_shift_lag_lead",
            lambda w: [FI.shift(w, "close", 3), FI.shift(w, "close", 30), FI.shift(w, "close", -5)],
            [[("close_lag3", LAG("close", 3)), ("close_lag30", LAG("close", 30)), ("close_lead5", SK.LEAD("close", 5))]],
            ["close_lag3", "close_lag30", "close_lead5"], 2)

finite_case("w68_log_return",
            lambda w: [FI.log_return(w, "close", 10, 0, "LOGRET_10"), FI.log_return(w, "close", 10, -10, "LOGRET_10_fut"),
                       FI.log_return(w, "close", 10, 20, "LOGRET_10_lag20")],
            [[("lr", f"CASE WHEN close > 0 AND {LAG('close', 10)} > 0 THEN ln(close / {LAG('close', 10)}) END")],
             [("LOGRET_10", "lr"), ("LOGRET_10_fut", SK.LEAD("lr", 10)), ("LOGRET_10_lag20", LAG("lr", 20))]],
            ["LOGRET_10", "LOGRET_10_fut", "LOGRET_10_lag20"], 8)

finite_case("w69_residual_ratio", lambda w: [FI.residual_ratio(w, n=25, m=25)],
            [[("e1", G(24, f"pow(close - (regr_intercept(close, rn) {W(25)} + regr_slope(close, rn) {W(25)} * rn), 2)")),
              ("e2", G(24, f"pow(close - avg(close) {W(25)}, 2)"))],
             [("RSS_25_25_reg", G(48, f"sum(e1) {W(25)}")), ("RSS_25_25_sma", G(48, f"sum(e2) {W(25)}")),
              ("RSS_25_25_ratio", G(48, DIV(f"sum(e1) {W(25)}", f"sum(e2) {W(25)}", "NULL")))]],
            ["RSS_25_25_reg", "RSS_25_25_sma", "RSS_25_25_ratio"], 4,
            {"RSS_25_25_reg": -5, "RSS_25_25_sma": -5})

finite_case("w70_trend_score", lambda w: [FI.trend_score(w, n=25)],
            [[("TREND_25", G(24, f"{DIV(f'regr_slope(close, rn) {W(25)}', f'first_value(close) {W(25)}', 'NULL')}"
                                 f" * coalesce(regr_r2(close, rn) {W(25)}, 0.0) * 10000.0"))]],
            ["TREND_25"], 5)

finite_case("w72_diff_ratio", lambda w: [FI.diff_ratio(w, k=10), FI.diff_ratio(w, k=20)],
            [[("DIFFR_10", G(10, DIV(f"close - {LAG('close', 10)}", "close", "NULL"))),
              ("DIFFR_20", G(20, DIV(f"close - {LAG('close', 20)}", "close", "NULL")))]],
            ["DIFFR_10", "DIFFR_20"], 8)

finite_case("w73_rolling_sum", lambda w: [FI.rolling_sum(w, "volume", 10)],
            [[("volume_rsum10", G(9, f"sum(volume) {W(10)}"))]], ["volume_rsum10"], 4)


# ============================================================ classes L and C
def _lsql(pre, recs, joins, post, cols, digits=4, per_col=None):
    """pre: window layers over bd (last one named ``pre``); recs: recursive CTE
    strings; joins: names of recursion outputs joined back on (symbol, rn);
    post: window layers over the joined table."""
    per_col = per_col or {}
    ctes, prev = [DAILY_CTES], "bd"
    for i, layer in enumerate(pre):
        body = ", ".join(f"{e} AS {n}" for n, e in layer)
        ctes.append(f"p{i} AS (SELECT *, {body} FROM {prev} {WINDOW})")
        prev = f"p{i}"
    ctes.append(f"pre AS (SELECT * FROM {prev})")
    ctes.extend(r.strip() for r in recs)
    j = "pre" + "".join(f" JOIN {t} USING (symbol, rn)" for t in joins)
    ctes.append(f"j0 AS (SELECT * FROM {j})")
    prev = "j0"
    for i, layer in enumerate(post):
        body = ", ".join(f"{e} AS {n}" for n, e in layer)
        ctes.append(f"q{i} AS (SELECT *, {body} FROM {prev} {WINDOW})")
        prev = f"q{i}"
    sel = ", ".join(cols)
    return f"WITH RECURSIVE {', '.join(ctes)} SELECT symbol, ts, {sel} FROM {prev}"


recur_case("w02_ema", lambda fr: RC.ema(RC.ema(fr, n=7), n=37),
           _lsql([], [SK.ema("EMA_7", "pre", "close", 7), SK.ema("EMA_37", "pre", "close", 37)],
                 ["EMA_7", "EMA_37"], [], ["EMA_7", "EMA_37"]), ["EMA_7", "EMA_37"], 3)

recur_case("w04_dema", lambda fr: RC.dema(fr, n=7),
           _lsql([], [SK.ema("e1", "pre", "close", 7), SK.ema("e2", "e1", "e1", 7, start=7)], ["e1", "e2"],
                 [[("DEMA_7", "2.0 * e1 - e2")]], ["DEMA_7"]), ["DEMA_7"], 3)

recur_case("w05_tema", lambda fr: RC.tema(fr, n=7),
           _lsql([], [SK.ema("e1", "pre", "close", 7), SK.ema("e2", "e1", "e1", 7, start=7),
                      SK.ema("e3", "e2", "e2", 7, start=13)], ["e1", "e2", "e3"],
                 [[("TEMA_7", "3.0 * e1 - 3.0 * e2 + e3")]], ["TEMA_7"]), ["TEMA_7"], 3)

_v = 0.7
_c1, _c2 = -_v ** 3, 3 * _v ** 2 + 3 * _v ** 3
_c3, _c4 = -6 * _v ** 2 - 3 * _v - 3 * _v ** 3, 1 + 3 * _v + _v ** 3 + 3 * _v ** 2
recur_case("w09_t3", lambda fr: RC.t3(fr, n=5, vfactor=0.7),
           _lsql([], [SK.ema("e1", "pre", "close", 5)] +
                 [SK.ema(f"e{i}", f"e{i - 1}", f"e{i - 1}", 5, start=1 + 4 * (i - 1)) for i in range(2, 7)],
                 [f"e{i}" for i in range(1, 7)],
                 [[("T3_5", f"e6 * {_c1!r} + e5 * {_c2!r} + e4 * {_c3!r} + e3 * {_c4!r}")]], ["T3_5"]),
           ["T3_5"], 3)

recur_case("w33_trix", lambda fr: RC.trix(fr, n=7),
           _lsql([], [SK.ema("e1", "pre", "close", 7), SK.ema("e2", "e1", "e1", 7, start=7),
                      SK.ema("e3", "e2", "e2", 7, start=13)], ["e3"],
                 [[("TRIX_7", G(19, f"CASE WHEN {LAG('e3', 1)} <> 0 THEN (e3 / {LAG('e3', 1)} - 1.0) * 100.0 ELSE 0.0 END"))]], ["TRIX_7"]),
           ["TRIX_7"], 6)

_kx = "CASE WHEN rn < 10 THEN 0.0 WHEN rn = 10 THEN close ELSE sc * close END"
_kd = "CASE WHEN rn > 10 THEN 1.0 - sc ELSE 1.0 END"
recur_case("w07_kama", lambda fr: RC.kama(fr, n=10),
           _lsql([[("ad", f"abs(close - {LAG('close', 1)})")],
                  [("er", G(10, f"least(1.0, {DIV(f'abs(close - {LAG(CLOSE, 10)})', f'sum(ad) {W(10)}', '1.0')})"))],
                  [("sc", f"pow(er * ({2 / 3!r} - {2 / 31!r}) + {2 / 31!r}, 2)")]],
                 [SK.recur("k", "pre", _kx, _kd, "rn > 10")], ["k"],
                 [[("KAMA_10", "k")]], ["KAMA_10"]), ["KAMA_10"], 3)


def _macd_sql(f, s, g, name, af=None, as_=None):
    af = af if af is not None else 2.0 / (f + 1)
    as_ = as_ if as_ is not None else 2.0 / (s + 1)
    recs = [SK.smooth("es", "pre", "close", 1, s, 1 - as_, 1.0 / s, as_),
            SK.smooth("ef", "pre", "close", s - f + 1, f, 1 - af, 1.0 / f, af),
            "mm AS (SELECT symbol, rn, ef - es AS m FROM ef JOIN es USING (symbol, rn))",
            SK.ema("sg", "mm", "m", g, start=s)]
    lb = s + g - 1
    post = [[(f"{name}_macd", f"CASE WHEN rn >= {lb} THEN m END"),
             (f"{name}_signal", f"CASE WHEN rn >= {lb} THEN sg END"),
             (f"{name}_hist", f"CASE WHEN rn >= {lb} THEN m - sg END")]]
    cols = [f"{name}_macd", f"{name}_signal", f"{name}_hist"]
    return _lsql([], recs, ["mm", "sg"], post, cols, 3), cols


_m_sql, _m_cols = _macd_sql(7, 17, 5, "MACD_7_17_5")
recur_case("w15_macd", lambda fr: RC.macd(fr, fast=7, slow=17, signal=5), _m_sql, _m_cols, 3)
_mf_sql, _mf_cols = _macd_sql(12, 26, 5, "MACDFIX_5", 0.15, 0.075)
recur_case("w17_macdfix", lambda fr: RC.macdfix(fr, signal=5), _mf_sql, _mf_cols, 3)

_GL = [[("dx", f"close - {LAG('close', 1)}")], [("g", "greatest(dx, 0.0)"), ("l", "greatest(-dx, 0.0)")]]
recur_case("w23_rsi", lambda fr: RC.rsi(RC.rsi(fr, n=14), n=7),
           _lsql(_GL, [SK.wilder_mean("ag14", "pre", "g", 14, 2), SK.wilder_mean("al14", "pre", "l", 14, 2),
                       SK.wilder_mean("ag7", "pre", "g", 7, 2), SK.wilder_mean("al7", "pre", "l", 7, 2)],
                 ["ag14", "al14", "ag7", "al7"],
                 [[("RSI_14", f"CASE WHEN ag14 IS NOT NULL THEN {DIV('ag14 * 100.0', 'ag14 + al14')} END"),
                   ("RSI_7", f"CASE WHEN ag7 IS NOT NULL THEN {DIV('ag7 * 100.0', 'ag7 + al7')} END")]],
                 ["RSI_14", "RSI_7"], 6), ["RSI_14", "RSI_7"], 6)

recur_case("w24_cmo", lambda fr: RC.cmo(fr, n=14),
           _lsql(_GL, [SK.wilder_mean("ag", "pre", "g", 14, 2), SK.wilder_mean("al", "pre", "l", 14, 2)],
                 ["ag", "al"],
                 [[("CMO_14", f"CASE WHEN ag IS NOT NULL THEN {DIV('(ag - al) * 100.0', 'ag + al')} END")]],
                 ["CMO_14"], 6), ["CMO_14"], 6)

recur_case("w27_stochrsi", lambda fr: RC.stochrsi(fr, n=14, fastk=5, fastd=3),
           _lsql(_GL, [SK.wilder_mean("ag", "pre", "g", 14, 2), SK.wilder_mean("al", "pre", "l", 14, 2)],
                 ["ag", "al"],
                 [[("rsi", f"CASE WHEN ag IS NOT NULL THEN {DIV('ag * 100.0', 'ag + al')} END")],
                  [("k", G(18, DIV(f"(rsi - min(rsi) {W(5)}) * 100.0", f"max(rsi) {W(5)} - min(rsi) {W(5)}")))],
                  [("STOCHRSI_14_5_3_fastk", G(20, "k")), ("STOCHRSI_14_5_3_fastd", G(20, f"avg(k) {W(3)}"))]],
                 ["STOCHRSI_14_5_3_fastk", "STOCHRSI_14_5_3_fastd"], 5),
           ["STOCHRSI_14_5_3_fastk", "STOCHRSI_14_5_3_fastd"], 5)

_DM = [[("up", f"high - {LAG('high', 1)}"), ("dn", f"{LAG('low', 1)} - low"), ("pc", LAG("close", 1))],
       [("pdm", "CASE WHEN up > 0 AND up > dn THEN up ELSE 0.0 END"),
        ("mdm", "CASE WHEN dn > 0 AND dn > up THEN dn ELSE 0.0 END"),
        ("tr", "CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END")]]
recur_case("w35_w36_plus_minus_dm", lambda fr: RC.minus_dm(RC.plus_dm(fr, n=14), n=14),
           _lsql(_DM, [SK.wilder_sum("PLUS_DM_14", "pre", "pdm", 14, 2),
                       SK.wilder_sum("MINUS_DM_14", "pre", "mdm", 14, 2)], ["PLUS_DM_14", "MINUS_DM_14"], [],
                 ["PLUS_DM_14", "MINUS_DM_14"], 2), ["PLUS_DM_14", "MINUS_DM_14"], 2)

_DI_RECS = [SK.wilder_sum("sp", "pre", "pdm", 14, 2), SK.wilder_sum("sm", "pre", "mdm", 14, 2),
            SK.wilder_sum("st", "pre", "tr", 14, 2)]
_DI_POST = [[("PLUS_DI_14", G(14, DIV("sp * 100.0", "st"))), ("MINUS_DI_14", G(14, DIV("sm * 100.0", "st")))],
            [("dxr", "CASE WHEN PLUS_DI_14 + MINUS_DI_14 <> 0 THEN abs(PLUS_DI_14 - MINUS_DI_14) * 100.0 / "
                     "(PLUS_DI_14 + MINUS_DI_14) END")],
            [("DX_14", G(14, "coalesce(last_value(dxr IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING "
                            "AND CURRENT ROW), 0.0)"))]]
recur_case("w37_w39_di_dx",
           lambda fr: RC.dx(RC.minus_di(RC.plus_di(fr, n=14), n=14), n=14),
           _lsql(_DM, _DI_RECS, ["sp", "sm", "st"], _DI_POST, ["PLUS_DI_14", "MINUS_DI_14", "DX_14"], 6),
           ["PLUS_DI_14", "MINUS_DI_14", "DX_14"], 6)


def _adx_sql():
    base = _lsql(_DM, _DI_RECS, ["sp", "sm", "st"], _DI_POST, ["DX_14"], 6)
    # second stage: Wilder mean of DX from row 15, then ADXR
    inner = base.replace("WITH RECURSIVE ", "", 1)
    head, sel = inner.rsplit(" SELECT symbol, ts, ", 1)
    return (f"WITH RECURSIVE {head}, dxt AS (SELECT symbol, rn, ts, DX_14 FROM q2), "
            f"{SK.wilder_mean('ADX_14', 'dxt', 'DX_14', 14, 15).strip()}, "
            f"fin AS (SELECT d.symbol, d.ts, d.rn, a.ADX_14, "
            f"CASE WHEN d.rn > 40 THEN (a.ADX_14 + lag(a.ADX_14, 13) OVER (PARTITION BY d.symbol ORDER BY d.rn)) / 2.0 END AS ADXR_14 "
            f"FROM dxt d JOIN ADX_14 a USING (symbol, rn)) "
            f"SELECT symbol, ts, ADX_14, ADXR_14 FROM fin")


recur_case("w40_w41_adx_adxr", lambda fr: RC.adxr(RC.adx(fr, n=14), n=14), _adx_sql(), ["ADX_14", "ADXR_14"], 6)

recur_case("w43_w44_atr_natr", lambda fr: RC.natr(RC.atr(fr, n=14), n=14),
           _lsql(_DM, [SK.wilder_mean("ATR_14", "pre", "tr", 14, 2)], ["ATR_14"],
                 [[("NATR_14", DIV("ATR_14 * 100.0", "close"))]], ["ATR_14", "NATR_14"], 3, {"NATR_14": 6}),
           ["ATR_14", "NATR_14"], 3, {"NATR_14": 6})

_CLV = DIV("(close - low) - (high - close)", "high - low")
recur_case("w45_w46_ad_adosc", lambda fr: RC.adosc(RC.ad(fr), fast=3, slow=10),
           _lsql([[("AD", f"sum({_CLV} * volume) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")]],
                 [SK.smooth("ef", "pre", "AD", 1, 1, 1 - 0.5, 1.0, 0.5),
                  SK.smooth("es", "pre", "AD", 1, 1, 1 - 2 / 11, 1.0, 2 / 11)], ["ef", "es"],
                 [[("ADOSC_3_10", G(9, "ef - es"))]], ["AD", "ADOSC_3_10"], 6), ["AD", "ADOSC_3_10"], 6)

recur_case("w47_obv", lambda fr: RC.obv(fr),
           _lsql([[("s", f"CASE WHEN rn = 1 THEN volume ELSE sign(close - {LAG('close', 1)}) * volume END")],
                  [("OBV", "sum(s) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")]],
                 [], [], [], ["OBV"], 4), ["OBV"], 4)

recur_case("w74_cumsum", lambda fr: RC.cumulative_sum(fr, "volume"),
           _lsql([[("volume_cumsum", "sum(volume) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")]],
                 [], [], [], ["volume_cumsum"], 4), ["volume_cumsum"], 4)

recur_case("w71_slope_atr", lambda fr: RC.slope_atr_ratio(fr, n=14),
           _lsql(_DM + [[("sl", G(13, f"regr_slope(close, rn) {W(14)}"))]],
                 [SK.wilder_mean("atr", "pre", "tr", 14, 2)], ["atr"],
                 [[("SLOPE_ATR_14", DIV("sl", "atr", "NULL"))]], ["SLOPE_ATR_14"], 6), ["SLOPE_ATR_14"], 6)


# ============================================================ candle patterns
from barloom.functions import patterns as PT  # noqa: E402
from barloom.plans import pattern_oracle as PO  # noqa: E402


def _pattern_sql_ctes(names):
    return [DAILY_CTES, *PO.pattern_ctes(list(names), "bd")]


def _pattern_case(qid, name):
    def q(spark, sf):
        fr = daily_frame(spark, sf)
        fr = fr.add(PT.pattern_feats(Win(fr.key, fr.block), [name]))
        return fr.df.select("symbol", "ts", F.col(name).cast("double").alias(name))
    SPARK[qid] = q
    SQL[qid] = f"WITH {', '.join(_pattern_sql_ctes([name]))} SELECT symbol, ts, CAST({name} AS DOUBLE) AS {name} FROM pat"


_K_IDS = {  # survey ids K1..K61 in registry order
    "CDL2CROWS": 1, "CDL3BLACKCROWS": 2, "CDL3INSIDE": 3, "CDL3LINESTRIKE": 4, "CDL3OUTSIDE": 5,
    "CDL3STARSINSOUTH": 6, "CDL3WHITESOLDIERS": 7, "CDLABANDONEDBABY": 8, "CDLADVANCEBLOCK": 9,
    "CDLBELTHOLD": 10, "CDLBREAKAWAY": 11, "CDLCLOSINGMARUBOZU": 12, "CDLCONCEALBABYSWALL": 13,
    "CDLCOUNTERATTACK": 14, "CDLDARKCLOUDCOVER": 15, "CDLDOJI": 16, "CDLDOJISTAR": 17, "CDLDRAGONFLYDOJI": 18,
    "CDLENGULFING": 19, "CDLEVENINGDOJISTAR": 20, "CDLEVENINGSTAR": 21, "CDLGAPSIDESIDEWHITE": 22,
    "CDLGRAVESTONEDOJI": 23, "CDLHAMMER": 24, "CDLHANGINGMAN": 25, "CDLHARAMI": 26, "CDLHARAMICROSS": 27,
    "CDLHIGHWAVE": 28, "CDLHIKKAKE": 29, "CDLHIKKAKEMOD": 30, "CDLHOMINGPIGEON": 31, "CDLIDENTICAL3CROWS": 32,
    "CDLINNECK": 33, "CDLINVERTEDHAMMER": 34, "CDLKICKING": 35, "CDLKICKINGBYLENGTH": 36, "CDLLADDERBOTTOM": 37,
    "CDLLONGLEGGEDDOJI": 38, "CDLLONGLINE": 39, "CDLMARUBOZU": 40, "CDLMATCHINGLOW": 41, "CDLMATHOLD": 42,
    "CDLMORNINGDOJISTAR": 43, "CDLMORNINGSTAR": 44, "CDLONNECK": 45, "CDLPIERCING": 46, "CDLRICKSHAWMAN": 47,
    "CDLRISEFALL3METHODS": 48, "CDLSEPARATINGLINES": 49, "CDLSHOOTINGSTAR": 50, "CDLSHORTLINE": 51,
    "CDLSPINNINGTOP": 52, "CDLSTALLEDPATTERN": 53, "CDLSTICKSANDWICH": 54, "CDLTAKURI": 55, "CDLTASUKIGAP": 56,
    "CDLTHRUSTING": 57, "CDLTRISTAR": 58, "CDLUNIQUE3RIVER": 59, "CDLUPSIDEGAP2CROWS": 60,
    "CDLXSIDEGAP3METHODS": 61,
}
for _n, _i in _K_IDS.items():
    _pattern_case(f"k{_i:02d}_{_n.lower()}", _n)


def _k62_spark(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(PT.pattern_feats(w))
    fr = fr.add(PT.pattern_wma_feats(w, n=300))
    cols = [f"{n}_wma300" for n in PT.ALL_PATTERNS]
    return finish(fr.df.select("symbol", "ts", *cols), 6)


def _k62_sql():
    ctes = _pattern_sql_ctes(PO.NAMES)
    wm = []
    for n in PO.NAMES:
        s1 = f"sum(CAST({n} AS DOUBLE) * rn) {W(300)}"
        s0 = f"sum(CAST({n} AS DOUBLE)) {W(300)}"
        wm.append(f"{R(f'CASE WHEN rn > {PO.bars_of(n) + 308} THEN ({s1} - (rn - 300) * {s0}) / 45150.0 END', 6)} AS {n}_wma300")
    return f"WITH {', '.join(ctes)} SELECT symbol, ts, {', '.join(wm)} FROM pat {WINDOW}"


SPARK["k62_pattern_wma300"] = _k62_spark
SQL["k62_pattern_wma300"] = _k62_sql()


# ======================================================= class N (grouped map)
from barloom.operators import grouped as GR  # noqa: E402


def _q_sar(spark, sf):
    fr = daily_frame(spark, sf)
    return finish(GR.parabolic_sar(fr).df.select("symbol", "ts", "SAR"), 4)


def _q_cycle(spark, sf):
    fr = daily_frame(spark, sf)
    cols = ["HT_DCPERIOD", "HT_DCPHASE", "HT_PHASOR_inphase", "HT_PHASOR_quadrature", "HT_SINE_sine",
            "HT_SINE_leadsine", "HT_TRENDMODE", "HT_TRENDLINE", "MAMA_mama", "MAMA_fama"]
    df = GR.cycle_indicators(fr).df.withColumn("HT_TRENDLINE", F.col("HT_TRENDLINE") / F.col("close"))  # a ratio has no decimal ties
    return finish(df.select("symbol", "ts", *cols), 4, {"HT_DCPERIOD": 6, "HT_TRENDLINE": 9})


def _q_exits(spark, sf):
    fr = daily_frame(spark, sf)
    w = Win(fr.key, fr.block)
    fr = fr.add(FI.linearreg_slope(w, n=7, out="sl"))
    fr = fr.with_columns(gate=F.when(F.col("sl") > 1e-9, 1).when(F.col("sl") < -1e-9, -1).otherwise(0))
    return GR.path_exits(fr, "gate", size=10.0, max_holding=20, stop_pct=0.05).df.select(
        "symbol", "ts", "target")


SPARK["w13_sar"] = _q_sar
SQL["w13_sar"] = (
    f"WITH RECURSIVE {DAILY_CTES}, src AS (SELECT symbol, rn, ts, high, low, lag(high) OVER (PARTITION BY symbol ORDER BY rn) AS hp, "
    "lag(low) OVER (PARTITION BY symbol ORDER BY rn) AS lp FROM bd), "
    f"{SK.sar_recursive('sr', 'src').strip()} "
    f"SELECT src.symbol, src.ts, {R('sr.sar_out', 4)} AS SAR FROM src LEFT JOIN sr USING (symbol, rn)")
SPARK["w08_w14_w48_w52_cycle_family_mama"] = _q_cycle
_CYCLE_OUT = {"HT_DCPERIOD": ("sp", 32, 6), "HT_DCPHASE": ("phase", 63, 4), "HT_PHASOR_inphase": ("inph", 32, 4),
              "HT_PHASOR_quadrature": ("quad", 32, 4), "HT_SINE_sine": ("sine", 63, 4), "HT_SINE_leadsine": ("lead", 63, 4),
              "HT_TRENDMODE": ("CAST(trend AS DOUBLE)", 63, 4), "HT_TRENDLINE": ("line / price", 63, 9), "MAMA_mama": ("mama", 32, 4),
              "MAMA_fama": ("fama", 32, 4)}
SQL["w08_w14_w48_w52_cycle_family_mama"] = (
    f"WITH RECURSIVE {DAILY_CTES}, sm AS (SELECT symbol, rn, ts, close AS price, CASE WHEN rn > 3 THEN (4 * close + 3 * lag(close, 1) OVER w "
    f"+ 2 * lag(close, 2) OVER w + lag(close, 3) OVER w) / 10.0 ELSE 0.0 END AS s FROM bd {WINDOW}), "
    "src AS (SELECT symbol, rn, ts, price, list_reverse(list(s) OVER back) AS sl, list_reverse(list(price) OVER back) AS pl FROM sm "
    "WINDOW back AS (PARTITION BY symbol ORDER BY rn ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)), "
    f"{SK.cycle_recursive('cy', 'src').strip()} SELECT src.symbol, src.ts, "
    + ", ".join(f"{R(f'CASE WHEN cy.rn > {lb} THEN {e} END', d)} AS {n}" for n, (e, lb, d) in _CYCLE_OUT.items())
    + " FROM cy JOIN src USING (symbol, rn)")
SPARK["sig4_path_dependent_exits"] = _q_exits
SQL["sig4_path_dependent_exits"] = (
    f"WITH RECURSIVE {DAILY_CTES}, sl AS (SELECT symbol, rn, ts, close, CASE WHEN rn > 6 THEN regr_slope(close, rn) "
    f"OVER (PARTITION BY symbol ORDER BY rn ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) END AS s FROM bd), "
    "src AS (SELECT symbol, rn, ts, close, CASE WHEN s > 1e-9 THEN 1 WHEN s < -1e-9 THEN -1 ELSE 0 END AS signal FROM sl), "
    f"{SK.exits_recursive('ex', 'src', 10.0, 20, 0.05).strip()} "
    "SELECT src.symbol, src.ts, ex.last AS target FROM ex JOIN src USING (symbol, rn)")
