"""Technical indicators by name, with their usual parameters, as derived columns (see `tables`).

Windows are SQL text; smoothings and the few path-dependent kernels are recursions. Where the library that made a name common has no
public default, the period is stated in the text. Outputs are in the units of the definition; `NORMALISED` puts price levels as
percent distances of the close, price differences as percents of it, and cumulative lines as 20-bar flows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np

from tickloom.functions.sqltext import S, dist, div, flag, lag, over, roll, so_far, weighted, wma
from tickloom.operators import scans as K
from tickloom.operators.tables import Column, Kernel, Smooth, ema, rma


def stepper(factory: Callable[[], Callable], outputs: int) -> Callable[..., tuple[np.ndarray, ...]]:
    """A kernel of `scans` over whole columns."""

    def run(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
        step = factory()
        rows = zip(*[[None if x != x else x for x in c.tolist()] for c in columns], strict=True)
        got = [step(*row) for row in rows]
        got = [(g,) for g in got] if outputs == 1 else got
        return tuple(np.array([np.nan if g[i] is None else float(g[i]) for g in got]) for i in range(outputs))

    return run


def outputs(inputs: tuple[str, ...], run: Callable, *names: str) -> dict[str, Column]:
    return {n: Kernel(inputs, run, i) for i, n in enumerate(names)}


def wilder(x: str, n: int) -> Smooth:
    """Wilder's sum over n: it starts from n - 1 values."""
    return Smooth(x, 1 / n, n - 1, n, n)


def age_of(x: str, best: str, n: int) -> str:
    """Bars since x was `best`, the latest of equal ones, within n bars."""
    return "CASE " + " ".join(f"WHEN {lag(x, k) if k else x} = {best} THEN {k}e0" for k in range(n)) + " END"


def mean_gap(x: str, mean: str, n: int) -> str:
    """Mean distance of the last n values of x from `mean`."""
    return "(" + " + ".join(f"abs({lag(x, k) if k else x} - {mean})" for k in range(n)) + f") / {n}"


def rank_of(x: str, n: int) -> str:
    """Share of the n values before this one that are below it, in percent."""
    return "100.0 * (" + " + ".join(f"CASE WHEN {lag(x, k)} < {x} THEN 1 ELSE 0 END" for k in range(1, n + 1)) + f") / {n}"


COLUMNS: dict[str, Column] = {
    # ---- what others need
    "pc": lag("close"), "ph": lag("high"), "pl": lag("low"), "pv": lag("volume"), "mp": "(high + low) / 2", "tp": "(high + low + close) / 3", "rng": "high - low",
    "tr": f"CASE WHEN {lag('close')} IS NOT NULL THEN greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) END",
    "gain": "CASE WHEN pc IS NOT NULL THEN greatest(close - pc, 0.0) END", "loss": "CASE WHEN pc IS NOT NULL THEN greatest(pc - close, 0.0) END",
    "move": "abs(close - pc)", "pdm": "CASE WHEN ph IS NOT NULL THEN CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0.0 END END",
    "mdm": "CASE WHEN ph IS NOT NULL THEN CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0.0 END END",
    "vol20": roll("mean", "volume", 20, 10), "volsum20": roll("sum", "volume", 20, 10),
    "mfv": "CASE WHEN high > low THEN ((close - low) - (high - close)) / (high - low) * volume ELSE 0.0 END",
    "ptp": lag("tp"), "mf_up": "CASE WHEN ptp IS NOT NULL THEN CASE WHEN tp > ptp THEN tp * volume ELSE 0.0 END END", "mf_dn": "CASE WHEN ptp IS NOT NULL THEN CASE WHEN tp < ptp THEN tp * volume ELSE 0.0 END END",
    "sma2": roll("mean", "close", 2), **{f"sma{n}": roll("mean", "close", n) for n in (5, 10, 12, 20, 26, 30, 50, 100, 150, 200)},
    **{f"ema{n}": ema("close", n) for n in (5, 8, 9, 10, 13, 20, 21, 26, 34, 50, 55, 89, 100, 200)},
    **{f"atr{n}": rma("tr", n) for n in (5, 10, 14, 20, 22, 50)},
    **{k: v for n in (2, 3, 5, 7, 9, 14, 21, 28) for k, v in {f"ru{n}": rma("gain", n), f"rd{n}": rma("loss", n), f"rsi{n}": f"CASE WHEN ru{n} + rd{n} > 0 THEN 100 * ru{n} / (ru{n} + rd{n}) WHEN ru{n} IS NOT NULL THEN 0.0 END"}.items()},
    **{k: v for n in (7, 14, 28) for k, v in {f"wt{n}": wilder("tr", n), f"wp{n}": wilder("pdm", n), f"wm{n}": wilder("mdm", n), f"pdi{n}": f"100 * {div(f'wp{n}', f'wt{n}')}", f"mdi{n}": f"100 * {div(f'wm{n}', f'wt{n}')}", f"dx{n}": f"CASE WHEN pdi{n} + mdi{n} > 0 THEN 100 * abs(pdi{n} - mdi{n}) / (pdi{n} + mdi{n}) WHEN pdi{n} IS NOT NULL THEN 0.0 END", f"adx{n}": rma(f"dx{n}", n)}.items()},
    **{f"hh{n}": roll("max", "high", n) for n in (5, 9, 10, 14, 15, 20, 28)}, **{f"ll{n}": roll("min", "low", n) for n in (5, 9, 10, 14, 15, 20, 28)},
    # ---- momentum
    "ta_AO": f"({roll('mean', 'mp', 5)}) - ({roll('mean', 'mp', 34)})", "ta_AC": f"ta_AO - ({roll('mean', 'ta_AO', 5)})",
    "ta_ADX": "adx14", "ta_ADXR": f"(adx14 + {lag('adx14', 13)}) / 2", "ta_APO": "sma12 - sma26", "ta_PPO": f"100 * ({div('sma12', 'sma26')} - 1)",
    "ar_up": age_of("high", "hh15", 15), "ar_dn": age_of("low", "ll15", 15), "ta_AROON_aroonup": "100 * (14 - ar_up) / 14", "ta_AROON_aroondown": "100 * (14 - ar_dn) / 14", "ta_AROONOSC": "ta_AROON_aroonup - ta_AROON_aroondown",
    "ta_BOP": "CASE WHEN high > low THEN (close - open) / (high - low) ELSE 0.0 END",
    "tpm14": roll("mean", "tp", 14), "tpm20": roll("mean", "tp", 20), "tpm50": roll("mean", "tp", 50),
    **{k: v for n in (14, 20, 50) for k, v in {f"tpd{n}": mean_gap("tp", f"tpm{n}", n), f"cci{n}": f"CASE WHEN tpd{n} > 1e-12 THEN (tp - tpm{n}) / (0.015 * tpd{n}) WHEN tpd{n} IS NOT NULL THEN 0.0 END"}.items()}, "ta_CCI": "cci14",
    "ta_CMO": "CASE WHEN ru14 + rd14 > 0 THEN 100 * (ru14 - rd14) / (ru14 + rd14) WHEN ru14 IS NOT NULL THEN 0.0 END",
    "ta_CMOU": f"100 * {div(f'({roll("sum", "gain", 14)}) - ({roll("sum", "loss", 14)})', f'({roll("sum", "gain", 14)}) + ({roll("sum", "loss", 14)})')}",
    "rocs": f"({dist('close', lag('close', 14))}) + ({dist('close', lag('close', 11))})", "ta_COPPOCK": wma("rocs", 10), "ta_DPO": f"close - {lag('sma20', 11)}", "ta_DX": "dx14",
    "ta_ER": div(f"abs(close - {lag('close', 10)})", roll("sum", "move", 10)), "ta_ERI_bullpower": "high - ema13", "ta_ERI_bearpower": "low - ema13",
    "ta_FOSC": f"100 * {div(f'close - {lag("ta_TSF")}', 'close')}",
    "ta_FRACTAL_swinghigh": "100 * " + flag(" AND ".join(f"{lag('high', 2)} > {lag('high', k) if k else 'high'}" for k in (0, 1, 3, 4))).replace("CASE", "(CASE").replace("END", "END)"),
    "ta_FRACTAL_swinglow": "100 * " + flag(" AND ".join(f"{lag('low', 2)} < {lag('low', k) if k else 'low'}" for k in (0, 1, 3, 4))).replace("CASE", "(CASE").replace("END", "END)"),
    "ob": "CASE WHEN close > open THEN close - open ELSE 0.0 END", "os": "CASE WHEN close < open THEN open - close ELSE 0.0 END", "ta_IMI": f"100 * {div(roll('sum', 'ob', 14), f'({roll("sum", "ob", 14)}) + ({roll("sum", "os", 14)})')}",
    "rsv": f"100 * {div('close - ll9', 'hh9 - ll9')}", "ta_KDJ_k": rma("rsv", 3), "ta_KDJ_d": rma("ta_KDJ_k", 3), "ta_KDJ_j": "3 * ta_KDJ_k - 2 * ta_KDJ_d",
    "c14on": "CASE WHEN t >= 14 THEN close END", "ef12": ema("c14on", 12), "ta_MACD_macd": "ef12 - ema26", "ta_MACD_macdsignal": ema("ta_MACD_macd", 9), "ta_MACD_macdhist": "ta_MACD_macd - ta_MACD_macdsignal",
    "ff12": Smooth("c14on", 0.15, 12), "fs26": Smooth("close", 0.075, 26), "ta_MACDFIX_macd": "ff12 - fs26", "ta_MACDFIX_macdsignal": ema("ta_MACDFIX_macd", 9), "ta_MACDFIX_macdhist": "ta_MACDFIX_macd - ta_MACDFIX_macdsignal",
    "ta_MACDEXT_macd": "sma12 - sma26", "ta_MACDEXT_macdsignal": roll("mean", "ta_MACDEXT_macd", 9), "ta_MACDEXT_macdhist": "ta_MACDEXT_macd - ta_MACDEXT_macdsignal",
    **{f"mfi{n}": f"100 * {div(roll('sum', 'mf_up', n), f'({roll("sum", "mf_up", n)}) + ({roll("sum", "mf_dn", n)})')}" for n in (7, 14, 21)}, "ta_MFI": "mfi14",
    "ta_MINUS_DI": "mdi14", "ta_PLUS_DI": "pdi14", "ta_MINUS_DM": "14 * wm14", "ta_PLUS_DM": "14 * wp14",
    "ta_MOM": f"close - {lag('close', 10)}", "ta_ROC": dist("close", lag("close", 10)), "ta_ROCP": f"({div('close', lag('close', 10))}) - 1", "ta_ROCR": div("close", lag("close", 10)), "ta_ROCR100": f"100 * ({div('close', lag('close', 10))})",
    "body_": "close - open", "ta_QSTICK": roll("mean", "body_", 10), "ta_RSI": "rsi14",
    "sm_c": "close - (hh14 + ll14) / 2", "sm_r": "hh14 - ll14", "sm_c1": ema("sm_c", 3), "sm_c2": ema("sm_c1", 3), "sm_r1": ema("sm_r", 3), "sm_r2": ema("sm_r1", 3), "ta_SMI_smi": f"100 * {div('sm_c2', 'sm_r2 / 2')}", "ta_SMI_smisignal": ema("ta_SMI_smi", 3),
    "fk5": "CASE WHEN hh5 > ll5 THEN 100 * (close - ll5) / (hh5 - ll5) WHEN hh5 IS NOT NULL THEN 0.0 END", "fd5": roll("mean", "fk5", 3), "ta_STOCHF_fastd": "fd5", "ta_STOCHF_fastk": "CASE WHEN fd5 IS NOT NULL THEN fk5 END",
    "ta_STOCH_slowd": roll("mean", "fd5", 3), "ta_STOCH_slowk": "CASE WHEN ta_STOCH_slowd IS NOT NULL THEN fd5 END",
    **{k: v for n, s, d in ((14, 3, 3), (21, 5, 5)) for k, v in {f"fk{n}": f"CASE WHEN {roll('max', 'high', n)} > {roll('min', 'low', n)} THEN 100 * (close - {roll('min', 'low', n)}) / (({roll('max', 'high', n)}) - ({roll('min', 'low', n)})) WHEN ({roll('max', 'high', n)}) IS NOT NULL THEN 0.0 END", f"sk{n}": roll("mean", f"fk{n}", s), f"stoch_d_{n}": roll("mean", f"sk{n}", d), f"stoch_k_{n}": f"CASE WHEN stoch_d_{n} IS NOT NULL THEN sk{n} END"}.items()},
    "rk5": f"CASE WHEN ({roll('max', 'rsi14', 5)}) > ({roll('min', 'rsi14', 5)}) + 1e-9 THEN 100 * (rsi14 - ({roll('min', 'rsi14', 5)})) / (({roll('max', 'rsi14', 5)}) - ({roll('min', 'rsi14', 5)})) WHEN ({roll('max', 'rsi14', 5)}) IS NOT NULL THEN 0.0 END", "ta_STOCHRSI_fastd": roll("mean", "rk5", 3), "ta_STOCHRSI_fastk": "CASE WHEN ta_STOCHRSI_fastd IS NOT NULL THEN rk5 END",
    "e1": ema("close", 30), "e2": ema("e1", 30), "e3": ema("e2", 30), "ta_TRIX": dist("e3", lag("e3")),
    "m1": "close - pc", "ts1": ema("m1", 25), "ts2": ema("ts1", 13), "tu1": ema("move", 25), "tu2": ema("tu1", 13), "ta_TSI": f"100 * {div('ts2', 'tu2')}",
    "bp": "CASE WHEN pc IS NOT NULL THEN close - least(low, pc) END",
    "ta_ULTOSC": "100 * (" + " + ".join(f"{w} * ({div(roll('sum', 'bp', n), roll('sum', 'tr', n))})" for n, w in ((7, 4), (14, 2), (28, 1))) + ") / 7",
    "ta_VHF": div(f"({roll('max', 'close', 28)}) - ({roll('min', 'close', 28)})", roll("sum", "move", 28)),
    "vp_": "abs(high - pl)", "vm_": "abs(low - ph)", "ta_VORTEX_plusvi": div(roll("sum", "vp_", 14), roll("sum", "tr", 14)), "ta_VORTEX_minusvi": div(roll("sum", "vm_", 14), roll("sum", "tr", 14)),
    "wd": "CASE WHEN close > pc THEN close - least(low, pc) WHEN close < pc THEN close - greatest(high, pc) ELSE 0.0 END", "ta_WAD": so_far("sum(wd)"), "ta_WAD_chg20": f"100 * {div(f'ta_WAD - {lag("ta_WAD", 20)}', 'close')}",
    **{f"willr{n}": f"CASE WHEN hh{n} > ll{n} THEN -100 * (hh{n} - close) / (hh{n} - ll{n}) WHEN hh{n} IS NOT NULL THEN 0.0 END" for n in (10, 14, 28)}, "ta_WILLR": "willr14",
    # ---- overlap
    "ab_u": "high * (1 + 4 * (high - low) / (high + low))", "ab_l": "low * (1 - 4 * (high - low) / (high + low))", "ta_ACCBANDS_upperband": roll("mean", "ab_u", 20), "ta_ACCBANDS_middleband": "sma20", "ta_ACCBANDS_lowerband": roll("mean", "ab_l", 20),
    "sd5": f"sqrt({roll('pvar', 'close', 5)})", "ta_BBANDS_upperband": "sma5 + 2 * sd5", "ta_BBANDS_middleband": "sma5", "ta_BBANDS_lowerband": "sma5 - 2 * sd5",
    "ta_DEMA": "2 * e1 - e2", "ta_TEMA": "3 * e1 - 3 * e2 + e3", "ta_DONCHIAN_upperband": "hh20", "ta_DONCHIAN_lowerband": "ll20", "ta_DONCHIAN_middleband": "(hh20 + ll20) / 2",
    "ta_EMA": "e1", "hm": f"2 * ({wma('close', 10)}) - ({wma('close', 20)})", "ta_HMA": wma("hm", 4), "ta_KC_middleband": "ema20", "ta_KC_upperband": "ema20 + 1.5 * atr20", "ta_KC_lowerband": "ema20 - 1.5 * atr20",
    "ta_MA": "sma30", "ta_SMA": "sma30", "ta_MIDPOINT": f"(({roll('max', 'close', 14)}) + ({roll('min', 'close', 14)})) / 2", "ta_MIDPRICE": "(hh14 + ll14) / 2", "ta_RMA": rma("close", 14),
    "x3_1": ema("close", 5), "x3_2": ema("x3_1", 5), "x3_3": ema("x3_2", 5), "x3_4": ema("x3_3", 5), "x3_5": ema("x3_4", 5), "x3_6": ema("x3_5", 5),
    "ta_T3": f"{-(0.7**3)!r} * x3_6 + {3 * (0.7**2 + 0.7**3)!r} * x3_5 + {-6 * 0.7**2 - 3 * (0.7 + 0.7**3)!r} * x3_4 + {1 + 3 * 0.7 + 0.7**3 + 3 * 0.7**2!r} * x3_3",
    "tm15": roll("mean", "close", 15), "ta_TRIMA": roll("mean", "tm15", 16), "cv": "close * volume", "ta_VWMA": div(roll("sum", "cv", 20), roll("sum", "volume", 20)), "ta_WMA": wma("close", 30),
    "zl": f"2 * close - {lag('close', 9)}", "ta_ZLEMA": ema("zl", 20),
    **outputs(("close",), stepper(K.kaufman(30), 1), "ta_KAMA"), **outputs(("high", "low"), stepper(K.parabolic(), 2), "ta_SAR", "ta_SAREXT_dir"), "ta_SAREXT": "ta_SAR * ta_SAREXT_dir",
    **{n: c for p, m, a, b in ((10, 3.0, "ta_SUPERTREND_supertrend", "ta_SUPERTREND_trend"), (7, 3.0, "st_7_3", "supertrend_7_3_dir"), (11, 2.0, "st_11_2", "supertrend_11_2_dir"), (20, 5.0, "st_20_5", "supertrend_20_5_dir")) for n, c in outputs(("high", "low", "close", f"atr{p}"), stepper(K.supertrend(m), 2), a, b).items()},
    "atr7": rma("tr", 7), "atr11": rma("tr", 11),
    # ---- statistics
    "tt": "t * 1.0", "slope14": f"CASE WHEN {over('count(close)', 14)} >= 14 THEN {over('regr_slope(close, tt)', 14)} END", "sma14": roll("mean", "close", 14),
    "ta_LINEARREG": "sma14 + 6.5 * slope14", "ta_LINEARREG_INTERCEPT": "sma14 - 6.5 * slope14", "ta_LINEARREG_SLOPE": "slope14", "ta_TSF": "sma14 + 7.5 * slope14",
    "lc": "ln(close)", "ta_LINEARREG_ANGLE": f"CASE WHEN {over('count(lc)', 14)} >= 14 THEN degrees(atan(100 * {over('regr_slope(lc, tt)', 14)})) END",
    "ta_PERCENTILE": f"CASE WHEN {over('count(close)', 14)} >= 14 THEN {over('percentile(close, 0.5)', 14)} END", "ta_PERCENTRANK": f"CASE WHEN t >= 14 THEN {rank_of('close', 14)} END",
    "ta_STDDEV": "sd5", "ta_VAR": roll("pvar", "close", 5), "ta_AVGDEV": mean_gap("close", "sma14", 14),
    # ---- volatility
    "ta_ADR": roll("mean", "rng", 14), "ta_ATR": "atr14", "ta_NATR": f"100 * {div('atr14', 'close')}", "ta_TRANGE": "tr", "re10": ema("rng", 10), "ta_CVI": dist("re10", lag("re10", 10)),
    "re9": ema("rng", 9), "re99": ema("re9", 9), "mi": div("re9", "re99"), "ta_MASSI": roll("sum", "mi", 25),
    "sd10": f"sqrt({roll('pvar', 'close', 10)})", "rv_u": "CASE WHEN close > pc THEN sd10 WHEN sd10 IS NOT NULL THEN 0.0 END", "rv_d": "CASE WHEN close < pc THEN sd10 WHEN sd10 IS NOT NULL THEN 0.0 END", "rv_us": ema("rv_u", 14), "rv_ds": ema("rv_d", 14), "ta_RVI": f"100 * {div('rv_us', 'rv_us + rv_ds')}",
    # ---- volume
    "ta_AD": so_far("sum(mfv)"), "ta_AD_flow20": div(f"ta_AD - {lag('ta_AD', 20)}", "volsum20"), "ad3": Smooth("ta_AD", 2 / 4, 1, 1, 10), "ad10": Smooth("ta_AD", 2 / 11, 1, 1, 10), "ta_ADOSC": "ad3 - ad10", "ta_CMF": div(roll("sum", "mfv", 20), roll("sum", "volume", 20)),
    "fi": "(close - pc) * volume", "ta_EFI": ema("fi", 13), "ta_MARKETFI": div("high - low", "volume"),
    "lnr": "ln(close / pc)", "nv": "CASE WHEN volume < pv THEN lnr ELSE 0.0 END", "pv_": "CASE WHEN volume > pv THEN lnr ELSE 0.0 END", "ta_NVI": f"1000 * exp({so_far('sum(nv)')})", "ta_PVI": f"1000 * exp({so_far('sum(pv_)')})",
    "nv255": ema("ta_NVI", 255), "pv255": ema("ta_PVI", 255), "ta_NVI_vs_ema255": dist("ta_NVI", "nv255"), "ta_PVI_vs_ema255": dist("ta_PVI", "pv255"),
    "ob1": "CASE WHEN pc IS NULL OR close > pc THEN volume WHEN close < pc THEN -volume ELSE 0.0 END", "ta_OBV": so_far("sum(ob1)"), "ta_OBV_flow20": div(f"ta_OBV - {lag('ta_OBV', 20)}", "volsum20"),
    "ve12": ema("volume", 12), "ve26": ema("volume", 26), "ta_PVO": f"100 * ({div('ve12', 've26')} - 1)",
    "pt": "CASE WHEN pc IS NULL THEN 0.0 ELSE (close - pc) / pc * volume END", "ta_PVT": so_far("sum(pt)"), "ta_PVT_flow20": div(f"ta_PVT - {lag('ta_PVT', 20)}", "volsum20"),
    "ta_RVOL": div("volume", roll("mean", "volume", 20)), "tpv": "tp * volume", "ta_VWAP": div(so_far("sum(tpv)"), so_far("sum(volume)")),
    # ---- prices
    "ta_AVGPRICE": "(open + high + low + close) / 4", "ta_MEDPRICE": "mp", "ta_TYPPRICE": "tp", "ta_WCLPRICE": "(high + low + 2 * close) / 4",
}

#: The indicators, by group.
GROUPS: dict[str, list[str]] = {
    "momentum": [c for c in list(COLUMNS)[: list(COLUMNS).index("ab_u")] if c.startswith("ta_") and c != "ta_WAD"],
    "overlap": [c for c in list(COLUMNS)[list(COLUMNS).index("ab_u") : list(COLUMNS).index("tt")] if c.startswith("ta_")],
    "statistics": [c for c in list(COLUMNS)[list(COLUMNS).index("tt") : list(COLUMNS).index("ta_ADR")] if c.startswith("ta_")],
    "volatility": [c for c in list(COLUMNS)[list(COLUMNS).index("ta_ADR") : list(COLUMNS).index("ta_AD")] if c.startswith("ta_")],
    "volume": [c for c in list(COLUMNS)[list(COLUMNS).index("ta_AD") :] if c.startswith("ta_") and c not in ("ta_AD", "ta_NVI", "ta_PVI", "ta_OBV", "ta_PVT")],
}
#: Outputs of kernels, which have no SQL form.
PATHS = ["ta_KAMA", "ta_SAR", "ta_SAREXT_dir", "ta_SAREXT", "ta_SUPERTREND_supertrend", "ta_SUPERTREND_trend"]

#: How outputs are normalised, by the name after "ta_" and before the output's own name.
PRICE_LEVEL = "ACCBANDS BBANDS DEMA DONCHIAN EMA HMA HT_TRENDLINE KAMA KC MA MAMA MIDPOINT MIDPRICE RMA SAR SMA SUPERTREND T3 TEMA TRIMA VWMA WMA ZLEMA LINEARREG LINEARREG_INTERCEPT TSF PERCENTILE AVGPRICE MEDPRICE TYPPRICE WCLPRICE VWAP".split()
PRICE_DIFF = "APO MACD MACDEXT MACDFIX MOM PLUS_DM MINUS_DM LINEARREG_SLOPE STDDEV ATR TRANGE AVGDEV ADR AO AC DPO QSTICK ERI HT_PHASOR".split()


def normalised(name: str) -> str:
    """Text of an indicator's column as a feature."""
    kind = name.removeprefix("ta_")
    kind = kind if kind in PRICE_LEVEL + PRICE_DIFF else "_".join(kind.split("_")[:-1]) if "_" in kind else kind
    special = {
        "ta_SUPERTREND_trend": name, "ta_LINEARREG_ANGLE": name, "ta_SAREXT": dist("close", "abs(ta_SAREXT)"), "ta_VAR": f"100 * {div('sqrt(greatest(ta_VAR, 0.0))', 'close')}", "ta_ADOSC": div("ta_ADOSC", "vol20"), "ta_EFI": f"100 * {div('ta_EFI', 'close * vol20')}",
        "ta_MARKETFI": f"ln(1 + greatest({div('ta_MARKETFI * vol20', 'close')}, 0.0))", "ta_FRACTAL_swinghigh": f"{name} / 100", "ta_FRACTAL_swinglow": f"{name} / 100",
    }
    return special.get(name) or (dist("close", name) if kind in PRICE_LEVEL else f"100 * {div(name, 'close')}" if kind in PRICE_DIFF else name)
