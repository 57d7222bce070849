"""Cycle indicators by the Hilbert transform: dominant cycle period and phase, phasor, sine, trend line and mode, and the adaptive mean.

A homodyne discriminator measures the cycle from bar to bar, and its own period sets the filters of the next bar, so bars follow one
another; symbols don't. A group therefore holds many symbols, whose bars are laid side by side and stepped together: each step is
numpy over all symbols of the group. Price is the close; there are four taps at 0, 2, 4 and 6 bars.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The transform's taps, its gain by the last period, and the smoothed price's weights.
TAPS, GAIN, WEIGHTS = (0.0962, 0.5769, -0.5769, -0.0962), (0.075, 0.54), (0.4, 0.3, 0.2, 0.1)
#: Bars at which the short and the long functions begin, and their first results.
BEGINS, FIRST = (12, 37), (32, 63)
#: How a period may change and its bounds, weights of new values, limits of the adaptive mean.
GROWS, SHRINKS, SHORTEST, LONGEST = 1.5, 0.67, 6.0, 50.0
NEW, NEW_PERIOD, FAST, SLOW = 0.2, 0.33, 0.5, 0.05
#: Fixed value: a price so far from the trend line is a trend.
AWAY = 0.015

SHORT = ["ta_HT_DCPERIOD", "ta_HT_PHASOR_inphase", "ta_HT_PHASOR_quadrature", "ta_MAMA_mama", "ta_MAMA_fama"]
LONG = ["ta_HT_DCPHASE", "ta_HT_SINE_sine", "ta_HT_SINE_leadsine", "ta_HT_TRENDLINE", "ta_HT_TRENDMODE"]


def smoothed(price: np.ndarray) -> np.ndarray:
    out = np.full(price.shape, np.nan)
    out[3:] = sum(w * price[3 - j : len(price) - j] for j, w in enumerate(WEIGHTS))
    return out


class Taps:
    """The transform of a series that is given bar by bar; nothing is known before its first value."""

    def __init__(self, width: int):
        self.held = np.zeros((7, width))

    def step(self, x: np.ndarray, gain: np.ndarray) -> np.ndarray:
        self.held[1:] = self.held[:-1].copy()
        self.held[0] = x
        return sum(w * self.held[2 * j] for j, w in enumerate(TAPS)) * gain


def discriminator(smooth: np.ndarray, begins: int):
    """For each bar from `begins` on: the bar, the smoothed period, and the phasor's parts."""
    width = smooth.shape[1]
    zero = np.zeros(width)
    of_price, of_detrended, of_in, of_quad = (Taps(width) for _ in range(4))
    detrended = [zero] * 4
    i2 = q2 = re = im = period = slow = zero
    for t in range(begins, len(smooth)):
        gain = GAIN[0] * period + GAIN[1]
        detrended = [of_price.step(smooth[t], gain), *detrended[:3]]
        quad, inner = of_detrended.step(detrended[0], gain), detrended[3]
        ji, jq = of_in.step(inner, gain), of_quad.step(quad, gain)
        new_q, new_i = NEW * (quad + ji) + (1 - NEW) * q2, NEW * (inner - jq) + (1 - NEW) * i2
        re, im = NEW * (new_i * i2 + new_q * q2) + (1 - NEW) * re, NEW * (new_i * q2 - new_q * i2) + (1 - NEW) * im
        i2, q2 = new_i, new_q
        known = (im != 0) & (re != 0)
        angle = np.arctan(np.divide(im, re, out=np.ones(width), where=known))
        found = np.where(known, 2 * np.pi / np.where(angle == 0, 1e-300, angle), period)
        found = np.maximum(np.minimum(found, GROWS * period), SHRINKS * period)
        found = np.clip(found, SHORTEST, LONGEST)
        period = NEW * found + (1 - NEW) * period
        slow = NEW_PERIOD * period + (1 - NEW_PERIOD) * slow
        yield t, slow, inner, quad


def short_functions(price: np.ndarray) -> dict[str, np.ndarray]:
    """Period, phasor and the adaptive mean with its follower; a column for each symbol."""
    out = {n: np.full(price.shape, np.nan) for n in SHORT}
    mean = follower = before = np.zeros(price.shape[1])
    for t, period, inner, quad in discriminator(smoothed(price), BEGINS[0]):
        phase = np.degrees(np.arctan(np.divide(quad, inner, out=np.zeros(len(inner)), where=inner != 0)))
        turn = np.maximum(before - phase, 1.0)
        weight = np.maximum(FAST / turn, SLOW)
        before = phase
        mean = weight * price[t] + (1 - weight) * mean
        follower = weight / 2 * mean + (1 - weight / 2) * follower
        if t >= FIRST[0]:
            for n, v in zip(SHORT, (period, inner, quad, mean, follower), strict=True):
                out[n][t] = v
    return out


def long_functions(price: np.ndarray) -> dict[str, np.ndarray]:
    """Phase, sine and its lead, trend line and mode; a column for each symbol."""
    smooth, width = smoothed(price), price.shape[1]
    out = {n: np.full(price.shape, np.nan) for n in LONG}
    sums = np.concatenate([np.zeros((1, width)), np.cumsum(price, axis=0)])
    zero = np.zeros(width)
    phase = sine = lead = zero
    trends, days = [zero] * 3, zero
    place, most = np.arange(int(LONGEST) + 1)[:, None], int(LONGEST) + 1
    recent = np.zeros((most, width))  # smoothed prices, newest first
    column = np.arange(width)
    for t, period, _, _ in discriminator(smooth, BEGINS[1]):
        recent[1:] = recent[:-1].copy()
        recent[0] = smooth[t]
        n = np.floor(period + 0.5).astype(np.int64)
        angle = 2 * np.pi * place / np.maximum(n, 1)
        used = np.where(place < n, recent, 0.0)
        real, imag = (used * np.sin(angle)).sum(0), (used * np.cos(angle)).sum(0)
        was, was_sine, was_lead = phase, sine, lead
        turned = np.degrees(np.arctan(np.divide(real, imag, out=np.zeros(width), where=imag != 0)))
        phase = np.where(imag != 0, turned, phase + 90 * np.sign(real)) + 90 + np.divide(360.0, period, out=np.zeros(width), where=period != 0)
        phase = phase + np.where(imag < 0, 180, 0)
        phase = phase - np.where(phase > 315, 360, 0)
        sine, lead = np.sin(np.radians(phase)), np.sin(np.radians(phase + 45))
        mean = np.where(n > 0, (sums[t + 1] - sums[np.maximum(t + 1 - n, 0), column]) / np.maximum(n, 1), 0.0)
        line = (4 * mean + 3 * trends[0] + 2 * trends[1] + trends[2]) / 10
        trends = [mean, *trends[:2]]
        crossed = ((sine > lead) & (was_sine <= was_lead)) | ((sine < lead) & (was_sine >= was_lead))
        days = np.where(crossed, 0, days) + 1
        step, usual = phase - was, np.divide(360.0, period, out=np.full(width, np.inf), where=period != 0)
        trend = ~crossed & (days >= 0.5 * period) & ~((step > SHRINKS * usual) & (step < GROWS * usual))
        trend |= np.abs(np.divide(smooth[t] - line, line, out=np.zeros(width), where=line != 0)) >= AWAY
        if t >= FIRST[1]:
            for name, v in zip(LONG, (phase, sine, lead, line, trend), strict=True):
                out[name][t] = v
    return out


def cycles(bars: DataFrame, groups: int = 64) -> DataFrame:
    """symbol, date and the cycle columns. groups: into how many groups symbols are dealt; a group's bars are in memory together."""
    schema = T.StructType([bars.schema["symbol"], bars.schema["date"], *(T.StructField(n, T.DoubleType()) for n in (*SHORT, *LONG))])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["symbol", "t"], ignore_index=True)
        code = pd.factorize(pdf["symbol"])[0]
        place = pdf.groupby(code).cumcount().to_numpy()
        price = np.zeros((place.max() + 1, code.max() + 1))  # a symbol that ends early goes on with zeros, which nobody reads
        price[place, code] = pdf["close"].to_numpy(float)
        found = short_functions(price) | long_functions(price)
        return pd.DataFrame({"symbol": pdf["symbol"], "date": pdf["date"]} | {n: found[n][place, code] for n in (*SHORT, *LONG)})

    return bars.select("symbol", "date", "t", "close").groupBy(F.pmod(F.hash("symbol"), F.lit(groups))).applyInPandas(run, schema)
