"""Small bar tables and a plain pandas statement of the indicator rules."""

import datetime as dt

import numpy as np
import pandas as pd

BAR = "symbol string, date date, open double, high double, low double, close double, volume long"
START = dt.date(1990, 1, 1)


def bars(spark, closes, symbol="A", volume=100, spread=1.0):
    rows = [
        (symbol, START + dt.timedelta(days=i), c, c + spread, c - spread, c, volume)
        for i, c in enumerate(map(float, closes))
    ]
    return spark.createDataFrame(rows, BAR)


def walk(n, seed=7, start=100.0):
    rng = np.random.default_rng(seed)
    return start * np.cumprod(1 + rng.normal(0, 0.012, n))


def by_date(df):
    return df.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)


def expected(pdf):
    """Indicators of one symbol, row by row."""
    g = pdf.sort_values("date").reset_index(drop=True)
    c = g["close"]
    d = c.diff()
    up, down = d.clip(lower=0).fillna(0.0), (-d).clip(lower=0).fillna(0.0)

    def mean(x, alpha, rows):
        return x.ewm(alpha=alpha, adjust=False, min_periods=rows).mean()

    u, v = mean(up, 1 / 14, 14), mean(down, 1 / 14, 14)
    rsi = 100 - 100 / (1 + u / v.replace(0, np.nan))
    g["rsi_14"] = rsi.where(v != 0, 100.0).where(u.notna())
    g["macd"] = mean(c, 2 / 13, 12) - mean(c, 2 / 27, 26)
    g["macd_signal"] = mean(g["macd"], 2 / 10, 9)
    g["macd_hist"] = g["macd"] - g["macd_signal"]
    m, s = c.rolling(20).mean(), c.rolling(20).std(ddof=0)
    g["bb_upper"], g["bb_lower"], g["bb_width"] = m + 2 * s, m - 2 * s, 4 * s / m * 100
    prev = c.shift()
    tr = pd.concat([g["high"] - g["low"], (g["high"] - prev).abs(), (g["low"] - prev).abs()], axis=1).max(axis=1)
    atr = np.zeros(len(g))
    for i in range(13, len(g)):
        atr[i] = tr[:14].mean() if i == 13 else (13 * atr[i - 1] + tr[i]) / 14
    g["atr_14"] = atr
    g["return_1d"], g["return_5d"] = c.pct_change(1), c.pct_change(5)
    g["sma_10"], g["sma_20"] = c.rolling(10).mean(), m
    return g
