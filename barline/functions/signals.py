"""Forecast signals, indicator zones and confidence bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barline.functions.scalar import clamp, ratio

# Band width in deviations and the indicator zones.
BAND_Z, OVERBOUGHT, OVERSOLD = 1.96, 70, 30
BLEND = (0.6, 0.4)


def forecast_signal(current: Column, predicted: Column) -> dict[str, Column]:
    change = predicted - current
    return {
        "change": change,
        "change_pct": ratio(change, current) * 100,
        "signal": F.when(change > 0, "Buy").otherwise("Sell"),
    }


def rsi_zone(rsi: Column) -> Column:
    return F.when(rsi > OVERBOUGHT, "overbought").when(rsi < OVERSOLD, "oversold").when(
        rsi.isNotNull(), "neutral"
    )


def histogram_side(macd: Column, signal: Column) -> Column:
    gap = macd - signal
    return F.when(gap >= 0, "up").when(gap < 0, "down")


def confidence(predicted: Column, current: Column, std: Column) -> dict[str, Column]:
    """Band around the prediction and a score that falls with its width. Band
    edges are rounded first; the score uses the rounded ones."""
    lower = F.round(predicted - F.lit(BAND_Z) * std, 4)
    upper = F.round(predicted + F.lit(BAND_Z) * std, 4)
    width = F.when(current == 0, F.lit(0.1)).otherwise(ratio(upper - lower, current))
    return {
        "confidence_lower": lower,
        "confidence_upper": upper,
        "confidence_score": F.round(clamp(1 - width, 0.0, 1.0), 4),
    }


def blend(first: Column, second: Column, share: tuple[float, float] = BLEND) -> Column:
    return F.lit(share[0]) * first + F.lit(share[1]) * second


def next_day(as_of: Column) -> Column:
    """Prediction date: the next calendar day."""
    return F.date_add(as_of.cast("date"), 1)
