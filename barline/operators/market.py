"""Read-side views over indexed bars and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.operators.indicators import features
from barline.operators.series import tail
from barline.schemas import INDICATORS

VIEW_PLACES = {"open": 4, "high": 4, "low": 4, "close": 4, "rsi_14": 2, "macd": 4,
               "macd_signal": 4, "bb_upper": 4, "bb_lower": 4}
JOINED_INDICATORS = [c for c in INDICATORS if c not in ("macd_hist", "bb_width")]


def market_view(bars: DataFrame, days: int = 90, scope: str = "window") -> DataFrame:
    """Last ``days`` bars per symbol with five indicators, rounded.

    ``scope="window"`` starts the indicators at the first shown bar, so warm-up
    rows are empty; ``"history"`` computes them as over the whole series, whose earlier
    blocks give only their carries.
    """
    if not 1 <= days <= 365:
        raise ValueError("days must be in 1..365")
    if scope == "window":
        shown = features(tail(bars, days))
    elif scope == "history":
        shown = tail(features(bars, last=days), days)
    else:
        raise ValueError("scope must be 'window' or 'history'")
    return shown.select(
        "symbol", "date",
        *[F.round(c, n).alias(c) for c, n in VIEW_PLACES.items() if c in ("open", "high", "low", "close")],
        "volume",
        *[F.round(c, VIEW_PLACES[c]).alias(c)
          for c in ("rsi_14", "macd", "macd_signal", "bb_upper", "bb_lower")],
    )


def prices_with_indicators(prices: DataFrame, indicators: DataFrame) -> DataFrame:
    """All price rows, with eight indicators where they exist."""
    wanted = indicators.select("symbol", "date", *JOINED_INDICATORS)
    return prices.join(wanted, ["symbol", "date"], "left")


def read_prices(prices: DataFrame, indicators: DataFrame, symbol: str, as_of: str,
                days: int = 180) -> DataFrame:
    """One symbol's joined rows since ``as_of - days``, by date. The filter on
    the join keys reaches both scans."""
    start = F.date_sub(F.lit(as_of).cast("date"), days)

    def since(df: DataFrame) -> DataFrame:
        return df.where((F.col("symbol") == symbol) & (F.col("date") >= start))

    return prices_with_indicators(since(prices), since(indicators)).orderBy("date")


def last_volatility(bars: DataFrame, rows: int = 20) -> DataFrame:
    """Sample deviation of the last closes and the current close per symbol.
    Positions pick the rows, so nothing is ranked."""
    recent = bars.where(F.col("pos") >= F.col("n") - rows)
    return recent.groupBy("symbol").agg(
        F.stddev_samp("close").alias("std"), F.max_by("close", "date").alias("current_price")
    )

