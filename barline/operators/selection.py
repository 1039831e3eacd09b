"""Filters and top-k selections used by the read side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# User-facing aliases and tracked instruments.
ALIASES = {"BTC": "BTC-USD", "ETH": "ETH-USD", "EURUSD": "EURUSD=X"}
TRACKED = [
    "AAPL", "MSFT", "GOOGL", "TSLA", "AMZN", "META", "NVDA", "BTC-USD", "ETH-USD", "EURUSD=X",
]
# Rows a series needs for each use.
MIN_ROWS = {"train": 80, "infer": 60, "live_fit": 10, "backtest": 60, "returns": 2}


def resolve_symbol(symbol: Column, aliases: dict[str, str] | None = None) -> Column:
    """Upper-case symbol with its alias applied. The alias list is a fixed
    literal, so it is an expression and not a join."""
    table = ALIASES if aliases is None else aliases
    name = F.upper(symbol)
    if not table:
        return name
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, name), name)


def with_resolved(df: DataFrame, aliases: dict[str, str] | None = None,
                  tracked: Sequence[str] | None = None) -> DataFrame:
    """Add ``resolved`` and ``supported``."""
    allowed = TRACKED if tracked is None else tracked
    resolved = df.withColumn("resolved", resolve_symbol(F.col("symbol"), aliases))
    return resolved.withColumn("supported", F.col("resolved").isin(*allowed))


def last_rows(df: DataFrame, rows: int, key: str = "symbol", order: Sequence[str] = ("date",)):
    """Last ``rows`` rows per key. Spark keeps only ``rows`` rows per key and
    map task before the shuffle, whatever the size of the key."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows).drop("_rn")


def first_rows(df: DataFrame, rows: int, key: str = "symbol", order: Sequence[str] = ("date",)):
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= rows).drop("_rn")


def history(df: DataFrame, symbol: str, days: int, as_of: str) -> DataFrame:
    """One symbol's rows of the last ``days`` calendar days before ``as_of``."""
    start = F.date_sub(F.lit(as_of).cast("date"), days)
    return df.where((F.col("symbol") == symbol) & (F.col("date") >= start)).orderBy("date")


def history_gate(df: DataFrame, need: int, key: str = "symbol") -> DataFrame:
    """Rows per key and whether they reach ``need``; short keys are reported."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counts.withColumn("enough", F.col("rows") >= need)


def union_frames(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def ingest_totals(df: DataFrame) -> DataFrame:
    """Rows per symbol and, with a NULL symbol, the grand total."""
    return df.rollup("symbol").agg(F.count(F.lit(1)).alias("rows"))
