"""Deduplication, quality filters, derived columns and record validation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barline.functions.scalar import missing
from barline.schemas import INDICATOR_RECORD

Rules = dict[str, Column]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order``.

    An aggregate, not a ranking: copies of a hot key are reduced before the
    shuffle. ``order`` should be total within a key; equal rows are the same.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def dedupe_bars(df: DataFrame) -> DataFrame:
    """Latest ingested bar per symbol and date, ties settled by value."""
    order = ["ingested_at"] + [
        c for c in df.columns if c not in ("symbol", "date", "ingested_at")
    ]
    return latest_per_key(df, ["symbol", "date"], order)


def quality_filter(df: DataFrame) -> DataFrame:
    """Positive close and volume, and a range that is not crossed. A missing
    value makes its comparison NULL, which drops the row."""
    return df.where("close > 0 AND volume > 0 AND high >= low")


def with_daily_return(df: DataFrame, limit: float = 0.5) -> DataFrame:
    """Add the open-to-close return and drop moves of ``limit`` or more; a
    missing or zero open drops the row."""
    moved = df.selectExpr("*", "try_divide(close - open, open) AS daily_return")
    return moved.where(f"abs(daily_return) < {limit}D")


def clean(df: DataFrame, before: Observation | None = None,
          after: Observation | None = None) -> DataFrame:
    """Dedupe, filter and add the daily return. The observations receive the
    row counts on both sides while the one job runs."""
    source = df.observe(before, F.count(F.lit(1)).alias("rows")) if before else df
    done = with_daily_return(quality_filter(dedupe_bars(source)))
    return done.observe(after, F.count(F.lit(1)).alias("rows")) if after else done


def derive(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Price range, typical price (called vwap), calendar columns (Sunday is
    day 1) and the processing time."""
    wide = df.selectExpr(
        "*",
        "high - low AS price_range",
        "(high + low + close) / 3 AS vwap",
        "year(date) AS year",
        "month(date) AS month",
        "dayofweek(date) AS day_of_week",
    )
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return wide.withColumn("processed_at", stamp)


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with the names of the rules
    they break. A rule that is NULL counts as broken."""
    judged = with_reasons(df, rules)
    valid = judged.where(F.size("reasons") == 0).drop("reasons")
    return valid, judged.where(F.size("reasons") > 0)


def with_reasons(df: DataFrame, rules: Rules) -> DataFrame:
    broken = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def price_record(df: DataFrame) -> DataFrame:
    return df.withColumn("symbol", F.upper(F.trim("symbol")))


def price_rules() -> Rules:
    rules = {"symbol": F.col("symbol").isNotNull(), "date": F.col("date").isNotNull()}
    for c in ("open", "high", "low", "close", "adjusted_close"):
        rules[c] = F.col(c) > 0
    rules["volume"] = F.col("volume") >= 0
    rules["high_low"] = F.col("high") >= F.col("low")
    return rules


def tick_record(df: DataFrame) -> DataFrame:
    return df.withColumn("source", F.coalesce("source", F.lit("unknown")))


def tick_rules() -> Rules:
    return {
        "symbol": F.col("symbol").isNotNull(),
        "price": F.col("price") > 0,
        "volume": F.col("volume") >= 0,
        "bid": F.col("bid") > 0,
        "ask": F.col("ask") > 0,
        "timestamp": F.col("timestamp").isNotNull(),
    }


def indicator_record(df: DataFrame) -> DataFrame:
    """Landed rows as ``INDICATOR_RECORD`` with ``reasons``: a symbol and a date are needed, any
    indicator may be missing, but one that is there must be a number."""
    def read(f):
        return F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)

    unread = []
    for f in INDICATOR_RECORD:
        bad = read(f).isNull() if not f.nullable else F.lit(False)
        if f.name in df.columns:
            bad = bad | (F.col(f.name).isNotNull() & read(f).isNull())
        unread.append(F.when(bad, f.name))
    return df.select(*[read(f).alias(f.name) for f in INDICATOR_RECORD], F.array_compact(F.array(*unread)).alias("reasons"))


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where none of ``columns`` is NULL or NaN."""
    types = dict(df.dtypes)
    for c in columns:
        gone = missing(F.col(c)) if types[c] in ("double", "float") else F.col(c).isNull()
        df = df.where(~gone)
    return df
