"""Keyed merges into parquet tables, and latest-value snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.cleaning import latest_per_key
from barline.schemas import INDICATORS

# Table keys and the columns that a conflict replaces.
PRICE_KEYS = ["symbol", "date"]
PRICE_UPDATES = ["close", "adjusted_close", "volume"]
INDICATOR_KEYS = ["symbol", "date"]
SENTIMENT_KEYS = ["symbol", "date"]
PREDICTION_KEYS = ["symbol", "prediction_date", "model_version"]
PREDICTION_UPDATES = [
    "predicted_price", "confidence_lower", "confidence_upper", "confidence_score",
]

# Seconds a snapshot value lives.
TTL = {
    "default": 300, "price": 60, "prediction": 3600, "sentiment": 1800,
    "backtest": 86400, "portfolio": 3600,
}


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 updates: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """``target`` after inserting ``source``; on a key conflict only
    ``updates`` are replaced, and of those only the ones that the source has.
    Source columns that are absent stay NULL in new rows. Of source rows that share a key the last by ``order`` wins; without
    an order, the greatest by value.

    Presence is carried by flags, so a NULL value is never taken for a missing
    row. Both sides are unique per key, so the join cannot be skewed; the
    source is reduced and joined on one partitioning. As in a unique index, a
    NULL key conflicts with nothing.
    """
    values = [c for c in source.columns if c not in keys]
    source = latest_per_key(source, keys, order or values) if values else source.distinct()
    s = source.select(
        *[F.col(k).alias(f"s_{k}") for k in keys],
        *[F.col(c).alias(f"s_{c}") for c in target.columns if c in source.columns and c not in keys],
        F.lit(True).alias("_in_source"),
    )
    t = target.withColumn("_in_target", F.lit(True))
    on = [t[k] == s[f"s_{k}"] for k in keys]
    both = t.join(s, on, "full_outer")
    in_source, in_target = F.col("_in_source").isNotNull(), F.col("_in_target").isNotNull()
    out = []
    for f in target.schema:
        c = f.name
        incoming = F.col(f"s_{c}").cast(f.dataType) if f"s_{c}" in s.columns else F.lit(None)
        if c in keys:
            value = F.when(in_target, F.col(c)).otherwise(incoming)
        elif c in updates and f"s_{c}" in s.columns:
            value = F.when(in_source, incoming).otherwise(F.col(c))
        else:
            value = F.when(in_target, F.col(c)).otherwise(incoming)
        out.append(value.cast(f.dataType).alias(c))
    return both.select(*out)


def upsert_prices(target: DataFrame, source: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return merge_upsert(target, source, PRICE_KEYS, PRICE_UPDATES, order)


def upsert_indicators(target: DataFrame, source: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Replaces every indicator that the source has; the others are kept."""
    available = [c for c in INDICATORS if c in source.columns]
    return merge_upsert(target, source, INDICATOR_KEYS, available, order)


def upsert_predictions(target: DataFrame, source: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Replaces the price, its band and its score, never the sentiment."""
    return merge_upsert(target, source, PREDICTION_KEYS, PREDICTION_UPDATES, order)


def upsert_sentiment(target: DataFrame, source: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Replaces every score and count that the source has."""
    values = [c for c in target.columns if c not in (*SENTIMENT_KEYS, "created_at")]
    return merge_upsert(target, source, SENTIMENT_KEYS, values, order)


def snapshot(df: DataFrame, key: Column, time: str, value: Sequence[str], ttl: int,
             tie: Sequence[str] = ()) -> DataFrame:
    """Latest value per upper-case key with the time it expires."""
    order = F.struct(F.col(time), *[F.col(c) for c in tie])
    latest = df.groupBy(F.upper(key).alias("key")).agg(
        F.max_by(F.struct(time, *value), order).alias("_v")
    )
    return latest.select("key", "_v.*").withColumn(
        "expires_at", F.col(time) + F.expr(f"INTERVAL {int(ttl)} SECONDS")
    )


def live(snap: DataFrame, as_of: Column) -> DataFrame:
    """Rows that have not expired at ``as_of``."""
    return snap.where(F.col("expires_at") > as_of)
