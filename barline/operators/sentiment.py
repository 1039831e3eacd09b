"""Headline scoring and sentiment aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.text import Scorer, compound, label, lexicon, wide_label
from barline.operators.cleaning import latest_per_key


def dedupe_headlines(df: DataFrame, order: Sequence[str] = ("date", "url")) -> DataFrame:
    """First row per symbol and headline by ``order``. Copies of one headline
    meet in an aggregate, so they are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in ("symbol", "headline")]
    best = df.groupBy("symbol", "headline").agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return best.select("symbol", "headline", "_row.*").select(*df.columns)


def score_headlines(df: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Add the four scores. ``scorer`` may wrap a pandas UDF for a model."""
    scored = df.withColumn("_s", (scorer or lexicon())(F.col("headline")))
    return scored.select(
        *df.columns,
        *[F.col(f"_s.{n}").alias(f"sentiment_{n}")
          for n in ("positive", "negative", "neutral", "compound")],
    )


def daily_sentiment(df: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Mean scores and article count per symbol and date."""
    return daily_means(score_headlines(df, scorer))


def daily_means(scored: DataFrame) -> DataFrame:
    """The same from rows that are scored already."""
    means = [
        F.avg(f"sentiment_{n}").alias(f"sentiment_{n}")
        for n in ("compound", "positive", "negative")
    ]
    return scored.groupBy("symbol", "date").agg(*means, F.count(F.lit(1)).alias("article_count"))


def score_articles(articles: DataFrame,
                   score: Callable[[Column], Column] | None = None) -> DataFrame:
    """Score and label per article. The label follows the unrounded score."""
    raw = articles.withColumn("_c", (score or compound())(F.col("title")))
    return raw.withColumns(
        {"sentiment_score": F.round("_c", 4), "sentiment_label": label(F.col("_c"))}
    ).drop("_c")


def symbol_sentiment(scored: DataFrame, symbols: DataFrame) -> DataFrame:
    """Mean of the rounded article scores per symbol of ``symbols``; a symbol
    without articles is neutral."""
    means = scored.groupBy("symbol").agg(
        F.avg("sentiment_score").alias("_mean"), F.count(F.lit(1)).alias("_count")
    )
    mean = F.coalesce("_mean", F.lit(0.0))
    return symbols.select("symbol").distinct().join(means, "symbol", "left").select(
        "symbol",
        F.round(mean, 4).alias("aggregate_score"),
        label(mean).alias("aggregate_label"),
        F.coalesce("_count", F.lit(0)).alias("article_count"),
    )


def sentiment_counts(per_symbol: DataFrame) -> DataFrame:
    name = F.col("aggregate_label")
    return per_symbol.agg(
        F.count_if(name == "Bullish").alias("bullish"),
        F.count_if(name == "Bearish").alias("bearish"),
        F.count_if(name == "Neutral").alias("neutral"),
    )


def latest_sentiment(daily: DataFrame) -> DataFrame:
    """Each symbol's newest daily score with the wide label, best first."""
    newest = latest_per_key(daily.select("symbol", "date", "sentiment_compound"), ["symbol"], ["date"])
    return newest.withColumn("label", wide_label(F.col("sentiment_compound"))).orderBy(
        F.desc("sentiment_compound"), "symbol"
    )


def join_sentiment(features: DataFrame, daily: DataFrame) -> DataFrame:
    """Daily sentiment as one more signal; days without news have no score."""
    signal = daily.select("symbol", "date", F.col("sentiment_compound").alias("sentiment_score"))
    return features.join(signal, ["symbol", "date"], "left")
