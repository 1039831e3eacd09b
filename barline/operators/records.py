"""Response records with nested series, and one table of them as JSON that expires by kind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators import backtest, portfolio
from barline.operators.merge import TTL, snapshot
from barline.session import stage

#: The key of each kind of record, after the kind itself.
KEYS = {"prediction": "symbol", "sentiment": "symbol", "backtest": "symbol", "portfolio": "symbols"}


def backtest_record(predictions: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Metrics of each symbol with its chart: at most some sixty points in order of date.

    Points are picked before they are gathered, so a list is short however long a series is.
    """
    point = F.struct("date", "actual", "predicted", "equity")
    charts = backtest.backtest_chart(predictions, fraction).groupBy("symbol").agg(
        F.sort_array(F.collect_list(point)).alias("chart"))
    return backtest.backtest_metrics(predictions, fraction).join(charts, "symbol", "left")


def portfolio_record(returns: DataFrame, draws: int = portfolio.DRAWS,
                     points: int = portfolio.FRONTIER_POINTS, seed: int = portfolio.SEED) -> DataFrame:
    """The best portfolio with ``points`` sampled ``(ret, vol)`` pairs in order of draw."""
    moments = stage(portfolio.draw_moments(returns, max(draws, points), seed, equal=True), "moments")
    sampled = portfolio.frontier(returns, points, seed, moments)
    ordered = sampled.agg(F.sort_array(F.collect_list(F.struct("portfolio", "ret", "vol"))).alias("p"))
    frontier = ordered.select(F.transform("p", lambda x: F.struct(x["ret"].alias("ret"), x["vol"].alias("vol")))).scalar()
    best = portfolio.optimize(returns, draws, seed, moments=moments.where(F.col("portfolio") < draws))
    return best.withColumn("frontier", frontier)


def sentiment_record(scored: DataFrame, per_symbol: DataFrame, shown: int) -> DataFrame:
    """Aggregates of each symbol with its first ``shown`` articles by ``seq``.

    The list is a display of the first articles; the aggregates are over all of them.
    """
    first = scored.where(F.col("seq") < shown)
    fields = ["title", "publisher", "url", "published_at", "sentiment_score", "sentiment_label"]
    lists = first.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("seq", *fields))).alias("a"))
    drop_seq = F.transform("a", lambda x: F.struct(*[x[c].alias(c) for c in fields]))
    none = F.array().cast(lists.select(drop_seq.alias("a")).schema["a"].dataType)
    return per_symbol.join(lists, "symbol", "left").select(
        *per_symbol.columns, F.coalesce(drop_seq, none).alias("articles"))


def as_values(records: DataFrame, kind: str, made_at: Column) -> DataFrame:
    """One row per record: its key, its JSON text, when it was made and when it expires."""
    name = F.col(KEYS[kind])
    name = F.concat_ws(",", F.sort_array(name)) if kind == "portfolio" else name
    text = records.select(F.concat(F.lit(f"{kind}:"), name).alias("_key"), F.to_json(F.struct("*")).alias("value"),
                          made_at.cast("timestamp").alias("made_at"))
    return snapshot(text, F.col("_key"), "made_at", ["value"], TTL[kind]).withColumn("kind", F.lit(kind))


def record_table(parts: dict[str, DataFrame], made_at: Column) -> DataFrame:
    """All kinds of records in one table; every kind keeps its own time to live."""
    return reduce(DataFrame.unionByName, [as_values(df, kind, made_at) for kind, df in parts.items()])
