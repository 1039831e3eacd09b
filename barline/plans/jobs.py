"""Whole jobs, one Spark application each; scheduling is left to the caller."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barline.functions.text import Scorer
from barline.operators import backtest, forecast, quality, records, sentiment
from barline.operators.cleaning import clean, derive
from barline.operators.indicators import features
from barline.operators.selection import MIN_ROWS, ingest_totals, union_frames
from barline.operators.series import index_series, keyless
from barline.schemas import INDICATORS
from barline.session import stage, staging
from barline.sinks.lake import write_processed, write_raw
from barline.sinks.models import ModelStore
from barline.sinks.warehouse import Warehouse
from barline.sources import payloads
from barline.sources.lake import read_raw


class EtlCounts(NamedTuple):
    read: int
    written: int


class ValidationFailed(RuntimeError):
    pass


def processed_bars(raw: DataFrame, before: Observation | None = None,
                   after: Observation | None = None) -> DataFrame:
    """Cleaned bars with derived columns and indicators. The cleaned bars are
    staged: numbering and indicators each read them more than once. Bars without
    a symbol or a date stay, without indicators, for the checks to report."""
    base = stage(derive(clean(raw, before, after)), "clean")
    indexed = stage(index_series(base, neighbours=["close"]), "indexed")
    done = features(indexed).select(*base.columns, *INDICATORS)
    return done.unionByName(keyless(base), allowMissingColumns=True)


def run_etl(spark: SparkSession, lake_path: str, output_path: str) -> EtlCounts:
    """Raw lake to processed table. Row counts come out of the job itself."""
    before, after = Observation(), Observation()
    with staging(spark):
        write_processed(processed_bars(read_raw(spark, lake_path), before, after), output_path)
    return EtlCounts(int(before.get["rows"]), int(after.get["rows"]))


def load_warehouse(spark: SparkSession, processed_path: str, warehouse: Warehouse,
                   run_id: str, dag_id: str = "batch") -> None:
    """Validate, then merge into both tables and log the run. A failed check
    stops the load and is logged too."""
    started = dt.datetime.now(dt.timezone.utc)
    processed = spark.read.parquet(processed_path)
    if not quality.passes(processed):
        now = dt.datetime.now(dt.timezone.utc)
        warehouse.log_run(dag_id, run_id, "failed", 0, started, now, "validation failed")
        raise ValidationFailed(processed_path)
    rows = warehouse.load_processed(processed)
    now = dt.datetime.now(dt.timezone.utc)
    warehouse.log_run(dag_id, run_id, "ok", rows, started, now)


def _matrix(processed: DataFrame) -> DataFrame:
    bars = processed.select("symbol", "date", "open", "high", "low", "close", "volume")
    indexed = stage(index_series(bars, neighbours=["close"]), "indexed")
    return stage(forecast.feature_matrix(indexed), "matrix")


def score_symbols(processed: DataFrame, warehouse: Warehouse, store: ModelStore,
                  as_of: str) -> tuple[DataFrame, DataFrame]:
    """Predict every symbol with the promoted model and merge the predictions. Returns the
    records and the symbols without one: all of them while no model is promoted, else
    those that have too little history. Nothing is fitted here."""
    matrix = _matrix(processed)
    version = store.promoted()
    model = forecast.rule("naive") if version is None else store.load(version)
    usable = matrix.limit(0) if version is None else matrix
    records = forecast.forecast(usable, model, as_of, version or "", need=MIN_ROWS["infer"])
    records = stage(records, "forecast")
    warehouse.upsert_predictions(records.drop("current_price", "model_trained_at"))
    return records, forecast.skipped(processed, records)


class Ingested(NamedTuple):
    totals: DataFrame
    articles: DataFrame
    headlines: DataFrame


def ingest(prices: DataFrame, news: DataFrame, lake_path: str, rejects_path: str, run_id: str,
           as_of: Column) -> Ingested:
    """Land both feeds ``(symbol, payload)``: bars go to the lake, articles are returned, and
    whatever cannot be read goes to the table of rejects with its reason.

    ``totals`` counts the landed bars per symbol and, with a NULL symbol, overall.
    """
    bars, bad_days = payloads.parse_daily(prices, as_of.cast("timestamp"))
    bars = stage(bars.withColumn("date", F.col("date").cast("timestamp")), "landed")
    write_raw(bars, lake_path, F.to_date(as_of))
    items = stage(payloads.news_items(news), "items")
    rejects = [bad_days.select(F.lit("prices").alias("feed"), "symbol", F.col("date").alias("item"), "reason")]
    rejects += [df.select(F.lit("news").alias("feed"), "symbol", "item", "reason")
                for df in (payloads.untitled_news(items), payloads.unread_news(news))]
    table = union_frames(*rejects).withColumn("run_id", F.lit(run_id))
    # A run that is repeated replaces its own rejects.
    table.write.mode("overwrite").parquet(f"{rejects_path}/run={run_id}")
    articles = payloads.parse_news(items)
    headlines = sentiment.dedupe_headlines(payloads.news_headlines(articles, as_of))
    return Ingested(ingest_totals(bars), articles, headlines)


def load_sentiment(headlines: DataFrame, warehouse: Warehouse, run_id: str,
                   scorer: Scorer | None = None, dag_id: str = "news") -> bool:
    """Score, check and merge the daily sentiment. News that fail their gate are logged and
    not stored; they do not stop the prices."""
    started = dt.datetime.now(dt.timezone.utc)
    scored = stage(sentiment.score_headlines(headlines, scorer), "scored")
    ok = bool(quality.statistics(quality.validate_headlines(scored)).first()["success"])
    rows = warehouse.upsert_sentiment(sentiment.daily_means(scored)) if ok else 0
    now = dt.datetime.now(dt.timezone.utc)
    warehouse.log_run(dag_id, run_id, "ok" if ok else "failed", rows, started, now, None if ok else "validation failed")
    return ok


class BatchResult(NamedTuple):
    totals: DataFrame
    counts: EtlCounts
    sentiment: DataFrame
    sentiment_counts: DataFrame
    predictions: DataFrame
    skipped: DataFrame
    records: DataFrame


def run_batch(spark: SparkSession, prices: DataFrame, news: DataFrame, root: str, run_id: str, as_of: str,
              scorer: Scorer | None = None, score: Callable[[Column], Column] | None = None) -> BatchResult:
    """The whole flow below ``root``: both feeds landed, ETL, a gate for each feed, merges, scoring
    by the promoted model, and the records that readers get.

    Folders: lake, rejects, processed, warehouse, models. A failed price gate stops the
    flow (``ValidationFailed``); a failed news gate leaves the stored sentiment as it is.
    """
    day = F.lit(as_of)
    warehouse, store = Warehouse(spark, f"{root}/warehouse"), ModelStore(spark, f"{root}/models")
    landed = ingest(prices, news, f"{root}/lake", f"{root}/rejects", run_id, day)
    totals = stage(landed.totals, "totals")
    counts = run_etl(spark, f"{root}/lake", f"{root}/processed")
    load_warehouse(spark, f"{root}/processed", warehouse, run_id)
    load_sentiment(landed.headlines, warehouse, run_id, scorer)
    processed = spark.read.parquet(f"{root}/processed")
    articles = stage(sentiment.score_articles(landed.articles, score), "articles")
    per_symbol = stage(sentiment.symbol_sentiment(articles, processed), "per_symbol")
    made, left_out = score_symbols(processed, warehouse, store, as_of)
    shown = records.sentiment_record(articles, per_symbol, payloads.NEWS_ITEMS)
    table = records.record_table({"prediction": made, "sentiment": shown}, day)
    return BatchResult(totals, counts, per_symbol, sentiment.sentiment_counts(per_symbol), made, left_out, table)


class Retrained(NamedTuple):
    metrics: DataFrame
    summary: DataFrame
    promoted: bool


def run_retrain(processed: DataFrame, store: ModelStore, version: str, model: PipelineModel | None = None,
                trees: int = forecast.TREES, gate: float = backtest.PROMOTION_SHARPE,
                decided_at: dt.datetime | None = None) -> Retrained:
    """Fit (unless a ``model`` is given), save, backtest every symbol and decide.

    The model is saved before it is judged and judged as it was saved, so a promoted
    version is the one that scoring loads. Below the gate, the version promoted before stays.
    """
    matrix = _matrix(processed)
    enough = matrix.where(F.col("n") >= MIN_ROWS["backtest"])
    store.save(version, model or forecast.fit(enough, trees=trees))
    predictions = stage(forecast.backtest_predictions(enough, store.load(version)), "backtest")
    metrics = stage(backtest.backtest_flags(backtest.backtest_metrics(predictions)), "metrics")
    summary = backtest.retrain_summary(metrics, gate)
    store.decide(version, summary, decided_at)
    return Retrained(metrics, summary, store.promoted() == version)


def monitor(offsets: DataFrame, messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Backlog per topic and message quality."""
    from barline.streaming import ticks

    return ticks.backlog(offsets), ticks.quality_summary(messages)
