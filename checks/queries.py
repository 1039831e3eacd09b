"""One registered query per operator; every one runs over whole tables."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barline.functions import signals, text
from barline.functions.scalar import rounded, symbol_list
from barline.operators import (
    backtest, cleaning, forecast, indicators, market, merge, portfolio, quality, records, selection,
    sentiment, series,
)
from barline.plans import jobs
from barline.schemas import INDICATOR_RECORD
from barline.session import shared_dir
from barline.sinks import lake as lake_sink
from barline.sinks.models import ModelStore
from barline.sinks.warehouse import Warehouse
from barline.sources import driver_tables as given
from barline.sources import lake as lake_source
from barline.sources import payloads
from barline.streaming import ticks as tick_ops
from checks import lake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A lexicon of common words, because market words are absent from the texts.
POS, NEG = ["the", "and", "is"], ["of", "to", "a"]
AS_OF = "1998-12-01"
TICK_AS_OF = "2024-01-30 23:50:00"
PORTFOLIO_DAYS = 252


def query(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def plain_ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def _points(name: str, *fields: str) -> Column:
    """A list of structs as text, numbers with four places."""
    def one(x):
        return F.concat_ws("|", *[x[f].cast("string") if f == "date" else x[f].cast("decimal(18,4)").cast("string") for f in fields])

    return F.array_join(F.transform(name, one), ";")


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


OHLC = {"open": 4, "high": 4, "low": 4, "close": 4}


# -- sources, cleaning, validation --------------------------------------------


@query
def bars_daily(spark, sf):
    return rounded(given.bars(given.quotes(spark, sf)), OHLC)


@query
def clean_bars(spark, sf):
    done = cleaning.clean(given.raw_bars(given.quotes(spark, sf)))
    return rounded(
        done.select("symbol", "date", *OHLC, "volume", "daily_return"), {**OHLC, "daily_return": 6}
    )


@query
def derive_bars(spark, sf):
    done = cleaning.derive(lake.cleaned(spark, sf))
    return rounded(
        done.select("symbol", "date", "price_range", "vwap", "year", "month", "day_of_week"),
        {"price_range": 4, "vwap": 4},
    )


@query
def dedupe_latest(spark, sf):
    q = given.quotes(spark, sf).select("symbol", "date", "price", "volume", *given.QUOTE_ORDER)
    best = cleaning.latest_per_key(q, ["symbol", "date"], given.QUOTE_ORDER)
    return best.select(
        "symbol", "date", F.round("price", 4).alias("price"), "volume", "l_orderkey", "l_linenumber"
    )


def _price_records(spark, sf):
    q = given.quotes(spark, sf)
    return cleaning.price_record(
        q.select(
            F.lower("symbol").alias("symbol"), "date",
            F.col("price").alias("open"),
            (F.col("price") * (1 + F.col("l_discount") - F.col("l_tax"))).alias("high"),
            F.col("price").alias("low"), F.col("price").alias("close"),
            F.col("price").alias("adjusted_close"), "volume",
        )
    )


@query
def split_valid_prices(spark, sf):
    judged = cleaning.with_reasons(_price_records(spark, sf), cleaning.price_rules())
    return judged.groupBy("symbol", F.array_join("reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("volume").alias("volume")
    )


@query
def split_valid_ticks(spark, sf):
    t = cleaning.tick_record(given.ticks(spark, sf))
    good, bad = cleaning.split_valid(t, cleaning.tick_rules())
    marked = good.withColumn("reasons", F.array().cast("array<string>")).unionByName(bad)
    return marked.groupBy("symbol", F.array_join("reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def drop_incomplete(spark, sf):
    f = lake.featured(spark, sf)
    kept = cleaning.drop_incomplete(f, ["macd_signal", "return_5d"])
    return kept.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.min("date").alias("first_date")
    )


@query
def validate_fallback(spark, sf):
    return quality.validate(lake.featured(spark, sf))


@query
def validate_quotes(spark, sf):
    q = given.quotes(spark, sf).select("symbol", "date", F.col("price").alias("close"), "volume")
    return quality.validate(q)


@query
def validate_expectations(spark, sf):
    return quality.validate_expectations(lake.featured(spark, sf))


@query
def expectations_broken(spark, sf):
    """Each expectation fails on some bars: the checks count them, and the statistics say so."""
    day = F.dayofmonth("date")
    bars = lake.featured(spark, sf).withColumns({
        "close": F.when(day == 3, -F.col("close")).when(day == 4, None).otherwise(F.col("close")),
        "volume": F.when(day == 5, -F.col("volume")).otherwise(F.col("volume")),
        "rsi_14": F.when(day == 6, F.col("rsi_14") + 100.5).otherwise(F.col("rsi_14")),
        "symbol": F.when(day == 7, None).otherwise(F.col("symbol")),
        "date": F.when(day == 8, None).otherwise(F.col("date")),
    })
    found = quality.validate_expectations(bars)
    total = quality.statistics(found)
    return found.join(total.withColumnRenamed("success", "all_passed"), F.lit(True))


@query
def validation_statistics(spark, sf):
    return quality.statistics(quality.validate_expectations(lake.featured(spark, sf)))


@query
def parse_daily_json(spark, sf):
    """Bars to one JSON payload per symbol and year, and back."""
    bars = lake.raw(spark, sf)
    fields = F.create_map(
        *[x for name, f in payloads.BAR_FIELDS.items()
          for x in (F.lit(f), F.col(name).cast("string"))]
    )
    days = F.map_from_entries(F.collect_list(F.struct(F.col("date").cast("string"), fields)))
    body = F.struct(days.alias(payloads.SERIES_FIELD))
    landed = bars.groupBy("symbol", F.year("date")).agg(F.to_json(body).alias("payload"))
    rows, _ = payloads.parse_daily(landed)
    return rounded(rows.select("symbol", "date", *OHLC, "adjusted_close", "volume"),
                   {**OHLC, "adjusted_close": 4})


def _run_dir(spark, name):
    import uuid

    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query
def lake_roundtrip(spark, sf):
    path = _run_dir(spark, "lake")
    bars = lake.raw(spark, sf).select("symbol", "date", *OHLC, "volume")
    lake_sink.write_raw(bars, path, F.lit("2024-01-02").cast("date"))
    back = lake_source.read_partition(spark, path, bars.schema, ingest_date="2024-01-02")
    return rounded(back.select("symbol", "date", *OHLC, "volume"), OHLC)


@query
def etl_processed(spark, sf):
    """The ETL job without its final write."""
    done = jobs.processed_bars(lake.raw(spark, sf)).drop("processed_at", "ingested_at", "adjusted_close")
    return rounded(done, {**OHLC, **ALL_PLACES, "daily_return": 6, "price_range": 4, "vwap": 4})


@query
def warehouse_load(spark, sf):
    """Processed bars merged into both tables, then read back joined."""
    tables = Warehouse(spark, _run_dir(spark, "warehouse"))
    tables.load_processed(lake.featured(spark, sf))
    done = market.prices_with_indicators(
        tables.read("stock_prices").select("symbol", "date", *OHLC, "volume"),
        tables.read("technical_indicators"),
    )
    kinds = dict(done.dtypes)
    return done.withColumns({c: F.col(c).cast("double") for c, t in kinds.items() if "decimal" in t})


@query
def warehouse_upserts(spark, sf):
    """Two overlapping feeds merged one after the other by touched months, and read from a day on."""
    tables = Warehouse(spark, _run_dir(spark, "warehouse"))
    columns = ["symbol", "date", *OHLC, "adjusted_close", "volume"]
    for status in ("F", "O"):
        tables.upsert_prices(lake.by_status(spark, sf, status).select(*columns))
    done = tables.read("stock_prices", since="1994-07-15").select(*columns)
    return done.withColumns({c: F.col(c).cast("double") for c, t in done.dtypes if "decimal" in t})


@query
def processed_roundtrip(spark, sf):
    path = _run_dir(spark, "processed")
    f = lake.featured(spark, sf).select("symbol", "date", "close", "rsi_14")
    lake_sink.write_processed(f.withColumns({"year": F.year("date"), "month": F.month("date")}), path)
    back = lake_source.read_processed(spark, path, since="1996-07-01")
    return rounded(back.select("symbol", "date", "close", "rsi_14"), {"close": 4, "rsi_14": 4})


@query
def etl_counts(spark, sf):
    """One ETL run from a written lake: rows read, rows written, and rows found."""
    source, target = _run_dir(spark, "lake"), _run_dir(spark, "processed")
    # One directory a symbol: the run is measured here, not the layout.
    lake.raw(spark, sf).withColumns({c: F.col(c).cast("timestamp") for c in ("date", "ingested_at")}).write.partitionBy("symbol").parquet(source)
    before, after = Observation(), Observation()
    done = jobs.processed_bars(lake_source.read_raw(spark, source), before, after)
    done.write.parquet(target)
    found = spark.read.parquet(target).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"), F.count("rsi_14").alias("rated"))
    return found.withColumns({"read": F.lit(int(before.get["rows"])), "written": F.lit(int(after.get["rows"]))})


@query
def indicator_records(spark, sf):
    """Indicators as landed text; one of them is no number on every thirteenth of a month."""
    names = [f.name for f in INDICATOR_RECORD]
    landed = lake.featured(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in names if c != "return_5d"])
    landed = landed.withColumn("macd", F.when(F.col("date").endswith("-13"), "n/a").otherwise(F.col("macd")))
    done = cleaning.indicator_record(landed)
    return done.groupBy("symbol", F.array_join("reasons", ",").alias("reasons")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("macd").alias("macds"), F.count("return_5d").alias("returns"),
        F.round(F.sum("rsi_14"), 2).alias("rsi_total"))


# -- indicators ----------------------------------------------------------------


def _rolled(spark, sf, places):
    done = indicators.rolling(lake.indexed(spark, sf), *places)
    return rounded(done.select("symbol", "date", *places), places)


def _recursed(spark, sf, places):
    done = indicators.recursive(lake.indexed(spark, sf), *places)
    return rounded(done.select("symbol", "date", *places), places)


@query
def returns(spark, sf):
    return _rolled(spark, sf, {"return_1d": 6, "return_5d": 6})


@query
def bollinger(spark, sf):
    return _rolled(spark, sf, {"bb_upper": 4, "bb_lower": 4, "bb_width": 4})


@query
def sma(spark, sf):
    return _rolled(spark, sf, {"sma_10": 4, "sma_20": 4})


@query
def volume_ratio(spark, sf):
    return _rolled(spark, sf, {"vol_ratio": 6})


@query
def ema12(spark, sf):
    done = series.ewm(lake.indexed(spark, sf), "close", 2 / 13, "ema_12", min_rows=12)
    return done.select("symbol", "date", F.round("ema_12", 4).alias("ema_12"))


@query
def rsi(spark, sf):
    return _recursed(spark, sf, {"rsi_14": 4})


@query
def macd(spark, sf):
    return _recursed(spark, sf, {"macd": 4, "macd_signal": 4, "macd_hist": 4})


@query
def atr(spark, sf):
    return _recursed(spark, sf, {"atr_14": 4})


ALL_PLACES = {"rsi_14": 4, "macd": 4, "macd_signal": 4, "macd_hist": 4, "bb_upper": 4,
              "bb_lower": 4, "bb_width": 4, "atr_14": 4, "return_1d": 6, "return_5d": 6}


@query
def indicators_all(spark, sf):
    """The whole ETL: quotes to bars, cleaning, indicators."""
    done = indicators.features(lake.indexed(spark, sf))
    return rounded(done.select("symbol", "date", *ALL_PLACES), ALL_PLACES)


FEATURE_PLACES = {c: 4 for c in forecast.LIVE_FEATURES if c != "volume"}


@query
def feature_matrix(spark, sf):
    done = forecast.feature_matrix(lake.indexed(spark, sf))
    return rounded(
        done.select("symbol", "date", "pos", "n", *forecast.LIVE_FEATURES), FEATURE_PLACES
    )


@query
def batch_features(spark, sf):
    whole = ("volume", "day_of_week")
    places = {c: 4 for c in [*forecast.BATCH_FEATURES, forecast.BATCH_TARGET] if c not in whole}
    return rounded(forecast.batch_features(cleaning.derive(lake.featured(spark, sf))), places)


@query
def next_target(spark, sf):
    done = backtest.with_target(lake.indexed(spark, sf))
    return rounded(done.select("symbol", "date", "close", "target"), {"close": 4, "target": 4})


@query
def chrono_split(spark, sf):
    done = backtest.chronological_split(lake.indexed(spark, sf), 0.85)
    return done.select("symbol", "date", "pos", "part")


@query
def log_returns(spark, sf):
    done = portfolio.log_returns(lake.indexed(spark, sf))
    return done.select("symbol", "date", F.round("r", 6).alias("r"))


@query
def market_window(spark, sf):
    return market.market_view(lake.indexed(spark, sf), 90)


@query
def market_history(spark, sf):
    return market.market_view(lake.indexed(spark, sf), 90, scope="history")


@query
def rsi_zones(spark, sf):
    f = lake.featured(spark, sf)
    zone = signals.rsi_zone(F.col("rsi_14")).alias("zone")
    side = signals.histogram_side(F.col("macd"), F.col("macd_signal")).alias("side")
    return f.groupBy("symbol", zone, side).agg(F.count(F.lit(1)).alias("rows"))


@query
def null_keys_reported(spark, sf):
    """Bars without a symbol or a date get no indicators and are not lost."""
    bars = lake.cleaned(spark, sf).withColumns({
        "symbol": F.expr("CASE WHEN symbol <> 'NATION_5' OR day(date) <> 17 THEN symbol END"),
        "date": F.expr("CASE WHEN symbol <> 'NATION_3' OR day(date) <> 13 THEN date END")})
    return indicators.add_indicators(bars).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("symbol").isNull()).alias("null_symbols"),
        F.count_if(F.col("date").isNull()).alias("null_dates"), F.count("return_1d").alias("returns"))


@query
def lookback_sequences(spark, sf):
    """Sequences reduced to a checksum: every value times its place."""
    s = backtest.lookback_sequences(lake.indexed(spark, sf), ["open", "close"], "close")
    total = F.aggregate(
        F.flatten(F.transform("sequence", lambda x, i: F.transform(x, lambda v: v * (i + 1)))),
        F.lit(0.0), lambda acc, v: acc + v,
    )
    return s.select("symbol", "date", F.size("sequence").alias("len"),
                    F.round(total, 2).alias("checksum"), F.round("label", 4).alias("label"))


@query
def minmax_scale(spark, sf):
    done = backtest.minmax_scale(lake.indexed(spark, sf), ["close", "volume"])
    back = backtest.unscale(F.col("scaled_close"), "close").alias("close_back")
    return rounded(
        done.select("symbol", "date", "part", "scaled_close", "scaled_volume", back),
        {"scaled_close": 6, "scaled_volume": 6, "close_back": 4},
    )


# -- selection and joins -------------------------------------------------------


@query
def symbol_alias(spark, sf):
    bars = lake.raw(spark, sf)
    aliases = {"NATION_0": "N0", "NATION_1": "N1"}
    tracked = ["N0", "NATION_2", "NATION_3", "NATION_7"]
    done = selection.with_resolved(bars, aliases, tracked)
    return done.groupBy("resolved", "supported").agg(F.count(F.lit(1)).alias("rows"))


@query
def symbol_lists(spark, sf):
    d = given.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    asked = F.concat(F.lit(" "), F.col("p_brand"), F.lit(",, "), F.col("p_name"), F.lit(" ,"))
    return d.select("p_partkey", F.array_join(symbol_list(asked), "|").alias("symbols"))


@query
def tail_n(spark, sf):
    kept = selection.last_rows(lake.raw(spark, sf), 20)
    return rounded(kept.select("symbol", "date", "close"), {"close": 4})


@query
def history_window(spark, sf):
    kept = selection.history(lake.raw(spark, sf), "NATION_3", 180, AS_OF)
    return rounded(kept.select("symbol", "date", "close"), {"close": 4})


@query
def min_history_gate(spark, sf):
    return selection.history_gate(lake.cleaned(spark, sf), 900)


@query
def left_join_prices_indicators(spark, sf):
    ind = lake.featured(spark, sf).select("symbol", "date", *ALL_PLACES)
    prices = lake.raw(spark, sf).select("symbol", "date", *OHLC, "volume")
    done = market.prices_with_indicators(prices, ind)
    places = {c: n for c, n in ALL_PLACES.items() if c in market.JOINED_INDICATORS}
    return rounded(done, {**OHLC, **places})


@query
def read_prices(spark, sf):
    ind = lake.featured(spark, sf).select("symbol", "date", *ALL_PLACES)
    prices = lake.raw(spark, sf).select("symbol", "date", *OHLC, "volume")
    done = market.read_prices(prices, ind, "NATION_3", AS_OF, 365)
    places = {c: n for c, n in ALL_PLACES.items() if c in market.JOINED_INDICATORS}
    return rounded(done, {**OHLC, **places})


@query
def union_frames(spark, sf):
    f = lake.by_status(spark, sf, "F").select("symbol", "date", "close", "volume")
    o = lake.by_status(spark, sf, "O").select("symbol", "date", "close")
    both = selection.union_frames(f, o)
    return rounded(both, {"close": 4})


@query
def ingest_totals(spark, sf):
    return selection.ingest_totals(lake.raw(spark, sf))


# -- merges and snapshots ------------------------------------------------------


@query
def upsert_prices(spark, sf):
    columns = ["symbol", "date", *OHLC, "adjusted_close", "volume"]
    target = lake.by_status(spark, sf, "F").select(*columns)
    source = lake.by_status(spark, sf, "O").select(*columns)
    return rounded(merge.upsert_prices(target, source), {**OHLC, "adjusted_close": 4})


def _banded(spark, sf, status):
    bars = series.index_series(lake.by_status(spark, sf, status), neighbours=["close"])
    names = ("bb_upper", "bb_lower", "return_1d")
    return indicators.rolling(bars, *names).select("symbol", "date", *names)


@query
def upsert_indicators(spark, sf):
    """The source lacks the lower band, so stored values of it stay."""
    target = _banded(spark, sf, "F")
    source = _banded(spark, sf, "O").drop("bb_lower")
    done = merge.upsert_indicators(target, source)
    return rounded(done, {"bb_upper": 4, "bb_lower": 4, "return_1d": 6})


def _records(spark, sf, status):
    bars = lake.by_status(spark, sf, status)
    return bars.select(
        "symbol",
        signals.next_day(F.col("date")).alias("prediction_date"),
        F.col("close").alias("predicted_price"),
        F.col("low").alias("confidence_lower"),
        F.col("high").alias("confidence_upper"),
        (F.col("low") / F.col("high")).alias("confidence_score"),
        F.lit("v1").alias("model_version"),
        F.col("open").alias("sentiment_score"),
        F.lit(status).alias("sentiment_label"),
    )


@query
def upsert_predictions(spark, sf):
    done = merge.upsert_predictions(_records(spark, sf, "F"), _records(spark, sf, "O"))
    return rounded(done, {"predicted_price": 4, "confidence_lower": 4, "confidence_upper": 4,
                          "confidence_score": 4, "sentiment_score": 4})


@query
def upsert_sentiment(spark, sf):
    """Twenty days of daily sentiment, then twenty by another lexicon merged in: ten are in both."""
    rows = given.headlines(spark, sf)
    target = sentiment.daily_sentiment(rows.where("date <= '2024-01-20'"), text.lexicon(POS, NEG))
    source = sentiment.daily_sentiment(rows.where("date >= '2024-01-11'"), text.lexicon(NEG, POS))
    done = merge.upsert_sentiment(target, source.drop("sentiment_negative"))
    return rounded(done, {f"sentiment_{n}": 6 for n in ("compound", "positive", "negative")})


@query
def run_log(spark, sf):
    """A load that passes its gate, and one that a repeated key stops."""
    tables = Warehouse(spark, _run_dir(spark, "warehouse"))
    good = lake.cleaned(spark, sf)
    for run, df in (("r1", good), ("r2", good.unionByName(good))):
        path = _run_dir(spark, "processed")
        df.write.parquet(path)
        try:
            jobs.load_warehouse(spark, path, tables, run)
        except jobs.ValidationFailed:
            pass
    log = tables.runs().select("dag_id", "run_id", "status", "rows_processed", "error_message")
    return log.crossJoin(tables.read("stock_prices").agg(F.count(F.lit(1)).alias("stored")))


@query
def latest_with_ttl(spark, sf):
    t = given.ticks(spark, sf).withColumn("user", F.concat_ws(":", F.lit("price"), "symbol"))
    snap = merge.snapshot(t, F.col("user"), "timestamp", ["price"], merge.TTL["price"], ["event_id"])
    return merge.live(snap, F.lit(TICK_AS_OF).cast("timestamp_ntz"))


# -- backtests and evaluation --------------------------------------------------


def _targets(spark, sf):
    return backtest.with_target(lake.indexed(spark, sf))


@query
def naive_backtest(spark, sf):
    return backtest.backtest_metrics(forecast.naive(_targets(spark, sf)))


@query
def drift_backtest(spark, sf):
    return backtest.backtest_metrics(forecast.drift(_targets(spark, sf)))


@query
def backtest_flags(spark, sf):
    m = backtest.backtest_metrics(forecast.drift(_targets(spark, sf)))
    return backtest.backtest_flags(m).select("symbol", "accuracy_ok", "sharpe_ok", "equity_ok")


@query
def equity_curve(spark, sf):
    done = backtest.equity_curve(forecast.drift(_targets(spark, sf)))
    return rounded(done.select("symbol", "date", "strategy_return", "equity"),
                   {"strategy_return": 6, "equity": 4})


@query
def chart_downsample(spark, sf):
    return backtest.backtest_chart(forecast.drift(_targets(spark, sf)))


def _pairs(spark, sf):
    p = forecast.drift(_targets(spark, sf))
    return p.select("symbol", "date", F.col("target").alias("actual"), F.col("pred").alias("predicted"))


@query
def eval_metrics(spark, sf):
    return backtest.evaluate(_pairs(spark, sf))


@query
def dir_acc_diff(spark, sf):
    rows = backtest.evaluation_rows(_pairs(spark, sf))
    rate = backtest.hit_rate_where(F.col("same_way"), F.col("pos") > 0)
    return rows.groupBy("symbol").agg(F.round(rate, 4).alias("directional_acc_pct"))


@query
def max_drawdown(spark, sf):
    return rounded(backtest.drawdown(backtest.evaluation_rows(_pairs(spark, sf))),
                   {"max_drawdown_pct": 4})


@query
def sharpe_pop(spark, sf):
    r = backtest.strategy_returns(forecast.drift(_targets(spark, sf)))
    return r.groupBy("symbol").agg(
        F.round(backtest.sharpe_population(F.col("strategy_return")), 4).alias("sharpe")
    )


@query
def sharpe_sample(spark, sf):
    r = backtest.strategy_returns(forecast.drift(_targets(spark, sf)))
    return r.groupBy("symbol").agg(
        F.round(backtest.sharpe_sample(F.col("strategy_return")), 4).alias("sharpe")
    )


@query
def retrain_summary(spark, sf):
    m = backtest.backtest_metrics(forecast.drift(_targets(spark, sf)))
    return rounded(backtest.retrain_summary(m), {"avg_sharpe": 4, "avg_accuracy": 3})


# -- portfolio -----------------------------------------------------------------


def _aligned(spark, sf):
    return portfolio.align_positions(lake.indexed(spark, sf), PORTFOLIO_DAYS)


def _returns(spark, sf):
    return lake.aligned_returns(spark, sf, PORTFOLIO_DAYS)


@query
def align_positions(spark, sf):
    return rounded(_aligned(spark, sf).select("symbol", "date", "rn", "close"), {"close": 4})


@query
def short_assets_reported(spark, sf):
    """A new listing and an asset with a zero price are reported, and the others used."""
    bars = lake.cleaned(spark, sf).where("symbol <> 'NATION_7' OR date >= DATE '1998-11-20'")
    zero = F.expr("symbol = 'NATION_3' AND date = max(date) OVER (PARTITION BY symbol)")
    bars = bars.withColumn("close", F.when(zero, F.lit(0.0)).otherwise(F.col("close")))
    bars = series.index_series(bars, neighbours=["close"])
    used = portfolio.align_positions(bars, PORTFOLIO_DAYS).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.lit("used").alias("reason"))
    return portfolio.unusable_assets(bars, PORTFOLIO_DAYS).unionByName(used)


@query
def ann_mean_cov(spark, sf):
    r = _returns(spark, sf)
    mean = portfolio.annual_mean(r).withColumnRenamed("symbol", "asset_i")
    return portfolio.annual_covariance(r).join(mean, "asset_i").select(
        "asset_i", "asset_j", F.round("cov", 6).alias("cov"), F.round("ann_mean", 6).alias("ann_mean")
    )


@query
def asset_sharpe(spark, sf):
    return rounded(portfolio.single_asset_sharpe(_returns(spark, sf)), {"sharpe": 6})


@query
def mc_weights(spark, sf):
    w = portfolio.random_weights(_returns(spark, sf))
    return w.select("portfolio", "asset", F.round("w", 8).alias("w"))


@query
def equal_weight_sharpe(spark, sf):
    r = _returns(spark, sf)
    done = portfolio.weighted_sharpe(r, portfolio.equal_weights(r))
    return rounded(done, {"sharpe": 6})


@query
def mc_portfolios(spark, sf):
    r = _returns(spark, sf)
    m = portfolio.draw_moments(r)
    return rounded(m, {"ret": 6, "vol": 6, "sharpe": 6})


@query
def best_portfolio(spark, sf):
    r = _returns(spark, sf)
    m = portfolio.draw_moments(r)
    return rounded(portfolio.best_portfolio(m), {"ret": 6, "vol": 6, "sharpe": 6})


def _as_text(record):
    shares = F.transform("weights", lambda w: F.format_string("%.4f", w))
    return record.withColumns(
        {"symbols": F.array_join("symbols", ","), "weights": F.array_join(shares, ",")}
    )


@query
def portfolio_record(spark, sf):
    made = records.portfolio_record(_returns(spark, sf))
    return _as_text(made.withColumn("frontier", _points("frontier", "ret", "vol")))


@query
def portfolio_horizons(spark, sf):
    return _as_text(portfolio.optimize_horizons(lake.indexed(spark, sf)))


@query
def frontier(spark, sf):
    return portfolio.frontier(_returns(spark, sf))


@query
def frontier_csv(spark, sf):
    r = _returns(spark, sf)
    table = portfolio.frontier_export(portfolio.frontier(r), portfolio.optimize(r))
    path = _run_dir(spark, "frontier")
    lake_sink.write_csv(table, path)
    return spark.read.option("header", True).schema(
        "type string, volatility_pct double, return_pct double, sharpe double"
    ).csv(path)


# -- sentiment -----------------------------------------------------------------


@query
def headline_dedupe(spark, sf):
    h = given.headlines(spark, sf)
    kept = sentiment.dedupe_headlines(h, ["date", "doc_id"])
    return kept.select("symbol", "date", "url", F.length("headline").cast("bigint").alias("chars"))


@query
def feed_entries(spark, sf):
    d = given.headlines(spark, sf)
    entries = d.select(
        "symbol", F.lit("feed").alias("feed_url"), F.lit(None).cast("string").alias("feed_title"),
        F.col("url").alias("title"), F.col("headline").alias("summary"), F.col("url").alias("link"),
        F.col("date").cast("timestamp_ntz").alias("published"),
    )
    done = payloads.parse_entries(entries, F.lit("2024-01-30").cast("timestamp_ntz"), 7)
    return done.select("symbol", "date", "headline", "summary", "url", "source")


SCORES = ["sentiment_positive", "sentiment_negative", "sentiment_neutral", "sentiment_compound"]


@query
def lexicon_score(spark, sf):
    s = sentiment.score_headlines(given.headlines(spark, sf), text.lexicon(POS, NEG))
    return rounded(s.select("doc_id", "symbol", *SCORES), {c: 4 for c in SCORES})


@query
def lexicon_default(spark, sf):
    """The two real word lists."""
    h = given.headlines(spark, sf)
    s = sentiment.score_headlines(h).withColumn("long_compound", text.compound()(F.col("headline")))
    return rounded(s.select("doc_id", *SCORES, "long_compound"),
                   {c: 4 for c in [*SCORES, "long_compound"]})


def _daily(spark, sf):
    return sentiment.daily_sentiment(given.headlines(spark, sf), text.lexicon(POS, NEG))


@query
def scorer_plug(spark, sf):
    """A scorer that a user brings: an Arrow UDF over batches of texts in place of the lexicon."""
    def score(texts: pd.Series) -> pd.DataFrame:
        good, bad = texts.str.count("e"), texts.str.count("a")
        total = (good + bad).clip(lower=1)
        return pd.DataFrame({"positive": good / total, "negative": bad / total, "neutral": 0.0, "compound": (good - bad) / total})

    done = sentiment.daily_sentiment(given.headlines(spark, sf), text.batch_scorer(score))
    return rounded(done, {c: 6 for c in SCORES if c != "sentiment_neutral"})


@query
def sentiment_daily(spark, sf):
    return rounded(_daily(spark, sf), {c: 6 for c in SCORES if c != "sentiment_neutral"})


@query
def latest_sentiment(spark, sf):
    return rounded(sentiment.latest_sentiment(_daily(spark, sf)), {"sentiment_compound": 6})


def _articles(spark, sf):
    h = given.headlines(spark, sf)
    return h.select("symbol", "doc_id", F.col("headline").alias("title"))


def _per_symbol(spark, sf):
    scored = sentiment.score_articles(_articles(spark, sf), text.compound(POS, NEG))
    nations = given.table(spark, sf, "nation").select(F.col("n_name").alias("symbol"))
    asked = scored.select("symbol").union(nations)
    return sentiment.symbol_sentiment(scored, asked)


@query
def article_scores(spark, sf):
    scored = sentiment.score_articles(_articles(spark, sf), text.compound(POS, NEG))
    return scored.select("doc_id", "sentiment_score", "sentiment_label")


@query
def sentiment_symbol(spark, sf):
    return _per_symbol(spark, sf)


@query
def sentiment_counts(spark, sf):
    return sentiment.sentiment_counts(_per_symbol(spark, sf))


@query
def top15_articles(spark, sf):
    """News items in both shapes: English ones nested, the others flat."""
    d = given.headlines(spark, sf).join(
        given.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id"
    )
    nested = F.struct(
        F.struct(
            F.col("headline").alias("title"),
            F.struct(F.col("symbol").alias("displayName")).alias("provider"),
            F.struct("url").alias("canonicalUrl"),
            F.col("date").cast("string").alias("pubDate"),
        ).alias("content")
    )
    flat = F.struct(
        F.when(F.col("lang") != "de", F.col("headline")).otherwise(F.lit("")).alias("title"),
        F.col("symbol").alias("publisher"), F.col("url").alias("link"),
        F.col("date").cast("string").alias("providerPublishTime"),
    )
    item = F.when(F.col("lang") == "en", F.to_json(nested)).otherwise(F.to_json(flat))
    return payloads.parse_news(d.select("symbol", F.col("doc_id").alias("seq"), item.alias("item")),
                               payloads.NEWS_ITEMS)


@query
def feature_sentiment(spark, sf):
    """Daily sentiment next to bars of a symbol with the same number."""
    day = F.date_add(F.lit("1996-01-01").cast("date"), F.datediff("date", F.lit("2024-01-01")))
    daily = _daily(spark, sf).withColumns(
        {"symbol": F.regexp_replace("symbol", "^src", "NATION_"), "date": day}
    )
    done = sentiment.join_sentiment(lake.indexed(spark, sf).select("symbol", "date", "close"), daily)
    return rounded(done, {"close": 4, "sentiment_score": 6})


# -- forecasts -----------------------------------------------------------------


@query
def confidence_band(spark, sf):
    last = market.last_volatility(lake.indexed(spark, sf))
    pred = F.col("current_price") * 1.01
    band = signals.confidence(pred, F.col("current_price"), F.col("std"))
    return last.withColumns(band).select("symbol", *band)


@query
def blend(spark, sf):
    """Two scaled predictions blended, then taken back to prices."""
    s = backtest.minmax_scale(lake.indexed(spark, sf), ["close", "open"])
    mixed = signals.blend(F.col("scaled_close"), F.col("scaled_open"))
    return s.select("symbol", "date", F.round(backtest.unscale(mixed, "close"), 4).alias("price"))


@query
def forecast_signal(spark, sf):
    last = series.tail(lake.indexed(spark, sf), 1)
    cols = signals.forecast_signal(F.col("open"), F.col("close"))
    return rounded(last.withColumns(cols).select("symbol", "date", *cols),
                   {"change": 4, "change_pct": 4})


@query
def gbt_forecast(spark, sf):
    return forecast.forecast(lake.matrix(spark, sf), lake.trees(spark, sf), AS_OF)


@query
def gbt_backtest(spark, sf):
    return backtest.backtest_metrics(forecast.backtest_predictions(lake.matrix(spark, sf), lake.trees(spark, sf)))


def _judged(spark, sf):
    """A store with three judged rules; only the first passes whatever its ratio is."""
    store, day = ModelStore(spark, _run_dir(spark, "models")), dt.datetime(1998, 12, 1)
    matrix = lake.matrix(spark, sf)
    for k, (name, gate) in enumerate((("naive", -1e9), ("drift", 0.8), ("reversal", 0.8))):
        store.save(name, forecast.rule(name))
        tested = backtest.backtest_metrics(forecast.backtest_predictions(matrix, store.load(name)))
        store.decide(name, backtest.retrain_summary(tested, gate), day + dt.timedelta(days=k))
    return store


@query
def model_decisions(spark, sf):
    done = _judged(spark, sf).decisions()
    return rounded(done.select("model_version", "avg_sharpe", "avg_accuracy", "symbols", "best_symbol", "promoted"),
                   {"avg_sharpe": 4, "avg_accuracy": 3})


@query
def batch_scoring(spark, sf):
    """Every symbol scored by the promoted version and merged into the table of predictions."""
    tables = Warehouse(spark, _run_dir(spark, "warehouse"))
    jobs.score_symbols(lake.cleaned(spark, sf), tables, _judged(spark, sf), AS_OF)
    done = tables.read("predictions").drop("created_at")
    return done.withColumns({c: F.col(c).cast("double") for c, t in done.dtypes if "decimal" in t})


@query
def forecast_record(spark, sf):
    """The record as readers get it from the table of values that expire."""
    made = forecast.forecast(lake.matrix(spark, sf), forecast.rule("reversal"), AS_OF, "reversal")
    values = records.as_values(made, "prediction", F.lit(AS_OF))
    schema = made.drop("model_trained_at").schema
    back = values.select("key", F.from_json("value", schema).alias("r"), plain_ntz("expires_at"))
    return back.select("key", "expires_at", "r.*")


@query
def backtest_record(spark, sf):
    made = records.backtest_record(forecast.drift(_targets(spark, sf)))
    return made.withColumn("chart", _points("chart", "date", "actual", "predicted", "equity"))


@query
def sentiment_record(spark, sf):
    """Aggregates of all articles of a symbol and the first fifteen of them."""
    rows = given.headlines(spark, sf)
    scored = sentiment.score_articles(
        rows.select("symbol", F.col("doc_id").alias("seq"), F.col("headline").alias("title"), F.lit("").alias("publisher"),
                    "url", F.col("date").cast("string").alias("published_at")), text.compound(POS, NEG))
    numbered = selection.first_rows(scored, 15, order=("seq",)).withColumn("seq", F.lit(0))
    per_symbol = sentiment.symbol_sentiment(scored, rows)
    made = records.sentiment_record(numbered, per_symbol, 15)
    shown = F.array_join(F.sort_array(F.transform("articles", lambda a: F.concat_ws(
        "|", a["url"], a["sentiment_score"].cast("decimal(18,4)").cast("string"), a["sentiment_label"]))), ";")
    return made.withColumn("articles", shown)


@query
def model_scaling(spark, sf):
    """All features of the batch model and its target, scaled by their train rows."""
    columns = [*forecast.BATCH_FEATURES, forecast.BATCH_TARGET]
    done = backtest.minmax_scale(lake.batch_rows(spark, sf), columns)
    names = [f"scaled_{c}" for c in columns]
    return rounded(done.select("symbol", "date", "part", *names), {c: 6 for c in names})


@query
def model_sequences(spark, sf):
    """Sequences of all scaled features, reduced to a checksum: every value times its place."""
    columns = [*forecast.BATCH_FEATURES, forecast.BATCH_TARGET]
    scaled = backtest.minmax_scale(lake.batch_rows(spark, sf), columns)
    s = backtest.lookback_sequences(scaled, [f"scaled_{c}" for c in forecast.BATCH_FEATURES], f"scaled_{forecast.BATCH_TARGET}")
    total = F.aggregate(
        F.flatten(F.transform("sequence", lambda x, i: F.transform(x, lambda v: v * (i + 1)))),
        F.lit(0.0), lambda acc, v: acc + v,
    )
    return s.select("symbol", "date", F.size("sequence").alias("len"), F.size(F.col("sequence")[0]).alias("features"),
                    F.round(total, 3).alias("checksum"), F.round("label", 6).alias("label"))


# -- ticks ---------------------------------------------------------------------


def _messages(events: DataFrame) -> DataFrame:
    """Tick messages as JSON; three event types leave one field out."""
    kind = F.col("event_type")
    body = F.struct(
        F.col("event_type").alias("symbol"),
        F.when(kind != "view", F.col("value") - 5).alias("price"),
        F.when(kind != "error", F.lit(1)).alias("volume"),
        F.when(kind != "signup", F.col("ts")).alias("timestamp"),
    )
    return events.select("event_id", F.to_json(body).alias("value"))


@query
def missing_fields(spark, sf):
    m = tick_ops.message_errors(_messages(given.table(spark, sf, "events")))
    return m.select("event_id", F.array_join("missing", ",").alias("missing"), "price_ok", "errors")


@query
def tick_quality(spark, sf):
    return tick_ops.quality_summary(_messages(given.table(spark, sf, "events")))


@query
def parse_ticks(spark, sf):
    t = given.ticks(spark, sf)
    body = F.struct("symbol", "price", "volume", "bid", "ask",
                    F.col("timestamp").cast("timestamp").alias("timestamp"))
    parsed = tick_ops.parse_ticks(t.select("event_id", F.to_json(body).alias("value")))
    # JSON text carries milliseconds.
    seconds = F.date_trunc("second", "timestamp").cast("timestamp_ntz")
    return parsed.select("event_id", "symbol", F.round("price", 4).alias("price"), "volume",
                         F.round("bid", 4).alias("bid"), F.round("ask", 4).alias("ask"),
                         seconds.alias("second"), "source")


@query
def tick_bars(spark, sf):
    return tick_ops.tick_bars(given.ticks(spark, sf), "1 hour", "event_id")


@query
def latest_tick(spark, sf):
    return tick_ops.latest_ticks(given.ticks(spark, sf), "event_id")


@query
def topic_backlog(spark, sf):
    e = given.table(spark, sf, "events")
    begin, end = F.min("event_id"), F.max("event_id")
    offsets = e.groupBy(F.col("event_type").alias("topic"), F.col("user_id").alias("partition")).agg(
        begin.alias("begin"), end.alias("end"),
        (begin + F.floor((end - begin) / 2)).alias("committed"),
    )
    return tick_ops.backlog(offsets)


def _event_stream(spark, sf):
    # A glob, because a stream path must name a folder or a pattern.
    path = f"{sf.rstrip('/')}/{{events}}.parquet"
    events = spark.readStream.schema(given.table(spark, sf, "events").schema).parquet(path)
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(stream, spark, name, writer=tick_ops.write_updates, **options):
    table, checkpoint = _run_dir(spark, name), _run_dir(spark, f"{name}-progress")
    writer(stream, table, checkpoint, **options).awaitTermination()
    return table


@query
def stream_tick_bars(spark, sf):
    bars = tick_ops.stream_bars(given.tick_columns(_event_stream(spark, sf)), "1 hour",
                                "10 minutes", "event_id")
    done = tick_ops.current(spark, _finish(bars, spark, "bars"), ["symbol", "window_start"])
    return plain_time(done, "window_start")


@query
def stream_batches(spark, sf):
    """The events as six files, one a micro-batch: bars grow over batches and their updates merge."""
    feed = _run_dir(spark, "feed")
    events = given.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(6, "event_id").write.parquet(feed)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(feed)
    # Files hold all days mixed, so only a watermark longer than the month loses nothing.
    bars = tick_ops.stream_bars(given.tick_columns(stream), "1 hour", "40 days", "event_id")
    keys = ["symbol", "window_start"]
    table = _finish(bars, spark, "batches", keys=keys, every=2)
    batches = spark.read.parquet(table).agg(F.max("batch").alias("last"))
    done = plain_time(tick_ops.current(spark, table, keys), "window_start")
    return done.join(batches.select((F.col("last") >= 1).alias("several")), F.lit(True))


@query
def stream_latest(spark, sf):
    latest = tick_ops.latest_ticks(given.tick_columns(_event_stream(spark, sf)), "event_id")
    done = tick_ops.current(spark, _finish(latest, spark, "latest"), ["symbol"])
    return plain_time(done, "timestamp")


@query
def stream_live_prices(spark, sf):
    """Last price of each symbol, and whether it has expired when the stream ends."""
    changes = tick_ops.live_prices(given.tick_columns(_event_stream(spark, sf)), late="10 seconds")
    table = _finish(changes, spark, "live", keys=["symbol"], every=4)
    done = tick_ops.current(spark, table, ["symbol"])
    return plain_time(done.select("symbol", "price", "timestamp", "live"), "timestamp")


@query
def stream_quality(spark, sf):
    m = _messages(_event_stream(spark, sf))
    table = _finish(m, spark, "quality", tick_ops.write_quality)
    return spark.read.parquet(table).agg(
        F.sum("checked").alias("checked"), F.sum("errors").alias("errors")
    )
