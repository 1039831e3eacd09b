"""Feature tables, forecasts by any predictor, and their records.

A predictor is a fitted pipeline that adds ``pred``, the next close, to indexed rows:
boosted trees with their features, or a rule. Pipelines of Spark's own stages are saved and
loaded whole (``sinks/models.py``), so that what scores is what was judged.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.functions.scalar import ratio
from barline.functions.signals import confidence, next_day
from barline.operators.backtest import split_point
from barline.operators.indicators import features
from barline.operators.market import last_volatility
from barline.operators.selection import MIN_ROWS
from barline.operators.series import LENGTH, POS, index_series
from barline.session import stage

# The features of the live and of the batch model.
LIVE_FEATURES = [
    "open", "high", "low", "volume", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_lower",
    "bb_width", "atr_14", "return_1d", "return_5d", "sma_10", "sma_20", "vol_ratio",
]
BATCH_FEATURES = [
    "open", "high", "low", "volume", "vwap", "rsi_14", "macd", "macd_signal", "bb_upper",
    "bb_lower", "atr_14", "return_1d", "return_5d", "day_of_week",
]
BATCH_TARGET = "adjusted_close"
# Rows a series needs before the slowest indicator (the signal mean) exists.
WARM_UP = 33

# Fit settings.
TREES, DEPTH, RATE, SAMPLE, COLUMN_SAMPLE, SEED = 200, 4, 0.05, 0.8, "0.8", 42

_PRICE_LIKE = ["open", "high", "low", "bb_upper", "bb_lower", "sma_10", "sma_20"]
_PRICE_SIZED = ["macd", "macd_signal", "atr_14"]
_FREE = ["rsi_14", "bb_width", "return_1d", "return_5d", "vol_ratio"]

#: Predictors that need no fit: no change; the last change once more; the last change undone.
RULES = {
    "naive": "close",
    "drift": "close + coalesce(close - prev_close, 0.0)",
    "reversal": "close - coalesce(close - prev_close, 0.0)",
}


def feature_matrix(bars: DataFrame) -> DataFrame:
    """Rows whose sixteen features are all present (neither NULL nor NaN), numbered
    anew from 0 with the closes beside them. Any row may be incomplete, not only
    the warm-up, so the kept rows are staged and counted."""
    kept = features(bars).where(F.col(POS) >= WARM_UP).dropna(subset=LIVE_FEATURES)
    kept = stage(kept.drop(POS, LENGTH, "prev_close", "next_close"), "complete")
    return index_series(kept, neighbours=["close"])


def batch_features(processed: DataFrame) -> DataFrame:
    """Features and target of the batch model from derived bars, complete rows only."""
    return processed.select("symbol", "date", *BATCH_FEATURES, BATCH_TARGET).dropna(
        subset=[*BATCH_FEATURES, BATCH_TARGET]
    )


def _scale_free() -> SQLTransformer:
    """Scale-free features, so that one model serves symbols of any price."""
    cols = [f"try_divide({c}, close) - 1 AS x_{c}" for c in _PRICE_LIKE]
    cols += [f"try_divide({c}, close) AS x_{c}" for c in _PRICE_SIZED]
    cols += [f"CAST({c} AS DOUBLE) AS x_{c}" for c in _FREE]
    return SQLTransformer(statement=f"SELECT *, {', '.join(cols)} FROM __THIS__")


def _train_rows(matrix: DataFrame, fraction: float) -> DataFrame:
    rows = matrix.where(F.col(POS) < F.col(LENGTH) - 1).withColumns(
        {LENGTH: F.col(LENGTH) - 1, "y": ratio(F.col("next_close"), F.col("close")) - 1}
    )
    return rows.where(F.col(POS) < split_point(fraction)).where("y IS NOT NULL")


def fit(matrix: DataFrame, fraction: float = 0.8, trees: int = TREES) -> PipelineModel:
    """Fit the next return on the train part of every series.

    One distributed fit over all symbols; the split is chronological within
    each. Spark's trees differ from other libraries' in number, not in use.
    """
    names = [f"x_{c}" for c in _PRICE_LIKE + _PRICE_SIZED + _FREE]
    learner = GBTRegressor(
        featuresCol="x", labelCol="y", predictionCol="yhat", maxIter=trees, maxDepth=DEPTH,
        stepSize=RATE, subsamplingRate=SAMPLE, featureSubsetStrategy=COLUMN_SAMPLE, seed=SEED,
    )
    prepared = PipelineModel([
        _scale_free(), VectorAssembler(inputCols=names, outputCol="x", handleInvalid="skip"),
        SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(names)}) FROM __THIS__")])
    # Every tree passes over the rows several times; a lost executor's part is read again.
    rows = prepared.transform(_train_rows(matrix, fraction)).select("x", "y").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trained = learner.fit(rows)
    finally:
        rows.unpersist()
    price = SQLTransformer(statement="SELECT * EXCEPT (x, yhat), close * (1 + yhat) AS pred FROM __THIS__")
    return PipelineModel([*prepared.stages, trained, price])


def rule(name: str) -> PipelineModel:
    """A predictor without a fit: one of ``RULES``."""
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {RULES[name]} AS pred FROM __THIS__")])


def predict(matrix: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``pred``, the predicted next close."""
    return model.transform(matrix)


def forecast(matrix: DataFrame, model: PipelineModel, as_of: str,
             version: str = "gbt-live-v1", need: int = MIN_ROWS["live_fit"],
             as_reference: bool = False) -> DataFrame:
    """One prediction record per symbol from its newest bar.

    ``as_reference`` predicts from the bar before it, whose outcome is already
    known, as a target-complete training table would. Symbols with fewer than
    ``need`` usable rows have no record; see ``skipped``.
    """
    back = 2 if as_reference else 1
    chosen = matrix.where((F.col(LENGTH) - 1 >= need) & (F.col(POS) == F.col(LENGTH) - back))
    preds = predict(chosen, model).select("symbol", "pred")
    day = F.lit(as_of).cast("date")
    joined = preds.join(last_volatility(matrix), "symbol")
    band = confidence(F.col("pred"), F.col("current_price"), F.col("std"))
    return joined.withColumns(band).select(
        "symbol",
        F.round("current_price", 4).alias("current_price"),
        F.round("pred", 4).alias("predicted_price"),
        *band,
        next_day(day).alias("prediction_date"),
        F.lit(version).alias("model_version"),
        F.lit(None).cast("double").alias("sentiment_score"),
        F.lit("Neutral").alias("sentiment_label"),
        day.alias("model_trained_at"),
    )


def skipped(symbols: DataFrame, records: DataFrame) -> DataFrame:
    """Requested symbols without a record."""
    return symbols.select("symbol").distinct().join(records, "symbol", "left_anti")


def backtest_predictions(matrix: DataFrame, model: PipelineModel) -> DataFrame:
    """``(symbol, date, close, target, pred)`` rows for ``backtest_metrics``: the outcome is
    known for all rows but the last of a series."""
    rows = matrix.where(F.col(POS) < F.col(LENGTH) - 1).withColumns(
        {LENGTH: F.col(LENGTH) - 1, "target": F.col("next_close")}
    )
    return predict(rows, model).select("symbol", "date", "close", "target", "pred", POS, LENGTH)


def naive(bars: DataFrame) -> DataFrame:
    """Predict no change."""
    return predict(bars, rule("naive"))


def drift(bars: DataFrame) -> DataFrame:
    """Predict that the last change repeats."""
    return predict(bars, rule("drift"))
