"""Chronological splits, strategy returns, equity and model metrics.

Predictions come as rows ``(symbol, date, close, target, pred)`` numbered with
``pos`` and ``n``. Neighbouring values are columns already, so every metric is
one map-side combined aggregate per symbol; only running values need blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.scalar import ratio
from barline.operators.series import (
    LENGTH, POS, index_series, over_block, running_product, with_halo,
)
from barline.session import stage

# Trading days a year and the two risk-free rates.
YEAR_DAYS = 252
RF_EVALUATION, RF_BACKTEST = 0.05, 0.02
CHART_POINTS = 60
PROMOTION_SHARPE = 0.8


def with_target(bars: DataFrame) -> DataFrame:
    """Next close as the target; the last row of each series has none."""
    kept = bars.where(F.col(POS) < F.col(LENGTH) - 1)
    return kept.withColumns({"target": F.col("next_close"), LENGTH: F.col(LENGTH) - 1})


def split_point(fraction: float) -> Column:
    return F.floor(F.col(LENGTH) * F.lit(fraction)).cast("bigint")


def chronological_split(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Mark the first ``floor(n * fraction)`` rows of each series as train."""
    part = F.when(F.col(POS) < split_point(fraction), "train").otherwise("test")
    return df.withColumn("part", part)


def test_rows(df: DataFrame, fraction: float = 0.8) -> DataFrame:
    """The test part, numbered from 0, with the train length in ``train_days``."""
    cut = split_point(fraction)
    return df.withColumn("train_days", cut).where(F.col(POS) >= F.col("train_days")).withColumns(
        {POS: F.col(POS) - F.col("train_days"), LENGTH: F.col(LENGTH) - F.col("train_days")}
    )


def strategy_returns(df: DataFrame) -> DataFrame:
    """Long when the prediction is above the close, else cash; and buy-and-hold."""
    move = ratio(F.col("target") - F.col("close"), F.col("close"))
    return df.withColumns(
        {
            "buyhold_return": move,
            "strategy_return": F.when(F.col("pred") > F.col("close"), move).otherwise(F.lit(0.0)),
        }
    )


def sharpe_sample(returns: Column, risk_free: float = RF_BACKTEST) -> Column:
    """Yearly Sharpe ratio with the sample deviation; 0 for a flat series."""
    std = F.stddev_samp(returns)
    mean = F.avg(returns) - F.lit(risk_free / YEAR_DAYS)
    return F.when(std > 1e-10, mean / std * F.sqrt(F.lit(float(YEAR_DAYS)))).otherwise(F.lit(0.0))


def sharpe_population(returns: Column, risk_free: float = RF_EVALUATION) -> Column:
    """Yearly Sharpe ratio with the population deviation; 0 for a flat series."""
    std = F.stddev_pop(returns)
    mean = F.avg(returns) - F.lit(risk_free / YEAR_DAYS)
    return F.when(std == 0, F.lit(0.0)).otherwise(
        F.sqrt(F.lit(float(YEAR_DAYS))) * try_div(mean, std)
    )


def try_div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def mean_abs(a: Column, b: Column) -> Column:
    return F.avg(F.abs(a - b))


def hit_rate(hit: Column) -> Column:
    return F.avg(F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0))) * 100


def side_of_close() -> Column:
    """Prediction and outcome lie on the same side of the close."""
    return F.signum(F.col("target") - F.col("close")) == F.signum(F.col("pred") - F.col("close"))


def backtest_metrics(predictions: DataFrame, fraction: float = 0.8) -> DataFrame:
    """One record per symbol over the test part of its series."""
    rows = strategy_returns(test_rows(predictions, fraction))
    mae = mean_abs(F.col("pred"), F.col("target"))
    naive = mean_abs(F.col("close"), F.col("target"))
    return rows.groupBy("symbol").agg(
        F.max("train_days").alias("train_days"),
        F.count(F.lit(1)).alias("test_days"),
        F.round(mae, 4).alias("mae"),
        F.round(naive, 4).alias("naive_mae"),
        F.round(try_div(naive - mae, naive) * 100, 2).alias("mae_vs_naive_pct"),
        F.round(hit_rate(side_of_close()), 2).alias("directional_accuracy"),
        F.round(sharpe_sample(F.col("strategy_return")), 3).alias("strategy_sharpe"),
        F.round(sharpe_sample(F.col("buyhold_return")), 3).alias("buyhold_sharpe"),
        F.round(F.product(1 + F.col("strategy_return")), 4).alias("final_equity"),
    )


def backtest_flags(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns(
        {
            "accuracy_ok": F.col("directional_accuracy") > 55,
            "sharpe_ok": F.col("strategy_sharpe") > 0.5,
            "equity_ok": F.col("final_equity") > 1,
        }
    )


def equity_curve(predictions: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Equity before and after each test row; it starts at 1."""
    rows = strategy_returns(test_rows(predictions, fraction))
    grown = rows.withColumn("_f", 1 + F.col("strategy_return"))
    return running_product(grown, "_f", "equity_after", before="equity").drop("_f")


def downsample(df: DataFrame, points: int = CHART_POINTS) -> DataFrame:
    """Every ``max(1, n div points)``-th row from the first."""
    step = F.greatest(F.floor(F.col(LENGTH) / points), F.lit(1))
    return df.where(F.col(POS) % step == 0)


def backtest_chart(predictions: DataFrame, fraction: float = 0.8) -> DataFrame:
    return downsample(equity_curve(predictions, fraction)).select(
        "symbol",
        "date",
        F.round("target", 4).alias("actual"),
        F.round("pred", 4).alias("predicted"),
        F.round("equity", 4).alias("equity"),
    )


# -- evaluation of (actual, predicted) series ----------------------------------


def evaluation_rows(df: DataFrame) -> DataFrame:
    """Number ``(symbol, date, actual, predicted)`` rows and add the long or
    short strategy return, NULL on the first row."""
    rows = index_series(df, neighbours=["actual", "predicted"])
    d_actual = F.col("actual") - F.col("prev_actual")
    d_pred = F.col("predicted") - F.col("prev_predicted")
    return rows.withColumns(
        {
            "same_way": F.signum(d_actual) == F.signum(d_pred),
            "strategy_return": ratio(d_actual, F.col("prev_actual")) * F.signum(d_pred),
        }
    )


def drawdown(rows: DataFrame) -> DataFrame:
    """Largest fall in percent from the running peak of the compounded
    strategy; the first peak is the first compounded value."""
    steps = rows.where(F.col(POS) > 0).select(
        "symbol",
        (F.col(POS) - 1).alias(POS),
        (F.col(LENGTH) - 1).alias(LENGTH),
        (1 + F.col("strategy_return")).alias("_f"),
    )
    curve = running_product(steps, "_f", "value", peak="peak")
    fall = ratio(F.col("value") - F.col("peak"), F.col("peak"))
    return curve.groupBy("symbol").agg((F.min(fall) * 100).alias("max_drawdown_pct"))


def error_metrics(rows: DataFrame) -> DataFrame:
    a, p = F.col("actual"), F.col("predicted")
    square = (a - p) * (a - p)
    moved = F.col(POS) > 0
    return rows.groupBy("symbol").agg(
        F.avg(F.abs(a - p)).alias("mae"),
        F.sqrt(F.avg(square)).alias("rmse"),
        # 1 - residual / total: both are per-row means, so counts cancel.
        (1 - try_div(F.avg(square), F.var_pop(a))).alias("r2"),
        (F.avg(F.abs(ratio(a - p, a))) * 100).alias("mape_pct"),
        hit_rate_where(F.col("same_way"), moved).alias("directional_acc_pct"),
        sharpe_population(F.when(moved, F.col("strategy_return"))).alias("sharpe_ratio"),
    )


def hit_rate_where(hit: Column, where: Column) -> Column:
    return F.avg(F.when(where, F.when(hit, F.lit(1.0)).otherwise(F.lit(0.0)))) * 100


def evaluate(df: DataFrame) -> DataFrame:
    """The evaluation record per symbol, rounded. The numbered rows feed the
    errors and, twice, the drawdown, so they are staged."""
    rows = stage(evaluation_rows(df), "evaluation")
    return error_metrics(rows).join(drawdown(rows), "symbol", "left").select(
        "symbol",
        *[F.round(c, 4).alias(c) for c in ("mae", "rmse", "r2")],
        *[F.round(c, 2).alias(c) for c in ("mape_pct", "directional_acc_pct")],
        F.round("sharpe_ratio", 4).alias("sharpe_ratio"),
        F.round("max_drawdown_pct", 2).alias("max_drawdown_pct"),
    )


def retrain_summary(metrics: DataFrame, gate: float = PROMOTION_SHARPE) -> DataFrame:
    """Means over symbols that have a Sharpe ratio, the best symbol (first name
    on ties) and whether the mean clears the promotion threshold."""
    valid = metrics.where(F.col("strategy_sharpe").isNotNull())
    best = F.min_by("symbol", F.struct((-F.col("strategy_sharpe")).alias("s"), "symbol"))
    return valid.agg(
        F.avg("strategy_sharpe").alias("avg_sharpe"),
        F.avg("directional_accuracy").alias("avg_accuracy"),
        F.count(F.lit(1)).alias("symbols"),
        best.alias("best_symbol"),
        (F.avg("strategy_sharpe") >= gate).alias("promoted"),
    )


# -- model inputs --------------------------------------------------------------


def lookback_sequences(df: DataFrame, columns: list[str], target: str, rows: int = 60) -> DataFrame:
    """For each row with ``rows`` rows before it: those rows' features in order,
    and the row's own target."""
    before = over_block(f"ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING")
    step = f"collect_list(array({', '.join(columns)})) {before}"
    framed = with_halo(df, rows).withColumn("sequence", F.expr(step))
    kept = framed.where(F.col("own") & (F.col(POS) >= rows))
    return kept.select("symbol", "date", "sequence", F.col(target).alias("label"))


def minmax_scale(df: DataFrame, columns: list[str], fraction: float = 0.85) -> DataFrame:
    """Scale each column to [0, 1] by the range of its train rows; a constant
    column is only shifted. ``min_c`` and ``range_c`` stay for the inverse."""
    parts = chronological_split(df, fraction)
    train = parts.where(F.col("part") == "train")
    low = [F.min(c).alias(f"min_{c}") for c in columns]
    span = [(F.max(c) - F.min(c)).alias(f"range_{c}") for c in columns]
    fitted = train.groupBy("symbol").agg(*low, *span)
    # One row per symbol: Spark broadcasts it while it is small and otherwise
    # splits a hot symbol in the adaptive sort-merge join.
    joined = parts.join(fitted, "symbol")
    scaled = {}
    for c in columns:
        width = F.when(F.col(f"range_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"range_{c}"))
        scaled[f"scaled_{c}"] = (F.col(c) - F.col(f"min_{c}")) / width
    return joined.withColumns(scaled)


def unscale(value: Column, column: str) -> Column:
    width = F.col(f"range_{column}")
    return value * F.when(width == 0, F.lit(1.0)).otherwise(width) + F.col(f"min_{column}")
