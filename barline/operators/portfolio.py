"""Positional alignment, yearly moments and maximum-Sharpe portfolios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.scalar import ratio
from barline.operators import blocks
from barline.operators.backtest import YEAR_DAYS
from barline.operators.series import LENGTH, POS
from barline.session import stage

# Sampling defaults, horizons offered and their bounds.
RISK_FREE, DRAWS, SEED, FRONTIER_POINTS = 0.02, 10_000, 42, 500
HORIZONS, MIN_DAYS, MAX_DAYS = (60, 126, 252, 504), 60, 504


def log_returns(bars: DataFrame) -> DataFrame:
    """Log return per row; series shorter than two rows have none."""
    r = F.ln(ratio(F.col("close"), F.col("prev_close")))
    return bars.where(F.col(POS) > 0).withColumn("r", r)


def _usable(need: int) -> Column:
    """Per asset: enough prices, and a positive one in each of its rows."""
    priced = F.coalesce(F.min((F.col("close") > 0) & (F.col("close") < F.lit(float("inf")))), F.lit(False))
    return (F.max(LENGTH) >= need) & priced & (F.count("close") == F.count(F.lit(1)))


def _newest(bars: DataFrame, days: int, symbols: Sequence[str] | None) -> DataFrame:
    if not MIN_DAYS <= days <= MAX_DAYS:
        raise ValueError(f"days must be in {MIN_DAYS}..{MAX_DAYS}")
    basket = bars if symbols is None else bars.where(F.col("symbol").isin(list(symbols)))
    return basket.where(F.col(LENGTH) - F.col(POS) <= days)


def unusable_assets(bars: DataFrame, days: int = 252, symbols: Sequence[str] | None = None,
                    need: int = MIN_DAYS) -> DataFrame:
    """Assets that ``align_positions`` leaves out: ``(symbol, rows, reason)``."""
    short = F.col("rows") < need
    return _newest(bars, days, symbols).groupBy("symbol").agg(
        F.max(LENGTH).alias("rows"), _usable(need).alias("_ok")
    ).where(~F.col("_ok")).select(
        "symbol", "rows", F.when(short, "short").otherwise("price").alias("reason")
    )


def align_positions(bars: DataFrame, days: int = 252, symbols: Sequence[str] | None = None,
                    need: int = MIN_DAYS) -> DataFrame:
    """Keep the last ``days`` prices of each asset of the basket (all, if none is
    named), cut all to the shortest, and pair them by position from the end.
    ``rn`` counts from 0 on. Assets with fewer than ``need`` prices, or without a
    positive price in each row, are left out; ``unusable_assets`` reports them."""
    bars = _newest(bars, days, symbols)
    usable = bars.groupBy("symbol").agg(_usable(need).alias("_ok")).where("_ok").select("symbol")
    bars = bars.join(usable, "symbol", "left_semi")
    shortest = bars.agg(F.least(F.min(LENGTH), F.lit(days)).alias("m")).scalar()
    from_end = F.col(LENGTH) - 1 - F.col(POS)
    kept = bars.withColumn("_m", shortest).where(from_end < F.col("_m"))
    return kept.select(
        "symbol", "date", (F.col("_m") - 1 - from_end).alias("rn"), "close", "prev_close"
    )


def aligned_returns(aligned: DataFrame) -> DataFrame:
    """``(symbol, rn, r)``; the first aligned price only serves as a base."""
    r = F.ln(ratio(F.col("close"), F.col("prev_close")))
    return aligned.where(F.col("rn") > 0).select("symbol", "rn", r.alias("r"))


def annual_mean(returns: DataFrame) -> DataFrame:
    return returns.groupBy("symbol").agg((F.avg("r") * YEAR_DAYS).alias("ann_mean"))


def annual_covariance(returns: DataFrame) -> DataFrame:
    """The yearly sample covariance matrix as rows ``(asset_i, asset_j, cov)``."""
    named = blocks.numbers(returns)
    stats = returns.groupBy("symbol").count().agg(F.max("count").alias("n")).scalar()
    found = blocks.covariance_blocks(blocks.return_blocks(returns, named, YEAR_DAYS))
    cells = found.select("i", "j", F.posexplode("cells").alias("at", "x"))
    cells = cells.selectExpr("i", "j", f"CAST(at DIV {blocks.ASSETS} AS INT) AS p", f"CAST(at % {blocks.ASSETS} AS INT) AS q", "x")
    both = cells.unionByName(cells.where("i < j").selectExpr("j AS i", "i AS j", "q AS p", "p AS q", "x"))
    first, second = (named.selectExpr(f"asset AS asset_{k}", f"block AS {k}", f"place AS {c}") for k, c in (("i", "p"), ("j", "q")))
    rows = both.join(first, ["i", "p"]).join(second, ["j", "q"])
    return rows.select("asset_i", "asset_j", (F.col("x") * YEAR_DAYS / (stats - 1)).alias("cov"))


def uniform(key: str) -> str:
    """SQL for a uniform number in (0, 1] from a hash of a text key: the same
    on any engine, partitioning or retry."""
    return f"(CAST(conv(substring(md5({key}), 1, 13), 16, 10) AS BIGINT) + 1) / {float(1 << 52)}D"


def _draw(seed: int) -> str:
    """SQL for a unit-mean exponential of portfolio ``p`` and asset ``a``."""
    return f"-ln({uniform(f"concat('{int(seed)}:', p, ':', a)")})"


def random_weights(returns: DataFrame, draws: int = DRAWS, seed: int = SEED) -> DataFrame:
    """``draws`` portfolios as rows ``(portfolio, asset, w)``: exponentials over their sum."""
    assets = returns.select(F.col("symbol").alias("a")).distinct()
    rows = assets.select("a", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("p")).withColumn("draw", F.expr(_draw(seed)))
    totals = rows.groupBy("p").agg(F.sum("draw").alias("total"))
    return rows.join(totals, "p").selectExpr("p AS portfolio", "a AS asset", "draw / total AS w")


def equal_weights(returns: DataFrame) -> DataFrame:
    assets = returns.select(F.col("symbol").alias("asset")).distinct()
    count = assets.agg(F.count(F.lit(1)).alias("n")).scalar()
    return assets.select(F.lit(-1).alias("portfolio"), "asset", (1 / count).alias("w"))


def _moments(sums: DataFrame, risk_free: float) -> DataFrame:
    """Return, volatility and Sharpe ratio per portfolio, its weights scaled to one."""
    scaled = sums.selectExpr("portfolio", "mean / total AS ret", "sqrt(greatest(variance, 0D)) / total AS vol")
    sharpe = F.when(F.col("vol") > 1e-10, (F.col("ret") - risk_free) / F.col("vol"))
    return scaled.withColumn("sharpe", F.coalesce(sharpe, F.lit(0.0)))


def draw_moments(returns: DataFrame, draws: int = DRAWS, seed: int = SEED, risk_free: float = RISK_FREE,
                 equal: bool = False) -> DataFrame:
    """Moments of the drawn portfolios and, as number -1, of ``equal`` weights."""
    named = blocks.numbers(returns)
    weights = blocks.drawn_blocks(named, draws, _draw(seed))
    if equal:
        weights = weights.unionByName(blocks.given_blocks(equal_weights(returns), named))
    return _moments(blocks.portfolio_sums(weights, blocks.return_blocks(returns, named, YEAR_DAYS), YEAR_DAYS), risk_free)


def portfolio_moments(weights: DataFrame, returns: DataFrame, risk_free: float = RISK_FREE) -> DataFrame:
    """Moments of given weights ``(portfolio, asset, w)``."""
    named = blocks.numbers(returns)
    found = blocks.portfolio_sums(blocks.given_blocks(weights, named), blocks.return_blocks(returns, named, YEAR_DAYS), YEAR_DAYS)
    return _moments(found, risk_free)


def best_portfolio(moments: DataFrame) -> DataFrame:
    """Highest Sharpe ratio, lower id on ties."""
    order = F.struct("sharpe", (-F.col("portfolio")).alias("first"))
    return moments.agg(F.max_by(F.struct("portfolio", "ret", "vol", "sharpe"), order).alias("b")).select(
        "b.*"
    )


def optimize(returns: DataFrame, draws: int = DRAWS, seed: int = SEED,
             risk_free: float = RISK_FREE, moments: DataFrame | None = None) -> DataFrame:
    """The response record: best weights, moments, equal-weight baseline and
    the improvement. Fewer than two assets give no row. ``moments`` are those of the
    draws and the equal weights, if a caller has them already."""
    moments = draw_moments(returns, draws, seed, risk_free, equal=True) if moments is None else moments
    sampled = F.col("portfolio") >= 0
    rank = F.when(sampled, F.struct("sharpe", (-F.col("portfolio")).alias("first")))
    picked = moments.agg(
        F.max_by(F.struct("portfolio", "ret", "vol", "sharpe"), rank).alias("b"),
        F.max(F.when(~sampled, F.struct("ret", "vol", "sharpe"))).alias("e"),
    )
    record = picked.select(
        F.col("b.portfolio").alias("portfolio"),
        F.round(F.col("b.ret") * 100, 2).alias("expected_return"),
        F.round(F.col("b.vol") * 100, 2).alias("volatility"),
        F.round("b.sharpe", 3).alias("sharpe"),
        F.round(F.col("e.ret") * 100, 2).alias("eq_return"),
        F.round(F.col("e.vol") * 100, 2).alias("eq_volatility"),
        F.round("e.sharpe", 3).alias("eq_sharpe"),
        F.round(
            F.try_divide(F.col("b.sharpe") - F.col("e.sharpe"), F.abs("e.sharpe")) * 100, 1
        ).alias("sharpe_improvement"),
    )
    used = returns.agg((F.max("rn") + 1).alias("days_used")).scalar()
    # Of all portfolios only the best is drawn again, asset by asset.
    assets = returns.select(F.col("symbol").alias("a")).distinct()
    drawn = assets.withColumn("p", record.select("portfolio").scalar()).withColumn("draw", F.expr(_draw(seed)))
    listed = drawn.agg(F.sort_array(F.collect_list(F.struct("a", "draw"))).alias("v"), F.sum("draw").alias("total"))
    chosen = listed.join(record, F.size("v") >= 2)
    return chosen.select(
        F.col("v.a").alias("symbols"),
        F.transform("v", lambda x: F.round(x["draw"] / F.col("total"), 4)).alias("weights"),
        *[c for c in record.columns if c != "portfolio"],
        used.alias("days_used"),
    )


def optimize_horizons(bars: DataFrame, horizons: Sequence[int] = HORIZONS,
                      draws: int = DRAWS) -> DataFrame:
    """The record for each horizon that a user can choose."""
    records = []
    for days in horizons:
        returns = stage(aligned_returns(align_positions(bars, days)), "returns")
        records.append(optimize(returns, draws).select(F.lit(days).alias("days"), "*"))
    return reduce(DataFrame.unionByName, records)


def frontier(returns: DataFrame, points: int = FRONTIER_POINTS, seed: int = SEED,
             moments: DataFrame | None = None) -> DataFrame:
    """Percent return and volatility of the first ``points`` draws; ``moments`` are those of
    at least as many draws, if a caller has them already."""
    moments = draw_moments(returns, points, seed) if moments is None else moments
    return moments.where(F.col("portfolio").between(0, points - 1)).select(
        "portfolio", F.round(F.col("ret") * 100, 2).alias("ret"),
        F.round(F.col("vol") * 100, 2).alias("vol"),
    )


def point_sharpe(ret: Column, vol: Column, risk_free: float = RISK_FREE) -> Column:
    return ratio(ret / 100 - F.lit(risk_free), vol / 100)


def frontier_export(points: DataFrame, record: DataFrame) -> DataFrame:
    """Sample points, optimum and equal-weight baseline as one flat table."""
    sample = points.select(
        F.lit("sample").alias("type"),
        F.col("vol").alias("volatility_pct"),
        F.col("ret").alias("return_pct"),
        F.round(point_sharpe(F.col("ret"), F.col("vol")), 3).alias("sharpe"),
    )
    optimal = record.select(
        F.lit("optimal"), "volatility", "expected_return", "sharpe"
    )
    equal = record.select(F.lit("equal_weight"), "eq_volatility", "eq_return", "eq_sharpe")
    return sample.union(optimal).union(equal)


def weighted_sharpe(returns: DataFrame, weights: DataFrame, risk_free: float = RISK_FREE) -> DataFrame:
    """Sharpe ratio per portfolio from its daily returns."""
    daily = (
        returns.join(weights, returns["symbol"] == weights["asset"])
        .groupBy("portfolio", "rn")
        .agg(F.sum(F.col("w") * F.col("r")).alias("p"))
    )
    vol = F.stddev_samp("p") * F.sqrt(F.lit(float(YEAR_DAYS)))
    mean = F.avg("p") * YEAR_DAYS - F.lit(risk_free)
    return daily.groupBy("portfolio").agg(
        F.when(vol < 1e-10, F.lit(0.0)).otherwise(F.try_divide(mean, vol)).alias("sharpe")
    )


def single_asset_sharpe(returns: DataFrame, risk_free: float = RISK_FREE) -> DataFrame:
    """One-asset form: the whole weight on each asset."""
    vol = F.stddev_samp("r") * F.sqrt(F.lit(float(YEAR_DAYS)))
    mean = F.avg("r") * YEAR_DAYS - F.lit(risk_free)
    return returns.groupBy("symbol").agg(
        F.when(vol < 1e-10, F.lit(0.0)).otherwise(F.try_divide(mean, vol)).alias("sharpe")
    )
