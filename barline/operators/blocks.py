"""Matrix products of a table of returns in blocks of fixed size.

Assets are numbered in blocks of ``ASSETS``, positions in blocks of ``DAYS`` and portfolios in
blocks of ``DRAWS``. A block is one row with its cells as an array, so no row grows with the
basket, and Spark deals blocks out like any other rows. Inside a task numpy multiplies pairs
of blocks; sums are kept for a bounded number of results and passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.session import stage

ASSETS, DAYS, DRAWS = 128, 128, 256
#: Left blocks of one position block are dealt over so many tasks.
SPREAD = 16
#: Result blocks that a task sums before it passes them on.
HELD = 64
#: Largest table of return blocks that every executor gets whole.
BROADCAST_BYTES = 32 << 20
#: The position block that holds each asset's mean, a one, and its number of returns.
FACTS = -1


def numbers(returns: DataFrame) -> DataFrame:
    """``(asset, block, place)``: at most ``ASSETS`` assets a block, in order of name."""
    # Ids rise within the sorted partitions; a block never spans two of them.
    ids = returns.select(F.col("symbol").alias("asset")).distinct().orderBy("asset").withColumn(
        "id", F.monotonically_increasing_id())
    return stage(ids.selectExpr("asset", f"id DIV {ASSETS} AS block", f"CAST(id % {ASSETS} AS INT) AS place"), "numbers")


def return_blocks(returns: DataFrame, named: DataFrame, year_days: int) -> DataFrame:
    """``(block, days, at, x)``: centred returns by asset block and position block, and the facts.

    ``at`` is ``place * DAYS + day``. All assets need the same positions, as aligned returns have.
    """
    stats = returns.groupBy("symbol").agg(F.avg("r").alias("mean"), F.count("r").alias("n"))
    known = named.join(stats, F.col("asset") == F.col("symbol")).drop("symbol")
    centred = returns.join(known, F.col("symbol") == F.col("asset")).selectExpr(
        "block", f"CAST(rn DIV {DAYS} AS INT) AS days", f"CAST(place * {DAYS} + rn % {DAYS} AS INT) AS at", "r - mean AS x")
    facts = known.selectExpr(
        "block", f"{FACTS} AS days",
        f"inline(array(struct(place * {DAYS} AS at, mean * {year_days} AS x), "
        f"struct(place * {DAYS} + 1 AS at, 1D AS x), struct(place * {DAYS} + 2 AS at, CAST(n AS DOUBLE) AS x)))")
    cells = centred.unionByName(facts).groupBy("block", "days").agg(F.collect_list(F.struct("at", "x")).alias("c"))
    return stage(cells.selectExpr("block", "days", "c.at AS at", "c.x AS x"), "return_blocks")


def _sum_batches(name: str, schema_keys: list[str], batches, held: int = HELD):
    """Sums of equal keys' arrays, at most ``held`` keys at a time."""
    sums: dict[tuple, np.ndarray] = {}

    def out() -> pd.DataFrame:
        rows = [(*k, v.ravel()) for k, v in sums.items()]
        return pd.DataFrame(rows, columns=[*schema_keys, name])

    for key, value in batches:
        if key in sums:
            sums[key] += value
        else:
            if len(sums) >= held:
                yield out()
                sums.clear()
            sums[key] = value
    if sums:
        yield out()


def covariance_blocks(blocks: DataFrame) -> DataFrame:
    """``(i, j, cells)`` for asset blocks ``i <= j``: sums of products of their centred returns."""
    n_assets, n_days, sum_batches = ASSETS, DAYS, _sum_batches

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def dense(at, x):
            out = np.zeros(n_assets * n_days)
            out[at] = x
            return out.reshape(n_assets, n_days)

        def products():
            for part in batches:
                for r in part.itertuples(index=False):
                    yield (r.i, r.j), dense(r.at, r.x) @ dense(r.at2, r.x2).T

        yield from sum_batches("cells", ["i", "j"], products())

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "j": [key[1]], "cells": [np.sum(np.stack(part["cells"].to_list()), axis=0)]})

    x = blocks.where(F.col("days") >= 0)
    left = x.selectExpr("block AS i", "days", f"pmod(xxhash64(block), {SPREAD}) AS spread", "at", "x")
    right = x.selectExpr("block AS j", "days", f"explode(sequence(0L, {SPREAD - 1}L)) AS spread", "at AS at2", "x AS x2")
    pairs = left.join(right, ["days", "spread"]).where("i <= j")
    schema = "i long, j long, cells array<double>"
    partial = pairs.select("i", "j", "at", "x", "at2", "x2").mapInPandas(multiply, schema)
    return partial.groupBy("i", "j").applyInPandas(add, schema)


def drawn_blocks(named: DataFrame, draws: int, weight: str) -> DataFrame:
    """``(d, block, at, w)``: weights of portfolios 0 to ``draws - 1`` by ``weight``, SQL of ``p`` and
    ``a``. Blocks are made in place: only their numbers are dealt out."""
    assets = named.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "asset"))).alias("a"))
    last = (draws - 1) // DRAWS
    made = assets.select("block", F.col("a.asset").alias("assets"), F.explode(F.sequence(F.lit(0), F.lit(last))).alias("d"))
    made = made.repartition("d")
    portfolios = f"sequence(d * {DRAWS}, least(d * {DRAWS} + {DRAWS - 1}, {draws - 1}))"
    return made.selectExpr(
        "d", "block", f"flatten(transform({portfolios}, p -> transform(assets, a -> {weight}))) AS w",
        f"flatten(transform({portfolios}, p -> transform(assets, (a, k) -> CAST((p - d * {DRAWS}) * {ASSETS} + k AS INT)))) AS at")


def given_blocks(weights: DataFrame, named: DataFrame) -> DataFrame:
    """The same from rows ``(portfolio, asset, w)``."""
    cells = weights.join(named, "asset").selectExpr(
        f"CAST(floor(portfolio / {DRAWS}) AS INT) AS d", "block",
        f"CAST(pmod(portfolio, {DRAWS}) * {ASSETS} + place AS INT) AS at", "CAST(w AS DOUBLE) AS w")
    packed = cells.groupBy("d", "block").agg(F.collect_list(F.struct("at", "w")).alias("c"))
    return packed.selectExpr("d", "block", "c.w AS w", "c.at AS at")


def portfolio_sums(weights: DataFrame, blocks: DataFrame, year_days: int) -> DataFrame:
    """``(portfolio, mean, variance, total)``: yearly, of weights as they are, and their sum.

    A weight block meets the return blocks of its assets, which gives each portfolio's return at
    each position; their squares sum to the variance. So the covariance matrix, which has the
    square of the basket's size, is not needed.
    """
    n_assets, n_days, n_draws, facts, sum_batches = ASSETS, DAYS, DRAWS, FACTS, _sum_batches

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def products():
            for part in batches:
                for r in part.itertuples(index=False):
                    w, x = np.zeros(n_draws * n_assets), np.zeros(n_assets * n_days)
                    w[r.at2], x[r.at] = r.w, r.x
                    yield (r.d, r.days), w.reshape(n_draws, n_assets) @ x.reshape(n_assets, n_days)

        yield from sum_batches("cells", ["d", "days"], products())

    def finish(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        daily = np.sum(np.stack(part["cells"].to_list()), axis=0).reshape(n_draws, n_days)
        out = pd.DataFrame({"portfolio": np.arange(n_draws) + key[0] * n_draws})
        for name, column in (("mean", 0), ("total", 1), ("weighted_n", 2)):
            out[name] = daily[:, column] if key[1] == facts else 0.0
        out["square"] = 0.0 if key[1] == facts else (daily * daily).sum(axis=1)
        return out

    size = 12 * blocks.select(F.sum(F.size("x"))).first()[0] if blocks.take(1) else 0
    sized = F.broadcast(blocks) if size <= BROADCAST_BYTES else blocks.hint("merge")
    met = weights.withColumnRenamed("at", "at2").join(sized, "block").select("d", "days", "at2", "w", "at", "x")
    partial = met.mapInPandas(multiply, "d int, days int, cells array<double>")
    sums = partial.groupBy("d", "days").applyInPandas(
        finish, "portfolio long, mean double, total double, weighted_n double, square double")
    whole = sums.groupBy("portfolio").agg(*[F.sum(c).alias(c) for c in ("mean", "total", "weighted_n", "square")])
    # A block's unused portfolios weigh nothing.
    return whole.where("total > 0").selectExpr(
        "CAST(portfolio AS INT) AS portfolio", "mean", f"square * {year_days} / (weighted_n / total - 1) AS variance", "total")
