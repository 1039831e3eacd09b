import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barline.operators import series
from barline.operators.indicators import add_indicators, features, recursive, rolling
from barline.operators.series import BLOCK, ewm, index_series, running_product, tail
from barline.schemas import INDICATORS
from tests.helpers import bars, by_date, expected, walk


def indexed(spark, closes, **kw):
    return index_series(bars(spark, closes, **kw), neighbours=["close"])


def close_to(a, b):
    assert (a.isna() == b.isna()).all()
    np.testing.assert_allclose(a.dropna().astype(float), b.dropna().astype(float), rtol=1e-9, atol=1e-9)


def test_positions_and_neighbours_cross_year_buckets(spark):
    got = by_date(indexed(spark, range(1, 801)))
    assert list(got["pos"]) == list(range(800)) and set(got["n"]) == {800}
    close_to(got["prev_close"], got["close"].shift())
    close_to(got["next_close"], got["close"].shift(-1))


def test_neighbour_of_a_null_stays_null(spark):
    df = bars(spark, [1, 2, 3]).withColumn("close", F.expr("CASE WHEN close = 2 THEN NULL ELSE close END"))
    got = by_date(index_series(df, neighbours=["close"]))
    assert got["prev_close"].isna().tolist() == [True, False, True]


def test_finer_bucket_gives_the_same_positions(spark):
    df = bars(spark, range(100))
    fine = index_series(df, neighbours=["close"], bucket=F.date_trunc("month", "date"))
    assert by_date(fine).equals(by_date(index_series(df, neighbours=["close"])))


@pytest.mark.parametrize("rows", [1, 13, 14, 34, 40, BLOCK, BLOCK + 1, 3 * BLOCK + 77])
def test_indicators_match_the_row_by_row_rules(spark, rows):
    ix = indexed(spark, walk(rows))
    want = expected(by_date(ix)[["symbol", "date", "open", "high", "low", "close", "volume"]])
    got = by_date(features(ix))
    for c in [*INDICATORS, "sma_10", "sma_20"]:
        close_to(got[c], want[c])


def test_one_hot_symbol_among_small_ones(spark):
    """A third of all rows and more in one symbol; others short."""
    df = bars(spark, walk(2 * BLOCK + 5), symbol="HOT")
    for i in range(5):
        df = df.union(bars(spark, walk(60, seed=i), symbol=f"S{i}"))
    got = by_date(add_indicators(df))
    for _, g in got.groupby("symbol"):
        want = expected(g[["symbol", "date", "open", "high", "low", "close", "volume"]])
        for c in INDICATORS:
            close_to(g[c].reset_index(drop=True), want[c])
    # No task sorts the hot symbol whole: its rows spread over blocks.
    blocks = index_series(df).select("symbol", F.expr(series.BLOCK_OF).alias("b"))
    assert blocks.where("symbol = 'HOT'").distinct().count() == 3


def test_recursive_and_rolling_agree_with_features(spark):
    ix = indexed(spark, walk(700))
    both = by_date(features(ix))
    rec, rol = by_date(recursive(ix)), by_date(rolling(ix))
    for c in ("rsi_14", "macd", "macd_signal", "macd_hist", "atr_14"):
        close_to(rec[c], both[c])
    for c in ("bb_upper", "bb_lower", "bb_width", "return_5d", "vol_ratio"):
        close_to(rol[c], both[c])


def test_flat_series(spark):
    got = by_date(features(indexed(spark, [50.0] * 40, spread=0.0)))
    assert got["rsi_14"][:13].isna().all() and (got["rsi_14"][13:] == 100).all()
    assert np.allclose(got["macd"].dropna(), 0) and got["macd"].notna().sum() == 15
    assert np.allclose(got["bb_upper"].dropna(), 50) and np.allclose(got["bb_lower"].dropna(), 50)


def test_warm_up_lengths(spark):
    short = by_date(features(indexed(spark, walk(13))))
    assert short["rsi_14"].isna().all() and (short["atr_14"] == 0).all()
    fourteen = by_date(features(indexed(spark, walk(14))))
    assert fourteen["rsi_14"].notna().tolist() == [False] * 13 + [True]
    assert (fourteen["atr_14"] > 0).tolist() == [False] * 13 + [True]
    signal = by_date(features(indexed(spark, walk(34))))["macd_signal"]
    assert signal.notna().tolist() == [False] * 33 + [True]


def test_zero_volume_ratio_is_one(spark):
    got = by_date(rolling(indexed(spark, walk(25), volume=0), "vol_ratio"))
    assert got["vol_ratio"][:19].isna().all() and (got["vol_ratio"][19:] == 1.0).all()


def test_ewm_matches_pandas_across_blocks(spark):
    x = np.sin(np.arange(2 * BLOCK + 30)) * 100
    got = by_date(ewm(indexed(spark, x), "close", 0.2, "y", min_rows=9))
    close_to(got["y"], pd.Series(x).ewm(alpha=0.2, adjust=False, min_periods=9).mean())


def test_ewm_from_a_later_start(spark):
    x = walk(80)
    got = by_date(ewm(indexed(spark, x), "close", 0.2, "y", min_rows=9, start=25))
    want = pd.Series(np.r_[[np.nan] * 25, x[25:]]).ewm(alpha=0.2, adjust=False, min_periods=9).mean()
    close_to(got["y"], want)
    with pytest.raises(ValueError):
        ewm(indexed(spark, x), "close", 0.9, "y")


def test_running_product_and_peak_with_sign_changes(spark):
    rng = np.random.default_rng(3)
    f = rng.normal(1.0, 0.05, 2 * BLOCK + 9)
    f[[10, 600]] = -1.1
    got = by_date(running_product(indexed(spark, f), "close", "p", peak="top"))
    want = np.cumprod(f)
    np.testing.assert_allclose(got["p"], want, rtol=1e-9)
    np.testing.assert_allclose(got["top"], np.maximum.accumulate(want), rtol=1e-9)


def test_tail_renumbers(spark):
    got = by_date(tail(indexed(spark, range(50)), 7))
    assert list(got["pos"]) == list(range(7)) and set(got["n"]) == {7}
    assert np.isnan(got["prev_close"][0]) and got["prev_close"][1] == 43


def test_invariants(spark):
    got = by_date(features(indexed(spark, walk(100, seed=11))))
    assert len(got) == 100
    assert got["rsi_14"].dropna().between(0, 100).all()
    assert (got["bb_upper"].dropna() >= got["bb_lower"].dropna()).all()
    assert (got["return_1d"].dropna().abs() < 0.5).all()


def test_hot_plan_has_no_whole_symbol_sort_of_rows(spark):
    """Rows are only exchanged by (symbol, block); by symbol alone go summaries."""
    plan = features(indexed(spark, walk(60)))._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "hashpartitioning(symbol" in line and "hashpartitioning(symbol#" in line:
            keys = line.split("hashpartitioning(")[1].split("),")[0]
            if keys.count("#") == 1:
                assert "close" not in line


def test_bars_without_a_key_are_kept(spark):
    df = bars(spark, walk(60))
    lost = bars(spark, [1.0, 2.0], symbol=None).unionByName(bars(spark, [3.0]).withColumn("date", F.lit(None).cast("date")))
    got = add_indicators(df.unionByName(lost))
    assert got.count() == 63
    assert got.where("symbol IS NULL").count() == 2 and got.where("date IS NULL").count() == 1
    assert got.where("symbol IS NULL OR date IS NULL").where("atr_14 IS NOT NULL").count() == 0


def long_series(spark, rows, symbol="A"):
    """Closes that come from the row number, numbered already."""
    x = 100 + 10 * np.sin(np.arange(rows) / 50) + np.cos(np.arange(rows) * 1.7)
    df = spark.range(rows).selectExpr(
        f"'{symbol}' AS symbol", "id AS pos", f"{rows}L AS n", "100 + 10 * sin(id / 50) + cos(id * 1.7D) AS close")
    return df, x


@pytest.mark.parametrize("rows", [48 * BLOCK + 7, 514 * BLOCK + 3])
def test_carries_over_many_blocks(spark, rows):
    """Beyond the reach of a carry, and beyond a chapter of blocks."""
    df, x = long_series(spark, rows)
    got = ewm(df, "close", 1 / 14, "y").orderBy("pos").select("y").toPandas()["y"]
    close_to(got, pd.Series(x).ewm(alpha=1 / 14, adjust=False).mean())
    slow = ewm(df, "close", 0.0005, "y").orderBy("pos").select("y").toPandas()["y"]  # reaches 2 900 blocks back
    close_to(slow, pd.Series(x).ewm(alpha=0.0005, adjust=False).mean())
    factors = df.withColumn("f", F.expr("1 + sin(id * 0.37) / 100".replace("id", "pos")))
    want = np.cumprod(1 + np.sin(np.arange(rows) * 0.37) / 100)
    p = running_product(factors, "f", "p", before="b", peak="top").orderBy("pos").select("p", "b", "top").toPandas()
    np.testing.assert_allclose(p["p"], want, rtol=1e-8)
    np.testing.assert_allclose(p["b"], np.r_[1.0, want[:-1]], rtol=1e-8)
    np.testing.assert_allclose(p["top"], np.maximum.accumulate(want), rtol=1e-8)
    plain = running_product(factors, "f", "p").agg(F.max("p")).first()[0]
    np.testing.assert_allclose(plain, want.max(), rtol=1e-8)


def test_chapters_hold_no_whole_series(spark, monkeypatch):
    monkeypatch.setattr(series, "CHAPTER_BITS", 2)
    df, x = long_series(spark, 37 * BLOCK + 11)
    got = ewm(df, "close", 0.01, "y").orderBy("pos").select("y").toPandas()["y"]
    close_to(got, pd.Series(x).ewm(alpha=0.01, adjust=False).mean())
    totals = df.groupBy("symbol", F.expr(series.BLOCK_OF).alias("blk")).agg(F.count(F.lit(1)).alias("v"))
    lists = series.earlier_blocks(totals, "v", "e", 3).selectExpr("blk", "size(e) AS s").collect()
    assert sorted((r.blk, r.s) for r in lists) == [(b, min(b, 3)) for b in range(38)]


def test_a_crowded_day_is_numbered_in_pieces(spark):
    """A million ticks of one symbol in one day, most of them within a minute."""
    crowd = spark.range(1_000_000).selectExpr(
        "'HOT' AS symbol", "timestamp_micros(1704103200000000 + CASE WHEN id < 950000 THEN id * 60 "
        "ELSE 57000000 + (id - 950000) * 800000 END) AS date", "CAST(id AS DOUBLE) AS close").repartition(8)
    few = spark.range(300).selectExpr("'S' AS symbol", "timestamp_seconds(1704103200 + id * 86400) AS date", "CAST(id AS DOUBLE) AS close")
    df = crowd.unionByName(few)
    sizes = series.measured_buckets(df, order="date").groupBy("symbol", "_bucket").count().toPandas()
    hot = sizes[sizes["symbol"] == "HOT"]["count"]
    assert len(hot) == series.PIECES and hot.max() < 3 * 1_000_000 / series.PIECES
    assert len(sizes[sizes["symbol"] == "S"]) == 1
    got = index_series(df, neighbours=["close"])
    wrong = got.where("pos <> close OR n <> CASE WHEN symbol = 'HOT' THEN 1000000 ELSE 300 END "
                      "OR NOT (prev_close <=> CASE WHEN pos > 0 THEN close - 1 END) "
                      "OR NOT (next_close <=> CASE WHEN pos < n - 1 THEN close + 1 END)")
    assert got.count() == 1_000_300 and wrong.count() == 0


@pytest.mark.parametrize("last", [1, 30, BLOCK, 5000])
def test_last_rows_equal_those_of_the_whole_series(spark, last):
    ix = indexed(spark, walk(3 * BLOCK + 40)).unionByName(indexed(spark, walk(25, seed=2), symbol="B")).cache()
    whole = features(ix).where(F.col("pos") >= F.col("n") - last)
    a, b = by_date(features(ix, last=last)), by_date(whole)
    assert list(a["pos"]) == list(b["pos"])
    for c in [*INDICATORS, "sma_10", "sma_20", "vol_ratio", "ema_12"]:
        close_to(a[c], b[c])


def test_only_the_blocks_of_the_last_rows_are_framed(spark):
    ix = indexed(spark, walk(6 * BLOCK + 40)).cache()
    ix.count()
    done = features(ix, last=30)
    done.collect()
    plan = done._jdf.queryExecution().executedPlan()
    found, todo = [], [plan]
    while todo:  # rows that each generator of halos put out
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if node.nodeName() == "Generate" and "own" not in node.nodeName():
            text = node.simpleString(500)
            if "[blk" in text:
                found.append(node.metrics().apply("numOutputRows").value())
    # The last block, the one before it, and its halo: not all seven.
    assert found and max(found) <= 2 * BLOCK + 40 + 19
