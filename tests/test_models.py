import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.functions import signals, text
from barline.operators import backtest, blocks, forecast, portfolio, sentiment
from barline.operators.series import BLOCK, index_series
from tests.helpers import START, bars, by_date, walk


def indexed(spark, closes, **kw):
    return index_series(bars(spark, closes, **kw), neighbours=["close"])


def test_backtest_against_a_loop(spark):
    c = walk(160)
    rows = forecast.drift(backtest.with_target(indexed(spark, c)))
    got = backtest.backtest_metrics(rows).first()
    n = 159
    split = int(n * 0.8)
    close, y = c[:-1], c[1:]
    pred = close + np.r_[0.0, np.diff(close)]
    close, y, pred = close[split:], y[split:], pred[split:]
    sr = np.where(pred > close, (y - close) / close, 0.0)

    def sharpe(r):
        e = r - 0.02 / 252
        return np.mean(e) / np.std(e, ddof=1) * np.sqrt(252)

    assert (got["train_days"], got["test_days"]) == (split, n - split)
    np.testing.assert_allclose(got["mae"], np.mean(np.abs(pred - y)), atol=1e-4)
    np.testing.assert_allclose(got["naive_mae"], np.mean(np.abs(close - y)), atol=1e-4)
    np.testing.assert_allclose(got["directional_accuracy"],
                               np.mean(np.sign(y - close) == np.sign(pred - close)) * 100, atol=1e-2)
    np.testing.assert_allclose(got["strategy_sharpe"], sharpe(sr), atol=1e-3)
    np.testing.assert_allclose(got["buyhold_sharpe"], sharpe((y - close) / close), atol=1e-3)
    np.testing.assert_allclose(got["final_equity"], np.prod(1 + sr), atol=1e-4)


def test_equity_is_before_the_return(spark):
    rows = forecast.drift(backtest.with_target(indexed(spark, walk(4 * BLOCK))))
    got = by_date(backtest.equity_curve(rows, fraction=0.1))
    want = np.cumprod(np.r_[1.0, 1 + got["strategy_return"]])
    np.testing.assert_allclose(got["equity"], want[:-1], rtol=1e-9)
    np.testing.assert_allclose(got["equity_after"], want[1:], rtol=1e-9)


def test_downsample_step(spark):
    assert backtest.downsample(indexed(spark, range(130))).count() == 65
    assert backtest.downsample(indexed(spark, range(59))).count() == 59


def test_evaluation_against_numpy(spark):
    rng = np.random.default_rng(1)
    a = walk(1200)
    p = a * (1 + rng.normal(0, 0.01, len(a)))
    df = bars(spark, a).select("symbol", "date", F.col("close").alias("actual")).join(
        bars(spark, p).select("date", F.col("close").alias("predicted")), "date")
    got = backtest.evaluate(df.select("symbol", "date", "actual", "predicted")).first()
    sr = np.diff(a) / a[:-1] * np.sign(np.diff(p))
    e = sr - 0.05 / 252
    v = np.cumprod(1 + sr)
    peak = np.maximum.accumulate(v)
    want = dict(
        mae=np.mean(np.abs(a - p)), rmse=np.sqrt(np.mean((a - p) ** 2)),
        r2=1 - np.sum((a - p) ** 2) / np.sum((a - a.mean()) ** 2),
        mape_pct=np.mean(np.abs((a - p) / a)) * 100,
        directional_acc_pct=np.mean(np.sign(np.diff(a)) == np.sign(np.diff(p))) * 100,
        sharpe_ratio=np.sqrt(252) * e.mean() / e.std(), max_drawdown_pct=((v - peak) / peak).min() * 100,
    )
    for name, value in want.items():
        np.testing.assert_allclose(got[name], value, atol=6e-3, err_msg=name)


def test_flat_returns_have_zero_sharpe(spark):
    df = spark.createDataFrame([(0.01,)] * 5, "r double")
    pop, samp = df.agg(backtest.sharpe_population(F.lit(0.0) * F.col("r")),
                       backtest.sharpe_sample(F.lit(0.0) * F.col("r"))).first()
    assert (pop, samp) == (0.0, 0.0)
    flat = portfolio.log_returns(indexed(spark, [5.0] * 10))
    assert portfolio.single_asset_sharpe(flat).first()["sharpe"] == 0.0


def test_retrain_summary(spark):
    rows = [("B", 1.0, 50.0), ("A", 1.0, 60.0), ("C", None, None)]
    got = backtest.retrain_summary(spark.createDataFrame(
        rows, "symbol string, strategy_sharpe double, directional_accuracy double")).first()
    assert tuple(got) == (1.0, 55.0, 2, "A", True)


def test_lookback_sequences(spark):
    got = by_date(backtest.lookback_sequences(indexed(spark, range(BLOCK + 70)), ["close", "high"], "close"))
    assert len(got) == BLOCK + 10
    row = got.iloc[BLOCK - 30]
    first = int(row["label"]) - 60
    assert [x[0] for x in row["sequence"]] == list(map(float, range(first, first + 60)))
    assert backtest.lookback_sequences(indexed(spark, range(60)), ["close"], "close").count() == 0


def test_minmax_uses_train_rows_only(spark):
    got = by_date(backtest.minmax_scale(indexed(spark, range(100)), ["close"], 0.8))
    assert got["scaled_close"][79] == 1.0 and got["scaled_close"][99] > 1.2
    flat = by_date(backtest.minmax_scale(indexed(spark, [3.0] * 10), ["close"]))
    assert (flat["scaled_close"] == 0).all()


# -- portfolio -----------------------------------------------------------------


@pytest.fixture(scope="module")
def basket(spark):
    frames = [indexed(spark, walk(n, seed=s), symbol=a)
              for a, s, n in (("A", 1, 300), ("B", 2, 280), ("C", 3, 120))]
    return frames[0].union(frames[1]).union(frames[2])


def test_alignment_is_positional(spark, basket):
    got = by_date(portfolio.align_positions(basket, 252))
    assert got.groupby("symbol").size().to_dict() == {"A": 120, "B": 120, "C": 120}
    assert got[got["symbol"] == "A"]["close"].iloc[-1] == walk(300, seed=1)[-1]
    with pytest.raises(ValueError):
        portfolio.align_positions(basket, 59)


def test_moments_against_numpy(spark, basket):
    r = portfolio.aligned_returns(portfolio.align_positions(basket, 252))
    m = np.column_stack([np.diff(np.log(walk(n, seed=s)[-120:])) for s, n in ((1, 300), (2, 280), (3, 120))])
    mean, cov = m.mean(axis=0) * 252, np.cov(m.T, ddof=1) * 252
    # The reference draws, passed in as a table.
    rng = np.random.default_rng(42)
    raw = rng.exponential(1.0, (200, 3))
    w = raw / raw.sum(axis=1, keepdims=True)
    table = spark.createDataFrame(
        [(i, a, float(w[i, j])) for i in range(200) for j, a in enumerate("ABC")],
        "portfolio int, asset string, w double")
    got = portfolio.portfolio_moments(table, r).toPandas().sort_values("portfolio")
    ret, vol = w @ mean, np.sqrt(np.einsum("pi,ij,pj->p", w, cov, w))
    np.testing.assert_allclose(got["ret"], ret)
    np.testing.assert_allclose(got["vol"], vol)
    best = portfolio.best_portfolio(portfolio.portfolio_moments(table, r)).first()
    assert best["portfolio"] == int(np.argmax((ret - 0.02) / vol))
    daily = portfolio.weighted_sharpe(r, table).toPandas().sort_values("portfolio")
    np.testing.assert_allclose(daily["sharpe"], (ret - 0.02) / vol, rtol=1e-6)


def test_optimize_record(spark, basket):
    r = portfolio.aligned_returns(portfolio.align_positions(basket, 252))
    got = portfolio.optimize(r, draws=300).first()
    assert got["symbols"] == ["A", "B", "C"] and abs(sum(got["weights"]) - 1) < 2e-4
    assert got["sharpe"] >= got["eq_sharpe"] - 0.5
    assert portfolio.optimize(r.where("symbol = 'A'"), draws=50).count() == 0


def test_ties_go_to_the_lower_id(spark):
    df = spark.createDataFrame([(3, 0.1, 0.2, 1.5), (1, 0.1, 0.2, 1.5), (2, 0.0, 0.1, 0.5)],
                               "portfolio int, ret double, vol double, sharpe double")
    assert portfolio.best_portfolio(df).first()["portfolio"] == 1


def test_weights_look_like_a_flat_dirichlet(spark):
    r = spark.createDataFrame([(a, 1, 0.0) for a in "ABCDEFG"], "symbol string, rn int, r double")
    w = portfolio.random_weights(r, 2000).toPandas()
    assert np.allclose(w.groupby("portfolio")["w"].sum(), 1)
    assert abs(w["w"].mean() - 1 / 7) < 1e-3 and abs(w["w"].std() - 0.1237) < 5e-3


# -- sentiment and signals -----------------------------------------------------


def score(spark, scorer, *headlines):
    df = spark.createDataFrame([(h,) for h in headlines], "headline string")
    return [tuple(r[0]) for r in df.select(scorer(F.col("headline"))).collect()]


def test_lexicon(spark):
    got = score(spark, text.lexicon(), "Record gain and GAIN again", "up down", "nothing here", None,
                "a cut\tloss\x1cweak")
    assert got == [(1.0, 0.0, 0.0, 1.0), (0.5, 0.5, 0.0, 0.0), (0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 1.0, 0.0),
                   (0.0, 1.0, 0.0, -1.0)]
    df = spark.createDataFrame([("buy the rally not the crash",)], "t string")
    assert abs(df.select(text.compound()(F.col("t"))).first()[0] - 1 / 3) < 1e-12


def test_whole_text_is_read(spark):
    assert score(spark, text.lexicon(), "word " * 30000 + "gain")[0][3] == 1.0


def test_labels_are_strict(spark):
    df = spark.createDataFrame([(0.05,), (0.051,), (-0.05,), (-0.2,)], "s double")
    assert [r[0] for r in df.select(text.label(F.col("s"))).collect()] == [
        "Neutral", "Bullish", "Neutral", "Bearish"]
    assert df.select(text.wide_label(F.col("s"))).collect()[3][0] == "Negative"


def test_sentiment_aggregates(spark):
    rows = [("A", START, "gain", "u1"), ("A", START, "loss", "u2"), ("A", START, "gain", "u0"), ("B", START, "x", "u")]
    news = spark.createDataFrame(rows, "symbol string, date date, headline string, url string")
    kept = sentiment.dedupe_headlines(news)
    assert {(r["headline"], r["url"]) for r in kept.where("symbol = 'A'").collect()} == {("gain", "u0"), ("loss", "u2")}
    daily = {r["symbol"]: r for r in sentiment.daily_sentiment(kept).collect()}
    assert daily["A"]["sentiment_compound"] == 0.0 and daily["A"]["article_count"] == 2
    scored = sentiment.score_articles(kept.withColumnRenamed("headline", "title"))
    asked = spark.createDataFrame([("A",), ("B",), ("Z",)], "symbol string")
    per = {r["symbol"]: tuple(r)[1:] for r in sentiment.symbol_sentiment(scored, asked).collect()}
    assert per["Z"] == (0.0, "Neutral", 0) and per["A"] == (0.0, "Neutral", 2)
    assert tuple(sentiment.sentiment_counts(sentiment.symbol_sentiment(scored, asked)).first()) == (0, 0, 3)
    assert sentiment.daily_sentiment(news.limit(0)).count() == 0


def test_scorer_may_be_a_pandas_udf(spark):
    import pandas as pd

    @F.pandas_udf("positive double, negative double, neutral double, compound double")
    def model(s: pd.Series) -> pd.DataFrame:
        n = s.str.len().astype(float)
        return pd.DataFrame({"positive": n, "negative": 0.0, "neutral": 0.0, "compound": n})

    news = spark.createDataFrame([("A", START, "four")], "symbol string, date date, headline string")
    assert sentiment.daily_sentiment(news, model).first()["sentiment_compound"] == 4.0


def test_batches_of_texts_reach_a_scorer_in_bounded_parts(spark, monkeypatch):
    import pandas as pd

    def model(s: pd.Series) -> pd.DataFrame:
        n = s.str.len().astype(float)
        return pd.DataFrame({"positive": n, "negative": n.sum(), "neutral": 0.0, "compound": n}, index=s.index)

    monkeypatch.setattr(text, "SCORED_BYTES", 100)
    rows = [("A", START, None if i % 10 == 3 else "x" * (i % 40), i) for i in range(300)] + [("A", START, "y" * 500, 300)]
    news = spark.createDataFrame(rows, "symbol string, date date, headline string, i int").repartition(1)
    got = {r["i"]: r for r in sentiment.score_headlines(news, text.batch_scorer(model)).collect()}
    for _, _, s, i in rows:
        assert got[i]["sentiment_positive"] == (None if s is None else len(s)) and got[i]["sentiment_neutral"] == 0.0
        assert got[i]["sentiment_negative"] < 100 + max(len(s or ""), 40) + (500 if i > 259 else 0)
    assert sentiment.score_headlines(news.limit(0), text.batch_scorer(model)).count() == 0


def test_scored_texts_are_freed_part_by_part(spark, monkeypatch):
    """A series whose ``.str`` was used refers to itself: nothing but the collector frees it."""
    import pandas as pd

    def model(s: pd.Series) -> pd.DataFrame:
        import gc

        kept = sum(isinstance(o, pd.Series) and o.name == "seen" for o in gc.get_objects())
        s.name = "seen"
        n = s.str.len().astype(float)
        return pd.DataFrame({"positive": n, "negative": float(kept), "neutral": 0.0, "compound": n})

    monkeypatch.setattr(text, "SCORED_BYTES", 100)
    rows = [("A", START, "x" * 60) for _ in range(40)]
    news = spark.createDataFrame(rows, "symbol string, date date, headline string").repartition(1)
    scored = sentiment.score_headlines(news, text.batch_scorer(model))
    assert scored.agg(F.max("sentiment_negative")).first()[0] == 0.0


def test_signals(spark):
    df = spark.createDataFrame([(100.0, 101.0, 2.0), (0.0, 1.0, 0.0), (100.0, 100.0, 200.0)],
                               "cur double, pred double, sd double")
    band = df.select(*[c.alias(n) for n, c in signals.confidence(F.col("pred"), F.col("cur"), F.col("sd")).items()])
    got = band.collect()
    assert tuple(got[0]) == (97.08, 104.92, 0.9216)
    assert got[1][2] == 0.9 and got[2][2] == 0.0
    sig = df.select(*[c.alias(n) for n, c in signals.forecast_signal(F.col("cur"), F.col("pred")).items()]).collect()
    assert [r["signal"] for r in sig] == ["Buy", "Buy", "Sell"] and sig[1]["change_pct"] is None
    zones = spark.createDataFrame([(71.0,), (70.0,), (29.9,), (None,)], "r double")
    assert [r[0] for r in zones.select(signals.rsi_zone(F.col("r"))).collect()] == [
        "overbought", "neutral", "oversold", None]


# -- forecasts -----------------------------------------------------------------


def test_forecast_and_backtest(spark):
    ix = indexed(spark, walk(200, seed=1)).union(indexed(spark, walk(180, seed=2), symbol="B"))
    short = indexed(spark, walk(36), symbol="C")
    matrix = forecast.feature_matrix(ix.union(short)).cache()
    assert matrix.groupBy("symbol").count().count() == 3
    model = forecast.fit(matrix, trees=3)
    got = {r["symbol"]: r for r in forecast.forecast(matrix, model, "2024-01-01").collect()}
    assert set(got) == {"A", "B"}
    a = got["A"]
    assert str(a["prediction_date"]) == "2024-01-02" and a["confidence_lower"] < a["predicted_price"] < a["confidence_upper"]
    assert 0 <= a["confidence_score"] <= 1 and abs(a["predicted_price"] / a["current_price"] - 1) < 0.2
    asked = spark.createDataFrame([("A",), ("C",), ("D",)], "symbol string")
    records = forecast.forecast(matrix, model, "2024-01-01")
    assert {r[0] for r in forecast.skipped(asked, records).collect()} == {"C", "D"}
    quirk = forecast.forecast(matrix, model, "2024-01-01", as_reference=True).count()
    assert quirk == 2
    enough = matrix.where("n >= 60")
    preds = forecast.backtest_predictions(enough, forecast.fit(enough, trees=3))
    metrics = backtest.backtest_metrics(preds).collect()
    assert {m["test_days"] for m in metrics} == {(200 - 34) - int((200 - 34) * 0.8), (180 - 34) - int((180 - 34) * 0.8)}
    # Better than a constant forecast of the train mean.
    assert all(m["mae"] < 10 for m in metrics)


def test_incomplete_rows_leave_no_gap_in_the_matrix(spark):
    whole = indexed(spark, walk(80))
    holed = whole.withColumn("high", F.when(F.col("pos") == 79, F.lit(float("nan"))).otherwise(F.col("high")))
    holed = holed.withColumn("volume", F.when(F.col("pos") != 40, F.col("volume")))
    m = forecast.feature_matrix(holed).toPandas().sort_values("pos")
    assert list(m["pos"]) == list(range(len(m))) and (m["n"] == len(m)).all()
    assert len(m) == 45 and not m[forecast.LIVE_FEATURES].isna().any().any()
    assert list(m["next_close"][:-1]) == list(m["close"][1:])


def test_a_new_listing_or_a_zero_price_empties_no_portfolio(spark):
    rows = indexed(spark, walk(120)).unionByName(indexed(spark, walk(120, seed=8), symbol="B"))
    rows = rows.unionByName(indexed(spark, walk(1), symbol="NEW")).unionByName(
        indexed(spark, [*walk(119), 0.0], symbol="ZERO"))
    left = portfolio.unusable_assets(rows, 60).collect()
    assert {tuple(r) for r in left} == {("NEW", 1, "short"), ("ZERO", 120, "price")}
    returns = portfolio.aligned_returns(portfolio.align_positions(rows, 60))
    best = portfolio.optimize(returns, 50).first()
    assert best["symbols"] == ["A", "B"] and best["days_used"] == 60
    only = portfolio.align_positions(rows, 60, symbols=["B"])
    assert [r[0] for r in only.select("symbol").distinct().collect()] == ["B"]


def test_large_blocks_are_not_broadcast(spark, monkeypatch):
    rows = indexed(spark, walk(70)).unionByName(indexed(spark, walk(70, seed=8), symbol="B"))
    returns = portfolio.aligned_returns(portfolio.align_positions(rows, 60))
    near = by_portfolio(portfolio.draw_moments(returns, 20))
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 0)
    far = portfolio.draw_moments(returns, 20)
    assert "BroadcastHashJoin" not in far._jdf.queryExecution().toString()
    assert np.allclose(near, by_portfolio(far))


def test_blocks_of_any_size_give_the_whole_matrix(spark, monkeypatch):
    """Many small blocks: baskets and positions that no block holds alone."""
    for name, size in (("ASSETS", 8), ("DAYS", 16), ("DRAWS", 4), ("HELD", 3)):
        monkeypatch.setattr(blocks, name, size)
    rng = np.random.default_rng(3)
    m = rng.standard_normal((61, 37)) / 100
    names = [f"N{i:02d}" for i in range(37)]
    rows = [(names[j], i + 1, float(m[i, j])) for i in range(61) for j in range(37)]
    r = spark.createDataFrame(rows, "symbol string, rn int, r double").repartition(5)
    cov = portfolio.annual_covariance(r).toPandas().pivot(index="asset_i", columns="asset_j", values="cov")
    assert list(cov.index) == names and np.allclose(cov.to_numpy(), np.cov(m.T) * 252, rtol=1e-9, atol=1e-12)
    w = portfolio.random_weights(r, 11).toPandas().pivot(index="portfolio", columns="asset", values="w").to_numpy()
    got = portfolio.draw_moments(r, 11, equal=True).toPandas().sort_values("portfolio")
    w = np.vstack([np.full(37, 1 / 37), w])
    assert list(got["portfolio"]) == [-1, *range(11)]
    assert np.allclose(got["ret"], w @ m.mean(axis=0) * 252)
    assert np.allclose(got["vol"], np.sqrt(np.einsum("pi,ij,pj->p", w, np.cov(m.T) * 252, w)))


def by_portfolio(moments):
    return moments.toPandas().sort_values("portfolio").to_numpy(float)
