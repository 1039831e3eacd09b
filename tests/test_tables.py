import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from barline.operators import merge
from barline.sinks.lake import write_processed, write_raw
from barline.sinks.warehouse import Warehouse
from barline.sources import lake, payloads
from tests.helpers import bars, walk

D = dt.date(2024, 1, 1)
T = dt.datetime(2024, 1, 2)
PRICES = "symbol string, date date, open double, close double, adjusted_close double, volume long"


def test_price_upsert_replaces_three_columns(spark):
    target = spark.createDataFrame([("A", D, 1.0, 1.0, 1.0, 1), ("B", D, 5.0, 5.0, None, 5)], PRICES)
    source = spark.createDataFrame([("A", D, 9.0, 9.0, None, 9), ("C", D, 7.0, 7.0, 7.0, 7)], PRICES)
    got = {r["symbol"]: tuple(r)[2:] for r in merge.upsert_prices(target, source).collect()}
    assert got == {"A": (1.0, 9.0, None, 9), "B": (5.0, 5.0, None, 5), "C": (7.0, 7.0, 7.0, 7)}


def test_upsert_takes_the_last_of_repeated_keys(spark):
    target = spark.createDataFrame([], PRICES)
    source = spark.createDataFrame(
        [("A", D, 1.0, 1.0, 1.0, 1, 1), ("A", D, 2.0, 2.0, 2.0, 2, 2)], PRICES + ", seq int")
    assert [r["close"] for r in merge.upsert_prices(target, source, ["seq"]).collect()] == [2.0]
    unordered = merge.upsert_prices(target, source.drop("seq"))
    # One exchange per side: the reduced source is joined where it lies.
    plan = unordered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert [r["close"] for r in unordered.collect()] == [2.0]


def test_indicator_upsert_leaves_absent_columns(spark):
    schema = "symbol string, date date, rsi_14 double, macd double"
    target = spark.createDataFrame([("A", D, 1.0, 2.0)], schema)
    source = spark.createDataFrame([("A", D, None)], "symbol string, date date, rsi_14 double")
    assert tuple(merge.upsert_indicators(target, source).first())[2:] == (None, 2.0)


def test_prediction_upsert_keeps_sentiment(spark):
    schema = ("symbol string, prediction_date date, predicted_price double, confidence_lower double, "
              "confidence_upper double, confidence_score double, model_version string, "
              "sentiment_score double, sentiment_label string")
    target = spark.createDataFrame([("A", D, 1.0, 1.0, 1.0, 1.0, "v", 0.5, "Bullish")], schema)
    source = spark.createDataFrame([("A", D, 2.0, 2.0, 2.0, 0.2, "v", None, "Neutral"),
                                    ("A", D, 3.0, 3.0, 3.0, 0.3, "w", None, "Neutral")], schema)
    got = {r["model_version"]: (r["predicted_price"], r["sentiment_label"])
           for r in merge.upsert_predictions(target, source).collect()}
    assert got == {"v": (2.0, "Bullish"), "w": (3.0, "Neutral")}


def test_snapshot_expires(spark):
    rows = [("a", T, 1.0), ("A", T + dt.timedelta(seconds=5), 2.0), ("b", T - dt.timedelta(days=1), 3.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, price double")
    snap = merge.snapshot(df, F.concat(F.lit("price:"), "symbol"), "ts", ["price"], merge.TTL["price"])
    now = F.lit(T + dt.timedelta(seconds=64))
    assert [(r["key"], r["price"]) for r in merge.live(snap, now).collect()] == [("PRICE:A", 2.0)]
    assert merge.live(snap, F.lit(T + dt.timedelta(seconds=65))).count() == 0


def files(path):
    """Data files below a folder with the time they were written."""
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def test_merges_touch_only_their_months(spark, tmp_path):
    w, path = Warehouse(spark, str(tmp_path)), str(tmp_path / "stock_prices")
    rows = bars(spark, walk(400)).withColumn("adjusted_close", F.col("close"))
    w.upsert_prices(rows)
    before = files(path)
    assert len(before) == 14  # one file a month
    day = dt.date(1990, 3, 5)
    change = spark.createDataFrame([("A", day, 5.0, 5), ("B", dt.date(1993, 7, 1), 6.0, 6)],
                                   "symbol string, date date, close double, volume long")
    assert w.upsert_prices(change) == 2
    after = files(path)
    kept = {f: t for f, t in after.items() if f in before}
    assert len(kept) == 13 and all(before[f] == t for f, t in kept.items())
    new = sorted(f for f in after if f not in before)
    assert ["year=1990/month=3" in f for f in new] == [True, False] and "year=1993/month=7" in new[1]
    got = w.read("stock_prices")
    assert got.count() == 401
    changed = got.where(F.col("date") == day).first()
    assert (float(changed.close), changed.volume) == (5.0, 5) and float(changed.open) != 5.0
    late = w.read("stock_prices", since="1991-01-15")
    assert late.count() == 22 and "PartitionFilters: [isnotnull" in late._jdf.queryExecution().executedPlan().toString()
    # A row without a date conflicts with nothing and is kept.
    assert w.upsert_sentiment(spark.createDataFrame([("A", None, 0.5)], "symbol string, date date, sentiment_compound double")) == 1
    assert w.upsert_sentiment(spark.createDataFrame([("A", D, 0.5)], "symbol string, date date, sentiment_compound double")) == 1
    assert w.read("sentiment").count() == 2
    assert w.upsert_prices(change.limit(0)) == 0 and files(path) == after


@pytest.mark.parametrize("days", [60, 600])
def test_directories_get_one_file_until_they_are_large(spark, tmp_path, days):
    df = bars(spark, walk(days)).union(bars(spark, walk(days), symbol="B")).repartition(7)
    df = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    write_processed(df, str(tmp_path / "p"))
    write_raw(df.drop("year", "month"), str(tmp_path / "r"), F.lit("2024-01-01").cast("date"))
    found = files(str(tmp_path / "p"))
    assert len(found) == len({os.path.dirname(f) for f in found}) == 2 * len({(d.year, d.month) for d in (
        dt.date(1990, 1, 1) + dt.timedelta(days=i) for i in range(days))})
    assert len(files(str(tmp_path / "r"))) == 2


def test_a_large_directory_is_split(spark, tmp_path):
    df = spark.range(200_000).select(F.lit("A").alias("symbol"), F.rand(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        write_raw(df, str(tmp_path / "r"), F.lit("2024-01-01").cast("date"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(str(tmp_path / "r"))) > 1
    assert spark.read.parquet(str(tmp_path / "r")).count() == 200_000


def test_warehouse_merges_and_log(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    assert w.read("stock_prices").count() == 0
    first = bars(spark, [1.0, 2.0]).withColumn("adjusted_close", F.col("close"))
    assert w.upsert_prices(first) == 2
    again = first.withColumns({"close": F.col("close") + 1, "open": F.lit(99.0)})
    assert w.upsert_prices(again.union(
        bars(spark, [7.0], symbol="Z").withColumn("adjusted_close", F.lit(7.0)))) == 3
    got = {(r["symbol"], float(r["open"]), float(r["close"])) for r in w.read("stock_prices").collect()}
    assert got == {("A", 1.0, 2.0), ("A", 2.0, 3.0), ("Z", 7.0, 7.0)}
    w.log_run("batch", "r1", "ok", 3)
    w.log_run("batch", "r2", "failed", 0, error="x")
    assert w.runs().count() == 2 and w.read("pipeline_runs").count() == 2


def test_warehouse_sentiment_and_partial_sources(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    assert w.read("pipeline_runs").count() == 0
    rows = spark.createDataFrame([("A", D, 0.5, 0.6, 0.1, 3)],
                                 "symbol string, date date, sentiment_compound double, "
                                 "sentiment_positive double, sentiment_negative double, article_count int")
    assert w.upsert_sentiment(rows) == 1
    made = w.read("sentiment").first()["created_at"]
    assert made is not None
    assert w.upsert_sentiment(rows.select("symbol", "date", F.lit(0.25).alias("sentiment_compound"))) == 1
    got = w.read("sentiment").first()
    assert (float(got["sentiment_compound"]), got["article_count"], got["created_at"]) == (0.25, 3, made)


def test_price_upsert_keeps_what_the_source_lacks(spark):
    target = spark.createDataFrame([("A", D, 1.0, 1.0, 4.0, 1)], PRICES)
    source = spark.createDataFrame([("A", D, 9.0, 9)], "symbol string, date date, close double, volume long")
    assert tuple(merge.upsert_prices(target, source).first())[2:] == (1.0, 9.0, 4.0, 9)


def test_lake_rewrite_replaces_one_date(spark, tmp_path):
    path = str(tmp_path / "lake")
    df = bars(spark, [1.0, 2.0])
    for value, day in ((1.0, "2024-01-01"), (2.0, "2024-01-01"), (3.0, "2024-01-02")):
        write_raw(df.withColumn("close", F.lit(value)), path, F.lit(day).cast("date"))
    write_raw(bars(spark, [9.0], symbol="B"), path, F.lit("2024-01-02").cast("date"))
    whole = lake.read_partition(spark, path, df.schema)
    assert sorted(r["close"] for r in whole.collect()) == [2.0, 2.0, 3.0, 3.0, 9.0]
    one = lake.read_partition(spark, path, df.schema, symbol="A", ingest_date="2024-01-01")
    assert {r["close"] for r in one.collect()} == {2.0}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert lake.read_partition(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_processed_table_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "processed")
    df = bars(spark, walk(400))
    write_processed(df.withColumns({"year": F.year("date"), "month": F.month("date")}), path)
    got = lake.read_processed(spark, path, symbol="A", since="1991-01-01")
    assert got.count() == 35
    raw = lake.read_raw(spark, path, bars(spark, []).schema)
    assert raw.columns[0] == "symbol" and raw.count() == 400


DAY = {"1. open": "1.0", "2. high": "2", "3. low": "0.5", "4. close": "1.5",
       "5. adjusted close": "1.4", "6. volume": "10"}


def test_daily_payload(spark):
    good = {"Time Series (Daily)": {"2024-01-03": DAY, "2024-01-02": DAY, "2024-01-04": {**DAY, "6. volume": "x"}}}
    rows = [("A", json.dumps(good)), ("B", json.dumps({"Note": "slow down"})),
            ("C", json.dumps({"Error Message": "bad"})), ("D", "not json")]
    df = spark.createDataFrame(rows, "symbol string, payload string")
    ok, rejects = payloads.parse_daily(df)
    got = ok.orderBy("date").collect()
    assert [str(r["date"]) for r in got] == ["2024-01-02", "2024-01-03"]
    assert (got[0]["close"], got[0]["volume"]) == (1.5, 10)
    assert {r["symbol"]: r["reason"] for r in rejects.collect()} == {
        "A": "unreadable day", "B": "slow down", "C": "bad", "D": "not a daily series"}


def test_feed_entries(spark):
    rows = [("A", "u", "Feed", "t", "s" * 600, "l", T), ("A", "u", None, None, None, None, None),
            ("A", "u", "Feed", "old", "s", "l", T - dt.timedelta(days=8))]
    df = spark.createDataFrame(
        rows, "symbol string, feed_url string, feed_title string, title string, summary string, "
              "link string, published timestamp")
    got = payloads.parse_entries(df, F.lit(T), 7, payloads.SUMMARY_CHARS).orderBy("headline").collect()
    assert [(r["headline"], len(r["summary"]), r["source"]) for r in got] == [("", 0, "u"), ("t", 500, "Feed")]
    assert got[0]["date"] == T.date()


def test_feed_summaries_stay_whole_by_default(spark):
    df = spark.createDataFrame([("A", "u", "Feed", "t", "s" * 600, "l", T)], "symbol string, feed_url string, "
                               "feed_title string, title string, summary string, link string, published timestamp")
    assert len(payloads.parse_entries(df, F.lit(T), 7).first()["summary"]) == 600


def test_news_in_two_shapes(spark):
    nested = {"content": {"title": "n", "provider": {"displayName": "p"}, "canonicalUrl": {"url": "u"},
                          "pubDate": "d"}}
    click = {"content": {"title": "c", "clickThroughUrl": {"url": "k"}}}
    flat = {"title": "f", "publisher": "q", "link": "v", "providerPublishTime": 5}
    empty = {"title": ""}
    items = [empty] * 2 + [nested, click, flat] + [{"title": f"x{i}"} for i in range(20)]
    df = spark.createDataFrame([("A", json.dumps(items))], "symbol string, payload string")
    assert payloads.parse_news(payloads.news_items(df)).count() == 23
    got = payloads.parse_news(payloads.news_items(df), payloads.NEWS_ITEMS).orderBy("seq").collect()
    # Fifteen items are taken first, then the two without a title fall out.
    assert len(got) == 13
    assert [tuple(r)[2:] for r in got[:3]] == [("n", "p", "u", "d"), ("c", "", "k", ""), ("f", "q", "v", "5")]


def test_jobs_leave_no_staged_tables(spark, tmp_path):
    from barline import session
    from barline.plans import jobs

    shared = session.shared_dir(spark)
    before = set(os.listdir(shared))
    raw = bars(spark, walk(60)).withColumns({"date": F.col("date").cast("timestamp"), "adjusted_close": F.col("close"), "ingested_at": F.lit(T)})
    write_raw(raw, str(tmp_path / "lake"), F.lit("2024-01-01").cast("date"))
    assert jobs.run_etl(spark, str(tmp_path / "lake"), str(tmp_path / "processed")) == (60, 60)
    jobs.load_warehouse(spark, str(tmp_path / "processed"), Warehouse(spark, str(tmp_path / "wh")), "r1")
    assert set(os.listdir(shared)) == before
    with pytest.raises(ValueError), session.staging(spark):
        session.stage(raw, "lost")
        raise ValueError
    assert set(os.listdir(shared)) == before
    session.stage(raw, "kept")
    assert len(os.listdir(shared)) == len(before) + 1


def test_shared_dir_needs_the_setting_on_a_cluster(spark, monkeypatch):
    from barline import session

    class Context:
        master, applicationId = "spark://host", "app"

    class Stub:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError):
        session.shared_dir(Stub())
