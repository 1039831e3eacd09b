import datetime as dt
import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from barline.operators import forecast
from barline.operators.series import index_series
from barline.plans import jobs
from barline.schemas import HEADLINES
from barline.sinks.models import ModelStore
from barline.sinks.warehouse import Warehouse
from barline.streaming import ticks
from tests.helpers import bars, walk

T = dt.datetime(2024, 1, 1)


def message(i, **kw):
    body = {"symbol": "A" if i % 3 else "B", "price": 10.0 + i % 7, "volume": 1, "bid": 1.0, "ask": 2.0,
            "timestamp": (T + dt.timedelta(minutes=i)).isoformat(), "source": "s", "seq": i}
    body.update(kw)
    return json.dumps({k: v for k, v in body.items() if v is not ...})


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    for part in range(3):
        lines = [message(i) for i in range(part * 100, part * 100 + 100)]
        (path / f"{part}.json").write_text("\n".join(lines))
    return str(path)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stream_bars_equal_batch_bars(spark, folder, tmp_path):
    one_file = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    stream = ticks.stream_bars(ticks.parse_ticks(one_file), "1 hour", "10 minutes")
    table = str(tmp_path / "bars")
    ticks.write_updates(stream, table, str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(table).select("batch").distinct().count() == 3
    got = ticks.current(spark, table, ["symbol", "window_start"])
    want = ticks.tick_bars(ticks.parse_ticks(spark.read.text(folder)), "1 hour")
    assert rows(got) == rows(want)


def test_late_rows_beyond_the_watermark_are_dropped(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "0.json").write_text(message(0) + "\n" + message(600))
    table, progress = str(tmp_path / "t"), str(tmp_path / "p")

    def run():
        s = ticks.stream_bars(ticks.parse_ticks(ticks.read_text(spark, str(path))), "1 hour", "10 minutes")
        ticks.write_updates(s, table, progress).awaitTermination()

    run()
    (path / "1.json").write_text(message(30) + "\n" + message(599))
    run()
    got = ticks.current(spark, table, ["symbol", "window_start"])
    # 00:30 lies beyond the watermark at 09:50; 09:59 does not.
    assert got.agg(F.sum("ticks")).first()[0] == 3


def test_late_rows_are_counted_and_folders_stay_few(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    table, progress, seen = str(tmp_path / "t"), str(tmp_path / "p"), ticks.LateRows()
    spark.streams.addListener(seen)
    # Minutes of the ticks of each file; the watermark trails the newest by ten minutes.
    files = [[0, 5, 600], [30, 599, 601], [1, 2, 3, 700], [650, 800], [789, 795, 900], [10, 1000], [1100], [1200], [1300]]
    try:
        for k, minutes in enumerate(files):
            (path / f"{k}.json").write_text("\n".join(message(i, symbol="A") for i in minutes))
            bars_ = ticks.stream_bars(ticks.parse_ticks(ticks.read_text(spark, str(path))), "1 minute", "10 minutes")
            query = ticks.write_updates(bars_, table, progress, keys=["symbol", "window_start"], every=2)
            query.awaitTermination()
        for _ in range(100):
            if seen.batches.get(str(query.id), 0) == len(files):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    # 30 < 590; 1, 2, 3 < 591; 650 < 690; 789 < 790; 10 < 890. 599 and 795 are in time.
    assert seen.dropped[str(query.id)] == 1 + 3 + 1 + 1 + 1
    got = ticks.current(spark, table, ["symbol", "window_start"])
    assert got.agg(F.sum("ticks")).first()[0] == sum(map(len, files)) - 7
    batches = [n for n in os.listdir(table) if n.startswith("batch=")]
    spark.read.parquet(table).count()
    assert len(batches) <= 5 and len(os.listdir(os.path.join(table, "_base"))) <= 2


def test_a_retried_batch_merges_the_same(spark, tmp_path):
    table = str(tmp_path / "t")
    for k in range(6):
        spark.createDataFrame([("A", k), (f"S{k}", k)], "symbol string, v long").write.parquet(f"{table}/batch={k}")
        if k % 2:
            ticks.compact(spark, table, ["symbol"], k)
            ticks.compact(spark, table, ["symbol"], k)
    want = [("A", 5), *[(f"S{k}", k) for k in range(6)]]
    assert rows(ticks.current(spark, table, ["symbol"])) == want
    # A base whose job was lost is not read.
    os.makedirs(f"{table}/_base/v9")
    assert rows(ticks.current(spark, table, ["symbol"])) == want


def test_prices_expire_and_late_ticks_do_not_revive_them(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    table, progress = str(tmp_path / "t"), str(tmp_path / "p")

    def tick(symbol, second, price):
        return message(0, symbol=symbol, price=price, timestamp=(T + dt.timedelta(seconds=second)).isoformat())

    def feed(k, *messages):
        (path / f"{k}.json").write_text("\n".join(messages))
        stream = ticks.live_prices(ticks.parse_ticks(ticks.read_text(spark, str(path))), late="10 seconds")
        ticks.write_updates(stream, table, progress, keys=["symbol"], every=3).awaitTermination()
        now = ticks.current(spark, table, ["symbol"])
        return {r.symbol: r.price for r in now.where("live").collect()}

    assert feed(0, tick("A", 0, 1.0), tick("A", 5, 2.0), tick("B", 3, 7.0)) == {"A": 2.0, "B": 7.0}
    # An older tick within the watermark changes nothing.
    assert feed(1, tick("A", 4, 9.0), tick("B", 40, 8.0)) == {"A": 2.0, "B": 8.0}
    # A's 60 seconds end at 65; the watermark is 70.
    assert feed(2, tick("C", 80, 3.0)) == {"B": 8.0, "C": 3.0}
    # Late ticks of A, one of them newer than its last, are beyond the watermark.
    assert feed(3, tick("A", 6, 5.0), tick("A", 66, 6.0), tick("C", 81, 4.0)) == {"B": 8.0, "C": 4.0}
    # A tick that is new itself brings it back; B's time ends at 100.
    assert feed(4, tick("A", 120, 11.0)) == {"A": 11.0, "C": 4.0}
    gone = ticks.current(spark, table, ["symbol"]).where("NOT live").first()
    assert (gone.symbol, gone.price, gone.expires_at - gone.timestamp) == ("B", None, dt.timedelta(seconds=60))


def test_stream_latest_and_quality(spark, folder, tmp_path):
    latest = ticks.latest_ticks(ticks.parse_ticks(ticks.read_text(spark, folder)))
    table = str(tmp_path / "latest")
    ticks.write_updates(latest, table, str(tmp_path / "p1")).awaitTermination()
    want = ticks.latest_ticks(ticks.parse_ticks(spark.read.text(folder)))
    assert rows(ticks.current(spark, table, ["symbol"])) == rows(want)
    quality = str(tmp_path / "quality")
    stream = ticks.read_text(spark, folder)
    ticks.write_quality(stream, quality, str(tmp_path / "p2")).awaitTermination()
    assert spark.read.parquet(quality).first()["checked"] == spark.read.text(folder).count()


def test_message_errors(spark):
    cases = [message(1), message(2, price=...), message(3, price=0), message(4, volume=..., symbol=...), "{}", "junk"]
    df = spark.createDataFrame([(c,) for c in cases], "value string")
    got = [(sorted(r["missing"]), r["errors"]) for r in ticks.message_errors(df).collect()]
    assert got == [([], 0), (["price"], 2), ([], 1), (["symbol", "volume"], 1),
                   (sorted(ticks.REQUIRED), 2), (sorted(ticks.REQUIRED), 2)]
    assert tuple(ticks.quality_summary(df).first()) == (6, 8)


def test_parse_keeps_micros_and_defaults_source(spark):
    df = spark.createDataFrame([(message(1, source=..., timestamp="2024-01-01T10:00:00.123456"),)], "value string")
    r = ticks.parse_ticks(df).first()
    assert r["source"] == "unknown" and r["timestamp"] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)


def test_backlog(spark):
    rows_ = [("t", 0, 0, 9000, 9000), ("t", 1, 100, 2000, 50), ("u", 0, 5, 3, 3)]
    df = spark.createDataFrame(rows_, "topic string, partition int, begin long, end long, committed long")
    got = {r["topic"]: tuple(r)[1:] for r in ticks.backlog(df).collect()}
    assert got == {"t": (10900, 1950, True), "u": (0, 0, False)}


def daily_payload(closes, **days):
    series = {}
    for i, c in enumerate(closes):
        day = (dt.date(2023, 1, 2) + dt.timedelta(days=i)).isoformat()
        series[day] = {"1. open": str(c), "2. high": str(c + 1), "3. low": str(c - 1), "4. close": str(c),
                       "5. adjusted close": str(c), "6. volume": "100"}
    series.update(days)
    return json.dumps({"Time Series (Daily)": series})


def news_payload(*titles):
    return json.dumps([{"title": t, "publisher": "p", "link": f"u/{i}", "providerPublishTime": 1704067200 + 86400 * (i % 2)}
                       for i, t in enumerate(titles)])


def feeds(spark, closes_a, closes_b):
    prices = [("A", daily_payload(closes_a, **{"2024-01-01": {"1. open": "x"}})), ("B", daily_payload(closes_b)),
              ("C", json.dumps({"Note": "slow down"}))]
    news = [("A", news_payload("strong gain", "record profit", "", "strong gain")), ("B", news_payload("heavy loss")),
            ("C", "not json")]
    schema = "symbol string, payload string"
    return spark.createDataFrame(prices, schema), spark.createDataFrame(news, schema)


def test_backlog_of_our_own_queries(spark):
    source = {"description": "KafkaV2[Subscribe[t,u]]", "startOffset": {"t": {"0": 5, "1": 0}},
              "endOffset": {"t": {"0": 50, "1": 7}, "u": {"0": 1}},
              "latestOffset": {"t": {"0": 20_050, "1": 7}, "u": {"0": 1, "1": 4}}}
    first = {"sources": [source | {"startOffset": None}]}
    df = spark.createDataFrame([(json.dumps({"id": "x", "sources": [source]}),)], "value string")
    got = rows(ticks.progress_offsets(df))
    assert got == [("t", 0, 5, 20_050, 50), ("t", 1, 0, 7, 7), ("u", 0, 0, 1, 1), ("u", 1, 0, 4, 0)]
    assert rows(ticks.backlog(ticks.progress_offsets(df))) == [("t", 20_052, 20_000, True), ("u", 5, 4, False)]
    fresh = ticks.progress_offsets(spark.createDataFrame([(json.dumps(first),)], "value string"))
    assert fresh.where("topic = 't' AND partition = 0").first()["begin"] == 0


def test_batch_flow_from_text_to_run_log(spark, tmp_path):
    root = str(tmp_path / "root")
    prices, news = feeds(spark, walk(150), walk(140, seed=3))
    out = jobs.run_batch(spark, prices, news, root, "r1", "2024-01-03")
    assert {tuple(r) for r in out.totals.collect()} == {("A", 150), ("B", 140), (None, 290)}
    assert out.counts == (290, 290)
    rejects = spark.read.parquet(f"{root}/rejects")
    assert sorted((r.feed, r.symbol, r.reason) for r in rejects.collect()) == [
        ("news", "A", "no title"), ("news", "C", "not a list of items"),
        ("prices", "A", "unreadable day"), ("prices", "C", "slow down")]
    processed = spark.read.parquet(f"{root}/processed")
    assert {"year", "month", "rsi_14", "vwap"} <= set(processed.columns)
    w = Warehouse(spark, f"{root}/warehouse")
    assert w.read("stock_prices").count() == 290 and w.read("technical_indicators").count() == 290
    stored = {(r.symbol, str(r.date)): (r.article_count, float(r.sentiment_compound)) for r in w.read("sentiment").collect()}
    # The repeated headline is stored once, on its first day.
    assert {k: v[0] for k, v in stored.items()} == {("A", "2024-01-01"): 1, ("A", "2024-01-02"): 1, ("B", "2024-01-01"): 1}
    assert stored["A", "2024-01-01"][1] > 0 > stored["B", "2024-01-01"][1]
    assert tuple(out.sentiment_counts.first()) == (1, 1, 0)
    # No model is promoted, so nothing is predicted.
    assert out.predictions.count() == 0 and w.read("predictions").count() == 0
    assert {r[0] for r in out.skipped.collect()} == {"A", "B"}
    assert {(r.dag_id, r.status, r.rows_processed) for r in w.runs().collect()} == {("batch", "ok", 290), ("news", "ok", 3)}

    store = ModelStore(spark, f"{root}/models")
    done = jobs.run_retrain(processed, store, "rule-1", forecast.rule("drift"), gate=-100.0)
    assert done.promoted and done.metrics.count() == 2
    out = jobs.run_batch(spark, prices, news, root, "r2", "2024-01-03")
    assert {r.model_version for r in out.predictions.collect()} == {"rule-1"} and out.skipped.count() == 0
    # A second run leaves the tables as they are.
    assert w.read("stock_prices").count() == 290 and w.read("predictions").count() == 2 and w.read("sentiment").count() == 3
    assert w.runs().count() == 4 and spark.read.parquet(f"{root}/rejects").count() == 8
    kept = {r.key: json.loads(r.value) for r in out.records.collect()}
    assert set(kept) == {"PREDICTION:A", "PREDICTION:B", "SENTIMENT:A", "SENTIMENT:B"}
    assert [a["title"] for a in kept["SENTIMENT:A"]["articles"]] == ["strong gain", "record profit", "strong gain"]
    assert kept["PREDICTION:A"]["model_version"] == "rule-1" and kept["SENTIMENT:B"]["aggregate_label"] == "Bearish"
    lives = {r.key: r.expires_at - r.made_at for r in out.records.collect()}
    assert lives["PREDICTION:A"] == dt.timedelta(hours=1) and lives["SENTIMENT:A"] == dt.timedelta(minutes=30)


def test_bad_news_stop_only_the_news(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "wh"))
    rows = [("A", T.date(), " ", "", "u", "s", T)]
    assert not jobs.load_sentiment(spark.createDataFrame(rows, HEADLINES), w, "r1")
    run = w.runs().first()
    assert (run.dag_id, run.status, run.error_message) == ("news", "failed", "validation failed")
    assert w.read("sentiment").count() == 0


def test_scoring_obeys_the_promotion(spark, tmp_path):
    root = str(tmp_path)
    raw = bars(spark, walk(150)).union(bars(spark, walk(140, seed=3), symbol="B"))
    store, w = ModelStore(spark, f"{root}/models"), Warehouse(spark, f"{root}/wh")
    assert store.promoted() is None and store.decisions().count() == 0
    first = jobs.run_retrain(raw, store, "gbt-1", trees=2, gate=-100.0, decided_at=T)
    assert first.promoted and first.summary.first()["symbols"] == 2
    # Below its gate a later version is kept, but not used.
    second = jobs.run_retrain(raw, store, "drift-2", forecast.rule("drift"), gate=100.0, decided_at=T + dt.timedelta(days=7))
    assert not second.promoted and store.promoted() == "gbt-1"
    assert {(r.model_version, r.promoted) for r in store.decisions().collect()} == {("gbt-1", True), ("drift-2", False)}
    records, skipped = jobs.score_symbols(raw, w, store, "2024-01-01")
    got = {r.symbol: (r.model_version, r.predicted_price) for r in records.collect()}
    assert {v[0] for v in got.values()} == {"gbt-1"} and skipped.count() == 0 and w.read("predictions").count() == 2
    with pytest.raises(Exception, match="already exists"):
        store.save("gbt-1", forecast.rule("naive"))

    # Another application scores the same from what is on disk, without a fit.
    raw.write.parquet(f"{root}/bars")
    code = f"""
from barline.session import get_spark
from barline.plans import jobs
from barline.sinks.models import ModelStore
from barline.sinks.warehouse import Warehouse
spark = get_spark(**{{"spark.master": "local[2]", "spark.sql.shuffle.partitions": "2"}})
store, w = ModelStore(spark, {root + "/models"!r}), Warehouse(spark, {root + "/wh2"!r})
records, _ = jobs.score_symbols(spark.read.parquet({root + "/bars"!r}), w, store, "2024-01-01")
print("GOT", sorted((r.symbol, r.model_version, r.predicted_price) for r in records.collect()))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300,
                          cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert f"GOT {sorted((s, *v) for s, v in got.items())}" in done.stdout, done.stderr[-2000:]


def test_fits_use_all_trees(spark):
    matrix = forecast.feature_matrix(index_series(bars(spark, walk(80)), neighbours=["close"]))
    model = forecast.fit(matrix, trees=3)
    assert forecast.TREES == 200 and model.stages[-2].getNumTrees == 3
    assert sorted(forecast.predict(matrix, model).columns) == sorted([*matrix.columns, "pred"])


def test_gate_stops_the_load(spark, tmp_path):
    path = str(tmp_path / "bad")
    df = bars(spark, [1.0, 2.0])
    df.union(df).write.parquet(path)
    w = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(jobs.ValidationFailed):
        jobs.load_warehouse(spark, path, w, "r1")
    assert w.runs().first()["status"] == "failed" and w.read("stock_prices").count() == 0


def test_monitor(spark):
    offsets = spark.createDataFrame([("t", 0, 0, 5, 1)],
                                    "topic string, partition int, begin long, end long, committed long")
    messages = spark.createDataFrame([(message(1),)], "value string")
    lag, quality = jobs.monitor(offsets, messages)
    assert lag.first()["lag"] == 4 and quality.first()["errors"] == 0
