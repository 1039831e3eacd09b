import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from barline.operators import cleaning, quality, selection
from tests.helpers import bars, walk

D, T = dt.date(2024, 1, 1), dt.datetime(2024, 1, 2)
RAW = ("symbol string, date date, open double, high double, low double, close double, "
       "adjusted_close double, volume long, ingested_at timestamp")
NAN = float("nan")


def raw(spark, *changes):
    base = dict(symbol="A", date=D, open=10.0, high=11.0, low=9.0, close=10.5,
                adjusted_close=10.5, volume=5, ingested_at=T)
    rows = [tuple({**base, **c}.values()) for c in changes]
    return spark.createDataFrame(rows, RAW)


def day(i):
    return D + dt.timedelta(days=i)


def test_clean_drops_and_keeps(spark):
    df = raw(
        spark,
        {"symbol": "ok"},
        {"symbol": "open0", "open": 0.0},
        {"symbol": "opennull", "open": None},
        {"symbol": "closenan", "close": NAN},
        {"symbol": "closenull", "close": None},
        {"symbol": "close0", "close": 0.0},
        {"symbol": "volnull", "volume": None},
        {"symbol": "vol0", "volume": 0},
        {"symbol": "highnull", "high": None},
        {"symbol": "crossed", "high": 8.0},
        {"symbol": "highnan", "high": NAN},
        {"symbol": "jump", "close": 15.0},
    )
    kept = {r["symbol"] for r in cleaning.clean(df).collect()}
    assert kept == {"ok", "highnan"}


def test_dedupe_keeps_the_latest(spark):
    df = raw(spark, {"close": 1.0}, {"close": 2.0, "ingested_at": T + dt.timedelta(hours=1)},
             {"close": 3.0, "ingested_at": T - dt.timedelta(hours=1)})
    assert [r["close"] for r in cleaning.dedupe_bars(df).collect()] == [2.0]


def test_dedupe_of_hot_copies_combines_before_the_shuffle(spark):
    df = raw(spark, {}).crossJoin(spark.range(2000)).drop("id")
    best = cleaning.dedupe_bars(df)
    assert best.count() == 1
    assert "partial_max_by" in best._jdf.queryExecution().executedPlan().toString()


def test_counts_come_from_the_job(spark):
    before, after = Observation(), Observation()
    df = raw(spark, {"date": day(0)}, {"date": day(1), "volume": 0})
    assert cleaning.clean(df, before, after).count() == 1
    assert before.get["rows"] == 2 and after.get["rows"] == 1


def test_derive(spark):
    r = cleaning.derive(raw(spark, {"date": dt.date(2024, 1, 7)})).first()
    assert (r["price_range"], r["vwap"]) == (2.0, (11.0 + 9.0 + 10.5) / 3)
    assert (r["year"], r["month"], r["day_of_week"]) == (2024, 1, 1)
    assert r["processed_at"] is not None


def test_price_records(spark):
    df = cleaning.price_record(raw(spark, {"symbol": " aapl "}, {"close": 0.0, "date": day(1)},
                                   {"high": 8.0, "date": day(2)}, {"volume": None, "date": day(3)}))
    good, bad = cleaning.split_valid(df, cleaning.price_rules())
    assert [r["symbol"] for r in good.collect()] == ["AAPL"]
    assert sorted(tuple(r["reasons"]) for r in bad.collect()) == [("close",), ("high_low",), ("volume",)]


def test_tick_records(spark):
    rows = [("A", 1.0, 1, 0.9, 1.1, T, None), ("A", 1.0, 1, 0.0, 1.1, T, "x")]
    df = cleaning.tick_record(spark.createDataFrame(
        rows, "symbol string, price double, volume long, bid double, ask double, timestamp timestamp, source string"))
    good, bad = cleaning.split_valid(df, cleaning.tick_rules())
    assert good.first()["source"] == "unknown" and bad.first()["reasons"] == ["bid"]


def _checks(df, suite=quality.validate):
    return {r["check"]: (r["passed"], r["failures"]) for r in suite(df).collect()}


def test_validator(spark):
    clean = bars(spark, walk(50)).withColumn("rsi_14", F.lit(55.0))
    assert quality.passes(clean)
    null = clean.withColumn("close", F.expr("CASE WHEN date = DATE '1990-01-03' THEN NULL ELSE close END"))
    assert _checks(null)["no_nulls_close"] == (False, 1) and not quality.passes(null)
    nan = clean.withColumn("close", F.expr("CASE WHEN date = DATE '1990-01-03' THEN double('NaN') ELSE close END"))
    assert _checks(nan)["no_nulls_close"] == (False, 1)
    low = clean.withColumn("close", F.expr("CASE WHEN date = DATE '1990-01-03' THEN -5D ELSE close END"))
    assert _checks(low)["close_positive"] == (False, 1)
    twice = clean.union(clean.limit(1))
    assert _checks(twice)["no_duplicates"] == (False, 1)
    assert "rsi_range" not in _checks(clean.drop("rsi_14"))
    assert _checks(clean.withColumn("rsi_14", F.lit(101.0)))["rsi_range"] == (False, 50)


def test_expectations_allow_zero_and_skip_volume_nulls(spark):
    df = bars(spark, [0.0, 1.0]).withColumns({"rsi_14": F.lit(None).cast("double"),
                                              "volume": F.lit(None).cast("long")})
    assert all(p for p, _ in _checks(df, quality.validate_expectations).values())
    stats = quality.statistics(quality.validate_expectations(df)).first()
    assert (stats["successful"], stats["evaluated"], stats["success"]) == (7, 7, True)
    # Without the column the expectation form falls back to the light one.
    assert not quality.passes(df.drop("rsi_14"), quality.validate_expectations)


def test_unreadable_input_fails(spark, tmp_path):
    assert not quality.path_passes(spark, str(tmp_path / "absent"))
    assert _checks(bars(spark, []))["no_duplicates"] == (True, 0)


def test_selection(spark):
    df = bars(spark, range(1, 31)).union(bars(spark, range(1, 6), symbol="B"))
    assert selection.last_rows(df, 20).count() == 25
    gate = {r["symbol"]: r["enough"] for r in selection.history_gate(df, 10).collect()}
    assert gate == {"A": True, "B": False}
    total = {r["symbol"]: r["rows"] for r in selection.ingest_totals(df).collect()}
    assert total == {"A": 30, "B": 5, None: 35}


def test_top_rows_are_cut_before_the_shuffle(spark):
    plan = selection.last_rows(bars(spark, range(30)), 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_aliases_and_lists(spark):
    df = spark.createDataFrame([("btc",), ("aapl",), ("zzz",)], "symbol string")
    got = {r["symbol"]: (r["resolved"], r["supported"]) for r in selection.with_resolved(df).collect()}
    assert got == {"btc": ("BTC-USD", True), "aapl": ("AAPL", True), "zzz": ("ZZZ", False)}
    from barline.functions.scalar import symbol_list

    text = spark.createDataFrame([(" aapl,, msft ,",)], "t string")
    assert text.select(symbol_list(F.col("t"))).first()[0] == ["AAPL", "MSFT"]


def test_indicator_records(spark):
    rows = [("A", "2024-01-01", "55.5", None, None), (None, "2024-01-01", "1", "2", "x"), ("A", "junk", None, "n/a", "1"),
            ("B", "2024-01-02", "NaN", "-1e3", None)]
    df = spark.createDataFrame(rows, "symbol string, date string, rsi_14 string, macd string, other string")
    got = cleaning.indicator_record(df).collect()
    assert [r.reasons for r in got] == [[], ["symbol"], ["date", "macd"], []]
    assert got[0].rsi_14 == 55.5 and got[3].macd == -1000.0 and got[0].atr_14 is None and "other" not in got[0]
