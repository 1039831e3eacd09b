"""Tick messages as streams: parsing, quality, bars, latest prices, backlog.

Every function works on batch and streaming frames alike; the writers at the
end make results complete by keeping each update with its batch number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barline.operators.merge import TTL
from barline.schemas import TICK

# Required fields, spot-check size and the alert level.
REQUIRED = ["symbol", "price", "volume", "timestamp"]
BACKLOG_ALERT = 10_000


def read_kafka(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Message stream ``(key, value)``; needs the Kafka connector."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .load()
    )
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Message stream from a folder of JSON lines."""
    return spark.readStream.text(path)


def parse_ticks(messages: DataFrame) -> DataFrame:
    """JSON ``value`` to typed columns; other columns are kept."""
    rest = [c for c in messages.columns if c not in ("value", "key")]
    parsed = messages.select(*rest, F.from_json("value", TICK).alias("t")).select(*rest, "t.*")
    return parsed.withColumn("source", F.coalesce("source", F.lit("unknown")))


def missing_fields(value: Column) -> Column:
    present = F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(f) for f in REQUIRED]), present)


def message_errors(messages: DataFrame) -> DataFrame:
    """Add the missing fields and the error count: one for any missing field,
    one for a price that is absent or not positive."""
    price = F.coalesce(F.get_json_object("value", "$.price").try_cast("double"), F.lit(0.0))
    return messages.withColumns(
        {"missing": missing_fields(F.col("value")), "price_ok": price > 0}
    ).withColumn(
        "errors",
        (F.size("missing") > 0).cast("int") + (~F.col("price_ok")).cast("int"),
    )


def quality_summary(messages: DataFrame) -> DataFrame:
    judged = message_errors(messages)
    return judged.agg(
        F.count(F.lit(1)).alias("checked"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
    )


def tick_bars(ticks: DataFrame, width: str = "1 hour", tie: str | None = None) -> DataFrame:
    """Open, high, low, close and volume per symbol and tumbling window."""
    order = F.struct("timestamp", tie) if tie else F.col("timestamp")
    return (
        ticks.groupBy("symbol", F.window("timestamp", width).alias("w"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("ticks"),
        )
        .select("symbol", F.col("w.start").alias("window_start"), "open", "high", "low", "close",
                "volume", "ticks")
    )


def stream_bars(ticks: DataFrame, width: str = "1 hour", late: str = "10 minutes",
                tie: str | None = None) -> DataFrame:
    return tick_bars(ticks.withWatermark("timestamp", late), width, tie)


def latest_ticks(ticks: DataFrame, tie: str | None = None) -> DataFrame:
    """Newest tick per symbol."""
    order = F.struct("timestamp", tie) if tie else F.col("timestamp")
    value = F.max_by(F.struct("price", "timestamp"), order).alias("v")
    return ticks.groupBy("symbol").agg(value).select("symbol", "v.*")


_PRICE = "symbol string, price double, timestamp timestamp, expires_at timestamp, live boolean"


def live_prices(ticks: DataFrame, ttl: int = TTL["price"], late: str = "10 seconds") -> DataFrame:
    """Stream of changes of the latest price: a row when a newer tick comes, and one with
    ``live`` false and no price once the watermark reaches the price's expiry.

    A symbol's state is its newest tick with a timer at its expiry, and goes with it, so
    the state holds no symbol longer than it trades. Ticks beyond the watermark and ticks older
    than the state change nothing: what has expired comes back only with a tick that is new
    itself. Only the newest tick of a symbol in an Arrow batch is shuffled, so a symbol with most
    of the ticks brings its task few rows.
    """

    def newest_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            last = part.sort_values("timestamp", kind="stable").drop_duplicates("symbol", keep="last")
            yield last[["symbol", "price", "timestamp"]]

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        symbol, life = key[0], 1000 * ttl
        if state.hasTimedOut:
            price, at = state.get
            state.remove()
            yield pd.DataFrame({"symbol": [symbol], "price": [None], "timestamp": [pd.Timestamp(at, unit="us")],
                                "expires_at": [pd.Timestamp(at + 1000 * life, unit="us")], "live": [False]})
            return
        new = pd.concat(list(batches)).sort_values("timestamp", kind="stable").iloc[-1]
        at = int(new["timestamp"].value // 1000)
        gone = at // 1000 + life <= state.getCurrentWatermarkMs()
        if gone or (state.exists and at <= state.get[1]):
            if state.exists:  # a timer lives only until the next call
                state.setTimeoutTimestamp(max(state.get[1] // 1000 + life, state.getCurrentWatermarkMs() + 1))
            return
        state.update((float(new["price"]), at))
        state.setTimeoutTimestamp(at // 1000 + life)
        yield pd.DataFrame({"symbol": [symbol], "price": [float(new["price"])], "timestamp": [new["timestamp"]],
                            "expires_at": [new["timestamp"] + pd.Timedelta(seconds=ttl)], "live": [True]})

    kept = ticks.where("symbol IS NOT NULL AND price IS NOT NULL AND timestamp IS NOT NULL").select(
        "symbol", "price", "timestamp")
    newest = kept.mapInPandas(newest_of, "symbol string, price double, timestamp timestamp")
    return newest.withWatermark("timestamp", late).groupBy("symbol").applyInPandasWithState(
        step, _PRICE, "price double, at long", "update", GroupStateTimeout.EventTimeTimeout)


def backlog(offsets: DataFrame) -> DataFrame:
    """Per topic: messages retained, real lag behind the committed offsets, and
    the alert on the retained count."""
    zero = F.lit(0)
    return offsets.groupBy("topic").agg(
        F.sum(F.greatest(zero, F.col("end") - F.col("begin"))).alias("retained"),
        F.sum(F.greatest(zero, F.col("end") - F.col("committed"))).alias("lag"),
    ).withColumn("alert", F.col("retained") > BACKLOG_ALERT)


# -- progress -------------------------------------------------------------------

_OFFSETS = "map<string, map<string, bigint>>"


def progress_offsets(progress: DataFrame) -> DataFrame:
    """Offsets for ``backlog`` from the progress of our own queries over a broker.

    ``progress`` has one JSON text ``value`` a batch (``query.lastProgress.json``). The broker's
    newest offset is ``end``, and what the batch has read up to is ``committed``; a partition
    that the batch starts with has its start as ``begin``.
    """
    source = "struct<startOffset: string, endOffset: string, latestOffset: string>"
    read = progress.select(F.explode(F.from_json("value", f"struct<sources: array<{source}>>")["sources"]).alias("s"))
    maps = read.select(*[F.from_json(f"s.{n}Offset", _OFFSETS).alias(n) for n in ("start", "end", "latest")])
    topics = maps.select("start", "end", F.explode("latest").alias("topic", "newest"))
    parts = topics.select("topic", F.explode("newest").alias("partition", "newest"),
                          F.try_element_at("start", "topic").alias("s"), F.try_element_at("end", "topic").alias("e"))
    at = F.coalesce(F.try_element_at("e", "partition"), F.lit(0))
    return parts.select(
        "topic", F.col("partition").cast("int").alias("partition"),
        F.coalesce(F.try_element_at("s", "partition"), F.lit(0)).alias("begin"),
        F.col("newest").alias("end"), at.alias("committed"))


class LateRows(StreamingQueryListener):
    """Rows that each query's watermark has dropped, and its batches, summed as progress comes.

    Spark keeps the progress of the last hundred batches only; these sums cover them all.
    ``spark.streams.addListener(LateRows())`` before the query starts.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event: Any) -> None:
        self.dropped.setdefault(str(event.id), 0)
        self.batches.setdefault(str(event.id), 0)

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        key = str(p.id)
        self.dropped[key] = self.dropped.get(key, 0) + sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        self.batches[key] = self.batches.get(key, 0) + (p.numInputRows > 0)

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass


# -- writers -------------------------------------------------------------------


def _names(spark: SparkSession, path: str) -> list[str]:
    """Entries of a folder; none if it is absent."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _drop(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _bases(spark: SparkSession, table: str) -> list[int]:
    """Batches up to which the updates are merged in one folder, complete ones only."""
    found = [int(n[1:]) for n in _names(spark, f"{table}/_base")]
    return sorted(n for n in found if "_SUCCESS" in _names(spark, f"{table}/_base/v{n}"))


def _merged(spark: SparkSession, table: str, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """Newest version of each key with its batch: the last base and the updates after it."""
    bases = [b for b in _bases(spark, table) if upto is None or b < upto]
    batches = [int(n.removeprefix("batch=")) for n in _names(spark, table) if n.startswith("batch=")]
    later = [b for b in batches if (not bases or b > bases[-1]) and (upto is None or b <= upto)]
    parts = [spark.read.parquet(f"{table}/_base/v{bases[-1]}")] if bases else []
    if later:
        paths = [f"{table}/batch={b}" for b in sorted(later)]
        parts.append(spark.read.option("basePath", table).parquet(*paths).withColumn("batch", F.col("batch").cast("long")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("v"), F.max("batch").alias("batch"))
    return best.select(*keys, "v.*", "batch")


def compact(spark: SparkSession, table: str, keys: Sequence[str], upto: int) -> None:
    """Merge the updates up to a batch into a base. Folders that the base *before* replaced go;
    those that only this one replaces stay for readers that have listed them."""
    before = [b for b in _bases(spark, table) if b < upto]
    _merged(spark, table, keys, upto).write.mode("overwrite").parquet(f"{table}/_base/v{upto}")
    if not before:
        return
    for b in before[:-1]:
        _drop(spark, f"{table}/_base/v{b}")
    for name in _names(spark, table):
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= before[-1]:
            _drop(spark, f"{table}/{name}")


def write_updates(stream: DataFrame, table: str, checkpoint: str, once: bool = True,
                  keys: Sequence[str] = (), every: int = 0):
    """Append each batch's changed rows with the batch number. A batch that is
    retried replaces its own folder, so the table holds each batch once.

    With ``keys`` and ``every``, each ``every``-th batch merges all updates so far, so that the
    table has at most some two times ``every`` folders, however long the stream runs. Batch
    numbers alone decide, so a retried batch does the same again.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")
        if every and batch_id % every == every - 1:
            compact(batch.sparkSession, table, keys, batch_id)

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, table: str, keys: list[str]) -> DataFrame:
    """Newest version of each key in a table of updates."""
    return _merged(spark, table, keys).drop("batch")


def write_quality(stream: DataFrame, table: str, checkpoint: str, once: bool = True):
    """One quality row per batch, over every message of it."""

    def save(batch: DataFrame, batch_id: int) -> None:
        quality_summary(batch).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()
