"""Bars, ticks, headlines and articles derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per line item: symbol is the supplier's nation."""
    item = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        item.join(supplier, item["l_suppkey"] == supplier["s_suppkey"])
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("symbol"),
            F.to_date("l_shipdate").alias("date"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_quantity").cast("bigint").alias("volume"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
            "l_linestatus", "l_discount", "l_tax",
        )
    )


QUOTE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def bars(quoted: DataFrame) -> DataFrame:
    """Daily bars from quotes; the quote order decides open and close."""
    place = F.struct(*QUOTE_ORDER)
    return quoted.groupBy("symbol", "date").agg(
        F.min_by("price", place).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", place).alias("close"),
        F.sum("volume").alias("volume"),
    )


def raw_bars(quoted: DataFrame) -> DataFrame:
    """Bars with the two remaining raw columns."""
    return bars(quoted).withColumns(
        {"adjusted_close": F.col("close"), "ingested_at": F.col("date").cast("timestamp_ntz")}
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return tick_columns(e)


def tick_columns(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.lit(1).cast("bigint").alias("volume"),
        (F.col("value") - 0.01).alias("bid"),
        (F.col("value") + 0.01).alias("ask"),
        F.col("ts").alias("timestamp"),
        F.lit("feed").alias("source"),
    )


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One headline per document, its whole text."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("source").alias("symbol"),
        news_day().alias("date"),
        F.col("text").alias("headline"),
        F.format_string("doc/%d", F.col("doc_id")).alias("url"),
        "doc_id",
    )


def news_day() -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
