"""Lake writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitions(df: DataFrame, path: str, *keys: str, replace_all: bool = False) -> None:
    """Write by directory keys. Rows of one directory meet in one task, so that a directory
    gets one file; Spark merges small directories into a task, and splits one that is larger
    than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` over several, so neither the
    number of files nor a task grows with the input. Unless ``replace_all``, directories that
    ``df`` has no rows for stay as they are."""
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .option("compression", "snappy")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_raw(df: DataFrame, path: str, ingest_date: Column | None = None) -> None:
    """Write by symbol and ingest date. A second write for a date replaces that
    date's files of the symbols it holds and leaves all others."""
    day = F.current_date() if ingest_date is None else ingest_date
    write_partitions(df.withColumn("ingest_date", day), path, "symbol", "ingest_date")


def write_processed(df: DataFrame, path: str) -> None:
    """Write the whole table by year, month and symbol."""
    write_partitions(df, path, "year", "month", "symbol", replace_all=True)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
