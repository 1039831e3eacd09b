"""Partitioned parquet lake: raw bars, news and processed bars."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.schemas import RAW_BARS


def read_raw(spark: SparkSession, path: str, schema: T.StructType = RAW_BARS) -> DataFrame:
    """Scan with a fixed schema. ``symbol`` may be a directory key, which Spark
    moves to the end, so the columns are put back in order."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_partition(spark: SparkSession, path: str, schema: T.StructType,
                   symbol: str | None = None, ingest_date: str | None = None) -> DataFrame:
    """One partition, one or all dates; an absent path reads as no rows. Both
    filters are on partition columns, so other directories are not opened."""
    keys = T.StructType([T.StructField("symbol", T.StringType()),
                         T.StructField("ingest_date", T.DateType())])
    full = T.StructType([f for f in schema if f.name not in keys.names] + list(keys))
    try:
        df = spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], full)
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if ingest_date is not None:
        df = df.where(F.col("ingest_date") == F.lit(ingest_date).cast("date"))
    return df.select(*schema.fieldNames(), *[k for k in keys.names if k not in schema.names])


def read_processed(spark: SparkSession, path: str, symbol: str | None = None,
                   since: str | None = None) -> DataFrame:
    """Processed bars. A lower date bound also bounds the year directories."""
    df = spark.read.parquet(path)
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if since is not None:
        day = F.lit(since).cast("date")
        df = df.where((F.col("year") >= int(since[:4])) & (F.col("date") >= day))
    return df
