"""Keyed warehouse tables as parquet, partitioned by the year and month of their date.

A merge lists the months of its source, reads and joins only those of the table, and
replaces only them (Spark's dynamic partition overwrite); the files of all other months are
neither read nor touched. The merged rows are staged first, as a table cannot be overwritten
while it is read. A merge that is lost between two months is mended by running it again, which
gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.operators.merge import (
    upsert_indicators, upsert_predictions, upsert_prices, upsert_sentiment,
)
from barline.schemas import PIPELINE_RUNS, PREDICTIONS, SENTIMENT, STOCK_PRICES, TECHNICAL_INDICATORS
from barline.session import stage, staging
from barline.sinks.lake import write_partitions

TABLES = {
    "stock_prices": STOCK_PRICES,
    "technical_indicators": TECHNICAL_INDICATORS,
    "predictions": PREDICTIONS,
    "sentiment": SENTIMENT,
    "pipeline_runs": PIPELINE_RUNS,
}


DATES = {"stock_prices": "date", "technical_indicators": "date", "predictions": "prediction_date", "sentiment": "date"}
_MONTH = "year * 100 + month"


def by_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumns({"year": F.year(date), "month": F.month(date)})


class Warehouse:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _table(self, name: str) -> DataFrame:
        """All rows with their year and month; empty before the first merge."""
        schema = T.StructType([*TABLES[name], T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self, name: str, since: str | None = None) -> DataFrame:
        """A table's rows. With ``since``, only those of that day or later; months before it
        are not opened."""
        if name == "pipeline_runs":
            return self.runs()
        rows = self._table(name)
        if since is not None:
            first = 100 * int(since[:4]) + int(since[5:7])
            rows = rows.where((F.expr(_MONTH) >= first) & (F.col(DATES[name]) >= F.lit(since).cast("date")))
        return rows.select(*TABLES[name].names)

    def _merge(self, name: str, source: DataFrame, merge: Callable, order: Sequence[str]) -> int:
        with staging(self.spark):
            return self._merge_months(name, source, merge, order)

    def _merge_months(self, name: str, source: DataFrame, merge: Callable, order: Sequence[str]) -> int:
        """Merge and return the number of source rows, counted as they are staged.
        Rows that do not say when they were made get the time of the merge."""
        seen = Observation()
        stamps = {c: F.current_timestamp() for c in ("created_at", "ingested_at")
                  if c in TABLES[name].names and c not in source.columns}
        counted = conform_available(source.withColumns(stamps), TABLES[name], order).observe(
            seen, F.count(F.lit(1)).alias("rows")
        )
        came = stage(counted, f"{name}-source")
        # As many rows as the source has months: a calendar bounds them.
        months = [r[0] for r in by_month(came, DATES[name]).select(F.expr(_MONTH).alias("m")).distinct().collect()]
        dated, undated = [m for m in months if m is not None], None in months
        touched = F.expr(_MONTH).isin(dated) | (F.col("year").isNull() if undated else F.lit(False))
        target = self._table(name).where(touched).select(*TABLES[name].names)
        merged = stage(by_month(merge(target, came, order), DATES[name]), f"{name}-merged")
        write_partitions(merged, f"{self.path}/{name}", "year", "month")
        return int(seen.get["rows"])

    def upsert_prices(self, source: DataFrame, order: Sequence[str] = ()) -> int:
        return self._merge("stock_prices", source, upsert_prices, order)

    def upsert_indicators(self, source: DataFrame, order: Sequence[str] = ()) -> int:
        return self._merge("technical_indicators", source, upsert_indicators, order)

    def upsert_predictions(self, source: DataFrame, order: Sequence[str] = ()) -> int:
        return self._merge("predictions", source, upsert_predictions, order)

    def upsert_sentiment(self, source: DataFrame, order: Sequence[str] = ()) -> int:
        return self._merge("sentiment", source, upsert_sentiment, order)

    def load_processed(self, processed: DataFrame) -> int:
        """Feed the price and the indicator table from one processed table."""
        rows = self.upsert_prices(processed)
        self.upsert_indicators(processed)
        return rows

    def log_run(self, dag_id: str, run_id: str, status: str, rows: int,
                started_at=None, completed_at=None, error: str | None = None) -> None:
        """Append one row to the run log."""
        row = [(dag_id, run_id, status, rows, started_at, completed_at, error)]
        df = self.spark.createDataFrame(row, PIPELINE_RUNS)
        df.write.mode("append").parquet(f"{self.path}/pipeline_runs/log")

    def runs(self) -> DataFrame:
        """The run log; empty before the first run."""
        try:
            return self.spark.read.schema(PIPELINE_RUNS).parquet(f"{self.path}/pipeline_runs/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], PIPELINE_RUNS)


def conform_available(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """Cast the columns that the table knows; drop others but ``extra``."""
    known = [F.col(f.name).cast(f.dataType) for f in schema if f.name in df.columns]
    return df.select(*known, *[c for c in extra if c not in schema.names])

