"""Fitted predictors by version, and the decisions which of them scoring may use.

A version is a pipeline that Spark ML writes whole; it is written once and never changed.
A decision is one appended row with the summary it rests on, so the history of promotions
is a table. Scoring asks for the newest promoted version: a version that failed its gate,
or whose job was lost before its decision, is never used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.schemas import MODEL_DECISIONS


class ModelStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def save(self, version: str, model: PipelineModel) -> None:
        """Write a new version; an existing one is an error."""
        model.save(f"{self.path}/versions/{version}")

    def load(self, version: str) -> PipelineModel:
        return PipelineModel.load(f"{self.path}/versions/{version}")

    def decide(self, version: str, summary: DataFrame, decided_at: dt.datetime | None = None) -> None:
        """Append the decision on a version from its ``retrain_summary``. Without a judged
        symbol there is no ground for promotion."""
        when = F.lit(decided_at or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
        row = summary.select(
            F.lit(version).alias("model_version"), "avg_sharpe", "avg_accuracy", "symbols", "best_symbol",
            F.coalesce("promoted", F.lit(False)).alias("promoted"), when.alias("decided_at"))
        row.write.mode("append").parquet(f"{self.path}/decisions")

    def decisions(self) -> DataFrame:
        """Every decision; empty before the first."""
        try:
            return self.spark.read.schema(MODEL_DECISIONS).parquet(f"{self.path}/decisions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MODEL_DECISIONS)

    def promoted(self) -> str | None:
        """The version that was promoted last, if any."""
        chosen = self.decisions().where("promoted")
        return chosen.agg(F.max_by("model_version", F.struct("decided_at", "model_version"))).first()[0]
