"""Validation suites: one aggregation pass, one result row per check."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.functions.scalar import missing


class MissingColumn(ValueError):
    pass


def _gone(df: DataFrame, c: str) -> Column:
    types = dict(df.dtypes)
    if c not in types:
        raise MissingColumn(c)
    floating = types[c] in ("double", "float")
    return missing(F.col(c)) if floating else F.col(c).isNull()


def _hits(condition: Column) -> Column:
    return F.count_if(condition)


def _run(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Rows ``(check, passed, failures)``. Rows are first summed per
    ``(symbol, date)``, which also yields the repeats and combines map-side."""
    per_key = df.groupBy("symbol", "date").agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in counts.items()]
    )
    totals = per_key.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("no_duplicates"),
    )
    names = [*counts, "no_duplicates"]
    checks = F.array(
        *[
            F.struct(
                F.lit(n).alias("check"),
                (F.col(n) == 0).alias("passed"),
                F.col(n).cast("bigint").alias("failures"),
            )
            for n in names
        ]
    )
    return totals.select(F.inline(checks))


def validate(df: DataFrame) -> DataFrame:
    """The lightweight suite."""
    counts = {
        f"no_nulls_{c}": _hits(_gone(df, c)) for c in ("symbol", "date", "close", "volume")
    }
    counts["close_positive"] = _hits(F.col("close") <= 0)
    counts["volume_positive"] = _hits(F.col("volume") <= 0)
    if "rsi_14" in df.columns:
        rsi = F.col("rsi_14")
        counts["rsi_range"] = _hits(~F.isnan(rsi) & ((rsi < 0) | (rsi > 100)))
    return _run(df, counts)


def validate_expectations(df: DataFrame) -> DataFrame:
    """The expectation form: bounds are inclusive and missing values pass a
    bound check."""

    def outside(c: str, low: float, high: float | None = None) -> Column:
        value = F.col(c)
        bad = value < low
        if high is not None:
            bad = bad | (value > high)
        return _hits(~_gone(df, c) & bad)

    counts = {f"not_null_{c}": _hits(_gone(df, c)) for c in ("symbol", "date", "close")}
    counts["between_close"] = outside("close", 0)
    counts["between_volume"] = outside("volume", 0)
    counts["between_rsi_14"] = outside("rsi_14", 0, 100)
    return _run(df, counts)


def validate_headlines(df: DataFrame) -> DataFrame:
    """The suite of scored news: every row has a symbol, a date and a headline, scores lie in
    their ranges, and no symbol has a headline twice on a day."""
    counts = {f"no_nulls_{c}": _hits(F.col(c).isNull()) for c in ("symbol", "date", "headline")}
    counts["headline_filled"] = _hits(F.trim("headline") == "")
    counts["compound_range"] = _hits(F.abs("sentiment_compound") > 1)
    repeats = F.count(F.lit(1)) - F.count_distinct("headline")
    totals = df.groupBy("symbol", "date").agg(repeats.alias("no_repeats"), *[c.alias(n) for n, c in counts.items()]).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in (*counts, "no_repeats")])
    checks = [F.struct(F.lit(n).alias("check"), (F.col(n) == 0).alias("passed"), F.col(n).alias("failures"))
              for n in totals.columns]
    return totals.select(F.inline(F.array(*checks)))


def statistics(checks: DataFrame) -> DataFrame:
    """Successful and evaluated checks, and whether all passed."""
    return checks.agg(
        F.count_if("passed").alias("successful"),
        F.count(F.lit(1)).alias("evaluated"),
        F.every("passed").alias("success"),
    )


def passes(df: DataFrame, suite=validate) -> bool:
    """Gate for a job. The expectation form falls back to the lightweight one
    when its columns are absent; input that cannot be read fails."""
    try:
        return bool(statistics(suite(df)).first()["success"])
    except (AnalysisException, MissingColumn):
        return False if suite is validate else passes(df, validate)


def path_passes(spark, path: str, suite=validate) -> bool:
    try:
        return passes(spark.read.parquet(path), suite)
    except AnalysisException:
        return False
