"""The lake that the checks read: built once per session and input version.

Bars are derived from the given tables by one ETL run and written to the shared
folder, as the batch job would do. Later queries scan those tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from barline.operators.cleaning import clean, derive
from barline.operators.forecast import batch_features, feature_matrix, fit
from barline.operators.indicators import features
from barline.operators.portfolio import align_positions, aligned_returns as returns_of
from barline.operators.series import index_series
from barline.session import shared_dir, stage
from barline.sinks.models import ModelStore
from barline.sources import driver_tables as given

_built: dict[tuple, DataFrame | str] = {}


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input files that bars come from."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    seen = []
    for name in ("lineitem", "supplier", "nation"):
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        status = path.getFileSystem(conf).getFileStatus(path)
        size = path.getFileSystem(conf).getContentSummary(path).getLength()
        seen.append((str(status.getPath()), size, status.getModificationTime()))
    return (spark.sparkContext.applicationId, *seen)


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    key = (name, *_version(spark, sf_dir))
    if key not in _built:
        _built[key] = stage(make(), name)
    return _built[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "raw", lambda: given.raw_bars(given.quotes(spark, sf_dir)))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "clean", lambda: clean(raw(spark, sf_dir)))


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned bars with positions and neighbouring closes."""
    return _once(
        spark, sf_dir, "indexed",
        lambda: index_series(cleaned(spark, sf_dir), neighbours=["close"]),
    )


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indexed bars with every indicator."""
    return _once(spark, sf_dir, "features", lambda: features(indexed(spark, sf_dir)))


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model features of complete rows; a fit passes over them many times."""
    return _once(spark, sf_dir, "matrix", lambda: feature_matrix(indexed(spark, sf_dir)))


def trees(spark: SparkSession, sf_dir: str) -> PipelineModel:
    """The boosted trees: fitted once, saved, and loaded by every query that scores."""
    version = hashlib.sha256(repr(_version(spark, sf_dir)).encode()).hexdigest()[:16]
    store = ModelStore(spark, f"{shared_dir(spark)}/models-{spark.sparkContext.applicationId}")
    key = ("trees", *_version(spark, sf_dir))
    if key not in _built:
        store.save(version, fit(matrix(spark, sf_dir)))
        _built[key] = version
    return store.load(_built[key])


def batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete rows of the batch model, numbered."""
    return _once(spark, sf_dir, "batch", lambda: index_series(batch_features(derive(featured(spark, sf_dir)))))


def aligned_returns(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Returns paired by position. Means, covariances and draws all read them."""
    return _once(
        spark, sf_dir, f"returns_{days}",
        lambda: returns_of(align_positions(indexed(spark, sf_dir), days)),
    )


def by_status(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """Raw bars of the line items of one status: two feeds that overlap."""
    return _once(
        spark, sf_dir, f"status_{status}",
        lambda: given.raw_bars(given.quotes(spark, sf_dir).where(f"l_linestatus = '{status}'")),
    )
