"""Session defaults, the shared folder and staged tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def get_spark(app_name: str = "barline", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # Call sites on every column cost more than building the plans here.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by the cluster.

    A temporary folder stands in for it only in local mode; on a cluster the
    setting is required, because a machine-local path would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_dirs:
        path = tempfile.mkdtemp(prefix="barline-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_dirs[app] = path
    return _local_dirs[app]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes: list[list[str]] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged within are deleted at the end, also after a failure. What outlives
    them must be written elsewhere by then."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, name: str, outer: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one intermediate feeds several consumers: it is computed once,
    its lineage ends at a table that outlives any executor, and each consumer
    reads only the columns it needs. It outlives the ``outer`` innermost ``staging``
    scopes. The write's shuffle files go when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if len(_scopes) > outer:
        _scopes[-1 - outer].append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before) if before is not None else spark.conf.unset(_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)
