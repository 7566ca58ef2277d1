"""Session helpers: shared folder for cut points, and a local session for tests and bench."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_WRITTEN: set[str] = set()  # scratch paths of this process that still exist


def _conf(spark: SparkSession, key: str) -> str | None:
    return spark.sparkContext.getConf().get(key) or spark.conf.get(key, None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode when none is named."""
    path = _conf(spark, "spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    path = tempfile.mkdtemp(prefix="lexiloom-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed at the end of the process if not before."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.add(path)
    return path


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for what runs inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back: the result survives lost executors,
    is computed once, and carries real size statistics into later joins. The shuffle files of its plan go once it is written, as
    nobody reads them again; otherwise they stay until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    with settings(spark, **{CLEANUP: "true"}):
        df.write.parquet(path, compression="zstd")
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def _delete(path: str) -> None:
    jvm, conf = SparkContext._active_spark_context._jvm, SparkContext._active_spark_context._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(conf).delete(place, True)
    _WRITTEN.discard(path)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables made by ``cut`` that no later plan reads, such as the earlier round of a loop. Others are left alone."""
    for df in tables:
        path = None if df is None else vars(df).get("scratch")
        if path in _WRITTEN:
            _delete(path)


@atexit.register
def discard_all() -> None:
    """Delete every scratch path of this process that is left; nothing to do once the session has been stopped."""
    if SparkContext._active_spark_context is not None:
        for path in list(_WRITTEN):
            _delete(path)


BATCH_CONF, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers by 8 MB, unless the session has a bound of its own: a row may be a block of vectors,
    and several workers share an executor's memory."""
    if spark.conf.get(BATCH_CONF) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores; leaves larger scans alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def local_session(cores: int | str = 8, app: str = "lexiloom") -> SparkSession:
    """Local session used by the tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
