"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "plover") -> SparkSession:
    """Local session as used by tests and ``bench.py`` (no UI, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # HotSpot never compiles a method over 8000 bytes of bytecode: a wide projection fused into one such method
        # runs interpreted, several times slower than the same projection outside whole-stage code
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PLOVER_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator (HDFS/S3/ABFS path) and we only
    read it.  Where it is unset (local tests) we create one under /tmp and
    register it, so ``checkpoint()`` and written tables share one place.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="plover-ckpt-")
        sc.setCheckpointDir(current)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (one per run, never reused)."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/plover/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder under the shared folder through Spark's own file system layer."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files stay on the executors' disks until the driver's JVM collects the plans that wrote them: have it do so now."""
    gc.collect()
    spark._jvm.System.gc()


#: Bytes of a row group of written tables.  A task reads whole row groups: with Parquet's 128 MB a file of many million
#: rows is one task's, and the other cores wait.
ROW_GROUP_BYTES = 2 << 20


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Inside the block no stage is fused into a method that HotSpot leaves interpreted (over 8000 bytes of bytecode),
    whatever the session's setting; it is set back after the block."""
    before = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, str(min(int(before), 8000)))
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, before)


def _write(df: DataFrame, path: str) -> None:
    with compiled(df.sparkSession):
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


@contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder and read back; the files go when the block ends.

    For inputs that are read many times inside the block (model fits): the plan runs
    once, a lost executor recovers from the files, and nothing stays behind.  The block runs
    with ``compiled``: the long expressions of fitted features are what it is for.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    _write(df, path)
    try:
        with compiled(spark):
            yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_path(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back; the files stay for the returned frame."""
    path = fresh_path(df.sparkSession, name)
    _write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
