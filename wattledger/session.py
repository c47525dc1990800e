"""Session helpers: zone pinning and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event time, day boundaries and windows are all defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh directory under the folder all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local master may
    go without the setting: elsewhere each executor would write to a disk of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wattledger-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write an intermediate result once to shared storage and read it back.

    Used where several branches need the same expensive rows: the branches then
    scan only the columns they use, and a lost executor costs a re-read instead of
    the whole upstream computation.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Run jobs that don't need each other at the same time, and return their results.

    A job's last tasks leave cores idle, which the next job's tasks take. All have ended
    when this returns; the first failure in the order of the jobs is raised.
    """
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


class Scratch:
    """Settled results of one job, removed when the job is over."""

    def __init__(self, spark: SparkSession):
        self._spark, self._paths = spark, []

    def settle(self, df: DataFrame, label: str) -> DataFrame:
        self._paths.append(scratch_path(self._spark, label))
        return settle(df, label, self._paths[-1])

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self._paths:
            directory = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            fs = directory.getFileSystem(self._spark._jsc.hadoopConfiguration())
            fs.delete(directory, True)


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state off the heap; call before the first start of a query."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
