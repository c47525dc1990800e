"""Keyed upserts on plain files: a change log and its newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/changes"


def write_changes(rows: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Write one micro-batch of changed rows and return them as stored.

    The directory is named by the batch id and overwritten, so replaying a micro-batch
    after a failure changes nothing. Reading the result back spares callers a second
    run of the stateful query.
    """
    path = f"{_log(root)}/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read_changes(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_batch).parquet(_log(root))


def newest(changes: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = ()) -> DataFrame:
    """Last write wins: the row of the highest batch per key.

    ``order`` decides, highest first, between rows of one key in the same batch.
    """
    last = Window.partitionBy(*keys).orderBy(
        F.col("batch_id").desc(), *[F.col(c).desc() for c in order]
    )
    return (
        changes.withColumn("place", F.row_number().over(last))
        .filter(F.col("place") == 1)
        .drop("place")
    )


def compact(
    spark: SparkSession,
    root: str,
    target: str,
    schema: T.StructType,
    keys: tuple[str, ...],
    order: tuple[str, ...] = (),
    upto_batch: int | None = None,
) -> str:
    """Rewrite the newest rows into a fresh log root with one directory per last batch.

    Rows keep the batch id that wrote them, so later batches can go on being written to
    the new root. The old root is left alone for readers that are still using it.
    """
    changes = read_changes(spark, root, schema)
    if upto_batch is not None:
        changes = changes.filter(F.col("batch_id") <= upto_batch)
    kept = newest(changes, keys, order)
    kept.hint("rebalance", "batch_id").write.partitionBy("batch_id").parquet(_log(target))
    return target
