"""Which windows of the live zone table have closed, batch by batch.

A window is closed once the watermark has passed its end: no reading can enter it any more.
The watermark of a batch is the latest event time of the batches before it, less the
lateness allowed. Each batch leaves one row with the latest event time and the first window
seen so far and with the watermark up to which windows were closed, so the next batch reads
one row, and a batch that is replayed finds the same.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattledger.operators.live import LATENESS, WINDOW

PROGRESS = "first_window timestamp, last_seen timestamp, closed timestamp"


@dataclass(frozen=True)
class Closing:
    """The windows that a batch closes: those that end after ``since`` (None: since the
    first) and not after ``upto`` (None: none)."""

    first_window: datetime | None
    since: datetime | None
    upto: datetime | None

    def ends(self, spark: SparkSession, width: str = WINDOW) -> DataFrame:
        """One row: the first and the last window that closes, null if none does."""
        one = spark.createDataFrame(
            [(self.first_window, self.since, self.upto)],
            "first_window timestamp, since timestamp, upto timestamp",
        )
        step = F.expr(f"INTERVAL {width}")
        # Windows begin at whole multiples of the width from the epoch on.
        micros = F.unix_micros(F.timestamp_micros(F.lit(0)) + step)
        begin = lambda at: F.timestamp_micros(F.floor(F.unix_micros(at) / micros) * micros)
        last = begin(F.col("upto")) - step
        after = F.when(F.col("since").isNotNull(), begin(F.col("since")))
        first = F.greatest(F.col("first_window"), after)
        some = F.col("upto").isNotNull() & F.col("first_window").isNotNull() & (first <= last)
        return one.select(F.when(some, first).alias("first"), F.when(some, last).alias("last"))


def _row(spark: SparkSession, root: str, batch_id: int):
    path = f"{root.rstrip('/')}/progress/batch_id={batch_id}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(PROGRESS).parquet(path).first()


def advance(rows: DataFrame, root: str, batch_id: int, lateness: str = LATENESS) -> Closing:
    """What the batch closes; its progress row is written, or written again alike.

    ``rows`` are the batch's zone rows as stored, with ``last_seen``.
    """
    spark = rows.sparkSession
    before = _row(spark, root, batch_id - 1) if batch_id else None
    known = spark.createDataFrame(
        [(before.first_window, before.last_seen) if before else (None, None)],
        "first_window timestamp, last_seen timestamp",
    )
    seen = rows.agg(F.min("window_start").alias("first_window"), F.max("last_seen").alias("last_seen"))
    both = known.unionByName(seen).agg(
        F.min("first_window").alias("first_window"), F.max("last_seen").alias("last_seen")
    )
    watermark = F.lit(before.last_seen if before else None).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    out = both.select("first_window", "last_seen", watermark.alias("closed"))
    out.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/progress/batch_id={batch_id}")
    now = _row(spark, root, batch_id)
    return Closing(now.first_window, before.closed if before else None, now.closed)
