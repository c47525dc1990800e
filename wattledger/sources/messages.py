"""The stream of reading messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattledger.schemas import MESSAGE


def read_kafka_messages(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int = 20_000, **options
) -> DataFrame:
    """Topic from its earliest retained offset; the checkpoint takes over on restart."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .options(**options)
        .load()
    )


def read_file_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same four columns from a directory of landed message files."""
    reader = spark.readStream.format(fmt).schema(MESSAGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
