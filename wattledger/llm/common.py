"""What the operators of this subpackage share: words, shingles, tables, scratch."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattledger.session import scratch_path, settle

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
#: Near-duplicate operators compare shingles of so many words.
SHINGLE_WORDS = 5
SIMILAR = 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written once to the folder that driver and executors share.

    The planner knows the size of the files, so joins with a stored result are
    broadcast only below its threshold, and a lost executor costs a re-read.
    """
    return settle(df, label)


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder in the shared scratch space, as a URI with a scheme."""
    path = scratch_path(spark, label)
    return path if ":/" in path else f"file://{path}"


def words(text: Column) -> Column:
    """Lower-case words of a text; an empty array for null and blank texts."""
    trimmed = F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACE_CHARS))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE)).otherwise(
        F.array().cast("array<string>")
    )


def shingles(docs: DataFrame, text: str, make, name: str) -> DataFrame:
    """Adds ``make`` of every run of five words, in order; null below five words.

    The words come out of a generator of one row: as a plain column, the optimizer would
    write them into the function that runs for each shingle wherever a filter is pushed
    down, and the text would be split again for each.
    """
    held = unused("words")
    size = F.size(held)
    runs = F.transform(
        F.sequence(F.lit(1), size - (SHINGLE_WORDS - 1)),
        lambda at: make(F.slice(F.col(held), at, SHINGLE_WORDS)),
    )
    return (
        docs.select("*", F.explode(F.array(words(F.col(text)))).alias(held))
        .withColumn(name, F.when(size >= SHINGLE_WORDS, runs))
        .drop(held)
    )


def unused(*taken: str) -> str:
    """A column name that no table brings along."""
    return f"{'_'.join(taken)}_{uuid.uuid4().hex[:12]}"
