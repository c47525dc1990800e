"""Benchmark decontamination: short test items found inside documents of any length.

The containment of an item in a document is the share of the item's shingles that the
document has. A MinHash signature of the document would need thousands of values to
notice a short item in a long text, so the signature is taken of the item and the
document is asked for its values: the smallest k shingle hashes of the item (its bottom-k
sketch). Items are partitioned by size, and k is set for each partition from its largest
size: an item of at most u shingles that is contained to t lacks at most (1 - t) u of
them, so one of any (1 - t) u + 1 is there. No contained item is missed, whatever the
length of the document. Candidates are then verified by exact shingle containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattledger.llm.common import SHINGLE_WORDS, SIMILAR, shingles, stored


def _joined(run: Column) -> Column:
    return F.array_join(run, " ")


def item_shingles(items: DataFrame) -> DataFrame:
    """(item, item_id, shingles, n): distinct shingles of items of five words or more."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    return (
        shingles(items, "text", _joined, "all")
        .select("item_id", F.array_distinct("all").alias("shingles"))
        .filter(F.size("shingles") > 0)
        .select(F.xxhash64("item_id", "shingles").alias("item"), "item_id", "shingles", F.size("shingles").alias("n"))
        .dropDuplicates(["item"])
    )


def sketches(items: DataFrame, least: float) -> DataFrame:
    """(hash, item): the bottom-k hashes of each item, k by its size partition."""
    largest = F.pow(F.lit(2.0), F.ceil(F.log2("n")))
    k = F.floor(largest * (1 - least) + 1e-9).cast("int") + 1
    hashes = F.transform("shingles", lambda s: F.xxhash64(F.split(s, " ")))
    # Ordered by another hash, so that which values a sketch keeps is independent of them.
    ordered = F.array_sort(
        F.transform(hashes, lambda h: F.struct(F.xxhash64(h).alias("rank"), h.alias("hash")))
    )
    kept = items.select("item", F.explode(F.slice(ordered, 1, k)).alias("kept"))
    return kept.select(F.col("kept.hash").alias("hash"), "item")


def candidates(docs: DataFrame, sketch: DataFrame) -> DataFrame:
    """(key, item) of texts that have a value of the item's sketch."""
    texts = docs.select(F.xxhash64("text").alias("key"), "text")
    hashes = shingles(texts, "text", F.xxhash64, "hashes").select(
        "key", F.explode_outer("hashes").alias("hash")
    )
    return hashes.join(sketch, "hash").select("key", "item").distinct()


def contained(docs: DataFrame, items: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_found, containment) of every contained item.

    A row for each document row and item of which the document has at least the share
    ``least`` of the distinct lower-case five-word shingles. Null and blank texts, and
    texts or items of fewer than five words, contain nothing and are contained nowhere.
    Repeated items count once, repeated documents give repeated rows, null ids stay
    null, and equal ids of different texts are judged each. Extra columns are ignored.
    Empty tables give no rows.
    """
    exact = stored(item_shingles(items), "items")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stored(candidates(docs, stored(sketches(exact, least), "sketches")), "candidates")
    shared = F.size(F.array_intersect("shingles", "own"))
    pairs = docs.join(found, F.xxhash64("text") == F.col("key")).join(exact, "item")
    return (
        shingles(pairs, "text", _joined, "own")
        .select("doc_id", "item_id", F.col("n").alias("n_shingles"), shared.alias("n_found"))
        .withColumn("containment", F.col("n_found") / F.col("n_shingles"))
        .filter(F.col("containment") >= least)
    )


def without_leaks(docs: DataFrame, items: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The documents that contain no item, with all their columns; null texts stay."""
    plain = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    leaks = stored(contained(plain, items, least).select(F.col("doc_id").alias("key")).distinct(), "leaks")
    return docs.join(leaks, F.xxhash64(docs["text"]) == leaks["key"], "left_anti")
