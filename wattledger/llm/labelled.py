"""Bounded samples of labelled documents, by hashes that depend on the rows alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattledger.llm.common import stored


def sampled(docs: DataFrame, marked: DataFrame, label: str, most: int, seed: int) -> DataFrame:
    """(order, label, text) of labelled texts, ``most`` of them at most.

    ``marked`` has one (id, label) per labelled id. Rows that repeat an id and a text count
    once, null and empty texts teach nothing. If there are more, those with the smallest
    ``order``, a hash of id and text, are taken, so an id with many texts has its share only.
    """
    marked = stored(marked, f"{label}-labels")
    n = marked.count()
    if n > 2 * most:  # some ids have several texts, some none
        part = int(2 * most / n * (1 << 32))
        marked = marked.filter(F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id"), 32) < part)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text") != "")
    order = F.xxhash64(F.lit(seed + 1), "id", "text").alias("order")
    rows = stored(
        rows.join(marked, F.col("doc_id") == F.col("id")).select(order, label, "text"), f"{label}-rows"
    )
    chosen = rows.select(F.col("order").alias("at")).distinct().orderBy("at").limit(most)
    chosen = stored(chosen, f"{label}-sample")
    return rows.join(chosen, F.col("order") == F.col("at")).drop("at").dropDuplicates(["order"])
