"""Mixing sources to target weights by nested hash thresholds.

The target of a source is reached by repeating all its documents as often as fits
and giving one more copy to the documents whose hash lies below a threshold. The
threshold is found without sorting documents: sizes are summed by source and leading
hash bits, the bucket in which the budget ends is found, and only that bucket is
summed again by the next bits. Thresholds of a larger budget include those of a
smaller one, so mixes are nested, and a hash depends on its row alone, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattledger.llm.common import WORD, stored

#: Bits of the hash that each level looks at. Three levels leave a bucket of one
#: document for any corpus; the last takes what remains of the hash as its own bucket.
LEVEL_BITS = (10, 10, 10, 30)
HASH_BITS = sum(LEVEL_BITS)
#: Rows are repeated in runs of this many, so no array holds all copies of a row.
RUN = 4096


def _identity(docs: DataFrame) -> list[Column]:
    """Id, source and hash of a row; rows that agree in them are equal for the mix."""
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    mixed = F.xxhash64(doc_id, F.coalesce(F.col("text"), F.lit("")), source)
    pick = F.shiftrightunsigned(mixed, 64 - HASH_BITS)
    return [doc_id.alias("this_id"), source.alias("this_source"), pick.alias("this_pick")]


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, pick) of every document; size counts words, 0 for null."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id, source, pick = _identity(docs)
    return docs.select(
        doc_id.alias("doc_id"), source.alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), pick.alias("pick"),
    )


def rotating_weights(cycle: int = 3) -> Column:
    """1, 2, ..., cycle, 1, ... over the sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return ((F.row_number().over(order) - 1) % cycle + 1).cast("double")


def source_targets(sources: DataFrame, cap: float = 3.0) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight): weighted shares of all sizes.

    No target exceeds ``cap`` times the size of its source; what a capped source
    cannot take goes to the others by weight, until none is above. Sources that reach
    their cap are those with the smallest cap per weight, so one pass in that order
    finds the level at which all others share what is left. The table has one row for
    each source.
    """
    limit = F.col("source_size") * cap
    order = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    ) / F.sum("weight").over(onwards)
    fits = F.when(
        F.col("level") * F.col("weight") <= limit * (1 + 1e-12),
        F.struct(F.col("nth"), F.col("level")),
    )
    levels = sources.withColumns({"nth": F.row_number().over(order), "level": level})
    shared = F.min(fits).over(everything)["level"]
    return levels.withColumn("target", F.least(limit, shared * F.col("weight"))).drop("nth", "level")


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, copies, cut, left): what every document gets, and where the rest ends.

    ``copies`` whole copies go to all documents of the source, one more to those with
    ``pick`` below ``cut``; ``left`` words remain for the rows exactly at ``cut``.
    """
    whole = F.floor(F.col("target") / F.col("source_size"))
    found = targets.filter(F.col("source_size") > 0).select(
        "source",
        whole.alias("copies"),
        (F.col("target") - whole * F.col("source_size")).alias("left"),
        F.lit(0).cast("long").alias("cut"),
    )
    used = 0
    for bits in LEVEL_BITS:
        rest = HASH_BITS - used - bits
        mine = F.shiftrightunsigned(F.col("pick"), rest + bits)
        inside = rows.select(
            F.col("source").alias("s"), mine.alias("upper"), "pick", (F.col("size") * F.col("n")).alias("mass")
        )
        bucket = F.shiftrightunsigned(F.col("pick"), rest)
        counts = (
            found.join(inside, F.col("s").eqNullSafe(F.col("source")) & (F.col("upper") == F.col("cut")))
            .groupBy("source", "copies", "left", "cut", bucket.alias("bucket"))
            .agg(F.sum("mass").alias("mass"))
        )
        upto = Window.partitionBy("source").orderBy("bucket")
        counts = counts.withColumn("below", F.sum("mass").over(upto) - F.col("mass"))
        # The last bucket that begins within the budget is the one in which it ends.
        at = F.when(F.col("below") <= F.col("left"), F.struct("bucket", "below"))
        found = stored(
            counts.groupBy("source", "copies")
            .agg(F.max(at).alias("at"), F.first("left").alias("left"))
            .select(
                "source", "copies", (F.col("left") - F.col("at.below")).alias("left"),
                F.col("at.bucket").alias("cut"),
            ),
            "mix-level",
        )
        used += bits
    return found


def _planned(rows: DataFrame, cap: float) -> DataFrame:
    """Distinct rows (with ``n`` copies) and their source's plan; ``extra`` copies get one more."""
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = stored(
        source_targets(sources.withColumn("weight", rotating_weights()), cap), "mix-targets"
    )
    plan = stored(
        targets.alias("t")
        .join(
            thresholds(rows, targets).alias("c"),
            F.col("t.source").eqNullSafe(F.col("c.source")),
            "left",
        )
        .select(
            F.col("t.source").alias("s"), "source_size", "target",
            F.coalesce("copies", F.lit(0)).cast("long").alias("copies"),
            F.coalesce("cut", F.lit(0)).alias("cut"), F.coalesce("left", F.lit(0.0)).alias("left"),
        ),
        "mix-plan",
    )
    extra = (
        F.when(F.col("pick") < F.col("cut"), F.col("n"))
        .when(
            (F.col("pick") == F.col("cut")) & (F.col("size") > 0),
            F.least("n", F.round(F.col("left") / F.col("size")).cast("long")),
        )
        .otherwise(0)
    )
    joined = rows.join(plan, F.col("s").eqNullSafe(F.col("source")))
    return joined.withColumn("extra", extra.cast("long")).drop("s", "cut", "left")


def _times(rows: DataFrame, n) -> DataFrame:
    """Every row ``n`` times, numbered from 1 in ``nth``."""
    runs = rows.withColumn("many", n).filter(F.col("many") > 0).withColumn(
        "run", F.explode(F.sequence(F.lit(0), F.expr(f"(many - 1) div {RUN}")))
    )
    nth = F.explode(F.sequence(F.col("run") * RUN + 1, F.least(F.col("many"), (F.col("run") + 1) * RUN)))
    return runs.withColumn("nth", nth).drop("run", "many")


def _distinct(docs: DataFrame) -> DataFrame:
    rows = stored(sized(docs), "mix-sizes")
    return rows.groupBy("doc_id", "source", "size", "pick").agg(F.count(F.lit(1)).alias("n"))


def mix(docs: DataFrame, cap: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    Null texts have size 0 and are taken with 0 words; a null source is a source of its
    own, the last. Repeated rows are rows of their own; at the threshold itself as many
    of them get one more copy as come nearest to the budget. An empty table gives no
    rows; a corpus without words has targets of 0. Other columns are ignored. Taken
    words of a source differ from its target by less than the words of one document.
    """
    each = _times(_planned(_distinct(docs), cap), F.col("n"))
    copies = F.col("copies") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)
    return each.select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def repeated(docs: DataFrame, cap: float = 3.0) -> DataFrame:
    """The rows of the mixed corpus, with all their columns, each as often as it is taken.

    Rows that agree in id, source and text share what they are taken for: each as often as
    the copies of its source say, and the first of them, by their columns written as JSON,
    once more. Rows without words use up no budget and are kept as they are. Nulls are
    values; an empty table gives no rows.
    """
    planned = _planned(_distinct(docs), cap)
    blank = F.col("size") == 0
    plan = stored(
        planned.select(
            F.col("doc_id").alias("plan_id"), F.col("source").alias("plan_source"),
            F.col("pick").alias("plan_pick"), "n",
            F.when(blank, F.lit(1).cast("long")).otherwise(F.col("copies")).alias("each"),
            F.when(blank, F.lit(0).cast("long")).otherwise(F.col("extra")).alias("more"),
        ).filter("each * n + more > 0"),
        "mix-copies",
    )
    # Stored apart: equal rows are few, and the planner sees how few.
    many = stored(plan.filter("n > 1"), "mix-equal-rows")
    wide = docs.select(F.struct("*").alias("row"), *_identity(docs))
    same = (
        F.col("this_id").eqNullSafe(F.col("plan_id"))
        & F.col("this_source").eqNullSafe(F.col("plan_source"))
        & (F.col("this_pick") == F.col("plan_pick"))
    )
    alone = _times(wide.join(plan.filter("n = 1"), same), F.col("each") + F.col("more"))
    # Rows that agree in all columns are one row here, however often they occur.
    identity = ("this_id", "this_source", "this_pick")
    kinds = (
        wide.join(many, same)
        .withColumn("written", F.to_json("row"))
        .groupBy(*identity, "written")
        .agg(
            F.first("row").alias("row"), F.count(F.lit(1)).alias("times"),
            F.first("each").alias("each"), F.first("more").alias("more"),
        )
    )
    upto = F.sum("times").over(Window.partitionBy(*identity).orderBy("written"))
    left = F.greatest(F.lit(0), F.least("times", F.col("more") - (upto - F.col("times"))))
    several = kinds.withColumn("total", F.col("each") * F.col("times") + left)
    return alone.select("row.*").unionByName(_times(several, F.col("total")).select("row.*"))
