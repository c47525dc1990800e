"""Near duplicates by BagMinHash: banded signatures, then exact multiset overlap.

Texts are multisets of lower-case five-word shingles; two are linked if their weighted
Jaccard similarity is at least the threshold. Signatures are banded, and a text that shares
a band with another is a candidate. Links are then found exactly among candidates:

1. Every bucket compares its members with one pivot, the member that shares bands with the
   most texts. Linked texts form components, so large groups of copies collapse in a
   number of comparisons that grows with their size, not its square.
2. Buckets that still hold several components may hide a link between two members that
   were not compared. Shingles of a single component cannot be part of such a link, and a
   pair of known sizes that reaches the threshold shares one of the first few shingles in
   an order that puts those first and then the rarer ones. Only pairs that share one of
   these prefixes are compared.

No pair is skipped for the size of its bucket, and no bucket is expanded into all pairs.
Equal texts are one text throughout.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattledger.llm import bagminhash, rolling
from wattledger.llm.common import SHINGLE_WORDS, SIMILAR, stored, unused
from wattledger.llm.components import components
from wattledger.session import scratch_path

#: A pair at the threshold shares none of 24 bands of 5 with a chance of 7 in 100,000.
BANDS, ROWS = 24, 5
#: Sizes within this factor of each other form a class.
CLASS_FACTOR = 1.04
#: Pairs that one copy of a text is compared in, about.
SPREAD = 256
KEY = pa.binary()


def text_key(text: Column) -> Column:
    """The identity of a text: 128 bits; null for null."""
    return F.unhex(F.md5(text.cast("binary")))


def _shingled(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count); a text of one to four words is one shingle."""
    words = rolling.Words(texts)
    whole = words.windows(SHINGLE_WORDS)
    inside = words.within(SHINGLE_WORDS)
    doc, element = words.doc[: len(whole)][inside], whole[inside]
    sizes = np.diff(words.first)
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE_WORDS))
    for size in np.unique(sizes[short]):
        at = short[sizes[short] == size]
        doc = np.append(doc, at)
        element = np.append(element, words.windows(int(size))[words.first[at]])
    return bagminhash.counted(doc, element)


def _lower(column) -> list[bytes]:
    return [(t or "").lower().encode() for t in column.to_pylist()]


def _sign(batches):
    for batch in batches:
        texts, keys = _lower(batch.column("text")), batch.column("key")
        for lo, hi in rolling.chunks(texts):
            doc, element, count = _shingled(texts[lo:hi])
            signature = bagminhash.signatures(doc, element, count, hi - lo, BANDS * ROWS)
            rows = signature.reshape(hi - lo, BANDS, ROWS)
            bands = np.broadcast_to(np.arange(1, BANDS + 1, dtype="u8"), (hi - lo, BANDS)).copy()
            for r in range(ROWS):
                bands = rolling.mix(bands ^ rows[:, :, r])
            full = np.flatnonzero(np.bincount(doc, minlength=hi - lo))
            flat = pa.array(bands[full].view("i8").ravel())
            ends = pa.array(np.arange(0, len(full) * BANDS + 1, BANDS, dtype="i4"))
            yield pa.RecordBatch.from_arrays(
                [keys.slice(lo, hi - lo).take(pa.array(full)), pa.ListArray.from_arrays(ends, flat)],
                names=["key", "bands"],
            )


def _bags(texts: list[bytes]):
    """For each text its (sorted shingles, counts)."""
    doc, element, count = _shingled(texts)
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [(element[a:b], count[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _verify(least: float):
    def verify(batches):
        for batch in batches:
            left, right = (_lower(batch.column(c)) for c in ("text_a", "text_b"))
            for lo in range(0, len(left), 64):
                bags = _bags(left[lo : lo + 64] + right[lo : lo + 64])
                n = len(bags) // 2
                linked = [bagminhash.overlap(bags[i], bags[n + i]) >= least for i in range(n)]
                at = pa.array(lo + np.flatnonzero(linked))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"]
                )

    return verify


@contextmanager
def keyed(texts: DataFrame, label: str):
    """(key, text) stored in buckets by key, so that joins on the key bring the other side
    to the texts. The table's entry in the catalog is dropped at the end, its files stay
    with the other intermediate results.
    """
    spark = texts.sparkSession
    name = unused(label.replace("-", "_"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, label)
    texts.write.format("parquet").option("path", path).bucketBy(buckets, "key").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of keys whose texts are similar; ``texts`` are ``keyed``.

    A text that many pairs share as their ``a`` is met in as many places as its pairs
    fill, so no task has all of them.
    """
    sizes = pairs.groupBy("a").agg(F.expr(f"(count(*) + {SPREAD - 1}) div {SPREAD}").alias("parts"))
    sizes = stored(sizes, "pair-parts")
    part = F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    spread = pairs.join(sizes.withColumnRenamed("a", "of"), F.col("a") == F.col("of")).select("a", "b", part)
    known = texts.select(F.col("key").alias("k"), "text")
    with_b = spread.join(known, F.col("b") == F.col("k")).select("a", "b", "part", F.col("text").alias("text_b"))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    with_a = sizes.join(known, F.col("a") == F.col("k")).select("a", parts, F.col("text").alias("text_a"))
    both = with_b.join(with_a, ["a", "part"])
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(least), "a binary, b binary")


def pivot_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each bucket's most central member with each of the others."""
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size"))
    central = members.join(sizes, "band").groupBy("key").agg(F.sum("size").alias("reach"))
    best = (
        members.join(stored(central, "reach"), "key")
        .groupBy("band")
        .agg(F.max(F.struct("reach", "key")).alias("best"))
        .select("band", F.col("best.key").alias("a"))
    )
    pairs = members.join(best, "band").filter(F.col("key") != F.col("a"))
    return pairs.select("a", F.col("key").alias("b")).distinct()


def _items(batches):
    """(key, label, item, count, total) of every distinct shingle."""
    for batch in batches:
        texts = _lower(batch.column("text"))
        for lo, hi in rolling.chunks(texts):
            doc, element, count = _shingled(texts[lo:hi])
            total = np.bincount(doc, weights=count, minlength=hi - lo).astype("i8")
            for part in range(0, len(doc), 100_000):
                d = doc[part : part + 100_000]
                at = pa.array(lo + d)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(at), batch.column("label").take(at),
                        pa.array(element[part : part + 100_000].view("i8")),
                        pa.array(count[part : part + 100_000].astype("i4")), pa.array(total[d]),
                    ],
                    names=["key", "label", "item", "count", "total"],
                )


def size_class(n: int) -> int:
    return int(math.log(n) / math.log(CLASS_FACTOR) + 1e-9)


def prefixes(total: int, items: np.ndarray, counts: np.ndarray, least: float):
    """(items, classes, larger) under which a text of ``total`` shingles meets its partners.

    ``items`` are its shingles that other components have, in the common order; all
    others come before them. To the class of its own size it goes as the smaller one of a
    pair; as the larger one it goes to every class a partner may have. A pair of sizes x
    >= y overlaps in least / (1 + least) * (x + y) at least, so it shares an item among
    the first x - overlap + 1 of the one and y - overlap + 1 of the other.
    """
    place = total - counts.sum() + np.cumsum(counts) - counts

    def first(overlap: float) -> int:
        return int(np.searchsorted(place, total - math.ceil(overlap - 1e-6) + 1))

    share = least / (1 + least)
    own = size_class(total)
    taken, classes = [first(share * 2 * total)], [own]
    smallest = max(1, math.ceil(least * total - 1e-6))
    for other in range(size_class(smallest), own + 1):
        size = max(smallest, math.floor(CLASS_FACTOR**other))
        taken.append(first(share * (total + size)))
        classes.append(other)
    found = [items[:n] for n in taken]
    larger = np.repeat(np.arange(len(taken)) > 0, taken)
    return np.concatenate(found), np.repeat(np.array(classes, dtype="i4"), taken), larger


def _prefix_rows(least: float):
    def make(batches):
        for batch in batches:
            lists = batch.column("items")
            flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            items, counts = (flat.field(c).to_numpy() for c in ("item", "count"))
            for i, total in enumerate(batch.column("total").to_pylist()):
                at = slice(ends[i], ends[i + 1])
                item, cls, larger = prefixes(total, items[at], counts[at].astype("i8"), least)
                for lo in range(0, len(item), 50_000):
                    part = slice(lo, lo + 50_000)
                    n = len(item[part])
                    own = pa.array([i] * n, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(own), batch.column("label").take(own),
                            pa.array([total] * n, pa.int64()), pa.array(item[part]), pa.array(cls[part]),
                            pa.array(larger[part]),
                        ],
                        names=["key", "label", "total", "item", "class", "larger"],
                    )

    return make


def hidden_pairs(members: DataFrame, texts: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """(a, b): pairs of different components that may still reach the threshold."""
    labelled = stored(
        members.join(labels, F.col("key") == F.col("node"), "left").select(
            "band", "key", F.coalesce("label", "key").alias("label")
        ),
        "labelled",
    )
    split = (
        labelled.groupBy("band")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("band")
    )
    unsettled = labelled.join(split, "band").select("key", "label").distinct()
    rows = texts.join(unsettled, "key").select("key", "label", "text")
    rows = stored(rows, "unsettled").mapInArrow(
        _items, "key binary, label binary, item long, count int, total long"
    )
    shared = (
        rows.groupBy("item")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("texts"))
        .filter(F.col("low") != F.col("high"))
        .select("item", "texts")
    )
    mine = rows.join(stored(shared, "shared-items"), "item").groupBy("key").agg(
        F.first("label").alias("label"), F.first("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("texts", "item", "count"))).alias("items"),
    )
    prefix = stored(
        mine.mapInArrow(
            _prefix_rows(least),
            "key binary, label binary, total long, item long, class int, larger boolean",
        ),
        "prefixes",
    )
    large = prefix.filter("larger").select(
        "item", "class", F.col("key").alias("a"), F.col("label").alias("la"), F.col("total").alias("na")
    )
    small = prefix.filter("not larger").select(
        "item", "class", F.col("key").alias("b"), F.col("label").alias("lb"), F.col("total").alias("nb")
    )
    meet = large.join(small, ["item", "class"]).filter(
        (F.col("la") != F.col("lb")) & (F.col("na") >= F.col("nb"))
    )
    return meet.select("a", "b").distinct()


def _members(texts: DataFrame) -> DataFrame:
    """(band, key) of every band that several texts share."""
    signed = stored(texts.select("key", "text").mapInArrow(_sign, "key binary, bands array<long>"), "signatures")
    bands = signed.select("key", F.explode("bands").alias("band"))
    shared = (
        bands.groupBy("band")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("band")
    )
    return stored(bands.join(stored(shared, "bands"), "band").select("band", "key").distinct(), "members")


def _linked(members: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """(node, label) of the texts that are linked to another one."""
    links = stored(verified(stored(pivot_pairs(members), "pivots"), texts, least), "links")
    labels = components(links)
    more = stored(verified(stored(hidden_pairs(members, texts, labels, least), "hidden"), texts, least), "links")
    return components(links.union(more))


def classes(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(key, label, class_id, first_id) of every distinct text.

    ``label`` names its class, ``class_id`` and ``first_id`` are the smallest ids of the
    class and of the text.

    Texts of one to four words are one shingle; texts without words are similar to none
    but their equals. Null texts are left out. Null ids count as larger than all others.
    """
    text = docs.select("text").filter(F.col("text").isNotNull())
    distinct = text.groupBy(text_key(F.col("text")).alias("key")).agg(F.first("text").alias("text"))
    with keyed(distinct, "distinct-texts") as all_texts:
        members = _members(all_texts)
        candidate = stored(members.select(F.col("key").alias("k")).distinct(), "candidate-keys")
        compared = all_texts.join(candidate, F.col("key") == F.col("k"), "left_semi")
        with keyed(compared, "candidate-texts") as texts:
            labels = _linked(members, texts, least)
    firsts = (
        docs.filter(F.col("text").isNotNull())
        .groupBy(text_key(F.col("text")).alias("key"))
        .agg(F.min(F.col("doc_id").cast("long")).alias("first_id"))
    )
    labelled = stored(
        firsts.join(labels, F.col("key") == F.col("node"), "left").select(
            "key", "first_id", F.coalesce("label", "key").alias("label")
        ),
        "classes",
    )
    least_id = labelled.groupBy("label").agg(F.min("first_id").alias("class_id"))
    return labelled.join(least_id, "label").select("key", "label", "class_id", "first_id")


def near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id): one row per document row with the smallest id of its class.

    Documents of equal texts share a class, however short; a null text is a class of its
    own, whose id is its document's. A class in which no row has an id has a null id.
    Extra columns are ignored; an empty table gives no rows.
    """
    found = classes(docs, least).withColumnRenamed("key", "k")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("key"))
    known = rows.filter(F.col("key").isNotNull()).join(found, F.col("key") == F.col("k"))
    alone = rows.filter(F.col("key").isNull()).select("doc_id", F.col("doc_id").alias("class_id"))
    return known.select("doc_id", "class_id").unionByName(alone)


def one_of_each(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The row with the smallest id of every class, and every row with a null text.

    All columns are kept. Of rows that repeat both id and text, one stays: the first by all
    its columns written as JSON.
    """
    found = classes(docs, least)
    chosen = found.filter(F.col("first_id").eqNullSafe(F.col("class_id"))).select(
        "label", F.col("key").alias("chosen_key"), F.col("class_id").alias("chosen_id")
    )
    # Several texts of a class may share its smallest id.
    chosen = chosen.groupBy("label").agg(F.min(F.struct("chosen_key", "chosen_id")).alias("c")).select("c.*")
    key, doc_id = text_key(docs["text"]), docs["doc_id"].cast("long")
    this, own = unused("key"), unused("id")
    counted = docs.filter(F.col("text").isNotNull()).groupBy(key.alias(this), doc_id.alias(own)).agg(
        F.count(F.lit(1)).alias("times")
    )
    kept = stored(
        counted.join(
            chosen,
            (F.col(this) == F.col("chosen_key")) & F.col(own).eqNullSafe(F.col("chosen_id")),
        ).select(this, own, "times"),
        "kept-keys",
    )
    once = kept.filter("times = 1").drop("times")
    often = stored(kept.filter("times > 1").drop("times"), "kept-repeated")
    same = (key == F.col(this)) & doc_id.eqNullSafe(F.col(own))
    row = F.struct(*[docs[c] for c in docs.columns])
    repeated = docs.join(often, same, "left_semi").groupBy("doc_id", "text").agg(
        F.min_by(row, F.to_json(row)).alias(this)
    )
    return (
        docs.join(once, same, "left_semi")
        .unionByName(repeated.select(f"{this}.*"))
        .unionByName(docs.filter(F.col("text").isNull()))
    )
