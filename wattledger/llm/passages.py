"""Substring dedup: passages of many words that occur in an earlier document.

Windows of the target length are found by doubling. At a short length, windows are not
compared one by one: each target window is represented by the least hash among the short
windows inside it, and equal target windows have equal representatives. Target windows
whose representative occurs in one text only are dropped; the others go on to twice the
length, until the target is reached, where every surviving window is compared by a 128-bit
hash. Neighbouring windows share representatives, so a level handles runs of windows.

Equal texts are one text whose id is the smallest of its documents: the windows of its
later copies all start in an earlier document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wattledger.llm import rolling
from wattledger.llm.common import stored

WINDOW = 50
#: The shortest length at which windows are compared.
SHORTEST = 20
#: Rows without an id count as later than all others.
NO_ID = (1 << 63) - 1


def level_lengths(target: int) -> list[int]:
    """Lengths below the target, each half of the next."""
    lengths = []
    while (target := -(-target // 2)) >= SHORTEST:
        lengths.append(target)
    return lengths[::-1]


def _texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... count[i] values for each i."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - count, count) + np.repeat(first, count)


def _allowed(batch, lo: int, hi: int, words: rolling.Words, n: int, window: int) -> np.ndarray:
    """Which word positions begin a window that is still a candidate."""
    inside = np.zeros(n, dtype=bool)
    whole = words.within(window)
    if "runs" not in batch.schema.names:
        inside[: len(whole)] = whole
        return inside
    runs = batch.column("runs").slice(lo, hi - lo)
    sizes = np.asarray(pc.fill_null(pc.list_value_length(runs), 0))
    flat = runs.flatten()
    first, last = (np.asarray(flat.field(k), dtype="i8") for k in ("a", "b"))
    base = np.repeat(words.first[:-1], sizes)
    at = _spread(base + first, last - first + 1)
    inside[at[at < n]] = True
    inside[: len(whole)] &= whole
    inside[len(whole) :] = False
    return inside


def _runs(length: int, window: int):
    """Runs (key, hash, a, b): windows a to b of a text, by their representative."""

    def make(batches):
        for batch in batches:
            texts, keys = _texts(batch.column("text")), batch.column("key").to_numpy()
            for lo, hi in rolling.chunks(texts):
                words = rolling.Words(texts[lo:hi])
                least = rolling.sliding_min(words.windows(length), window - length + 1)
                n = len(least)
                if not n:
                    continue
                allowed = _allowed(batch, lo, hi, words, n, window)
                doc = words.doc[:n]
                begins = np.ones(n, dtype=bool)
                begins[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | (allowed[1:] != allowed[:-1])
                start = np.flatnonzero(begins)
                end = np.append(start[1:], n) - 1
                keep = allowed[start]
                start, end = start[keep], end[keep]
                zero = words.first[doc[start]]
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": keys[lo:hi][doc[start]],
                        "hash": least[start].view("i8"),
                        "a": (start - zero).astype("i4"),
                        "b": (end - zero).astype("i4"),
                    }
                )

    return make


def _windows(window: int):
    """(h1, h2, key, id, at) of every candidate window of the target length."""

    def make(batches):
        for batch in batches:
            texts = _texts(batch.column("text"))
            keys, ids = (batch.column(c).to_numpy() for c in ("key", "first_id"))
            for lo, hi in rolling.chunks(texts):
                words = rolling.Words(texts[lo:hi])
                h1 = words.windows(window)
                other = rolling.Words(texts[lo:hi], seed=1)
                h2 = other.windows(window, base=0xDA942042E4DD58B5)
                at = np.flatnonzero(_allowed(batch, lo, hi, words, len(h1), window))
                doc = words.doc[at]
                for part in range(0, len(at), 200_000):
                    p, d = at[part : part + 200_000], doc[part : part + 200_000]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "h1": h1[p].view("i8"), "h2": h2[p].view("i8"),
                            "key": keys[lo:hi][d], "id": ids[lo:hi][d],
                            "at": (p - words.first[d]).astype("i4"),
                        }
                    )

    return make


def _kept(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def covered_words(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of the starts."""
    change = np.zeros(n + 1, dtype="i4")
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + window, n), -1)
    return np.cumsum(change[:n]) > 0


RESULT_NAMES = ("doc_id", "n_words", "n_removed", "kept_sha256", "kept")
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _settled(window: int, with_text: bool):
    """Results of texts whose removed windows are known: ``starts``, or all if ``copy``."""

    def make(batches):
        for batch in batches:
            rows = {name: [] for name in RESULT_NAMES}
            held = 0
            for i, text in enumerate(_texts(batch.column("text"))):
                words = text.split()
                n = len(words)
                if batch.column("copy")[i].as_py():
                    kept = [] if n >= window else words
                elif (starts := batch.column("starts")[i]).is_valid and len(starts):
                    gone = covered_words(n, starts.values.to_numpy().astype("i8"), window)
                    kept = [words[k] for k in np.flatnonzero(~gone)]
                else:
                    kept = words
                rows["doc_id"].append(batch.column("doc_id")[i].as_py())
                rows["n_words"].append(n)
                rows["n_removed"].append(n - len(kept))
                rows["kept_sha256"].append(_kept(kept))
                rows["kept"].append(b" ".join(kept).decode(errors="replace") if with_text else None)
                held += len(text) if with_text else 0
                if held > 32_000_000:
                    yield _batch(rows)
                    rows, held = {name: [] for name in rows}, 0
            yield _batch(rows)

    return make


def _batch(rows: dict[str, list]) -> pa.RecordBatch:
    types = {"kept_sha256": pa.string(), "kept": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, types.get(k, pa.int64())) for k, v in rows.items()], names=list(rows)
    )


#: What is carried of a document whose windows are still to be compared.
OPEN = {
    "text": pa.string(), "key": pa.int64(), "first_id": pa.int64(),
    "runs": pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])),
}
FIRST_PASS = RESULT + ", text string, key long, first_id long, runs array<struct<a int, b int>>, open boolean"


def _first_pass(window: int, with_text: bool):
    """Results of the rows that are settled, and the others as they are."""
    settled = _settled(window, with_text)

    def make(batches):
        for batch in batches:
            is_open = batch.column("open")
            for done in settled([batch.filter(pc.invert(is_open))]):
                n = done.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*done.columns, *(pa.nulls(n, t) for t in OPEN.values()), pa.array([False] * n, pa.bool_())],
                    names=[*done.schema.names, *OPEN, "open"],
                )
            rest = batch.filter(is_open)
            n, empty = rest.num_rows, _batch({k: [] for k in RESULT_NAMES})
            yield pa.RecordBatch.from_arrays(
                [
                    rest.column("doc_id"), *(pa.nulls(n, f.type) for f in list(empty.schema)[1:]),
                    *(rest.column(c) for c in OPEN), pa.array([True] * n, pa.bool_()),
                ],
                names=[*RESULT_NAMES, *OPEN, "open"],
            )

    return make


RUNS = "key long, hash long, a int, b int"
WINDOWS = "h1 long, h2 long, key long, id long, at int"


def surviving_runs(texts: DataFrame, length: int, window: int) -> DataFrame:
    """(of, runs): the runs of each text whose representative another text has, too."""
    runs = texts.mapInArrow(_runs(length, window), RUNS)
    shared = stored(
        runs.groupBy("hash")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("hash"),
        f"repeated-{length}",
    )
    mine = runs.join(shared, "hash").groupBy(F.col("key").alias("of"))
    return mine.agg(F.collect_set(F.struct("a", "b")).alias("runs"))


def deduplicate(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) of every document.

    Removed is each word covered by a run of ``window`` words that also starts in a
    document with a smaller id. Words are what ASCII white space parts, unchanged; null
    texts have none. Documents of fewer than ``window`` words lose nothing. Rows of equal
    ids don't remove each other's words; rows without an id come after all others. The
    kept words are joined by one space (null unless ``with_text``). Extra columns are
    ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("check"),
    )
    order = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    firsts = rows.groupBy("key", "check").agg(F.min(order).alias("first_id"))
    first_level, *more = level_lengths(window) or [window]
    runs = surviving_runs(rows.select("key", "text"), first_level, window)
    known = firsts.join(runs, F.col("key") == F.col("of"), "left").drop("of")
    known = stored(known, "passage-texts").withColumnsRenamed({"key": "k", "check": "c"})
    same = (F.col("key") == F.col("k")) & (F.col("check") == F.col("c"))
    all_rows = rows.join(known, same).drop("k", "c").withColumn("copy", order > F.col("first_id"))
    is_open = ~F.col("copy") & F.col("runs").isNotNull()
    # One pass over all texts: most rows are settled by it, and only the others go on.
    passed = stored(
        all_rows.withColumns({"open": is_open, "starts": F.lit(None).cast("array<int>")}).mapInArrow(
            _first_pass(window, with_text), FIRST_PASS
        ),
        "passage-rows",
    )
    done = passed.filter(~F.col("open")).select(*RESULT_NAMES)
    open_rows = passed.filter("open").select("doc_id", *OPEN)
    for length in more:
        narrowed = stored(surviving_runs(open_rows.select("key", "text", "runs"), length, window), "passage-runs")
        open_rows = stored(
            open_rows.drop("runs").join(narrowed, F.col("key") == F.col("of"), "left").drop("of"),
            "passage-candidates",
        )
    candidates = open_rows.filter(F.col("runs").isNotNull()).select("key", "first_id", "text", "runs")
    windows = candidates.mapInArrow(_windows(window), WINDOWS)
    repeated = stored(
        windows.groupBy("h1", "h2")
        .agg(F.min("id").alias("earliest"), F.max("id").alias("latest"))
        .filter(F.col("earliest") < F.col("latest"))
        .drop("latest"),
        f"repeated-{window}",
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(F.col("id") > F.col("earliest"))
    starts = later.groupBy(F.col("key").alias("of"), F.col("id").alias("of_id")).agg(
        F.collect_set("at").alias("starts")
    )
    last = open_rows.join(
        starts, (F.col("key") == F.col("of")) & (F.col("first_id") == F.col("of_id")), "left"
    )
    last = last.select("doc_id", "text", "starts", F.lit(False).alias("copy"))
    return done.unionByName(last.mapInArrow(_settled(window, with_text), RESULT))
