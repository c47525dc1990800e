"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped into buckets of similar length, and buckets are cut into blocks of a
bounded number of rows and bytes. Queries, in blocks as well, meet the bucket of the longest
vectors first; the k-th best product found there is a threshold for the rest. In every other
block a query's threshold becomes a local one: the cosine that a vector of the block's
greatest length would need. Above 1 the block holds nothing for the query. Near 1 the query's
largest coordinates bound those of its partners (coordinate pruning); otherwise vectors too
short for the threshold are left out (length pruning). Products of what remains are exact.

Blocks are packed rows of stored tables. Tasks read their pairs of blocks from these files,
so no block is copied by a shuffle or sent through the driver, however many it meets, and a
task returns the k best of all its blocks.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattledger.llm.common import stored

BUCKETS = 8
#: Rows of a block of vectors and of queries, and bytes of its components, at most.
VECTOR_ROWS, QUERY_ROWS, BLOCK_BYTES = 2048, 1024, 1 << 22
#: Bytes of components, before packing, in a file of blocks.
FILE_BYTES = 1 << 26
#: Local cosine from which coordinates are compared, and how many of them.
COORDINATE_COSINE, COORDINATES = 0.9, 4
#: Where the first coordinate leaves more than this share, products are cheaper than the others.
FEW = 0.125
#: Whole numbers up to these are exact in floats and in doubles.
EXACT_FLOAT, EXACT = 2.0**24, 2.0**53
#: Room for the rounding of lengths.
SLACK = 1 + 1e-9
BLOCK = "longest double, width int, kind string, ids binary, lengths binary, components binary"
LONG = (-(1 << 63), (1 << 63) - 1)


def scaled(batches):
    """(vec_id, length, components): whole components, floor(256 x), as bytes of longs."""
    for batch in batches:
        ids, vectors = batch.column("vec_id"), batch.column("embedding")
        flat = np.asarray(vectors.flatten(), dtype="f8") * 256.0
        whole = np.clip(np.floor(flat), -(2.0**62), 2.0**62).astype("i8")
        ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))]).astype("i8")
        length = [float(np.sqrt((whole[a:b].astype("f8") ** 2).sum())) for a, b in zip(ends, ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(length, pa.float64()), pa.array([whole[a:b].tobytes() for a, b in zip(ends, ends[1:])])],
            names=["vec_id", "length", "components"],
        )


def vectors_of(table: DataFrame) -> DataFrame:
    """The vectors that take part: with an id, and finite components only."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    return rows.mapInArrow(scaled, "vec_id long, length double, components binary")


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(parts), width), dtype="i8")
    for i, part in enumerate(parts):
        row = np.frombuffer(part, "<i8")
        out[i, : len(row)] = row
    return out


def _packed(rows: list[tuple]) -> dict[str, object]:
    """A block of (vec_id, length, components, ...) rows, in their order."""
    ids, lengths, parts = ([r[i] for r in rows] for i in range(3))
    whole = _matrix(parts, max(map(len, parts)) // 8)
    most = int(np.abs(whole).max(initial=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if most <= np.iinfo(t).max)
    return {
        "longest": max(lengths), "width": whole.shape[1], "kind": kind, "ids": np.array(ids, "<i8").tobytes(),
        "lengths": np.array(lengths, "<f8").tobytes(), "components": whole.astype(kind).tobytes(),
    }


def _unpacked(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(block["ids"], "<i8")
    whole = np.frombuffer(block["components"], block["kind"]).reshape(len(ids), block["width"])
    return ids, np.frombuffer(block["lengths"], "<f8"), whole


def _cut(batches, columns: list[str], most: int, bucket_of):
    """(bucket, rows): the rows of a task, in runs of a bucket that are a block's at most."""
    held, widest = defaultdict(list), defaultdict(int)
    for batch in batches:
        buckets = bucket_of(batch.column("length").to_numpy(zero_copy_only=False)).tolist()
        rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
        for bucket, row in zip(buckets, rows, strict=True):
            wide = max(widest[bucket], len(row[2]))
            if held[bucket] and (len(held[bucket]) >= most or wide * (len(held[bucket]) + 1) > BLOCK_BYTES):
                yield bucket, held.pop(bucket)
                wide = len(row[2])
            held[bucket].append(row)
            widest[bucket] = wide
    yield from held.items()


def _vector_blocks(edges: list[float]):
    """A function for mapInArrow: blocks of a bucket's vectors, longest first."""
    bounds, most = np.array(edges, "f8"), VECTOR_ROWS

    def run(batches):
        bucket_of = lambda length: (length[:, None] < bounds).sum(axis=1)
        for bucket, rows in _cut(batches, ["vec_id", "length", "components"], most, bucket_of):
            block = {"bucket": bucket, **_packed(sorted(rows, key=lambda r: (-r[1], r[0])))}
            yield pa.RecordBatch.from_pylist([block], schema=pa.schema(
                [("bucket", pa.int32()), ("longest", pa.float64()), ("width", pa.int32()), ("kind", pa.string())]
                + [(c, pa.binary()) for c in ("ids", "lengths", "components")]
            ))

    return run


def _query_blocks(batches):
    """Blocks of queries, with their thresholds and the least length that reaches one."""
    columns = ["vec_id", "length", "components", "threshold"]
    for _, rows in _cut(batches, columns, QUERY_ROWS, lambda length: np.zeros(len(length), "i8")):
        least = np.array([LONG[0] if r[3] is None else r[3] for r in rows], "<i8")
        length = np.array([r[1] for r in rows])
        needs = np.where((least > 0) & (length > 0), least / np.maximum(length, 1e-300), -np.inf)
        block = {"needs": float(needs.min()), "thresholds": least.tobytes()}
        block |= {f"query_{c}": v for c, v in _packed(rows).items()}
        yield pa.RecordBatch.from_pylist([block], schema=pa.schema(
            [("needs", pa.float64()), ("thresholds", pa.binary()), ("query_longest", pa.float64())]
            + [("query_width", pa.int32()), ("query_kind", pa.string())]
            + [(f"query_{c}", pa.binary()) for c in ("ids", "lengths", "components")]
        ))


def _exact(most: float):
    """The type in which products of at most this size, and their partial sums, are exact."""
    sizes = (("f4", EXACT_FLOAT), ("f8", EXACT), ("i8", 2.0**62))
    return next((kind for kind, size in sizes if most * SLACK < size), object)


def products(q: np.ndarray, v: np.ndarray, kind) -> np.ndarray:
    """Exact inner products, in the type given; those beyond a long are held at its bounds."""
    found = q.astype(kind) @ v.astype(kind).T
    return np.clip(found, *LONG).astype("i8") if kind is object else found


def pair_products(q: np.ndarray, v: np.ndarray, kind) -> np.ndarray:
    """As products, of each row with the other's row at its place, as longs."""
    if kind is object:
        return np.clip((q.astype(object) * v.astype(object)).sum(axis=1), *LONG).astype("i8")
    return np.einsum("ij,ij->i", q.astype(kind), v.astype(kind)).astype("i8")


class Best:
    """The k best products so far of each query of a block; ties to smaller ids.

    ``least`` is what a product has to reach: the k-th best known, the least long if none.
    """

    def __init__(self, ids: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.least, self.k = ids, least.copy(), k
        self.scores = np.zeros((len(ids), k), "i8")
        self.found = np.zeros((len(ids), k), "i8")
        self.held = np.zeros(len(ids), "i8")

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Products of the queries in these rows; those with a row of the own id don't count."""
        others = (ids != self.ids[rows]) & (scores >= self.least[rows])
        asked = np.unique(rows[others])
        old = np.arange(self.k) < self.held[asked][:, None]
        rows = np.concatenate([rows[others], np.repeat(asked, self.held[asked])])
        scores = np.concatenate([scores[others], self.scores[asked][old]])
        ids = np.concatenate([ids[others], self.found[asked][old]])
        order = np.lexsort((ids, ~scores, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        starts = np.searchsorted(rows, asked)
        sizes = np.diff(np.append(starts, len(rows)))
        rank = np.arange(len(rows)) - np.repeat(starts, sizes)
        kept = rank < self.k
        self.scores[rows[kept], rank[kept]] = scores[kept]
        self.found[rows[kept], rank[kept]] = ids[kept]
        self.held[asked] = np.minimum(sizes, self.k)
        full = asked[sizes >= self.k]
        self.least[full] = np.maximum(self.least[full], self.scores[full, self.k - 1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query_id, vec_id, score)"""
        real = np.arange(self.k) < self.held[:, None]
        return np.repeat(self.ids, self.held), self.found[real], self.scores[real]


def search_block(queries, vectors, best: Best) -> None:
    """Adds the products of a block of queries with one of vectors that can be among the best.

    Both are (id, length, components), the vectors longest first. Rows that cannot reach a
    threshold are left out.
    """
    qid, q_length, qs = queries
    vid, v_length, vs = vectors
    width = min(qs.shape[1], vs.shape[1])  # what one lacks is zeros
    qs, vs = qs[:, :width], vs[:, :width]
    threshold = np.where(best.least > LONG[0], best.least, -np.inf)
    reach = q_length * v_length[0]
    local = np.where(reach > 0, threshold / np.where(reach > 0, reach, 1), np.where(threshold > 0, np.inf, -np.inf))
    floor = np.where(threshold > 0, threshold / np.maximum(q_length, 1e-300) / SLACK, 0.0)
    # Vectors are ordered by length, so each query reads a head of the block.
    heads = np.searchsorted(-v_length, -floor, side="right")
    kind = _exact(float(reach.max()))
    near = (local >= COORDINATE_COSINE) & (width > 0)
    at = np.flatnonzero(near & (local <= SLACK))
    by_length = np.flatnonzero(~near & (local <= SLACK))
    if len(at):
        many = _by_coordinates(at, local, heads, (q_length, qs), (vid, v_length, vs), kind, best)
        by_length = np.concatenate([by_length, many])
    if not len(by_length):
        return
    ids = vid[: heads[by_length].max()]
    scores = products(qs[by_length], vs[: len(ids)], kind)
    own = np.flatnonzero(np.isin(ids, qid[by_length]))
    row, column = np.nonzero(qid[by_length][:, None] == ids[own])
    lowest, edge = (LONG[0], LONG) if kind in ("i8", object) else (-np.inf, (-EXACT, EXACT) if kind == "f8" else (-EXACT_FLOAT, EXACT_FLOAT))
    scores[row, own[column]] = lowest
    least = np.clip(best.least[by_length], int(edge[0]), int(edge[1])).astype(scores.dtype)
    unknown = np.flatnonzero(best.least[by_length] == LONG[0])
    if len(unknown) and len(ids) > best.k:
        least[unknown] = np.partition(scores[unknown], len(ids) - best.k, axis=1)[:, len(ids) - best.k]
    row, column = np.nonzero(scores >= least[:, None])
    best.add(by_length[row], scores[row, column].astype("i8"), ids[column])


def _by_coordinates(at: np.ndarray, local: np.ndarray, heads: np.ndarray, queries, vectors, kind, best: Best) -> np.ndarray:
    """Adds the products of these queries; returns those for which pruning leaves too much.

    Both unit vectors lie within an angle of each other: a coordinate's partner is at least
    ct - s, with c the coordinate, t the angle's cosine and s the sines' product.
    """
    q_length, qs = queries
    vid, v_length, vs = vectors
    unit = (vs / np.maximum(v_length, 1e-300)[:, None]).T.astype("f4")
    signed = np.concatenate([unit, -unit])
    direction = qs[at] / q_length[at][:, None]
    focus = np.argsort(-np.abs(direction), axis=1)[:, :COORDINATES]
    c = np.take_along_axis(direction, focus, axis=1)
    side = focus + len(unit) * (c < 0)
    t = np.minimum(local[at], 1.0)[:, None]
    low = (np.abs(c) * t - np.sqrt(np.maximum(0.0, (1 - t * t) * (1 - c**2))) - 1e-5).astype("f4")
    near = signed[side[:, 0]] >= low[:, :1]
    near &= np.arange(len(vid)) < heads[at][:, None]
    many = near.sum(axis=1) > FEW * len(vid)
    near[many] = False
    row, column = np.nonzero(near)
    for i in range(1, focus.shape[1]):
        held = signed[side[row, i], column] >= low[row, i]
        row, column = row[held], column[held]
    pairs = max(1, BLOCK_BYTES // (8 * qs.shape[1]))
    for start in range(0, len(row), pairs):
        r, v = at[row[start : start + pairs]], column[start : start + pairs]
        best.add(r, pair_products(qs[r], vs[v], kind), vid[v])
    return at[many]


def _search(k: int):
    """A function for mapInArrow: the k best of all vectors that a task's queries meet."""

    def run(batches):
        best = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: column[i].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                queries = _unpacked({c.removeprefix("query_"): row[c] for c in row if c.startswith("query_")})
                block = row["query_ids"]
                if block not in best:
                    best[block] = Best(queries[0], np.frombuffer(row["thresholds"], "<i8"), k)
                search_block(queries, _unpacked(row), best[block])
        for found in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in found.rows()], names=["query_id", "vec_id", "score"])

    return run


def _meet(queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The best products of (vec_id, length, components, threshold) queries with these blocks."""
    schema = f"needs double, thresholds binary, query_{BLOCK.replace(', ', ', query_')}"
    needs = F.when(F.col("length") > 0, F.col("threshold") / F.col("length"))
    asked = stored(queries.sortWithinPartitions(needs).mapInArrow(_query_blocks, schema), "query-blocks")
    # Each task reads one part of both tables; nothing is dealt out or broadcast.
    pairs = blocks.join(asked.hint("shuffle_replicate_nl"), F.col("needs") <= F.col("longest") * SLACK)
    return pairs.drop("bucket", "needs", "longest", "query_longest").mapInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(table: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the highest products per query.

    Components are whole, floor(256 x). Vectors without an id, null, or with null or
    non-finite components take no part; shorter vectors are filled with zeros; components
    beyond 2**62 are held there, and scores at the bounds of a long. A query never meets
    rows of its own id; an id that occurs in several rows is a candidate in each and asks
    once, with its least vector. Ties go to the smaller id. Extra columns are ignored.
    """
    vectors = stored(vectors_of(table), "vectors")
    n, size = vectors.agg(F.count("*"), F.sum(F.length("components"))).first()
    edges = (vectors.approxQuantile("length", [i / BUCKETS for i in range(1, BUCKETS)], 0.01) if n else [])
    edges = sorted(set(edges))
    tasks = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // FILE_BYTES))
    blocks = vectors.mapInArrow(_vector_blocks(edges), f"bucket int, {BLOCK}").repartition(tasks)
    blocks = stored(blocks, "vector-blocks")
    asks = vectors.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("components", "length")).alias("v"))
    asks = stored(asks.select("vec_id", "v.components", "v.length"), "queries")
    none = F.lit(None).cast("long")
    opening, rest = F.col("bucket") == 0, F.col("bucket") > 0
    first = stored(_top(_meet(asks.withColumn("threshold", none), blocks.filter(opening), k), k), "top-longest")
    if not edges:
        return first.select("query_id", "rank", "vec_id", "score")
    reached = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("threshold"))
    known = asks.join(reached, F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
    more = _meet(known, blocks.filter(rest), k)
    return _top(first.drop("rank").unionByName(more), k).select("query_id", "rank", "vec_id", "score")
