"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring. A row goes to the owner of the first point at
or after its own position; where that shard is full it goes on clockwise to the next
shard with room. The bound is tight: shards take either the floor or the ceiling of
the mean row count, so counts differ by one at most.

Who is full when depends on the order of arrival. Rows arrive in the order of a second
hash, cut into a fixed number of turns; the counts of (arc, turn) cells, a table whose
size is set by the ring and not by the data, are all that the walk around the ring needs.
Rows are then dealt within their cell only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from wattledger.llm.common import stored

VIRTUAL_NODES = 64
TURNS = 32
POSITION_BITS = 32
RUN = 4096
LAW = "rows"


class Ring:
    """Points of ``shards`` shards; a shard's points don't depend on the others."""

    def __init__(self, shards: int, nodes: int = VIRTUAL_NODES):
        points = sorted(
            (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=4).digest(), "big"), s)
            for s in range(shards)
            for v in range(nodes)
        )
        self.shards = shards
        self.positions = [p for p, _ in points]
        self.owners = [s for _, s in points]

    def arcs(self):
        """A column function: the arc, hence the first point at or after a position."""
        points = np.array(self.positions, dtype="int64")

        @F.pandas_udf("int")
        def arc(position: pd.Series) -> pd.Series:
            at = np.searchsorted(points, position.to_numpy("int64"))
            return pd.Series((at % len(points)).astype("int32"))

        return arc


def place(counts: dict[tuple[int, int], int], ring: Ring) -> list[tuple[int, int, int, int, int, int]]:
    """(arc, turn, first, last, shard, slot) pieces of cells, walking turn by turn.

    ``counts`` has the rows of each (arc, turn); a piece holds the rows numbered first
    to last - 1 of its cell, whose slots in the shard begin at ``slot``.
    """
    total = sum(counts.values())
    room = [total // ring.shards + (s < total % ring.shards) for s in range(ring.shards)]
    filled = [0] * ring.shards
    n_arcs, pieces = len(ring.owners), []
    onwards = list(range(n_arcs))  # the arc whose owner has room, as far as known

    def with_room(arc: int) -> int:
        seen = []
        while filled[ring.owners[onwards[arc]]] >= room[ring.owners[onwards[arc]]]:
            seen.append(arc)
            arc = (onwards[arc] + 1) % n_arcs
        for a in seen:
            onwards[a] = onwards[arc]
        return onwards[arc]

    for arc, turn in sorted(counts, key=lambda cell: (cell[1], cell[0])):
        first, end = 0, counts[arc, turn]
        while first < end:
            shard = ring.owners[with_room(arc)]
            n = min(end - first, room[shard] - filled[shard])
            pieces.append((arc, turn, first, first + n, shard, filled[shard]))
            filled[shard] += n
            first += n
    return pieces


def shard(docs: DataFrame, shards: int = 24, nodes: int = VIRTUAL_NODES, turns: int = TURNS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    Size is the bytes of the text plus 8. Rows with a null id have a position of their
    own by their text; null texts count as empty. Equal rows take neighbouring
    slots, as many as there are; they are counted before they are shuffled. Extra columns
    are ignored, an empty table gives no rows.
    """
    spark = docs.sparkSession
    ring = Ring(shards, nodes)
    text = F.coalesce(F.col("text"), F.lit(""))
    crc, size = F.crc32(text.cast("binary")), F.octet_length(text) + F.lit(8)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.cast("long").alias("size"), crc.cast("long").alias("text_crc32"),
    )
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    key = F.xxhash64(F.coalesce(F.col("doc_id"), F.col("text_crc32")), F.col("doc_id").isNull())
    order = F.xxhash64(F.lit(1), "doc_id", "text_crc32", "size")
    located = rows.withColumns(
        {
            "arc": ring.arcs()(F.shiftrightunsigned(key, 64 - POSITION_BITS)),
            "turn": F.pmod(order, F.lit(turns)).cast("int"),
            "order": order,
        }
    )
    located = stored(located, "ring-rows")
    counts = {
        (r["arc"], r["turn"]): r["n"]
        for r in located.groupBy("arc", "turn").agg(F.sum("n").alias("n")).collect()
    }
    pieces = spark.createDataFrame(
        place(counts, ring), "arc int, turn int, first long, last long, shard int, base long"
    )
    cell = Window.partitionBy("arc", "turn").orderBy("order", "doc_id", "text_crc32", "size")
    numbered = located.withColumn("end", F.sum("n").over(cell))
    begin = F.col("end") - F.col("n")
    dealt = numbered.join(pieces, ["arc", "turn"]).filter(
        (begin < F.col("last")) & (F.col("end") > F.col("first"))
    )
    low, high = F.greatest(begin, F.col("first")), F.least("end", "last")
    dealt = dealt.select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("base") + low - F.col("first")).alias("slot"), (high - low).alias("many"),
    )
    runs = dealt.withColumn("run", F.explode(F.sequence(F.lit(0), F.expr(f"(many - 1) div {RUN}"))))
    nth = F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("many"), (F.col("run") + 1) * RUN) - 1))
    return runs.withColumn("nth", nth).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("slot") + F.col("nth")).alias("slot")
    )
