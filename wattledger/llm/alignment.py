"""Alignment of two tokenizers: which tokens of one stand for which of the other.

A text with a space before it is encoded by a byte-level BPE (A), the text alone by a
sentencepiece BPE, which adds that space itself (B). Both say where their tokens lie: A in
characters, B in bytes. These spans are the coarse cuts. Where they don't tell tokens apart
- a character that several tokens of A make up, or that B spells in single bytes - the
lengths of the decoded tokens refine them; and a cut counts only if the bytes between two of
them are the token's own. Offsets at which both have a cut part the text into groups.

Neither tokenizer merges over the place between a character and a space after it, so a text
falls into pieces there, and equal pieces are encoded and aligned once by a worker.

Counts of linked id pairs are taken over the corpus and joined back without bringing them
together anywhere: texts are worked on in chunks, a chunk's distinct pairs are numbered, and
only these go through the join.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wattledger.llm.common import stored

#: Bytes of text and rows of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21
CHUNK_ROWS = 5000
#: Pieces a worker remembers, twice at most: those met since the last turn outlive it.
REMEMBERED = 150_000
#: Longer pieces are not remembered.
SHORT = 64
#: Pieces that are aligned together, and that are encoded as one text.
TOGETHER = 25_600
JOINED = 128
#: Groups of more pairs of tokens are counted by their distinct ids.
LAID_OUT = 64

_LEADS_ASTRAY = re.compile(r"[^\S ] |  ")  # white space before a space belongs with it
_PIECE_START = re.compile(r"(?<=\S)(?= )")
_workers: dict[tuple[str, str], Aligner] = {}


def byte_alphabet() -> dict[str, int]:
    """The characters in which byte-level vocabularies are written, and their bytes.

    Printable bytes of Latin-1 stand for themselves, the others follow from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Side:
    """The tokens of some pieces by one tokenizer, one after the other.

    ``start`` and ``end`` are byte spans in the joined pieces, ``text`` is the encoded text of
    a token: one piece, or several that follow each other. ``inner`` and ``edges`` are the
    places at which texts and pieces begin, and the end.
    """

    def __init__(self, ids, start, end, text, inner: np.ndarray, edges: np.ndarray, table: list[bytes], lengths: np.ndarray):
        self.ids, n = ids, len(edges) - 1
        length = lengths[ids]
        first = np.searchsorted(text, np.arange(len(inner) - 1))
        spelled = np.cumsum(length)
        before = np.concatenate([[0], spelled])[first]
        spelled += (inner[:-1] - before)[text]
        # Several tokens share a character: their spans are empty or reach into the next.
        unclear = (end == start) | (np.append(start[1:], edges[-1:]) < end)
        self.end = np.where(unclear, spelled, end)
        begin = np.concatenate([edges[:1], self.end[:-1]])[: len(ids)]
        opens = first[first < len(ids)]
        begin[opens] = inner[:-1][text[opens]]
        self.piece = text if len(inner) == len(edges) else np.clip(np.searchsorted(edges, self.end) - 1, 0, n - 1)
        if np.any(self.piece[1:] < self.piece[:-1]):  # spans that don't fit the text at all
            self.piece, begin = np.sort(self.piece), np.full(len(ids), -1)
        own = np.bincount(self.piece, length, n) == np.diff(edges)
        np.logical_and.at(own, self.piece, (self.end - begin == length) & (begin >= edges[self.piece]))
        self.fits = own
        self.spelled = b"".join(map(table.__getitem__, ids.tolist()))

    def agrees(self, raw: bytes, edges: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which pieces the tokens spell byte by byte, with a cut after each."""
        if self.spelled == raw:
            return self.fits
        ends = np.cumsum(np.bincount(self.piece, lengths[self.ids], len(edges) - 1).astype("i8"))
        parts = zip([0, *ends[:-1].tolist()], ends.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True)
        return self.fits & np.array([self.spelled[a:b] == raw[c:d] for a, b, c, d in parts], dtype=bool)

    def only(self, kept: np.ndarray) -> None:
        at = kept[self.piece]
        self.ids, self.piece, self.end = self.ids[at], self.piece[at], self.end[at]

    def into(self, common: np.ndarray) -> None:
        self.group = np.searchsorted(common, self.end)
        self.n = np.bincount(self.group, minlength=len(common))
        self.first = np.cumsum(self.n) - self.n


def links_of(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, pair, links) of all occurrences of tokens that share a group, by piece."""
    product = a.n * b.n
    small = product <= LAID_OUT
    left = np.flatnonzero(small[a.group])
    n = b.n[a.group[left]]
    i = np.repeat(left, n)
    j = np.repeat(b.first[a.group[left]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    piece, pair, links = a.piece[i], a.ids[i] << 32 | b.ids[j], np.ones(len(i), dtype="i8")
    for g in np.flatnonzero(~small):  # long runs without a common cut: by distinct ids
        (x, m), (y, k) = (
            np.unique(s.ids[s.first[g] : s.first[g] + s.n[g]], return_counts=True) for s in (a, b)
        )
        piece = np.append(piece, np.full(len(x) * len(y), a.piece[a.first[g]]))
        pair = np.append(pair, (x[:, None] << 32 | y[None, :]).ravel())
        links = np.append(links, (m[:, None] * k[None, :]).ravel())
    order = np.lexsort((pair, piece))
    piece, pair = piece[order], pair[order]
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (piece[1:] != piece[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return piece[at], pair[at], np.add.reduceat(links[order], at) if len(at) else links


class Aligner:
    """Both tokenizers and the pieces that were aligned before."""

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        vocabulary = self._a.get_vocab(with_added_tokens=True)
        self._bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self._bytes_a[i] = bytes(alphabet[c] for c in token)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self._lengths_a, self._lengths_b = (
            np.fromiter(map(len, t), "i8", len(t)) for t in (self._bytes_a, self._bytes_b)
        )
        #: Ids as they are written within a group and at the end of its part, and where
        #: each of these four lists begins.
        na, nb = len(self._bytes_a), len(self._bytes_b)
        self._names = (0, na, 2 * na, 2 * na + nb)
        self._written = [
            b"%d%s" % (i, mark) for n, mark in ((na, b","), (na, b"|"), (nb, b","), (nb, b";")) for i in range(n)
        ]
        #: Whether texts may be encoded piece by piece.
        self.parts = not any(re.search("[^▁]▁", p) for p in pieces)
        self._new: dict[str, tuple | None] = {}
        self._old: dict[str, tuple | None] = {}

    def pieces(self, text: str) -> list[str]:
        """" " and the text in pieces that begin at a space after another character."""
        text = " " + text
        if not self.parts:
            return [text]
        if not _LEADS_ASTRAY.search(text) and text[-1] != " ":
            return [" " + p for p in text[1:].split(" ")]
        found = _PIECE_START.split(text)
        if len(found) > 1 and found[-1].isspace():  # no text of its own
            found[-2:] = ["".join(found[-2:])]
        return found

    def _align(self, pieces: list[str]) -> list[tuple | None]:
        """(tokens of A, of B, groups, links, the groups written, (pair, links) as bytes)
        of each piece; None where a tokenizer doesn't spell it.

        Pieces that end in a character are encoded many at once, since both tokenizers cut
        between them. Where that didn't come out even, they are encoded one by one.
        """
        found: dict[str, tuple | None] = {}
        ready = [p for p in pieces if not p[-1].isspace()] if self.parts else []
        for lo in range(0, len(ready), TOGETHER):
            some = ready[lo : lo + TOGETHER]
            found.update(zip(some, self._some(some, JOINED), strict=True))
        single = [p for p in pieces if found.get(p) is None]
        for lo in range(0, len(single), TOGETHER):
            some = single[lo : lo + TOGETHER]
            found.update(zip(some, self._some(some, 1), strict=True))
        return [found[p] for p in pieces]

    def _some(self, pieces: list[str], joined: int) -> list[tuple | None]:
        texts = ["".join(pieces[lo : lo + joined]) for lo in range(0, len(pieces), joined)]
        encoded = self._a.encode_batch(texts, add_special_tokens=False)
        others = self._b.encode(
            [t[1:] for t in texts], return_type="offset_mapping", return_bytes=True, num_threads=1
        )
        whole, which = "".join(texts), np.arange(len(texts))
        raw = whole.encode()
        codes = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
        wide = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000).astype("i8")
        byte_at = np.concatenate([[0], np.cumsum(wide)])
        chars = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), "i8", len(pieces)))])
        edges = byte_at[chars]
        chars = np.append(chars[:-1:joined], chars[-1:])
        inner = byte_at[chars]
        flat = lambda x: np.fromiter(chain.from_iterable(x), "i8")
        each = [e.ids for e in encoded]
        ids, spans = flat(each), flat(chain.from_iterable(e.offsets for e in encoded))
        text = np.repeat(which, [len(x) for x in each])
        a = Side(
            ids, byte_at[chars[text] + spans[0::2]], byte_at[chars[text] + spans[1::2]], text, inner, edges,
            self._bytes_a, self._lengths_a,
        )
        each = [e["ids"] for e in others]
        ids, spans = flat(each), flat(chain.from_iterable(e["offsets"] for e in others))
        text = np.repeat(which, [len(x) for x in each])
        start = inner[text] + 1  # after the space that B adds
        b = Side(ids, start + spans[0::2], start + spans[1::2], text, inner, edges, self._bytes_b, self._lengths_b)
        good = a.agrees(raw, edges, self._lengths_a) & b.agrees(raw, edges, self._lengths_b)
        a.only(good)
        b.only(good)
        common = np.intersect1d(a.end, b.end, assume_unique=True)
        a.into(common)
        b.into(common)
        owner, pair, links = links_of(a, b)
        n_links = np.bincount(owner, links, len(pieces)).astype("i8").tolist()
        n_a, n_b = (np.bincount(s.piece, minlength=len(pieces)) for s in (a, b))
        groups = np.bincount(a.piece[a.first], minlength=len(pieces)).tolist()
        # Tokens in the order in which groups are written, each with what follows it.
        order = np.empty(len(a.ids) + len(b.ids), dtype="i8")
        for side, shift, names in ((a, b.first[a.group], 0), (b, (a.first + a.n)[b.group], 2)):
            at = np.arange(len(side.ids))
            last = at == (side.first + side.n - 1)[side.group]
            order[at + shift] = side.ids + self._names[names] + last * (self._names[names + 1] - self._names[names])
        tokens = list(map(self._written.__getitem__, order.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        pairs = np.column_stack([pair, links])
        upto = np.searchsorted(owner, np.arange(len(pieces) + 1)).tolist()
        n_a, n_b, out, at = n_a.tolist(), n_b.tolist(), [], 0
        for i, fits in enumerate(good.tolist()):
            written = b"".join(tokens[at : ends[i]])[:-1]
            found = pairs[upto[i] : upto[i + 1]].tobytes()
            out.append((n_a[i], n_b[i], groups[i], n_links[i], written, found) if fits else None)
            at = ends[i]
        return out

    def aligned(self, pieces: list[str]) -> list[tuple | None]:
        """The alignment of each of some distinct pieces."""
        new, old = self._new, self._old
        missing = [p for p in pieces if p not in new]
        fresh, once = [], {}
        for p in missing:
            if p in old:
                new[p] = old[p]
            else:
                fresh.append(p)
        for p, found in zip(fresh, self._align(fresh), strict=True):
            (new if len(p) <= SHORT else once)[p] = found
        out = [new[p] if p in new else once[p] for p in pieces]
        if len(new) > REMEMBERED:
            self._old, self._new = new, {}
        return out


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _workers:
        _workers[path_a, path_b] = Aligner(path_a, path_b)
    return _workers[path_a, path_b]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_PARTS = pa.schema(
    [("chunk", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS),
     ("groups_sha256", pa.string()), ("nths", pa.binary()), ("links", pa.binary()),
     ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32()))]
)
PARTS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "nths binary, links binary, pairs array<long>, docs array<int>"
)


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, in any order, and the sum of each one's weights."""
    found = pa.table({"k": keys, "w": weights}).group_by("k", use_threads=False).aggregate([("w", "sum")])
    return found.column("k").to_numpy(), found.column("w_sum").to_numpy()


def _chunk_of(aligner: Aligner, chunk: int, ids: list, texts: list[str | None]) -> pa.RecordBatch:
    """A row for each text, and a last row with the chunk's distinct pairs.

    A text's row has the numbers of its pairs (``nths``) and how often each is linked.
    """
    number = defaultdict(count().__next__)
    ways = [list(map(number.__getitem__, aligner.pieces(t))) if t else [] for t in texts]
    found = aligner.aligned(list(number))
    if None in found:  # such texts are looked at whole: a tokenizer might spell them all the same
        for i, way in enumerate(ways):
            if any(found[k] is None for k in way):
                whole = aligner._align([" " + texts[i]])
                ways[i] = [len(found)] if whole[0] else []
                found += whole
    pieces = [f or (0, 0, 0, 0, b"", b"") for f in found]
    sizes = np.array([len(w) for w in ways])
    flat = np.fromiter(chain.from_iterable(ways), "i8", int(sizes.sum()))
    doc = np.repeat(np.arange(len(ways)), sizes)
    counts = np.array([p[:4] for p in pieces], dtype="i8").reshape(-1, 4)
    totals = [np.bincount(doc, counts[flat, c], len(ways)).astype("i8") for c in range(4)]
    written = [p[4] for p in pieces]
    hashes = [hashlib.sha256(b";".join(map(written.__getitem__, w))).hexdigest() if w else "" for w in ways]

    pair, links = np.frombuffer(b"".join(p[5] for p in pieces), "i8").reshape(-1, 2).T
    lengths = np.array([len(p[5]) // 16 for p in pieces], dtype="i8")
    first = np.cumsum(lengths) - lengths
    distinct, nth = np.unique(pair, return_inverse=True)
    # Each text's pieces once with their number, their pairs laid out, and each pair once.
    width = max(1, len(pieces))
    held, times = summed(doc * width + flat, np.ones(len(flat), dtype="i8"))
    piece = held % width
    n = lengths[piece]
    at = np.repeat(first[piece] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    many = max(1, len(distinct))
    keys, linked = summed(np.repeat(held // width, n) * many + nth[at], links[at] * np.repeat(times, n))
    order = np.argsort(keys)
    keys, linked = keys[order], linked[order]
    ends = np.searchsorted(keys, np.arange(len(ways) + 1) * many)
    nths, of_doc = (keys % many).astype("<i4"), linked.astype("<i8")
    rows = len(ways)
    cut = lambda x: [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)] + [None]
    docs = np.bincount(nths, minlength=len(distinct))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk] * (rows + 1), pa.int64()), pa.array([*ids, None], pa.int64()),
            *(pa.array([*t.tolist(), None], pa.int64()) for t in totals), pa.array([*hashes, None], pa.string()),
            pa.array(cut(nths), pa.binary()), pa.array(cut(of_doc), pa.binary()),
            pa.array([None] * rows + [distinct.tolist()], pa.list_(pa.int64())),
            pa.array([None] * rows + [docs.tolist()], pa.list_(pa.int32())),
        ],
        schema=_PARTS,
    )


def _chunks(path_a: str, path_b: str):
    """A function for mapInArrow: chunks of the (doc_id, text) rows of a task."""

    def make(batches):
        aligner, chunk = _aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(*(batch.column(c) for c in ("doc_id", "text")), strict=True):
                text = text.as_py()
                if texts and (size + len(text or "") > CHUNK_BYTES or len(texts) >= CHUNK_ROWS):
                    yield _chunk_of(aligner, chunk, ids, texts)
                    chunk, ids, texts, size = chunk + 1, [], [], 0
                ids.append(doc_id.as_py())
                texts.append(text)
                size += len(text or "")
        if texts:
            yield _chunk_of(aligner, chunk, ids, texts)

    return make


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def _counted(texts: pa.Table, pairs: pa.Table) -> pa.Table:
    """The texts of a chunk with sums over the corpus-wide counts of its pairs."""
    nth = pairs.column("nth").to_numpy()
    size = int(nth.max()) + 1 if len(nth) else 0
    docs, best = np.zeros(size, "i8"), np.zeros(size, "i8")
    docs[nth], best[nth] = pairs.column("docs").to_numpy(), pairs.column("best").to_numpy()
    sums = []
    for nths, links in zip(texts.column("nths"), texts.column("links"), strict=True):
        at, n = np.frombuffer(nths.as_py(), "<i4"), np.frombuffer(links.as_py(), "<i8")
        sums.append((int(n @ best[at]), int(n @ docs[at])))
    columns = {c: texts.column(c) for c in ("doc_id", *_COUNTS)}
    columns["n_best"] = pa.array([s[0] for s in sums], pa.int64())
    columns["count_sum"] = pa.array([s[1] for s in sums], pa.int64())
    return pa.table(columns | {"groups_sha256": texts.column("groups_sha256")})


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, docs, best): documents that hold a pair linked, and whether no pair of its A
    id is held by more. ``pair`` is A's id times 2**32 plus B's."""
    held = chunks.filter(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "docs")).alias("x"))
    counts = stored(held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.docs").alias("docs")), "pair-counts")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("most"))
    return counts.join(most, first == F.col("a")).select(
        "pair", "docs", (F.col("docs") == F.col("most")).cast("long").alias("best")
    )


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Counts, links and groups of every document; see RESULT.

    ``path_a`` names a byte-level BPE of the tokenizers library without a normalizer,
    ``path_b`` a sentencepiece model that adds a space before a text. Special tokens are plain
    text. ``n_best`` counts the links whose pair is held by as many documents as any pair of
    its A id, ``count_sum`` sums up the documents that hold each link's pair.

    Null and empty texts, and texts that a tokenizer doesn't spell byte by byte, have no
    tokens: zeros and "". Whole texts are aligned, long ones as a chunk of their own.
    Repeated rows count as documents of their own, null ids stay null; extra columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = stored(rows.mapInArrow(_chunks(path_a, path_b), PARTS), "alignment-chunks")
    marked = stored(pair_counts(chunks), "pair-marks").withColumnRenamed("pair", "marked")
    of_chunk = chunks.filter(F.col("pairs").isNotNull()).select(
        F.col("chunk").alias("of"), F.posexplode("pairs").alias("nth", "pair")
    )
    known = of_chunk.join(marked, F.col("pair") == F.col("marked")).select("of", "nth", "docs", "best")
    texts = chunks.filter(F.col("pairs").isNull()).drop("pairs", "docs")
    return texts.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(_counted, RESULT)
