"""Token ids as Arrow stream files of equal-length sequences with masks.

A part is a pair of files in a shared folder. ``part-N.arrows`` is an Arrow IPC stream
whose batches hold fixed-size lists: ``tokens`` (unsigned integers) and ``mask`` (true for
ids, false for the padding of the part's last sequence). All batches but the last have
the same number of sequences, hence the same length in bytes, so sequence i lies at a
computable offset and is read without copying from a memory map. ``part-N.docs.arrows``
has the ids and token counts of the part's documents. Documents are in ascending order of
id over all parts and follow each other without gaps.
"""

from __future__ import annotations

import json
import os
import string
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wattledger.llm.common import fresh_folder, stored
from wattledger.llm.rolling import chunks

SEQUENCE = 2048
SEQUENCES_A_BATCH = 64
#: Words whose ids a worker remembers, twice at most: those that were met since the last
#: turn outlive it, the others are forgotten.
REMEMBERED = 800_000
#: Bytes of text that are encoded together at most, whole words each.
CHUNK = 4_000_000
#: Bytes of short texts whose new words are encoded together.
TOGETHER = 1 << 20
#: Words of letters that are encoded as one text.
JOINED = 256
_ENDINGS = string.punctuation
# How a tokenizer splits whose words of letters stand alone.
_LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"
_encoders: dict[tuple[str, str], WordEncoder] = {}


def splits_at_space(spec: dict) -> bool:
    """Whether a tokenizer drops white space and keeps runs of letters apart, with a mark
    at the end of each, and normalizes within white space only."""
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    plain = [n for n in steps if n["type"] in ("NFC", "Lowercase")]
    spaces = [n for n in steps if n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " "]
    split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return (
        len(plain) + len(spaces) == len(steps)
        and split.get("type") == "Split" and split.get("pattern") == {"Regex": _LETTER_RUNS}
        and split.get("behavior") == "Removed" and split.get("invert") is True
        and spec["model"].get("end_of_word_suffix") == _WORD_END and spec.get("post_processor") is None
    )


class WordEncoder:
    """Encodes texts with a tokenizer of the tokenizers library.

    If its normalizer and its splitting work within white space and apart from it
    (``splits_at_space``), the ids of a text are those of its words one after the other, and
    equal words are encoded once. A run of letters is apart from the ASCII punctuation that
    follows it. Texts of any other tokenizer are encoded whole.
    """

    def __init__(self, path: str, dtype: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        self._encode, self._dtype = loaded.encode_batch_fast, np.dtype(dtype)
        self.by_word = splits_at_space(json.loads(loaded.to_str()))
        vocabulary = loaded.get_vocab(with_added_tokens=True)
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends_word[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._new: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        if not texts:
            return []
        found = [e.ids for e in self._encode(texts, add_special_tokens=False)]
        data = np.fromiter(chain.from_iterable(found), self._dtype).tobytes()
        ends = (np.cumsum([len(x) for x in found], dtype="i8") * self._dtype.itemsize).tolist()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _letter_ids(self, words: list[str]) -> list[bytes]:
        """The ids of words of letters, many of them encoded as one text and cut at the ends."""
        out, size = [], self._dtype.itemsize
        groups = [words[lo : lo + JOINED] for lo in range(0, len(words), JOINED)]
        texts = [" ".join(group) for group in groups]
        for group, encoding in zip(groups, self._encode(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, dtype=self._dtype)
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            if len(ends) != len(group) or ends[-1] != len(ids):  # not what it takes for letters
                out += self._ids(group)
                continue
            data, cuts = ids.tobytes(), (ends * size).tolist()
            out += [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
        return out

    def _learn(self, missing: list[bytes]) -> None:
        if not missing:
            return
        letters: dict[str, int] = {"": 0}
        others: dict[str, int] = {"": 0}
        parts = []
        for text in b" ".join(missing).decode(errors="replace").split(" "):
            base = text.rstrip(_ENDINGS)
            if base.isascii():
                low, plain = base.lower(), base.isalpha()
            else:
                low, plain = base, base.isalpha() and base.lower().isalpha()
            if plain:
                ending = text[len(base) :]
                parts.append((letters.setdefault(low, len(letters)), others.setdefault(ending, len(others))))
            else:
                parts.append((0, others.setdefault(text, len(others))))
        first = [b"", *self._letter_ids(list(letters)[1:])]
        last = [b"", *self._ids(list(others)[1:])]
        self._new.update(zip(missing, [first[i] + last[j] for i, j in parts], strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of UTF-8 texts, in the byte order and width of the dtype."""
        if not self.by_word:
            return self._ids([t.decode(errors="replace") for t in texts])
        out = []
        for lo, hi in chunks(texts, TOGETHER):
            if hi - lo == 1 and len(texts[lo]) > CHUNK:
                out.append(b"".join(self._of([piece])[0] for piece in _pieces(texts[lo])))
            else:
                out += self._of(texts[lo:hi])
        return out

    def _of(self, texts: list[bytes]) -> list[bytes]:
        words = [t.split() for t in texts]  # at ASCII white space only
        new, old, missing = self._new, self._old, []
        for word in set(chain.from_iterable(words)).difference(new):
            if (ids := old.get(word)) is None:
                missing.append(word)
            else:
                new[word] = ids
        self._learn(missing)
        found = [b"".join(map(new.__getitem__, w)) for w in words]
        if len(new) > REMEMBERED:
            self._old, self._new = new, {}
        return found


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces that end at white space; a longer word stays whole."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        while end < len(text) and not text[end : end + 1].isspace():
            end += 1
        yield text[start:end]
        start = end


def _encoder(path: str, dtype: str) -> WordEncoder:
    if (path, dtype) not in _encoders:
        _encoders[path, dtype] = WordEncoder(path, dtype)
    return _encoders[path, dtype]


class SequenceWriter:
    """Cuts ids into sequences and writes them batch by batch."""

    def __init__(self, sink, dtype: str, length: int):
        self._type, self._length = np.dtype(dtype), length
        self.schema = pa.schema(
            {
                "tokens": pa.list_(pa.field("item", pa.from_numpy_dtype(self._type), False), length),
                "mask": pa.list_(pa.field("item", pa.bool_(), False), length),
            }
        )
        self._stream = pa.ipc.new_stream(sink, self.schema)
        self._held: list[bytes] = []
        self._bytes = 0
        self._full = length * SEQUENCES_A_BATCH * self._type.itemsize
        self.tokens = 0

    def _write(self, ids: np.ndarray) -> None:
        n = len(ids)
        rows = -(-n // self._length)
        padded = np.zeros(rows * self._length, dtype=self._type)
        padded[:n] = ids
        mask = pa.array(np.arange(len(padded)) < n)
        self._stream.write_batch(
            pa.record_batch(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(padded), type=self.schema.field(0).type),
                    pa.FixedSizeListArray.from_arrays(mask, type=self.schema.field(1).type),
                ],
                schema=self.schema,
            )
        )

    def add(self, ids: bytes) -> None:
        self._held.append(ids)
        self._bytes += len(ids)
        self.tokens += len(ids) // self._type.itemsize
        if self._bytes >= self._full:
            data, at = b"".join(self._held), 0
            while len(data) - at >= self._full:
                self._write(np.frombuffer(data, self._type, self._full // self._type.itemsize, at))
                at += self._full
            self._held, self._bytes = [data[at:]], len(data) - at

    def close(self) -> None:
        if self._bytes:
            self._write(np.frombuffer(b"".join(self._held), self._type))
        self._stream.close()


SUMMARY = "part int, path string, n_docs long, n_tokens long"
INDEX = pa.schema({"doc_id": pa.int64(), "n_tokens": pa.int64()})


def _writer(folder: str, tokenizer: str, end_id: int, dtype: str, length: int):
    """A function for mapInArrow: one part from the (doc_id, text) rows of a task."""

    def write(batches):
        part = TaskContext.get().partitionId()
        encoder, end = _encoder(tokenizer, dtype), np.array([end_id], dtype=dtype).tobytes()
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root)
        attempt = uuid.uuid4().hex
        ending = {"tokens": ".arrows", "docs": ".docs.arrows"}
        names = {k: f"{root}/part-{part:05d}{v}" for k, v in ending.items()}
        n_docs = 0
        with (
            fs.open_output_stream(f"{names['tokens']}.{attempt}") as sink,
            fs.open_output_stream(f"{names['docs']}.{attempt}") as docs_sink,
            pa.ipc.new_stream(docs_sink, INDEX) as index,
        ):
            writer = SequenceWriter(sink, dtype, length)
            for batch in batches:
                counts = []
                texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
                for lo, hi in chunks(texts, CHUNK):
                    for ids in encoder.encode(texts[lo:hi]):
                        counts.append(len(ids) // len(end) + 1)
                        writer.add(ids + end)
                n_docs += len(counts)
                index.write_batch(
                    pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64())], schema=INDEX)
                )
            writer.close()
        # A part appears whole or not at all; a repeated attempt replaces it by the same.
        for name in names.values():
            fs.move(f"{name}.{attempt}", name)
        if n_docs:
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "path": [f"{folder}/part-{part:05d}"],
                    "n_docs": [n_docs],
                    "n_tokens": [writer.tokens],
                }
            )

    return write


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int,
    dtype: str = "<u2",
    folder: str | None = None,
    length: int = SEQUENCE,
) -> DataFrame:
    """Writes all documents and returns the parts: part, path, n_docs, n_tokens, start.

    Null texts are empty and consist of the end id. Ids ascend, null ids first; rows
    of equal ids are ordered by a hash of their text, and many of them may fill several parts.
    ``start`` counts the ids of all parts before. Extra columns are ignored; an empty
    table gives no parts. ``dtype`` must hold the ids of the vocabulary.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumns({"tie": F.xxhash64("text"), "salt": F.rand(1)})
    ordered = rows.repartitionByRange("doc_id", "tie", "salt").sortWithinPartitions("doc_id", "tie")
    parts = stored(
        ordered.select("doc_id", "text").mapInArrow(
            _writer(folder, tokenizer, end_id, dtype, length), SUMMARY
        ),
        "token-parts",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class Sequences:
    """Random access to the sequences of a part through a memory map, without copies."""

    def __init__(self, path: str):
        self._map = pa.memory_map(path)
        self._buffer = self._map.read_buffer(self._map.size())
        reader = pa.BufferReader(self._buffer)
        self.schema = pa.ipc.read_schema(reader)
        self._first = reader.tell()
        pa.ipc.read_message(reader)
        self._stride = reader.tell() - self._first

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence i; the ids are a view of the file."""
        batch, row = divmod(i, SEQUENCES_A_BATCH)
        at = self._first + batch * self._stride
        if i < 0 or at >= self._buffer.size:
            raise IndexError(i)
        message = pa.ipc.read_message(pa.BufferReader(self._buffer.slice(at)))
        if message is None:
            raise IndexError(i)
        found = pa.ipc.read_record_batch(message, self.schema)
        if row >= found.num_rows:
            raise IndexError(i)
        ids, mask = (found.column(c).slice(row, 1).flatten() for c in ("tokens", "mask"))
        return ids.to_numpy(), mask.to_numpy(zero_copy_only=False)


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(batches):
    """Documents of the parts in a batch of (path, start), from the files alone."""
    for batch in batches:
        for row in batch.to_pylist():
            yield from _read_part(row["path"], row["start"])


def _read_part(path: str, start: int):
    fs, root = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(f"{root}.docs.arrows") as source:
        index = pa.ipc.open_stream(source).read_all()
    lengths = index.column("n_tokens").to_numpy()
    ends = np.cumsum(lengths)
    checks = np.zeros(len(lengths), dtype="int64")
    doc = at = 0
    with fs.open_input_stream(f"{root}.arrows") as source:
        for batch in pa.ipc.open_stream(source):
            ids = batch.column("tokens").flatten().to_numpy()
            real = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            wide = np.ascontiguousarray(ids[: int(real.sum())], dtype="<u4")
            data, done = memoryview(wide).cast("B"), 0
            while done < len(wide):
                upto = min(len(wide), int(ends[doc]) - at)
                checks[doc] = zlib.crc32(data[4 * done : 4 * upto], int(checks[doc]))
                done = upto
                doc += at + done == ends[doc]
            at += len(wide)
    if at != (ends[-1] if len(ends) else 0) or doc != len(ends):
        raise ValueError(f"{path}: {at} ids of {doc} documents don't fit its index")
    for lo in range(0, len(ends), 10_000):
        part = slice(lo, lo + 10_000)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": index.column("doc_id").slice(lo, 10_000).combine_chunks(),
                "start": ends[part] - lengths[part] + start,
                "n_tokens": lengths[part],
                "ids_crc32": checks[part],
            }
        )


def read_documents(parts: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    placed = stored(parts.select("part", "path", "start"), "token-places")
    n = max(1, placed.count())
    return placed.repartitionByRange(n, "part").select("path", "start").mapInArrow(_read, DOCUMENTS)
