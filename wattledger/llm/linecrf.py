"""Document quality from lines: a linear-chain conditional random field.

Every line is good or bad. What speaks for either are features of the line and of its two
neighbours; how lines follow each other is learned as well. Forward and backward messages
give each line the probability of being good given the whole document, and a document's
quality is the mean of its lines' probabilities, weighted by their lengths in characters.
That mean is mapped to a probability of the label by a logistic curve.

Messages are products of 2 x 2 matrices. All prefixes and suffixes are built by doubling
spans over all lines of a batch at once, so documents of any length take a number of
passes that grows with the logarithm of the longest.

The model is fitted on a bounded sample of labelled documents, see ``fit``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattledger.llm import rolling
from wattledger.llm.common import stored
from wattledger.llm.labelled import sampled
from wattledger.llm.toxicity import logistic

#: Labelled documents, and lines of them, that the model is fitted on at most.
FIT_ROWS = 5000
FIT_LINES = 20_000
ACCEPTED = 0.3
ROUNDS = 150
PENALTY = 1e-4
#: Bound of what a line says for either label, in log odds.
MOST_EMISSION = 20.0

FEATURES = (
    "empty", "words", "letters", "capitals", "digits", "marks", "symbols", "word length",
    "symbol ends", "double ends", "lone symbols", "same as before", "distinct", "sentence end", "same line",
)
_OTHER, _LETTER, _CAPITAL, _DIGIT, _MARK, _SYMBOL = range(6)
_KIND = np.full(256, _SYMBOL, dtype="u1")
_KIND[[0x20, *range(0x09, 0x0E)]] = _OTHER
_KIND[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
_KIND[ord("A") : ord("Z") + 1] = _CAPITAL
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = _MARK


def line_features(lines: list[bytes], start_of_text: np.ndarray) -> np.ndarray:
    """Features of each line by itself, lines x FEATURES. The lines of a text follow each
    other, and ``start_of_text`` marks the first of each."""
    n = len(lines)
    words = rolling.Words(lines)
    data, count = words._data, np.diff(words.first)
    some, per = np.maximum(count, 1), lambda x: np.bincount(words.doc, x, n)
    kinds = _KIND[data[: int(words.offsets[-1])]]
    of_kind = []
    for kind in (_LETTER, _CAPITAL, _DIGIT, _MARK, _SYMBOL):
        sums = np.concatenate([[0], np.cumsum(kinds == kind)])
        of_kind.append(np.diff(sums[words.offsets]))
    letters, capitals, digits, marks, symbols = of_kind
    length = np.maximum(sum(of_kind), 1)
    last, before = kinds[words.end - 1], kinds[np.maximum(words.end - 2, 0)]
    long = words.end - words.start >= 2
    punctuation = (last == _MARK) | (last == _SYMBOL)
    again = np.zeros(len(words.hash), dtype=bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    order = np.lexsort((words.hash, words.doc))
    doc, value = words.doc[order], words.hash[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    # The line as a whole: the sum of its words mixed with their places.
    place = np.arange(len(words.hash)) - words.first[words.doc]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(rolling.mix(words.hash + place.astype("u8")))])
    whole = sums[words.first[1:]] - sums[words.first[:-1]]
    same = np.zeros(n, dtype=bool)
    same[1:] = (whole[1:] == whole[:-1]) & (count[1:] > 0) & ~start_of_text[1:]
    ends = np.zeros(n, dtype=bool)
    full = np.flatnonzero(count)
    ends[full] = last[words.first[full + 1] - 1] == _MARK
    return np.column_stack(
        [
            count == 0, np.log1p(count), letters / length, capitals / np.maximum(letters + capitals, 1),
            digits / length, marks / length, symbols / length, per(np.log1p(words.end - words.start)) / some,
            per(last == _SYMBOL) / some, per(long & punctuation & ((before == _MARK) | (before == _SYMBOL))) / some,
            per(~long & punctuation) / some, per(again) / some,
            np.bincount(doc[new], minlength=n) / some, ends, same,
        ]
    ).astype("f8")


def weights_of(lines: list[bytes]) -> np.ndarray:
    """Characters of each line that are not white space, in bytes."""
    return np.array([len(x.translate(None, b" \t\n\x0b\x0c\r")) for x in lines], dtype="f8")


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the lines before and after it, and whether there are any.

    ``first`` are the places at which texts begin, and the number of lines.
    """
    n = len(x)
    has_before, has_after = np.ones(n, dtype=bool), np.ones(n, dtype=bool)
    full = np.diff(first) > 0  # texts without lines at either end have no place here
    has_before[first[:-1][full]] = False
    has_after[first[1:][full] - 1] = False
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[~has_before], after[~has_after] = 0, 0
    return np.column_stack([np.ones(n), x, before, after, ~has_before, ~has_after])


def _products(m: np.ndarray, at: np.ndarray, longest: int, backwards: bool) -> np.ndarray:
    """For each line the product of the matrices of its text up to it (or from it on).

    ``at`` counts the lines of the text before (or after) a line. Products are scaled, which
    the messages don't notice.
    """
    m, reach = m.copy(), 1
    while reach < longest:
        here = np.flatnonzero(at >= reach)
        there = here + reach if backwards else here - reach
        left, right = (m[here], m[there]) if backwards else (m[there], m[here])
        both = left @ right
        m[here] = both / both.max(axis=(1, 2), keepdims=True)
        reach *= 2
    return m


@dataclass
class Field:
    """Weights of the features for "good", of beginnings, and of labels that follow each
    other (bad, good)."""

    emission: np.ndarray
    begin: np.ndarray
    follow: np.ndarray

    def messages(self, x: np.ndarray, first: np.ndarray):
        """(forward, backward, matrices, begins): the messages of every line."""
        # Row by row: a matrix product's last bits would depend on the rows around.
        odds = np.clip((x * self.emission).sum(axis=1), -MOST_EMISSION, MOST_EMISSION)
        each = np.column_stack([np.zeros(len(x)), odds])
        sizes = np.diff(first)
        before = np.arange(len(x)) - np.repeat(first[:-1], sizes)
        after = np.repeat(sizes, sizes) - 1 - before
        begins = before == 0
        m = np.where(begins[:, None, None], self.begin[None, None, :], self.follow[None]) + each[:, None, :]
        m = np.exp(m - m.max(axis=(1, 2), keepdims=True))
        longest = int(sizes.max(initial=0))
        forward = _products(m, before, longest, False)[:, 0, :]
        # From the next line on.
        tail = _products(m, after, longest, True)
        backward = np.ones((len(x), 2))
        inner = np.flatnonzero(after > 0)
        backward[inner] = tail[inner + 1].sum(axis=2)
        return forward, backward / backward.max(axis=1, keepdims=True), m, begins

    def marginals(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The probability of each line to be good, given its text."""
        if not len(x):
            return np.zeros(0)
        forward, backward, _, _ = self.messages(x, first)
        both = forward * backward
        return both[:, 1] / both.sum(axis=1)


def train(x: np.ndarray, first: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> Field:
    """The field that fits the lines' labels best, by Adam's steps on the likelihood."""
    field = Field(np.zeros(x.shape[1]), np.zeros(2), np.zeros((2, 2)))
    label = good.astype(int)
    begins = np.zeros(len(x), dtype=bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    inner = np.flatnonzero(~begins)
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[inner - 1], label[inner]), 1)
    seen_first = np.bincount(label[begins], minlength=2)
    sizes = (x.shape[1], 2, 4)
    moment, square = np.zeros(sum(sizes)), np.zeros(sum(sizes))
    for step in range(1, rounds + 1):
        forward, backward, m, _ = field.messages(x, first)
        p = forward * backward
        p /= p.sum(axis=1, keepdims=True)
        pair = forward[inner - 1][:, :, None] * m[inner] * backward[inner][:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        gradient = np.concatenate(
            [x.T @ (good - p[:, 1]), seen_first - p[begins].sum(axis=0), (seen - pair.sum(axis=0)).ravel()]
        ) / len(x)
        now = np.concatenate([field.emission, field.begin, field.follow.ravel()])
        gradient -= PENALTY * now
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        pace = 0.1 / (1 + 3 * step / rounds)
        now += pace * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        a, b = sizes[0], sizes[0] + 2
        field = Field(now[:a], np.clip(now[a:b], -10, 10), np.clip(now[b:], -10, 10).reshape(2, 2))
    return field


@dataclass
class Model:
    """A fitted field, the scale of its features, and the curve from means to scores."""

    field: Field | None
    middle: np.ndarray
    spread: np.ndarray
    curve: tuple[float, float]
    share: float

    def lines(self, own: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.field is None:
            return np.full(len(own), self.share)
        return self.field.marginals(with_neighbours((own - self.middle) / self.spread, first), first)

    def scores(self, means: np.ndarray) -> np.ndarray:
        """Scores of weighted means; a mean that is not a number has the share of good documents."""
        if self.field is None:
            return np.full(len(means), self.share)
        known = np.where(np.isnan(means), self.share, means)
        z = self.curve[0] + self.curve[1] * _log_odds(known)
        return np.round(1 / (1 + np.exp(-z)), 12)


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _means(good: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    total = np.bincount(doc, weight, len(first) - 1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.bincount(doc, weight * good, len(first) - 1) / total


def split_lines(texts: list[str | None]) -> tuple[list[bytes], np.ndarray]:
    """The lines of all texts, and where each text's begin; null and empty texts have none."""
    parts = [t.encode().split(b"\n") if t else [] for t in texts]
    return [x for p in parts for x in p], np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("i8")


def _starts(first: np.ndarray) -> np.ndarray:
    marks = np.zeros(int(first[-1]) + 1, dtype=bool)
    marks[first] = True
    return marks[:-1]


def described(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, first) of the lines of some texts."""
    lines, first = split_lines(texts)
    if not lines:
        return np.zeros((0, len(FEATURES))), np.zeros(0), first
    return line_features(lines, _starts(first)), weights_of(lines), first


def _sampled(batches):
    """(order, quality, n_lines, features, weights) of training rows; arrays as float32."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("order", "quality", "text"))
        for order, quality, text in zip(*columns, strict=True):
            x, w, _ = described([text])
            yield pa.RecordBatch.from_pydict(
                {
                    "order": pa.array([order], pa.int64()), "quality": pa.array([quality], pa.int32()),
                    "n_lines": pa.array([len(x)], pa.int64()), "x": [x.astype("<f4").tobytes()],
                    "w": [w.astype("<f4").tobytes()],
                }
            )


def held_out(doc_id: Column) -> Column:
    """Rows that the model never learns from: a fifth, by a checksum of their id. Null for null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def sample(docs: DataFrame, labels: DataFrame, most: int, most_lines: int) -> list:
    """Labelled texts, ``most`` of them and ``most_lines`` lines at most, in the order of a hash.

    Rows that repeat an id and text count once; ids that are labelled both ways teach
    nothing. What is left out depends on the hash alone.
    """
    marked = labels.select(
        F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("quality")
    ).filter(F.col("quality").isin(0, 1) & ~held_out(F.col("id")))
    marked = marked.groupBy("id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
    texts = sampled(docs, marked.filter("quality = other").drop("other"), "quality", most, seed=11)
    made = stored(
        texts.mapInArrow(_sampled, "order long, quality int, n_lines long, x binary, w binary"), "quality-lines"
    )
    lines, upto = 0, None
    for r in made.select("order", "n_lines").orderBy("order").collect():  # of ``most`` rows
        lines += r["n_lines"]
        if lines > most_lines:
            break
        upto = r["order"]
    return made.filter(F.col("order") <= upto).orderBy("order").collect() if upto is not None else []


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, most_lines: int = FIT_LINES) -> Model:
    """A model of labelled documents that are not held out, see ``sample``.

    Every line has the label of its document. Without good or without bad documents every
    line and document scores the share of good ones, one half without any.
    """
    rows = sample(docs, labels, most, most_lines)
    quality = np.array([r["quality"] for r in rows], dtype="f8")
    share = float(quality.mean()) if len(rows) else 0.5
    width = len(FEATURES)
    if not rows or not 0 < share < 1:
        return Model(None, np.zeros(width), np.ones(width), (0.0, 1.0), min(max(share, 1e-6), 1 - 1e-6))
    x = np.concatenate([np.frombuffer(r["x"], "<f4") for r in rows]).astype("f8").reshape(-1, width)
    w = np.concatenate([np.frombuffer(r["w"], "<f4") for r in rows]).astype("f8")
    first = np.concatenate([[0], np.cumsum([r["n_lines"] for r in rows])])
    middle, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    scaled = with_neighbours((x - middle) / spread, first)
    field = train(scaled, first, np.repeat(quality, np.diff(first)))
    means = _means(field.marginals(scaled, first), w, first)
    known = ~np.isnan(means)
    curve = logistic(_log_odds(means[known])[:, None], quality[known])
    return Model(field, middle, spread, (float(curve[0]), max(float(curve[1]), 1e-3)), share)


def _scorer(model: Model):
    def make(batches):
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            for lo, hi in rolling.chunks([t or "" for t in texts]):
                x, w, first = described(texts[lo:hi])
                good = model.lines(x, first)
                lists = pa.ListArray.from_arrays(pa.array(first.astype("i4")), pa.array(good, pa.float64()))
                scores = pa.array(model.scores(_means(good, w, first)), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), lists, scores], names=["doc_id", "lines", "score"]
                )

    return make


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lines, score) of every row: each line's probability of being good, and the
    document's. Lines end at line feeds.

    Only the text enters. Null, empty and blank texts score like a text of the mean quality
    of the labelled ones; null and empty ones have no lines. Whole texts are scored.
    Rows are independent: repeated rows give repeated results, null ids stay null; extra
    columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scorer(model), "doc_id long, lines array<double>, score double")
