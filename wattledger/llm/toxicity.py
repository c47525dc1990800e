"""Toxicity: a learned lexicon, matched with misspellings, scored in context.

The lexicon is what the training rows show: beginnings of words, or whole words, that
toxic documents have far more often than others. Its terms form a trie; a Levenshtein
automaton runs over it, so that a word is matched against all terms at once: it hits a term
that it begins with, or one that it misspells within the edits the term's length allows.
The product of trie and automaton is made deterministic as it is used, and most words die in
it after a few letters. Around each hit a window of words tells quotation from abuse. A
logistic regression of these counts gives the score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattledger.llm.common import stored
from wattledger.llm.labelled import sampled

#: Labelled rows that the model is fitted on at most, chosen by a hash of id and text.
FIT_ROWS = 10_000
#: The share of the best term's evidence that each term must have.
EVIDENCE_SHARE = 0.05
LEAST_EVIDENCE = 8.0
#: How many of the terms with some evidence or more may be expected by chance.
CHANCE_SHARE = 0.5
#: Letters of the beginnings that may become terms, and of whole words. Longer words are
#: found by their beginnings.
STEM_LETTERS = range(4, 9)
TERM_LETTERS = range(3, 41)
#: Words on either side of a hit that are its context.
CONTEXT = 8
REJECT_SCORE = 0.7
#: Words whose match a worker remembers at most.
REMEMBERED = 150_000

QUOTE_MARKS = "\"“”„«»"
REPORTING = frozenset("said says wrote writes quote quoted called calling claimed asked replied".split())
ADDRESS = frozenset("you your you're u tu vous toi du dich ihr tú usted eres".split())


def core(word: str) -> str:
    """The word from its first to its last letter; both ends are looked at once."""
    if word.isalpha():
        return word
    start, end = 0, len(word)
    while start < end and not _is_letter(word[start]):
        start += 1
    while end > start and not _is_letter(word[end - 1]):
        end -= 1
    return word[start:end]


def _is_letter(c: str) -> bool:
    """Letters, and what counts like them in words: no digits, marks or underscores."""
    return c.isalnum() and not c.isdecimal()


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class FuzzyLexicon:
    """A trie of terms with the states of a Levenshtein automaton over it.

    A state is a set of (trie node, edits so far), the fewest edits of each node. States
    are numbered as they are met and their transitions kept, so matching a word is a walk
    through a table that grows only with the lexicon.
    """

    def __init__(self, terms: list[str]):
        self.terms = terms
        self._children: list[dict[str, int]] = [{}]
        self._term_at: dict[int, int] = {}
        for number, term in enumerate(terms):
            node = 0
            for letter in term:
                if letter not in self._children[node]:
                    self._children[node][letter] = len(self._children)
                    self._children.append({})
                node = self._children[node][letter]
            self._term_at[node] = number
        self._letters = frozenset("".join(terms))
        self._most = max(map(edits_allowed, terms), default=0)
        self._numbers: dict[frozenset, int] = {}
        self._states: list[frozenset] = []
        self._moves: dict[tuple[int, str], int] = {}
        self._accepts: list[tuple[int, int] | None] = []
        self._begins: list[bool] = []
        self._start = self._number({0: 0})
        self._known: dict[str, tuple[int, int] | None] = {}

    def _number(self, edits: dict[int, int]) -> int:
        """The number of a state, after adding what skipped letters of terms lead to."""
        queue = list(edits)
        while queue:
            node = queue.pop()
            if edits[node] < self._most:
                for child in self._children[node].values():
                    if edits[node] + 1 < edits.get(child, self._most + 1):
                        edits[child] = edits[node] + 1
                        queue.append(child)
        state = frozenset(edits.items())
        if state not in self._numbers:
            self._numbers[state] = len(self._states)
            self._states.append(state)
            ends = [
                (e, self._term_at[n])
                for n, e in state
                if n in self._term_at and e <= edits_allowed(self.terms[self._term_at[n]])
            ]
            self._accepts.append(min(ends) if ends else None)
            self._begins.append(bool(ends) and min(ends)[0] == 0)
        return self._numbers[state]

    def _move(self, state: int, letter: str) -> int:
        """The next state, or -1 if no term is in reach."""
        after: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self._most and edits < after.get(node, self._most + 1):
                after[node] = edits

        for node, edits in self._states[state]:
            reach(node, edits + 1)
            for other, child in self._children[node].items():
                reach(child, edits + (other != letter))
        return self._number(after) if after else -1

    def _walk(self, word: str) -> tuple[int, int] | None:
        state = self._start
        for letter in word:
            letter = letter if letter in self._letters else "\0"
            if (found := self._moves.get((state, letter))) is None:
                found = self._moves[state, letter] = self._move(state, letter)
            if found < 0:
                return None
            state = found
            if self._begins[state]:
                break
        return self._accepts[state]

    def hits(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(position, term, edits) of the words that begin with a term or misspell one."""
        known = self._known
        if missing := set(words).difference(known):
            if len(known) > REMEMBERED:
                known.clear()
                missing = set(words)
            for word in missing:
                found = self._walk(core(word)) if self.terms else None
                known[word] = found
        return [(i, f[1], f[0]) for i, f in enumerate(map(known.__getitem__, words)) if f]


@dataclass(frozen=True)
class Hit:
    position: int
    term: str
    edits: int
    quoted: bool
    addressed: bool


def contexts(words: list[str], found: list[tuple[int, int, int]], terms: list[str]) -> list[Hit]:
    """Hits with what the words around them say.

    A hit is quoted if it is marked itself, if an odd number of quotation marks precedes
    it in its window and one follows, or if a reporting word stands before it.
    """
    hits = []
    for position, term, edits in found:
        low = max(0, position - CONTEXT)
        before, own, after = words[low:position], words[position], words[position + 1 : position + 1 + CONTEXT]
        marks = lambda part: sum(w.count(q) for w in part for q in QUOTE_MARKS)
        around = {core(w) for w in before + after}
        preceding = {core(w) for w in before}
        quoted = marks([own]) >= 2 or (marks(before) % 2 == 1 and marks([own, *after]) > 0) or bool(
            preceding & REPORTING
        )
        hits.append(Hit(position, terms[term], edits, quoted, bool(around & ADDRESS)))
    return hits


FEATURES = (
    "any_exact", "any_misspelt", "weight", "exact", "misspelt", "quoted", "addressed", "densest", "rate",
)


def features(n_words: int, hits: list[Hit], odds: dict[str, float]) -> list[float]:
    """Counts of hits, as logarithms, and their summed log odds; all 0 without hits."""
    open_hits = [h for h in hits if not h.quoted]
    exact = sum(h.edits == 0 for h in open_hits)
    at = [h.position for h in hits]
    densest, first = 0, 0
    for last in range(len(at)):
        while at[last] - at[first] > 2 * CONTEXT:
            first += 1
        densest = max(densest, last - first + 1)
    counts = (exact, len(open_hits) - exact, len(hits) - len(open_hits), sum(h.addressed for h in hits), densest)
    logs = [float(np.log1p(c)) for c in counts]
    rate = float(np.log1p(100 * len(hits) / n_words)) if n_words else 0.0
    weight = float(sum(odds[h.term] for h in open_hits))
    return [float(exact > 0), float(counts[1] > 0), weight, *logs, rate]


def _split(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass
class Model:
    """A fitted scorer: terms with their log odds, and a weight for each feature after the constant."""

    odds: dict[str, float]
    weights: list[float]

    def score(self, rows: list[list[float]]) -> np.ndarray:
        x = np.array(rows, dtype="f8").reshape(len(rows), len(FEATURES))
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _word_counts(batches):
    """(word, toxic, others): documents with a word that begins so, counted within a batch."""
    for batch in batches:
        seen: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text"), batch.column("toxic"), strict=True):
            bad = toxic.as_py()
            terms = set()
            for word in {core(w) for w in set(_split(text.as_py()))}:
                if len(word) in TERM_LETTERS:
                    terms.add(word)
                terms.update(word[:n] for n in STEM_LETTERS if n < len(word))
            for term in terms:
                seen.setdefault(term, [0, 0])[1 - bad] += 1
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(list(seen), pa.string()),
                "toxic": pa.array([c[0] for c in seen.values()], pa.int64()),
                "others": pa.array([c[1] for c in seen.values()], pa.int64()),
            }
        )


def by_chance(histogram: dict[int, int], n_toxic: int, n_others: int) -> tuple[np.ndarray, np.ndarray]:
    """(evidence, expected number) of the terms that chance alone would show, most evidence first.

    ``histogram`` has the number of words in each number of documents; by chance, a word's
    documents are toxic with the share of toxic documents. Fewer documents than training
    rows, so both arrays stay small; what chance shows less than a millionth of is left out.
    """
    share = n_toxic / (n_toxic + n_others)
    factorials = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, max(histogram, default=1) + 1)))])
    evidence, expected = [np.zeros(0)], [np.zeros(0)]
    for n, words in histogram.items():
        a = np.arange(2, n + 1)
        a = a[a * n_others > 3 * (n - a) * n_toxic]
        b = n - a
        logs = factorials[n] - factorials[a] - factorials[b] + a * np.log(share) + b * np.log1p(-share)
        number = words * np.exp(logs)
        own = 2 * (a * np.log(a / (n * share)) + b * np.log(np.maximum(b, 1) / (n * (1 - share))))
        evidence.append(own[number > 1e-6])
        expected.append(number[number > 1e-6])
    at, number = np.concatenate(evidence), np.concatenate(expected)
    order = np.argsort(-at)
    return at[order], number[order]


def above_chance(found: np.ndarray, at: np.ndarray, number: np.ndarray) -> int:
    """How many of the terms, by falling evidence ``found``, to keep: down to the last evidence
    that at most ``CHANCE_SHARE`` of the terms would reach by chance; at least the best ones."""
    upto = np.concatenate([[0.0], np.cumsum(number)])
    chance = upto[np.searchsorted(-at, -found + 1e-6, "right")]
    best = int(np.searchsorted(-found, -found[0] + 1e-6, "right")) if len(found) else 0
    places = np.searchsorted(-found, -found + 1e-6, "right")
    good = places[chance <= CHANCE_SHARE * places]
    return max(best, int(good.max(initial=0)))


def learn_terms(rows: DataFrame, n_toxic: int, n_others: int) -> dict[str, float]:
    """Terms with the most evidence for toxic documents, by a log-likelihood ratio.

    Few documents have many words that are in toxic ones only, by chance; so the evidence
    must be more than chance shows in as many words. Of terms that begin alike, the one with
    more evidence stays, of equals the longer one.
    """
    counts = rows.mapInArrow(_word_counts, "word string, toxic long, others long")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("others").alias("b"))
    counts = stored(counts, "toxic-counts")
    total = n_toxic + n_others
    part = lambda seen, share: F.when(
        seen > 0, seen * F.log(seen / ((F.col("a") + F.col("b")) * F.lit(share)))
    ).otherwise(0.0)
    evidence = 2 * (part(F.col("a"), n_toxic / total) + part(F.col("b"), n_others / total))
    purer = F.col("a") * n_others > 3 * F.col("b") * n_toxic
    found = counts.filter(purer & (F.col("a") >= 2)).select("word", "a", "b", evidence.alias("evidence"))
    found = stored(found, "toxic-terms")
    top = found.agg(F.max("evidence")).first()[0]
    if top is None:
        return {}
    least = max(LEAST_EVIDENCE, EVIDENCE_SHARE * top)
    # Few: each explains a share of the toxic documents.
    best = (
        found.filter(F.col("evidence") >= least)
        .orderBy(F.desc("evidence"), F.desc(F.length("word")), "word")
        .collect()
    )
    # A row for each number of documents, of the bounded training rows.
    words = counts.groupBy((F.col("a") + F.col("b")).alias("n")).agg(F.count(F.lit(1)).alias("words")).collect()
    chance = by_chance({r["n"]: r["words"] for r in words}, n_toxic, n_others)
    chosen: dict[str, float] = {}
    for r in best[: above_chance(np.array([r["evidence"] for r in best]), *chance)]:
        word = r["word"]
        if not any(t.startswith(word) or word.startswith(t) for t in chosen):
            odds = (r["a"] + 0.5) / (r["b"] + 0.5) * (n_others + 0.5) / (n_toxic + 0.5)
            chosen[word] = float(np.log(odds))
    return chosen


def _featured(odds: dict[str, float], keep: tuple[str, ...], finish, name: str):
    """A function for mapInArrow: ``keep``, and ``finish`` of the rows' features."""
    terms, lexicon = sorted(odds), []

    def make(batches):
        if not lexicon:
            lexicon.append(FuzzyLexicon(terms))
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = _split(text.as_py())
                rows.append(features(len(words), contexts(words, lexicon[0].hits(words), terms), odds))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), finish(rows)], names=[*keep, name]
            )

    return make


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Weights of a logistic regression (the first is the constant) by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(doc_id) -> F.Column:
    """Rows that the model never learns from: a third, by a checksum of their id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> Model:
    """A model of labelled documents that are not held out, ``most`` of them at most.

    Rows without a label, id or text teach nothing, and rows that repeat id and text count
    once; long texts are read whole. Without toxic or without other rows the
    lexicon is empty and every score is the share of toxic rows, 0 without any rows.
    """
    marked = labels.select(
        F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")
    ).filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("id")))
    marked = marked.groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = stored(sampled(docs, marked, "toxic", most, seed=7), "toxic-training")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    bad, good = seen["bad"], seen["n"] - seen["bad"]
    if not bad or not good:
        share = min(max(bad / seen["n"] if seen["n"] else 0.0, 1e-9), 1 - 1e-9)
        return Model({}, [float(np.log(share / (1 - share)))] + [0.0] * len(FEATURES))
    terms = learn_terms(rows, bad, good)
    vectors = _featured(terms, ("toxic",), lambda x: pa.array(x, pa.list_(pa.float64())), "x")
    known = rows.mapInArrow(vectors, "toxic int, x array<double>").collect()
    x = np.array([r["x"] for r in known]).reshape(len(known), len(FEATURES))
    weights = logistic(x, np.array([r["toxic"] for r in known], dtype="f8"))
    return Model(terms, [float(w) for w in weights])


def score(
    docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """The columns ``keep`` and the score of every row, whole texts scored.

    Only the text enters the score. Null and empty texts have the score of a text without
    hits. Rows are independent; extra columns are ignored; an empty table gives no rows.
    """
    make = _featured(model.odds, keep, lambda x: pa.array(model.score(x), pa.float64()), name)
    fields = docs.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"`{name}` double"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(make, schema)
