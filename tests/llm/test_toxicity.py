from __future__ import annotations

import itertools
import time

import numpy as np
import pytest

from wattledger.llm import labelled, toxicity
from wattledger.llm.common import table
from tests.llm.conftest import prose


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms = ["abab", "baaba", "cabbages", "bbbbbaaaaa"]
    lexicon = toxicity.FuzzyLexicon(terms)
    words = ["".join(w) for n in range(1, 8) for w in itertools.product("ab", repeat=n)]
    words += ["cabbage", "cabages", "kabbage", "xcabbages", "bbbbaaaa", "bbbbaaa", "zabab", "abaz", "cabbagesque"]
    for word in words:
        starts = [t for t in terms if word.startswith(t)]
        near = [t for t in terms if distance(word, t) <= toxicity.edits_allowed(t)]
        hit = lexicon.hits([word])
        assert bool(hit) == bool(starts or near), word
        if hit and not starts:
            assert terms[hit[0][1]] in near
            assert hit[0][2] == min(distance(word, t) for t in near)


def test_context_tells_quotation():
    words = 'he said "you idiot" and left'.split()
    (hit,) = toxicity.contexts(words, [(3, 0, 0)], ["idiot"])
    assert hit.quoted and hit.addressed
    (hit,) = toxicity.contexts("what an idiot this is".split(), [(2, 0, 0)], ["idiot"])
    assert not hit.quoted and not hit.addressed


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    return docs, toxicity.fit(docs, table(spark, "/root/testdata/sf0.01", "labels"))


def test_held_out_rows(spark, model):
    docs, fitted = model
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    rows = toxicity.score(docs, fitted).join(labels, "doc_id").filter(toxicity.held_out(labels["doc_id"])).collect()
    right = sum((r["score"] >= 0.7) == bool(r["toxic"]) for r in rows)
    assert len(rows) > 80 and right / len(rows) > 0.9
    assert not any(r["score"] >= 0.7 and not r["toxic"] for r in rows)


def test_held_out_labels_teach_nothing(spark, model):
    docs, fitted = model
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    held = toxicity.held_out(labels["doc_id"])
    flipped = labels.filter(~held).unionByName(labels.filter(held).withColumn("toxic", 1 - labels["toxic"]))
    assert toxicity.fit(docs, flipped) == fitted


def test_misspelt_terms_are_found(model):
    _, fitted = model
    lexicon = toxicity.FuzzyLexicon(sorted(fitted.odds))
    long_terms = [t for t in fitted.odds if len(t) >= 5]
    assert long_terms and all(lexicon.hits([t[:2] + t[3:]]) for t in long_terms)


def test_awkward_rows(spark, awkward, model):
    docs, fitted = model
    rows = toxicity.score(awkward, fitted).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(awkward.limit(0), fitted).count() == 0
    whole = toxicity.score(awkward, fitted, keep=tuple(awkward.columns), name="s")
    assert whole.columns == [*awkward.columns, "s"]


def test_without_training_rows(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(r["score"] < 0.01 for r in toxicity.score(awkward, toxicity.fit(awkward, none)).collect())
    one_kind = spark.createDataFrame([(6, 1), (8, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.fit(awkward, one_kind).odds == {}
    assert toxicity.fit(awkward.limit(0), one_kind).odds == {}


def test_fit_bound_is_kept(spark, documents):
    docs = documents([(i, " ".join(prose(i, 5)) + (" vilewordly" if i % 4 == 0 else "")) for i in range(400)])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels, most=120)
    assert any("vilewordly".startswith(t) for t in fitted.odds)


def test_one_id_with_most_rows_has_its_share_only(spark, documents):
    """The bound holds for rows, not ids, and repeated rows count once."""
    docs = documents([(0, f"vilewordly {i}") for i in range(300)] + [(i, f"plain words {i}") for i in range(1, 60)] * 3)
    labels = spark.createDataFrame([(i, int(i == 0)) for i in range(60)], "doc_id long, toxic int")
    marked = labels.withColumnRenamed("doc_id", "id")
    assert labelled.sampled(docs, marked, "toxic", 100, seed=7).count() == 100
    assert labelled.sampled(docs, marked, "toxic", 1000, seed=7).count() == 359
    again = labelled.sampled(docs.repartition(5), marked, "toxic", 100, seed=7)
    want = {r["text"] for r in labelled.sampled(docs, marked, "toxic", 100, seed=7).collect()}
    assert {r["text"] for r in again.collect()} == want


def test_long_words_become_terms_by_their_beginnings(spark, documents):
    docs = documents([(i, ("vile" + "x" * 60 + str(i)) if i % 2 else f"word plain{i}") for i in range(200)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    fitted = toxicity.fit(docs, labels)
    assert list(fitted.odds) == ["vilexxxx"]


def test_word_edges():
    for word, want in (("--a_b--", "a_b"), ("123", ""), ("_ü9", "ü"), ("", ""), ("don't!", "don't"), ("Ⅷ٣²", "Ⅷ٣²")):
        assert toxicity.core(word) == want
    lexicon = toxicity.FuzzyLexicon(["abab", "cabbages"])
    started = time.perf_counter()
    for word in ("a" + "1" * 1_000_000 + "b", "1" * 1_000_000, "#" * 1_000_000 + "a", "a" + "_" * 1_000_000):
        assert lexicon.hits([word]) == []
        toxicity.contexts(["x", word, "y"], [(1, 0, 0)], ["abab"])
    assert time.perf_counter() - started < 10


def test_few_training_rows_rank_held_out_ones(spark):
    """58 labelled rows, 6 of them toxic: words in two toxic ones only are chance, not evidence."""
    small = "/root/testdata/sf0.001"
    docs, labels = (table(spark, small, t) for t in ("documents", "labels"))
    fitted = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, fitted).join(labels, "doc_id").filter(toxicity.held_out(labels["doc_id"])).collect()
    bad, good = ([r["score"] for r in rows if r["toxic"] == label] for label in (1, 0))
    pairs = [(b > g) + (b == g) / 2 for b in bad for g in good]
    assert sum(pairs) / len(pairs) > 0.65
    assert not any(s >= toxicity.REJECT_SCORE for s in good)


def test_evidence_by_chance():
    """1000 words in two documents each, a tenth toxic: ten in toxic ones only are expected."""
    at, number = toxicity.by_chance({2: 1000, 5: 1}, 10, 90)
    assert list(number[at > 9]) == pytest.approx([0.00001, 0.00045, 10.0])
    found = np.array([23.0] + [2 * 2 * np.log(10)] * 12)
    assert toxicity.above_chance(found, at, number) == 1
    assert toxicity.above_chance(np.array([23.0] + [2 * 2 * np.log(10)] * 40), at, number) == 41
    assert toxicity.above_chance(found[:0], at, number) == 0
