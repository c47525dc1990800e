"""The field over lines: exact marginals, held-out accuracy, awkward rows."""

from __future__ import annotations

import time
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattledger.llm import linecrf, queries
from wattledger.llm.common import table


def enumerated(field, x):
    """The marginals by summing over all labellings of one text."""
    odds = x @ field.emission
    total, good = 0.0, np.zeros(len(x))
    for labels in product((0, 1), repeat=len(x)):
        energy = field.begin[labels[0]] + sum(o for o, y in zip(odds, labels, strict=True) if y)
        energy += sum(field.follow[a, b] for a, b in zip(labels, labels[1:]))
        weight = np.exp(energy)
        total += weight
        good += weight * np.array(labels)
    return good / total


def test_marginals_are_exact():
    chance = np.random.default_rng(5)
    for _ in range(20):
        sizes = chance.integers(1, 9, size=6)
        first = np.concatenate([[0], np.cumsum(sizes)])
        x = chance.normal(size=(first[-1], 3))
        field = linecrf.Field(chance.normal(size=3), chance.normal(size=2), chance.normal(size=(2, 2)) * 2)
        want = [enumerated(field, x[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        assert np.allclose(field.marginals(x, first), np.concatenate(want), atol=1e-9)


def likelihood(field, x, first, label):
    total = 0.0
    for a, b in zip(first[:-1], first[1:], strict=True):
        odds = x[a:b] @ field.emission

        def energy(y):
            return (
                field.begin[y[0]] + odds @ np.array(y) + sum(field.follow[i, j] for i, j in zip(y, y[1:]))
            )

        total += energy(label[a:b]) - np.log(sum(np.exp(energy(y)) for y in product((0, 1), repeat=b - a)))
    return total


def test_training_raises_the_likelihood():
    chance = np.random.default_rng(6)
    first = np.arange(0, 101, 5)
    x = chance.normal(size=(100, 2))
    label = (x[:, 0] + 2 * chance.normal(size=100) > 0).astype(int)
    untrained = linecrf.Field(np.zeros(2), np.zeros(2), np.zeros((2, 2)))
    field = linecrf.train(x, first, label.astype(float))
    best = likelihood(field, x, first, label)
    assert best > likelihood(untrained, x, first, label) + 5
    for move in (0.3, -0.3):  # no neighbour is much better
        other = linecrf.Field(field.emission + move, field.begin, field.follow)
        assert likelihood(other, x, first, label) < best


def test_long_chains_are_stable_and_fast():
    chance = np.random.default_rng(7)
    n = 300_000
    field = linecrf.Field(np.array([50.0]), np.array([5.0, -5.0]), np.array([[9.0, -9.0], [-9.0, 9.0]]))
    started = time.perf_counter()
    found = field.marginals(chance.normal(size=(n, 1)), np.array([0, n]))
    assert np.isfinite(found).all() and found.min() >= 0 and found.max() <= 1
    assert time.perf_counter() - started < 30


def test_features_of_neighbours():
    x = np.arange(1.0, 6.0)[:, None]
    found = linecrf.with_neighbours(x, np.array([0, 2, 2, 5]))
    assert found[:, 2].tolist() == [0, 1, 0, 3, 4]
    assert found[:, 3].tolist() == [2, 0, 4, 5, 0]
    assert found[:, 4].tolist() == [1, 0, 1, 0, 0]
    assert found[:, 5].tolist() == [0, 1, 0, 0, 1]


def test_line_features():
    lines = [b"a good line, it is.", b"", b"of of of of", b"of of of of", b"SHOUT!! LOUD!!", b"a | b | c", b"x$$$ 12"]
    x = linecrf.line_features(lines, np.array([1, 0, 0, 0, 0, 0, 0], dtype=bool))
    of = lambda name: x[:, linecrf.FEATURES.index(name)].round(3).tolist()
    assert of("empty") == [0, 1, 0, 0, 0, 0, 0]
    assert of("same as before") == [0, 0, 0.75, 0.75, 0, 0, 0]
    assert of("distinct") == [1, 0, 0.25, 0.25, 1, 0.8, 1]
    assert of("same line") == [0, 0, 0, 1, 0, 0, 0]
    assert of("sentence end") == [1, 0, 0, 0, 1, 0, 0]
    assert of("capitals") == [0, 0, 0, 0, 1, 0, 0]
    assert of("double ends") == [0, 0, 0, 0, 1, 0, 0.5]
    assert of("lone symbols") == [0, 0, 0, 0, 0, 0.4, 0]


def test_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op11_line_quality(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(table(spark, sf_dir, "labels"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.3)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in tested) >= 0.95 * len(tested)
    assert got.count() == table(spark, sf_dir, "documents").count()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(i, i % 2, 0) for i in range(60)] + [(None, 1, 0), (7, None, 0), (8, 5, 0), (9, 0, 0), (9, 1, 0)],
        "doc_id long, quality int, toxic int",
    )


def test_awkward_rows(awkward, documents, labels):
    texts = [(i, "A plain line of words.\nAnd another.\n" if i % 2 else "@@ ## $$\n## ## ##") for i in range(60)]
    model = linecrf.fit(documents(texts), labels)
    found = linecrf.score(awkward, model).collect()
    assert len(found) == awkward.count()
    by_text = {}
    for r, text in zip(found, [r["text"] for r in awkward.collect()], strict=True):
        assert 0 <= r["score"] <= 1
        assert len(r["lines"]) == (len(text.split("\n")) if text else 0)
        assert by_text.setdefault(text, r["score"]) == r["score"]
    assert by_text[None] == by_text[""]
    assert linecrf.score(awkward.limit(0), model).collect() == []
    again = linecrf.fit(documents(texts).repartition(3), labels)
    assert np.allclose(again.field.emission, model.field.emission)


def test_texts_without_lines_at_either_end():
    """They leave the other texts' neighbours as they are, also where no line follows."""
    x = np.arange(6.0).reshape(3, 2)
    plain = linecrf.with_neighbours(x, np.array([0, 1, 3]))
    assert plain[:, -2:].tolist() == [[1, 1], [1, 0], [0, 1]]
    for first in ([0, 1, 3, 3], [0, 0, 1, 3], [0, 0, 1, 1, 3, 3, 3]):
        assert (linecrf.with_neighbours(x, np.array(first)) == plain).all()
    assert linecrf.with_neighbours(x[:0], np.array([0, 0])).shape == (0, 9)


def test_one_label_only_and_none(documents, labels):
    docs = documents([(1, "a\nb"), (3, "c"), (None, "x")])
    only = linecrf.fit(docs, labels)
    assert {r["score"] for r in linecrf.score(docs, only).collect()} == {1 - 1e-6}
    none = linecrf.fit(docs, labels.limit(0))
    assert {r["score"] for r in linecrf.score(docs, none).collect()} == {0.5}


def test_sample_is_bounded_by_rows_and_lines(documents, labels):
    """One id that holds most rows doesn't outweigh the others."""
    docs = documents([(1, f"hot {i}") for i in range(300)] + [(i, "one\ntwo") for i in range(60)])
    assert len(linecrf.sample(docs, labels, 20, 10_000)) == 20
    rows = linecrf.sample(docs, labels, 500, 50)
    assert sum(r["n_lines"] for r in rows) <= 50
    same = documents([(1, "same")] * 300)
    assert len(linecrf.sample(same, labels, 20, 100)) == 1


def test_labels_of_held_out_rows_teach_nothing(documents, labels):
    texts = [(i, "good words" if i % 2 else "## ##") for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 0]
    turned = labels.withColumn("quality", F.when(F.col("doc_id").isin(held), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (linecrf.fit(documents(texts), x) for x in (labels, turned))
    assert np.array_equal(a.field.emission, b.field.emission)
