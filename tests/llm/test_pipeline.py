"""The stages, one after the other, against brute-force versions of each."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_documents import WORD, bag, brute_classes, brute_targets
from wattledger.llm import stages, toxicity
from wattledger.llm.common import stored, table

ROWS = ("doc_id", "text", "source")


def rows_of(docs):
    return [tuple(r) for r in docs.select(*ROWS).collect()]


@pytest.mark.parametrize("kind", ["given", "awkward", "empty"])
def test_every_stage(spark, tables_dir, awkward, kind):
    docs = table(spark, tables_dir, "documents") if kind == "given" else awkward
    docs = docs.limit(0) if kind == "empty" else docs
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        given = rows_of(docs)
        docs = stored(stage(spark, docs, tables_dir), name)
        if name == "token_output":
            break
        assert docs.columns == columns
        seen[name] = (given, rows_of(docs))

    given, kept = seen["toxicity"]
    labels = table(spark, tables_dir, "labels")
    everything = table(spark, tables_dir, "documents") if kind == "given" else awkward
    everything = everything.limit(0) if kind == "empty" else everything
    scores = toxicity.score(everything, toxicity.fit(everything, labels), keep=ROWS).collect()
    assert Counter(kept) == Counter(tuple(r)[:3] for r in scores if r["score"] < 0.7)

    given, kept = seen["near_duplicates"]
    of, _ = brute_classes([r[:2] for r in given])
    assert Counter(of[t] for _, t, _ in kept if t is not None) == Counter(set(of.values()))

    given, kept = seen["decontamination"]
    items = [set(bag(r["text"])) for r in table(spark, tables_dir, "benchmark").collect()]
    clean = [r for r in given if not any(len(m & set(bag(r[1] or ""))) >= 0.8 * len(m) for m in items)]
    assert Counter(kept) == Counter(clean)

    given, mixed = seen["source_mix"]
    size = lambda r: len(WORD.findall(r[1] or ""))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in given:
        sizes[r[2]] += size(r)
        largest[r[2]] = max(largest[r[2]], size(r))
    for r in mixed:
        taken[r[2]] += size(r)
    targets = brute_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    assert set(mixed) <= set(given)
    assert all(n <= 3 * Counter(given)[r] for r, n in Counter(mixed).items())

    encoder = Tokenizer.from_file(stages.tokenizer_path())
    want = Counter()
    for doc_id, text, _ in mixed:
        ids = np.array(encoder.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in docs.collect()) == want


def test_run_applies_the_stages(spark, tables_dir):
    docs = table(spark, tables_dir, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, tables_dir), name)
    want = sorted(map(tuple, docs.collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, tables_dir).collect())) == want and want
