"""The Merkle manifest against trees built in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from wattledger.llm import merkle, queries
from wattledger.llm.common import table

FIELDS = merkle.FIELDS


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def climb(levels, at, given):
    siblings = []
    for level in levels[:-1]:
        first = at // 16 * 16
        run, slot = level[first : first + 16], at - first
        siblings += run[:slot] + run[slot + 1 :]
        given, at = digest(*run[:slot], given, *run[slot + 1 :]), at // 16
    return siblings, given


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        doc_id, *middle, text = row
        hit = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        after = "".join(c.lower() if "A" <= c <= "Z" else c for c in text) if hit else text
        leaf, given = (digest(*map(written, (doc_id, *middle, t))) for t in (text, after))
        groups[row[1]].append(((doc_id is not None, doc_id or 0), leaf, given, doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {n: tree([leaf for _, leaf, *_ in sorted(groups[n])]) for n in names}
    top = tree([trees[n][-1][0] for n in names])
    for place, name in enumerate(names):
        for i, (_, leaf, given, doc_id) in enumerate(sorted(groups[name])):
            low, folded = climb(trees[name], i, given)
            high, folded = climb(top, place, folded)
            root = top[-1][0]
            yield doc_id, leaf, trees[name][-1][0], root, digest(*low, *high), folded, folded == root


def rows_of(docs):
    return [tuple(r) for r in docs.select(*FIELDS).collect()]


def proven(docs):
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(hit, merkle.lowered_ascii(F.col("text"))).otherwise(F.col("text"))
    found = merkle.manifest(docs, changed={"text": text})
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=repr)


def test_given_documents(spark, tables_dir):
    got = queries.op13_merkle_proofs(spark, tables_dir).collect()
    want = brute(rows_of(table(spark, tables_dir, "documents")))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert {r["verified"] for r in got} == {True, False}


def test_awkward_rows(awkward):
    docs = awkward.withColumns({"lang": F.lit("en"), "n_chars": F.lit(None).cast("long")})
    docs = docs.withColumns({c: F.lit("clash") for c in ("tree", "place", "level", "pos", "leaf", "given", "block", "low", "slot")})
    assert proven(docs) == sorted(brute(rows_of(docs)), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def some(n, sources):
    chance = random.Random(n)
    ids = lambda: chance.choice([None, 1, chance.randrange(10**6)])
    return [(ids(), chance.choice(sources), "de", 3, chance.choice([None, "", "Ab", "é"])) for _ in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        [], some(1, ["a"]), some(1, [None]), some(2, ["a"]), some(17, ["a"]), some(300, [None, "", "a", "é", "z"]),
        some(40, ["hot"] * 30 + ["b"]) + [(5, f"s{i}", None, None, "T") for i in range(40)],
    ],
    ids=["empty", "one", "one of null", "run of two", "run of one", "groups", "many groups"],
)
def test_shapes(spark, rows):
    assert proven(spark.createDataFrame(rows, SCHEMA)) == sorted(brute(rows), key=repr)


def test_several_blocks_and_levels(spark):
    """Nodes above a block are met by the copy of each block below."""
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "hot").alias("source"),
        F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("Text").alias("text"),
    )
    assert proven(docs) == sorted(brute(rows_of(docs)), key=repr)


def test_row_limit_of_recursion_is_restored(spark, documents):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(documents([(1, "a"), (2, "b")]).select(*FIELDS))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
