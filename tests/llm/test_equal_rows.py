"""Rows that agree in what an operator looks at, and differ in the rest."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from wattledger.llm import mix, neardup


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_mixed_rows_keep_their_own_columns(documents):
    """Three rows of one id and text, two of them equal; a source of weight 1 beside others."""
    docs = documents([(1, "one two three four", "a")] * 3 + [(i, f"w{i} x y z", "b") for i in range(2, 12)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") > 1, "en").otherwise("de"))
    first = docs.filter("doc_id = 1").limit(1).withColumn("lang", F.lit("fr"))
    docs = docs.unionByName(first).unionByName(first)
    got = rows_of(mix.repeated(docs))
    assert got == rows_of(mix.repeated(docs.repartition(5)))
    want = {r["doc_id"]: 0 for r in docs.collect()}
    for r in mix.mix(docs).collect():
        want[r["doc_id"]] += r["copies"]
    taken = Counter()
    for row, n in got.items():
        taken[row[0]] += n
    assert taken == Counter(want)
    kinds = {row[2]: n for row, n in got.items() if row[0] == 1}
    if len(kinds) == 2 and taken[1] >= 5:
        assert kinds["fr"] >= 2 and kinds["de"] >= 3
    assert mix.repeated(docs.limit(0)).count() == 0


def test_one_of_equal_ids_and_texts_stays_whatever_the_order(documents):
    text = "several words that make up a text of some length"
    docs = documents([(1, text, "b"), (1, text, "a"), (1, text, "c"), (2, text, "a"), (3, None, "x")])
    for parts in (1, 4):
        rows = neardup.one_of_each(docs.repartition(parts)).select("doc_id", "source").collect()
        assert sorted(map(tuple, rows)) == [(1, "a"), (3, "x")]
