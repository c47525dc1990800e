from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattledger.llm import topk, warc
from wattledger.llm.common import stored, table


def assembled(pages, **options):
    archives = warc.write_archives(pages, **options)
    return warc.assemble(stored(warc.read_records(archives, with_payload=True), "records"))


def page_id(side):
    return F.expr(f"cast({side}.metadata.fields['page-id'] as long)") if side else F.expr(
        "cast(metadata.fields['page-id'] as long)"
    )


PAGES = "page_id long, url string, html string, key string"


def test_pages_come_back(spark):
    rows = [
        (3, "u3", "<p>same</p>", "x"), (1, "u1", "<p>same</p>", "x"), (2, "u2\r\nWARC-Type: fake", "<p>other ü</p>\r\n\r\n", "x"),
        (5, "u5", None, "x"), (4, None, "", "x"), (6, "u6", "z" * 3_000_000, "x"), (3, "u3", "<p>same</p>", "x"),
        (None, "u7", "<p>same</p>", "x"), (8, "u8", "WARC/1.1\r\n\r\nContent-Length: 3", None),
    ]
    got = assembled(spark.createDataFrame(rows, PAGES)).select(
        page_id("").alias("page_id"), "capture.type", "copies", page_id("original").alias("of"),
        F.coalesce("original.capture.payload", "capture.payload").alias("payload"),
        F.coalesce("original.capture.payload_digest", "capture.payload_digest").alias("digest"),
        "capture.declared_digest", "request.type",
    ).collect()
    first = {}
    for i, _, html, _ in rows:
        html = (html or "").encode()
        first[html] = min((x for x in (i, first.get(html)) if x is not None), default=None)
    want = Counter()
    for i, _, html, _ in rows:
        html = (html or "").encode()
        original = i == first[html]
        want[i, "response" if original else "revisit", None if original else first[html], html] += 1
    assert Counter({(r[0], r[1], r["of"], bytes(r["payload"])): r["copies"] for r in got}) == want
    for r in got:
        digest = base64.b32encode(hashlib.sha1(bytes(r["payload"])).digest()).decode()
        assert r["digest"] == r["declared_digest"] == digest
        assert r[7] == "request"


def test_short_payloads_stay_responses(spark):
    rows = [(1, "a", "abc", ""), (2, "b", "abc", ""), (3, "c", "abcdef", ""), (4, "d", "abcdef", "")]
    got = assembled(spark.createDataFrame(rows, PAGES), least=4).select(page_id(""), "capture.type").collect()
    assert dict(got) == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_no_pages(spark):
    assert assembled(spark.createDataFrame([], PAGES)).count() == 0


def test_given_pages(spark, tables_dir):
    pages = table(spark, tables_dir, "pages")
    assert assembled(pages).agg(F.sum("copies")).first()[0] == pages.count()


def test_torn_archives_are_refused():
    good = warc.record("response", "<urn:uuid:1>", {}, b"HTTP/1.1 200 OK\r\n\r\nx")
    headers, block = warc.parse(__import__("gzip").decompress(good))
    assert headers["warc-type"] == "response" and block.endswith(b"x")
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200 OK\r\n\r\n")
    with pytest.raises(ValueError):
        warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")


def brute(rows, k):
    whole = [
        (i, [int(np.floor(256.0 * float(x))) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    asks = {}
    for i, v in whole:
        if i % 50 == 0:
            asks[i] = min(asks.get(i, v), v, key=lambda w: np.array(w, dtype="<i8").tobytes())
    out = []
    for q, a in asks.items():
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in whole if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<double>, length string"


@pytest.mark.parametrize("kind", ["normal", "lengths", "close", "tied"])
def test_top_products(spark, kind, monkeypatch):
    monkeypatch.setattr(topk, "VECTOR_ROWS", 40)
    chance = np.random.default_rng(4)
    x = chance.normal(size=(400, 8))
    if kind == "lengths":
        x *= np.exp(chance.normal(size=(400, 1)) * 2)
    elif kind == "close":
        x = x[:8].repeat(50, 0) * 9 + chance.normal(size=(400, 8)) * 0.2
    elif kind == "tied":
        x = np.round(x[:5].repeat(80, 0))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [
        (None, [1.0] * 8), (1001, None), (1002, [float("nan")] * 8), (1003, [None, 1.0]), (1004, []),
        (1005, [float("inf")] * 8), (1050, [2.0, 1.0]), (50, [9.0] * 8), (7, [-3.0] * 8), (1100, [0.0] * 8),
    ]
    table_ = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    got = sorted(map(tuple, topk.top_k(table_, F.col("vec_id") % 50 == 0).collect()))
    assert got == brute(rows, 5)


def test_huge_components_and_few_rows(spark):
    rows = [(0, [1e12, -1e12]), (1, [1e9, 5.0]), (2, [3.0, 4.0])]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame([(*r, "") for r in rows], SCHEMA), F.col("vec_id") % 50 == 0).collect()))
    assert got == [(0, 1, 1, min(brute(rows, 5)[0][3], (1 << 63) - 1)), (0, 2, 2, brute(rows, 5)[1][3])]
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_copies_of_queries_are_not_sent_through_the_driver(spark, monkeypatch):
    """Queries meet 400 blocks; a copy for each, broadcast at once, would exceed the limit set."""
    monkeypatch.setattr(topk, "VECTOR_ROWS", 10)
    x = np.random.default_rng(6).normal(size=(4000, 64))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    table_ = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    spark.conf.set("spark.sql.maxBroadcastTableSize", "8m")
    try:
        found = topk.top_k(table_, F.col("vec_id") % 50 == 0)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, found.collect()))
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
    assert "explode" not in plan and "CartesianProduct" in plan
    assert got == brute(rows, 5)


@pytest.mark.parametrize("kind", ["normal", "close", "tied", "doubles", "longs", "huge", "narrow", "none"])
def test_block_against_block(kind):
    chance = np.random.default_rng(8)
    size = {"doubles": 1e5, "longs": 1e8, "huge": 1e18}.get(kind, 300)
    vs = (chance.normal(size=(300, 12)) * size).astype("i8")
    if kind in ("close", "longs", "huge"):
        vs = (vs[:6].repeat(50, 0) * (1 + chance.normal(size=(300, 12)) * 0.01)).astype("i8")
    elif kind == "tied":
        vs = vs[:2].repeat(150, 0)
    ids = chance.integers(0, 250, 300)
    length = np.sqrt((vs.astype("f8") ** 2).sum(axis=1))
    order = np.lexsort((ids, -length))
    ids, vs, length = ids[order], vs[order], length[order]
    at = chance.choice(300, 40, replace=False)
    _, at = np.unique(ids[at], return_index=True)
    qs, k = vs[at], {"none": 400}.get(kind, 5)
    if kind == "narrow":
        vs[:, 9:] = 0
        length = np.sqrt((vs.astype("f8") ** 2).sum(axis=1))
        order = np.lexsort((ids, -length))
        ids, vs, length = ids[order], vs[order, :9], length[order]
    best = topk.Best(ids[at], np.full(len(at), topk.LONG[0]), k)
    asked = (ids[at], np.sqrt((qs.astype("f8") ** 2).sum(axis=1)), qs)
    for part in range(0, 300, 100):
        topk.search_block(asked, (ids[part : part + 100], length[part : part + 100], vs[part : part + 100]), best)
    got = Counter(zip(*map(np.ndarray.tolist, best.rows()), strict=True))
    want = Counter()
    for q, row in zip(ids[at].tolist(), qs.tolist(), strict=True):
        products = [sum(a * b for a, b in zip(row, v)) for v in vs.tolist()]
        held = [max(min(p, topk.LONG[1]), topk.LONG[0]) for p in products]
        others = sorted((-s, i) for s, i in zip(held, ids.tolist(), strict=True) if i != q)
        want.update((q, i, -s) for s, i in others[:k])
    assert got == want


def test_blocks_are_bounded_by_rows_and_bytes(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_BYTES", 800)
    rows = [(i, float(i % 3), np.arange(n, dtype="<i8").tobytes()) for i, n in enumerate([10] * 25 + [300, 0, 0, 5, 50])]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a : a + 7], strict=True)], names=["vec_id", "length", "components"])
        for a in range(0, len(rows), 7)
    ]
    cut = list(topk._cut(batches, ["vec_id", "length", "components"], 4, lambda x: x.astype(int)))
    assert sorted(r for _, part in cut for r in part) == rows
    for bucket, part in cut:
        assert {int(r[1]) for r in part} == {bucket} and len(part) <= 4
        assert len(part) == 1 or len(part) * max(len(r[2]) for r in part) <= 800
        ids, lengths, whole = topk._unpacked(topk._packed(part))
        assert ids.tolist() == [r[0] for r in part] and lengths.tolist() == [r[1] for r in part]
        for r, components in zip(part, whole, strict=True):
            n = len(r[2]) // 8
            assert components[:n].astype("<i8").tobytes() == r[2]
            assert not components[n:].any()
