"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattledger.llm import (
    alignment, containment, linecrf, merkle, mix, neardup, passages, ring, secrets, stages, tokens, topk, toxicity, warc,
)
from wattledger.llm.common import stored, table


def op1_token_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tokens.write_tokens(
        table(spark, sf_dir, "documents"), stages.tokenizer_path(), end_id=stages.END_ID
    )
    return tokens.read_documents(parts)


def op2_bagminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = ring.shard(table(spark, sf_dir, "documents"), shards=24)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit(ring.LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.contained(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    captures = warc.assemble(stored(warc.read_records(archives), "warc-records"))
    page_id = lambda metadata: metadata["fields"]["page-id"].cast("long")
    full = F.coalesce("original.capture", "capture")
    rows = captures.select(
        page_id(F.col("metadata")).alias("page_id"),
        full["payload_bytes"].alias("payload_bytes"),
        full["payload_digest"].alias("payload_digest"),
        F.col("capture.type").alias("record_type"),
        page_id(F.col("original.metadata")).alias("refers_to"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return rows.drop("copy")


def op6_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.REJECT_SCORE).cast("int").alias("predicted"),
    )


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.deduplicate(table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op10_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op11_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, from a field over its lines.

    ``held_out`` and the rest of a row with a null id: null, and scored all the same.
    """
    docs = table(spark, sf_dir, "documents")
    scored = linecrf.score(docs, linecrf.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", linecrf.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= linecrf.ACCEPTED).cast("int").alias("predicted"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a byte-level BPE aligned with those of a sentencepiece BPE, every document.

    Null and empty texts, and those that a tokenizer doesn't spell, have zeros and "".
    """
    vocabularies = (stages.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), *vocabularies)


def op13_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest's proof of every document, some of them tampered with.

    Where 5 divides the checksum of the id, the text's ASCII capitals become small; a null
    id has no checksum and a null text nothing to change. Equal ids are ordered by hash.
    """
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampered, merkle.lowered_ascii(F.col("text"))).otherwise(F.col("text"))
    return merkle.manifest(table(spark, sf_dir, "documents"), changed={"text": text})


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_sequences, op2_bagminhash_classes, op3_ring_shards, op4_mix_sources,
        op5_warc_transactions, op6_top_products, op7_toxic_scores, op8_repeated_passages,
        op9_benchmark_containment, op10_secret_spans, op11_line_quality,
        op12_token_alignment, op13_merkle_proofs,
    )
}

OP9_SQL = r"""
WITH split AS (
    SELECT 'd' AS kind, doc_id AS id,
        regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w
    FROM documents
    UNION ALL
    SELECT 'b', item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') FROM benchmark
), shingle AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM split)
), size AS (
    SELECT id, count(*) AS n FROM shingle WHERE kind = 'b' GROUP BY id
), found AS (
    SELECT d.id AS doc_id, b.id AS item_id, count(*) AS k
    FROM shingle d JOIN shingle b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b'
    GROUP BY 1, 2
)
SELECT doc_id, item_id, n::INT AS n_shingles, k::INT AS n_found, k / n AS containment
FROM found JOIN size ON size.id = item_id WHERE k / n >= 0.8
"""

OP6_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x)::BIGINT AS score
    FROM v q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
    FROM scored
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _crc32_sql(text: str) -> str:
    """The unsigned checksum of an ASCII text, bit by bit."""
    byte_step = (
        "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
        "lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    )
    codes = f"list_transform(string_split({text}, ''), lambda t: ascii(t)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte_step}), 4294967295)"


def _encoded_sql(*values: str) -> str:
    parts = [f"coalesce(strlen(({v})::VARCHAR) || ':' || ({v})::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


def _tree_sql(name: str, base: str) -> str:
    """All levels of the trees over (tree, pos, n, h)."""
    return f"""{name}(tree, level, pos, n, h) AS (
    SELECT tree, 0, pos, n, h FROM {base}
    UNION ALL
    SELECT tree, level + 1, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(h, '' ORDER BY pos))
    FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 16
)"""


def _fold_sql(name: str, base: str, levels: str) -> str:
    """What each (leaf, tree, pos, f) folds into, level by level."""
    return f"""{name}(leaf, tree, level, pos, f) AS (
    SELECT leaf, tree, 0, pos, f FROM {base}
    UNION ALL
    SELECT c.leaf, c.tree, c.level + 1, c.pos // 16,
        sha256(string_agg(CASE WHEN x.pos = c.pos THEN c.f ELSE x.h END, '' ORDER BY x.pos))
    FROM {name} c JOIN {levels} x
        ON x.tree = c.tree AND x.level = c.level AND x.pos // 16 = c.pos // 16 AND x.n > 1
    GROUP BY c.leaf, c.tree, c.level, c.pos
)"""


OP13_SQL = rf"""
WITH RECURSIVE given AS (
    SELECT *, coalesce('=' || source, '') AS tree, row_number() OVER () AS leaf,
        coalesce({_crc32_sql("doc_id::VARCHAR")} % 5 = 0, false) AS hit FROM documents
), hashes AS (
    SELECT leaf, doc_id, tree, {_encoded_sql("doc_id", "source", "lang", "n_chars", "text")} AS h,
        {_encoded_sql("doc_id", "source", "lang", "n_chars",
                      "CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                      "'abcdefghijklmnopqrstuvwxyz') ELSE text END")} AS f
    FROM given
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n FROM hashes
), {_tree_sql("lv", "leaves")}, {_fold_sql("up", "leaves", "lv")}, subroots AS (
    SELECT tree AS name, h, '/' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
    FROM lv WHERE n = 1
), {_tree_sql("tv", "subroots")}, arrived AS (
    SELECT u.leaf, s.tree, s.pos, u.f FROM up u
    JOIN lv ON lv.tree = u.tree AND lv.level = u.level AND lv.pos = u.pos AND lv.n = 1
    JOIN subroots s ON s.name = u.tree
), {_fold_sql("top", "arrived", "tv")}, root AS (SELECT h, level FROM tv WHERE n = 1),
way AS (
    SELECT u.leaf, x.level, x.pos, x.h FROM up u JOIN lv x
        ON x.tree = u.tree AND x.level = u.level AND x.pos // 16 = u.pos // 16 AND x.pos <> u.pos AND x.n > 1
    UNION ALL
    SELECT u.leaf, 1000 + x.level, x.pos, x.h FROM top u JOIN tv x
        ON x.level = u.level AND x.pos // 16 = u.pos // 16 AND x.pos <> u.pos AND x.n > 1
), proof AS (SELECT leaf, string_agg(h, '' ORDER BY level, pos) AS siblings FROM way GROUP BY leaf)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
    t.f AS folded_root, t.f = r.h AS verified
FROM leaves l JOIN subroots s ON s.name = l.tree CROSS JOIN root r
JOIN top t ON t.leaf = l.leaf AND t.level = r.level LEFT JOIN proof p ON p.leaf = l.leaf
"""

#: Of equal payloads the smallest page_id is the response; base32 comes from five hexadecimal
#: digits, hence four letters, at a time.
OP5_SQL = r"""
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h,
        min(page_id) OVER (PARTITION BY payload) AS first_id FROM p
), letters AS (
    SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 1 + 5 * g, 5))::BIGINT >> (15 - 5 * c)) % 32)::INT, 1), '' ORDER BY g, c) AS digest
    FROM d, (SELECT unnest(range(8)) AS g), (SELECT unnest(range(4)) AS c) GROUP BY page_id
)
SELECT d.page_id, d.n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN d.page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN d.page_id <> first_id THEN first_id END AS refers_to
FROM d JOIN letters USING (page_id)
"""

#: A word is covered if one of the windows that reach it starts in a document before.
OP8_SQL = r"""
WITH t AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
    FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t)
), repeats AS (
    SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS first_id FROM windows)
    WHERE first_id < doc_id
), covered AS (SELECT DISTINCT r, i + k AS at FROM repeats, (SELECT unnest(range(50)) AS k)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS at FROM t),
kept AS (
    SELECT words.r, string_agg(word, ' ' ORDER BY words.at) AS text, count(*) AS n
    FROM words LEFT JOIN covered ON covered.r = words.r AND covered.at = words.at
    WHERE covered.at IS NULL GROUP BY words.r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept ON kept.r = t.r
"""

ORACLE_SQL = {
    "op5_warc_transactions": OP5_SQL,
    "op6_top_products": OP6_SQL,
    "op8_repeated_passages": OP8_SQL,
    "op9_benchmark_containment": OP9_SQL,
    "op13_merkle_proofs": OP13_SQL,
}
