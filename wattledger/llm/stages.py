"""The stages of the corpus pipeline: (spark, docs, sf_dir) -> the rows that go on.

Each works on all rows it is given. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattledger.llm import containment, mix, neardup, tokens, toxicity
from wattledger.llm.common import fresh_folder, table, unused

#: The vocabulary of the token output and the id that ends a document.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the rejection score; null and empty texts stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    name = unused("score")
    scored = toxicity.score(docs, model, keep=tuple(docs.columns), name=name)
    return scored.filter(F.col(name) < toxicity.REJECT_SCORE).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the smallest id; null texts stay.

    Rows that repeat id and text are one; see ``neardup.one_of_each``. Long texts are
    compared whole.
    """
    return neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; null and short texts contain none.

    Repeated rows stay or go together.
    """
    return containment.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or repeated.

    A null source is a source; rows without words are kept once; see ``mix.repeated``.
    """
    return mix.repeated(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the sequences written from all documents.

    A null text is its end id alone; equal ids are ordered by a hash of their text.
    """
    parts = tokens.write_tokens(
        docs, tokenizer_path(), end_id=END_ID, folder=fresh_folder(spark, "corpus")
    )
    return tokens.read_documents(parts)
