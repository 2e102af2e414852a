"""A corpus pipeline of five stages over `documents`: quality rules, exact dedup, near dedup, source mix, BPE.

Every stage takes an empty table (and gives one), columns beyond those of `documents`, whatever their names, and nulls in any column. A null text counts as
empty; a row without an id is a row like any other. Texts are taken whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geomill.llm import chunk_bpe, exact_dedup, line_clean, near_dedup, source_mix


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules accept, without the lines that fail; n_chars, where there is one, follows the text. A null or
    empty text has no words and goes; repeated rows are judged alike and all stay or go."""
    kept = line_clean.keep_clean(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of rows with that id too, one. Null and empty texts are equal; a null id is smaller than
    any other."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id. Texts without words have no near copies and stay."""
    return near_dedup.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its Poisson draw says, in shuffled order. The draw depends on id and seed only (on the text where there is no id), so
    rows with one id are drawn alike; a null source is the source ``."""
    return source_mix.mix_sources(docs).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every copy in the mix, as digests: doc_id, n_tokens, ids_sha256, decoded_sha256 and chunk counts. A row for every row, repeated
    ones too; an empty text has no ids."""
    import public_tokenizers

    return chunk_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.json"), chunk_bpe.digests, chunk_bpe.DIGESTS)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("source_mix", mix),
    ("chunk_bpe", token_ids),
]
#: Near-duplicate components, BPE ids and the mix's inverted distribution over them are no SQL: brute force in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written to the shared folder and read again."""
    from geomill.llm.common import documents, staged

    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
