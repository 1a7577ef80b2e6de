"""A corpus pipeline: each stage's rows are written as Parquet and are the documents of the next stage.

language   documents whose language can't be told go (operator 6)
copies     of equal texts one stays (operator 8)
near       of each group of near-duplicates (five words, 0.8) one stays (operator 10)
secrets    secrets are masked in the texts that stay (operator 3)
packing    texts become sequences of at most 2048 tokens (operator 9)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import exact_dedup, language_id, minhash_join, packing, secrets
from chronofold.llm.common import crc_text, read_table, stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, null texts among them, go; all others stay, however unsure their language. Null languages
    teach nothing; without any label in the table no language is known, and every row goes."""
    held = F.pmod(crc_text("doc_id"), F.lit(4)) == 2
    model = language_id.train(docs.where(~held).select("doc_id", "text", "lang"))
    return language_id.keep_identified(docs, model)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows whose texts are equal without white space the longest stays, then that of the least id; null ids lose."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of the least id; texts without words and null texts stay. Rows of one id
    count as one document with several texts, each kept or dropped by its own group. An empty table stays empty."""
    return minhash_join.keep_one(docs, size=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay, with secrets in their texts masked and n_chars counted anew; null texts stay null."""
    masked = secrets.mask_secrets(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and place; null texts count as empty, null and repeated ids are packed like others."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("copies", copies), ("near", near_duplicates), ("secrets", mask_secrets), ("packing", sequences)]

#: Trained models, shingle similarity and token packing have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole table of documents; what each one returns is stored and read again. An empty table gives
    no pieces. Extra columns of the table stay up to the last stage."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
