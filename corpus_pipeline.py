"""From raw documents to token ids: a corpus pipeline of five stages over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written and read again as the next one's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from terroir.llm import bpe, contamination, quality, repeats, simhash
from terroir.storage import new_path, remove, scratch


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the limit of their language.

    Null and empty texts go; a null language is one of its own; null ids are judged but never trusted; repeated rows
    are judged alike; an empty table, or one without labels, keeps what has a text. Other columns pass through.
    """
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at four or fewer bits.

    The least id stays (nulls last, ties by text hash); of repeated rows one; null and empty texts are one group, whose
    first row stays. Texts are fingerprinted whole. Other columns pass through.
    """
    return simhash.without_near_duplicates(docs, words=4, distance=4)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words, or strings of 400 bytes, that occur again.

    Every row stays, with what is left of its text (maybe nothing) and ``n_chars`` counted anew; null texts stay null;
    all copies of a passage go, in repeated rows too; rows that share an id keep apart by their texts.
    """
    return repeats.without_repeats(docs, length=400, words=51)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Null and empty texts contain none and stay, as every row does where the benchmark is empty; repeated rows go or
    stay together; a document goes by one item, however long it is.
    """
    return contamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with a digest of the text decoded from them.

    Null and empty texts have no ids; null ids and repeated rows are encoded each; an empty table gives no rows.
    """
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # The other stages' workers are still there: a smaller dictionary than that of the stage alone.
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN, kept=100_000)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("benchmark", drop_benchmark),
    ("tokens", encode),
]

#: Perplexity, fingerprints and contraction are not expressed in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table of ``sf_dir``.

    What a stage wrote on its way goes once its result is written, and that once the next one's is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
