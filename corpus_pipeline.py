"""From ``documents`` to token ids: five stages, each written as Parquet and read again.

language ID -> near-duplicate removal -> benchmark decontamination -> secret
masking -> BPE.  A stage gets (spark, docs, sf_dir) and works on all that the
stage before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hitlens.llm import bpe, decontaminate, langid, secrets, simhash
from hitlens.llm.common import crc_mod, read_table
from hitlens.llm.registry import vocabulary_path
from hitlens.session import shared_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those that no learned language claims clearly."""
    model = langid.train(spark, docs.where(crc_mod("doc_id", 5) != 0))
    return langid.keep_identified(spark, docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group of linked documents."""
    return simhash.keep_one(spark, docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; a document that is nothing else goes."""
    return decontaminate.remove(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in place; every document stays."""
    return secrets.redact(spark, docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, decoded)"""
    return bpe.encode(spark, docs, vocabulary_path(), keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("decontaminate", remove_benchmark),
    ("secrets", mask_secrets),
    ("bpe", tokenize),
]

#: Fingerprints, kernel scores and BPE are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; what lies between them is in the shared folder."""
    folder = shared_dir(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
