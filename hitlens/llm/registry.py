"""The registered queries of the training-data operators, one ``opN_<name>`` each.

A query applies its operator with production parameters to the whole table and
derives the contract's columns from the operator's own result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitlens.llm import (bpe, decontaminate, dialogue, langid, negatives, oracle, passages, pii, planes, quality,
                         secrets, simhash, toxicity, urls)
from hitlens.llm.common import crc_mod, read_table
from hitlens.session import shared_dir


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.train(spark, docs.where(crc_mod("doc_id", 5) != 0))
    return langid.predict(spark, docs, model).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(spark, read_table(spark, sf_dir, "documents"),
                                 read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urls.train(spark, urls.labelled_urls(spark))
    return urls.judge(spark, read_table(spark, sf_dir, "pages"), weights).select("page_id", "host", "path", "rule", "verdict")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    trained = toxicity.train(spark, docs, labels.where(crc_mod("doc_id", 3) != 1))
    return toxicity.score(spark, docs, trained).select(
        "doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= toxicity.CUT).cast("int").alias("predicted"))


def vocabulary_path() -> str:
    """The public vocabulary file that the contract names."""
    import public_tokenizers
    return str(public_tokenizers.path("word_bpe_49k.json"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(spark, read_table(spark, sf_dir, "documents"), vocabulary_path())
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return passages.remove_repeats(spark, docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.findings(spark, read_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE_RULES]

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(secrets.span_text(own), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = pii.find(spark, docs, pii.train(spark, docs))
    kinds = F.array(*map(F.lit, pii.KINDS))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        F.array_position(kinds, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        s["kind"].alias("kind"))))
    return found.select("doc_id", *map(count, pii.KINDS),
                        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
                        secrets.span_text(every).alias("spans"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(spark, docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-planes")
    planes.write_corpus(spark, read_table(spark, sf_dir, "documents"), folder, vocabulary_path())
    return planes.read_corpus(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = dialogue.damage(read_table(spark, sf_dir, "conversations"))
    repaired = dialogue.repair(spark, damaged, count_col="n")
    texts = dialogue.digests(repaired.turns).withColumnRenamed("conv_id", "of")
    return repaired.summary.join(texts, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(spark, rows.select("vec_id", moved.alias("label"), "embedding"), F.col("id") % 100 == 0)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_decontaminate": op2_decontaminate,
    "op3_quality": op3_quality,
    "op4_urls": op4_urls,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_passages": op7_passages,
    "op8_secrets": op8_secrets,
    "op9_pii": op9_pii,
    "op10_simhash": op10_simhash,
    "op11_token_planes": op11_token_planes,
    "op12_dialogue": op12_dialogue,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": oracle.DECONTAMINATE,
    "op3_quality": oracle.QUALITY,
    "op7_passages": oracle.PASSAGES,
    "op8_secrets": oracle.SECRETS,
    "op13_hard_negatives": oracle.HARD_NEGATIVES,
}
