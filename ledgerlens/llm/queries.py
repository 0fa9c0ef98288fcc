"""The registered query of each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    alignment,
    audit,
    decontaminate,
    language,
    licenses,
    near,
    neighbours,
    packing,
    personal,
    secrets,
    substrings,
    topk,
    toxicity,
)
from ledgerlens.llm.oracles import ORACLES  # noqa: F401
from ledgerlens.llm.tables import crc_mod, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod("doc_id", 5) == 0
    rows = toxicity.labelled(docs.select("doc_id", "text"), labels, ~held_out)
    model = toxicity.learn(rows)
    return toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def file_tree(docs: DataFrame) -> DataFrame:
    """Documents as files: of each source, a directory for 1,000 ids and one below it for 100; the
    first 20 ids of a thousand are the licence files of the upper directories, the first two of a
    hundred those of the lower ones."""
    upper = F.col("doc_id") % 1000 < 20
    name = F.when(upper, F.lit("LICENSE")).otherwise(F.concat(
        F.floor(F.col("doc_id") / 100).cast("string"), F.lit("/"),
        F.when(F.col("doc_id") % 100 < 2, F.lit("LICENSE")).otherwise(
            F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".txt")))))
    return docs.select("doc_id", "text", F.concat(
        "source", F.lit("/"), F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("/"), name)
        .alias("path"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licences(file_tree(table(spark, sf_dir, "documents")), "doc_id")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op5_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.personal_data(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents")).drop("spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th", "spans")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    profiles = language.learn(docs.where(~held_out))
    return language.identify(
        docs.select("doc_id", held_out.alias("held_out"), "text"), profiles).drop("text")


def op10_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(table(spark, sf_dir, "documents")).drop("th", "class_th")


def op11_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
        {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(
        docs.withColumn("doc_id", F.col("doc_id").cast("long")),
        tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), digests=True)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_licences, op3_topk, op4_secrets, op5_personal, op6_substrings, op7_packing,
    op8_decontaminate, op9_language, op10_near, op11_audit, op12_neighbours,
    op13_alignment)}
