"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and works on all of docs.

docs may have any columns beside doc_id and text; they pass through. Empty tables pass through
every stage; null ids, null texts and repeated rows are documents as each operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, language, near, packing, secrets
from ledgerlens.llm.queries import tokenizer_path
from ledgerlens.llm.tables import KEYS, crc_mod, key_of, keyed, masked, place, table, unmasked

#: Texts that share less than this with the nearest language profile are no text of it.
LEAST_FIT = 0.1


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or unlike every learned language, go."""
    profiles = language.learn(docs.where(crc_mod("doc_id", 3) != 1))
    rows, names = masked(docs)
    found = language.identify(rows, profiles, place(names, "text"))
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("fit") >= LEAST_FIT)
    return unmasked(found.where(kept), names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest id stays, once."""
    classes = near.near_classes(docs)
    heads = key_of(classes.where("representative")).distinct()
    rows, names = masked(docs)
    rows = keyed(rows, place(names, "doc_id"), place(names, "text"))
    return unmasked(rows.join(heads, KEYS).dropDuplicates(KEYS), names)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages make up a twentieth of go."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = key_of(found.where("contaminated")).distinct()
    rows, names = masked(docs)
    rows = keyed(rows, place(names, "doc_id"), place(names, "text"))
    return unmasked(rows.join(bad, KEYS, "left_anti"), names)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark; n_chars, where there, follows."""
    rows, names = masked(docs)
    text = place(names, "text")
    out = secrets.redacted_rows(rows, text)
    if "n_chars" in docs.columns:
        size = place(names, "n_chars")
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(size, F.when(
            F.size("spans") > 0, F.length(text).cast(kind)).otherwise(F.col(size)))
    return unmasked(out, names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece, with its ids."""
    return packing.pack(docs, tokenizer_path(), ids=True)
