"""Reading tables and naming rows for the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, text). Rows with one id and different texts differ in th, a hash of the text;
    rows equal in both are one document for operators that compare documents."""
    return docs.select(
        F.col(key).alias("doc_id"), F.xxhash64(text_of(text)).alias("th"),
        text_of(text).alias("text"))


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def masked(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns named by place, and their names, so that no operator's own column can
    have the name of a column that only passes through."""
    names = {f"_c{i}": name for i, name in enumerate(docs.columns)}
    return docs.toDF(*names), names


def place(names: dict[str, str], wanted: str) -> str:
    return next(p for p, name in names.items() if name == wanted)


def unmasked(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.select(*[F.col(p).alias(name) for p, name in names.items()])


def keyed(rows: DataFrame, key: str, text: str) -> DataFrame:
    """rows plus the three columns that name a document by id and text, none of them null."""
    return rows.withColumns({
        "_id": F.coalesce(F.col(key).cast("string"), F.lit("")),
        "_no_id": F.col(key).isNull(), "_th": F.xxhash64(text_of(text))})


KEYS = ["_id", "_no_id", "_th"]


def key_of(found: DataFrame, *columns: str) -> DataFrame:
    """The same three columns for an operator's rows (doc_id, th), with other columns."""
    return found.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.col("doc_id").isNull().alias("_no_id"), F.col("th").alias("_th"), *columns)
