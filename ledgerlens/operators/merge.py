"""Keyed merge of verdicts, and the two-model ensemble."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.verdict import result_code, scope_result, stamp


def ensemble_pick(
    above: Column, below: Column, above_probability: Column, below_probability: Column
) -> Column:
    """The code of the model that is more certain; the large-class model wins ties."""
    return F.when(
        F.array_max(above_probability) >= F.array_max(below_probability), above
    ).otherwise(below)


def probabilities(vector: Column) -> Column:
    return vector_to_array(vector)


def keyed_merge(rows: DataFrame, order: list[str], as_of: dt.date) -> DataFrame:
    """One result per identifier; later rows overwrite earlier ones.

    ``rows`` has the identifier, the declared code, ``scope_note`` and, for rows in scope,
    ``predicted`` and ``verdict``. The declared code comes from the last row of an identifier.
    Scored rows overwrite out-of-scope notes. ``order`` names the columns that put the rows of an
    identifier in order, the last of them one that differs between rows (an arrival number), so
    that both maxima are of one row. Maxima of structs are combined before the shuffle, so many copies of
    one identifier cost one row per task.
    """
    scored = F.col("scope_note").isNull()
    place = [F.col(c) for c in order]
    last_row = F.max(F.struct(*place, F.col(S.CODE).alias("code")))
    last_note = F.max(F.struct(
        scored.cast("int").alias("scored"), *place,
        F.coalesce("scope_note", "predicted").alias("predicted"),
        F.coalesce("scope_note", "verdict").alias("verdict"),
    ))
    merged = rows.groupBy(F.col(S.ID).alias("Identificador")).agg(
        last_row.alias("row"), last_note.alias("note"))
    code, note = F.col("row.code"), F.col("note")
    return merged.select(
        "Identificador",
        code.alias("Natureza Real"),
        note["predicted"].alias("Natureza Predita"),
        note["verdict"].alias("Corretude"),
        stamp(as_of).alias("Data Predicao"),
        F.when(note["scored"] == 1, result_code(code, note["predicted"], note["verdict"]))
        .otherwise(scope_result(note["verdict"])).alias("Resultado"),
    )


def result_distribution(results: DataFrame) -> DataFrame:
    return results.groupBy("Resultado").agg(F.count("*").alias("n"))
