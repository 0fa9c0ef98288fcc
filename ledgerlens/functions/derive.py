"""Derived columns: date, person, organ and action features, and min-max scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S

# Accepted date layouts, tried in this order, and the day zero of serial dates.
DATE_LAYOUTS = ["yyyy/M/d", "yyyy-M-d", "M/d/yyyy", "d/M/yyyy"]
SERIAL_EPOCH = "1899-12-30"
CODE_PREFIX = 7

FLAGS = ["pessoa_juridica", "orgao_sucedido", "acao_programa"]
REPLACED = [S.CPF, S.CNPJ, S.CPF_CNPJ, S.ORGAN, "acao", "programa"]


def month_of_text(text: Column) -> Column:
    day = F.element_at(F.split(text, "[ T]"), 1)
    return F.month(F.coalesce(*[F.try_to_date(day, layout) for layout in DATE_LAYOUTS]))


def month_of_serial(serial: Column) -> Column:
    return F.month(F.date_add(F.to_date(F.lit(SERIAL_EPOCH)), serial.cast("int")))


def month_of(period: Column) -> Column:
    """Month of a date text; a text of digits only is a spreadsheet serial."""
    text = period.cast("string")
    serial = text.rlike("^[0-9]+$")
    return F.when(serial, month_of_serial(text.try_cast("int"))).otherwise(month_of_text(text))


def legal_person(cpf: Column) -> Column:
    return F.when(cpf == "-", 1).otherwise(0).cast("byte")


def succeeded_organ(organ: Column, successor: Column) -> Column:
    return F.coalesce(organ != successor, F.lit(True)).cast("byte")


def without_prefix(label: Column) -> Column:
    return F.substring(label, CODE_PREFIX + 1, 2**31 - 1)


def action_program(action: Column, program: Column) -> Column:
    return F.concat(without_prefix(action), F.lit(" & "), without_prefix(program))


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Unclipped; a constant column becomes ``value - low``."""
    return F.when(high == low, value - low).otherwise((value - low) / (high - low))


def derived_categories(categories: list[str]) -> list[str]:
    """Names of the category columns after derivation; the process number is not one of them."""
    return [c for c in categories if c not in (*REPLACED, S.PROCESS)] + FLAGS


def derive_features(df: DataFrame, categories: list[str], extra: list[str] = []) -> DataFrame:
    """One projection with all derived categories, the amounts, the text and ``extra`` columns."""
    kept = [c for c in categories if c not in (*REPLACED, S.PERIOD)]
    return df.select(
        *[c for c in extra if c not in kept],
        *kept,
        month_of(F.col(S.PERIOD)).alias(S.PERIOD),
        legal_person(F.col(S.CPF)).alias("pessoa_juridica"),
        succeeded_organ(F.col(S.ORGAN), F.col(S.SUCCESSOR)).alias("orgao_sucedido"),
        action_program(F.col("acao"), F.col("programa")).alias("acao_programa"),
        S.HISTORY,
        *[c for c in S.AMOUNTS if c not in extra],
    )
