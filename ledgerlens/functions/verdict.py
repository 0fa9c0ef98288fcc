"""Result codes, out-of-scope verdicts and date stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

IN_SCOPE = "Em escopo"
ELEMENT_92 = "Classe 92"
EXPIRED = "Classe com vigência expirada"
UNKNOWN = "Classe desconhecida"
NO_BALANCE = "Saldo zerado"

# Result code by correctness verdict, when the predicted code equals the declared
# one and when it differs.
SAME_CODE = {"INCORRETO": "INCV_M2", "OK": "C_M1-M2", "INCONCLUSIVO": "AD_M2"}
OTHER_CODE = {"INCORRETO": "INCT_M1-M2", "OK": "INCV_M1", "INCONCLUSIVO": "INCV_M1-AD_M2"}


def _pick(key: Column, table: dict[str, str]) -> Column:
    picked = F.lit(None).cast("string")
    for label, code in table.items():
        picked = F.when(key == label, code).otherwise(picked)
    return picked


def result_code(declared: Column, predicted: Column, verdict: Column) -> Column:
    return F.when(declared == predicted, _pick(verdict, SAME_CODE)).otherwise(
        _pick(verdict, OTHER_CODE))


def initials(text: Column) -> Column:
    return F.upper(F.array_join(
        F.transform(F.split(text, " "), lambda word: F.left(word, F.lit(1))), ""))


def scope_verdict(status: Column, balance: Column) -> Column:
    """Why a commitment is out of scope; null when it is in scope."""
    return (
        F.when(status.isNull(), UNKNOWN)
        .when(status != IN_SCOPE, status)
        .when(balance == 0, NO_BALANCE)
    )


def scope_result(verdict: Column) -> Column:
    return (
        F.when(verdict == UNKNOWN, "UNK")
        .when(verdict == NO_BALANCE, "SNULO")
        .otherwise(initials(verdict))
    )


def stamp(as_of: dt.date) -> Column:
    return F.lit(as_of.strftime("%d/%m/%Y"))
