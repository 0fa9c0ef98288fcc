import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions import derive
from ledgerlens.functions.verdict import initials, result_code
from ledgerlens.operators import filters, merge, scope

ROWS = f"{S.ID} string, {S.CODE} string, {S.BALANCE} double"


def ids(df):
    return sorted(r[S.ID] for r in df.collect())


def test_positive_balance_drops_zero_negative_nan_and_null(spark):
    rows = spark.createDataFrame(
        [("a", "x", 1.0), ("b", "x", 0.0), ("c", "x", -1.0), ("d", "x", float("nan")),
         ("e", "x", None)], ROWS)
    kept, dropped = filters.split_by(rows, filters.positive_balance())
    assert ids(kept) == ["a"] and ids(dropped) == ["b", "c", "d", "e"]


def test_element_92_needs_the_whole_code(spark):
    rows = spark.createDataFrame(
        [("a", "3.1.90.92.01", 1.0), ("b", "3.1.90.92.011", 1.0), ("c", "x3.1.90.92.01", 1.0),
         ("d", "3.1.90.92.01\n", 1.0), ("e", "3.1.92.90.01", 1.0)], ROWS)
    assert ids(rows.where(filters.element_92())) == ["a"]


def test_several_dates_and_organs_are_alternatives(spark):
    rows = spark.createDataFrame(
        [("a", "2020/01/01", "X"), ("b", "2020/01/02", "Y"), ("c", "2020/01/03", "X")],
        f"{S.ID} string, periodo string, orgao string")
    as_of = dt.date(2020, 1, 4)
    day = [dt.date(2020, 1, d) for d in (1, 2)]
    assert ids(rows.where(filters.slice_condition(as_of, dates=day))) == ["a", "b"]
    assert ids(rows.where(filters.slice_condition(as_of, dates=day, orgaos=["Y", "Z"]))) == ["b"]
    assert ids(rows.where(filters.slice_condition(as_of))) == ["c"]
    assert ids(rows.where(filters.slice_condition(
        as_of, daterange=(dt.date(2020, 1, 3), dt.date(2020, 1, 2))))) == ["b", "c"]


def scope_fixture(spark):
    rows = (
        [(f"n{i}", "3.1.90.92.01", 1.0) for i in range(3)]      # element 92, also expired
        + [(f"z{i}", "3.1.90.92.02", 0.0) for i in range(3)]    # element 92, never positive
        + [(f"e{i}", "3.1.90.30.05", 2.0) for i in range(3)]    # expired
        + [(f"a{i}", "3.1.90.30.01", 2.0) for i in range(5)]    # large class
        + [(f"b{i}", "3.1.90.30.02", 2.0) for i in range(2)]    # small class
        + [("s0", "3.1.90.30.03", 2.0), ("m0", "3.1.90.30.04", -2.0), ("u0", None, 2.0)]
    )
    expired = spark.createDataFrame([("3.1.90.92.01",), ("3.1.90.30.05",)], "nat_despesa string")
    return spark.createDataFrame(rows, ROWS), expired


def test_scope_map_and_sections(spark):
    rows, expired = scope_fixture(spark)
    profile = scope.code_profile(rows, expired, floor=5)
    status = {r.natureza: r.status for r in scope.scope_map(profile).collect()}
    assert status == {
        "3.1.90.92.01": "Classe 92", "3.1.90.92.02": "Em escopo",
        "3.1.90.30.05": "Classe com vigência expirada", "3.1.90.30.01": "Em escopo",
        "3.1.90.30.02": "Em escopo", "3.1.90.30.03": "Em escopo", "3.1.90.30.04": "Em escopo",
    }
    cleaned = scope.cleaned_rows(rows, profile)
    assert {r[S.ID]: r.section for r in cleaned.collect()} == {
        **{f"a{i}": "above" for i in range(5)}, "b0": "below", "b1": "below"}


def test_funnel_adds_up(spark):
    rows, expired = scope_fixture(spark)
    steps = scope.cleaning_funnel(scope.code_profile(rows, expired, floor=5)).collect()
    by_name = {s.step: s for s in steps}
    assert by_name["positive_balance"].rows_kept == 14
    for before, after in zip(steps[:3], steps[1:4]):
        assert before.rows_kept == after.rows_kept + after.rows_dropped
    last = by_name["not_expired"].rows_kept
    assert by_name["above_floor"].rows_kept + by_name["above_floor"].rows_dropped == last
    assert by_name["below_floor"].rows_dropped == 1


def test_floor_of_one_keeps_single_rows_above(spark):
    rows, expired = scope_fixture(spark)
    profile = scope.code_profile(rows, expired, floor=1)
    sections = {r[S.CODE]: r.section for r in profile.collect()}
    assert sections["3.1.90.30.03"] == "above" and sections["3.1.90.30.04"] is None


def test_out_of_scope_reasons(spark):
    known = spark.createDataFrame(
        [("k", "Em escopo"), ("n", "Classe 92"), ("x", "Classe com vigência expirada")],
        "natureza string, status string")
    rows = spark.createDataFrame(
        [("1", "k", 5.0), ("2", "k", 0.0), ("3", "k", -5.0), ("4", "k", float("nan")),
         ("5", "n", 0.0), ("6", "x", 1.0), ("7", "?", 0.0), ("8", None, 1.0)], ROWS)
    assert ids(scope.in_scope(rows, known)) == ["1", "3", "4"]
    noted = scope.out_of_scope(rows, known).select(
        S.ID, merge.scope_result(F.col("scope_note")).alias("r")).collect()
    assert {r[S.ID]: r.r for r in noted} == {
        "2": "SNULO", "5": "C9", "6": "CCVE", "7": "UNK", "8": "UNK"}


@pytest.mark.parametrize("declared, predicted, verdict, code", [
    ("a", "a", "INCORRETO", "INCV_M2"), ("a", "a", "OK", "C_M1-M2"),
    ("a", "a", "INCONCLUSIVO", "AD_M2"), ("a", "b", "INCORRETO", "INCT_M1-M2"),
    ("a", "b", "OK", "INCV_M1"), ("a", "b", "INCONCLUSIVO", "INCV_M1-AD_M2"), ("a", "b", "?", None),
    ("a", "a", None, None),
])
def test_result_codes(spark, declared, predicted, verdict, code):
    row = spark.createDataFrame([(declared, predicted, verdict)], "d string, p string, v string")
    assert row.select(result_code(F.col("d"), F.col("p"), F.col("v")).alias("r")).first().r == code


def test_initials(spark):
    row = spark.createDataFrame([("Classe com vigência expirada",)], "s string")
    assert row.select(initials(F.col("s")).alias("r")).first().r == "CCVE"


def test_last_write_wins(spark):
    rows = spark.createDataFrame([
        # scored rows overwrite notes, and the declared code is the last row's
        ("a", "x", 1, None, "x", "OK"), ("a", "y", 2, "Classe 92", None, None),
        ("b", "x", 1, "Classe 92", None, None), ("b", "x", 2, "Saldo zerado", None, None),
        ("c", "x", 1, None, "x", "OK"), ("c", "x", 2, None, "z", "INCORRETO"),
    ], f"{S.ID} string, {S.CODE} string, at int, scope_note string, predicted string, verdict string")
    found = {r["Identificador"]: r for r in
             merge.keyed_merge(rows, ["at"], dt.date(2020, 5, 6)).collect()}
    assert len(found) == 3
    assert tuple(found["a"])[1:] == ("y", "x", "OK", "06/05/2020", "INCV_M1")
    assert tuple(found["b"])[1:] == ("x", "Saldo zerado", "Saldo zerado", "06/05/2020", "SNULO")
    assert tuple(found["c"])[1:] == ("x", "z", "INCORRETO", "06/05/2020", "INCT_M1-M2")


def test_ensemble_ties_go_to_the_large_classes(spark):
    rows = spark.createDataFrame(
        [("a", "b", [0.5, 0.5], [0.5]), ("a", "b", [0.4, 0.1], [0.5])],
        "a string, b string, pa array<double>, pb array<double>")
    picked = rows.select(merge.ensemble_pick(*[F.col(c) for c in ("a", "b", "pa", "pb")]).alias("p"))
    assert [r.p for r in picked.collect()] == ["a", "b"]


@pytest.mark.parametrize("value, month", [
    ("2020/03/01", 3), ("2020-3-1", 3), ("03/25/2020", 3), ("25/03/2020", 3), ("43891", 3),
    ("2020-03-01 00:00:00", 3), ("not a date", None), (None, None),
])
def test_month(spark, value, month):
    row = spark.createDataFrame([(value,)], "p string")
    assert row.select(derive.month_of(F.col("p")).alias("m")).first().m == month


def test_derived_flags(spark):
    row = spark.createDataFrame(
        [("-", "X", None, "2045 - ACAO 1", "1001 - PROGRAMA")],
        "cpf string, o string, s string, a string, p string").select(
        derive.legal_person(F.col("cpf")).alias("legal"),
        derive.succeeded_organ(F.col("o"), F.col("s")).alias("succeeded"),
        derive.action_program(F.col("a"), F.col("p")).alias("both")).first()
    assert tuple(row) == (1, 1, "ACAO 1 & PROGRAMA")
