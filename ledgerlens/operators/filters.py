"""Row filters and column projections over commitments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.sources.staging import checked_broadcast, staged

# Fixed value: the form of an expense code whose element is 92.
ELEMENT_92_FORM = r"^\d[.]\d[.]\d\d[.]92[.]\d\d\z"
FIRST_YEAR = 2015


def project(df: DataFrame, column_set: str) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in S.COLUMN_SETS[column_set]])


def period_text(day: dt.date) -> str:
    return day.strftime("%Y/%m/%d")


def from_year(first: int = FIRST_YEAR) -> Column:
    return F.col(S.YEAR) >= first


def on_dates(days: Iterable[dt.date]) -> Column:
    return F.col(S.PERIOD).isin([period_text(day) for day in days])


def in_date_range(one: dt.date, other: dt.date) -> Column:
    return F.col(S.PERIOD).between(period_text(min(one, other)), period_text(max(one, other)))


def on_previous_day(as_of: dt.date) -> Column:
    return F.col(S.PERIOD) == period_text(as_of - dt.timedelta(days=1))


def of_organs(organs: Iterable[str]) -> Column:
    return F.col(S.ORGAN).isin(list(organs))


def slice_condition(
    as_of: dt.date,
    dates: Iterable[dt.date] | None = None,
    daterange: tuple[dt.date, dt.date] | None = None,
    orgaos: Iterable[str] | None = None,
) -> Column:
    """Which commitments a dated run reads: the given dates, else the range, else the day before
    ``as_of``; optionally only some organs. Scans push this down."""
    if dates:
        condition = on_dates(dates)
    elif daterange:
        condition = in_date_range(*daterange)
    else:
        condition = on_previous_day(as_of)
    return condition & of_organs(orgaos) if orgaos else condition


def positive_balance(balance: Column | None = None) -> Column:
    balance = F.col(S.BALANCE) if balance is None else balance
    return F.coalesce((balance > 0) & ~F.isnan(balance), F.lit(False))


def element_92(code: Column | None = None) -> Column:
    return (F.col(S.CODE) if code is None else code).rlike(ELEMENT_92_FORM)


def split_by(df: DataFrame, mask: Column) -> tuple[DataFrame, DataFrame]:
    holds = F.coalesce(mask, F.lit(False))
    return df.where(holds), df.where(~holds)


def without_codes(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    codes = listed.select(F.col(column).alias(S.CODE))
    return df.join(checked_broadcast(codes), S.CODE, "left_anti")


def with_codes(df: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    codes = listed.select(F.col(column).alias(S.CODE))
    return df.join(checked_broadcast(codes), S.CODE, "left_semi")


def frequent_codes(df: DataFrame, floor: int) -> DataFrame:
    """Rows whose code occurs at least ``floor`` times."""
    counts = df.groupBy(S.CODE).agg(F.count("*").alias("n")).where(F.col("n") >= floor)
    return with_codes(df, staged(counts, "frequent"), S.CODE)
