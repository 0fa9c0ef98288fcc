"""Which expense codes the classifiers cover, and which rows each of them learns from.

All class-level rules need only two counts per code, so one aggregation with map-side combining
replaces a chain of passes over the rows. The result has one row per code; rows meet it again
through a size-checked broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.verdict import ELEMENT_92, EXPIRED, IN_SCOPE, scope_verdict
from ledgerlens.operators.filters import element_92, positive_balance
from ledgerlens.operators.lookup import lookup
from ledgerlens.sources.staging import checked_broadcast, staged

POPULATION_FLOOR = 200
SMALLEST_CLASS = 2


def code_profile(df: DataFrame, expired: DataFrame, floor: int = POPULATION_FLOOR) -> DataFrame:
    """Per code: rows, rows with a positive balance, scope status and section (staged)."""
    listed = expired.select(F.col("nat_despesa").alias(S.CODE), F.lit(True).alias("listed"))
    counts = (
        df.where(F.col(S.CODE).isNotNull())
        .groupBy(S.CODE)
        .agg(F.count("*").alias("n"), F.count_if(positive_balance()).alias("n_pos"))
        .join(checked_broadcast(listed.distinct()), S.CODE, "left")
        .withColumn("is_92", element_92())
        .withColumn("is_expired", F.coalesce("listed", F.lit(False)))
    )
    left = F.col("n_pos") > 0
    status = (
        F.when(left & F.col("is_92"), ELEMENT_92)
        .when(left & F.col("is_expired"), EXPIRED)
        .otherwise(IN_SCOPE)
    )
    section = (
        F.when(F.col("is_92") | F.col("is_expired") | ~left, None)
        .when(F.col("n_pos") >= floor, "above")
        .when(F.col("n_pos") >= SMALLEST_CLASS, "below")
    )
    return staged(
        counts.select(S.CODE, "n", "n_pos", "is_92", "is_expired",
                      status.alias("status"), section.alias("section")),
        "codes",
    )


def scope_map(profile: DataFrame) -> DataFrame:
    return profile.select(F.col(S.CODE).alias("natureza"), "status")


def cleaned_rows(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Training rows with the section that learns from them."""
    sections = profile.where(F.col("section").isNotNull()).select(S.CODE, "section")
    found = lookup(df.where(positive_balance()), sections, S.CODE, S.ID)
    return found.where(F.col("section").isNotNull())


def cleaning_funnel(profile: DataFrame) -> DataFrame:
    """Rows and classes kept and dropped at every cleaning step, from the per-code counts."""
    n_pos, is_92, expired = F.col("n_pos"), F.col("is_92"), F.col("is_expired")
    section = F.col("section")
    zero = F.lit(0).cast("long")

    def tally(step: str, order: int, kept: Column, dropped: Column) -> Column:
        def rows(part: Column) -> Column:
            return F.coalesce(F.sum(part), zero)

        def classes(part: Column) -> Column:
            return F.count_if(part > 0)

        return F.struct(
            F.lit(order).alias("step_no"), F.lit(step).alias("step"),
            rows(kept).alias("rows_kept"), classes(kept).alias("classes_kept"),
            rows(dropped).alias("rows_dropped"), classes(dropped).alias("classes_dropped"),
        )

    def only(condition: Column, count: Column = n_pos) -> Column:
        return F.when(condition, count).otherwise(zero)

    current = ~is_92 & ~expired
    steps = F.array(
        tally("initial", 0, F.col("n"), zero),
        tally("positive_balance", 1, n_pos, F.col("n") - n_pos),
        tally("not_element_92", 2, only(~is_92), only(is_92)),
        tally("not_expired", 3, only(current), only(~is_92 & expired)),
        tally("above_floor", 4, only(F.coalesce(section == "above", F.lit(False))),
              only(current & ~F.coalesce(section == "above", F.lit(False)))),
        tally("below_floor", 5, only(F.coalesce(section == "below", F.lit(False))),
              only(current & section.isNull())),
    )
    return profile.agg(steps.alias("steps")).select(F.inline("steps"))


def with_scope(df: DataFrame, scope: DataFrame) -> DataFrame:
    """Adds ``scope_note``: null for a row in scope, else why it is out of scope."""
    known = scope.select(F.col("natureza").alias(S.CODE), F.col("status").alias("_status"))
    return (
        lookup(df, known, S.CODE, S.ID)
        .withColumn("scope_note", scope_verdict(F.col("_status"), F.col(S.BALANCE)))
        .drop("_status")
    )


def in_scope(df: DataFrame, scope: DataFrame) -> DataFrame:
    return with_scope(df, scope).where(F.col("scope_note").isNull()).drop("scope_note")


def out_of_scope(df: DataFrame, scope: DataFrame) -> DataFrame:
    return with_scope(df, scope).where(F.col("scope_note").isNotNull())


def class_frequencies(df: DataFrame, column: str = S.CODE) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
    )


def class_count(df: DataFrame, column: str = S.CODE) -> DataFrame:
    """Number of distinct labels: the labels are combined before they are counted."""
    labels = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.lit(1).alias("one"))
    return labels.agg(F.count("*").alias("n_classes"))
