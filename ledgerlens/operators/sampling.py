"""Reproducible samples, stratified splits, folds and label codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.ranking import (
    GROUP, at_or_before, group_sizes, histogram, keyed, numbered_copies, ordered_index, rank_cuts,
)
from ledgerlens.sources.staging import checked_broadcast

SEED = 15


def sample_rows(rows: DataFrame, n: int, identifier: str, seed: int = SEED) -> DataFrame:
    """``n`` rows with the smallest hash of (identifier, seed); all rows if there are fewer.

    Exactly n, also where the last identifier has more copies than are still wanted."""
    marked = keyed(rows, identifier, None, seed)
    hist = histogram(marked)
    total = hist.agg(F.sum("n").alias("n")).first()["n"] or 0
    if n >= total:
        return rows
    if n <= 0:
        return rows.limit(0)
    targets = group_sizes(hist).select(GROUP, F.lit(0).alias("cut"), F.lit(n).alias("rank"))
    cuts = rank_cuts(marked, hist, targets)
    numbered = numbered_copies(marked, cuts).join(checked_broadcast(cuts), GROUP)
    return numbered.where(at_or_before(F.col("cuts")[0])).select(*rows.columns)


def quotas(sizes: DataFrame, label: str, percent: int) -> DataFrame:
    """Held-out rows per class: proportional, largest remainders first, ceil(percent) in total.

    ``sizes`` has one row per class, so its window sorts class labels and never data rows.
    """
    everything = Window.partitionBy(F.lit(0))  # one row per class: bounded by the labels
    product = F.col("n").cast("decimal(18,0)") * F.col("wanted").cast("decimal(18,0)")
    shares = (
        sizes.withColumn("total", F.sum("n").over(everything))
        .withColumn("wanted", F.expr(f"(total * {percent} + 99) div 100"))
        .withColumn("product", product)
        .withColumn("whole", F.expr("product div total"))
        .withColumn("remainder", F.col("product") % F.col("total"))
        .withColumn("missing", F.col("wanted") - F.sum("whole").over(everything))
        .withColumn("turn", F.row_number().over(
            everything.orderBy(F.desc("remainder"), F.asc(label))))
    )
    extra = F.when(F.col("turn") <= F.col("missing"), 1).otherwise(0)
    return shares.select(label, "n", (F.col("whole") + extra).cast("long").alias("quota"))


def stratified_split(
    rows: DataFrame, label: str, identifier: str, percent: int, seed: int = SEED,
) -> DataFrame:
    """Adds ``is_test`` to exactly the quota of each class. Copies of one identifier stay on the
    same side but for the identifier at the cut, of which as many go to the test as are missing.

    Only the histogram, one bucket per class and the copies at the cuts are shuffled; the other
    rows are compared with the cut where they lie.
    """
    marked = keyed(rows, identifier, label, seed)
    hist = histogram(marked.where(F.col(label).isNotNull()))
    targets = (
        quotas(group_sizes(hist), GROUP, percent)
        .where("quota > 0")
        .select(GROUP, F.lit(0).alias("cut"), F.col("quota").alias("rank"))
    )
    cuts = rank_cuts(marked, hist, targets)
    joined = numbered_copies(marked, cuts).join(checked_broadcast(cuts), GROUP, "left")
    is_test = F.coalesce(at_or_before(F.col("cuts")[0]), F.lit(False))
    return joined.select(*rows.columns, is_test.alias("is_test"))


def fold_sizes(sizes: DataFrame, label: str, folds: int) -> DataFrame:
    """Rows of each class in each fold: the classes, laid end to end in label order, are dealt
    round robin, so folds differ by at most one row overall and within a class."""
    before = Window.partitionBy(F.lit(0)).orderBy(label).rowsBetween(
        Window.unboundedPreceding, -1)
    dealt = sizes.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))

    def upto(position: str, fold: int) -> Column:
        return F.expr(f"({position} + {folds - 1 - fold}) div {folds}")

    return dealt.select(
        label, "n",
        F.array(*[upto("start + n", i) - upto("start", i) for i in range(folds)]).alias("sizes"),
    )


def stratified_folds(
    rows: DataFrame, label: str, identifier: str, folds: int = 3, seed: int = SEED,
) -> DataFrame:
    """Adds ``fold``: consecutive blocks of each class in hash order."""
    marked = keyed(rows, identifier, label, seed)
    hist = histogram(marked.where(F.col(label).isNotNull()))
    sizes = fold_sizes(group_sizes(hist), GROUP, folds)
    upto = [F.aggregate(F.slice("sizes", 1, i + 1), F.lit(0).cast("long"), lambda a, b: a + b)
            for i in range(folds - 1)]
    targets = (
        sizes.select(GROUP, F.posexplode(F.array(*upto)).alias("cut", "rank")).where("rank > 0")
    )
    cuts = rank_cuts(marked, hist, targets)
    joined = numbered_copies(marked, cuts).join(checked_broadcast(cuts), GROUP, "left")
    # A cut that is missing (rank 0) lies before every row, like one that was passed.
    reached = F.filter(F.coalesce("cuts", F.array()), at_or_before)
    fold = F.when(F.size(reached) == 0, F.lit(folds - 1)).otherwise(reached[0]["cut"])
    return joined.select(*rows.columns, fold.cast("int").alias("fold"))


def label_codes(rows: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels numbered from 0."""
    labels = rows.where(F.col(label).isNotNull()).select(F.lit(0).alias(GROUP), label).distinct()
    return ordered_index(labels, GROUP, label).select(label, F.col("index").alias("code"))


def encode_labels(rows: DataFrame, label: str, codes: DataFrame) -> DataFrame:
    return rows.join(checked_broadcast(codes), label)


def decode_labels(rows: DataFrame, code: str, codes: DataFrame) -> DataFrame:
    """Replace a column of numbers by the labels they stand for."""
    names = codes.select(F.col("code").alias(code), F.col(codes.columns[0]).alias("_name"))
    decoded = rows.join(checked_broadcast(names), code, "left")
    return decoded.select(*[
        F.col("_name").alias(c) if c == code else F.col(f"`{c}`") for c in rows.columns])
