"""Exact ranks inside large groups without sorting a group in one task.

For random ranks, rows carry a hexadecimal hash key. A histogram over the first digits of the
key, built with map-side combining, tells in which bucket each wanted rank lies; only that bucket
is sorted. For ranks in value order, the values are range-partitioned into files first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources.staging import checked_broadcast, staged

KEY, TIE, BUCKET, GROUP, COPY = "_key", "_tie", "_bucket", "_group", "_copy"

# Hexadecimal digits of the first and of the second histogram, and the rows that may be sorted
# in one task.
DIGITS, FINE_DIGITS = 2, 4
SORTABLE = 1_000_000


def hash_key(identifier: Column, seed: int) -> Column:
    return F.md5(F.concat(identifier.cast("string"), F.lit(f":{seed}")).cast("binary"))


def keyed(rows: DataFrame, identifier: str, group: str | None, seed: int) -> DataFrame:
    """Rows with their group, hash key and identifier; a null identifier counts as ''."""
    tie = F.coalesce(F.col(identifier).cast("string"), F.lit(""))
    return (
        rows.withColumn(GROUP, F.col(group) if group else F.lit(""))
        .withColumn(KEY, hash_key(tie, seed))
        .withColumn(TIE, tie)
        .withColumn(BUCKET, F.substring(KEY, 1, DIGITS))
    )


def histogram(keyed_rows: DataFrame) -> DataFrame:
    counts = keyed_rows.groupBy(GROUP, BUCKET).agg(F.count("*").alias("n"))
    return staged(counts, "histogram")


def group_sizes(hist: DataFrame) -> DataFrame:
    return hist.groupBy(GROUP).agg(F.sum("n").alias("n"))


def _locate(counts: DataFrame, groups: list[str], bucket: str) -> DataFrame:
    """Of (groups, bucket, n, rank) keep the bucket that holds the rank, as (..., n, within).

    The window sees one row per bucket of a group, never data rows."""
    running = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)
    before = F.col("upto") - F.col("n")
    return (
        counts.withColumn("upto", F.sum("n").over(running))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > before))
        .select(*groups, bucket, "n", (F.col("rank") - before).alias("within"))
    )


def rank_cuts(keyed_rows: DataFrame, hist: DataFrame, targets: DataFrame) -> DataFrame:
    """Key of the row at each wanted rank.

    ``targets`` has (group, cut, rank), rank counted from 1; the result has one row per group
    with an array of (cut, key, tie, copy): the identifier at the rank, and how many of its copies
    rank no later. The rows of the buckets that hold a rank, a small part of
    all rows, are written out; where such a bucket is still large, a second histogram over the
    next digits narrows it down before anything is sorted.
    """
    edges = staged(_locate(hist.join(targets, GROUP), [GROUP, "cut"], BUCKET), "edges")
    rows = keyed_rows.select(GROUP, BUCKET, KEY, TIE).join(
        checked_broadcast(edges), [GROUP, BUCKET])
    if (edges.agg(F.max("n").alias("n")).first()["n"] or 0) > SORTABLE:
        fine = F.substring(KEY, F.length(BUCKET) + 1, F.lit(FINE_DIGITS))
        rows = staged(rows.drop("n").withColumn("_fine", fine), "boundary")
        counts = rows.groupBy(GROUP, "cut", "_fine", F.col("within").alias("rank")).agg(
            F.count("*").alias("n"))
        narrow = staged(_locate(counts, [GROUP, "cut"], "_fine"), "narrow")
        rows = rows.drop("within").join(checked_broadcast(narrow), [GROUP, "cut", "_fine"])
    # Copies of one identifier are counted before they are sorted, so a row stands for all of them.
    copies = rows.groupBy(GROUP, "cut", KEY, TIE).agg(
        F.count("*").alias("n"), F.first("within").alias("within"))
    order = Window.partitionBy(GROUP, "cut").orderBy(KEY, TIE).rowsBetween(
        Window.unboundedPreceding, 0)
    before = F.col("upto") - F.col("n")
    at_rank = (
        copies.withColumn("upto", F.sum("n").over(order))
        .where((F.col("upto") >= F.col("within")) & (before < F.col("within")))
        .withColumn(COPY, F.col("within") - before)
    )
    return staged(
        at_rank.groupBy(GROUP).agg(
            F.sort_array(F.collect_list(F.struct("cut", KEY, TIE, COPY))).alias("cuts")),
        "cuts",
    )


def numbered_copies(keyed_rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Keyed rows with the number of the copy, from 1, of identifiers that a cut names.

    Only those rows are written out. A file's rows are numbered where they lie, after those of
    earlier files, so copies of one identifier need not meet in one task. Other rows get 1, which
    no comparison looks at.
    """
    edges = cuts.select(GROUP, F.explode("cuts").alias("cut")).select(
        GROUP, f"cut.{KEY}", f"cut.{TIE}").distinct().withColumn("_edge", F.lit(True))
    marked = keyed_rows.join(checked_broadcast(edges), [GROUP, KEY, TIE], "left")
    rest = marked.where(F.col("_edge").isNull()).drop("_edge").withColumn(
        COPY, F.lit(1).cast("long"))
    found = staged(marked.where("_edge").drop("_edge"), "copies").withColumn(
        "_file", F.col("_metadata.file_name")).withColumn("_at", F.col("_metadata.row_index"))
    earlier = Window.partitionBy(GROUP, TIE).orderBy("_file").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = staged(
        found.groupBy(GROUP, TIE, "_file").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(GROUP, TIE, "_file", "_start"), "starts")
    place = F.row_number().over(Window.partitionBy(GROUP, TIE, "_file").orderBy("_at"))
    numbered = found.join(checked_broadcast(starts), [GROUP, TIE, "_file"]).withColumn(
        COPY, (F.col("_start") + place).cast("long"))
    return rest.unionByName(numbered.select(*rest.columns))


def at_or_before(cut: Column) -> Column:
    """Whether a keyed row ranks no later than the row the cut names."""
    return F.struct(KEY, TIE, COPY) <= F.struct(
        cut[KEY].alias(KEY), cut[TIE].alias(TIE), cut[COPY].alias(COPY))


def ordered_index(values: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct (group, value) rows numbered from 0 within their group, in value order.

    A distributed sort is written out; a file then holds a contiguous run of a group, so a number
    is the rows of the group in earlier files plus the place within the file. No task sees more
    than one file's rows, however large a vocabulary is.
    """
    runs = staged(values.orderBy(group, value), "ordered").withColumn(
        "_file", F.col("_metadata.file_name"))
    earlier = Window.partitionBy(group).orderBy("_first").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = staged(
        runs.groupBy(group, "_file").agg(F.count("*").alias("_n"), F.min(value).alias("_first"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(group, "_file", "_start"),
        "starts",
    )
    place = F.row_number().over(Window.partitionBy(group, "_file").orderBy(value)) - 1
    return (
        runs.join(checked_broadcast(starts), [group, "_file"])
        .withColumn("index", (F.col("_start") + place).cast("int"))
        .select(*values.columns, "index")
    )
