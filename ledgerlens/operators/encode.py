"""Fitted encodings in table form: process counts, ranges, vocabularies, term weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.derive import min_max
from ledgerlens.operators.lookup import lookup
from ledgerlens.operators.ranking import ordered_index
from ledgerlens.sources.staging import staged

PROCESS_COUNT = "empenhos_por_processo"


def fit_process_counts(train: DataFrame) -> DataFrame:
    counts = train.where(F.col(S.PROCESS).isNotNull()).groupBy(S.PROCESS).agg(
        F.count("*").alias("n"))
    return staged(counts, "process-counts")


def apply_process_counts(rows: DataFrame, counts: DataFrame, identifier: str = S.ID) -> DataFrame:
    """Adds the number of training rows of the same process, 0 for a process not seen there."""
    found = lookup(rows, counts.withColumnRenamed("n", "_n"), S.PROCESS, identifier)
    return found.withColumn(
        PROCESS_COUNT, F.coalesce("_n", F.lit(0)).cast("double")).drop("_n")


def fit_ranges(train: DataFrame, columns: list[str]) -> DataFrame:
    """(column, low, high) per numeric column, from one aggregation; NaN does not count."""
    ends = []
    for name in columns:
        value = F.col(f"`{name}`").cast("double")
        value = F.when(~F.isnan(value), value)
        ends.append(F.struct(F.lit(name).alias("column"), F.min(value).alias("low"),
                             F.max(value).alias("high")))
    return train.agg(F.array(*ends).alias("ends")).select(F.inline("ends"))


def scaled(ranges: DataFrame, columns: list[str]) -> dict[str, Column]:
    """Scaled form of each numeric column. ``ranges`` has one row per column, so its few numbers
    become literals of the projection. A missing amount counts as 0."""
    ends = {row["column"]: (row["low"], row["high"]) for row in ranges.collect()}

    def amount(name: str) -> Column:
        return F.coalesce(F.nanvl(F.col(f"`{name}`").cast("double"), F.lit(0.0)), F.lit(0.0))

    return {
        name: min_max(amount(name), *[F.lit(0.0 if end is None else end) for end in ends[name]])
        for name in columns
    }


def category_values(rows: DataFrame, columns: list[str], extra: list[str] = []) -> DataFrame:
    """(extra..., column, value) for every category of every row; a null is a category."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column"),
                 F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("nan")).alias("value"))
        for name in columns
    ])
    return rows.select(*extra, F.inline(pairs))


def fit_vocabulary(train: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, index): sorted distinct values of each category column, from 0.

    The distinct values are found with map-side combining and numbered without bringing the
    vocabulary of a column into one task.
    """
    values = category_values(train, columns).distinct()
    return staged(ordered_index(values, "column", "value"), "vocabulary")


def one_hot_positions(
    rows: DataFrame, vocabulary: DataFrame, columns: list[str], identifier: str = S.ID
) -> DataFrame:
    """(identifier, column, index) of the ones; a value not in the vocabulary gives no row.

    A frequent value is a hot join key, which ``lookup`` spreads.
    """
    cell = F.concat_ws("=", "column", "value").alias("_cell")
    cells = category_values(rows, columns, [identifier]).select(identifier, "column", cell)
    known = vocabulary.select(cell, "index")
    return lookup(cells, known, "_cell", identifier).where(F.col("index").isNotNull()).select(
        identifier, "column", "index")


def term_counts(terms: Column) -> Column:
    """Array of (term, tf) of one text: sort its terms, then measure the runs.

    All inside the row, so counting terms needs no shuffle.
    """
    ordered = F.sort_array(terms)

    def runs(holder: Column) -> Column:
        ordered, starts, size = holder["terms"], holder["starts"], F.size(holder["terms"])
        return F.transform(starts, lambda start, i: F.struct(
            ordered[start].alias("term"),
            (F.coalesce(F.get(starts, i + 1), size) - start).alias("tf"),
        ))

    def with_starts(ordered: Column) -> Column:
        positions = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1))
        starts = F.filter(
            F.coalesce(positions, F.array().cast("array<int>")),
            lambda i: (i == 0) | (ordered[i] != F.get(ordered, i - 1)),
        )
        return F.struct(ordered.alias("terms"), starts.alias("starts"))

    from ledgerlens.functions.stemming import let

    return let(let(ordered, with_starts), runs)


def text_terms(rows: DataFrame, identifier: str, terms: Column) -> DataFrame:
    """(identifier, term, tf), one row per distinct term of a text."""
    return rows.select(identifier, F.inline(term_counts(terms)))


def document_frequencies(counted: DataFrame) -> DataFrame:
    return staged(counted.groupBy("term").agg(F.count("*").alias("df")), "document-frequency")


def inverse_frequency(df: Column, documents: int) -> Column:
    return F.log((F.lit(1.0) + documents) / (F.lit(1.0) + df)) + 1.0


def term_weights(
    counted: DataFrame, frequencies: DataFrame, documents: int, identifier: str,
    keep: list[str] = [],
) -> DataFrame:
    """(identifier, term, weight): tf times smoothed idf, scaled to length 1 per text; ``keep``
    names further columns of the frequencies. Terms that were not counted there are left out.

    Terms that occur in a large part of the texts are hot join keys; ``lookup`` spreads them.
    The norm is a window over one text's distinct terms.
    """
    idf = frequencies.select(
        "term", inverse_frequency(F.col("df"), documents).alias("idf"), *keep)
    weighted = (
        lookup(counted, idf, "term", identifier,
               weights=frequencies.select("term", F.col("df").alias("n")))
        .where(F.col("idf").isNotNull())
        .withColumn("raw", F.col("tf") * F.col("idf"))
    )
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(identifier)))
    return weighted.select(identifier, "term", *keep, (F.col("raw") / norm).alias("weight"))
