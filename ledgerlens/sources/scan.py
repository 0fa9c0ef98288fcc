"""Scans: JDBC, CSV on any Hadoop file system, parquet side tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schema as S
from ledgerlens.functions.names import normalise_columns, normalise_name
from ledgerlens.operators.filters import FIRST_YEAR, from_year, slice_condition

class EmptyInput(RuntimeError):
    """No commitment matches the filters of a run."""


class MissingColumns(ValueError):
    """A file's header lacks columns of the schema."""


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """CSV on local, HDFS or object storage: the columns of the schema, found by their names.

    Names in the header are normalised first, so display names work; their order is the file's,
    and further columns are ignored. Types are those of the schema, never inferred. Without a
    header, columns are taken by position. A file with quoted line breaks (``multi_line``) is one
    task, so large tables are better kept as many files, without line breaks, or as parquet.
    """
    schema = schema or S.commitment_schema()
    options = {"header": header, "encoding": "UTF-8", "multiLine": multi_line, "escape": '"'}
    if not header:
        return spark.read.schema(schema).csv(path, enforceSchema=True, **options)
    # all strings: only the header line is looked at
    found = [normalise_name(name) for name in spark.read.csv(path, **options).columns]
    missing = [f.name for f in schema.fields if f.name not in found]
    if missing:
        raise MissingColumns(f"no column {', '.join(missing)} in {path}")
    kinds = {f.name: f.dataType for f in schema.fields}
    first = {name: found.index(name) for name in kinds}
    places = T.StructType([
        T.StructField(f"_c{i}", kinds[name] if first.get(name) == i else T.StringType())
        for i, name in enumerate(found)])
    rows = spark.read.schema(places).csv(path, enforceSchema=True, **options)
    return rows.select(*[F.col(f"_c{first[name]}").alias(name) for name in kinds])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A side table (expired codes, validated commitments) with normalised headers."""
    if path.lower().rstrip("/").endswith(".csv"):
        raw = spark.read.csv(path, header=True, encoding="UTF-8", multiLine=True, escape='"')
    else:
        raw = spark.read.parquet(path)
    return normalise_columns(raw)


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    years: tuple[int, int] | None = None,
    partitions: int = 64,
) -> dict[str, str]:
    """Reader options; with ``years`` the scan is read in parallel ranges of the budget year."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", "pushDownPredicate": "true"}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value:
            options[key] = value
    if years:
        options.update(
            partitionColumn=f'"{S.SOURCE_HEADERS[0]}"', lowerBound=str(years[0]),
            upperBound=str(years[1] + 1), numPartitions=str(partitions))
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The 44 source columns with normalised names. Later filters are pushed to the database."""
    source = spark.read.format("jdbc").options(**options).load()
    return source.select(
        *[F.col(f"`{header}`").alias(normalise_name(header)) for header in S.SOURCE_HEADERS])


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Hash a plain scan over all cores if it has fewer splits than cores, as a small file has.

    A large table has more splits than cores and is left alone, so nothing large is shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def arrival(rows: DataFrame) -> Column:
    """What puts the rows of a scan in order: the file in name order, where its block starts, the
    place in the block. Spark packs blocks of several files into one task, large ones first, but
    never reorders a block, so the row number of a task decides only within one. Rows that are
    not those of a file scan (a database, a join) are in the order of their tasks."""
    place = F.monotonically_increasing_id().alias("place")
    try:
        rows.select("_metadata.file_path", "_metadata.file_block_start")
    except AnalysisException:
        return F.struct(F.lit("").alias("file"), F.lit(0).cast("long").alias("block"), place)
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), place)


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyInput("no commitment matches the filters")
    return df


def load_commitments(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    training: bool = False,
    as_of: dt.date | None = None,
    dates: Iterable[dt.date] | None = None,
    daterange: tuple[dt.date, dt.date] | None = None,
    orgaos: Iterable[str] | None = None,
    first_year: int = FIRST_YEAR,
) -> DataFrame:
    """Input of a job: the file if one is given, else the filtered database table.

    A file is read whole, unless dates or organs are named, which then select its rows. A training
    run on a database without filters reads all years from ``first_year``.
    """
    if path:
        if path.lower().rstrip("/").endswith(".csv"):
            rows = read_csv(spark, path)
        else:
            rows = normalise_columns(spark.read.parquet(path))
        if dates or daterange or orgaos:
            rows = rows.where(slice_condition(as_of or dt.date.today(), dates, daterange, orgaos))
        return rows
    if jdbc is None:
        raise ValueError("give a path or JDBC options")
    source = read_jdbc(spark, jdbc)
    condition: Column
    if training and not (dates or daterange or orgaos):
        condition = from_year(first_year)
    else:
        condition = slice_condition(as_of or dt.date.today(), dates, daterange, orgaos)
    return require_rows(source.where(condition))
