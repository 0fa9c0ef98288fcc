"""How the filters of a corpus interact: sorted posting lists of the documents that fail them.

For every part of the corpus and every filter the documents that fail it are kept as posting lists:
one list for each range of ids, holding increasing places among the range's sorted ids (so ids may
repeat). Ranges are cut by a distributed sort over part, id and row, so that no task holds more than
one range however large a part or frequent an id is. In a range the union of every set of filters
is made by galloping merges, list by list: the shorter list's places are searched in the longer one
and only those missing are merged in. Sizes of the ranges are summed; every order of the filters is
then plain arithmetic on them, since what a step removes is the difference of two unions.

Defined cases: a null part is the empty string, a null text is empty. Rows are documents of their
own: repeated rows count each. A document without an id is a copy of none, makes none a copy and
has no label. A label applies to all rows with its id; of several label rows one that is set is
enough, null is not set. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.tables import text_of
from ledgerlens.operators.lookup import lookup
from ledgerlens.sources.staging import staged

RANGE = 1 << 16  # documents of a range, at most

#: What separates words, as in the words of the other operators.
SEPARATORS = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of single texts: few words, few different words, many capitals, marks."""
    words = F.filter(F.split(text, SEPARATORS), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def bits(conditions: list[Column]) -> Column:
    out = F.lit(0)
    for at, condition in enumerate(conditions):
        out = out + F.when(F.coalesce(condition, F.lit(False)), 1 << at).otherwise(0)
    return out


def flagged(docs: DataFrame, filters: dict[str, Column], key: str = "doc_id",
            text: str = "text", part: str = "lang") -> DataFrame:
    """(part, id, row, digest, fails): one bit of ``fails`` for each of the filters."""
    return staged(docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(key).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.sha2(text_of(text).cast("binary"), 256).alias("digest"),
        bits(list(filters.values())).alias("fails")), "flagged")


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """Sets ``bit`` of the documents whose text some smaller id has.

    Smallest ids are combined before the shuffle; only texts that occur again are looked up, and a
    text with a large part of all rows is spread."""
    firsts = staged(
        rows.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .where("n > 1"), "firsts")
    found = lookup(rows, firsts.select("digest", "first"), "digest", "row",
                   weights=firsts.select("digest", "n"))
    is_copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return found.withColumn(
        "fails", F.col("fails") + F.when(is_copy, 1 << bit).otherwise(0)).drop("first", "digest")


def with_marks(rows: DataFrame, labels: DataFrame, marks: dict[str, Column],
               key: str = "doc_id") -> DataFrame:
    """Adds ``marks``: one bit for each condition on the labels of the document's id."""
    known = labels.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").cast("string").alias("_id"), *[
            F.coalesce(c, F.lit(False)).alias(f"_m{at}") for at, c in enumerate(marks.values())])
    table = staged(known.groupBy("_id").agg(
        bits([F.max(f"_m{at}") for at in range(len(marks))]).alias("marks")), "marks")
    found = lookup(rows.withColumn("_id", F.col("id").cast("string")), table, "_id", "row")
    return found.drop("_id").withColumn("marks", F.coalesce("marks", F.lit(0)))


def posting_lists(rows: DataFrame, filters: int, marks: int, most: int = RANGE) -> DataFrame:
    """(part, ids, failing, marked): of a range of documents of one part the sorted ids, and for
    each filter and mark the increasing places of its documents."""

    def lists(codes: np.ndarray, count: int) -> list[np.ndarray]:
        return [np.flatnonzero(codes >> at & 1).astype(np.int32) for at in range(count)]

    def packed(part: str, run: pa.Table) -> pa.RecordBatch:
        fails, marked = (run.column(c).to_numpy() for c in ("fails", "marks"))
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.string()),
            pa.array([run.column("id").to_pylist()], pa.list_(pa.int64())),
            pa.array([lists(fails, filters)], pa.list_(pa.list_(pa.int32()))),
            pa.array([lists(marked, marks)], pa.list_(pa.list_(pa.int32()))),
        ], names=["part", "ids", "failing", "marked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, size = None, [], 0
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1), len(parts)]
            for low, high in zip(edges, edges[1:], strict=False):
                while low < high:
                    if size and (parts[low] != part or size == most):
                        yield packed(part, pa.Table.from_batches(held))
                        held, size = [], 0
                    part, take = parts[low], min(high - low, most - size)
                    held.append(batch.slice(low, take))
                    size, low = size + take, low + take
        if size:
            yield packed(part, pa.Table.from_batches(held))

    order = ["part", "id", "row"]  # the row's number splits parts and ids of any frequency
    dealt = rows.select(*order, "fails", "marks").repartitionByRange(*order)
    return staged(dealt.sortWithinPartitions(*order).mapInArrow(
        run, "part string, ids array<long>, failing array<array<int>>, marked array<array<int>>"),
        "postings")


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which of the short list's places the long one has. Both increase, so that every search
    starts where the one before ended."""
    at = np.searchsorted(long, short)
    inside = at < len(long)
    inside[inside] = long[at[inside]] == short[inside]
    return inside


def union(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    short, long = (one, other) if len(one) <= len(other) else (other, one)
    new = short[~gallop(short, long)]
    return np.insert(long, np.searchsorted(long, new), new)


def difference(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return one[~gallop(one, other)]


def unions(failing: list[np.ndarray]) -> list[np.ndarray]:
    """The union of every set of lists; place s of the result is for the set with bits s."""
    out = [np.empty(0, np.int32)]
    for of_filter in failing:
        out += [union(known, of_filter) for known in out]
    return out


def union_sizes(postings: DataFrame, filters: int, marks: int) -> DataFrame:
    """(part, subset, n, n_0, n_1, ...): documents that fail a filter of the subset, and how many
    of them have each mark. The subset -1 stands for all documents."""
    counts = ["n", *[f"n_{at}" for at in range(marks)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                failing, marked = (
                    [np.asarray(x.values, np.int32) for x in batch.column(name)[row]]
                    for name in ("failing", "marked"))
                size = len(batch.column("ids")[row])
                sets = [np.arange(size, dtype=np.int32), *unions(failing)]
                found = [[len(s) for s in sets]] + [
                    [int(gallop(m, s).sum() if len(m) < len(s) else gallop(s, m).sum())
                     for s in sets] for m in marked]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("part")[row].as_py()] * len(sets), pa.string()),
                     pa.array(range(-1, len(sets) - 1), pa.int32()),
                     *[pa.array(x, pa.int64()) for x in found]],
                    names=["part", "subset", *counts])

    partial = postings.mapInArrow(
        run, "part string, subset int, " + ", ".join(f"{c} long" for c in counts))
    return partial.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in counts])


def failing_ids(postings: DataFrame, names: list[str], name: str,
                after: list[str] = []) -> DataFrame:
    """(part, id) of the documents that ``name`` removes behind the filters ``after``."""
    at, others = names.index(name), [names.index(x) for x in after]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lists = [np.asarray(x, np.int32) for x in row["failing"]]
                left = lists[at]
                for other in others:
                    left = difference(left, lists[other])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(left), pa.string()),
                     pa.array([row["ids"][i] for i in left], pa.int64())], names=["part", "id"])

    return postings.mapInArrow(run, "part string, id long")


def orders(sizes: DataFrame, names: list[str], marks: list[str]) -> DataFrame:
    """Every order of the filters and every step of it, from the sizes of the unions."""
    steps, everything = [], (1 << len(names)) - 1
    for order in permutations(range(len(names))):
        before = 0
        for step, at in enumerate(order, 1):
            steps.append({"filter_order": "".join(names[x] for x in order), "step": step,
                          "own": 1 << at, "before": before, "after": before | 1 << at,
                          "others": everything & ~(1 << at)})
            before |= 1 << at
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,"
                         "own:int,before:int,after:int,others:int>>")
    values = [c for c in sizes.columns if c not in ("part", "subset")]
    wide = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(
        F.struct("subset", F.struct(*values)))).alias("sizes"))

    def size(subset: Column | str, value: str = "n") -> Column:
        return F.col("sizes")[F.col(subset) if isinstance(subset, str) else subset][value]

    removed = size("after") - size("before")
    out = wide.select("part", "sizes", F.inline(listed)).select(
        "part", "filter_order", "step", "own",
        (size(F.lit(-1)) - size("after")).alias("kept"), removed.alias("removed"),
        (size("own") - removed).alias("redundant"),
        (size(F.lit(everything)) - size("others")).alias("unique_fails"),
        *[(size("after", f"n_{at}") - size("before", f"n_{at}")).alias(f"{mark}_lost")
          for at, mark in enumerate(marks)])
    # one row for each order and step of a part
    of_filter = Window.partitionBy("part", "own")
    return out.withColumn("shapley", F.sum("removed").over(of_filter)).drop("own")


def audit(docs: DataFrame, labels: DataFrame, marks: dict[str, Column],
          filters: dict[str, Column] | None = None, copies: str | None = "E",
          key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, <mark>_lost, shapley.

    ``filters`` are conditions on a document's columns by name; ``copies`` names one more, the
    documents whose text a smaller id has. ``marks`` are conditions on the columns of ``labels``.
    """
    filters = text_filters(text_of(text)) if filters is None else filters
    names = [*filters, *([copies] if copies else [])]
    rows = flagged(docs, filters, key, text, part)
    rows = with_copies(rows, len(filters)) if copies else rows.drop("digest")
    rows = with_marks(rows, labels, marks, key)
    lists = posting_lists(rows, len(names), len(marks))
    sizes = staged(union_sizes(lists, len(names), len(marks)), "sizes")
    return orders(sizes, names, list(marks))
