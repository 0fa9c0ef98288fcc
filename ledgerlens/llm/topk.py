"""Exact top-k inner products by columnar branch and bound.

Vectors become whole numbers, floor(scale * x), and are kept in blocks of vertical layout: one row
of the block's matrix is one dimension of all its vectors. A block of queries meets every block of
candidates. Scores accumulate one block of dimensions at a time, those with the most mass first;
what the remaining dimensions can still add is bounded by the remaining mass of query and
candidate (Cauchy-Schwarz). Candidates whose upper bound falls below the k-th lower bound are
dropped, and the survivors are compacted before the next block. The k best of each pair of blocks
then meet in one ranking per query.

Defined cases: vectors that are null or hold null or non-finite components, and rows without an
id, take no part. Missing components of shorter vectors count as 0. A query meets every row but
itself; other rows with its id are met. Ties go to the smaller id, rows that tie in that, too, are
kept in any order, and their ranks differ. Sums are exact below 2 ** 63. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources.staging import staged

CANDIDATES = 16_384  # vectors of a block
QUERIES = 4_096
AT_ONCE = 256        # queries whose scores are held at once
DIMENSIONS = 16      # accumulated between two rounds of pruning
SPARSE = 0.25        # share of survivors from which on candidates are compacted one query at a time


def usable(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x.cast("double")) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def narrowest(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers in the smallest type that holds them all."""
    low, high = matrix.min(initial=0), matrix.max(initial=0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return matrix.astype(kind)
    return matrix


def blocks(rows: DataFrame, size: int, scale: float, label: str) -> DataFrame:
    """(rid, id, vector) -> (block, rids, ids, dims, kind, data): vectors of a block, vertically,
    numbers of the type ``kind``."""
    count = max(1, -(-rows.count() // size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        vectors = table.column("vector").combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.chunk(0)
        n = vectors.value_lengths().to_numpy()
        dims = int(n.max())
        matrix = np.zeros((dims, len(n)))
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        matrix[place, row] = np.floor(scale * vectors.flatten().to_numpy().astype(np.float64))
        matrix = narrowest(matrix)
        yield pa.RecordBatch.from_arrays(
            [table.column("part").combine_chunks().slice(0, 1).cast(pa.int64()),
             pa.array([table.column("rid").to_numpy().tobytes()], pa.binary()),
             pa.array([table.column("id").to_numpy().tobytes()], pa.binary()),
             pa.array([dims], pa.int32()), pa.array([matrix.dtype.name]),
             pa.array([matrix.tobytes()], pa.binary())],
            names=["block", "rids", "ids", "dims", "kind", "data"])

    # every partition is one block: a repartition without a key deals rows out evenly
    dealt = rows.repartition(count).select("rid", "id", "vector",
                                           F.spark_partition_id().alias("part"))
    return staged(dealt.mapInArrow(
        run, "block long, rids binary, ids binary, dims int, kind string, data binary"), label)


def best(q: np.ndarray, c: np.ndarray, q_rid: np.ndarray, c_rid: np.ndarray, ids: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the k best candidates of each query; q and c: dims x vectors."""
    dims = max(len(q), len(c))
    q, c = (np.pad(x, ((0, dims - len(x)), (0, 0))) for x in (q, c))
    if dims * np.abs(q).max(initial=0) * np.abs(c).max(initial=0) >= 2.0 ** 52:
        q, c = q.astype(np.int64), c.astype(np.int64)
    order = np.argsort(-(c.astype(np.float64) ** 2).sum(1), kind="stable")
    q, c = q[order], c[order]
    steps = [slice(at, min(at + DIMENSIONS, dims)) for at in range(0, dims, DIMENSIONS)]

    def rest(x: np.ndarray) -> np.ndarray:  # mass that is left after each step
        square = x.astype(np.float64) ** 2
        after = [np.sqrt(square[s.stop:].sum(0)) for s in steps]
        return np.stack(after) * (1 + 1e-9) if after else np.zeros((0, x.shape[1]))

    q_rest, c_rest = rest(q), rest(c)
    out_q, out_c, out_s = [], [], []
    n = c.shape[1]
    for low in range(0, q.shape[1], AT_ONCE):
        part = q[:, low:low + AT_ONCE]
        size = part.shape[1]
        score = np.zeros((size, n), q.dtype)
        alive: list[np.ndarray] | None = None
        own = [np.flatnonzero(c_rid == r) for r in q_rid[low:low + size]]
        values: list[np.ndarray] = []
        for i, step in enumerate(steps):
            if alive is None:
                score += part[step].T @ c[step]
            else:
                for j, at in enumerate(alive):
                    values[j] = values[j] + part[step, j] @ c[step][:, at]
            if i == len(steps) - 1:
                break
            keep, left = [], 0
            for j in range(size):
                at = alive[j] if alive is not None else None
                now = score[j] if at is None else values[j]
                slack = q_rest[i, low + j] * (c_rest[i] if at is None else c_rest[i][at])
                under = now - slack
                if at is None and len(own[j]):
                    under[own[j]] = -np.inf
                if len(under) > k:
                    floor = np.partition(under, len(under) - k)[len(under) - k]
                    mask = now + slack >= floor
                else:
                    mask = np.ones(len(under), bool)
                keep.append(np.flatnonzero(mask) if at is None else (at[mask], now[mask]))
                left += int(mask.sum())
            if alive is not None:
                alive, values = [x[0] for x in keep], [x[1] for x in keep]
            elif left < SPARSE * size * n:
                alive = [at[~np.isin(at, o)] if len(o) else at
                         for at, o in zip(keep, own, strict=True)]
                values = [score[j][at] for j, at in enumerate(alive)]
        for j in range(size):
            if alive is None:
                at = np.delete(np.arange(n), own[j]) if len(own[j]) else np.arange(n)
                now = score[j][at]
            else:
                at, now = alive[j], values[j]
            if len(now) > k:
                least = np.partition(now, len(now) - k)[len(now) - k]
                at, now = at[now >= least], now[now >= least]
            first = np.lexsort((ids[at], -now))[:k]
            out_q.append(np.full(len(first), low + j))
            out_c.append(at[first])
            out_s.append(now[first])
    join = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
    return join(out_q), join(out_c), join(out_s)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id",
          vector: str = "embedding", scale: float = 64.0, candidates: int = CANDIDATES,
          queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the k rows of highest inner product."""
    rows = staged(
        vectors.where(F.col(key).isNotNull() & usable(vector)).select(
            F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("id"),
            F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks")), "vectors")
    known = blocks(rows.drop("asks"), candidates, scale, "candidates")
    asked = blocks(rows.where("asks").drop("asks"), queries, scale, "queries")
    # every block of queries with every block of candidates, as an equi-join on listed pairs
    numbers = known.select("block").collect()  # one number for each block of vectors
    pairs = asked.select(
        *[F.col(c).alias(f"q_{c}") for c in asked.columns],
        F.explode(F.array(*[F.lit(r[0]) for r in numbers]).cast("array<long>")).alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rids = {p: np.frombuffer(row[f"{p}rids"], np.int64) for p in ("", "q_")}
                ids = {p: np.frombuffer(row[f"{p}ids"], np.int64) for p in ("", "q_")}
                data = {p: np.frombuffer(row[f"{p}data"], row[f"{p}kind"]).astype(
                    np.float64).reshape(row[f"{p}dims"], -1)
                        if row[f"{p}dims"] else np.zeros((0, len(ids[p]))) for p in ("", "q_")}
                q, c, s = best(data["q_"], data[""], rids["q_"], rids[""], ids[""], k)
                q, c = q.astype(np.int64), c.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rids["q_"][q]), pa.array(ids["q_"][q]), pa.array(ids[""][c]),
                     pa.array(s.astype(np.int64))], names=["rid", "query_id", "vec_id", "score"])

    # Blocks of queries repeat for each block of candidates, which an estimate of their size does not
    # see: never send them to all tasks by way of the driver.
    met = pairs.hint("merge").join(known, "block").repartition(
        max(1, min(len(numbers) * max(1, asked.count()), 1 << 20)))
    found = met.mapInArrow(run, "rid long, query_id long, vec_id long, score long")
    order = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
