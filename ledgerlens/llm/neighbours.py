"""Approximate nearest neighbours by cosine, over learned partitions.

The neighbour graph of a sample is cut into balanced parts, by recursive bisection along the graph's
slowest mode and swaps that lower the cut. A small classifier learns which parts a vector and its
neighbours lie in. It deals every row to its most probable part, and sends a query to its several
most probable ones: as many as it takes to reach a probability that was chosen on sample rows the
classifier did not see, so that ``coverage`` of their neighbours lie in the parts visited. All
rows of those parts are compared with the query in double precision.

Only the fit is bounded: at most ``SAMPLE`` rows and ``SAMPLE_BYTES`` of vectors, chosen by a hash.
Every row is indexed. A part may hold any share of the rows: parts and their queries are split into
slots of bounded size, and every slot of rows meets every slot of queries of its part. Of copies of
one vector the k + 1 smallest ids are kept, as the others cannot be among any k nearest.

Defined cases: rows without an id, and vectors that are null, zero or hold null or non-finite
components, take no part. Missing components of shorter vectors count as 0. A query meets every row
but itself; other rows with its id are met. Ties go to the smaller id, and rows that tie in that,
too, are kept in any order. A query visits further parts until they hold k rows beside its own, so
it finds fewer than k only if there are no more. Other columns are ignored. An empty table, or one
without queries, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.topk import usable
from ledgerlens.operators.lookup import lookup
from ledgerlens.sources.staging import staged

SAMPLE = 20_000             # rows of the fit, at most
SAMPLE_BYTES = 32 << 20     # and their vectors as doubles
MOST_PARTS = 1024
PER_PART = 16               # sample rows for each part, at least
NEIGHBOURS = 10             # of each sample row in the graph
COVERAGE = 0.97
SLOT_BYTES = 32 << 20       # vectors of a slot of rows
QUERY_BYTES = 4 << 20       # vectors of a slot of queries
AT_ONCE = 2048              # rows compared at once


@dataclass
class Router:
    """Probabilities of the parts, by one hidden layer; ``reach`` is the probability to cover."""

    weights: list[np.ndarray]
    reach: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.weights
        z = np.maximum(x.astype(np.float32) @ w + b, 0) @ v + c
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; none of them is zero."""
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def bisect(src: np.ndarray, dst: np.ndarray, n: int, first: int, rng: np.random.Generator,
           rounds: int = 40, swaps: int = 20) -> np.ndarray:
    """Sides of n nodes, exactly ``first`` of them False, with few edges (src, dst) between."""
    degree = np.maximum(np.bincount(src, minlength=n), 1e-9)
    scale, constant = 1 / np.sqrt(degree), np.sqrt(degree / degree.sum())
    mode = rng.standard_normal(n)
    for _ in range(rounds):
        mode -= constant * (constant @ mode)
        mode /= np.linalg.norm(mode) + 1e-300
        mode = 0.5 * (mode + scale * np.bincount(src, (scale * mode)[dst], n))
    side = np.ones(n, bool)
    side[np.argsort(mode * scale, kind="stable")[:first]] = False
    for _ in range(swaps):
        cut = side[src] != side[dst]
        gain = np.bincount(src, np.where(cut, 1.0, -1.0), n)
        ones, others = np.flatnonzero(side), np.flatnonzero(~side)
        ones = ones[np.argsort(-gain[ones], kind="stable")]
        others = others[np.argsort(-gain[others], kind="stable")]
        pairs = min(len(ones), len(others))
        useful = int((gain[ones[:pairs]] + gain[others[:pairs]] > 0).sum())
        new = side.copy()
        take = max(1, useful // 2)
        new[ones[:take]], new[others[:take]] = False, True
        if not useful or (new[src] != new[dst]).sum() >= cut.sum():
            break
        side = new
    return side


def balanced_parts(src: np.ndarray, dst: np.ndarray, n: int, parts: int,
                   rng: np.random.Generator) -> np.ndarray:
    """Parts of n nodes whose sizes differ by at most a few rows."""
    part = np.zeros(n, np.int64)
    work = [(np.arange(n), src, dst, 0, parts)]
    while work:
        nodes, s, d, low, count = work.pop()
        if count == 1:
            part[nodes] = low
            continue
        half = count // 2
        side = bisect(s, d, len(nodes), round(len(nodes) * half / count), rng)
        for flag, start, size in ((False, low, half), (True, low + half, count - half)):
            mine = side == flag
            number, inside = np.cumsum(mine) - 1, mine[s] & mine[d]
            work.append((nodes[mine], number[s[inside]], number[d[inside]], start, size))
    return part


def fit_classifier(x: np.ndarray, wanted: np.ndarray, rng: np.random.Generator, hidden: int = 128,
                   epochs: int = 15, batch: int = 256, rate: float = 3e-3,
                   steps: int = 1000) -> list[np.ndarray]:
    """Weights of a classifier whose probabilities come near ``wanted`` (rows x parts). Small
    samples are seen more often, so that there are at least ``steps`` steps."""
    x = x.astype(np.float32)
    epochs = max(epochs, -(-steps * batch // max(1, len(x))) if len(x) > batch else steps // 10)
    dims, parts = x.shape[1], wanted.shape[1]
    weights = [rng.standard_normal((dims, hidden)).astype(np.float32) * np.float32(2 ** 0.5),
               np.zeros(hidden, np.float32),
               rng.standard_normal((hidden, parts)).astype(np.float32) / np.float32(hidden ** 0.5),
               np.zeros(parts, np.float32)]
    mean, square, step = [[np.zeros_like(w) for w in weights] for _ in range(2)] + [0]
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for low in range(0, len(order), batch):
            rows = order[low:low + batch]
            inner = x[rows] @ weights[0] + weights[1]
            active = np.maximum(inner, 0)
            z = active @ weights[2] + weights[3]
            z = np.exp(z - z.max(1, keepdims=True))
            out = (z / z.sum(1, keepdims=True) - wanted[rows]) / len(rows)
            back = (out @ weights[2].T) * (inner > 0)
            slopes = [x[rows].T @ back, back.sum(0), active.T @ out, out.sum(0)]
            step += 1
            for w, m, s, g in zip(weights, mean, square, slopes, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                w -= (rate * (1 - epoch / epochs) * (m / (1 - 0.9 ** step))
                      / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return weights


def fit_router(x: np.ndarray, near: np.ndarray, parts: int, k: int, coverage: float,
               seed: int = 0) -> Router:
    """Cut the neighbour graph (row -> near rows) of unit vectors and learn the parts."""
    n, rng = len(x), np.random.default_rng(seed)
    src, dst = np.repeat(np.arange(n), near.shape[1]), near.ravel()
    part = balanced_parts(np.concatenate([src, dst]), np.concatenate([dst, src]), n, parts, rng)
    wanted = np.zeros((n, parts), np.float32)
    np.add.at(wanted, (src, part[dst]), 1)
    wanted[np.arange(n), part] += 1
    wanted /= wanted.sum(1, keepdims=True)
    held = rng.permutation(n) < n // 10
    weights = fit_classifier(x[~held], wanted[~held], rng)
    router = Router(weights, 1.0)
    if held.sum() < 20:
        return router  # too few to choose by: every part is visited
    # What probability must be covered to reach a neighbour's part: all parts before it.
    chance = router.probabilities(x)
    dealt, mine = chance.argmax(1), chance[held]
    order = np.argsort(-mine, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(mine, order, 1), 1) - np.take_along_axis(mine, order, 1)
    place = np.argsort(order, axis=1)
    needed = np.take_along_axis(
        before, np.take_along_axis(place, dealt[near[held][:, :k]], 1), 1).ravel()
    router.reach = float(np.sort(needed)[min(len(needed) - 1, int(coverage * len(needed)))] + 1e-6)
    return router


def routed(router: Router, x: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    """The parts each unit vector visits: its most probable ones up to ``reach``, and further ones
    until they hold ``least`` rows; empty parts are left out."""
    chance = router.probabilities(x)
    order = np.argsort(-chance, axis=1, kind="stable")
    ranked = np.take_along_axis(chance, order, 1)
    before = np.cumsum(ranked, 1) - ranked
    rows = np.cumsum(sizes[order], 1) - sizes[order]
    visit = (before < router.reach) | (rows < least)
    visit[:, 0] = True
    return [o[v & (sizes[o] > 0)] for o, v in zip(order, visit, strict=True)]


def matrix(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors kept as bytes, as rows of doubles."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(np.float64)


def packed(rows: DataFrame, dims: int, kind: str) -> DataFrame:
    """(rid, id, vector, asks) -> (rid, id, asks, data): vectors of equal width as bytes, scaled by
    a power of two so that no square overflows; this changes no cosine."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            n = lists.value_lengths().to_numpy()
            x = np.zeros((len(n), dims))
            row = np.repeat(np.arange(len(n)), n)
            x[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = (
                lists.flatten().to_numpy())
            exponent = np.frexp(np.abs(x).max(1, initial=0))[1]
            x = np.ldexp(x, -exponent[:, None]).astype(kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), batch.column("id"), batch.column("asks"),
                 pa.array([r.tobytes() for r in x], pa.binary())],
                names=["rid", "id", "asks", "data"])

    return staged(rows.mapInArrow(run, "rid long, id long, asks boolean, data binary"), "packed")


def without_copies(rows: DataFrame, keep: int) -> DataFrame:
    """Rows but for the copies of a vector beyond the ``keep`` smallest ids. The rows of a vector
    are first ranked in salted groups, so that one with many copies is no task of its own."""
    named = rows.select("rid", "id", F.sha2("data", 256).alias("digest"))
    common = staged(named.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > keep),
                    "common")
    if common.isEmpty():
        return rows
    found = lookup(named, common, "digest", "rid", weights=common).where("n is not null")
    salt = F.pmod(F.xxhash64("rid"), F.lit(256))
    for keys in (["digest", salt], ["digest"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("id", "rid"))
        found = found.withColumn("place", place).where(F.col("place") <= keep)
    copies = lookup(named, common, "digest", "rid", weights=common).where("n is not null").join(
        found.select("rid"), "rid", "left_anti")
    return staged(rows.join(copies.select("rid"), "rid", "left_anti"), "distinct")


def sample(rows: DataFrame, n: int, most: int) -> np.ndarray:
    """Vectors of at most ``most`` rows, those with the smallest hashes (bounded, on the driver)."""
    draw = F.pmod(F.xxhash64(F.lit(12), "rid"), F.lit(1 << 30))
    share = min(1 << 30, int(1.2 * most / n * (1 << 30)) + 1)
    table = rows.select("data", "rid", draw.alias("draw")).where(F.col("draw") < share).orderBy(
        "draw", "rid").limit(most)
    return table.select("data").toArrow().column("data")


def graph(spark, x: np.ndarray, neighbours: int) -> DataFrame:
    """(row, near): the nearest rows of each sample row, nearest first, a block of rows a task."""
    shared = spark.sparkContext.broadcast(x)  # at most SAMPLE_BYTES
    step = max(256, -(-len(x) // 64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        for batch in batches:
            for block in batch.column(0).to_pylist():
                rows = np.arange(block * step, min((block + 1) * step, len(x)))
                score = x[rows] @ x.T
                score[np.arange(len(rows)), rows] = -np.inf
                some = np.argpartition(-score, neighbours - 1, axis=1)[:, :neighbours]
                order = np.argsort(-np.take_along_axis(score, some, 1), axis=1, kind="stable")
                near = np.take_along_axis(some, order, 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), pa.array(near.tolist(), pa.list_(pa.int64()))],
                    names=["row", "near"])

    blocks = -(-len(x) // step)
    return staged(spark.range(0, blocks, 1, blocks).mapInArrow(
        run, "row long, near array<long>"), "graph")


def learn(rows: DataFrame, n: int, dims: int, kind: str, k: int, coverage: float,
          parts: int | None = None, most: int = SAMPLE) -> Router:
    """Fit on a bounded sample. The graph and the fit run in tasks; only the sample's vectors
    and the fitted weights pass through the driver."""
    most = min(most, n, max(256, SAMPLE_BYTES // (8 * max(1, dims))))
    x = unit(matrix(sample(rows, n, most).combine_chunks(), kind))
    if parts is None:
        parts = min(MOST_PARTS, int(np.ceil(n ** 0.5 / 4)), max(1, len(x) // PER_PART))
    if parts == 1 or len(x) <= NEIGHBOURS:
        return Router([np.zeros((dims, 1), np.float32), np.zeros(1, np.float32),
                       np.zeros((1, 1), np.float32), np.zeros(1, np.float32)], 1.0)
    spark = rows.sparkSession
    near, shared = graph(spark, x, NEIGHBOURS), spark.sparkContext.broadcast(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        order = np.argsort(table.column("row").to_numpy())
        lists = np.array(table.column("near").to_pylist())[order]
        router = fit_router(shared.value, lists, parts, k, coverage)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.tobytes() for w in router.weights], pa.binary()),
             pa.array([list(w.shape) for w in router.weights], pa.list_(pa.int64())),
             pa.array([router.reach] * len(router.weights))], names=["weights", "shape", "reach"])

    # one row of neighbours for each sample row, so this task is as bounded as the sample
    got = near.repartition(1).mapInArrow(
        run, "weights binary, shape array<long>, reach double").collect()
    return Router([np.frombuffer(r["weights"], np.float32).reshape(r["shape"]) for r in got],
                  got[0]["reach"])


def dealt(rows: DataFrame, router: Router, kind: str) -> DataFrame:
    """Every row with its most probable part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(matrix(batch.column("data"), kind))
                part = router.probabilities(x).argmax(1)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("rid", "id", "data")),
                     pa.array(part, pa.int64())], names=["rid", "id", "data", "part"])

    return staged(rows.select("rid", "id", "data").mapInArrow(
        run, "rid long, id long, data binary, part long"), "dealt")


def visits(asked: DataFrame, router: Router, kind: str, sizes: np.ndarray, least: int) -> DataFrame:
    """(rid, id, data, part): a row for each part that a query visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, AT_ONCE):
                rows = batch.slice(low, AT_ONCE)
                x = unit(matrix(rows.column("data"), kind))
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in ("rid", "id", "data")),
                     pa.array([p.tolist() for p in routed(router, x, sizes, least)],
                              pa.list_(pa.int64()))], names=["rid", "id", "data", "parts"])

    found = staged(asked.select("rid", "id", "data").mapInArrow(
        run, "rid long, id long, data binary, parts array<long>"), "visits")
    return found.select("rid", "id", "data", F.explode("parts").alias("part"))


class Nearest:
    """The k best rows of each query of a slot, as rows come in."""

    def __init__(self, rid: np.ndarray, x: np.ndarray, k: int):
        self.rid, self.x, self.k = rid, x, k
        self.length = np.sqrt((x * x).sum(1))
        self.unit = x / self.length[:, None]
        self.floor = np.full(len(rid), -np.inf)
        self.query, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0)

    def add(self, rid: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
        length = np.sqrt((y * y).sum(1))
        rough = self.unit @ (y / length[:, None]).T
        rough[self.rid[:, None] == rid[None, :]] = -np.inf
        floor = self.floor
        if rough.shape[1] >= self.k:
            floor = np.maximum(floor, np.partition(rough, -self.k, axis=1)[:, -self.k])
        # What may be among the k best gets its exact score, the same sum for the same vectors.
        query, row = np.nonzero((rough >= floor[:, None] - 1e-9) & (rough > -np.inf))
        score = np.concatenate([np.empty(0)] + [
            (self.x[q] * y[r]).sum(1) / (self.length[q] * length[r])
            for q, r in ((query[at:at + 65536], row[at:at + 65536])
                         for at in range(0, len(query), 65536))])
        query = np.concatenate([self.query, query])
        ids, score = np.concatenate([self.id, ids[row]]), np.concatenate([self.score, score])
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        start = np.searchsorted(query, np.arange(len(self.rid)))
        place = np.arange(len(query)) - start[query]
        last = place == self.k - 1
        self.floor[query[last]] = score[last]
        kept = place < self.k
        self.query, self.id, self.score = query[kept], ids[kept], score[kept]


def compared(met: DataFrame, kind: str, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): in each slot, queries come before the rows they meet."""
    slot = ["part", "slot", "query_slot"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, ids, best = None, [], {}, None

        def results() -> Iterator[pa.RecordBatch]:
            if best is not None and len(best.query):
                rid = best.rid[best.query]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid), pa.array([ids[r] for r in rid.tolist()], pa.int64()),
                     pa.array(best.id), pa.array(best.score)],
                    names=["query", "query_id", "vec_id", "score"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in [*slot, "kind"]], axis=1)
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            edges = [0, *change.tolist(), len(keys)] if len(keys) else []
            for low, high in zip(edges, edges[1:], strict=False):
                if tuple(keys[low, :3]) != at:
                    yield from results()
                    at, asked, best = tuple(keys[low, :3]), [], None
                part = batch.slice(low, high - low)
                rid, own = part.column("rid").to_numpy(), part.column("id").to_numpy()
                if keys[low, 3] == 0:
                    asked.append((rid, own, matrix(part.column("data"), kind)))
                    continue
                if best is None and asked:
                    ids = dict(zip(np.concatenate([a[0] for a in asked]).tolist(),
                                   np.concatenate([a[1] for a in asked]).tolist(), strict=True))
                    best = Nearest(np.concatenate([a[0] for a in asked]),
                                   np.concatenate([a[2] for a in asked]), k)
                for i in range(0, high - low if best is not None else 0, AT_ONCE):
                    some = slice(i, min(i + AT_ONCE, high - low))
                    best.add(rid[some], own[some],
                             matrix(part.column("data").slice(i, AT_ONCE), kind))
        yield from results()

    placed = met.repartition(*slot).sortWithinPartitions(*slot, "kind")
    return placed.mapInArrow(run, "query long, query_id long, vec_id long, score double")


def counts(rows: DataFrame, parts: int) -> np.ndarray:
    """Rows of each part; one number for each part comes to the driver."""
    out = np.zeros(parts, np.int64)
    for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect():
        out[r["part"]] = r["n"]
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id",
            vector: str = "embedding", coverage: float = COVERAGE, parts: int | None = None,
            slot_bytes: int = SLOT_BYTES, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query row."""
    spark = vectors.sparkSession
    element = vectors.schema[vector].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    some = F.exists(vector, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & usable(vector) & some).select(
        F.monotonically_increasing_id().alias("rid"), F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    result = T.StructType([
        T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()),
        T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    if not dims:
        return spark.createDataFrame([], result)
    rows = packed(rows, dims, kind)
    index = without_copies(rows, k + 1)
    router = learn(index, index.count(), dims, kind, k, coverage, parts)
    known = dealt(index, router, kind)
    sizes = counts(known, len(router.weights[-1]))
    asked = visits(rows.where("asks"), router, kind, sizes, k + 1)
    width = np.dtype(kind).itemsize * dims
    held = [-(-n // max(1, size // width)) for n, size in (
        (sizes, slot_bytes), (counts(asked, len(sizes)), query_bytes))]
    slots, query_slots = (F.lit([max(1, int(n)) for n in x])[F.col("part")] for x in held)
    mine = F.xxhash64("rid")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    cells = asked.select("part", F.pmod(mine, query_slots).cast("int").alias("query_slot"),
                         F.lit(0).alias("kind"), "rid", "id", "data", slots.alias("n"))
    met = cells.select("part", every(F.col("n")).alias("slot"), "query_slot", "kind", "rid", "id",
                       "data")
    cells = known.select("part", F.pmod(mine, slots).cast("int").alias("slot"),
                         F.lit(1).alias("kind"), "rid", "id", "data", query_slots.alias("n"))
    met = met.unionByName(cells.select(
        "part", "slot", every(F.col("n")).alias("query_slot"), "kind", "rid", "id", "data"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (compared(met, kind, k).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
