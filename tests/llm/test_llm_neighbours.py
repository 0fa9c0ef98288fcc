"""Approximate nearest neighbours against every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import neighbours
from ledgerlens.llm.queries import op12_neighbours

SCHEMA = "vec_id long, embedding array<float>, rid long, data string, part int, asks boolean"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, False) for i, v in rows], SCHEMA)


def plain(rows, asks, k):
    """[(id, vector)] -> {(query id, rank): (id, score)} by brute force; ids are distinct."""
    dims = max(len(v) for _, v in rows if v)
    good = [(i, np.array([*v, *[0.0] * (dims - len(v))], np.float32).astype(float))
            for i, v in rows if i is not None and v is not None
            and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if asks(i):
            scores = sorted((-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), j)
                            for j, w in good if j != i)
            out |= {(i, rank): (j, -s) for rank, (s, j) in enumerate(scores[:k], 1)}
    return out


def found(out):
    return {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in out.collect()}


def same(got, wanted):
    assert got.keys() == wanted.keys()
    for key, (vec_id, score) in wanted.items():
        assert abs(got[key][1] - score) < 1e-12, key
        assert got[key][0] == vec_id, key


def recall(got, wanted):
    sets = [{(q, i) for (q, _), (i, _) in x.items()} for x in (got, wanted)]
    return len(sets[0] & sets[1]) / len(sets[1])


def clusters(n, dims, centres, seed, noise=0.15):
    dice = np.random.default_rng(seed)
    middle = dice.standard_normal((centres, dims))
    middle /= np.linalg.norm(middle, axis=1)[:, None]
    at = dice.integers(0, centres, n)
    return [(i, (middle[c] + noise * dice.standard_normal(dims) / dims ** 0.5 * 3).tolist())
            for i, c in enumerate(at)]


def test_one_part_is_exact(spark):
    """Nulls, zero, non-finite and short vectors, large and small scales; slots of a few rows."""
    dice = np.random.default_rng(5)
    rows = [(i, (dice.standard_normal(6) * 10.0 ** dice.integers(-12, 12)).tolist())
            for i in range(150)]
    rows += [(200, None), (201, [0.0] * 6), (202, [1.0, None, 2.0]), (203, [float("nan")] * 6),
             (204, [float("inf"), 1.0]), (205, []), (None, [1.0] * 6), (206, [1.0, 2.0]),
             (208, [3e38] * 6), (210, [1e-30] * 6)]
    out = neighbours.nearest(frame(spark, rows), F.col("vec_id") % 2 == 0, k=4, parts=1,
                             slot_bytes=240, query_bytes=120)
    same(found(out), plain(rows, lambda i: i % 2 == 0, 4))


def test_copies_of_one_vector(spark):
    """A third of all rows hold one vector; the smallest ids are the nearest, its own left out."""
    rows = clusters(300, 8, 4, 3)
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0]) for i in range(150)]
    out = found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, k=5, parts=1))
    same(out, plain(rows, lambda i: i % 50 == 0, 5))
    assert [out[1050, r][0] for r in range(1, 6)] == [1000, 1001, 1002, 1003, 1004]
    assert [out[1000, r][0] for r in range(1, 6)] == [1001, 1002, 1003, 1004, 1005]
    many = found(neighbours.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, k=5, parts=4))
    assert recall(many, plain(rows, lambda i: i % 50 == 0, 5)) >= 0.9


def test_few_parts_are_visited_where_vectors_cluster(spark):
    rows = clusters(3000, 16, 40, 1)
    vectors = frame(spark, rows)
    out = found(neighbours.nearest(vectors, F.col("vec_id") % 50 == 0, slot_bytes=4096))
    assert recall(out, plain(rows, lambda i: i % 50 == 0, 5)) >= 0.9
    packed = neighbours.packed(
        vectors.select(F.col("vec_id").alias("rid"), F.col("vec_id").alias("id"),
                       F.col("embedding").cast("array<double>").alias("vector"), "asks"), 16, "<f4")
    router = neighbours.learn(packed, 3000, 16, "<f4", 5, neighbours.COVERAGE)
    parts = len(router.weights[-1])
    x = neighbours.unit(np.array([v for _, v in rows]))
    visited = neighbours.routed(router, x, np.full(parts, 100), 6)
    assert parts == 14 and np.mean([len(v) for v in visited]) < 0.5 * parts


def test_registered_query_reaches_the_recall(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    out = op12_neighbours(spark, folder)
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "int", "bigint", "double"]
    wanted = plain(rows, lambda i: i % 50 == 0, 5)
    got = found(out)
    assert got.keys() == wanted.keys() and recall(got, wanted) >= 0.9


def test_small_and_empty_tables(spark):
    none = neighbours.nearest(frame(spark, []), F.col("vec_id") % 2 == 0)
    assert none.collect() == [] and none.columns == ["query_id", "rank", "vec_id", "score"]
    alone = neighbours.nearest(frame(spark, [(2, [1.0])]), F.col("vec_id") % 2 == 0)
    assert alone.collect() == []
    three = [(2, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [1.0, 1.0])]
    same(found(neighbours.nearest(frame(spark, three), F.col("vec_id") % 2 == 0)),
         plain(three, lambda i: i % 2 == 0, 5))
    silent = neighbours.nearest(frame(spark, three), F.lit(None).cast("boolean"))
    assert silent.collect() == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(2, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 1.0])]
    out = neighbours.nearest(frame(spark, rows), F.col("vec_id") == 2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in out) == [
        (2, 1, 2, 0.0), (2, 1, 2, 1.0), (2, 1, 2, 1.0), (2, 2, 2, 0.0), (2, 2, 2, 0.0),
        (2, 2, 2, 0.0)]


@pytest.mark.parametrize("parts", [2, 5, 16])
def test_parts_are_balanced_and_cut_few_edges(parts):
    """A ring: contiguous arcs cut two edges for each part."""
    n = 640
    src = np.concatenate([np.arange(n), (np.arange(n) + 1) % n])
    dst = np.concatenate([(np.arange(n) + 1) % n, np.arange(n)])
    part = neighbours.balanced_parts(src, dst, n, parts, np.random.default_rng(0))
    sizes = np.bincount(part, minlength=parts)
    assert sizes.max() - sizes.min() <= 4
    assert (part[src] != part[dst]).sum() / 2 <= n * 0.15


def test_classifier_learns_what_it_is_shown():
    dice = np.random.default_rng(1)
    x = dice.standard_normal((2000, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = (x[:, 0] > 0).astype(int) + 2 * (x[:, 1] > 0)
    weights = neighbours.fit_classifier(x, np.eye(4, dtype=np.float32)[side], dice)
    chance = neighbours.Router(weights, 1.0).probabilities(x)
    assert np.allclose(chance.sum(1), 1, atol=1e-5) and (chance.argmax(1) == side).mean() > 0.95
