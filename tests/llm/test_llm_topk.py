"""Blocks of the exact top-k: how they are stored and how they meet."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import topk


def table(spark, n, factor):
    dice = np.random.default_rng(3)
    return spark.createDataFrame(
        [(i, (factor * dice.standard_normal(5)).tolist()) for i in range(n)],
        "vec_id long, embedding array<double>")


def test_blocks_are_never_sent_by_way_of_the_driver(spark, monkeypatch):
    found = topk.top_k(table(spark, 60, 1), F.col("vec_id") % 10 == 0, k=3, candidates=16, queries=4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.count() == 18


@pytest.mark.parametrize(("factor", "kind"), [
    (0.1, "int8"), (50, "int16"), (1e6, "int32"), (1e12, "float64")])
def test_narrow_numbers_give_the_same_scores(spark, factor, kind):
    rows = table(spark, 40, factor)
    stored = topk.blocks(rows.select(F.col("vec_id").alias("rid"), F.col("vec_id").alias("id"),
                                     F.col("embedding").alias("vector")), 16, 64.0, "blocks")
    assert {r.kind for r in stored.collect()} == {kind}
    vectors = {r.vec_id: [int(np.floor(64 * x)) for x in r.embedding] for r in rows.collect()}
    found = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(
        rows, F.col("vec_id") % 10 == 0, k=4, candidates=16, queries=2).collect()]
    wanted = []
    for q in range(0, 40, 10):
        best = sorted((-sum(x * y for x, y in zip(vectors[q], vectors[c])), c)
                      for c in vectors if c != q)[:4]
        if factor < 1e12:  # sums are exact below 2 ** 63
            wanted += [(q, at, c, -s) for at, (s, c) in enumerate(best, 1)]
    assert not wanted or sorted(found) == sorted(wanted)
    assert len(found) == 16
