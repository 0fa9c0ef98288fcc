"""Left lookup joins that stay balanced when a few keys own most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.staging import BROADCAST_BYTES, checked_broadcast, fits_broadcast, staged

HOT_SHARE = 1000
SALTS = 256


def lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread: str,
    limit: int = BROADCAST_BYTES,
    weights: DataFrame | None = None,
) -> DataFrame:
    """``rows`` left join ``table`` (staged, one row per ``key``, a string) on ``key``.

    A table of measured small size is broadcast. Otherwise the keys that own more than
    1/HOT_SHARE of the rows (there are fewer than HOT_SHARE of them) are served from a broadcast
    and their rows are spread over the shuffle by a hash of ``spread``; all other rows meet the
    table in an ordinary shuffled join. ``weights`` (key, n) gives the rows per key if they are
    known already.
    """
    values = [c for c in table.columns if c != key]
    if fits_broadcast(table, limit):
        return rows.join(F.broadcast(table), key, "left").select(*rows.columns, *values)
    if weights is None:
        weights = staged(rows.groupBy(key).agg(F.count("*").alias("n")), "weights")
    total = weights.agg(F.sum("n").alias("n")).first()["n"] or 0
    # A hot key that the table lacks is hot all the same; its values are null.
    hot = staged(
        weights.where((F.col("n") > total / HOT_SHARE) & F.col(key).isNotNull()).select(key)
        .join(table, key, "left")
        .select(key, F.lit(True).alias("_is_hot"), F.struct(*values).alias("_hot")), "hot")
    # A hot row, or one without a key, needs no partner from the shuffle: its slot is the key
    # plus a salt, which sends it anywhere. Should such a slot happen to be a key of the table,
    # the value found there is not used.
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("string")
    anywhere = F.concat(F.coalesce(F.col(key), F.lit("")), F.lit("\u0001"), salt)
    slotted = rows.join(checked_broadcast(hot), key, "left").withColumn(
        "_slot", F.when(F.col("_is_hot").isNotNull() | F.col(key).isNull(), anywhere)
        .otherwise(F.col(key)))
    cold = table.select(F.col(key).alias("_slot"), F.struct(*values).alias("_cold"))
    joined = slotted.join(cold, "_slot", "left")
    found = F.when(F.col("_is_hot").isNotNull(), F.col("_hot")).when(
        F.col(key).isNotNull(), F.col("_cold"))
    return joined.select(*rows.columns, *[found[c].alias(c) for c in values])
