"""Connected components by smallest labels, with shortcuts; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.staging import staged


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (id, label): the smallest id of each node's component.

    Null ends and links of a node to itself add nothing. A round takes the smallest label of all
    neighbours and then the label's own label, so that labels travel twice as far each time.
    """
    links = links.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = staged(links.select("a", "b").unionAll(links.select("b", "a")).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("id"), F.least("a", "b").alias("label")), "labels")
    while True:
        heard = (both.join(labels, both["b"] == labels["id"])
                 .groupBy("a").agg(F.min("label").alias("heard")))
        nearer = labels.join(heard, labels["id"] == heard["a"]).select(
            "id", F.col("label").alias("old"), F.least("label", "heard").alias("label"))
        nearer = staged(nearer, "nearer")
        jump = nearer.select(F.col("id").alias("via"), F.col("label").alias("beyond"))
        new = staged(
            nearer.join(jump, F.col("label") == F.col("via"), "left")
            .select("id", "old", F.least("label", F.coalesce("beyond", "label")).alias("label")),
            "labels")
        labels = new.select("id", "label")
        if new.where(F.col("old") != F.col("label")).isEmpty():
            return labels
