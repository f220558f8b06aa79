"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """node, label for every node of ``links`` (a, b); the label is the component's least node.

    Each round a node takes the least label among its neighbours and then the label of
    its label, so paths shorten by half and stars need two rounds. Rounds end when
    nothing changes. Labels are a written table after each round.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "edges")
    labels = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels"
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), F.col("label").alias("other")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("other").alias("other"))
        )
        pulled = labels.join(near, "node").select(
            "node", "label", F.least("label", "other").alias("lower")
        )
        jump = labels.select(F.col("node").alias("lower"), F.col("label").alias("jumped"))
        after = written(
            pulled.join(jump, "lower").select(
                "node", F.least("lower", "jumped").alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels
