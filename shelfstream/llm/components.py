"""Connected components of a graph given as links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfstream.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in links (a, b): the smallest node it is connected with. A round
    takes the smallest label among the neighbours and then the label of that label."""
    both = materialise(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a != b").distinct(), "links",
    )
    state = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        .select("node", F.least("node", "label").alias("label")), "labels",
    )
    while True:
        near = both.join(state.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        least = state.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        least = materialise(least, "labels-near")
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = materialise(
            least.join(jump, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")
            ), "labels",
        )
        state = moved.select("node", "label")
        if moved.filter("label != old").isEmpty():
            return state
