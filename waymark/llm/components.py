"""Connected components by minimum labels with pointer jumping; all state stays in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import discard, exchanged, written


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label) for each node of links (a, b); the label is the smallest node that can be reached.

    A round gives each node the smallest label among its own and its neighbours', then that label's own label.
    Labels only fall, and rounds end when none does; long chains halve with every jump. All tables grow with the
    links, so they are joined by exchange and never broadcast; adaptive execution splits the keys of large components.
    """
    edges = written(spark, links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    labels = written(spark, edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "cc-labels")
    while True:
        near = edges.join(exchanged(labels), edges.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        low = labels.join(exchanged(near), "node").select("node", "label", F.least("label", "low").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("next"))
        stepped = written(spark, low.join(exchanged(jump), "low", "left").select("node", F.col("label").alias("was"), F.least("low", F.coalesce("next", "low")).alias("label")), "cc-labels")
        discard(spark, labels)
        labels = stepped
        if stepped.where("label < was").isEmpty():
            discard(spark, edges)
            return _of(stepped, stepped.select("node", "label"))


def _of(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of a written table, which can be discarded as that table."""
    rows._waymark_at = table._waymark_at
    return rows
