"""Connected components over links, by passing the least label and shortening paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.llm.common import stored


def components(links: DataFrame, tag: str = "components") -> DataFrame:
    """node, label: for every node of ``links`` (columns a, b) the least node of its component.

    Each turn takes the least label among neighbours and then the label of that label, so the number of turns grows
    with the logarithm of a path's length in practice. Labels are written out every turn; hot nodes only ever meet
    partial minima.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).where("node != other")
    edges = stored(both.distinct(), tag)
    labels = stored(edges.groupBy("node").agg(F.least(F.min("other"), F.min("node")).alias("label")), tag)
    while True:
        heard = (edges.join(labels.withColumnRenamed("node", "other"), "other")
                 .groupBy("node").agg(F.min("label").alias("heard")))
        new = labels.join(heard, "node").select("node", "label", F.least("label", "heard").alias("near"))
        far = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        turned = stored(new.join(far, "near").select(
            "node", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("label")).alias("moved")), tag)
        labels = turned.select("node", "label")
        if turned.where("moved").isEmpty():
            return labels
