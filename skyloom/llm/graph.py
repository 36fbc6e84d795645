"""Connected components as DataFrame joins: labels spread along links, with shortcuts, until none changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import sized, written


def components(links: DataFrame) -> DataFrame:
    """links(a, b): any 64-bit ids, each link once or more. Returns node, comp: the smallest id it reaches.

    Nodes without a link aren't returned. Each round takes the least label among a node's neighbours and then
    that label's own label, so a chain of n nodes needs about log n rounds. Every round is cut by a written
    table, in as few files as its rows need; only counts come to the driver.
    """
    n = 3 * links.count()
    ends = links.where("a <> b").select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b"))).alias("e"))
    both = written(sized(ends.select("e.a", "e.b").distinct(), n))  # with a link of each node to itself
    labels = written(sized(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp")), n))
    while True:
        own = F.min(F.when(F.col("a") == F.col("b"), F.col("comp")))
        step = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("next"), own.alias("was"))
        up = labels.select(F.col("node").alias("next"), F.col("comp").alias("top"))
        moved = written(sized(step.join(up, "next").select(F.col("a").alias("node"), F.least("next", "top").alias("comp"), "was"), n))
        labels = moved.select("node", "comp")
        if moved.where("comp <> was").isEmpty():
            return labels
