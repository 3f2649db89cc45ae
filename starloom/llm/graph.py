"""Connected components by star contraction: each round is two groupings and two joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """Links (a long, b long) in; (node, root) out for every linked node but the roots.

    The root is the smallest node of the component. No node's neighbours are gathered: a round
    takes minima, which combine before the shuffle, and joins them back, which adaptive execution
    splits if a node has very many links. Rounds are written to the shared folder. Self links
    and nulls are left out.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(low.withColumnRenamed("m", "b")).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
