"""Connected components of an edge table, without collecting anything.

Large-star and small-star steps in turn (Kiveris et al., 2014): each is one
aggregation and one join on a column of longs. Steps end in a table in the
shared folder, so lineage stays short and a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a long, b long): root is the component's least node."""
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while True:
        # Large star: neighbours above u are handed to the least of u and its neighbours.
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its neighbours below it are handed to the least of these.
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(small_least, "u")
        small = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(small_least.select("u", F.col("m").alias("v"))).distinct()
        pairs = materialize(small, "stars")
        # Done when every edge hangs on a root: no node is both a child and a parent.
        if pairs.join(pairs.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty():
            parents = pairs.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
            if parents.isEmpty():
                break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
