"""Connected components of a graph of longs, as alternating star contractions.

Each round rewrites the edges so that every node points to the least node it knows: first every larger
neighbour of a node is tied to the least one (large star), then every smaller one (small star). Both are a
minimum per node followed by a join with the edges, so a node with very many neighbours is one key of an
aggregation with map-side combining and of a join whose skew Spark splits; nothing gathers a neighbourhood.
The number of rounds grows with the logarithm of the graph's diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.session import drop_scratch, write_scratch


def _least(pairs: DataFrame) -> DataFrame:
    """For each node u with neighbours v: m, the least of its neighbours and itself."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges -> (node, root), root the least node of the component; isolated nodes have no row.

    Each round is written to the shared folder and its predecessor removed."""
    spark = edges.sparkSession
    path = write_scratch(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    while True:
        e = spark.read.schema("u long, v long").parquet(path)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_least(large), "u")
        small = small.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
        after_path = write_scratch(small.select("p.u", "p.v").where("u > v").distinct())
        after = spark.read.schema("u long, v long").parquet(after_path)
        changed = after.join(e, ["u", "v"], "left_anti").limit(1).count() + e.join(after, ["u", "v"], "left_anti").limit(1).count()
        drop_scratch(spark, path)
        path = after_path
        if not changed:
            roots = after.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
