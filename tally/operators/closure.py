"""The closure table of a hierarchy from its (child, parent) edges, by pointer doubling.

The closure has one row per node and ancestor with the distance between them. It starts with the edges; in round r all
pairs up to distance 2^r are known, and joining those at exactly that distance to all known pairs gives the pairs up
to twice as far. So the number of rounds is the logarithm of the depth, each a join on the middle node and a minimum per
pair, both shuffles that Spark splits where one node (a root) is the ancestor of very many.

A node may have several parents; the distance is that of the shortest way. Nodes on a cycle are their own ancestors and
are reported by ``cycles``. Edges with a null child or parent say nothing beyond the node itself and are left out;
repeated edges count once; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tally.session import drop_scratch, write_scratch


def hierarchy_closure(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, ancestor, depth) for every node and each of its ancestors."""
    spark = edges.sparkSession
    first = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).where("node is not null and ancestor is not null").distinct()
    schema = first.withColumn("depth", F.lit(1)).schema
    path, reach = write_scratch(first.withColumn("depth", F.lit(1))), 1
    while True:
        known = spark.read.schema(schema).parquet(path)
        far = known.where(F.col("depth") == reach).select("node", F.col("ancestor").alias("_via"))
        on = known.select(F.col("node").alias("_via"), "ancestor", (F.col("depth") + F.lit(reach)).alias("depth"))
        longer = far.join(on, "_via").select("node", "ancestor", "depth")
        both = known.unionByName(longer).groupBy("node", "ancestor").agg(F.min("depth").alias("depth"))
        after = write_scratch(both)
        drop_scratch(spark, path)
        path, reach = after, 2 * reach
        closure = spark.read.schema(schema).parquet(path)
        if not closure.where(F.col("depth") > reach // 2).limit(1).count():
            return closure


def cycles(closure: DataFrame) -> DataFrame:
    """(node, length) of the nodes that are their own ancestors, with the length of their shortest way round."""
    return closure.where(F.col("node") == F.col("ancestor")).select("node", F.col("depth").alias("length"))


def roots(closure: DataFrame) -> DataFrame:
    """(node, root, depth): the topmost ancestors of every node, those without a parent of their own."""
    tops = closure.select(F.col("ancestor").alias("root")).distinct().join(closure.select(F.col("node").alias("root")).distinct(), "root", "left_anti")
    return closure.join(tops, F.col("ancestor") == F.col("root")).select("node", "root", "depth")
