"""Connected components of a distributed edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node that has an edge in ``edges`` (u, v); ``root`` is the component's smallest node.

    Each round hangs larger neighbours, then smaller ones, on the smallest node seen; a logarithmic number of
    rounds is known to suffice in practice, log squared in theory. A node with a third of all edges is met by
    aggregates and joins only, never by a list of its neighbours.
    """
    now = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(now, "edges")
    mark = None
    while True:
        sym = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        beside = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(beside.unionByName(low.withColumnRenamed("m", "v")).distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
