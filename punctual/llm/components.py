"""Connected components of a table of links, by alternating stars; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from punctual.runtime import cut, scratch


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link between different nodes, root being the smallest node it reaches.

    Each round hangs every node on the smallest neighbour it knows (Kiveris et al., large and small stars); the number
    of rounds grows with the logarithm of the longest chain. A node with very many links is a hot join key that has
    one row on the other side, which Spark splits. Nulls link nothing; repeated and reversed links count once.
    """
    spark = links.sparkSession
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    with scratch(spark, "components") as work:
        seen, edges = _written(edges, f"{work}/0")
        turn = 0
        while seen[0]:
            turn += 1
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            lowest = cut(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), path=f"{work}/m{turn}")
            large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = cut(large.distinct(), path=f"{work}/l{turn}")
            lowest = cut(large.groupBy("u").agg(F.min("v").alias("m")), path=f"{work}/n{turn}")
            hung = large.join(lowest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = hung.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
            before = seen
            seen, edges = _written(small, f"{work}/{turn}")
            if seen == before:
                break
        roots = edges.select("v").distinct()
        return cut(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root"))))


def _written(edges: DataFrame, path: str) -> tuple[tuple, DataFrame]:
    """The table, and two numbers that change whenever it does."""
    seen = Observation()
    mark = F.sum(F.shiftright(F.xxhash64("u", "v"), 24))
    out = cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), mark.alias("mark")), path=path)
    return (seen.get["n"], seen.get["mark"]), out
