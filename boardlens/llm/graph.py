"""Connected components of a link table of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.operators.lineage import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), component being the smallest node reachable.

    Alternating star contractions: every node's larger neighbours, then its smaller ones, are tied to its smallest
    neighbour, until only stars are left. A node's neighbours are never gathered; minima are made before the
    shuffle, and a round is two sums and two joins over a written table. Links may repeat, point to themselves and
    be given in one direction; null ends are dropped. No links give no rows.
    """
    edges = cut(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("a is not null and b is not null and u > v").distinct()
    )
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lows, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = cut(small.unionByName(lows.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        sums = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        if edges.agg(*sums).first() == after.agg(*sums).first():
            break
        edges = after
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
