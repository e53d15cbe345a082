"""Connected components of a link table, by alternating large and small stars.

Each round points every node's neighbours at the smallest node among them, first
towards larger and then towards smaller neighbours; the number of rounds grows
with the logarithm of the component size. Neighbourhoods are only ever reduced
to their minimum (combined before the shuffle) and joined back, so a hub with
very many links needs no task that holds them all. Each round is written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreports.llm.shared import dealt_anew, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node of its component.

    Links may repeat and point either way; a link with a null end is ignored. No
    links give an empty table.
    """
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    )
    while True:
        # large star: larger neighbours of u point at the smallest neighbour
        both = edges.where("u <> v").unionByName(edges.where("u <> v").select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(dealt_anew(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        # small star: u and its smaller neighbours point at the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(dealt_anew(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        # done when every node has one link, to a node without any
        again = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u").union(
            edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").select("u"))
        if not again.limit(1).count():
            break
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
