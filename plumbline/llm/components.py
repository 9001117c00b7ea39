"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.staging import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` has ids ``a`` and ``b``. One row per linked id: ``id``, ``component`` (the smallest id it reaches).

    Rounds of large stars and small stars turn any graph into stars around the smallest ids, in a number of rounds that
    grows with the logarithm of its size. A round is minima per node, folded before the shuffle, and joins with them;
    no node's neighbours are ever gathered. Each round is written to the shared folder, which cuts the lineage.
    """

    def stored(rows: DataFrame) -> tuple[DataFrame, tuple]:
        rows, sums = materialise(
            rows.where("u > v").distinct(), n=F.count(F.lit(1)), s=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        )
        return rows, tuple(sorted(sums.items()))

    edges, mark = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges, seen = stored(small)
        if seen == mark:
            break
        mark = seen
    return edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
