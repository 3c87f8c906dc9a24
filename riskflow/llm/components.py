"""Connected components of a link table by alternating star operations.

Links are rewritten until every component is a star around its smallest node: a large star hangs the larger
neighbours of each node on the smallest one it knows, a small star does so with the others. The number of
rounds grows with the logarithm of the component sizes. Each step is a partial aggregate and a join with a
stored table of one row per node, so a node with very many links is split over tasks. Every step is written
to the shared folder; a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.session import materialize


def _star(links: DataFrame, smaller: Column) -> DataFrame:
    """Hang the far ends of (u, v) that ``smaller`` does not drop on the least node seen from u."""
    least = materialize(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    least = least.select("u", F.least("u", "m").alias("m"))
    return links.join(least, "u").filter(smaller).select(F.col("v").alias("a"), F.col("m").alias("b"))


def _distinct(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller node, each once."""
    return (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).head()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of ``links`` (a, b) the smallest node it can reach.

    Links may come in either direction and more than once; links of a node to itself and links with a null
    end are dropped. No links give an empty result.
    """
    stars = materialize(_distinct(links), "links")
    before, after = None, _state(stars)
    while before != after:
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            stars.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = materialize(_distinct(_star(both, F.col("v") > F.col("u"))), "links")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = materialize(down.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        stars = materialize(_distinct(hung.unionByName(own)), "links")
        before, after = after, _state(stars)
    members = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return members.unionByName(roots)
