"""Connected components of a link table, by rounds of joins with the least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import forget, spread_join, stable


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root is the least node it reaches.

    Alternates two steps until only stars are left: every node hands its greater neighbours to its least
    neighbour, then its smaller ones (Kiveris et al. 2014, "Connected components in MapReduce and
    beyond"). Each is a partial aggregate and a join; edges shrink to stars, nothing is collected. A link
    with a null end counts for nothing. With ``rounds`` it stops after as many: nodes of one root are
    connected then, but connected nodes may still have several roots. The edges of a hot root are dealt to several
    tasks, and a round deletes the table of the round before.
    """
    edges = stable(links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        # large star: greater neighbours v of u go to the least of u and its neighbours; a root may have most of them
        turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = stable(spread_join(turned, least, "u", ["v"]).select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                       .where("u != v").distinct())
        # small star: smaller neighbours of u, and u itself, go to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        grown = stable(spread_join(large, small, "u", ["v"]).select(
            F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")),
                              F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("e"))
            .select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).where("u != v").distinct())
        forget(edges)
        forget(large)
        edges = grown
        if rounds is not None:
            rounds -= 1
            if not rounds:
                break
            continue
        # done when every node has one parent and no parent has one
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
            edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        seen = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if seen.where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(
        F.min("root").alias("root"))
