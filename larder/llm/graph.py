"""Connected components of an edge table as a distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import cut_at, drop_path


def _towards_least(links: DataFrame, upward: bool) -> DataFrame:
    """Hang neighbours on the least node of each neighbourhood.

    ``links`` are rows (hi, lo). ``upward`` moves every larger neighbour of a node to the least of the
    whole neighbourhood; otherwise a node and its smaller neighbours move to the least of these.
    The least is a combining aggregate, and the join back is one that the planner may split when a
    node has very many neighbours.
    """
    if upward:
        sides = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
    else:
        sides = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if upward:
        moved = joined.where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        moved = joined.select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        )
    return moved.where("hi <> lo").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the least node of its component.

    Alternates the two star steps until no root is itself below another one. Every step is written to
    the shared folder, so the lineage stays short; loops and repeated edges are allowed, rows with a
    null end are no edges, and an empty table gives an empty result. The steps needed grow with the
    logarithm of the longest path.
    """
    spark = edges.sparkSession
    links, path = cut_at(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct(),
        "links",
    )
    while True:
        # a forest of stars: every node has one parent and no parent has a parent
        deep = links.select(F.col("lo").alias("n")).join(
            links.select(F.col("hi").alias("n")).distinct(), "n", "left_semi"
        )
        many = links.groupBy("hi").count().where("count > 1").select(F.col("hi").alias("n"))
        if deep.union(many).isEmpty():
            break
        after, new = cut_at(_towards_least(_towards_least(links, True), False), "links")
        drop_path(spark, path)
        links, path = after, new
    roots = links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)
