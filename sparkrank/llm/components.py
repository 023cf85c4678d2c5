"""Connected components of a table of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrank.llm.shared import forget, kept


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node of its surroundings."""
    links = _both(edges)
    least = links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        links.join(least, "a")
        .where(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)`` that is not the smallest of its component.

    Nodes are longs; a link to itself and repeated links do no harm. Rounds
    alternate a large and a small star until the links stay the same, about
    log2 of the longest path squared at worst. Groupings keep one minimum per
    node and task, so a node with very many links meets in no single task; the
    joins are ordinary ones that adaptive execution splits. Each round is
    written to the shared folder, which bounds the lineage, and the one before is
    removed; the driver sees one count and one checksum per round.
    """
    edges = kept(edges.select("a", "b").where("a <> b").distinct())
    before = _digest(edges)
    while before[0]:
        after_round = kept(_small_star(_large_star(edges)))
        forget(edges)
        edges = after_round
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
