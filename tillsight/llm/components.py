"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.llm.sized import bounded, merged
from tillsight.session import cut_lineage

LINKS_PER_TASK = 20_000


def few_tasks(df: DataFrame, rows: int, each: int = LINKS_PER_TASK) -> DataFrame:
    """The same rows in no more tasks than so many rows keep busy; the shuffle's own number where that is less."""
    return df.coalesce(max(1, -(-rows // each)))


def nearest(edges: DataFrame, rows: int) -> DataFrame:
    """(a, b, least): each edge with the smallest neighbour of its node a, or a itself.

    The minima are written first, so that Spark can split the edges of one node in the join.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("least"))
    return few_tasks(edges.join(merged(cut_lineage(few_tasks(least, rows)), rows), "a"), rows)


def large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return nearest(both, 2 * rows).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def small_star(edges: DataFrame, rows: int) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = nearest(down, rows)
    moved = found.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(found.select("a", F.col("least").alias("b")))


def are_stars(edges: DataFrame, rows: int) -> bool:
    """Whether each node points to one other, which points to none: nothing is left to do."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    counts = ends.groupBy("node").agg(F.sum("out").alias("out"), F.count("*").alias("all"))
    return few_tasks(counts, rows).filter("out > 1 OR (out = 1 AND all > 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of links (a, b); the component is its smallest node.

    Each round is two joins on the nodes; a node with very many links is a skewed join
    key, which Spark splits. The rounds grow with the logarithm of the longest path.
    """
    edges = cut_lineage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while (rows := edges.count()) and not are_stars(edges, rows):
        large = cut_lineage(few_tasks(large_star(edges, rows).distinct(), rows))
        edges = cut_lineage(few_tasks(small_star(large, rows).distinct(), rows))
    pointing = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return few_tasks(pointing.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()), rows)


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components (node, component) after further links (a, b): only the graph of the components is searched."""
    named, rows = labels.withColumnRenamed("component", "c"), labels.count()
    for end in "ab":
        own = named.select(F.col("node").alias(end), F.col("c").alias(f"c{end}"))
        links = links.join(merged(own, rows), end, "left")
    found = cut_lineage(components(links.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))))
    moved = found.select(F.col("node").alias("c"), "component")
    known = named.join(bounded(moved), "c", "left").select("node", F.coalesce("component", "c").alias("component"))
    return known.union(found.join(merged(named.select("node"), rows), "node", "left_anti").select("node", "component"))
