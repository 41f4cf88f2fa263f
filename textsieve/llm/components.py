"""Connected components of a table of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from textsieve.staging import write_staged


def _settled(edges: DataFrame) -> bool:
    """Whether every larger end has one link, and no link has it as its smaller end."""
    ends = edges.select(F.col("a").alias("id"), F.lit(0).alias("links")).union(edges.select("b", F.lit(1)))
    open_ = ends.groupBy("id").agg(F.sum("links").alias("n"), F.min("links").alias("least"))
    return open_.filter("n > least").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """id and component_id (the smallest id reachable) of every id in links (a, b).

    Each round joins every node's neighbours to the smallest of them, first the
    larger neighbours, then the smaller ones, until all links are stars around the
    smallest ids. Smallest neighbours are aggregated and written before they are
    joined back, so that Spark may split a node with very many links. Null ids and
    links of an id to itself are left out; repeated links count once; no links give
    no rows.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = write_staged(ordered.filter("a < b").distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = write_staged(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = write_staged(
            both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a < b").distinct(), "edges"
        )
        least = write_staged(large.groupBy("b").agg(F.min("a").alias("m")), "least")
        joined = large.join(least, "b")
        edges = write_staged(
            joined.select(F.col("m").alias("a"), "b").union(joined.select(F.col("m").alias("a"), F.col("a").alias("b"))).filter("a < b").distinct(),
            "edges",
        )
    roots = edges.select(F.col("a").alias("id"), F.col("a").alias("component_id")).distinct()
    return edges.select(F.col("b").alias("id"), F.col("a").alias("component_id")).union(roots)


def labelled(rows: DataFrame, column: str, found: DataFrame) -> DataFrame:
    """rows with the component of column, itself if it has no links."""
    known = found.select(F.col("id").alias(column), "component_id")
    return rows.join(known, column, "left").withColumn("component_id", F.coalesce("component_id", column))


def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) that lie in different components, with these: left and right."""
    a = labelled(pairs, "a", found).withColumnRenamed("component_id", "left")
    return labelled(a, "b", found).withColumnRenamed("component_id", "right").filter("left != right")


def joined_by(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components when links (a, b) are added to those of which found is the result.

    Only the components themselves are linked and go through the rounds.
    """
    new = write_staged(components(apart(links, found).select(F.col("left").alias("a"), F.col("right").alias("b"))), "joined")
    moved = found.join(new.select(F.col("id").alias("component_id"), F.col("component_id").alias("to")), "component_id", "left")
    moved = moved.select("id", F.coalesce("to", "component_id").alias("component_id"))
    return moved.union(new.join(found.select("id"), "id", "left_anti"))
