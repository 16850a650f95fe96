"""Connected components of a graph given as a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasmlens.llm.frames import stored

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b of one orderable type);
    the root is the smallest node of the component.

    Large-star and small-star steps take turns until no link changes. A step joins every
    node's links with the smallest neighbour, an aggregate, and keeps distinct links only;
    no neighbourhood is gathered anywhere. Every round is written to the shared folder.
    """
    edges = stored(links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        large = _star(_both_ways(edges), above_only=True)
        # Links now lead from a node to a smaller one; a node's smallest one takes over the others.
        small = stored(_star(large, above_only=False), "links")
        before, state = state, _state(small)
        if state == before:
            return small.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = small
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(links: DataFrame, above_only: bool) -> DataFrame:
    """Link every neighbour of u (only larger ones, or all smaller ones and u itself) with
    the smallest of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("_u"), F.least("m", "u").alias("m"))
    joined = links.join(least, F.col("u") == F.col("_u"))
    if above_only:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    """Size and sums of hashes; equal for equal sets of links."""
    return tuple(links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
