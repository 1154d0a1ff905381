"""Connected components of an edge table, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.scratch import Scratch


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _stars(pairs: DataFrame, lowest: DataFrame) -> DataFrame:
    return pairs.join(lowest, F.col("u") == F.col("n"))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, numbers): a component is named by its smallest node.

    Each round joins every edge with the smallest neighbour of its ends and writes the new edges to the shared folder. Stars, the usual
    shape of groups of copies, take two rounds; a chain of n nodes takes about log n. No group is gathered in a task.
    """
    now = scratch.keep(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = scratch.keep(_stars(both, lowest).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        lowest = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = _stars(down, lowest).where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        after = scratch.keep(small.unionByName(lowest.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct())
        scratch.drop(now, large)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    ends = now.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    found = scratch.keep(ends.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
    scratch.drop(now)
    return found


def linked(named: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """``named`` (``node, component``) after more ``links``: only the components that these join are worked on, not the older edges."""
    ends = links.join(named.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left").join(
        named.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
    joined = components(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")), scratch)
    renamed = named.join(joined.select(F.col("node").alias("n"), F.col("component").alias("c")), F.col("component") == F.col("n"), "left")
    known = renamed.select("node", F.coalesce("c", "component").alias("component"))
    now = scratch.keep(known.unionByName(joined.join(named, "node", "left_anti")))
    scratch.drop(joined, named)
    return now
