"""Connected components of a graph that lies in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.llm.scratch import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the links (long ids): the smallest node that it is joined to.

    Alternates the two star steps: each node hands its larger neighbours, then its smaller ones, to the
    smallest neighbour, until every link points to the smallest node of its component. The rounds grow with
    the logarithm of a component's size. Each round is written, so a lost executor repeats one round at most,
    and a node with very many links is summed up by its minimum before the shuffle and joined, not gathered.
    Null ends and links of a node with itself are left out.
    """
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    mark = _mark(links)
    while mark[0]:
        links = written(_small_star(_large_star(links)), "links")
        before, mark = mark, _mark(links)
        if mark == before:
            break
    roots = links.select(F.col("b").alias("a"), "b")
    return links.union(roots).distinct().select(F.col("a").alias("node"), F.col("b").alias("component"))


def _mark(links: DataFrame) -> tuple:
    """Tells one set of links from another."""
    return tuple(
        links.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a").toDF("a", "b"))
    least = links.union(links.select("b", "a").toDF("a", "b")).groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.toDF("a", "b")).distinct()
