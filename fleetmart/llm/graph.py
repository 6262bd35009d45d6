"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.llm.store import Workspace


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """(id, component) for every id that occurs in ``links`` (columns a, b); component is the least id reachable.

    Every round rewrites the links so that they lead to ever smaller ids, and ends when a round changes nothing. Rounds
    grow with the logarithm of a component's size. The minimum per id is aggregated before the shuffle and the joins
    are plain equi-joins that AQE can split, so a star with very many links is not one task. Links of an id with
    itself and links with nulls are ignored.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = work.save(edges, "links")
    mark = _mark(edges)
    while True:
        wide = work.save(_large(edges).where("u <> v").distinct(), "large")
        new = work.save(_small(wide).where("u <> v").distinct(), "small")
        work.drop(wide)
        work.drop(edges)
        edges, before, mark = new, mark, _mark(new)
        if mark == before:
            break
    pairs = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id")
    return pairs.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
