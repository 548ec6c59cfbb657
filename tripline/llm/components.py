"""Connected components of an edge table by alternating large and small stars.

Each round is a few joins on the edges; both stars keep the components, and at
rest every node points at the smallest of its component. Rounds are written
to the shared folder, so the lineage stays short and a lost executor costs a
retry of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.sources.session import settle

#: Tasks that the rows of one key are dealt to.
SALTS = 16


def spread_join(rows: DataFrame, each: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` with the one row that ``each`` has of their ``key``.

    A key may have any share of ``rows``: they are dealt by ``by`` as well, and
    ``each`` is copied to all places that they may come to.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).join(
        each.select("*", salts), [key, "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return spread_join(both.where("v > u"), least, "u", "v").select(
        F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger node u to the smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = spread_join(edges, least, "u", "v").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.where("u <> v").union(
        least.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """u, v of any edges -> node, root: the smallest node reachable.

    Nodes without an edge are absent, as are the roots themselves. Loops and
    repeated edges do no harm; an empty table gives an empty one.
    """
    current = settle(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _digest(current)
    while seen[0]:
        current = settle(_small_star(_large_star(current)), "stars")
        now = _digest(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
