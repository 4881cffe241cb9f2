"""Connected components by alternating large-star and small-star rounds, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: A node is hot with over 1 / (HOT_SHARE * partitions) of all rows; its rows are dealt over SALTS parts.
HOT_SHARE = 4
SALTS = 64


def _with_least(rows: DataFrame, least: DataFrame, limit: int) -> DataFrame:
    """rows (a, b) joined to least (a, m, n); a hot node's rows are dealt by their other end.

    Nodes over the limit are a few times the partitions at most, so their list may be broadcast.
    """
    hot = F.broadcast(least.where(F.col("n") > limit).select("a", F.lit(True).alias("hot")))
    dealt = rows.join(hot, "a", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.hash("b"), F.lit(SALTS))).otherwise(0)).drop("hot")
    salts = F.when(F.col("n") > limit, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(least.select("a", "m", F.explode(salts).alias("salt")), ["a", "salt"]).drop("salt")


def _large_star(edges: DataFrame, limit: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count(F.lit(1)).alias("n"))
    return _with_least(both.where("b > a"), least, limit).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame, limit: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
    linked = _with_least(down, least, limit)
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node reachable, for every node with an edge (columns a, b) but the roots themselves.

    Rounds are logarithmic in the longest path and go on until nothing changes; each is written to the
    shared folder. Minima are partly aggregated before the shuffle and the star of a hot node is salted.
    """
    edges = materialise(edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before, total = None, edges.count()
    while True:
        limit = max(SALTS, 2 * total // (HOT_SHARE * parts))
        edges = materialise(_small_star(_large_star(edges, limit), limit), "cc")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, total = now, now[0]
