"""Roles of the star-schema tables: sites, phases and their derived positions and years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lon(key):
    return F.lit(6.5) + (key % 1000) / F.lit(500.0)


def lat(key):
    return F.lit(47.5) + (key * 7 % 1000) / F.lit(800.0)


def metre_x(key):
    """Projected stand-in position on a 20 km square."""
    return (key * 7919 % 20000).cast("double")


def metre_y(key):
    return (key * 104729 % 20000).cast("double")


def sites(spark: SparkSession, sf: str) -> DataFrame:
    n = F.broadcast(t(spark, sf, "nation"))
    return t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("site_id"), F.col("c_name").alias("name"), F.col("n_name").alias("commune"), F.col("c_mktsegment").alias("kind"), F.col("c_acctbal").alias("surface"))


SITES = "sites AS (SELECT c_custkey AS site_id, c_name AS name, n_name AS commune, c_mktsegment AS kind, c_acctbal AS surface FROM customer JOIN nation ON c_nationkey = n_nationkey)"
LON = "(CAST(6.5 AS DOUBLE) + ({k} % 1000) / CAST(500 AS DOUBLE))"
LAT = "(CAST(47.5 AS DOUBLE) + ({k} * 7 % 1000) / CAST(800 AS DOUBLE))"
XY = "CAST({k} * 7919 % 20000 AS DOUBLE) AS x, CAST({k} * 104729 % 20000 AS DOUBLE) AS y"
FOLD = "translate(lower({c}), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy')"
