"""Sinks: denormalised CSV, GeoJSON lines, relational tables, source-wise replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo


def denormalised(sites: DataFrame) -> DataFrame:
    """One row per site and phase (sites without phases once), with the sources joined."""
    return sites.select("*", F.explode_outer("phases").alias("__ph")).select(
        "site_id", "nom_site", "pays", "commune", "type_site", "x_l93", "y_l93", "precision_localisation",
        *[F.coalesce(F.col(f"__ph.{c}").cast("string"), F.lit("")).alias(c) for c in ("periode", "sous_periode", "datation_debut", "datation_fin")],
        F.size("sources").alias("sources_count"), F.array_join(F.transform("sources", lambda s: s["reference"]), "; ").alias("references"),
    )


def features(sites: DataFrame) -> DataFrame:
    """One GeoJSON feature per located site (column ``value``)."""
    lon, lat = geo.to_wgs84(F.col("x_l93"), F.col("y_l93"))
    props = F.struct("site_id", "nom_site", "commune", "pays", "type_site", F.array_join(F.transform("phases", lambda p: p["periode"]), ", ").alias("periodes"))
    body = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), props.alias("properties"))
    return sites.where("x_l93 is not null and y_l93 is not null").select(F.to_json(body).alias("value"))


def relational(sites: DataFrame) -> dict[str, DataFrame]:
    """The tables sites, phases and sources."""
    child = lambda c: sites.select(F.explode(c).alias("s")).select("s.*")
    flat = [F.to_json(c).alias(c) if t.startswith(("array", "map")) else F.col(c) for c, t in sites.dtypes if c not in ("phases", "sources")]
    return {"sites": sites.select(*flat), "phases": child("phases"), "sources": child("sources")}


def export(sites: DataFrame, out: str) -> None:
    """All sinks under one folder; each is written in parallel parts."""
    denormalised(sites).write.mode("overwrite").csv(f"{out}/sites_csv", header=True)
    features(sites).write.mode("overwrite").text(f"{out}/sites_geojson")
    for name, t in relational(sites).items():
        t.write.mode("overwrite").parquet(f"{out}/{name}")


def replace_source(df: DataFrame, path: str, source: str) -> None:
    """Overwrite only the partitions of the sources in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)
