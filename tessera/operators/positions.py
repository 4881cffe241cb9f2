"""The position of a group of rows: choice, conflicts and their details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo

#: Positions nearer than this in both coordinates are one.
TOLERANCE = 1e-5


def _sound(x: Column, y: Column) -> Column:
    """Both coordinates are there and finite."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(finite(x) & finite(y), F.lit(False))


def preference(box: tuple[float, float, float, float], order: str) -> Column:
    """Sort key over x, y, epsg, date: a known system first, then a point within the box (degrees), then the latest date, then ``order``."""
    x, y, epsg = F.col("x"), F.col("y"), F.col("epsg")
    lon, lat = geo.utm32_to_wgs84(x, y)
    within = F.when(epsg == 4326, geo.in_box(x, y, box)).when(epsg == 25832, geo.in_box(lon, lat, box))
    near = F.coalesce(F.when(_sound(x, y), within), F.lit(False))
    late = F.coalesce(-F.unix_micros(F.col("date").cast("timestamp")), F.lit(0))
    return F.struct(epsg.isNull().alias("unknown"), (~near).alias("far"), late.alias("late"), F.col(order).alias("o"))


def signature() -> Column:
    """What makes two positions different: their system, and their coordinates by steps of the tolerance; unknown ones are alike."""
    step = lambda c: F.when(_sound(F.col("x"), F.col("y")), F.round(F.col(c) / TOLERANCE))
    return F.struct(step("x").alias("x"), step("y").alias("y"), F.coalesce("epsg", F.lit(0)).alias("epsg"))


def chosen(rows: DataFrame, group: str, box: tuple[float, float, float, float], order: str) -> DataFrame:
    """One row a group: x, y, epsg, date of its preferred row, n rows, and whether its positions differ.

    rows: group, x, y, epsg, date, order. Two extremes tell whether signatures differ, so all is aggregated
    before the shuffle and a large group takes no more room than a small one.
    """
    s = signature()
    best = F.min_by(F.struct("x", "y", "epsg", "date"), preference(box, order))
    return rows.groupBy(group).agg(best.alias("b"), F.count(F.lit(1)).alias("n"), (F.min(s) != F.max(s)).alias("conflict")).select(group, "b.x", "b.y", "b.epsg", "b.date", "n", "conflict")


def conflict_details(rows: DataFrame, picked: DataFrame, group: str, order: str) -> DataFrame:
    """(group, details): JSON of the chosen position and of all rows of each group whose positions differ, dates as text."""
    told = F.struct("x", "y", "epsg", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss").alias("date"))
    clash = picked.where("conflict").select(group, told.alias("chosen"))
    held = rows.join(clash.select(group), group, "left_semi").groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), told.alias("r")))), lambda v: v["r"]).alias("rows"))
    return clash.join(held, group).select(group, F.to_json(F.struct("chosen", "rows"), {"ignoreNullFields": "false"}).alias("details"))
