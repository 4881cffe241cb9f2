"""Projections and distances as closed-form expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS80, and Lambert-93 (conformal conic, parallels 44 and 49, origin 46.5 N 3 E).
A, FLAT = 6378137.0, 1 / 298.257222101
E = math.sqrt(2 * FLAT - FLAT * FLAT)
LAT1, LAT2, LAT0, LON0, X0, Y0 = 44.0, 49.0, 46.5, 3.0, 700000.0, 6600000.0
EARTH = 6371000.0


def _t(lat: float) -> float:
    return math.tan(math.pi / 4 - lat / 2) / ((1 - E * math.sin(lat)) / (1 + E * math.sin(lat))) ** (E / 2)


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - (E * math.sin(lat)) ** 2)


_P1, _P2, _P0 = (math.radians(x) for x in (LAT1, LAT2, LAT0))
N = (math.log(_m(_P1)) - math.log(_m(_P2))) / (math.log(_t(_P1)) - math.log(_t(_P2)))
C = _m(_P1) / (N * _t(_P1) ** N)
RHO0 = A * C * _t(_P0) ** N


def to_lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - E * F.sin(phi)) / (1 + E * F.sin(phi)), F.lit(E / 2))
    rho = F.lit(A * C) * F.pow(t, F.lit(N))
    theta = F.lit(N) * (F.radians(lon) - math.radians(LON0))
    return X0 + rho * F.sin(theta), Y0 + RHO0 - rho * F.cos(theta)


def to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat); five steps of the latitude iteration."""
    dx, dy = x - X0, F.lit(RHO0) - (y - Y0)
    t = F.pow(F.sqrt(dx * dx + dy * dy) / (A * C), F.lit(1 / N))
    phi = F.lit(math.pi / 2) - 2 * F.atan(t)
    for _ in range(5):
        phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - E * F.sin(phi)) / (1 + E * F.sin(phi)), F.lit(E / 2)))
    return F.degrees(F.atan2(dx, dy) / N) + LON0, F.degrees(phi)


def utm32_to_wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat) of UTM zone 32 north, by Krueger's series to the fourth order."""
    n = FLAT / (2 - FLAT)
    radius = A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280)
    delta = (2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45, 56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630)
    xi, eta = y / (0.9996 * radius), (x - 500000.0) / (0.9996 * radius)
    north, east = xi, eta
    for k, b in enumerate(beta, 1):
        north = north - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        east = east - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(north) / F.cosh(east))
    lat = chi
    for k, d in enumerate(delta, 1):
        lat = lat + d * F.sin(2 * k * chi)
    return 9.0 + F.degrees(F.atan2(F.sinh(east), F.cos(north))), F.degrees(lat)


def reproject(x: Column, y: Column, epsg: int) -> tuple[Column, Column]:
    """To Lambert-93 from 2154, 4326 or 25832; missing, not finite and null-island points are null."""
    if epsg == 2154:
        out = (x, y)
    elif epsg == 4326:
        out = to_lambert93(x, y)
    elif epsg == 25832:
        out = to_lambert93(*utm32_to_wgs84(x, y))
    else:
        raise ValueError(f"EPSG {epsg} is not supported")
    sound = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")) & ~((x == 0) & (y == 0))
    return F.when(sound, out[0]), F.when(sound, out[1])


#: Where Lambert-93 coordinates are plausible (x from, x to, y from, y to).
LAMBERT_BOUNDS = (100_000.0, 1_200_000.0, 6_000_000.0, 7_200_000.0)


def reprojected(x: Column, y: Column, epsg: Column) -> Column:
    """struct(x, y, in_bounds) in Lambert-93, by the system of each row; what cannot be placed is null and out of bounds."""
    known = {code: reproject(x, y, code) for code in (2154, 4326, 25832)}
    pick = lambda i: F.coalesce(*[F.when(epsg == code, at[i]) for code, at in known.items()])
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
    px, py = finite(pick(0)), finite(pick(1))
    whole = px.isNotNull() & py.isNotNull()
    return F.struct(F.when(whole, px).alias("x"), F.when(whole, py).alias("y"), F.coalesce(whole & in_box(px, py, LAMBERT_BOUNDS), F.lit(False)).alias("in_bounds"))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Metres between projected points."""
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * EARTH * F.asin(F.sqrt(a))


def snap(c: Column, step: int = 50) -> Column:
    """Nearest grid line, halves to even."""
    return F.bround(c / step) * step


def in_box(x: Column, y: Column, box) -> Column:
    return x.between(box[0], box[1]) & y.between(box[2], box[3])
