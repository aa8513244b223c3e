"""Forward and inverse map projections as columns (Snyder 1987, closed forms on the GRS80 ellipsoid)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid, and the parameters of EPSG:3005 and EPSG:3978.
A, FLAT = 6_378_137.0, 1 / 298.257222101
E2 = FLAT * (2 - FLAT)
E1 = math.sqrt(E2)
ALBERS = {"lat0": 45.0, "lon0": -126.0, "lat1": 50.0, "lat2": 58.5, "x0": 1_000_000.0, "y0": 0.0}
LAMBERT = {"lat0": 49.0, "lon0": -95.0, "lat1": 49.0, "lat2": 77.0, "x0": 0.0, "y0": 0.0}


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))


def _t(phi: float) -> float:
    s = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - E1 * s) / (1 + E1 * s)) ** (E1 / 2)


def albers(lon: Column, lat: Column, p: dict = ALBERS) -> tuple[Column, Column]:
    """(x, y) of the equal-area conic projection."""
    lat0, lat1, lat2 = (math.radians(p[k]) for k in ("lat0", "lat1", "lat2"))
    n = (_m(lat1) ** 2 - _m(lat2) ** 2) / (_q(lat2) - _q(lat1))
    c = _m(lat1) ** 2 + n * _q(lat1)
    rho0 = A * math.sqrt(c - n * _q(lat0)) / n
    s = F.sin(F.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - E1 * s) / (1 + E1 * s)) / (2 * E1))
    rho = A * F.sqrt(c - n * q) / n
    theta = n * F.radians(lon - p["lon0"])
    return p["x0"] + rho * F.sin(theta), p["y0"] + rho0 - rho * F.cos(theta)


def _cone(p: dict) -> tuple[float, float, float]:
    lat0, lat1, lat2 = (math.radians(p[k]) for k in ("lat0", "lat1", "lat2"))
    n = (math.log(_m(lat1)) - math.log(_m(lat2))) / (math.log(_t(lat1)) - math.log(_t(lat2)))
    f = _m(lat1) / (n * _t(lat1) ** n)
    return n, f, A * f * _t(lat0) ** n


def lambert(lon: Column, lat: Column, p: dict = LAMBERT) -> tuple[Column, Column]:
    """(x, y) of the conformal conic projection."""
    n, f, rho0 = _cone(p)
    s = F.sin(F.radians(lat))
    t = F.tan(math.pi / 4 - F.radians(lat) / 2) / F.pow((1 - E1 * s) / (1 + E1 * s), F.lit(E1 / 2))
    rho, theta = A * f * F.pow(t, F.lit(n)), n * F.radians(lon - p["lon0"])
    return p["x0"] + rho * F.sin(theta), p["y0"] + rho0 - rho * F.cos(theta)


def lambert_inverse(x: Column, y: Column, p: dict = LAMBERT) -> tuple[Column, Column]:
    """(lon, lat); the latitude by five steps of its fixed-point rule."""
    n, f, rho0 = _cone(p)
    dx, dy = x - p["x0"], rho0 - (y - p["y0"])
    t = F.pow(F.sqrt(dx * dx + dy * dy) / (A * f), F.lit(1 / n))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(5):
        s = F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - E1 * s) / (1 + E1 * s), F.lit(E1 / 2)))
    return F.degrees(F.atan2(dx, dy) / n) + p["lon0"], F.degrees(phi)


def great_circle_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * 6371.0088 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))
