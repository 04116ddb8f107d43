"""Transverse Mercator (UTM, WGS 84) as column expressions, by Krüger's series to the third order."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS 84 and the UTM scale and false origin, in metres.
AXIS, FLATTENING, SCALE, EAST, SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500_000.0, 10_000_000.0
_N = FLATTENING / (2 - FLATTENING)
_RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)
_E = 2 * math.sqrt(_N) / (1 + _N)


def utm_zone(crs: str) -> tuple[int, bool]:
    """(zone, south) of 'EPSG:326zz' or 'EPSG:327zz'; other systems aren't supported."""
    m = re.fullmatch(r"EPSG:32([67])(\d\d)", crs)
    if not m or not 1 <= int(m[2]) <= 60:
        raise ValueError(f"not a UTM zone on WGS 84: {crs}")
    return int(m[2]), m[1] == "7"


def to_utm(lat: Column, lon: Column, crs: str) -> tuple[Column, Column]:
    """(x, y) in metres of degrees north and east."""
    zone, south = utm_zone(crs)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(zone * 6.0 - 183.0))
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(_E) * F.atanh(F.lit(_E) * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for k, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        y = y + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return F.lit(EAST) + SCALE * _RADIUS * x, F.lit(SOUTH if south else 0.0) + SCALE * _RADIUS * y


def from_utm(x: Column, y: Column, crs: str) -> tuple[Column, Column]:
    """(lat, lon) in degrees of metres east and north."""
    zone, south = utm_zone(crs)
    xi, eta = (y - F.lit(SOUTH if south else 0.0)) / (SCALE * _RADIUS), (x - F.lit(EAST)) / (SCALE * _RADIUS)
    u, v = xi, eta
    for k, b in enumerate(_BETA, 1):
        u = u - b * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        v = v - b * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    chi = F.asin(F.sin(u) / F.cosh(v))
    phi = chi
    for k, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * k * chi)
    return F.degrees(phi), F.degrees(F.atan2(F.sinh(v), F.cos(u))) + F.lit(zone * 6.0 - 183.0)


def reproject(x: Column, y: Column, source: str, target: str) -> tuple[Column, Column]:
    """Coordinates of one UTM zone in another."""
    return (x, y) if source == target else to_utm(*from_utm(x, y, source), target)
