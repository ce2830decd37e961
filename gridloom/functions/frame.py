"""World frame: Transverse Mercator on WGS84 as Column expressions; x is east, z is south, in metres.

Series after Snyder, Map Projections: A Working Manual (USGS Professional Paper 1395), pp. 61-64.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import radians, sin, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS84 ellipsoid.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
EP2 = E2 / (1 - E2)
M = (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256, 3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024, 15 * E2**2 / 256 + 45 * E2**3 / 1024, 35 * E2**3 / 3072)


@dataclass(frozen=True)
class Frame:
    """A projection centre, its scale, and the projected place of the block origin."""

    lat_0: float = 41.8972
    lon_0: float = -87.62443
    scale: float = 1.0
    west: float = -32.0
    north: float = 33.0

    def _arc_0(self) -> float:
        p = radians(self.lat_0)
        return AXIS * (M[0] * p - M[1] * sin(2 * p) + M[2] * sin(4 * p) - M[3] * sin(6 * p))


def to_block(lon: Column, lat: Column, frame: Frame = Frame()) -> tuple[Column, Column]:
    """(x, z) of a geographic position."""
    p = F.radians(lat)
    s, c, t = F.sin(p), F.cos(p), F.tan(p)
    n = AXIS / F.sqrt(1 - E2 * s * s)
    tt, cc, a = t * t, EP2 * c * c, F.radians(lon - frame.lon_0) * c
    arc = AXIS * (M[0] * p - M[1] * F.sin(2 * p) + M[2] * F.sin(4 * p) - M[3] * F.sin(6 * p))
    a2 = a * a
    east = n * a * (1 + a2 / 6 * (1 - tt + cc) + a2 * a2 / 120 * (5 - 18 * tt + tt * tt + 72 * cc - 58 * EP2))
    north = arc - frame._arc_0() + n * t * a2 * (0.5 + a2 / 24 * (5 - tt + 9 * cc + 4 * cc * cc) + a2 * a2 / 720 * (61 - 58 * tt + tt * tt + 600 * cc - 330 * EP2))
    return east * frame.scale - frame.west, frame.north - north * frame.scale


def to_geographic(x: Column, z: Column, frame: Frame = Frame()) -> tuple[Column, Column]:
    """(lon, lat) of a block position; add one half to both for a cell's centre."""
    e1 = (1 - sqrt(1 - E2)) / (1 + sqrt(1 - E2))
    mu = (frame._arc_0() + (frame.north - z) / frame.scale) / (AXIS * M[0])
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
    s, c, t = F.sin(p), F.cos(p), F.tan(p)
    w = 1 - E2 * s * s
    n, r, tt, cc = AXIS / F.sqrt(w), AXIS * (1 - E2) / (w * F.sqrt(w)), t * t, EP2 * c * c
    d = (x + frame.west) / (n * frame.scale)
    d2 = d * d
    lat = p - n * t / r * d2 * (0.5 - d2 / 24 * (5 + 3 * tt + 10 * cc - 4 * cc * cc - 9 * EP2) + d2 * d2 / 720 * (61 + 90 * tt + 298 * cc + 45 * tt * tt - 252 * EP2 - 3 * cc * cc))
    lon = d * (1 - d2 / 6 * (1 + 2 * tt + cc) + d2 * d2 / 120 * (5 - 2 * cc + 28 * tt - 3 * cc * cc + 8 * EP2 + 24 * tt * tt)) / c
    return F.degrees(lon) + frame.lon_0, F.degrees(lat)
