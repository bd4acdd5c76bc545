"""Map projection: UTM easting/northing (metres) -> latitude/longitude.

Inverse transverse Mercator on the WGS84 ellipsoid with the Krueger series
to fourth order in the third flattening n (as published for UTM; accurate
to well under a millimetre inside a zone).  Written with built-in math
expressions only, so it runs inside generated code; there is no Python
worker or external projection package in the loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 semi-major axis and flattening; UTM scale factor and
# false easting/northing.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0
UTM_FALSE_NORTHING_SOUTH = 10000000.0

_N = WGS84_F / (2 - WGS84_F)
_A = WGS84_A / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_BETA = (
    _N / 2 - 2 * _N ** 2 / 3 + 37 * _N ** 3 / 96 - _N ** 4 / 360,
    _N ** 2 / 48 + _N ** 3 / 15 - 437 * _N ** 4 / 1440,
    17 * _N ** 3 / 480 - 37 * _N ** 4 / 840,
    4397 * _N ** 4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N ** 2 / 3 - 2 * _N ** 3 + 116 * _N ** 4 / 45,
    7 * _N ** 2 / 3 - 8 * _N ** 3 / 5 - 227 * _N ** 4 / 45,
    56 * _N ** 3 / 15 - 136 * _N ** 4 / 35,
    4279 * _N ** 4 / 630,
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _in_range(e: Column, n: Column) -> Column:
    return (e >= 100000) & (e <= 1000000) & (n >= 0) & (n <= 10000000)


def utm_to_latlon(easting: str | Column, northing: str | Column, zone: int = 10,
                  northern: bool = True) -> tuple[Column, Column]:
    """``(latitude, longitude)`` in degrees; null outside the valid UTM
    range (easting 100-1000 km, northing 0-10000 km) or for null input."""
    e = _col(easting).cast("double")
    n = _col(northing).cast("double")
    n0 = 0.0 if northern else UTM_FALSE_NORTHING_SOUTH
    xi = (n - F.lit(n0)) / F.lit(UTM_K0 * _A)
    eta = (e - F.lit(UTM_FALSE_EASTING)) / F.lit(UTM_K0 * _A)
    xi_p = xi
    eta_p = eta
    for j, b in enumerate(_BETA, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(xi * (2 * j)) * F.cosh(eta * (2 * j))
        eta_p = eta_p - F.lit(b) * F.cos(xi * (2 * j)) * F.sinh(eta * (2 * j))
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(chi * (2 * j))
    lon0 = math.radians(zone * 6 - 183)
    lam = F.lit(lon0) + F.atan2(F.sinh(eta_p), F.cos(xi_p))
    ok = _in_range(e, n)
    lat = F.when(ok, F.degrees(phi))
    lon = F.when(ok, F.degrees(lam))
    return lat, lon
