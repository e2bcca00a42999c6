"""Great-circle distance and an equal-width grid over the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from waypost.functions.scalar import _c
from waypost.params import EARTH_RADIUS_KM

# Grid cells are enumerated with this much slack so that floating-point error at
# a cell edge can only add a candidate, never lose one.
_SLACK = 1 + 1e-9


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    phi1, phi2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = F.radians(_c(lon2) - _c(lon1)) / 2
    h = F.pow(F.sin(half_dphi), F.lit(2.0)) + F.cos(phi1) * F.cos(phi2) * F.pow(
        F.sin(half_dlambda), F.lit(2.0)
    )
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def band_height(km: float, radius_km: float = EARTH_RADIUS_KM) -> float:
    """Height of a grid band in degrees: the search radius, within sane limits."""
    return min(180.0, max(1e-4, math.degrees(km / radius_km)))


def _band(lat: Column, height: float) -> Column:
    return F.floor((lat + 90.0) / F.lit(height))


def _columns_in(band: Column, height: float) -> Column:
    """Cells around one band, each at least one search radius wide."""
    edge = F.greatest(
        F.abs(band * F.lit(height) - 90.0), F.abs((band + 1) * F.lit(height) - 90.0)
    )
    around = F.cos(F.radians(F.least(edge, F.lit(90.0)))) * F.lit(360.0 / height)
    return F.greatest(F.lit(1).cast("bigint"), F.floor(around))


def _key(band: Column, column: Column) -> Column:
    return band * F.lit(10_000_000).cast("bigint") + column


def cell_of(lat, lon, height: float) -> Column:
    """The one grid cell that holds a point; NULL without a position."""
    band = _band(_c(lat), height)
    count = _columns_in(band, height)
    turn = F.pmod(_c(lon) + 180.0, F.lit(360.0)) / 360.0
    return _key(band, F.least(F.floor(turn * count), count - 1))


def cells_within(lat, lon, km: float, height: float, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """All grid cells that a circle of ``km`` around the point may touch."""
    lat, lon = _c(lat), _c(lon)
    reach = math.degrees(km / radius_km) * _SLACK
    over_pole = F.abs(lat) + reach >= 90.0
    sine = F.least(F.lit(1.0), F.lit(math.sin(math.radians(min(reach, 90.0)))) / F.cos(F.radians(lat)))
    span = F.when(over_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(sine)) * F.lit(_SLACK))

    def in_band(band: Column) -> Column:
        count = _columns_in(band, height)
        first = F.floor((lon + 180.0 - span) / 360.0 * count - F.lit(1e-9))
        last = F.least(F.floor((lon + 180.0 + span) / 360.0 * count + F.lit(1e-9)), first + count - 1)
        return F.transform(F.sequence(first, last), lambda c: _key(band, F.pmod(c, count)))

    top = _band(F.lit(90.0), height)
    bands = F.sequence(
        F.greatest(F.lit(0).cast("bigint"), _band(lat - F.lit(reach), height)),
        F.least(top, _band(lat + F.lit(reach), height)),
    )
    return F.array_distinct(F.flatten(F.transform(bands, in_band)))
