"""Column expressions of the record and observation model. No UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from waypost.params import (
    AREA_TIERS,
    GLOBAL_AREA,
    GLOBAL_COST,
    KNOTS_PER_MS,
    USABLE_FIX_AGE_SECONDS,
    VERTICAL_RATE_DEADBAND,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_callsign(callsign: Column | str) -> Column:
    """Callsign without its fixed-width padding; a blank one is absent."""
    trimmed = F.regexp_replace(_c(callsign), r"^\s+|\s+$", "")
    return F.nullif(trimmed, F.lit(""))


def observed_at(time_position: Column | str, last_contact: Column | str) -> Column:
    return F.coalesce(_c(time_position), _c(last_contact))


def dedup_key(icao24: Column | str, time_position: Column | str, last_contact: Column | str) -> Column:
    """Observation identity; contact-only rows are tagged so they never meet a real fix."""
    fix = _c(time_position).cast("string")
    contact = F.concat(F.lit("c"), _c(last_contact).cast("string"))
    return F.concat_ws(":", _c(icao24), F.coalesce(fix, contact))


def position_age(time_position: Column | str, last_contact: Column | str) -> Column:
    return F.coalesce(_c(last_contact) - _c(time_position), F.lit(0))


def has_position(latitude: Column | str = "latitude", longitude: Column | str = "longitude") -> Column:
    return _c(latitude).isNotNull() & _c(longitude).isNotNull()


def epoch_to_ts(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_c(seconds))


def best_altitude(geometric: Column | str = "geo_altitude", barometric: Column | str = "baro_altitude") -> Column:
    return F.coalesce(_c(geometric), _c(barometric))


def usable_position(
    age: Column | str = "position_age_seconds",
    latitude: Column | str = "latitude",
    longitude: Column | str = "longitude",
    max_age_seconds: int = USABLE_FIX_AGE_SECONDS,
) -> Column:
    return has_position(latitude, longitude) & (_c(age) <= max_age_seconds)


def flight_phase(
    on_ground: Column | str = "on_ground",
    vertical_rate: Column | str = "vertical_rate",
    deadband: float = VERTICAL_RATE_DEADBAND,
) -> Column:
    rate = _c(vertical_rate)
    return (
        F.when(_c(on_ground), F.lit("ground"))
        .when(rate.isNull(), F.lit("unknown"))
        .when(rate > deadband, F.lit("climb"))
        .when(rate < -deadband, F.lit("descent"))
        .otherwise(F.lit("cruise"))
    )


def to_knots(ms: Column | str, factor: float = KNOTS_PER_MS) -> Column:
    return F.round(_c(ms) * F.lit(factor))


def to_minutes(seconds: Column | str) -> Column:
    return F.round(_c(seconds) / F.lit(60.0), 1)


def metres_to_km(metres: Column | str) -> Column:
    return _c(metres) / F.lit(1000.0)


def safe_ratio(part: Column | str, whole: Column | str, scale: int = 1) -> Column:
    """``part / whole`` rounded; NULL where ``whole`` is 0."""
    return F.round(_c(part) / F.nullif(_c(whole), F.lit(0)), scale)


def safe_percent(part: Column | str, whole: Column | str, scale: int = 1) -> Column:
    """``part`` as a percentage of ``whole``.

    Scaled by 100 before the single division, so that a tie reaches ``round`` as
    the decimal tie it is.
    """
    return F.round(_c(part) * F.lit(100) / F.nullif(_c(whole), F.lit(0)), scale)


def empty_to_null(text: Column | str) -> Column:
    return F.nullif(_c(text), F.lit(""))


def flight_id(icao24: Column | str = "icao24", session_seq: Column | str = "session_seq") -> Column:
    return F.concat(_c(icao24), F.lit("-"), _c(session_seq).cast("string"))


def partition_date(ts: Column | str = "observed_at") -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd")


def partition_hour(ts: Column | str = "observed_at") -> Column:
    return F.date_format(_c(ts), "HH")


def hour_bucket(ts: Column | str = "observed_at") -> Column:
    return F.date_trunc("hour", _c(ts))


def is_global_box(lat_min="lat_min", lon_min="lon_min", lat_max="lat_max", lon_max="lon_max") -> Column:
    """The all-zero box stands for the whole world."""
    return (_c(lat_min) == 0) & (_c(lon_min) == 0) & (_c(lat_max) == 0) & (_c(lon_max) == 0)


def box_area(lat_min="lat_min", lon_min="lon_min", lat_max="lat_max", lon_max="lon_max") -> Column:
    extent = (_c(lat_max) - _c(lat_min)) * (_c(lon_max) - _c(lon_min))
    return F.when(is_global_box(lat_min, lon_min, lat_max, lon_max), F.lit(GLOBAL_AREA)).otherwise(extent)


def box_cost(lat_min="lat_min", lon_min="lon_min", lat_max="lat_max", lon_max="lon_max") -> Column:
    """Credits for one poll, by area tier."""
    box = (lat_min, lon_min, lat_max, lon_max)
    cost = F.when(is_global_box(*box), F.lit(GLOBAL_COST))
    for area, credits in AREA_TIERS:
        cost = cost.when(box_area(*box) <= area, F.lit(credits))
    return cost.otherwise(F.lit(GLOBAL_COST))


def in_box(latitude, longitude, lat_min, lon_min, lat_max, lon_max) -> Column:
    """Inside the box, edges included; vectors without a position belong everywhere."""
    return (
        is_global_box(lat_min, lon_min, lat_max, lon_max)
        | ~has_position(latitude, longitude)
        | (
            _c(latitude).between(_c(lat_min), _c(lat_max))
            & _c(longitude).between(_c(lon_min), _c(lon_max))
        )
    )
