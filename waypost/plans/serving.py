"""Ready-made questions over the model tables. Times are relative to ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.functions.scalar import empty_to_null, safe_percent, to_knots
from waypost.operators.dedup import latest_per_key
from waypost.params import QUALITY_LEVELS
from waypost.plans.partials import headline as partial_headline


class NoTrack(LookupError):
    """The flight has no usable position."""


def _as_of(as_of: dt.datetime | None) -> Column:
    return F.lit(as_of) if as_of is not None else F.current_timestamp()


def _between(name: str, value: int, low: int, high: int | None) -> None:
    if value < low or (high is not None and value > high):
        raise ValueError(f"{name}={value} is out of range")


def latest_positions(silver: DataFrame, as_of: dt.datetime | None = None, max_age_s: int = 900) -> DataFrame:
    """Latest usable row per aircraft; stale fixes are dropped first, so none can win."""
    _between("max_age_s", max_age_s, 0, None)
    recent = silver.where("has_usable_position").where(
        F.col("observed_at") >= _as_of(as_of) - F.make_interval(secs=F.lit(max_age_s))
    )
    newest = latest_per_key(
        recent.select(
            "icao24", "callsign", "origin_country", "latitude", "longitude", "altitude_m",
            "velocity", "true_track", "on_ground", "observed_at", "position_age_seconds",
        ),
        ["icao24"],
        ["observed_at"],
    )
    return newest.select(
        "icao24", "callsign", "origin_country", "latitude", "longitude", "altitude_m",
        to_knots("velocity").alias("velocity_knots"),
        "true_track", "on_ground", "observed_at", "position_age_seconds",
    )


def live(
    silver: DataFrame, as_of: dt.datetime | None = None, max_age_s: int = 900, limit: int = 2000
) -> DataFrame:
    _between("limit", limit, 1, 10_000)
    return (
        latest_positions(silver, as_of, max_age_s)
        .orderBy(F.desc("observed_at"), "icao24")
        .limit(limit)
    )


def flight_list(
    flights: DataFrame, limit: int = 100, min_quality: str = "low", complete_only: bool = False
) -> DataFrame:
    """Flights of at least ``min_quality``, newest first."""
    _between("limit", limit, 1, 1000)
    allowed = QUALITY_LEVELS[QUALITY_LEVELS.index(min_quality):]
    chosen = flights.where(F.col("reconstruction_quality").isin(*allowed))
    if complete_only:
        chosen = chosen.where("is_complete")
    return (
        chosen.select(
            "flight_id", "icao24", "callsign", "departure_time", "arrival_time", "duration_minutes",
            empty_to_null("departure_airport").alias("departure_airport"),
            empty_to_null("arrival_airport").alias("arrival_airport"),
            "max_altitude_m", "max_velocity_knots", "endpoint_distance_km",
            "observation_count", "is_complete", "reconstruction_quality",
        )
        .orderBy(F.desc("departure_time"), "flight_id")
        .limit(limit)
    )


def track_points(sessions: DataFrame) -> DataFrame:
    """Usable points of all flights, as ``track`` lists them."""
    return sessions.where("has_usable_position").select(
        "flight_id", "observed_at", "latitude", "longitude", "altitude_m",
        to_knots("velocity").alias("velocity_knots"),
        "vertical_rate", "flight_phase", "seconds_since_previous",
    )


def track(sessions: DataFrame, flight_id: str) -> DataFrame:
    """Usable points of one flight in order; an unknown flight is an error."""
    # The aircraft is part of the id; naming it lets sorted files be skipped.
    icao24 = flight_id.rpartition("-")[0]
    points = track_points(
        sessions.where((F.col("icao24") == icao24) & (F.col("flight_id") == flight_id))
    ).drop("flight_id")
    if points.isEmpty():
        raise NoTrack(f"no track for flight {flight_id}")
    return points.orderBy("observed_at")


def traffic_window(traffic: DataFrame, as_of: dt.datetime | None = None, hours: int = 48) -> DataFrame:
    _between("hours", hours, 1, 720)
    return (
        traffic.where(F.col("traffic_hour") >= _as_of(as_of) - F.make_interval(hours=F.lit(hours)))
        .select(
            "traffic_hour", "region", "distinct_aircraft", "distinct_airborne",
            "observations", "duplicate_rate_pct",
        )
        .orderBy("traffic_hour", "region")
    )


def stats(bronze: DataFrame, ingest_batches: DataFrame, flights: DataFrame) -> DataFrame:
    """Headline measures, one row.

    The duplicate rate comes from the ingest metrics: a table that collapses
    copies no longer shows how many there were.
    """
    observations = (
        bronze.groupBy("icao24", "observed_at", "region")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    headline = observations.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.count_distinct(F.struct("icao24", "observed_at")).alias("distinct_observations"),
        F.count_distinct("icao24").alias("distinct_aircraft"),
        F.max("observed_at").alias("latest_observation"),
        F.sort_array(F.collect_set("region")).alias("regions"),
    )
    return _with_totals(headline, ingest_batches, flights)


def stats_from_partials(partials: DataFrame, ingest_batches: DataFrame, flights: DataFrame) -> DataFrame:
    """``stats`` from the counts kept with each batch (``plans.partials``), without reading bronze."""
    return _with_totals(partial_headline(partials), ingest_batches, flights)


def _with_totals(headline: DataFrame, ingest_batches: DataFrame, flights: DataFrame) -> DataFrame:
    ingested = ingest_batches.agg(
        F.struct(
            F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("distinct_observations"), F.lit(0)).alias("seen"),
        )
    ).scalar()
    built = flights.agg(
        F.struct(
            F.count(F.lit(1)).alias("flights"), F.count_if("is_complete").alias("complete")
        )
    ).scalar()
    rows, seen = ingested.getField("rows"), ingested.getField("seen")
    return headline.select(
        "raw_rows", "distinct_observations",
        F.coalesce(safe_percent(rows - seen, rows, 2), F.lit(0.0)).alias("duplicate_rate_pct"),
        "distinct_aircraft",
        built.getField("flights").alias("flights_reconstructed"),
        built.getField("complete").alias("complete_flights"),
        "latest_observation", "regions",
    )


def partition_stats(bronze: DataFrame) -> DataFrame:
    """Rows, distinct aircraft and duplicate rows of the given slice of bronze."""
    return (
        bronze.groupBy("icao24", "observed_at")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count_distinct("icao24").alias("distinct_aircraft"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        )
    )


def geojson_features(positions: DataFrame) -> DataFrame:
    """One GeoJSON point feature per aircraft; an unknown altitude stays null."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
        ).alias("geometry"),
        F.struct(
            "icao24",
            F.coalesce("callsign", F.lit("")).alias("callsign"),
            F.col("altitude_m").alias("altitude"),
            F.col("on_ground").alias("onGround"),
        ).alias("properties"),
    )
    return positions.select("icao24", F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def geojson_bounds(positions: DataFrame) -> DataFrame:
    return positions.agg(
        F.min("longitude").alias("west"), F.min("latitude").alias("south"),
        F.max("longitude").alias("east"), F.max("latitude").alias("north"),
    )
