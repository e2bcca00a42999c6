"""Sessions and the flight fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.functions.geo import haversine_km
from waypost.functions.scalar import flight_id, flight_phase, to_knots, to_minutes
from waypost.operators.nearest import nearest_within, pick_strategy
from waypost.operators.scans import sessionize
from waypost.params import (
    HIGH_QUALITY_GAP_SECONDS,
    MEDIUM_QUALITY_GAP_SECONDS,
    MEDIUM_QUALITY_OBSERVATIONS,
    Params,
)
from waypost.workspace import settle

SESSION_COLUMNS = [
    "flight_id", "icao24", "session_seq", "observed_at", "callsign", "origin_country",
    "latitude", "longitude", "altitude_m", "on_ground", "velocity", "vertical_rate",
    "true_track", "squawk", "region", "has_usable_position", "seconds_since_previous",
    "is_session_start", "flight_phase",
]


def flight_sessions(silver: DataFrame, params: Params = Params(), slice_col: str | None = None) -> DataFrame:
    """Every observation with the flight it belongs to.

    Gaps are measured over all positioned rows, stale ones included. ``silver`` is
    read twice; pass a written table. ``slice_col`` is as in ``sessionize``.
    """
    numbered = sessionize(
        silver,
        key=["icao24"],
        ts="observed_at",
        gap_s=params.session_gap_seconds,
        state_col="on_ground",
        from_state=True,
        to_state=False,
        boundary=params.boundary,
        chunk_s=params.chunk_seconds,
        slice_col=slice_col,
    )
    return numbered.withColumns(
        {
            "flight_id": flight_id(),
            "flight_phase": flight_phase(deadband=params.vertical_rate_deadband),
        }
    ).select(*SESSION_COLUMNS)


def _phase_count(phase: str) -> Column:
    return F.count_if(F.col("flight_phase") == phase)


def flight_summary(sessions: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per session, aggregated from its usable observations.

    Three steps, each shrinking the next: sums per session, callsign, region and
    country (fixed-width buffers, so hashed and combined on the map side), then
    per session and callsign, then per session, where the most frequent callsign
    wins and the smaller one breaks a tie. Grouping by ``icao24`` with the session
    number rather than by ``flight_id`` keeps string keys out of the hot path.
    """
    usable = sessions.where("has_usable_position")
    gap = F.col("seconds_since_previous")
    if params.gap_scope == "within_session":
        gap = F.when(F.col("is_session_start") == 0, gap)
    elif params.gap_scope != "observed":
        raise ValueError(f"unknown gap_scope {params.gap_scope!r}")

    session = ["icao24", "session_seq"]
    parts = usable.groupBy(*session, "callsign", "region", "origin_country").agg(
        F.min("observed_at").alias("departure_time"),
        F.max("observed_at").alias("arrival_time"),
        F.count(F.lit(1)).alias("observation_count"),
        F.max("altitude_m").alias("max_altitude_m"),
        F.sum("altitude_m").alias("sum_altitude"),
        F.count("altitude_m").alias("n_altitude"),
        F.max("velocity").alias("max_velocity_ms"),
        F.sum("velocity").alias("sum_velocity"),
        F.count("velocity").alias("n_velocity"),
        F.min_by("latitude", "observed_at").alias("first_latitude"),
        F.min_by("longitude", "observed_at").alias("first_longitude"),
        F.max_by("latitude", "observed_at").alias("last_latitude"),
        F.max_by("longitude", "observed_at").alias("last_longitude"),
        F.min_by("on_ground", "observed_at").alias("started_on_ground"),
        F.max_by("on_ground", "observed_at").alias("ended_on_ground"),
        _phase_count("climb").alias("climb_observations"),
        _phase_count("cruise").alias("cruise_observations"),
        _phase_count("descent").alias("descent_observations"),
        _phase_count("ground").alias("ground_observations"),
        F.max(gap).alias("max_gap_seconds"),
    )

    def merged(grouped, *extra: Column) -> DataFrame:
        first = [F.min_by(c, "departure_time").alias(c) for c in
                 ("first_latitude", "first_longitude", "started_on_ground")]
        last = [F.max_by(c, "arrival_time").alias(c) for c in
                ("last_latitude", "last_longitude", "ended_on_ground")]
        total = [F.sum(c).alias(c) for c in
                 ("observation_count", "sum_altitude", "n_altitude", "sum_velocity", "n_velocity",
                  "climb_observations", "cruise_observations", "descent_observations",
                  "ground_observations")]
        top = [F.max(c).alias(c) for c in
               ("arrival_time", "max_altitude_m", "max_velocity_ms", "max_gap_seconds")]
        return grouped.agg(
            *first, *last, *total, *top,
            F.min("departure_time").alias("departure_time"),
            F.min("origin_country").alias("origin_country"),
            *extra,
        )

    per_callsign = merged(
        parts.groupBy(*session, "callsign"), F.collect_set("region").alias("regions")
    )
    # Ordered by count, then by the smaller callsign; NULL never wins.
    votes = F.struct((-F.col("observation_count")).alias("n"), F.col("callsign").alias("callsign"))
    per_session = merged(
        per_callsign.groupBy(*session),
        F.min(F.when(F.col("callsign").isNotNull(), votes)).alias("vote"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("regions")))).alias("regions_seen"),
    )
    return per_session.select(
        flight_id().alias("flight_id"),
        *session,
        F.col("vote.callsign").alias("callsign"),
        "origin_country", "departure_time", "arrival_time",
        (F.unix_seconds("arrival_time") - F.unix_seconds("departure_time")).alias("duration_seconds"),
        "observation_count",
        "max_altitude_m",
        F.try_divide("sum_altitude", "n_altitude").alias("avg_altitude_m"),
        "max_velocity_ms",
        F.try_divide("sum_velocity", "n_velocity").alias("avg_velocity_ms"),
        "first_latitude", "first_longitude", "last_latitude", "last_longitude",
        "started_on_ground", "ended_on_ground",
        "climb_observations", "cruise_observations", "descent_observations",
        "ground_observations", "regions_seen", "max_gap_seconds",
    )


#: Which end of a flight is which airport.
ENDS = {"first": "departure", "last": "arrival"}


def _with_airports(matched: DataFrame, airports: DataFrame, params: Params) -> DataFrame:
    """Both ends of every flight through one shuffled lookup, joined back once."""
    key = ["icao24", "session_seq"]
    ends = matched.select(
        *key,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(take).alias("end"),
                        F.col(f"{end}_latitude").alias("latitude"),
                        F.col(f"{end}_longitude").alias("longitude"),
                    )
                    for end, take in ENDS.items()
                ]
            )
        ),
    )
    found = nearest_within(
        ends,
        airports,
        left_point=("latitude", "longitude"),
        right_point=("latitude", "longitude"),
        right_key="icao",
        take={"icao": "icao", "name": "name"},
        left_key=[*key, "end"],
        km=params.match_radius_km,
        strategy="shuffle",
    )
    taken = {"icao": "airport", "name": "airport_name"}
    both = found.groupBy(*key).agg(
        *[
            F.max(F.when(F.col("end") == take, F.col(c))).alias(f"{take}_{suffix}")
            for take in ENDS.values()
            for c, suffix in taken.items()
        ]
    )
    return matched.join(both, key, "left")


def flights(
    sessions: DataFrame,
    airports: DataFrame,
    params: Params = Params(),
    strategy: str = "auto",
) -> DataFrame:
    """The flight fact: sessions with enough observations, endpoints matched to airports."""
    if strategy == "auto":
        strategy = pick_strategy(airports)
    matched = flight_summary(sessions, params).where(
        F.col("observation_count") >= params.min_flight_observations
    )
    if strategy == "broadcast":
        # Nothing is shuffled, so the ends are looked up one after the other.
        for end, take in ENDS.items():
            matched = nearest_within(
                matched,
                airports,
                left_point=(f"{end}_latitude", f"{end}_longitude"),
                right_point=("latitude", "longitude"),
                right_key="icao",
                take={"icao": f"{take}_airport", "name": f"{take}_airport_name"},
                left_key=["icao24", "session_seq"],
                km=params.match_radius_km,
                strategy=strategy,
            )
    else:
        matched = _with_airports(settle(matched, "flight-summary"), airports, params)

    both_grounded = F.col("started_on_ground") & F.col("ended_on_ground")
    gap = F.col("max_gap_seconds")
    endpoint_km = haversine_km("first_latitude", "first_longitude", "last_latitude", "last_longitude")
    return matched.select(
        "flight_id", "icao24", "callsign", "origin_country",
        "departure_time", "arrival_time", "duration_seconds",
        to_minutes("duration_seconds").alias("duration_minutes"),
        "departure_airport", "departure_airport_name",
        "arrival_airport", "arrival_airport_name",
        "first_latitude", "first_longitude", "last_latitude", "last_longitude",
        F.round(endpoint_km, 1).alias("endpoint_distance_km"),
        F.round("max_altitude_m").alias("max_altitude_m"),
        F.round("avg_altitude_m").alias("avg_altitude_m"),
        to_knots("max_velocity_ms", params.knots_per_ms).alias("max_velocity_knots"),
        to_knots("avg_velocity_ms", params.knots_per_ms).alias("avg_velocity_knots"),
        "observation_count", "climb_observations", "cruise_observations",
        "descent_observations", "ground_observations", "max_gap_seconds", "regions_seen",
        "started_on_ground", "ended_on_ground",
        both_grounded.alias("is_complete"),
        F.when(both_grounded & (gap <= HIGH_QUALITY_GAP_SECONDS), "high")
        .when(
            (F.col("observation_count") >= MEDIUM_QUALITY_OBSERVATIONS)
            & (gap <= MEDIUM_QUALITY_GAP_SECONDS),
            "medium",
        )
        .otherwise("low")
        .alias("reconstruction_quality"),
    )
