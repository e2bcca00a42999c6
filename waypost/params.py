"""Tunable rules of the telemetry model, with the published defaults."""

from __future__ import annotations

from dataclasses import dataclass

# These defaults define the results and must not drift.
SESSION_GAP_SECONDS = 30 * 60
MATCH_RADIUS_KM = 8.0
USABLE_FIX_AGE_SECONDS = 60
VERTICAL_RATE_DEADBAND = 1.5
KNOTS_PER_MS = 1.94384
MIN_FLIGHT_OBSERVATIONS = 3
HIGH_QUALITY_GAP_SECONDS = 300
MEDIUM_QUALITY_GAP_SECONDS = 900
MEDIUM_QUALITY_OBSERVATIONS = 10
MIN_EPOCH = 946_684_800
MAX_EPOCH = 4_102_444_800
MAX_INVALID_RATIO = 0.05
RATIO_GUARD_MIN_MESSAGES = 100
BATCH_ROWS = 5000
BATCH_SECONDS = 30
BRONZE_RETENTION_DAYS = 30
METRICS_RETENTION_DAYS = 90
FRESH_WARN_SECONDS = 30 * 60
FRESH_ERROR_SECONDS = 2 * 60 * 60
EWMA_ALPHA = 0.3
STALENESS_CEILING_SECONDS = 10 * 60
EARTH_RADIUS_KM = 6371.0088
DAILY_QUOTAS = {"anonymous": 400, "registered": 4000, "feeder": 8000}
# (largest area in square degrees, credits); anything larger costs GLOBAL_COST.
AREA_TIERS = ((25.0, 1), (100.0, 2), (400.0, 3))
GLOBAL_COST = 4
GLOBAL_AREA = 360.0 * 180.0
# (name, lat_min, lon_min, lat_max, lon_max)
DEFAULT_REGIONS = (
    ("benelux", 50.0, 3.0, 53.5, 7.5),
    ("london", 50.5, -1.5, 52.5, 1.5),
    ("paris", 48.0, 1.5, 49.5, 3.5),
    ("rhine-alps", 47.5, 7.5, 51.0, 12.5),
    ("swiss-alps", 45.5, 6.0, 47.5, 11.0),
    ("iberia", 36.0, -10.0, 44.0, 3.0),
    ("nordics", 55.0, 8.0, 66.0, 26.0),
)
QUALITY_LEVELS = ("low", "medium", "high")
FLIGHT_PHASES = ("ground", "climb", "cruise", "descent", "unknown")


@dataclass(frozen=True)
class Params:
    """Knobs of the model jobs.

    ``boundary``: ``takeoff_row`` opens a session on the first airborne row after
    a ground row; ``last_ground_row`` opens it one row earlier, so that a flown
    flight keeps its ground start and can count as complete.

    ``gap_scope``: ``observed`` lets a flight's longest gap include the gap that
    precedes its first row; ``within_session`` leaves that one out.

    ``null_policy``: ``row`` keeps the latest copy whole; ``column`` keeps the
    latest non-null value of each column.

    ``chunk_seconds``: length of the time slices that split one entity's history
    over several tasks.
    """

    session_gap_seconds: int = SESSION_GAP_SECONDS
    match_radius_km: float = MATCH_RADIUS_KM
    usable_fix_age_seconds: int = USABLE_FIX_AGE_SECONDS
    vertical_rate_deadband: float = VERTICAL_RATE_DEADBAND
    knots_per_ms: float = KNOTS_PER_MS
    min_flight_observations: int = MIN_FLIGHT_OBSERVATIONS
    boundary: str = "takeoff_row"
    gap_scope: str = "observed"
    null_policy: str = "row"
    chunk_seconds: int = 86_400
