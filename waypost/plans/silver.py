"""Silver: one row per observation, cleaned."""

from __future__ import annotations

from pyspark.sql import DataFrame

from waypost.functions.scalar import best_altitude, has_position, usable_position
from waypost.operators.dedup import dedup_latest
from waypost.params import Params


def state_vectors(bronze: DataFrame, params: Params = Params(), slice_col: str | None = None) -> DataFrame:
    """Latest copy of each ``(icao24, observed_at)`` that has a position.

    Stale fixes stay, flagged by ``has_usable_position``: they still show that the
    aircraft was in contact. ``slice_col`` is a column that follows from the time, such
    as ``time_slice`` of a bucketed table; with it in the key nothing is shuffled there.
    """
    latest = dedup_latest(
        bronze,
        keys=["icao24", *([slice_col] if slice_col else []), "observed_at"],
        version="ingested_at",
        tie_breakers=["poll_time", "last_contact"],
        null_policy=params.null_policy,
    )
    return positioned(latest, params)


def positioned(latest: DataFrame, params: Params = Params()) -> DataFrame:
    """The rows of deduplicated copies that have a position, with what silver adds."""
    return latest.where(has_position()).withColumns(
        {
            "has_usable_position": usable_position(max_age_seconds=params.usable_fix_age_seconds),
            "altitude_m": best_altitude(),
        }
    )
