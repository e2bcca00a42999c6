"""Small hand-written frames in the shape of bronze and silver."""

from __future__ import annotations

import datetime as dt

from waypost import schemas

T0 = 1_704_067_200  # 2024-01-01T00:00:00Z


def at(seconds: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(T0 + seconds, dt.timezone.utc)


BASE = {
    "icao24": "abc123", "observed_at": at(0), "callsign": "AB1", "origin_country": "X",
    "time_position": at(0), "last_contact": at(0), "longitude": 4.0, "latitude": 50.0,
    "baro_altitude": None, "on_ground": False, "velocity": 10.0, "true_track": 0.0,
    "vertical_rate": 0.0, "geo_altitude": 100.0, "squawk": None, "spi": False,
    "position_source": 0, "category": None, "region": "r1", "poll_time": at(0),
    "ingested_at": at(0), "position_age_seconds": 0,
}


def bronze(spark, *rows: dict):
    full = []
    for row in rows:
        row = dict(row)
        if "t" in row:
            moment = at(row.pop("t"))
            row = {"observed_at": moment, "time_position": moment, "last_contact": moment, **row}
        full.append(tuple({**BASE, **row}[c] for c in schemas.BRONZE_COLUMNS))
    return spark.createDataFrame(full, schemas.BRONZE)
