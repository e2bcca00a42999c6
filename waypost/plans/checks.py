"""Data-quality checks. Each result row: check, passed, severity, violations, detail."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waypost.functions.scalar import safe_percent
from waypost.params import (
    FLIGHT_PHASES,
    FRESH_ERROR_SECONDS,
    FRESH_WARN_SECONDS,
    MIN_FLIGHT_OBSERVATIONS,
    QUALITY_LEVELS,
)

RESULT = ("check", "passed", "severity", "violations", "detail")


@dataclass(frozen=True)
class Check:
    """A rule over one table.

    ``kind``: ``not_null``, ``range`` (inclusive, either bound optional, NULL
    passes), ``values`` (NULL passes) or ``unique`` (NULL keys do not count).
    """

    table: str
    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    allowed: tuple = field(default=())
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.table}.{self.kind}.{'+'.join(self.columns)}"

    def violated(self) -> Column:
        col = F.col(self.columns[0])
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "range":
            below = F.lit(False) if self.low is None else col < self.low
            above = F.lit(False) if self.high is None else col > self.high
            return F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False))
        if self.kind == "values":
            return F.coalesce(~col.isin(*self.allowed), F.lit(False))
        raise ValueError(f"{self.kind} is not a row check")


def _nulls(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", (c,)) for c in columns]


#: The rules declared for the model tables.
MODEL_CHECKS = (
    *_nulls("bronze", "icao24", "observed_at"),
    Check("state_vectors", "unique", ("icao24", "observed_at")),
    *_nulls("state_vectors", "icao24", "observed_at", "latitude", "longitude", "has_usable_position"),
    Check("state_vectors", "range", ("latitude",), -90, 90),
    Check("state_vectors", "range", ("longitude",), -180, 180),
    Check("state_vectors", "range", ("source_row_count",), 1),
    *_nulls("flight_sessions", "flight_id", "icao24", "observed_at", "session_seq"),
    Check("flight_sessions", "range", ("session_seq",), 1),
    Check("flight_sessions", "values", ("flight_phase",), allowed=FLIGHT_PHASES),
    Check("flights", "unique", ("flight_id",)),
    *_nulls("flights", "flight_id", "icao24", "departure_time", "arrival_time", "is_complete"),
    Check("flights", "range", ("duration_seconds",), 0),
    Check("flights", "range", ("observation_count",), MIN_FLIGHT_OBSERVATIONS),
    Check("flights", "range", ("max_altitude_m",), -500, 25_000),
    Check("flights", "values", ("reconstruction_quality",), allowed=QUALITY_LEVELS),
    Check("hourly_traffic", "unique", ("traffic_hour", "region")),
    *_nulls("hourly_traffic", "traffic_hour", "region", "distinct_aircraft"),
    Check("hourly_traffic", "range", ("distinct_aircraft",), 0),
)


def _result(name, passed: Column, severity: Column | str, violations: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        passed.alias("passed"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        violations.cast("bigint").alias("violations"),
        detail.alias("detail"),
    )


def _row_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All row checks of one table in a single aggregate."""
    counted = df.agg(*[F.count_if(c.violated()).alias(f"v{i}") for i, c in enumerate(checks)])
    results = [
        _result(
            c.name, F.col(f"v{i}") == 0, c.severity, F.col(f"v{i}"),
            F.concat(F.col(f"v{i}").cast("string"), F.lit(" rows")),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*results)))


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    keys = df.dropna(subset=list(check.columns)).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("_copies"))
    repeated = keys.agg(F.count_if(F.col("_copies") > 1).alias("n"))
    return repeated.select(
        F.inline(
            F.array(
                _result(
                    check.name, F.col("n") == 0, check.severity, F.col("n"),
                    F.concat(F.col("n").cast("string"), F.lit(" repeated keys")),
                )
            )
        )
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = MODEL_CHECKS) -> DataFrame:
    """Evaluate the checks of the tables given: one pass per table, unique checks apart."""
    parts = []
    for table, df in tables.items():
        own = [c for c in checks if c.table == table]
        rows = [c for c in own if c.kind != "unique"]
        if rows:
            parts.append(_row_checks(df, rows))
        parts += [_unique_check(df, c) for c in own if c.kind == "unique"]
    if not parts:
        raise ValueError("no check applies to the tables given")
    return reduce(DataFrame.unionByName, parts)


def check_fresh(
    bronze: DataFrame,
    as_of: dt.datetime | None = None,
    warn_s: int = FRESH_WARN_SECONDS,
    error_s: int = FRESH_ERROR_SECONDS,
) -> DataFrame:
    """Age of the newest ingested row; an empty table fails as a warning."""
    now = F.unix_seconds(F.lit(as_of) if as_of is not None else F.current_timestamp())
    aged = bronze.agg((now - F.unix_seconds(F.max("ingested_at"))).alias("age"))
    stale = F.coalesce(F.col("age") > warn_s, F.lit(True))
    return aged.select(
        F.inline(
            F.array(
                _result(
                    "bronze.fresh",
                    ~stale,
                    F.when(F.col("age") > error_s, "error").otherwise("warn"),
                    stale.cast("int"),
                    F.coalesce(
                        F.concat(F.col("age").cast("string"), F.lit(" s old")), F.lit("table is empty")
                    ),
                )
            )
        )
    )


def check_plausible(flights: DataFrame) -> DataFrame:
    """Counts of flights that no real flight can look like; blocking."""
    rules = {
        "negative_duration": F.col("duration_seconds") < 0,
        "cruise_altitude_without_speed": (F.col("max_altitude_m") > 8000)
        & (F.col("max_velocity_knots") < 50),
        "below_minimum_observations": F.col("observation_count") < MIN_FLIGHT_OBSERVATIONS,
        "arrival_before_departure": F.col("arrival_time") < F.col("departure_time"),
    }
    counted = flights.agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(rule).alias(n) for n, rule in rules.items()]
    )
    detail = F.concat(F.col("checked").cast("string"), F.lit(" flights checked"))
    return counted.select(
        F.inline(
            F.array(
                *[_result(f"flights.{n}", F.col(n) == 0, "error", F.col(n), detail) for n in rules]
            )
        )
    )


def check_dedup(silver: DataFrame) -> DataFrame:
    """Raw rows against observations. A rate of exactly zero passes but is suspicious."""
    counted = silver.agg(F.sum("source_row_count").alias("raw"), F.count(F.lit(1)).alias("kept"))
    rate = safe_percent(F.col("raw") - F.col("kept"), "raw", 2)
    checked = counted.withColumns(
        {"ok": F.coalesce(F.col("kept") <= F.col("raw"), F.lit(False)), "rate": rate}
    )
    return checked.select(
        F.inline(
            F.array(
                _result(
                    "state_vectors.deduplicated", F.col("ok"), "warn", (~F.col("ok")).cast("int"),
                    F.coalesce(
                        F.concat(
                            F.col("raw").cast("string"), F.lit(" raw rows, "),
                            F.col("kept").cast("string"), F.lit(" observations"),
                        ),
                        F.lit("no rows"),
                    ),
                )
            )
        ),
        F.col("rate").alias("duplicate_rate_pct"),
        F.coalesce(F.col("rate") == 0, F.lit(False)).alias("suspicious_zero"),
    )


def check_moved(metrics: DataFrame) -> DataFrame:
    """A bounded run that wrote nothing has failed."""
    written = metrics.agg(F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows"))
    return written.select(
        F.inline(
            F.array(
                _result(
                    "ingest.moved", F.col("rows") > 0, "error", (F.col("rows") == 0).cast("int"),
                    F.concat(F.col("rows").cast("string"), F.lit(" rows written")),
                )
            )
        )
    )
