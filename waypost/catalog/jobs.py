"""Model jobs, serving queries and data-quality checks over the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from waypost import schemas
from waypost.catalog import standin as S
from waypost.catalog.records import _BRONZE_LIST, DAY, LATEST_SQL, rec_sql
from waypost.catalog.registry import query
from waypost.catalog.relational import (
    _SILVER_LIST,
    _TRAFFIC,
    _WINDOW_COLUMNS,
    DUP_SQL,
    _NULL_SQL,
    session_sql,
    silver_sql,
)
from waypost.operators.validation import validate
from waypost.plans import checks as C
from waypost.plans import profile as profiles
from waypost.plans import serving as Q
from waypost.plans.flights import SESSION_COLUMNS, flight_sessions, flights
from waypost.plans.partials import add_partials, hour_stats, observation_partials, read_partials
from waypost.plans.regions import region_yield
from waypost.plans.silver import state_vectors
from waypost.sinks.buckets import SLICE, write_bucketed
from waypost.sinks.tables import ingest_metrics, write_bronze
from waypost.sources.polls import decode_vectors
from waypost.sources.tables import read_bronze
from waypost.workspace import fresh_path, settle

VEC, REC, SILVER = S.VEC_SQL, S.REC_SQL, S.SILVER_SQL
ROUND_TRIP = replace(S.DAY_GAP, boundary="last_ground_row", gap_scope="within_session")


@query("q_state_vectors", silver_sql(f"SELECT {_SILVER_LIST} FROM silver"))
def q_state_vectors(spark, sf):
    return S.silver(spark, sf)


@query("q_flight_sessions", session_sql(f"SELECT {', '.join(SESSION_COLUMNS)} FROM sess"))
def q_flight_sessions(spark, sf):
    return S.sessions(spark, sf)


@query("q_flights", session_sql("SELECT * FROM flights", S.flights_sql()))
def q_flights(spark, sf):
    return S.flight_fact(spark, sf)


@query(
    "q_flights_from_ground",
    silver_sql(
        "SELECT * FROM flights",
        S.sessions_sql(86_400, "last_ground_row"), S.flights_sql("within_session"),
    ),
)
def q_flights_from_ground(spark, sf):
    return S.flight_fact(spark, sf, ROUND_TRIP)


@query("q_hourly_traffic", silver_sql("SELECT * FROM traffic", _TRAFFIC))
def q_hourly_traffic(spark, sf):
    return S.traffic(spark, sf)


@query(
    "q_live",
    S.with_sql(
        """SELECT icao24, callsign, origin_country, latitude, longitude, altitude_m,
             round(velocity * 1.94384e0) AS velocity_knots, true_track, on_ground, observed_at,
             position_age_seconds FROM latest ORDER BY observed_at DESC, icao24 LIMIT 2000""",
        VEC, REC, SILVER, LATEST_SQL,
    ),
)
def q_live(spark, sf):
    return Q.live(S.silver(spark, sf), S.AS_OF, max_age_s=DAY)


_LISTED = """flight_id, icao24, callsign, departure_time, arrival_time, duration_minutes,
  departure_airport, arrival_airport, max_altitude_m, max_velocity_knots, endpoint_distance_km,
  observation_count, is_complete, reconstruction_quality"""


@query(
    "q_flight_list",
    silver_sql(
        f"""SELECT {_LISTED} FROM flights WHERE reconstruction_quality IN ('low', 'medium', 'high')
            AND is_complete ORDER BY departure_time DESC, flight_id LIMIT 1000""",
        S.sessions_sql(86_400, "last_ground_row"), S.flights_sql("within_session"),
    ),
)
def q_flight_list(spark, sf):
    return Q.flight_list(S.flight_fact(spark, sf, ROUND_TRIP), 1000, "low", complete_only=True)


@query(
    "q_track",
    session_sql(
        """SELECT observed_at, latitude, longitude, altitude_m,
             round(velocity * 1.94384e0) AS velocity_knots, vertical_rate, flight_phase,
             seconds_since_previous FROM sess WHERE has_usable_position AND flight_id = (
               SELECT flight_id FROM summary ORDER BY observation_count DESC, flight_id LIMIT 1)""",
        S.flights_sql(),
    ),
)
def q_track(spark, sf):
    """The track of the best observed flight."""
    rows = settle(S.sessions(spark, sf), "sessions")
    counted = rows.where("has_usable_position").groupBy("flight_id").agg(F.count(F.lit(1)).alias("n"))
    longest = counted.orderBy(F.desc("n"), "flight_id").first()
    return Q.track(rows, longest.flight_id)


@query(
    "q_traffic_window",
    silver_sql(
        f"SELECT {_WINDOW_COLUMNS} FROM traffic WHERE traffic_hour >= {S.AS_OF_EPOCH - 48 * 3600}", _TRAFFIC
    ),
)
def q_traffic_window(spark, sf):
    return Q.traffic_window(S.traffic(spark, sf), S.AS_OF)


def _bucketed_bronze(spark, sf):
    """Stand-in bronze as a bucketed table, and a name for further ones."""
    slot = f"waypost_{uuid.uuid4().hex}"
    return write_bucketed(S.bronze(spark, sf), f"{slot}_bronze", fresh_path(spark, "bronze-buckets")), slot


def settle_bucketed(silver, slot):
    return write_bucketed(silver, f"{slot}_silver", fresh_path(silver.sparkSession, "silver-buckets"))


@query("snk_bronze_buckets", rec_sql("SELECT *, CAST(observed_at // 86400 AS BIGINT) AS time_slice FROM "
                                     f"(SELECT {_BRONZE_LIST} FROM rec)"))
def snk_bronze_buckets(spark, sf):
    return _bucketed_bronze(spark, sf)[0].select(*schemas.BRONZE_COLUMNS, SLICE)


@query("q_flight_sessions_bucketed", session_sql(f"SELECT {', '.join(SESSION_COLUMNS)} FROM sess"))
def q_flight_sessions_bucketed(spark, sf):
    """The same sessions over bucketed bronze and silver: after the first write only summaries are shuffled."""
    bronze, slot = _bucketed_bronze(spark, sf)
    silver = settle_bucketed(state_vectors(bronze, slice_col=SLICE), slot)
    return flight_sessions(silver, S.DAY_GAP, SLICE)


@query(
    "q_hour_stats",
    rec_sql(
        """SELECT observed_at // 3600 * 3600 AS hour, count(*) AS rows, count(DISTINCT icao24) AS distinct_aircraft,
             count(*) - count(DISTINCT icao24 || '@' || observed_at) AS duplicate_rows FROM rec GROUP BY 1"""
    ),
)
def q_hour_stats(spark, sf):
    """Every hour's statistics, from partial counts of two halves of bronze, whose copies overlap."""
    bronze = S.bronze(spark, sf)
    late = F.unix_seconds("ingested_at") - F.unix_seconds("poll_time") == 60
    path = fresh_path(spark, "partials")
    add_partials(bronze.where(late), path, 0)
    add_partials(bronze.where(~late), path, 1)
    return hour_stats(read_partials(spark, path))


@query(
    "q_stats",
    session_sql(
        f"""SELECT count(*) AS raw_rows, count(DISTINCT icao24 || '@' || observed_at) AS distinct_observations,
              (SELECT round((count(*) - count(DISTINCT icao24 || '@' || observed_at)) * 100e0 / count(*), 2)
               FROM rec WHERE {S.REASON_SQL} IS NULL) AS duplicate_rate_pct,
              count(DISTINCT icao24) AS distinct_aircraft,
              (SELECT count(*) FROM flights) AS flights_reconstructed,
              (SELECT count(*) FROM flights WHERE is_complete) AS complete_flights,
              max(observed_at) AS latest_observation,
              string_agg(DISTINCT region, ',' ORDER BY region) AS regions FROM rec""",
        S.flights_sql(),
    ),
)
def q_stats(spark, sf):
    """From bronze written once, its partial counts, and flights by way of bucketed tables."""
    bronze, slot = _bucketed_bronze(spark, sf)
    batches = settle(ingest_metrics(validate(S.messages(spark, sf))), "metrics")
    silver = settle_bucketed(state_vectors(bronze, slice_col=SLICE), slot)
    fact = flights(flight_sessions(silver, S.DAY_GAP, SLICE), S.airports(spark, sf), S.DAY_GAP)
    return Q.stats_from_partials(settle(observation_partials(bronze), "partials"), batches, fact)


HOUR = (dt.datetime(2024, 1, 10, 12), dt.datetime(2024, 1, 10, 13))
_FROM, _TO = (int(t.replace(tzinfo=dt.timezone.utc).timestamp()) for t in HOUR)


@query(
    "q_partition_stats",
    rec_sql(
        f"""SELECT count(*) AS rows, count(DISTINCT icao24) AS distinct_aircraft,
              count(*) - count(DISTINCT icao24 || '@' || observed_at) AS duplicate_rows
            FROM rec WHERE observed_at >= {_FROM} AND observed_at < {_TO}"""
    ),
)
def q_partition_stats(spark, sf):
    """One hour of written bronze: the bounds prune all other folders."""
    path = fresh_path(spark, "bronze")
    write_bronze(S.bronze(spark, sf), path)
    return Q.partition_stats(read_bronze(spark, path, *HOUR))


_AGES = "SELECT last_contact - time_position AS age FROM vec WHERE time_position IS NOT NULL"


@query(
    "q_profile",
    S.with_sql(
        f"""SELECT metric, CAST(value AS DOUBLE) AS value FROM (
            SELECT 'polls' AS metric, count(DISTINCT file) AS value FROM vec
            UNION ALL SELECT 'mean_interval_s',
              (arg_max(poll_time, file) - arg_min(poll_time, file)) / (count(DISTINCT file) - 1) FROM vec
            UNION ALL SELECT 'vectors_with_fields_18', count(*) FROM vec
            UNION ALL SELECT 'rows_' || population, rows FROM dups
            UNION ALL SELECT 'duplicates_' || population, duplicates FROM dups
            UNION ALL SELECT 'duplicate_pct_' || population, duplicate_pct FROM dups
            UNION ALL SELECT 'staleness_p50', list_sort(list(age))[least(
                count(*) * 50 // 100, count(*) - 1) + 1] FROM ({_AGES})
            UNION ALL SELECT 'staleness_p90', list_sort(list(age))[least(
                count(*) * 90 // 100, count(*) - 1) + 1] FROM ({_AGES})
            UNION ALL SELECT 'staleness_p99', list_sort(list(age))[least(
                count(*) * 99 // 100, count(*) - 1) + 1] FROM ({_AGES})
            UNION ALL SELECT 'staleness_max', max(age) FROM ({_AGES})
            UNION ALL SELECT 'staleness_over_10s_pct',
              count(*) FILTER (WHERE age > 10) * 100e0 / count(*) FROM ({_AGES})
            UNION ALL SELECT 'null_pct_' || field, null_pct FROM ({_NULL_SQL}))""",
        VEC, DUP_SQL,
    ),
)
def q_profile(spark, sf):
    polls = S.polls(spark, sf)
    vectors, _ = decode_vectors(polls)
    return profiles.profile(S.envelopes(spark, sf), polls, vectors)


@query(
    "q_region_yield",
    S.with_sql(
        """SELECT region, polls, cost, round(smooth, 6) AS "yield",
             round(smooth / cost, 6) AS yield_per_credit, worst_gap_s, breaches
           FROM (SELECT region, count(*) AS polls, max(gap) AS worst_gap_s,
                   count(*) FILTER (WHERE gap > 600) AS breaches,
                   list_reduce(list(CAST(vectors AS DOUBLE) ORDER BY poll_time),
                     lambda a, x: 0.3e0 * x + 0.7e0 * a) AS smooth
                 FROM (SELECT *, poll_time - lag(poll_time) OVER (PARTITION BY region ORDER BY poll_time)
                         AS gap FROM polls) GROUP BY region) JOIN costs USING (region)""",
        VEC, REC, S.POLLS_SQL, S.REGION_COST_SQL,
    ),
)
def q_region_yield(spark, sf):
    yields = region_yield(S.region_polls(spark, sf), S.region_table(spark, sf))
    return yields.withColumns(
        {c: F.round(c, 6) for c in ("yield", "yield_per_credit")}
    )


# Checks --------------------------------------------------------------------------


def _check_sql(rows: list[tuple[str, str, str]], *ctes: str, unit: str = "rows") -> str:
    """Oracle of plain checks: (name, FROM clause, condition of a violation)."""
    body = " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) AS violations FROM {source} WHERE {bad}"
        for name, source, bad in rows
    )
    return S.with_sql(
        f"""SELECT "check", violations = 0 AS passed, 'error' AS severity, violations,
            violations || ' {unit}' AS detail FROM ({body})""",
        *ctes,
    )


_SILVER_CTES = (VEC, REC, SILVER)
_FLIGHT_CTES = (*_SILVER_CTES, S.sessions_sql(), S.flights_sql())


def _kind(kind: str, *tables: str) -> list[C.Check]:
    return [c for c in C.MODEL_CHECKS if c.kind == kind and c.table in tables]


@query(
    "chk_not_null",
    _check_sql(
        [
            *[(f"bronze.not_null.{c}", "rec", f"{c} IS NULL") for c in ("icao24", "observed_at")],
            *[
                (f"state_vectors.not_null.{c}", "silver", f"{c} IS NULL")
                for c in ("icao24", "observed_at", "latitude", "longitude", "has_usable_position")
            ],
            ("lineitem.not_null.l_shipdate", "lineitem", "l_shipdate IS NULL"),
            ("vectors.not_null.latitude", "vec", "latitude IS NULL"),
        ],
        *_SILVER_CTES,
    ),
)
def chk_not_null(spark, sf):
    tables = {
        "bronze": S.bronze(spark, sf),
        "state_vectors": S.silver(spark, sf),
        "lineitem": S.table(spark, sf, "lineitem"),
        "vectors": S.vectors(spark, sf),
    }
    own = [
        C.Check("lineitem", "not_null", ("l_shipdate",)),
        C.Check("vectors", "not_null", ("latitude",)),
    ]
    return C.run_checks(tables, [*_kind("not_null", "bronze", "state_vectors"), *own])


def _repeated(source: str, keys: str) -> str:
    return f"(SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"


@query(
    "chk_unique",
    _check_sql(
        [
            ("state_vectors.unique.icao24+observed_at", _repeated("silver", "icao24, observed_at"), "true"),
            (
                "lineitem.unique.l_orderkey+l_linenumber",
                _repeated("lineitem", "l_orderkey, l_linenumber"), "true",
            ),
            (
                "lineitem.unique.l_partkey+l_suppkey",
                _repeated("lineitem", "l_partkey, l_suppkey"), "true",
            ),
        ],
        *_SILVER_CTES,
        unit="repeated keys",
    ),
)
def chk_unique(spark, sf):
    tables = {"state_vectors": S.silver(spark, sf), "lineitem": S.table(spark, sf, "lineitem")}
    own = [
        C.Check("lineitem", "unique", ("l_orderkey", "l_linenumber")),
        C.Check("lineitem", "unique", ("l_partkey", "l_suppkey")),
    ]
    return C.run_checks(tables, [*_kind("unique", "state_vectors"), *own])


@query(
    "chk_range",
    _check_sql(
        [
            ("flights.range.duration_seconds", "flights", "duration_seconds < 0"),
            ("flights.range.observation_count", "flights", "observation_count < 3"),
            ("flights.range.max_altitude_m", "flights", "max_altitude_m < -500 OR max_altitude_m > 25000"),
            ("lineitem.range.l_quantity", "lineitem", "l_quantity < 2 OR l_quantity > 49"),
            ("customer.range.c_acctbal", "customer", "c_acctbal < 0"),
        ],
        *_FLIGHT_CTES,
    ),
)
def chk_range(spark, sf):
    tables = {
        "flights": S.flight_fact(spark, sf),
        "lineitem": S.table(spark, sf, "lineitem"),
        "customer": S.table(spark, sf, "customer"),
    }
    own = [
        C.Check("lineitem", "range", ("l_quantity",), 2, 49),
        C.Check("customer", "range", ("c_acctbal",), 0),
    ]
    return C.run_checks(tables, [*_kind("range", "flights"), *own])


@query(
    "chk_values",
    _check_sql(
        [
            (
                "flight_sessions.values.flight_phase", "sess",
                "flight_phase NOT IN ('ground', 'climb', 'cruise', 'descent', 'unknown')",
            ),
            ("orders.values.o_orderstatus", "orders", "o_orderstatus NOT IN ('F', 'O')"),
        ],
        *_SILVER_CTES, S.sessions_sql(),
    ),
)
def chk_values(spark, sf):
    tables = {"flight_sessions": S.sessions(spark, sf), "orders": S.table(spark, sf, "orders")}
    own = [C.Check("orders", "values", ("o_orderstatus",), allowed=("F", "O"))]
    return C.run_checks(tables, [*_kind("values", "flight_sessions"), *own])


@query(
    "chk_fresh",
    rec_sql(
        f"""SELECT 'bronze.fresh' AS "check", age <= 1800 AS passed,
              CASE WHEN age > 7200 THEN 'error' ELSE 'warn' END AS severity,
              CAST(age > 1800 AS BIGINT) AS violations, age || ' s old' AS detail
            FROM (SELECT {S.AS_OF_EPOCH + 6000} - max(ingested_at) AS age FROM rec)"""
    ),
)
def chk_fresh(spark, sf):
    return C.check_fresh(S.bronze(spark, sf), S.AS_OF + dt.timedelta(seconds=6000))


@query(
    "chk_plausible",
    session_sql(
        " UNION ALL ".join(
            f"""SELECT 'flights.{name}' AS "check", count(*) FILTER (WHERE {bad}) = 0 AS passed,
                'error' AS severity, count(*) FILTER (WHERE {bad}) AS violations,
                count(*) || ' flights checked' AS detail FROM flights"""
            for name, bad in (
                ("negative_duration", "duration_seconds < 0"),
                ("cruise_altitude_without_speed", "max_altitude_m > 8000 AND max_velocity_knots < 50"),
                ("below_minimum_observations", "observation_count < 3"),
                ("arrival_before_departure", "arrival_time < departure_time"),
            )
        ),
        S.flights_sql(),
    ),
)
def chk_plausible(spark, sf):
    return C.check_plausible(S.flight_fact(spark, sf))


@query(
    "chk_dedup",
    silver_sql(
        """SELECT 'state_vectors.deduplicated' AS "check", kept <= raw AS passed, 'warn' AS severity,
             CAST(kept > raw AS BIGINT) AS violations,
             raw || ' raw rows, ' || kept || ' observations' AS detail,
             (20000 * (raw - kept) + raw) // (2 * raw) / 100e0 AS duplicate_rate_pct,
             raw = kept AS suspicious_zero
           FROM (SELECT CAST(sum(source_row_count) AS BIGINT) AS raw, count(*) AS kept FROM silver)"""
    ),
)
def chk_dedup(spark, sf):
    return C.check_dedup(S.silver(spark, sf))


@query(
    "chk_moved",
    rec_sql(
        f"""SELECT 'ingest.moved' AS "check", count(*) > 0 AS passed, 'error' AS severity,
              CAST(count(*) = 0 AS BIGINT) AS violations, count(*) || ' rows written' AS detail
            FROM rec WHERE {S.REASON_SQL} IS NULL"""
    ),
)
def chk_moved(spark, sf):
    return C.check_moved(ingest_metrics(validate(S.messages(spark, sf))))


