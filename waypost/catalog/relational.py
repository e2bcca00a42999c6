"""Joins, aggregations, windows and ordering over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from waypost import schemas
from waypost.catalog import standin as S
from waypost.catalog.records import rec_sql, vec_sql
from waypost.catalog.registry import query
from waypost.operators.boxes import bbox_cost, tag_regions
from waypost.operators.dedup import dedup_latest, latest_per_key
from waypost.operators.nearest import nearest_k, nearest_within
from waypost.operators.ranks import percentile_by_index
from waypost.operators.scans import ewma, sessionize
from waypost.plans import profile as profiles
from waypost.plans.flights import flight_summary
from waypost.plans.regions import poll_gaps, quota_ledger
from waypost.plans.serving import flight_list, track_points, traffic_window
from waypost.workspace import settle

VEC, REC, SILVER = S.VEC_SQL, S.REC_SQL, S.SILVER_SQL
_SILVER_LIST = ", ".join(
    [*schemas.BRONZE_COLUMNS, "source_row_count", "has_usable_position", "altitude_m"]
)


def silver_sql(body: str, *more: str) -> str:
    return S.with_sql(body, VEC, REC, SILVER, *more)


def session_sql(body: str, *more: str) -> str:
    return silver_sql(body, S.sessions_sql(), *more)


# Joins ---------------------------------------------------------------------------

_KM = S.haversine_sql("p.latitude", "p.longitude", "f.latitude", "f.longitude")
_NEAREST_SQL = S.with_sql(
    f"""SELECT p.event_id, p.pos, m.icao, m.name, m.km
        FROM vec p LEFT JOIN (
          SELECT event_id, pos, icao, name, km FROM (
            SELECT p.event_id, p.pos, f.icao, f.name, round({_KM}, 6) AS km, row_number() OVER (
              PARTITION BY p.event_id, p.pos ORDER BY round({_KM}, 6), f.icao) AS rn
            FROM vec p JOIN fields f ON round({_KM}, 6) <= 8) WHERE rn = 1) m
        ON m.event_id = p.event_id AND m.pos = p.pos""",
    VEC, S.AIRPORT_SQL,
)


def _nearest(spark, sf, strategy):
    return nearest_within(
        S.vectors(spark, sf).select("event_id", "pos", "latitude", "longitude"),
        S.airports(spark, sf),
        ("latitude", "longitude"),
        ("latitude", "longitude"),
        right_key="icao",
        take={"icao": "icao", "name": "name"},
        left_key=["event_id", "pos"],
        distance="km",
        strategy=strategy,
    ).select("event_id", "pos", "icao", "name", "km")


@query("join_nearest_radius", _NEAREST_SQL)
def join_nearest_radius(spark, sf):
    return _nearest(spark, sf, "auto")


@query("join_nearest_shuffled", _NEAREST_SQL)
def join_nearest_shuffled(spark, sf):
    return _nearest(spark, sf, "shuffle")


def _nearest_k_sql(k: int, within: str) -> str:
    return S.with_sql(
        f"""SELECT event_id, pos, icao, km, rank FROM (
              SELECT p.event_id, p.pos, f.icao, round({_KM}, 6) AS km, row_number() OVER (
                PARTITION BY p.event_id, p.pos ORDER BY round({_KM}, 6), f.icao) AS rank
              FROM vec p JOIN fields f ON {within}) WHERE rank <= {k}""",
        VEC, S.AIRPORT_SQL,
    )


def _nearest_k(spark, sf, k, km):
    return nearest_k(
        S.vectors(spark, sf).select("event_id", "pos", "latitude", "longitude"),
        S.airports(spark, sf),
        ("latitude", "longitude"),
        ("latitude", "longitude"),
        right_key="icao",
        take={"icao": "icao"},
        left_key=["event_id", "pos"],
        k=k,
        km=km,
    )


@query("join_nearest_three", _nearest_k_sql(3, f"round({_KM}, 6) <= 60"))
def join_nearest_three(spark, sf):
    return _nearest_k(spark, sf, 3, 60.0)


@query("join_nearest_any_distance", _nearest_k_sql(2, "p.latitude IS NOT NULL AND p.longitude IS NOT NULL"))
def join_nearest_any_distance(spark, sf):
    return _nearest_k(spark, sf, 2, None)


@query(
    "join_left_enrich",
    session_sql(
        """SELECT flight_id, departure_airport, departure_airport_name, arrival_airport,
             arrival_airport_name FROM flights""",
        S.flights_sql(),
    ),
)
def join_left_enrich(spark, sf):
    """The fact keeps flights whose ends match no airport."""
    return S.flight_fact(spark, sf, strategy="shuffle").select(
        "flight_id", "departure_airport", "departure_airport_name", "arrival_airport", "arrival_airport_name"
    )


@query(
    "join_left_customer",
    """SELECT c_custkey AS custkey, n_name AS nation, o.orders, o.spent_cents
       FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN (SELECT o_custkey, count(*) AS orders,
                    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS spent_cents
                  FROM orders GROUP BY 1) o ON o.o_custkey = c_custkey""",
)
def join_left_customer(spark, sf):
    orders = S.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("spent_cents"),
    )
    nations = S.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    return (
        S.table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(F.col("c_custkey").alias("custkey"), "nation", "orders", "spent_cents")
    )


_BOX_JOIN_SQL = S.with_sql(
    """SELECT v.event_id, v.pos, b.name AS region FROM vec v JOIN boxes b
       ON v.latitude IS NULL OR v.longitude IS NULL
         OR (b.lat_min = 0 AND b.lon_min = 0 AND b.lat_max = 0 AND b.lon_max = 0)
         OR (v.latitude BETWEEN b.lat_min AND b.lat_max
             AND v.longitude BETWEEN b.lon_min AND b.lon_max)""",
    VEC, S.BOX_SQL,
)


def _regions(spark, sf, strategy):
    return tag_regions(
        S.vectors(spark, sf).select("event_id", "pos", "latitude", "longitude"),
        S.region_boxes(spark, sf),
        strategy=strategy,
    ).select("event_id", "pos", "region")


@query("join_region_box", _BOX_JOIN_SQL)
def join_region_box(spark, sf):
    return _regions(spark, sf, "auto")


@query("join_region_shuffled", _BOX_JOIN_SQL)
def join_region_shuffled(spark, sf):
    return _regions(spark, sf, "shuffle")


# Aggregations ----------------------------------------------------------------------

_KEEP = ", ".join([*schemas.BRONZE_COLUMNS, "source_row_count"])


@query("dedup_latest", silver_sql(f"SELECT {_KEEP} FROM ranked WHERE rn = 1"))
def dedup_latest_query(spark, sf):
    return dedup_latest(
        S.bronze(spark, sf), ["icao24", "observed_at"], "ingested_at", ["poll_time", "last_contact"]
    )


_COLUMN_WISE = ", ".join(
    f"first({c} ORDER BY {S._RANK_SQL}) FILTER (WHERE {c} IS NOT NULL) AS {c}"
    for c in schemas.BRONZE_COLUMNS[2:]
)


@query(
    "dedup_latest_column",
    rec_sql(
        f"""SELECT icao24, observed_at, {_COLUMN_WISE}, count(*) AS source_row_count
            FROM rec GROUP BY icao24, observed_at"""
    ),
)
def dedup_latest_column(spark, sf):
    return dedup_latest(
        S.bronze(spark, sf), ["icao24", "observed_at"], "ingested_at",
        ["poll_time", "last_contact"], null_policy="column",
    )


@query(
    "dedup_lineitem",
    """SELECT l_partkey, l_suppkey, epoch_us(l_shipdate) // 1000000 AS l_shipdate, l_orderkey,
         l_linenumber, l_quantity, l_returnflag, source_row_count FROM (
         SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey
                  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn,
                count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS source_row_count FROM lineitem)
       WHERE rn = 1""",
)
def dedup_lineitem(spark, sf):
    lines = S.table(spark, sf, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag",
    )
    return dedup_latest(lines, ["l_partkey", "l_suppkey"], "l_shipdate", ["l_orderkey", "l_linenumber"])


def _summary(spark, sf, *columns):
    return flight_summary(S.sessions(spark, sf), S.DAY_GAP).select("flight_id", *columns)


_ENDS = [
    "first_latitude", "first_longitude", "last_latitude", "last_longitude",
    "started_on_ground", "ended_on_ground",
]


@query("agg_endpoints", session_sql(f"SELECT flight_id, {', '.join(_ENDS)} FROM summary", S.flights_sql()))
def agg_endpoints(spark, sf):
    return _summary(spark, sf, *_ENDS)


@query(
    "agg_mode",
    session_sql(
        """SELECT s.flight_id, v.callsign FROM summary s
           LEFT JOIN votes v ON v.flight_id = s.flight_id AND v.rn = 1""",
        S.flights_sql(),
    ),
)
def agg_mode(spark, sf):
    return _summary(spark, sf, "callsign")


@query("agg_any", session_sql("SELECT flight_id, origin_country FROM summary", S.flights_sql()))
def agg_any(spark, sf):
    return _summary(spark, sf, "origin_country")


@query(
    "agg_basic",
    session_sql(
        """SELECT flight_id, departure_time, arrival_time, duration_seconds, observation_count,
             max_alt AS max_altitude_m, avg_alt AS avg_altitude_m, max_vel AS max_velocity_ms,
             avg_vel AS avg_velocity_ms, max_gap_seconds FROM summary""",
        S.flights_sql(),
    ),
)
def agg_basic(spark, sf):
    return _summary(
        spark, sf, "departure_time", "arrival_time", "duration_seconds", "observation_count",
        "max_altitude_m", "avg_altitude_m", "max_velocity_ms", "avg_velocity_ms", "max_gap_seconds",
    )


_PHASES = ["climb_observations", "cruise_observations", "descent_observations", "ground_observations"]


@query("agg_countif", session_sql(f"SELECT flight_id, {', '.join(_PHASES)} FROM summary", S.flights_sql()))
def agg_countif(spark, sf):
    return _summary(spark, sf, *_PHASES)


@query(
    "agg_distinct",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS parts,
         (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_partkey, l_suppkey FROM lineitem) d
          WHERE d.l_returnflag = l.l_returnflag) AS part_suppliers
       FROM lineitem l GROUP BY l_returnflag""",
)
def agg_distinct(spark, sf):
    return S.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct(F.struct("l_partkey", "l_suppkey")).alias("part_suppliers"),
    )


_TRAFFIC = S.TRAFFIC_SQL


@query(
    "agg_distinct_if",
    silver_sql(
        "SELECT traffic_hour, region, distinct_aircraft, distinct_airborne, distinct_on_ground"
        " FROM traffic",
        _TRAFFIC,
    ),
)
def agg_distinct_if(spark, sf):
    return S.traffic(spark, sf).select(
        "traffic_hour", "region", "distinct_aircraft", "distinct_airborne", "distinct_on_ground"
    )


@query(
    "agg_filtered",
    silver_sql(
        "SELECT traffic_hour, region, avg_airborne_altitude_m, max_altitude_m,"
        " avg_airborne_velocity_knots FROM traffic",
        _TRAFFIC,
    ),
)
def agg_filtered(spark, sf):
    return S.traffic(spark, sf).select(
        "traffic_hour", "region", "avg_airborne_altitude_m", "max_altitude_m",
        "avg_airborne_velocity_knots",
    )


@query("agg_collect_set", session_sql("SELECT flight_id, regions_seen FROM summary", S.flights_sql()))
def agg_collect_set(spark, sf):
    return _summary(spark, sf, "regions_seen")


_PERCENTS = (0, 10, 50, 90, 99, 100)


@query(
    "agg_percentile",
    vec_sql(
        f"""SELECT p, value FROM (
              SELECT CAST(unnest([{', '.join(map(str, _PERCENTS))}]) AS DOUBLE) AS p) ps JOIN (
              SELECT last_contact - time_position AS value, count(*) OVER () AS n,
                row_number() OVER (ORDER BY last_contact - time_position) - 1 AS i
              FROM vec WHERE time_position IS NOT NULL) v
            ON i = least(CAST(floor(n * p / 100) AS BIGINT), n - 1)"""
    ),
)
def agg_percentile(spark, sf):
    return percentile_by_index(profiles.staleness(S.vectors(spark, sf)), "age", _PERCENTS)


@query(
    "agg_percentile_price",
    f"""SELECT p, value FROM (
          SELECT CAST(unnest([{', '.join(map(str, _PERCENTS))}]) AS DOUBLE) AS p) ps JOIN (
          SELECT CAST(round(l_extendedprice * 100) AS BIGINT) AS value, count(*) OVER () AS n,
            row_number() OVER (ORDER BY CAST(round(l_extendedprice * 100) AS BIGINT)) - 1 AS i
          FROM lineitem) v
        ON i = least(CAST(floor(n * p / 100) AS BIGINT), n - 1)""",
)
def agg_percentile_price(spark, sf):
    cents = S.table(spark, sf, "lineitem").select(
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    )
    return percentile_by_index(cents, "cents", _PERCENTS)


_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS field, count(*) FILTER (WHERE {column} IS NULL{present}) AS nulls,"
    f" count(*) FILTER (WHERE {column} IS NULL{present}) * 100e0 / count(*) AS null_pct FROM vec"
    for name, column, present in (
        (n, "raw_callsign" if n == "callsign" else "NULL" if n == "sensors" else n, "")
        for n, _, _ in schemas.VECTOR_FIELDS
    )
)


@query("agg_null_rates", vec_sql(_NULL_SQL))
def agg_null_rates(spark, sf):
    return profiles.null_rates(S.polls(spark, sf))


DUP_SQL = """
seen AS (
  SELECT on_ground, row_number() OVER (PARTITION BY icao24, time_position,
    CASE WHEN time_position IS NULL THEN last_contact END ORDER BY file, poll_time, pos) > 1 AS again
  FROM vec
),
dups AS (
  SELECT population, rows, duplicates, CASE WHEN rows = 0 THEN 0e0 ELSE duplicates * 100e0 / rows END
    AS duplicate_pct FROM (
  SELECT 'overall' AS population, count(*) AS rows, count(*) FILTER (WHERE again) AS duplicates FROM seen
  UNION ALL SELECT 'on_ground', count(*), count(*) FILTER (WHERE again) FROM seen WHERE on_ground
  UNION ALL SELECT 'airborne', count(*), count(*) FILTER (WHERE again) FROM seen WHERE NOT on_ground)
)"""


@query("agg_dup_rate", S.with_sql("SELECT * FROM dups", VEC, DUP_SQL))
def agg_dup_rate(spark, sf):
    return profiles.duplicate_rates(S.vectors(spark, sf))


# Windows ---------------------------------------------------------------------------


def _numbered(spark, sf, *columns, **params):
    rows = sessionize(
        settle(S.silver(spark, sf), "silver"), ["icao24"], "observed_at", 86_400, "on_ground", **params
    )
    return rows.select("icao24", "observed_at", *columns)


@query("win_row_number", session_sql("SELECT icao24, observed_at, observation_seq FROM sess"))
def win_row_number(spark, sf):
    return _numbered(spark, sf, "observation_seq")


@query(
    "win_lag",
    session_sql(
        "SELECT icao24, observed_at, lag(observed_at) OVER w AS previous_ts,"
        " lag(on_ground) OVER w AS previous_state FROM silver"
        " WINDOW w AS (PARTITION BY icao24 ORDER BY observed_at)"
    ),
)
def win_lag(spark, sf):
    return _numbered(spark, sf, "previous_ts", "previous_state")


@query("win_gap", session_sql("SELECT icao24, observed_at, seconds_since_previous FROM sess"))
def win_gap(spark, sf):
    return _numbered(spark, sf, "seconds_since_previous")


@query("win_boundary", session_sql("SELECT icao24, observed_at, is_session_start FROM sess"))
def win_boundary(spark, sf):
    return _numbered(spark, sf, "is_session_start")


@query("win_running_sum", session_sql("SELECT icao24, observed_at, session_seq FROM sess"))
def win_running_sum(spark, sf):
    return _numbered(spark, sf, "session_seq")


_SEQ = "observation_seq, seconds_since_previous, is_session_start, session_seq"


@query("sessionize", silver_sql(f"SELECT icao24, observed_at, {_SEQ} FROM sess", S.sessions_sql(1800)))
def sessionize_query(spark, sf):
    rows = sessionize(
        settle(S.silver(spark, sf), "silver"), ["icao24"], "observed_at", 1800, "on_ground"
    )
    return rows.select("icao24", "observed_at", *_SEQ.split(", "))


@query(
    "sessionize_last_ground",
    silver_sql(
        f"SELECT icao24, observed_at, {_SEQ} FROM sess", S.sessions_sql(86_400, "last_ground_row")
    ),
)
def sessionize_last_ground(spark, sf):
    return _numbered(spark, sf, *_SEQ.split(", "), boundary="last_ground_row")


@query(
    "win_ewma",
    S.with_sql(
        """SELECT region, poll_time, vectors, round(list_reduce(
             list(CAST(vectors AS DOUBLE)) OVER (PARTITION BY region ORDER BY poll_time
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             lambda a, x: 0.3e0 * x + 0.7e0 * a), 6) AS ewma FROM hours""",
        VEC, REC,
        "hours AS (SELECT region, poll_time // 3600 * 3600 AS poll_time, count(*) AS vectors"
        " FROM rec GROUP BY ALL)",
    ),
)
def win_ewma(spark, sf):
    hourly = S.bronze(spark, sf).groupBy(
        "region", F.date_trunc("hour", "poll_time").alias("poll_time")
    ).agg(F.count(F.lit(1)).alias("vectors"))
    smoothed = ewma(settle(hourly, "hourly"), "region", "poll_time", "vectors")
    return smoothed.select(
        "region", "poll_time", F.col("vectors").cast("bigint").alias("vectors"),
        F.round("ewma", 6).alias("ewma"),
    )


@query(
    "win_poll_gap",
    S.with_sql(
        """SELECT region, poll_time, vectors, gap_s, coalesce(gap_s > 600, false) AS breach FROM (
             SELECT *, poll_time - lag(poll_time) OVER (PARTITION BY region ORDER BY poll_time) AS gap_s
             FROM polls)""",
        VEC, REC, S.POLLS_SQL,
    ),
)
def win_poll_gap(spark, sf):
    return poll_gaps(settle(S.region_polls(spark, sf), "region-polls"))


@query(
    "win_quota_ledger",
    S.with_sql(
        """SELECT region, poll_time, cost, day, spent, 400 - spent AS remaining, spent > 400 AS over_quota
           FROM (SELECT p.region, p.poll_time, c.cost,
               strftime(make_timestamp(p.poll_time * 1000000), '%Y-%m-%d') AS day,
               CAST(sum(c.cost) OVER (PARTITION BY p.poll_time // 86400
                 ORDER BY p.poll_time, p.region ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 AS BIGINT) AS spent
             FROM polls p JOIN costs c USING (region))""",
        VEC, REC, S.POLLS_SQL, S.REGION_COST_SQL,
    ),
)
def win_quota_ledger(spark, sf):
    costs = bbox_cost(S.region_table(spark, sf)).select(F.col("name").alias("region"), "cost")
    polls = S.region_polls(spark, sf).join(costs, "region").select("region", "poll_time", "cost")
    return quota_ledger(settle(polls, "priced-polls"), quota=400)


# Order and limit ---------------------------------------------------------------------


@query(
    "topk_recent",
    session_sql(
        "SELECT flight_id, departure_time FROM flights ORDER BY departure_time DESC, flight_id LIMIT 100",
        S.flights_sql(),
    ),
)
def topk_recent(spark, sf):
    return flight_list(S.flight_fact(spark, sf)).select("flight_id", "departure_time")


_POINTS = """flight_id, observed_at, latitude, longitude, altitude_m,
  round(velocity * 1.94384e0) AS velocity_knots, vertical_rate, flight_phase, seconds_since_previous"""


@query(
    "sort_track",
    session_sql(f"SELECT {_POINTS} FROM sess WHERE has_usable_position ORDER BY flight_id, observed_at"),
)
def sort_track(spark, sf):
    return track_points(S.sessions(spark, sf)).orderBy("flight_id", "observed_at")


_WINDOW_COLUMNS = (
    "traffic_hour, region, distinct_aircraft, distinct_airborne, observations, duplicate_rate_pct"
)


@query(
    "sort_hour_region",
    silver_sql(
        f"SELECT {_WINDOW_COLUMNS} FROM traffic WHERE traffic_hour >= {S.AS_OF_EPOCH - 720 * 3600}"
        " ORDER BY traffic_hour, region",
        _TRAFFIC,
    ),
)
def sort_hour_region(spark, sf):
    return traffic_window(S.traffic(spark, sf), S.AS_OF, 720)


@query(
    "latest_per_key",
    """SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) // 1000000 AS o_orderdate, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
           AS rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1""",
)
def latest_per_key_query(spark, sf):
    orders = S.table(spark, sf, "orders").where(F.col("o_orderstatus") != "P").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"),
        "o_totalprice",
    )
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


