"""Hourly traffic per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waypost.functions.scalar import hour_bucket, safe_percent, safe_ratio, to_knots
from waypost.params import Params


def hourly_traffic(silver: DataFrame, params: Params = Params()) -> DataFrame:
    """Distinct aircraft and polling intensity per hour and region.

    Rows are first summed per hour, region and aircraft, so the distinct counts
    become plain counts and a busy hour spreads over its aircraft instead of
    meeting in one task.
    """
    airborne = ~F.col("on_ground")
    altitude, velocity = F.when(airborne, F.col("altitude_m")), F.when(airborne, F.col("velocity"))
    per_aircraft = (
        silver.select(
            hour_bucket().alias("traffic_hour"),
            "region", "icao24", "on_ground", "altitude_m", "velocity", "source_row_count",
        )
        .groupBy("traffic_hour", "region", "icao24")
        .agg(
            F.count_if(airborne).alias("airborne"),
            F.count_if("on_ground").alias("grounded"),
            F.count(F.lit(1)).alias("observations"),
            F.sum(altitude).alias("sum_altitude"),
            F.count(altitude).alias("n_altitude"),
            F.max(altitude).alias("max_altitude"),
            F.sum(velocity).alias("sum_velocity"),
            F.count(velocity).alias("n_velocity"),
            F.sum("source_row_count").alias("raw_rows"),
        )
    )
    totals = per_aircraft.groupBy("traffic_hour", "region").agg(
        F.count(F.lit(1)).alias("distinct_aircraft"),
        F.count_if(F.col("airborne") > 0).alias("distinct_airborne"),
        F.count_if(F.col("grounded") > 0).alias("distinct_on_ground"),
        F.sum("observations").alias("observations"),
        F.try_divide(F.sum("sum_altitude"), F.sum("n_altitude")).alias("avg_altitude"),
        F.max("max_altitude").alias("max_altitude"),
        F.try_divide(F.sum("sum_velocity"), F.sum("n_velocity")).alias("avg_velocity"),
        F.sum("raw_rows").alias("raw_rows"),
    )
    return totals.select(
        "traffic_hour", "region", "distinct_aircraft", "distinct_airborne", "distinct_on_ground",
        "observations",
        safe_ratio("observations", "distinct_aircraft").alias("observations_per_aircraft"),
        F.round("avg_altitude").alias("avg_airborne_altitude_m"),
        F.round("max_altitude").alias("max_altitude_m"),
        to_knots("avg_velocity", params.knots_per_ms).alias("avg_airborne_velocity_knots"),
        "raw_rows",
        safe_percent(F.col("raw_rows") - F.col("observations"), "raw_rows").alias("duplicate_rate_pct"),
    )
