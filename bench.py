"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the tables and the cores. Each query runs once
to warm up and then RUNS times; its figure is the median. Results go to Spark's
``noop`` sink, so that all rows are computed and none are collected. Where an operator
is meant, its input is written first and only the operator is timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from waypost import decode_vectors, nearest_within, schemas, tag_regions, validate  # noqa: E402
from waypost.catalog import QUERIES  # noqa: E402
from waypost.catalog import standin as S  # noqa: E402
from waypost.plans.profile import duplicate_rates  # noqa: E402
from waypost.workspace import settle  # noqa: E402

#: Registered queries, timed as they are, their stand-in input included.
HEADLINE = (
    "q_state_vectors",
    "dedup_lineitem",
    "q_flight_sessions",
    "q_flights",
    "q_hourly_traffic",
    "q_profile",
    "q_stats",
    "q_live",
    "q_region_yield",
    "join_nearest_shuffled",
    "agg_percentile",
    "win_ewma",
)
RUNS = 3


def on_written_input(spark: SparkSession, sf_dir: str) -> dict:
    """Operators over their written input."""
    messages = settle(S.messages(spark, sf_dir).select("value"), "messages")
    good = settle(S.messages(spark, sf_dir, False).select("value"), "good-messages")
    polls = settle(S.polls(spark, sf_dir), "polls")
    vectors = settle(S.vectors(spark, sf_dir), "vectors")
    wire = ", ".join(
        f"{f.name} {'bigint' if f.name in schemas.EPOCH_COLUMNS else f.dataType.simpleString()}"
        for f in schemas.BRONZE.fields
    )
    return {
        "decode_positional": lambda: decode_vectors(polls)[0],
        "val_records": lambda: validate(messages),
        "val_good_records": lambda: validate(good),
        "plain_typed_parse": lambda: good.select(F.from_json("value", wire).alias("r")),
        "join_nearest_radius": lambda: nearest_within(
            vectors.select("event_id", "pos", "latitude", "longitude"), S.airports(spark, sf_dir),
            ("latitude", "longitude"), ("latitude", "longitude"), "icao", {"icao": "icao"}, ["event_id", "pos"],
        ),
        "join_region_box": lambda: tag_regions(
            vectors.select("event_id", "pos", "latitude", "longitude"), S.region_boxes(spark, sf_dir)
        ),
        "agg_dup_rate": lambda: duplicate_rates(vectors),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("waypost-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="waypost-bench-"))
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(build) -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    jobs = on_written_input(spark, sf_dir) | {
        name: lambda name=name: QUERIES[name](spark, sf_dir) for name in HEADLINE
    }
    timed = {}
    for name, build in jobs.items():
        seconds(build)
        timed[name] = round(statistics.median(seconds(build) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
