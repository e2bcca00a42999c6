"""Position telemetry analytics on Spark DataFrames."""

from waypost.functions.geo import haversine_km
from waypost.operators.boxes import bbox_cost, bbox_filter, bbox_validate, default_regions, tag_regions
from waypost.operators.dedup import dedup_latest, latest_per_key
from waypost.operators.nearest import nearest_k, nearest_within
from waypost.operators.ranks import percentile_by_index
from waypost.operators.scans import ewma, running_total, sessionize
from waypost.operators.validation import field_drift, ratio_verdict, split_valid, validate
from waypost.params import Params
from waypost.plans.checks import MODEL_CHECKS, Check, run_checks
from waypost.plans.flights import flight_sessions, flights
from waypost.plans.profile import profile
from waypost.plans.regions import quota_ledger, region_yield
from waypost.plans.serving import flight_list, live, partition_stats, stats, track, traffic_window
from waypost.plans.silver import state_vectors
from waypost.plans.traffic import hourly_traffic
from waypost.sources.polls import decode_vectors, read_polls, time_shift, to_records
from waypost.sources.records import read_ndjson, stream_kafka, stream_ndjson
from waypost.sources.tables import read_airports, read_bronze

__all__ = [
    "MODEL_CHECKS", "Check", "Params", "bbox_cost", "bbox_filter", "bbox_validate",
    "decode_vectors", "dedup_latest", "default_regions", "ewma", "field_drift", "flight_list",
    "flight_sessions", "flights", "haversine_km", "hourly_traffic", "latest_per_key", "live",
    "nearest_k", "nearest_within", "partition_stats", "percentile_by_index", "profile", "quota_ledger",
    "ratio_verdict", "read_airports", "read_bronze", "read_ndjson", "read_polls", "region_yield",
    "run_checks", "running_total", "sessionize", "split_valid", "state_vectors", "stats",
    "stream_kafka", "stream_ndjson", "tag_regions", "time_shift", "to_records", "track",
    "traffic_window", "validate",
]
