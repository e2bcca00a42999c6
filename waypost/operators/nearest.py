"""Nearest reference point within a radius, as an equi-join on grid cells."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waypost.functions.geo import band_height, cell_of, cells_within, haversine_km
from waypost.params import EARTH_RADIUS_KM, MATCH_RADIUS_KM
from waypost.workspace import fits_broadcast, release, settle

#: Left rows that one task looks up in a cell; a cell with more is dealt over several.
CELL_ROWS = 100_000

#: Most cells that count as hot, which bounds what is broadcast about them.
HOT_CELLS = 10_000


def pick_strategy(right: DataFrame) -> str:
    """``broadcast`` for a reference side that is small in rows and bytes, else ``shuffle``."""
    return "broadcast" if fits_broadcast(right) else "shuffle"


def _dealt(placed: DataFrame, points: DataFrame, left_key: Sequence[str], cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: cells with too many left rows over several tasks, points copied to each."""
    heat = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_rows"))
    # No more than HOT_CELLS cells can each hold more than that share of all rows.
    share = heat.agg(F.greatest(F.ceil(F.sum("_rows") / HOT_CELLS), F.lit(cell_rows))).scalar()
    hot = heat.where(F.col("_rows") > share).select("_cell", F.ceil(F.col("_rows") / share).alias("_salts"))
    hot = F.broadcast(settle(hot, "hot-cells"))
    n_salts = F.coalesce("_salts", F.lit(1).cast("bigint"))
    salted = (
        placed.join(hot, "_cell", "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*left_key), n_salts))
        .drop("_salts")
    )
    spread = (
        points.join(hot, "_cell", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), n_salts - 1)))
        .drop("_salts")
    )
    return salted, spread


def nearest_within(
    left: DataFrame,
    right: DataFrame,
    left_point: tuple[str, str],
    right_point: tuple[str, str],
    right_key: str,
    take: dict[str, str],
    left_key: Sequence[str],
    km: float = MATCH_RADIUS_KM,
    distance: str | None = None,
    strategy: str = "auto",
    radius_km: float = EARTH_RADIUS_KM,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Attach to each left row the nearest right row no further than ``km``.

    ``take`` maps right columns to output names, ``distance`` names an optional
    output for the distance. Distances compare at millimetre resolution and equal
    ones fall to the smaller ``right_key``. Rows without a match or a position
    keep NULLs. ``left_key`` identifies a left row.

    Each reference point is listed in the few cells its circle touches, so a left
    row looks into exactly one cell. ``broadcast`` (chosen when the right side
    is small) leaves the left side unshuffled whatever its skew; ``shuffle`` serves any
    size: cells with more than ``cell_rows`` left rows are dealt over several tasks, and
    only their reference points are copied.
    """
    if strategy == "auto":
        strategy = pick_strategy(right)
    height = band_height(km, radius_km)
    out = {**take, **({"_km": distance} if distance else {})}

    # Copies at one location can never win against the smallest key there.
    lat, lon = right_point
    payload = [c for c in take if c not in (right_key, lat, lon)]
    points = (
        right.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .groupBy(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        .agg(F.min(F.struct(right_key, *payload)).alias("_best"))
        .select("_lat", "_lon", "_best.*")
        .withColumns({c: F.col(s) for c, s in ((lat, "_lat"), (lon, "_lon")) if c in take})
        .withColumn("_cell", F.explode(cells_within("_lat", "_lon", km, height, radius_km)))
    )
    ranked = [right_key, *[c for c in take if c != right_key]]
    here = left.withColumn("_cell", cell_of(*left_point, height))

    if strategy == "broadcast":
        cells = points.groupBy("_cell").agg(
            F.collect_list(F.struct("_lat", "_lon", *ranked)).alias("_near")
        )

        def candidate(p):
            km_away = F.round(haversine_km(*left_point, p["_lat"], p["_lon"], radius_km), 6)
            return F.struct(km_away.alias("_km"), *[p[c].alias(c) for c in ranked])

        best = F.array_min(
            F.filter(F.transform("_near", candidate), lambda c: c["_km"] <= F.lit(km))
        )
        # Exploded from a one-element array, so that the search runs once per row
        # however many of its columns are taken.
        return (
            here.join(F.broadcast(cells), "_cell", "left")
            .select(*left.columns, F.explode(F.array(best)).alias("_best"))
            .select(*left.columns, *[F.col(f"_best.{c}").alias(a) for c, a in out.items()])
        )

    if strategy != "shuffle":
        raise ValueError(f"unknown strategy {strategy!r}")
    placed = here.where(F.col("_cell").isNotNull()).select(
        *left_key,
        F.col(left_point[0]).alias("_left_lat"),
        F.col(left_point[1]).alias("_left_lon"),
        "_cell",
    )
    salted, spread = _dealt(placed, points, left_key, cell_rows)
    best = (
        salted.join(spread, ["_cell", "_salt"])
        .withColumn("_km", F.round(haversine_km("_left_lat", "_left_lon", "_lat", "_lon", radius_km), 6))
        .where(F.col("_km") <= km)
        .groupBy(*left_key)
        .agg(F.min(F.struct("_km", *ranked)).alias("_best"))
    )
    return left.join(best, list(left_key), "left").select(
        *left.columns, *[F.col(f"_best.{c}").alias(a) for c, a in out.items()]
    )


#: Rings grow by this factor where too few points are found.
RING = 4.0


def _within(rows: DataFrame, points: DataFrame, left_key: Sequence[str], km: float, radius_km: float, cell_rows: int) -> DataFrame:
    """Rows (``left_key``, ``_left_lat``, ``_left_lon``) with each point no further than ``km``."""
    height = band_height(km, radius_km)
    listed = points.withColumn("_cell", F.explode(cells_within("_lat", "_lon", km, height, radius_km)))
    here = rows.withColumn("_cell", cell_of("_left_lat", "_left_lon", height))
    if fits_broadcast(listed):
        met = here.join(F.broadcast(listed), "_cell")
    else:
        salted, spread = _dealt(here, listed, left_key, cell_rows)
        met = salted.join(spread, ["_cell", "_salt"])
    away = F.round(haversine_km("_left_lat", "_left_lon", "_lat", "_lon", radius_km), 6)
    return met.withColumn("_km", away).where(F.col("_km") <= km)


def nearest_k(
    left: DataFrame,
    right: DataFrame,
    left_point: tuple[str, str],
    right_point: tuple[str, str],
    right_key: str,
    take: dict[str, str],
    left_key: Sequence[str],
    k: int,
    km: float | None = None,
    rank: str = "rank",
    distance: str = "km",
    first_km: float = MATCH_RADIUS_KM,
    radius_km: float = EARTH_RADIUS_KM,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The ``k`` nearest right rows of each left row, no further than ``km`` if that is given.

    A row per match: ``left_key``, what ``take`` maps, ``rank`` from 1 and ``distance``.
    Distances compare at millimetre resolution, equal ones fall to the smaller
    ``right_key``, which identifies a right row as ``left_key`` does a left one. Rows
    without a position, and left rows without a match, are in no row.

    Of points at one location only the ``k`` smallest keys can count, and left rows at one
    location share a search, so the search runs over distinct locations of either side.
    Candidates come from the grid as in ``nearest_within``; a task passes on no more than
    ``k`` of a location to the shuffle. Without ``km`` the search starts at ``first_km``,
    and locations with fewer than ``k`` matches go on with a ring ``RING`` times as wide,
    until it spans the sphere. Each round sees only the locations that are still open.
    """
    keys, spot = list(left_key), ["_left_lat", "_left_lon"]
    at_one_place = Window.partitionBy("_lat", "_lon").orderBy(f"_right.{right_key}")
    points = settle(
        right.where(F.col(right_point[0]).isNotNull() & F.col(right_point[1]).isNotNull())
        .select(F.col(right_point[0]).alias("_lat"), F.col(right_point[1]).alias("_lon"), F.struct(right_key, *[c for c in take if c != right_key]).alias("_right"))
        .withColumn("_rank", F.row_number().over(at_one_place))
        .where(F.col("_rank") <= k)
        .drop("_rank"),
        "points",
    )
    placed = left.where(F.col(left_point[0]).isNotNull() & F.col(left_point[1]).isNotNull()).select(
        *keys, F.col(left_point[0]).alias("_left_lat"), F.col(left_point[1]).alias("_left_lon")
    )
    open_ = settle(placed.select(*spot).distinct(), "open")
    by_distance = Window.partitionBy(*spot).orderBy("_km", f"_right.{right_key}")

    def found(rows: DataFrame, reach: float) -> DataFrame:
        met = _within(rows, points, spot, reach, radius_km, cell_rows)
        return met.withColumn("_rank", F.row_number().over(by_distance)).where(F.col("_rank") <= k)

    if km is not None:
        done = found(open_, km)
    else:
        wanted = min(k, points.count())
        span, reach, done = math.pi * radius_km, first_km, None
        while True:
            last = reach >= span
            matched = settle(found(open_, reach), "matched")
            full = matched.groupBy(*spot).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= wanted).select(*spot)
            part = matched if last else matched.join(full, spot, "left_semi")
            done = part if done is None else done.unionByName(part)
            if last or not wanted:
                break
            rest = settle(open_.join(full, spot, "left_anti"), "open")
            release(open_)
            open_ = rest
            if open_.isEmpty():
                break
            reach *= RING
    return placed.join(done, spot).select(
        *keys, *[F.col(f"_right.{c}").alias(a) for c, a in take.items()], F.col("_rank").alias(rank), F.col("_km").alias(distance)
    )
