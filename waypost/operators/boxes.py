"""Named latitude/longitude boxes: price, validity and membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waypost import schemas
from waypost.functions.scalar import box_area, box_cost, has_position, in_box, is_global_box
from waypost.params import DEFAULT_REGIONS
from waypost.workspace import fits_broadcast

#: Finest level of the grid; tiles of a level are 360 / 2 ** level degrees wide and high.
MAX_LEVEL = 16

#: Tiles over which vectors without a position are dealt in a shuffle.
ANYWHERE_TILES = 64


def default_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_REGIONS, schemas.REGIONS)


def bbox_cost(regions: DataFrame) -> DataFrame:
    return regions.withColumns({"area_sq_deg": box_area(), "cost": box_cost()})


def bbox_validate(regions: DataFrame) -> DataFrame:
    """Adds ``reason``, NULL for an acceptable box; the global box needs a name only."""
    reason = (
        F.when(F.coalesce(F.col("name"), F.lit("")) == "", F.lit("unnamed"))
        .when(is_global_box(), F.lit(None))
        .when(
            (F.col("lat_min") >= F.col("lat_max")) | (F.col("lon_min") >= F.col("lon_max")),
            F.lit("inverted"),
        )
        .when((F.col("lat_min") < -90) | (F.col("lat_max") > 90), F.lit("latitude out of range"))
        .when((F.col("lon_min") < -180) | (F.col("lon_max") > 180), F.lit("longitude out of range"))
    )
    return regions.withColumn("reason", reason.cast("string"))


def bbox_filter(
    vectors: DataFrame, lat_min: float, lon_min: float, lat_max: float, lon_max: float
) -> DataFrame:
    """Rows a poll over the box returns: inside it, or without a position."""
    box = [F.lit(float(v)) for v in (lat_min, lon_min, lat_max, lon_max)]
    return vectors.where(in_box("latitude", "longitude", *box))


def _tile(level, lat, lon):
    """The tile of a point on one level; rows and columns are less than 2 ** 20."""
    size = F.lit(360.0) / F.pow(F.lit(2.0), level)
    row, column = F.floor((lat + 90.0) / size), F.floor((lon + 180.0) / size)
    return (level.cast("bigint") * (1 << 20) + row) * (1 << 20) + column


def tag_regions(
    vectors: DataFrame, regions: DataFrame, out: str = "region", strategy: str = "auto"
) -> DataFrame:
    """One row per vector and region that covers it.

    A vector without a position belongs to every region, as each regional poll
    would have returned it. A box is listed on the level of the grid whose tiles are just
    as large as it, so in four tiles at most whatever its size, and a vector looks up one
    tile on each level that has boxes. What meets it there are boxes of about the tile's
    size: a table of many small boxes does not fill the tiles of large ones. With a small
    region table the large side is never shuffled. In a shuffle the vectors without a
    position are dealt over ``ANYWHERE_TILES`` tiles, each with all regions, and a hot
    tile is split by adaptive execution. ``strategy`` is ``auto``, ``broadcast`` or
    ``shuffle``.
    """
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    south = F.when(F.col("_all"), F.lit(-90.0)).otherwise(F.greatest("lat_min", F.lit(-90.0)))
    north = F.when(F.col("_all"), F.lit(90.0)).otherwise(F.least("lat_max", F.lit(90.0)))
    west = F.when(F.col("_all"), F.lit(-180.0)).otherwise(F.greatest("lon_min", F.lit(-180.0)))
    east = F.when(F.col("_all"), F.lit(180.0)).otherwise(F.least("lon_max", F.lit(180.0)))
    extent = F.greatest(north - south, east - west)
    finest = F.lit(MAX_LEVEL)
    level = F.when(extent > 0, F.least(finest, F.floor(F.log2(F.lit(360.0) / extent) - 1e-9).cast("int"))).otherwise(finest)
    level = F.greatest(F.lit(0), level)
    corners = F.array(
        *[_tile(F.col("_level"), lat, lon) for lat in (south, north) for lon in (west, east)]
    )
    anywhere = F.sequence(F.lit(-ANYWHERE_TILES).cast("bigint"), F.lit(-1).cast("bigint"))
    boxes = regions.withColumn("_all", is_global_box()).where((south <= north) & (west <= east)).withColumn("_level", level)
    covers = boxes.withColumn("_tile", F.explode(F.concat(F.array_distinct(corners), anywhere))).select(
        F.col("name").alias(out), "lat_min", "lon_min", "lat_max", "lon_max", "_tile"
    )
    levels = sorted(r["_level"] for r in boxes.select("_level").distinct().collect())  # MAX_LEVEL + 1 at most
    if strategy == "broadcast" or (strategy == "auto" and fits_broadcast(covers)):
        covers = F.broadcast(covers)
    elif strategy == "shuffle":
        covers = covers.hint("merge")
    latitude, longitude = F.col("latitude"), F.col("longitude")
    nowhere = -1 - F.pmod(F.xxhash64(*vectors.columns), F.lit(ANYWHERE_TILES)).cast("bigint")
    at = F.array(*[_tile(F.lit(level), latitude, longitude) for level in levels]).cast("array<bigint>")
    located = vectors.drop(out).withColumn("_tile", F.explode(F.when(has_position(), at).otherwise(F.array(nowhere))))
    covered = in_box("latitude", "longitude", "lat_min", "lon_min", "lat_max", "lon_max")
    return located.join(covers, "_tile").where(covered).select(*vectors.drop(out).columns, out)
