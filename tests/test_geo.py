import math
import random

import pytest
from pyspark.sql import functions as F

from waypost import bbox_cost, bbox_filter, bbox_validate, default_regions, haversine_km, nearest_k, nearest_within, tag_regions
from waypost.operators import nearest
from waypost.schemas import REGIONS


def km(lat1, lon1, lat2, lon2):
    p1, p2, dl = math.radians(lat1), math.radians(lat2), math.radians(lon2 - lon1)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, h)))


def points(rng, n, centre=None, spread=0.3):
    out = []
    for _ in range(n):
        if centre:
            lat = max(-90.0, min(90.0, centre[0] + rng.uniform(-spread, spread)))
            lon = (centre[1] + rng.uniform(-spread, spread) * (1 if abs(centre[0]) < 85 else 600) + 540) % 360 - 180
        else:
            lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        out.append((lat, lon))
    return out


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
@pytest.mark.parametrize(
    ("centre", "radius"),
    [((50.0, 4.0), 8.0), ((0.0, 180.0), 12.0), ((89.9, 10.0), 20.0), ((-90.0, 0.0), 15.0), (None, 900.0),
     (None, 21_000.0)],
)
def test_grid_join_equals_brute_force(spark, strategy, centre, radius):
    rng = random.Random(str((centre, radius)))
    left, right = points(rng, 150, centre), points(rng, 60, centre)
    right += right[:5]  # copies of a location
    lf = spark.createDataFrame([(i, *p) for i, p in enumerate(left)] + [(999, None, None)], "id int, la double, lo double")
    rf = spark.createDataFrame([(f"p{i:03d}", *p) for i, p in enumerate(right)], "code string, la double, lo double")
    got = {
        r.id: (r.code, r.away)
        for r in nearest_within(
            lf, rf, ("la", "lo"), ("la", "lo"), "code", {"code": "code"}, ["id"],
            km=radius, distance="away", strategy=strategy,
        ).collect()
    }
    assert got.pop(999) == (None, None)
    for i, p in enumerate(left):
        near = [(round(km(*p, *q), 6), f"p{j:03d}") for j, q in enumerate(right)]
        near = min((d, c) for d, c in near)
        expected = near if near[0] <= radius else None
        if expected is None:
            assert got[i] == (None, None)
        else:
            assert got[i][1] == pytest.approx(expected[0], abs=2e-6)
            assert got[i][0] == expected[1]


def test_radius_is_inclusive_and_ties_fall_to_the_key(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0)], "id int, la double, lo double")
    right = spark.createDataFrame([("b", 0.0, 1.0), ("a", 0.0, -1.0)], "code string, la double, lo double")
    rim = round(km(0, 0, 0, 1), 6)

    def match(radius):
        return nearest_within(
            left, right, ("la", "lo"), ("la", "lo"), "code", {"code": "code"}, ["id"], km=radius
        ).first().code

    assert match(rim) == "a"
    assert match(rim - 0.001) is None


def test_haversine_antipodes(spark):
    row = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("d")).first()
    assert row.d == pytest.approx(math.pi * 6371.0088)


def boxes(spark, *rows):
    return spark.createDataFrame([(n, *map(float, b)) for n, b in rows], REGIONS)


def test_price_tiers_at_their_limits(spark):
    sizes = [(5, 5, 1), (5, 5.01, 2), (10, 10, 2), (10, 10.01, 3), (20, 20, 3), (20, 20.01, 4)]
    df = boxes(spark, *[(f"b{i}", (0, 0, a, b)) for i, (a, b, _) in enumerate(sizes)], ("globe", (0, 0, 0, 0)))
    cost = {r.name: r.cost for r in bbox_cost(df).collect()}
    assert cost == {**{f"b{i}": c for i, (_, _, c) in enumerate(sizes)}, "globe": 4}


def test_box_validation(spark):
    df = boxes(
        spark, ("", (0, 0, 1, 1)), ("flat", (1, 0, 1, 1)), ("inv", (0, 5, 1, 1)), ("lat", (-91, 0, 1, 1)),
        ("lon", (0, 0, 1, 181)), ("globe", (0, 0, 0, 0)), ("ok", (0, 0, 1, 1)),
    )
    assert {r.name: r.reason for r in bbox_validate(df).collect()} == {
        "": "unnamed", "flat": "inverted", "inv": "inverted", "lat": "latitude out of range",
        "lon": "longitude out of range", "globe": None, "ok": None,
    }
    assert bbox_validate(default_regions(spark)).where("reason IS NOT NULL").isEmpty()


def test_regions_cover_edges_and_positionless_vectors(spark):
    regions = boxes(spark, ("a", (50, 3, 53.5, 7.5)), ("b", (53.5, 7.5, 60, 10)), ("globe", (0, 0, 0, 0)),
                    ("rim", (89, 179, 90, 180)))
    vectors = spark.createDataFrame(
        [(1, 53.5, 7.5), (2, 10.0, 10.0), (3, None, 5.0), (4, 50.0, 3.0), (5, 90.0, 180.0)],
        "id int, latitude double, longitude double",
    )
    tagged = {}
    for r in tag_regions(vectors, regions).collect():
        tagged.setdefault(r.id, set()).add(r.region)
    assert tagged == {
        1: {"a", "b", "globe"}, 2: {"globe"}, 3: {"a", "b", "globe", "rim"}, 4: {"a", "globe"},
        5: {"rim", "globe"},
    }
    assert {r.id for r in bbox_filter(vectors, 50, 3, 53.5, 7.5).collect()} == {1, 3, 4}
    assert bbox_filter(vectors, 0, 0, 0, 0).count() == 5


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_boxes_of_every_size(spark, strategy):
    rng = random.Random(2)
    def box(size):
        lat, lon = rng.uniform(-90, 90 - min(size, 179)), rng.uniform(-180, 180 - min(size, 359))
        return lat, lon, min(90, lat + size * rng.random()), min(180, lon + size)
    rows = [(f"b{i}", box(10 ** rng.uniform(-4, 2.5))) for i in range(300)]
    rows += [("point", (10, 10, 10, 10)), ("world", (-90, -180, 90, 180)), ("tile", (0, 0, 22.5, 22.5)), ("globe", (0, 0, 0, 0))]
    spots = [(0.0, 0.0), (22.5, 22.5), (90.0, 180.0), (-90.0, -180.0), (10.0, 10.0), (None, 1.0)]
    spots += [(rng.uniform(b[0], b[2]), rng.uniform(b[1], b[3])) for _, b in rows[:200]]
    vectors = spark.createDataFrame([(i, *p) for i, p in enumerate(spots)], "id int, latitude double, longitude double")
    got = {(r.id, r.region) for r in tag_regions(vectors, boxes(spark, *rows), strategy=strategy).collect()}
    assert got == {
        (i, n)
        for i, (lat, lon) in enumerate(spots)
        for n, b in rows
        if lat is None or n == "globe" or (b[0] <= lat <= b[2] and b[1] <= lon <= b[3])
    }


def test_many_small_boxes_give_few_candidates(spark):
    """100,000 boxes of a quarter degree and one world-wide box."""
    from waypost.operators.boxes import _tile

    small = spark.range(100_000).selectExpr(
        "cast(id as string) AS name", "(id % 1000) * 0.17 - 85 AS lat_min", "floor(id / 1000) * 3.5 - 178 AS lon_min"
    ).selectExpr("*", "lat_min + 0.25 AS lat_max", "lon_min + 0.25 AS lon_max")
    vectors = spark.range(500).selectExpr("id", "id * 0.3 - 80 AS latitude", "id * 0.7 - 177 AS longitude")
    regions = small.unionByName(boxes(spark, ("world", (-90, -180, 90, 180))))
    out = tag_regions(vectors, regions)
    assert out.where("region = 'world'").count() == 500
    level = 10  # tiles of 0.35 degrees
    lists = regions.where("name <> 'world'").select(
        F.explode(F.array_distinct(F.array(*[_tile(F.lit(level), F.col(a), F.col(b)) for a in ("lat_min", "lat_max") for b in ("lon_min", "lon_max")]))).alias("tile")
    ).groupBy("tile").count()
    assert lists.agg(F.max("count")).first()[0] <= 5


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize(("centre", "k", "reach"), [((0.0, 180.0), 3, 12.0), ((89.9, 10.0), 2, None), (None, 3, None), (None, 4, 3000.0)])
def test_k_nearest_equal_brute_force(spark, monkeypatch, small, centre, k, reach):
    if not small:
        monkeypatch.setattr("waypost.operators.nearest.fits_broadcast", lambda *_: False)
    rng = random.Random(str((centre, k)))
    left, right = points(rng, 60, centre), points(rng, 40, centre)
    right += right[:3]  # copies of a location
    lf = spark.createDataFrame([(i, *p) for i, p in enumerate(left)] + [(999, None, 1.0)], "id int, la double, lo double")
    rf = spark.createDataFrame([(f"p{i:03d}", *p) for i, p in enumerate(right)] + [("none", None, None)], "code string, la double, lo double")
    got = nearest_k(lf, rf, ("la", "lo"), ("la", "lo"), "code", {"code": "c"}, ["id"], k=k, km=reach, cell_rows=7).collect()
    assert len(got) == len({(r.id, r.rank) for r in got})
    found = {(r.id, r.rank): r.c for r in got}
    want = {}
    for i, p in enumerate(left):
        near = sorted((round(km(*p, *q), 6), f"p{j:03d}") for j, q in enumerate(right))
        want |= {(i, n): c for n, (d, c) in enumerate(near[:k], 1) if reach is None or d <= reach}
    assert found == want


def test_k_nearest_of_few_or_none(spark):
    lf = spark.createDataFrame([(1, 0.0, 0.0)], "id int, la double, lo double")
    rf = spark.createDataFrame([("a", 0.0, 179.0), ("b", 1.0, 1.0)], "code string, la double, lo double")
    ask = lambda right: nearest_k(lf, right, ("la", "lo"), ("la", "lo"), "code", {"code": "c"}, ["id"], k=5).collect()
    assert {(r.rank, r.c) for r in ask(rf)} == {(1, "b"), (2, "a")}
    assert ask(rf.where("false")) == []


def test_copies_at_one_location_share_a_search_and_k_points(spark, monkeypatch):
    """Only k points of a location can count, and rows at one location are looked up once."""
    seen = []
    plain = nearest._within
    monkeypatch.setattr(nearest, "_within", lambda rows, points, *a: seen.append((rows.count(), points.count())) or plain(rows, points, *a))
    lf = spark.range(300).selectExpr("id", "50.0 + id % 3 AS la", "5.0 AS lo")
    rf = spark.range(200).selectExpr("format_string('p%03d', id) AS code", "50.0 + id % 2 AS la", "5.1 AS lo")
    got = nearest_k(lf, rf, ("la", "lo"), ("la", "lo"), "code", {"code": "c"}, ["id"], k=2).collect()
    near = {0: ["p000", "p002"], 1: ["p001", "p003"], 2: ["p001", "p003"]}
    assert sorted((r.id, r["rank"], r.c) for r in got) == [(i, n + 1, near[i % 3][n]) for i in range(300) for n in range(2)]
    assert max(n for n, _ in seen) == 3 and max(n for _, n in seen) == 4
