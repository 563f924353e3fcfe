import math
import random

import pytest

from vejrkraft.operators import nearest
from vejrkraft.operators.nearest import _balanced_cells, nearest_point

POINTS = "code int, latitude double, longitude double, ord int"


def brute(points, la, lo):
    if la is None or lo is None or not math.isfinite(la) or not math.isfinite(lo):
        return None
    return min(points, key=lambda p: ((la - p[1]) ** 2 + (lo - p[2]) ** 2, p[3]))[0]


@pytest.mark.parametrize("limit", [4096, 10])
def test_equals_brute_force(spark, limit):
    rnd = random.Random(limit)
    # A tight cluster, a loose field and repeated spots.
    points = [(i, rnd.gauss(55, 0.001), rnd.gauss(9, 0.001), i) for i in range(150)]
    points += [(i, rnd.uniform(54, 58), rnd.uniform(8, 13), i) for i in range(150, 260)]
    points += [(1000 + p[0], p[1], p[2], 1000 + p[3]) for p in points[:20]]
    asks = [(i, rnd.uniform(53, 59), rnd.uniform(7, 14)) for i in range(200)]
    asks += [(200 + i, rnd.gauss(55, 0.002), rnd.gauss(9, 0.002)) for i in range(100)]
    asks += [(300, None, 9.0), (301, 55.0, None), (302, float("nan"), 9.0), (303, 55.0, 9.0), (304, 55.0, 9.0)]
    asks += [(305, float("inf"), 9.0), (306, 55.0, float("-inf"))]
    df = spark.createDataFrame(asks, "id int, latitude double, longitude double")
    got = nearest_point(df, spark.createDataFrame(points, POINTS), max_array_points=limit)
    assert {r["id"]: r["municipality_code"] for r in got.collect()} == {
        i: brute(points, la, lo) for i, la, lo in asks
    }


@pytest.mark.parametrize(
    "point",
    [
        lambda i: (55.0, i * 1e-12),  # one latitude
        lambda i: (2.0**-i if i < 900 else i * 1e-300, 9.0 + i % 7),  # ever closer to a corner
        lambda i: (float(i % 3), 2.0 ** (i % 50) + i),
        lambda i: (0.0, float(i)) if i % 2 else (float(i), 0.0),  # a cross
    ],
)
def test_leaves_are_bounded_whatever_the_spread(spark, point):
    points = [(*map(float, point(i)), i, i) for i in range(3000)]
    df = spark.createDataFrame(points, "p_lat double, p_lon double, p_ord int, p_code int").dropDuplicates(["p_lat", "p_lon"])
    leaves, depth = _balanced_cells(df)
    sizes = [r["count"] for r in leaves.groupBy("cell").count().collect()]
    assert max(sizes) <= 64 and sum(sizes) == df.count() and depth <= 5


@pytest.mark.parametrize("limit", [4096, 1])
def test_tie_goes_to_the_first_point(spark, limit):
    points = spark.createDataFrame([(7, 0.0, 2.0, 1), (5, 0.0, 0.0, 0), (9, 0.0, 0.0, 2)], POINTS)
    df = spark.createDataFrame([(0.0, 1.0)], "latitude double, longitude double")
    got = nearest_point(df, points, max_array_points=limit).first()
    assert got["municipality_code"] == 5


@pytest.mark.parametrize("limit", [4096, 1])
def test_points_without_coordinates_are_ignored(spark, limit):
    points = [(1, None, 2.0, 0), (2, float("nan"), 1.0, 1), (3, 9.0, 9.0, 2), (4, 20.0, 9.0, 3)]
    points += [(5, 0.0, float("inf"), 4), (6, float("-inf"), 1.0, 5)]
    df = spark.createDataFrame([(0.0, 1.0)], "latitude double, longitude double")
    got = nearest_point(df, spark.createDataFrame(points, POINTS), max_array_points=limit).first()
    assert got["municipality_code"] == 3


def test_no_points(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "latitude double, longitude double")
    assert nearest_point(df, spark.createDataFrame([], POINTS)).first()["municipality_code"] is None


@pytest.fixture
def met(monkeypatch):
    """Small cells, and the tables of coordinates that met the points of a cell."""
    asked, meet = [], nearest._meet
    monkeypatch.setattr(nearest, "_CELL_POINTS", 64)
    monkeypatch.setattr(nearest, "_meet", lambda a, cells: asked.append(a.count()) or meet(a, cells))
    return asked


def test_few_cells_are_met_where_points_crowd_into_a_corner(spark, met):
    points = [(i, 1 / (1 + i), 1 / (1 + i * 37 % 1500 * 3), i) for i in range(3000)]
    asks = [(i, 1 / (1 + 3 * i), 1 / (2 + i * 7 % 100)) for i in range(300)]
    df = spark.createDataFrame(asks, "id int, latitude double, longitude double")
    got = nearest_point(df, spark.createDataFrame(points, POINTS), max_array_points=64)
    assert {r["id"]: r["municipality_code"] for r in got.collect()} == {i: brute(points, la, lo) for i, la, lo in asks}
    assert met[0] == 300 and met[1] < 300 * 8


def test_coordinates_far_outside_meet_few_cells(spark, met):
    points = [(i, i * 37 % 200 / 300, i * 53 % 199 / 300, i) for i in range(3000)]
    asks = [(i, i % 20 / 4 - 0.5, 1000.0 + i) for i in range(300)]
    df = spark.createDataFrame(asks, "id int, latitude double, longitude double")
    got = nearest_point(df, spark.createDataFrame(points, POINTS), max_array_points=64)
    assert {r["id"]: r["municipality_code"] for r in got.collect()} == {i: brute(points, la, lo) for i, la, lo in asks}
    assert met[0] == 300 and met[1] < 300 * 8
