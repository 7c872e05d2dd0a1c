"""Points against regions, beside slow versions that look at every edge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmill.functions import geo
from reachmill.operators import region


def star(cx, cy, r, n, seed):
    """A ring of n vertices around a centre, rough at all scales."""
    random = np.random.default_rng(seed)
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    far = r * (1 + 0.25 * np.interp(angle, np.linspace(0, 2 * np.pi, 60), random.random(60)) + 0.002 * random.random(n))
    return np.stack([cx + far * np.cos(angle), cy + far * np.sin(angle)], 1)


def slow_distance(x, y, rings):
    edges = np.concatenate([np.column_stack([r, np.roll(r, -1, 0)]) for r in rings])
    x1, y1, x2, y2 = edges.T
    over = (y1 > y) != (y2 > y)
    if (x < (x2 - x1)[over] * (y - y1[over]) / (y2 - y1)[over] + x1[over]).sum() % 2:
        return 0.0
    kx, ky = np.cos(np.radians(y)) * np.pi / 180 * geo.EARTH_M, np.pi / 180 * geo.EARTH_M
    ax, ay, dx, dy = (x1 - x) * kx, (y1 - y) * ky, (x2 - x1) * kx, (y2 - y1) * ky
    u = np.clip(-(ax * dx + ay * dy) / (dx * dx + dy * dy), 0, 1)
    return np.sqrt((ax + u * dx) ** 2 + (ay + u * dy) ** 2).min()


def edges_of(spark, rings):
    rows = [(i, j, float(x), float(y)) for i, ring in enumerate(rings) for j, (x, y) in enumerate(ring)]
    import pandas as pd

    return region.vertex_edges(spark.createDataFrame(pd.DataFrame(rows, columns=["ring", "ord", "lon", "lat"])))


def wkt(rings):
    text = lambda r: "(" + ", ".join(f"{x:.15g} {y:.15g}" for x, y in [*r, r[0]]) + ")"
    return f"MULTIPOLYGON(({text(rings[0])}, {text(rings[1])}), ({text(rings[2])}))"


def test_large_region_against_every_edge(spark, monkeypatch):
    # an outline of 100,000 vertices with a hole, and an island
    monkeypatch.setattr(region, "SLICE_ROWS", 300)
    rings = [star(-2, 48, 1.5, 100_000, 1), star(-2.2, 48.1, 0.5, 3000, 2), star(1.0, 48.3, 0.3, 500, 3)]
    random = np.random.default_rng(4)
    points = np.column_stack([random.uniform(-4.4, 1.9, 700), random.uniform(45.9, 50.1, 700)])
    points[:300] = [-0.35, 48.2] + 0.1 * random.standard_normal((300, 2))  # a crowd near the outline
    points[300:330] = rings[0][random.integers(0, 100_000, 30)] + 1e-5
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    got = {r.id: r.distance_m for r in region.region_distance(df, edges_of(spark, rings)).collect()}
    want = {i: slow_distance(x, y, rings) for i, (x, y) in enumerate(points)}
    assert got == {i: pytest.approx(d, abs=1e-6) if d <= 25_000 else None for i, d in want.items()}
    kinds = [sum(d == 0 for d in want.values()), sum(0 < d <= 25_000 for d in want.values()), sum(d > 25_000 for d in want.values())]
    assert min(kinds) > 50


@pytest.mark.parametrize("width", [500.0, 25_000.0, 400_000.0])
def test_any_width_and_wkt(spark, width):
    rings = [star(2, 46, 0.8, 700, 5), star(2.1, 46.1, 0.2, 300, 6), star(4, 46, 0.3, 5, 7)]
    random = np.random.default_rng(8)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.column_stack([random.uniform(0, 5, 300), random.uniform(44, 48, 300)]))]
    layer = spark.createDataFrame([(wkt(rings),), (None,), ("MULTIPOLYGON EMPTY",)], "wkt string")
    edges = region.wkt_edges(layer)
    assert edges.count() == 1005
    df = spark.createDataFrame(points, "id int, lon double, lat double")
    got = {r.id: r.distance_m for r in region.region_distance(df, edges, width).collect()}
    want = {i: slow_distance(x, y, rings) for i, x, y in points}
    assert got == {i: pytest.approx(d, rel=1e-6, abs=1e-4) if d <= width else None for i, d in want.items()}


def test_square_with_vertices_on_points_rows_and_columns(spark):
    # edges along the axes, points in line with vertices
    square = [[(0, 0), (2, 0), (2, 2), (0, 2)], [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5)]]
    points = [(0.25, 0.5), (0.25, 1.0), (1.0, 1.0), (1.75, 1.5), (2.1, 1.0), (2.1, 0.5), (-0.1, 0.25), (0.75, 0.25), (0.5, 0.25), (1.0, 2.1)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    got = [r.distance_m for r in region.region_distance(df, edges_of(spark, square), 200_000).orderBy("id").collect()]
    assert [d == 0 for d in got] == [True, True, False, True, False, False, False, True, True, False]
    assert got == pytest.approx([slow_distance(x, y, [np.array(r, float) for r in square]) for x, y in points], abs=1e-6)


def test_awkward_points_and_regions(spark):
    square = [[(0, 0), (1, 0), (1, 1), (0, 1), (0, 1)]]
    rows = [(1, 0.5, 0.5, "a", "b"), (1, 0.5, 0.5, "a", "b"), (None, 0.5, 1.01, None, None), (2, None, 0.5, "a", "b"), (3, float("nan"), 0.5, "a", "b"), (4, 0.5, float("inf"), "a", "b"), (5, 90.0, 80.0, "a", "b")]
    df = spark.createDataFrame(rows, "id int, lon double, lat double, part string, cx string")
    got = region.region_distance(df, edges_of(spark, square))
    assert got.columns == [*df.columns, "distance_m"]
    metres = sorted(((r.id or 0, -1 if r.distance_m is None else round(r.distance_m)) for r in got.collect()))
    assert metres == [(0, 1112), (1, 0), (1, 0), (2, -1), (3, -1), (4, -1), (5, -1)]
    nowhere = edges_of(spark, square).limit(0)
    assert {r.distance_m for r in region.region_distance(df, nowhere).collect()} == {None}
    assert region.region_distance(df.limit(0), edges_of(spark, square)).count() == 0


def test_ring_of_several_hundred_vertices_as_an_expression(spark):
    ring = star(1, 47, 0.3, 400, 9)
    points = [(float(x), float(y)) for x, y in np.random.default_rng(1).uniform([0.5, 46.5], [1.5, 47.5], (40, 2))]
    df = spark.createDataFrame([*points, (None, 47.0)], "lon double, lat double")
    got = df.select("lon", "lat", geo.distance_to_ring_m(F.col("lon"), F.col("lat"), ring.tolist()).alias("d")).collect()
    assert [r.d for r in got[:-1]] == pytest.approx([slow_distance(x, y, [ring]) for x, y in points], abs=1e-6) and got[-1].d is None


def test_no_group_holds_a_long_list(spark, monkeypatch):
    # 40,000 edges around a few cells, in parts of 2,000: as exact as in one
    monkeypatch.setattr(region, "LIST_ROWS", 2_000, raising=False)
    monkeypatch.setattr(region, "STRETCH", 100, raising=False)
    rings = [star(2, 46, 0.4, 40_000, 11), star(2.1, 46.1, 0.1, 3000, 12)]
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(np.random.default_rng(13).uniform([1.3, 45.4], [2.7, 46.6], (150, 2)))]
    points += [(i + 150, x, y) for i, x, y in points[:50]]
    df, edges = spark.createDataFrame(points, "id int, lon double, lat double"), edges_of(spark, rings)
    got = {r.id: r.distance_m for r in region.region_distance(df, edges).collect()}
    want = {i: slow_distance(x, y, rings) for i, x, y in points}
    assert got == {i: pytest.approx(d, abs=1e-6) if d <= 25_000 else None for i, d in want.items()}
    side = 12_500 / region.DEGREE_M
    places = df.select(F.col("lon").alias("px"), F.col("lat").alias("py")).distinct().withColumn("cx", F.floor(F.col("px") / side)).withColumn("cy", F.floor(F.col("py") / side))
    lists = region._dealt(places, edges, 25_000, side)[1]
    by = lists.groupBy("cx", "cy", "part", "block").count().agg(F.max("count"), F.countDistinct("cx", "cy"), F.count("*")).first()
    assert by[0] < 4_000 and by[2] > 3 * by[1]
