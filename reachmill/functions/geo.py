"""Geometry as Column expressions: WKT, centroids, projection, distance, precedence."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public parameters of EPSG:2154 (Lambert conformal conic, two parallels, GRS80).
_A, _F = 6378137.0, 1 / 298.257222101
_PHI1, _PHI2, _PHI0, _LAM0 = (math.radians(v) for v in (44.0, 49.0, 46.5, 3.0))
_FE, _FN = 700000.0, 6600000.0
_E = math.sqrt(_F * (2 - _F))
EARTH_M = 6371010.0


def _t(phi: float) -> float:
    s = _E * math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - (_E * math.sin(phi)) ** 2)


_N = math.log(_m(_PHI1) / _m(_PHI2)) / math.log(_t(_PHI1) / _t(_PHI2))
_K = _m(_PHI1) / (_N * _t(_PHI1) ** _N)
_R0 = _A * _K * _t(_PHI0) ** _N


def lambert93_to_wgs84(x: Column, y: Column, rounds: int = 6) -> Column:
    """struct(lon, lat) in degrees of EPSG:2154 coordinates."""
    dx, dy = x - _FE, F.lit(_R0) - (y - _FN)
    r = F.sqrt(dx * dx + dy * dy)
    t = F.pow(r / (_A * _K), F.lit(1 / _N))
    lon = F.atan2(dx, dy) / _N + _LAM0
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = _E * F.sin(phi)
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(_E / 2)))
    return F.struct(F.degrees(lon).alias("lon"), F.degrees(phi).alias("lat"))


def wkt_rings(wkt: Column) -> Column:
    """array of rings, each an array of struct(x, y), of a WKT point, polygon or multipolygon."""
    texts = F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1))
    pair = lambda p: F.struct(F.split(F.trim(p), r"\s+")[0].cast("double").alias("x"), F.split(F.trim(p), r"\s+")[1].cast("double").alias("y"))
    return F.transform(texts, lambda ring: F.transform(F.split(ring, ","), pair))


def wkt_centroid(wkt: Column) -> Column:
    """struct(x, y): the area-weighted centroid; the mean of the coordinates where there is no area; null for empty geometry.

    Rings are summed with the sign of their orientation, so holes (which run
    the other way round) are taken off.
    """
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def ring_sum(ring):
        index = F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))

        def step(acc, i):
            p, q = F.element_at(ring, i), F.element_at(ring, F.least(i + 1, F.size(ring)))
            cross = p["x"] * q["y"] - q["x"] * p["y"]
            return F.struct((acc["a"] + cross).alias("a"), (acc["x"] + (p["x"] + q["x"]) * cross).alias("x"), (acc["y"] + (p["y"] + q["y"]) * cross).alias("y"))

        return F.aggregate(index, zero, step)

    rings = wkt_rings(wkt)
    total = F.aggregate(F.transform(rings, ring_sum), zero, lambda a, b: F.struct((a["a"] + b["a"]).alias("a"), (a["x"] + b["x"]).alias("x"), (a["y"] + b["y"]).alias("y")))
    flat = F.flatten(rings)
    mean = lambda c: F.aggregate(flat, F.lit(0.0), lambda s, p: s + p[c]) / F.size(flat)
    by_area = F.struct((total["x"] / (3 * total["a"])).alias("x"), (total["y"] / (3 * total["a"])).alias("y"))
    by_mean = F.struct(mean("x").alias("x"), mean("y").alias("y"))
    return F.when(F.size(flat) > 0, F.when(total["a"] != 0, by_area).otherwise(by_mean))


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def distance_to_ring_m(lon: Column, lat: Column, ring) -> Column:
    """Metres from a point to a polygon given as a list of (lon, lat), closed or not; 0 inside.

    One fold over the edges, for rings of a few hundred vertices; the regions of
    ``operators.region`` have any number.  Distances to the edges are taken in
    the plane that touches the point, which is within 0.1 % over the few tens of
    kilometres of a border strip.
    """
    ring = [tuple(map(float, p)) for p in ring]
    if ring[0] != ring[-1]:
        ring.append(ring[0])
    corners = [F.lit([p[i] for p in points]).alias(f"{axis}{n}") for n, points in ((1, ring[:-1]), (2, ring[1:])) for i, axis in ((0, "x"), (1, "y"))]
    kx = F.cos(F.radians(lat)) * (math.pi / 180 * EARTH_M)
    ky = math.pi / 180 * EARTH_M

    def edge(so_far, e):
        ax, ay, bx, by = (e["x1"] - lon) * kx, (e["y1"] - lat) * ky, (e["x2"] - lon) * kx, (e["y2"] - lat) * ky
        dx, dy = bx - ax, by - ay
        u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(-(ax * dx + ay * dy), dx * dx + dy * dy), F.lit(0.0))))
        d = F.sqrt(F.pow(ax + u * dx, 2) + F.pow(ay + u * dy, 2))
        spans = (e["y1"] > lat) != (e["y2"] > lat)
        crossed = spans & F.coalesce(lon < F.try_divide((e["x2"] - e["x1"]) * (lat - e["y1"]), e["y2"] - e["y1"]) + e["x1"], F.lit(False))
        return F.struct(F.least(so_far["best"], d).alias("best"), (so_far["inside"] != crossed).alias("inside"))

    start = F.struct(F.lit(None).cast("double").alias("best"), F.lit(False).alias("inside"))
    found = F.aggregate(F.arrays_zip(*corners), start, edge)
    return F.when(lon.isNotNull() & lat.isNotNull(), F.when(found["inside"], F.lit(0.0)).otherwise(found["best"]))


def resolve_geometry(min_fiabilite: int = 0) -> Column:
    """struct(x, y, geometry_source) by precedence, of columns x, y (construction), gx, gy (group), ax, ay (address), fictive_cstr, fictive_groupe and fiabilite.

    An address counts with a known reliability of at least ``min_fiabilite``; a
    construction or group whose flag is null is neither real nor fictive, and isn't used.
    """
    pick = lambda x, y, s: F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.lit(s).alias("geometry_source"))
    there = lambda x, y: F.col(x).isNotNull() & F.col(y).isNotNull()
    flag = lambda c, v: F.coalesce(F.col(c).cast("int") == v, F.lit(False))
    sure = there("ax", "ay") & F.coalesce(F.col("fiabilite") >= min_fiabilite, F.lit(False))
    nothing = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(None).cast("string").alias("geometry_source"))
    own, group = there("x", "y"), there("gx", "gy")
    return (
        F.when(sure, pick("ax", "ay", "geom_adresse")).when(own & flag("fictive_cstr", 0), pick("x", "y", "geom_cstr")).when(group & flag("fictive_groupe", 0), pick("gx", "gy", "geom_groupe"))
        .when(own & flag("fictive_cstr", 1), pick("x", "y", "fictive")).when(group & flag("fictive_groupe", 1), pick("gx", "gy", "fictive")).otherwise(nothing)
    )


def tile_ids(lon_min: float, lat_min: float, lon_max: float, lat_max: float) -> list[str]:
    """Names of the one-degree tiles that cover a box."""
    name = lambda v, pos, neg, n: f"{pos if v >= 0 else neg}{abs(v):0{n}d}"
    span = lambda a, b: range(math.floor(a), math.ceil(b) if math.ceil(b) > math.floor(a) else math.floor(a) + 1)
    return [name(y, "N", "S", 2) + name(x, "E", "W", 3) for y in span(lat_min, lat_max) for x in span(lon_min, lon_max)]
