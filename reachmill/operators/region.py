"""Points against a region of any number of vertices: a grid index of its edges, joined by cell.

The plane is cut into cells of half the width of the border strip.  An edge is
listed in every cell that has a point within the width of it, so a point finds
its nearest edge in the list of its own cell, or is farther off than the width.

Whether a point is inside follows from the edges of its cell alone.  Every row
of cells has a centre line, and the places where edges cross that line are
known; their number to the right of the point's meridian tells whether the
meridian's place on the line is inside.  From there to the point the way stays within
the cell, and each edge of the cell that it crosses changes sides.  Edges of
all rings count alike, so holes and islands need no order or orientation.

Places (points that differ) and lists meet in groups of one cell.  A cell with more
than ``SLICE_ROWS`` places or a list of more than ``LIST_ROWS`` is dealt to several
groups: crossings add up and the smallest distance wins, so each may see a part of the list.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import BORDER_WIDTH_M
from reachmill.functions.geo import EARTH_M, wkt_rings
from reachmill.sources.lineage import cut

#: Places of a cell in one group, about.
SLICE_ROWS = 50_000
#: Rows of a cell's list in one group, about.
LIST_ROWS = 50_000
#: Edges that follow each other and stay together, at most.
STRETCH = 512
#: Edges that follow each other and are tried together.
RUN = 32
#: Metres in a degree of latitude.
DEGREE_M = math.pi / 180 * EARTH_M
#: The centre line of a row of cells stands at this share of it; not a half, since vertices tend to lie on round values.
CENTRE = 0.5 + 1 / (7 * math.pi)

_EDGE = ["x1", "y1", "x2", "y2"]


def wkt_edges(layer: DataFrame, column: str = "wkt") -> DataFrame:
    """ring, ord, x1, y1, x2, y2: the edges of all polygons of a layer, closed or not; null geometry gives none."""
    rings = layer.select(F.monotonically_increasing_id().alias("feature"), F.posexplode(wkt_rings(F.col(column))).alias("part", "points")).where("size(points) > 1")
    rings = rings.withColumn("ring", F.xxhash64("feature", "part"))
    following = F.concat(F.slice("points", F.lit(2), F.size("points")), F.slice("points", 1, 1))
    each = rings.select("ring", F.posexplode(F.arrays_zip(F.col("points").alias("a"), following.alias("b"))).alias("ord", "e"))
    return each.select("ring", F.col("ord").cast("long").alias("ord"), F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2")).where("x1 <> x2 or y1 <> y2")


def vertex_edges(vertices: DataFrame) -> DataFrame:
    """The same of vertices(ring, ord, lon, lat), whose ord runs from 0 without gaps in each ring."""
    last = vertices.groupBy("ring").agg(F.max("ord").alias("last"))
    here = vertices.join(last, "ring").select("ring", "ord", F.col("lon").alias("x1"), F.col("lat").alias("y1"), F.when(F.col("ord") == F.col("last"), 0).otherwise(F.col("ord") + 1).cast("long").alias("to"))
    there = vertices.select(F.col("ring").alias("_ring"), F.col("ord").cast("long").alias("_ord"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
    edges = here.join(there, (F.col("ring") == F.col("_ring")) & (F.col("to") == F.col("_ord")))
    return edges.select("ring", F.col("ord").cast("long").alias("ord"), *_EDGE).where("x1 <> x2 or y1 <> y2")


def _listed(edges: DataFrame, width: float, side: float) -> DataFrame:
    """cx, cy and the edge, for every cell that may hold a point within the width of it."""
    high = width / DEGREE_M
    far = F.greatest(F.abs(F.least("y1", "y2") - high), F.abs(F.greatest("y1", "y2") + high))
    wide = F.lit(high) / F.greatest(F.cos(F.radians(F.least(far, F.lit(90.0)))), F.lit(0.01))
    cell = lambda v: F.floor(v / side)
    out = edges.withColumn("cx", F.explode(F.sequence(cell(F.least("x1", "x2") - wide), cell(F.greatest("x1", "x2") + wide))))
    return out.withColumn("cy", F.explode(F.sequence(cell(F.least("y1", "y2") - high), cell(F.greatest("y1", "y2") + high))))


def _crossings(edges: DataFrame, side: float) -> DataFrame:
    """cy, x1: where edges cross the centre lines of rows of cells."""
    first = F.ceil(F.least("y1", "y2") / side - CENTRE)
    after = F.ceil(F.greatest("y1", "y2") / side - CENTRE)
    rows = edges.withColumn("first", first).withColumn("after", after).where("first < after").withColumn("cy", F.explode(F.sequence(F.col("first"), F.col("after") - 1)))
    line = (F.col("cy") + CENTRE) * side
    return rows.select("cy", (F.col("x1") + (line - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x1"))


def inside(px, py, line, crossings, edges):
    """For each point, whether it is inside: see the module's text.  edges: those that touch the cell, rows of x1, y1, x2, y2."""
    import numpy as np

    crossings = np.sort(crossings)
    odd = (len(crossings) - np.searchsorted(crossings, px, "right")) % 2 == 1
    x1, y1, x2, y2 = edges.T
    step = max(1, (1 << 22) // max(1, len(edges)))
    for at in range(0, len(px), step):
        x, y = px[at : at + step, None], py[at : at + step, None]
        over = (x1 > x) != (x2 > x)
        p, e = np.nonzero(over)
        height = y1[e] + (x[p, 0] - x1[e]) * (y2[e] - y1[e]) / (x2[e] - x1[e])
        crossed = (height > line) != (height > y[p, 0])
        odd[at : at + step] ^= np.bincount(p[crossed], minlength=len(x)) % 2 == 1
    return odd


def _segment_m(px, py, kx, edges):
    """Metres from points to edges, element by element, in the plane that touches the point."""
    import numpy as np

    ax, ay, bx, by = ((edges[..., i] - (px if i % 2 == 0 else py)) * (kx if i % 2 == 0 else DEGREE_M) for i in range(4))
    dx, dy = bx - ax, by - ay
    length = dx * dx + dy * dy
    u = np.clip(np.divide(-(ax * dx + ay * dy), length, out=np.zeros_like(length), where=length > 0), 0, 1)
    return np.hypot(ax + u * dx, ay + u * dy)


def nearest_m(px, py, edges, width):
    """Metres from each point to the nearest edge, nan beyond the width.

    Runs of edges are bounded by boxes; a point tries the run whose box is
    nearest, and then those whose box is nearer than what it found.
    """
    import numpy as np

    best = np.full(len(px), np.inf)
    if len(edges):
        runs = -(-len(edges) // RUN)
        padded = np.concatenate([edges, np.repeat(edges[-1:], runs * RUN - len(edges), 0)]).reshape(runs, RUN, 4)
        left, right = padded[:, :, [0, 2]].min((1, 2)), padded[:, :, [0, 2]].max((1, 2))
        low, high = padded[:, :, [1, 3]].min((1, 2)), padded[:, :, [1, 3]].max((1, 2))
        kx = np.cos(np.radians(py)) * DEGREE_M
        step = max(1, (1 << 20) // runs)
        for at in range(0, len(px), step):
            x, y, k = px[at : at + step], py[at : at + step], kx[at : at + step]
            dx = np.maximum(0, np.maximum(left - x[:, None], x[:, None] - right)) * k[:, None]
            dy = np.maximum(0, np.maximum(low - y[:, None], y[:, None] - high)) * DEGREE_M
            bound = np.hypot(dx, dy)
            first = bound.argmin(1)
            found = _segment_m(x[:, None], y[:, None], k[:, None], padded[first]).min(1)
            bound[np.arange(len(x)), first] = np.inf
            p, r = np.nonzero(bound <= np.minimum(found, width)[:, None])
            for a in range(0, len(p), 1 << 16):
                own, run = p[a : a + (1 << 16)], r[a : a + (1 << 16)]
                np.minimum.at(found, own, _segment_m(x[own, None], y[own, None], k[own, None], padded[run]).min(1))
            best[at : at + step] = found
    return np.where(best <= width, best, np.nan)


def _measure(width, side):
    def run(key, places, near):
        import numpy as np
        import pyarrow as pa

        px, py = (places.column(c).to_numpy() for c in ("px", "py"))
        near = near.sort_by([("ring", "ascending"), ("ord", "ascending")])
        line = near.column("x2").is_null().to_numpy()
        columns = [near.column(c).fill_null(np.nan).to_numpy() for c in _EDGE]
        crossings, edges = columns[0][line], np.stack([c[~line] for c in columns], 1)
        cx, cy = key[0].as_py(), key[1].as_py()
        touch = edges[(np.maximum(edges[:, 0], edges[:, 2]) >= cx * side) & (np.minimum(edges[:, 0], edges[:, 2]) <= (cx + 1) * side) & (np.maximum(edges[:, 1], edges[:, 3]) >= cy * side) & (np.minimum(edges[:, 1], edges[:, 3]) <= (cy + 1) * side)]
        odd = inside(px, py, (cy + CENTRE) * side, crossings, touch)
        metres = nearest_m(px, py, edges, width)
        return pa.table({"px": px, "py": py, "odd": pa.array(odd.astype(np.int32)), "metres": pa.array(metres, mask=np.isnan(metres))})

    return run


def _dealt(places: DataFrame, edges: DataFrame, width: float, side: float) -> tuple[DataFrame, DataFrame]:
    """(places, lists) with cx, cy, part and block: a group of the one meets that of the other, and neither is large.

    A cell's places are dealt to parts and its list to blocks, in stretches of
    edges that follow each other; each part meets each block.
    """
    cells = cut(places.groupBy("cx", "cy").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("parts")))
    listed = _listed(edges, width, side).join(cells, ["cx", "cy"]).select("cx", "cy", "parts", "ring", "ord", *_EDGE)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("ring", "long"), ("ord", "long"))]
    lines = _crossings(edges, side).join(cells, "cy").select("cx", "cy", "parts", *nothing, "x1", *[F.lit(None).cast("double").alias(c) for c in _EDGE[1:]])
    lists = listed.unionByName(lines)
    sizes = cut(lists.groupBy("cx", "cy").agg(F.ceil(F.count("*") / LIST_ROWS).alias("blocks")))
    stretch = F.when(F.col("ord").isNull(), F.xxhash64("x1")).otherwise(F.xxhash64("ring", F.floor(F.col("ord") / STRETCH)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    lists = lists.join(sizes, ["cx", "cy"]).withColumn("block", F.pmod(stretch, "blocks")).withColumn("part", every("parts"))
    places = places.join(cells, ["cx", "cy"]).join(sizes, ["cx", "cy"]).withColumn("part", F.pmod(F.xxhash64("px", "py"), "parts")).withColumn("block", every("blocks"))
    return places.drop("parts", "blocks"), lists.drop("parts", "blocks")


def region_distance(points: DataFrame, edges: DataFrame, width: float = BORDER_WIDTH_M, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """points with distance_m: 0 inside the region, metres to its boundary up to ``width``, else null; null without finite coordinates.

    ``edges`` are those of wkt_edges or vertex_edges, of any number of rings and
    regions (of overlapping ones, what an odd number of them covers is inside).
    Distances are taken in the plane that touches the point.  An empty region has no inside.
    Points that share coordinates are measured once.
    """
    names, side = points.columns, width / 2 / DEGREE_M
    known = F.coalesce(F.abs(F.col(lon)) < float("inf"), F.lit(False)) & F.coalesce(F.abs(F.col(lat)) < float("inf"), F.lit(False)) & ~F.isnan(lon) & ~F.isnan(lat)
    px, py = F.col(lon).cast("double"), F.col(lat).cast("double")
    places = cut(points.where(known).select(px.alias("px"), py.alias("py")).distinct().withColumn("cx", F.floor(F.col("px") / side)).withColumn("cy", F.floor(F.col("py") / side)))
    edges = cut(edges.where("x1 is not null and y1 is not null and x2 is not null and y2 is not null"))
    by = ["cx", "cy", "part", "block"]
    places, lists = _dealt(places, edges, width, side)
    measured = places.groupBy(*by).cogroup(lists.groupBy(*by)).applyInArrow(_measure(width, side), "px double, py double, odd int, metres double")
    metres = F.when(F.sum("odd") % 2 == 1, 0.0).otherwise(F.min("metres"))
    found = measured.groupBy(F.col("px").alias("_place_x"), F.col("py").alias("_place_y")).agg(metres.alias("distance_m"))
    located = points.where(known).join(found, (px == F.col("_place_x")) & (py == F.col("_place_y")), "left").select(*[F.col(f"`{c}`") for c in names], "distance_m")
    return located.unionByName(points.where(~known).withColumn("distance_m", F.lit(None).cast("double")))
