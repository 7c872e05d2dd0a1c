"""Every registered query of the engine beside its SQL."""

from __future__ import annotations

import atexit
import datetime
import io as _bytes
import os
import shutil
import tempfile
import warnings

from pyspark.sql import functions as F

from reachmill.functions import geo
from reachmill.functions.contracts import ATOMIC, LEVELS, MODES, RUNGS, ContractError, duplicates, gain_report, matrix_report
from reachmill.operators import aggregates, deltas, feeds, gtfs, matrix, monolith, region, routing, universe
from reachmill.plans import inputs, publisher, reroute
from reachmill.plans.adapters import CLUSTERS, KEPT, METRICS, as_query, frame
from reachmill.plans.runner import Run, run_metadata
from reachmill.sources import io, timetables
from reachmill.sources.stored import StoredTable
from reachmill.streaming import incremental

_QUERIES: dict = {}
_SQL: dict[str, str] = {}
DATE, PROBS = "2026-09-16", (0.1, 0.5, 0.9)
POLICY = {
    "whole_feeds": [],
    "route_ids": {"demo": ["3", "4"]},
    "route_short_name_patterns": {"demo": "^P"},
    "trip_text_patterns": {"demo": "renfort scol$"},
    "bus_route_types": gtfs.BUS_ROUTE_TYPES + gtfs.EXCLUDED_ROUTE_TYPES,
}


def query(sql: str | None = None, name: str | None = None):
    """Registers f(get), where get(name) is a table or canonical input, under its name."""

    def register(f):
        key = name or f.__name__
        _QUERIES[key] = lambda spark, sf_dir: f(lambda n: frame(spark, sf_dir, n))
        if sql:
            _SQL[key] = as_query(sql)
        return f

    return register


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def _ladder(column: str, suffix: str = "") -> str:
    return ", ".join(f"CAST(sum(CASE WHEN {column} <= {r} THEN 1 ELSE 0 END) AS INT) AS count_{r}{suffix}" for r in RUNGS)


# pairs and matrices


@query("SELECT * FROM {collapsed}")
def pair_collapse(get):
    return matrix.collapse_pairs(get("pairs"), ["from_id", "to_id", "mode"])


def _matrix(get):
    return matrix.derive_matrix(matrix.collapse_pairs(get("pairs"), ["from_id", "to_id", "mode"]), get("dest_map"))


query("SELECT * FROM {matrix}", "matrix_single")(_matrix)

_TRANSIT = f"""SELECT p.from_id AS batiment_id, d.TYPEQU, min(travel_time_p1) AS tt_nearest, min(travel_time_p50) AS travel_time_p50, {_ladder("travel_time_p1")}, {_ladder("travel_time_p50", "_p50")},
  'transit' AS mode, min(travel_time_p1) AS travel_time_p1
  FROM {{transit_pairs}} p JOIN {{dest_map}} d ON p.to_id = d.id WHERE travel_time_p1 IS NOT NULL AND travel_time_p50 IS NOT NULL GROUP BY p.from_id, d.TYPEQU"""


@query(_TRANSIT)
def matrix_transit(get):
    return matrix.derive_transit_matrix(get("transit_pairs"), get("dest_map"))


@query("SELECT 'o' || from_id AS from_id, 'd' || to_id AS to_id, travel_time FROM {collapsed} WHERE mode = 'walk'")
def matrix_orientation(get):
    pairs = matrix.collapse_pairs(get("pairs").where("mode = 'walk'"))
    o, d = F.concat(F.lit("o"), "from_id"), F.concat(F.lit("d"), "to_id")
    swapped = pairs.select(d.alias("from_id"), o.alias("to_id"), "travel_time")
    return matrix.orient_pairs(swapped, get("origins").select(F.concat(F.lit("o"), "id").alias("id")), get("dest_map").select(F.concat(F.lit("d"), "id").alias("id")))


@query("SELECT 'bad' AS violation, CAST(0 AS BIGINT) AS n WHERE false UNION ALL SELECT v, CAST(0 AS BIGINT) FROM (VALUES ('empty_id'), ('mode'), ('cap'), ('count'), ('nearest'), ('monotone'), ('duplicate_key')) t(v)")
def validate_matrix_report(get):
    return matrix_report(_matrix(get))


@query("""SELECT 'cap' AS violation, CAST(count(CASE WHEN tt_nearest > 17 THEN 1 END) AS BIGINT) AS n FROM {matrix}
  UNION ALL SELECT 'nearest', CAST(count(CASE WHEN tt_nearest > 17 OR count_5 > 0 THEN 1 END) AS BIGINT) FROM {matrix} UNION ALL SELECT 'count', CAST(0 AS BIGINT)""")
def validate_matrix_broken(get):
    rows = _matrix(get).withColumn("tt_nearest", F.when(F.col("tt_nearest") > 17, 40.0).when(F.col("count_5") > 0, 6.0).otherwise(F.col("tt_nearest")))
    return matrix_report(rows).where("violation in ('cap', 'nearest', 'count')")


_ODD = """SELECT CASE WHEN k % 17 = 0 THEN '' ELSE batiment_id END AS batiment_id, CASE WHEN k % 29 = 0 THEN NULL ELSE TYPEQU END AS TYPEQU, CASE WHEN k % 13 = 0 THEN 'boat' ELSE mode END AS mode,
  CASE WHEN k % 11 = 0 THEN 40 WHEN k % 23 = 0 THEN NULL ELSE tt_nearest END AS tt_nearest, CASE WHEN k % 7 = 0 THEN -1 ELSE count_5 END AS count_5, CASE WHEN k % 5 = 0 THEN count_15 + 1 ELSE count_10 END AS count_10, count_15, CASE WHEN k % 31 = 0 THEN NULL ELSE count_20 END AS count_20
  FROM (SELECT *, CAST(batiment_id AS INT) AS k FROM {m}) x"""
_COUNTS = ["count_5", "count_10", "count_15", "count_20"]
_RULES = {
    "empty_id": "coalesce(batiment_id, '') = '' OR coalesce(TYPEQU, '') = ''",
    "mode": "mode NOT IN ('walk', 'transit', 'bike', 'car')",
    "cap": "NOT coalesce(tt_nearest BETWEEN 0 AND 20, false)",
    "count": " OR ".join(f"{c} IS NULL OR {c} < 0" for c in _COUNTS),
    "nearest": " OR ".join(f"coalesce(({c} >= 1) <> (tt_nearest <= {r}), false)" for c, r in zip(_COUNTS, RUNGS)),
    "monotone": " OR ".join(f"coalesce({a} > {b}, false)" for a, b in zip(_COUNTS, _COUNTS[1:])),
}


@query(
    f"WITH o AS ({_ODD.format(m='{matrix}')} UNION ALL SELECT batiment_id, TYPEQU, mode, tt_nearest, count_5, count_10, count_15, count_20 FROM {{matrix}} WHERE CAST(batiment_id AS INT) % 19 = 0) "
    + " UNION ALL ".join(f"SELECT '{k}' AS violation, CAST(count(CASE WHEN {v} THEN 1 END) AS BIGINT) AS n FROM o" for k, v in _RULES.items())
    + " UNION ALL SELECT 'duplicate_key', CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM o GROUP BY batiment_id, TYPEQU, mode HAVING count(*) > 1) d"
)
def validate_matrix_rules(get):
    """Every rule broken by some rows, and some keys given twice."""
    rows = _matrix(get)
    odd = rows.sparkSession.sql(_ODD, m=rows)
    return matrix_report(odd.unionByName(rows.where("CAST(batiment_id AS INT) % 19 = 0").select(odd.columns)))


# routing

# up to 65,536 rows: leaves by a prefix of the digest, and the root
_TREE = """c AS (SELECT h, count(*) AS n FROM r GROUP BY h), p AS (SELECT CASE WHEN count(*) <= 256 THEN 0 WHEN count(*) <= 4096 THEN 1 ELSE 2 END AS p FROM c),
  g AS (SELECT substr(h, 1, p) AS h, sha256(string_agg(h || ':' || CAST(n AS STRING), ',' ORDER BY h)) AS n FROM c, p GROUP BY 1) SELECT sha256(string_agg(h || ':' || n, ',' ORDER BY h)) AS content_key FROM g"""


@query("SELECT printf('coord_o_%06d', row_number() OVER (ORDER BY first)) AS id, lon, lat FROM (SELECT lon, lat, min(ord) AS first FROM {origins} GROUP BY lon, lat) x")
def coord_plan_points(get):
    return routing.coordinate_plan(get("origins"), "coord_o")[0]


_PLAN = "SELECT lon, lat, printf('{p}_%06d', row_number() OVER (ORDER BY first)) AS point_id FROM (SELECT lon, lat, min(ord) AS first FROM {{{t}}} GROUP BY lon, lat) x"
_OPLAN, _DPLAN = _PLAN.format(p="coord_o", t="origins"), _PLAN.format(p="coord_d", t="destinations")


@query(f"SELECT o.id, p.point_id FROM {{origins}} o JOIN ({_OPLAN}) p ON o.lon = p.lon AND o.lat = p.lat")
def coord_plan_link(get):
    return routing.coordinate_plan(get("origins"), "coord_o")[1]


_ROUTE = "SELECT o.id AS from_id, d.id AS to_id, 2 + ceil(sqrt(((o.lon - d.lon) * 80) * ((o.lon - d.lon) * 80) + ((o.lat - d.lat) * 111) * ((o.lat - d.lat) * 111)) / 30 * 60) AS travel_time FROM {origins} o, {destinations} d"


@query(f"SELECT from_id, to_id, CAST(travel_time AS DOUBLE) AS travel_time FROM ({_ROUTE}) x WHERE travel_time <= 20")
def stub_route(get):
    return routing.stub_route(get("origins"), get("destinations"))


@query(f"SELECT from_id, to_id, CAST(travel_time AS DOUBLE) AS travel_time FROM ({_ROUTE}) x WHERE travel_time <= 20")
def route_unique(get):
    return routing.route_unique(get("origins"), get("destinations"), routing.stub_route)


@query(f"SELECT from_id, to_id, CAST(travel_time AS DOUBLE) AS travel_time_p1, CAST(travel_time + 5 AS DOUBLE) AS travel_time_p50 FROM ({_ROUTE}) x WHERE travel_time <= 20")
def stub_transit_route(get):
    return routing.stub_transit_route(get("origins"), get("destinations"))


@query(f"""SELECT o.id AS from_id, d.id AS to_id, CAST(f.ord AS DOUBLE) AS travel_time FROM
  (SELECT point_id, min(o.ord) AS ord FROM {{origins}} o JOIN ({_OPLAN}) p ON o.lon = p.lon AND o.lat = p.lat GROUP BY point_id) f
  JOIN (SELECT o.id, p.point_id FROM {{origins}} o JOIN ({_OPLAN}) p ON o.lon = p.lon AND o.lat = p.lat) o ON o.point_id = f.point_id
  JOIN (SELECT o.id, p.point_id FROM {{destinations}} o JOIN ({_DPLAN}) p ON o.lon = p.lon AND o.lat = p.lat) d ON substr(d.point_id, 9) = substr(o.point_id, 9)""")
def expand_pairs(get):
    ol, dl = routing.coordinate_plan(get("origins"), "coord_o")[1], routing.coordinate_plan(get("destinations"), "coord_d")[1]
    first = get("origins").join(ol, "id").groupBy("point_id").agg(F.min("ord").alias("ord"))
    pairs = first.select(F.col("point_id").alias("from_id"), F.regexp_replace("point_id", "coord_o", "coord_d").alias("to_id"), F.col("ord").cast("double").alias("travel_time"))
    return routing.expand_pairs(pairs, ol, dl)


@query("SELECT id, CAST(floor((row_number() OVER (ORDER BY id) - 1) / 100) + 1 AS INT) AS chunk_id FROM {origins}")
def chunk_slice(get):
    return routing.chunk_ids(get("origins").select("id"), 100)


@query("SELECT CAST(count(*) AS BIGINT) AS n_identities, CAST(count(DISTINCT (lon, lat)) AS BIGINT) AS n_coordinates, CAST(ceil(count(DISTINCT (lon, lat)) / 100.0) AS BIGINT) AS n_chunks FROM {origins}")
def plan_census(get):
    return routing.census(get("origins"), routing.coordinate_plan(get("origins"), "c")[0], 100)


@query(f"""WITH r AS (SELECT sha256(id || '|' || CAST(CAST(ord AS BIGINT) AS STRING) || '|' || CAST(CAST(ord AS BIGINT) % 7 AS STRING)) AS h FROM {{origins}}),
  {_TREE}""")
def content_key(get):
    return routing.universe_key(get("origins").select("id", F.col("ord").alias("lon"), (F.col("ord") % 7).alias("lat")))


@query("SELECT mode, CAST(count(*) AS BIGINT) AS n_chunks, CAST(sum(n_rows) AS BIGINT) AS n_rows, CAST(sum(route_seconds) AS BIGINT) AS route_seconds FROM {chunk_entries} GROUP BY mode", "run_metadata")
def _run_metadata(get):
    return run_metadata(get("chunk_entries"))


# buildings and territories

_REACHED = f"(TYPEQU IN {_in(KEPT)} AND count_20 >= 1)"
_FLAGS = ", ".join(f"coalesce(bool_or({_REACHED} AND TYPEQU IN {_in(t)}), false) AS has_{n}" for n, t in CLUSTERS.items())
_BUILDING = f"""
  WITH b AS (SELECT batiment_id, mode, count(DISTINCT CASE WHEN {_REACHED} THEN TYPEQU END) AS diversity, coalesce(sum(CASE WHEN {_REACHED} THEN count_20 END), 0) AS total, {_FLAGS} FROM {{matrix}} GROUP BY batiment_id, mode),
  g AS (SELECT * FROM (SELECT DISTINCT batiment_id FROM {{matrix}}) x, (SELECT DISTINCT mode FROM {{matrix}}) y),
  f AS (SELECT g.batiment_id, g.mode, coalesce(b.diversity, 0) AS diversity, coalesce(b.total, 0) AS total, {", ".join(f"coalesce(has_{n}, false) AS has_{n}" for n in CLUSTERS)}
        FROM g LEFT JOIN b ON g.batiment_id = b.batiment_id AND g.mode = b.mode),
  bm AS (SELECT f.batiment_id, f.mode, CAST(f.diversity AS BIGINT) AS diversity, CAST(f.total AS BIGINT) AS total, CAST(r.diversity - f.diversity AS BIGINT) AS div_loss, CAST(r.total - f.total AS BIGINT) AS tot_loss, {", ".join(f"f.has_{n}" for n in CLUSTERS)}
        FROM f LEFT JOIN f r ON f.batiment_id = r.batiment_id AND r.mode = 'car')"""


def _building(get, with_ref=False):
    return matrix.building_metrics(_matrix(get), KEPT, 20, "car", CLUSTERS, with_ref, MODES)


query(_BUILDING + " SELECT * FROM bm", "building_metrics")(_building)

for _level, _keys in LEVELS.items():
    _k = _keys[0]
    _shares = ", ".join(f"avg(CAST(m.has_{n} AS INT)) AS share_{n}, avg(CAST(r.has_{n} AND NOT m.has_{n} AS INT)) AS pct_iso_{n}" for n in CLUSTERS)
    query(
        _BUILDING
        + f""" SELECT c.{_k}, m.mode, CAST(count(DISTINCT m.batiment_id) AS BIGINT) AS nb_buildings, {_shares}, avg(CAST(m.total = 0 AS INT)) AS pct_iso_full, avg(m.diversity) AS avg_diversity, avg(m.total) AS avg_total,
        avg(m.div_loss) AS avg_div_loss, quantile_cont(CAST(m.div_loss AS DOUBLE), 0.5) AS med_div_loss, avg(m.tot_loss) AS avg_tot_loss, quantile_cont(CAST(m.tot_loss AS DOUBLE), 0.5) AS med_tot_loss
        FROM bm m JOIN {{crosswalk}} c ON m.batiment_id = c.batiment_id JOIN bm r ON r.batiment_id = m.batiment_id AND r.mode = 'car' WHERE c.{_k} IS NOT NULL GROUP BY c.{_k}, m.mode""",
        f"territory_{_level}",
    )(lambda get, level=_level: matrix.territory_aggregates(_building(get, True), get("crosswalk"), level, "car", CLUSTERS))


# gains

_GAIN = f"""SELECT t.batiment_id, t.TYPEQU, 'transit_gain' AS mode, w.tt_nearest IS NOT NULL AS walk_available, w.tt_nearest - t.travel_time_p1 AS time_gain_p1, w.tt_nearest - t.travel_time_p50 AS time_gain_p50,
  {", ".join(f"CAST(t.count_{r} - coalesce(w.count_{r}, 0) AS INT) AS count_gain_{r}_p1, CAST(t.count_{r}_p50 - coalesce(w.count_{r}, 0) AS INT) AS count_gain_{r}_p50" for r in RUNGS)}
  FROM ({_TRANSIT}) t LEFT JOIN (SELECT * FROM {{matrix}} WHERE mode = 'walk') w ON t.batiment_id = w.batiment_id AND t.TYPEQU = w.TYPEQU"""


def _gains(get):
    return matrix.transit_gains(matrix_transit(get), _matrix(get).where("mode = 'walk'"))


query(_GAIN, "transit_gain")(_gains)


@query("SELECT v AS violation, CAST(0 AS BIGINT) AS n FROM (VALUES ('mode'), ('time_gain'), ('whole'), ('duplicate_key')) t(v)")
def validate_gain_report(get):
    return gain_report(_gains(get))


_ODD_GAINS = """SELECT batiment_id, TYPEQU, CASE WHEN k % 13 = 0 THEN 'walk' ELSE mode END AS mode, CASE WHEN k % 5 = 0 THEN NOT walk_available WHEN k % 23 = 0 THEN NULL ELSE walk_available END AS walk_available, time_gain_p1, time_gain_p50,
  CASE WHEN k % 7 = 0 THEN NULL ELSE count_gain_5_p1 END AS count_gain_5_p1, count_gain_10_p1, count_gain_15_p1, count_gain_20_p1, count_gain_5_p50, count_gain_10_p50, count_gain_15_p50, count_gain_20_p50 FROM (SELECT *, CAST(batiment_id AS INT) AS k FROM {g}) x"""


@query(f"""WITH o AS ({_ODD_GAINS.format(g=f"({_GAIN}) y")} UNION ALL SELECT batiment_id, TYPEQU, mode, walk_available, time_gain_p1, time_gain_p50, {", ".join(f"count_gain_{r}_{p}" for p in ("p1", "p50") for r in RUNGS)} FROM ({_GAIN}) z WHERE CAST(batiment_id AS INT) % 19 = 0)
  SELECT 'mode' AS violation, CAST(count(CASE WHEN mode <> 'transit_gain' THEN 1 END) AS BIGINT) AS n FROM o
  UNION ALL SELECT 'time_gain', CAST(count(CASE WHEN (time_gain_p1 IS NULL) = coalesce(walk_available, false) OR (time_gain_p50 IS NULL) = coalesce(walk_available, false) THEN 1 END) AS BIGINT) FROM o
  UNION ALL SELECT 'whole', CAST(count(CASE WHEN count_gain_5_p1 IS NULL THEN 1 END) AS BIGINT) FROM o
  UNION ALL SELECT 'duplicate_key', CAST(count(*) AS BIGINT) FROM (SELECT 1 FROM o GROUP BY batiment_id, TYPEQU HAVING count(*) > 1) d""")
def validate_gain_rules(get):
    """Every rule of the gains broken by some rows, and some keys given twice."""
    rows = _gains(get)
    odd = rows.sparkSession.sql(_ODD_GAINS, g=rows)
    return gain_report(odd.unionByName(rows.where("CAST(batiment_id AS INT) % 19 = 0").select(odd.columns)))


# the address table


@query("SELECT batiment_id, TYPEQU, tt_nearest AS nearest_bike, " + ", ".join(f"count_{r} AS count_{r}_bike" for r in RUNGS) + " FROM {matrix} WHERE mode = 'bike'")
def normalize_atomic(get):
    return monolith.normalise_atomic(_matrix(get).where("mode = 'bike'"), "bike")


_NGAIN = "SELECT batiment_id, TYPEQU, walk_available AS transit_gain_walk_available, time_gain_p1 AS transit_gain_time_p1, time_gain_p50 AS transit_gain_time_p50, " + ", ".join(f"count_gain_{r}_{p} AS transit_gain_count_{r}_{p}" for p in ("p1", "p50") for r in RUNGS) + f" FROM ({_GAIN}) g"


@query(_NGAIN)
def normalize_gain(get):
    return monolith.normalise_gains(_gains(get))


@query("SELECT DISTINCT o_custkey AS k, o_orderstatus AS v FROM {orders}")
def collapse_rows(get):
    once = get("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v"))
    return monolith.collapse(once.unionByName(once), ["k"])


@query("SELECT o_custkey AS k, CAST(count(DISTINCT coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END, '~')) AS BIGINT) AS n_versions FROM {orders} GROUP BY 1 HAVING count(DISTINCT coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END, '~')) > 1")
def collapse_conflicts(get):
    v = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))
    return monolith.conflicts(get("orders").select(F.col("o_custkey").alias("k"), v.alias("v")), ["k"])


_FAMILY = "SELECT batiment_id AS address_id, TYPEQU, tt_nearest AS nearest_{m}, " + ", ".join(f"count_{r} AS count_{r}_{{m}}" for r in RUNGS) + " FROM {{matrix}} WHERE mode = '{m}'"
_WIDE = "SELECT coalesce(w.address_id, b.address_id) AS address_id, coalesce(w.TYPEQU, b.TYPEQU) AS TYPEQU, nearest_walk, nearest_bike, " + ", ".join(f"count_{r}_{m}" for m in ("walk", "bike") for r in RUNGS) + f" FROM ({_FAMILY.format(m='walk')}) w FULL JOIN ({_FAMILY.format(m='bike')}) b ON w.address_id = b.address_id AND w.TYPEQU = b.TYPEQU"


@query(_WIDE)
def monolith_upsert(get):
    rows = _matrix(get).withColumnRenamed("batiment_id", "address_id")
    return monolith.merge([monolith.normalise_atomic(rows.where(f"mode = '{m}'"), m) for m in ("walk", "bike")], strict=True)


@query("""SELECT k AS address_id, t AS TYPEQU, max(nw) AS nearest_walk, CASE WHEN min(av) <> max(av) AND max(nw) IS NOT NULL THEN max(CASE WHEN nw IS NOT NULL THEN av END) ELSE max(av) END = 1 AS transit_gain_walk_available,
  CASE WHEN min(av) <> max(av) AND max(nw) IS NOT NULL THEN max(CASE WHEN nw IS NOT NULL THEN g END) ELSE max(g) END AS transit_gain_count_5_p1
  FROM (SELECT o_custkey AS k, o_orderstatus AS t, CASE WHEN o_orderkey % 2 = 0 THEN CAST(7 AS DOUBLE) END AS nw, CAST(o_orderkey % 2 = 0 AS INT) AS av, CAST(o_orderkey % 2 AS INT) + 3 AS g FROM {orders}) x GROUP BY 1, 2""")
def monolith_gain_preference(get):
    even = F.col("o_orderkey") % 2 == 0
    rows = get("orders").select(F.col("o_custkey").alias("address_id"), F.col("o_orderstatus").alias("TYPEQU"), F.when(even, 7.0).alias("nearest_walk"), even.alias("transit_gain_walk_available"), ((F.col("o_orderkey") % 2).cast("int") + 3).alias("transit_gain_count_5_p1"))
    return monolith.merge([rows.where(even), rows.where(~even)], strict=True)


_BASE = "SELECT a.address_id, m.* EXCLUDE (batiment_id) FROM ({rows}) m JOIN {{monolith_addresses}} a ON a.routing_source = 'existing' AND a.routing_point_id = 'p' || m.batiment_id"


@query("SELECT a.address_id, m.TYPEQU, m.mode, m.tt_nearest, m.count_5, m.count_10, m.count_15, m.count_20 FROM {matrix} m JOIN {monolith_addresses} a ON a.routing_source = 'existing' AND a.routing_point_id = 'p' || m.batiment_id")
def project_base(get):
    return monolith.project_base(_matrix(get), get("origin_link"), get("monolith_addresses"))


@query("SELECT 'a' || m.batiment_id AS address_id, m.TYPEQU, m.tt_nearest FROM {matrix} m JOIN {monolith_addresses} a ON a.routing_source = 'reroute' AND a.address_id = 'a' || m.batiment_id WHERE mode = 'walk'")
def project_reroute(get):
    rows = _matrix(get).where("mode = 'walk'").select(F.concat(F.lit("a"), "batiment_id").alias("batiment_id"), "TYPEQU", "tt_nearest")
    return monolith.project_reroute(rows, get("monolith_addresses"))


_FINAL_COUNTS = [f"count_{r}_{m}" for m in ATOMIC for r in RUNGS] + [f"transit_gain_count_{r}_{p}" for p in ("p1", "p50") for r in RUNGS]
_FINAL_SIDE = f"""k AS (SELECT DISTINCT batiment_id, TYPEQU FROM {{matrix}} WHERE mode <> 'transit' UNION SELECT batiment_id, TYPEQU FROM gn),
  {", ".join(f"f{m} AS (SELECT * FROM {{matrix}} WHERE mode = '{m}')" for m in ATOMIC)}"""


@query(f"""WITH gn AS ({_NGAIN}), {_FINAL_SIDE}
  SELECT a.address_id, a.lon, a.lat, a.n_non_dependance_constructions AS n_linked_constructions, a.n_residential_groups AS n_linked_groups, a.routing_source, k.TYPEQU,
  {", ".join(f"f{m}.tt_nearest AS nearest_{m}" for m in ATOMIC)}, {", ".join(f"coalesce(f{m}.count_{r}, 0) AS count_{r}_{m}" for m in ATOMIC for r in RUNGS)},
  coalesce(gn.transit_gain_walk_available, false) AS transit_gain_walk_available, gn.transit_gain_time_p1, gn.transit_gain_time_p50, {", ".join(f"coalesce(gn.transit_gain_count_{r}_{p}, 0) AS transit_gain_count_{r}_{p}" for p in ("p1", "p50") for r in RUNGS)}
  FROM k JOIN {{monolith_addresses}} a ON a.routing_source = 'existing' AND a.routing_point_id = 'p' || k.batiment_id
  {" ".join(f"LEFT JOIN f{m} ON f{m}.batiment_id = k.batiment_id AND f{m}.TYPEQU = k.TYPEQU" for m in ATOMIC)} LEFT JOIN gn ON gn.batiment_id = k.batiment_id AND gn.TYPEQU = k.TYPEQU""")
def monolith_final(get):
    return monolith.build_wide(_matrix(get), matrix_transit(get), get("origin_link"), get("monolith_addresses"))


@query("SELECT 'p' || CAST(o_custkey AS STRING) AS point_id, CAST(count(DISTINCT o_orderkey % 2) AS BIGINT) AS n_chunks FROM {orders} GROUP BY 1 HAVING count(DISTINCT o_orderkey % 2) > 1")
def chunk_overlap(get):
    return monolith.points_in_several_chunks(get("orders").select(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("point_id"), (F.col("o_orderkey") % 2).alias("chunk_id")))


# dense territory statistics


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("SELECT s.code_insee, m.TYPEQU, 'count_20_car' AS metric, CAST(m.count_20_car AS DOUBLE) AS value, CAST(count(*) AS BIGINT) AS weight FROM {metrics} m JOIN {spine} s ON m.address_id = s.address_id WHERE m.count_20_car IS NOT NULL GROUP BY 1, 2, 4")
def hist_metric(get):
    return aggregates.histogram(get("metrics"), get("spine"), ["code_insee"], ["count_20_car"])


def _dense_sql(keys, columns=METRICS, first="code_insee", where=""):
    k = ", ".join(keys)
    known = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    stats = []
    for c in columns:
        # rows whose finest key is null count as addresses but have no values at coarser levels
        v = f"coalesce(CASE WHEN {first} IS NOT NULL THEN m.{c} END, 0)"
        stats.append(f"round(avg(CAST({v} AS DOUBLE)), 6) AS {c}_mean")
        stats += [f"round(quantile_cont(CAST({v} AS DOUBLE), {p}), 6) AS {c}_p{round(100 * p)}" for p in PROBS]
        stats.append(f"round(greatest(0.0, max(CAST({v} AS DOUBLE))), 6) AS {c}_max")
        stats.append(f"round(CAST(sum(CASE WHEN {v} > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS {c}_share")
    return f"""SELECT {k}, t.TYPEQU, CAST(count(*) AS BIGINT) AS n_addresses, CAST(count(CASE WHEN {first} IS NOT NULL THEN m.{columns[0]} END) AS BIGINT) AS n_observed, {", ".join(stats)}
      FROM {{spine}} s CROSS JOIN {{types}} t LEFT JOIN {{metrics}} m ON m.address_id = s.address_id AND m.TYPEQU = t.TYPEQU WHERE {known} GROUP BY {k}, t.TYPEQU"""


@query(_dense_sql(["code_insee", "nom_commune"]))
def dense_stats(get):
    return _rounded(aggregates.dense(get("metrics"), get("spine"), get("types"), ["code_insee", "nom_commune"], METRICS, PROBS))


for _level, _keys in LEVELS.items():
    query(_dense_sql(_keys), f"dense_levels_{_level}")(lambda get, level=_level: _rounded(aggregates.dense_levels(get("metrics"), get("spine"), get("types"), METRICS, probs=PROBS)[level]))


@query("SELECT m.TYPEQU, " + ", ".join(f"round(quantile_cont(CAST(m.v AS DOUBLE), {p}), 6) AS p{round(100 * p)}" for p in PROBS) + " FROM (SELECT t.TYPEQU, coalesce(m.count_20_walk, 0) AS v FROM {spine} s CROSS JOIN {types} t LEFT JOIN {metrics} m ON m.address_id = s.address_id AND m.TYPEQU = t.TYPEQU) m GROUP BY m.TYPEQU")
def implicit_zero_quantile(get):
    values = get("metrics").where("count_20_walk is not null").groupBy("TYPEQU", F.col("count_20_walk").alias("value")).agg(F.count("*").alias("weight"))
    totals = get("types").join(F.broadcast(get("spine").agg(F.count("*").alias("n_total"))))
    return _rounded(aggregates.implicit_zero_quantiles(values, ["TYPEQU"], totals, PROBS))


@query(f"""WITH d AS ({_dense_sql(["code_insee"], ["count_20_car"], where="")}) SELECT a.code_insee, t.TYPEQU, coalesce(d.n_addresses, 0) AS n_addresses, coalesce(d.n_observed, 0) AS n_observed, d.count_20_car_mean,
  {", ".join(f"d.count_20_car_p{round(100 * p)}" for p in PROBS)}, d.count_20_car_max, d.count_20_car_share, CASE WHEN coalesce(d.n_addresses, 0) = 0 THEN 'no_address' WHEN d.n_observed = 0 THEN 'no_observation' ELSE 'observed' END AS coverage_status
  FROM (SELECT n_name AS code_insee FROM {{nation}} UNION ALL SELECT 'EMPTY') a CROSS JOIN {{types}} t LEFT JOIN d ON d.code_insee = a.code_insee AND d.TYPEQU = t.TYPEQU""")
def publish_axis(get):
    stats = aggregates.dense(get("metrics"), get("spine"), get("types"), ["code_insee"], ["count_20_car"], PROBS)
    axis = get("nation").select(F.col("n_name").alias("code_insee"))
    axis = axis.unionByName(axis.limit(1).select(F.lit("EMPTY").alias("code_insee")))
    return _rounded(aggregates.publish_axis(stats, axis, get("types"), ["code_insee"]))


# universes


@query(f"""SELECT CASE WHEN u.usage_principal_bdnb_open IS NULL THEN 'unknown_coverage' WHEN u.usage_principal_bdnb_open IN ('HOUSEHOLD', 'FURNITURE') THEN 'residential' ELSE 'non_residential' END AS usage_status,
  CAST(count(*) AS BIGINT) AS n_groups FROM {{groups}} g LEFT JOIN {{usage}} u ON g.batiment_groupe_id = u.batiment_groupe_id GROUP BY 1""")
def usage_audit(get):
    return universe.usage_audit(get("groups"), get("usage"), ["HOUSEHOLD", "FURNITURE"])


@query("SELECT batiment_groupe_id, address_id, fiabilite, ord FROM (SELECT *, row_number() OVER (PARTITION BY batiment_groupe_id ORDER BY fiabilite DESC NULLS LAST, ord) AS n FROM {relations}) x WHERE n = 1")
def best_relation(get):
    return universe.best_relation(get("relations"))


@query("SELECT batiment_construction_id, batiment_groupe_id, has_address, fictive FROM (SELECT *, row_number() OVER (PARTITION BY batiment_groupe_id ORDER BY batiment_construction_id) AS n FROM {constructions} WHERE NOT fictive) x WHERE n = 1")
def first_construction(get):
    return universe.first_construction(get("constructions"))


@query("SELECT *, count(*) OVER w >= 2 AND sum(CAST(has_address AS INT)) OVER w >= 1 AND NOT has_address AS is_dependance_candidate FROM {constructions} WINDOW w AS (PARTITION BY batiment_groupe_id)")
def dependance_flag(get):
    return universe.dependance_flags(get("constructions"))


@query("""WITH c AS (SELECT g.batiment_groupe_id, r.n FROM {groups} g LEFT JOIN (SELECT batiment_groupe_id, count(*) AS n FROM {relations} GROUP BY 1) r ON g.batiment_groupe_id = r.batiment_groupe_id)
  SELECT CAST(n AS BIGINT) AS n_addresses, CAST(count(*) AS BIGINT) AS n_groups, round_even(CAST(100 AS DOUBLE) * count(*) / (SELECT count(*) FROM c), 2) AS pct FROM c GROUP BY n""")
def group_address_metrics(get):
    return universe.group_address_metrics(get("groups"), get("relations"))


@query("""SELECT origin_id, CASE WHEN s = 'geom_adresse' THEN ax WHEN s = 'geom_cstr' OR (s = 'fictive' AND x IS NOT NULL) THEN x WHEN s IS NOT NULL THEN gx END AS x,
  CASE WHEN s = 'geom_adresse' THEN ay WHEN s = 'geom_cstr' OR (s = 'fictive' AND x IS NOT NULL) THEN y WHEN s IS NOT NULL THEN gy END AS y, s AS geometry_source
  FROM (SELECT *, CASE WHEN ax IS NOT NULL AND fiabilite >= 12 THEN 'geom_adresse' WHEN x IS NOT NULL AND fictive_cstr = 0 THEN 'geom_cstr' WHEN gx IS NOT NULL AND fictive_groupe = 0 THEN 'geom_groupe'
        WHEN x IS NOT NULL THEN 'fictive' WHEN gx IS NOT NULL THEN 'fictive' END AS s FROM {geometry_candidates}) q""")
def geometry_precedence(get):
    return get("geometry_candidates").withColumn("g", geo.resolve_geometry(12)).select("origin_id", "g.*")


_HOMES = ["HOUSEHOLD", "FURNITURE"]
_GROUPS = """own AS (SELECT g.*, u.usage_principal_bdnb_open FROM {res_groups} g JOIN {usage} u ON g.batiment_groupe_id = u.batiment_groupe_id WHERE u.usage_principal_bdnb_open IN (USAGES) AND g.code_departement_insee IN ('0', '1', '2')),
  rel AS (SELECT r.* FROM {res_relations} r JOIN own ON own.batiment_groupe_id = r.batiment_groupe_id), st AS (SELECT batiment_groupe_id, CAST(count(*) AS BIGINT) AS n_addresses, max(fiabilite) AS max_fiabilite FROM rel GROUP BY 1),
  best AS (SELECT b.batiment_groupe_id, b.fiabilite, p.x AS ax, p.y AS ay FROM (SELECT *, row_number() OVER (PARTITION BY batiment_groupe_id ORDER BY fiabilite DESC NULLS LAST, ord) AS n FROM rel) b LEFT JOIN {res_points} p ON p.address_id = b.address_id WHERE b.n = 1),
  con AS (SELECT c.* FROM {res_constructions} c JOIN own ON own.batiment_groupe_id = c.batiment_groupe_id)"""
_PLACED = """SELECT origin_id, q.batiment_groupe_id, own.code_commune_insee, own.code_departement_insee, own.usage_principal_bdnb_open, granularity, n_addresses, max_fiabilite, is_dependance_candidate,
    CASE WHEN ax IS NOT NULL AND ay IS NOT NULL AND fiabilite >= 15 THEN 'geom_adresse' WHEN q.x IS NOT NULL AND q.y IS NOT NULL AND f = 0 THEN 'geom_cstr' WHEN own.x IS NOT NULL AND own.y IS NOT NULL AND own.fictive = 0 THEN 'geom_groupe'
      WHEN q.x IS NOT NULL AND q.y IS NOT NULL AND f = 1 THEN 'fictive' WHEN own.x IS NOT NULL AND own.y IS NOT NULL AND own.fictive = 1 THEN 'fictive' END AS geometry_source, q.x AS qx, q.y AS qy, f, own.x AS gx, own.y AS gy, ax, ay
  FROM q JOIN own ON own.batiment_groupe_id = q.batiment_groupe_id LEFT JOIN st ON st.batiment_groupe_id = q.batiment_groupe_id LEFT JOIN best ON best.batiment_groupe_id = q.batiment_groupe_id"""
_RESOLVED = """SELECT origin_id, batiment_groupe_id, code_commune_insee, code_departement_insee, usage_principal_bdnb_open, granularity, n_addresses, max_fiabilite, is_dependance_candidate,
  CASE WHEN geometry_source = 'geom_adresse' THEN ax WHEN geometry_source = 'geom_cstr' OR (geometry_source = 'fictive' AND qx IS NOT NULL AND qy IS NOT NULL AND f = 1) THEN qx ELSE gx END AS x,
  CASE WHEN geometry_source = 'geom_adresse' THEN ay WHEN geometry_source = 'geom_cstr' OR (geometry_source = 'fictive' AND qx IS NOT NULL AND qy IS NOT NULL AND f = 1) THEN qy ELSE gy END AS y, geometry_source FROM w WHERE geometry_source IS NOT NULL"""


def _residential(get, **how):
    return universe.residential_universe(get("res_groups"), get("usage"), get("res_constructions"), get("res_relations"), get("res_points"), ["0", "1", "2"], min_fiabilite=15, residential=_HOMES, **how)


@query(f"""WITH {_GROUPS.replace("USAGES", "'HOUSEHOLD', 'FURNITURE'")}, q AS (
    SELECT batiment_construction_id AS origin_id, batiment_groupe_id, x, y, CAST(fictive AS INT) AS f, 'batiment_construction' AS granularity, count(*) OVER g >= 2 AND sum(CAST(has_address AS INT)) OVER g >= 1 AND NOT has_address AS is_dependance_candidate FROM con WINDOW g AS (PARTITION BY batiment_groupe_id)
    UNION ALL SELECT batiment_groupe_id, batiment_groupe_id, NULL, NULL, NULL, 'groupe', false FROM own WHERE batiment_groupe_id NOT IN (SELECT batiment_groupe_id FROM con)), w AS ({_PLACED}) {_RESOLVED} AND geometry_source <> 'fictive'""")
def residential_constructions(get):
    return _residential(get)


@query(f"""WITH {_GROUPS.replace("USAGES", "'HOUSEHOLD', 'FURNITURE'")}, c AS (SELECT *, row_number() OVER (PARTITION BY batiment_groupe_id ORDER BY batiment_construction_id) AS n FROM con WHERE NOT fictive),
  q AS (SELECT own.batiment_groupe_id AS origin_id, own.batiment_groupe_id, c.x, c.y, CASE WHEN c.n = 1 THEN 0 END AS f, 'groupe' AS granularity, false AS is_dependance_candidate FROM own LEFT JOIN c ON c.batiment_groupe_id = own.batiment_groupe_id AND c.n = 1), w AS ({_PLACED}) {_RESOLVED}""")
def residential_groups(get):
    return _residential(get, granularity="groupe", drop_fictive_only=False)


_ZONED = f"SELECT *, CASE WHEN DEP IN ('1', '2', '3') THEN 'region' WHEN distance_m < 25000 THEN 'strip' END AS zone FROM {{equipment}}"
_KEPT_EQUIPMENT = f"SELECT * FROM ({_ZONED}) z WHERE zone IS NOT NULL AND (QUALITE_GEOLOC IN ('11', '12', '21', '22', '_U') OR coalesce(length(LIBVOIE) > 0, false))"


@query(f"SELECT universe_row, zone FROM ({_ZONED}) z WHERE zone IS NOT NULL")
def zone_classify(get):
    e = get("equipment")
    return e.select("universe_row", universe.classify_zone(F.col("DEP"), F.col("distance_m"), ["1", "2", "3"]).alias("zone")).where("zone is not null")


# every point against every edge: crossings to the east, and the distance in the plane that touches the point
_METRES = "CAST(3.141592653589793 AS DOUBLE) / 180 * 6371010"
_REGION = f"""e AS (SELECT ring, lon AS x1, lat AS y1, coalesce(lead(lon) OVER (PARTITION BY ring ORDER BY ord), first_value(lon) OVER (PARTITION BY ring ORDER BY ord)) AS x2,
    coalesce(lead(lat) OVER (PARTITION BY ring ORDER BY ord), first_value(lat) OVER (PARTITION BY ring ORDER BY ord)) AS y2 FROM {{region_vertices}}),
  t AS (SELECT universe_row, (y1 > LATITUDE) <> (y2 > LATITUDE) AND LONGITUDE < (x2 - x1) * (LATITUDE - y1) / (CASE WHEN y1 <> y2 THEN y2 - y1 ELSE 1 END) + x1 AS crossed,
      (x1 - LONGITUDE) * k AS ax, (y1 - LATITUDE) * ky AS ay, (x2 - x1) * k AS dx, (y2 - y1) * ky AS dy
    FROM (SELECT *, cos(radians(LATITUDE)) * {_METRES} AS k, {_METRES} AS ky FROM {{equipment}} WHERE LONGITUDE IS NOT NULL AND LATITUDE IS NOT NULL) q, e WHERE x1 <> x2 OR y1 <> y2),
  near AS (SELECT universe_row, CASE WHEN count(CASE WHEN crossed THEN 1 END) % 2 = 1 THEN 0 ELSE min(sqrt((ax + u * dx) * (ax + u * dx) + (ay + u * dy) * (ay + u * dy))) END AS m
    FROM (SELECT *, greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), -(ax * dx + ay * dy) / (dx * dx + dy * dy))) AS u FROM t) s GROUP BY universe_row)"""


def _region_edges(get):
    return region.vertex_edges(get("region_vertices"))


@query(f"WITH {_REGION} SELECT q.universe_row, round(CASE WHEN m <= 25000 THEN m END, 3) AS distance_m FROM {{equipment}} q LEFT JOIN near n ON q.universe_row = n.universe_row", "region_distance")
def _region_distance(get):
    points = get("equipment").select("universe_row", "LONGITUDE", "LATITUDE")
    found = region.region_distance(points, _region_edges(get), lon="LONGITUDE", lat="LATITUDE")
    return found.select("universe_row", F.round("distance_m", 3).alias("distance_m"))


@query(f"""WITH {_REGION} SELECT q.universe_row, TYPEQU, CASE WHEN DEP IN ('1', '2', '3') THEN 'region' ELSE 'strip' END AS zone, round(CASE WHEN m <= 25000 THEN m END, 3) AS distance_m FROM {{equipment}} q LEFT JOIN near n ON q.universe_row = n.universe_row
  WHERE (DEP IN ('1', '2', '3') OR m < 25000) AND (QUALITE_GEOLOC IN ('11', '12', '21', '22', '_U') OR coalesce(length(LIBVOIE) > 0, false))""")
def region_universe(get):
    kept = universe.region_universe(get("equipment").drop("distance_m"), _region_edges(get), ["1", "2", "3"])
    return kept.select("universe_row", "TYPEQU", "zone", F.round("distance_m", 3).alias("distance_m"))


_KEPT = ["TYPEQU", "SIRET", "LONGITUDE", "LATITUDE", "DEP", "QUALITE_GEOLOC", "LIBVOIE", "DEPCOM", "NOMRS", "zone"]
_ORDERED = ["DEP", "DEPCOM", "TYPEQU", "SIRET", "LONGITUDE", "LATITUDE", "QUALITE_GEOLOC", "LIBVOIE", "NOMRS", "zone"]
_UNIVERSE = f"""{_REGION}, z AS (SELECT q.*, CASE WHEN DEP IN ('1', '2', '3') THEN 'region' ELSE 'strip' END AS zone FROM (
    SELECT *, DEP || '0' AS DEPCOM, CASE WHEN SIRET = '4' THEN '' ELSE 'n' END AS NOMRS FROM (SELECT * FROM {{equipment}} UNION ALL SELECT * FROM {{equipment}} WHERE universe_row % 5 = 0) d) q LEFT JOIN near n ON q.universe_row = n.universe_row
    WHERE (DEP IN ('1', '2', '3') OR (m < 25000 AND DEP IN ('4', '5', '6', '7'))) AND (QUALITE_GEOLOC IN ('11', '12', '21', '22', '_U') OR coalesce(length(LIBVOIE) > 0, false))),
  kept AS (SELECT {", ".join(_KEPT)}, row_number() OVER (ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _ORDERED)}) AS universe_row FROM z)"""


def _kept_universe(get):
    towns = get("equipment").unionByName(get("equipment").where("universe_row % 5 = 0")).drop("distance_m", "universe_row")
    towns = towns.withColumn("DEPCOM", F.concat("DEP", F.lit("0"))).withColumn("NOMRS", F.when(F.col("SIRET") == "4", "").otherwise("n"))
    kept = inputs.destination_universe(towns, _region_edges(get), ["1", "2", "3"], ["4", "5", "6", "7"])
    return kept.select("universe_row", *_KEPT)


@query(f"""WITH {_UNIVERSE}, f AS (SELECT {", ".join(_KEPT)}, min(universe_row) AS first FROM kept WHERE LONGITUDE IS NOT NULL AND LATITUDE IS NOT NULL GROUP BY ALL),
  i AS (SELECT *, printf('bpe_listing_%06d', row_number() OVER (ORDER BY first)) AS id FROM f)
  SELECT k.universe_row, i.id, i.id AS base_id, k.TYPEQU, k.SIRET, k.NOMRS, k.DEP, k.DEPCOM, k.LONGITUDE AS lon, k.LATITUDE AS lat, k.zone FROM kept k JOIN i ON {" AND ".join(f"k.{c} IS NOT DISTINCT FROM i.{c}" for c in _KEPT)}""")
def destination_registry(get):
    return inputs.destination_plan(_kept_universe(get))["registry"]


@query(f"""WITH {_UNIVERSE}, r AS (SELECT *, LONGITUDE IS NOT NULL AND LATITUDE IS NOT NULL AS there FROM kept)
  SELECT CAST(count(*) AS BIGINT) AS n_universe, CAST(count(CASE WHEN there THEN 1 END) AS BIGINT) AS n_routable, CAST(count(CASE WHEN NOT there THEN 1 END) AS BIGINT) AS n_na_coord, CAST(count(CASE WHEN zone = 'region' THEN 1 END) AS BIGINT) AS n_region,
  CAST(count(CASE WHEN zone = 'strip' THEN 1 END) AS BIGINT) AS n_strip, CAST(count(CASE WHEN SIRET IS NULL THEN 1 END) AS BIGINT) AS n_siret_na, CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT SIRET FROM kept) x) AS BIGINT) AS n_siret_shared,
  CAST(count(CASE WHEN there AND SIRET = '' THEN 1 END) AS BIGINT) AS n_empty_siret, CAST(count(DISTINCT CASE WHEN there THEN (LONGITUDE, LATITUDE) END) AS BIGINT) AS n_pts, CAST(count(DISTINCT CASE WHEN there AND SIRET = '' THEN (LONGITUDE, LATITUDE) END) AS BIGINT) AS n_empty_pts FROM r""")
def universe_facts(get):
    return inputs.universe_facts(_kept_universe(get))


@query("SELECT o_custkey AS k, CASE WHEN count(DISTINCT o_orderstatus) > 0 THEN max(o_orderstatus) END AS v FROM {orders} WHERE o_orderkey % 4 = 0 GROUP BY 1 HAVING count(DISTINCT o_orderstatus) <= 1")
def single_values(get):
    rows = get("orders").where("o_orderkey % 4 = 0").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v"))
    several = monolith.conflicts(rows, ["k"]).select("k")
    return monolith.single_values(rows.join(several, "k", "left_anti"), ["k"], "v")


def _equipment(get):
    return universe.equipment_universe(get("equipment"), F.col("distance_m"), ["1", "2", "3"])


query(_KEPT_EQUIPMENT, "geoloc_filter")(_equipment)


@query(f"SELECT DISTINCT TYPEQU FROM ({_KEPT_EQUIPMENT}) a WHERE zone = 'strip' AND TYPEQU NOT IN (SELECT TYPEQU FROM ({_KEPT_EQUIPMENT}) b WHERE zone = 'region')")
def strip_only_types(get):
    return universe.strip_only_types(_equipment(get))


_LISTED = ["TYPEQU", "SIRET", "LONGITUDE", "LATITUDE", "DEP"]
_REGISTRY = f"""WITH r AS (SELECT * FROM {{equipment}} WHERE LONGITUDE IS NOT NULL AND LATITUDE IS NOT NULL), f AS (SELECT {", ".join(_LISTED)}, min(universe_row) AS first FROM r GROUP BY ALL),
  i AS (SELECT *, printf('bpe_listing_%06d', row_number() OVER (ORDER BY first)) AS id FROM f)
  SELECT r.*, i.id FROM r JOIN i ON {" AND ".join(f"r.{c} IS NOT DISTINCT FROM i.{c}" for c in _LISTED)}"""


@query(_REGISTRY)
def listing_registry(get):
    return universe.listing_registry(get("equipment"), _LISTED)


@query(f"""SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT id) AS BIGINT) AS n_listings, CAST(count(DISTINCT (LONGITUDE, LATITUDE)) AS BIGINT) AS n_points, CAST(count(CASE WHEN coalesce(SIRET, '') = '' THEN 1 END) AS BIGINT) AS n_empty_siret,
  CAST(count(CASE WHEN zone = 'region' THEN 1 END) AS BIGINT) AS n_region, CAST(count(CASE WHEN zone = 'strip' THEN 1 END) AS BIGINT) AS n_strip
  FROM (SELECT *, CASE WHEN DEP = '1' THEN 'region' ELSE 'strip' END AS zone FROM ({_REGISTRY}) q) z""")
def destination_facts(get):
    return universe.destination_facts(universe.listing_registry(get("equipment"), _LISTED).withColumn("zone", F.when(F.col("DEP") == "1", "region").otherwise("strip")))


_ADDRESSES = """SELECT c.address_id, p.lon, p.lat, c.n_non_dependance_constructions, c.n_residential_groups, CASE WHEN e.id IS NULL THEN 'reroute' ELSE 'existing' END AS routing_source, e.id AS routing_point_id FROM
  (SELECT l.address_id, CAST(count(DISTINCT o.origin_id) AS BIGINT) AS n_non_dependance_constructions, CAST(count(DISTINCT o.batiment_groupe_id) AS BIGINT) AS n_residential_groups
   FROM {reroute_links} l JOIN {reroute_origins} o ON l.origin_id = o.origin_id WHERE o.is_dependance_candidate = false GROUP BY 1) c
  LEFT JOIN {address_points} p ON p.address_id = c.address_id LEFT JOIN {existing_points} e ON e.lon = p.lon AND e.lat = p.lat"""


@query(_ADDRESSES)
def address_universe(get):
    return universe.address_universe(get("reroute_origins"), get("reroute_links"), get("address_points"), get("existing_points"))


@query("""WITH l AS (SELECT l.address_id, o.code_commune_insee AS c, o.code_departement_insee AS d FROM {reroute_links} l JOIN {reroute_origins} o ON l.origin_id = o.origin_id)
  SELECT address_id, CASE WHEN count(DISTINCT c) = 1 THEN min(c) ELSE min(CASE WHEN c = substr(address_id, 1, 5) THEN c END) END AS code_insee,
  CASE WHEN count(DISTINCT c) = 1 THEN min(d) ELSE min(CASE WHEN c = substr(address_id, 1, 5) THEN d END) END AS code_departement FROM l GROUP BY address_id""")
def territory_crosswalk(get):
    return universe.territory_crosswalk(get("address_points"), get("reroute_links"), get("reroute_origins"), "prefix")


@query("SELECT universe_row AS id, LONGITUDE AS lon, LATITUDE AS lat FROM {equipment} WHERE LONGITUDE IS NOT NULL AND LATITUDE IS NOT NULL")
def routable_points(get):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # it tells how many are dropped
        return universe.routable(get("equipment").select(F.col("universe_row").alias("id"), F.col("LONGITUDE").alias("lon"), F.col("LATITUDE").alias("lat")), "listing")


_COMMUNES = "SELECT n_name AS code_insee, 'Commune ' || n_name AS nom_officiel, CAST(n_regionkey AS STRING) AS code_insee_du_departement, '53' AS code_insee_de_la_region, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE CAST(n_nationkey % 4 AS STRING) || '/x' END AS codes_siren_des_epci FROM {nation}"


@query("SELECT code_insee, nom_officiel AS nom_commune, code_insee_du_departement AS code_departement, code_insee_de_la_region AS region, nullif(codes_siren_des_epci, '') AS epci FROM (" + _COMMUNES + ") c WHERE code_insee_du_departement IN ('1', '2', '3')")
def commune_crosswalk(get):
    return universe.commune_crosswalk(get("nation").sparkSession.sql(_COMMUNES, nation=get("nation")), ["1", "2", "3"], strict=True)


@query("SELECT code_insee FROM (" + _COMMUNES + ") c WHERE codes_siren_des_epci LIKE '%2/x%'")
def communes_of_body(get):
    return universe.communes_of_body(get("nation").sparkSession.sql(_COMMUNES, nation=get("nation")), "2/x").select("code_insee")


@query("SELECT c.*, CASE WHEN c.epci IS NOT NULL THEN 'Body of ' || c.epci END AS nom_epci, 'Dep ' || c.code_departement AS nom_departement FROM {crosswalk} c")
def territory_names(get):
    look = lambda column, words: get("crosswalk").where(F.col(column).isNotNull()).select(F.col(column).alias("code"), F.concat(F.lit(words), column).alias("nom")).distinct()
    return universe.territory_names(get("crosswalk"), {"epci": look("epci", "Body of "), "departement": look("code_departement", "Dep ")}, strict=True)


@query("SELECT t.TYPEQU, 'Type ' || t.TYPEQU AS nom_typequ FROM {types} t")
def labelled_types(get):
    labels = get("part").select(F.col("p_brand").alias("TYPEQU"), F.concat(F.lit("Type "), "p_brand").alias("nom_typequ")).distinct()
    return publisher.labelled_types(get("types").unionByName(get("types")), labels.unionByName(labels.limit(1).select(F.lit("other").alias("TYPEQU"), "nom_typequ")))


@query("SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM {orders} GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(get):
    return duplicates(get("orders"), ["o_custkey"])


# deltas


@query("SELECT round((SELECT count(DISTINCT c.batiment_id) FROM {crosswalk} c JOIN {matrix} m ON m.batiment_id = c.batiment_id) / (SELECT sum(nb_buildings) FROM {snapshot}), 9) AS prior")
def granularity_prior(get):
    agg = matrix.territory_aggregates(_building(get, True), get("crosswalk"), "commune", "car", CLUSTERS).where("mode = 'car'")
    prior = deltas.granularity_prior(agg, get("snapshot"))
    return agg.limit(1).select(F.round(F.lit(prior), 9).alias("prior"))


def _deltas(get, accepted=None):
    agg = matrix.territory_aggregates(_building(get, True), get("crosswalk"), "commune", "car", CLUSTERS)
    return deltas.deltas(agg, get("snapshot"), nb_prior=1.2, border=["NATION_1", "NATION_2", "NATION_3"], accepted=accepted)


_D_OURS = " UNION ALL ".join(f"SELECT code_insee, '{m}' AS metric, CAST({m} AS DOUBLE) AS derived FROM agg WHERE mode = 'car'" for m in deltas.SNAPSHOT_MAP)
_D_THEIRS = " UNION ALL ".join(f"SELECT code_insee, nom_commune, '{m}' AS metric, CAST({s} AS DOUBLE) AS snapshot FROM {{snapshot}}" for m, s in deltas.SNAPSHOT_MAP.items())
_DELTAS = (
    _BUILDING
    + f""", agg AS (SELECT c.code_insee, m.mode, count(DISTINCT m.batiment_id) AS nb_buildings, {", ".join(f"avg(CAST(m.has_{n} AS INT)) AS share_{n}" for n in CLUSTERS)}, avg(CAST(m.total = 0 AS INT)) AS pct_iso_full, avg(m.diversity) AS avg_diversity, avg(m.total) AS avg_total
    FROM bm m JOIN {{crosswalk}} c ON m.batiment_id = c.batiment_id GROUP BY 1, 2), ours AS ({_D_OURS}), theirs AS ({_D_THEIRS}),
    j AS (SELECT coalesce(o.code_insee, t.code_insee) AS code_insee, coalesce(o.metric, t.metric) AS metric, t.snapshot, o.derived, o.derived - t.snapshot AS delta_abs, CASE WHEN t.snapshot <> 0 THEN (o.derived - t.snapshot) / t.snapshot END AS delta_rel
      FROM ours o FULL JOIN theirs t ON o.code_insee = t.code_insee AND o.metric = t.metric),
    k AS (SELECT j.*, n.nom_commune, CASE WHEN snapshot IS NULL OR derived IS NULL THEN 'missing' WHEN metric = 'nb_buildings' THEN CASE WHEN coalesce(abs(derived / nullif(snapshot, 0) - CAST(1.2 AS DOUBLE)) / CAST(1.2 AS DOUBLE) <= CAST(0.3 AS DOUBLE), false) THEN 'expected' ELSE 'flag' END
      WHEN (metric LIKE 'share%' OR metric = 'pct_iso_full') THEN CASE WHEN abs(delta_abs) <= CAST(0.1 AS DOUBLE) THEN 'expected' ELSE 'flag' END
      WHEN coalesce(abs(delta_rel) <= CASE WHEN metric = 'avg_total' THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END, false) THEN 'expected'
      WHEN j.code_insee IN ('NATION_1', 'NATION_2', 'NATION_3') AND coalesce(delta_rel > 0, false) THEN 'expected' ELSE 'flag' END AS classification FROM j LEFT JOIN (SELECT DISTINCT code_insee, nom_commune FROM {{snapshot}}) n ON n.code_insee = j.code_insee)"""
)


@query(_DELTAS + " SELECT code_insee, nom_commune, metric, snapshot, derived, round(delta_abs, 9) AS delta_abs, round(delta_rel, 9) AS delta_rel, classification FROM k", "deltas")
def _deltas_query(get):
    return _deltas(get).drop("reason").withColumn("delta_abs", F.round("delta_abs", 9)).withColumn("delta_rel", F.round("delta_rel", 9))


_LIMIT = "CASE WHEN metric LIKE 'share%' OR metric = 'pct_iso_full' THEN '10 points' WHEN metric = 'avg_total' THEN '40 %' WHEN metric = 'avg_diversity' THEN '25 %' ELSE '30 %' END"
_SIGNED = lambda c: f"CASE WHEN round(100 * {c}) > 0 THEN '+' ELSE '' END || CAST(CAST(round(100 * {c}) AS BIGINT) AS STRING)"
_CHANGE = f"CASE WHEN metric LIKE 'share%' OR metric = 'pct_iso_full' THEN {_SIGNED('delta_abs')} || ' points' ELSE coalesce({_SIGNED('delta_rel')} || ' %', 'from zero') END"


@query(_DELTAS + f""" SELECT k.code_insee, k.metric, CASE WHEN k.classification <> 'missing' AND f.reason IS NOT NULL THEN 'expected' ELSE k.classification END AS classification,
  CASE WHEN snapshot IS NULL THEN 'absent from the snapshot' WHEN derived IS NULL THEN 'not derived' WHEN f.reason IS NOT NULL THEN 'accepted before: ' || f.reason
    WHEN k.metric = 'nb_buildings' THEN CAST(CAST(round(100 * (derived / snapshot)) AS BIGINT) AS STRING) || ' % of the snapshot, ' || CASE WHEN k.classification = 'expected' THEN 'within ' ELSE 'beyond ' END || '30 % around the prior of 120 %'
    ELSE CASE WHEN k.classification = 'flag' THEN 'beyond ' || {_LIMIT.replace("metric", "k.metric")} || ': ' WHEN k.metric IN ('avg_diversity', 'avg_total') AND NOT abs(delta_rel) <= CASE WHEN k.metric = 'avg_total' THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END
      THEN 'beyond ' || {_LIMIT.replace("metric", "k.metric")} || ', a border commune that gained: ' ELSE 'within ' || {_LIMIT.replace("metric", "k.metric")} || ': ' END || {_CHANGE.replace("metric", "k.metric")} END AS reason
  FROM k LEFT JOIN {{findings}} f ON f.code_insee = k.code_insee AND f.metric = k.metric""")
def delta_reasons(get):
    return _deltas(get, get("findings")).select("code_insee", "metric", "classification", "reason")


@query(_DELTAS + " SELECT metric, classification, CAST(count(*) AS BIGINT) AS n FROM k GROUP BY metric, classification")
def delta_counts(get):
    return deltas.delta_counts(_deltas(get))


# timetables

_ACTIVE = """SELECT service_id FROM (SELECT service_id FROM {calendar} WHERE wednesday = '1' AND start_date <= '20260916' AND end_date >= '20260916'
  EXCEPT SELECT service_id FROM {calendar_dates} WHERE replace(date, '-', '') = '20260916' AND exception_type = '2') x UNION SELECT service_id FROM {calendar_dates} WHERE replace(date, '-', '') = '20260916' AND exception_type = '1'"""


def _active(get):
    return gtfs.active_services(get("calendar"), get("calendar_dates"), DATE)


query(_ACTIVE, "gtfs_active_services")(_active)


@query(f"""WITH t AS (SELECT DISTINCT trip_id FROM {{trips}} WHERE service_id IN ({_ACTIVE})),
  c AS (SELECT s.*, CASE WHEN CAST(substr(departure_time, 4, 2) AS INT) < 60 THEN CAST(substr(departure_time, 1, 2) AS INT) * 3600 + CAST(substr(departure_time, 4, 2) AS INT) * 60 END AS secs FROM {{stop_times}} s WHERE trip_id IN (SELECT trip_id FROM t))
  SELECT (SELECT CAST(count(*) AS BIGINT) FROM t) AS n_active_trips, CAST(count(DISTINCT CASE WHEN secs >= 36000 AND secs < 39600 THEN trip_id END) AS BIGINT) AS n_window_trips, CAST(count(DISTINCT stop_id) AS BIGINT) AS n_active_stops FROM c""")
def gtfs_activity(get):
    return gtfs.activity(_active(get), get("trips"), get("stop_times"))


@query(f"SELECT service_id, date, exception_type FROM {{calendar_dates}} WHERE replace(date, '-', '') <> '20260917' UNION ALL SELECT service_id, '20260917', '1' FROM ({_ACTIVE}) a")
def gtfs_project(get):
    return gtfs.project_services(get("calendar_dates"), _active(get), "20260917")


@query("SELECT stop_id, parent_station FROM {stops} WHERE parent_station IS NOT NULL AND parent_station <> '' AND parent_station NOT IN (SELECT stop_id FROM {stops})")
def gtfs_parent_orphans(get):
    return gtfs.parent_orphans(get("stops"))


@query("SELECT * FROM {stop_times} WHERE trip_id NOT IN (SELECT trip_id FROM {trips} t JOIN {routes} r ON t.route_id = r.route_id WHERE r.route_type = '715')")
def route_type_cascade(get):
    return gtfs.route_type_cascade(get("routes"), get("trips"), get("stop_times"))["stop_times"]


@query("""SELECT * FROM {trips} WHERE route_id NOT IN (SELECT route_id FROM {routes} WHERE route_id IN ('3', '4') OR lower(route_short_name) LIKE 'p%') AND NOT lower(trip_headsign) LIKE '%renfort scol'""")
def school_filter(get):
    return gtfs.school_filter(get("routes"), get("trips"), "demo", POLICY)[1]


@query("SELECT 'gtfsx_' || n_name AS id FROM {nation} WHERE n_nationkey % 3 <> 0 AND n_name NOT IN ('NATION_1', 'NATION_2')")
def feed_selection(get):
    feeds = get("nation").select(F.concat(F.lit("gtfsx_"), "n_name").alias("id"), F.when(F.col("n_nationkey") % 3 != 0, F.array(F.lit("r5r-transit"))).otherwise(F.array(F.lit("audit"))).alias("readers"), F.lit("x").alias("pin_key_role"))
    return gtfs.select_feeds(feeds, "derived", ["gtfsx_NATION_1", "gtfsx_NATION_2"]).select("id")


# publishing and reroutes


@query(f"""WITH r AS (SELECT sha256('lat=' || '''' || CAST(CAST(ord AS BIGINT) % 7 AS STRING) || '|lon=' || '''' || CAST(CAST(ord AS BIGINT) AS STRING) || '|name=' || CASE WHEN CAST(ord AS BIGINT) % 5 = 0 THEN '-' ELSE '''' || id END) AS h FROM {{origins}}),
  {_TREE}""")
def table_fingerprint(get):
    o = get("origins").select(F.when(F.col("ord") % 5 != 0, F.col("id")).alias("name"), F.col("ord").alias("lon"), (F.col("ord") % 7).alias("lat"))
    return routing.table_fingerprint(o)


for _level, _keys in LEVELS.items():
    _by = ", ".join(f"a.{k}" for k in _keys)
    _on = " AND ".join(f"d.{k} = a.{k}" for k in _keys)

    def _published(get, level=_level, keys=tuple(_keys)):
        labels = get("types").select("TYPEQU", F.concat(F.lit("Type "), "TYPEQU").alias("nom_typequ"))
        axis = get("spine").select(*keys).dropna("any").distinct()
        extra = axis.limit(1).select(*[F.lit("EMPTY").alias(k) for k in keys])
        return _rounded(publisher.level_table(get("metrics"), get("spine"), get("types"), labels, axis.unionByName(extra), level, METRICS, PROBS, strict=False))

    query(
        f"""WITH d AS ({_dense_sql(_keys)}) SELECT {_by}, t.TYPEQU, 'Type ' || t.TYPEQU AS nom_typequ, coalesce(d.n_addresses, 0) AS n_addresses, coalesce(d.n_observed, 0) AS n_observed,
  d.* EXCLUDE ({", ".join(_keys)}, TYPEQU, n_addresses, n_observed), CASE WHEN coalesce(d.n_addresses, 0) = 0 THEN 'no_address' WHEN d.n_observed = 0 THEN 'no_observation' ELSE 'observed' END AS coverage_status
  FROM (SELECT DISTINCT {", ".join(_keys)} FROM {{spine}} WHERE {" AND ".join(f"{k} IS NOT NULL" for k in _keys)} UNION ALL SELECT {", ".join("'EMPTY'" for _ in _keys)}) a CROSS JOIN {{types}} t LEFT JOIN d ON {_on} AND d.TYPEQU = t.TYPEQU""",
        f"published_{_level}",
    )(_published)


@query("""WITH o AS (SELECT * FROM {reroute_origins} WHERE code_departement_insee IN ('1', '2') AND NOT coalesce(is_dependance_candidate, true)),
  c AS (SELECT l.address_id, count(DISTINCT o.origin_id) AS nc, count(DISTINCT o.batiment_groupe_id) AS ng FROM {reroute_links} l JOIN o ON l.origin_id = o.origin_id GROUP BY 1)
  SELECT c.address_id, p.lon, p.lat, CAST(nc AS BIGINT) AS n_non_dependance_constructions, CAST(ng AS BIGINT) AS n_residential_groups, CASE WHEN e.id IS NULL THEN 'reroute' ELSE 'existing' END AS routing_source, e.id AS routing_point_id
  FROM c LEFT JOIN {address_points} p ON p.address_id = c.address_id LEFT JOIN {existing_points} e ON e.lon = p.lon AND e.lat = p.lat""")
def reroute_inputs(get):
    return reroute.reroute_inputs(get("reroute_origins"), get("reroute_links"), get("address_points"), get("existing_points"), ["1", "2"])


@query("SELECT DISTINCT l.point_id FROM {matrix} m JOIN {origin_link} l ON l.id = m.batiment_id WHERE m.mode = 'car' AND m.count_5 > 0")
def base_points(get):
    return monolith.base_point_ids(_matrix(get).where("mode = 'car' and count_5 > 0"), get("origin_link"))


@query("SELECT * FROM (SELECT o.from_id, o.to_id, o.mode, 'raw' AS view, o.travel_time FROM {pairs} o UNION ALL SELECT from_id, to_id, mode, 'collapsed', travel_time FROM {collapsed}) x WHERE mode = 'bike'")
def pair_views(get):
    raw, collapsed = matrix.pair_views(get("pairs").where("mode = 'bike'"), ["from_id", "to_id", "mode"])
    columns = lambda df, name: df.select("from_id", "to_id", "mode", F.lit(name).alias("view"), "travel_time")
    return columns(raw, "raw").unionByName(columns(collapsed, "collapsed"))


# set operations


@query("SELECT o_custkey AS k FROM {orders} WHERE o_orderkey % 2 = 0 UNION SELECT c_custkey FROM {customer} WHERE c_custkey % 3 = 0")
def set_union(get):
    return get("orders").where("o_orderkey % 2 = 0").select(F.col("o_custkey").alias("k")).union(get("customer").where("c_custkey % 3 = 0").select("c_custkey")).distinct()


@query("SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey FROM {orders} WHERE o_orderkey % 9 = 0")
def set_except(get):
    return get("customer").select(F.col("c_custkey").alias("k")).subtract(get("orders").where("o_orderkey % 9 = 0").select("o_custkey"))


@query("SELECT c_custkey AS k FROM {customer} WHERE c_custkey % 2 = 0 INTERSECT SELECT o_custkey FROM {orders}")
def set_intersect(get):
    return get("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")).intersect(get("orders").select("o_custkey"))


@query("SELECT c_custkey AS k, c_mktsegment AS a, NULL AS b FROM {customer} UNION ALL SELECT s_suppkey, NULL, s_name FROM {supplier}")
def set_union_fill(get):
    left = get("customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("a"))
    return left.unionByName(get("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("b")), allowMissingColumns=True)


# geometry and archives: rows only


@query()
def lambert93(get):
    o = get("origins")
    return o.select("id", geo.lambert93_to_wgs84(F.lit(700000.0) + F.col("ord") * 10, F.lit(6600000.0) - F.col("ord") * 7).alias("p")).select("id", "p.*")


@query()
def wkt_centroid(get):
    x, y = F.col("ord").cast("string"), (F.col("ord") % 10).cast("string")
    wkt = F.concat(F.lit("POLYGON(("), x, F.lit(" "), y, F.lit(","), x, F.lit(" 20,"), F.lit("99999 20,"), F.lit("99999 "), y, F.lit(","), x, F.lit(" "), y, F.lit("))"))
    return get("origins").select("id", geo.wkt_centroid(wkt).alias("c")).select("id", "c.*")


@query()
def strip_distance(get):
    ring = [(-1.4, 48.1), (-1.2, 48.1), (-1.2, 48.3), (-1.4, 48.3)]
    return get("origins").select("id", geo.distance_to_ring_m(F.col("lon"), F.col("lat"), ring).alias("distance_m"))


def zip_members(spark, sf_dir):
    """A timetable archive written and read back; the table is small by its nature."""
    text = _bytes.StringIO()
    text.write("﻿service_id,wednesday\n")
    for r in frame(spark, sf_dir, "calendar").orderBy("service_id").collect():
        text.write(f"{r.service_id},{r.wednesday}\n")
    rows = []
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "feed.zip")
        io.write_zip({"feed/Calendar.txt": text.getvalue().encode()}, path)
        rows = io.read_zip_member(spark, path, "calendar.txt").collect()
    return spark.createDataFrame(rows, "service_id string, wednesday string")


_QUERIES["zip_members"] = zip_members


def _folder(spark, prefix):
    """A new folder that driver and executors share; it goes when the driver ends."""
    parent = (spark.sparkContext.getConf().get("spark.checkpoint.dir") or "").removeprefix("file:") or None
    if parent and "://" in parent.removeprefix("//"):
        raise ContractError(f"a mounted folder is needed, not {parent}")
    if parent:
        os.makedirs(parent, exist_ok=True)
    elif not spark.sparkContext.master.startswith("local"):
        raise ContractError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix=prefix, dir=parent)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def resume_runner(spark, sf_dir):
    """A run of several chunks that stops after one and is taken up again; its matrix is that of one pass."""
    origins, destinations, types = (frame(spark, sf_dir, n) for n in ("origins", "destinations", "dest_map"))
    folder = _folder(spark, "run-")
    size = max(1, -(-origins.select("lon", "lat").distinct().count() // 3))
    for limit in (1, None):
        run = Run(folder, origins, destinations, types, modes=["car"], chunk_size=size)
        run.execute(limit)
    return run.matrix(strict=True).select("batiment_id", "TYPEQU", F.lit("car").alias("mode"), "tt_nearest", *[f"count_{r}" for r in RUNGS])


def _feed_lines(spark, sf_dir):
    """Timetables of several feeds, written as archives and read again."""
    get = lambda n: frame(spark, sf_dir, n)
    members = (("calendar.txt", "feed_calendar", ["service_id"]), ("calendar_dates.txt", "feed_dates", ["service_id", "date"]), ("routes.txt", "feed_routes", ["route_id"]), ("trips.txt", "feed_trips", ["trip_id"]), ("stop_times.txt", "feed_stop_times", ["trip_id", "stop_sequence"]))
    folder = _folder(spark, "feeds-")
    timetables.write_members([(get(table), member, order) for member, table, order in members], folder)
    return timetables.archives(spark, folder), folder


def feed_set_summary(spark, sf_dir):
    return feeds.summary(_feed_lines(spark, sf_dir)[0], DATE)


def feed_set_projected(spark, sf_dir):
    """The services of one date moved to another, in archives of their own; what runs there then is what ran before."""
    lines, folder = _feed_lines(spark, sf_dir)
    timetables.write_timetables(feeds.project(lines, DATE, "20260917"), f"{folder}/projected")
    return feeds.summary(timetables.archives(spark, f"{folder}/projected"), "20260917")


def feed_set_cascade(spark, sf_dir):
    lines = feeds.without_route_types(_feed_lines(spark, sf_dir)[0])
    return lines.groupBy("feed_id", "member").agg(F.count("*").alias("n_lines"))


# readers and writers: files made of the tables, read again


def snapshot_file(spark, sf_dir):
    """The snapshot as a delimited file whose codes lost their zeros, of some communes only."""
    get, folder = (lambda n: frame(spark, sf_dir, n)), _folder(spark, "files-")
    columns = list(deltas.SNAPSHOT_MAP.values())
    rows = get("customer").select(F.col("c_custkey").alias("code_insee"), F.col("c_name").alias("nom_commune"), *[(F.col("c_custkey") % (i + 2) / 2).alias(c) for i, c in enumerate(columns)])
    rows.write.option("header", True).csv(f"{folder}/snapshot")
    return io.read_snapshot(spark, f"{folder}/snapshot", columns, [f"{i:05}" for i in range(0, 100, 3)])


def nomenclature_file(spark, sf_dir):
    get, folder = (lambda n: frame(spark, sf_dir, n)), _folder(spark, "files-")
    get("types").select("TYPEQU", F.concat(F.lit("Type; "), "TYPEQU").alias("LIB"), F.lit("x").alias("UNREAD")).write.option("header", True).csv(f"{folder}/types")
    return io.read_nomenclature(spark, f"{folder}/types")


def equipment_file(spark, sf_dir):
    """The equipment table as a wide delimited file, of which the columns of the contract are read."""
    get, folder = (lambda n: frame(spark, sf_dir, n)), _folder(spark, "files-")
    rows = get("equipment")
    wide = rows.select(*[F.col(c).cast("string").alias(c) if c in rows.columns else F.lit("_Z" if c.startswith("LAMBERT") else "x").alias(c) for c in io.EQUIPMENT_COLUMNS], F.lit("y").alias("OTHER"))
    wide.write.option("header", True).option("sep", ";").option("emptyValue", "").csv(f"{folder}/bpe")
    return io.read_equipment(spark, f"{folder}/bpe").select("TYPEQU", "SIRET", "DEP", "QUALITE_GEOLOC", "LONGITUDE", "LATITUDE", "LAMBERT_X")


def pair_files(spark, sf_dir):
    """Raw pairs written chunk by chunk, one chunk twice: the second time replaces the first."""
    get, folder = (lambda n: frame(spark, sf_dir, n)), _folder(spark, "files-")
    pairs = get("pairs").where("mode = 'bike'").withColumn("n", F.pmod(F.col("from_id").cast("int"), F.lit(2)))
    for n in (0, 1, 0):
        io.write_pairs(pairs.where(F.col("n") == n), f"{folder}/pairs", "bike", n, "run")
    return spark.read.parquet(f"{folder}/pairs").select("from_id", "to_id", "travel_time", "run_label", "mode", "chunk_id")


def checkpoint_parts(spark, sf_dir):
    """Parts of a table by departement, one of them written again, read as one with its key checked."""
    get, folder = (lambda n: frame(spark, sf_dir, n)), _folder(spark, "files-")
    rows = get("monolith_addresses").withColumn("part_of", F.pmod(F.xxhash64("address_id"), F.lit(3)))
    for part in (0, 1, 2, 1):
        io.write_checkpoint(rows.where(F.col("part_of") == part).drop("part_of"), f"{folder}/parts", str(part))
    return io.read_checkpoint(spark, f"{folder}/parts", ["address_id"])


def cached_table(spark, sf_dir):
    """A table kept under a key: the second call reads what the first one made."""
    get, folder = (lambda n: frame(spark, sf_dir, n)), _folder(spark, "files-")
    make = [lambda: get("spine"), lambda: get("spine").limit(0)]
    for once in make:
        kept = io.cached(spark, folder, {"table": "spine"}, once)
    return kept


def run_gains(spark, sf_dir):
    """The gains of a run of several chunks, taken up after one of them was made anew."""
    origins, destinations, types = (frame(spark, sf_dir, n) for n in ("origins", "destinations", "dest_map"))
    folder = _folder(spark, "run-")
    noon = datetime.datetime(2026, 9, 16, 10, tzinfo=datetime.timezone.utc)
    size = max(1, -(-origins.select("lon", "lat").distinct().count() // 3))
    make = lambda: Run(folder, origins, destinations, types, modes=["walk", "transit"], chunk_size=size, departure=noon)
    run = make()
    run.execute()
    run.gains()
    shutil.rmtree(run.chunk_path("walk", 2), ignore_errors=True)
    run = make()
    run.execute()
    return run.gains().drop("chunk_id")


_QUERIES |= {f.__name__: f for f in (snapshot_file, nomenclature_file, equipment_file, pair_files, checkpoint_parts, cached_table, run_gains)}
_SNAPSHOT_COLUMNS = ", ".join(f"CAST(c_custkey % {i + 2} AS DOUBLE) / 2 AS {c}" for i, c in enumerate(deltas.SNAPSHOT_MAP.values()))
_WALK = _ROUTE.replace("/ 30 * 60", "/ 4 * 60")
_SQL |= {
    "snapshot_file": as_query(f"SELECT lpad(CAST(c_custkey AS STRING), 5, '0') AS code_insee, c_name AS nom_commune, {_SNAPSHOT_COLUMNS} FROM {{customer}} WHERE c_custkey < 100 AND c_custkey % 3 = 0"),
    "nomenclature_file": as_query("SELECT TYPEQU, 'Type; ' || TYPEQU AS nom_typequ FROM {types}"),
    "equipment_file": as_query("SELECT TYPEQU, SIRET, DEP, QUALITE_GEOLOC, LONGITUDE, LATITUDE, CAST(NULL AS DOUBLE) AS LAMBERT_X FROM {equipment}"),
    "pair_files": as_query("SELECT from_id, to_id, CAST(travel_time AS DOUBLE) AS travel_time, 'run' AS run_label, mode, CAST(CAST(from_id AS INT) % 2 AS INT) AS chunk_id FROM {pairs} WHERE mode = 'bike'"),
    "checkpoint_parts": as_query("SELECT * FROM {monolith_addresses}"),
    "cached_table": as_query("SELECT * FROM {spine}"),
    "run_gains": as_query(f"""WITH w AS (SELECT p.from_id AS batiment_id, d.TYPEQU, CAST(min(travel_time) AS DOUBLE) AS tt_nearest, {_ladder('travel_time')} FROM ({_WALK}) p JOIN {{dest_map}} d ON p.to_id = d.id WHERE travel_time <= 20 GROUP BY 1, 2),
      t AS (SELECT p.from_id AS batiment_id, d.TYPEQU, CAST(min(travel_time) AS DOUBLE) AS p1, CAST(min(travel_time + 5) AS DOUBLE) AS p50, {_ladder('travel_time')}, {_ladder('(travel_time + 5)', '_p50')} FROM ({_ROUTE}) p JOIN {{dest_map}} d ON p.to_id = d.id WHERE travel_time <= 20 GROUP BY 1, 2)
      SELECT t.batiment_id, t.TYPEQU, 'transit_gain' AS mode, w.tt_nearest IS NOT NULL AS walk_available, w.tt_nearest - t.p1 AS time_gain_p1, w.tt_nearest - t.p50 AS time_gain_p50,
      {", ".join(f"CAST(t.count_{r} - coalesce(w.count_{r}, 0) AS INT) AS count_gain_{r}_p1, CAST(t.count_{r}_p50 - coalesce(w.count_{r}, 0) AS INT) AS count_gain_{r}_p50" for r in RUNGS)} FROM t LEFT JOIN w ON w.batiment_id = t.batiment_id AND w.TYPEQU = t.TYPEQU"""),
}


def stored_upsert(spark, sf_dir):
    """Walking times are stored, then biking times are merged into the buckets of their addresses."""
    rows = _matrix(lambda n: frame(spark, sf_dir, n)).withColumnRenamed("batiment_id", "address_id")
    table = StoredTable(spark, _folder(spark, "stored-"), "address_id", 16)
    for mode in ("walk", "bike"):
        monolith.upsert_stored(table, [monolith.normalise_atomic(rows.where(f"mode = '{mode}'"), mode)])
    return table.read()


def incremental_matrix(spark, sf_dir):
    """Pairs that come in three batches, so that most origins come again, and the matrix that is kept up to date."""
    get = lambda n: frame(spark, sf_dir, n)
    folder, pairs = _folder(spark, "stream-"), get("pairs").withColumn("travel_time", F.col("travel_time").cast("double"))
    for n in range(3):
        pairs.where(F.pmod(F.xxhash64("to_id", "travel_time"), F.lit(3)) == n).write.mode("append").parquet(f"{folder}/in")
        incremental.derive_new_pairs(spark, f"{folder}/in", "from_id string, to_id string, mode string, travel_time double", get("dest_map"), f"{folder}/out", f"{folder}/checkpoint", 16)
    return incremental.stored_matrix(spark, f"{folder}/out")


_QUERIES |= {"resume_runner": resume_runner, "stored_upsert": stored_upsert, "incremental_matrix": incremental_matrix}
_QUERIES |= {f.__name__: f for f in (feed_set_summary, feed_set_projected, feed_set_cascade)}
_FEEDS = """WITH a AS (SELECT feed_id, service_id FROM (SELECT feed_id, service_id FROM {feed_calendar} WHERE wednesday = '1' AND start_date <= '20260916' AND end_date >= '20260916'
    EXCEPT SELECT feed_id, service_id FROM {feed_dates} WHERE replace(date, '-', '') = '20260916' AND exception_type = '2') x UNION SELECT feed_id, service_id FROM {feed_dates} WHERE replace(date, '-', '') = '20260916' AND exception_type = '1'),
  t AS (SELECT DISTINCT t.feed_id, t.trip_id FROM {feed_trips} t JOIN a ON a.feed_id = t.feed_id AND a.service_id = t.service_id),
  c AS (SELECT s.*, CASE WHEN CAST(substr(departure_time, 4, 2) AS INT) < 60 THEN CAST(substr(departure_time, 1, 2) AS INT) * 3600 + CAST(substr(departure_time, 4, 2) AS INT) * 60 END AS secs FROM {feed_stop_times} s JOIN t ON t.feed_id = s.feed_id AND t.trip_id = s.trip_id),
  n AS (SELECT feed_id, count(*) AS n FROM t GROUP BY 1), m AS (SELECT feed_id, count(DISTINCT CASE WHEN secs >= 36000 AND secs < 39600 THEN trip_id END) AS w, count(DISTINCT stop_id) AS s FROM c GROUP BY 1)
  SELECT f.feed_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_active_trips, CAST(coalesce(m.w, 0) AS BIGINT) AS n_window_trips, CAST(coalesce(m.s, 0) AS BIGINT) AS n_active_stops
  FROM (SELECT feed_id FROM {feed_trips} UNION SELECT feed_id FROM {feed_calendar} UNION SELECT feed_id FROM {feed_dates}) f LEFT JOIN n ON n.feed_id = f.feed_id LEFT JOIN m ON m.feed_id = f.feed_id"""
_CASCADE = """WITH g AS (SELECT feed_id, route_id FROM {feed_routes} WHERE route_type = '715'), t AS (SELECT t.* FROM {feed_trips} t LEFT JOIN g ON g.feed_id = t.feed_id AND g.route_id = t.route_id WHERE g.feed_id IS NULL)
  SELECT feed_id, member, CAST(count(*) AS BIGINT) AS n_lines FROM (
    SELECT feed_id, 'calendar.txt' AS member FROM {feed_calendar} UNION ALL SELECT feed_id, 'calendar_dates.txt' FROM {feed_dates} UNION ALL SELECT feed_id, 'routes.txt' FROM {feed_routes} WHERE route_type <> '715'
    UNION ALL SELECT feed_id, 'trips.txt' FROM t UNION ALL SELECT s.feed_id, 'stop_times.txt' FROM {feed_stop_times} s JOIN t ON t.feed_id = s.feed_id AND t.trip_id = s.trip_id) x GROUP BY 1, 2"""
_SQL |= {"feed_set_summary": as_query(_FEEDS), "feed_set_projected": as_query(_FEEDS), "feed_set_cascade": as_query(_CASCADE)}
_SQL |= {"stored_upsert": as_query(_WIDE), "incremental_matrix": as_query("SELECT * FROM {matrix}")}
_SQL["resume_runner"] = as_query(f"SELECT p.from_id AS batiment_id, d.TYPEQU, 'car' AS mode, CAST(min(travel_time) AS DOUBLE) AS tt_nearest, {_ladder('travel_time')} FROM ({_ROUTE}) p JOIN {{dest_map}} d ON p.to_id = d.id WHERE travel_time <= 20 GROUP BY p.from_id, d.TYPEQU")
_SQL["zip_members"] = as_query("SELECT service_id, wednesday FROM {calendar}")
