"""Canonical inputs made from the driver's tables, in SQL that Spark and the checking engine both read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from reachmill.operators.joins import fine_shuffles

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KEPT = [f"Brand#{i}" for i in range(1, 16)]
CLUSTERS = {
    "alimentation": ["Brand#1", "Brand#2", "Brand#3"],
    "sante": ["Brand#4", "Brand#5"],
    "administration": ["Brand#6", "Brand#7", "Brand#8"],
    "ecole": ["Brand#9"],
    "banque": ["Brand#8", "Brand#10"],
}
METRICS = ["count_20_walk", "count_20_car", "gain"]

SQL = {
    "pairs": """
        SELECT CAST(o.o_custkey AS STRING) AS from_id, CAST(l.l_partkey AS STRING) AS to_id,
               CASE l.l_linenumber % 4 WHEN 0 THEN 'walk' WHEN 1 THEN 'transit' WHEN 2 THEN 'bike' ELSE 'car' END AS mode, l.l_quantity % 25 AS travel_time
        FROM {orders} o JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey WHERE l.l_quantity % 25 <= 20""",
    "transit_pairs": """
        SELECT CAST(o.o_custkey AS STRING) AS from_id, CAST(l.l_partkey AS STRING) AS to_id,
               CASE WHEN l.l_partkey % 11 = 0 THEN NULL ELSE l.l_quantity % 15 END AS travel_time_p1,
               CASE WHEN l.l_partkey % 13 = 0 THEN NULL ELSE l.l_quantity % 15 + l.l_linenumber END AS travel_time_p50
        FROM {orders} o JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey WHERE l.l_quantity % 15 + l.l_linenumber <= 20""",
    "dest_map": "SELECT CAST(p_partkey AS STRING) AS id, p_brand AS TYPEQU FROM {part}",
    "crosswalk": """
        SELECT CAST(c.c_custkey AS STRING) AS batiment_id, n.n_name AS code_insee, 'Commune ' || n.n_name AS nom_commune,
               CASE WHEN c.c_mktsegment = 'BUILDING' THEN NULL ELSE c.c_mktsegment END AS epci, r.r_name AS code_departement, 'all' AS region
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "spine": "SELECT batiment_id AS address_id, code_insee, nom_commune, epci, code_departement, region FROM {crosswalk}",
    "types": "SELECT DISTINCT p_brand AS TYPEQU FROM {part}",
    "collapsed": "SELECT from_id, to_id, mode, min(travel_time) AS travel_time FROM {pairs} GROUP BY from_id, to_id, mode",
    "matrix": """
        SELECT p.from_id AS batiment_id, d.TYPEQU, p.mode, min(p.travel_time) AS tt_nearest,
               CAST(sum(CASE WHEN p.travel_time <= 5 THEN 1 ELSE 0 END) AS INT) AS count_5, CAST(sum(CASE WHEN p.travel_time <= 10 THEN 1 ELSE 0 END) AS INT) AS count_10,
               CAST(sum(CASE WHEN p.travel_time <= 15 THEN 1 ELSE 0 END) AS INT) AS count_15, CAST(sum(CASE WHEN p.travel_time <= 20 THEN 1 ELSE 0 END) AS INT) AS count_20
        FROM {collapsed} p JOIN {dest_map} d ON p.to_id = d.id GROUP BY p.from_id, d.TYPEQU, p.mode""",
    "metrics": """
        SELECT address_id, TYPEQU, max(w) AS count_20_walk, max(c) AS count_20_car, max(g) AS gain FROM (
          SELECT batiment_id AS address_id, TYPEQU, CASE WHEN mode = 'walk' THEN count_20 END AS w, CASE WHEN mode = 'car' THEN count_20 END AS c,
                 CASE WHEN mode = 'bike' THEN count_10 - 2 END AS g FROM {matrix}) x GROUP BY address_id, TYPEQU""",
    "origins": "SELECT CAST(c_custkey AS STRING) AS id, CAST(c_custkey AS BIGINT) AS ord, -1.5 + CAST(c_custkey % 37 AS DOUBLE) / 64 AS lon, 48.0 + CAST(c_custkey % 23 AS DOUBLE) / 64 AS lat FROM {customer}",
    "destinations": "SELECT CAST(s_suppkey AS STRING) AS id, CAST(s_suppkey AS BIGINT) AS ord, -1.5 + CAST(s_suppkey % 19 AS DOUBLE) / 32 AS lon, 48.0 + CAST(s_suppkey % 7 AS DOUBLE) / 16 AS lat FROM {supplier}",
    "snapshot": """
        SELECT n_name AS code_insee, 'Commune ' || n_name AS nom_commune, 40.0 + n_nationkey AS nb_buildings, CASE WHEN n_nationkey % 7 = 0 THEN NULL ELSE 0.5 END AS share_food_c, 0.25 AS share_health_c, 0.75 AS share_admin_c,
               0.0 AS share_school_c, 0.5 AS share_bank_c, 4.0 + n_nationkey % 5 AS avg_div_car, 8.0 + n_nationkey % 9 AS avg_tot_car, 0.0 AS pct_iso_full_c
        FROM {nation} WHERE n_nationkey % 6 <> 5""",
    "calendar": """
        SELECT CAST(n_nationkey AS STRING) AS service_id, CASE WHEN n_nationkey % 2 = 0 THEN '1' ELSE '0' END AS wednesday,
               CASE WHEN n_nationkey % 5 = 0 THEN '20261001' ELSE '20260101' END AS start_date, CASE WHEN n_nationkey % 7 = 0 THEN '20260901' ELSE '20261231' END AS end_date FROM {nation}""",
    "calendar_dates": """
        SELECT CAST(n_nationkey AS STRING) AS service_id, CASE WHEN n_nationkey % 3 = 0 THEN '2026-09-16' ELSE '20260916' END AS date, CASE WHEN n_nationkey % 4 = 0 THEN '2' ELSE '1' END AS exception_type
        FROM {nation} WHERE n_nationkey % 4 < 2 UNION ALL SELECT CAST(n_nationkey AS STRING) AS service_id, '20260917' AS date, '1' AS exception_type FROM {nation} WHERE n_nationkey < 3""",
    "trips": "SELECT CAST(o_orderkey AS STRING) AS trip_id, CAST(o_custkey % 25 AS STRING) AS service_id, CAST(o_custkey % 40 AS STRING) AS route_id, CASE WHEN o_orderkey % 17 = 0 THEN 'Depot renfort SCOL' ELSE o_orderpriority END AS trip_headsign FROM {orders}",
    "stop_times": """
        SELECT CAST(l_orderkey AS STRING) AS trip_id, CAST(l_suppkey AS STRING) AS stop_id, l_linenumber AS stop_sequence,
               lpad(CAST(l_partkey % 26 AS STRING), 2, '0') || ':' || lpad(CAST(l_suppkey % 61 AS STRING), 2, '0') || ':00' AS departure_time FROM {lineitem}""",
    "routes": "SELECT CAST(k AS STRING) AS route_id, CASE WHEN k % 10 = 7 THEN '715' ELSE '3' END AS route_type, CASE WHEN k % 9 = 0 THEN 'p' ELSE 'L' END || CAST(k AS STRING) AS route_short_name FROM (SELECT DISTINCT o_custkey % 40 AS k FROM {orders}) x",
    "stops": "SELECT CAST(s_suppkey AS STRING) AS stop_id, CASE WHEN s_suppkey % 5 = 0 THEN CAST(s_suppkey * 2 AS STRING) WHEN s_suppkey % 5 = 1 THEN '' ELSE NULL END AS parent_station FROM {supplier}",
    "res_groups": """
        SELECT CAST(c_custkey AS STRING) AS batiment_groupe_id, CAST(c_nationkey AS STRING) AS code_commune_insee, CAST(c_nationkey % 4 AS STRING) AS code_departement_insee, CAST(c_custkey AS DOUBLE) AS x,
               CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE CAST(c_custkey % 50 AS DOUBLE) END AS y, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 3 = 0 AS INT) END AS fictive FROM {customer}""",
    "res_constructions": """
        SELECT CAST(o_orderkey AS STRING) AS batiment_construction_id, CAST(o_custkey AS STRING) AS batiment_groupe_id, o_orderkey % 3 = 0 AS has_address, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 5 = 0 END AS fictive,
               CAST(o_orderkey AS DOUBLE) AS x, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 90 AS DOUBLE) END AS y FROM {orders} WHERE o_custkey % 10 <> 0""",
    "res_relations": "SELECT CAST(l_suppkey AS STRING) AS batiment_groupe_id, CAST(l_partkey AS STRING) AS address_id, CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(l_partkey % 30 AS INT) END AS fiabilite, l_orderkey * 10 + l_linenumber AS ord FROM {lineitem}",
    "res_points": "SELECT CAST(p_partkey AS STRING) AS address_id, CAST(p_partkey AS DOUBLE) AS x, CAST(p_partkey % 70 AS DOUBLE) AS y FROM {part} WHERE p_partkey % 6 <> 0",
    "findings": "SELECT n_name AS code_insee, 'avg_diversity' AS metric, 'seen in ' || n_name AS reason FROM {nation} WHERE n_nationkey % 4 = 1",
    "feed_calendar": "SELECT 'f' || CAST(CAST(service_id AS INT) % 7 AS STRING) AS feed_id, CAST(CAST(floor(CAST(service_id AS INT) / 7) AS INT) AS STRING) AS service_id, wednesday, start_date, end_date FROM {calendar}",
    "feed_dates": "SELECT 'f' || CAST(CAST(service_id AS INT) % 7 AS STRING) AS feed_id, CAST(CAST(floor(CAST(service_id AS INT) / 7) AS INT) AS STRING) AS service_id, date, exception_type FROM {calendar_dates}",
    "feed_trips": "SELECT 'f' || CAST(CAST(service_id AS INT) % 7 AS STRING) AS feed_id, trip_id, CAST(CAST(floor(CAST(service_id AS INT) / 7) AS INT) AS STRING) AS service_id, route_id FROM {trips}",
    "feed_stop_times": "SELECT t.feed_id, s.trip_id, s.stop_id, s.stop_sequence, s.departure_time FROM {stop_times} s JOIN {feed_trips} t ON s.trip_id = t.trip_id",
    "feed_routes": "SELECT feed_id, route_id, route_type FROM (SELECT DISTINCT feed_id, route_id FROM {feed_trips}) f JOIN (SELECT route_id AS r, route_type FROM {routes}) x ON f.route_id = x.r",
    "groups": "SELECT CAST(c_custkey AS STRING) AS batiment_groupe_id FROM {customer}",
    "usage": "SELECT CAST(c_custkey AS STRING) AS batiment_groupe_id, c_mktsegment AS usage_principal_bdnb_open FROM {customer} WHERE c_custkey % 7 <> 0",
    "relations": "SELECT CAST(o_custkey AS STRING) AS batiment_groupe_id, CAST(o_orderkey AS STRING) AS address_id, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_orderkey % 7 AS INT) END AS fiabilite, o_orderkey AS ord FROM {orders}",
    "constructions": "SELECT CAST(o_orderkey AS STRING) AS batiment_construction_id, CAST(o_custkey AS STRING) AS batiment_groupe_id, o_orderkey % 3 = 0 AS has_address, o_orderkey % 5 = 0 AS fictive FROM {orders}",
    "geometry_candidates": """
        SELECT CAST(c_custkey AS STRING) AS origin_id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey AS DOUBLE) END AS x, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(1 + c_custkey AS DOUBLE) END AS y,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(2 + c_custkey AS DOUBLE) END AS gx, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(3 + c_custkey AS DOUBLE) END AS gy,
               CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(4 + c_custkey AS DOUBLE) END AS ax, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(5 + c_custkey AS DOUBLE) END AS ay,
               CAST(c_custkey % 4 = 0 AS INT) AS fictive_cstr, CAST(c_custkey % 7 = 0 AS INT) AS fictive_groupe, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 30 AS INT) END AS fiabilite FROM {customer}""",
    "equipment": """
        SELECT CAST(s_suppkey AS BIGINT) AS universe_row, 'Brand#' || CAST(s_suppkey % 9 AS STRING) AS TYPEQU, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey % 20 AS STRING) END AS SIRET,
               CASE WHEN s_suppkey % 31 = 0 THEN NULL ELSE CAST(s_suppkey % 20 AS DOUBLE) / 8 END AS LONGITUDE, 48.0 + CAST(s_suppkey % 10 AS DOUBLE) / 16 AS LATITUDE,
               CAST(s_nationkey AS STRING) AS DEP, CAST(s_suppkey % 40 AS STRING) AS QUALITE_GEOLOC, CASE WHEN s_suppkey % 3 = 0 THEN 'rue' WHEN s_suppkey % 3 = 1 THEN '' ELSE NULL END AS LIBVOIE,
               CAST(s_suppkey * 997 % 50000 AS DOUBLE) AS distance_m FROM {supplier}""",
    "region_vertices": """
        SELECT ring, ord, cx + r * cos(2 * pi() * ord / n) AS lon, cy + r * sin(2 * pi() * ord / n) AS lat FROM (
          SELECT ring, ord, count(*) OVER (PARTITION BY ring) AS n, CASE WHEN ring = 2 THEN 2.1 ELSE 0.9 END AS cx, CASE WHEN ring = 2 THEN 48.5 ELSE 48.3 END AS cy,
                 CASE ring WHEN 0 THEN 0.6 WHEN 1 THEN 0.1 ELSE 0.12 END * (1 + CAST(k * 7919 % 97 AS DOUBLE) / 400) AS r
          FROM (SELECT CAST(c_custkey AS BIGINT) AS k, CASE WHEN c_custkey % 10 = 1 THEN 1 WHEN c_custkey % 10 = 2 THEN 2 ELSE 0 END AS ring, row_number() OVER (PARTITION BY CASE WHEN c_custkey % 10 = 1 THEN 1 WHEN c_custkey % 10 = 2 THEN 2 ELSE 0 END ORDER BY c_custkey) - 1 AS ord FROM {customer}) v) w""",
    "reroute_origins": "SELECT CAST(o_orderkey AS STRING) AS origin_id, CAST(o_custkey AS STRING) AS batiment_groupe_id, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderkey % 4 = 0 END AS is_dependance_candidate, lpad(CAST(o_custkey % 25 AS STRING), 5, '0') AS code_commune_insee, CAST(o_custkey % 5 AS STRING) AS code_departement_insee FROM {orders}",
    "reroute_links": "SELECT DISTINCT CAST(l_orderkey AS STRING) AS origin_id, lpad(CAST(l_partkey % 25 AS STRING), 5, '0') || '_' || CAST(l_partkey AS STRING) AS address_id FROM {lineitem} WHERE l_linenumber < 3",
    "address_points": "SELECT lpad(CAST(p_partkey % 25 AS STRING), 5, '0') || '_' || CAST(p_partkey AS STRING) AS address_id, CAST(p_partkey % 101 AS DOUBLE) / 64 AS lon, CAST(p_partkey % 53 AS DOUBLE) / 64 AS lat FROM {part}",
    "existing_points": "SELECT 'coord_' || CAST(p_partkey AS STRING) AS id, CAST(p_partkey % 101 AS DOUBLE) / 64 AS lon, CAST(p_partkey % 53 AS DOUBLE) / 64 AS lat FROM {part} WHERE p_partkey < 1200 AND p_partkey % 2 = 0",
    "origin_link": "SELECT CAST(c_custkey AS STRING) AS id, 'p' || CAST(c_custkey AS STRING) AS point_id FROM {customer}",
    "monolith_addresses": """
        SELECT 'a' || CAST(o_orderkey AS STRING) AS address_id, CAST(o_orderkey % 97 AS DOUBLE) / 32 AS lon, CAST(o_orderkey % 89 AS DOUBLE) / 32 AS lat, CAST(o_orderkey % 3 AS INT) + 1 AS n_non_dependance_constructions,
               CAST(o_orderkey % 2 AS INT) + 1 AS n_residential_groups, CASE WHEN o_orderkey % 10 = 0 THEN 'reroute' ELSE 'existing' END AS routing_source, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'p' || CAST(o_custkey AS STRING) END AS routing_point_id
        FROM {orders} WHERE o_orderkey % 6 < 2""",
    "chunk_entries": "SELECT CASE o_orderkey % 4 WHEN 0 THEN 'walk' WHEN 1 THEN 'transit' WHEN 2 THEN 'bike' ELSE 'car' END AS mode, CAST(o_custkey % 12 AS INT) AS chunk_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(o_orderkey % 100) AS BIGINT) AS route_seconds FROM {orders} GROUP BY 1, 2",
}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a canonical input."""
    fine_shuffles(spark)
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SQL[name]
    return spark.sql(text, **{n: frame(spark, sf_dir, n) for n in needed(text)})


def needed(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


def as_query(text: str) -> str:
    """A self-contained query: the canonical inputs that text names in braces as common table expressions."""
    order: list[str] = []

    def visit(t):
        for n in needed(t):
            if n not in BASE and n not in order:
                visit(SQL[n])
                order.append(n)

    visit(text)
    plain = lambda t: re.sub(r"\{(\w+)\}", r"\1", t)
    ctes = ", ".join(f"{n} AS ({plain(SQL[n])})" for n in order)
    body = plain(text)
    if not ctes:
        return body
    return f"WITH {ctes}, {body.lstrip()[5:]}" if re.match(r"\s*WITH ", body) else f"WITH {ctes} {body}"
