"""Operators on worked examples, contracts that raise, and every registered query against its SQL."""

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmill.functions import geo
from reachmill.functions.contracts import CLUSTERS, ContractError, assert_probs, assert_within_cap, validate_gains, validate_matrix
from reachmill.operators import aggregates, deltas, gtfs, matrix, monolith, routing, universe
from reachmill.plans import registry
from reachmill.plans.runner import Run
from reachmill.sources import geopackage, io

SF = "/root/testdata/sf0.001"
MATRIX = "batiment_id string, TYPEQU string, mode string, tt_nearest double, count_5 int, count_10 int, count_15 int, count_20 int"
B1_CAR = [("B104", 3, 1, 2, 2, 2), ("B105", 4, 1, 1, 1, 1), ("D265", 5, 1, 1, 1, 1), ("A129", 2, 1, 1, 1, 1), ("C108", 8, 0, 1, 1, 1), ("A203", 6, 0, 1, 1, 1), ("B204", 10, 0, 1, 1, 1), ("F999", 12, 0, 0, 1, 1)]
B1_WALK = [("B104", 8, 0, 1, 1, 2), ("B105", 12, 0, 0, 1, 1), ("D265", 15, 0, 0, 1, 1), ("A129", 6, 0, 1, 1, 1), ("C108", 20, 0, 0, 0, 1), ("A203", 18, 0, 0, 0, 1)]
B3_CAR = [("B104", 12, 0, 0, 1, 1), ("B105", 14, 0, 0, 1, 1), ("D265", 16, 0, 0, 0, 1), ("A129", 13, 0, 0, 1, 1), ("C108", 19, 0, 0, 0, 1)]
KEPT = ["B104", "B105", "D265", "A129", "C108", "A203", "B204"]


@pytest.fixture(scope="module")
def fixture(spark):
    rows = [(b, t, m, float(x[0]), *x[1:]) for b, m, content in (("b1", "car", B1_CAR), ("b2", "car", B1_CAR), ("b1", "walk", B1_WALK), ("b2", "walk", [("B104", 20, 0, 0, 0, 1)]), ("b3", "car", B3_CAR), ("b4", "car", [("B104", 18, 0, 0, 0, 1), ("D265", 19, 0, 0, 0, 1)])) for t, *x in content]
    return spark.createDataFrame(rows, MATRIX)


def test_building_metrics_example(fixture):
    validate_matrix(fixture)
    got = {(r.batiment_id, r.mode): r for r in matrix.building_metrics(fixture, KEPT).collect()}
    assert len(got) == 8
    assert (got["b1", "car"].diversity, got["b1", "car"].total, got["b1", "car"].div_loss) == (7, 8, 0)
    assert (got["b4", "walk"].diversity, got["b4", "walk"].div_loss, got["b4", "car"].diversity) == (0, 2, 2)
    assert got["b1", "walk"].has_banque and not got["b3", "car"].has_banque
    lost = matrix.building_metrics(fixture.where("mode = 'walk'"), KEPT).collect()
    assert all(r.div_loss is None for r in lost)
    with pytest.raises(ContractError):
        matrix.building_metrics(fixture, KEPT, threshold=7)


def test_territory_example(spark, fixture):
    crosswalk = spark.createDataFrame([("b1", "35101"), ("b2", "35101"), ("b3", "56101"), ("b4", "56101")], "batiment_id string, code_insee string")
    got = {(r.code_insee, r.mode): r for r in matrix.territory_aggregates(matrix.building_metrics(fixture, KEPT), crosswalk, "commune").collect()}
    assert got["35101", "walk"].nb_buildings == 2 and got["35101", "walk"].pct_iso_ecole == 0.5 and got["56101", "walk"].pct_iso_full == 1.0
    with pytest.raises(ContractError):
        matrix.territory_aggregates(matrix.building_metrics(fixture, KEPT), crosswalk, "street")


@pytest.mark.parametrize("change, word", [({"tt_nearest": 21.0}, "cap"), ({"mode": "boat"}, "mode"), ({"count_5": 1}, "nearest"), ({"count_10": 5}, "monotone"), ({"batiment_id": ""}, "empty_id"), ({"count_20": -1}, "count")])
def test_matrix_contract(spark, change, word):
    row = {"batiment_id": "b1", "TYPEQU": "B104", "mode": "walk", "tt_nearest": 8.0, "count_5": 0, "count_10": 1, "count_15": 1, "count_20": 2} | change
    with pytest.raises(ContractError, match=word):
        validate_matrix(spark.createDataFrame([tuple(row.values())], MATRIX))


def test_matrix_contract_reports_all(spark):
    bad = spark.createDataFrame([("b", "T", "boat", 30.0, 0, 0, 0, 0)] * 2, MATRIX).withColumn("count_30", F.lit(1))
    with pytest.raises(ContractError) as e:
        validate_matrix(bad)
    assert all(w in str(e.value) for w in ("cap", "mode", "duplicate_key", "count_30"))
    assert validate_matrix(spark.createDataFrame([], MATRIX)).count() == 0


@pytest.mark.parametrize("cap", [30, 21, 0, -5, "x", True])
def test_cap(cap):
    with pytest.raises(ContractError):
        assert_within_cap(cap)


def test_gain_example(spark):
    t = [("b1", "A", "transit", 7.0, 7.0, 9.0, 0, 1, 2, 3, 0, 1, 1, 2), ("b2", "B", "transit", 4.0, 4.0, 6.0, 1, 2, 3, 4, 1, 2, 3, 4)]
    names = "batiment_id string, TYPEQU string, mode string, tt_nearest double, travel_time_p1 double, travel_time_p50 double, " + ", ".join(f"count_{r}{s} int" for s in ("", "_p50") for r in (5, 10, 15, 20))
    got = {r.batiment_id: r for r in validate_gains(matrix.transit_gains(spark.createDataFrame(t, names), spark.createDataFrame([("b1", "A", "walk", 8.0, 0, 1, 1, 2)], MATRIX))).collect()}
    assert (got["b1"].walk_available, got["b1"].time_gain_p1, got["b1"].time_gain_p50, got["b2"].time_gain_p1) == (True, 1.0, -1.0, None)
    assert [got["b1"][f"count_gain_{r}_p1"] for r in (5, 10, 15, 20)] == [0, 0, 1, 1] and [got["b2"][f"count_gain_{r}_p50"] for r in (5, 10, 15, 20)] == [1, 2, 3, 4]


def test_transit_drops_half_null_pairs(spark):
    pairs = spark.createDataFrame([("b1", "d1", 4.0, 8.0), ("b1", "d2", None, None), ("b1", "d2", 3.0, None)], "from_id string, to_id string, travel_time_p1 double, travel_time_p50 double")
    dest = spark.createDataFrame([("d1", "A"), ("d2", "B")], "id string, TYPEQU string")
    assert [r.TYPEQU for r in matrix.derive_transit_matrix(pairs, dest, strict=True).collect()] == ["A"]
    with pytest.raises(ContractError):
        matrix.derive_transit_matrix(spark.createDataFrame([("b1", "d1", 9.0, 8.0)], pairs.schema), dest, strict=True)


@pytest.mark.parametrize("values, weights, n", [([4, 1, 0], [1, 1, 1], 5), ([4, 1, 0], [1, 2, 1], 6), ([-3, 2], [2, 1], 9), ([7], [1], 1)])
def test_implicit_zero_quantiles(spark, values, weights, n):
    df = spark.createDataFrame([("k", float(v), w) for v, w in zip(values, weights)], "k string, value double, weight long")
    totals = spark.createDataFrame([("k", n)], "k string, n_total long")
    got = aggregates.implicit_zero_quantiles(df, ["k"], totals).first()
    dense = np.repeat(values, weights).tolist() + [0] * (n - sum(weights))
    assert np.allclose(list(got)[1:], np.quantile(dense, np.arange(1, 10) / 10))


def test_dense_example(spark):
    spine = spark.createDataFrame([("a1", "35001", "Centre", "E1"), ("a2", "35001", "Centre", None), ("a3", "35002", "Rural", "E1")], "address_id string, code_insee string, nom_commune string, epci string")
    metrics = spark.createDataFrame([("a1", "A", 2, -1.0), ("a2", "A", 0, None)], "address_id string, TYPEQU string, count_5_walk int, gain double")
    types = spark.createDataFrame([("A",), ("B",)], "TYPEQU string")
    got = {(r.code_insee, r.TYPEQU): r for r in aggregates.dense(metrics.drop("gain"), spine, types, ["code_insee", "nom_commune"], ["count_5_walk"], strict=True).collect()}
    one, two = got["35001", "A"], got["35001", "B"]
    assert len(got) == 4 and (one.n_addresses, one.n_observed, one.count_5_walk_mean, one.count_5_walk_share, one.count_5_walk_p50) == (2, 2, 1.0, 0.5, 1.0)
    assert (two.n_observed, two.count_5_walk_mean, two.count_5_walk_max) == (0, 0.0, 0.0)
    levels = aggregates.dense_levels(metrics, spine, types, ["gain", "count_5_walk"], {"commune": ["code_insee"], "epci": ["epci"]})
    assert levels["commune"].count() == 4 and levels["epci"].count() == 2
    own = levels["commune"].where("code_insee = '35001' and TYPEQU = 'A'").first()
    assert (own.n_observed, own.gain_max, own.gain_mean) == (1, 0.0, -0.5)
    assert aggregates.dense(metrics.limit(0), spine, types, ["code_insee"], ["count_5_walk"]).count() == 4
    for bad in (metrics.unionByName(metrics), metrics.withColumn("TYPEQU", F.lit("Z")), metrics.withColumn("address_id", F.lit("zz")), metrics.select("address_id", "TYPEQU", F.lit(None).cast("int").alias("count_5_walk"))):
        with pytest.raises(ContractError):
            aggregates.dense(bad, spine, types, ["code_insee"], ["count_5_walk"], strict=True)
    with pytest.raises(ContractError):
        assert_probs([0.5, 0.5])


def test_monolith_merge(spark):
    walk = spark.createDataFrame([("a1", "A", 7.0)], "address_id string, TYPEQU string, nearest_walk double")
    bike = spark.createDataFrame([("a1", "A", 8.0), ("a2", "B", 12.0)], "address_id string, TYPEQU string, nearest_bike double")
    got = {r.address_id: r for r in monolith.merge([walk, bike], strict=True).collect()}
    assert got["a2"].nearest_walk is None and got["a1"].nearest_bike == 8.0
    with pytest.raises(ContractError):
        monolith.merge([walk, walk.withColumn("nearest_walk", F.lit(9.0))], strict=True)
    assert monolith.collapse(walk.unionByName(walk), strict=True).count() == 1
    for other in (9.0, None):
        with pytest.raises(ContractError):
            monolith.collapse(walk.unionByName(walk.withColumn("nearest_walk", F.lit(other).cast("double"))), strict=True)
    spine = spark.createDataFrame([("a1", 1.0, 2.0, 1, 1, "existing", "p1")], "address_id string, lon double, lat double, n_non_dependance_constructions int, n_residential_groups int, routing_source string, routing_point_id string")
    done = monolith.finish(walk, spine, strict=True).first()
    assert done.count_5_bike == 0 and done.nearest_bike is None and "routing_point_id" not in done.asDict()
    with pytest.raises(ContractError):
        monolith.finish(bike, spine, strict=True)
    assert monolith.publish_names(["transit_gain_count_5_p1_mean", "x"]) == {"transit_gain_count_5_p1_mean": "count_5_transitgain_mean", "x": "x"}


def test_coordinates(spark):
    points = spark.createDataFrame([("b1a", 1, -1.35, 48.1), ("b1b", 2, -1.35, 48.1), ("b2", 3, -1.4, 48.12), ("b3", 4, -1.4 + 1e-12, 48.12)], "id string, ord long, lon double, lat double")
    plan, link = routing.coordinate_plan(points, "c")
    assert plan.count() == 3 and {r.id: r.point_id for r in link.collect()}["b1b"] == "c_000001"
    with pytest.raises(ContractError):
        routing.expand_pairs(spark.createDataFrame([("zz", "c_000001", 1.0)], "from_id string, to_id string, travel_time double"), link, link, strict=True)
    direct = {tuple(r) for r in routing.stub_route(points, points).collect()}
    assert direct == {tuple(r) for r in routing.route_unique(points, points, routing.stub_route).collect()}
    flipped = spark.createDataFrame([("d", "o", 1.0)], "from_id string, to_id string, travel_time double")
    o, d = (spark.createDataFrame([(i,)], "id string") for i in "od")
    assert tuple(matrix.orient_pairs(flipped, o, d).first()) == ("o", "d", 1.0)
    with pytest.raises(ContractError):
        matrix.orient_pairs(flipped, o, o)


def test_geometry(spark):
    one = spark.range(1)
    p = one.select(geo.lambert93_to_wgs84(F.lit(700000.0), F.lit(6600000.0)).alias("a"), geo.lambert93_to_wgs84(F.lit(652469.02), F.lit(6862035.26)).alias("b")).first()
    assert abs(p.a.lon - 3) < 1e-9 and abs(p.a.lat - 46.5) < 1e-9 and abs(p.b.lon - 2.3522) < 2e-3 and abs(p.b.lat - 48.8566) < 2e-3
    shape = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
    c = one.select(geo.wkt_centroid(F.lit(shape)).alias("c"), geo.wkt_centroid(F.lit("POLYGON EMPTY")).alias("e")).first()
    assert abs(c.c.x - (16 * 2 - 1.5) / 15) < 1e-12 and c.e is None
    ring = [(0, 0), (1, 0), (1, 1), (0, 1)]
    d = one.select(geo.distance_to_ring_m(F.lit(0.5), F.lit(0.5), ring).alias("a"), geo.distance_to_ring_m(F.lit(1.1), F.lit(0.5), ring).alias("b"), geo.haversine_m(F.lit(1.1), F.lit(0.5), F.lit(1.0), F.lit(0.5)).alias("c")).first()
    assert d.a == 0 and abs(d.b / d.c - 1) < 1e-3
    assert geo.tile_ids(-2.5, 47.2, -0.5, 48.9) == ["N47W003", "N47W002", "N47W001", "N48W003", "N48W002", "N48W001"]


def test_deltas_example(spark):
    m = list(deltas.SNAPSHOT_MAP)
    derived = spark.createDataFrame([("35001", "car", 120.0, *[0.5] * 5, 9.0, 9.0, 0.0), ("35002", "car", 300.0, *[0.5] * 5, 9.0, 2.0, 0.0)], "code_insee string, mode string, " + ", ".join(f"{c} double" for c in [*m[:6], "avg_diversity", "avg_total", "pct_iso_full"]))
    snapshot = spark.createDataFrame([(c, "n", 100.0, *[0.5] * 5, 4.0, 2.0, 0.0) for c in ("35001", "35002", "35003")], "code_insee string, nom_commune string, " + ", ".join(f"{c} double" for c in deltas.SNAPSHOT_MAP.values()))
    found = deltas.deltas(derived, snapshot, nb_prior=1.2, border=["35001"])
    got = {(r.code_insee, r.metric): r.classification for r in found.collect()}
    assert len(got) == 27 and all(v == "missing" for k, v in got.items() if k[0] == "35003")
    assert got["35002", "nb_buildings"] == got["35002", "avg_diversity"] == "flag" and got["35001", "nb_buildings"] == got["35001", "avg_diversity"] == "expected"
    report = deltas.render_report(found)
    assert "| nb_buildings | 1 | 1 | 1 |" in report and "35002" in report


def test_deltas_name_their_figures_and_findings(spark):
    m = list(deltas.SNAPSHOT_MAP)
    columns = ", ".join(f"{c} double" for c in m)
    derived = spark.createDataFrame([(c, "car", *v) for c, v in (("1", [150.0, 0.5, 0.5, 0.75, 0.5, 0.5, 5.0, 2.0, 0.0]), ("2", [90.0, 0.5, 0.5, 0.5, 0.5, 0.5, 9.0, 2.0, 0.0]))], "code_insee string, mode string, " + columns)
    snapshot = spark.createDataFrame([(c, "n", 100.0, 0.5, 0.5, 0.5, 0.5, 0.5, 4.0, 0.0, 0.0) for c in ("1", "2")], "code_insee string, nom_commune string, " + ", ".join(f"{c} double" for c in deltas.SNAPSHOT_MAP.values()))
    accepted = spark.createDataFrame([("2", "avg_diversity", "measured twice")], "code_insee string, metric string, reason string")
    got = {(r.code_insee, r.metric): (r.classification, r.reason) for r in deltas.deltas(derived, snapshot, nb_prior=1.4, border=["1"], accepted=accepted).collect()}
    assert got["1", "nb_buildings"] == ("expected", "150 % of the snapshot, within 30 % around the prior of 140 %")
    assert got["2", "nb_buildings"] == ("flag", "90 % of the snapshot, beyond 30 % around the prior of 140 %")
    assert got["1", "share_administration"] == ("flag", "beyond 10 points: +25 points") and got["2", "share_administration"] == ("expected", "within 10 points: 0 points")
    assert got["1", "avg_diversity"] == ("expected", "within 25 %: +25 %") and got["2", "avg_diversity"] == ("expected", "accepted before: measured twice")
    assert got["1", "avg_total"] == ("flag", "beyond 40 %: from zero")
    for rows, word in (([("2", "avg_diversity", " ")], "empty value"), ([("2", "height", "x")], "unknown metric"), ([("2", "avg_total", "x")] * 2, "duplicate"), ([(None, "avg_total", "x")], "empty value")):
        with pytest.raises(ContractError, match=word):
            deltas.deltas(derived, snapshot, nb_prior=1.4, accepted=spark.createDataFrame(rows, accepted.schema))
    with pytest.raises(ContractError, match="reason"):
        deltas.require_findings(accepted.drop("reason"))
    with pytest.raises(ContractError, match="no mode boat"):
        deltas.deltas(derived, snapshot, ref_mode="boat", nb_prior=1.4, strict=True)
    assert {r.reason for r in deltas.deltas(derived, snapshot, ref_mode="boat", nb_prior=1.4).collect()} == {"not derived"}
    assert len(deltas.ROUTED_TYPES) == len(set(deltas.ROUTED_TYPES)) == 53 and set(deltas.DIVERGENCE["routed_but_not_recorded"]) < set(deltas.ROUTED_TYPES)
    assert "a wider strip around the region" in deltas.drift_of("avg_total", True) and "a wider strip around the region" not in deltas.drift_of("avg_total", False) and deltas.drift_of("pct_iso_full") == []


def test_a_reference_mode_is_atomic(spark):
    with pytest.raises(ContractError, match="must be one of walk, bike, car"):
        matrix.building_metrics(spark.createDataFrame([], MATRIX), ["A"], ref_mode="transit")


def test_metrics_refuse_an_unknown_mode(spark):
    rows = [("b1", "T", "car", 1), ("b1", "T", "boat", 1)]
    for broken in (rows, [*rows[:1], ("b2", "T", None, 1)]):
        with pytest.raises(Exception, match="unknown mode"):
            matrix.building_metrics(spark.createDataFrame(broken, "batiment_id string, TYPEQU string, mode string, count_20 int"), ["T"]).collect()


def test_report_lists_every_row(spark):
    schema = "code_insee string, nom_commune string, metric string, snapshot double, derived double, classification string, reason string"
    rows = [(f"{i:05}", "n", "avg_total", 2.0, 9.0, "flag", "outside the band") for i in range(450)] + [(f"{i:05}", None, "avg_total", 2.0, None, "missing", "not derived") for i in range(450, 700)]
    report = deltas.render_report(spark.createDataFrame(rows, schema)).splitlines()
    listed = [line[2:7] for line in report if line.startswith("- ")]
    assert listed == [r[0] for r in rows] and "- 00699 : avg_total (not derived)" in report


def test_timetables(spark):
    calendar = spark.createDataFrame([("weekday", "1", "20260101", "20261231"), ("saturday", "0", "20260101", "20261231")], "Service_ID string, wednesday string, start_date string, end_date string")
    dates = spark.createDataFrame([("weekday", "20260916", "2"), ("saturday", "2026-09-16", "1"), ("special", "20260916", "1")], "service_id string, date string, exception_type string")
    assert {r[0] for r in gtfs.active_services(calendar, dates, "2026-09-16").collect()} == {"saturday", "special"}
    assert gtfs.active_services(None, dates, "20260916").count() == 2
    with pytest.raises(ContractError):
        gtfs.active_services(None, None, "20260916")
    times = spark.createDataFrame([("10:00:00",), ("25:10:01",), ("10:60:00",), ("x",), (None,)], "t string").select(gtfs.seconds(F.col("t"))).collect()
    assert [r[0] for r in times] == [36000, 90601, None, None, None]
    with pytest.raises(ContractError):
        gtfs.activity_window(["11:00:00", "10:00:00"])
    routes = spark.createDataFrame([("demo:3", "1", "L1"), ("9", "3", "P1"), ("8", "3", "X")], "route_id string, route_type string, route_short_name string")
    trips = spark.createDataFrame([("t1", "9", "x"), ("t2", "8", "Renfort Scol"), ("t3", "8", None)], "trip_id string, route_id string, trip_headsign string")
    kept, left = gtfs.school_filter(routes, trips, "demo", registry.POLICY)
    assert [r.route_id for r in kept.collect()] == ["8"] and [r.trip_id for r in left.collect()] == ["t3"]
    with pytest.raises(ContractError):
        gtfs.school_filter(routes, trips, "demo", registry.POLICY, strict=True)
    with pytest.raises(ContractError):
        gtfs.school_filter(routes, trips, "other", registry.POLICY)


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("TYPEQU,LIB\nA101,Police\n00012,Zero\n")
    assert {r.TYPEQU for r in io.read_nomenclature(spark, str(tmp_path / "a.csv")).collect()} == {"A101", "00012"}
    with pytest.raises(ContractError):
        io.read_delimited(spark, str(tmp_path / "a.csv"), ["nope"])
    (tmp_path / "s.csv").write_text("code_insee,nom_commune,v\n123,X,1.5\n")
    assert tuple(io.read_snapshot(spark, str(tmp_path / "s.csv"), ["v"]).first()) == ("00123", "X", 1.5)
    path = str(tmp_path / "f.zip")
    io.write_zip({"b/Trips.txt": "﻿trip_id,x\n1,\n2,NA\n".encode(), "stops.txt": b""}, path)
    first = io.sha256_file(path)
    io.write_zip({"stops.txt": b"", "b/Trips.txt": "﻿trip_id,x\n1,\n2,NA\n".encode()}, path)
    assert io.sha256_file(path) == first
    assert [tuple(r) for r in io.read_zip_member(spark, path, "trips.txt").collect()] == [("1", None), ("2", None)]
    assert io.read_zip_member(spark, path, "none.txt", required=False) is None
    with pytest.raises(ContractError):
        io.check_timetable_zip(path)
    io.write_json({"kind": "run", "é": 1}, str(tmp_path / "m.json"))
    with pytest.raises(ContractError):
        io.read_json(str(tmp_path / "m.json"), "receipt")
    import sqlite3
    import struct

    blob = b"GP\0\1" + struct.pack("<i", 2154) + struct.pack("<BIIIdddddd", 1, 3, 1, 3, 0, 0, 1, 0, 1, 1)
    with sqlite3.connect(tmp_path / "g.gpkg") as db:
        db.execute("create table commune (code text, geom blob)")
        db.execute("insert into commune values ('35001', ?)", (blob,))
    assert geopackage.read_geopackage(spark, str(tmp_path / "g.gpkg"), "commune", ["code"], "geom").first()[1] == "POLYGON ((0 0, 1 0, 1 1))"
    source = tmp_path / "data.bin"
    source.write_bytes(b"abc")
    (tmp_path / "got").mkdir()
    with pytest.raises(ContractError):
        io.acquire(source.as_uri(), str(tmp_path / "got"), "0" * 64)
    assert io.acquire(source.as_uri(), str(tmp_path / "got"), io.sha256_file(str(source))).endswith("data.bin")


def test_runner_resumes(spark, tmp_path):
    o = spark.createDataFrame([(f"o{i}", i, -1.3 + i / 200, 48.1) for i in range(5)], "id string, ord long, lon double, lat double")
    d = spark.createDataFrame([(f"d{i}", i, -1.3 + i / 100, 48.1) for i in range(3)], "id string, ord long, lon double, lat double")
    types = spark.createDataFrame([("d0", "A"), ("d1", "B"), ("d2", "A")], "id string, TYPEQU string")
    run = Run(str(tmp_path / "r"), o, d, types, modes=["walk"], chunk_size=2)
    run.execute(limit=1)
    assert [e["status"] for e in run.manifest["entries"]] == ["complete", "pending", "pending"]
    again = Run(str(tmp_path / "r"), o, d, types, modes=["walk"], chunk_size=2)
    again.execute()
    whole = matrix.derive_matrix(matrix.collapse_pairs(routing.stub_dispatch(o, d, mode="walk")), types, "walk")
    assert {tuple(r) for r in again.matrix().select(whole.columns).collect()} == {tuple(r) for r in whole.collect()}
    folder = again.chunk_path("walk", 2)
    victim = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(os.path.join(folder, victim), "ab") as f:
        f.write(b"x")
    again.sweep()
    assert [e["chunk_id"] for e in again.owed()] == [2]
    again.execute()
    assert not again.owed() and again.metadata()["modes"]["walk"]["complete"] == 3
    with pytest.raises(ContractError, match="chunk_size"):
        Run(str(tmp_path / "r"), o, d, types, modes=["walk"], chunk_size=3)


def test_universe_examples(spark):
    g = spark.createDataFrame([(10.0, 20.0, 30.0, 0, 0, 20), (None, 21.0, 31.0, 0, 0, 20), (None, None, None, 0, 0, None), (40.0, 42.0, 44.0, 1, 1, 20), (None, None, None, 0, 1, None)], "x double, gx double, ax double, fictive_cstr int, fictive_groupe int, fiabilite int")
    g = g.withColumn("y", F.col("x")).withColumn("gy", F.col("gx")).withColumn("ay", F.col("ax"))
    assert [r.g.x for r in g.select(geo.resolve_geometry(0).alias("g")).collect()] == [30.0, 31.0, None, 44.0, None]
    assert [r.g.geometry_source for r in g.select(geo.resolve_geometry(21).alias("g")).collect()] == ["geom_cstr", "geom_groupe", None, "fictive", None]
    origins = spark.createDataFrame([("c1", "g1", "35001", "35"), ("c2", "g1", "35002", "35")], "origin_id string, batiment_groupe_id string, code_commune_insee string, code_departement_insee string")
    for address, want in (("35001_x", "35001"), ("99999_x", None)):
        links = spark.createDataFrame([("c1", address), ("c2", address)], "origin_id string, address_id string")
        table = spark.createDataFrame([(address,)], "address_id string")
        assert universe.territory_crosswalk(table, links, origins, "prefix").first().code_insee == want
        with pytest.raises(ContractError):
            universe.territory_crosswalk(table, links, origins, strict=True)


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_against_sql(spark, engine, name):
    df = registry.queries()[name](spark, SF)
    rows, names = df.collect(), df.columns
    if name not in registry.oracle_sql():
        assert name in ("lambert93", "wkt_centroid", "strip_distance") and rows
        return
    other = engine.sql(registry.oracle_sql()[name])
    assert sorted(names) == sorted(other.columns)
    order = lambda columns: sorted(range(len(columns)), key=lambda i: columns[i])
    mine, theirs = (sorted(tuple(repr(r[i]) for i in order(c)) for r in x) for x, c in ((rows, names), (other.fetchall(), other.columns)))
    assert mine == theirs
