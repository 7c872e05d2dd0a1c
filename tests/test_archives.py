"""Sets of timetable archives and layers of geopackages, read and written by tasks."""

import os
import sqlite3
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError
from reachmill.operators import feeds, gtfs
from reachmill.sources import geopackage, io, timetables

DAYS = "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\n"


def archive(i, routes="r,3\ns,715\n"):
    """A feed whose ids are those of all others; feeds of odd number don't run on Wednesdays."""
    return {
        "calendar.txt": (DAYS + f"x,0,0,{int(i % 2 == 0)},0,0,0,0,20260101,20261231\n").encode(),
        f"sub/Calendar_Dates.TXT": f"﻿Service_ID,date,exception_type\nx,20260916,{2 if i % 10 == 0 else 9}\ny,2026-09-16,1\n".encode(),
        "routes.txt": ("route_id,route_type\n" + routes).encode(),
        "trips.txt": b"route_id,service_id,trip_id,trip_headsign\nr,x,t1,NA\ns,x,t2,\"a, b\"\nr,y,t3,Renfort\n",
        "stop_times.txt": b"trip_id,departure_time,stop_id,stop_sequence\nt1,10:30:00,A,1\nt2,09:00:00,B,1\nt3,10:59:59,C,1\nt3,11:00:00,D,2\n",
        "stops.txt": b"stop_id\nA\nB\nC\nD\n",
    }


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    for i in range(100):
        io.write_zip(archive(i), str(folder / f"f{i:03d}.zip"))
    return str(folder)


def test_a_hundred_feeds_in_one_plan(spark, many):
    lines = timetables.read_timetables(spark, many)
    assert lines.rdd.getNumPartitions() == 100
    got = {r.feed_id: (r.n_active_trips, r.n_window_trips, r.n_active_stops) for r in feeds.summary(lines, "2026-09-16").collect()}
    # y runs everywhere; x on even feeds, but for every tenth
    assert got == {f"f{i:03d}": (3, 2, 4) if i % 2 == 0 and i % 10 else (1, 1, 2) for i in range(100)}
    each = timetables.archives(spark, many)  # every member read by itself
    assert {r.feed_id: (r.n_active_trips, r.n_window_trips, r.n_active_stops) for r in feeds.summary(each, "2026-09-16").collect()} == got
    gtfs.feed_gate(feeds.summary(lines, "2026-09-16"), [f"f{i:03d}" for i in range(100)])
    with pytest.raises(ContractError, match="without service"):
        gtfs.feed_gate(feeds.summary(lines, "2020-09-16"), ["f001"])
    assert timetables.read_timetables(spark, many, ["stops.txt"]).select("member").distinct().collect() == [("stops.txt",)]
    feeds.require_members(lines)
    with pytest.raises(ContractError, match="all its members"):
        feeds.require_members(lines.where("not (feed_id = 'f007' and member = 'stops.txt')"))


def test_archives_are_written_whole_and_alike(spark, many, tmp_path):
    lines = timetables.read_timetables(spark, many).where("feed_id < 'f012'")
    for n, df in (("a", lines), ("b", lines.repartition(5, "line"))):
        timetables.write_timetables(df, str(tmp_path / n))
    names = sorted(os.listdir(tmp_path / "a"))
    assert names == [f"f{i:03d}.zip" for i in range(12)] and all((tmp_path / "a" / n).read_bytes() == (tmp_path / "b" / n).read_bytes() for n in names)
    with zipfile.ZipFile(tmp_path / "a" / "f003.zip") as z:
        assert z.read("trips.txt") == b"route_id,service_id,trip_headsign,trip_id\nr,x,,t1\ns,x,\"a, b\",t2\nr,y,Renfort,t3\n"
    back = timetables.read_timetables(spark, str(tmp_path / "a"))
    key = lambda df: sorted((r.feed_id, r.member, r.line, tuple(sorted((k, v) for k, v in r.fields.items()))) for r in df.collect())
    assert key(back) == key(lines)


def test_projection_and_filters_by_feed(spark, many):
    lines = timetables.read_timetables(spark, many).where("feed_id < 'f004'")
    moved = feeds.project(lines, "2026-09-16", "2027-01-02")
    ran = lambda df, date: sorted(tuple(r) for r in feeds.active_services(df, date).collect())
    assert ran(moved, "2027-01-02") == ran(lines, "2026-09-16") == [("f000", "y"), ("f001", "y"), ("f002", "x"), ("f002", "y"), ("f003", "y")]
    left = feeds.without_route_types(lines)
    count = lambda df: {(r.member, r[1]) for r in df.groupBy("feed_id", "member").count().select("member", "count").distinct().collect()}
    assert count(left) == {("calendar.txt", 1), ("calendar_dates.txt", 2), ("routes.txt", 1), ("trips.txt", 2), ("stop_times.txt", 3), ("stops.txt", 4)}
    policy = {"whole_feeds": ["f000"], "route_ids": {"f001": ["r"]}, "route_short_name_patterns": {}, "trip_text_patterns": {"f002": "^renfort"}, "reviewed_public_feeds": ["f003"]}
    trips = {}
    for r in feeds.without_school_service(lines, policy).where("member = 'trips.txt'").collect():
        trips.setdefault(r.feed_id, set()).add(r.fields["trip_id"])
    assert trips == {"f001": {"t2"}, "f002": {"t1", "t2"}, "f003": {"t1", "t2", "t3"}}
    with pytest.raises(ContractError, match="f003"):
        feeds.without_school_service(lines, {**policy, "reviewed_public_feeds": []})


def test_archives_that_are_refused(spark, tmp_path):
    cases = {"twice": {"stops.txt": b"a\n1\n", "x/Stops.TXT": b"a\n1\n"}, "alike": {"stops.txt": b"a,A\n1,2\n"}}
    for name, members in cases.items():
        os.makedirs(tmp_path / name)
        io.write_zip(members, str(tmp_path / name / f"{name}.zip"))
        with pytest.raises(Exception, match="several times" if name == "twice" else "case only"):
            timetables.read_timetables(spark, str(tmp_path / name)).collect()
    os.makedirs(tmp_path / "broken")
    (tmp_path / "broken" / "b.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="b: "):
        timetables.read_timetables(spark, str(tmp_path / "broken")).collect()
    os.makedirs(tmp_path / "none")
    assert timetables.read_timetables(spark, str(tmp_path / "none")).count() == 0
    io.write_zip({"stops.txt": b"", "trips.txt": b"trip_id\n"}, str(tmp_path / "none" / "e.zip"))
    assert timetables.read_timetables(spark, str(tmp_path / "none")).count() == 0


def wkb(kind, body, order="<"):
    return struct.pack(f"{order}BI", int(order == "<"), kind) + body


def points(values, order="<"):
    return b"".join(struct.pack(f"{order}{len(v)}d", *v) for v in values)


RING = struct.pack("<I", 4) + points([(0, 0), (1, 0), (1, 1), (0, 0)])
POINT, LINE = wkb(1, points([(1, 2)])), wkb(2, struct.pack("<I", 2) + points([(0, 0), (1.5, 2)]))
POLYGON = wkb(3, struct.pack("<I", 2) + RING + RING)
GEOMETRIES = [
    (POINT, "POINT (1 2)"),
    (wkb(1, points([(1, 2)], ">"), ">"), "POINT (1 2)"),
    (wkb(1, points([(float("nan"), float("nan"))])), "POINT EMPTY"),
    (wkb(1001, points([(1, 2, 3)])), "POINT (1 2)"),
    (wkb(3001, points([(1, 2, 3, 4)])), "POINT (1 2)"),
    (wkb(0x80000001, points([(1, 2, 3)])), "POINT (1 2)"),
    (LINE, "LINESTRING (0 0, 1.5 2)"),
    (POLYGON, "POLYGON ((0 0, 1 0, 1 1, 0 0), (0 0, 1 0, 1 1, 0 0))"),
    (wkb(3, struct.pack("<I", 0)), "POLYGON EMPTY"),
    (wkb(1003, struct.pack("<II", 1, 3) + points([(0, 0, 9), (1, 0, 9), (0, 0, 9)])), "POLYGON ((0 0, 1 0, 0 0))"),
    (wkb(4, struct.pack("<I", 2) + POINT + POINT), "MULTIPOINT ((1 2), (1 2))"),
    (wkb(5, struct.pack("<I", 1) + LINE), "MULTILINESTRING ((0 0, 1.5 2))"),
    (wkb(6, struct.pack("<I", 1) + POLYGON), "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0), (0 0, 1 0, 1 1, 0 0)))"),
    (wkb(7, struct.pack("<I", 2) + POINT + LINE), "GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1.5 2))"),
    (None, None),
]


def test_layers_of_a_geopackage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geopackage, "PART_ROWS", 4)
    path = str(tmp_path / "a b.gpkg")
    header = b"GP\0\1" + struct.pack("<i", 2154)
    with sqlite3.connect(path) as db:
        db.execute("create table kinds (code text, n integer, unread blob, geom blob)")
        db.executemany("insert into kinds values (?, ?, x'00', ?)", [(f"{i:05d}", i, blob if blob is None else (header if i % 2 else b"GP\0\3" + struct.pack("<i4d", 2154, 0, 0, 1, 1)) + blob) for i, (blob, _) in enumerate(GEOMETRIES)])
        db.execute("create table other (name text)")
    rows = geopackage.read_geopackage(spark, path, "kinds", ["n", "code"], "geom")
    assert rows.columns == ["n", "code", "geom"] and rows.rdd.getNumPartitions() == 4
    assert [(r.n, r.code, r.geom) for r in sorted(rows.collect(), key=lambda r: int(r.n))] == [(str(i), f"{i:05d}", text) for i, (_, text) in enumerate(GEOMETRIES)]
    assert geopackage.read_geopackage(spark, path, "kinds", ["code"]).where(F.col("code") > "00009").count() == 5
    assert geopackage.read_geopackage(spark, path, "other", ["name"]).collect() == []
    with pytest.raises(ContractError, match="missing column"):
        geopackage.read_geopackage(spark, path, "kinds", ["nope"])


def test_members_are_written_as_pieces_in_order(spark, tmp_path):
    import csv
    import io as texts
    import zipfile

    rows = [("f", f"t{i:05}", i % 7, [None, "a,b", 'say "x"', "plain", "two\nlines"][i % 5]) for i in range(3000)]
    table = spark.createDataFrame(rows[::-1], "feed_id string, trip_id string, n int, words string").repartition(5)
    one = table.select("feed_id", F.col("words").alias("only"), "trip_id").where("trip_id < 't00005'").drop("trip_id")
    timetables.write_members([(table, "stop_times.txt", ["trip_id"]), (one, "single.txt", ["only"])], str(tmp_path))
    want = texts.StringIO()
    out = csv.writer(want, lineterminator="\n")
    out.writerows([("n", "trip_id", "words"), *((n, t, w) for _, t, n, w in rows)])
    with zipfile.ZipFile(tmp_path / "f.zip") as archive:
        assert archive.namelist() == ["single.txt", "stop_times.txt"]
        assert archive.read("stop_times.txt").decode() == want.getvalue()
        assert archive.read("single.txt").decode().startswith('only\n""\n')
    assert [p.name for p in tmp_path.iterdir()] == ["f.zip"]
    back = timetables.read_timetables(spark, str(tmp_path), ["stop_times.txt"]).orderBy("line").collect()
    assert [(r.line, r.fields["trip_id"], r.fields["words"]) for r in back] == [(i + 1, t, w) for i, (_, t, _, w) in enumerate(rows)]
