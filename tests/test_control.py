"""Identities, configuration, staging and numbering."""

import os

import pytest

from reachmill.functions.contracts import ContractError
from reachmill.operators import staging
from reachmill.plans import identity
from reachmill.plans.config import Config, Environment
from reachmill.sources import io

GOOD = {name: b"x\n1\n" for name in ("stops.txt", "trips.txt", "stop_times.txt", "routes.txt")}


@pytest.mark.parametrize(
    "value, text",
    [(None, "__null__"), ("", ""), (20, "20"), (20.0, "20"), (3.6, "3.6"), (-0.0, "0"), (1e15, "1000000000000000"), (0.1 + 0.2, "0.3"), (1e-7, "0.0000001"), (True, "true"), ([1, 2.0], "[1,2]"), ({"b": 1, "a": None}, '{"a":null,"b":1}')],
)
def test_canonical(value, text):
    assert identity.canonical(value) == text


def test_first_mismatch_follows_the_order():
    a = {"version": 1, "routing_parameters": {"max_rides": 2, "walk_speed": 3.6}, "git_sha": "x"}
    b = {"version": 1.0, "routing_parameters": {"max_rides": 3, "walk_speed": 4}, "git_sha": "y"}
    assert identity.first_mismatch(a, a) is None
    assert identity.first_mismatch(a, b)["component"] == "routing_parameters.walk_speed"
    assert identity.first_mismatch(a, {**a, "git_sha": "y"})["component"] == "git_sha"
    assert identity.first_mismatch(a, {**a, "git_sha": "y"}, waived=["git_sha"]) is None
    assert identity.first_mismatch({"git_sha": None}, {}) is None
    assert identity.digest({"a": 1, "b": 2}) == identity.digest({"b": 2.0, "a": 1})


def test_portable_documents(tmp_path):
    root = str(tmp_path)
    document = {"a": os.path.join(root, "x", "y.parquet"), "b": ["-Xmx4G", {"c": root}], "n": 3, "other": "/elsewhere/z", "drive": "C:\\data"}
    got = identity.make_portable(document, root)
    assert got == {"a": "x/y.parquet", "b": ["-Xmx4G", {"c": ""}], "n": 3, "other": "/elsewhere/z", "drive": "C:\\data"}
    with pytest.raises(ContractError, match=r"metadata.other: /elsewhere/z; metadata.drive"):
        identity.require_portable(got)
    with pytest.raises(ContractError):
        identity.portable(root + "-beside", root)
    assert identity.require_portable({"a": "x/y"}) == {"a": "x/y"}


def test_config():
    made = Config.read({"REACHMILL_DATA_DIR": "/d", "REACHMILL_MODES": " walk, car,", "REACHMILL_RESUME": "No", "REACHMILL_CHUNK_SIZE": "", "REACHMILL_DEPARTURE": "2026-09-16T10:00:00+0200"})
    assert (made.output_dir, made.modes, made.resume, made.chunk_size) == ("/d/matrix", ["walk", "car"], False, 50_000)
    assert made.routing_parameters(max_rides=2)["departure_datetime"] == "2026-09-16T08:00:00Z"
    for bad in ({}, {"MODES": "boat"}, {"MODES": ","}, {"CHUNK_SIZE": "0"}, {"CHUNK_SIZE": "many"}, {"RESUME": "maybe"}, {"DEPARTURE": "tomorrow"}):
        with pytest.raises(ContractError):
            Config.read({**({"REACHMILL_DATA_DIR": "/d"} if bad else {}), **{f"REACHMILL_{k}": v for k, v in bad.items()}})
    assert Environment({}).path("X") is None and Environment({"P_X": "a"}, "P_").text("X") == "a"


@pytest.fixture
def feeds(tmp_path):
    out = []
    for name in ("a", "b", "c"):
        path = str(tmp_path / f"{name}-source.zip")
        io.write_zip({**GOOD, "agency.txt": name.encode()}, path)
        out.append({"id": name, "cached_path": os.path.basename(path), "sha256": io.sha256_file(path)})
    return out


def test_pins_fail_together(feeds, tmp_path):
    assert sorted(staging.verify_pins(feeds, str(tmp_path))) == ["a", "b", "c"]
    broken = [{**feeds[0], "sha256": "0" * 64}, {**feeds[1], "cached_path": None}, {**feeds[2], "cached_path": "gone.zip"}]
    with pytest.raises(ContractError, match=r"3 feed\(s\).*a: pinned.*b: no cached_path.*c: no file gone.zip"):
        staging.verify_pins(broken, str(tmp_path))
    with pytest.raises(ContractError):
        staging.verify_pins([], str(tmp_path))


def test_override_notes_lineage(feeds, tmp_path):
    path = str(tmp_path / "new.zip")
    io.write_zip(GOOD, path)
    sha = io.sha256_file(path)
    got = staging.override(feeds, {"b": {"output_path": path, "sha256": sha, "policy": "proxy", "source_service_date": "2025-09-17", "source_path": "/x/old.zip"}})
    assert got[1]["staging_override"] == {"policy": "proxy", "sha256": sha, "source_service_date": "2025-09-17", "source_artifact": "old.zip"}
    assert got[0] == feeds[0] and staging.verify_pins(got, str(tmp_path))["b"] == path
    for bad in ({"z": {"output_path": path, "sha256": sha}}, {"a": {"output_path": path}}, {"a": {"output_path": path + "x", "sha256": sha}}):
        with pytest.raises(ContractError):
            staging.override(feeds, bad)


def test_staging_copies_prunes_and_refuses(feeds, tmp_path):
    data, target = str(tmp_path), str(tmp_path / "network")
    block = staging.stage(feeds, target, data, excluded={"c": "no service"})
    assert [f["id"] for f in block["feeds"]] == ["a", "b"] and block["excluded"] == [{"id": "c", "reason": "no service"}]
    (tmp_path / "network" / "own.zip").write_bytes(b"kept")

    def refuse(paths):
        raise ContractError("gate")

    with pytest.raises(ContractError, match="gate"):
        staging.stage(feeds[2:], target, data, gate=refuse)
    assert sorted(os.listdir(target)) == ["a.zip", "b.zip", "own.zip", "staged.json"]
    block = staging.stage(feeds, target, data, transform=lambda feed, path: None if feed["id"] == "a" else path)
    assert block["skipped"] == ["a"] and sorted(os.listdir(target)) == ["b.zip", "c.zip", "own.zip", "staged.json"]
    assert [f["sha256"] for f in block["feeds"]] == [f["sha256"] for f in feeds[1:]]


def test_numbered_runs_over_stretches(spark):
    from reachmill.operators.ranking import numbered

    values = [(i * 7919) % 100_003 for i in range(20_000)]
    got = numbered(spark.createDataFrame([(v,) for v in values] + [(None,)], "v long"), "v").collect()
    assert sorted((r.place, r.v) for r in got)[1:] == list(enumerate(sorted(values), 2)) and min(got, key=lambda r: r.place).v is None
    words = spark.createDataFrame([(str(v),) for v in values], "v string")
    assert [r.v for r in sorted(numbered(words, "v", "n").collect(), key=lambda r: r.n)] == sorted(map(str, values))
    assert numbered(words.limit(0), "v").count() == 0


def test_numbered_deals_ties_to_several_tasks(spark):
    from pyspark.sql import functions as F

    from reachmill.operators.ranking import numbered

    # two thirds of the rows share one value, a third are equal in all columns
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(7).alias("v"), F.when(F.col("id") % 3 != 1, F.col("id")).alias("w"))
    with_parts = lambda: numbered(rows, "v")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_parts().withColumn("part", F.spark_partition_id())
        sizes = [r[1] for r in got.groupBy("part").count().collect()]
        places = [(r.place, r.v) for r in got.select("place", "v").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted(p for p, _ in places) == list(range(1, 30_001)) and [v for _, v in sorted(places)] == sorted(v for _, v in places)
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * 30_000 / len(sizes)
    again = {(r.v, r.w, r.place) for r in with_parts().where("w is not null").collect()}
    assert again == {(r.v, r.w, r.place) for r in numbered(rows.repartition(7, "w"), "v").where("w is not null").collect()}
