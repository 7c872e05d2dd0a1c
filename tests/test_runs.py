"""Runs by mode, reroutes, publishing, lasting folders, and the smaller readers and checks."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from reachmill.functions import contracts
from reachmill.functions.contracts import RUNGS, ContractError, validate_gains
from reachmill.operators import aggregates, gtfs, matrix, monolith, region, routing, universe
from reachmill.plans import inputs, publisher, registry, reroute, roots, runner
from reachmill.plans.runner import Run
from reachmill.sources import io

NOON = datetime.datetime(2026, 9, 16, 10, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def town(spark):
    o = spark.createDataFrame([(f"o{i}", i, -1.3 + i / 200, 48.1) for i in range(5)], "id string, ord long, lon double, lat double")
    d = spark.createDataFrame([(f"d{i}", i, -1.3 + i / 100, 48.1) for i in range(3)], "id string, ord long, lon double, lat double")
    return o, d, spark.createDataFrame([("d0", "A"), ("d1", "B"), ("d2", "A")], "id string, TYPEQU string")


@pytest.fixture(scope="module")
def base(town, tmp_path_factory):
    run = Run(str(tmp_path_factory.mktemp("base") / "r"), *town, modes=["walk", "bike", "car", "transit"], chunk_size=2, departure=NOON)
    run.execute()
    return run


def test_modes_have_times_of_their_own(base, town):
    assert not base.owed()
    near = {r["mode"]: r["t"] for r in base.matrix().groupBy("mode").agg(F.sum("tt_nearest").alias("t")).collect()}
    assert near["walk"] > near["bike"] > near["car"]
    for mode in ("walk", "bike", "car"):
        want = matrix.derive_matrix(matrix.collapse_pairs(routing.stub_dispatch(*town[:2], mode=mode)), town[2], mode)
        got = base.matrix().where(F.col("mode") == mode).select(want.columns)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    want = matrix.derive_transit_matrix(routing.stub_transit_route(*town[:2]), town[2])
    assert {tuple(r) for r in base.transit().select(want.columns).collect()} == {tuple(r) for r in want.collect()}


def test_transit_needs_a_departure(town, tmp_path):
    for modes, departure, word in ((["transit"], None, "departure"), (["transit"], datetime.date(2026, 9, 16), "departure"), (["boat"], NOON, "boat"), ([], NOON, "no mode")):
        with pytest.raises(ContractError, match=word):
            Run(str(tmp_path / "x"), *town, modes=modes, departure=departure)
    assert not os.path.exists(tmp_path / "x")


def test_another_departure_is_another_run(base, town):
    with pytest.raises(ContractError, match="departure"):
        Run(base.folder, *town, modes=base.modes, chunk_size=2, departure=NOON + datetime.timedelta(hours=1))


def test_gains_of_chunks(base):
    gains = base.gains()
    assert validate_gains(gains).count() == base.transit().count()
    before = {f: os.path.getmtime(os.path.join(p, f)) for p, _, files in os.walk(os.path.join(base.folder, "gains")) for f in files if f.endswith(".parquet")}
    base.gains()
    assert before == {f: os.path.getmtime(os.path.join(p, f)) for p, _, files in os.walk(os.path.join(base.folder, "gains")) for f in files if f.endswith(".parquet")}


def test_gains_follow_their_chunks(town, tmp_path):
    far = []

    def router(origins, destinations, cap=20, mode="car", departure=None):
        return routing.stub_dispatch(origins, destinations, cap=cap, mode=mode, departure=departure).withColumns({c: F.col(c) + 1 for c in ("travel_time", "travel_time_p1", "travel_time_p50") if far and mode == "walk" and c == "travel_time"})

    make = lambda: Run(str(tmp_path / "r"), *town, modes=["walk", "transit"], chunk_size=2, departure=NOON, router=router)
    run = make()
    run.execute()
    before = {(r.batiment_id, r.TYPEQU): r.time_gain_p1 for r in run.gains().collect()}
    far.append(1)  # the walk of one chunk is made anew, and takes longer
    victim = run.chunk_path("walk", 2)
    os.remove(next(os.path.join(victim, f) for f in os.listdir(victim) if f.endswith(".parquet")))
    again = make()
    again.execute()
    moved = {r.batiment_id for r in again._chunks(["walk"]).where("chunk_id = 2").collect()}
    after = {(r.batiment_id, r.TYPEQU): r.time_gain_p1 for r in again.gains().collect()}
    assert moved and after == {k: v + 1 if k[0] in moved and v is not None else v for k, v in before.items()}


def test_one_job_a_mode_and_failures_apart(spark, town, tmp_path, monkeypatch):
    written = []
    real = io.write_chunks
    monkeypatch.setattr(io, "write_chunks", lambda rows, path: (written.append(1), real(rows, path)))
    run = Run(str(tmp_path / "a"), *town, modes=["walk", "car"], chunk_size=1)
    run.execute()
    assert len(written) == 2 and not run.owed() and len(run.manifest["entries"]) == 10
    assert sum(e["n_rows"] for e in run.manifest["entries"]) == run.matrix().count()

    def beyond(origins, destinations, cap=20, mode="car", departure=None):
        # one origin's times break the contract
        return routing.stub_dispatch(origins, destinations, cap=cap, mode=mode).withColumn("travel_time", F.when(F.col("from_id") == "coord_o_000003", -1.0).otherwise(F.col("travel_time")))

    run = Run(str(tmp_path / "b"), *town, modes=["car"], chunk_size=1, router=beyond)
    run.execute()
    assert {e["chunk_id"]: e["status"] for e in run.manifest["entries"]} == {1: "complete", 2: "complete", 3: "failed", 4: "complete", 5: "complete"}
    assert "cap (" in run.manifest["entries"][2]["error"] and run.matrix().where("tt_nearest < 0").count() == 0
    # a chunk from which nothing is reached is complete without rows
    lost = town[0].unionByName(spark.createDataFrame([("o9", 9, 5.0, 45.0)], town[0].schema))
    run = Run(str(tmp_path / "c"), lost, *town[1:], modes=["car"], chunk_size=1)
    run.execute()
    assert not run.owed() and [e["n_rows"] for e in run.manifest["entries"]][-1] == 0 and run.matrix().count() > 0
    run.sweep()
    assert not run.owed()


def _second_fails(monkeypatch, *modes):
    """Chunk 2 of the modes fails, alone and with others."""
    real = Run._rows

    def rows(run, mode, chunks):
        if mode in modes and 2 in chunks:
            raise RuntimeError("the router broke down")
        return real(run, mode, chunks)

    monkeypatch.setattr(Run, "_rows", rows)


@pytest.mark.parametrize("name, mode", [("resume_runner", "car"), ("run_gains", "walk"), ("run_gains", "transit")])
def test_a_failed_chunk_is_no_result_of_a_query(spark, monkeypatch, name, mode):
    _second_fails(monkeypatch, mode)
    with pytest.raises(ContractError, match=rf"owes 1 of \d chunk\(s\) of {mode}: {mode} 2 failed \(the router broke down\)"):
        registry.queries()[name](spark, "/root/testdata/sf0.001")


def test_a_failed_chunk_is_no_result_of_a_run(base, town, tmp_path, monkeypatch):
    make = lambda: Run(str(tmp_path / "r"), *town, modes=["walk", "transit"], chunk_size=2, departure=NOON)
    with monkeypatch.context() as patched:
        _second_fails(patched, "walk")
        run = make()
        run.execute()
    assert [(e["mode"], e["chunk_id"], e["status"]) for e in run.owed()] == [("walk", 2, "failed")]
    for result in (lambda: run.matrix(strict=True), run.gains, lambda: run._chunks(["walk"]), lambda: reroute.address_table(run, None, None, None), lambda: reroute.address_table(base, run, None, None)):
        with pytest.raises(ContractError, match="walk 2 failed"):
            result()
    with pytest.warns(UserWarning, match=r"owes 1 of 3 chunk\(s\) of walk"):
        some = run.gains(strict=False)  # no walk is known there, which isn't that there is none
    assert {r[0] for r in some.select("chunk_id").distinct().collect()} == {1, 3}
    with pytest.warns(UserWarning, match="walk 2 failed"):
        assert {r[0] for r in run.matrix().where("mode = 'walk'").select("chunk_id").distinct().collect()} == {1, 3}
    with pytest.raises(ContractError, match="no bike"):
        run.require_complete(["bike"])
    run = make()
    run.execute()
    both = lambda r: {tuple(x) for x in r.gains().collect()}
    assert run.matrix(strict=True).count() == base.matrix().where("mode in ('walk', 'transit')").count() and both(run) == both(base)


def test_what_is_left_of_a_chunk_is_no_chunk(town, tmp_path, monkeypatch):
    real = io.write_chunks
    monkeypatch.setattr(io, "write_chunks", lambda rows, path: real(rows.repartition(3, "batiment_id"), path))
    make = lambda: Run(str(tmp_path / "r"), *town, modes=["walk"], chunk_size=5)
    run = make()
    run.execute()
    n, folder = run.matrix().count(), run.chunk_path("walk", 1)
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    assert len(files) > 1
    os.remove(os.path.join(folder, files[0]))
    for _ in range(2):  # the first one finds the difference, the second one valid rows
        run.sweep()
        assert [e["status"] for e in run.manifest["entries"]] == ["pending"] and run.metadata()["modes"]["walk"] == {"chunks": 1, "complete": 0, "n_rows": 0}
    run.execute()
    assert run.matrix(strict=True).count() == run.metadata()["modes"]["walk"]["n_rows"] == n
    run.manifest["entries"][0].update(status="running", sha256=None, n_rows=None)  # a run that broke before it could say so
    run.save()
    again = make()
    again.sweep()
    assert not again.owed() and again.matrix(strict=True).count() == n


def test_unreadable_files_are_no_empty_chunk(town, tmp_path, monkeypatch):
    run = Run(str(tmp_path / "r"), *town, modes=["walk"], chunk_size=5)
    with monkeypatch.context() as patched:
        patched.setattr(runner, "file_digests", lambda *_: {})
        run.execute()
    assert run.manifest["entries"][0]["status"] == "failed" and "of which 0 can be read" in run.manifest["entries"][0]["error"]
    with pytest.raises(ContractError, match="walk 1 failed"):
        run.matrix()


def test_runs_without_rows(town, tmp_path):
    o, d, types = town
    far = d.withColumn("lon", F.lit(60.0))
    for name, origins, destinations in (("nowhere", o, far), ("nobody", o.limit(0), d)):
        run = Run(str(tmp_path / name), origins, destinations, types, modes=["walk", "transit"], chunk_size=2, departure=NOON)
        run.execute()
        assert not run.owed() and run.matrix(strict=True).count() == run.transit().count() == run.gains().count() == 0
        assert set(run.matrix().columns) == {*contracts.MATRIX_KEY, "chunk_id", "tt_nearest", *contracts.ladder()}

    def idle(origins, destinations, cap=20, mode="car", departure=None):
        return routing.stub_dispatch(origins, destinations, cap=cap, mode=mode, departure=departure).where(F.lit(mode != "walk"))

    run = Run(str(tmp_path / "idle"), *town, modes=["walk", "transit"], chunk_size=2, departure=NOON, router=idle)
    run.execute()
    assert run.gains().where("not walk_available").count() == run.matrix().count() == run.transit().count() > 0


def test_contract_reports_count_in_one_pass(spark):
    rows = [("b1", "A", "walk", 8.0, 0, 1, 1, 2), ("b1", "A", "walk", 8.0, 0, 1, 1, 2), ("", "A", "boat", 21.0, 0, 1, 0, 2), ("b2", "A", "car", 4.0, 0, 1, 1, 1)]
    df = spark.createDataFrame(rows, "batiment_id string, TYPEQU string, mode string, tt_nearest double, count_5 int, count_10 int, count_15 int, count_20 int")
    report = {r[0]: r[1] for r in contracts.matrix_report(df).collect()}
    assert report == {"empty_id": 1, "mode": 1, "cap": 1, "count": 0, "nearest": 2, "monotone": 1, "duplicate_key": 1}
    seen, counts = contracts.observed(df, contracts.matrix_rules(), "x")
    seen.write.format("noop").mode("overwrite").save()
    assert counts.get["n_rows"] == 4 and contracts.broken(counts) == ["empty_id (1 rows)", "mode (1 rows)", "cap (1 rows)", "nearest (2 rows)", "monotone (1 rows)"]


def test_digest_tree_of_any_depth(spark, monkeypatch):
    rows = spark.range(3000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("lon"), F.lit(1).alias("lat"))
    for children in (256, 16, 2):  # two levels, and more
        monkeypatch.setattr(routing, "CHILDREN", children)
        key = routing.universe_key(rows).first()[0]
        assert key == routing.universe_key(rows.repartition(7, "lon")).first()[0]
        assert key != routing.universe_key(rows.where("id <> '5'")).first()[0] and key != routing.universe_key(rows.unionByName(rows.limit(1))).first()[0]
    assert routing.universe_key(rows.limit(0)).count() == 1


def test_hot_coordinates_spread_over_tasks(spark, monkeypatch):
    from reachmill.operators import joins

    monkeypatch.setattr(joins, "PER_TASK", 20)
    # half of all identities stand at one point, on both sides
    origins = spark.range(2000).select(F.concat(F.lit("o"), "id").alias("id"), F.concat(F.lit("p"), F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 90)).alias("point_id"))
    destinations = spark.range(60).select(F.concat(F.lit("d"), "id").alias("id"), F.concat(F.lit("q"), F.when(F.col("id") < 30, 0).otherwise(F.col("id"))).alias("point_id"))
    pairs = spark.createDataFrame([(f"p{i}", f"q{j}", float(i + j), i) for i in range(0, 90, 3) for j in (0, 31, 45)] + [("p0", "nowhere", 1.0, 0)], "from_id string, to_id string, travel_time double, extra int")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = routing.expand_pairs(pairs, origins, destinations)
        rows = sorted(map(tuple, got.collect()))
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    o, d = ({} for _ in range(2))
    for at, link in ((o, origins), (d, destinations)):
        for r in link.collect():
            at.setdefault(r.point_id, []).append(r.id)
    assert rows == sorted((a, b, r.travel_time, r.extra) for r in pairs.collect() for a in o.get(r.from_id, []) for b in d.get(r.to_id, []))
    assert len(rows) > 30_000 and max(sizes) < 2 * len(rows) / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_dry_run(town):
    assert Run.dry_run(*town[:2], modes=["walk", "car"], chunk_size=2) == {
        "kind": "dry_run", "modes": ["walk", "car"], "origins": {"n_identities": 5, "n_coordinates": 5, "n_chunks": 3}, "destinations": {"n_identities": 3, "n_coordinates": 3, "n_chunks": 2}, "chunks": 6,
    }


def test_reroutes(spark, base, town, tmp_path):
    addresses = spark.createDataFrame(
        [("a0", -1.3, 48.1, 1, 1, "existing", "coord_o_000001"), ("a1", -1.301, 48.1, 2, 1, "reroute", None), ("a2", -1.302, 48.1, 1, 1, "reroute", None)],
        "address_id string, lon double, lat double, n_non_dependance_constructions long, n_residential_groups long, routing_source string, routing_point_id string",
    )
    links = spark.createDataFrame([("o0", "a0"), ("o1", "a1"), ("o2", "a2")], "origin_id string, address_id string")
    key = reroute.reroute_key(addresses, links)
    assert key == reroute.reroute_key(addresses.orderBy(F.desc("address_id")).select(*addresses.columns[::-1]), links.unionByName(links))
    run = reroute.reroute_run(base, str(tmp_path / "r"), addresses, town[2], key)
    run.execute()
    same = lambda df: sorted((r.id, r.lon, r.lat) for r in df.collect())
    assert same(reroute.base_destinations(base)) == same(town[1])
    assert {r[0] for r in run.matrix().select("batiment_id").distinct().collect()} == {"a1", "a2"}
    changed = reroute.reroute_key(addresses, links.limit(2))
    with pytest.raises(ContractError, match="plan_key"):
        reroute.reroute_run(base, str(tmp_path / "r"), addresses, town[2], changed)
    link = spark.read.parquet(os.path.join(base.folder, "plan", "link"))
    wide = reroute.address_table(base, run, link, addresses)
    assert {r[0] for r in wide.select("address_id").distinct().collect()} == {"a0", "a1", "a2"}
    slow = monolith.build({m: base.matrix().where(f"mode = '{m}'").drop("chunk_id") for m in ("walk", "bike", "car")}, matrix.transit_gains(base.transit(), base.matrix().where("mode = 'walk'")), link, addresses)
    fast = monolith.build_wide(base.matrix(), base.transit(), link, addresses)
    assert fast.columns == slow.columns and {tuple(r) for r in fast.collect()} == {tuple(r) for r in slow.collect()}


def test_wide_build_folds_points(spark):
    """Buildings that share a point give one row for each of its addresses and types, as the build by families does."""
    columns = ", ".join(f"count_{r} int" for r in RUNGS)
    rows = [("b1", "T", "walk", 4.0, 1, 1, 1, 2), ("b2", "T", "walk", 4.0, 1, 1, 1, 2), ("b1", "T", "car", 2.0, 3, 3, 3, 3), ("b3", "U", "bike", 9.0, 0, 1, 1, 1)]
    m = spark.createDataFrame(rows, f"batiment_id string, TYPEQU string, mode string, tt_nearest double, {columns}")
    p50 = ", ".join(f"count_{r}_p50 int" for r in RUNGS)
    t = spark.createDataFrame([("b1", "T", 3.0, 6.0, 2, 2, 2, 2, 0, 1, 1, 1), ("b2", "T", 3.0, 6.0, 2, 2, 2, 2, 0, 1, 1, 1), ("b3", "V", 5.0, 8.0, 1, 1, 1, 1, 0, 1, 1, 1)], f"batiment_id string, TYPEQU string, travel_time_p1 double, travel_time_p50 double, {columns}, {p50}")
    link = spark.createDataFrame([("b1", "p1"), ("b2", "p1"), ("b3", "p2")], "id string, point_id string")
    a = spark.createDataFrame([("a1", 1.0, 2.0, 1, 1, "existing", "p1"), ("a2", 1.0, 2.0, 1, 1, "existing", "p1"), ("a3", 1.0, 2.0, 1, 1, "existing", "p2")], "address_id string, lon double, lat double, n_non_dependance_constructions long, n_residential_groups long, routing_source string, routing_point_id string")
    slow = monolith.build({x: m.where(f"mode = '{x}'") for x in ("walk", "bike", "car")}, matrix.transit_gains(t, m.where("mode = 'walk'")), link, a)
    fast = monolith.build_wide(m, t, link, a, strict=True)
    assert fast.count() == 4 and {tuple(r) for r in fast.collect()} == {tuple(r) for r in slow.collect()}


def test_publisher(spark, tmp_path):
    spine = spark.createDataFrame([("a1", "c1", "C1", "e1", "d1", "r"), ("a2", "c1", "C1", "e1", "d1", "r"), ("a3", "c2", "C2", None, "d1", "r")], "address_id string, code_insee string, nom_commune string, epci string, code_departement string, region string")
    metrics = spark.createDataFrame([("a1", "T", 4, 2), ("a3", "U", 1, 1)], "address_id string, TYPEQU string, count_5_walk int, transit_gain_count_5_p1 int")
    types = spark.createDataFrame([("T",), ("U",)], "TYPEQU string")
    labels = spark.createDataFrame([("T", "Tea"), ("U", "Umbrellas"), ("X", "other")], "TYPEQU string, nom_typequ string")
    axes = {"commune": spine.select("code_insee", "nom_commune").unionByName(spark.createDataFrame([("c9", "C9")], "code_insee string, nom_commune string")), "departement": spine.select("code_departement")}
    document = publisher.publish(metrics, spine, types, labels, axes, ["count_5_walk", "transit_gain_count_5_p1"], str(tmp_path / "out"), (0.5,))
    assert document["levels"]["commune"]["n_rows"] == 6 and document["levels"]["commune"]["coverage"] == {"observed": 2, "no_observation": 2, "no_address": 2}
    assert io.read_json(str(tmp_path / "out" / "metadata.json"), "published_levels") == document
    rows = {(r.code_insee, r.TYPEQU): r for r in spark.read.parquet(str(tmp_path / "out" / "commune")).collect()}
    assert (rows["c1", "T"].count_5_walk_mean, rows["c1", "T"].count_5_transitgain_mean, rows["c1", "T"].nom_typequ) == (2.0, 1.0, "Tea")
    assert rows["c9", "U"].count_5_walk_mean is None and rows["c9", "U"].n_addresses == 0
    with pytest.raises(ContractError, match="without a label"):
        publisher.labelled_types(types, labels.where("TYPEQU = 'T'"))
    with pytest.raises(ContractError, match="not on the axis"):
        publisher.level_table(metrics, spine, types, labels, axes["commune"].where("code_insee = 'c9'"), "commune", ["count_5_walk"], (0.5,))
    territories, communes = spine.select("address_id", "code_insee"), spine.select("code_insee", "nom_commune", "epci", "code_departement", "region").distinct()
    assert publisher.located_spine(spine, territories, communes).count() == 3
    with pytest.raises(ContractError, match="outside of every commune"):
        publisher.located_spine(spine, territories, communes.where("code_insee = 'c1'"))
    with pytest.raises(ContractError, match="duplicate key"):
        publisher.located_spine(spine, territories, communes.unionByName(communes))


def test_all_levels_come_from_one_reading(spark, tmp_path):
    from reachmill.sources.lineage import cut

    spine = spark.createDataFrame([(f"a{i}", f"c{i % 4}", f"C{i % 4}", f"e{i % 3}" if i % 5 else None, f"d{i % 2}", "r") for i in range(60)], "address_id string, code_insee string, nom_commune string, epci string, code_departement string, region string")
    io.write_table(spark.createDataFrame([(f"a{i}", t, i % 7, i % 3 - 1) for i in range(0, 60, 2) for t in "TU"], "address_id string, TYPEQU string, count_5_walk int, gain int"), str(tmp_path / "metrics"))
    metrics, types = spark.read.parquet(str(tmp_path / "metrics")), spark.createDataFrame([("T",), ("U",), ("V",)], "TYPEQU string")
    reads = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    one = aggregates.dense_levels(metrics, spine, types, ["count_5_walk", "gain"], probs=(0.5,))
    assert {reads(df) for df in one.values()} == {1}
    kept = aggregates.dense_levels(metrics, spine, types, ["count_5_walk", "gain"], probs=(0.5,), stored=cut)
    assert {reads(df) for df in kept.values()} == {0}
    for level, df in one.items():
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, kept[level].select(df.columns).collect()))
    # metrics are columns when they meet the spine, and rows only after that
    plan = one["commune"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Expand") < plan.rindex("Join Inner")


def test_lasting_folders(tmp_path):
    root = tmp_path / "root"
    roots.mark_root(str(root))
    with pytest.raises(ContractError, match="already"):
        roots.mark_root(str(root))
    (root / "a" / "b").mkdir(parents=True)
    (tmp_path / "other").mkdir()
    assert roots.require_root(str(root / "a" / "b"), str(root)) and roots.find_root(str(tmp_path / "other")) is None
    os.symlink(tmp_path / "other", root / "alias")
    for path in (tmp_path / "other", root / "alias"):
        with pytest.raises(ContractError):
            roots.require_root(str(path), str(root))


def test_networks_are_found_by_what_made_them(tmp_path):
    pin = lambda n: {"id": n, "sha256": n * 4}
    identity = roots.network_identity(pin("osm"), [pin("b"), pin("a")])
    assert roots.network_key(identity) == roots.network_key(roots.network_identity(pin("osm"), [pin("a"), pin("b")]))
    assert roots.probe_network(str(tmp_path), identity)["reason"] == "no network of this identity"
    folder = os.path.join(str(tmp_path), roots.network_key(identity)[:16])
    os.makedirs(folder)
    with open(os.path.join(folder, "net.dat"), "w") as f:
        f.write("net")
    assert roots.save_network(str(tmp_path), identity, [os.path.join(folder, "net.dat")]) == folder
    assert roots.probe_network(str(tmp_path), identity)["hit"] and roots.find_network(str(tmp_path), "osm" * 4) == [folder]
    record = io.read_json(os.path.join(folder, "network.json"))
    io.write_json({**record, "identity": {**identity, "cap_minutes": 30}}, os.path.join(folder, "network.json"))
    assert not roots.probe_network(str(tmp_path), identity)["hit"]
    io.write_json(record, os.path.join(folder, "network.json"))
    with open(os.path.join(folder, "net.dat"), "a") as f:
        f.write("!")
    assert "differs" in roots.probe_network(str(tmp_path), identity)["reason"]
    with pytest.raises(ContractError, match="twice"):
        roots.network_identity(pin("osm"), [pin("a"), pin("a")])


def test_service_dates(spark):
    late = datetime.datetime(2026, 9, 15, 22, 30, tzinfo=datetime.timezone.utc)
    assert gtfs.resolve_service_date(late) == datetime.date(2026, 9, 16) and gtfs.resolve_service_date(late, "20260101") == datetime.date(2026, 1, 1)
    with pytest.raises(ContractError):
        gtfs.resolve_service_date(datetime.date(2026, 9, 16))
    df = spark.sql("SELECT timestamp'2026-09-15 22:30:00' AS t, timestamp'2026-01-15 22:30:00' AS w, '1234:05:06' AS clock")
    assert tuple(df.select(gtfs.local_date(F.col("t")), gtfs.local_date(F.col("w")), gtfs.seconds(F.col("clock"))).first()) == (datetime.date(2026, 9, 16), datetime.date(2026, 1, 15), 1234 * 3600 + 306)


def test_strict_inputs(spark, town):
    pairs = routing.stub_route(*town[:2])
    with pytest.raises(ContractError, match="duplicate key"):
        matrix.derive_matrix(pairs, town[2].unionByName(town[2]), "car", strict=True)
    totals = spark.createDataFrame([("k", 3)], "k string, n_total long")
    for rows in ([("k", 1.0, 4.0)], [("k", None, 1.0)], [("k", 1.0, 0.5)], [("k", 1.0, None)], [("k", 1.0, -1.0)]):
        with pytest.raises(Exception, match="quantiles"):
            aggregates.implicit_zero_quantiles(spark.createDataFrame(rows, "k string, value double, weight double"), ["k"], totals, (0.5,)).collect()
    points = spark.createDataFrame([(f"p{i:02}",) for i in range(5)], "id string")
    assert [r.id for r in routing.chunk_slice(points, 2, 2).orderBy("id").collect()] == ["p02", "p03"]
    for chunk in (0, 4):
        with pytest.raises(ContractError, match="no chunk"):
            routing.chunk_slice(points, chunk, 2)
    with pytest.raises(Exception, match="census"):
        routing.census(points.limit(2), points, 2).collect()
    link = spark.createDataFrame([("b1", "p1"), ("b2", "p1")], "id string, point_id string")
    rows = spark.createDataFrame([("b1",), ("b2",), ("b9",)], "batiment_id string")
    assert monolith.base_point_ids(rows, link).count() == 1
    with pytest.raises(ContractError, match="no routing point"):
        monolith.base_point_ids(rows, link, strict=True)


def test_warnings(spark):
    origins = spark.createDataFrame([("a", 1.0, 1.0), ("b", None, 1.0)], "origin_id string, lon double, lat double")
    with pytest.warns(UserWarning, match="1 of 2"):
        assert universe.select_origins(origins, ["a", "z", "a"]).count() == 1
    with pytest.raises(ContractError):
        universe.select_origins(origins, ["z"])
    with pytest.warns(UserWarning, match="without coordinates"):
        assert universe.routable(origins).count() == 1
    u = spark.createDataFrame([("A", "strip"), ("A", "region"), ("B", "strip")], "TYPEQU string, zone string")
    with pytest.warns(UserWarning, match="B"):
        assert [r[0] for r in universe.warn_strip_only(u).collect()] == ["B"]


def test_address_points(spark):
    rows = spark.createDataFrame([("a", "POINT (700000 6600000)"), ("a", "POINT (700000 6600000)"), ("b", "POINT (352000 6789000)")], "address_id string, wkt string")
    got = {r.address_id: (round(r.lon, 3), round(r.lat, 3)) for r in universe.address_points_from_wkt(rows).collect()}
    assert got["a"] == (3.0, 46.5) and -1.8 < got["b"][0] < -1.5 and 48.0 < got["b"][1] < 48.3
    for extra, word in ((("a", "POINT (1 2)"), "duplicate key"), (("c", "POINT EMPTY"), "without geometry")):
        more = rows.unionByName(spark.createDataFrame([extra], rows.schema))
        with pytest.raises(ContractError, match=word):
            universe.address_points_from_wkt(more)
        assert universe.address_points_from_wkt(more, strict=False).count() == 2
    layer = spark.createDataFrame([("53", "x"), ("22", "y"), ("22", "z")], "code string, name string")
    assert universe.one_feature(layer, "code", "53").first().name == "x"
    for code in ("22", "99"):
        with pytest.raises(ContractError, match="expected one feature"):
            universe.one_feature(layer, "code", code)


def test_equipment_reader(spark, tmp_path):
    extra = ["NOTE", *io.EQUIPMENT_COLUMNS, "LAST"]
    line = lambda **own: ";".join(own.get(c, "x") for c in extra)
    text = [";".join(extra), line(DEP="01", SIRET="00123", LONGITUDE="-1.3", LATITUDE="48.2", QUALITE_GEOLOC="_U"), line(DEP="99", LONGITUDE="_Z", LATITUDE="_Z", QUALITE_GEOLOC="11"), line(DEP="99", LONGITUDE="-1.39", LATITUDE="48.05", QUALITE_GEOLOC="11")]
    (tmp_path / "bpe.csv").write_text("\n".join(text))
    rows = io.read_equipment(spark, str(tmp_path / "bpe.csv"))
    assert rows.columns == io.EQUIPMENT_COLUMNS and rows.first().SIRET == "00123" and rows.where("LONGITUDE is null").count() == 1
    edges = region.wkt_edges(spark.createDataFrame([("POLYGON((-1.4 48.1, -1.2 48.1, -1.2 48.3, -1.4 48.3, -1.4 48.1))",)], "wkt string"))
    assert [(r.DEP, r.zone) for r in universe.region_universe(rows, edges, ["01"]).orderBy("DEP").collect()] == [("01", "region"), ("99", "strip")]


def test_residential_universe(spark):
    point = "x double, y double"
    groups = spark.createDataFrame([("g1", "35001", "35", 1.0, 1.0, 0), ("g2", "35001", "35", 2.0, 2.0, 0), ("g3", "22001", "22", 3.0, 3.0, 0), ("g4", "35001", "35", 4.0, 4.0, 0)], f"batiment_groupe_id string, code_commune_insee string, code_departement_insee string, {point}, fictive int")
    usage = spark.createDataFrame([("g1", "Résidentiel individuel"), ("g2", "Résidentiel collectif"), ("g3", "Résidentiel individuel"), ("g4", "Tertiaire")], "batiment_groupe_id string, usage_principal_bdnb_open string")
    constructions = spark.createDataFrame([("c1", "g1", True, False, 5.0, 5.0), ("c2", "g1", False, False, 6.0, 6.0), ("c9", "g4", True, False, 7.0, 7.0)], f"batiment_construction_id string, batiment_groupe_id string, has_address boolean, fictive boolean, {point}")
    constructions = constructions.withColumn("fictive", F.col("fictive").cast("int"))
    relations = spark.createDataFrame([("g1", "a1", 20, 1), ("g1", "a2", 30, 2), ("g2", "a3", None, 3)], "batiment_groupe_id string, address_id string, fiabilite int, ord long")
    points = spark.createDataFrame([("a1", 8.0, 8.0), ("a2", 9.0, 9.0)], f"address_id string, {point}")
    groups35 = universe.residential_groups(groups, usage, ["35"])
    assert {r[0] for r in groups35.select("batiment_groupe_id").collect()} == {"g1", "g2"}
    assert universe.residential_groups(groups, usage, communes=["22001"]).count() == 1
    constructions = constructions.withColumn("fictive", F.col("fictive") == 1)
    groups = groups.withColumn("fictive", F.col("fictive") == 1)
    got = {r.origin_id: r for r in universe.residential_universe(groups, usage, constructions, relations, points, ["35"]).collect()}
    assert set(got) == {"c1", "c2", "g2"}
    assert (got["c1"].x, got["c1"].geometry_source, got["c1"].n_addresses, got["c1"].is_dependance_candidate) == (9.0, "geom_adresse", 2, False)
    assert got["c2"].is_dependance_candidate and (got["g2"].x, got["g2"].geometry_source) == (2.0, "geom_groupe")
    assert (got["c1"].granularity, got["g2"].granularity, got["g2"].usage_principal_bdnb_open) == ("batiment_construction", "groupe", "Résidentiel collectif")
    # one origin a group; the address is too unsure, so the first real construction gives the place
    by_group = {r.origin_id: r for r in universe.residential_universe(groups, usage, constructions, relations, points, ["35"], min_fiabilite=50, granularity="groupe").collect()}
    assert set(by_group) == {"g1", "g2"} and (by_group["g1"].x, by_group["g1"].geometry_source, by_group["g1"].is_dependance_candidate) == (5.0, "geom_cstr", False)
    fictive = groups.withColumn("fictive", F.lit(True))
    assert {r.origin_id for r in universe.residential_universe(fictive, usage, constructions, relations, points, ["35"]).collect()} == {"c1", "c2"}
    kept = universe.residential_universe(fictive, usage, constructions, relations, points, ["35"], drop_fictive_only=False).collect()
    assert {(r.origin_id, r.geometry_source) for r in kept} == {("c1", "geom_adresse"), ("c2", "geom_adresse"), ("g2", "fictive")}
    unknown = fictive.withColumn("fictive", F.lit(None).cast("boolean"))  # neither real nor fictive: not used
    assert {r.origin_id for r in universe.residential_universe(unknown, usage, constructions, relations, points, ["35"], drop_fictive_only=False).collect()} == {"c1", "c2"}
    mixed = usage.unionByName(spark.createDataFrame([("g5", "Résidentiel indifférencié")], usage.schema))
    more = groups.unionByName(groups.where("batiment_groupe_id = 'g2'").withColumn("batiment_groupe_id", F.lit("g5")))
    for wanted in (False, True):
        assert ("g5" in {r.origin_id for r in universe.residential_universe(more, mixed, constructions, relations, points, include_indifferencie=wanted).collect()}) == wanted
    with pytest.raises(ContractError, match="granularity"):
        universe.residential_universe(groups, usage, constructions, relations, points, granularity="street")


def test_territories(spark):
    communes = spark.createDataFrame([("35001", "A", "35", "53", "1/2"), ("22001", "B", "22", "53", "")], "code_insee string, nom_officiel string, code_insee_du_departement string, code_insee_de_la_region string, codes_siren_des_epci string")
    walk = universe.commune_crosswalk(communes, ["35"], strict=True)
    assert walk.first().epci == "1/2" and universe.commune_crosswalk(communes).where("epci is null").count() == 1
    assert [r.code_insee for r in universe.communes_of_body(communes, "2").collect()] == ["35001"]
    with pytest.raises(ContractError):
        universe.commune_crosswalk(communes.unionByName(communes), strict=True)
    names = {"departement": spark.createDataFrame([("35", "Ille")], "code string, nom string")}
    assert universe.territory_names(walk, names, strict=True).first().nom_departement == "Ille"
    with pytest.raises(ContractError, match="without a name"):
        universe.territory_names(walk, {"departement": spark.createDataFrame([("35", None)], "code string, nom string")}, strict=True)


def test_tables_and_chunks(spark, tmp_path):
    rows = spark.createDataFrame([("b", "x", 1.0), ("a", "x", 2.0), ("a", "x", 2.0)], "from_id string, to_id string, travel_time double")
    io.write_pairs(rows, str(tmp_path / "pairs"), "car", 3, "run")
    back = spark.read.parquet(str(tmp_path / "pairs"))
    assert back.count() == 3 and back.first().run_label == "run" and back.select("mode", "chunk_id").distinct().collect() == [("car", 3)]
    with pytest.raises(ContractError, match="travel_time_p1"):
        io.write_pairs(rows, str(tmp_path / "pairs"), "transit", 1, "run", transit=True)
    io.write_table(spark.createDataFrame([("é",), ("z",), ("Z",), ("a",)], "k string").repartition(4), str(tmp_path / "sorted"), ["k"])
    assert [r.k for r in spark.read.parquet(str(tmp_path / "sorted")).collect()] == ["Z", "a", "z", "é"]
    for name, keys in (("one", ["a", "b"]), ("two", ["c"]), ("two", ["d"])):
        io.write_checkpoint(spark.createDataFrame([(k,) for k in keys], "k string"), str(tmp_path / "parts"), name)
    assert {r.k for r in io.read_checkpoint(spark, str(tmp_path / "parts"), ["k"]).collect()} == {"a", "b", "d"}
    assert io.read_checkpoint(spark, str(tmp_path / "parts"), ["k"], ["one"]).count() == 2
    io.write_checkpoint(spark.createDataFrame([("a",)], "k string"), str(tmp_path / "parts"), "three")
    with pytest.raises(ContractError, match="duplicate key"):
        io.read_checkpoint(spark, str(tmp_path / "parts"), ["k"])
    made = []
    for _ in range(2):
        io.cached(spark, str(tmp_path / "cache"), {"a": 1}, lambda: made.append(1) or spark.range(3))
    assert made == [1] and io.cached(spark, str(tmp_path / "cache"), {"a": 2}, lambda: spark.range(4)).count() == 4
    names = spark.createDataFrame([("walk_12.parquet",), ("transit_gain_3.parquet",), ("other.txt",)], "n string")
    mode, chunk = io.chunk_of_file("n")
    assert [tuple(r) for r in names.select(mode, chunk).collect()] == [("walk", 12), ("transit_gain", 3), ("", None)]
    assert io.metric_columns(spark.createDataFrame([(1, 2, 3, "x")], "count_5_walk int, nearest_walk int, transit_gain_count_20_p1 int, address_id string")) == ["count_5_walk", "transit_gain_count_20_p1"]
    (tmp_path / "codes.csv").write_text("code_insee,x\n01001,1\n35238,2\n")
    assert io.read_codes(spark, str(tmp_path / "codes.csv")) == ["01001", "35238"]
    (tmp_path / "snap.csv").write_text("code_insee,nom_commune,v\n1001,A,1\n350010,B,2\n")
    assert [r.code_insee for r in io.read_snapshot(spark, str(tmp_path / "snap.csv"), ["v"]).collect()] == ["01001", "350010"]
    io.write_poly([[(-1.5, 48.0), (-1.0, 48.0), (-1.0, 48.5)]], str(tmp_path / "crop.poly"))
    lines = (tmp_path / "crop.poly").read_text().splitlines()
    assert lines[:2] == ["crop", "1"] and lines[2] == lines[5] == "   -1.5000000E+00   4.8000000E+01" and lines[-2:] == ["END", "END"]


def test_inputs_from_files(spark, tmp_path):
    import sqlite3

    path = str(tmp_path / "admin.gpkg")
    with sqlite3.connect(path) as db:
        db.execute("create table commune (" + ", ".join(f"{c} text" for c in inputs.COMMUNES) + ")")
        db.executemany("insert into commune values (?, ?, ?, ?, ?)", [("35001", "A", "35", "53", "1"), ("22001", "B", "22", "53", "")])
    got = inputs.commune_crosswalk(spark, path, str(tmp_path / "kept"), ["35"]).collect()
    assert [(r.code_insee, r.nom_commune, r.epci) for r in got] == [("35001", "A", "1")]
    made = os.listdir(tmp_path / "kept")
    assert inputs.commune_crosswalk(spark, path, str(tmp_path / "kept")).count() == 2 and os.listdir(tmp_path / "kept") == made
    assert inputs.label_folder("  été 2026/run#1  ") == "-t-2026-run-1-"


def test_destinations_from_equipment(spark):
    columns = "DEP string, DEPCOM string, TYPEQU string, SIRET string, NOMRS string, QUALITE_GEOLOC string, LIBVOIE string, LONGITUDE double, LATITUDE double"
    rows = [("2", "2b", "B", "", "n", "11", None, 0.5, 0.5), ("1", "1a", "A", "s", "n", "11", None, 0.5, 0.5), ("1", "1a", "A", "s", "n", "11", None, 0.5, 0.5), ("1", "1a", "A", "t", "n", "11", None, None, 0.5), ("9", "9z", "C", "u", "n", "11", None, 1.01, 0.5), ("8", "8z", "C", "u", "n", "11", None, 1.01, 0.5), ("1", "1a", "A", "x", "n", "99", "", 0.5, 0.5)]
    edges = region.wkt_edges(spark.createDataFrame([("POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))",)], "wkt string"))
    kept = inputs.destination_universe(spark.createDataFrame(rows, columns), edges, ["1", "2"], ["9"])
    assert [(r.universe_row, r.DEP, r.zone) for r in kept.orderBy("universe_row").collect()] == [(1, "1", "region"), (2, "1", "region"), (3, "1", "region"), (4, "2", "region"), (5, "9", "strip")]
    plan = inputs.destination_plan(kept)
    assert sorted((r.universe_row, r.id) for r in plan["registry"].collect()) == [(1, "bpe_listing_000001"), (2, "bpe_listing_000001"), (4, "bpe_listing_000002"), (5, "bpe_listing_000003")]
    assert plan["destinations"].count() == plan["dest_map"].count() == 3
    facts = plan["facts"].first().asDict()
    assert facts == {"n_universe": 5, "n_routable": 4, "n_na_coord": 1, "n_region": 4, "n_strip": 1, "n_siret_na": 0, "n_siret_shared": 1, "n_empty_siret": 1, "n_pts": 2, "n_empty_pts": 1}


def test_single_values(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("a", 1), ("b", None)], "k string, v int")
    assert {r.k: r.v for r in monolith.single_values(rows, ["k"], "v").collect()} == {"a": 1, "b": None}
    with pytest.raises(ContractError, match="several values of v"):
        monolith.single_values(rows.unionByName(spark.createDataFrame([("a", 2)], rows.schema)), ["k"], "v")


def test_tables_are_read_lazily(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        io.read_table(spark, str(tmp_path / "nowhere"))
    io.write_table(spark.range(5), str(tmp_path / "t"))
    assert io.read_table(spark, str(tmp_path / "t")).where("id > 2").count() == 2


def test_sets(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (1,)], "k int")
    aggregates.same_set(a, b, "axis")
    for x, y in ((a, b.where("k = 1")), (b.where("k = 1"), a)):
        with pytest.raises(ContractError, match="axis"):
            aggregates.same_set(x, y, "axis")
    clash = monolith.merge_conflicts([spark.createDataFrame([("a", "T", 1)], "address_id string, TYPEQU string, v int"), spark.createDataFrame([("a", "T", 2)], "address_id string, TYPEQU string, v int")])
    assert [tuple(r) for r in clash.collect()] == [("a", "T", "v", 2)]
    summary = spark.createDataFrame([("f", 1, 1, 1), ("g", 1, 0, 1)], "feed_id string, n_active_trips int, n_window_trips int, n_active_stops int")
    gtfs.feed_gate(summary, ["f"])
    for wanted, word in ((["g"], "without service"), (["h"], "missing")):
        with pytest.raises(ContractError, match=word):
            gtfs.feed_gate(summary, wanted)
