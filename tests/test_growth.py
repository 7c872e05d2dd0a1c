"""What held at small sizes only: results and shares of work when tables grow."""

import datetime
import math

import duckdb
from pyspark.sql import functions as F

from reachmill.operators import joins, matrix, routing
from reachmill.plans import adapters, registry
from reachmill.plans.runner import Run
from reachmill.sources import stored
from reachmill.streaming import incremental


def test_content_keys_of_more_rows_than_two_digits_take(spark, tmp_path):
    # the SQL has prefixes of two digits at most, however many rows there are
    spark.range(70_000).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    for name in ("content_key", "table_fingerprint"):
        sql = registry.oracle_sql()[name].replace("FROM customer", f"FROM '{tmp_path}/customer.parquet/*.parquet'")
        wanted = duckdb.connect().execute(sql).fetchone()[0]
        assert registry.queries()[name](spark, str(tmp_path)).first()[0] == wanted


def _crowd(spark):
    """Many identities at few coordinates: little data, of which much becomes."""
    at = lambda n, copies: spark.range(n * copies).select(F.col("id").cast("string").alias("id"), F.col("id").alias("ord"), (F.col("id") % n / 8.0 - 1.5).alias("lon"), F.lit(48.0).alias("lat")).coalesce(1)
    return at(12, 300), at(6, 40)


def _spread(spark, rows):
    """Rows, and the share of the largest task, as adaptive execution deals them."""
    sizes = [r[0] for r in rows.rdd.mapPartitions(lambda x: [(sum(1 for _ in x),)]).collect()]
    return sum(sizes), max(sizes) / sum(sizes)


def test_pairs_of_few_coordinates_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(routing, "PAIRS_A_TASK", 10_000, raising=False)
    origins, destinations = _crowd(spark)
    wanted = sum(300 * 40 for i in range(12) for j in range(6) if 2 + math.ceil(abs(i - j) / 8 * 80 / 30 * 60) <= 20)
    n, largest = _spread(spark, routing.stub_route(origins, destinations))
    assert n == wanted and largest < 0.8


def test_identities_meet_after_the_last_shuffle(spark):
    origins, destinations = _crowd(spark)
    n, largest = _spread(spark, routing.route_unique(origins, destinations, routing.stub_route))
    assert n == sum(300 * 40 for i in range(12) for j in range(6) if i == j or abs(i - j) / 8 * 80 / 30 * 60 <= 18) and largest < 0.8


def test_a_matrix_by_points_is_that_of_identities(spark):
    pairs = spark.sql("SELECT concat('p', a.id) AS from_id, concat('q', b.id) AS to_id, CASE WHEN a.id = b.id THEN NULL ELSE CAST(a.id * 7 % 11 + b.id * 5 % 13 AS DOUBLE) END AS travel_time, a.id % 2 AS chunk_id FROM range(6) a, range(6) b")
    pairs = pairs.unionByName(pairs.where("to_id = 'q2'").withColumn("travel_time", F.col("travel_time") + 1))
    # ids at several points, one at the same point twice, and none
    origins = spark.createDataFrame([(f"o{i}", f"p{i % 6}") for i in range(20)] + [("o3", "p5"), ("o4", "p4"), ("o5", "p4"), (None, "p1"), ("o9", "p9")], "id string, point_id string")
    destinations = spark.createDataFrame([(f"d{i}", f"q{i % 5}") for i in range(15)] + [("d3", "q5"), ("d4", "q4"), ("d5", "q5"), (None, "q1")], "id string, point_id string")
    types = spark.createDataFrame([(f"d{i}", f"t{i % 3}") for i in range(14)] + [("d1", "t0"), ("d2", "t2")], "id string, TYPEQU string")
    chunks = pairs.select(F.col("from_id").alias("point_id"), "chunk_id").distinct()
    link, routed = origins.join(chunks, "point_id"), pairs.drop("chunk_id")
    same = lambda a, b: sorted(map(str, a.select(sorted(a.columns)).collect())) == sorted(map(str, b.select(sorted(a.columns)).collect())) and a.count()
    expanded = routing.expand_pairs(pairs, origins, destinations)
    plain = matrix.derive_matrix(matrix.collapse_pairs(expanded, ["from_id", "to_id", "chunk_id"]), types, "car", carry=["chunk_id"])
    assert same(plain, matrix.derive_shared_matrix(routed, link, destinations, types, "car", carry=["chunk_id"]))
    both = lambda df: df.withColumn("travel_time_p1", F.col("travel_time")).withColumn("travel_time_p50", F.col("travel_time") + 4).drop("travel_time")
    plain = matrix.derive_transit_matrix(both(expanded), types, carry=["chunk_id"])
    assert same(plain, matrix.derive_shared_matrix(both(routed), link, destinations, types, "transit", carry=["chunk_id"]))


def test_transit_pairs_are_dealt_as_well(spark, monkeypatch):
    monkeypatch.setattr(routing, "PAIRS_A_TASK", 10_000, raising=False)
    assert _spread(spark, routing.stub_transit_route(*_crowd(spark)))[1] < 0.8


def test_blocks_meet_in_runs(spark, monkeypatch):
    # Spark holds all rows that one row is exploded into, so no two arrays that meet may be long
    monkeypatch.setattr(joins, "SLICE", 7)
    origins, destinations = _crowd(spark)
    held = joins.sliced(joins.blocks(origins.select("lon", "lat", "id"), ["lon", "lat"], "ids"), "ids")
    assert held.agg(F.max(F.size("ids")), F.sum(F.size("ids"))).first()[:] == (7, 3600)
    assert routing.stub_route(origins, destinations).count() == sum(300 * 40 for i in range(12) for j in range(6) if 2 + math.ceil(abs(i - j) / 8 * 80 / 30 * 60) <= 20)


def test_shuffles_begin_with_more_partitions_than_the_session_has(spark):
    rows = registry.queries()["pair_collapse"](spark, "/root/testdata/sf0.01")
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k"}
    before = {k: spark.conf.get(k) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        assert rows.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_batch_of_the_stream_is_planned_adaptively(spark, tmp_path, monkeypatch):
    seen, take = [], incremental.take_pairs
    monkeypatch.setattr(incremental, "take_pairs", lambda pairs, rows: (seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled")), take(pairs, rows)))
    pairs = spark.range(50).select(F.col("id").cast("string").alias("from_id"), F.lit("d").alias("to_id"), F.lit("car").alias("mode"), F.lit(4.0).alias("travel_time"))
    pairs.write.parquet(str(tmp_path / "in"))
    types = spark.sql("SELECT 'd' AS id, 't' AS TYPEQU")
    incremental.derive_new_pairs(spark, str(tmp_path / "in"), "from_id string, to_id string, mode string, travel_time double", types, str(tmp_path / "out"), str(tmp_path / "c"), 4)
    assert seen == ["true"] and incremental.stored_matrix(spark, str(tmp_path / "out")).count() == 50


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "100k")
    try:
        table = stored.StoredTable(spark, str(tmp_path), "id", 1)
        table.replace(spark.range(0, 200_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")), [0])
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "data/version=1/bucket=0").glob("*.parquet"))) > 1 and table.read().count() == 200_000


def test_rows_of_a_run_are_dealt_by_identities(spark, tmp_path):
    # 12 coordinates and 3,600 identities: little to read, of which each task makes a part
    origins, destinations = _crowd(spark)
    types = destinations.select("id", F.concat(F.lit("t"), F.col("ord") % 5).alias("TYPEQU"))
    run = Run(str(tmp_path / "run"), origins, destinations, types, modes=["walk", "transit"], chunk_size=5, departure=datetime.datetime(2026, 9, 16, 10, tzinfo=datetime.timezone.utc))
    for mode in ("walk", "transit"):
        n, largest = _spread(spark, run._rows(mode, [1, 2, 3]))
        assert n > 3000 and largest < 0.5
    run.execute()
    assert run.gains().count() == run.transit().count() == n


def test_gains_of_an_identity_in_two_chunks(spark, tmp_path):
    # one id at two coordinates, which are in different chunks: a row for each chunk, against the walk of that chunk
    origins = spark.sql("SELECT * FROM VALUES ('a', 0, -1.5D, 48.0D), ('a', 1, -1.25D, 48.0D), ('b', 2, -1.25D, 48.0D) v(id, ord, lon, lat)")
    destinations = spark.sql("SELECT * FROM VALUES ('d', 0, -1.5D, 48.0D), ('e', 1, -1.25D, 48.0D) v(id, ord, lon, lat)")
    run = Run(str(tmp_path / "run"), origins, destinations, destinations.selectExpr("id", "'t' AS TYPEQU"), modes=["walk", "transit"], chunk_size=1, departure=datetime.datetime(2026, 9, 16, 10, tzinfo=datetime.timezone.utc))
    run.execute()
    got = sorted((r.batiment_id, r.chunk_id, r.walk_available) for r in run.gains().collect())
    assert got == [("a", 1, True), ("a", 2, True), ("b", 2, True)]


def test_a_task_reads_a_small_split(spark, monkeypatch):
    # lineitem of sf0.1 has 10 MB; rows are aggregated where they are read, so the split bounds a task's memory
    name = "spark.sql.files.maxPartitionBytes"
    monkeypatch.setattr(joins, "SPLIT", "1m", raising=False)
    spark.conf.unset(name)
    try:
        assert adapters.frame(spark, "/root/testdata/sf0.1", "lineitem").rdd.getNumPartitions() >= 10
        spark.conf.set(name, "5m")
        adapters.frame(spark, "/root/testdata/sf0.1", "lineitem")
        assert spark.conf.get(name) == "5m"
    finally:
        spark.conf.unset(name)


def test_a_table_is_not_broadcast_by_the_size_of_its_files(spark, tmp_path):
    # 600,000 types have 5 MB as a file, and would take over 100 MB of every task
    spark.range(600_000).selectExpr("id AS p_partkey", "'Brand#' || CAST(id % 25 AS STRING) AS p_brand").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    types = adapters.frame(spark, str(tmp_path), "dest_map")
    pairs = spark.range(1_000_000).selectExpr("CAST(id % 1000 AS STRING) AS from_id", "CAST(id % 600000 AS STRING) AS to_id", "'car' AS mode", "4.0D AS travel_time")
    rows = matrix.derive_matrix(pairs, types)
    assert len(rows.collect()) == 1_000
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
