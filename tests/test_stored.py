"""Stored tables, and what is kept in them: the address table and the matrix of a stream."""

import os

import pytest
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError
from reachmill.operators import monolith
from reachmill.sources.stored import ROW_GROUP, StoredTable
from reachmill.streaming import incremental


def files(path):
    """Every data file with its bytes."""
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(folder, n), "rb") as f:
                    found[os.path.relpath(os.path.join(folder, n), path)] = f.read()
    return found


def walk(spark, rows):
    return spark.createDataFrame(rows, "address_id string, TYPEQU string, nearest_walk double, count_5_walk int")


def test_upsert_rewrites_its_buckets_alone(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path), "address_id", 8)
    assert table.read() is None and table.version == 0
    rows = [(f"a{i}", t, float(i % 20), i % 3) for i in range(200) for t in ("A", "B")]
    assert monolith.upsert_stored(table, [walk(spark, rows)]) == 1
    before = files(tmp_path / "data")
    bike = spark.createDataFrame([("a7", "A", 3.0, 1), ("a7", "C", 4.0, 1), ("new", "A", 5.0, 0)], "address_id string, TYPEQU string, nearest_bike double, count_5_bike int")
    assert monolith.upsert_stored(table, [bike, walk(spark, [("a7", "A", 7.0, 1)])]) == 2
    touched = set(table.touched(bike))
    assert 1 <= len(touched) <= 2
    after = files(tmp_path / "data")
    assert {n: after[n] for n in before} == before  # nothing that was there is changed
    state = table.state()
    assert {int(b) for b, v in state["at"].items() if v == 2} == touched and {v for b, v in state["at"].items() if int(b) not in touched} == {1}
    got = {(r.address_id, r.TYPEQU): r for r in table.read().collect()}
    assert len(got) == 402 and (got["a7", "A"].nearest_walk, got["a7", "A"].nearest_bike, got["a8", "B"].nearest_walk) == (7.0, 3.0, 8.0)
    assert got["a7", "C"].nearest_walk is None and got["a8", "B"].nearest_bike is None
    # a value that differs from the stored one is refused, and the table stays
    with pytest.raises(ContractError, match="conflicting values"):
        monolith.upsert_stored(table, [walk(spark, [("a9", "A", 1.0, 0), ("fresh", "A", 1.0, 0)])])
    assert table.version == 2 and files(tmp_path / "data") == after
    assert table.read(version=1).count() == 400
    gone = table.vacuum()
    assert len([n for n in gone if n.startswith("data")]) == len(touched) and table.read().count() == 402


def test_stored_tables_refuse(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path), "address_id", 4)
    other = StoredTable(spark, str(tmp_path), "address_id", 4)
    rows = walk(spark, [("a", "A", 1.0, 1)])
    state = other.state()
    monolith.upsert_stored(table, [rows])
    other.state = lambda version=None: state  # a writer that started before the other had committed
    with pytest.raises(ContractError, match="came first"):
        other.replace(rows, other.touched(rows))
    assert not [n for n in os.listdir(tmp_path / "versions") if n.endswith(".part")]
    with pytest.raises(Exception, match="not replaced"):
        table.replace(rows, [b for b in range(4) if b not in table.touched(rows)])
    assert table.version == 1 and table.read().count() == 1
    with pytest.raises(ContractError, match="bucketed by"):
        StoredTable(spark, str(tmp_path), "TYPEQU")
    assert StoredTable(spark, str(tmp_path), "address_id", 99).buckets == 4
    with pytest.raises(ContractError, match="another type"):
        table.upsert(rows.withColumn("nearest_walk", F.lit("x")), lambda old, new: new)
    table.replace(rows.limit(0), table.touched(rows))
    assert table.read() is None


def test_row_groups_are_bounded(spark, tmp_path):
    import pyarrow.parquet as pq

    table = StoredTable(spark, str(tmp_path), "address_id", 1)
    table.upsert(spark.range(2 * ROW_GROUP + 5).select(F.col("id").cast("string").alias("address_id")), lambda old, new: new)
    sizes = []
    for folder, _, names in os.walk(tmp_path / "data"):
        for n in names:
            if n.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, n)).metadata
                sizes += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert sum(sizes) == 2 * ROW_GROUP + 5 and max(sizes) <= ROW_GROUP


SCHEMA = "from_id string, to_id string, mode string, travel_time double"


@pytest.fixture
def arrive(spark, tmp_path):
    types = spark.createDataFrame([("d", "A"), ("e1", "A"), ("e2", "A"), ("e3", "B")], "id string, TYPEQU string")

    def run(rows=None):
        if rows is not None:
            spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        return incremental.derive_new_pairs(spark, str(tmp_path / "in"), SCHEMA, types, str(tmp_path / "out"), str(tmp_path / "cp"), 8)

    return run


def stored(spark, tmp_path, *columns):
    rows = incremental.tables(spark, str(tmp_path / "out"))[1].read().collect()
    return {(r.batiment_id, r.TYPEQU): tuple(r[c] for c in columns) for r in rows}


def test_batches_change_their_own_origins(spark, tmp_path, arrive):
    for n in (1, 2, 3):
        assert arrive([(f"o{n}", "d", "walk", float(n)), ("again", "d", "walk", 9.0 - n), ("again", f"e{n}", "walk", 7.0)]) == 1
    assert arrive() == 0
    assert stored(spark, tmp_path, "tt_nearest", "count_5", "count_20") == {("o1", "A"): (1.0, 1, 1), ("o2", "A"): (2.0, 1, 1), ("o3", "A"): (3.0, 1, 1), ("again", "A"): (6.0, 0, 3), ("again", "B"): (7.0, 0, 1)}
    before = files(tmp_path / "out")
    # a longer time and a repeated one change no row; a new origin gets rows of its own
    assert arrive([("o1", "d", "walk", 19.0), ("o2", "d", "walk", 2.0), ("o4", "d", "walk", 4.0)]) == 1
    since = stored(spark, tmp_path, "since")
    assert {k[0] for k, v in since.items() if v == (4,)} == {"o4"} and since["o1", "A"] == (1,) and since["o3", "A"] == (3,)
    after = files(tmp_path / "out")
    assert {n: after[n] for n in before} == before
    assert "since" not in incremental.stored_matrix(spark, str(tmp_path / "out")).columns


def test_a_failure_between_pairs_and_matrix_loses_nothing(spark, tmp_path, arrive, monkeypatch):
    assert arrive([("o1", "d", "walk", 1.0)]) == 1

    def broken(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, "follow", broken)
        with pytest.raises(RuntimeError):
            arrive([("o1", "e1", "walk", 3.0), ("o2", "d", "walk", 2.0)])
    assert set(stored(spark, tmp_path)) == {("o1", "A")}
    assert arrive() == 0
    assert stored(spark, tmp_path, "tt_nearest", "count_5") == {("o1", "A"): (1.0, 2), ("o2", "A"): (2.0, 1)}
    # a batch that fails before it is committed is taken in again
    with monkeypatch.context() as m:
        m.setattr(incremental, "take_pairs", broken)
        with pytest.raises(Exception):
            arrive([("o3", "d", "walk", 5.0)])
    assert arrive() == 1 and stored(spark, tmp_path, "tt_nearest")["o3", "A"] == (5.0,)
    assert incremental.stored_matrix(spark, str(tmp_path / "nowhere")) is None
