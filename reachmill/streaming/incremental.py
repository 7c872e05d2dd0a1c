"""Chunks as a stream of files: the matrix of all that has arrived, of which a batch changes only its own origins.

Two stored tables share their buckets, by a hash of the origin.  ``pairs`` holds the
smallest time of each pair, with the version at which it last got smaller;
``matrix`` holds the rows of each origin, with the version of pairs they come
from.  A batch of files reads and writes the buckets of its origins alone, and
within these only origins with a smaller or a new time get new rows.

The matrix remembers the version of pairs that it follows.  What it lacks is made up
for at every call, so a failure between the two tables, or a batch that is
repeated, changes nothing in the end: the smallest time stays the smallest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.operators.matrix import collapse_pairs, derive_matrix
from reachmill.sources.lineage import cut
from reachmill.sources.stored import StoredTable

KEYS = ["from_id", "to_id", "mode"]


def tables(spark: SparkSession, path: str, buckets: int = 64) -> tuple[StoredTable, StoredTable]:
    return StoredTable(spark, f"{path}/pairs", "from_id", buckets), StoredTable(spark, f"{path}/matrix", "batiment_id", buckets)


def take_pairs(pairs: StoredTable, rows: DataFrame) -> None:
    """Merges new pairs: the smaller time stays, and a time that is new or smaller carries the new version."""
    version = pairs.version + 1

    def merge(existing, incoming):
        before = existing.select(*KEYS, F.col("travel_time").alias("old"), "since") if "since" in existing.columns else incoming.limit(0).select(*KEYS, F.col("travel_time").alias("old"), F.lit(0).alias("since"))
        both = before.withColumn("travel_time", F.lit(None).cast("double")).unionByName(incoming.select(*KEYS, F.lit(None).cast("double").alias("old"), F.lit(None).cast("int").alias("since"), "travel_time"))
        one = both.groupBy(*KEYS).agg(F.min("old").alias("old"), F.max("since").alias("since"), F.min("travel_time").alias("new"))
        kept = F.col("old").isNotNull() & (F.col("new").isNull() | (F.col("old") <= F.col("new")))
        return one.select(*KEYS, F.least("old", "new").alias("travel_time"), F.when(kept, F.col("since")).otherwise(F.lit(version)).cast("int").alias("since"))

    pairs.upsert(collapse_pairs(rows.select(*KEYS, F.col("travel_time").cast("double")), KEYS), merge)


def follow(pairs: StoredTable, matrix: StoredTable, dest_map: DataFrame) -> int:
    """Gives the origins whose pairs changed since the matrix last followed them new rows; returns the number of buckets written."""
    state, done = pairs.state(), matrix.state().get("mark", {}).get("pairs", 0)
    owed = sorted(int(b) for b, v in state.get("at", {}).items() if v > done)
    if owed:
        held = pairs.read(owed, state["version"])
        changed = cut(held.where(F.col("since") > done).select("from_id").distinct())
        rows = derive_matrix(held.join(changed, "from_id", "left_semi").select(*KEYS, "travel_time"), dest_map).withColumn("since", F.lit(state["version"]))
        before = matrix.read(owed)
        if before is not None:
            rows = before.join(changed.withColumnRenamed("from_id", "batiment_id"), "batiment_id", "left_anti").unionByName(rows)
        matrix.replace(rows, owed, {"pairs": state["version"]})
    return len(owed)


def derive_new_pairs(spark: SparkSession, pairs_path: str, schema: str, dest_map: DataFrame, out_path: str, checkpoint: str, buckets: int = 64) -> int:
    """Takes in the pair files that are new since the last call, brings the matrix up to date, and returns the number of batches.

    An origin may arrive in several batches, and the files of a batch again after a
    failure.  ``dest_map`` is that of the first call; another one needs another folder.
    """
    pairs, matrix = tables(spark, out_path, buckets)
    done = []

    def batch(rows: DataFrame, number: int) -> None:
        # a stream's own session plans without adaptive execution: a task would hold a fixed share of all pairs
        staged = f"{checkpoint}/arrived"
        rows.select(*KEYS, F.col("travel_time").cast("double")).write.mode("overwrite").parquet(staged)
        take_pairs(pairs, spark.read.parquet(staged))
        done.append(number)

    stream = spark.readStream.schema(schema).parquet(pairs_path)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    follow(pairs, matrix, dest_map)
    return len(done)


def stored_matrix(spark: SparkSession, out_path: str) -> DataFrame | None:
    """The matrix that derive_new_pairs keeps; None before there is one."""
    rows = tables(spark, out_path)[1].read()
    return None if rows is None else rows.drop("since")
