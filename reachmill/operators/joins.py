"""Joins whose keys may be shared by a large part of all rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a key that one task joins, about.
PER_TASK = 10_000
#: Keys that are dealt to several tasks, at most: what is broadcast has no more rows.
MOST_HOT = 10_000
#: Entries of a run of a block.  Spark holds all rows that explode makes of one row, so two runs that meet are held as SLICE * SLICE rows.
SLICE = 256
#: Identities of which one task makes the rows, some tens of each, about.
MEMBERS = 20_000

#: Partitions with which shuffles begin; adaptive execution joins them to the advisory size, and to few where there is little.
FINEST = 1_000
#: Compressed bytes of a shuffle that one task takes: each sort or aggregation of narrow rows then has about one page of memory, 64 MB.
ADVISORY = "4m"
#: Bytes of a file that one task reads: what is aggregated where it is read grows with the split, and narrow columns take some fifty times as much memory.
SPLIT = "8m"
#: Bytes of a table by its files up to which it is broadcast without being counted, and up to which it is once it has been shuffled and its rows
#: are known.  Hashed, keys that compress well take some fifty times the first, in every task.
GUESSED, KNOWN = "1m", "10m"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_BROADCASTS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
_SHUFFLES = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def fine_shuffles(spark: SparkSession) -> None:
    """Lets shuffles of the session begin with FINEST partitions, so that a task takes ADVISORY and not a fixed share of all rows, and reads SPLIT of a file; tables are broadcast up to GUESSED and KNOWN.

    Sessions that set the first number, the size of splits or the bound of broadcasts themselves keep their settings.
    """
    if spark.conf.get(_SPLIT, None) is None:
        spark.conf.set(_SPLIT, SPLIT)
    guessed, known = _BROADCASTS
    if spark.conf.get(guessed, None) is None:
        spark.conf.set(guessed, GUESSED)
        if spark.conf.get(known, None) is None:
            spark.conf.set(known, KNOWN)
    begin, advisory = _SHUFFLES
    if spark.conf.get(begin, None) is None:
        spark.conf.set(begin, max(FINEST, int(spark.conf.get("spark.sql.shuffle.partitions"))))
        spark.conf.set(advisory, ADVISORY)


def fanned(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys over spark.sql.shuffle.partitions tasks: little data that becomes much isn't joined into few tasks by its size."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def dealt(df: DataFrame, rows: float, *keys: str) -> DataFrame:
    """df of about ``rows`` rows, each of which becomes some tens, dealt by keys: MEMBERS rows a task, or fewer while there are fewer tasks than shuffle partitions."""
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(1, math.ceil(rows / MEMBERS), min(few, math.ceil(rows / 1_000))), *keys)


def blocks(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """keys, _part and ``name``, an array of the structs of all other columns: the rows of a key, in blocks of about PER_TASK.

    Where there are many rows a block has a ten-thousandth of all, so no more
    than MOST_HOT keys are dealt to several blocks, _part from 0.
    """
    rest = [c for c in rows.columns if c not in keys]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    bar = counts.agg(F.greatest(F.lit(PER_TASK), F.ceil(F.coalesce(F.sum("_n"), F.lit(0)) / MOST_HOT)).alias("_bar"))  # one row
    hot = counts.join(F.broadcast(bar), F.col("_n") > F.col("_bar")).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.ceil(F.col("_n") / F.col("_bar")).alias("_parts"))
    on = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    part = F.pmod(F.xxhash64(*rest), F.coalesce("_parts", F.lit(1))).cast("int").alias("_part")
    return rows.join(F.broadcast(hot), on, "left").select(*keys, part, F.struct(*rest).alias("_row")).groupBy(*keys, "_part").agg(F.collect_list("_row").alias(name))


def sliced(held: DataFrame, *names: str) -> DataFrame:
    """held with the arrays ``names`` cut into runs of at most SLICE entries, a row for each run (of each array): rows that become many at once stay few."""
    runs = lambda name: F.transform(F.sequence(F.lit(0), F.floor((F.size(name) - 1) / SLICE).cast("int")), lambda i: F.slice(F.col(name), i * SLICE + 1, F.lit(SLICE)))
    for name in names:
        held = held.withColumn(name, F.explode(runs(name)))
    return held


def fan_out(few: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """few and many joined on ``key``, where many rows of ``many`` may share a key and few rows of ``few`` do.

    The keys of ``many`` are counted first.  One with more than PER_TASK rows
    (or, where there are many such, than a ten-thousandth of all) is dealt to
    as many tasks as it has multiples of that; the rows of ``few`` are copied to each.
    """
    counts = many.groupBy(key).agg(F.count("*").alias("_n"))
    bar = counts.agg(F.greatest(F.lit(PER_TASK), F.ceil(F.coalesce(F.sum("_n"), F.lit(0)) / MOST_HOT)).alias("_bar"))  # one row
    hot = counts.join(F.broadcast(bar), F.col("_n") > F.col("_bar")).select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / F.col("_bar")).alias("_parts"))
    hot = F.broadcast(hot)
    parts = F.coalesce("_parts", F.lit(1))
    left = few.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_hot", "_parts")
    rest = [F.col(f"`{c}`") for c in many.columns]
    right = many.join(hot, F.col(key) == F.col("_hot"), "left").select(*rest, F.pmod(F.xxhash64(*rest), parts).alias("_part"))
    return left.join(right, [key, "_part"]).drop("_part")
