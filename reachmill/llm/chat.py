"""Chat formatting: keep maximal conversations, then render them.

Logged conversations often repeat: a client logs the dialogue so far after
every turn.  A conversation's turns are hashed with their place, and running
sums of these hashes give a hash of every prefix.  A conversation whose whole
hash is the hash of a proper prefix of another one is dropped by an anti-join;
of equal conversations the smallest id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmill.llm.common import cut

#: Turns of one conversation that are summed in one task; longer ones are summed in stretches.
STRETCH = 1024


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """turns(conv_id, turn, role, text) with place (from 1) and two running sums that identify the prefix up to it.

    The sums are of 64-bit hashes with unlike seeds, so two unlike prefixes of one length agree with a chance of about 2 ** -128.
    """
    # equal turn numbers are ordered by role and text
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")]
    part = F.coalesce(F.floor(F.col("turn") / STRETCH), F.lit(-(2**62)))  # before every turn's
    rows = turns.withColumn("part", part)
    inner = Window.partitionBy("conv_id", "part").orderBy(*order)
    rows = rows.withColumn("nth", F.row_number().over(inner))
    before = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("conv_id", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"))
    rows = rows.join(before.withColumnsRenamed({"conv_id": "c", "part": "p"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p")
    rows = rows.withColumn("place", (F.col("skip") + F.col("nth")).cast("int"))
    told = [x for c in ("role", "text") for x in (F.col(c).isNull(), F.coalesce(c, F.lit("")))]
    for name, salt in (("h1", 1), ("h2", 2)):
        rows = rows.withColumn(name, F.xxhash64("place", *told, F.lit(salt)).cast("decimal(38,0)"))
    running = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = rows.groupBy("conv_id", "part").agg(F.sum("h1").alias("s1"), F.sum("h2").alias("s2"))
    sums = sums.select("conv_id", "part", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).cast("decimal(38,0)").alias(s) for s in ("s1", "s2")])
    rows = rows.withColumn("r1", F.sum("h1").over(running)).withColumn("r2", F.sum("h2").over(running))
    rows = rows.join(sums.withColumnsRenamed({"conv_id": "c", "part": "p"}), F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    key = lambda r, s: (F.col(r) + F.col(s)).cast("string")
    return rows.select("conv_id", "turn", "role", "text", "place", key("r1", "s1").alias("p1"), key("r2", "s2").alias("p2"))


def maximal(turns: DataFrame) -> DataFrame:
    """The turns, with their places, of the conversations that are no prefix of another.

    Rows without a conv_id are left out: they belong to no conversation.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    hashed = cut(prefix_hashes(rows.where("conv_id is not null")))
    whole = hashed.groupBy("conv_id").agg(F.max("place").alias("n"))
    ends = hashed.join(whole, "conv_id")
    full = ends.where("place = n").groupBy("n", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    proper = ends.where("place < n").select(F.col("place").alias("n"), "p1", "p2").distinct()
    kept = full.join(proper, ["n", "p1", "p2"], "left_anti").select("conv_id")
    return hashed.join(kept, "conv_id", "left_semi")


def render(turns: DataFrame, start: str = "<|startoftext|>", end: str = "<|endoftext|>") -> DataFrame:
    """conv_id, n_turns, text: each maximal conversation in one chat text.

    A turn is start, its role, a line feed, its text, end and a line feed.  A
    null role is rendered as "unknown", a null text as nothing.  Turns follow
    their numbers; equal numbers follow role and text, null numbers come first.
    """
    rows = maximal(turns)
    line = F.concat(F.lit(start), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(end + "\n"))
    ordered = F.array_sort(F.collect_list(F.struct("place", line.alias("line"))))
    text = F.array_join(F.transform(ordered, lambda x: x["line"]), "")
    return rows.groupBy("conv_id").agg(F.count("*").alias("n_turns"), text.alias("text"))
