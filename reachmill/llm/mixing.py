"""Mixing sources to target weights by entropy balancing.

Every source has a target number of words.  Of all rates of its documents that
meet it, none of them under 0 or over ``MOST``, those are taken that stray least from
one copy each, in the sense of relative entropy.  They are exponential tilts of
the size, exp(t size / mean size), cut off at ``MOST``; the t of each source is
the minimum of a convex dual of one variable, whose slope is the words that
the rates take less the target.

All sources are solved at once by Newton steps.  A step is one aggregation over
the cells (source, size, number of documents), since documents of one size have
one rate; it is taken on the logarithm of the words, and a bisection takes its
place where it leaves the interval that is known to hold the solution.  Rates become
copies cell by cell, from the largest size to the smallest, each cell
making up what the rounding of those before it left over, so that a source ends
within about its smallest sizes of its target.  The copies of a cell are dealt to its
documents in order of a hash of their ids.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmill.llm.common import cut
from reachmill.operators.ranking import numbered

#: Weights of the sources in their order, repeated.
WEIGHTS = (3, 1, 2)
#: Copies of a document at most, and so times its source's size that a target has at most.
MOST = 2
#: All targets together, in sizes of the whole table.
SHARE = 1.5
#: A source is solved when its words are within this share of its target, or within a ten-thousandth of a word.
CLOSE = 1e-9
ROUNDS = 200
#: Sources in a table that is broadcast, at most.
FEW_SOURCES = 100_000


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size: the words [^\\x20\\x09-\\x0D]+ of the whole text; null is empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """totals(source, source_size) with target: the sources share ``share`` of all sizes by weight, none over ``most`` times its own.

    Weights repeat over the sources in order of code point, null last.  What a
    source has to give up is shared again by weight among the others, until no
    target is above its limit: each round is one aggregation, and takes out
    every source that is above.
    """
    place = numbered(totals.where("source is not null"), "source", "place")
    rows = cut(place.unionByName(totals.where("source is null").withColumn("place", F.lit(place.count() + 1).cast("long"))))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("place") - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = rows.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("limit"))
    whole = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("limit") <= F.col("weight") * level
        taken, left, n = rows.agg(F.sum(F.when(full, F.col("limit")).otherwise(0.0)), F.sum(F.when(~full, F.col("weight"))), F.count_if(~full)).first()
        after = (whole - taken) / left if n else level
        if not n or after <= level:
            break
        level = after
    return rows.withColumn("target", F.least("limit", F.col("weight") * level)).drop("limit")


def _by_source(df: DataFrame, table: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """df joined with table on source, where nulls are equal."""
    named = table.withColumnRenamed("source", "_source")
    return df.join(F.broadcast(named) if few else named, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def balance(cells: DataFrame, goals: DataFrame, most: float = MOST, few: bool = True) -> DataFrame:
    """goals(source, source_size, target, ...) with tilt: rates min(most, exp(tilt size / mean)) of cells(source, size, n) take the target.

    Null where nothing has to be solved: a target at ``most`` times the source's
    size (rate ``most``) or a source without words.
    """
    solve = (F.col("source_size") > 0) & (F.col("target") < F.col("source_size") * most * (1 - 1e-12))
    goals = cut(_by_source(goals, cells.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")), few))
    state = goals.where(solve).select("source", "target", "mean", F.lit(0.0).alias("tilt"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(None).cast("double").alias("off"))
    state, top = cut(state), math.log(most)
    for _ in range(ROUNDS):
        x = F.col("size") / F.col("mean")
        tilted = F.col("tilt") * x
        words = F.col("n") * F.col("size") * F.exp(F.least(tilted, F.lit(top)))
        slope = F.when(tilted < top, words * x).otherwise(0.0)
        sums = _by_source(cells.where("size > 0"), state.select("source", "mean", "tilt"), few).groupBy("source").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        now = _by_source(state, sums, few)
        over = F.col("words") - F.col("target")
        now = now.withColumn("off", F.abs(over)).withColumn("low", F.when(over <= 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(over >= 0, F.col("tilt")).otherwise(F.col("high")))
        # Newton on log(words) - log(target): words is near to an exponential, so this goes straight where words itself would take many steps
        newton = F.col("tilt") - (F.log("words") - F.log("target")) * F.col("words") / F.col("slope")
        inside = (F.col("slope") > 0) & (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        outside = F.when(F.col("low").isNull(), F.least(2 * F.col("high"), F.lit(-1.0))).when(F.col("high").isNull(), F.greatest(2 * F.col("low"), F.lit(1.0))).otherwise((F.col("low") + F.col("high")) / 2)
        done = F.col("off") <= F.greatest(F.lit(1e-4), F.col("target") * CLOSE)
        step = F.when(done, F.col("tilt")).when(F.coalesce(inside & ~F.isnan(newton), F.lit(False)), newton).otherwise(outside)
        state = cut(now.select("source", "target", "mean", F.least(F.greatest(step, F.lit(-1e12)), F.lit(1e12)).alias("tilt"), "low", "high", "off"))
        if not state.where(~done).limit(1).count():
            break
    return _by_source(goals, state.select("source", "tilt"), few, "left")


def _copies(most):
    """Whole copies of each cell of a source, the largest size first: cells(size, n, rate) to (size, copies)."""

    def run(group):
        import numpy as np
        import pyarrow as pa

        size, n, rate = (group.column(c).to_numpy() for c in ("size", "n", "rate"))
        order = np.argsort(-size, kind="stable")
        out, over = [], 0.0  # words that are still to be taken
        for s, m, r in zip(size[order].tolist(), n[order].tolist(), rate[order].tolist()):
            want = m * r + over / s if s else m * r
            copies = min(most * m, max(0, math.floor(want + 0.5)))
            over += (m * r - copies) * s
            out.append(copies)
        source = group.column("source").take(pa.array(order))
        return pa.table([source, pa.array(size[order], pa.int64()), pa.array(out, pa.int64())], names=["source", "size", "copies"])

    return run


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken: one row per row of docs.

    ``taken`` is copies times size: the words that the mix takes of the document.
    A document has at most ``most`` copies.  A source's taken words are within its
    smallest sizes of its target, unless a few documents make up most of the source.

    Null texts, empty texts and those without words have size 0 and are taken by
    their source's rate, with no words.  A null source is a source of its own, the last.
    Rows that repeat a doc_id, or lack one, are documents of their own; those equal in id, source and
    size can't be told apart, so which of them has a copy more is left open.
    Reruns agree, whatever the partitions.  Other columns are not read; an
    empty table gives an empty table.
    """
    rows = cut(sizes(docs, id_col, text_col, source_col).withColumn("hash", F.xxhash64("doc_id")))
    # the square root of the rows: neither a cell's rows in one task nor its number of parts grows faster
    parts = max(1, math.isqrt(rows.count()))
    rows = rows.withColumn("part", F.pmod("hash", F.lit(parts)))
    counts = cut(rows.groupBy("source", "size", "part").agg(F.count("*").alias("m")))
    cells = cut(counts.groupBy("source", "size").agg(F.sum("m").alias("n")))
    totals = cut(cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size")))
    few = totals.count() <= FEW_SOURCES
    goals = cut(balance(cells, targets(totals, weights, share, most), most, few))
    rate = F.when(F.col("tilt").isNotNull(), F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(most) + 1))))).when(F.col("source_size") > 0, F.lit(float(most))).otherwise(F.lit(1.0))
    rated = _by_source(cells, goals.select("source", "source_size", "target", "mean", "tilt"), few).withColumn("rate", rate).drop("mean", "tilt")
    rated = cut(rated)
    copies = rated.select("source", "size", "n", "rate").groupBy("source").applyInArrow(_copies(most), "source string, size long, copies long").toDF("_source", "_size", "copies")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
    rated = rated.join(copies, same).select("source", "size", "source_size", "target", "rate", F.floor(F.col("copies") / F.col("n")).alias("each"), (F.col("copies") % F.col("n")).alias("more"))
    # the first ``more`` documents of a cell, by part and hash, have one copy more
    before = F.sum("m").over(Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    rated = rated.withColumnsRenamed({"source": "_source", "size": "_size"})
    placed = placed.join(rated, same).select(*[F.col(c).alias(f"_{c}") for c in ("source", "size", "part")], "before", "each", "more", "source_size", "target", "rate")
    own = Window.partitionBy("source", "size", "part").orderBy("hash", "doc_id")
    ranked = rows.withColumn("at", F.row_number().over(own))
    out = ranked.join(placed, same & (F.col("part") == F.col("_part")))
    out = out.withColumn("copies", F.col("each") + F.when(F.col("before") + F.col("at") <= F.col("more"), 1).otherwise(0))
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", F.col("copies").cast("int").alias("copies"), (F.col("copies") * F.col("size")).alias("taken"))
