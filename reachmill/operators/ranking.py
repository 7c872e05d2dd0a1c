"""Consecutive numbers over a whole table without one task for all of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmill.sources.lineage import cut

#: monotonically_increasing_id holds the partition above this many bits and the row's place in it below.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: str, name: str = "place") -> DataFrame:
    """df with a column ``name``: 1, 2, ... by the column ``order``, nulls first; equal values are numbered by a hash of the other columns.

    The rows are dealt by ranges of (order, hash, row), so a value that a third
    of them share is dealt to several tasks too, and sorted within each; a row's
    number is its place in its partition after the counts of those before it.
    Fan-out is the session's: spark.sql.shuffle.partitions, joined to partitions
    of the advisory size by adaptive execution.  The dealt rows are written to
    the shared folder once, so a repeated task can't number them otherwise.
    """
    tie, row, at = (f"_{name}_{x}" for x in ("tie", "row", "at"))
    others = [F.col(f"`{c}`") for c, t in df.dtypes if c != order and "map<" not in t and "variant" not in t]
    by = [F.col(order).asc_nulls_first(), F.col(tie), F.col(row)]
    rows = df.withColumn(tie, F.xxhash64(*others) if others else F.lit(0)).withColumn(row, F.monotonically_increasing_id())
    dealt = cut(rows.repartitionByRange(*by).sortWithinPartitions(*by).drop(tie, row).withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(at, _PLACE_BITS)
    counts = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    skips = counts.select("_part", before.alias("_skip"))  # one row a partition
    place = F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + F.col("_skip") + 1
    return dealt.withColumn("_part", part).join(F.broadcast(skips), "_part").withColumn(name, place.cast("long")).drop("_part", "_skip", at)
