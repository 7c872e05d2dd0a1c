"""Packing pieces of documents into sequences of bounded length.

A packing needs only the number of pieces of each length, and lengths run from
1 to the sequence length, so it is planned on the driver from a histogram whose
size does not depend on the corpus.  A plan is a table of slots: pieces of one
length with ranks in [first, last) go, ``per_bin`` to a bin, into consecutive
bins from ``bin`` on, at ``offset``.  Ranks come from one sort across the
cluster by (length, document, piece).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import cut


#: Pieces in a task, about.
PART_ROWS = 2_000_000


def minimum_bin_slack(counts: dict[int, int], size: int):
    """Slots by minimum bin slack.

    Each bin takes the longest piece that is left and then, by subset sums over
    the lengths that are left (a bitset, longest lengths first, stopped once the
    bin can be full), the combination that fills it best.  The combination is
    taken out as often as the counts allow, so that every round uses up a
    length: there are at most as many rounds as lengths, times a constant.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left, reverse=True)
    used = dict.fromkeys(left, 0)
    slots, bins = [], 0
    while order:
        room = size - order[0]
        mask = (1 << (room + 1)) - 1
        reach, steps = 1, []
        for n in order:
            spare = min(left[n] - (n == order[0]), room // n)
            part = 1
            while spare > 0 and not reach >> room & 1:
                take = min(part, spare)
                steps.append((n, take, reach))
                reach |= (reach << n * take) & mask
                spare -= take
                part *= 2
            if reach >> room & 1:
                break
        at, combination = reach.bit_length() - 1, {order[0]: 1}
        for n, take, before in reversed(steps):
            if not before >> at & 1:
                combination[n] = combination.get(n, 0) + take
                at -= n * take
        times = min(left[n] // k for n, k in combination.items())
        offset = 0
        for n in sorted(combination, reverse=True):
            k = combination[n]
            slots.append((n, used[n], used[n] + k * times, bins, k, offset))
            offset += n * k
            used[n] += k * times
            left[n] -= k * times
        bins += times
        order = [n for n in order if left[n]]
    return slots, bins


class CapacityTree:
    """A segment tree over capacities 0..size: the smallest capacity of at least n that some bin has."""

    def __init__(self, size):
        self.leaves = 1 << size.bit_length()
        self.any = bytearray(2 * self.leaves)

    def put(self, capacity, present):
        at = capacity + self.leaves
        self.any[at] = present
        while at > 1:
            at //= 2
            self.any[at] = self.any[2 * at] | self.any[2 * at + 1]

    def at_least(self, n):
        at = n + self.leaves
        if self.any[at]:
            return n
        while at > 1:
            if at % 2 == 0 and self.any[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at + (not self.any[2 * at])
                return at - self.leaves
            at //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], size: int):
    """Slots by best fit decreasing: every piece, longest first, goes to the fullest bin that still has room.

    Bins with the same room are interchangeable, so runs of them are filled at
    once; the outcome is that of placing the pieces one by one.
    """
    tree, runs = CapacityTree(size), {}
    slots, bins = [], 0

    def give(room, first, n):
        if n and room:
            runs.setdefault(room, []).append((first, n))
            tree.put(room, 1)

    for length in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.at_least(length)
            if room is None:
                room, first, n = size, bins, -(-left // (size // length))
                bins += n
            else:
                first, n = runs[room].pop()
                if not runs[room]:
                    tree.put(room, 0)
            per_bin = room // length
            full = min(n, left // per_bin)
            if full:
                slots.append((length, rank, rank + full * per_bin, first, per_bin, size - room))
                give(room - per_bin * length, first, full)
                rank += full * per_bin
                left -= full * per_bin
                first, n = first + full, n - full
            if n and 0 < left < per_bin:
                slots.append((length, rank, rank + left, first, left, size - room))
                give(room - left * length, first, 1)
                first, n, left = first + 1, n - 1, 0
            give(room, first, n)
    return slots, bins


def _place(slots, before):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        table = np.array(slots.value, np.int64).reshape(-1, 6)
        table = table[np.lexsort((table[:, 1], table[:, 0]))]
        begins = (table[:, 0] << 44) + table[:, 1]
        smaller = before.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("place").to_numpy() - smaller[length]
            slot = table[np.searchsorted(begins, (length << 44) + rank, "right") - 1]
            nth = rank - slot[:, 1]
            sequence = slot[:, 3] + nth // np.maximum(slot[:, 4], 1)
            offset = slot[:, 5] + nth % np.maximum(slot[:, 4], 1) * length
            keep = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "place"]
            names = [n for n in batch.schema.names if n != "place"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, size: int, plan=minimum_bin_slack) -> DataFrame:
    """pieces(doc_id, piece, length, ...) with sequence_id and offset.

    Lengths are from 1 to size.  Sequence ids run from 0 without gaps; a
    sequence's pieces lie side by side from offset 0.
    """
    import numpy as np

    spark = pieces.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pieces.count() // PART_ROWS + 1)
    rows = cut(pieces.repartitionByRange(parts, "length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece"))
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most ``size`` rows
    slots, _ = plan(counts, size)
    before = np.zeros(size + 2, np.int64)
    for n, c in counts.items():
        before[n + 1] = c
    before = np.cumsum(before)
    # a row's place in the order: the rows of earlier partitions, then its number within its own
    sizes = sorted((r[0], r[1]) for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect())
    starts, total = [], 0
    for p, n in sizes:
        starts.append((p, total))
        total += n
    starts = spark.createDataFrame(starts, "_p int, _start long")
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.withColumn("_number", number).withColumn("_p", F.spark_partition_id())
    placed = placed.join(F.broadcast(starts), "_p").withColumn("place", F.col("_start") + F.col("_number")).drop("_p", "_start", "_number")
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"
    context = spark.sparkContext
    return placed.mapInArrow(_place(context.broadcast(slots), context.broadcast(before)), schema)
