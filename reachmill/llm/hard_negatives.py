"""Hard negatives by norm-bucketed exact search.

Candidates are sorted by their length, longest first, and cut into buckets.  An
inner product with an anchor is at most the product of the two lengths, so as
soon as that bound is under what an anchor still wants, the anchor needs
neither this bucket nor any after it.  What it wants is at least the lower
limit of its score window, and at least the kth score found so far.

A stretch is a run of buckets that one task holds.  The stretch of the longest
candidates is searched first; its kth scores, with the windows' limits, tell
which anchors have to be sent to which of the other stretches.  Anchors meet
candidates in blocks, never as rows of a join, and each block gives k rows an
anchor and window at most.  With blocks of B rows the rows that are moved are
2 / B of the products that are computed.  Where all lengths are alike the bound
prunes nothing, and the anchors meet all candidates, in blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmill.llm.common import cut
from reachmill.operators.ranking import numbered

#: Candidates in a bucket; values of vectors in a stretch and in a block of anchors.
BUCKET = 512
BLOCK_VALUES = 1 << 18
#: Stretches that are broadcast to tell which anchors go where; more are joined by their number.
FEW_STRETCHES = 1 << 20
#: Whole numbers up to here are exact in double precision.
EXACT = 2.0**53

_FOUND = "row long, at int, score long, other long, other_id long"


def stretch_rows(dim: int) -> int:
    return max(BUCKET, BLOCK_VALUES // dim)


def _best(key, k):
    """Places of the k largest keys of each row, largest first; key is changed."""
    import numpy as np

    if key.shape[1] > 4 * k:
        some = np.argpartition(key, key.shape[1] - k, axis=1)[:, -k:]
        part = np.take_along_axis(key, some, 1)
        return np.take_along_axis(some, np.argsort(-part, axis=1, kind="stable"), 1)
    return np.argsort(-key, axis=1, kind="stable")[:, :k]


class Stretch:
    """Candidates in order of falling length: whole-number vectors x, their rows, ids and labels."""

    def __init__(self, x, rows, ids, labels):
        import numpy as np

        length = np.sqrt((x * x).sum(1))
        # within a bucket candidates stand in order of id, so that of equal scores the first is wanted
        order = np.argsort(-length, kind="stable")
        order = np.concatenate([part[np.lexsort((rows[part], ids[part]))] for part in np.split(order, range(BUCKET, len(order), BUCKET))])
        self.x, self.rows, self.ids, self.labels, self.length = x[order], rows[order], ids[order], labels[order], length[order]
        self.visited = 0

    def search(self, anchors, rows, labels, low, high, least, k, same):
        """The best k candidates of every anchor and window: (anchor, window, score, place) arrays.

        ``low`` and ``high`` bound the scores, a column a window; ``least`` is the kth score known already (-inf without).
        """
        import numpy as np

        m, w = low.shape
        length = np.sqrt((anchors * anchors).sum(1))
        if len(self.x) and m and self.length.max() * length.max() * BUCKET >= EXACT:
            raise ValueError("inner products are too large to be exact")
        score, place = np.full((m, w, k), -np.inf), np.full((m, w, k), -1)
        for first in range(0, len(self.x), BUCKET):
            x, bucket = self.x[first : first + BUCKET], slice(first, first + BUCKET)
            wanted = np.maximum(np.maximum(low, least), score[:, :, -1])
            wanted[low > high] = np.inf
            open_ = np.flatnonzero(length * self.length[bucket].max() * (1 + 1e-12) >= wanted.min(1))
            if not len(open_):
                break  # what follows is shorter still
            self.visited += len(open_) * len(x)
            product = anchors[open_] @ x.T
            alike = labels[open_][:, None] == self.labels[bucket][None, :]
            fits = (alike if same else ~alike) & (rows[open_][:, None] != self.rows[bucket][None, :])
            order = np.arange(len(x), 0, -1.0)
            for j in range(w):
                floor = wanted[open_, j][:, None]
                inside = fits & (product >= floor) & (product <= high[open_, j][:, None])
                hit = np.flatnonzero(inside.any(1))
                if not len(hit):
                    continue
                key = np.where(inside[hit], product[hit] * BUCKET + order, -np.inf)  # of equal scores the first place has the larger key
                at = _best(key, k)
                here = np.take_along_axis(key, at, 1)
                value = np.where(here > -np.inf, np.take_along_axis(product[hit], at, 1), -np.inf)
                own = open_[hit]
                both, where = np.concatenate([score[own, j], value], 1), np.concatenate([place[own, j], at + first], 1)
                known = np.where(where >= 0, self.ids[where], 0)
                rank = np.lexsort((self.rows[where], known, -both), axis=1)[:, :k]
                score[own, j], place[own, j] = np.take_along_axis(both, rank, 1), np.take_along_axis(where, rank, 1)
        place[score == -np.inf] = -1
        a, j, i = np.nonzero(place >= 0)
        return a, j, score[a, j, i], place[a, j, i]


def _search(k, same):
    def run(_, candidates, asks):
        import numpy as np
        import pyarrow as pa

        out = [[], [], [], [], []]
        if candidates.num_rows and asks.num_rows:
            matrix = lambda t: np.asarray(t.column("x").combine_chunks().flatten(), np.float64).reshape(t.num_rows, -1)
            column = lambda t, c: t.column(c).to_numpy()
            held = Stretch(matrix(candidates), column(candidates, "row"), column(candidates, "vec_id"), column(candidates, "label"))
            count = np.diff(asks.column("low").combine_chunks().offsets.to_numpy())
            windows = lambda c, fill: np.stack([np.pad(np.asarray(v, np.float64), (0, count.max() - len(v)), constant_values=fill) for v in asks.column(c).to_pylist()])
            rows = column(asks, "row")
            a, j, score, place = held.search(matrix(asks), rows, column(asks, "label"), windows("low", np.inf), windows("high", -np.inf), windows("least", np.inf), k, same)
            out = [rows[a], j, score, held.rows[place], held.ids[place]]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(np.asarray(c, np.int64), t) for c, t in zip(out, kinds)], names=["row", "at", "score", "other", "other_id"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("row", "at").orderBy(F.desc("score"), "other_id", "other")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(asks: DataFrame, candidates: DataFrame, stretches: DataFrame, k: int, same: bool) -> DataFrame:
    """row, at, score, other, other_id, rank: the best k candidates for each window of every ask.

    asks(row, label, x, dim, length, low, high): arrays of windows, ``at`` numbers them
    from 0; candidates(row, vec_id, label, x, dim, stretch); stretches(dim, stretch,
    longest).  ``same``: candidates of the ask's label, else of all others; never the ask's own row.
    """
    several = stretches.agg(F.coalesce(F.max("stretch"), F.lit(0))).first()[0] > 0
    asks = asks.withColumn("least", F.transform("low", lambda _: F.lit(float("-inf"))))

    def wave(asked: DataFrame, of: DataFrame) -> DataFrame:
        """asked holds a row for each ask and stretch that it is sent to."""
        size = F.greatest(F.lit(BUCKET), F.floor(F.lit(BLOCK_VALUES) / F.col("dim")))
        asked = asked.select("dim", "stretch", "row", "label", "x", "low", "high", "least")
        slices = cut(asked.groupBy("dim", "stretch").agg(F.ceil(F.count("*") / size).alias("slices")))
        asked = asked.join(slices, ["dim", "stretch"]).withColumn("slice", F.pmod(F.xxhash64("row"), "slices")).drop("slices")
        dealt = of.join(slices, ["dim", "stretch"]).withColumn("slice", F.explode(F.expr("sequence(0L, slices - 1)"))).select("dim", "stretch", "slice", "row", "vec_id", "label", "x")
        # names of its own, or Spark takes both sides' columns for the same ones
        dealt = dealt.toDF(*[f"{c}_" for c in dealt.columns]).toDF(*dealt.columns)
        by = ["dim", "stretch", "slice"]
        return dealt.groupBy(*by).cogroup(asked.groupBy(*by)).applyInArrow(_search(k, same), _FOUND)

    first = wave(asks.withColumn("stretch", F.lit(0).cast("long")), candidates.where("stretch = 0"))
    if not several:
        return _ranked(first, k)
    first = cut(_ranked(first, k))
    known = first.where(F.col("rank") == k).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("at", F.col("score").cast("double")))).alias("kth"))
    asks = asks.join(known, "row", "left")
    least = F.transform("low", lambda _, i: F.coalesce(F.element_at("kth", i), F.lit(float("-inf"))))
    asks = asks.withColumn("least", F.when(F.col("kth").isNotNull(), least).otherwise(F.col("least"))).drop("kth")
    open_ = F.filter(F.arrays_zip("low", "high", "least"), lambda w: w["low"] <= w["high"])
    asks = asks.withColumn("wanted", F.array_min(F.transform(open_, lambda w: F.greatest(w["low"], w["least"])))).where("wanted is not null")
    asks = cut(asks)
    # a stretch is wanted if its longest candidate may reach the ask's limit
    others = stretches.where("stretch > 0")
    reaches = F.col("longest") * F.col("length") * (1 + 1e-12) >= F.col("wanted")
    if others.count() <= FEW_STRETCHES:
        sent = asks.join(F.broadcast(others), "dim").where(reaches)
    else:
        last = others.groupBy("dim").agg(F.max("stretch").alias("last"))
        sent = asks.join(F.broadcast(last), "dim").withColumn("stretch", F.explode(F.sequence(F.lit(1).cast("long"), "last"))).join(others, ["dim", "stretch"]).where(reaches)
    return _ranked(first.drop("rank").unionByName(wave(sent, candidates.where("stretch > 0"))), k)


def hard_negatives(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for vectors of whole numbers.

    ``is_anchor`` is a condition on vec_id.  Scores are inner products, higher ones
    first, ties by the smaller vec_id.  An anchor's positives are its first
    ``positives`` other rows of its label; for each, the first ``negatives`` rows of
    other labels whose score is between the two shares of the positive's: a
    positive with a negative score has none.

    Rows without an id or a label, and vectors that are null, empty or hold a
    null or non-finite entry take no part (zero vectors do).  Rows that repeat a vec_id are
    rows of their own: each is an anchor, and the others are its candidates.
    Vectors meet vectors of their own length only.  Scores so large that they
    aren't exact in double precision raise.  Other columns are not read; an
    empty table gives an empty table.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where("vec_id is not null and label is not null and x is not null and size(x) > 0")
    rows = rows.where(F.forall("x", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))
    rows = rows.withColumn("dim", F.size("x").cast("long")).withColumn("length", length).withColumn("falling", F.struct("dim", -F.col("length")))
    rows = cut(numbered(rows, "falling", "row").drop("falling"))
    # a stretch is so many rows in order of length, counted from the first of their dim
    begin = rows.groupBy("dim").agg(F.min("row").alias("begin"))
    size = F.greatest(F.lit(BUCKET), F.floor(F.lit(BLOCK_VALUES) / F.col("dim")))
    rows = rows.join(F.broadcast(begin), "dim").withColumn("stretch", F.floor((F.col("row") - F.col("begin")) / size)).drop("begin")
    rows = cut(rows)
    stretches = cut(rows.groupBy("dim", "stretch").agg(F.max("length").alias("longest")))
    anchors = rows.where(is_anchor).drop("stretch")
    limits = lambda low, high: {"low": F.array(F.lit(low)), "high": F.array(F.lit(high))}
    first = search(anchors.withColumns(limits(float("-inf"), float("inf"))), rows, stretches, positives, same=True)
    first = cut(first.select("row", F.col("rank").alias("n"), F.col("score").alias("positive_score"), F.col("other_id").alias("positive_id")))
    wanted = first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "positive_score"))).alias("p"))
    share = lambda percent, whole: F.transform("p", lambda p: whole(p["positive_score"] * percent / 100).cast("double"))
    asks = anchors.join(wanted, "row").withColumn("low", share(low_percent, F.ceil)).withColumn("high", share(high_percent, F.floor)).drop("p")
    found = search(asks, rows, stretches, negatives, same=False)
    found = found.select("row", (F.col("at") + 1).alias("n"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score")).join(first, ["row", "n"])
    return found.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
