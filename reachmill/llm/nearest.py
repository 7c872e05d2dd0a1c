"""Approximate nearest neighbours by a hash-prefix forest.

Every vector gets one long hash string per tree (signs of random projections).
A tree is the sorted array of its strings.  A query descends every tree to its
longest matching prefix and then ascends all trees in step: the prefix is
shortened by one bit at a time in all trees until the ranges of strings that
share it hold enough candidates; these are scored exactly.

Signs of projections tell angles, and nearness is the largest inner product.
So an indexed vector v is hashed with sqrt(M^2 - |v|^2) appended, M being the
largest length in its forest, and a query with 0: then the smallest angle is the
largest inner product.  A block has several forests, each of vectors of about
one length, since M far above most lengths would make all angles alike.

The index is dealt into blocks of about ``block`` rows by a hash of the row's
number, and the queries into blocks of their own, so a task holds
one block of either kind whatever the size of the tables, and recall depends on
the size of a forest, not on that of the table.  Equal vectors are hashed once
and share their strings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmill.llm.common import cut

TREES, BITS = 128, 32
BLOCK = 8192
QUERY_BLOCK = 8192
#: Entries over all trees, for each vector of a block, at which the ascent ends.
ENOUGH = 0.6
#: Entries besides, for each neighbour that is asked for: small blocks need more.
FLOOR = 25
#: Lengths in a forest differ by this factor at most, but for strata of fewer than FEWEST rows, which join their neighbour.
SPREAD = 1.2
FEWEST = 64


class Forest:
    """Sorted hash strings of the rows of x, one array per tree; ``rows`` are their numbers."""

    def __init__(self, x, rows, trees, seed=1):
        import numpy as np

        square = (x * x).sum(1)
        x, same = np.unique(np.column_stack([x, np.sqrt(np.maximum(0.0, square.max() - square))]), axis=0, return_inverse=True)
        self.several = len(x) < len(rows)
        self.rows = rows[np.argsort(same, kind="stable")]
        self.counts = np.bincount(same)
        random = np.random.default_rng(seed)
        self.planes = [random.standard_normal((x.shape[1], BITS)) for _ in range(trees)]
        self.orders, self.strings = [], []
        for planes in self.planes:
            strings = self.hash(x, planes)
            order = np.argsort(strings, kind="stable")
            self.orders.append(order.astype(np.int32))
            self.strings.append(strings[order])

    @staticmethod
    def hash(x, planes):
        import numpy as np

        return np.packbits(x @ planes > 0, axis=1).view(">u4").ravel().astype(np.int64)

    def _deepest(self, hashed):
        """Bits of the longest prefix that any query shares with any string."""
        import numpy as np

        least = (1 << BITS) - 1
        for own, strings in zip(hashed, self.strings):
            at = np.searchsorted(strings, own)
            for near in (np.maximum(at - 1, 0), np.minimum(at, len(strings) - 1)):
                least = min(least, int((own ^ strings[near]).min()))
        return BITS - least.bit_length()

    def candidates(self, queries, enough):
        """For each query the candidates' row numbers, from at least ``enough`` entries of the trees if they have so many."""
        import numpy as np

        queries = np.column_stack([queries, np.zeros(len(queries))])
        hashed = np.stack([self.hash(queries, p) for p in self.planes])
        lows, highs = np.zeros(hashed.shape, np.int32), np.zeros(hashed.shape, np.int32)
        open_ = np.arange(len(queries))
        for depth in range(self._deepest(hashed), -1, -1):
            tail = (1 << (BITS - depth)) - 1
            low, high = np.empty((len(hashed), len(open_)), np.int32), np.empty((len(hashed), len(open_)), np.int32)
            for t, strings in enumerate(self.strings):
                own = hashed[t, open_]
                low[t] = np.searchsorted(strings, own & ~tail, "left")
                high[t] = np.searchsorted(strings, own | tail, "right")
            old_low, old_high = lows[:, open_], highs[:, open_]
            old = old_high - old_low
            # trees ascend one after the other, until there are enough
            so_far = np.cumsum(high - low - old, 0) + old.sum(0)
            higher = np.concatenate([np.zeros((1, len(open_)), bool), so_far[:-1] >= enough])
            lows[:, open_], highs[:, open_] = np.where(higher, old_low, low), np.where(higher, old_high, high)
            open_ = open_[so_far[-1] < enough]
            if not len(open_):
                break
        seen = np.zeros(len(self.counts), bool)
        for i in range(len(queries)):
            seen[:] = False
            seen[np.concatenate([order[a:b] for order, a, b in zip(self.orders, lows[:, i].tolist(), highs[:, i].tolist())])] = True
            yield self.rows[np.repeat(seen, self.counts) if self.several else seen]


def forests(x, trees, spread=SPREAD, fewest=FEWEST):
    """(forest, share of entries): one forest for each stretch of lengths within a factor of ``spread``, the longest first.

    How many there are follows from the lengths alone, not from the number of
    rows.  Long vectors are nearest more often, so entries are shared by the square of the mean length.
    """
    import numpy as np

    size = np.sqrt((x * x).sum(1))
    order = np.argsort(-size, kind="stable")
    falling = size[order]
    level = np.floor(np.log(falling[0] / np.maximum(falling, falling[0] * 1e-9)) / np.log(spread) + 1e-9)
    parts = []
    for stretch in np.split(order, np.flatnonzero(np.diff(level)) + 1):
        if parts and len(parts[-1]) < fewest:
            parts[-1] = np.concatenate([parts[-1], stretch])
        else:
            parts.append(stretch)
    if len(parts) > 1 and len(parts[-1]) < fewest:
        parts[-2:] = [np.concatenate(parts[-2:])]
    weight = np.array([(size[rows].mean() / falling[0]) ** 2 for rows in parts])
    weight *= len(x) / (weight * [len(rows) for rows in parts]).sum()
    return [(Forest(x[rows], rows, trees, seed), w) for seed, (rows, w) in enumerate(zip(parts, weight), 1)]


def _search(k, trees, enough, spread):
    def run(_, index, queries):
        import numpy as np
        import pyarrow as pa

        out = [[], [], [], []]
        if index.num_rows and queries.num_rows:
            index, queries = index.combine_chunks(), queries.combine_chunks()
            matrix = lambda t: np.asarray(t.column("v").chunk(0).values, np.float64).reshape(t.num_rows, -1)
            x, q = matrix(index), matrix(queries)
            ids, own = index.column("vec_id").to_numpy(), index.column("row").to_numpy()
            qids, asked = queries.column("vec_id").to_numpy(), queries.column("row").to_numpy()
            everything = np.arange(len(x))
            grown = forests(x, trees, spread)
            found_by = [f.candidates(q, w * (enough * len(f.rows) + FLOOR * k / len(grown))) for f, w in grown]
            for i, found in enumerate(zip(*found_by)):
                rows = np.concatenate(found)
                rows = rows if len(rows) > k else everything
                rows = rows[own[rows] != asked[i]]
                near = x[rows]
                if len(rows) > k:
                    rough = near @ q[i]
                    slack = 1e-12 * (np.abs(near).max() * np.abs(q[i]).max() * x.shape[1])
                    keep = rough >= np.partition(rough, len(rows) - k)[len(rows) - k] - slack
                    rows, near = rows[keep], near[keep]
                score = np.zeros(len(rows))
                for j in range(x.shape[1]):  # summed component by component, so equal vectors tie exactly
                    score += near[:, j] * q[i, j]
                best = np.lexsort((ids[rows], -score))[:k]
                out[0].append(np.full(len(best), asked[i]))
                out[1].append(np.full(len(best), qids[i]))
                out[2].append(ids[rows[best]])
                out[3].append(score[best])
        join = lambda parts, t: pa.array(np.concatenate(parts) if parts else np.empty(0), t)
        return pa.table({"asked": join(out[0], pa.int64()), "query_id": join(out[1], pa.int64()), "vec_id": join(out[2], pa.int64()), "score": join(out[3], pa.float64())})

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v, dim of the rows that take part: not null, not zero, all components finite."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return rows.where(finite & F.exists("v", lambda c: c != 0)).withColumn("dim", F.size("v"))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES, block: int = BLOCK, query_block: int = QUERY_BLOCK, spread: float = SPREAD, enough: float = ENOUGH) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest inner product found for each query.

    ``is_query`` is a condition on vec_id.  A query row is no candidate of its
    own; rows that repeat a vec_id are queries and candidates of their own, so
    that k rows come for each.  With fewer candidates than k all of them are
    given.  Ties go to the smaller vec_id.  Null, empty or zero vectors and
    vectors with a null or non-finite component take no part, nor do rows
    without an id.  Vectors meet vectors of their own length only.  Other
    columns are not read; an empty table gives an empty table.
    """
    rows = cut(usable(vectors, id_col, vector_col).withColumn("row", F.monotonically_increasing_id()))
    n, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-asked // query_block))
    index = rows.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks))).withColumn("q", F.explode(F.expr(f"sequence(0L, {query_blocks - 1}L)")))
    # columns of its own, or Spark takes the two sides' columns for the same ones when it prunes them
    queries = rows.where(is_query).select(*[F.col(c).alias(f"{c}_") for c in rows.columns]).withColumnsRenamed({f"{c}_": c for c in rows.columns})
    queries = queries.withColumn("q", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(query_blocks))).withColumn("b", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    found = index.groupBy("dim", "b", "q").cogroup(queries.groupBy("dim", "b", "q")).applyInArrow(_search(k, trees, enough, spread), "asked long, query_id long, vec_id long, score double")
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
