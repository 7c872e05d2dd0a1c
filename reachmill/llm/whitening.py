"""Embedding whitening by hierarchical SVD merging.

A partition is summarised by its number of rows, their mean, and the singular
values and right vectors of its centred rows, all of them: nothing of the
spread is given away.  Two summaries are merged by the SVD of their scaled
vectors stacked on one row more, sqrt(n m / (n + m)) times the difference of
the means, which is what centring on the common mean adds.  Summaries are
merged a few at a time, level by level, so that a task holds ``FAN_IN`` of them
whatever the number of partitions; a summary has at most dim rows of dim values.

Whitened rows are projections on the right vectors over the root of their
variance.  How far their covariance is from the identity is measured on all
rows, by summaries that are merged in the same tree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import cut, ship, small_batches, unpack

#: Summaries that one task merges.
FAN_IN = 8
#: Values of rows that are decomposed at once.
CHUNK_VALUES = 1 << 19
#: A component whose variance is under this share of the largest, times dim, has no whitened values: it is noise of rounding.
NOISE = 1e-14

_SUMMARY = "dim int, n long, total array<double>, spread array<double>, part long"


def finite_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v, dim of the rows whose vector is there, not empty, and without null or non-finite entries; null ids stay."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("v is not null and size(v) > 0")
    return rows.where(F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))).withColumn("dim", F.size("v"))


def merge_spread(n, total, spread, m, other_total, other_spread):
    """(n, total, spread) of both sets of rows; spread holds one row per singular value, the right vector times that value."""
    import numpy as np

    apart = np.sqrt(n * m / (n + m)) * (total / n - other_total / m)
    _, size, right = np.linalg.svd(np.vstack([spread, other_spread, apart]), full_matrices=False)
    rows = min(len(size), len(total))
    return n + m, total + other_total, size[:rows, None] * right[:rows]


def summarise(x):
    """(n, total, spread) of the rows of x."""
    import numpy as np

    total = x.sum(0)
    _, size, right = np.linalg.svd(x - total / len(x), full_matrices=False)
    return len(x), total, size[:, None] * right


def merge_scatter(n, total, scatter, m, other_total, other_scatter):
    """The same for the sum of centred outer products, which is all that the covariance of few columns needs."""
    import numpy as np

    apart = total / n - other_total / m
    return n + m, total + other_total, scatter + other_scatter + (n * m / (n + m)) * np.outer(apart, apart)


def scatter_of(x):
    total = x.sum(0)
    y = x - total / len(x)
    return len(x), total, y.T @ y


def _matrix(column, dim):
    import numpy as np

    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)


def _by_dim(batch):
    """(dim, rows of the batch with that dim)."""
    import numpy as np

    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, np.flatnonzero(dims == dim)


def _out(found):
    import pyarrow as pa

    rows = [(dim, n, total.tolist(), spread.ravel().tolist()) for dim, (n, total, spread) in found]
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
    return [pa.array(c, k) for c, k in zip(columns, kinds)]


def _leaves(values, begin, merge):
    """One summary for each dim of a partition; ``values()``, called once a task, makes the rows that are summarised of a batch's vectors."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        got, of = {}, values()
        for batch in batches:
            for dim, rows in _by_dim(batch):
                x = of(dim, _matrix(batch.column("v").take(pa.array(rows)), dim))
                if not x.shape[1]:
                    continue  # no component has whitened values
                step = max(1, CHUNK_VALUES // x.shape[1])
                for at in range(0, len(x), step):
                    own = begin(x[at : at + step])
                    got[dim] = merge(*got[dim], *own) if dim in got else own
        columns = _out(got.items())
        part = pa.array([TaskContext.get().partitionId()] * len(got), pa.int64())
        yield pa.RecordBatch.from_arrays([*columns, part], names=["dim", "n", "total", "spread", "part"])

    return run


def _merged(merge):
    def run(group):
        import numpy as np
        import pyarrow as pa

        rows = group.to_pylist()
        rows.sort(key=lambda r: r["part"])  # so that a repeated task merges in the same order
        whole = None
        for r in rows:
            total = np.array(r["total"])
            own = (r["n"], total, np.array(r["spread"]).reshape(-1, len(total)))
            whole = merge(*whole, *own) if whole else own
        columns = _out([(rows[0]["dim"], whole)])
        return pa.Table.from_arrays([*columns, pa.array([rows[0]["part"] // FAN_IN], pa.int64())], names=["dim", "n", "total", "spread", "part"])

    return run


def _tree(leaves: DataFrame, merge) -> dict:
    """dim: (n, total, spread) of all rows; only the root of a tree comes to the driver, dim rows of dim values."""
    import numpy as np

    level = cut(leaves)
    while level.groupBy("dim").count().where("count > 1").limit(1).count():
        level = cut(level.groupBy("dim", F.floor(F.col("part") / FAN_IN)).applyInArrow(_merged(merge), _SUMMARY))
    out = {}
    for r in level.toLocalIterator():
        total = np.array(r.total)
        out[r.dim] = (r.n, total, np.array(r.spread).reshape(-1, len(total)))
    return out


@dataclass
class Whitening:
    """The fit of vectors of one length: their number, sums (of the values less ``shift``), variances by component and unit components as rows."""

    n: int
    total: object
    values: object
    components: object
    shift: float = 0.0
    error: float = 0.0

    def explained(self):
        all_of_it = self.values.sum()
        return self.values / all_of_it if all_of_it > 0 else self.values * 0.0

    def usable(self, most):
        """The number of leading components, at most ``most``, that have whitened values."""
        return int((self.values[:most] > NOISE * len(self.total) * max(self.values[0], 1e-300)).sum())

    def project(self, x, most):
        """Whitened rows of x (values less shift)."""
        import numpy as np

        k = self.usable(most)
        return (x - self.total / self.n) @ (self.components[:k] / np.sqrt(self.values[:k])[:, None]).T


def fit(rows: DataFrame, components: int = 32, shift: float = 0.0) -> dict[int, Whitening]:
    """dim: Whitening of rows(v, dim), covariance with divisor n.

    ``shift`` is taken off every value first; near the values' mean it keeps sums
    of whole numbers exact (under 2^53) and differences free of cancellation.
    The error is the largest entry of the whitened rows' covariance less the
    identity, over the usable ones of ``components``.
    """
    import numpy as np

    spark = rows.sparkSession
    small_batches(spark)
    vectors = rows.select("v", "dim")
    leaves = vectors.mapInArrow(_leaves(lambda: lambda dim, x: x - shift, summarise, merge_spread), _SUMMARY)
    models = {}
    for dim, (n, total, spread) in _tree(leaves, merge_spread).items():
        _, size, right = np.linalg.svd(spread, full_matrices=True)
        values = np.concatenate([size * size / n, np.zeros(dim - len(size))])
        largest = np.abs(right).argmax(1)
        right = right * np.sign(right[np.arange(dim), largest])[:, None]  # either sign is right; the largest entry is made positive
        models[dim] = Whitening(n, total, values, right, shift)
    if models:
        shared = ship(spark, models)

        def whitened():
            known = unpack(shared)
            return lambda dim, x: known[dim].project(x - shift, components)

        for dim, (n, _, scatter) in _tree(vectors.mapInArrow(_leaves(whitened, scatter_of, merge_scatter), _SUMMARY), merge_scatter).items():
            models[dim].error = float(np.abs(scatter / n - np.eye(len(scatter))).max())
    return models


def whiten(vectors: DataFrame, components: int = 32, shift: float = 0.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, whitened array<double>, n, deviation, explained array<double>, identity_error: one row per vector that is finite.

    Null or empty vectors and those with a null or non-finite entry take no
    part; rows that repeat a vec_id, or lack one, are rows like others.  Vectors
    of one length are whitened by themselves.  Entries of ``whitened`` beyond the
    rank of the rows (constant columns, fewer rows than columns) are null, and
    their share explained is 0; the arrays have min(components, dim) entries.
    ``deviation`` is the sum over columns of (n value - sum)^2, a long, for vectors of
    whole numbers: null for others and where it doesn't fit.  Other columns are not
    read; an empty table gives an empty table.
    """
    rows = cut(finite_vectors(vectors, id_col, vector_col))
    models = fit(rows, components, shift)
    shared = ship(rows.sparkSession, models)
    return rows.mapInArrow(_apply(shared, components), "vec_id long, whitened array<double>, n long, deviation long, explained array<double>, identity_error double")


def exact_deviation(x, n, total):
    """sum((n x - total)^2) of each row of whole numbers as whole numbers; None where a row isn't whole or the sum is over 2^63."""
    import numpy as np

    if not ((total == np.rint(total)).all() and (np.abs(total) < 2.0**53).all()):
        return [None] * len(x)
    whole = (x == np.rint(x)).all(1) & (np.abs(x) < 2.0**53).all(1)
    rough = np.abs(n * x - total).max(1, initial=0.0)
    small = whole & (rough * rough * x.shape[1] < 2.0**62) & (np.abs(x).max(1, initial=0.0) * n < 2.0**62)
    out = [None] * len(x)
    s = total.astype(np.int64)
    own = n * x[small].astype(np.int64) - s
    for i, v in zip(np.flatnonzero(small).tolist(), (own * own).sum(1).tolist()):
        out[i] = v
    for i in np.flatnonzero(whole & ~small).tolist():
        v = sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
        out[i] = v if v < 2**63 else None
    return out


def _apply(shared, components):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        models = unpack(shared)
        for batch in batches:
            for dim, rows in _by_dim(batch):
                model, picked = models[dim], batch.take(pa.array(rows))
                x = _matrix(picked.column("v"), dim) - model.shift
                k = min(components, dim)
                z = model.project(x, components)
                flat = np.full((len(x), k), np.nan)
                flat[:, : z.shape[1]] = z
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * k)
                share = np.where(np.arange(k) < z.shape[1], model.explained()[:k], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        picked.column("vec_id"), pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), mask=np.isnan(flat.ravel()))), pa.array(np.full(len(x), model.n)),
                        pa.array(exact_deviation(x, model.n, model.total), pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.tile(share, len(x)))), pa.array(np.full(len(x), model.error)),
                    ],
                    names=["vec_id", "whitened", "n", "deviation", "explained", "identity_error"],
                )

    return run
