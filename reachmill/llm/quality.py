"""Quality scores by histogram gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents and flattened
into parallel arrays, which all rows of a batch descend at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import ship, small_batches, unpack

#: Labelled documents that the trees are fitted on, about.
SAMPLE = 16_000
TREES, DEPTH, BINS, RATE = 80, 4, 32, 0.15
#: Symbols whose share of the bytes is a statistic each.
SYMBOLS = "!?.,;:|#$%&*@/\\<>{}[]()\"'-_=+~"


def statistics(text: str):
    """The document statistics of a whole text, as a vector; an empty text has zeros."""
    import numpy as np

    data = text.encode("utf-8", "replace")
    raw = np.frombuffer(data, np.uint8)
    n = len(raw)
    if not n:
        return np.zeros(len(SYMBOLS) + 27)
    count = np.bincount(raw, minlength=256).astype(float)
    symbols = count[[ord(c) for c in SYMBOLS]]
    lower, upper, digits = count[97:123].sum(), count[65:91].sum(), count[48:58].sum()
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[0], (~blank).view(np.int8), [0]]))
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    width = ends - begins
    words = len(width)
    lines = data.split(b"\n")
    filled = [s for s in lines if s.strip()]
    sizes = np.array([len(s) for s in filled] or [0], float)
    terms = data.split()
    distinct = len(set(terms))
    last = raw[ends - 1] if words else raw[:0]
    first = raw[begins] if words else raw[:0]
    caps = (first >= 65) & (first <= 90)
    shout = caps & (width > 1) & ((raw[np.minimum(begins + 1, n - 1)] >= 65) & (raw[np.minimum(begins + 1, n - 1)] <= 90)) if words else caps
    symbol_end = ~(((last >= 48) & (last <= 57)) | ((last >= 65) & (last <= 90)) | ((last >= 97) & (last <= 122)) | (last >= 128))
    plain_end = (last == 46) | (last == 44)
    own = lambda x, m: float(x) / max(m, 1)
    letters = count[:128] / max(count[:128].sum(), 1)
    spread = -float((letters[letters > 0] * np.log2(letters[letters > 0])).sum())
    rest = [
        np.log1p(n), np.log1p(words), own(lower, n), own(upper, n), own(digits, n), own(blank.sum(), n), own((raw >= 128).sum(), n), own(count[10], n),
        float(width.mean()) if words else 0, float(width.std()) if words else 0, float(width.max()) if words else 0, own((width <= 3).sum(), words), own((width >= 12).sum(), words),
        own(distinct, words), distinct / (words**0.75 + 1), own(caps.sum(), words), own(shout.sum(), words), own(symbol_end.sum(), words), own((symbol_end & ~plain_end).sum(), words), own(plain_end.sum(), words),
        np.log1p(len(filled)), sizes.mean(), sizes.std() / (sizes.mean() + 1), 1 - own(len(set(filled)), len(filled)), own(sum(s[-1:] in b".!?:;" for s in filled), len(filled)), spread, own(count[124] + count[9], words),
    ]
    return np.concatenate([symbols / n, rest])


class Trees:
    """Boosted trees for a 0/1 target with logistic loss, on features in at most BINS bins."""

    def fit(self, x, y, trees=TREES, depth=DEPTH, bins=BINS, rate=RATE, shrink=5.0):
        import numpy as np

        self.edges = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
        codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)]).astype(np.int64)
        p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.start)
        size = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature, self.cut, self.value = np.zeros((trees, size), np.int64), np.full((trees, size), np.inf), np.zeros((trees, size))
        for t in range(trees):
            prob = 1 / (1 + np.exp(-score))
            g, h = prob - y, prob * (1 - prob)
            node = np.zeros(len(y), np.int64)
            for level in range(depth + 1):
                base = 2**level - 1
                own = node - base
                width = 2**level
                sg, sh = np.bincount(own, g, width), np.bincount(own, h, width)
                self.value[t, base : base + width] = -rate * sg / (sh + shrink)
                if level == depth:
                    break
                best = np.full(width, 1e-6)
                for f, code in enumerate(codes):
                    key = own * bins + code
                    lg = np.bincount(key, g, width * bins).reshape(width, bins).cumsum(1)[:, :-1]
                    lh = np.bincount(key, h, width * bins).reshape(width, bins).cumsum(1)[:, :-1]
                    rg, rh = sg[:, None] - lg, sh[:, None] - lh
                    gain = lg**2 / (lh + shrink) + rg**2 / (rh + shrink) - (sg**2 / (sh + shrink))[:, None]
                    gain[(lh < 1) | (rh < 1)] = -1
                    gain[:, len(self.edges[f]) :] = -1
                    k = gain.argmax(1)
                    top = gain[np.arange(width), k]
                    for i in np.flatnonzero(top > best):
                        best[i] = top[i]
                        self.feature[t, base + i], self.cut[t, base + i] = f, self.edges[f][k[i]]
                right = x[np.arange(len(y)), self.feature[t, node]] > self.cut[t, node]
                node = 2 * node + 1 + right
            score += self.value[t, node]
        return self

    def predict(self, x):
        """Probabilities of rows x, descending all trees level by level."""
        import numpy as np

        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
        return 1 / (1 + np.exp(-(self.start + self.value[tree, node].sum(1))))


def _statistics(batches):
    import pyarrow as pa

    for batch in batches:
        rows = [statistics(t.as_py() or "") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64())), batch.column(2)], names=["id", "x", "y"])


def _score(shared):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        trees = unpack(shared)
        for batch in batches:
            x = np.array([statistics(t.as_py() or "") for t in batch.column(1)])
            score = trees.predict(x) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return run


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees from about ``sample`` labelled documents that are not held out, chosen by a hash of the id."""
    import numpy as np

    small_batches(docs.sparkSession)
    usable = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)").where(~held_out("id"))
    usable = usable.groupBy("id").agg(F.max("y").alias("y"))
    share = int(1_000_000 * sample / max(1, usable.count())) + 1
    chosen = usable.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000)) < share)  # about ``sample`` rows, so it may be broadcast
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id").select("id", "text", "y")
    got = rows.mapInArrow(_statistics, "id long, x array<double>, y int").toPandas().sort_values("id", kind="stable")
    if not len(got):
        return Trees().fit(np.zeros((2, len(SYMBOLS) + 27)), np.array([0.0, 1.0]), trees=1, depth=1)
    return Trees().fit(np.stack(got["x"]), got["y"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    Scores need the text only.  Null and empty texts are scored by their zero
    statistics.  Rows whose crc32(doc_id) mod 4 is 2 are held out of fitting.
    Without any label every score is 0.5.  Repeated rows get equal scores, null
    ids are scored too, other columns are not read.
    """
    trees = fit(docs, labels, id_col, text_col, sample=sample)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_score(ship(docs.sparkSession, trees)), "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
