"""Near-duplicate groups by fast similarity sketching.

A document's set holds the 64-bit hashes of its distinct word shingles.  The
sketch has ``t`` coordinates.  In round i < t every element is thrown into a
bin chosen by round i's hash; in round t + b every element is offered to bin
b.  A coordinate keeps the smallest (round, value) it was offered, so an early
round wins and every coordinate is filled after 2t rounds at the latest; each
coordinate agrees between two sets with probability equal to their Jaccard
similarity and the number of agreements is as concentrated as with
independent permutations.

Candidates come from banding.  Documents with equal sets are collapsed to one
representative first, so exact copies never form pairs.  Band keys are sorted
across the cluster by (key, id); a run of equal keys gives all its pairs if it
is short and a star around its smallest id if it is long or is cut by a
partition border.  Candidates are confirmed on whole sets, confirmed links are
joined to components by star contraction, and the members of long runs that
are still in different components are then compared pair by pair.  No step
brings a whole bucket into one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import cut, small_batches, tidy

#: Runs of at most so many documents give all their pairs at once.
SHORT_RUN = 16
#: Band keys in a task, about.
PART_ROWS = 2_000_000
#: The set of an id in more than this many pairs, and in more than a thousandth of all, is dealt to several tasks.
HOT_LINKS = 1000


def mix64(x):
    """A 64-bit finaliser on numpy arrays of unsigned 64-bit integers."""
    import numpy as np

    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text, width=3):
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    A-Z is lower-cased; words are maximal runs of anything but space and
    U+0009 to U+000D.  Fewer words than ``width`` make one shingle of the
    whole sequence; no words make an empty set.
    """
    import numpy as np
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(n, width)
    odd = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1) + 2 * k) & 0xFFFFFFFFFFFFFFFF | 1) for i in range(k)]
    s = h[: n - k + 1] * odd[0]
    for i in range(1, k):
        s = mix64(s) + h[i : n - k + 1 + i] * odd[i]
    return np.unique(mix64(s))


class Sketcher:
    """Sketches of t = bands * rows coordinates and their band keys."""

    def __init__(self, bands, rows, seed=1):
        import numpy as np

        self.bands, self.rows, self.t = bands, rows, bands * rows
        self.seeds = mix64(np.arange(1, 2 * self.t + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        self.salt = mix64(np.arange(1, bands + 1, dtype=np.uint64) + np.uint64(977 * seed))

    def sketch(self, x):
        import numpy as np

        t, low = self.t, np.uint64(0xFFFFFFFF)
        s = np.full(t, np.iinfo(np.uint64).max, np.uint64)
        done, step = 0, max(1, min(t, math.ceil(2 * t * math.log(t + 1) / len(x))))
        while done < t:
            rounds = np.arange(done, min(t, done + step), dtype=np.uint64)
            h = mix64(x[None, :] ^ self.seeds[rounds.astype(np.intp)][:, None])
            bins = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)
            np.minimum.at(s, bins.ravel().astype(np.intp), ((rounds << np.uint64(32))[:, None] | (h & low)).ravel())
            done += len(rounds)
            if not (s == np.iinfo(np.uint64).max).any():
                return s
        for b in np.flatnonzero(s == np.iinfo(np.uint64).max):
            s[b] = np.uint64((t + int(b)) << 32) | (mix64(x ^ self.seeds[t + b]) & low).min()
        return s

    def band_keys(self, x):
        import numpy as np

        s = mix64(self.sketch(x)).reshape(self.bands, self.rows)
        key = self.salt.copy()
        for i in range(self.rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + s[:, i])
        return key.view(np.int64)


def _signatures(bands, rows, width):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        sketcher = Sketcher(bands, rows)
        for batch in batches:
            sizes, keys, bits = [], [], []
            for text in batch.column(1):
                x = shingle_set(text.as_py() or "", width)
                sizes.append(len(x))
                keys.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None)
                bits.append(sketcher.band_keys(x) if len(x) else np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(b) for b in bits])]).astype(np.int32)
            flat = np.concatenate(bits) if bits else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    return run


def _sets(width):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            sets = [shingle_set(text.as_py() or "", width).view(np.int64) for text in batch.column(1)]
            there = np.array([len(s) > 0 for s in sets], bool)  # an empty set is alike to nothing
            sets = [s for s in sets if len(s)]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(there)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["id", "shingles"])

    return run


def _runs(short, percent):
    """Candidates from rows sorted by (key, id): see the module's text.

    Rows out: kind 0, a pair (x, y); kind 1, (x = key, y = smallest id of a run
    at the partition's border); kind 2, a member (x = key, y = id) of a long run
    or a border run.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def out(kind, x, y):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y)], names=["kind", "x", "y"])

        got = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
        if not got:
            return
        key, ids, n = (np.concatenate([g[i] for g in got]).astype(np.int64) for i in range(3))
        if not len(key):
            return
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([start, [len(key)]]))
        border = np.zeros(len(start), bool)
        border[[0, -1]] = True
        yield out(1, key[start[border]], ids[start[border]])
        loose = (size > short) | border
        member = np.repeat(loose, size)
        yield out(2, key[member], ids[member])
        run_of = np.repeat(np.arange(len(start)), size)
        long = np.flatnonzero(np.repeat(size > short, size))
        first = start[run_of[long]]
        far = first != long
        lefts, rights = [first[far]], [long[far]]
        little = np.flatnonzero(np.repeat((size <= short) & (size > 1), size))
        for d in range(1, short):  # the pairs of short runs, by their distance within the run
            other = little + d
            little, other = little[other < len(key)], other[other < len(key)]
            same = run_of[little] == run_of[other]
            little = little[same]
            if not len(little):
                break
            lefts.append(little)
            rights.append(little + d)
        left, right = np.concatenate(lefts), np.concatenate(rights)
        a, b = n[left], n[right]
        fits = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (ids[left] != ids[right])
        x, y = ids[left[fits]], ids[right[fits]]
        if len(x):
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
            yield out(0, pairs[0], pairs[1])

    return run


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links(a, b): the smallest id reachable.

    Alternates large-star and small-star contraction until the edges no longer
    change, so the number of rounds is logarithmic in the longest path.  Hot
    ids are pre-aggregated; each round is checkpointed.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, width: int = 3, bands: int = 32, rows: int = 5, short: int = SHORT_RUN) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Linked are documents with 100 * |intersection| >= percent * |union|;
    component_id is the smallest doc_id reachable over links.  With 32 bands of
    5 rows a pair at 0.85 is missed with probability 7e-9.

    Null texts, empty texts and texts without words have no shingles and link
    with nothing: their component_id is their own doc_id.  All other rows that
    share a doc_id count as one node, linked by any of their texts.  A null doc_id
    takes no part in links: its component_id is null and it is kept.  Other
    columns are not read.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows_in = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sig = cut(rows_in.mapInArrow(tidy(_signatures(bands, rows, width)), "doc_id long, n_shingles long, set_key binary, bands array<long>"))
    # equal sets: one representative each
    classes = sig.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    classes = cut(classes)
    members = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"), "n")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), classes.count() * bands // PART_ROWS + 1)
    runs = cut(members.repartitionByRange(parts, "key", "id").sortWithinPartitions("key", "id").mapInArrow(tidy(_runs(short, percent)), "kind int, x long, y long"))
    border = runs.where("kind = 1").groupBy("x").agg(F.min("y").alias("a"), F.collect_set("y").alias("ys")).where("size(ys) > 1").select("a", F.explode("ys").alias("b")).where("a <> b")
    loose = runs.where("kind = 2").select(F.col("x").alias("key"), F.col("y").alias("id"))
    pairs = cut(runs.where("kind = 0").select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(border).distinct())
    texts = rows_in
    if sig.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        texts = rows_in.dropDuplicates(["doc_id", "text"])  # a repeated row gives its set once
    links, shared = confirm(pairs, texts, percent, width), shared_ids(sig, classes)
    links = cut(links if shared is None else links.unionByName(shared))
    found = cut(components(links))
    # members of long runs and of runs at a border that are still apart
    apart = loose.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    open_keys = apart.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    apart = cut(apart.join(open_keys, "key", "left_semi"))
    if apart.limit(1).count():
        stars = apart.join(apart.groupBy("key").agg(F.min("id").alias("a")), "key").select("a", F.col("id").alias("b"))
        family = components(stars).withColumnRenamed("component", "family")
        members = cut(apart.select("id", "component").distinct().join(family, "id"))
        links = cut(links.unionByName(between(members, texts, percent, width)))
        found = cut(components(links))
    label = classes.join(found, classes.rep == found.id, "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    # one key may hold a third of the rows: the few keys with over a thousandth of them are broadcast
    total = sig.count()
    counts = sig.where("set_key is not null").groupBy("set_key").agg(F.count("*").alias("c"))
    hot = counts.where(F.col("c") * 1000 > total).where("c > 100").select("set_key")
    hot_label = label.join(hot, "set_key", "left_semi").select("set_key", F.col("component").alias("hot"))
    out = sig.drop("bands").join(F.broadcast(cut(hot_label)), "set_key", "left")
    cold = out.withColumn("k", F.when(F.col("hot").isNull(), F.col("set_key")).otherwise(F.unhex(F.sha2(F.col("doc_id").cast("string"), 256))))
    out = cold.join(label.select(F.col("set_key").alias("k"), "component"), "k", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("hot", "component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def shared_ids(sig: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) from the representative of each class to every doc_id in it that is in another class too; None if there is no such doc_id."""
    rows = sig.where("set_key is not null and doc_id is not null")
    several = rows.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).where("lo <> hi").select("doc_id")
    if not several.limit(1).count():
        return None
    own = rows.select("doc_id", "set_key").join(several, "doc_id", "left_semi").distinct()
    return own.join(classes.select("set_key", "rep"), "set_key").select(F.least("rep", "doc_id").alias("a"), F.greatest("rep", "doc_id").alias("b")).where("a <> b").distinct()


def between(members: DataFrame, rows_in: DataFrame, percent: int, width: int, block: int = 256) -> DataFrame:
    """All links (a, b) between members(id, component, family) of one family but different components.

    A family is dealt into blocks of about ``block`` documents by a hash of the
    id; each pair of blocks is one group of bounded size, in which exact
    intersection sizes come from matrix products.  Only links leave it.
    """
    sets = cut(rows_in.join(members.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(tidy(_sets(width)), "id long, shingles array<long>"))
    size = members.groupBy("family").agg(F.ceil(F.count("*") / block).alias("blocks"))
    dealt = members.join(size, "family").withColumn("own", F.pmod(F.xxhash64("id"), "blocks")).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = dealt.select("family", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "id", "component")
    return dealt.join(sets, "id").groupBy("family", "lo", "hi").applyInArrow(_between(percent), "a long, b long").distinct()


def _between(percent, columns=8192):
    def run(group):
        import numpy as np
        import pyarrow as pa

        own, lo, ids, part = (group.column(n).to_numpy() for n in ("own", "lo", "id", "component"))
        sets = [np.asarray(x.values) for x in group.column("shingles")]
        n = np.array([len(x) for x in sets])
        left = np.flatnonzero(own == lo)
        right = left if group.column("hi")[0].as_py() == lo[0] else np.flatnonzero(own != lo)
        token, where = np.unique(np.concatenate(sets), return_inverse=True)
        doc = np.repeat(np.arange(len(sets)), n)
        often = np.bincount(where, minlength=len(token)) > 1
        where, doc = (np.cumsum(often) - 1)[where[often[where]]], doc[often[where]]
        order = np.argsort(where, kind="stable")
        where, doc = where[order], doc[order]
        same = np.zeros((len(left), len(right)), np.float64)
        for at in range(0, int(often.sum()), columns):
            a, b = np.searchsorted(where, [at, at + columns])
            m = np.zeros((len(sets), columns), np.float32)
            m[doc[a:b], where[a:b] - at] = 1
            same += m[left] @ m[right].T
        total = n[left][:, None] + n[right][None, :] - same
        hit = (same * 100 >= total * percent) & (part[left][:, None] != part[right][None, :])
        x, y = np.nonzero(hit)
        x, y = ids[left[x]], ids[right[y]]
        return pa.table({"a": pa.array(np.minimum(x, y), pa.int64()), "b": pa.array(np.maximum(x, y), pa.int64())})

    return run


def confirm(pairs: DataFrame, rows_in: DataFrame, percent: int, width: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    nodes = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = cut(rows_in.join(nodes, "doc_id", "left_semi").mapInArrow(tidy(_sets(width)), "id long, shingles array<long>"))
    # the centre of a large star: its set is copied once for every HOT_LINKS of its pairs, so that no task gets all of them
    bar = max(HOT_LINKS, pairs.count() // 1000)
    hot = F.broadcast(pairs.groupBy("a").agg(F.count("*").alias("c")).where(F.col("c") > bar).select("a", F.ceil(F.col("c") / HOT_LINKS).alias("copies")))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")).join(hot, "a", "left")
    left = left.withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    dealt = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("copies", F.lit(1))).alias("copy"))
    both = dealt.join(right, "b").join(left, ["a", "copy"]).withColumn("same", F.size(F.array_intersect("sa", "sb")))
    return both.where(F.col("same") * 100 >= (F.size("sa") + F.size("sb") - F.col("same")) * percent).select("a", "b").distinct()
