"""Hard negatives, mixing and whitening against brute force, and on awkward rows."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachmill.llm import hard_negatives, mixing, queries, whitening

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, row string, dim string, stretch string, n string"
NAN, INF = float("nan"), float("inf")


def table(spark, x, labels=None, ids=None):
    ids = range(len(x)) if ids is None else ids
    labels = [0] * len(x) if labels is None else labels
    return spark.createDataFrame([(int(i), [float(c) for c in v], None if label is None else int(label), "a", "b", "c", "d") for i, v, label in zip(ids, x, labels)], VECTORS)


def slow_negatives(x, ids, labels, every, positives=5, negatives=3):
    """(anchor, positive, rank, negative, scores) by looking at everything; x holds whole numbers."""
    out = []
    for a in range(len(x)):
        if ids[a] % every:
            continue
        score = [int(v) for v in x @ x[a]]
        order = sorted((i for i in range(len(x)) if i != a), key=lambda i: (-score[i], ids[i]))
        for p in [i for i in order if labels[i] == labels[a]][:positives]:
            fits = [i for i in order if labels[i] != labels[a] and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:negatives]
            out += [(ids[a], ids[p], r, ids[i], score[p], score[i]) for r, i in enumerate(fits, 1)]
    return sorted(out)


def rows_of(df, columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


NEGATIVES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("lengths", ["alike", "unlike", "ties"])
def test_hard_negatives_against_all_products(spark, monkeypatch, lengths):
    # small stretches and buckets, so that several stretches, slices and pruned buckets occur
    monkeypatch.setattr(hard_negatives, "BUCKET", 16)
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 400)
    random = np.random.default_rng(3)
    x = random.standard_normal((600, 8)) + 0.7
    if lengths == "unlike":
        x *= np.exp(1.2 * random.standard_normal(600))[:, None]
    x = np.rint(8 * x) if lengths == "ties" else np.rint(300 * x)
    if lengths == "ties":
        x[200:420] = x[7]  # one vector that a third of the rows share
    ids, labels = random.permutation(600).tolist(), random.integers(0, 4, 600).tolist()
    labels[250:400] = [1] * 150
    got = hard_negatives.hard_negatives(table(spark, x, labels, ids), F.col("vec_id") % 10 == 0)
    want = slow_negatives(x.astype(int), ids, labels, 10)
    assert rows_of(got, NEGATIVES) == want and len(want) > 300


def test_hard_negatives_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([[math.floor(256 * float(c)) for c in r.embedding] for r in rows])
    ids = [r.vec_id for r in rows]
    labels = [(r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label for r in rows]
    assert rows_of(queries.op11_hard_negatives(spark, SF), NEGATIVES) == slow_negatives(x, ids, labels, 50)


def test_buckets_are_pruned_by_length():
    random = np.random.default_rng(5)
    unit = random.standard_normal((8192, 16))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    x = np.rint(unit * 1000 * np.exp(random.standard_normal(8192))[:, None])
    ids = np.arange(8192)
    held = hard_negatives.Stretch(x, ids, ids, np.zeros(8192, int))
    asks, flat = x[:50], lambda v: np.full((50, 1), v)
    a, _, score, place = held.search(asks, ids[:50], np.zeros(50, int), flat(-INF), flat(INF), flat(-INF), 5, True)
    for i in range(50):
        s = x @ asks[i]
        s[i] = -INF
        assert score[a == i].tolist() == sorted(s, reverse=True)[:5]
        assert (s[held.rows[place[a == i]]] == score[a == i]).all()
    assert held.visited < 0.4 * 50 * 8192
    with pytest.raises(ValueError):
        hard_negatives.Stretch(x * 1e6, ids, ids, ids).search(asks * 1e6, ids[:50], ids[:50], flat(0.0), flat(1.0), flat(0.0), 1, True)


def test_hard_negatives_awkward(spark):
    rows = [
        (0, [4.0, 0.0], 1), (2, [3.0, 0.0], 1), (2, [3.0, 0.0], 1), (3, [2.0, 1.0], 2), (3, [2.0, 1.0], 2), (4, [2.0, 0.0], None), (5, None, 2), (6, [], 2), (7, [None, 1.0], 2),
        (8, [NAN, 1.0], 2), (9, [INF, 1.0], 2), (None, [2.0, 2.0], 2), (10, [0.0, 0.0], 1), (20, [1.0], 1), (30, [-4.0, 0.0], 3), (40, [-1.0, 0.0], 3),
    ]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], VECTORS)
    got = rows_of(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0), NEGATIVES)
    assert got == sorted([(0, 2, r, 3, 12, 8) for r in (1, 2)] * 2 + [(10, 0, 1, 3, 0, 0), (10, 0, 2, 3, 0, 0), (10, 0, 3, 30, 0, 0)] + [(10, 2, r, n, 0, 0) for r, n in ((1, 3), (2, 3), (3, 30))] * 2 + [(0, 10, 1, n, 0, 0) for n in ()])
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Share by weight, cut at the limits, share what is left over again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    whole, fixed = share * sum(sizes.values()), set()
    while True:
        left = whole - sum(most * sizes[s] for s in fixed)
        free = sum(weight[s] for s in names if s not in fixed)
        target = {s: most * sizes[s] if s in fixed else left * weight[s] / free for s in names}
        above = {s for s in names if s not in fixed and target[s] > most * sizes[s]}
        if not above:
            return target
        fixed |= above


def slow_tilt(sizes, target, most=2):
    """Rates min(most, exp(t size / mean)) that take the target, by bisection."""
    s = np.array(sizes, float)
    x, low, high = s / s.mean(), -1e4, 1e4
    for _ in range(300):
        t = (low + high) / 2
        low, high = (t, high) if (s * np.minimum(most, np.exp(np.minimum(t * x, 1)))).sum() < target else (low, t)
    return np.minimum(most, np.exp(np.minimum(low * x, 1)))


def test_mixing_against_bisection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # sources of unlike sizes, a null one, and one that holds a third of the rows
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 50 == 1, F.lit(None)).when(F.col("doc_id") % 5 == 1, "É").otherwise(F.col("source")))
    got = mixing.mix(docs).collect()
    own = {r.doc_id: r for r in docs.collect()}
    by = {}
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", own[r.doc_id].text or "")) and r.source == own[r.doc_id].source
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        by.setdefault(r.source, []).append(r)
    assert len(got) == len(own)
    want = slow_targets({s: sum(r.size for r in rows) for s, rows in by.items()})
    solved = 0
    for s, rows in by.items():
        assert rows[0].source_size == sum(r.size for r in rows) and rows[0].target == pytest.approx(want[s], rel=1e-9)
        sizes = [r.size for r in rows]
        if want[s] >= 2 * sum(sizes):
            assert all(r.copies == 2 for r in rows)
            continue
        assert [r.rate for r in rows] == pytest.approx(slow_tilt(sizes, want[s]).tolist(), abs=1e-6)
        # the smallest sizes make up what the larger ones leave over
        assert abs(sum(r.taken for r in rows) - want[s]) <= max(50, 0.02 * want[s])
        solved += 1
    assert solved >= 3
    again = mixing.mix(docs.repartition(7, "text")).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in got)


def test_mixing_in_one_large_cell(spark):
    docs = spark.createDataFrame([(i, "one two three", "s", 1) for i in range(3000)] + [(5000 + i, "a b", None, 1) for i in range(1000)], "doc_id long, text string, source string, size int")
    rows = mixing.mix(docs, weights=(1, 4)).collect()
    # 11,000 words, of which 16,500 are shared 1 : 4; the null source stops at 4,000
    assert {(r.source, r.target) for r in rows} == {("s", 12_500.0), (None, 4000.0)}
    assert abs(sum(r.taken for r in rows if r.source == "s") - 12_500) <= 1.5 and {r.copies for r in rows} == {1, 2}


def test_mixing_awkward(spark):
    schema = "doc_id long, text string, source string, size string, target string, copies string, part string"
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n", "a"), (4, "one", "b"), (4, "one", "b"), (None, "two words", "b"), (5, "x " * 50_000, None), (6, "é ß", None), (7, "w", "B")]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    got = mixing.mix(df).collect()
    assert sorted((r.doc_id or 0, r.size, r.source or "") for r in got) == sorted([(1, 0, "a"), (2, 0, "a"), (3, 0, "a"), (4, 1, "b"), (4, 1, "b"), (0, 2, "b"), (5, 50_000, ""), (6, 1, ""), (7, 1, "B")])
    assert all(r.taken <= 2 * r.size for r in got)
    assert {(r.source, r.target) for r in got} == {("B", 2.0), ("a", 0.0), ("b", 8.0), (None, 1.5 * 50_006 - 10)}
    assert mixing.mix(df.limit(0)).collect() == []
    nothing = mixing.mix(df.where("doc_id <= 3")).collect()
    assert {(r.size, r.target, r.taken) for r in nothing} == {(0, 0.0, 0)}


def test_many_sources_are_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs).collect()
    taken = {}
    for r in rows:
        taken.setdefault((r.source, r.target), []).append(r.taken)
    assert len(rows) == docs.count() and all(abs(sum(t) - target) <= max(60, 0.05 * target) for (_, target), t in taken.items())


def slow_whitening(x, most):
    y = x - x.mean(0)
    e, u = np.linalg.eigh(y.T @ y / len(y))
    e, u = e[::-1], u[:, ::-1]
    return (y @ u[:, :most]) / np.sqrt(e[:most]), e / e.sum()


def test_whitening_query_against_one_decomposition(spark):
    rows = sorted(spark.read.parquet(f"{SF}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r.embedding] for r in rows])
    n, total = len(x), x.sum(0)
    want, share = slow_whitening((x - 1_000_000).astype(float), 32)
    got = sorted(queries.op13_embedding_whitening(spark, SF).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in got] == [(r.vec_id, c) for r in rows for c in range(1, 33)]
    z = np.array([r.whitened for r in got]).reshape(n, 32)
    assert np.abs(z * np.sign((z * want).sum(0)) - want).max() < 1e-8
    assert [r.deviation for r in got[::32]] == [int(((n * v - total) ** 2).sum()) for v in x]
    assert [r.explained for r in got[:32]] == pytest.approx(share[:32].tolist(), rel=1e-9)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_merging_loses_nothing():
    random = np.random.default_rng(1)
    x = random.standard_normal((300, 6)) @ random.standard_normal((6, 6)) + 50
    cuts = [0, 1, 2, 5, 9, 100, 101, 300]
    parts = [whitening.summarise(x[a:b]) for a, b in zip(cuts, cuts[1:])]
    while len(parts) > 1:
        parts = [whitening.merge_spread(*p, *q) for p, q in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1 :]
    n, total, spread = parts[0]
    y = x - x.mean(0)
    assert n == 300 and np.allclose(total, x.sum(0)) and np.allclose(spread.T @ spread, y.T @ y, rtol=1e-12)


def test_whitening_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "CHUNK_VALUES", 40)
    x = np.random.default_rng(2).standard_normal((200, 5)) @ np.diag([5, 4, 3, 2, 1.0]) + [100, -7, 0, 3, 3]
    rows = whitening.whiten(table(spark, x).repartition(13), 3).collect()
    want, share = slow_whitening(x, 3)
    z = np.array([r.whitened for r in sorted(rows, key=lambda r: r.vec_id)])
    assert np.abs(z * np.sign((z * want).sum(0)) - want).max() < 1e-9
    assert rows[0].explained == pytest.approx(share[:3].tolist()) and rows[0].identity_error < 1e-9 and rows[0].deviation is None


def test_whitening_awkward(spark):
    x = [(1, [1.0, 5.0, 0.0]), (1, [1.0, 5.0, 0.0]), (None, [4.0, 5.0, 1.0]), (2, [2.0, 5.0, 7.0]), (3, None), (4, []), (5, [1.0, None, 2.0]), (6, [1.0, NAN, 2.0]), (7, [1.0, -INF, 2.0]), (8, [9.0]), (9, [3.0, 4.0]), (10, [5.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "a", "b", "c", "d") for i, v in x], VECTORS)
    got = {}
    for r in whitening.whiten(df, 32).collect():
        got.setdefault(len(r.whitened), []).append(r)
    assert {d: len(rows) for d, rows in got.items()} == {3: 4, 1: 1, 2: 2}
    three = got[3]
    assert all(r.whitened[2] is None and r.explained[2] == 0.0 and r.n == 4 for r in three)  # a constant column
    z = np.array([r.whitened[:2] for r in three])
    assert np.allclose(z.T @ z / 4, np.eye(2)) and np.allclose(z.mean(0), 0) and three[0].identity_error < 1e-12
    by = {r.vec_id: r.deviation for r in three}
    assert by == {1: (4 - 8) ** 2 + 64, None: 8**2 + 4**2, 2: 20**2}
    assert got[1][0].whitened == [None] and got[1][0].n == 1 and got[1][0].identity_error == 0.0
    assert all(r.whitened[0] ** 2 == pytest.approx(1) and r.whitened[1] is None for r in got[2])
    assert whitening.whiten(df.limit(0)).collect() == []


def test_deviation_is_exact_beyond_double_precision():
    x = np.array([[2.0**30, 1.0], [-(2.0**30), 0.0], [0.5, 1.0], [2.0**31, 7.0]])
    total = np.array([2.0**31 - 1, 8.0])
    want = [sum((4 * int(a) - int(t)) ** 2 for a, t in zip(r, total)) for r in x]
    got = whitening.exact_deviation(x, 4, total)
    assert got[2] is None and [got[0], got[1]] == [w if w < 2**63 else None for w in want[:2]] and got[3] is None and want[3] >= 2**63
