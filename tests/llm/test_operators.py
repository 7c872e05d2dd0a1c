"""Every operator against brute force, an exact round trip or held-out accuracy, and on awkward rows."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reachmill.llm import best_fit, binary_output, chat, exact_dedup, language_id, minhash, nearest, packing, personal_data, quality, queries, sentencepiece_codec, word_tokens

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string"
WORDS = [f"w{i}" for i in range(400)]


def near(i, edits):
    words = WORDS[:200].copy()
    for e in range(edits):
        words[(37 * i + 11 * e) % 200] = f"x{i}y{e}"
    return " ".join(words)


AWKWARD = [
    (1, None, None, None, None, "a", "b"),
    (2, "", "en", "s", 0, None, None),
    (3, "one two", "en", "s", 7, "z", "z"),
    (4, "One TWO", "en", "s", 7, "z", "z"),
    (4, "One TWO", "en", "s", 7, "z", "z"),
    (5, " \t\n ", "fr", "s", 4, "z", "z"),
    (6, "Écoute  le ▁ vent", "fr", "s", 17, "z", "z"),
    (7, "é " * 30_000 + "mail a.b@c.de, 10.0.0.1!", "fr", "s", 60_000, "z", "z"),
    (None, "no id here", "en", "s", 10, "z", "z"),
    (8, near(1, 0), "en", "s", 1, "z", "z"),
    (9, near(2, 2), "en", "s", 1, "z", "z"),
    (10, near(3, 2), "en", "s", 1, "z", "z"),
    (11, near(4, 20), "en", "s", 1, "z", "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return docs.select("doc_id", "text").collect()


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} or ({tuple(words)} if words else set())


def brute_components(pairs):
    sets, parent = [(i, shingles(t)) for i, t in pairs if i is not None], {}
    find = lambda i: i if parent.setdefault(i, i) == i else find(parent[i])
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            n = len(x[1] & y[1])
            if n and 100 * n >= 85 * (len(x[1]) + len(y[1]) - n):
                p, q = find(x[0]), find(y[0])
                parent[max(p, q)] = min(p, q)
    return {i: find(i) for i, _ in sets}


@pytest.mark.parametrize("short", [16, 2])
def test_near_duplicates_against_all_pairs(docs, rows, short):
    got = minhash.near_duplicates(docs, short=short).collect()
    want = brute_components([(r[0], r[1]) for r in rows])
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {r[0]: len(shingles(r[1])) for r in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_in_one_large_group(spark):
    random = np.random.default_rng(5)
    made = [(i, near(int(random.integers(1, 10_000)), int(random.integers(0, 12)))) for i in range(150)]
    got = minhash.near_duplicates(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(made)


def test_near_duplicates_awkward(awkward, nothing):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(awkward).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (5, 0, 5, True), (3, 1, 3, True), (4, 1, 3, False), (None, 1, None, True)} <= got
    assert {(8, 198, 8, True), (9, 198, 8, False), (10, 198, 8, False), (11, 198, 11, True)} <= got
    assert minhash.near_duplicates(nothing).count() == 0


def test_near_duplicates_with_shared_ids(spark):
    """Rows that share an id are one node, whichever of their texts links."""
    texts = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "abcd"}
    for rows, want in (
        ([(1, "a"), (5, "a"), (5, "b"), (7, "b")], {1: {1}, 5: {1}, 7: {1}}),
        ([(3, "a"), (5, "a"), (5, "b"), (4, "b"), (9, "c")], {3: {3}, 5: {3}, 4: {3}, 9: {9}}),
        ([(2, "a"), (2, "b"), (6, "b"), (6, "c"), (8, "c"), (8, "d"), (8, "a")], {2: {2}, 6: {2}, 8: {2}}),
    ):
        got = {}
        for r in minhash.near_duplicates(spark.createDataFrame([(i, texts[c]) for i, c in rows], "doc_id long, text string")).collect():
            got.setdefault(r.doc_id, set()).add(r.component_id)
        assert got == want


def test_shared_ids_link_by_like_texts_only(spark):
    random = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    rows = [(5, " ".join(base)), (5, ""), (7, " ".join(base[:110] + [f"y{i}" for i in range(10)])), (7, None), (7, " \t")]  # 0.83
    for i in range(295):
        words = list(base) if i % 3 else [f"v{i}w{j}" for j in range(60)]
        for at in random.integers(0, len(words), int(random.integers(0, 9))):
            words[at] = f"z{i}x{at}"
        rows.append((int(random.integers(100, 220)) if i % 7 else None, " ".join(words) if i % 11 else ["", None][i % 2]))
    rows += [rows[20]] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(df).collect()
    want = brute_components(rows)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None and r.n_shingles} == {(i, want[i]) for i, t in rows if i is not None and shingles(t)}
    pair = {r.doc_id: r.component_id for r in minhash.near_duplicates(df.limit(5)).collect()}
    assert pair == {5: 5, 7: 7}


def test_components_with_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT_LINKS", 3)
    random = np.random.default_rng(8)
    links = [(0, i) for i in range(1, 40)] + [(100 + i, 101 + i) for i in range(25)] + [(int(a), int(b)) for a, b in random.integers(200, 260, (40, 2))] + [(-5, 300), (-5, 301), (300, -7)]
    parent = {}
    find = lambda i: i if parent.setdefault(i, i) == i else find(parent[i])
    for a, b in links:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    got = minhash.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {i: find(i) for a, b in links if a != b for i in (a, b)}


def test_confirm_with_a_hot_centre(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT_LINKS", 3)
    made = [(i, near(i, i % 9)) for i in range(40)]
    pairs = spark.createDataFrame([(0, i) for i in range(1, 40)], "a long, b long")
    got = {r.b for r in minhash.confirm(pairs, spark.createDataFrame(made, "doc_id long, text string"), 85, 3).collect()}
    sets = [shingles(t) for _, t in made]
    assert got == {i for i in range(1, 40) if 100 * len(sets[0] & sets[i]) >= 85 * len(sets[0] | sets[i])}


def test_sketch_estimates_similarity():
    sketcher, random = minhash.Sketcher(64, 4), np.random.default_rng(1)
    both, own = random.integers(0, 2**63, 700, dtype=np.uint64), random.integers(0, 2**63, 300, dtype=np.uint64)
    a, b = sketcher.sketch(np.concatenate([both, own[:150]])), sketcher.sketch(np.concatenate([both, own[150:]]))
    assert abs((a == b).mean() - 0.7) < 0.12
    assert len(set(sketcher.sketch(both[:1]).tolist())) == 256  # a single element fills every coordinate


def test_exact_duplicates(docs, rows, awkward, nothing):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    got = exact_dedup.exact_duplicates(docs, digest_all=True).collect()
    assert {tuple(r) for r in got} == {(i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    sparse = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs).collect()}
    assert all((r.keep_id, r.group_size, r.kept) == (sparse[r.doc_id].keep_id, sparse[r.doc_id].group_size, sparse[r.doc_id].kept) for r in got)
    assert any(r.text_sha256 is None for r in sparse.values())
    odd = [tuple(r)[:4] for r in exact_dedup.exact_duplicates(awkward).collect()]
    assert odd.count((4, 4, 3, True)) == 2 and (3, 4, 3, False) in odd and (1, 2, 2, False) in odd and (None, None, 1, True) in odd
    assert exact_dedup.exact_duplicates(nothing).count() == 0


def test_quality_holds_out(spark):
    big = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{big}/labels.parquet")
    got = quality.quality_scores(spark.read.parquet(f"{big}/documents.parquet"), labels).join(labels, "doc_id").toPandas()
    assert all(got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2))
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.values[:, None] > bad.values[None, :]).mean() > 0.9
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()


def test_quality_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(2, 0, 0), (3, 1, 0), (4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(awkward, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(nothing, labels).count() == 0
    assert {r.score for r in quality.quality_scores(awkward, labels.limit(0)).collect()} == {0.5}


SPANS = [
    ("write to a.b+c@d-e.f.org, now", [("email", 9, 24)]),
    ("x@y and @z.de and q@@r.de", []),
    ("10.20.30.40 and 256.1.1.1 and 1.2.3.4.5", [("ip", 0, 11), ("ip", 30, 37)]),
    ("pay 4111 1111 1111 1111 or 4111111111111112", [("card", 4, 23)]),
    ("call +1 (743) 555-3824. Not +1234.", [("phone", 5, 22)]),
    ("é+33 1 23 45 67 89", [("phone", 1, 18)]),
]


@pytest.mark.parametrize("text, want", SPANS)
def test_base_spans(text, want):
    assert personal_data.base_spans(text) == want


def slow_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and personal_data.luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.findall("[0-9]", m[0])) <= 15]
    return out


def test_personal_data(docs, rows, awkward, nothing):
    got = {r.doc_id: r for r in personal_data.personal_data(docs, with_masked=True).collect()}
    for i, text in rows:
        base = slow_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(personal_data.join_spans(base).encode()).hexdigest()
        assert set(filter(None, personal_data.join_spans(base).split(","))) <= set(got[i].spans.split(","))
        for k, s, e in base:
            assert text[s:e] not in got[i].text or len(text[s:e]) < 9
    odd = {r.doc_id: r for r in personal_data.personal_data(awkward).collect()}
    assert (odd[7].n_email, odd[7].n_ip, odd[1].spans) == (1, 1, "")
    assert personal_data.personal_data(nothing).count() == 0


@pytest.mark.parametrize("alphabet", ["0123456789.- +()@a", "12+ (-.)@x.", "0.9 -"])
def test_base_spans_on_noise(alphabet):
    random = np.random.default_rng(3)
    for _ in range(400):
        text = "".join(random.choice(list(alphabet), 120))
        assert personal_data.base_spans(text) == slow_spans(text)


def enumerated(field, text, start, end):
    """All segmentations of a place as (score, arcs), by brute force."""
    bounds, arcs = field.lattice(text, start, end)

    def paths(j):
        if not j:
            yield 0.0, ()
        for i, kind, score, _ in arcs[j] if j else ():
            for s, done in paths(i):
                yield s + score, (*done, (i, j, kind))

    return bounds, list(paths(len(bounds)))


def test_field_against_all_segmentations():
    field = personal_data.Field().fit(personal_data.made_examples(120))
    for text in ("+1 (743) 55-38", "jo @ ab.cd", "10 . 2 . 3 . 44", "1234 5678 9", "(200) 555-1234"):
        bounds, every = enumerated(field, text, 0, len(text))
        assert len(every) > 1
        _, arcs = field.lattice(text, 0, len(text))
        total = np.logaddexp.reduce([s for s, _ in every])
        alpha, beta = field.forward(arcs), field.backward(arcs)
        assert abs(alpha[-1] - total) < 1e-9 and abs(beta[0] - total) < 1e-9
        best = max(every, key=lambda p: p[0])[1]
        chance = lambda arc: np.exp(np.logaddexp.reduce([s for s, path in every if arc in path]) - total)
        for sure in (0.0, 0.5, 0.9):
            want = [(personal_data.KINDS[k], bounds[i][0], bounds[j - 1][1]) for i, j, k in best if k is not None and chance((i, j, k)) >= sure]
            assert field.best(text, 0, len(text), sure=sure) == want


def test_field_finds_disguised_entities(docs):
    """Recall of planted spans that the patterns miss, and precision on look-alikes and between plain words."""
    import random

    field, dice = personal_data.fit(docs), random.Random(77)
    found = planted = wrong = 0
    for i in range(400):
        kind = personal_data.KINDS[i % 4]
        for span in (personal_data.disguised(kind, dice), None):
            before, own = "wort here ", span or personal_data.look_alike(dice)
            base, spans = personal_data.find_spans(f"{before}{own} et puis", field)
            assert set(base) <= set(spans)
            planted += span is not None
            found += span is not None and (kind, len(before), len(before) + len(own)) in spans
            wrong += span is None and len(spans) > len(base)
    assert found >= 0.95 * planted and wrong <= 0.01 * planted
    text = "write to " + "a" * 100 + " @ host.org now"
    assert personal_data.find_spans(text, field)[1] == [("email", 9, 120)]


def test_field_learns_and_stays_sure():
    examples = []
    random = np.random.default_rng(2)
    for _ in range(200):
        phone, plain = f"+1 ({random.integers(200, 999)}) 555-{random.integers(1000, 9999)}", str(random.integers(10**5, 10**6))
        text = f" {phone} " if random.random() < 0.5 else f" {plain} "
        examples.append((text, 1, len(text) - 1, [(3, 1, len(text) - 1)] if phone in text else []))
    field = personal_data.Field().fit(examples)
    assert field.best(" +1 (321) 555-1234 ", 1, 18) == [("phone", 1, 18)]
    assert field.best(" 123456 ", 1, 7) == []


def test_sentencepiece_is_the_library(docs, rows, awkward, nothing):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in sentencepiece_codec.encode_digests(docs).collect()}
    for i, text in rows:
        ids = library.encode(text or "")
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and got[i].n_tokens == len(ids)
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    full = {r.doc_id: r for r in sentencepiece_codec.encode(awkward).collect()}
    assert full[1].ids == [] and full[1].decoded == "" and full[3].decoded == "one two" and list(zip(full[3].begins, full[3].ends))[-1][1] == 7
    digests = {r.doc_id: r for r in sentencepiece_codec.encode_digests(awkward).collect()}
    for i in (1, 6, 7):
        spans = np.array([full[i].begins, full[i].ends], "<u4").T.tobytes()
        assert digests[i].spans_sha256 == hashlib.sha256(spans).hexdigest()
    assert sentencepiece_codec.encode_digests(nothing).count() == 0


def mapped_model(folder, **options):
    """The public model with the character map of NFKC normalisation."""
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto, rules = sentencepiece_model_pb2.ModelProto(), sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")).serialized_model_proto())
    if options.pop("mapped", True):
        rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
        proto.normalizer_spec.CopyFrom(rules.normalizer_spec)
    for name, value in options.items():
        setattr(proto.normalizer_spec, name, value)
    (folder / "mapped.model").write_bytes(proto.SerializeToString())
    return str(folder / "mapped.model")


@pytest.mark.parametrize("options", [{"mapped": False}, {}, {"remove_extra_whitespaces": False}, {"add_dummy_prefix": False}])
def test_sentencepiece_ids_and_spans(rows, tmp_path, options):
    """Ids and spans are the library's, through the character map where the model has one."""
    import random

    import sentencepiece

    file = mapped_model(tmp_path, **options)
    library, codec, dice = sentencepiece.SentencePieceProcessor(model_file=file), sentencepiece_codec.Codec(file), random.Random(1)
    texts = [*(r[1] or "" for r in AWKWARD), *(r[1] for r in rows[:40]), " lead", "trail ", "a  b   c", "▁x ▁▁ y", "日本 語\n\n<0x41> <s> é", "\U0001f600 ok", "ＡＢＣ ﬁne ①②", "½ ㌔ plain", "ﷺ ﷺ", "   "]
    texts += ["".join(dice.choice("abc  \n\té▁ＡﬁｶﾞŁ½①日\U0001f600\u3000\u00a0\u200b\u0301") for _ in range(dice.randint(1, 25))) for _ in range(400)]
    for text in texts:
        got, decimals = codec.encode(text)
        assert got[:, 0].tolist() == library.encode(text) and decimals.decode() == ",".join(map(str, got[:, 0].tolist()))
        for (i, begin, end), piece in zip(got.tolist(), library.encode(text, return_type="proto").pieces):
            assert library.is_byte(i) or (begin, end) == (piece.begin, piece.end)
        if not codec.map.units:
            spans = dict.fromkeys((b, e) for _, b, e in got.tolist())
            assert b"".join(text.encode()[b:e] for b, e in spans) == text.encode()


def nearest_recall(spark, vectors, **options):
    """Recall by scores, after a check of ranks and of scores against plain products."""
    got = nearest.nearest(vectors, F.col("vec_id") % 20 == 0, **options).toPandas()
    pdf = vectors.toPandas()
    x, ids = np.stack(pdf.embedding).astype(float), pdf.vec_id.to_numpy()
    hits, queries = 0, ids[ids % 20 == 0]
    for q in queries:
        score = x @ x[ids == q][0]
        best = np.sort(score[ids != q])[::-1][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert len(mine) == 20 and list(mine["rank"]) == list(range(1, 21)) and (mine.score.diff().dropna() <= 0).all()
        assert np.allclose(mine.score, score[[int(np.flatnonzero(ids == v)[0]) for v in mine.vec_id]], rtol=1e-9, atol=1e-12)
        hits += (mine.score.to_numpy() >= best[-1] - 1e-12).sum()
    return hits / 20 / len(queries)


def test_nearest_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    for options in ({}, {"block": 512, "query_block": 40}):
        assert nearest_recall(spark, vectors, **options) >= 0.9


def test_nearest_with_unlike_lengths(spark):
    longer = F.exp(0.6 * F.randn(3))
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").withColumn("by", longer)
    vectors = spark.createDataFrame(vectors.select("vec_id", F.transform("embedding", lambda c: c * F.col("by")).alias("embedding")).collect())
    assert nearest_recall(spark, vectors) >= 0.9


def test_nearest_visits_less_than_half():
    random = np.random.default_rng(4)
    x = random.standard_normal((6000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    ((forest, _),) = nearest.forests(x, nearest.TREES)
    visited, hits = 0, 0
    for q, rows in zip(x[:60], forest.candidates(x[:60], nearest.ENOUGH * len(x) + nearest.FLOOR * 20)):
        visited += len(rows)
        hits += len(set(rows.tolist()) & set(np.argsort(-(x @ q))[:21].tolist()))
    assert visited < 0.45 * 60 * 6000 and hits >= 0.9 * 60 * 21


@pytest.mark.parametrize("rows", [500, 1000, 3000, 4095, 5000, 8000])
@pytest.mark.parametrize("sigma", [0.0, 0.5, 0.8, 1.5])
def test_recall_of_blocks_at_any_size_and_spread(rows, sigma):
    random = np.random.default_rng(rows)
    x = random.standard_normal((rows, 64))
    x *= (np.exp(sigma * random.standard_normal(rows)) / np.linalg.norm(x, axis=1))[:, None]
    grown, hits, visited = nearest.forests(x, nearest.TREES), 0, 0
    found = zip(*[f.candidates(x[:60], w * (nearest.ENOUGH * len(f.rows) + nearest.FLOOR * 20 / len(grown))) for f, w in grown])
    for i, parts in enumerate(found):
        near = np.concatenate(parts)
        visited += len(near)
        score = x @ x[i]
        score[i] = -np.inf
        hits += np.isin(np.argsort(-score)[:20], near).sum()
    assert hits >= 0.9 * 60 * 20 and visited < (0.75 if rows < 2000 else 0.5) * 60 * rows


def test_nearest_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0])]
    got = nearest.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == sorted([(0, 1, 1, 2.0), (0, 2, 1, 2.0), (0, 3, 0, 0.0), (0, 1, 1, 1.0), (0, 2, 1, 1.0), (0, 3, 0, 0.0)])


def test_nearest_awkward(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 0.0]), (20, [1.0, 2.0]), (40, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in nearest.nearest(vectors, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1): (1, 1.0), (0, 2): (7, 1.0), (0, 3): (20, 1.0), (0, 4): (2, 0.5), (20, 1): (2, 1.5), (20, 2): (0, 1.0), (20, 3): (1, 1.0), (20, 4): (7, 1.0)}
    assert nearest.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def spread(slots, counts, size):
    """Every bin's (offset, length) from slots, checked for gaps and overflow; the pieces used by length."""
    bins, used = {}, {}
    for length, first, last, base, per_bin, offset in slots:
        assert first == used.get(length, 0)
        used[length] = last
        for n in range(last - first):
            bins.setdefault(base + n // per_bin, []).append((offset + n % per_bin * length, length))
    assert used == counts
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= size
    return bins


def test_packing_plans():
    random = np.random.default_rng(4)
    for size, n in ((64, 500), (100, 3000), (4096, 4000)):
        lengths = random.integers(1, size + 1, n)
        counts = {int(k): int(v) for k, v in zip(*np.unique(lengths, return_counts=True))}
        total = -(-int(lengths.sum()) // size)
        for plan, slack in ((packing.minimum_bin_slack, 1.03), (packing.best_fit_decreasing, 1.06)):
            slots, number = plan(counts, size)
            bins = spread(slots, counts, size)
            assert set(bins) == set(range(number)) and number <= total * slack + 1
        plain = []  # best fit decreasing, piece by piece
        for length in sorted(lengths.tolist(), reverse=True):
            fits = [i for i, room in enumerate(plain) if room >= length]
            if fits:
                plain[min(fits, key=lambda i: plain[i])] -= length
            else:
                plain.append(size - length)
        assert len(plain) == packing.best_fit_decreasing(counts, size)[1]
    assert packing.minimum_bin_slack({}, 10) == ([], 0)


def test_each_bin_is_the_fullest(monkeypatch):
    """Every round's combination fills its bin as well as any combination of the pieces left does."""
    from itertools import combinations_with_replacement

    random = np.random.default_rng(11)
    for _ in range(40):
        size = int(random.integers(12, 40))
        counts = {int(k): int(v) for k, v in zip(*np.unique(random.integers(1, size + 1, 12), return_counts=True))}
        slots, bins = packing.minimum_bin_slack(counts, size)
        content = spread(slots, counts, size)
        left = dict(counts)
        for b in range(bins):
            own = [n for _, n in content[b]]
            longest = max(n for n, c in left.items() if c)
            assert longest in own
            left[longest] -= 1
            usable, best = [n for n, c in left.items() if c], 0
            for many in range(1, size - longest + 1):
                for pick in combinations_with_replacement(usable, many):
                    if sum(pick) <= size - longest and all(pick.count(n) <= left[n] for n in set(pick)):
                        best = max(best, sum(pick))
                if many >= 5:
                    break
            assert sum(own) - longest >= best
            own.remove(longest)
            for n in own:
                left[n] -= 1


def test_written_matrices_read_back(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    packed = binary_output.packed_matrices(docs, size=256)
    binary_output.write_packed(packed, str(tmp_path / "packed"))
    back = {r["sequence_id"]: r for f in sorted((tmp_path / "packed").glob("*.parquet")) for r in pq.read_table(f).to_pylist()}
    assert len(back) == packed.count() and set(back) == set(range(len(back)))
    assert sum(r["cu_seqlens"][-1] for r in back.values()) == best_fit.token_pieces(docs, 256).agg(F.sum("length")).first()[0]
    for r in back.values():
        assert len(r["ids"]) == len(r["positions"]) == 512 and r["cu_seqlens"][0] == 0 and len(r["doc_ids"]) == len(r["pieces"]) == len(r["cu_seqlens"]) - 1


def test_best_fit_packs_every_id(docs, rows, awkward, nothing):
    tokenizer = word_tokens.WordTokenizer()
    got = best_fit.pack_documents(docs, size=512).collect()
    by_doc, bins = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in rows:
        ids = tokenizer.whole(text or "") + (1).to_bytes(4, "little")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces] == [(k, 512 * k, min(512, len(ids) // 4 - 512 * k), zlib.crc32(ids[2048 * k : 2048 * (k + 1)])) for k in range(-(-len(ids) // 2048))]
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 512
    assert len(bins) <= -(-sum(r.length for r in got) // 512) * 1.02 + 1
    odd = best_fit.pack_documents(awkward).collect()
    assert sum(r.length for r in odd if r.doc_id in (1, 2, 5)) == 3 and sum(r.doc_id == 4 for r in odd) == 2
    assert best_fit.pack_documents(nothing).count() == 0


def test_word_tokenizer_is_the_library(rows):
    tokenizer = word_tokens.WordTokenizer(table_words=64)
    for text in [*(r[1] for r in rows[:60]), "It's  I'LL we've'd", "x²½ ſtraße İstanbul", "á b", "<|endoftext|> x", "日本", "\x1c a\x85b", "ΑΣ ΣΑ", "１２ ab12cd  ﬁ", "don't—stop… «ça»", " x­ y"]:
        assert tokenizer.ids(text or "") == tokenizer.whole(text or "")


def test_texts_are_encoded_together(monkeypatch):
    # the table is too small for the words, so text by text each would be made again in every text
    import pyarrow as pa

    words = [f"{a}{b}" for a in "stuvwxyzäß" for b in "abcdefghij"]
    texts = ["", *[" ".join(words[i:] + words[:i]) for i in range(0, 100, 10)], "日本 go", "<|endoftext|>", " \t", *[" ".join(words[::-1]) + ", it's 12.5\n"] * 3]
    library, made = word_tokens.WordTokenizer(), []

    class Counted(word_tokens.WordTokenizer):
        def __init__(self, file=None):
            super().__init__(file, table_words=8)

        def _run(self, run):
            made.append(run)
            return super()._run(run)

    monkeypatch.setattr(best_fit, "WordTokenizer", Counted)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts))), "text": texts})
    got = pa.Table.from_batches(best_fit._pieces(64, 1, None, True, True)([batch])).to_pylist()
    for i, text in enumerate(texts):
        ids = np.append(np.frombuffer(library.whole(text), "<u4"), 1).astype("<u4")
        own = [r for r in got if r["doc_id"] == i]
        assert b"".join(r["ids"] for r in own) == ids.astype("<u2").tobytes()
        assert [(r["start"], r["length"], r["ids_crc32"]) for r in own] == [(k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes())) for k in range(0, len(ids), 64)]
    assert len(made) <= 120


def test_matrices_round_trip(docs, rows, awkward, nothing):
    tokenizer = word_tokens.WordTokenizer()
    got = binary_output.packed_matrices(docs, size=256).collect()
    pieces = {}
    for r in got:
        ids, place = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(place) == 256
        for k, (a, b) in enumerate(zip(r.cu_seqlens, r.cu_seqlens[1:])):
            assert (place[a:b] == np.arange(b - a)).all()
            pieces[r.doc_ids[k], r.pieces[k]] = ids[a:b]
        assert (ids[r.cu_seqlens[-1] :] == 49407).all()
    for i, text in rows:
        want = np.append(np.frombuffer(tokenizer.whole(text or ""), "<u4"), 49407)
        own = np.concatenate([pieces[i, k] for k in range(-(-len(want) // 256))])
        assert (own == want).all()
    assert sum(len(r.doc_ids) for r in binary_output.packed_matrices(awkward).collect()) >= len(AWKWARD)
    assert binary_output.packed_matrices(nothing).count() == 0


def test_chat_keeps_maximal(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 5, "user", "x"), (4, 7, None, None), (5, 0, "user", "x"), (6, None, "user", "q"), (None, 0, "user", "a"), (7, 0, "user", "a"), (7, 0, "user", "a")]
    turns = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, place string")
    got = {r.conv_id: (r.n_turns, r.text) for r in chat.render(turns, "<", ">").collect()}
    assert got == {1: (2, "<user\na>\n<assistant\nb>\n"), 4: (2, "<user\nx>\n<unknown\n>\n"), 6: (1, "<user\nq>\n"), 7: (2, "<user\na>\n<user\na>\n")}
    assert chat.render(turns.limit(0)).count() == 0


def test_chat_puts_null_turns_first(spark):
    rows = [(1, None, "user", "none"), (1, -5000, "user", "low"), (1, 3, "user", "last"), (2, None, "user", "none"), (2, -5000, "user", "low"), (3, 0, "\x00", "x"), (4, 0, None, "x"), (4, 1, "user", "y")]
    got = {r.conv_id: r.text for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "<", ">").collect()}
    assert got == {1: "<user\nnone>\n<user\nlow>\n<user\nlast>\n", 3: "<\x00\nx>\n", 4: "<unknown\nx>\n<user\ny>\n"}


def test_chat_sums_stretches(spark, monkeypatch):
    rows = [(c, t, "user", str(t)) for c, n in ((1, 10), (2, 7), (3, 12)) for t in range(n)]
    monkeypatch.setattr(chat, "STRETCH", 3)
    assert [r.conv_id for r in chat.render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()] == [3]


def test_language_accuracy(spark, awkward, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0))
    held = got[got.held_out & (got.lang_pred != "und")]
    assert (held.lang_pred == held.lang).mean() > 0.97 and got.score.between(0, 1).all()
    odd = language_id.identify(awkward).collect()
    assert {r.lang_pred for r in odd if r.doc_id in (1, 2, 5)} == {"und"} and {r.lang_pred for r in odd} <= {"en", "fr", "und"}
    assert language_id.identify(nothing).count() == 0


def test_every_language_is_learned(spark):
    random = np.random.default_rng(6)
    names = [f"l{i:02}" for i in range(70)]
    rows = []
    for n in names:
        words = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(4)]
        rows += [(n, " ".join(words))] * 8
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert {r.lang_pred for r in language_id.identify(docs).collect()} == set(names)


def test_language_stage_without_labels(spark):
    rows = [(1, "some text", None), (2, None, None), (3, "12 34", None), (4, "mehr Text", None)]
    got = language_id.keep_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.doc_id for r in got.collect()} == {1, 4}


def test_exact_copies_by_id_and_text(spark):
    rows = [(5, "x"), (9, "X"), (5, "y"), (None, "x"), (None, "only null"), (None, "ONLY null"), (None, "own"), (7, "z"), (7, "Z")]
    got = corpus_pipeline.drop_exact_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted((r.doc_id or 0, r.text.lower()) for r in got) == [(0, "only null"), (0, "own"), (5, "y"), (7, "z"), (9, "x")]


def test_stages_with_clashing_and_missing_columns(spark):
    rows = [(1, "some words here", "n", "i", "t", "d", "g"), (2, "SOME words here", "n", "i", "t", "d", "g"), (2, "some WORDS here", "n", "i", "t", "d", "g"), (3, "12", "n", "i", "t", "d", "g"), (4, "mail a.b@c.de", "n", "i", "t", "d", "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _norm string, _id string, _text string, _Digest string, digest string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, SF)
        assert df.columns == ["doc_id", "text", "_norm", "_id", "_text", "_Digest", "digest"]
    got = df.collect()
    assert sorted((r.doc_id, r.text.lower()) for r in got) == [(2, "some words here"), (4, "mail <email>")] and {tuple(r[2:]) for r in got} == {("n", "i", "t", "d", "g")}


def test_pipeline_stages(spark, docs, awkward, nothing):
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = spark.createDataFrame(stage(spark, kept, SF).collect(), docs.schema)
        assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert all(re.search(r"[^\W\d_]", t) for t in texts) and len(set(map(str.lower, texts))) == len(texts)
    assert not any(slow_spans(t) for t in texts)
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.collect()}
    for table in (awkward, nothing):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            table = stage(spark, table, SF)
        ids = [r.doc_id for r in table.collect()]
        assert len(ids) == len(set(ids))


def test_near_copies_of_the_pipeline(spark):
    words = [f"b{i}" for i in range(1000)]
    edited = [f"e{i}" if i % 40 == 20 else w for i, w in enumerate(words)]  # 0.777 on five words
    longer = words + [f"c{i}" for i in range(200)]  # 0.833
    stage = lambda rows: sorted((r.doc_id or 0) for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string"), SF).collect())
    other = [f"d{i}" for i in range(300)]
    assert stage([(1, words), (2, longer), (8, other)]) == [1, 8]
    assert stage([(1, words), (2, edited), (8, other)]) == [1, 2, 8]
    assert stage([(4, longer), (2, words), (None, words), (9, []), (10, [])]) == [0, 2, 9, 10]


def slow_machine_votes(model, v):
    """Hierarchy.predict in steps of its own: the family with the largest margin, then a vote of each pair within it."""
    margins = {g: float(np.dot(v, w) + b) for g, (w, b) in zip(model.families, model.top)}
    best = max(margins.values())
    name = next(g for g in model.families if margins[g] == best)
    wins, sums = {}, {}
    for (a, c), (w, b) in model.pairs.items():
        if a in model.members[name]:
            m = float(np.dot(v, w) + b)
            for lang, own in ((a, m), (c, -m)):
                wins[lang] = wins.get(lang, 0) + (own > 0 or (own == 0 and lang == a))
                sums[lang] = sums.get(lang, 0.0) + own
    langs = model.members[name]
    return max(langs, key=lambda g: (wins.get(g, 0), sums.get(g, 0.0), g))


def test_family_comes_first_then_votes():
    random = np.random.default_rng(12)
    langs = ["en", "de", "nl", "sv", "fr", "es", "it", "fi", "xx"]
    alphabets = {g: "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 9)) for g in langs}
    write = lambda g, n: " ".join("".join(random.choice(list(alphabets[g]), 5)) for _ in range(n))
    labels = [g for g in langs for _ in range(30)]
    model = language_id.Hierarchy().fit(np.stack([language_id.features(write(g, 25)) for g in labels]), labels)
    assert set(model.families) == {"germanic", "romance", "uralic", "xx"} and model.members["germanic"] == ["de", "en", "nl", "sv"]
    assert set(model.pairs) == {(a, c) for m in model.members.values() for a in m for c in m if a < c}
    hits = 0
    for g in langs:
        for n in (1, 3, 25):
            v = language_id.features(write(g, n))
            lang, score = model.predict(v)
            assert lang == slow_machine_votes(model, v) and 0 <= score <= 1
            hits += n == 25 and lang == g
    assert hits >= 8


def test_language_stage_writes_what_it_found(spark):
    texts = {"en": "the house and the tree are in the garden with the dog", "fr": "la maison et les arbres sont dans le jardin avec le chien"}
    rows = [(i, texts[g], g, "x") for i, g in enumerate(["en", "fr"] * 30)] + [(100, texts["en"], None, "x"), (101, texts["fr"], "en", "x"), (102, "12 + 3", "en", "x"), (103, None, "en", "x")]
    got = {r.doc_id: r for r in language_id.keep_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()}
    assert got[100].lang == "en" and got[101].lang == "fr" and got[100].score == "x" and not {102, 103} & set(got)


def slow_split(x, g, h, edges, shrink):
    """The best (gain, feature, cut) of a node, trying every edge of every feature."""
    best = (1e-6, None, None)
    value = lambda m: g[m].sum() ** 2 / (h[m].sum() + shrink)
    for f in range(x.shape[1]):
        for edge in edges[f]:
            left = x[:, f] <= edge
            if h[left].sum() >= 1 and h[~left].sum() >= 1:
                gain = value(left) + value(~left) - value(np.ones(len(x), bool))
                if gain > best[0] + 1e-9:
                    best = (gain, f, edge)
    return best


def test_trees_against_slow_splits_and_walks():
    random = np.random.default_rng(13)
    x = np.round(random.standard_normal((300, 4)), 1)
    y = ((x[:, 1] > 0.3) ^ (x[:, 2] < -0.5)).astype(float)
    trees = quality.Trees().fit(x, y, trees=3, depth=2, bins=8, rate=0.3, shrink=5.0)
    score = np.full(len(x), trees.start)
    for t in range(3):
        prob = 1 / (1 + np.exp(-score))
        g, h = prob - y, prob * (1 - prob)
        members = {0: np.ones(len(x), bool)}
        for node in range(3):
            own = members[node]
            gain, feature, cut = slow_split(x[own], g[own], h[own], trees.edges, 5.0) if own.any() else (0, None, None)
            if feature is None:
                assert np.isinf(trees.cut[t, node])
            else:
                assert (trees.feature[t, node], trees.cut[t, node]) == (feature, cut)
            right = x[:, trees.feature[t, node]] > trees.cut[t, node]
            members[2 * node + 1], members[2 * node + 2] = own & ~right, own & right
        for leaf in range(3, 7):
            own = members[leaf]
            assert np.isclose(trees.value[t, leaf], -0.3 * g[own].sum() / (h[own].sum() + 5.0))
            score[own] += trees.value[t, leaf]
    assert np.allclose(trees.predict(x), 1 / (1 + np.exp(-score)))
    for row, got in zip(x, trees.predict(x)):  # node by node
        total = trees.start
        for feature, cut, value in zip(trees.feature, trees.cut, trees.value):
            node = 0
            while 2 * node + 2 < len(value):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += value[node]
        assert np.isclose(got, 1 / (1 + np.exp(-total)))


ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
import corpus_pipeline
from reachmill.llm import queries
for name, query in [*queries.queries().items(), ("pipeline", corpus_pipeline.run)]:
    print("ROWS", name, query(spark, {sf!r}).count())
"""


def test_workers_need_no_repository(tmp_path):
    """All queries run where the driver alone can import this package."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = ELSEWHERE.format(repo=repo, folder=str(tmp_path / "shared"), sf=SF)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    rows = [line.split()[1:] for line in out.stdout.splitlines() if line.startswith("ROWS ")]
    assert len(rows) == 14 and all(int(n) > 0 for _, n in rows), out.stderr[-3000:]


def test_queries_have_their_names():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()} == set(range(1, 14))
