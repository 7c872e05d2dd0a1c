"""Language identification by hierarchical discrimination.

A linear classifier first names the language family; within a family, one
linear support vector machine for each pair of languages votes.  Features are
hashed letter trigrams of the whole text, square-rooted and scaled to unit
length.  The machines are fitted on a bounded sample, the same share of every
language up to ``per_language`` texts.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import ship, small_batches, tidy, unpack

# Languages by family.  A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "lb", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "semitic": ["ar", "he", "mt"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}

BITS = 12
#: Texts that are learned from: so many a language, and so many in all as long as that leaves FEWEST a language.
PER_LANGUAGE, IN_ALL, FEWEST = 400, 8000, 20
UNDETERMINED = "und"
#: A text's score under which keep_identified takes its language for unknown: what a tie of families and one of languages give together.
LEAST = 0.25


def family(lang: str) -> str:
    return next((name for name, langs in FAMILIES.items() if lang in langs), lang)


def features(text: str):
    """Unit vector of 2 ** BITS hashed trigram weights, over lower-cased letters with everything else as blanks."""
    import numpy as np

    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    b = np.where(letter, raw, np.uint8(32)).astype(np.uint32)
    b = np.concatenate([np.array([32, 32], np.uint32), b, np.array([32], np.uint32)])
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    v = np.sqrt(np.bincount(code, minlength=1 << BITS).astype(np.float32))
    return v / (np.linalg.norm(v) or 1)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def fit_machine(x, y, steps: int = 120, shrink: float = 1e-4):
    """Weights and intercept of a linear machine with squared hinge loss, y in {-1, 1}, classes weighted alike."""
    import numpy as np

    n_pos, n_neg = max(1, (y > 0).sum()), max(1, (y < 0).sum())
    share = np.where(y > 0, 0.5 / n_pos, 0.5 / n_neg).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    look_w, look_b = w.copy(), b
    step = 1 / (4 + shrink)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ look_w + look_b))
        g = -2 * share * y * slack
        new_w, new_b = look_w - step * (x.T @ g + shrink * look_w), look_b - step * g.sum()
        pull = k / (k + 3)
        look_w, look_b = new_w + pull * (new_w - w), new_b + pull * (new_b - b)
        w, b = new_w, new_b
    return w, b


class Hierarchy:
    """fit on (features, languages); predict(features) gives (language, score)."""

    def fit(self, x, langs):
        import numpy as np

        langs = np.array(langs)
        groups = np.array([family(v) for v in langs])
        self.families = sorted(set(groups))
        self.members = {g: sorted(set(langs[groups == g])) for g in self.families}
        one = self.families[: 1 if len(self.families) == 2 else None]
        self.top = [fit_machine(x, np.where(groups == g, 1, -1).astype(np.float32)) for g in one] if len(self.families) > 1 else []
        if len(self.families) == 2:
            self.top.append((-self.top[0][0], -self.top[0][1]))
        self.pairs = {}
        for g in self.families:
            for a, c in combinations(self.members[g], 2):
                own = (langs == a) | (langs == c)
                self.pairs[a, c] = fit_machine(x[own], np.where(langs[own] == a, 1, -1).astype(np.float32))
        return self

    def predict(self, v):
        import math

        squash = lambda m: 1 / (1 + math.exp(-max(-30.0, min(30.0, 4 * float(m)))))
        if not self.families:
            return UNDETERMINED, 0.0
        margins = [float(v @ w + b) for w, b in self.top] or [10.0]
        best = max(range(len(margins)), key=lambda i: (margins[i], -i))
        score, langs = squash(margins[best]), self.members[self.families[best]]
        votes = {a: [0, 0.0] for a in langs}
        for a, c in combinations(langs, 2):
            w, b = self.pairs[a, c]
            m = float(v @ w + b)
            win, lose = (a, c) if m >= 0 else (c, a)
            votes[win][0] += 1
            votes[win][1] += abs(m)
            votes[lose][1] -= abs(m)
        lang = max(langs, key=lambda a: (votes[a][0], votes[a][1], a))
        if len(langs) > 1:
            score *= squash(votes[lang][1] / (len(langs) - 1))
        return lang, score


def _features(batches):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        rows = [features(t.as_py() or "").astype(np.float16).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["lang", "f"])


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_language: int = PER_LANGUAGE) -> Hierarchy:
    """The machines, from about per_language texts of every language (fewer if there are many), chosen by a hash of the id."""
    import numpy as np

    small_batches(labelled.sparkSession)
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    per_language = min(per_language, max(FEWEST, IN_ALL // max(1, counts.count())))
    share = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1_000_000))
    wanted = rows.join(F.broadcast(counts), "lang").where(share < (F.lit(1_000_000 * per_language) / F.col("n")).cast("long") + 1)
    got = wanted.select("lang", "text").mapInArrow(_features, "lang string, f binary").toPandas()
    model = Hierarchy()
    if got.empty:
        model.families = []
        return model
    got = got.sort_values(["lang", "f"], kind="stable")
    x = np.frombuffer(b"".join(got["f"]), np.float16).reshape(len(got), 1 << BITS).astype(np.float32)
    return model.fit(x, list(got["lang"]))


def _predict(shared):
    def run(batches):
        import pyarrow as pa

        model = unpack(shared)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                text = text.as_py()
                lang, score = model.predict(features(text)) if text and has_letter(text) else (UNDETERMINED, 0.0)
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return run


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs, whole texts.

    Learned from the rows with a language and a crc32(doc_id) that 5 does not
    divide; the others are held out.  Null texts and texts without a letter are
    "und" with score 0, and so is every text if no row has a language.  Scores
    lie in 0..1.  Repeated rows get the same answer; a null id is not held out;
    other columns are not read.
    """
    model = fit(docs.where(~held_out(id_col) & F.col(id_col).isNotNull()), lang_col, text_col, id_col, per_language)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_predict(ship(docs.sparkSession, model)), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def _keep(shared, at, lang_at, least):
    def run(batches):
        import pyarrow as pa

        model = unpack(shared)
        for batch in batches:
            mask, langs = [], []
            for text in batch.column(at):
                text = text.as_py()
                lang, score = None, 0.0
                if text and has_letter(text):
                    lang, score = model.predict(features(text)) if model.families else (None, 1.0)
                mask.append(score >= least)
                langs.append(lang)
            if lang_at is not None and model.families:
                batch = batch.set_column(lang_at, batch.schema.field(lang_at), pa.array(langs, pa.string()).cast(batch.schema.field(lang_at).type))
            yield batch.filter(pa.array(mask, pa.bool_()))

    return run


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE, least: float = LEAST) -> DataFrame:
    """The rows of docs, all columns, whose language can be told, with that language in lang_col.

    Rejected are null texts, texts without a letter and texts whose score is
    under ``least``.  If no row teaches a language, or there is no lang_col, every
    text with a letter stays as it is.  Repeated rows are judged alike.
    """
    lang_at = docs.columns.index(lang_col) if lang_col in docs.columns else None
    taught = docs if lang_at is not None else docs.withColumn(lang_col, F.lit(None).cast("string"))
    model = fit(taught.where(~held_out(id_col) & F.col(id_col).isNotNull()), lang_col, text_col, id_col, per_language)
    small_batches(docs.sparkSession)
    return docs.mapInArrow(tidy(_keep(ship(docs.sparkSession, model), docs.columns.index(text_col), lang_at, least)), docs.schema)
