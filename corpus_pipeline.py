"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last
return the columns of documents.  An empty table passes all stages as one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reachmill.llm import best_fit, exact_dedup, language_id, minhash, personal_data
from reachmill.llm.common import cut, ensure_checkpoint_dir, table

#: The rule for near copies: so many percent alike in shingles of so many words.
PERCENT, WIDTH = 80, 5


def _without(docs, dropped):
    """docs without the rows whose doc_id is in dropped; rows without a doc_id stay."""
    return docs.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def _private(docs, name):
    """name, or the first of name_, name__, ... that is no column of docs, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _joined(keyed, norm, texts, how):
    """keyed, whose digests are in the column ``norm``, joined with texts(doc_id, digest), where null ids are equal."""
    own, digest = _private(keyed, "_id"), _private(keyed, "_digest")
    texts = texts.select(F.col("doc_id").alias(own), F.col("digest").alias(digest)).distinct()
    return keyed.join(texts, F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(norm) == F.col(digest)), how)


def identify_language(spark, docs, sf_dir):
    """Documents whose language can be told, with that language as their lang.

    Null texts, texts without a letter (empty ones too) and texts whose score is
    under language_id.LEAST go.  Repeated rows and null ids are judged by their text.
    Without a column lang there is nothing to learn: every text with a letter stays.
    """
    return language_id.keep_identified(docs)


def drop_exact_copies(spark, docs, sf_dir):
    """One row of each group of equal texts; rows are told apart by doc_id, null or not, and text.  Other columns may have any names."""
    found = cut(exact_dedup.exact_duplicates(docs)).where("group_size > 1").select("doc_id", F.col("text_sha256").alias("digest"), "kept")
    norm = _private(docs, "_norm")
    keyed = docs.withColumn(norm, F.sha2(exact_dedup.normalise(F.col("text")).cast("binary"), 256))
    out = _joined(keyed, norm, found.where("not kept"), "left_anti")
    repeated = found.where("kept").groupBy("doc_id", "digest").count().where("count > 1")
    if repeated.limit(1).count():
        again = _joined(keyed, norm, repeated, "left_semi").dropDuplicates(["doc_id", norm])
        out = _joined(out, norm, repeated, "left_anti").unionByName(again)
    return out.select(docs.columns)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near duplicates: that with the smallest doc_id.

    Documents are linked at a similarity of 0.8 on shingles of five words.  Rows
    that share a doc_id are one document; rows without a doc_id and texts
    without words (null and empty ones too) stay.
    """
    found = minhash.near_duplicates(docs, percent=PERCENT, width=WIDTH)
    return _without(docs, cut(found.where("not kept").select("doc_id")))


def mask_personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind; n_chars is that of the new text.

    Null and empty texts and null ids pass as they are; repeated rows are masked alike.
    """
    return personal_data.mask_documents(docs)


def pack(spark, docs, sf_dir):
    """The token pieces of all documents, packed.

    Null and empty texts are the end id alone; repeated rows are packed as often as they occur, a null doc_id is carried along.
    """
    return best_fit.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: Trained models decide in two stages, so SQL can't express the rows.
ORACLE_SQL = None


def _remove(spark, path):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def run(spark, sf_dir):
    """The last stage's rows.  A stage's table goes once the next one is written; the last stage checkpoints what it reads."""
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            _remove(spark, before)
        before = f"{folder}/{name}"
    packed = STAGES[-1][1](spark, docs, sf_dir)
    _remove(spark, folder)
    return packed
