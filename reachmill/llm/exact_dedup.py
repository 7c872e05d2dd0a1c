"""Exact deduplication by progressive refinement, with DataFrame functions only.

Texts are compared after lower-casing A-Z.  Level one counts byte lengths;
level two hashes a prefix of the texts whose length is shared; level three
hashes the whole text, of those whose length and prefix are shared.  A level's
survivors are held in a filter of fixed size (a bitmap over a hash of the
level's key), so what is broadcast never grows with the corpus: a full bitmap
only lets more texts through to the next level, which decides exactly.  Texts
are never shuffled; digests are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: 2 ** FILTER_BITS bits in a level's filter, in rows of 32,768 bits: 4 MB.
FILTER_BITS = 25
PREFIX_CHARS = 256


def normalise(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null becomes the empty text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() changes other letters too, so it serves for ASCII texts only
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _slot(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(1 << FILTER_BITS))


def _shared(keys: DataFrame) -> DataFrame:
    """The filter (bucket, bitmap) of the slots that at least two rows of keys(slot) hold; at most 2 ** (FILTER_BITS - 15) rows."""
    twice = keys.groupBy("slot").agg(F.count("*").alias("c")).where("c > 1")
    bits = twice.select((F.col("slot") / 32768).cast("long").alias("bucket"), (F.col("slot") % 32768).alias("bit"))
    return bits.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _passes(df: DataFrame, slot: Column, shared: DataFrame, flag: str) -> DataFrame:
    """df with a boolean flag: is the slot in the filter?"""
    bucket = (slot / 32768).cast("long")
    bit = (slot % 32768).cast("int")
    df = df.withColumn("_bucket", bucket).join(F.broadcast(shared.select(F.col("bucket").alias("_bucket"), "bitmap")), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("bitmap", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return df.withColumn(flag, F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))).drop("_bucket", "bitmap")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False, prefix: int = PREFIX_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal normalised texts the largest doc_id is kept.  Null texts
    count as empty, and empty texts are equal to each other.  Of repeated rows
    with one doc_id every one counts in group_size and every one that carries
    the kept id has kept = true.  Null ids sort below all others; a group of
    null ids only has a null keep_id and kept = true.  text_sha256 is null for
    rows that an earlier level found unique, unless digest_all asks for all.
    Other columns are not read; an empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    length = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0))
    by_length = _slot(length)
    lengths = cut(_shared(rows.select(by_length.alias("slot"))))

    norm = normalise(F.col("text"))
    by_prefix = _slot(length, F.substring(norm, 1, prefix))
    level_two = _passes(rows, by_length, lengths, "l2").where("l2")
    prefixes = cut(_shared(level_two.select(by_prefix.alias("slot"))))

    level_three = _passes(_passes(rows, by_length, lengths, "l2"), F.when(F.col("l2"), by_prefix), prefixes, "l3")
    digest = F.sha2(norm.cast("binary"), 256)
    keyed = level_three.select("doc_id", "l3", (digest if digest_all else F.when(F.col("l3"), digest)).alias("text_sha256"))
    keyed = cut(keyed)

    groups = cut(keyed.where("l3").groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))
    # at most 1,000 texts hold more than a thousandth of the rows each: these are broadcast, so that no task gets a hot text
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    is_hot = F.col("group_size") * 1000 > F.lit(total)
    hot = groups.where(is_hot).select(F.col("text_sha256").alias("h"), F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    cold = groups.where(~is_hot).select(F.col("text_sha256").alias("c"), "keep_id", "group_size")
    out = keyed.withColumn("probe", F.when(F.col("l3"), F.col("text_sha256")))
    out = out.join(F.broadcast(hot), F.col("probe") == F.col("h"), "left")
    spread = F.concat(F.lit("-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("-"), F.coalesce(F.col("text_sha256"), F.lit("")))
    out = out.withColumn("probe", F.when(F.col("probe").isNotNull() & F.col("h").isNull(), F.col("probe")).otherwise(spread))
    out = out.join(cold, F.col("probe") == F.col("c"), "left")
    keep = F.coalesce(F.when(F.col("h").isNotNull(), F.col("hot_id")), F.when(F.col("c").isNotNull(), F.col("keep_id")), F.col("doc_id"))
    size = F.coalesce("hot_size", "group_size", F.lit(1)).cast("long")
    return out.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.coalesce(F.col("doc_id") == keep, F.col("doc_id").isNull() & keep.isNull()).alias("kept"), "text_sha256")
