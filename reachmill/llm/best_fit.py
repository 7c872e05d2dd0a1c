"""Whole documents packed into as few token sequences as possible, by minimum bin slack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import cut, small_batches, stretches, tidy
from reachmill.llm.packing import minimum_bin_slack, pack
from reachmill.llm.word_tokens import WordTokenizer


def _pieces(size, end_id, tokenizer_file, with_ids, with_crc):
    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        tokenizer = WordTokenizer(tokenizer_file)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for first, last in stretches(texts):
                ids, n = tokenizer.closed(texts[first:last], end_id)
                pieces = -(-n // size)
                doc = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * size
                length = np.minimum(size, n[doc] - start)
                out = [batch.column(0).slice(first).take(pa.array(doc)), *map(pa.array, (piece, start, length))]
                if with_crc:
                    ends = np.cumsum(length)
                    out.append(pa.array([zlib.crc32(ids[a:b]) for a, b in zip((ends - length).tolist(), ends.tolist())], pa.int64()))
                if with_ids:
                    offsets = np.concatenate([[0], np.cumsum(2 * length)]).astype(np.int32)
                    out.append(pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u2"))]))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "piece", "start", "length"] + ["ids_crc32"] * with_crc + ["ids"] * with_ids)

    return run


def token_pieces(docs: DataFrame, size: int = 4096, end_id: int = 1, tokenizer_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, with_crc: bool = True) -> DataFrame:
    """doc_id, piece, start, length (and ids_crc32, of little-endian unsigned 32-bit ids; and ids, little-endian unsigned 16-bit): every document's ids and end_id, cut after every ``size`` ids."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, piece long, start long, length long" + ", ids_crc32 long" * with_crc + ", ids binary" * with_ids
    return rows.mapInArrow(tidy(_pieces(size, end_id, tokenizer_file, with_ids, with_crc)), schema)


def pack_documents(docs: DataFrame, size: int = 4096, end_id: int = 1, tokenizer_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence_id and offset.

    Null and empty texts are packed as the end id alone.  Repeated rows are
    packed as often as they occur; a null doc_id is carried along.  Other
    columns are not read; an empty table gives an empty table.
    """
    pieces = cut(token_pieces(docs, size, end_id, tokenizer_file, id_col, text_col))
    return pack(pieces, size, minimum_bin_slack)
