"""Token-id output: packed id matrices with segment lengths and position resets.

Documents are encoded, closed by an end id and cut after every ``size`` ids
without loss.  Pieces are packed by best fit decreasing; the bin that fits best
is found in a segment tree over capacities.  A row of the output is one
sequence: its ids (little-endian unsigned 16-bit, padded), the cumulative
lengths of its segments and positions that restart with every segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.best_fit import token_pieces
from reachmill.llm.common import store
from reachmill.llm.packing import best_fit_decreasing, pack

#: Sequences that one task puts together at a time.
SHEET = 512


def _sheet(size, pad_id):
    def run(group):
        import numpy as np
        import pyarrow as pa

        group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).combine_chunks()
        sequence, length, offset = (group.column(n).to_numpy() for n in ("sequence_id", "length", "offset"))
        names, row, segments = np.unique(sequence, return_inverse=True, return_counts=True)
        ids, places = np.full(len(names) * size, pad_id, "<u2"), np.zeros(len(names) * size, "<u2")
        count = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        at = np.repeat(row * size + offset, length) + count
        ids[at] = np.frombuffer(b"".join(group.column("ids").to_pylist()), "<u2")
        places[at] = count
        bounds = np.concatenate([[0], np.cumsum(segments)])
        ends = np.empty(len(length) + len(names), np.int32)  # every row's zero, then the ends of its segments
        ends[bounds[:-1] + np.arange(len(names))] = 0
        ends[np.arange(len(length)) + row + 1] = offset + length
        lists = lambda values, per: pa.ListArray.from_arrays(pa.array(per, pa.int32()), values)
        rows = lambda matrix: pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer((np.arange(len(names) + 1) * 2 * size).astype(np.int32)), pa.py_buffer(matrix)])
        columns = {
            "sequence_id": pa.array(names),
            "doc_ids": lists(group.column("doc_id").chunk(0), bounds),
            "pieces": lists(group.column("piece").chunk(0), bounds),
            "cu_seqlens": lists(pa.array(ends), bounds + np.arange(len(bounds))),
            "ids": rows(ids),
            "positions": rows(places),
        }
        return pa.table(columns)

    return run


def packed_matrices(docs: DataFrame, size: int = 2048, end_id: int = 49407, pad_id: int = 49407, tokenizer_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """sequence_id, doc_ids, pieces, cu_seqlens, ids, positions: one row per packed sequence.

    Null and empty texts are the end id alone; repeated rows are packed as often
    as they occur and null ids stay null in doc_ids.  Sequence lengths and ids
    must be under 65,536.  Other columns are not read.
    """
    pieces = token_pieces(docs, size, end_id, tokenizer_file, id_col, text_col, with_ids=True, with_crc=False)
    pieces = store(pieces.select("doc_id", "piece", "length", "ids", F.monotonically_increasing_id().alias("row")))
    slots = pack(pieces.select("doc_id", "piece", "length", "row"), size, best_fit_decreasing).select("row", "sequence_id", "offset")
    placed = pieces.join(slots, "row").select("sequence_id", "offset", "length", "doc_id", "piece", "ids")
    placed = placed.withColumn("sheet", F.floor(F.col("sequence_id") / SHEET))
    schema = "sequence_id long, doc_ids array<long>, pieces array<long>, cu_seqlens array<int>, ids binary, positions binary"
    return placed.groupBy("sheet").applyInArrow(_sheet(size, pad_id), schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet files of binary rows, uncompressed, readable by row group."""
    packed.write.option("compression", "none").parquet(path)
