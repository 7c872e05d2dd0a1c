"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation walks the model's compiled character map (a double-array trie
over UTF-8 with replacement strings) taking the longest prefix that it holds
at each place, and records for every normalised character the source byte it
came from.  What is cut into pieces is the normalised text, by the model without
its own normaliser; the pieces are then projected through the record to byte
spans of the original text.  A model without a map keeps its characters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.llm.common import small_batches, tidy

MARK = "▁"


class CharacterMap:
    """The longest-prefix map compiled into a SentencePiece model."""

    def __init__(self, blob: bytes):
        import numpy as np

        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int):
        """(bytes read, replacement) of the longest key that starts at ``at``, or None."""
        if not self.units:
            return None
        node, best = 0, None
        unit = self.units[0]
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.strings[best[1] : self.strings.index(b"\0", best[1])]


class Codec:
    """encode(text) and decode(ids) of one model file."""

    def __init__(self, model_file):
        import numpy as np
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(self.library.serialized_model_proto())
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with the space mark at the end of words are not supported")
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        #: symbols that normalisation leaves as they are
        self.symbols = sorted((p.piece.encode() for p in proto.pieces if p.type == 4), key=len, reverse=True)
        self.plain = not self.map.units and not self.squeeze and self.prefix and self.escape and not self.symbols
        #: bytes that a piece takes up in the normalised text; a byte piece takes one, an unknown piece's are not known
        self.widths = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = {i for i, p in enumerate(proto.pieces) if p.type == 2}
        spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = b"", False, False, False
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.decimals = [str(i) for i in range(len(proto.pieces))]

    def normalise(self, text):
        """(normalised text, source byte of each of its characters and of its end)."""
        import numpy as np

        if self.plain:
            points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
            width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
            ends = np.concatenate([[0], np.cumsum(width)])
            if not text:
                return "", ends
            return MARK + text.replace(" ", MARK), np.concatenate([[0], ends])
        data, out, source, at = text.encode("utf-8", "replace"), [], [], 0
        end = len(data)
        pairs = []
        while at < end:
            symbol = next((k for k in self.symbols if data.startswith(k, at)), None)
            found = (len(symbol), symbol) if symbol else self.map.longest(data, at)
            if found is None:
                width = 1 + (data[at] >= 0xC0) + (data[at] >= 0xE0) + (data[at] >= 0xF0)
                found = width, data[at : at + width]
            pairs += [(c, at) for c in found[1].decode("utf-8", "replace")]
            at += found[0]
        if self.squeeze:
            while pairs and pairs[0][0] == " ":
                pairs.pop(0)
            while pairs and pairs[-1][0] == " ":
                end = pairs.pop()[1]
        if self.prefix and pairs:
            out, source = [MARK if self.escape else " "], [pairs[0][1]]
        before = " " if self.squeeze and self.prefix else ""
        for c, at in pairs:
            if self.squeeze and c == " " and before == " ":
                continue
            before = c
            out.append(MARK if c == " " and self.escape else c)
            source.append(at)
        return "".join(out), np.array([*source, end], np.int64)

    def encode(self, text):
        """(rows, decimals): rows of id, begin and end, byte spans of the original text, end exclusive; the ids' decimals joined by commas.

        The pieces that make up one character by its bytes share its span.
        """
        import numpy as np

        normal, source = self.normalise(text) if text else ("", None)
        if not normal:
            return np.empty((0, 3), np.int64), b""
        ids, decimals = self.bare.encode(normal, num_threads=1), self.decimals
        return np.column_stack([np.array(ids, np.int64), *self._project(ids, normal, source)]), ",".join([decimals[i] for i in ids]).encode()

    def _project(self, ids, normal, source):
        """Source bytes at which the pieces of a normalised text begin and end."""
        import numpy as np

        points = np.frombuffer(normal.encode("utf-32-le", "replace"), "<u4")
        wide = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        own = np.array(ids, np.intp)
        step = self.widths[own]
        if not self.unknown.isdisjoint(ids):
            step = self._with_unknown(own, step, wide)
        ends = np.cumsum(step)
        owner = np.repeat(np.arange(len(points), dtype=np.int32), wide)  # the character of each normalised byte
        return source[owner[ends - step]], source[owner[ends - 1] + 1]

    def _with_unknown(self, own, step, wide):
        """Bytes of each piece where some are unknown: an unknown piece takes up the one character it stands for."""
        step, starts, at = step.copy(), {}, 0
        for c, w in enumerate(wide.tolist()):
            starts[at] = w
            at += w
        at = 0
        for i, piece in enumerate(own.tolist()):
            if piece in self.unknown:
                step[i] = starts[at]
            at += int(step[i])
        return step

    def decode(self, ids):
        return self.library.decode(ids)


def _model_file(model_file):
    if model_file:
        return model_file
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encoder(model_file, digests):
    def run(batches):
        import hashlib

        import pyarrow as pa

        codec = Codec(_model_file(model_file))
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            out = [[] for _ in range(4)]
            for text in batch.column(1):
                rows, decimals = codec.encode(text.as_py() or "")
                decoded = codec.decode(rows[:, 0].tolist())
                if digests:
                    row = len(rows), sha(decimals), sha(decoded.encode("utf-8")), sha(rows[:, 1:].astype("<u4").tobytes())
                else:
                    row = *rows.T, decoded
                for column, value in zip(out, row):
                    column.append(value)
            if digests:
                columns, names = [pa.array(out[0], pa.int64()), *map(pa.array, out[1:])], ["n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"]
                columns[1:] = [c.cast(pa.string()) for c in columns[1:]]
            else:
                columns, names = [*(pa.array(c, pa.list_(pa.int32())) for c in out[:3]), pa.array(out[3], pa.string())], ["ids", "begins", "ends", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return run


def _rows(docs, id_col, text_col):
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, begins, ends, decoded of every row of docs; see Codec.encode.

    Null and empty texts give no ids and an empty decoded text.  Rows and ids
    repeat as in docs, null ids stay null, other columns are not read; an empty
    table gives an empty table.
    """
    return _rows(docs, id_col, text_col).mapInArrow(tidy(_encoder(model_file, False)), "doc_id long, ids array<int>, begins array<int>, ends array<int>, decoded string")


def encode_digests(docs: DataFrame, model_file: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and the digests ids_sha256, decoded_sha256 and spans_sha256 of what encode gives, made where it is made.

    spans_sha256 is of the spans' begins and ends in turn, as little-endian unsigned 32-bit numbers.
    """
    return _rows(docs, id_col, text_col).mapInArrow(tidy(_encoder(model_file, True)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
