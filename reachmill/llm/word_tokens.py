"""Token ids of whole texts by a word-level byte-pair tokenizer file, through a bounded table of words.

The tokenizer's rules never look across white space, so the ids of a text are
those of its blank-separated chunks in sequence, and those of a chunk are those
of its letter, digit and symbol runs, each on its own.  Texts are taken
together: every different chunk of them is put together once, from a table of
runs, and its ids are copied to wherever it stands.  The table has two
generations: a full young one becomes the old one, from which what is still in
use is taken over.  A run that is in neither goes through the file's byte-pair
model.  Texts with characters for which this shortcut is not proven (outside
ASCII and Latin letters, or with special tokens) go to the library as a whole.
"""

from __future__ import annotations

import string

#: Runs in one generation of the table, and characters of the longest run that it takes.
TABLE_WORDS, LONGEST = 150_000, 64


class WordTokenizer:
    """ids(text) gives little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, file=None, table_words=TABLE_WORDS):
        import os
        import re

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if file is None:
            import public_tokenizers

            file = public_tokenizers.path("word_bpe_49k.json")
        self.library = Tokenizer.from_file(file)
        self.runs = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.plain = bytes([9, 10, 13, *range(32, 127)])
        self.odd = re.compile(r"[^¡-įı-ſ]").search
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.alphabet = {b: 256 + i for i, b in enumerate(others)}
        self.packed = [i.to_bytes(4, "little") for i in range(max(self.library.get_vocab().values()) + 1)]
        self.young: dict = {}
        self.old: dict = {}
        self.table_words = table_words

    def unproven(self, text):
        """Whether the library has to take the text as a whole."""
        rest = text.encode().translate(None, self.plain)  # whole characters go, so what stays is UTF-8
        return "<|" in text or bool(rest) and self.odd(rest.decode()) is not None

    def _run(self, run):
        spelled = run if run.isascii() else run.encode().decode("latin-1").translate(self.alphabet)
        packed = self.packed
        return b"".join([packed[t.id] for t in self.library.model.tokenize(spelled)])

    def _found(self, run):
        """The ids of a run that isn't in the young generation."""
        got = self.old.get(run)
        if got is None:
            got = self._run(run)
        if len(run) <= LONGEST:
            if len(self.young) >= self.table_words:
                self.young, self.old = {}, self.young
            self.young[run] = got
        return got

    def _chunk(self, chunk):
        """The ids of a chunk that isn't a run of the young generation."""
        if chunk.isalpha():
            return self._found(chunk)
        word = chunk.rstrip(string.punctuation)
        runs = (word, chunk[len(word) :]) if word.isalpha() else self.runs(chunk)
        return b"".join([self.young.get(r) or self._found(r) for r in runs])

    def whole(self, text):
        """The library's own answer."""
        import numpy as np

        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text):
        return self.closed([text], 0)[0][:-1].tobytes()

    def closed(self, texts, end_id):
        """(ids, counts): one array of the ids of all texts, end_id after each, and every text's number of ids with its end.

        Every different chunk of the texts is looked up once.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        whole = [i for i, t in enumerate(texts) if self.unproven(t)]
        lower = [t.lower() for t in texts]
        for i in whole:
            lower[i] = ""
        split = pc.ascii_split_whitespace(pa.array(lower, pa.string()))
        ends = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        packed = [self.young.get(c) or self._chunk(c) for c in coded.dictionary.to_numpy(zero_copy_only=False)]
        known = len(packed)
        packed += [end_id.to_bytes(4, "little"), *[self.whole(texts[i]) for i in whole]]
        # after the chunks of a text comes what the library made of it as a whole, and then the end
        closing = np.insert(np.full(len(texts), known), whole, np.arange(known + 1, len(packed)))
        at = np.insert(ends[1:], whole, ends[1:][whole])
        codes = np.insert(coded.indices.to_numpy().astype(np.int64), at, closing)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        begins = np.cumsum(sizes) - sizes
        per = sizes[codes]
        upto = np.cumsum(per)
        ids = np.frombuffer(b"".join(packed), "<u4")[np.repeat(begins[codes] - (upto - per), per) + np.arange(per.sum())]
        return ids, np.diff(upto[codes == known], prepend=0)
