"""Token ids of whole texts by a public tokenizer, each distinct chunk encoded once.

The word-level vocabulary used here drops white space and cuts its input at the edges of
letters, digits and other signs before it merges anything. So a text's ids are those of
its chunks in turn, where a chunk ends at ASCII white space and between ASCII characters
of different kinds (not after an apostrophe, which may open a contraction, and not beside
other characters, which may compose). ASCII capitals are folded as the tokenizer does it
itself, but for those before a non-ASCII character. Texts with the strings of special
tokens are cut at white space only. Chunks are dictionary-encoded for a slice of rows,
only unseen ones go through the tokenizer, and ids are gathered by index. The cache of
chunks lives in the Python worker, is bounded, and changes speed only. A text longer than
a slice is encoded in parts cut at white space, so only a chunk without any needs memory
in proportion to its own length.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from quarrystone.llm._base import text_bytes, text_slices

CACHE_CHUNKS = 200_000
#: Larger slices than elsewhere, as a slice encodes each of its chunks once.
SLICE_BYTES = 2 << 20
#: New chunks that go through the tokenizer at once; what it returns for each takes a kilobyte or so.
ENCODE_CHUNKS = 4_000
#: Chunks longer than this are encoded but not kept.
CACHE_BYTES = 64

#: 0 white space, 1 letter, 2 digit, 3 other ASCII, 4 beyond ASCII
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[0x80:] = 4
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")


def chunk_starts(data: np.ndarray, offsets: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks start, and which bytes belong to one; ``plain`` cuts at white space only."""
    kind = _KIND[data]
    inside = kind > 0
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    cut = cut[:-1]
    before, now = kind[:-1], kind[1:]
    cut[1:] |= before == 0
    if not plain:
        cut[1:] |= (before < 4) & (now < 4) & ((before != now) | (now == 2)) & ~((data[:-1] == 0x27) & (now == 1))
    return np.flatnonzero(cut & inside), inside


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """Encodes columns of texts; for tokenizers that drop white space between tokens."""

    loaded: dict[str | None, ChunkTokenizer] = {}

    def __init__(self, path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer, self.seen, self.older = Tokenizer.from_file(path or default_path()), {}, {}
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]

    @classmethod
    def of(cls, path: str | None) -> ChunkTokenizer:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and each row's offsets; null counts as empty."""
        data, offsets = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        raw = data.tobytes()
        plain = any(x.encode() in raw for x in self.special)
        starts, inside = chunk_starts(data, offsets, plain)
        if not plain:
            alone = np.ones(len(data), bool)
            alone[:-1] = data[1:] < 0x80
            data = np.where(alone, _FOLD[data], data)
        # bytes of white space are left out, so each chunk ends where the next one starts
        at = np.concatenate([[0], np.cumsum(inside)])
        places = np.append(at[starts], at[-1])
        chunks = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(data[inside]))
        coded = chunks.dictionary_encode()
        ids = self._ids(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), np.uint32)
        index = coded.indices.to_numpy()
        n = sizes[index]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        out = flat[np.arange(total) + np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - n), n)]
        return out, np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]

    def encode_long(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, for a slice of rows that may be one long text."""
        if len(column) != 1 or not column[0].is_valid or (raw := column[0].as_buffer()).size <= SLICE_BYTES:
            return self.encode(column)
        raw, ids, start = memoryview(raw), [], 0
        while start < len(raw):
            space = _SPACE.search(raw, start + SLICE_BYTES)
            end = space.end() if space else len(raw)
            ids.append(self.encode(pa.array([str(raw[start:end], "utf-8")]))[0])
            start = end
        ids = np.concatenate(ids)
        return ids, np.array([0, len(ids)])

    def _ids(self, chunks: list[str]) -> list[bytes]:
        """Two generations of cached chunks: what the older one still gives moves to the newer."""
        if len(self.seen) > CACHE_CHUNKS:
            self.seen, self.older = {}, self.seen
        seen, older = self.seen, self.older
        ids, new = [seen.get(c) for c in chunks], []
        for i, x in enumerate(ids):
            if x is None:
                x = older.get(chunks[i])
                if x is None:
                    new.append(i)
                else:
                    ids[i] = seen[chunks[i]] = x
        for k in range(0, len(new), ENCODE_CHUNKS):
            part = new[k : k + ENCODE_CHUNKS]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([chunks[i] for i in part], add_special_tokens=False)):
                ids[i] = np.array(e.ids, np.uint32).tobytes()
                if len(chunks[i]) <= CACHE_BYTES:
                    seen[chunks[i]] = ids[i]
        return ids


def encoder(path: str | None, text: str, make):
    """A mapInArrow function: ``make(batch, ids, offsets)`` for each slice of rows."""

    def run(batches):
        tokenizer = ChunkTokenizer.of(path)
        for batch in text_slices(batches, text, SLICE_BYTES):
            yield make(batch, *tokenizer.encode_long(batch.column(text)))

    return run
