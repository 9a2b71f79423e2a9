"""Byte-level BPE, encoded by prefix dynamic programming and decoded again.

A text is cut as the tokenizer's pattern cuts it, in one pass of numpy over its code points
(runs of letters, digits, white space and other signs, with the pattern's rules for one space,
contractions and trailing white space). Each distinct piece of a slice is encoded once: for
every byte prefix of a piece exactly one token can stand last, namely the one that ends there
and that the merges would leave beside the last token of the prefix before it. ``Prefixes``
stores that token for each prefix. An encoding is read off backwards, an append goes on where
the prefixes end, and after an edit the prefixes are computed anew only until as many of them
as the longest token has bytes agree with the old ones. No merge loop runs over a text; merges
of the tokens themselves, done once for each token, decide which two may stand side by side.

``encode``, ``decode`` and ``reencode`` work on DataFrames, without a shuffle. Vocabularies are
rank files (base64 token, rank) whose tokens are their own encodings, as trained ones are; the
file's path is a parameter, and executors read it.

Defined results: null and empty texts have no ids and decode to an empty text. Repeated rows,
empty tables and further columns of any name are no special cases. A text longer than a slice
is encoded in parts cut before white space, so memory grows with its ids (4 bytes each) and
with the longest piece only. Strings of special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quarrystone.llm._base import SLICE_BYTES, table, text_bytes, text_slices

#: Kept results, of pieces and of pairs of tokens, before a generation of them is dropped. It changes speed only.
CACHE = 400_000
#: Longer pieces are encoded but not kept.
CACHE_BYTES = 64
#: Fixed values of the pattern: its white space, and the letters of its contractions.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
ONE_LETTER, TWO_LETTERS = "stmd", ["re", "ve", "ll"]
SPACE, LETTER, DIGIT, OTHER = range(4)
#: A match of the pattern starts at white space after a character that isn't white space, whatever comes before and after.
_CUT = re.compile(rb"[\x21-\x7e](?=[ \t\n\r])")
_NEVER = 1 << 60


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def kinds() -> np.ndarray:
    """The pattern's class of each code point, as the tokenizer's own library tells letters and digits."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}")):
        matches = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(matches).decode().encode("utf-32-le"), np.uint32)] = kind
    out[WHITE_SPACE] = SPACE
    return out


def piece_starts(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """True where a match of the pattern starts; ``rows`` are the offsets of the rows in ``points``."""
    kind, n = kinds()[points], len(points)
    starts = np.zeros(n + 1, bool)
    starts[1:-1] = kind[1:] != kind[:-1]
    starts[rows] = True
    edge = starts.copy()
    edge[rows] = False  # a run's start inside a row
    after = np.flatnonzero(edge[1:-1] & (kind[:-1] == SPACE)) + 1  # a run after white space
    starts[after - 1] = True
    starts[after[points[after - 1] == 0x20]] = False
    first = np.zeros(n + 3, bool)
    first[rows] = True
    at = np.flatnonzero(starts[:-1] & (points == 0x27))
    at = at[at + 1 < n]
    at = at[~first[at + 1]]
    one = at[np.isin(points[at + 1], [ord(c) for c in ONE_LETTER])]
    two = at[at + 2 < n]
    two = two[~first[two + 2]]
    two = two[np.isin(points[two + 1].astype(np.int64) << 21 | points[two + 2], [ord(a) << 21 | ord(b) for a, b in TWO_LETTERS])]
    for found, size in ((one, 2), (two, 3)):
        starts[found + 1] = False
        starts[found + size] = True
    return starts[:-1]


def _pieces(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The matches of all rows one after another, and where each row's begin."""
    data, offsets = text_bytes(column)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # the byte at which each code point starts
    starts = lead[piece_starts(points, np.searchsorted(lead, offsets))]
    places = np.append(starts, len(data))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)])
    return pieces, np.searchsorted(starts, offsets)


def gathered(index: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``index`` of a table of byte strings or arrays, joined, and their offsets there."""
    sizes = np.diff(offsets)[index]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.arange(total) + np.repeat(offsets[index] - (ends - sizes), sizes)], np.concatenate([[0], ends])


class Vocabulary:
    """Tokens and ranks, which pairs of tokens may be neighbours, and the encodings of pieces seen."""

    loaded: dict[str | None, Vocabulary] = {}

    def __init__(self, path: str | None = None):
        import ahocorasick

        lines = Path(path or default_path()).read_bytes().split(b"\n")
        self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.tokens = {i: t for t, i in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.ending = ahocorasick.Automaton()  # by latin-1, a character for each byte
        for t, i in self.ranks.items():
            self.ending.add_word(t.decode("latin-1"), (len(t), i))
        self.ending.make_automaton()
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.beside: dict[int, bool] = {}
        self.seen: dict[bytes, np.ndarray] = {}
        self.older: dict[bytes, np.ndarray] = {}
        size = max(self.tokens) + 1
        for name, values in (("bytes_of", [self.tokens.get(i, b"") for i in range(size)]), ("decimal_of", [b"%d " % i for i in range(size)])):
            setattr(self, name, (np.frombuffer(b"".join(values), np.uint8), np.concatenate([[0], np.cumsum([len(v) for v in values])])))

    @classmethod
    def of(cls, path: str | None) -> Vocabulary:
        if path not in cls.loaded:
            cls.loaded[path] = cls(path)
        return cls.loaded[path]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; none for a single byte."""
        if token not in self.parts:
            raw = self.tokens[token]
            now = [raw[i : i + 1] for i in range(len(raw))]
            while len(now) > 2:
                merges = [self.ranks.get(a + b, _NEVER) for a, b in zip(now, now[1:])]
                i = merges.index(min(merges))
                if merges[i] == _NEVER:
                    raise ValueError(f"token {token} is not made by merges of tokens")
                now[i : i + 2] = [now[i] + now[i + 1]]
            self.parts[token] = (self.ranks[now[0]], self.ranks[now[1]]) if len(now) == 2 else None
        return self.parts[token]

    def edge(self, token: int, side: int) -> list[int]:
        """The tokens that stand at one edge (0 left, 1 right) while ``token`` is merged, first the single byte."""
        out = [token]
        while parts := self.halves(out[-1]):
            out.append(parts[side])
        return out[::-1]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the merges leave ``a`` and ``b`` side by side.

        Both grow by merges in the order of their ranks, at equal ranks the left one first. They
        don't stay apart if at some time the tokens at their common edge would merge first.
        """
        key = a << 32 | b
        known = self.beside.get(key)
        if known is None:
            left, right, i, j = self.edge(a, 1), self.edge(b, 0), 0, 0
            known = True
            while known:
                next_left = left[i + 1] if i + 1 < len(left) else _NEVER
                next_right = right[j + 1] if j + 1 < len(right) else _NEVER
                across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], _NEVER)
                if across < next_left and across <= next_right and across < _NEVER:
                    known = False
                elif next_left == next_right == _NEVER:
                    break
                elif next_left <= next_right:
                    i += 1
                else:
                    j += 1
            if len(self.beside) > CACHE:
                self.beside.clear()
            self.beside[key] = known
        return known

    def piece(self, raw: bytes) -> np.ndarray:
        """The ids of one match of the pattern."""
        ids = self.seen.get(raw)
        if ids is None:
            ids = self.older.get(raw)
            if ids is None:
                ids = np.array([self.ranks[raw]] if raw in self.ranks else Prefixes(self, raw).ids(), np.int32)
            if len(raw) <= CACHE_BYTES:
                if len(self.seen) > CACHE:
                    self.seen, self.older = {}, self.seen
                self.seen[raw] = ids
        return ids

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after another, and each row's offsets."""
        pieces, rows = _pieces(column)
        coded = pieces.dictionary_encode()
        ids = [self.piece(x) for x in coded.dictionary.to_pylist()]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        out, at = gathered(coded.indices.to_numpy(), flat, np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64))
        return out, at[rows]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows one after another, and each row's offsets."""
        out, at = gathered(ids, *self.bytes_of)
        return out, at[offsets]


class Prefixes:
    """One piece's byte prefixes, each with the only token that can stand last in its encoding."""

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b""):
        self.vocabulary, self.raw, self.last = vocabulary, b"", []
        self.append(raw)

    def append(self, more: bytes) -> None:
        """Go on at the end; what is there stays as it is."""
        start = len(self.raw)
        self.raw += more
        self.last += [-1] * len(more)
        self._fill(start)

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes from ``start`` to ``stop``; returns how many prefixes were computed."""
        old, behind = self.last[stop:], start + len(new)
        self.raw = self.raw[:start] + new + self.raw[stop:]
        self.last = self.last[:start] + [-1] * (len(self.raw) - start)
        return self._fill(start, behind, old)

    def _fill(self, start: int, behind: int = _NEVER, old: list[int] | None = None) -> int:
        """Tokens of the prefixes that end after byte ``start``; from byte ``behind`` on, ``old`` are those before an edit."""
        v, last = self.vocabulary, self.last
        beside, neighbours = v.beside, v.neighbours
        first = max(0, start - v.longest + 1)
        agree = done = 0
        for end, (size, token) in v.ending.iter(self.raw[first:].decode("latin-1")):
            end += first
            if end < start or last[end] >= 0:
                continue
            before = end - size
            if before >= 0:
                known = beside.get(last[before] << 32 | token)
                if known is None:
                    known = neighbours(last[before], token)
            if before < 0 or known:
                last[end] = token
                done += 1
                if end >= behind:
                    agree = agree + 1 if old[end - behind] == token else 0
                    if agree >= v.longest:
                        last[end + 1 :] = old[end + 1 - behind :]
                        break
        return done

    def ids(self) -> list[int]:
        out, at = [], len(self.raw)
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


def parts(raw: bytes | memoryview, size: int = SLICE_BYTES) -> Iterator[str]:
    """A text in parts of about ``size`` bytes, cut where a match of the pattern starts in any case."""
    start = 0
    while start < len(raw):
        cut = _CUT.search(raw, start + size) if len(raw) - start > size else None
        end = cut.end() if cut else len(raw)
        yield str(raw[start:end], "utf-8")
        start = end


def encoded(vocabulary: Vocabulary, batches, text: str):
    """(rows, ids, offsets) for each slice of rows; a long text is encoded in parts."""
    for whole in batches:
        for b in text_slices([whole], text):
            column = b.column(text)
            if b.num_rows == 1 and column[0].is_valid and (raw := column[0].as_buffer()).size > SLICE_BYTES:
                ids = np.concatenate([vocabulary.encode(pa.array([p]))[0] for p in parts(memoryview(raw))])
                yield b, ids, np.array([0, len(ids)])
            else:
                yield b, *vocabulary.encode(column)


def _replaced(schema: StructType, name: str, kind) -> StructType:
    return StructType([*(f for f in schema if f.name.lower() != name.lower()), StructField(name, kind)])


def _with(b: pa.RecordBatch, names: list[str], column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(b.column(n) for n in names[:-1]), column], names=names)


def _lists(ids: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """df with the ids of each text, array<int>; a column of that name is replaced."""
    schema = _replaced(df.schema, ids, ArrayType(IntegerType()))

    def run(batches):
        v = Vocabulary.of(path)
        for b, found, at in encoded(v, batches, text):
            yield _with(b, schema.names, _lists(found, at))

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", text: str = "text", path: str | None = None) -> DataFrame:
    """df with the text that each row's ids spell; bytes that are no UTF-8 become U+FFFD."""
    schema = _replaced(df.schema, text, StringType())

    def run(batches):
        v = Vocabulary.of(path)
        for b in batches:
            column = b.column(ids)
            sizes = np.array([len(x) if x is not None else 0 for x in column], np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate([[0], np.cumsum(sizes)])
            raw, places = v.decode(flat, at)
            raw = raw.tobytes()
            yield _with(b, schema.names, pa.array([raw[i:j].decode("utf-8", "replace") for i, j in zip(places[:-1], places[1:])], pa.string()))

    return df.mapInArrow(run, schema)


def reencoded(v: Vocabulary, raw: bytes, ids: np.ndarray, start: int, stop: int, new: bytes) -> tuple[bytes, np.ndarray]:
    """Text and ids after an edit of bytes; only what lies between the nearest certain starts of matches is encoded."""
    left = right = None
    back = 64
    while left is None:
        begin = max(0, start - back)
        left = next((m.end() for m in reversed(list(_CUT.finditer(raw, begin, start))) if m.end() < start), 0 if begin == 0 else None)
        back *= 4
    right = _CUT.search(raw, stop)
    right = right.end() if right else len(raw)
    after = raw[:start] + new + raw[stop:]
    ends = np.cumsum(np.diff(v.bytes_of[1])[ids])
    a, b = np.searchsorted(ends, left, "right"), np.searchsorted(ends, right, "right")
    middle = v.encode(pa.array([after[left : right + len(new) - (stop - start)].decode()]))[0]
    return after, np.concatenate([ids[:a], middle, ids[b:]]).astype(np.int32)


def reencode(df: DataFrame, start: str = "edit_start", stop: str = "edit_stop", new: str = "edit_text", text: str = "text", ids: str = "ids", path: str | None = None) -> DataFrame:
    """df with text and ids after each row's edit: the bytes from ``start`` to ``stop`` become ``new``.

    A null start leaves the row as it is; an append is an edit from the end to the end. Offsets are
    UTF-8 bytes, at the edges of characters. Text and ids come last, as columns of these names.
    """
    schema = _replaced(_replaced(df.schema, text, StringType()), ids, ArrayType(IntegerType()))

    def run(batches):
        v = Vocabulary.of(path)
        for b in batches:
            texts, all_ids = [], []
            for raw, known, i, j, x in zip(*(b.column(c).to_pylist() for c in (text, ids, start, stop, new))):
                raw, known = (raw or "").encode(), np.array(known or [], np.int32)
                if i is not None:
                    raw, known = reencoded(v, raw, known, i, i if j is None else j, (x or "").encode())
                texts.append(raw.decode())
                all_ids.append(known)
            at = np.concatenate([[0], np.cumsum([len(x) for x in all_ids])]).astype(np.int64)
            flat = np.concatenate(all_ids) if all_ids else np.zeros(0, np.int32)
            names = schema.names
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names[:-2]), pa.array(texts, pa.string()), _lists(flat, at)], names=names)

    return df.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def digests(batches):
        v = Vocabulary.of(None)
        for b, ids, at in encoded(v, batches, "text"):
            decimal, ends = gathered(ids, *v.decimal_of)
            decimal, ends = decimal.tobytes(), ends[at]
            raw, places = v.decode(ids, at)
            raw = raw.tobytes()
            columns = [
                b.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array([hashlib.sha256(decimal[i : max(i, j - 1)]).hexdigest() for i, j in zip(ends[:-1], ends[1:])], pa.string()),
                pa.array([hashlib.sha256(raw[i:j]).hexdigest() for i, j in zip(places[:-1], places[1:])], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.mapInArrow(digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
