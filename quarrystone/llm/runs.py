"""Periodic runs: stretches of a text that repeat a block of words at least twice, found by common extensions.

The words of a slice of documents become one sequence of numbers, with a separator of its own
behind each document, so that nothing extends across documents. ``CommonPrefixes`` answers how far
two places agree: only suffixes that start in a difference cover modulo 31 are sorted (6 of 31, by
doubling over blocks of 31 words), any two places reach two sorted suffixes within 30 words, which
are compared directly, and a sparse table over the sorted suffixes' common prefixes gives the rest.
For each period p the places 0, p, 2p, ... of a document are compared with those p further on,
forwards and backwards (the reversed sequence): a run of period p and length 2p or more holds such
a pair. That's n + n/2 + n/3 + ... pairs for n words. Pairs whose first words differ go at once; no
run is lost by that, as all words of a run equal those p further on. The same stretch found with
several periods keeps the smallest.

Documents are independent, so there is no shuffle. ``periodic_runs`` returns each text's runs,
``collapse`` the text without the repetitions.

Defined results: null, empty and blank texts have no words and no runs. Repeated rows are handled
each; empty tables stay empty; further columns of any name pass. A text is worked on whole in its
task, as a run may be as long as the text: some 60 bytes of memory for each byte of a text longer
than a slice (1 MB), in addition to the pairs, which are looked at PAIRS at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from quarrystone.llm._base import NOT_SPACE, table, text_bytes, text_slices, word_spans

#: A perfect difference set: every difference modulo PERIOD is that of exactly one pair.
COVER, PERIOD = [1, 5, 11, 24, 25, 27], 31
#: A run has at least this many words, and at least twice its period.
MIN_WORDS = 12
#: Pairs of places looked at together.
PAIRS = 1 << 20


def _shifts() -> np.ndarray:
    """How far to go from places a, b modulo PERIOD until both are in the cover."""
    inside = np.isin(np.arange(2 * PERIOD) % PERIOD, COVER)
    out = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            out[a, b] = np.argmax(inside[a : a + PERIOD] & inside[b : b + PERIOD])
    return out


SHIFTS = _shifts()


class CommonPrefixes:
    """How many elements of a sequence agree from two places on; no two suffixes may be equal to the end of the shorter one."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words.astype(np.int32), -2 - np.arange(2 * PERIOD, dtype=np.int32)])
        self._sort(n)

    def _sort(self, n: int) -> None:
        at = [np.arange(c, n, PERIOD) for c in COVER]
        sizes = [len(x) for x in at]
        places = np.concatenate(at)
        m = len(places)
        self.number = np.full(n + PERIOD, m, np.int32)  # which sample starts here
        self.number[places] = np.arange(m)
        last = np.cumsum(sizes)
        ends = np.repeat(last, sizes)  # a class of samples goes on until here
        windows = np.lib.stride_tricks.sliding_window_view(self.words, PERIOD)[places]
        blocks = pa.Array.from_buffers(pa.binary(4 * PERIOD), m, [None, pa.py_buffer(np.ascontiguousarray(windows))])
        rank = np.append(blocks.dictionary_encode().indices.to_numpy().astype(np.int64) + 1, 0)
        del windows, blocks
        levels, step, index = [rank.astype(np.int32)], 1, np.arange(m)
        while True:  # rank: of the next `step` blocks; any order of blocks will do, as long as it is one
            follower = np.where(index + step < ends, index + step, m)
            key = rank[:-1] * (m + 2) + rank[follower]
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[1], (key[order][1:] != key[order][:-1]).astype(np.int64)]) if m else np.zeros(0, np.int64)
            rank = np.zeros(m + 1, np.int64)
            rank[order] = np.cumsum(new)
            if m == 0 or rank.max() == m:
                break
            levels.append(rank.astype(np.int32))
            step *= 2
        self.place = np.zeros(m + 1, np.int64)  # of a sample among the sorted ones
        self.place[order] = np.arange(m)
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(m - 1, 0), np.int32)
        for k in range(len(levels) - 1, -1, -1):
            same = (levels[k][a] == levels[k][b]) & (a < m) & (b < m)
            common[same] += 1 << k
            for x in (a, b):
                moved = x[same] + (1 << k)
                x[same] = np.where(moved < ends[x[same]], moved, m)
        self.least = [common]
        while 2 << (len(self.least) - 1) <= len(common):
            half, before = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(before[:-half], before[half:]))

    def _compared(self, a: np.ndarray, b: np.ndarray, length: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Add to ``length`` the words that agree, ``most`` at most; returns which pairs agree in all of them."""
        open_ = np.flatnonzero(most > 0)
        whole = np.ones(len(a), bool)
        for t in range(int(most.max(initial=0))):
            x, y = a[open_] + length[open_], b[open_] + length[open_]
            same = self.words[x] == self.words[y]
            whole[open_[~same]] = False
            open_ = open_[same]
            length[open_] += 1
            open_ = open_[most[open_] > t + 1]
            if not len(open_):
                break
        return whole

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        length = np.zeros(len(a), np.int64)
        reached = np.flatnonzero(self._compared(a, b, length, SHIFTS[a % PERIOD, b % PERIOD]))
        if len(reached):
            x, y = (self.place[self.number[p[reached] + length[reached]]] for p in (a, b))
            low, high = np.minimum(x, y), np.maximum(x, y)
            k = np.frexp((high - low).astype(np.float64))[1] - 1
            blocks = np.zeros(len(reached), np.int64)
            for level in np.unique(k):
                of = k == level
                blocks[of] = np.minimum(self.least[level][low[of]], self.least[level][high[of] - (1 << level)])
            length[reached] += blocks * PERIOD
            more = length[reached]
            self._compared(a[reached], b[reached], more, np.full(len(reached), PERIOD))
            length[reached] = more
        return length


def _grid(n: np.ndarray):
    """(document, place, period) for all places 0, p, 2p, ... and periods p up to half of each document's n words."""
    half = n // 2
    docs = np.repeat(np.arange(len(n)), half)
    periods = np.arange(len(docs)) - np.repeat(np.cumsum(half) - half, half) + 1
    counts = -(-(n[docs] - periods) // periods)  # places with a partner
    ends = np.cumsum(counts)
    start = 0
    while start < len(docs):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        c = counts[start:stop]
        step = np.arange(int(ends[stop - 1] - done)) - np.repeat(ends[start:stop] - c - done, c)
        p = np.repeat(periods[start:stop], c)
        yield np.repeat(docs[start:stop], c), step * p, p
        start = stop


class Runs(NamedTuple):
    """The runs of a slice of documents, by document, start and period; a run's start is a word number in its document."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def find_runs(words: np.ndarray, n: np.ndarray, min_words: int = MIN_WORDS) -> Runs:
    """All maximal runs of the documents whose word numbers (0 and up) stand in ``words`` one after another, n each."""
    first = np.cumsum(n + 1) - (n + 1)  # of each document, with the separators
    total = int((n + 1).sum())
    w = np.full(total, -1, np.int32)
    separators = first + n
    inside = np.ones(total, bool)
    inside[separators] = False
    w[inside] = words
    w[separators] = int(words.max(initial=-1)) + 1 + np.arange(len(n))
    forwards = backwards = None
    found = []
    for doc, place, p in _grid(n):
        a = first[doc] + place
        same = np.flatnonzero(w[a] == w[a + p])
        if not len(same):
            continue
        if forwards is None:
            # reversed, each document's separator stands behind it again: the one of the document before, and one more at the end
            forwards, backwards = CommonPrefixes(w), CommonPrefixes(np.append(w[::-1][1:], int(words.max()) + 1 + len(n)))
        doc, a, p = doc[same], a[same], p[same]
        ahead = forwards(a, a + p)
        back = backwards(total - 2 - a, total - 2 - a - p) - 1
        good = (ahead + back >= p) & (ahead + back + p >= min_words)
        found.append(np.stack([doc, a - back - first[doc], ahead + back + p, p])[:, good])
    if not found:
        return Runs(*np.zeros((4, 0), np.int64))
    doc, start, length, period = np.concatenate(found, 1)
    order = np.lexsort([period, length, start, doc])
    doc, start, length, period = (x[order] for x in (doc, start, length, period))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    doc, start, length, period = (x[new] for x in (doc, start, length, period))
    order = np.lexsort([period, start, doc])
    return Runs(*(x[order] for x in (doc, start, length, period)))


class Slice(NamedTuple):
    """A slice of documents: its words' bytes in order, numbers, the documents' word offsets, and their runs."""

    rows: pa.RecordBatch
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    runs: Runs

    def kept(self) -> np.ndarray:
        """Which words stay if each run keeps its first period."""
        change = np.zeros(len(self.begin) + 1, np.int64)
        at = self.first[self.runs.doc] + self.runs.start
        np.add.at(change, at + self.runs.period, 1)
        np.add.at(change, at + self.runs.length, -1)
        return np.cumsum(change[:-1]) == 0

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """Each document's kept words, joined by one space."""
        begin, size = self.begin[keep], (self.end - self.begin)[keep] + 1
        ends = np.cumsum(size)
        out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        inside = np.ones(len(out), bool)
        inside[ends - 1] = False
        source = np.arange(len(out)) + np.repeat(begin - (ends - size), size)
        out[inside] = self.data[source[inside]]
        raw = out.tobytes()
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(keep)])[self.first]]
        return [raw[i : max(i, j - 1)] for i, j in zip(edges[:-1], edges[1:])]


def sliced(batches, text: str, min_words: int = MIN_WORDS, rearranged=None):
    """A ``Slice`` for each slice of rows; ``rearranged(rows, n)`` may give the word that stands at each place of a document."""
    for whole in batches:
        for rows in text_slices([whole], text):
            data, offsets = text_bytes(rows.column(text))
            begin, end, first = word_spans(data, offsets, NOT_SPACE)
            size = end - begin
            at = np.concatenate([[0], np.cumsum(size)])
            words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(at), pa.py_buffer(data[NOT_SPACE[data]])])
            numbers = words.dictionary_encode().indices.to_numpy()
            n = np.diff(first)
            if rearranged is not None:
                places = rearranged(rows, n) + np.repeat(first[:-1], n)
                begin, end, numbers = begin[places], end[places], numbers[places]
            yield Slice(rows, data, begin, end, first, find_runs(numbers, n, min_words))


_RUN = StructType([StructField(n, LongType()) for n in ("start", "length", "period")])


def _schema(df: DataFrame, name: str, kind) -> StructType:
    return StructType([*(f for f in df.schema if f.name.lower() != name.lower()), StructField(name, kind)])


def periodic_runs(df: DataFrame, text: str = "text", runs: str = "runs", min_words: int = MIN_WORDS) -> DataFrame:
    """df with each text's runs by start and period: array<struct<start, length, period>>, in words."""
    schema = _schema(df, runs, ArrayType(_RUN))

    def run(batches):
        for s in sliced(batches, text, min_words):
            values = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in s.runs[1:]], fields=[pa.field(f.name, pa.int64()) for f in _RUN])
            at = np.searchsorted(s.runs.doc, np.arange(s.rows.num_rows + 1))
            yield pa.RecordBatch.from_arrays([*(s.rows.column(n) for n in schema.names[:-1]), pa.ListArray.from_arrays(pa.array(at, pa.int32()), values)], names=schema.names)

    return df.mapInArrow(run, schema)


def collapse(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """df where each run of a text keeps its first period only; words are joined by one space. Null stays null; the text becomes the last column."""
    schema = _schema(df, text, StringType())

    def run(batches):
        for s in sliced(batches, text, min_words):
            texts = pa.array([x.decode() if ok else None for x, ok in zip(s.joined(s.kept()), s.rows.column(text).is_valid().to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*(s.rows.column(n) for n in schema.names[:-1]), texts], names=schema.names)

    return df.mapInArrow(run, schema)


def planted(rows: pa.RecordBatch, n: np.ndarray) -> np.ndarray:
    """The query's contract: in one of ten documents all words from some place on repeat with some period."""
    out = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    first = np.cumsum(n) - n
    for r, d in enumerate(rows.column("doc_id").to_pylist()):
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        if h % 10 == 0 and n[r]:
            g = h // 10
            a = g % int(n[r])
            p = 1 + (int(n[r]) - a) // (3 + g % 8)
            own = out[first[r] : first[r] + n[r]]
            own[a:] = a + (own[a:] - a) % p
    return out


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]

    def digests(batches):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for s in sliced(batches, "text", rearranged=planted):
            doc, start, length, period = s.runs
            at = np.searchsorted(doc, np.arange(s.rows.num_rows + 1))
            lines = [b"%d,%d,%d\n" % x for x in zip(start.tolist(), length.tolist(), period.tolist())]
            best = np.lexsort([period, start, -length, doc])  # a document's longest run comes first
            top = pa.array(np.where(np.diff(at) > 0, np.append(best, 0)[np.minimum(at[:-1], len(best))], 0), pa.int64(), mask=np.diff(at) == 0)
            longest = [pa.array(np.append(x, 0), pa.int64()).take(top) for x in (start, length, period, 1000 * length // np.maximum(period, 1))]
            yield pa.RecordBatch.from_arrays(
                [s.rows.column("doc_id"), pa.array(np.diff(at), pa.int64()), *longest, pa.array([sha(b"".join(lines[i:j])) for i, j in zip(at[:-1], at[1:])], pa.string()), pa.array(map(sha, s.joined(s.kept())), pa.string())],
                names=names,
            )

    return docs.mapInArrow(digests, "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")
