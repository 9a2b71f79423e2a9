"""What the operators of this subpackage share: tables, checkpoints, word spans."""

from __future__ import annotations

import ctypes
import re
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of text worked on at once inside a task; longer texts make a slice of their own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Whole texts that go to a Python worker at once where ``checkpointed`` is told so. Spark's own 10,000 are tens of megabytes,
#: held by the executor and, twice, by the worker of each task that runs.
TEXT_ROWS = 1000


def checkpointed(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder.

    With ``batch_rows`` no Arrow batch has more rows while df is made.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder serves a session in local mode; elsewhere it's an error.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    if batch_rows is None:
        return df.checkpoint(eager=True)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    if 0 < int(before) <= batch_rows:
        return df.checkpoint(eager=True)
    conf.set(key, str(batch_rows))
    try:
        return df.checkpoint(eager=True)
    finally:
        conf.set(key, before)


def spare(columns: list[str], *names: str) -> list[str]:
    """Names like ``names`` that no column has, in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def row_key(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, list[str]]:
    """df with three more columns that tell a document by its id, of any type, and its text; and their names.

    They are: no id, the id as a string, Spark's xxhash64 of the text (null as empty).
    """
    key = spare(df.columns, "_n", "_d", "_v")
    values = [F.col(doc_id).isNull(), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.xxhash64(F.coalesce(F.col(text), F.lit("")))]
    return df.withColumns(dict(zip(key, values))), key


def held_out(doc_id, n: int, r: int):
    """True where crc32 of the id as text leaves ``r`` modulo ``n``; null ids are never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n == r, F.lit(False))


def _give_back() -> None:
    """Return freed memory to the system: Python workers live on from task to task, side by side."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def text_slices(batches, column: str, size: int = SLICE_BYTES):
    """Cut Arrow batches into runs of rows whose text (or bytes) stays below ``size``."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(lengths):
            if i > start and total + n > size:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)
        _give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and each row's offsets; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    column = pa.concat_arrays([column])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the words of all rows, and for each row the index of its first word.

    A word is a longest run of bytes that ``is_word`` marks (256 booleans);
    rows never share a word.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def packed_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words, each followed by one space, and where each begins and ends there."""
    lengths = ends - starts + 1
    place = np.cumsum(lengths) - lengths
    packed = np.full(int(lengths.sum()), 32, np.uint8)
    mask = np.ones(len(packed), bool)
    mask[place + lengths - 1] = False
    packed[mask] = data[is_word[data]]
    return packed.tobytes(), place, place + lengths - 1


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """256 booleans, false in the given inclusive ranges."""
    out = np.ones(256, bool)
    for a, b in excluded:
        out[a : b + 1] = False
    return out


#: Words of the contracts that split at ASCII white space.
NOT_SPACE = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: A-Z to a-z, all other bytes unchanged.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit polynomial hash of each word's bytes. Good for finding; matches are to be verified."""
    out = np.empty(len(starts), np.uint64)
    table = np.arange(256, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + block)))
        lengths = ends[i:j] - starts[i:j]
        first = np.cumsum(lengths) - lengths
        at = np.arange(lengths.sum())
        within = at - np.repeat(first, lengths)
        values = table[data[np.repeat(starts[i:j], lengths) + within]] * _powers(int(lengths.max()))[within]
        out[i:j] = np.add.reduceat(values, first)
        i = j
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for p, w in zip(_powers(k), range(k)):
        out += words[w : w + n] * p
    out ^= out >> np.uint64(31)
    return out * np.uint64(0x94D049BB133111EB)
