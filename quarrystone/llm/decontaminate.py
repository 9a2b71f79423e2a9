"""Benchmark decontamination: remove spans or documents that repeat benchmark windows.

The benchmark's normalised word windows are hashed into sorted arrays that are broadcast;
document tasks slide over their words, look every window's hash up and verify each
hit on the words themselves. A benchmark of up to BLOCK_BYTES goes out at once: one scan,
one Python worker a task, nothing shuffled. A larger one is dealt into blocks of about
that size, and each has a scan of its own, so that the driver and a task hold one block
at a time (some 10 bytes for each byte of text); the hits, keyed by a digest of the text,
are joined to the documents at the end. An item's own text isn't cut, so one that is
larger than a block makes its block larger.

Defined results: null and empty texts have no words and no hits; an item without
words has no window and a null item_id is written as an empty string. Repeated rows
are judged each on their own; items repeated under one id count once. An empty benchmark
hits nothing. Extra columns pass through; ``find_hits`` replaces input columns named like
its own, ``decontaminate`` adds none and keeps all.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from quarrystone.llm._base import ASCII_LOWER, byte_class, checkpointed, packed_words, spare, table, text_bytes, text_slices, window_hashes, word_hashes, word_spans

WINDOW = 10
BLOCK_BYTES = 8 << 20
#: [0-9a-z] and all characters beyond ASCII, after lower-casing A-Z.
WORD = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
_FILTER_BITS = 20
_SPANS = ArrayType(StructType().add("a", "long").add("b", "long"))


def _words(column: pa.Array):
    data, offsets = text_bytes(column)
    data = ASCII_LOWER[data]
    starts, ends, at = word_spans(data, offsets, WORD)
    return data, offsets, starts, ends, at


class WindowSet:
    """The windows of some benchmark items: sorted hashes with the place of each window, by length."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        data, _, starts, ends, at = _words(pa.array([t for _, t in items], pa.string()))
        self.ids, n = [i for i, _ in items], np.diff(at)
        self.raw, self.place, self.stop = packed_words(data, starts, ends, WORD)
        self.item = np.repeat(np.arange(len(n), dtype=np.int32), n)
        words = word_hashes(data, starts, ends)
        length = np.minimum(n, window)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in np.unique(length[length > 0]).tolist():
            rows = np.flatnonzero(length == k)
            each = n[rows] - k + 1
            first = np.repeat(at[rows] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            h = window_hashes(words, k)[first]
            order = np.argsort(h, kind="stable")
            near = np.zeros(1 << _FILTER_BITS, bool)
            near[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.by_length[k] = (h[order], first[order].astype(np.int32), near)

    def hits(self, data, starts, ends, at):
        """Verified occurrences: first word, length in words, item ids."""
        words = word_hashes(data, starts, ends)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        packed, known = None, {}
        for k, (hashes, first, near) in self.by_length.items():
            h = window_hashes(words, k)
            if not len(h):
                continue
            found = np.flatnonzero(near[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            found = found[row[found] == row[found + k - 1]]
            lo, hi = np.searchsorted(hashes, h[found]), np.searchsorted(hashes, h[found], "right")
            if not (lo < hi).any():
                continue
            packed = packed or packed_words(data, starts, ends, WORD)
            raw, place, stop = packed
            for i, a, b in zip(found[lo < hi].tolist(), lo[lo < hi].tolist(), hi[lo < hi].tolist()):
                span = raw[place[i] : stop[i + k - 1]]
                if span not in known:
                    known[span] = {self.ids[self.item[j]] for j in first[a:b].tolist() if self.raw[self.place[j] : self.stop[j + k - 1]] == span}
                if known[span]:
                    yield i, k, known[span]

    def scan(self, column: pa.Array) -> tuple[np.ndarray, list, list]:
        """Number of words, hit spans (first word, end word) and item ids of each row; both in order."""
        data, _, starts, ends, at = _words(column)
        spans: list[set] = [set() for _ in range(len(column))]
        items: list[set] = [set() for _ in range(len(column))]
        for i, k, found in self.hits(data, starts, ends, at):
            r = int(np.searchsorted(at, i, "right")) - 1
            spans[r].add((i - int(at[r]), i - int(at[r]) + k))
            items[r] |= found
        return np.diff(at), [sorted(x) for x in spans], [sorted(x) for x in items]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> tuple[int, DataFrame]:
    """How many blocks, and the items with their blocks."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-total // BLOCK_BYTES) or 1
    return n, items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))


def _scanned(df: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, window: int, schema: StructType, finish) -> DataFrame:
    """``finish(batch, n_words, spans, items)`` over slices of df's rows, when the whole benchmark was looked for."""
    spark = df.sparkSession
    n, items = _blocks(benchmark, item_id, item_text)
    share = lambda b: spark.sparkContext.broadcast(WindowSet([(r.item, r.text) for r in items.filter(F.col("block") == b).collect()], window))  # noqa: E731  one block
    if n == 1:
        shared = share(0)

        def whole(batches):
            for x in batches:
                for b in text_slices([x], text):
                    yield finish(b, *shared.value.scan(b.column(text)))

        return df.mapInArrow(whole, schema)

    key, spans, ids = spare(df.columns, "key", "spans", "items")
    keyed = df.withColumn(key, F.md5(F.coalesce(F.col(text), F.lit(""))))
    asked = keyed.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def one(block):
        def found(batches):
            for x in batches:
                for b in text_slices([x], "text"):
                    _, spans, items = block.value.scan(b.column("text"))
                    hit = [i for i, s in enumerate(spans) if s]
                    spans = pa.array([[{"a": a, "b": z} for a, z in spans[i]] for i in hit], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
                    yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(hit, pa.int64())), spans, pa.array([items[i] for i in hit], pa.list_(pa.string()))], names=["key", "spans", "items"])

        return asked.mapInArrow(found, StructType().add("key", "string").add("spans", _SPANS).add("items", ArrayType(StringType())))

    parts = []
    for k in range(n):
        block = share(k)
        parts.append(checkpointed(one(block)))
        block.destroy()
    merged = reduce(DataFrame.unionByName, parts).groupBy("key").agg(*(F.array_distinct(F.flatten(F.collect_set(c))).alias(new) for c, new in (("spans", spans), ("items", ids)))).withColumnRenamed("key", key)

    def joined(batches):
        for x in batches:
            for b in text_slices([x], text):
                *_, at = _words(b.column(text))
                s = [sorted((y["a"], y["b"]) for y in x or ()) for x in b.column(spans).to_pylist()]
                yield finish(b, np.diff(at), s, [sorted(x or ()) for x in b.column(ids).to_pylist()])

    return keyed.join(merged, key, "left").drop(key).mapInArrow(joined, schema)


def find_hits(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Add ``n_words``, ``hit_spans`` (first word, end word) and ``items`` (sorted ids) to every row."""
    df = df.drop("n_words", "hit_spans", "items")
    names = df.columns
    schema = StructType([*df.schema.fields]).add("n_words", LongType()).add("hit_spans", _SPANS).add("items", ArrayType(StringType()))

    def finish(b, n_words, spans, items):
        spans = pa.array([[{"a": a, "b": z} for a, z in x] for x in spans], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        return pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(n_words, pa.int64()), spans, pa.array(items, pa.list_(pa.string()))], names=[*names, "n_words", "hit_spans", "items"])

    return _scanned(df, benchmark, text, item_id, item_text, window, schema, finish)


def hit_words(spans: list[tuple[int, int]]) -> int:
    """Words inside any of the spans, which are in order."""
    total = end = 0
    for a, b in spans:
        total += max(0, b - max(end, a))
        end = max(end, b)
    return total


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans (in order) and what stands between them."""
    data, _, starts, ends, _ = _words(pa.array([text]))
    raw, out, at = text.encode(), [], 0
    for first, last in spans:
        a, b = int(starts[first]), int(ends[last - 1])
        out.append(raw[at : max(at, a)])
        at = max(at, b)
    return (b"".join(out) + raw[at:]).decode()


def decontaminate(df: DataFrame, benchmark: DataFrame, mode: str = "spans", max_share: float = 0.5, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove benchmark passages from texts; the columns stay as they are.

    mode 'documents' drops every document with a hit. mode 'spans' cuts the hit words
    and drops only documents of which over ``max_share`` of the words are hit.
    """
    names = df.columns

    def finish(b, n_words, spans, items):
        share = max_share if mode == "spans" else 0
        keep = np.array([hit_words(s) <= share * n for s, n in zip(spans, n_words.tolist())], bool)
        b, spans = b.select(names).filter(pa.array(keep)), [s for s, k in zip(spans, keep) if k]
        if not any(spans):
            return b
        texts = [cut_spans(t, s) if s else t for t, s in zip(b.column(text).to_pylist(), spans)]
        return b.set_column(names.index(text), text, pa.array(texts, b.schema.field(text).type))

    return _scanned(df, benchmark, text, item_id, item_text, window, df.schema, finish)


def query(spark, sf_dir: str) -> DataFrame:
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]

    def digests(b, n_words, spans, items):
        hit = [hit_words(x) for x in spans]
        sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        columns = [pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(sha, pa.string()), pa.array([h > 0 for h in hit], pa.bool_())]
        return pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=names)

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = StructType([docs.schema["doc_id"]]).add("n_words", "long").add("n_hit", "long").add("n_items", "long").add("items_sha256", "string").add("contaminated", "boolean")
    return _scanned(docs, table(spark, sf_dir, "benchmark"), "text", "item_id", "text", WINDOW, schema, digests)


def _sql_words(name: str, key: str) -> str:
    return f"SELECT {key}, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM {name}"


SQL = f"""
WITH d AS ({_sql_words('documents', 'doc_id')}), b AS ({_sql_words('benchmark', 'item_id')}),
bw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p+k-1], ' ') AS g FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM (SELECT *, least(10, len(w)) AS k FROM b WHERE len(w) > 0))),
dw AS (SELECT doc_id, p, k, array_to_string(w[p:p+k-1], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM bw))),
h AS (SELECT doc_id, p, k, item_id FROM dw JOIN bw USING (k, g)),
n AS (SELECT doc_id, count(DISTINCT p + j)::BIGINT AS n_hit FROM (SELECT DISTINCT doc_id, p, k FROM h), range(10) AS t(j) WHERE j < k GROUP BY doc_id),
i AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""
