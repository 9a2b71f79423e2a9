"""Line dedup: lines that many documents share stay in one document only.

Every line's key is hashed to 128 bits in its task, and only hashes travel. They are
range-partitioned and sorted by (hash, document, text version), so that a frequent
line is spread over as many partitions as it fills; each partition is streamed once,
batch by batch, holding the newest documents of the open run. Runs that touch a
partition's edge are decided after their parts have been summed (at most two parts a
partition). What comes back is a compressed keep bitmap for each document that loses
lines, not text.

Defined results: null and empty texts are one empty line; keys under ``min_chars``
are never dropped. Rows of one doc_id count as one document, and each row is cut by
its own text; a null doc_id counts as a document of its own, smaller than all others.
Ids may be of any type that sorts. Ties cannot occur: the keeper is the largest doc_id.
Empty tables give empty results. Extra columns, whatever their names, pass through
``apply_keep``; ``with_keeps`` replaces ``keep`` and ``n_dropped`` of the input.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import BinaryType, DataType, LongType, StringType, StructField, StructType

from quarrystone.llm._base import checkpointed, row_key, spare, table, text_slices

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 20, 3
#: Undecided rows of one run that a task holds; more go out to be decided by the join.
HELD_ROWS = 50_000


def _schema(doc: DataType, *more: StructField) -> StructType:
    fields = [("h1", LongType()), ("h2", LongType()), ("doc", doc), ("ver", LongType()), ("n_lines", LongType()), ("at", BinaryType())]
    return StructType([*(StructField(n, t) for n, t in fields), *more])


def _hasher(min_chars: int):
    def hashed(batches):
        """One row for each distinct key of a text: hash, document, text version, line numbers."""
        for whole in batches:
            for batch in text_slices([whole], "text"):
                row, digests, ver, n, at = [], [], [], [], []
                for r, text in enumerate(batch.column("text").to_pylist()):
                    raw = (text or "").encode()
                    found: dict[bytes, bytearray] = {}
                    lines = raw.split(b"\n")
                    for i, line in enumerate(lines):
                        key = line.strip(WHITE)
                        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                            key = key.lower()
                            if key not in found:
                                found[key] = bytearray()
                            found[key] += i.to_bytes(4, "little")
                    row += [r] * len(found)
                    digests += map(xxhash.xxh3_128_digest, found)
                    ver += [xxhash.xxh64_intdigest(raw, 42)] * len(found)
                    n += [len(lines)] * len(found)
                    at += map(bytes, found.values())
                h = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).view(np.int64).reshape(-1, 2)
                columns = [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column("doc").take(pa.array(row, pa.int64())), pa.array(np.array(ver, np.uint64).view(np.int64)), pa.array(n, pa.int64()), pa.array(at, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "doc", "ver", "n_lines", "at"])

    return hashed


def _starts(rows: pa.RecordBatch, name: str) -> np.ndarray:
    """True where a sorted column's value differs from the row before; a null equals a null."""
    a, b = rows.column(name).slice(1), rows.column(name).slice(0, rows.num_rows - 1)
    differ = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null()))
    return np.concatenate([[True], differ.to_numpy(zero_copy_only=False)])


def _streamer(min_docs: int):
    def stream(batches):
        """Pass once over sorted rows. kind 'drop': another document of the run is larger and the
        run has enough documents. The runs at a partition's edges may go on next door: their rows
        that aren't proven yet come out as 'open', with one row of kind 'part' that counts the
        documents seen here and names the first and the last. So do those of a run with more than
        HELD_ROWS undecided rows (one document, or no id, in very many versions).
        """
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held = start = None  # the undecided rows of the run that is open, and its first document
        before, docs, edge = 0, 0, True  # its documents that aren't held, all of them, and whether it's to be summed

        def put(rows, kind, docs=0, last=None):
            n = rows.num_rows
            last = pa.nulls(n, rows.column("doc").type) if last is None else last
            more = [pa.array([kind] * n, pa.string()), pa.array([part] * n, pa.int64()), pa.array([docs] * n, pa.int64()), last]
            return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*rows.schema.names, "kind", "part", "docs", "last_doc"])

        def close(rows, start, docs):
            """A run that is to be summed ends: its undecided rows, and its row of kind 'part'."""
            yield put(rows, "open")
            key = rows.slice(rows.num_rows - 1)
            sign = [key.column("h1"), key.column("h2"), start, pa.array([0]), pa.array([0]), pa.array([b""], pa.binary())]
            yield put(pa.RecordBatch.from_arrays(sign, names=rows.schema.names), "part", docs, key.column("doc"))

        for batch in batches:
            if not batch.num_rows:
                continue
            going_on = held is not None
            rows = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if going_on else batch
            new_run = _starts(rows, "h1") | _starts(rows, "h2")
            new_doc = new_run | _starts(rows, "doc")
            once = np.flatnonzero(new_doc | _starts(rows, "ver"))  # repeated rows go
            runs = np.flatnonzero(new_run)
            n_docs = np.add.reduceat(new_doc.astype(np.int64), runs)
            n_docs[0] += before if going_on else 0
            doc_of = np.cumsum(new_doc) - 1
            last_doc = doc_of[np.append(runs[1:], rows.num_rows) - 1]
            run_of, enough = (np.cumsum(new_run) - 1)[once], n_docs >= min_docs
            drop = enough[run_of] & (doc_of[once] != last_doc[run_of])
            if drop.any():
                yield put(rows.take(pa.array(once[drop])), "drop")
            rest = once[~drop]
            if len(runs) > 1 and edge:
                yield from close(rows.take(pa.array(rest[rest < runs[1]])), start if going_on else rows.column("doc").slice(0, 1), int(n_docs[0]))
            edge = edge and len(runs) == 1
            if len(runs) > 1 or not going_on:
                start = rows.column("doc").slice(int(runs[-1]), 1)
            held = rows.take(pa.array(rest[rest >= runs[-1]]))
            docs = int(n_docs[-1])
            before = docs - 1 if enough[-1] else before if len(runs) == 1 else 0
            if held.num_rows > HELD_ROWS:
                yield put(held.slice(0, held.num_rows - 1), "open")
                held, before, edge = held.slice(held.num_rows - 1), docs - 1, True
        if held is not None:
            yield from close(held, start, docs)

    return stream


def line_keeps(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Keep bitmaps of the texts that lose lines: doc, ver, n_lines, n_dropped, keep.

    doc is the document id, ver Spark's xxhash64 of the text, keep a zlib-compressed
    bitmap with bit i set if line i stays.
    """
    df = df.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"))
    id_type = df.schema["doc"].dataType
    order = ["h1", "h2", "doc", "ver"]  # no id sorts as the smallest document
    lines = checkpointed(df.mapInArrow(_hasher(min_chars), _schema(id_type)))  # so that finding the ranges doesn't hash again
    lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    more = [StructField("kind", StringType()), StructField("part", LongType()), StructField("docs", LongType()), StructField("last_doc", id_type)]
    runs = checkpointed(lines.mapInArrow(_streamer(min_docs), _schema(id_type, *more)))
    key = W.partitionBy("h1", "h2").orderBy("part", "doc")
    same = F.lag("part").over(key).isNotNull() & F.lag("last_doc").over(key).eqNullSafe(F.col("doc"))
    parts = runs.filter("kind = 'part'").withColumn("new_docs", F.col("docs") - same.cast("int"))
    sums = parts.groupBy("h1", "h2").agg(F.sum("new_docs").alias("total"), F.max("last_doc").alias("top"))
    late = runs.filter("kind = 'open'").join(sums, ["h1", "h2"]).filter((F.col("total") >= min_docs) & ~F.col("doc").eqNullSafe(F.col("top"))).select(*order, "n_lines", "at")
    drops = runs.filter("kind = 'drop'").select(*order, "n_lines", "at").unionByName(late)
    grouped = drops.groupBy("doc", "ver").agg(F.first("n_lines").alias("n_lines"), F.collect_list("at").alias("at"))

    def bitmaps(batches):
        for b in batches:
            n_lines = b.column("n_lines").to_pylist()
            at = [np.frombuffer(b"".join(x), np.uint32) for x in b.column("at").to_pylist()]
            keep = pa.array([keep_bitmap(a, n) for a, n in zip(at, n_lines)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("ver"), b.column("n_lines"), pa.array([len(a) for a in at], pa.int64()), keep], names=["doc", "ver", "n_lines", "n_dropped", "keep"])

    fields = [("doc", id_type), ("ver", LongType()), ("n_lines", LongType()), ("n_dropped", LongType()), ("keep", BinaryType())]
    return grouped.mapInArrow(bitmaps, StructType([StructField(n, t) for n, t in fields]))


def keep_bitmap(dropped: np.ndarray, n_lines: int) -> bytes:
    """Compressed bitmap, bit i set if line i stays."""
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1)


def read_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")[:n_lines].astype(bool)


def cut(text: str | None, keep: bytes | None) -> str | None:
    """The text with the lines that its bitmap keeps."""
    if keep is None or text is None:
        return text
    lines = text.split("\n")
    return "\n".join(x for x, k in zip(lines, read_bitmap(keep, len(lines))) if k)


def _joined(df: DataFrame, keeps: DataFrame, doc_id: str, text: str, n_dropped: str, keep: str) -> DataFrame:
    left, key = row_key(df, doc_id, text)
    k = keeps.select(F.col("doc").isNull().alias(key[0]), F.coalesce(F.col("doc").cast("string"), F.lit("")).alias(key[1]), F.col("ver").alias(key[2]), F.col("n_dropped").alias(n_dropped), F.col("keep").alias(keep))
    return left.join(k, key, "left").drop(*key).withColumn(n_dropped, F.coalesce(n_dropped, F.lit(0).cast("bigint")))


def with_keeps(df: DataFrame, keeps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of df with n_dropped and its bitmap, null where nothing is dropped."""
    return _joined(df.drop("n_dropped", "keep"), keeps, doc_id, text, "n_dropped", "keep")


def apply_keep(df: DataFrame, keeps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df with dropped lines cut from their texts; columns as before."""
    names = df.columns
    n_dropped, keep = spare(names, "n_dropped", "keep")

    def kept(batches):
        for whole in batches:
            for b in text_slices([whole], text):
                loses = b.column(keep).is_valid()
                some = b.filter(loses)
                texts = pa.array([cut(x, y) for x, y in zip(some.column(text).to_pylist(), some.column(keep).to_pylist())], some.schema.field(text).type)
                yield pa.RecordBatch.from_arrays([pc.replace_with_mask(b.column(n), loses, texts) if n == text else b.column(n) for n in names], names=names)

    return _joined(df, keeps, doc_id, text, n_dropped, keep).mapInArrow(kept, df.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def digests(batches):
        for whole in batches:
            for b in text_slices([whole], "text"):
                texts = b.column("text").to_pylist()
                kept = [cut(t, k) or "" for t, k in zip(texts, b.column("keep").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([(t or "").count("\n") + 1 for t in texts], pa.int64()), b.column("n_dropped"), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in kept])],
                    names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
                )

    return with_keeps(docs, line_keeps(docs)).mapInArrow(digests, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string")


_WS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
SQL = f"""
WITH l AS (
  SELECT doc_id, i, ls[i] AS line, translate(trim(ls[i], {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), g AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, g.k IS NOT NULL AND l.doc_id <> g.top AS bad FROM l LEFT JOIN g ON l.k = g.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (bad)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT bad), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
