"""Best-fit packing after Martello-Toth dominance reduction.

What a packing looks like depends on piece lengths alone, and there are at most
``capacity`` of them. So documents are encoded and cut in tasks, counted by length
(a histogram of at most ``capacity`` rows reaches the driver), and the driver packs
the histogram: reduction fixes sets that dominate every alternative (an item nothing
fits with; a pair that fills the sequence, or that no two items could replace; a
triple likewise), and best-fit decreasing places the rest, whole runs of equal pieces
at a time. The plan says which ranks of each length go to which sequences; its size is
bounded by the capacity, not by the data. Pieces find their rank by a salted row
number: each length has buckets of its own, so many that all lengths together have
BUCKETS at most (and one each), each numbered alone, then shifted by bucket counts.

Defined results: null text is an empty document, whose piece is the end id alone.
Repeated rows are documents of their own; ties between equal lengths go by doc_id.
A null doc_id stays null and is packed. Empty tables give no sequences. Extra columns
aren't read. A text of any length is encoded whole (see ``tokens``).
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from quarrystone.llm._base import TEXT_ROWS, checkpointed, table
from quarrystone.llm.tokens import encoder

CAPACITY, END_ID = 4096, 1
#: Buckets that ranks are taken in, beside one for each length; none is made for fewer pieces than MIN_BUCKET.
BUCKETS, MIN_BUCKET = 1 << 18, 500


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def make(batch, ids, at):
        cols: list[list] = [[] for _ in names]
        for doc, a, b in zip(batch.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            whole = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
            for k, start in enumerate(range(0, len(whole), capacity)):
                part = whole[start : start + capacity]
                for col, x in zip(cols, (doc, k, start, len(part), zlib.crc32(part.tobytes()), part)):
                    col.append(x)
        types = [batch.schema.field("doc_id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    df = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {df.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return df.mapInArrow(encoder(path, "text", make), schema)


class _Stock:
    """Counts of items by length, with the lengths still there in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {k: v for k, v in counts.items() if v > 0}
        self.order = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.order.pop(bisect.bisect_left(self.order, length))

    def largest(self, room: int, less: tuple = ()) -> int | None:
        """The largest length within room, with the items in ``less`` taken away."""
        i = bisect.bisect_right(self.order, room) - 1
        while i >= 0 and self.n[self.order[i]] <= less.count(self.order[i]):
            i -= 1
        return self.order[i] if i >= 0 else None

    def smallest(self, k: int, less: int) -> list[int]:
        """The k smallest items, one of length ``less`` taken away."""
        out: list[int] = []
        for x in self.order:
            out += [x] * min(k, self.n[x] - (x == less))
            if len(out) >= k:
                break
        return out[:k]


def _best_pairs(stock: _Stock, j: int, room: int, above: int) -> int:
    """The largest sum within room of two items, both larger than ``above``, beside one of length j; 0 if none."""
    has = lambda x: stock.n[x] - (x == j)
    order = [x for x in stock.order if above < x <= room and has(x)]
    best, lo, hi = 0, 0, len(order) - 1
    while lo <= hi:
        a, b = order[lo], order[hi]
        if a + b > room:
            hi -= 1
            continue
        if lo != hi or has(a) > 1:
            best = max(best, a + b)
        lo += 1
    return best


def reduce_dominated(stock: _Stock, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Fix sets that dominate every alternative for their largest item; shrinks the stock.

    For an item j and the room beside it, with a the largest item that fits:
    - nothing fits: {j};
    - a fills the room, or no two items fit, or (no three fit) no fitting pair is larger
      than a: {j, a}, since whatever else stood beside j can stand where a was;
    - no three fit, b is the largest beside j and a, and every fitting pair with its smaller
      item above b sums to a at most: {j, a, b}.
    Taking items away only narrows the alternatives, so a set is fixed as often as it's there.
    """
    fixed = []
    for j in reversed(list(stock.order)):
        while j in stock.n:
            room = capacity - j
            low = stock.smallest(3, j)
            if not low or low[0] > room:
                m = stock.n[j] if not low or low[0] != j else 1
                stock.take(j, m)
                fixed.append(([(j, 1)], m))
                continue
            a = stock.largest(room, (j,))
            two, three = len(low) > 1 and low[0] + low[1] <= room, len(low) > 2 and sum(low) <= room
            if a == room or not two or (not three and _best_pairs(stock, j, room, 0) <= a):
                m = stock.n[j] // 2 if a == j else min(stock.n[j], stock.n[a])
                stock.take(j, m * (1 + (a == j)))
                if a != j:
                    stock.take(a, m)
                fixed.append(([(j, 2)] if a == j else [(j, 1), (a, 1)], m))
                continue
            b = None if three else stock.largest(room - a, (j, a))
            if b is not None and _best_pairs(stock, j, room, b) <= a:
                items: dict[int, int] = {}
                for x in (j, a, b):
                    items[x] = items.get(x, 0) + 1
                m = min(stock.n[x] // c for x, c in items.items())
                for x, c in items.items():
                    stock.take(x, m * c)
                fixed.append((list(items.items()), m))
                continue
            break
    return fixed


def best_fit(stock: _Stock, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing on counts: every piece goes where the least room is left."""
    open_: dict[int, list[tuple[list, int]]] = {capacity: [([], sum(stock.n.values()))]}
    order = [capacity]

    def put(room, pattern, m):
        if m:
            if room not in open_:
                open_[room] = []
                bisect.insort(order, room)
            open_[room].append((pattern, m))

    for length in reversed(list(stock.order)):
        n = stock.n[length]
        while n:
            room = order[bisect.bisect_left(order, length)]
            pattern, m = open_[room].pop()
            if not open_[room]:
                del open_[room]
                order.pop(bisect.bisect_left(order, room))
            each = room // length
            full = min(m, n // each)
            put(room - each * length, [*pattern, (length, each)], full)
            n, m = n - full * each, m - full
            if m and 0 < n < each:
                put(room - n * length, [*pattern, (length, n)], 1)
                n, m = 0, m - 1
            put(room, pattern, m)
    return [(pattern, m) for groups in open_.values() for pattern, m in groups if pattern]


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """The plan: for runs of ranks of each length, the sequences and offsets they go to.

    Row i: pieces of ``length`` with ranks ``rank`` and on (up to the next row) go to sequence
    ``base`` + k // ``each``, at ``offset`` + k % ``each`` * length, k the rank less ``rank``.
    """
    stock = _Stock(counts)
    patterns = reduce_dominated(stock, capacity) + best_fit(stock, capacity)
    rows, used, sequence = [], {}, 0
    for items, m in patterns:
        offset = 0
        for length, each in items:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, each, offset))
            used[length] = rank + each * m
            offset += each * length
        sequence += m
    rows.sort()
    plan = dict(zip(("length", "rank", "base", "each", "offset"), np.array(rows, np.int64).reshape(-1, 5).T))
    return plan


def place(df: DataFrame, capacity: int = CAPACITY, bucket_pieces: int | None = None) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ids_crc32 and maybe more, with lineage cut)."""
    sizes = df.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in sizes}
    bucket_pieces = bucket_pieces or max(MIN_BUCKET, -(-sum(histogram.values()) // BUCKETS))
    buckets = df.sparkSession.createDataFrame([(n, -(-m // bucket_pieces)) for n, m in histogram.items()], "length bigint, salts bigint")
    salted = df.join(F.broadcast(buckets), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("salts")).cast("int")).drop("salts")
    counts = checkpointed(salted.groupBy("length", "salt").agg(F.count("*").alias("n")))
    plan = pack_histogram(histogram, capacity)
    shared = df.sparkSession.sparkContext.broadcast(plan)  # rows bounded by the capacity
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    mine = W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(mine) - 1).join(shifts, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("shift"))
    names = df.columns
    ranked = ranked.select(*names, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", sequence_id bigint, offset bigint"

    def look_up(batches):
        plan = shared.value
        lengths = plan["length"]
        for b in batches:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy().astype(np.int64)
            lo, hi = np.searchsorted(lengths, n), np.searchsorted(lengths, n, "right")
            # within the rows of each length: the last that starts at or before the rank
            start = np.empty(len(n), np.int64)
            for x in np.unique(n):
                at = n == x
                a, z = lo[at][0], hi[at][0]
                start[at] = a + np.searchsorted(plan["rank"][a:z], rank[at], "right") - 1
            k, each = rank - plan["rank"][start], plan["each"][start]
            out = [pa.array(plan["base"][start] + k // each), pa.array(plan["offset"][start] + k % each * n)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *out], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(look_up, schema)


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    return place(checkpointed(pieces(df, doc_id, text, path, capacity, end_id), TEXT_ROWS), capacity)


def sequences(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The packed sequences: sequence_id, ids, and the doc_ids in order. Every row's pieces are there once, whatever its id."""
    placed = place(checkpointed(pieces(df, doc_id, text, path, capacity, end_id, with_ids=True), TEXT_ROWS), capacity)
    rows = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
