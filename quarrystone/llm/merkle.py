"""Merkle manifest of a dataset: a digest for each document, one for each group, one for all, and proofs.

The tree is worked through time-forward: nodes are taken in the order of their labels (the last
leaf below, then the level), a node sends its digest to its parent through a priority queue ordered
by the parent's label, and so finds its children's digests waiting when its turn comes. A task holds
the queue for one block of 256 sibling leaves at a time (a few messages for each level); the queue
between blocks is Spark's shuffle, which sorts and spills: a block's digest goes on as a leaf of the
next round, until each group has one node left, its subroot, and the same again over the subroots.
Then the rounds are taken in reverse and labels backwards: each block gets its proof suffix (the
runs of siblings from there up to the root) as one message and delivers suffixes to its nodes.

Leaves are numbered within their groups by a range partition over (group, key, digest), so a group
that holds a third of all rows is spread over as many partitions as it fills; a partition can only
go on with one group of the one before, so one number for each partition says all. Texts never
travel: 32-byte digests do, checkpointed first, so that finding the ranges doesn't hash texts again.
Rounds are checkpointed, each 1/256 of the one before.

Defined results: a null group is a group of its own and comes first, null keys come first in it.
Rows of equal keys are ordered by their digests, so equal rows are leaves side by side and give equal
subroots in any order. A group of one row has that leaf as its subroot. Empty tables have no root:
``build`` works and ``proofs`` gives no rows. Columns of any names pass through ``proofs``. A very
long text is hashed in its task by a built-in function and never copied to Python.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from quarrystone.llm._base import checkpointed, spare, table

#: A node has up to 16 children (4 bits of a position); a block has LEVELS of them above its leaves.
BITS, LEVELS = 4, 2
FAN, BLOCK = 1 << BITS, 1 << BITS * LEVELS


def leaf_digest(*columns: str | Column) -> Column:
    """32 bytes: SHA-256 over each value's length in bytes, a colon and the value as text, ``-`` for null."""

    def part(c):
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, columns)).cast("binary"), 256))


def _hash(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


def climb(digests: list[bytes], top: int):
    """The nodes above a block's leaves in the order of their labels: ((last leaf, level), children's digests), and the topmost digest."""
    queue: list[tuple[int, int, int, bytes]] = []  # (the receiver's label, the sender's place among its siblings, digest)
    nodes = []
    if not top:
        return nodes, digests[0]
    for i, d in enumerate(digests):
        heappush(queue, (i | FAN - 1, 1, i, d))
        while queue and (queue[0][0] <= i or i == len(digests) - 1):
            last, level, child, _ = queue[0]
            run = []
            while queue and queue[0][:2] == (last, level):
                run.append(heappop(queue)[3])
            nodes.append(((last, level), run))
            d = _hash(run)
            if level < top:
                heappush(queue, (last | (1 << BITS * (level + 1)) - 1, level + 1, last >> BITS * level, d))
    return nodes, d


def _top(block: int, n: int) -> int:
    """Levels above a block's leaves: all of them, but for a group that is no more than one block."""
    if block > 0:
        return LEVELS
    return 0 if n == 1 else 1 if n <= FAN else 2


def descend(nodes, top: int, path: bytes):
    """(position, siblings with itself, the parent's path) for each leaf of a block, from its nodes backwards."""
    waiting, out = {}, []
    for (last, level), run in reversed(nodes):
        mine = path if level == top else waiting.pop((last, level))
        for at in range(len(run) - 1, -1, -1):
            if level == 1:
                out.append((at, run, mine))
            else:
                size = BITS * (level - 1)
                child = (last >> BITS * level << BITS) + at
                waiting[(child + 1 << size) - 1, level - 1] = step(at, run) + mine
    return out[::-1] if nodes else [(0, [], path)]


def step(at: int, run: list[bytes]) -> bytes:
    """One level of a path: the node's position, how many siblings with itself, and their digests."""
    return bytes([at, len(run)]) + b"".join(run) if run else b""


@functools.lru_cache(64)
def read_path(path: bytes) -> list[tuple[bytes, bytes]]:
    """For each level from below, the hexadecimal digests left and right of the own one."""
    out, i = [], 0
    while i < len(path):
        at, n = path[i], path[i + 1]
        a, b, c = i + 2, i + 2 + 32 * at, i + 2 + 32 * n
        out.append((path[a:b].hex().encode(), path[b + 32 : c].hex().encode()))
        i = c
    return out


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    x = leaf.hex().encode()
    for left, right in read_path(path):
        x = hashlib.sha256(left + x + right).hexdigest().encode()
    return bytes.fromhex(x.decode())


def _blocks(batches):
    """(rows, edges): sorted rows cut so that each group's block is whole, and where each starts."""
    held = None
    for batch in _chained(batches):
        if batch is None:
            if held is not None and held.num_rows:
                yield held, _edges(held)
            return
        rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        edges = _edges(rows)
        if len(edges) > 2:
            yield rows.slice(0, int(edges[-2])), edges[:-1]
        held = rows.slice(int(edges[-2]))


def _chained(batches):
    for b in batches:
        if b.num_rows:
            yield b
    yield None


def _edges(rows: pa.RecordBatch) -> np.ndarray:
    group = rows.column("g").dictionary_encode(null_encoding="encode").indices.to_numpy()
    block = rows.column("b").to_numpy()
    return np.concatenate([[0], np.flatnonzero((group[1:] != group[:-1]) | (block[1:] != block[:-1])) + 1, [rows.num_rows]])


def numbered(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """df with each row's number, from 0, within its group, checkpointed; no group goes through one task.

    Rows are range-partitioned and sorted. A group that goes on from one partition to the next adds
    the rows that it has before: one number for each partition at most, which is broadcast.
    """
    part, first = spare([*df.columns, name], "part", "first")
    salt, n = spare([*df.columns, name, part, first], "salt", "n")
    columns = df.columns
    schema = StructType([*df.schema, StructField(name, LongType()), StructField(part, LongType()), StructField(first, BooleanType())])

    def count(batches):
        from pyspark import TaskContext

        own, before, current, begun = TaskContext.get().partitionId(), 0, None, False
        only = True
        for b in _chained(batches):
            if b is None:
                return
            values = b.column(group)
            codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
            sizes = np.diff(np.append(starts, b.num_rows))
            goes_on = begun and values[0].as_py() == current
            only = only and (goes_on or not begun)
            local = np.arange(b.num_rows) - np.repeat(starts, sizes)
            if goes_on:
                local[: sizes[0]] += before
            flags = np.zeros(b.num_rows, bool)
            if only:
                flags[: sizes[0]] = True
            only = only and len(starts) == 1
            before, current, begun = int(local[-1]) + 1, values[b.num_rows - 1].as_py(), True
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in columns), pa.array(local, pa.int64()), pa.array(np.full(b.num_rows, own), pa.int64()), pa.array(flags)], names=schema.names)

    keys = [group, *order]
    salted = df.withColumn(salt, F.monotonically_increasing_id())  # equal rows need not stay together
    placed = salted.repartitionByRange(*keys, salt).sortWithinPartitions(*keys).drop(salt)
    placed = checkpointed(placed.mapInArrow(count, schema))
    counts = placed.groupBy(group, part).agg(F.max(name).alias(n))
    later = W.partitionBy(group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(part, F.sum(F.col(n) + 1).over(later).alias(n)).filter(F.col(n) > 0).withColumn(first, F.lit(True))
    out = placed.join(F.broadcast(offsets), [part, first], "left").withColumn(name, F.col(name) + F.coalesce(n, F.lit(0)))
    return out.select(*df.columns, name)


@dataclass
class Manifest:
    """The leaves with their numbers, the rounds of the groups' trees and of the tree over the subroots."""

    leaves: DataFrame
    group: str
    digest: str
    number: str
    rounds: list[DataFrame]
    top: list[DataFrame]

    def subroots(self) -> DataFrame:
        """group, subroot."""
        return self.rounds[-1].select(F.col("g").alias(self.group), F.col("d").alias("subroot"))

    def root(self) -> DataFrame:
        """root, one row; none for an empty table."""
        return self.top[-1].select(F.col("d").alias("root"))


_NODE = StructType([StructField("g", StringType()), StructField("i", LongType()), StructField("d", BinaryType())])


def _up(batches):
    for rows, edges in _blocks(batches):
        digests, blocks = rows.column("d").to_pylist(), rows.column("b").to_numpy()
        out = [climb(digests[i:j], _top(int(blocks[i]), int(j - i)))[1] for i, j in zip(edges[:-1], edges[1:])]
        yield pa.RecordBatch.from_arrays([rows.column("g").take(pa.array(edges[:-1])), pa.array(blocks[edges[:-1]], pa.int64()), pa.array(out, pa.binary())], names=_NODE.names)


def _risen(nodes: DataFrame) -> list[DataFrame]:
    """Rounds of blocks until each group has one node; nodes: g, i, d."""
    rounds = [nodes]
    while True:
        blocks = rounds[-1].withColumn("b", F.shiftright("i", BITS * LEVELS)).repartition("g", "b").sortWithinPartitions("g", "b", "i")
        rounds.append(checkpointed(blocks.mapInArrow(_up, _NODE)))
        if not rounds[-1].agg(F.max("i")).first()[0]:
            return rounds


def build(df: DataFrame, group: str, key: str, digest: str) -> Manifest:
    """The manifest of df's rows by their digests (32 bytes, ``leaf_digest``); columns of df stay with the leaves."""
    (number,) = spare(df.columns, "leaf_number")
    leaves = numbered(checkpointed(df), group, [key, digest], number)
    rounds = _risen(leaves.select(F.col(group).cast("string").alias("g"), F.col(number).alias("i"), F.col(digest).alias("d")))
    names = numbered(rounds[-1].select("g", "d", F.lit("").alias("all")), "all", ["g"], "i")
    return Manifest(leaves, group, digest, number, rounds, _risen(names.select(F.col("all").alias("g"), "i", "d", F.col("g").alias("name"))))


def _down(nodes: DataFrame, messages: DataFrame, schema: StructType, put) -> DataFrame:
    """Deliver each block's message to its nodes: ``put(rows, of, found)`` makes rows of the nodes' rows, their messages' places and paths."""
    nodes = nodes.withColumns({"b": F.shiftright("i", BITS * LEVELS), "is_node": F.lit(True)})
    messages = messages.withColumns({"is_node": F.lit(False)})
    both = messages.unionByName(nodes, allowMissingColumns=True)

    def run(batches):
        for rows, edges in _blocks(batches):
            digests, blocks = rows.column("d").to_pylist(), rows.column("b").to_numpy()
            paths = rows.column("path")
            at, of, found = [], [], []
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
                n = j - i - 1
                top = _top(int(blocks[i]), n)
                found += descend(climb(digests[i + 1 : j], top)[0], top, paths[i].as_py())
                at += range(i + 1, j)
                of += [i] * n
            yield put(rows.take(pa.array(at, pa.int64())), rows.take(pa.array(of, pa.int64())), found)

    return both.repartition("g", "b").sortWithinPartitions("g", "b", "is_node", "i").mapInArrow(run, schema)


_MESSAGE = StructType([StructField("g", StringType()), StructField("b", LongType()), StructField("path", BinaryType()), StructField("subroot", BinaryType()), StructField("root", BinaryType())])


def _to_blocks(rows: pa.RecordBatch, sent: pa.RecordBatch, found) -> pa.RecordBatch:
    paths = pa.array([step(at, run) + path for at, run, path in found], pa.binary())
    return pa.RecordBatch.from_arrays([rows.column("g"), rows.column("i"), paths, sent.column("subroot"), sent.column("root")], names=_MESSAGE.names)


def _to_groups(rows: pa.RecordBatch, sent: pa.RecordBatch, found) -> pa.RecordBatch:
    """From the leaves of the tree over the subroots to the groups' last rounds."""
    paths = pa.array([step(at, run) + path for at, run, path in found], pa.binary())
    return pa.RecordBatch.from_arrays([rows.column("name"), pa.array([0] * rows.num_rows, pa.int64()), paths, rows.column("d"), sent.column("root")], names=_MESSAGE.names)


def delivered(m: Manifest, columns: list[str], schema: StructType, put) -> DataFrame:
    """The reversed sweep: ``put(rows, sent, found)`` gets leaves with ``columns``, the messages (subroot, root) and (position, run, path of the parent) of each."""
    messages = m.top[-1].select("g", F.lit(0).cast("bigint").alias("b"), F.lit(b"").alias("path"), F.lit(b"").alias("subroot"), F.col("d").alias("root"))
    for nodes in reversed(m.top[1:-1]):
        messages = _down(nodes, messages, _MESSAGE, _to_blocks)
    messages = _down(m.top[0], messages, _MESSAGE, _to_groups)
    for nodes in reversed(m.rounds[1:-1]):
        messages = _down(nodes, messages, _MESSAGE, _to_blocks)
    leaves = m.leaves.select(F.col(m.group).cast("string").alias("g"), F.col(m.number).alias("i"), F.col(m.digest).alias("d"), F.struct(*columns).alias("row"))
    return _down(leaves, messages, schema, put)


def proofs(m: Manifest) -> DataFrame:
    """The leaves' rows with subroot, root and path: all that ``fold`` needs to find the root again."""
    columns = [c for c in m.leaves.columns if c != m.number]
    names = spare(columns, "subroot", "root", "path")
    schema = StructType([*(m.leaves.schema[c] for c in columns), *(StructField(n, BinaryType()) for n in names)])

    def put(rows, sent, found):
        paths = pa.array([step(at, run) + path for at, run, path in found], pa.binary())
        return pa.RecordBatch.from_arrays([*rows.column("row").flatten(), sent.column("subroot"), sent.column("root"), paths], names=schema.names)

    return delivered(m, columns, schema, put)


def verified(df: DataFrame, digest: str, path: str = "path", root: str = "root", names: tuple[str, str] = ("folded_root", "verified")) -> DataFrame:
    """df with the root that each row's digest, computed from the data as they are now, and its path give, and whether that's the root."""
    schema = StructType([*(f for f in df.schema if f.name not in names), StructField(names[0], BinaryType()), StructField(names[1], BooleanType())])

    def run(batches):
        for b in batches:
            d, p, r = (b.column(c).to_pylist() for c in (digest, path, root))
            folded = [None if x is None or y is None else fold(x, y) for x, y in zip(d, p)]
            kept = [b.column(n) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(folded, pa.binary()), pa.array([x is not None and x == y for x, y in zip(folded, r)])], names=schema.names)

    return df.mapInArrow(run, schema)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, leaf_digest(*COLUMNS[:-1], F.translate("text", _UPPER, _LOWER)))
    m = build(docs.select("doc_id", "source", leaf_digest(*COLUMNS).alias("leaf"), changed.alias("changed")), "source", "doc_id", "leaf")
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = StructType([docs.schema["doc_id"], *(StructField(n, StringType()) for n in names), StructField("verified", BooleanType())])

    def put(rows, sent, found):
        doc_id, leaf, changed = rows.column("row").flatten()
        root = sent.column("root").to_pylist()
        proof, folded = [], []
        for x, y, (at, run, path) in zip(leaf.to_pylist(), changed.to_pylist(), found):
            x = x if y is None else y
            siblings = b"".join(run[:at] + run[at + 1 :]).hex().encode() + b"".join(a + b for a, b in read_path(path))
            proof.append(hashlib.sha256(siblings).hexdigest())
            folded.append(fold(_hash([*run[:at], x, *run[at + 1 :]]) if run else x, path))
        hexed = [pa.array([x.hex() for x in c], pa.string()) for c in (leaf.to_pylist(), sent.column("subroot").to_pylist(), root)]
        ok = pa.array([x == y for x, y in zip(folded, root)], pa.bool_())
        return pa.RecordBatch.from_arrays([doc_id, *hexed, pa.array(proof, pa.string()), pa.array([x.hex() for x in folded], pa.string()), ok], names=schema.names)

    return delivered(m, ["doc_id", "leaf", "changed"], schema, put)


def _sql() -> str:
    """Levels one after another, enough for 16^6 documents of a source and 16^4 sources; the fold nests the steps."""
    part = lambda c: f"coalesce(octet_length(encode({c}))::VARCHAR || ':' || {c}, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]) + ")"
    ctes = [
        "b0 AS (SELECT b, b AS c FROM (SELECT unnest(range(256)) AS b))",
        *(f"b{k + 1} AS (SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c FROM b{k})" for k in range(8)),
        "crc AS (SELECT list(c ORDER BY b) AS t FROM b8)",
        f"""d AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} AS lower_leaf,
          list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])) AS rest FROM documents, crc)""",
        "s0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
    ]

    def tree(name: str, first: str, group: str, levels: int) -> str:
        before = first
        for k in range(levels):
            ctes.append(f"{name}n{k} AS (SELECT *, count(*) OVER (PARTITION BY {group}) AS m FROM ({before}))")
            w = f"OVER (PARTITION BY {group}, i // 16 ORDER BY i ROWS BETWEEN"
            ctes.append(f"{name}r{k} AS (SELECT {group}, i, m, coalesce(string_agg(h, '') {w} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {w} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}n{k})")
            before = f"SELECT {group}, i // 16 AS i, CASE WHEN any_value(m) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h FROM {name}n{k} GROUP BY {group}, i // 16"
        return before

    ctes.append(f"sub AS ({tree('a', 'SELECT source, i, leaf AS h FROM s0', 'source', 6)})")
    ctes.append("top AS (SELECT 0 AS o, source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS j FROM sub)")
    ctes.append(f"root AS ({tree('t', 'SELECT o, j AS i, subroot AS h FROM top', 'o', 4)})")
    joins, folded, proof = [], "CASE WHEN xor(rest, 4294967295) % 5 = 0 THEN lower_leaf ELSE leaf END", []
    folds = []
    for name, levels, on in (("a", 6, "x.source IS NOT DISTINCT FROM {0}.source AND {0}.i = x.i // {1}"), ("t", 4, "{0}.i = top.j // {1}")):
        for k in range(levels):
            t = f"{name}{k}"
            joins.append(f"JOIN {name}r{k} {t} ON " + on.format(t, 16**k))
            folds.append(t)
            proof.append(f"CASE WHEN {t}.m > 1 THEN {t}.l || {t}.r ELSE '' END")
    columns = ", ".join(f"{t}.m AS {t}m, {t}.l AS {t}l, {t}.r AS {t}r" for t in folds)
    ctes.append(f"f0 AS (SELECT x.doc_id, x.leaf, top.subroot, root.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, {folded} AS f, {columns} FROM s0 x JOIN top ON x.source IS NOT DISTINCT FROM top.source, root {' '.join(joins)})")
    for k, t in enumerate(folds):
        ctes.append(f"f{k + 1} AS (SELECT * REPLACE (CASE WHEN {t}m > 1 THEN sha256({t}l || f || {t}r) ELSE f END AS f) FROM f{k})")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(folds)}"


SQL = _sql()
