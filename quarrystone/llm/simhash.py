"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits from word shingles; texts link at ``radius`` or fewer
differing bits, and components of links are the groups. Equal fingerprints are one
node, so exact copies cost one grouping. Nodes are linked like this: bits that go
together are put into the same partition (from the corpus' 64 x 64 bit counts), a
dynamic program gives each partition its own threshold, from the candidate counts
that all fingerprints' bit statistics foretell, such that thresholds sum to
radius - partitions + 1: any linked pair then agrees within the threshold in at least
one partition. Each node is sent to its partition values, and to all values within
the threshold; whoever meets is verified on all 64 bits.

Within a meeting place only a spanning forest of the true links is put out, found by
growing clusters, so a large group of near copies yields as many edges as nodes.
Places with over PLACE_ROWS nodes are cut into blocks that meet pairwise, so that no
task holds more than two blocks. No link between different fingerprints is lost.

Defined results: null and empty texts, and texts without words, have fingerprint
zero and are linked like any other. Repeated rows and ties share their component.
A null doc_id takes part but never names a component (null if all are null). Ids may
be of any type that sorts. Extra columns, whatever their names, pass through
``drop_near_duplicates``. Empty tables give empty results.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quarrystone.llm._base import ASCII_LOWER, NOT_SPACE, checkpointed, packed_words, row_key, table, text_bytes, text_slices, word_spans
from quarrystone.llm.components import connected_components

RADIUS, SHINGLE = 3, 3
PLACE_ROWS = 20_000
_U64 = np.uint64
_LANES = _U64(0x0101010101010101)


def majority_bits(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of the 64-bit hashes."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    full = n // 255 * 255
    for part in ([hashes[:full].reshape(-1, 255)] if full else []) + ([hashes[full:].reshape(1, -1)] if full < n else []):
        for k in range(8):  # byte lanes count up to 255 each
            lanes = ((part >> _U64(k)) & _LANES).sum(axis=1, dtype=np.uint64)
            counts[k::8] += lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def _fingerprints(text: pa.Array, shingle: int) -> np.ndarray:
    data, offsets = text_bytes(text)
    data = ASCII_LOWER[data]
    starts, ends, at = word_spans(data, offsets, NOT_SPACE)
    raw, place, stops = packed_words(data, starts, ends, NOT_SPACE)
    place, stops = place.tolist(), stops.tolist()
    digest, out = xxhash.xxh64_intdigest, np.zeros(len(at) - 1, np.uint64)
    for r, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if b > a:
            k = min(shingle, b - a)
            out[r] = majority_bits(np.array([digest(raw[i:j], 42) for i, j in zip(place[a : b - k + 1], stops[a + k - 1 : b])], np.uint64))
    return out


def fingerprints(df: DataFrame, text: str = "text", shingle: int = SHINGLE, column: str = "fp") -> DataFrame:
    """df without its text but with ``column``, the fingerprint as a signed bigint."""
    rest = df.drop(column).schema
    keep = [f for f in rest.fields if f.name != text]
    schema = type(rest)([*keep]).add(column, "long")

    def compute(batches):
        for whole in batches:
            for b in text_slices([whole], text):
                fp = pa.array(_fingerprints(b.column(text), shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), fp], names=schema.names)

    return df.select(*rest.names).mapInArrow(compute, schema)


def bit_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and for each pair of bits how many have both; over all of them."""

    def partial(batches):
        total, n = np.zeros((64, 64), np.int64), 0
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(fp), 100_000):
                bits = np.unpackbits(fp[i : i + 100_000].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
            n += len(fp)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(4096), -1)), pa.array(np.append(total.ravel(), n))], names=["at", "n"])

    rows = nodes.select("fp").mapInArrow(partial, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect()  # 4097 at most
    both = np.zeros((64, 64), np.int64)
    for r in rows:
        if r["at"] >= 0:
            both[divmod(r["at"], 64)] = r["n"]
    return next((r["n"] for r in rows if r["at"] < 0), 0), both


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Cut the bits into ``parts`` groups of nearly equal size, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    corr = np.abs(cov / np.outer(sd, sd))
    left, groups = set(range(64)), []
    for g in range(parts):
        size = (64 * (g + 1)) // parts - (64 * g) // parts
        start = max(sorted(left), key=lambda i: sum(corr[i, j] for j in left if j != i))
        group = [start]
        left.discard(start)
        while len(group) < size:
            best = max(sorted(left), key=lambda i: sum(corr[i, j] for j in group))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def distances(both: np.ndarray, group: list[int]) -> np.ndarray:
    """Chances that two fingerprints differ in 0, 1, ... bits of the group, from the shares of each bit and pair of bits.

    Bits are put in a chain, each next to the one it goes with most, and whether the two
    fingerprints agree in a bit depends on the bit before it.
    """
    p = np.diag(both)
    same = p**2 + (1 - p) ** 2
    cov = np.abs(both - np.outer(p, p))
    order, left = [group[0]], set(group[1:])
    while left:
        order.append(max(sorted(left), key=lambda i: cov[order[-1], i]))
        left.discard(order[-1])
    at = np.zeros((len(group) + 1, 2))  # by number of differing bits, and whether the last one differs
    at[0, 0], at[1, 1] = same[order[0]], 1 - same[order[0]]
    for a, b in zip(order, order[1:]):
        pab = both[a, b]
        agree = pab**2 + (p[a] - pab) ** 2 + (p[b] - pab) ** 2 + (1 - p[a] - p[b] + pab) ** 2
        stay = agree / max(same[a], 1e-12)  # agree in b if they do in a
        turn = (same[b] - agree) / max(1 - same[a], 1e-12)
        new = np.zeros_like(at)
        new[:, 0] = at[:, 0] * stay + at[:, 1] * turn
        new[1:, 1] = at[:-1, 0] * (1 - stay) + at[:-1, 1] * (1 - turn)
        at = np.clip(new, 0, 1)
    return at.sum(axis=1)


def allocate(n: int, both: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Partitions with thresholds: the cheapest plan by expected rows sent and pairs compared.

    For each number of partitions a dynamic program over (partition, threshold left) picks
    thresholds t >= -1 (-1: unused) with sum radius - partitions + 1. A partition's cost at t
    is a row for each node and value within t, and the pairs expected within distance t there,
    from the counts of bits and of pairs of bits among all fingerprints.
    """
    row_cost, pair_cost = 200.0, 1.0
    best = (float("inf"), [])
    for parts in range(2, radius + 4):
        groups = group_bits(n, both, parts)
        costs = []
        for g in groups:
            dist = distances(both / max(n, 1), g)
            at = {-1: 0.0}
            for t in range(radius + 1):
                values = sum(comb(len(g), d) for d in range(t + 1))
                at[t] = row_cost * n * values + pair_cost * n * n / 2 * dist[: t + 1].sum() * (1 + t)
            costs.append(at)
        table_: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for at in costs:
            new: dict[int, tuple[float, list[int]]] = {}
            for used, (c, ts) in table_.items():
                for t, x in at.items():
                    if c + x < new.get(used + t, (float("inf"),))[0]:
                        new[used + t] = (c + x, [*ts, t])
            table_ = new
        c, ts = table_.get(radius - parts + 1, (float("inf"), []))
        if c < best[0]:
            best = (c, [(g, t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


def _places(plan, batches):
    """Rows (part, value, fp, home): home where the value is the node's own."""
    masks = []
    for bits, t in plan:
        flips = [0]
        for d in range(1, t + 1):
            from itertools import combinations

            flips += [sum(1 << b for b in c) for c in combinations(bits, d)]
        masks.append((_U64(sum(1 << b for b in bits)), np.array(flips, np.uint64)))
    for b in batches:
        fp = b.column(0).to_numpy().view(np.uint64)
        for part, (mask, flips) in enumerate(masks):
            step = max(1, 200_000 // len(flips))
            for i in range(0, len(fp), step):
                own = fp[i : i + step]
                value = ((own & mask)[:, None] ^ flips[None, :]).ravel()
                who = np.repeat(own, len(flips))
                home = np.tile(np.arange(len(flips)) == 0, len(own))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(who), part, np.int32)), pa.array(value.view(np.int64)), pa.array(who.view(np.int64)), pa.array(home)], names=["part", "value", "fp", "home"])


def spanning_links(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs within ``radius``: each cluster grows from its seed until nothing is near."""
    rest, a, b = np.unique(fp), [], []
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            took = np.zeros(len(rest), bool)
            for x in front:
                near = ~took
                near[near] = np.bitwise_count(rest[near] ^ x) <= radius
                if near.any():
                    a.append(np.full(int(near.sum()), x, np.uint64))
                    b.append(rest[near])
                    took |= near
                    if took.all():
                        break
            front, rest = rest[took], rest[~took]
    none = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _linker(radius: int):
    def link(batches):
        """Rows come sorted by place; a place's rows may run over several batches."""
        held, open_key = [], None

        def flush(keys, fp):
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1 if len(keys) else np.zeros(0, int)
            bounds = np.concatenate([[0], cut, [len(fp)]])
            sizes = np.diff(bounds)
            a, b = [], []
            group = np.repeat(np.arange(len(sizes)), sizes)
            small = sizes <= 12
            for d in range(1, 12):  # small places: all pairs, at once
                i = np.flatnonzero((group[:-d] == group[d:]) & small[group[:-d]]) if len(group) > d else np.zeros(0, int)
                if not len(i):
                    break
                i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= radius]
                a.append(fp[i])
                b.append(fp[i + d])
            for g in np.flatnonzero(~small):
                x, y = spanning_links(fp[bounds[g] : bounds[g + 1]], radius)
                a.append(x)
                b.append(y)
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                return pa.RecordBatch.from_arrays([pa.array(x[x != y].view(np.int64)), pa.array(y[x != y].view(np.int64))], schema=_LINKS)

        for batch in batches:
            keys = np.column_stack([batch.column(n).to_numpy() for n in ("part", "value", "x", "y")]).astype(np.int64)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if not len(fp):
                continue
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                if out := flush(np.concatenate([*(k for k, _ in held), keys[:cut]]), np.concatenate([*(f for _, f in held), fp[:cut]])):
                    yield out
                held = []
            held.append((keys[cut:], fp[cut:]))
        if held and (out := flush(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))):
            yield out

    return link


def near_links(nodes: DataFrame, radius: int = RADIUS, place_rows: int = PLACE_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect whatever lies within ``radius``.

    ``nodes``: one row for each fingerprint, column fp, with its lineage cut.
    """
    plan = allocate(*bit_counts(nodes), radius)
    places = nodes.select("fp").mapInArrow(lambda batches: _places(plan, batches), "part int, value bigint, fp bigint, home boolean")
    counts = places.groupBy("part", "value").agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).filter("n > 1 and homes > 0")
    met = places.join(counts, ["part", "value"]).withColumn("blocks", F.ceil(F.col("n") / place_rows).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("x"), F.greatest("own", k).alias("y")))
    met = met.withColumn("own", own).select("part", "value", "fp", F.explode(pairs).alias("p")).select("part", "value", "p.x", "p.y", "fp")
    key = ["part", "value", "x", "y"]
    return met.repartition(*key).sortWithinPartitions(*key).mapInArrow(_linker(radius), "a bigint, b bigint")


def components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, ver (Spark's xxhash64 of the text), fp (signed bigint), root (a fingerprint that names
    the component) and component_id (smallest doc_id reachable) for every row."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("ver", F.xxhash64(F.coalesce("text", F.lit(""))))
    docs = checkpointed(fingerprints(rows, "text", shingle))
    nodes = checkpointed(docs.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = connected_components(near_links(nodes, radius))
    nodes = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = nodes.groupBy("root").agg(F.min("rep").alias("component_id"))
    nodes = checkpointed(nodes.join(names, "root").select("fp", "root", "component_id"))
    return docs.join(nodes, "fp").select("doc_id", "ver", "fp", "root", "component_id")


def keep_first(df: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each root in ``found`` (doc_id, ver, root) stays: that with the smallest doc_id; columns as before.

    Rows without an id stay only if nothing in their component has one; then, as among
    rows of one id, the text with the smallest hash stays.
    """
    rows, key = row_key(df, doc_id, text)
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("ver").alias("v"))).alias("k")
    kept = found.groupBy("root").agg(smallest)
    kept = kept.select(F.col("k.n").alias(key[0]), F.coalesce(F.col("k.d").cast("string"), F.lit("")).alias(key[1]), F.col("k.v").alias(key[2]))
    return rows.join(kept, key, "left_semi").dropDuplicates(key).select(*df.columns)


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component stays, as ``keep_first`` says; columns as before."""
    return keep_first(df, components(df, doc_id, text, radius, shingle), doc_id, text)


def query(spark, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
