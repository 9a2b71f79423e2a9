"""Near-duplicates by the Jaccard similarity of word shingles: MinHash bands find pairs, whole shingle sets decide.

Two texts link if their sets of SHINGLE-word shingles have a Jaccard similarity of
SIMILARITY or more; components of links are the groups. Equal sets are one node, so
exact copies cost one grouping. Each node goes to a place for each of BANDS bands of
ROWS minima; a pair of similarity J shares a place with probability 1 - (1 - J^ROWS)^BANDS,
which is 0.99997 at J = 0.8 and rises with J. This is the only loss: whoever meets is
held against the whole sets (64-bit hashes of shingles).

Places with the same nodes are one place. Within a place only a spanning forest of the
true links is put out. Places whose sets have over PLACE_BYTES are cut into blocks that
meet pairwise, so that no task holds more than two blocks.

The pipeline's near-duplicate stage finds pairs by op2's fingerprints first, which reach
those of few differing bits only, and by bands the rest: at a Jaccard similarity of 0.8 two
64-bit fingerprints differ in some ten bits, and no allotment of thresholds over 64 bits
finds such pairs without comparing most of all others. The sets decide on both.

Words are longest runs without ASCII white space, A-Z lowered. A text of fewer words
than a shingle is one shingle; null texts, empty texts and texts without words are copies
of each other. Which document stays and what happens to null ids, repeated rows and extra
columns is as ``simhash.keep_first`` says; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType

from quarrystone.llm import simhash
from quarrystone.llm._base import ASCII_LOWER, NOT_SPACE, TEXT_ROWS, _powers, checkpointed, text_bytes, text_slices, window_hashes, word_hashes, word_spans
from quarrystone.llm.components import connected_components
from quarrystone.llm.simhash import keep_first

SHINGLE, BANDS, ROWS = 5, 20, 4
#: The similarity as a fraction, so that the comparison is exact.
SIMILARITY = (4, 5)
PLACE_BYTES = 8 << 20
_RNG = np.random.default_rng(42)
_FLIP = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_MULTIPLY = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def shingle_sets(text: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Each row's distinct shingle hashes, sorted."""
    data, offsets = text_bytes(text)
    data = ASCII_LOWER[data]
    starts, ends, at = word_spans(data, offsets, NOT_SPACE)
    words = word_hashes(data, starts, ends)
    windows = window_hashes(words, shingle)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        out.append(np.unique(windows[a : b - shingle + 1] if b - a >= shingle else window_hashes(words[a:b], b - a) if b > a else windows[:0]))
    return out


def band_values(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS values for each of the sets, none of which may be empty."""
    hashes = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    minima = np.empty((BANDS * ROWS, len(sets)), np.uint64)
    for i, (flip, by) in enumerate(zip(_FLIP, _MULTIPLY)):
        minima[i] = np.minimum.reduceat((hashes ^ flip) * by, starts)
    minima ^= minima >> np.uint64(29)
    return (minima.reshape(BANDS, ROWS, -1) * _powers(ROWS)[None, :, None]).sum(axis=1, dtype=np.uint64).T


def signatures(rows: DataFrame, fingerprint: bool = False) -> DataFrame:
    """rows without text but with node (a hash of the shingle set) and its band values (none for an empty set).

    ``fingerprint`` adds fp, as ``simhash.fingerprints`` has it, in the same pass: a pass of its own would hold
    the texts in a second Python worker beside this one.
    """
    keep = [f for f in rows.schema.fields if f.name != "text"]
    schema = type(rows.schema)([*keep]).add("node", "long").add("bands", ArrayType(LongType()))
    schema = schema.add("fp", "long") if fingerprint else schema

    def compute(batches):
        for whole in batches:
            for b in text_slices([whole], "text"):
                sets = shingle_sets(b.column("text"))
                node = np.array([xxhash.xxh64_intdigest(s.tobytes(), 42) for s in sets], np.uint64)
                full = [s for s in sets if len(s)]
                values = band_values(full).ravel() if full else np.zeros(0, np.uint64)
                ends = np.cumsum([0] + [BANDS * (len(s) > 0) for s in sets])
                bands = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))
                more = [pa.array(simhash._fingerprints(b.column("text"), simhash.SHINGLE).view(np.int64))] if fingerprint else []
                yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), pa.array(node.view(np.int64)), bands, *more], names=schema.names)

    return rows.select(*[f.name for f in keep], "text").mapInArrow(compute, schema)


def _sets(batches):
    for whole in batches:
        for b in text_slices([whole], "text"):
            found = [s.tobytes() for s in shingle_sets(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([len(s) for s in found], pa.int64()), pa.array(found, pa.binary())], names=["node", "bytes", "shingles"])


def spanning_links(node: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the pairs at SIMILARITY or more: each cluster grows from its seed until nothing is near."""
    p, q = SIMILARITY
    sizes = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(int(ids.max()) + 1, bool)
    rest, links = np.arange(len(sets)), []
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            close = (q * sizes[rest] >= p * sizes[x]) & (q * sizes[x] >= p * sizes[rest])
            who = rest[close]
            if not len(who):
                continue
            mark[ids[starts[x] : starts[x] + sizes[x]]] = True
            runs = np.cumsum(sizes[who]) - sizes[who]
            at = np.arange(int(sizes[who].sum())) + np.repeat(starts[who] - runs, sizes[who])
            both = np.add.reduceat(mark[ids[at]].astype(np.int64), runs)
            mark[ids[starts[x] : starts[x] + sizes[x]]] = False
            near = who[q * both >= p * (sizes[x] + sizes[who] - both)]
            links += [(node[x], node[y]) for y in near.tolist()]
            front += near.tolist()
            rest = rest[~np.isin(rest, near)]
    return links


def _link(batches):
    """Rows come sorted by place; a place's rows may run over several batches."""
    key, node, sets = None, [], []
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def flush():
        links = spanning_links(node, sets) if len(node) > 1 else []
        return [pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], schema=schema)] if links else []

    for b in batches:
        keys = zip(*(b.column(c).to_pylist() for c in ("band", "value", "x", "y")))
        for k, n, s in zip(keys, b.column("node").to_pylist(), b.column("shingles")):
            if k != key:
                yield from flush()
                key, node, sets = k, [], []
            node.append(n)
            sets.append(np.frombuffer(s.as_py(), np.uint64))
    yield from flush()


def near_links(nodes: DataFrame, texts: DataFrame, place_bytes: int = PLACE_BYTES, more: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) between nodes that connect whatever meets in a band and is similar.

    ``nodes``: node, ver and bands, one row for each node; ``texts``: ver and text. Both with their lineage cut.
    ``more`` (node, band, value): further places, of bands beyond BANDS - 1.
    """
    place = ["band", "value"]
    placed = nodes.select("node", F.posexplode("bands").alias(*place))
    placed = placed if more is None else placed.unionByName(more)
    counts = placed.groupBy(*place).agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"), F.min("node").alias("low")
    ).filter("n > 1")
    once = counts.groupBy("n", "x", "y", "low").agg(F.min(F.struct(*place)).alias("p")).select("p.*")
    met = checkpointed(placed.join(once, place))
    asked = nodes.select("node", "ver").join(met.select("node").distinct(), "node")
    sets = texts.join(asked, "ver").select("node", "text").dropDuplicates(["node"])
    sets = checkpointed(sets.mapInArrow(_sets, "node bigint, bytes bigint, shingles binary"), TEXT_ROWS)
    met = met.join(sets.select("node", "bytes"), "node")
    blocks = met.groupBy(*place).agg(F.ceil(F.sum("bytes") / place_bytes).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("own", k).alias("x"), F.greatest("own", k).alias("y")))
    met = met.join(blocks, place).withColumn("own", own).select(*place, "node", F.explode(pairs).alias("p")).select(*place, "p.x", "p.y", "node")
    key = [*place, "x", "y"]
    return met.join(sets.select("node", "shingles"), "node").repartition(*key).sortWithinPartitions(*key).mapInArrow(_link, "a bigint, b bigint")


def components(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int | None = None) -> DataFrame:
    """doc_id, ver (Spark's xxhash64 of the text) and root (a node that names the component) for every row.

    With a ``radius``, pairs whose fingerprints differ in that many bits or fewer, as ``simhash.near_links`` finds them, are
    held against the whole sets beside those that bands bring together. Texts pass once through both.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("ver", F.xxhash64(F.coalesce("text", F.lit(""))))
    docs = checkpointed(signatures(rows, radius is not None), TEXT_ROWS)
    nodes = checkpointed(docs.groupBy("node").agg(F.min("ver").alias("ver"), F.first("bands").alias("bands")))
    more = None if radius is None else fingerprint_places(docs, radius)
    roots = connected_components(near_links(nodes, rows.select("ver", "text"), more=more))
    return docs.join(roots, "node", "left").select("doc_id", "ver", F.coalesce("root", "node").alias("root"))


def fingerprint_places(docs: DataFrame, radius: int = simhash.RADIUS) -> DataFrame:
    """(node, band, value): a place for each link between nodes of one fingerprint, and of fingerprints within ``radius``.

    ``docs``: node and fp, with their lineage cut. Nodes without shingles link by being equal, and have no place.
    """
    held = docs.filter(F.size("bands") > 0).select("node", "fp").distinct()
    prints = checkpointed(held.groupBy("fp").agg(F.min("node").alias("low")))
    same = held.join(prints, "fp").filter("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b"))
    end = lambda name: prints.select(F.col("fp").alias(name), F.col("low").alias(f"_{name}"))
    near = simhash.near_links(prints.select("fp"), radius).join(end("a"), "a").join(end("b"), "b")
    near = near.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
    pairs = checkpointed(same.unionByName(near).distinct())
    return pairs.select(F.explode(F.array("a", "b")).alias("node"), F.lit(BANDS).alias("band"), F.xxhash64("a", "b").alias("value"))


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int | None = None) -> DataFrame:
    """One document of each component stays, as ``simhash.keep_first`` says; columns as before."""
    return keep_first(df, components(df, doc_id, text, radius), doc_id, text)
