"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text's features are its hashed words (square root of their share), structure
statistics (shares of symbols, capitals, digits, repeats, line shapes ...) and metadata
(stated against true length), the latter two cut into bins. The machine adds to a linear score
every pair of features through rank-``RANK`` factors; by the sum-of-squares identity
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)
that takes time linear in the features. It is fitted by AdaGrad on at most
``sample_rows`` labelled rows, taken in the order of a hash of the id; scoring goes over
every text, whole, in tasks that hold the model (a table of fixed size).

Defined results: null and empty texts have no words; their bins score them. Without
labels, or with one class, every score is the share of good labels (0.5 without labels).
Repeated rows are scored each; in learning, a document counts once for each distinct label
it has. A null n_chars has a bin of its own. Extra columns pass
through ``score_texts``; ``score`` of the input is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from quarrystone.llm._base import NOT_SPACE, held_out, table, text_bytes, text_slices, word_hashes, word_spans
from quarrystone.llm.toxicity import labelled_sample

SAMPLE_ROWS = 10_000
HASH_BITS, RANK, BINS = 15, 8, 16
STATS = ["words", "word_length", "symbols", "upper", "digits", "stops", "pipes", "shouts", "wide", "lines", "line_length", "distinct", "repeats", "dup_lines", "short_lines", "stated"]
_WORD_SLOTS = 1 << HASH_BITS
_SLOTS = _WORD_SLOTS + len(STATS) * BINS


def _members(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_CLASSES = {
    "symbols": _members("#*$%&|<>~^=+_\\{}[]@"), "upper": _members("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _members("0123456789"),
    "stops": _members(".,;:?"), "pipes": _members("|"), "shouts": _members("!"),
}
_WIDE = np.arange(256) >= 0x80


def read_features(text: pa.Array, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of all rows one after another, and each row's offsets."""
    data, offsets = text_bytes(text)
    starts, ends, at = word_spans(data, offsets, NOT_SPACE)
    rows = len(offsets) - 1
    size = np.diff(offsets)
    points = np.diff(np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets])  # characters
    h = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(rows), np.diff(at))
    n = np.diff(at)
    share = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask[data])])[offsets]) / np.maximum(size, 1)
    # distinct words of each row with their counts
    order = np.lexsort((h, row))
    hs, rs = h[order], row[order]
    new = np.ones(len(hs), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(hs)]]))
    word_row, slot = rs[first], (hs[first] >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    distinct = np.bincount(word_row, minlength=rows)
    follows = np.zeros(len(h), bool)
    if len(h) > 1:
        follows[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    # lines
    breaks = np.flatnonzero(data == 10)
    line_starts = np.unique(np.concatenate([offsets[:-1][size > 0], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    line_ends = np.concatenate([line_starts[1:], [len(data)]]) if len(line_starts) else line_starts
    line_ends = np.minimum(line_ends, offsets[1:][line_row]) if len(line_starts) else line_starts
    lines = np.bincount(line_row, minlength=rows)
    line_hash = word_hashes(data, line_starts, line_ends) if len(line_starts) else np.zeros(0, np.uint64)
    pairs = np.unique(np.column_stack([line_row.astype(np.uint64), line_hash]), axis=0) if len(line_starts) else np.zeros((0, 2), np.uint64)
    stats = {k: share(m) for k, m in _CLASSES.items()} | {
        "words": np.log1p(n) / 12, "word_length": np.bincount(row, ends - starts, minlength=rows) / np.maximum(n, 1) / 24, "wide": share(_WIDE),
        "lines": np.log1p(lines) / 8, "line_length": np.log1p(size / np.maximum(lines, 1)) / 10, "distinct": distinct / np.maximum(n, 1),
        "repeats": np.bincount(row, follows, minlength=rows) / np.maximum(n, 1), "dup_lines": 1 - np.bincount(pairs[:, 0].astype(np.int64), minlength=rows) / np.maximum(lines, 1),
        "short_lines": np.bincount(line_row, (line_ends - line_starts) < 30, minlength=rows) / np.maximum(lines, 1),
        "stated": np.where(np.isnan(stated), 1, np.clip(np.abs(stated - points) / np.maximum(points, 1), 0, 0.9)),
    }
    table_ = np.column_stack([np.clip(stats[k], 0, 1) for k in STATS])
    small = np.isin(STATS, ["symbols", "upper", "digits", "stops", "pipes", "shouts", "wide", "repeats", "dup_lines"])
    binned = np.minimum(np.where(small, np.sqrt(table_), table_) * BINS, BINS - 1).astype(np.int64)
    stat_slot = _WORD_SLOTS + np.arange(len(STATS)) * BINS + binned
    all_row = np.concatenate([word_row, np.repeat(np.arange(rows), len(STATS))])
    all_slot = np.concatenate([slot, stat_slot.ravel()])
    all_value = np.concatenate([np.sqrt(count / np.maximum(n, 1)[word_row]), np.full(rows * len(STATS), 1 / np.sqrt(len(STATS)))])
    order = np.argsort(all_row, kind="stable")
    return all_slot[order], all_value[order], np.concatenate([[0], np.cumsum(distinct + len(STATS))])


@dataclass
class Machine:
    bias: float
    linear: np.ndarray  # slots
    factors: np.ndarray  # slots x rank

    def raw(self, slot: np.ndarray, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The score of each row before the logistic curve; every row has features."""
        if len(at) < 2:
            return np.zeros(0)
        vx = self.factors[slot] * value[:, None]
        s = np.add.reduceat(vx, at[:-1], axis=0)
        q = np.add.reduceat((vx * vx).sum(axis=1), at[:-1])
        return self.bias + np.add.reduceat(self.linear[slot] * value, at[:-1]) + 0.5 * ((s * s).sum(axis=1) - q)

    def probability(self, slot, value, at) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(slot, value, at), -30, 30)))


def fit(slot: np.ndarray, value: np.ndarray, at: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.1, decay: float = 1e-5, seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss. Words seen in the sample are learned; unseen slots stay 0."""
    share = min(max(float(y.mean()) if len(y) else 0.5, 1e-9), 1 - 1e-9)
    m = Machine(float(np.log(share / (1 - share))), np.zeros(_SLOTS), np.zeros((_SLOTS, RANK)))
    if not len(y) or share < 1e-6 or share > 1 - 1e-6:
        return m
    rng = np.random.default_rng(seed)
    used = np.unique(slot)
    m.factors[used] = rng.normal(0, 0.05, (len(used), RANK))
    g0, gw, gv = 1e-8, np.full(_SLOTS, 1e-8), np.full((_SLOTS, RANK), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            n = at[rows + 1] - at[rows]
            take = np.repeat(at[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            s, x = slot[take], value[take]
            starts = np.cumsum(n) - n
            vx = m.factors[s] * x[:, None]
            sums = np.add.reduceat(vx, starts, axis=0)
            z = m.bias + np.add.reduceat(m.linear[s] * x, starts) + 0.5 * ((sums * sums).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), starts))
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
            each = np.repeat(e, n) * x
            gradient = each[:, None] * (np.repeat(sums, n, axis=0) - vx)
            u, inverse = np.unique(s, return_inverse=True)
            dw = np.bincount(inverse, each) + decay * m.linear[u]
            dv = np.column_stack([np.bincount(inverse, gradient[:, f]) for f in range(RANK)]) + decay * m.factors[u]
            gw[u] += dw * dw
            gv[u] += dv * dv
            g0 += e.sum() ** 2
            m.linear[u] -= rate * dw / np.sqrt(gw[u])
            m.factors[u] -= 0.2 * rate * dv / np.sqrt(gv[u])
            m.bias -= rate * e.sum() / np.sqrt(g0)
    return m


def _stated(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False)


def learn(sample: DataFrame) -> Machine:
    """Fit on rows (text, n_chars, y); the sample's features go to the driver."""

    def features(batches):
        for whole in batches:
            for b in text_slices([whole], "text"):
                slot, value, at = read_features(b.column("text"), _stated(b))
                lists = lambda x, t: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(x, t))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), lists(slot, pa.int32()), lists(value, pa.float32())], names=["doc_id", "y", "slot", "value"])

    schema = StructType([sample.schema["doc_id"], *StructType.fromDDL("y int, slot array<int>, value array<float>")])
    found = sample.mapInArrow(features, schema).toArrow().combine_chunks().sort_by([("doc_id", "ascending"), ("y", "ascending")])  # sample_rows rows
    if not found.num_rows:
        return fit(np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64), np.zeros(0))
    slots, values = found.column("slot").combine_chunks(), found.column("value").combine_chunks()
    at = slots.offsets.to_numpy().astype(np.int64)
    return fit(slots.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(float), at - at[0], found.column("y").to_numpy().astype(float))


def score_texts(df: DataFrame, machine: Machine, text: str = "text", keep_text: bool = True) -> DataFrame:
    """df with ``score``, the probability of the good label; needs n_chars, or takes it as unstated."""
    df = df.drop("score")
    fields = [f for f in df.schema.fields if keep_text or f.name != text]
    names = [f.name for f in fields]
    if "n_chars" not in df.columns:
        df = df.withColumn("n_chars", F.lit(None).cast("bigint"))
    shared = df.sparkSession.sparkContext.broadcast(machine)  # fixed size

    def run(batches):
        machine = shared.value
        for whole in batches:
            for b in text_slices([whole], text):
                score = machine.probability(*read_features(b.column(text), _stated(b)))
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(score, pa.float64())], names=[*names, "score"])

    return df.mapInArrow(run, type(df.schema)([*fields]).add("score", "double"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 3, 1)
    sample = labelled_sample(docs, table(spark, sf_dir, "labels"), "quality", ~out, SAMPLE_ROWS, "n_chars")
    scored = score_texts(docs.select("doc_id", "text", "n_chars"), learn(sample), keep_text=False)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
