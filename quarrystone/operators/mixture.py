"""Gaussian mixtures by expectation and maximisation over blocks of rows.

Equal rows are counted and packed once into blocks of numbers, which are checkpointed; a round is one pass over
the blocks, whose sums (a few numbers for each task) are put together on the driver. The start,
the floor of a row's weights and the end of the rounds are those of MLlib's GaussianMixture,
which gives the start itself; its rounds handle one row at a time and so take about ten times as long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from quarrystone.functions.session import checkpointed

MAX_ITER, TOLERANCE = 100, 0.01
_EPS = float(np.finfo(float).eps)
#: Numbers of a block; rows within a task are worked on block by block.
BLOCK_NUMBERS = 1 << 16


def _blocks(df: DataFrame, column: str) -> DataFrame:
    """(width, x, n): the distinct rows of the vectors in ``column``, packed, and how many rows each stands for."""

    def pack(batches):
        for b in batches:
            v, n = b.column(0), b.column(1).to_numpy().astype(float)
            if not len(v):
                continue
            x = v.flatten().to_numpy(zero_copy_only=False)
            width = len(x) // len(v)
            step = max(1, BLOCK_NUMBERS // max(width, 1))
            for i in range(0, len(v), step):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([width], pa.int32()), pa.array([x[i * width : (i + step) * width].tobytes()], pa.binary()), pa.array([n[i : i + step].tobytes()], pa.binary())], names=["width", "x", "n"]
                )

    parts = df.sparkSession.sparkContext.defaultParallelism
    rows = df.select(vector_to_array(column).alias("v")).groupBy("v").agg(F.count("*").alias("n"))
    # few rows would end in one partition, and every round in one task
    return rows.repartition(max(parts, df.rdd.getNumPartitions()), "v").mapInArrow(pack, "width int, x binary, n binary")


def log_terms(x: np.ndarray, parts: list[tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log density of each row (a column of ``x``) under each (weight, mean, covariance), without the weight; a covariance without full rank by its pseudo-inverse."""
    out = np.empty((len(parts), x.shape[1]))
    for k, (_, mean, cov) in enumerate(parts):
        values, axes = np.linalg.eigh(cov)
        full = values > _EPS * values.max() * len(mean)
        d = (axes[:, full] / np.sqrt(values[full])).T @ (x - mean[:, None])
        d *= d
        out[k] = -0.5 * (len(mean) * np.log(2 * np.pi) + np.log(values[full]).sum() + d.sum(axis=0))
    return out


def sums(x: np.ndarray, n: np.ndarray, parts: list[tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log likelihood, rows, and for each component the weights, weighted rows and weighted products of the rows, which are the columns of ``x``, each there ``n`` times."""
    r = np.exp(log_terms(x, parts))
    r *= np.array([w for w, _, _ in parts])[:, None]
    r += _EPS
    total = r.sum(axis=0)
    r *= n / total
    return np.concatenate([[np.log(total) @ n, n.sum()], r.sum(axis=1), (r @ x.T).ravel(), *(((x * one) @ x.T).ravel() for one in r)])


def _round(blocks: DataFrame, parts) -> np.ndarray:
    def task(batches):
        got = None
        for b in batches:
            for width, raw, n in zip(b.column("width").to_pylist(), b.column("x"), b.column("n")):
                one = sums(np.ascontiguousarray(np.frombuffer(raw.as_py()).reshape(-1, width).T), np.frombuffer(n.as_py()), parts)
                got = one if got is None else got + one
        if got is not None:
            yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()], pa.binary())], names=["s"])

    return np.sum([np.frombuffer(r["s"]) for r in blocks.mapInArrow(task, "s binary").collect()], axis=0)  # one row a task


def fit(df: DataFrame, column: str, k: int, seed: int = 7) -> tuple[list[tuple[float, np.ndarray, np.ndarray]], float, int]:
    """(weight, mean, covariance) of each of k components of the vectors in ``column``, the log likelihood before the last round, and the number of rounds."""
    df = df.select(column)
    start = GaussianMixture(k=k, seed=seed, featuresCol=column, maxIter=0).fit(df)
    parts = [(w, g["mean"].toArray(), g["cov"].toArray()) for w, g in zip(start.weights, start.gaussiansDF.collect())]  # k rows
    blocks, d = checkpointed(_blocks(df, column)), len(parts[0][1])
    last, now, n = float("-inf"), 0.0, 0
    while n < MAX_ITER and abs(now - last) > TOLERANCE:
        s = _round(blocks, parts)
        last, now, n = now, float(s[0]), n + 1
        weight, means, products = s[2 : 2 + k], s[2 + k : 2 + k + k * d].reshape(k, d), s[2 + k + k * d :].reshape(k, d, d)
        parts = []
        for w, m, p in zip(weight, means, products):
            mean = m / w
            parts.append((float(w / weight.sum()), mean, p / w - np.outer(mean, mean)))
    return parts, now, n
