"""Boosted trees and forests on counted rows.

Trees see a number by at most BINS intervals, as MLlib's do, and a category by its code. Rows of equal
intervals and codes are alike to them, so they are counted once, with the sums of what is predicted, and
MLlib fits the counts as weights: the same sums decide a split, whatever the number of rows behind them.
Forests draw rows with replacement, for which a weight is no substitute, so they are grown here (``folds``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, functions as F

from quarrystone.functions.session import checkpointed
from quarrystone.operators import folds
from quarrystone.operators.folds import BINS, FOREST_DEPTH, SEED, TREES, Trees
from quarrystone.operators.order import running


def cut_points(df: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """At most BINS - 1 cuts of each numeric column: between all values where those are few, or else where another share of the rows is full."""
    if not columns:
        return {}
    names = [f"_{i}" for i in range(len(columns))]
    long = df.select(*(F.col(c).cast("double").alias(n) for c, n in zip(columns, names))).unpivot([], names, "c", "v").filter("v IS NOT NULL AND NOT isnan(v)")
    rows = running(long.groupBy("c", "v").agg(F.count("*").alias("n"), F.lit(1).cast("bigint").alias("one")), ["c"], "v", ["n", "one"])
    full = F.floor(F.col("cum_n") * BINS / F.col("all_n")) > F.floor((F.col("cum_n") - F.col("n")) * BINS / F.col("all_n"))
    cuts = rows.filter(F.col("next").isNotNull() & ((F.col("all_one") <= BINS) | full)).select("c", ((F.col("v") + F.col("next")) / 2).alias("cut")).collect()  # BINS a column
    return {c: sorted({r["cut"] for r in cuts if r["c"] == n}) for c, n in zip(columns, names)}


def interval(df: DataFrame, column: str, name: str, cuts: list[float]) -> DataFrame:
    """df with ``name``, the number of the interval between ``cuts`` that a number lies in; one more for a null or NaN."""
    inf = float("inf")
    # a column without cuts has one interval, which Bucketizer doesn't allow
    splits = [-inf, *cuts, inf] if cuts else [-inf, 0.0, inf]
    out = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)
    none = F.lit(float(len(splits) - 1))
    return out.withColumn(name, F.coalesce(F.col(name) if cuts else F.when(F.col(name) == none, none).when(F.col(name).isNotNull(), 0.0), none))


def assembled(df: DataFrame, inputs: list[str], attributes: dict) -> DataFrame:
    """df with _x, the vector of ``inputs``; ``attributes`` are the metadata of those that are codes of categories."""
    for c in inputs:
        if c in attributes:
            df = df.withMetadata(c, attributes[c])
    return VectorAssembler(inputCols=inputs, outputCol="_x").transform(df)


def fit(cells: DataFrame, inputs: list[str], attributes: dict, classes: int | None, n: str = "n"):
    """Boosted trees of _y on ``inputs``: a number, or one of ``classes`` codes. Rows weigh ``n``; a row's _y is a number's mean there."""
    parts = cells.sparkSession.sparkContext.defaultParallelism
    x = assembled(cells, inputs, attributes).select("_x", "_y", F.col(n).cast("double").alias("_w")).coalesce(parts).persist()  # the shuffle's own partitions would be visited by each of many jobs
    most = max([BINS + 2, *(len(attributes[c]["ml_attr"].get("vals", [])) + 1 for c in inputs if c in attributes)])
    how = {"labelCol": "_y", "featuresCol": "_x", "predictionCol": "_p", "weightCol": "_w"}
    trees = {"maxIter": 10, "maxDepth": 4, "maxBins": most, "seed": 7}
    if classes is None:
        model = GBTRegressor(**how, **trees)
    elif classes == 2:
        model = GBTClassifier(**how, **trees)
    else:
        model = OneVsRest(classifier=GBTClassifier(**trees), parallelism=4, **how)
    try:
        return model.fit(x)
    finally:
        x.unpersist()


def kind_cells(rows: DataFrame, columns: list[str], cuts: dict[str, list[float]], kinds: int) -> tuple[DataFrame, folds.Shape]:
    """(number, bins, counts), blocks of distinct rows of intervals with the number of rows of each ``kind`` (a whole number below ``kinds``), and their shape."""
    shape, names = folds.Shape(len(columns), 1, -(-kinds // 2)), [f"_{i}" for i in range(len(columns))]
    for c, n in zip(columns, names):
        rows = interval(rows, c, n, cuts[c])
    counts = rows.groupBy(*(F.col(n).cast("tinyint").alias(n) for n in names), F.col("kind").cast("int").alias("kind")).agg(F.count("*").alias("n"))
    cells = counts.groupBy(*names).agg(F.collect_list(F.struct("kind", "n")).alias("of"))
    parts = rows.sparkSession.sparkContext.defaultParallelism

    def dense(batches):
        from pyspark import TaskContext

        for j, b in enumerate(batches):
            if b.num_rows:
                lists = b.column("of")
                at, of = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy()), lists.flatten()
                counts = np.zeros((b.num_rows, 2 * shape.folds))
                counts[at, of.field("kind").to_numpy()] = of.field("n").to_numpy()
                bins = np.stack([b.column(n).to_numpy().astype(np.uint8) for n in names], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([(TaskContext.get().partitionId() << 32) + j]), pa.array([bins.tobytes()], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["number", "bins", "counts"])

    dealt = cells.repartition(parts, *names).sortWithinPartitions(*names)
    return checkpointed(dealt.mapInArrow(dense, "number bigint, bins binary, counts binary")), shape


def forest(cells: DataFrame, shape: folds.Shape, member: np.ndarray, label: np.ndarray, labels: int) -> Trees:
    """TREES trees a set (tree * sets + set), each of the set's rows drawn with replacement; a node looks at the root of the columns' number of them, and Gini impurity decides.

    ``member`` (set, kind) says which kinds of rows a set has, ``label`` the label of each kind.
    """
    sets, kinds, d = *member.shape, shape.columns
    trees, rng = Trees.of(TREES * sets, FOREST_DEPTH, labels), np.random.default_rng(SEED)
    columns = rng.random((TREES * sets, trees.feature.shape[1], d)).argsort(axis=2)[..., : int(np.ceil(np.sqrt(d)))]
    into = np.eye(labels)[label]

    def weights(number, bins, counts):
        counts = counts.reshape(len(counts), -1)[:, :kinds]
        some = counts.nonzero()
        for t in range(TREES):
            drawn = np.zeros(counts.shape)
            drawn[some] = np.random.default_rng([SEED, t, number]).poisson(counts[some])
            for s in range(sets):
                yield t * sets + s, (drawn * member[s]) @ into

    def score(sums):
        n = sums.sum(axis=-1)
        return np.where(n > 0, (sums**2).sum(axis=-1) / np.maximum(n, 1e-300), 0)

    folds._grow(cells, shape, trees, FOREST_DEPTH, labels, columns, weights, score, lambda sums: sums / max(sums.sum(), 1e-300))
    return trees


def said(trees: Trees, sets: int, s: int, bins: np.ndarray) -> np.ndarray:
    """The label that the forest of a set gives each row of intervals (column, row)."""
    return sum(trees.value[t, trees.reached(t, bins, FOREST_DEPTH)] for t in range(s, TREES * sets, sets)).argmax(axis=1)
