"""Linear, hinge, forest and boosted models of all training sets of a cross-validation at once.

A training set is one side's rows but for a fold; there are two sides. Fitted one by one, each model
starts a job for each of its rounds. Here a round of all models is one pass over the rows, whose
sums come together in a shuffle or, where they are a few numbers, on the driver. Linear and hinge models go
by L-BFGS over blocks of rows, packed once. Trees see a column by at most BINS intervals, as MLlib's
do; rows of equal intervals are counted, so where columns are few, their number doesn't grow with the input.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarrystone.functions.session import checkpointed
from quarrystone.operators.order import running

#: MLlib's defaults, or what ``learned.learner`` sets.
BINS, ROUNDS, TOLERANCE = 32, 20, 1e-6
TREES, FOREST_DEPTH, BOOSTS, BOOST_DEPTH, RATE, SEED = 20, 5, 10, 4, 0.1, 7


@dataclass
class Shape:
    """Numbers of columns, labels and folds. A set (side, fold) holds the side's rows of all other folds."""

    columns: int
    labels: int
    folds: int

    @property
    def classes(self) -> int:
        """Models of one class against the rest: one is enough for two labels."""
        return 1 if self.labels == 2 else self.labels


def _sum(blocks: DataFrame, one) -> np.ndarray:
    """The sum of ``one(columns of a block)`` over all blocks; a row of a few numbers for each task goes to the driver."""

    def task(batches):
        total = None
        for b in batches:
            for row in zip(*b.columns):
                got = one(*(x.as_py() for x in row))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    return np.sum([np.frombuffer(r["s"]) for r in blocks.mapInArrow(task, "s binary").collect()], axis=0)


def pack(rows: DataFrame, shape: Shape) -> DataFrame:
    """(side, code, x): blocks of a side's rows; ``rows`` has side, code (label * folds + fold) and the columns c0, c1, ... as doubles."""

    def task(batches):
        for b in batches:
            side, code = b.column("side").to_numpy(), b.column("code").to_numpy()
            x = np.stack([b.column(f"c{i}").to_numpy() for i in range(shape.columns)])
            for s in (0, 1):
                at = side == s
                if at.any():
                    yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([code[at].tobytes()], pa.binary()), pa.array([x[:, at].tobytes()], pa.binary())], names=["side", "code", "x"])

    return rows.mapInArrow(task, "side int, code binary, x binary")


def _rows(shape: Shape, code: bytes, x: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    code = np.frombuffer(code, np.int32)
    return code // shape.folds, code % shape.folds, np.frombuffer(x).reshape(shape.columns, -1)


def lbfgs(x: np.ndarray, rounds: int = ROUNDS, memory: int = 10):
    """Yields points, is sent (value, gradient) there, and returns the least it found: steps are halved or doubled until both Wolfe conditions hold."""
    f, g = yield x
    steps: list = []
    for _ in range(rounds):
        q, parts = g.copy(), []
        for s, y in reversed(steps):
            parts.append((s @ q) / (s @ y))
            q -= parts[-1] * y
        if steps:
            s, y = steps[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(parts)):
            q += s * (a - (y @ q) / (s @ y))
        slope = -(g @ q)
        if not slope < 0:
            break
        t, low, high = 1.0 if steps else min(1.0, 1 / np.sqrt(g @ g)), 0.0, np.inf
        for _ in range(20):
            s = -t * q
            f1, g1 = yield x + s
            if not f1 <= f + 1e-4 * t * slope:
                high = t
            elif -(g1 @ q) < 0.9 * slope:
                low = t
            else:
                break
            t = (low + high) / 2 if high < np.inf else 2 * t
        if not f1 < f:
            break
        change, gain = g1 - g, f - f1
        if s @ change > 0:
            steps = [*steps[1 - memory :], (s, change)] if len(steps) >= memory else [*steps, (s, change)]
        x, f, g = x + s, f1, g1
        if gain <= TOLERANCE * max(abs(f), 1e-12):
            break
    return x


def _together(searches: list, values) -> list[np.ndarray]:
    """Where generators like ``lbfgs`` end, asked in step; ``values(points)`` takes one point a search, or None where it has ended."""
    points = [next(s) for s in searches]
    ends: list = [None] * len(searches)
    while any(p is not None for p in points):
        got = values(points)
        for i, p in enumerate(points):
            if p is not None:
                try:
                    points[i] = searches[i].send(got[i])
                except StopIteration as e:
                    points[i], ends[i] = None, e.value
    return ends


def _moments(blocks: DataFrame, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means and sample deviations (1 where there is none) of the columns for each set; sums are taken around the mean of all rows."""
    d, folds = shape.columns, shape.folds

    def around(centre):
        def one(side, code, x):
            _, fold, x = _rows(shape, code, x)
            out, x = np.zeros((2, folds, 1 + 2 * d)), x - centre[:, None]
            for i in range(folds):
                at = fold == i
                out[side, i] = np.concatenate([[at.sum()], x[:, at].sum(axis=1), (x[:, at] ** 2).sum(axis=1)])
            return out.ravel()

        s = _sum(blocks, one).reshape(2, folds, 1 + 2 * d)
        return (s.sum(axis=1, keepdims=True) - s).reshape(2 * folds, -1)

    n, total = (s := around(np.zeros(d)))[:, 0], s[:, 1 : 1 + d]
    centre = total.sum(axis=0) / max(n.sum(), 1)
    s = around(centre)
    mean = s[:, 1 : 1 + d] / np.maximum(n, 1)[:, None]
    var = (s[:, 1 + d :] - n[:, None] * mean**2) / np.maximum(n - 1, 1)[:, None]
    return n, mean + centre, np.where(var > 1e-12 * s[:, 1 + d :] / np.maximum(n, 1)[:, None], np.sqrt(np.maximum(var, 0)), np.inf)


def linear_models(blocks: DataFrame, shape: Shape, names: list[str]) -> dict[str, np.ndarray]:
    """name -> weights (set, class, 1 + column; the first is the intercept) of "linear" (logistic, one vector a label) and "svm" (hinge loss, one a class)."""
    d, folds, sets = shape.columns, shape.folds, 2 * shape.folds
    sizes = {"linear": shape.labels, "svm": shape.classes}
    n, mean, dev = _moments(blocks, shape)

    def raw(points):
        """Points on the sets' own scales as weights of the columns as they are."""
        w = points[..., 1:] / dev[:, None, :]
        return np.concatenate([(points[..., 0] - (w * mean[:, None, :]).sum(axis=2))[..., None], w], axis=2)

    def values(asked):
        weights = {}
        for j, name in enumerate(names):
            points = asked[j * sets : (j + 1) * sets]
            if any(p is not None for p in points):
                weights[name] = raw(np.stack([np.zeros((sizes[name], 1 + d)) if p is None else p.reshape(sizes[name], 1 + d) for p in points]))

        def one(side, code, x):
            label, fold, x = _rows(shape, code, x)
            into, out = (np.arange(folds)[:, None] != fold)[:, None, :], []
            for name, w in weights.items():
                k, mine = sizes[name], w.reshape(2, folds, -1, 1 + d)[side]
                m = (mine[..., 1:].reshape(-1, d) @ x).reshape(folds, k, -1) + mine[..., :1]
                if name == "linear":
                    truth = np.arange(k)[:, None] == label
                    m -= m.max(axis=1, keepdims=True)
                    p = np.exp(m)
                    total = p.sum(axis=1, keepdims=True)
                    loss, c = np.where(truth, np.log(total) - m, 0) * into, (p / total - truth) * into
                else:
                    y = np.where(label == 1, 1.0, -1.0)[None, :] if k == 1 else np.where(np.arange(k)[:, None] == label, 1.0, -1.0)
                    short = np.maximum(1 - y * m, 0) * into
                    loss, c = short, -y * (short > 0)
                g = np.zeros((2, folds, k, 2 + d))
                g[side] = np.concatenate([loss.sum(axis=2)[..., None], c.sum(axis=2)[..., None], (c.reshape(-1, c.shape[2]) @ x.T).reshape(folds, k, d)], axis=2)
                out.append(g.ravel())
            return np.concatenate(out)

        got, out, at = _sum(blocks, one), [None] * len(asked), 0
        for j, name in enumerate(names):
            if name in weights:
                k = sizes[name]
                g = got[at : at + sets * k * (2 + d)].reshape(sets, k, 2 + d) / np.maximum(n, 1)[:, None, None]
                at += sets * k * (2 + d)
                g[..., 2:] = (g[..., 2:] - g[..., 1:2] * mean[:, None, :]) / dev[:, None, :]
                out[j * sets : (j + 1) * sets] = [(one_set[:, 0], one_set[:, 1:]) for one_set in g]
        return out

    # a hinge model of several labels is a search for each class, as its classes don't depend on each other
    searches, place = [], []
    for j, name in enumerate(names):
        for i in range(sets):
            parts = [slice(None)] if name == "linear" else [slice(c, c + 1) for c in range(sizes[name])]
            for part in parts:
                place.append((j * sets + i, part))
                searches.append(lbfgs(np.zeros(len(range(*part.indices(sizes[name]))) * (1 + d))))
    held = [np.zeros((sizes[name], 1 + d)) for name in names for _ in range(sets)]

    def each(points):
        live = {at for (at, _), p in zip(place, points) if p is not None}
        for (at, part), p in zip(place, points):
            if p is not None:
                held[at][part] = p.reshape(-1, 1 + d)
        got = values([h if at in live else None for at, h in enumerate(held)])
        return [None if p is None else (float(got[at][0][part].sum()), got[at][1][part].ravel()) for (at, part), p in zip(place, points)]

    for (at, part), end in zip(place, _together(searches, each)):
        held[at][part] = end.reshape(-1, 1 + d)
    return {name: raw(np.stack(held[j * sets : (j + 1) * sets])) for j, name in enumerate(names)}


def linear_hits(blocks: DataFrame, shape: Shape, models: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """name -> rows of the first side that the models of each side tell right, each by the set that lacks its fold."""

    def one(side, code, x):
        hits = np.zeros((len(models), 2))
        if side == 0:
            label, fold, x = _rows(shape, code, x)
            for j, w in enumerate(models.values()):
                for s in (0, 1):
                    for i in range(shape.folds):
                        at, mine = fold == i, w[s * shape.folds + i]
                        m = mine[:, 1:] @ x[:, at] + mine[:, :1]
                        hits[j, s] += (((m[0] > 0) if len(m) == 1 else m.argmax(axis=0)) == label[at]).sum()
        return hits.ravel()

    return dict(zip(models, _sum(blocks, one).reshape(-1, 2)))


def thresholds(blocks: DataFrame, shape: Shape) -> list[np.ndarray]:
    """At most BINS - 1 cuts of each column: between all values where those are few, or else where another share of the rows is full."""

    def task(batches):
        for b in batches:
            for raw in b.column("x"):
                for i, x in enumerate(np.frombuffer(raw.as_py()).reshape(shape.columns, -1)):
                    v, n = np.unique(x, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), i, np.int32)), pa.array(v), pa.array(n)], names=["c", "v", "n"])

    counts = blocks.mapInArrow(task, "c int, v double, n bigint").groupBy("c", "v").agg(F.sum("n").alias("n"))
    rows = running(counts.withColumn("one", F.lit(1).cast("bigint")), ["c"], "v", ["n", "one"])
    full = F.floor(F.col("cum_n") * BINS / F.col("all_n")) > F.floor((F.col("cum_n") - F.col("n")) * BINS / F.col("all_n"))
    cuts = rows.filter(F.col("next").isNotNull() & ((F.col("all_one") <= BINS) | full)).select("c", ((F.col("v") + F.col("next")) / 2).alias("cut")).collect()  # BINS a column
    return [np.array(sorted(r["cut"] for r in cuts if r["c"] == i)) for i in range(shape.columns)]


def count_cells(blocks: DataFrame, shape: Shape, cuts: list[np.ndarray], parts: int) -> DataFrame:
    """(number, bins, counts): blocks of distinct rows of intervals, with their rows by side, label and fold. Equal rows meet in one block."""
    kinds = 2 * shape.labels * shape.folds

    def cut(batches):
        for b in batches:
            for side, code, x in zip(b.column("side").to_pylist(), b.column("code"), b.column("x")):
                code, x = np.frombuffer(code.as_py(), np.int32), np.frombuffer(x.as_py()).reshape(shape.columns, -1)
                key = np.empty((x.shape[1], shape.columns + 4), np.uint8)
                for i, c in enumerate(cuts):
                    key[:, i] = np.searchsorted(c, x[i], side="left")
                key[:, shape.columns :] = (code + side * (kinds // 2)).astype("<i4").view(np.uint8).reshape(-1, 4)
                one, n = np.unique(key.view(f"V{key.shape[1]}").ravel(), return_counts=True)
                one = one.view(np.uint8).reshape(len(one), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.tobytes() for r in one[:, : shape.columns]], pa.binary()), pa.array(np.ascontiguousarray(one[:, shape.columns :]).view("<i4").ravel()), pa.array(n)], names=["cell", "kind", "n"]
                )

    def dense(batches):
        from pyspark import TaskContext

        for j, b in enumerate(batches):
            if b.num_rows:
                lists = b.column("of")
                at, of = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy()), lists.flatten()
                counts = np.zeros((b.num_rows, kinds))
                counts[at, of.field("kind").to_numpy()] = of.field("n").to_numpy()
                number = (TaskContext.get().partitionId() << 32) + j
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([b"".join(b.column("cell").to_pylist())], pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["number", "bins", "counts"])

    rows = blocks.mapInArrow(cut, "cell binary, kind int, n bigint").repartition(parts, "cell").groupBy("cell", "kind").agg(F.sum("n").alias("n"))
    cells = rows.groupBy("cell").agg(F.collect_list(F.struct("kind", "n")).alias("of")).sortWithinPartitions("cell")
    return checkpointed(cells.mapInArrow(dense, "number bigint, bins binary, counts binary"))


def _cells(shape: Shape, bins: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Intervals (column, row) and counts (row, side, label, fold)."""
    b = np.ascontiguousarray(np.frombuffer(bins, np.uint8).reshape(-1, shape.columns).T)
    return b, np.frombuffer(counts).reshape(-1, 2, shape.labels, shape.folds)


@dataclass
class Trees:
    """Complete binary trees: a row goes right of a node where the column's interval is above the cut. ``value``: label weights, or a mean."""

    feature: np.ndarray  # (tree, node)
    cut: np.ndarray
    value: np.ndarray  # (tree, node, number)
    open: np.ndarray  # nodes that may still be split

    @staticmethod
    def of(n: int, depth: int, numbers: int) -> Trees:
        nodes = (2 << depth) - 1
        first = np.zeros((n, nodes), bool)
        first[:, 0] = True
        return Trees(np.zeros((n, nodes), np.int64), np.full((n, nodes), 255), np.zeros((n, nodes, numbers)), first)

    def reached(self, t: int, bins: np.ndarray, depth: int) -> np.ndarray:
        node, row = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1])
        for _ in range(depth):
            node = 2 * node + 1 + (bins[self.feature[t][node], row] > self.cut[t][node])
        return node


def _grow(cells: DataFrame, shape: Shape, trees: Trees, depth: int, numbers: int, columns, weights, score, value) -> None:
    """Splits the trees level by level, each level of all trees in one pass.

    ``weights(number, bins, counts)`` gives (tree, row weights as (row, number)) one after another, ``columns[tree, node]`` the
    columns a node may be split by; ``score(sums)`` is what a split makes larger, ``value(sums)`` what a leaf says.
    """
    slots = columns.shape[2]
    for level in range(depth):
        first, width = (1 << level) - 1, 1 << level

        def task(batches):
            sums: dict = {}
            for b in batches:
                for number, raw, n in zip(b.column("number").to_pylist(), b.column("bins").to_pylist(), b.column("counts").to_pylist()):
                    bins, counts = _cells(shape, raw, n)
                    for t, w in weights(number, bins, counts):
                        node = trees.reached(t, bins, level)
                        at = np.flatnonzero(trees.open[t][node] & w.any(axis=1))
                        node, w = node[at] - first, w[at]
                        total = sums.setdefault(t, np.zeros((slots, numbers, width * BINS)))
                        for s in range(slots):
                            key = node * BINS + bins[columns[t, node + first, s], at]
                            for k in range(numbers):
                                total[s, k] += np.bincount(key, w[:, k], minlength=width * BINS)
            if sums:
                yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["t", "s"])

        def split(table):
            s = np.sum([np.frombuffer(x.as_py()) for x in table.column("s")], axis=0).reshape(slots, numbers, width, BINS).transpose(2, 0, 3, 1)
            left = s.cumsum(axis=2)
            whole = left[:, :, -1:, :]
            left = left[:, :, :-1]
            gain = score(left) + score(whole - left) - score(whole)
            gain = gain.reshape(width, -1)
            best, row = gain.argmax(axis=1), np.arange(width)
            chosen = left.reshape(width, -1, numbers)[row, best]
            found = np.concatenate([best[:, None], gain[row, best][:, None], chosen, whole[:, 0, 0]], axis=1)
            return pa.table({"t": table.column("t").slice(0, 1), "f": pa.array([found.tobytes()], pa.binary())})

        for r in cells.mapInArrow(task, "t int, s binary").groupBy("t").applyInArrow(split, "t int, f binary").collect():  # one row a tree
            t, found = r["t"], np.frombuffer(r["f"]).reshape(width, -1)
            for i, (best, gain, *sums) in enumerate(found):
                node, left, whole = first + i, np.array(sums[:numbers]), np.array(sums[numbers:])
                if not trees.open[t, node]:
                    continue
                trees.value[t, node] = value(whole)
                children = [2 * node + 1, 2 * node + 2]
                if gain > 1e-12 * np.abs(whole).sum():
                    slot, cut = divmod(int(best), BINS - 1)
                    trees.feature[t, node], trees.cut[t, node] = columns[t, node, slot], cut
                    for child, part in zip(children, (left, whole - left)):
                        trees.value[t, child], trees.open[t, child] = value(part), True
        # a leaf hands its value down, so that all rows may be followed to the last level
        for node in range(first, first + width):
            leaf = trees.cut[:, node] == 255
            for child in (2 * node + 1, 2 * node + 2):
                trees.value[leaf, child] = trees.value[leaf, node]


def forests(cells: DataFrame, shape: Shape) -> Trees:
    """TREES trees a set (tree * sets + set), each of rows drawn with replacement; a node looks at the root of the columns' number of them, and Gini impurity decides."""
    sets, d = 2 * shape.folds, shape.columns
    trees, rng = Trees.of(TREES * sets, FOREST_DEPTH, shape.labels), np.random.default_rng(SEED)
    slots = int(np.ceil(np.sqrt(d)))
    columns = rng.random((TREES * sets, trees.feature.shape[1], d)).argsort(axis=2)[..., :slots]

    def weights(number, bins, counts):
        some = counts.nonzero()
        for t in range(TREES):
            drawn = np.zeros(counts.shape)
            drawn[some] = np.random.default_rng([SEED, t, number]).poisson(counts[some])
            for s in (0, 1):
                total = drawn[:, s].sum(axis=2)
                for i in range(shape.folds):
                    yield t * sets + s * shape.folds + i, total - drawn[:, s, :, i]

    def score(sums):
        n = sums.sum(axis=-1)
        return np.where(n > 0, (sums**2).sum(axis=-1) / np.maximum(n, 1e-300), 0)

    _grow(cells, shape, trees, FOREST_DEPTH, shape.labels, columns, weights, score, lambda sums: sums / max(sums.sum(), 1e-300))
    return trees


def boosted(cells: DataFrame, shape: Shape) -> list[Trees]:
    """BOOSTS rounds of one tree a set and class (set * classes + class), each fitted on what the logistic loss of those before leaves."""
    sets, d, classes = 2 * shape.folds, shape.columns, shape.classes
    done: list[Trees] = []
    columns = np.broadcast_to(np.arange(d), (sets * classes, (2 << BOOST_DEPTH) - 1, d))

    def weights(number, bins, counts):
        for s in (0, 1):
            whole = counts[:, s].sum(axis=2)
            for i in range(shape.folds):
                n = whole - counts[:, s, :, i]
                total = n.sum(axis=1)
                for c in range(classes):
                    t = (s * shape.folds + i) * classes + c
                    yes = n[:, 1 if classes == 1 else c]
                    up, down = 1.0, -1.0
                    if done:
                        m = margin(done, t, bins)
                        up, down = 4 / (1 + np.exp(2 * m)), -4 / (1 + np.exp(-2 * m))
                    yield t, np.stack([total, yes * up + (total - yes) * down], axis=1)

    def score(sums):
        n = sums[..., 0]
        return np.where(n > 0, sums[..., 1] ** 2 / np.maximum(n, 1e-300), 0)

    for _ in range(BOOSTS):
        trees = Trees.of(sets * classes, BOOST_DEPTH, 1)
        _grow(cells, shape, trees, BOOST_DEPTH, 2, columns, weights, score, lambda sums: sums[1:] / max(sums[0], 1e-300))
        done.append(trees)
    return done


def margin(done: list[Trees], t: int, bins: np.ndarray) -> np.ndarray:
    return sum((1.0 if j == 0 else RATE) * x.value[t, x.reached(t, bins, BOOST_DEPTH), 0] for j, x in enumerate(done))


def tree_hits(cells: DataFrame, shape: Shape, forest: Trees | None, boosts: list[Trees] | None) -> dict[str, np.ndarray]:
    """name -> rows of the first side told right by the models of each side, as ``linear_hits``."""
    sets, classes = 2 * shape.folds, shape.classes
    names = [n for n, x in (("forest", forest), ("xgb", boosts)) if x is not None]

    def one(number, raw, n):
        bins, counts = _cells(shape, raw, n)
        row, hits = np.arange(bins.shape[1]), np.zeros((len(names), 2))
        for s in (0, 1):
            for i in range(shape.folds):
                asked = counts[:, 0, :, i]
                for j, name in enumerate(names):
                    if name == "forest":
                        said = sum(forest.value[t, forest.reached(t, bins, FOREST_DEPTH)] for t in range(s * shape.folds + i, TREES * sets, sets)).argmax(axis=1)
                    else:
                        m = np.stack([margin(boosts, (s * shape.folds + i) * classes + c, bins) for c in range(classes)])
                        said = (m[0] > 0).astype(int) if classes == 1 else m.argmax(axis=0)
                    hits[j, s] += asked[row, said].sum()
        return hits.ravel()

    return dict(zip(names, _sum(cells, one).reshape(-1, 2)))


def hits(rows: DataFrame, shape: Shape, names: list[str]) -> dict[str, tuple[int, int]]:
    """name -> rows of the first side told right by models of the first and of the second side; ``rows`` as ``pack`` takes them."""
    context = rows.sparkSession.sparkContext
    parts = max(context.defaultParallelism, rows.rdd.getNumPartitions())
    blocks = checkpointed(pack(rows.repartition(parts, *rows.columns), shape))
    if blocks.isEmpty():
        return {n: (0, 0) for n in names}
    out: dict = {}
    if lines := [n for n in names if n in ("linear", "svm")]:
        out |= linear_hits(blocks, shape, linear_models(blocks, shape, lines))
    if {"forest", "xgb"} & set(names):
        cells = count_cells(blocks, shape, thresholds(blocks, shape), parts)
        out |= tree_hits(cells, shape, forests(cells, shape) if "forest" in names else None, boosted(cells, shape) if "xgb" in names else None)
    return {n: (int(round(out[n][0])), int(round(out[n][1]))) for n in names}
