"""Nearest neighbours and the distance metrics built on them.

``nn_join`` finds exact neighbours in two rounds. The searched side is dealt to the nearest of some
of its rows (pivots) and its cells are cut into blocks. In the first round each asking row meets
only the cell of its own nearest pivot, which gives it a bound: the k-th distance found there. In the
second it visits just those other cells that the triangle inequality lets hold something nearer
(distance to the pivot less the cell's radius, against the row's own bound). For that, rows lie in blocks
of their own cells, with the cells that each has to visit as bits; a block is read beside the blocks of all
cells that one of its rows visits (a product of two checkpoints, so no vector is shuffled again for each visit),
and a task merges what it finds for a row. Blocks meet in Arrow batches: a matrix product around the cell's centre gives
distances with a known error, whatever lies within that error of the k-th is computed again
difference by difference, and only the k best go on. No pair of rows ever becomes a row, and the
result doesn't depend on how rows were dealt. Of equal rows of the searched side only those with
the k smallest ids take part, as no others can be among the k nearest, so a third of all rows may be
copies. Rows without a vector are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructType

from quarrystone.functions.session import checkpointed
from quarrystone.operators.order import quantiles
from quarrystone.operators.split import unit_hash, unit_hash_of

#: Rows of a block: two blocks of 64 doubles stay below 5 MB.
BLOCK_ROWS = 4096
#: Pivots at most, so that they can be broadcast (0.5 MB at 64 doubles) and their pairs looked at on the driver.
MAX_PIVOTS = 1024
#: Parts of the asking and of the searched side, each of which meets each; more of the latter where one would have over PART_BLOCKS blocks.
ASKING_PARTS, SEARCHED_PARTS, PART_BLOCKS = 32, 8, 64


def _matrix(column: pa.Array) -> np.ndarray:
    column = pa.concat_arrays([column]) if isinstance(column, pa.Array) else column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def products(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all rows of q and x by matrix products, and for each row of q what they may be off by."""
    qq, xx = (q * q).sum(axis=1), (x * x).sum(axis=1)
    error = 16 * (q.shape[1] + 8) * np.finfo(float).eps * (qq + xx.max(initial=0))
    return np.maximum(qq[:, None] + xx[None, :] - 2 * (q @ x.T), 0), error


def exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Squared distances of the given pairs, from their differences."""
    out = np.empty(len(rows))
    for i in range(0, len(rows), 1 << 16):
        d = q[rows[i : i + (1 << 16)]] - x[cols[i : i + (1 << 16)]]
        out[i : i + (1 << 16)] = (d * d).sum(axis=1)
    return out


def nearest(q: np.ndarray, q_id: np.ndarray, x: np.ndarray, x_id: np.ndarray, k: int, exclude_self: bool, bound: np.ndarray | float = np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, squared distance) of the k nearest rows of x, ties by x_id; none that are surely farther than ``bound``."""
    centre = x[0]
    near, error = products(q - centre, x - centre)
    if exclude_self:
        near[q_id[:, None] == x_id[None, :]] = np.inf
    limit = np.minimum(np.partition(near, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1], bound * bound * (1 + 1e-9)) + 2 * error
    rows, cols = np.nonzero((near <= limit[:, None]) & np.isfinite(near))
    d = exact(q, x, rows, cols)
    order = np.lexsort((x_id[cols], d, rows))
    rows, cols, d = rows[order], cols[order], d[order]
    first = np.searchsorted(rows, rows)
    keep = np.arange(len(rows)) - first < k
    return rows[keep], cols[keep], d[keep]


def _sides(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v and tag, a number that goes with a row into its block: what it means is for the search to know."""
    return df.filter(F.col(vector).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.lit(0).cast("bigint").alias("tag"))


def _celled(df: DataFrame, pivots) -> DataFrame:
    """id, v, tag, the nearest pivot and the distance to it."""

    def run(batches):
        p = pivots.value
        for b in batches:
            v = _matrix(b.column("v"))
            cell, far = np.zeros(len(v), np.int32), np.zeros(len(v))
            for i in range(0, len(v), 512):
                q = v[i : i + 512] - p[0]
                cell[i : i + 512] = products(q, p - p[0])[0].argmin(axis=1) if len(p) else 0
            if len(v):
                far = np.sqrt(exact(v, p, np.arange(len(v)), cell))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), b.column("tag"), pa.array(cell), pa.array(far)], names=["id", "v", "tag", "cell", "far"])

    schema = StructType().add("id", LongType()).add("v", ArrayType(DoubleType())).add("tag", LongType()).add("cell", IntegerType()).add("far", DoubleType())
    return df.mapInArrow(run, schema)


def _grouped(rows: DataFrame, cell: str, sizes: dict[int, int], block_rows: int, names: tuple[str, ...], values: tuple[str, ...], more: list = ()) -> DataFrame:
    """Blocks of about ``block_rows`` rows of a cell: cell under names[0], lists of ``values`` under the other names, and the aggregates ``more``."""
    parts = rows.sparkSession.createDataFrame([(c, -(-n // block_rows)) for c, n in sizes.items()], "_cell int, _parts int")  # MAX_PIVOTS rows
    dealt = rows.join(F.broadcast(parts), F.col(cell) == F.col("_cell")).withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    return dealt.groupBy(F.col(cell).alias(names[0]), "_b").agg(*(F.collect_list(v).alias(n) for n, v in zip(names[1:], values)), *more).drop("_b")


class Meeting:
    """Asking rows of a block that visit a cell (ids, vectors, bounds, tags) beside a block of that cell (ids, vectors, tags); ``block`` tells asking blocks apart."""

    def __init__(self, batch: pa.RecordBatch, r: int):
        self.q_id, self.bound, self.q_tag, self.x_id, self.x_tag = (batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in ("qs", "qr", "qt", "xs", "xt"))
        self.q, self.x = (_matrix(batch.column(c)[r].values) for c in ("qv", "xv"))
        self.block = batch.column("qb")[r].as_py()

    @staticmethod
    def of(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                yield Meeting(batch, r)


class Cells:
    """The searched side, dealt to pivots, in blocks; its cells' radii and sizes are known to the driver (MAX_PIVOTS numbers)."""

    def __init__(self, rows: DataFrame, block_rows: int):
        self.block_rows, spark = block_rows, rows.sparkSession
        self.n = rows.count()
        if self.n <= block_rows:  # one block: nothing to deal
            self.blocks = rows.withColumn("cell", F.lit(0)).groupBy("cell").agg(F.collect_list("id").alias("xs"), F.collect_list("v").alias("xv"), F.collect_list("tag").alias("xt"))
            return
        chosen = rows.orderBy(F.xxhash64("id"), "id").limit(min(MAX_PIVOTS, -(-self.n // block_rows))).toArrow()
        self.pivots = spark.sparkContext.broadcast(_matrix(chosen.column("v")))
        dealt = checkpointed(_celled(rows, self.pivots))
        stats = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("r")).collect()
        self.radius, self.size = np.full(len(chosen), -np.inf), np.zeros(len(chosen), np.int64)
        for r in stats:
            self.radius[r["cell"]], self.size[r["cell"]] = r["r"], r["n"]
        self.blocks = checkpointed(_grouped(dealt, "cell", {r["cell"]: r["n"] for r in stats}, block_rows, ("cell", "xs", "xv", "xt"), ("id", "v", "tag")))

    def visits(self, rows: DataFrame, own: bool | None, least: int | None) -> DataFrame:
        """(id, v, tag, bound, cell, to): the cells that each row (id, v, tag, cell, bound) has to look into, as bits of 64-bit words.

        ``own``: all cells but that of the row's nearest pivot (false), or that one, too (null), as far as
        they can hold something within the bound. A row without a bound takes one under which ``least`` rows lie
        for certain, or every cell if that's null. Rows that visit none are left out.
        """
        pivots, radius, size = self.pivots, self.radius, self.size

        def run(batches):
            p = pivots.value
            for b in batches:
                v, cell, bounds = _matrix(b.column("v")), b.column("cell").to_numpy(), b.column("bound").to_numpy(zero_copy_only=False)
                for i in range(0, len(v), 512):
                    home, bound = cell[i : i + 512], bounds[i : i + 512].astype(float)
                    near, error = products(v[i : i + 512] - p[0], p - p[0])
                    low, high = np.sqrt(np.maximum(near - error[:, None], 0)), np.sqrt(near + error[:, None])
                    for r in np.flatnonzero(np.isnan(bound)):
                        upper = high[r] + radius
                        order = np.argsort(upper)
                        enough = np.flatnonzero(np.cumsum(size[order]) >= least) if least is not None else []
                        bound[r] = upper[order][enough[0]] if len(enough) else np.inf
                    slack = 1e-9 * (1 + high)
                    needed = np.zeros((len(home), -(-len(radius) // 64) * 64), bool)
                    needed[:, : len(radius)] = (low - radius[None, :] <= bound[:, None] + slack) & (size > 0)[None, :]
                    if own is False:
                        needed[np.arange(len(home)), home] = False
                    words = np.packbits(needed, axis=1, bitorder="little").view("<i8")
                    to = pa.ListArray.from_arrays(pa.array(np.arange(len(home) + 1, dtype=np.int32) * words.shape[1]), pa.array(words.ravel()))
                    part = b.slice(i, 512)
                    all_rows = pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "v", "tag", "bound", "cell")), to], names=["id", "v", "tag", "bound", "cell", "to"])
                    yield all_rows.filter(pa.array(needed.any(axis=1)))

        return rows.select("id", "v", "tag", "cell", "bound").mapInArrow(run, "id bigint, v array<double>, tag bigint, bound double, cell int, to array<bigint>")

    def homes(self, sizes: dict[int, int], most: int) -> tuple[dict[int, int], dict[int, int]]:
        """cell -> group, and group -> rows: cells put together along a chain of near pivots while they hold no more than ``most`` of the rows counted in ``sizes``."""
        p = self.pivots.value - self.pivots.value[0]
        left, at, group, homes, held = set(sizes), min(sizes, default=0), -1, {}, {}
        while left:
            rest = np.array(sorted(left))
            at = int(rest[products(p[at : at + 1], p[rest])[0][0].argmin()])
            left.remove(at)
            if group < 0 or held[group] + sizes[at] > most:
                group += 1
            homes[at], held[group] = group, held.get(group, 0) + sizes[at]
        return homes, held

    def met(self, rows: DataFrame, own: bool | None, least: int | None = None) -> DataFrame:
        """(qb, qs, qv, qr, qt, xs, xv, xt): blocks of asking rows (number, ids, vectors, bounds, tags) beside the blocks of cells that they visit.

        In the first round (``own`` true) rows meet their own cell only, by a join; ``visits`` says what else they meet,
        in blocks twice as large, as each of them is read for many cells.
        """
        sizes = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # MAX_PIVOTS rows
        if own:
            return met_blocks(_grouped(rows.fillna(-1.0, ["bound"]), "cell", sizes, self.block_rows, ("to", "qs", "qv", "qr", "qt"), ("id", "v", "bound", "tag")), self.blocks)
        homes, held = self.homes(sizes, 2 * self.block_rows)
        homes = rows.sparkSession.createDataFrame(list(homes.items()), "cell int, home int")  # MAX_PIVOTS rows
        rows = self.visits(rows, own, least).fillna(-1.0, ["bound"]).join(F.broadcast(homes), "cell").withColumn("one", F.struct("id", "v", "bound", "tag", "to"))
        wanted = F.array(*(F.bit_or(F.get("to", F.lit(i))) for i in range(-(-len(self.radius) // 64)))).alias("wanted")
        searched = max(SEARCHED_PARTS, -(-sum(-(-int(n) // self.block_rows) for n in self.size) // PART_BLOCKS))
        return met_blocks(checkpointed(_grouped(rows, "home", held, 2 * self.block_rows, ("group", "rows"), ("one",), [wanted])).coalesce(ASKING_PARTS), self.blocks.coalesce(searched))

    def met_at_once(self, rows: DataFrame) -> DataFrame:
        """The same for a side of one block and all rows (id, v, and bound if they have one)."""
        rows = rows.withColumns({"to": F.lit(0), "bound": F.col("bound") if "bound" in rows.columns else F.lit(-1.0)})
        return met_blocks(_grouped(rows, "to", {0: rows.count()}, self.block_rows, ("to", "qs", "qv", "qr", "qt"), ("id", "v", "bound", "tag")), self.blocks)


def met_blocks(asking: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each block of asking rows is read beside each block of its cell, or of the cells ``wanted`` of any of its rows; not each row beside each row."""
    if "wanted" not in asking.columns:
        return asking.join(blocks, F.col("to") == F.col("cell")).select(F.get("qs", F.lit(0)).alias("qb"), "qs", "qv", "qr", "qt", "xs", "xv", "xt")
    visits = lambda bits: F.getbit(F.get(bits, F.floor(F.col("cell") / 64).cast("int")), F.col("cell") % 64) == 1
    pairs = asking.hint("shuffle_replicate_nl").join(blocks, visits(F.col("wanted"))).withColumn("of", F.filter("rows", lambda r: visits(r["to"])))
    return pairs.select(F.get("rows", F.lit(0))["id"].alias("qb"), *(F.col(f"of.{c}").alias(n) for n, c in (("qs", "id"), ("qv", "v"), ("qr", "bound"), ("qt", "tag"))), "xs", "xv", "xt")


def _unbound(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bound", F.lit(None).cast("double"))


def two_rounds(left: DataFrame, right: DataFrame, block_rows: int, search, least: int | None, bounds) -> DataFrame:
    """What ``search(blocks)`` finds, in the rows' own cells and then in the cells within their bounds.

    left, right: (id, v, tag). ``bounds(found)`` makes (id, bound) of what the first round found; rows without one
    fall back on ``least`` (``Cells.visits``). A side of one block needs a single round.
    """
    cells = Cells(right, block_rows)
    if cells.n <= block_rows:
        return search(cells.met_at_once(left))
    rows = checkpointed(_celled(left, cells.pivots))
    first = checkpointed(search(cells.met(_unbound(rows), True)))
    bounded = rows.join(bounds(first), "id", "left")
    return first.unionByName(search(cells.met(bounded, False, least)))


def one_of_equals(df: DataFrame, key: str, vector: str) -> DataFrame | None:
    """(key, vector): the distinct vectors, each with the smallest of its keys, if at least half of the rows are copies.

    That is told by a sketch, which bears on the way taken only.
    """
    rows = df.filter(F.col(vector).isNotNull())
    r = rows.agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(vector), 0.02).alias("d")).first()
    return rows.groupBy(vector).agg(F.min(key).alias(key)).select(key, vector) if r["n"] > 2 * r["d"] else None


def to_equals(found: DataFrame, asked: DataFrame, df: DataFrame, key: str, vector: str) -> DataFrame:
    """What was found for the rows of ``one_of_equals`` as rows of all of df's rows with that vector."""
    of = asked.select(F.col(key).alias("_one"), F.col(vector).alias("_of"))
    known = found.join(of, F.col(key) == F.col("_one")).drop(key, "_one")
    rows = df.filter(F.col(vector).isNotNull()).select(key, vector)
    return rows.join(known, F.col(vector) == F.col("_of")).select(*found.columns)


def nn_join(a: DataFrame, b: DataFrame, a_id: str, b_id: str, vector: str, k: int = 1, exclude_self: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a_id, rank, b_id, distance): the k nearest rows of b for each row of a, Euclidean; ties by b_id.

    With ``exclude_self`` a row isn't its own neighbour (equal ids). Ids are numbers and unique. Where a has many
    copies and they all find the same, their vector asks once.
    """
    if not exclude_self and (one := one_of_equals(a, a_id, vector)) is not None:
        one = checkpointed(one)
        return to_equals(_nn_join(one, b, a_id, b_id, vector, k, False, block_rows), one, a, a_id, vector)
    return _nn_join(a, b, a_id, b_id, vector, k, exclude_self, block_rows)


def _nn_join(a: DataFrame, b: DataFrame, a_id: str, b_id: str, vector: str, k: int, exclude_self: bool, block_rows: int) -> DataFrame:
    asked = k + exclude_self  # one more, as a row may be left out of its own neighbours
    copies = F.row_number().over(W.partitionBy("v").orderBy("id"))
    left, right = _sides(a, a_id, vector), checkpointed(_sides(b, b_id, vector).withColumn("_c", copies).filter(F.col("_c") <= asked).drop("_c"))

    def best(batches):
        block, kept = None, None  # the nearest (asking id, id, squared distance) of a block's rows, which meet one block after another
        out = lambda: pa.RecordBatch.from_arrays([pa.array(x) for x in (kept[0], kept[1], np.sqrt(kept[2]))], names=["q", "n", "d"])
        for m in Meeting.of(batches):
            if m.block != block:
                if block is not None:
                    yield out()
                block, kept, last = m.block, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)), np.zeros(0, bool)
            bound = np.where(m.bound < 0, np.inf, m.bound)
            if last.any():
                full, far = kept[0][last], np.sqrt(kept[2][last])
                at = np.minimum(np.searchsorted(full, m.q_id), len(full) - 1)
                bound = np.where(full[at] == m.q_id, np.minimum(bound, far[at]), bound)
            found = [kept]
            for s in range(0, len(m.q), 512):
                rows, cols, d = nearest(m.q[s : s + 512], m.q_id[s : s + 512], m.x, m.x_id, k, exclude_self, bound[s : s + 512])
                found.append((m.q_id[s : s + 512][rows], m.x_id[cols], d))
            kept = tuple(map(np.concatenate, zip(*found)))
            order = np.lexsort((kept[1], kept[2], kept[0]))
            kept = tuple(x[order] for x in kept)
            place = np.arange(len(order)) - np.searchsorted(kept[0], kept[0])
            kept, last = tuple(x[place < k] for x in kept), (place == k - 1)[place < k]
        if block is not None:
            yield out()

    ranked = lambda found: found.groupBy("q").agg(F.slice(F.sort_array(F.collect_list(F.struct("d", "n"))), 1, k).alias("t"))
    bounds = lambda found: ranked(found).select(F.col("q").alias("id"), F.get("t", F.lit(k - 1))["d"].alias("bound"))
    found = two_rounds(left, right, block_rows, lambda met: met.mapInArrow(best, "q bigint, n bigint, d double"), asked, bounds)
    return ranked(found).select(F.col("q").alias(a_id), F.posexplode("t").alias("p", "t")).select(a_id, (F.col("p") + 1).alias("rank"), F.col("t.n").alias(b_id if b_id != a_id else f"{b_id}_near"), F.col("t.d").alias("distance"))


def distinct_ball_counts(centres: DataFrame, points: DataFrame, key: str, vector: str, radius: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(n, copies, balls): for each distinct point that lies in a ball, the smallest of its keys, how many points it stands for and how many balls it lies in.

    ``radius`` (q, r) gives each centre's radius, its edge included. A centre visits the cells that its ball can
    reach into. Equal balls and equal points take part once, with their number.
    """
    one = _sides(points, key, vector).groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("tag"))
    cells = Cells(checkpointed(one.select("id", "v", "tag")), block_rows)
    balls = _sides(centres, key, vector).join(radius.select(F.col("q").alias("id"), F.col("r").alias("bound")), "id")
    balls = balls.groupBy("v", "bound").agg(F.min("id").alias("id"), F.count("*").alias("tag"))
    met = cells.met_at_once(checkpointed(balls)) if cells.n <= block_rows else cells.met(_celled_with_bound(balls, cells.pivots), None)

    def count(batches):
        for m in Meeting.of(batches):
            q, x, r, total = m.q, m.x, m.bound, np.zeros(len(m.x), np.int64)
            for s in range(0, len(q), 512):
                near, error = products(q[s : s + 512] - x[0], x - x[0])
                rows, cols = np.nonzero(near <= (r[s : s + 512] ** 2 + 2 * error + 1e-12 * r[s : s + 512] ** 2)[:, None])
                inside = np.sqrt(exact(q[s : s + 512], x, rows, cols)) <= r[s : s + 512][rows]
                np.add.at(total, cols[inside], m.q_tag[s : s + 512][rows[inside]])
            hit = total > 0
            yield pa.RecordBatch.from_arrays([pa.array(m.x_id[hit]), pa.array(m.x_tag[hit]), pa.array(total[hit])], names=["n", "copies", "balls"])

    return met.mapInArrow(count, "n bigint, copies bigint, balls bigint").groupBy("n", "copies").agg(F.sum("balls").alias("balls"))


def ball_counts(centres: DataFrame, points: DataFrame, key: str, vector: str, radius: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(n, balls): for each point that lies in a ball, how many; copies of a point have a row each."""
    rows = _sides(points, key, vector).select("id", F.min("id").over(W.partitionBy("v")).alias("n"))
    return distinct_ball_counts(centres, points, key, vector, radius, block_rows).join(rows, "n").select(F.col("id").alias("n"), "balls")


def _celled_with_bound(rows: DataFrame, pivots) -> DataFrame:
    rows = checkpointed(rows.select("id", "v", "tag", "bound"))
    return _celled(rows, pivots).join(rows.select("id", "bound"), "id")


def relabel_by_neighbour(syn: DataFrame, real: DataFrame, syn_id: str, real_id: str, vector: str, label: str) -> DataFrame:
    """Candidates with the label of the nearest real row, and whether it changed."""
    near = nn_join(syn.withColumnRenamed(syn_id, "_s"), real.withColumnRenamed(real_id, "_r"), "_s", "_r", vector).select("_s", "_r")
    labels = real.select(F.col(real_id).alias("_r"), F.col(label).alias("_new"))
    out = syn.join(near.join(labels, "_r"), F.col(syn_id) == F.col("_s"))
    return out.withColumn("changed", ~F.col(label).eqNullSafe(F.col("_new"))).withColumn(label, F.col("_new")).drop("_s", "_r", "_new")


def distances(a: DataFrame, b: DataFrame, key: str, vector: str, k: int = 1, same: bool = False) -> DataFrame:
    """(q, rank, distance) from a's rows to b's; with ``same``, where they are one table, to a row's nearest others, which for copies are as far."""
    if same and (one := one_of_equals(a, key, vector)) is not None:
        one = checkpointed(one.withColumnRenamed(key, "q"))
        found = _nn_join(one, b.withColumnRenamed(key, "n"), "q", "n", vector, k, True, BLOCK_ROWS).select("q", "rank", "distance")
        return to_equals(found, one, a.withColumnRenamed(key, "q"), "q", vector)
    return nn_join(a.withColumnRenamed(key, "q"), b.withColumnRenamed(key, "n"), "q", "n", vector, k, same).select("q", "rank", "distance")


def nearest_distance_stats(syn: DataFrame, real: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """Mean scaled distance to the nearest real row, and the shares within 0.2 and from 0.8 on."""
    x = F.col("distance") / scale
    return distances(syn, real, key, vector).agg(F.avg(x).alias("nearest_syn_neighbor_distance"), F.avg((x <= 0.2).cast("double")).alias("close_values_probability"), F.avg((x >= 0.8).cast("double")).alias("distant_values_probability"))


def nndr(syn: DataFrame, real: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean ratio of the nearest to the second nearest distance."""
    return nndr_of(distances(syn, real, key, vector, 2))


def nndr_of(two: DataFrame) -> DataFrame:
    """The same of (q, rank, distance) to the two nearest."""
    d = two.groupBy("q").agg(F.min("distance").alias("a"), F.max("distance").alias("b"))
    return d.agg(F.avg(F.when(F.col("b") > 0, F.col("a") / F.col("b")).otherwise(1.0)).alias("value"))


def dcr(syn: DataFrame, real: DataFrame, key: str, vector: str) -> DataFrame:
    """Median distance to the closest record, candidate to real over real to real; null if half the real rows have copies."""
    return dcr_of(distances(syn, real, key, vector), distances(real, real, key, vector, 1, True))


def dcr_of(closest: DataFrame, own: DataFrame) -> DataFrame:
    """The same of the distances to the nearest real row, of candidates and of real rows."""
    m = lambda x, n: quantiles(x, "distance", [0.5]).select(F.col("value").alias(n))
    return m(closest, "a").crossJoin(m(own, "b")).select(F.when(F.col("b") > 0, F.col("a") / F.col("b")).alias("value"))


#: Rows of the searched side that are ranked for all rounds at once; rounds that choose none of them look at the whole block.
RANKED = 64


def tagged(df: DataFrame, key: str, vector: str, share: float, rounds: int) -> DataFrame:
    """id, v and tag, whose bits are the rounds that choose the row by its hashes (a ``share`` of the rows on average)."""
    if rounds > 62:
        raise ValueError("a row's rounds are bits of one number: 62 at most")

    def run(batches):
        for b in batches:
            bits = [sum((unit_hash_of(f"{x}|nnaa|{i}") < share) << i for i in range(rounds)) for x in b.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(bits, pa.int64())], names=["id", "v", "tag"])

    return _sides(df, key, vector).mapInArrow(run, "id bigint, v array<double>, tag bigint")


def in_rounds(df: DataFrame, key: str, vector: str, share: float, rounds: int) -> DataFrame:
    """(id, v, chosen): the distinct vectors, the smallest of their keys, and for each round how many of their rows it chooses."""
    counts = tagged(df, key, vector, share, rounds).groupBy("v").agg(F.min("id").alias("id"), *(F.sum(F.getbit("tag", F.lit(i)).cast("bigint")).alias(f"_{i}") for i in range(rounds)))
    return counts.select("id", "v", F.array(*(f"_{i}" for i in range(rounds))).alias("chosen"))


def _bits(chosen: str, least: int, rounds: int):
    """The rounds that choose at least so many rows, as bits."""
    return sum((F.when(F.get(chosen, F.lit(i)) >= least, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i in range(rounds)), F.lit(0).cast("bigint"))


def nearest_in_rounds(a: DataFrame, b: DataFrame, key: str, vector: str, share: float, rounds: int, own: bool, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(i, q, distance): for each round i the nearest row of b among those that the round's hashes choose (a ``share`` of b on average).

    With ``own`` both sides are the same table: a row isn't its own neighbour, and only chosen rows ask.
    """
    right = tagged(b, key, vector, share, rounds)
    left = tagged(a, key, vector, share, rounds) if own else _sides(a, key, vector).withColumn("tag", F.lit((1 << rounds) - 1).cast("bigint"))
    return nearest_tagged(left, right, rounds, own, block_rows)


def nearest_tagged(left: DataFrame, right: DataFrame, rounds: int, own: bool, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(i, q, distance): for each round i whose bit a row of ``left`` has in its tag, the nearest of the rows of ``right`` that have it, too.

    Both sides are (id, v, tag); with ``own`` rows of equal ids don't meet. All rounds share one search;
    a row's bound is the farthest of what its rounds found in its own cell. In a block the RANKED nearest rows
    serve all rounds; only where a round has none of them, or the last is too near to be sure, the whole block is looked at.
    """
    def best(batches):
        for met in Meeting.of(batches):
            q_id, x_id, q_tag, x_tag, q, x = met.q_id, met.x_id, met.q_tag, met.x_tag, met.q, met.x
            m = min(RANKED, len(x))
            for s in range(0, len(q), 512):
                part, at = q[s : s + 512], np.arange(len(q[s : s + 512]))[:, None]
                near, error = products(part - x[0], x - x[0])
                if own:
                    near[q_id[s : s + 512, None] == x_id[None, :]] = np.inf
                first = np.argpartition(near, m - 1, axis=1)[:, :m]
                close = near[at, first]
                edge = close.max(axis=1) - 2 * error if m < len(x) else np.full(len(part), np.inf)
                d = exact(part, x, np.repeat(at[:, 0], m), first.ravel()).reshape(len(part), m)
                d[~np.isfinite(close)] = np.inf
                for i in range(rounds):
                    asks, gives = (q_tag[s : s + 512] >> i) & 1 > 0, (x_tag >> i) & 1 > 0
                    low = np.where(gives[first] & asks[:, None], d, np.inf).min(axis=1)
                    rest = np.flatnonzero(asks & ~(low <= edge))
                    if len(rest):
                        here = np.where(gives[None, :], near[rest], np.inf)
                        rows, cols = np.nonzero((here <= here.min(axis=1)[:, None] + 2 * error[rest, None]) & np.isfinite(here))
                        np.minimum.at(low, rest[rows], exact(part, x, rest[rows], cols))
                    found = np.flatnonzero(np.isfinite(low))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), i, np.int32)), pa.array(q_id[s : s + 512][found]), pa.array(np.sqrt(low[found]))], names=["i", "q", "d"])

    nearest_of = lambda found: found.groupBy("i", "q").agg(F.min("d").alias("distance"))
    asked = left.select(F.col("id").alias("q"), F.bit_count("tag").alias("_asked"))

    def bounds(found):  # a row that found nothing in one of its rounds has none
        one = nearest_of(found).groupBy("q").agg(F.max("distance").alias("bound"), F.count("*").alias("_n")).join(asked, "q")
        return one.select(F.col("q").alias("id"), F.when(F.col("_n") == F.col("_asked"), F.col("bound")).alias("bound"))

    return nearest_of(two_rounds(left, right, block_rows, lambda met: met.mapInArrow(best, "i int, q bigint, d double"), None, bounds))


def nnaa(syn: DataFrame, real: DataFrame, key: str, vector: str, rounds: int = 30) -> DataFrame:
    """Nearest-neighbour adversarial accuracy: how often a row's nearest is of its own side.

    Sides of unequal size are balanced: in each of ``rounds`` rounds the larger one is cut to a
    hash share of the smaller one's size, and the mean is taken. Equal sides need one round.
    Equal rows of a side are searched for once and counted by their number: a row with a copy has a neighbour at distance 0.
    """
    n_syn, n_real = syn.count(), real.count()
    if not n_syn or not n_real:
        return syn.sparkSession.createDataFrame([(None,)], "value double")
    share = min(n_syn, n_real) / max(n_syn, n_real)
    rounds = rounds if share < 1 else 1
    large, little = (syn, real) if n_syn > n_real else (real, syn)
    large = checkpointed(in_rounds(large, key, vector, share, rounds))
    little = checkpointed(_sides(little, key, vector).groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("w")).select("id", "v", "w"))
    given = large.select("id", "v", _bits("chosen", 1, rounds).alias("tag")).filter("tag <> 0")
    lone = large.select("id", "v", (_bits("chosen", 1, rounds) - _bits("chosen", 2, rounds)).alias("tag")).filter("tag <> 0")
    every = little.select("id", "v", F.lit((1 << rounds) - 1).cast("bigint").alias("tag"))
    far = lambda x, y, same, name: distances(x, y, "id", "v", 1, same).select("q", F.col("distance").alias(name))
    rate = lambda df: df.groupBy("i").agg((F.sum(F.when(F.col("other") > F.col("own"), F.col("w")).otherwise(0)) / F.sum("w")).alias("s"))
    rows = large.select(F.col("id").alias("q"), F.posexplode("chosen").alias("i", "w")).filter("w > 0")
    mine = rows.join(nearest_tagged(lone, given, rounds, True).withColumnRenamed("distance", "own"), ["i", "q"], "left")
    mine = mine.withColumn("own", F.when(F.col("w") > 1, 0.0).otherwise(F.col("own"))).filter("own IS NOT NULL")
    theirs = nearest_tagged(every, given, rounds, False).withColumnRenamed("distance", "other")
    weight = little.select(F.col("id").alias("q"), "w")
    among = weight.join(far(little, little, True, "own"), "q", "left").withColumn("own", F.when(F.col("w") > 1, 0.0).otherwise(F.col("own"))).filter("own IS NOT NULL")
    first = rate(mine.join(far(large, little, False, "other"), "q"))
    second = rate(theirs.join(among, "q")).withColumnRenamed("s", "s2")
    return first.join(second, "i").agg(F.avg((F.col("s") + F.col("s2")) / 2).alias("value"))


def entropy_weights(real: DataFrame, vector: str) -> list[float]:
    """For each place of the vector one over the entropy of its values, rounded to whole numbers; entropies below 1e-6 count as that."""
    values = real.filter(F.col(vector).isNotNull()).select(F.posexplode(vector).alias("i", "x")).groupBy("i", F.round("x").alias("x")).agg(F.count("*").alias("n"))
    total = values.groupBy("i").agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.ln("n")).alias("s"))
    rows = {r["i"]: r["h"] for r in total.select("i", (F.ln("t") - F.col("s") / F.col("t")).alias("h")).collect()}  # as many as places
    return [1 / max(rows[i], 1e-6) for i in sorted(rows)]


def identifiability(syn: DataFrame, real: DataFrame, key: str, vector: str, weighted: bool = True) -> DataFrame:
    """Share of real rows nearer to a candidate than to another real row, places weighted by their entropy."""
    if weighted:
        w = F.array(*map(F.lit, entropy_weights(real, vector)))
        scale = lambda df: df.withColumn(vector, F.zip_with(F.col(vector).cast("array<double>"), w, lambda x, y: x * y))
        syn, real = scale(syn), scale(real)
    own = distances(real, real, key, vector, 1, True).select("q", F.col("distance").alias("own"))
    other = distances(real, syn, key, vector).select("q", F.col("distance").alias("other"))
    return own.join(other, "q").agg(F.avg((F.col("other") < F.col("own")).cast("double")).alias("value"))


def prdc(syn: DataFrame, real: DataFrame, key: str, vector: str, k: int = 5, own: DataFrame | None = None, back: DataFrame | None = None, near: DataFrame | None = None) -> DataFrame:
    """Precision, recall, density and coverage on the balls that reach to each row's k-th neighbour on its own side.

    precision: share of candidates in a real ball; recall: share of real rows in a candidate's ball;
    density: real balls around a candidate over k, on average; coverage: share of real balls with a candidate.
    ``own``, ``back`` and ``near`` (q, rank, distance) are those among real rows, among candidates and from real rows
    to candidates, where they are known already.
    """
    radius = lambda d: d.groupBy("q").agg(F.max("distance").alias("r"))
    ball = lambda df: radius(distances(df, df, key, vector, k, True))
    balls = checkpointed(ball(real) if own is None else radius(own.filter(F.col("rank") <= k)))
    near = (distances(real, syn, key, vector) if near is None else near.filter("rank = 1")).select("q", "distance")
    coverage = balls.join(near, "q").agg(F.avg((F.col("distance") <= F.col("r")).cast("double")).alias("coverage"))
    of = lambda df, n: df.agg(F.count("*").alias(n))
    covered = distinct_ball_counts(real, syn, key, vector, balls).agg(F.sum("copies").alias("_in"), F.sum(F.col("copies") * F.col("balls")).alias("_balls")).crossJoin(of(syn, "_syn"))
    back = distinct_ball_counts(syn, real, key, vector, ball(syn) if back is None else radius(back.filter(F.col("rank") <= k))).agg(F.sum("copies").alias("_back")).crossJoin(of(real, "_real"))
    share = lambda a, b: F.when(F.col(b) > 0, F.coalesce(F.col(a), F.lit(0)) / F.col(b))
    return covered.crossJoin(back).crossJoin(coverage).select(share("_in", "_syn").alias("precision"), share("_back", "_real").alias("recall"), (share("_balls", "_syn") / k).alias("density"), "coverage")


def attribute_disclosure(real: DataFrame, syn: DataFrame, key: str, vector: str, attribute: str, tolerance: float | None = None) -> DataFrame:
    """Share of real rows whose attribute the nearest candidate (on what is known) gives away.

    A category must be met; with ``tolerance`` (1/30 is usual) the attribute is a number and may be off by that share of the real side's range.
    """
    near = nn_join(real.withColumnRenamed(key, "q"), syn.withColumnRenamed(key, "n"), "q", "n", vector).select("q", "n")
    both = near.join(real.select(F.col(key).alias("q"), F.col(attribute).alias("_t")), "q").join(syn.select(F.col(key).alias("n"), F.col(attribute).alias("_g")), "n")
    if tolerance is None:
        hit = F.col("_t").eqNullSafe(F.col("_g"))
    else:
        both = both.crossJoin(F.broadcast(real.agg(((F.max(attribute) - F.min(attribute)) * tolerance).alias("_w"))))
        hit = F.coalesce(F.abs(F.col("_t") - F.col("_g")) <= F.col("_w"), F.col("_t").isNull() & F.col("_g").isNull())
    return both.agg(F.avg(hit.cast("double")).alias("value"))


def _from_centre(df: DataFrame, centre: DataFrame, vector: str) -> DataFrame:
    d = F.aggregate(F.zip_with(F.col(vector).cast("array<double>"), F.col("_c"), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    return df.crossJoin(F.broadcast(centre)).select(F.sqrt(d).alias("d"))


def alpha_precision(real: DataFrame, syn: DataFrame, vector: str, alpha: float = 0.9) -> DataFrame:
    """Shares of candidates within the real side's alpha ball, and of real rows within the candidates'."""
    def ball(a, b):
        parts = a.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"))
        centre = parts.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("_c"))  # one vector
        radius = quantiles(_from_centre(a, centre, vector), "d", [alpha]).select(F.col("value").alias("r"))
        return _from_centre(b, centre, vector).crossJoin(F.broadcast(radius)).agg(F.avg((F.col("d") <= F.col("r")).cast("double")).alias("s"))

    return ball(real, syn).withColumnRenamed("s", "alpha_precision").crossJoin(ball(syn, real).withColumnRenamed("s", "beta_recall"))


def authenticity(real: DataFrame, syn: DataFrame, key: str, vector: str) -> DataFrame:
    """Share of candidates farther from their nearest real row than that row is from its own nearest."""
    near = nn_join(syn.withColumnRenamed(key, "q"), real.withColumnRenamed(key, "n"), "q", "n", vector).select("q", "n", F.col("distance").alias("d"))
    own = distances(real, real, key, vector, 1, True).select(F.col("q").alias("n"), F.col("distance").alias("own"))
    return near.join(own, "n").agg(F.avg((F.col("d") > F.col("own")).cast("double")).alias("value"))
