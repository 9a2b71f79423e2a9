"""Splits, samples and masks, all decided by hashes of row keys and a seed.

A choice of exactly k rows never sorts a group: rows are counted by slices of their hash,
and only the slice that holds the k-th row is ranked. The row found there is a bound that
every row is held against where it stands, so nothing else is shuffled.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quarrystone.functions.session import checkpointed, small

SLICES = 4096


def unit_hash(key: Column, *seed: object) -> Column:
    """A number in (0, 1) from md5 of the key and the seed; the same on every engine."""
    h = F.md5(F.concat(key, *(F.lit(f"|{s}") if not isinstance(s, Column) else F.concat(F.lit("|"), s) for s in seed)).cast("binary"))
    return (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def unit_hash_of(text: str) -> float:
    """The number that ``unit_hash`` gives for a key with its seeds written out (key|seed|seed), for use inside a task."""
    return (int(hashlib.md5(text.encode()).hexdigest()[:12], 16) + 0.5) / float(1 << 48)


def last_taken(df: DataFrame, group: list[str], order: str, key: str, k) -> DataFrame:
    """(group, _tu, _tk): order and key of the last of the rows with the smallest ``order`` (in [0, 1)) that each group takes.

    How many: ``k`` is a table (group, take), or a function from a group's count to that number.
    Groups that take none have no row. Rows are counted by slices of ``order``; only the slice in
    which a group's number is reached, one of SLICES, is shuffled and ranked.
    """
    df = df.withColumn("_s", F.floor(F.col(order) * SLICES).cast("int"))
    counts = df.groupBy(*group, "_s").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = counts.withColumn("take", k(F.sum("_n").over(W.partitionBy(*group)))) if callable(k) else counts.join(k, group)
    edge = counts.filter("_b < take").groupBy(*group).agg(F.max("_s").alias("_e"), F.max_by(F.least(F.col("take") - F.col("_b"), F.col("_n")), "_s").alias("_left"))
    rows = df.join(small(edge), group).filter("_s = _e").select(*group, order, key, "_left")
    place = F.row_number().over(W.partitionBy(*group).orderBy(order, key))
    return small(rows.withColumn("_r", place).filter("_r = _left").select(*group, F.col(order).alias("_tu"), F.col(key).alias("_tk")))


def _taken(order: str, key: str) -> Column:
    return (F.col(order) < F.col("_tu")) | ((F.col(order) == F.col("_tu")) & (F.col(key) <= F.col("_tk")))


def take_smallest(df: DataFrame, group: list[str], order: str, key: str, k) -> DataFrame:
    """For each group the rows with the smallest ``order``, as ``last_taken`` counts them; keys are unique within a group and not null."""
    return df.join(last_taken(df, group, order, key, k), group).filter(_taken(order, key)).select(*df.columns)


def split_by_threshold(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Add ``split`` (train, test) by the hash alone: no shuffle, sizes right on average."""
    return df.withColumn("split", F.when(unit_hash(F.col(key), seed) < fraction, "train").otherwise("test"))


def train_test_split(df: DataFrame, key: str, fraction: float = 0.6667, seed: int = 42, stratify: str | None = None) -> DataFrame:
    """Add ``split``; exactly round(fraction x n) rows of each class (or of all) are train. Keys are to be unique."""
    group = ["_g"]
    u = df.withColumns({"_u": unit_hash(F.col(key), seed), "_g": F.col(stratify) if stratify else F.lit(0)})
    u = u.withColumn("_g", F.coalesce(F.col("_g").cast("string"), F.lit("\0")))
    sizes = u.groupBy("_g").agg(F.bround(F.count("*") * F.lit(fraction), 0).cast("bigint").alias("take"))
    last = last_taken(u.select(key, "_g", "_u"), group, "_u", key, sizes)
    split = F.when(F.coalesce(_taken("_u", key), F.lit(False)), "train").otherwise("test")
    return u.join(last, "_g", "left").withColumn("split", split).select(*(c for c in df.columns if c != "split"), "split")


def split_by_membership(imputed: DataFrame, split: DataFrame, key: str) -> DataFrame:
    """Rows of ``imputed`` with the split of their key; those without one go."""
    return imputed.join(split.select(key, "split"), key)


def semi_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def anti_rows(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def number_rows(df: DataFrame, key: str, seed: object = "rows") -> DataFrame:
    """Add ``row_no`` from 0, without gaps, in the order of a hash of the key: numbered within slices, shifted by their counts."""
    rows = df.withColumn("_u", unit_hash(F.col(key).cast("string"), seed)).withColumn("_s", F.floor(F.col("_u") * SLICES).cast("int"))
    counts = rows.groupBy("_s").agg(F.count("*").alias("_n"))  # SLICES rows
    shift = counts.select("_s", F.coalesce(F.sum("_n").over(W.orderBy("_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inside = F.row_number().over(W.partitionBy("_s").orderBy("_u", key)) - 1
    return rows.withColumn("_r", inside).join(F.broadcast(shift), "_s").withColumn("row_no", F.col("_r") + F.col("_b")).drop("_u", "_s", "_r", "_b")


def bootstrap(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows drawn with replacement: hashes of 0..n-1 joined to row numbers; adds ``draw``."""
    numbered = number_rows(df, key)
    size = df.agg(F.count("*").alias("_size"))
    draws = df.sparkSession.range(n).withColumnRenamed("id", "draw").crossJoin(F.broadcast(size))
    draws = draws.withColumn("row_no", F.floor(unit_hash(F.col("draw").cast("string"), seed) * F.col("_size"))).drop("_size")
    return draws.join(numbered, "row_no").drop("row_no")


def augment(train: DataFrame, synthetic: DataFrame) -> DataFrame:
    return train.unionByName(synthetic)


def mask_count(n: Column, fraction: float) -> Column:
    return F.when(n < 2, 0).otherwise(F.least(F.greatest(F.lit(1), F.bround(n * F.lit(fraction), 0)), n - 1)).cast("bigint")


def _weighed(df: DataFrame, key: str, features: list[str], sensitive: list[str], masks: list[tuple[str, int, int]]):
    """df with what the draws of each of ``masks`` (mechanism, mask_index, seed) look at, the cells' names (mechanism, mask_index, column, text of the hash),
    and for each of them its column of observed cells and that of its exponent, or none.

    Means and deviations are computed once and kept: a sum made again may differ in its last bit, and then
    the row at the bound would lie on the other side of it.
    """
    for m, _, _ in masks:
        if m not in ("mcar", "mar", "mnar"):
            raise ValueError(f"unknown mechanism {m!r}")
    from quarrystone.operators.clean import is_numeric, label_encode

    columns, numeric = [c for c in features if c not in sensitive], [x for x in features if is_numeric(df, x)]
    source = {(m, c): None if m == "mcar" else c if m == "mnar" else next((x for x in numeric if x != c), None) for m in dict.fromkeys(m for m, _, _ in masks) for c in columns}
    text = sorted({*source.values()} - {None, *numeric})
    weighed = {k: i for i, k in enumerate(k for k, x in source.items() if x)}
    rows = df.select(key, *features)
    if text:
        rows = label_encode(rows.withColumns({f"_code_{x}": F.col(x) for x in text}), [f"_code_{x}" for x in text])
    value = lambda k: F.col(f"_code_{source[k]}" if source[k] in text else source[k])
    if weighed:
        seen = lambda k: F.when(F.col(k[1]).isNotNull(), value(k))
        stats = [x for k, i in weighed.items() for x in (F.avg(seen(k)).alias(f"_m_{i}"), F.stddev_pop(seen(k)).alias(f"_d_{i}"), F.count_if(F.col(k[1]).isNotNull() & value(k).isNull()).alias(f"_n_{i}"))]
        rows = rows.crossJoin(F.broadcast(checkpointed(rows.agg(*stats))))

    def exponent(k):
        i = weighed.get(k)
        if i is None:
            return F.lit(None).cast("double")
        z = F.greatest(F.lit(-4.0), F.least(F.lit(4.0), (value(k) - F.col(f"_m_{i}")) / F.col(f"_d_{i}")))
        even = (F.col(f"_n_{i}") > 0) | (F.coalesce(F.col(f"_d_{i}"), F.lit(0.0)) == 0)
        return 1 / F.when(even, 1.0).otherwise(1 / (1 + F.exp(-z)))

    names = [(m, i, c, f"{c}|{seed}") for m, i, seed in masks for c in columns]
    rows = rows.select(key, *features, *(F.col(c).isNotNull().alias(f"_o_{j}") for j, c in enumerate(columns)), *(exponent(k).alias(f"_e_{i}") for k, i in weighed.items()))
    power = lambda m, c: F.col(f"_e_{weighed[m, c]}") if (m, c) in weighed else F.lit(None).cast("double")
    return rows, names, [(F.col(f"_o_{columns.index(c)}"), power(m, c)) for m, _, c, _ in names]


def _draw(u: Column, exponent: Column) -> Column:
    return F.when(exponent.isNull(), u).otherwise(1 - F.pow(u, exponent))


def _cells(rows: DataFrame, key: str, names: list, looks: list) -> DataFrame:
    """(_c, key, _u): the observed cells' draws. A cell's hash is made after the explode, in one compiled expression for all columns and masks."""
    cells = F.array(*(F.struct(F.lit(at).alias("_c"), F.lit(t).alias("_t"), o.alias("_o"), e.alias("_e")) for at, ((_, _, _, t), (o, e)) in enumerate(zip(names, looks))))
    cells = rows.select(key, F.explode(cells).alias("_x")).select(key, "_x.*").filter("_o")
    return cells.select("_c", key, _draw(unit_hash(F.col(key), F.col("_t")), F.col("_e")).alias("_u"))


def _hidden(df: DataFrame, key: str, features: list[str], sensitive: list[str], fraction: float, masks: list[tuple[str, int, int]]) -> DataFrame:
    """(mechanism, mask_index, column, key) of the cells that each of ``masks`` (mechanism, mask_index, seed) hides, all in the same passes."""
    rows, names, looks = _weighed(df, key, features, sensitive, masks)
    out = take_smallest(_cells(rows, key, names, looks), ["_c"], "_u", key, lambda n: mask_count(n, fraction))
    name = lambda at: F.get(F.array(*(F.lit(x[at]) for x in names)), F.col("_c"))
    return out.select(name(0).alias("mechanism"), name(1).alias("mask_index"), name(2).alias("column"), key)


@dataclass
class Hidden:
    """Rows with a bit of ``_hidden`` for each hidden cell of several masks: ``names`` has a (mechanism, mask_index, column) for each bit."""

    rows: DataFrame
    names: list[tuple[str, int, str]]

    def bit(self, mechanism: str, i: int, column: str) -> Column:
        """Whether a mask hides a row's cell."""
        name = (mechanism, i, column)
        return F.getbit("_hidden", F.lit(self.names.index(name))) == 1 if name in self.names else F.lit(False)


def hidden_grid(df: DataFrame, key: str, features: list[str], mechanisms: list[str], n_masks: int, seed: int = 0, fraction: float = 0.2, sensitive: list[str] = ()) -> Hidden:
    """The masks of ``mask_grid`` as bits of the rows that they hide cells of: no mask is a table, and no row is shuffled or joined.

    Bounds of the masks' columns (a row for each) go over the driver.
    """
    masks = _seeds(mechanisms, n_masks, seed)
    rows, names, looks = _weighed(df, key, features, sensitive, masks)
    if len(names) > 63:
        raise ValueError("a row's hidden cells are bits of one number: 63 at most")
    last = {r["_c"]: r for r in last_taken(_cells(rows, key, names, looks), ["_c"], "_u", key, lambda n: mask_count(n, fraction)).collect()}

    def hides(at):
        (o, e), end = looks[at], last[at]
        u = _draw(unit_hash(F.col(key), names[at][3]), e)
        return o & ((u < end["_tu"]) | ((u == end["_tu"]) & (F.col(key) <= end["_tk"])))

    bits = sum((F.when(hides(at), F.lit(1 << at)).otherwise(F.lit(0)).cast("bigint") for at in last), F.lit(0).cast("bigint"))
    return Hidden(rows.select(key, *features, bits.alias("_hidden")), [x[:3] for x in names])


def _seeds(mechanisms: list[str], n_masks: int, seed: int) -> list[tuple[str, int, int]]:
    return [(m, k, seed + 10_000 * i + k) for i, m in enumerate(mechanisms) for k in range(n_masks)]


def artificial_mask(df: DataFrame, key: str, features: list[str], sensitive: list[str] = (), fraction: float = 0.2, mechanism: str = "mcar", seed: int = 0) -> DataFrame:
    """(column, key) of observed cells to hide, a fixed share of each non-sensitive column.

    mar weights rows by the logistic of the clipped z-score of the first other numeric feature,
    mnar by that of the column itself (text by its sorted codes); where that feature is
    constant or incomplete, weights are even. Weighted draws without replacement order rows by
    1 - u^(1/w), u the row's hash.
    """
    return _hidden(df, key, features, sensitive, fraction, [(mechanism, 0, seed)]).select("column", key)


def mask_grid(df: DataFrame, key: str, features: list[str], mechanisms: list[str], n_masks: int, seed: int = 0, fraction: float = 0.2, sensitive: list[str] = ()) -> DataFrame:
    """(mechanism, mask_index, column, key); the seed is base + 10000 x mechanism + mask."""
    return _hidden(df, key, features, sensitive, fraction, _seeds(mechanisms, n_masks, seed))


def apply_mask(df: DataFrame, mask: DataFrame, key: str) -> DataFrame:
    """Null in exactly the listed cells."""
    columns = [c for c in df.columns if c != key]
    flags = mask.groupBy(F.col(key).alias("_k")).agg(*(F.bool_or(F.col("column") == c).alias(f"_m_{c}") for c in columns))
    joined = df.join(flags, F.col(key) == F.col("_k"), "left")
    return joined.select(key, *(F.when(~F.coalesce(F.col(f"_m_{c}"), F.lit(False)), F.col(c)).alias(c) for c in columns))


def mask_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cells in one mask only, as often as they are there more; empty if a stored mask is what its seed makes. Each mask is made once."""
    sides = a.withColumn("_d", F.lit(1)).unionAll(b.withColumn("_d", F.lit(-1)))
    more = sides.groupBy(*a.columns).agg(F.abs(F.sum("_d")).cast("int").alias("_d")).filter("_d > 0")
    return more.withColumn("_d", F.explode(F.array_repeat(F.lit(0), F.col("_d")))).drop("_d")


def proportional_resample(df: DataFrame, target: str, shares: dict[str, float], n: int, key: str, seed: int = 0) -> DataFrame:
    """round(n x share) rows of each class; rows repeat only where a class is too small."""
    spark = df.sparkSession
    want = spark.createDataFrame([(str(c), round(n * p)) for c, p in shares.items()], "_c string, _want bigint")
    rows = df.withColumns({"_c": F.col(target).cast("string"), "_u": unit_hash(F.col(key), seed)})
    sizes = rows.groupBy("_c").agg(F.count("*").alias("_n")).join(F.broadcast(want), "_c")
    rest = sizes.select("_c", (F.col("_want") % F.col("_n")).alias("take"))
    extra = take_smallest(rows, ["_c"], "_u", key, rest.filter("take > 0"))
    whole = rows.join(F.broadcast(sizes.select("_c", F.expr("cast(_want div _n as int)").alias("_times")).filter("_times > 0")), "_c")
    whole = whole.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_i", "_times")
    return whole.unionByName(extra).drop("_c", "_u")


def normal_hash(key: Column, *seed: object) -> Column:
    """A standard normal number from hashes of the key and the seed (Box and Muller's form)."""
    return F.sqrt(-2 * F.ln(unit_hash(key, *seed, "r"))) * F.cos(unit_hash(key, *seed, "a") * 6.283185307179586)


def balanced_seed_sample(df: DataFrame, target: str, n: int, key: str, features: list[str], seed: int = 0, jitter: float = 0.01) -> DataFrame:
    """Equal counts of each class, features moved by Gaussian noise of ``jitter`` deviations, the same for all copies of a row."""
    classes = [r[0] for r in df.select(F.col(target).cast("string")).distinct().collect()]
    rows = proportional_resample(df, target, {c: 1 / len(classes) for c in classes}, n, key, seed)
    stats = df.agg(*(F.stddev_pop(f).alias(f"_d_{f}") for f in features))
    return rows.crossJoin(F.broadcast(stats)).withColumns({f: F.col(f) + normal_hash(F.col(key).cast("string"), f, seed) * jitter * F.col(f"_d_{f}") for f in features}).drop(*(f"_d_{f}" for f in features))


def sample_column(df: DataFrame, column: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """n values of a column without replacement."""
    return df.select(column, key, unit_hash(F.col(key), seed).alias("_u")).orderBy("_u", key).limit(n).select(column)


def shuffle(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """A seeded permutation: sorted by hash, with ``place`` from the sort's own order kept as a hash."""
    return df.withColumn("place", F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary"))).orderBy("place")
