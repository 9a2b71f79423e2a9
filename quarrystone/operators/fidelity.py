"""Distributions and marginal metrics: real against candidates, all columns and models at once.

Wide tables are unpivoted once to (model, column, value) and counted by column; whatever
follows works on counts. Order statistics window over distinct values with their counts.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quarrystone.functions.numeric import erfc
from quarrystone.functions.session import checkpointed
from quarrystone.operators.association import associations, by_key, correlation_ratios
from quarrystone.operators.clean import complete_cases
from quarrystone.operators.order import quantiles, running


def frequencies(df: DataFrame, column: str, keys: list[str] = ()) -> DataFrame:
    """Counts and shares of a column's values; null is left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("string").alias("value")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*keys) if keys else W.partitionBy()))


def class_proportions(df: DataFrame, target: str) -> DataFrame:
    f = frequencies(df, target)
    return f.withColumn("top", F.col("share") == F.max("share").over(W.partitionBy()))


def histogram(df: DataFrame, column: str, bins: int, keys: list[str] = ()) -> DataFrame:
    """Equal-width density histogram over the finite values: bin (from 0), low, high, n, density."""
    x = F.col(column).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))).withColumn("_x", x)
    bounds = rows.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count("*").alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("_x") - F.col("_lo")) / width))).otherwise(0).cast("int")
    binned = rows.crossJoin(F.broadcast(bounds)).groupBy(*keys, at.alias("bin"), "_lo", width.alias("_w")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(*keys) if keys else W.partitionBy())
    return binned.select(*keys, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("low"), (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("high"), "n", (F.col("n") / (total * F.col("_w"))).alias("density"))


def kde_grid(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density (Scott's bandwidth) on even points from min to max, over distinct values with
    their counts; nothing for fewer than two distinct values."""
    values = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("w"))
    s = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"), (F.stddev_samp(column) * F.pow(F.count(column), F.lit(-0.2))).alias("h"), F.count(column).alias("n")).filter("hi > lo")
    grid = s.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")).withColumn("x", F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1))
    both = values.crossJoin(F.broadcast(grid))  # a fixed number of points beside each distinct value
    z = (F.col("x") - F.col("v")) / F.col("h")
    return both.groupBy("i", "x").agg((F.sum(F.col("w") * F.exp(-z * z / 2)) / (F.first("n") * F.first("h") * 2.5066282746310002)).alias("density"))


def observed_vs_imputed(original: DataFrame, imputed: DataFrame, key: str, column: str) -> DataFrame:
    """Shares of a categorical column's values among observed and among imputed cells."""
    gaps = original.select(F.col(key).alias("_k"), F.col(column).isNull().alias("_g"))
    rows = imputed.join(gaps, F.col(key) == F.col("_k")).select(F.when(F.col("_g"), "imputed").otherwise("observed").alias("source"), column)
    return frequencies(rows, column, ["source"])


def real_vs_synthetic(real: DataFrame, syn: DataFrame, column: str, order: list[str] = ()) -> DataFrame:
    """value, place, real share and share for each model; configured values first, others sorted after."""
    a, b = frequencies(real, column).select("value", F.col("share").alias("real")), frequencies(syn, column, ["model"]).select("model", "value", "share")
    models = syn.select("model").distinct()
    values = a.select("value").union(b.select("value")).distinct()
    out = values.crossJoin(F.broadcast(models)).join(a, "value", "left").join(b, ["model", "value"], "left").fillna(0.0, ["real", "share"])
    return out.withColumn("place", category_place(F.col("value"), list(order)))


def category_place(value: Column, order: list[str]) -> Column:
    """Sort key: position in the configured order, or behind it."""
    at = F.array_position(F.array(*map(F.lit, order)), value) if order else F.lit(0)
    return F.when(at > 0, at).otherwise(F.lit(len(order) + 1)).cast("int")


def order_categories(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    return df.select(column).distinct().withColumn("place", category_place(F.col(column).cast("string"), order)).orderBy("place", column)


def category_union(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    return a.select(column).union(b.select(column)).distinct()


def column_distributions(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, n of several categorical columns in one pass."""
    long = df.select(*(F.col(c).cast("string").alias(c) for c in columns)).unpivot([], columns, "column", "value")
    return long.filter("value IS NOT NULL").groupBy("column", "value").agg(F.count("*").alias("n"))


def stack_sources(sources: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(m).alias("source"), *columns) for m, df in sources.items()])


# marginals of real and candidates


def marginals(real: DataFrame, syn: DataFrame, categorical: list[str], numeric: list[str], bins: int = 10) -> DataFrame:
    """model, column, value, p (real share), q (candidate share), n (the candidates' cells); numeric columns cut at the real side's even bins.

    A column that is constant on the real side has its value in the first bin and all above it in the last.
    """
    stats = real.agg(*(x for c in numeric for x in (F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}"))))

    def cells(df, *keys):
        even = lambda c: F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor((F.col(c) - F.col(f"_lo_{c}")) / ((F.col(f"_hi_{c}") - F.col(f"_lo_{c}")) / bins))))
        cut = lambda c: F.when(F.col(f"_hi_{c}") > F.col(f"_lo_{c}"), even(c)).when(F.col(c) > F.col(f"_hi_{c}"), bins - 1).when(F.col(c).isNotNull(), 0).cast("int").cast("string")
        wide = (df.crossJoin(F.broadcast(stats)) if numeric else df).select(*keys, *(F.col(c).cast("string").alias(c) for c in categorical), *(cut(c).alias(c) for c in numeric))
        long = wide.unpivot(list(keys), [*categorical, *numeric], "column", "value").filter("value IS NOT NULL")
        counts = long.groupBy(*keys, "column", "value").agg(F.count("*").alias("n"))
        whole = F.sum("n").over(W.partitionBy(*keys, "column"))
        return counts.withColumns({"share": F.col("n") / whole, "n": whole})

    a, b = cells(real).drop("n").withColumnRenamed("share", "p"), cells(syn, "model").withColumnRenamed("share", "q")
    base = a.crossJoin(F.broadcast(syn.select("model").distinct()))
    both = base.join(b, ["model", "column", "value"], "full_outer").fillna(0.0, ["p", "q"])
    return both.withColumn("n", F.coalesce(F.max("n").over(W.partitionBy("model", "column")), F.lit(0)))


def _per_model(m: DataFrame, term: Column, final=lambda s: s) -> DataFrame:
    return m.groupBy("model", "column").agg(final(F.sum(term)).alias("d")).groupBy("model").agg(F.avg("d").alias("value"))


def jensenshannon_dist(m: DataFrame) -> DataFrame:
    mid = (F.col("p") + F.col("q")) / 2
    part = lambda x: F.when(x > 0, x * F.ln(x / mid)).otherwise(0.0)
    return _per_model(m, (part(F.col("p")) + part(F.col("q"))) / 2, lambda s: F.sqrt(F.greatest(s, F.lit(0.0))))


def inv_kl_divergence(m: DataFrame, eps: float = 1e-6) -> DataFrame:
    p, q = F.greatest("p", F.lit(eps)), F.greatest("q", F.lit(eps))
    return _per_model(m, p * F.ln(p / q), lambda s: 1 / (1 + s))


def h_dist(m: DataFrame) -> DataFrame:
    d = F.sqrt("p") - F.sqrt("q")
    return _per_model(m, d * d, lambda s: F.sqrt(s / 2))


def total_variation(m: DataFrame) -> DataFrame:
    return _per_model(m, F.abs(F.col("p") - F.col("q")) / 2)


def chi_squared_statistic(m: DataFrame) -> DataFrame:
    return _per_model(m, F.when(F.col("p") > 0, (F.col("q") - F.col("p")) * (F.col("q") - F.col("p")) / F.col("p")).otherwise(0.0))


def chi_squared_p(statistic: Column, freedom: Column) -> Column:
    """Upper tail of the chi-squared distribution by the cube-root normal form (Wilson and Hilferty), good to about 1e-3."""
    t = 2 / (9 * freedom)
    z = (F.cbrt(statistic / freedom) - (1 - t)) / F.sqrt(t) / F.sqrt(F.lit(2.0))
    tail = erfc(F.abs(z)) / 2
    return F.when((freedom < 1) | (statistic <= 0), 1.0).otherwise(F.when(z >= 0, tail).otherwise(1 - tail))


def chi_squared_test(m: DataFrame) -> DataFrame:
    """Mean over columns of the p value that candidates were drawn from the real side's shares; a value the real side lacks gives 0."""
    gap = F.col("q") - F.col("p")
    one = m.groupBy("model", "column").agg(
        F.sum(F.when(F.col("p") > 0, F.col("n") * gap * gap / F.col("p")).otherwise(0.0)).alias("s"), (F.count_if(F.col("p") > 0) - 1).alias("k"), F.max((F.col("p") == 0) & (F.col("q") > 0)).alias("new")
    )
    return one.groupBy("model").agg(F.avg(F.when(F.col("new"), 0.0).otherwise(chi_squared_p(F.col("s"), F.col("k")))).alias("value"))


def _cumulative(real: DataFrame, syn: DataFrame, numeric: list[str]) -> DataFrame:
    """model, column, v with both cumulative shares and the next value, on distinct values with counts."""
    long = lambda df, *k: df.select(*k, *(F.col(c).cast("double").alias(c) for c in numeric)).unpivot(list(k), numeric, "column", "v").filter("v IS NOT NULL").groupBy(*k, "column", "v").agg(F.count("*").alias("n"))
    a = long(real).crossJoin(F.broadcast(syn.select("model").distinct())).select("model", "column", "v", F.col("n").alias("a"), F.lit(0).cast("bigint").alias("b"))
    b = long(syn, "model").select("model", "column", "v", F.lit(0).cast("bigint").alias("a"), F.col("n").alias("b"))
    both = a.unionByName(b).groupBy("model", "column", "v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    rows = running(both, ["model", "column"], "v", ["a", "b"])
    share = lambda c: F.when(F.col(f"all_{c}") > 0, F.col(f"cum_{c}") / F.col(f"all_{c}")).otherwise(0.0)
    return rows.select("model", "column", "v", share("a").alias("fa"), share("b").alias("fb"), "next")


def ks_of(cumulative: DataFrame) -> DataFrame:
    c = cumulative.groupBy("model", "column").agg(F.max(F.abs(F.col("fa") - F.col("fb"))).alias("d"))
    return c.groupBy("model").agg(F.avg(1 - F.col("d")).alias("value"))


def ks_test(real: DataFrame, syn: DataFrame, numeric: list[str]) -> DataFrame:
    """1 less the Kolmogorov-Smirnov statistic, averaged over columns."""
    return ks_of(_cumulative(real, syn, numeric))


def wasserstein_of(cumulative: DataFrame) -> DataFrame:
    area = F.abs(F.col("fa") - F.col("fb")) * (F.col("next") - F.col("v"))
    return cumulative.groupBy("model").agg(F.coalesce(F.sum(area), F.lit(0.0)).alias("value"))


def wasserstein_dist(real: DataFrame, syn: DataFrame, numeric: list[str]) -> DataFrame:
    """The sum over columns of one-dimensional Wasserstein distances."""
    return wasserstein_of(_cumulative(real, syn, numeric))


def data_mismatch(real: DataFrame, syn: DataFrame) -> DataFrame:
    types = dict(syn.dtypes)
    bad = sum(types.get(c) != k for c, k in real.dtypes)
    return syn.select("model").distinct().withColumn("value", F.lit(bad / len(real.columns)))


def common_rows_proportion(real: DataFrame, syn: DataFrame, columns: list[str]) -> DataFrame:
    r = real.select(*(F.col(c).alias(f"_{c}") for c in columns)).distinct().withColumn("_hit", F.lit(1))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns]
    return syn.join(r, on, "left").groupBy("model").agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("value"))


def dwm(real: DataFrame, syn: DataFrame, numeric: list[str]) -> DataFrame:
    """Mean absolute difference of column means on the real side's scale."""
    s = real.agg(*(x for c in numeric for x in (F.avg(c).alias(f"_m_{c}"), (F.max(c) - F.min(c)).alias(f"_r_{c}"))))
    g = syn.groupBy("model").agg(*(F.avg(c).alias(c) for c in numeric)).crossJoin(F.broadcast(s))
    parts = [F.abs(F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_r_{c}") > 0, F.col(f"_r_{c}")).otherwise(1.0) for c in numeric]
    return g.select("model", (reduce(lambda a, b: a + b, parts) / len(parts)).alias("value"))


def cio(real: DataFrame, syn: DataFrame, numeric: list[str], z: float = 1.959963984540054) -> DataFrame:
    """Mean overlap of the 95 % confidence intervals of column means."""
    ends = lambda c, p: ((F.avg(c) - z * F.stddev_samp(c) / F.sqrt(F.count(c))).alias(f"{p}l_{c}"), (F.avg(c) + z * F.stddev_samp(c) / F.sqrt(F.count(c))).alias(f"{p}h_{c}"))
    g = syn.groupBy("model").agg(*(x for c in numeric for x in ends(c, "s"))).crossJoin(F.broadcast(real.agg(*(x for c in numeric for x in ends(c, "r")))))
    def overlap(c):
        low, high = F.greatest(f"rl_{c}", f"sl_{c}"), F.least(f"rh_{c}", f"sh_{c}")
        # an interval without width (a constant column) is covered or not
        part = lambda p: F.when(F.col(f"{p}h_{c}") > F.col(f"{p}l_{c}"), (high - low) / (F.col(f"{p}h_{c}") - F.col(f"{p}l_{c}"))).when(high >= low, 1.0).otherwise(-1.0)
        return F.greatest(F.lit(0.0), part("r") / 2 + part("s") / 2)
    return g.select("model", (reduce(lambda a, b: a + b, map(overlap, numeric)) / len(numeric)).alias("value"))


def pair_sums(df: DataFrame, keys: list[str], numeric: list[str]) -> DataFrame:
    """(keys, i, j, n, sx, sy, sxx, syy, sxy) for i < j: sums over the rows where both numeric columns are there, about the columns' means.

    A task sums matrix products, so the plan and the shuffle don't grow with rows times pairs.
    """
    means = df.agg(*(F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in numeric)).first()
    centred = df.select(*keys, F.array(*((F.col(c) - F.lit(float(means[c]))).cast("double") for c in numeric)).alias("_v"))
    d, names = len(numeric), ["n", "sx", "sy", "sxx", "syy", "sxy"]
    at = np.triu_indices(d, 1)

    def run(batches):
        sums: dict[tuple, list[np.ndarray]] = {}
        for b in batches:
            known, which = by_key(b, keys)
            kinds = [b.schema.field(k).type for k in keys]
            v = pa.concat_arrays([b.column("_v")]).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            for i, key in enumerate(known):
                x = v[which == i]
                there = ~np.isnan(x)
                x, m = np.where(there, x, 0), there.astype(float)
                part = [m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x]
                sums[key] = [a + p for a, p in zip(sums[key], part)] if key in sums else part
        for key, parts in sums.items():
            columns = [pa.array([k] * len(at[0]), t) for k, t in zip(key, kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), *(pa.array(p[at]) for p in parts)], names=[*keys, "i", "j", *names])

    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), "i int", "j int", *(f"{n} double" for n in names)])
    return centred.mapInArrow(run, schema).groupBy(*keys, "i", "j").agg(*(F.sum(n).alias(n) for n in names))


def correlations(df: DataFrame, keys: list[str], numeric: list[str]) -> DataFrame:
    """(keys, i, j, r): Pearson's correlation of each pair of columns, 0 where one is constant."""
    n = F.col("n")
    a, b = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / F.sqrt(a * b)
    tiny = 1e-12  # what rounding leaves of a constant column
    return pair_sums(df, keys, numeric).select(*keys, "i", "j", F.when((n > 1) & (a > tiny * F.col("sxx")) & (b > tiny * F.col("syy")) & (a > 0) & (b > 0), r).otherwise(0.0).alias("r"))


def cramers_v(df: DataFrame, keys: list[str], categorical: list[str]) -> DataFrame:
    """(keys, i, j, r): Cramer's V of each pair of categorical columns, 0 where one has a single value."""
    return associations(df, keys, categorical, "cramers_v")


def _pair_difference(real: DataFrame, syn: DataFrame, value: str = "r") -> DataFrame:
    """model, value: the sum over pairs of absolute differences of two (i, j, r) tables."""
    return syn.join(real.select("i", "j", F.col(value).alias("_r")), ["i", "j"]).groupBy("model").agg(F.sum(F.abs(F.col(value) - F.col("_r"))).alias("value"))


def corr_diff(real: DataFrame, syn: DataFrame, numeric: list[str], categorical: list[str] = ()) -> DataFrame:
    """Sum of absolute differences of the correlations of all pairs: Pearson's, Cramer's V, and the correlation ratio of mixed ones."""
    parts = []
    if len(numeric) > 1:
        parts.append(_pair_difference(correlations(real, [], numeric), correlations(syn, ["model"], numeric)))
    if len(categorical) > 1:
        parts.append(_pair_difference(cramers_v(real, [], categorical), cramers_v(syn, ["model"], categorical)))
    if numeric and categorical:
        parts.append(_pair_difference(correlation_ratios(real, [], categorical, numeric), correlation_ratios(syn, ["model"], categorical, numeric)))
    return reduce(DataFrame.unionByName, parts).groupBy("model").agg(F.sum("value").alias("value"))


def mutual_information(df: DataFrame, keys: list[str], categorical: list[str]) -> DataFrame:
    """(keys, i, j, r): mutual information of each pair of columns over the root of their entropies' product, 0 where one has a single value."""
    return associations(df, keys, categorical, "mutual_information")


def mi_diff(real: DataFrame, syn: DataFrame, categorical: list[str]) -> DataFrame:
    """Sum over pairs of absolute differences of the normalised mutual information."""
    return _pair_difference(mutual_information(real, [], categorical), mutual_information(syn, ["model"], categorical))


def q_mse(real: DataFrame, syn: DataFrame, numeric: list[str], n: int = 10) -> DataFrame:
    """Squared error of candidate shares in the real side's quantile bins, averaged over bins and columns."""
    cells = real.select(*(F.col(c).cast("double").alias(c) for c in numeric)).unpivot([], numeric, "column", "v")
    found = quantiles(cells, "v", [k / n for k in range(1, n)], ["column"]).collect()  # n numbers a column
    cuts = {c: sorted(r["value"] for r in found if r["column"] == c) for c in numeric}
    place = lambda c: F.size(F.filter(F.array(*map(F.lit, cuts[c])), lambda q: q < F.col(c)))
    long = lambda df, *k: df.select(*k, *(place(c).alias(c) for c in numeric)).unpivot(list(k), numeric, "column", "bin").groupBy(*k, "column", "bin").agg(F.count("*").alias("n"))
    share = lambda df, *k: df.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy(*k, "column"))).drop("n")
    a = share(long(real)).withColumnRenamed("share", "p").crossJoin(F.broadcast(syn.select("model").distinct()))
    both = a.join(share(long(syn, "model"), "model").withColumnRenamed("share", "q"), ["model", "column", "bin"], "full_outer").fillna(0.0, ["p", "q"])
    return both.groupBy("model").agg(F.avg((F.col("p") - F.col("q")) * (F.col("p") - F.col("q"))).alias("value"))


def class_sizes(df: DataFrame, quasi: list[str], keys: list[str] = ()) -> DataFrame:
    return df.groupBy(*keys, *quasi).agg(F.count("*").alias("n"))


def k_anonymization(syn: DataFrame, quasi: list[str]) -> DataFrame:
    return class_sizes(syn, quasi, ["model"]).groupBy("model").agg(F.min("n").alias("value"))


def _beside_real(real: DataFrame, classes: DataFrame, quasi: list[str]) -> DataFrame:
    """classes with _r, how many real rows are of the same class, 0 if none; null is a value like any other."""
    sizes = class_sizes(real, quasi).select(*(F.col(c).alias(f"_q{i}") for i, c in enumerate(quasi)), F.col("n").alias("_n"))
    same = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_q{i}")) for i, c in enumerate(quasi)))
    return classes.join(sizes, same, "left").select(*classes.columns, F.coalesce("_n", F.lit(0)).alias("_r"))


def k_map(real: DataFrame, syn: DataFrame, quasi: list[str]) -> DataFrame:
    """The smallest real count behind a class that a candidate uses; null is a value."""
    return _beside_real(real, syn.select("model", *quasi).distinct(), quasi).groupBy("model").agg(F.min("_r").alias("value"))


def l_diversity(syn: DataFrame, quasi: list[str], sensitive: str) -> DataFrame:
    return syn.groupBy("model", *quasi).agg(F.count_distinct(sensitive).alias("d")).groupBy("model").agg(F.min("d").alias("value"))


def delta_presence(real: DataFrame, syn: DataFrame, quasi: list[str]) -> DataFrame:
    """The largest ratio of a class' candidate count to its real count; null is a value. A model whose classes have no real row has none."""
    both = _beside_real(real, class_sizes(syn, quasi, ["model"]), quasi)
    return both.groupBy("model").agg(F.max(F.when(F.col("_r") > 0, F.col("n") / F.col("_r"))).alias("value"))


def hit_rate(real: DataFrame, syn: DataFrame, categorical: list[str], numeric: list[str], key: str, share: float = 1 / 30, bucketed: int = 3) -> DataFrame:
    """Share of real rows with a candidate row equal on categories and within a share of each numeric range.

    Rows meet in buckets of the first ``bucketed`` numeric columns, as wide as the tolerance: a real
    row looks into its own bucket and its neighbours in each. It's a semi join, so a row stops at its first hit.
    """
    s = real.agg(*(((F.max(c) - F.min(c)) * share).alias(f"_t_{c}") for c in numeric))
    cut = numeric[:bucketed]
    # a column without a range has a tolerance of 0 and one bucket; equality is left to the comparison
    bucket = lambda c: F.when(F.col(f"_t_{c}") > 0, F.floor(F.col(c) / F.col(f"_t_{c}"))).otherwise(0).cast("bigint")
    b = syn.crossJoin(F.broadcast(s)).select(F.col("model").alias("_model"), *(F.col(c).alias(f"_{c}") for c in [*categorical, *numeric]), *(bucket(c).alias(f"_b_{c}") for c in cut)).distinct()
    a = real.crossJoin(F.broadcast(s)).crossJoin(F.broadcast(syn.select("model").distinct()))
    on = F.col("model") == F.col("_model")
    for c in cut:
        a = a.withColumn(f"_a_{c}", F.explode(F.array(bucket(c) - 1, bucket(c), bucket(c) + 1)))
        on = on & (F.col(f"_a_{c}") == F.col(f"_b_{c}"))
    for c in categorical:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    for c in numeric:
        on = on & (F.abs(F.col(c) - F.col(f"_{c}")) <= F.col(f"_t_{c}"))
    hits = a.join(b, on, "left_semi").select("model", key).distinct().groupBy("model").agg(F.count("*").alias("n"))
    total = real.agg(F.count("*").alias("_all"))
    rate = F.when(F.col("_all") > 0, F.coalesce("n", F.lit(0)) / F.col("_all"))
    return syn.select("model").distinct().join(hits, "model", "left").crossJoin(F.broadcast(total)).select("model", rate.alias("value"))


def max_mean_discrepancy(real: DataFrame, syn: DataFrame, numeric: list[str], block_rows: int = 4096) -> DataFrame:
    """model, value and linear: the squared discrepancies of a Gaussian and of the linear kernel, on the real side's deviations.

    The Gaussian kernel is exp(-|x - y|^2 / (2 d)), d the number of columns. It's exact over all
    rows: equal rows are one point with a count, points are dealt into blocks, and blocks meet
    pairwise as matrix products in Arrow batches. Rows with a null are left out.
    """
    s = real.agg(*(x for c in numeric for x in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))))
    z = lambda c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") > 0, F.col(f"_s_{c}")).otherwise(1.0)
    g = syn.groupBy("model").agg(*(F.avg(c).alias(c) for c in numeric)).crossJoin(F.broadcast(s))
    linear = g.select("model", reduce(lambda a, b: a + b, [z(c) * z(c) for c in numeric]).alias("linear"))

    # sides are named 'r' and 'c' with the model's name
    sides = real.select(F.lit("r").alias("side"), *numeric).unionByName(syn.select(F.concat(F.lit("c"), F.col("model").cast("string")).alias("side"), *numeric))
    points = complete_cases(sides, numeric).crossJoin(F.broadcast(s)).select("side", F.array(*(z(c).cast("double") for c in numeric)).alias("v")).groupBy("side", "v").agg(F.count("*").alias("n"))
    sizes = checkpointed(points.groupBy("side").agg(F.sum("n").alias("rows"), F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")))  # a row for each side
    dealt = points.join(F.broadcast(sizes.select("side", "blocks")), "side")
    blocks = dealt.withColumn("b", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")).groupBy("side", "b").agg(F.collect_list("v").alias("v"), F.collect_list("n").alias("n"))
    end = lambda i: [F.col("side").alias(f"s{i}"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(f"b{i}")]
    wanted = sizes.select(*end(1)).crossJoin(sizes.select(*end(2))).filter("s1 = s2 OR s1 = 'r'")  # within each side, and real against candidates
    side = lambda i: blocks.select(F.col("side").alias(f"s{i}"), F.col("b").alias(f"b{i}"), F.col("v").alias(f"v{i}"), F.col("n").alias(f"n{i}"))
    met = side(1).join(wanted, ["s1", "b1"]).join(side(2), ["s2", "b2"])
    width = 2.0 * len(numeric)

    def kernel(batches):
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                side = [np.array(batch.column(c)[r].as_py(), float) for c in ("v1", "n1", "v2", "n2")]
                total = 0.0
                for i in range(0, len(side[0]), 512):
                    d = ((side[0][i : i + 512, None, :] - side[2][None, :, :]) ** 2).sum(axis=2)
                    total += float(side[1][i : i + 512] @ np.exp(-d / width) @ side[3])
                out.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("s1"), batch.column("s2"), pa.array(out, pa.float64())], names=["s1", "s2", "k"])

    sums = met.mapInArrow(kernel, "s1 string, s2 string, k double").groupBy("s1", "s2").agg(F.sum("k").alias("k"))
    at = lambda i: F.broadcast(sizes.select(F.col("side").alias(f"s{i}"), F.col("rows").alias(f"_n{i}")))
    means = sums.join(at(1), "s1").join(at(2), "s2").select("s1", "s2", (F.col("k") / F.col("_n1") / F.col("_n2")).alias("k"))
    own = means.filter("s1 = 'r' AND s2 = 'r'").select(F.col("k").alias("_own"))
    rows = means.filter("s2 <> 'r'").groupBy(F.substring("s2", 2, 1 << 30).alias("model")).agg(F.sum(F.when(F.col("s1") == "r", -2 * F.col("k")).otherwise(F.col("k"))).alias("_rest"))
    rbf = rows.crossJoin(F.broadcast(own)).select("model", F.greatest(F.lit(0.0), F.col("_own") + F.col("_rest")).alias("value"))
    return linear.join(rbf, "model", "left").select("model", "value", "linear")
