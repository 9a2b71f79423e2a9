"""Representation fairness: log disparity of subgroup rates, real against candidates.

Rows are counted once per side (partial counts before the shuffle); all that follows
works on one row for each model and subgroup, so its windows are small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quarrystone.functions.numeric import erfc, pretty_name

NO_INFO, NO_BASE, INSUFFICIENT = -9999999.0, -8888888.0, -7777777.0
SIGNIFICANT, MODERATE, EXTREME = 0.05, -math.log(0.9), -math.log(0.8)
#: Labels and their display colours (fixed values).
COLORS = {
    "Highly Underrepresented": "#d58570",
    "Underrepresented": "#eabcad",
    "Equitable": "#d4e6e8",
    "Equitable(p)": "#d4e6e8",
    "Overrepresented": "#a5b0cb",
    "Highly Overrepresented": "#00205b",
    "Absent": "#ab2328",
    "No Info": "#000000",
    "No Base Data": "#54585a",
    "Insufficient Data": "#000000",
}
_INF = float("inf")


def rate(n: Column, total: Column) -> Column:
    return F.when(total == 0, 0.0).otherwise(n / total)


def log_disparity(alpha: Column, beta: Column, for_plot: bool = False) -> Column:
    """log odds of beta less those of alpha; sentinels where a rate is zero, infinities where one is."""
    out = F.when((beta == 1) & (alpha == 1), 0.0).when(beta == 1, _INF).when(alpha == 1, -_INF)
    if not for_plot:
        out = F.when((beta == 0) & (alpha == 0), NO_INFO).when(beta == 0, -_INF).when(alpha == 0, NO_BASE).when((beta == 1) & (alpha == 1), 0.0).when(beta == 1, _INF).when(alpha == 1, -_INF)
    return out.otherwise(F.ln(beta / (1 - beta)) - F.ln(alpha / (1 - alpha)))


def proportion_test(bg_n: Column, bg_total: Column, ob_n: Column, ob_total: Column) -> Column:
    """p of the chi-squared test on 2 x 2 counts without correction; a sentinel if a count is under 5."""
    a, b, c, d = ob_n.cast("double"), (ob_total - ob_n).cast("double"), bg_n.cast("double"), (bg_total - bg_n).cast("double")
    chi2 = (a + b + c + d) * (a * d - b * c) * (a * d - b * c) / ((a + b) * (c + d) * (a + c) * (b + d))
    none = F.when((ob_n == 0) & (bg_n == 0), NO_INFO).when(bg_n == 0, NO_BASE)
    return F.when((a >= 5) & (b >= 5) & (c >= 5) & (d >= 5), erfc(F.sqrt(chi2 / 2))).otherwise(F.coalesce(none, F.lit(INSUFFICIENT)))


def bh_adjust(df: DataFrame, p: str, family: list[str], out: str = "bh_p") -> DataFrame:
    """Benjamini-Hochberg within each family; p outside [0, 1] gets null and doesn't count."""
    valid = F.col(p).between(0, 1)
    df = df.withColumn("_v", F.coalesce(valid, F.lit(False)))
    group = W.partitionBy(*family, "_v")
    ranked = df.withColumns({"_k": F.row_number().over(group.orderBy(p)), "_n": F.count("*").over(group)})
    raw = F.col(p) * F.col("_n") / F.col("_k")
    running = F.min(raw).over(group.orderBy(F.col("_k").desc()).rowsBetween(W.unboundedPreceding, 0))
    return ranked.withColumn(out, F.when(F.col("_v"), F.least(running, F.lit(1.0)))).drop("_v", "_k", "_n")


def equity_label(value: Column, bh_p: Column) -> Column:
    return (
        F.when(value == -_INF, "Absent").when(value == NO_INFO, "No Info").when(value == NO_BASE, "No Base Data").when(value == INSUFFICIENT, "Insufficient Data")
        .when(bh_p > SIGNIFICANT, "Equitable(p)")
        .when(value < -EXTREME, "Highly Underrepresented").when(value < -MODERATE, "Underrepresented")
        .when(value > EXTREME, "Highly Overrepresented").when(value > MODERATE, "Overrepresented").otherwise("Equitable")
    )


def equity_color(label: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in COLORS.items() for x in kv))[label], F.lit("#000000"))


def format_equity(value: Column, bh_p: Column) -> Column:
    """Three decimals, sentinels as they are, a star where the difference isn't significant."""
    text = F.when(value.isNull(), "NA").when(value == -_INF, "-Inf").when(value == _INF, "+Inf").when(value.isin(NO_INFO, NO_BASE, INSUFFICIENT), value.cast("bigint").cast("string")).otherwise(F.format_string("%.3f", value))
    return F.concat(text, F.when(bh_p > SIGNIFICANT, "*").otherwise(""))


def format_p(p: Column) -> Column:
    return F.when(p.isNull(), "NA").otherwise(F.format_string("%.3f", p))


def tooltip_value(value: Column) -> Column:
    return (
        F.when(value == NO_INFO, "No Info").when(value == NO_BASE, "No Base Data").when(value == INSUFFICIENT, "Insufficient Data")
        .when(value == -_INF, "-Inf (Absent)").when(value == _INF, "+Inf").otherwise(F.format_string("%+.4f", value))
    )


def group_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def join_counts(real: DataFrame, syn: DataFrame, keys: list[str]) -> DataFrame:
    """background_n and user_n for each model and key, 0 where a side has none; a null key equals itself."""
    base = real.crossJoin(F.broadcast(syn.select("model").distinct()))
    names = ["model", *keys]
    other = syn.select(*(F.col(k).alias(f"_s_{k}") for k in names), "user_n")
    on = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in names]
    both = base.join(other, on, "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return both.select(*(F.coalesce(k, f"_s_{k}").alias(k) for k in names), zero("background_n"), zero("user_n"))


def attach_disparity(counts: DataFrame, totals: DataFrame, family: list[str]) -> DataFrame:
    """Rates, p, adjusted p, value, label and colour. totals: model, total_background, total_user."""
    df = counts.join(F.broadcast(totals), "model")
    df = df.withColumns({
        "background_rate": rate(F.col("background_n"), F.col("total_background")), "observed_rate": rate(F.col("user_n"), F.col("total_user")),
        "p_value": proportion_test(F.col("background_n"), F.col("total_background"), F.col("user_n"), F.col("total_user")),
    })
    df = bh_adjust(df, "p_value", family)
    df = df.withColumn("equity_value", log_disparity(F.col("background_rate"), F.col("observed_rate")))
    df = df.withColumn("equity_label", equity_label(F.col("equity_value"), F.col("bh_p")))
    return df.withColumn("equity_color", equity_color(F.col("equity_label")))


def _totals(real: DataFrame, syn: DataFrame) -> DataFrame:
    n = real.agg(F.sum("background_n").alias("total_background"))
    return syn.groupBy("model").agg(F.sum("user_n").alias("total_user")).crossJoin(F.broadcast(n))


def disparity_leaf(real: DataFrame, syn: DataFrame, target: str, protected: list[str]) -> DataFrame:
    """One row for each model and combination of target and protected groups."""
    keys = [target, *protected]
    bg, us = group_counts(real, keys, "background_n"), group_counts(syn, ["model", *keys], "user_n")
    return attach_disparity(join_counts(bg, us, keys), _totals(bg, us), ["model"])


def hierarchy_counts(df: DataFrame, target: str, protected: list[str], more: list[str] = (), name: str = "n") -> DataFrame:
    """Counts by target, by target with 1..k protected groups, and by each protected group, in one pass."""
    keys, more = [target, *protected], list(more)
    sets = [("target", [target])] + [(f"target_chain_{i}", keys[: i + 1]) for i in range(1, len(keys))] + [(f"protected::{p}", [p]) for p in protected]
    # the leaf counts are small; grouping sets go over them
    leaf = group_counts(df, [*more, *keys], "_n")
    cols = [*more, *keys]
    bits = {name_: sum(1 << (len(cols) - 1 - cols.index(c)) for c in cols if c not in [*more, *s]) for name_, s in sets}
    grouped = leaf.groupingSets([[F.col(c) for c in [*more, *s]] for _, s in sets], *cols).agg(F.grouping_id().alias("_g"), F.sum("_n").alias(name))
    level = F.lit(None).cast("string")
    for name_, b in bits.items():
        level = F.when(F.col("_g") == b, name_).otherwise(level)
    return grouped.select(*more, level.alias("level"), *keys, name)


def join_level_counts(real: DataFrame, syn: DataFrame, target: str, protected: list[str]) -> DataFrame:
    bg = hierarchy_counts(real, target, protected, name="background_n")
    us = hierarchy_counts(syn, target, protected, ["model"], name="user_n")
    return join_counts(bg, us, ["level", target, *protected])


def disparity_hierarchy(real: DataFrame, syn: DataFrame, target: str, protected: list[str]) -> DataFrame:
    """All levels, adjusted together within a model."""
    both = join_level_counts(real, syn, target, protected)
    totals = both.filter("level = 'target'").groupBy("model").agg(F.sum("background_n").alias("total_background"), F.sum("user_n").alias("total_user"))
    return attach_disparity(both, totals, ["model"])


def subgroup_table(hierarchy: DataFrame, target: str, protected: list[str]) -> DataFrame:
    """Protected groups, then the target: formatted values in display order."""
    name, group, order = F.lit("Target"), F.col(target), F.lit(len(protected))
    for i, p in enumerate(protected):
        here = F.col("level") == f"protected::{p}"
        name, group, order = F.when(here, p).otherwise(name), F.when(here, F.col(p)).otherwise(group), F.when(here, i).otherwise(order)
    rows = hierarchy.filter((F.col("level") == "target") | F.col("level").startswith("protected::"))
    rows = rows.select("model", name.alias("characteristic"), order.alias("char_order"), group.alias("subgroup"), "equity_value", "bh_p", "equity_label", "equity_color")
    return _display(rows, ["model", "characteristic"])


def _display(rows: DataFrame, group: list[str]) -> DataFrame:
    rows = rows.withColumn("sub_order", F.dense_rank().over(W.partitionBy(*group).orderBy("subgroup")))
    return rows.select("model", "characteristic", "char_order", "sub_order", "subgroup", format_equity(F.col("equity_value"), F.col("bh_p")).alias("equity_text"), format_p(F.col("bh_p")).alias("p_text"), "equity_label", "equity_color").orderBy("model", "char_order", "sub_order")


def leaf_table(hierarchy: DataFrame, target: str, protected: list[str]) -> DataFrame:
    """The deepest chain, each row named 'target × group × group'."""
    rows = hierarchy.filter(F.col("level") == f"target_chain_{len(protected)}").select("model", F.lit("Intersectional").alias("characteristic"), F.lit(0).alias("char_order"), F.concat_ws(" × ", target, *protected).alias("subgroup"), "equity_value", "bh_p", "equity_label", "equity_color")
    return _display(rows, ["model", "characteristic"])


def sunburst_nodes(hierarchy: DataFrame, target: str, protected: list[str]) -> DataFrame:
    """Nodes of the tree target > group > group: ids, parents, values, colours, hover text."""
    rows = hierarchy.filter((F.col("level") == "target") | F.col("level").startswith("target_chain_"))
    depth = F.when(F.col("level") == "target", 0).otherwise(F.substring_index("level", "_", -1).cast("int"))
    parts = [F.concat(F.lit("t::"), target)] + [F.concat(F.lit(f"{p}::"), p) for p in protected]
    steps = F.array(*parts)
    label = F.get(F.array(target, *protected), F.col("_d"))
    groups = F.concat(*(F.when(F.col("_d") >= i + 1, F.concat(F.lit(pretty(p) + ": "), p, F.lit("<br>"))).otherwise("") for i, p in enumerate(protected)))
    hover = F.concat(
        F.lit("Target: "), target, F.lit("<br>"), groups, F.lit("Equity label: "), "equity_label", F.lit("<br>Log disparity: "), tooltip_value(F.col("equity_value")),
        F.format_string("<br>Real rate: %.4f<br>Synthetic rate: %.4f<br>Real n: %d<br>Synthetic n: %d<br>BH-adjusted p: ", "background_rate", "observed_rate", "background_n", "user_n"),
        F.when(F.col("bh_p").isNull(), "NA").otherwise(F.format_string("%.4f", "bh_p")),
    )
    return rows.withColumn("_d", depth).select("model", F.array_join(F.slice(steps, F.lit(1), F.col("_d") + 1), "|").alias("id"), F.array_join(F.slice(steps, F.lit(1), F.col("_d")), "|").alias("parent"), label.alias("label"), F.col("user_n").alias("value"), F.col("equity_color").alias("color"), hover.alias("hover"))


def pretty(name: str) -> str:
    return name.replace("__GROUP", "").replace("_", " ").title()


def _summary_aggs():
    value = F.col("equity_value")
    usable = F.when(~value.isin(NO_INFO, NO_BASE, INSUFFICIENT) & (F.abs(value) < _INF), F.abs(value))
    return [F.count("*").alias("n_subgroups"), F.avg(usable).alias("mean_abs"), F.percentile(usable, 0.5).alias("median_abs"), F.avg(F.when(F.col("bh_p").between(0, SIGNIFICANT), 1.0).otherwise(0.0)).alias("share_significant")]


def disparity_summary(leaf: DataFrame) -> DataFrame:
    return leaf.agg(*_summary_aggs())


def summarize_models(leaf: DataFrame) -> DataFrame:
    return leaf.groupBy("model").agg(*_summary_aggs()).orderBy("mean_abs")


def label_counts(leaf: DataFrame) -> DataFrame:
    return leaf.groupBy("model", "equity_label").agg(F.count("*").alias("n"))


def label_counts_pivot(leaf: DataFrame) -> DataFrame:
    names = list(COLORS)
    return leaf.groupBy("model").pivot("equity_label", names).count().fillna(0, names)


def disparity_report(real: DataFrame, syn: DataFrame, target: str, protected: list[str]) -> dict[str, DataFrame]:
    """All tables of the report by name, lazily."""
    leaf, tree = disparity_leaf(real, syn, target, protected), disparity_hierarchy(real, syn, target, protected)
    return {
        "leaf": leaf, "hierarchy": tree, "subgroups": subgroup_table(tree, target, protected), "leaf_table": leaf_table(tree, target, protected),
        "nodes": sunburst_nodes(tree, target, protected), "summary": summarize_models(leaf), "labels": label_counts(leaf),
    }


def disparity_for_candidates(real: DataFrame, candidates: dict[str, DataFrame] | DataFrame, target: str, protected: list[str]) -> tuple[DataFrame, DataFrame]:
    """Leaf table of all candidates at once, and (model, error) rows of those that lack columns."""
    spark, need = real.sparkSession, [target, *protected]
    if isinstance(candidates, DataFrame):
        return disparity_leaf(real, candidates, target, protected), spark.createDataFrame([], "model string, error string")
    errors = [(m, f"no such columns: {[c for c in need if c not in df.columns]}") for m, df in candidates.items() if any(c not in df.columns for c in need)]
    good = [df.select(F.lit(m).alias("model"), *need) for m, df in candidates.items() if all(c in df.columns for c in need)]
    if not good:
        raise ValueError("no candidate has all columns")
    syn = good[0]
    for g in good[1:]:
        syn = syn.unionByName(g)
    return disparity_leaf(real, syn, target, protected), spark.createDataFrame(errors, "model string, error string")


def disparity_metric_table(leaf: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """(model, metric, value) of the three summary metrics, null for failed models."""
    names = {"mean_abs": "log_disparity_mean_abs", "median_abs": "log_disparity_median_abs", "share_significant": "log_disparity_share_significant"}
    wide = summarize_models(leaf).select("model", *(F.col(a).alias(b) for a, b in names.items()))
    if errors is not None:
        wide = wide.unionByName(errors.select("model"), allowMissingColumns=True)
    return wide.unpivot("model", list(names.values()), "metric", "value")
