"""Candidates: a Bayesian network over discretised columns, and all configured candidates with their variants."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from quarrystone.functions.session import checkpointed, small
from quarrystone.operators.clean import is_numeric
from quarrystone.operators.fidelity import mutual_information
from quarrystone.operators.order import cumulative, quantiles
from quarrystone.operators.split import unit_hash

#: Columns drawn before the lineage of the rows is cut.
CUT_EVERY = 8


def discretise(df: DataFrame, columns: list[str], bins: int = 10) -> tuple[DataFrame, dict[str, list[float]]]:
    """columns as text categories, and the bins' edges: numeric columns of many values by quantile bins (their numbers), others as they are.

    Many are more than twice the bins by a sketch, which bears on the form of the table only.
    """
    numeric = [c for c in columns if is_numeric(df, c)]
    if numeric:
        many = df.agg(*(F.approx_count_distinct(c).alias(c) for c in numeric)).first()
        numeric = [c for c in numeric if many[c] > 2 * bins]
    edges: dict[str, list[float]] = {}
    if numeric:
        long = df.select(*(F.col(c).cast("double").alias(c) for c in numeric)).unpivot([], numeric, "column", "v")
        for r in quantiles(long, "v", [k / bins for k in range(bins + 1)], ["column"]).collect():  # bins + 1 numbers a column
            edges.setdefault(r["column"], []).append(r["value"])
        edges = {c: sorted(set(v)) for c, v in edges.items()}
    inner = lambda c: F.array(*map(F.lit, edges.get(c, [])[1:-1])) if len(edges.get(c, [])) > 2 else F.array().cast("array<double>")
    code = lambda c: F.when(F.col(c).isNotNull(), F.size(F.filter(inner(c), lambda e: e < F.col(c))).cast("string"))
    return df.select(*((code(c) if c in numeric else F.col(c).cast("string")).alias(c) for c in columns)), edges


def spanning_tree(weights: dict[tuple[int, int], float], n: int) -> list[tuple[int, int | None]]:
    """(node, parent) in an order in which parents come first: the maximum spanning tree, grown from node 0; ties go to the lower pair."""
    w = np.zeros((n, n))
    for (i, j), x in weights.items():
        w[i, j] = w[j, i] = x
    best, parent, left = w[0].copy(), np.zeros(n, int), np.ones(n, bool)
    order: list[tuple[int, int | None]] = [(0, None)]
    left[0] = False
    for _ in range(n - 1):
        j = int(np.flatnonzero(left)[best[left].argmax()])
        order.append((j, int(parent[j])))
        left[j] = False
        better = (w[j] > best) | ((w[j] == best) & (j < parent))
        best, parent = np.where(better, w[j], best), np.where(better, j, parent)
    return order


def conditional_table(codes: DataFrame, column: str, given: str | None) -> tuple[DataFrame, DataFrame]:
    """A column's values beside each value of another as ranges of whole numbers, as long as their counts.

    Returns parents (p, base, total, width) and ranges (p, b, lo, hi, value): all ranges lie one after
    another, those of one parent from base to base + total, and each stands in every bucket b of
    width numbers from base on that it reaches into. There are up to three times as many rows as
    pairs of values, none of which holds a list, and a bucket of few ranges for each number drawn.
    """
    counts = codes.groupBy((F.lit("") if given is None else F.col(given)).alias("p"), F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ends = checkpointed(cumulative(counts, ["p", "value"], "n", "hi").withColumn("lo", F.col("hi") - F.col("n")))
    parents = ends.groupBy("p").agg(F.min("lo").alias("base"), F.sum("n").alias("total"), F.ceil(F.sum("n") / F.count("*")).alias("width"))
    at = lambda x: F.floor((x - F.col("base")) / F.col("width"))
    ranges = ends.join(parents, "p").select("p", F.explode(F.sequence(at(F.col("lo")), at(F.col("hi") - 1))).alias("b"), "lo", "hi", "value")
    return small(parents), small(ranges)


def draw_values(rows: DataFrame, parents: DataFrame, ranges: DataFrame, given: Column, u: Column, name: str) -> DataFrame:
    """rows with ``name``, drawn from the table of their value ``given`` by a number ``u`` in (0, 1); rows whose value has no table go."""
    known = rows.withColumns({"_p": given, "_u": u}).join(parents.withColumnRenamed("p", "_q"), F.col("_p") == F.col("_q"))
    place = F.least(F.floor(F.col("_u") * F.col("total")), F.col("total") - 1)
    known = known.withColumns({"_r": F.col("base") + place, "_b": F.floor(place / F.col("width"))})
    here = (F.col("_p") == F.col("p")) & (F.col("_b") == F.col("b")) & (F.col("_r") >= F.col("lo")) & (F.col("_r") < F.col("hi"))
    return known.join(ranges, here).select(*rows.columns, F.col("value").alias(name))


def bayes_net_generate(df: DataFrame, columns: list[str], n: int, bins: int = 10, seed: int = 7) -> DataFrame:
    """n rows from a tree-shaped Bayesian network: id and the columns.

    Numeric columns are cut at quantiles; the tree is the maximum spanning tree of the pairs'
    mutual information (columns x columns numbers on the driver); conditional tables are groupings.
    Values are drawn from the root down: a hash of the row's id falls into one of the ranges that
    its parent value's counts make (``conditional_table``), found by an equality join on buckets of
    them; a number lies evenly in its bin. Nulls are drawn like a value.
    """
    codes, edges = discretise(df, columns, bins)
    codes = checkpointed(codes.select(*(F.coalesce(c, F.lit("\0null")).alias(c) for c in columns)))
    pairs = mutual_information(codes, [], columns).collect() if len(columns) > 1 else []
    tree = spanning_tree({(r["i"], r["j"]): r["r"] for r in pairs}, len(columns))
    rows, key = df.sparkSession.range(n), F.col("id").cast("string")
    for step, (node, parent) in enumerate(tree):
        given = None if parent is None else columns[parent]
        tables = conditional_table(codes, columns[node], given)
        rows = draw_values(rows, *tables, F.lit("") if given is None else F.col(given), unit_hash(key, "draw", node, seed), columns[node])
        if step % CUT_EVERY == CUT_EVERY - 1:
            rows = checkpointed(rows)
    out = []
    for i, c in enumerate(columns):
        value = F.when(F.col(c) != "\0null", F.col(c))
        if c in edges:
            e = F.array(*map(F.lit, edges[c]))
            low, high = F.get(e, value.cast("int")), F.coalesce(F.get(e, value.cast("int") + 1), F.lit(edges[c][-1]))
            value = (low + (high - low) * unit_hash(key, "place", i, seed)).cast(df.schema[c].dataType) if len(edges[c]) > 1 else F.when(value.isNotNull(), F.lit(edges[c][0])).cast(df.schema[c].dataType)
        else:
            value = value.cast(df.schema[c].dataType)
        out.append(value.alias(c))
    return rows.select("id", *out)


def bootstrap_generate(df: DataFrame, columns: list[str], n: int, key: str, seed: int = 7) -> DataFrame:
    """n rows drawn from the table itself, as a baseline that keeps everything: id and the columns."""
    from quarrystone.operators.split import bootstrap

    return bootstrap(df.select(key, *columns), key, n, seed).select(F.col("draw").alias("id"), *columns)


def generate_all(sources: dict[str, DataFrame], specs: list[dict], columns: list[str], n: int, key: str, path: str, force: bool = False) -> DataFrame:
    """Every configured candidate as a folder below ``path`` (model=<name>), made if it isn't there yet: (model, state, message).

    ``sources``: names of input variants ('raw', 'imputed', ...) -> tables. A spec has ``name`` and
    ``kind`` (mixture, bayes_net, bootstrap), and may have ``source``, ``params`` and ``tuned``
    (parameters of a further candidate <name>_hpo). A candidate that fails is recorded and passed
    over. ``state``: made, cached or failed.
    """
    from quarrystone.operators.learned import gmm_generate
    from quarrystone.sources.tables import write_candidate

    spark = next(iter(sources.values())).sparkSession

    def make(kind, df, params):
        if kind == "mixture":
            return gmm_generate(df, columns, n, **params)
        if kind == "bayes_net":
            return bayes_net_generate(df, columns, n, **params)
        if kind == "bootstrap":
            return bootstrap_generate(df, columns, n, key, **params)
        raise ValueError(f"unknown kind {kind!r}")

    rows, first = [], next(iter(sources))
    for spec in specs:
        variants = [(spec["name"], spec.get("params", {}))] + ([(f"{spec['name']}_hpo", spec["tuned"])] if spec.get("tuned") is not None else [])
        for name, params in variants:
            try:
                source = sources[spec.get("source", first)]
                made = write_candidate(lambda: make(spec["kind"], source, params), path, name, force)
                rows.append((name, "made" if made else "cached", json.dumps(params, sort_keys=True)))
            except Exception as e:  # noqa: BLE001  a failing candidate must not stop the others
                rows.append((name, "failed", f"{type(e).__name__}: {e}"[:300]))
    return spark.createDataFrame(rows, "model string, state string, message string")
