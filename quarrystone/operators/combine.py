"""Orienting, ranking, gating and reporting candidate metrics, as one long table.

Long form: model, framework, type, metric, value (raw), oriented. There are as many rows
as models times metrics, so windows and pivots here are small whatever the data was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from quarrystone.functions.numeric import base_model, format_4g

#: Metric -> (framework, type, direction, two classes only). Names and types; directions are ours where not stated.
CATALOG = {
    "data_mismatch": ("family1", "utility", "minimize", False), "common_rows_proportion": ("family1", "utility", "minimize", False),
    "nearest_syn_neighbor_distance": ("family1", "utility", "maximize", False), "close_values_probability": ("family1", "utility", "maximize", False),
    "distant_values_probability": ("family1", "utility", "minimize", False), "jensenshannon_dist": ("family1", "utility", "minimize", False),
    "chi_squared_test": ("family1", "utility", "maximize", False), "inv_kl_divergence": ("family1", "utility", "maximize", False),
    "ks_test": ("family1", "utility", "maximize", False), "max_mean_discrepancy": ("family1", "utility", "minimize", False),
    "wasserstein_dist": ("family1", "utility", "minimize", False), "prdc": ("family1", "utility", "maximize", False), "alpha_precision": ("family1", "utility", "maximize", False),
    "linear_model": ("family1", "utility", "maximize", False), "mlp": ("family1", "utility", "maximize", False), "xgb": ("family1", "utility", "maximize", False),
    "linear_model_augmentation": ("family1", "utility", "maximize", False), "mlp_augmentation": ("family1", "utility", "maximize", False), "xgb_augmentation": ("family1", "utility", "maximize", False),
    "feat_rank_distance": ("family1", "utility", "maximize", False), "detection_xgb": ("family1", "privacy", "minimize", False), "detection_mlp": ("family1", "privacy", "minimize", False),
    "detection_gmm": ("family1", "privacy", "minimize", False), "detection_linear": ("family1", "privacy", "minimize", False), "delta-presence": ("family1", "privacy", "maximize", False),
    "k-anonymization": ("family1", "privacy", "maximize", False), "k-map": ("family1", "privacy", "maximize", False), "distinct l-diversity": ("family1", "privacy", "maximize", False),
    "identifiability_score": ("family1", "privacy", "minimize", False), "DomiasMIA_prior": ("family1", "privacy", "minimize", False),
    "data_leakage_mlp": ("family1", "privacy", "minimize", False), "data_leakage_xgb": ("family1", "privacy", "minimize", False), "data_leakage_linear": ("family1", "privacy", "minimize", False),
    "dwm": ("family2", "utility", "minimize", False), "pca": ("family2", "utility", "minimize", False), "cio": ("family2", "utility", "maximize", False), "corr_diff": ("family2", "utility", "minimize", False),
    "mi_diff": ("family2", "utility", "minimize", False), "ks_tvd": ("family2", "utility", "minimize", False), "frac_ks_sigs": ("family2", "utility", "minimize", False), "h_dist": ("family2", "utility", "minimize", False), "p_mse": ("family2", "utility", "minimize", False),
    "q_mse": ("family2", "utility", "minimize", False), "auroc_diff": ("family2", "utility", "minimize", True), "cls_acc": ("family2", "utility", "minimize", False),
    "nndr": ("family2", "privacy", "maximize", False), "nnaa": ("family2", "privacy", "minimize", False), "dcr": ("family2", "privacy", "maximize", False), "hit_rate": ("family2", "privacy", "minimize", False),
    "eps_risk": ("family2", "privacy", "minimize", False), "mia_recall": ("family2", "privacy", "minimize", False), "mia_precision": ("family2", "privacy", "minimize", False),
    "att_discl_risk": ("family2", "privacy", "minimize", False), "statistical_parity": ("family2", "fairness", "minimize", True),
    "equalized_odds": ("custom", "fairness", "minimize", True), "equal_opportunity": ("custom", "fairness", "minimize", True),
    "log_disparity_mean_abs": ("custom", "fairness", "minimize", False), "log_disparity_share_significant": ("custom", "fairness", "minimize", False),
}
#: Result columns named by a prefix: framework and type.
PREFIXES = {"auroc_": ("family2", "utility"), "sp_": ("family2", "fairness"), "eo_": ("custom", "fairness"), "eqo_": ("custom", "fairness")}
#: Limits of the absolute privacy gate: (metric, comparison, limit).
GATE = [("mia_recall", "max", 0.6), ("mia_precision", "max", 0.6), ("hit_rate", "max", 0.05), ("att_discl_risk", "max", 0.6), ("identifiability_score", "max", 0.3), ("k-anonymization", "min", 5.0), ("k-map", "min", 5.0)]
WEIGHTS = {"utility": 1 / 3, "privacy": 1 / 3, "fairness": 1 / 3}


def metric_catalog(spark: SparkSession) -> DataFrame:
    rows = [(m, *v) for m, v in CATALOG.items()]
    return spark.createDataFrame(rows, "metric string, framework string, type string, direction string, binary_only boolean")


def resolve_selection(catalog: DataFrame, enabled: bool = True, names: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    """Disabled: none; else the named metrics (unknown names are an error), the types, or all."""
    if not enabled:
        return catalog.limit(0)
    if names:
        unknown = [n for n in names if n not in CATALOG]
        if unknown:
            raise ValueError(f"unknown metrics: {unknown}")
        return catalog.filter(F.col("metric").isin(names))
    return catalog.filter(F.col("type").isin(types)) if types else catalog


def binary_preset(catalog: DataFrame) -> DataFrame:
    return catalog.filter("binary_only")


def classify_metric(name: Column) -> tuple[Column, Column]:
    """(framework, type) of a result column: by its name, by prefix, else family2 utility."""
    framework, kind = F.lit("family2"), F.lit("utility")
    for prefix, (fw, ty) in PREFIXES.items():
        framework, kind = F.when(name.startswith(prefix), fw).otherwise(framework), F.when(name.startswith(prefix), ty).otherwise(kind)
    pick = lambda i: F.create_map(*(F.lit(x) for m, v in CATALOG.items() for x in (m, v[i])))[name]
    return F.coalesce(pick(0), framework), F.coalesce(pick(1), kind)


def drop_redundant(metrics: DataFrame) -> DataFrame:
    return metrics.filter(~F.col("metric").endswith("_naive"))


def orient(metrics: DataFrame) -> DataFrame:
    """oriented = value, negated where less is better."""
    direction = F.create_map(*(F.lit(x) for m, v in CATALOG.items() for x in (m, v[2])))[F.col("metric")]
    return metrics.withColumn("oriented", F.when(direction == "minimize", -F.col("value")).otherwise(F.col("value")))


def orient_family1(metrics: DataFrame, models: DataFrame) -> DataFrame:
    """Oriented family-1 values; models that failed stay as null rows."""
    own = drop_redundant(metrics.filter("framework = 'family1'"))
    return align_metrics(orient(own), models)


def orient_family2(metrics: DataFrame) -> DataFrame:
    return orient(metrics.filter("framework = 'family2' AND metric NOT LIKE '%rank'"))


def orient_disparity(metrics: DataFrame) -> DataFrame:
    """Mean and share are ranked (negated); the median stays raw only."""
    own = metrics.filter(F.col("metric").startswith("log_disparity"))
    return own.withColumn("oriented", F.when(F.col("metric") != "log_disparity_median_abs", -F.col("value")))


def align_metrics(metrics: DataFrame, models: DataFrame) -> DataFrame:
    """A row for each model and metric; null where a model has none."""
    names = metrics.select("framework", "type", "metric").distinct()
    return models.select("model").distinct().crossJoin(names).join(metrics, ["model", "framework", "type", "metric"], "left")


def merge_binary_pass(main: DataFrame, binary: DataFrame) -> DataFrame:
    """Main metrics with those of the two-class pass, which win; its rank columns don't come in."""
    binary = binary.filter("metric NOT LIKE '%rank'")
    return main.join(binary.select("model", "metric"), ["model", "metric"], "left_anti").unionByName(binary)


def minmax_scale(metrics: DataFrame, value: str = "oriented") -> DataFrame:
    """scaled: 0 to 1 over models within a metric, 0.5 where all are equal; nulls stay."""
    w = W.partitionBy("framework", "type", "metric")
    low, high = F.min(value).over(w), F.max(value).over(w)
    return metrics.withColumn("scaled", F.when(F.col(value).isNotNull(), F.when(high == low, 0.5).otherwise((F.col(value) - low) / (high - low))))


def group_rank(scaled: DataFrame, value: str = "scaled") -> DataFrame:
    return scaled.groupBy("model", "framework", "type").agg(F.avg(value).alias("rank"))


def type_rank(groups: DataFrame) -> DataFrame:
    """The mean of the group ranks, not of all metrics."""
    return groups.groupBy("model", "type").agg(F.avg("rank").alias("rank"))


def overall_rank(types: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    weight = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))[F.col("type")]
    return types.groupBy("model").agg(F.sum(F.coalesce(weight, F.lit(0.0)) * F.coalesce("rank", F.lit(0.0))).alias("rank")).orderBy(F.desc("rank"), "model")


def combined_table(metrics: DataFrame, weights: dict[str, float] = WEIGHTS, strategy: str = "linear") -> DataFrame:
    """Long table with raw metrics and the group, type and overall ranks (type 'rank', metric as named)."""
    if strategy not in ("linear", "summation"):
        raise ValueError(f"unknown strategy {strategy!r}")
    oriented = orient(drop_redundant(metrics)) if "oriented" not in metrics.columns else drop_redundant(metrics)
    scaled = minmax_scale(oriented) if strategy == "linear" else oriented.withColumn("scaled", F.col("oriented"))
    groups = group_rank(scaled)
    types = type_rank(groups)
    out = scaled.select("model", "framework", "type", "metric", "value")
    out = out.unionByName(groups.select("model", "framework", F.lit("rank").alias("type"), F.col("type").alias("metric"), F.col("rank").alias("value")))
    out = out.unionByName(types.select("model", F.lit("rank").alias("framework"), F.lit("type").alias("type"), F.col("type").alias("metric"), F.col("rank").alias("value")))
    return out.unionByName(overall_rank(types, weights).select("model", F.lit("rank").alias("framework"), F.lit("overall").alias("type"), F.lit("overall").alias("metric"), F.col("rank").alias("value")))


def combined_wide(combined: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each model, columns named framework|type|metric."""
    return combined.withColumn("c", F.concat_ws("|", "framework", "type", "metric")).groupBy("model").pivot("c", columns).agg(F.first("value"))


def combined_long(wide: DataFrame) -> DataFrame:
    columns = [c for c in wide.columns if c != "model"]
    parts = F.split("c", r"\|")
    return wide.unpivot("model", columns, "c", "value").select("model", parts[0].alias("framework"), parts[1].alias("type"), parts[2].alias("metric"), "value")


def privacy_gate(metrics: DataFrame, limits: list[tuple[str, str, float]] = GATE) -> DataFrame:
    """(model, pass, violations): raw values against limits; null fails, metrics nobody has are left out."""
    spark = metrics.sparkSession
    rules = spark.createDataFrame([(m, k, float(v)) for m, k, v in limits], "metric string, kind string, lim double")
    known = rules.join(metrics.select("metric").distinct(), "metric", "left_semi")
    cells = metrics.select("model").distinct().crossJoin(F.broadcast(known)).join(metrics.select("model", "metric", "value"), ["model", "metric"], "left")
    ok = F.coalesce(F.when(F.col("kind") == "max", F.col("value") <= F.col("lim")).otherwise(F.col("value") >= F.col("lim")), F.lit(False))
    text = F.concat("metric", F.lit("="), format_4g(F.col("value")), F.when(F.col("kind") == "max", " > ").otherwise(" < "), format_4g(F.col("lim")))
    return cells.groupBy("model").agg(F.bool_and(ok).alias("pass"), F.array_join(F.sort_array(F.collect_list(F.when(~ok, text))), "; ").alias("violations"))


def merge_gate(combined: DataFrame, gate: DataFrame) -> DataFrame:
    return combined.join(gate, "model", "left")


def gate_counts(gate: DataFrame) -> DataFrame:
    return gate.groupBy("pass").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("model")), ", ").alias("models"))


def rank_summary(combined: DataFrame) -> DataFrame:
    """model, overall, utility, privacy, fairness to 3 decimals, best first."""
    kinds = ["overall", "utility", "privacy", "fairness"]
    wide = combined.filter("framework = 'rank'").groupBy("model").pivot("metric", kinds).agg(F.first("value"))
    return wide.select("model", *(F.bround(k, 3).alias(k) for k in kinds)).orderBy(F.desc("overall"), "model")


def recommend(combined: DataFrame, gate: DataFrame) -> DataFrame:
    """The best model that passes; one row with a null model and a reason if none does."""
    best = combined.filter("framework = 'rank' AND type = 'overall'").join(gate.filter("pass"), "model").agg(F.max_by("model", F.struct("value", "model")).alias("model"))
    return best.select("model", F.when(F.col("model").isNull(), "no model passes the privacy gate").otherwise("best overall rank among passing models").alias("reason"))


def composite_score(metrics: DataFrame) -> DataFrame:
    """Less is better: the negated mean of oriented values."""
    return orient(metrics).groupBy("model").agg((-F.avg("oriented")).alias("score"))


def fairness_gap_table(metrics: DataFrame) -> DataFrame:
    names = ["statistical_parity", "equalized_odds", "equal_opportunity"]
    return metrics.filter(F.col("metric").isin(names)).groupBy("model").pivot("metric", names).agg(F.first("value"))


def tradeoff_points(combined: DataFrame) -> DataFrame:
    kinds = ["utility", "privacy", "fairness"]
    wide = combined.filter("framework = 'rank' AND type = 'type'").groupBy("model").pivot("metric", kinds).agg(F.first("value"))
    return wide.select("model", base_model(F.col("model")).alias("base"), F.col("model").endswith("_hpo").alias("tuned"), *kinds)


# trials and runs


def best_trial(trials: DataFrame, capped: list[str] = ()) -> DataFrame:
    """Per study the parameters with the least value among complete trials, capped ones left out."""
    done = trials.filter("state = 'COMPLETE' AND value IS NOT NULL")
    best = done.groupBy("study").agg(F.min_by(F.struct("number", "value", "params"), F.struct("value", "number")).alias("b"))
    return best.select("study", "b.number", "b.value", F.map_filter("b.params", lambda k, v: ~k.isin(*capped) if capped else F.lit(True)).alias("params"))


def trials_to_keep(trials: DataFrame) -> DataFrame:
    """(study, number) that may go: neither best nor latest, and no trial of the study is running."""
    done = trials.filter("state = 'COMPLETE'")
    keep = done.groupBy("study").agg(F.min_by("number", F.struct("value", "number")).alias("best"))
    latest = trials.groupBy("study").agg(F.max("number").alias("latest"), F.bool_or(F.col("state") == "RUNNING").alias("busy"))
    both = trials.join(keep, "study", "left").join(latest, "study")
    return both.filter(~F.col("busy") & (F.col("number") != F.coalesce("best", F.lit(-1))) & (F.col("number") != F.col("latest"))).select("study", "number")


def trial_history(trials: DataFrame) -> DataFrame:
    """Each complete trial with the best value so far."""
    w = W.partitionBy("study").orderBy("number").rowsBetween(W.unboundedPreceding, 0)
    return trials.filter("state = 'COMPLETE'").select("study", "number", "value", F.min("value").over(w).alias("best"))


def trial_slices(trials: DataFrame) -> DataFrame:
    return trials.filter("state = 'COMPLETE'").select("study", "number", "value", F.explode("params").alias("param", "setting"))


def compare_params(default: DataFrame, tuned: DataFrame) -> DataFrame:
    """(name, default, tuned, changed) of two (name, value) tables."""
    a, b = default.select("name", F.col("value").alias("default")), tuned.select("name", F.col("value").alias("tuned"))
    return a.join(b, "name", "full_outer").withColumn("changed", ~F.col("default").eqNullSafe(F.col("tuned")))


def provenance_diff(expected: DataFrame, recorded: DataFrame) -> DataFrame:
    """(field, expected, recorded) where the two (field, value) tables differ."""
    a, b = expected.select("field", F.col("value").alias("expected")), recorded.select("field", F.col("value").alias("recorded"))
    return a.join(b, "field", "full_outer").filter(~F.col("expected").eqNullSafe(F.col("recorded")))


def latest_run(runs: DataFrame, run_id=None) -> DataFrame:
    """The newest run of each dataset version, or the named one (an error if there's none)."""
    if run_id is not None:
        found = runs.filter(F.col("run_id") == run_id)
        if found.isEmpty():
            raise ValueError(f"no run {run_id!r}")
        return found
    return runs.groupBy("dataset", "version").agg(F.max_by("run_id", F.struct("created_at", "run_id")).alias("run_id"))


def pending_models(candidates: DataFrame, done: DataFrame, key: list[str] = ("model", "fingerprint")) -> DataFrame:
    return candidates.join(done.select(*key), list(key), "left_anti")


def result_cache(wanted: DataFrame, stored: DataFrame, key: str = "cache_key") -> tuple[DataFrame, DataFrame]:
    """(results to reuse, keys to compute)."""
    return stored.join(wanted.select(key), key, "left_semi"), wanted.join(stored.select(key), key, "left_anti")


def cache_key(fields: dict[str, Column]) -> Column:
    """A digest of the fields that bear on a result, in name order."""
    return F.sha2(F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields)))), 256)
