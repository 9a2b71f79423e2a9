"""The whole evaluation stage as one call: metrics of all candidates, ranks, gate, recommendation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock, RLock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from quarrystone.functions.session import checkpointed
from quarrystone.operators import combine, fidelity as fi, learned as le, neighbours as nn, permutation
from quarrystone.operators.clean import complete_cases, is_numeric, scale_stats, with_stats


@dataclass
class Config:
    """Roles of the columns and what is asked for. ``metrics``: names to compute, or all that the roles allow; ``limits``: the privacy gate.

    ``quasi``: quasi-identifiers; ``sensitive``: the attribute of l-diversity and disclosure; ``attributes``: all sensitive
    columns (that one if there are none); ``target``: what models predict, ``positive`` its value that counts as 1 for
    metrics of two classes; ``protected``: columns whose groups fairness compares.
    """

    key: str
    numeric: list[str]
    categorical: list[str]
    quasi: list[str] = field(default_factory=list)
    sensitive: str | None = None
    metrics: list[str] | None = None
    weights: dict[str, float] = field(default_factory=lambda: dict(combine.WEIGHTS))
    limits: list[tuple[str, str, float]] = field(default_factory=lambda: list(combine.GATE))
    strategy: str = "linear"
    target: str | None = None
    positive: object = None
    protected: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    permutations: int = 1000

    def sensitive_columns(self) -> list[str]:
        return self.attributes or ([self.sensitive] if self.sensitive else [])

    def inputs(self) -> list[str]:
        """What models of the target see."""
        return [c for c in self.numeric if c != self.target]


def vectors(df: DataFrame, stats: DataFrame, key: str, numeric: list[str]) -> DataFrame:
    """key (bigint hash of the key) and v, the numeric columns on the scale of ``stats``; rows with a null are left out."""
    z = F.array(*((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") for c in numeric))
    return with_stats(complete_cases(df, numeric), stats).select(F.xxhash64(key).alias("key"), z.alias("v"))


class Base:
    """The tables that several metrics need, each made once, when the first of them asks, and checkpointed.

    For all candidates: ``marginals``, ``cumulative``, ``tests``. For each model: its vectors and the distances
    from and to the real rows ('sr', 'rs': candidates to real and back, 'ss' and 'rr' within a side); those
    among the real rows serve all models. Metrics run side by side: whoever asks second waits for the first.
    """

    def __init__(self, real: DataFrame, candidates: DataFrame, config: Config, holdout: DataFrame | None = None, shared: dict | None = None, locks: tuple | None = None):
        self.real, self.candidates, self.config, self.holdout = real, candidates, config, holdout
        self.kept: dict = {}
        self.shared = {} if shared is None else shared
        self.locks, self.shared_locks, self.guard = ({}, {}, Lock()) if locks is None else ({}, *locks)

    def only(self, model: str) -> Base:
        return Base(self.real, self.candidates.filter(F.col("model") == model), self.config, self.holdout, self.shared, (self.shared_locks, self.guard))

    def rows(self, model: str) -> DataFrame:
        return self.candidates.filter(F.col("model") == model).drop("model")

    def _once(self, name, make, where=None):
        where = self.kept if where is None else where
        if name not in where:
            where[name] = checkpointed(make())
        return where[name]

    def once(self, name, make, where=None):
        """``make()``, checkpointed, by the first that asks for this name, in ``where`` if that is given."""
        with self.guard:
            lock = (self.locks if where is None else self.shared_locks).setdefault(name, RLock())
        with lock:
            return self._once(name, make, where)

    def marginals(self) -> DataFrame:
        return self.once("marginals", lambda: fi.marginals(self.real, self.candidates, self.config.categorical, self.config.numeric))

    def cumulative(self) -> DataFrame:
        return self.once("cumulative", lambda: fi._cumulative(self.real, self.candidates, self.config.numeric))

    def tests(self) -> DataFrame:
        c = self.config
        return self.once("tests", lambda: permutation.significance(permutation.permutation_test(self.real, self.candidates, c.numeric, c.categorical, c.permutations)))

    def vectors(self, model: str | None) -> DataFrame:
        c = self.config
        stats = self.once("stats", lambda: scale_stats(self.real, c.numeric), self.shared)
        if model is None:
            return self.once("real", lambda: vectors(self.real, stats, c.key, c.numeric), self.shared)
        return self.once(("vectors", model), lambda: vectors(self.candidates.filter(F.col("model") == model), stats, c.key, c.numeric))

    def near(self, which: str, model: str | None = None) -> DataFrame:
        """(q, rank, distance); within a side to the five nearest others, from candidates to the two nearest real rows, back to the nearest."""
        r, s = self.vectors(None), None if which == "rr" else self.vectors(model)
        make = {"rr": lambda: nn.distances(r, r, "key", "v", 5, True), "ss": lambda: nn.distances(s, s, "key", "v", 5, True), "sr": lambda: nn.distances(s, r, "key", "v", 2), "rs": lambda: nn.distances(r, s, "key", "v")}[which]
        return self.once((which, model), make, self.shared if which == "rr" else None)


def _cells(c: Config) -> list[str]:
    return [*c.numeric, *c.categorical]


#: Metrics that take all models in one pass: base -> (model, value).
METRICS = {
    "data_mismatch": lambda b: fi.data_mismatch(b.real.select(*_cells(b.config)), b.candidates.select("model", *_cells(b.config))),
    "common_rows_proportion": lambda b: fi.common_rows_proportion(b.real, b.candidates, _cells(b.config)),
    "jensenshannon_dist": lambda b: fi.jensenshannon_dist(b.marginals()), "chi_squared_test": lambda b: fi.chi_squared_test(b.marginals()),
    "inv_kl_divergence": lambda b: fi.inv_kl_divergence(b.marginals()), "h_dist": lambda b: fi.h_dist(b.marginals()),
    "ks_test": lambda b: fi.ks_of(b.cumulative()), "wasserstein_dist": lambda b: fi.wasserstein_of(b.cumulative()),
    "ks_tvd": lambda b: b.tests(), "frac_ks_sigs": lambda b: b.tests().select("model", F.col("share_significant").alias("value")),
    "max_mean_discrepancy": lambda b: fi.max_mean_discrepancy(b.real, b.candidates, b.config.numeric).select("model", "value"),
    "dwm": lambda b: fi.dwm(b.real, b.candidates, b.config.numeric), "cio": lambda b: fi.cio(b.real, b.candidates, b.config.numeric), "q_mse": lambda b: fi.q_mse(b.real, b.candidates, b.config.numeric),
    "corr_diff": lambda b: fi.corr_diff(b.real, b.candidates, b.config.numeric, b.config.categorical), "mi_diff": lambda b: fi.mi_diff(b.real, b.candidates, b.config.categorical),
    "hit_rate": lambda b: fi.hit_rate(b.real, b.candidates, b.config.categorical, b.config.numeric, b.config.key),
    "k-anonymization": lambda b: fi.k_anonymization(b.candidates, b.config.quasi), "k-map": lambda b: fi.k_map(b.real, b.candidates, b.config.quasi), "delta-presence": lambda b: fi.delta_presence(b.real, b.candidates, b.config.quasi),
    "distinct l-diversity": lambda b: fi.l_diversity(b.candidates, b.config.quasi, b.config.sensitive),
}


def _scaled(b: Base, model: str, test) -> float | None:
    """Share of candidates whose distance to the nearest real row, over the largest such distance, passes a test."""
    first = b.near("sr", model).filter("rank = 1")
    top = first.agg(F.max("distance").alias("_top"))
    x = F.when(F.col("_top") > 0, F.col("distance") / F.col("_top")).otherwise(0.0)
    return first.crossJoin(F.broadcast(top)).agg(F.avg(test(x).cast("double"))).first()[0]


def _mean(row) -> float | None:
    return None if row is None or any(x is None for x in row) else sum(row) / len(row)


def _disclosure(b: Base, model: str) -> float | None:
    c = b.config
    known = [x for x in c.numeric if x != c.sensitive]
    stats = b.once(("stats", "known"), lambda: scale_stats(b.real, known), b.shared)
    side = lambda df: vectors(df, stats, c.key, known).join(df.select(F.xxhash64(c.key).alias("key"), F.col(c.sensitive).alias("_a")), "key")
    tolerance = 1 / 30 if is_numeric(b.real, c.sensitive) else None
    return nn.attribute_disclosure(side(b.real), side(b.rows(model)), "key", "v", "_a", tolerance).first()["value"]


def _fitted(name: str, augmented: bool):
    def run(b: Base, model: str):
        c, train = b.config, b.rows(model).select(b.config.target, *b.config.inputs())
        if augmented:
            train = b.real.select(c.target, *c.inputs()).unionByName(train)
        r = le.train_test_score(train, b.real if b.holdout is None else b.holdout, c.target, c.inputs(), name).first()
        return r["accuracy"] if r["auc"] is None else r["auc"]

    return run


def _leak(name: str):
    def run(b: Base, model: str):
        c = b.config
        found = le.data_leakage(b.rows(model), b.real, c.sensitive_columns(), [x for x in _cells(c) if x not in c.sensitive_columns()], name)
        return found.agg(F.avg("value")).first()[0]

    return run


def _fair(kind: str):
    def run(b: Base, model: str):
        c = b.config
        gaps = b.once(("fair", model), lambda: le.fairness_metrics(b.real, b.rows(model), c.target, c.positive, c.protected, c.inputs(), c.key))
        return gaps.filter(F.col("metric") == kind).first()["value"]

    return run


def _attack(column: str):
    def run(b: Base, model: str):
        attack = b.once(("mia", model), lambda: le.membership_attack(b.real, b.holdout, b.rows(model), b.config.numeric, b.config.key))
        return attack.first()[column]

    return run


#: Metrics on neighbours in the space of scaled numeric columns, and on fitted models, one model after another: (base, model) -> value.
SINGLE = {
    "nearest_syn_neighbor_distance": lambda b, m: b.near("sr", m).filter("rank = 1").agg(F.avg("distance")).first()[0],
    "close_values_probability": lambda b, m: _scaled(b, m, lambda x: x <= 0.2), "distant_values_probability": lambda b, m: _scaled(b, m, lambda x: x >= 0.8),
    "prdc": lambda b, m: _mean(nn.prdc(b.vectors(m), b.vectors(None), "key", "v", 5, b.near("rr"), b.near("ss", m), b.near("rs", m)).first()),
    "alpha_precision": lambda b, m: nn.alpha_precision(b.vectors(None), b.vectors(m), "v").first()["alpha_precision"],
    "identifiability_score": lambda b, m: nn.identifiability(b.vectors(m), b.vectors(None), "key", "v").first()["value"],
    "eps_risk": lambda b, m: b.near("rr").filter("rank = 1").withColumnRenamed("distance", "own").join(b.near("rs", m).select("q", F.col("distance").alias("other")), "q").agg(F.avg((F.col("other") < F.col("own")).cast("double"))).first()[0],
    "nndr": lambda b, m: nn.nndr_of(b.near("sr", m)).first()["value"], "nnaa": lambda b, m: nn.nnaa(b.vectors(m), b.vectors(None), "key", "v").first()["value"],
    "dcr": lambda b, m: nn.dcr_of(b.near("sr", m).filter("rank = 1"), b.near("rr").filter("rank = 1")).first()["value"],
    "att_discl_risk": _disclosure,
    **{n: _fitted(x, False) for n, x in (("linear_model", "linear"), ("mlp", "mlp"), ("xgb", "xgb"))},
    **{f"{n}_augmentation": _fitted(x, True) for n, x in (("linear_model", "linear"), ("mlp", "mlp"), ("xgb", "xgb"))},
    "feat_rank_distance": lambda b, m: le.feature_rank_distance(b.real, b.rows(m), b.config.target, b.config.inputs()).first()["value"],
    **{f"detection_{x}": lambda b, m, x=x: le.detection(b.real, b.rows(m), b.config.numeric, b.config.key, x).first()["auc"] for x in ("xgb", "mlp", "gmm", "linear")},
    **{f"data_leakage_{x}": _leak(x) for x in ("mlp", "xgb", "linear")},
    "pca": lambda b, m: le.pca_difference(b.real, b.rows(m), b.config.numeric).first()["eigenvalue_gap"],
    "p_mse": lambda b, m: le.p_mse(b.real, b.rows(m), b.config.numeric, b.config.key).first()["value"],
    "DomiasMIA_prior": lambda b, m: le.domias(b.real, b.holdout, b.rows(m), b.config.numeric, b.config.key).first()["auc"],
    "mia_recall": _attack("mia_recall"), "mia_precision": _attack("mia_precision"),
    "auroc_diff": lambda b, m: le.auroc_difference(b.real, b.holdout, b.rows(m), b.config.target, b.config.positive, b.config.inputs()).first()["value"],
    "cls_acc": lambda b, m: le.f1_difference(b.real, b.rows(m), b.config.target, b.config.inputs(), b.config.key, ["forest", "xgb", "svm", "linear"]).agg(F.avg("value")).first()[0],
    **{k: _fair(k) for k in ("statistical_parity", "equalized_odds", "equal_opportunity")},
}

#: Metrics on neighbours; the rest of SINGLE fits models.
NEIGHBOURLY = {"nearest_syn_neighbor_distance", "close_values_probability", "distant_values_probability", "prdc", "alpha_precision", "identifiability_score", "eps_risk", "nndr", "nnaa", "dcr", "att_discl_risk"}
#: Metrics that run side by side.
ABREAST = 6
#: Computed only where named: 40 models for each candidate.
ON_REQUEST = {"cls_acc"}


def allowed(c: Config, holdout: bool) -> list[str]:
    """The names that the roles in ``c`` suffice for, but for those ON_REQUEST."""
    out = [n for n in [*METRICS, *SINGLE] if n not in ON_REQUEST]
    drop: set[str] = set()
    if not c.quasi:
        drop |= {"k-anonymization", "k-map", "delta-presence", "distinct l-diversity"}
    if not c.sensitive:
        drop |= {"distinct l-diversity", "att_discl_risk"}
    if not c.sensitive_columns():
        drop |= {n for n in out if n.startswith("data_leakage")}
    if len(c.categorical) < 2:
        drop.add("mi_diff")
    if not c.target:
        drop |= {"linear_model", "mlp", "xgb", "feat_rank_distance"} | {n for n in out if n.endswith("_augmentation")}
    if not holdout:
        drop |= {"DomiasMIA_prior", "mia_recall", "mia_precision"} | {n for n in out if n.endswith("_augmentation")}
    if not (c.target and c.positive is not None and holdout):
        drop.add("auroc_diff")
    if not (c.target and c.positive is not None and c.protected):
        drop |= {"statistical_parity", "equalized_odds", "equal_opportunity"}
    return [n for n in out if n not in drop]


def _error(e: Exception) -> str:
    return f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"[:300]


def measure(real: DataFrame, candidates: DataFrame, config: Config, names: list[str], holdout: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(model, framework, type, metric, value) and the failures (model, metric, error).

    A metric is computed for all models at once; only if that fails, for each model by itself, so
    a failing candidate costs the others nothing but that. Values are a row for each model.
    """
    spark = real.sparkSession
    models = sorted(r[0] for r in candidates.select("model").distinct().collect())  # as many as candidates
    base, single, guard = Base(real, candidates, config, holdout), {}, Lock()

    def of(model):
        with guard:
            return single.setdefault(model, base.only(model))

    def attempt(metric, model, work):
        """(values, failures); whatever a metric or a candidate does must not stop the rest."""
        try:
            return work(), []
        except Exception as e:  # noqa: BLE001
            return [], [(model, metric, _error(e))]

    def all_models(m):
        every = lambda b: [(r["model"], m, None if r["value"] is None else float(r["value"])) for r in METRICS[m](b).select("model", "value").collect()]
        found, failed = attempt(m, None, lambda: every(base))
        for model in models if failed else []:
            more = attempt(m, model, lambda: every(of(model)))  # noqa: B023
            found, failed = found + more[0], failed + more[1]
        return found, [f for f in failed if f[0] is not None]

    def one_model(m, model):
        return attempt(m, model, lambda: [(model, m, None if (v := SINGLE[m](base, model)) is None else float(v))])

    # most metrics are many small jobs, which leave cores idle one after another
    with ThreadPoolExecutor(ABREAST) as pool:
        work = [pool.submit(inheritable_thread_target(spark)(all_models), m) if m in METRICS else pool.submit(inheritable_thread_target(spark)(one_model), m, model) for m in names for model in (models if m in SINGLE else [None])]
        done = [w.result() for w in work]
    values, errors = ([x for d in done for x in d[i]] for i in (0, 1))
    framework, kind = combine.classify_metric(F.col("metric"))
    found = spark.createDataFrame(values, "model string, metric string, value double")
    return found.select("model", framework.alias("framework"), kind.alias("type"), "metric", "value"), spark.createDataFrame(errors, "model string, metric string, error string")


def evaluate(real: DataFrame, candidates: DataFrame, config: Config, more: DataFrame | None = None, holdout: DataFrame | None = None) -> dict[str, DataFrame]:
    """metrics, errors, combined (ranked, with the gate), gate, summary and recommendation of all candidates.

    ``holdout``: real rows that no candidate was made from; models are judged on them, attacks need them. ``more``
    (model, framework, type, metric, value) brings metrics computed elsewhere, such as those of the two-class pass
    or of representation fairness. Unknown metric names are an error.
    """
    known = [*METRICS, *SINGLE]
    unknown = [n for n in config.metrics or [] if n not in known]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    names = allowed(config, holdout is not None) if config.metrics is None else config.metrics
    metrics, errors = measure(real, candidates, config, names, holdout)
    if more is not None:
        metrics = metrics.unionByName(more)
    # a model without any value still has its rows, so that the gate fails it
    metrics = combine.align_metrics(metrics, candidates)
    gate = combine.privacy_gate(metrics, config.limits)
    ranked = combine.combined_table(metrics, config.weights, config.strategy)
    return {
        "metrics": metrics, "errors": errors, "combined": combine.merge_gate(ranked, gate), "gate": gate,
        "summary": combine.rank_summary(ranked), "recommendation": combine.recommend(ranked, gate),
    }


#: What candidates are tuned by (names fixed by the metric list of the tuning stage).
TUNING = ["prdc", "alpha_precision", "wasserstein_dist", "inv_kl_divergence", "nearest_syn_neighbor_distance", "identifiability_score"]


def candidate_score(real: DataFrame, candidates: DataFrame, config: Config, holdout: DataFrame | None = None, target: str | None = None) -> DataFrame:
    """(model, score), less is better: the negated mean of the oriented tuning metrics; with a target also that of boosted trees on the held-out rows."""
    metrics, errors = measure(real, candidates, config, config.metrics or TUNING)
    failed = errors.limit(1).collect()
    if failed:
        raise ValueError(f"{failed[0]['metric']} of {failed[0]['model']}: {failed[0]['error']}")
    if target is not None and holdout is not None:
        rows = []
        for (model,) in candidates.select("model").distinct().collect():
            score = le.train_test_score(candidates.filter(F.col("model") == model), holdout, target, config.numeric, "xgb").first()["accuracy"]
            rows.append((model, "family1", "utility", "xgb", score))
        metrics = metrics.unionByName(real.sparkSession.createDataFrame(rows, metrics.schema))
    return combine.composite_score(metrics)
