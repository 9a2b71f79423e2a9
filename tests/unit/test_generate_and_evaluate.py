"""Candidates and the evaluation stage: shares, repeatability, failures that stay where they are."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import evaluate as ev, generate as ge, learned as le
from quarrystone.sources import tables as so


@pytest.fixture(scope="module")
def real(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        c = rng.choice("aab")
        rows.append((f"k{i}", c, {"a": "x", "b": "y"}[c] if rng.random() < 0.9 else None, rng.gauss(0 if c == "a" else 5, 1), float(rng.randrange(3))))
    return spark.createDataFrame(rows, "key string, c string, e string, u double, v double").repartition(3).cache()


def test_tree_is_the_heaviest():
    assert ge.spanning_tree({(0, 1): 0.1, (0, 2): 0.9, (1, 2): 0.5, (2, 3): 0.2, (0, 3): 0.1, (1, 3): 0.05}, 4) == [(0, None), (2, 0), (1, 2), (3, 2)]
    assert ge.spanning_tree({}, 1) == [(0, None)]


def test_network_keeps_shares_links_and_nulls(spark, real):
    made = ge.bayes_net_generate(real, ["c", "e", "u", "v"], 4000).cache()
    share = lambda df, cond: df.filter(cond).count() / df.count()
    for cond in ("c = 'a'", "e IS NULL", "v = 0", "c = 'a' AND e = 'y'", "c = 'b' AND u > 2.5"):
        assert abs(share(made, cond) - share(real, cond)) < 0.05, cond
    assert made.filter("c = 'a' AND e = 'y'").count() == 0
    low, high = real.agg(F.min("u"), F.max("u")).first()
    assert made.filter((F.col("u") < low) | (F.col("u") > high)).count() == 0
    again = {r.id: tuple(r) for r in ge.bayes_net_generate(real.repartition(7), ["c", "e", "u", "v"], 50).collect()}
    assert again == {r.id: tuple(r) for r in ge.bayes_net_generate(real, ["c", "e", "u", "v"], 50).repartition(2).collect()}


def test_mixture_rows_do_not_depend_on_partitions(spark, real):
    one = {r.id: (r.u, r.v) for r in le.gmm_generate(real.coalesce(1), ["u", "v"], 30).collect()}
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "7")
    try:
        assert {r.id: (r.u, r.v) for r in le.gmm_generate(real.coalesce(1), ["u", "v"], 30).collect()} == one
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_generate_all_caches_and_passes_over_failures(spark, real, tmp_path):
    specs = [{"name": "m", "kind": "mixture", "tuned": {"k": 2}}, {"name": "b", "kind": "bootstrap", "source": "other"}, {"name": "z", "kind": "none"}, {"name": "y", "kind": "mixture", "source": "absent"}]
    run = lambda **k: {r.model: r.state for r in ge.generate_all({"raw": real, "other": real}, specs, ["u", "v"], 20, "key", str(tmp_path), **k).collect()}
    assert run() == {"m": "made", "m_hpo": "made", "b": "made", "z": "failed", "y": "failed"}
    assert run() == {"m": "cached", "m_hpo": "cached", "b": "cached", "z": "failed", "y": "failed"}
    assert run(force=True)["m"] == "made"
    assert {r.model: r["count"] for r in spark.read.parquet(str(tmp_path)).groupBy("model").count().collect()} == {"m": 20, "m_hpo": 20, "b": 20}
    calls = []
    assert not so.write_candidate(lambda: calls.append(1), str(tmp_path), "m") and not calls


CONFIG = ev.Config("key", ["u", "v"], ["c", "e"], ["c"], "v", metrics=["wasserstein_dist", "k-anonymization"])


def test_evaluation_ranks_and_keeps_a_failing_candidate_apart(spark, real):
    good = real.withColumn("model", F.lit("copy"))
    far = real.withColumn("model", F.lit("far")).withColumn("u", F.col("u") + 50)
    # a candidate that fails when it is read
    bad = real.withColumn("model", F.lit("bad")).withColumn("u", F.raise_error(F.lit("no such thing")).cast("double"))
    out = ev.evaluate(real, good.unionByName(far).unionByName(bad), CONFIG)
    errors = out["errors"].collect()
    assert {r.model for r in errors} == {"bad"}
    value = {(r.model, r.metric): r.value for r in out["metrics"].collect()}
    assert value["copy", "wasserstein_dist"] == 0.0 and value["far", "wasserstein_dist"] > 40 and value["bad", "wasserstein_dist"] is None
    gate = {r.model: r for r in out["gate"].collect()}
    assert gate["copy"]["pass"]
    assert out["recommendation"].first().model == "copy"
    assert {r.model for r in out["summary"].collect()} == {"copy", "far", "bad"}
    with pytest.raises(ValueError):
        ev.evaluate(real, good, ev.Config("key", ["u"], ["c"], metrics=["nonsense"]))


def test_score_prefers_the_nearer_candidate(spark, real):
    near = real.filter("v < 2").withColumn("model", F.lit("near"))
    far = real.withColumn("model", F.lit("far")).withColumns({"u": F.col("u") * 9 + 40, "v": F.col("v") * 20})
    config = ev.Config("key", ["u", "v"], ["c", "e"], metrics=["wasserstein_dist", "inv_kl_divergence"])
    score = {r.model: r.score for r in ev.candidate_score(real, near.unionByName(far), config).collect()}
    assert score["near"] < score["far"]
    with pytest.raises(ValueError):
        ev.candidate_score(real, near.drop("u"), config)


def test_fairness_gaps_by_hand(spark):
    rows = [("a", 1, 1), ("a", 0, 1), ("a", 1, 0), ("b", 0, 1), ("b", 0, 1), ("b", 0, 0)]
    g = le.fairness_gaps(spark.createDataFrame(rows, "g string, hit int, truth int"), "g").first()
    assert (round(g.statistical_parity, 6), g.equalized_odds, g.equal_opportunity) == (round(2 / 3, 6), 1.0, 0.5)


def test_models_of_biased_candidates_have_gaps(spark):
    rng = random.Random(6)
    rows = [(f"k{i}", g := rng.choice("ab"), float(g == "b"), x := rng.gauss(0, 1), "p" if x > 0 else "n") for i in range(300)]
    real = spark.createDataFrame(rows, "key string, g string, ib double, x double, y string")
    biased = real.withColumn("y", F.when(F.col("g") == "a", "p").otherwise("n"))
    value = lambda syn: {r.metric: r.value for r in le.fairness_metrics(real, syn, "y", "p", ["g"], ["x", "ib"], "key", folds=2).collect()}
    fair, unfair = value(real), value(biased)
    assert unfair["statistical_parity"] > 0.9 and fair["equalized_odds"] < 0.3 and unfair["sp_y_g"] == unfair["statistical_parity"]


def test_rank_correlation_with_ties():
    assert le.rank_correlation([1, 2, 3], [10, 20, 30]) == 1.0 and le.rank_correlation([1, 2, 3], [3, 2, 1]) == -1.0
    assert le.rank_correlation([0, 0, 0], [0, 0, 0]) == 1.0 and le.rank_correlation([1, 1, 1], [1, 2, 3]) == 0.0 and le.rank_correlation([4], [9]) == 1.0
    assert abs(le.rank_correlation([1, 1, 2, 3], [1, 2, 2, 3]) - 0.8333333) < 1e-6


def test_detection_of_far_and_equal_candidates(spark, real):
    far = real.withColumns({"u": F.col("u") + 30, "key": F.concat("key", F.lit("s"))})
    for name in ("gmm", "linear"):
        assert le.detection(real, far, ["u", "v"], "key", name).first().auc > 0.95, name
    same = real.withColumn("key", F.concat("key", F.lit("s")))
    assert le.detection(real, same, ["u", "v"], "key", "linear").first().auc < 0.65
    assert le.p_mse(real, far, ["u", "v"], "key").first().value > 0.2


def test_membership_and_utility_have_the_right_direction(spark, real):
    train, rest = real.filter("abs(hash(key)) % 2 = 0"), real.filter("abs(hash(key)) % 2 = 1")
    assert le.train_test_score(real, real, "c", ["u", "v"], "forest").first().accuracy > 0.9
    assert abs(le.auroc_difference(train, rest, train, "c", "a", ["u", "v"]).first().value) < 1e-6
    r = le.membership_attack(train, rest, train, ["u", "v"], "key", 2).first()
    assert 0 <= r.mia_recall <= 1 and 0 <= r.mia_precision <= 1
    auc = le.domias(train, rest, train, ["u", "v"], "key", 2).first().auc
    assert 0.3 <= auc <= 1
    p = le.pca_difference(real, real, ["u", "v"]).first()
    assert (p.eigenvalue_gap, p.cosine) == (0.0, 1.0)
    labelled = le.relabel_by_classifier(real, real, "c", ["u", "v"])
    assert labelled.join(real.select("key", F.col("c").alias("was")), "key").filter("c = was").count() > 360
    over = [r.c for r in le.oversample_then_subsample(real, "c", ["u", "v"], 90).collect()]
    assert len(over) == 90 and abs(over.count("a") / 90 - 2 / 3) < 0.1


def test_a_text_column_of_very_many_values(spark):
    """Every value of the wide column once, a few of the other very often: draws follow the pairs that are there."""
    n = 1_000_000
    real = spark.range(0, n, 1, 4).select(F.concat(F.lit("name "), F.col("id").cast("string")).alias("wide"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 50)).alias("few"))
    made = ge.bayes_net_generate(real, ["few", "wide"], 3000)
    made.persist()
    number = F.substring("wide", 6, 9).cast("long")
    right = F.col("few") == F.when(number % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), number % 50))
    r = made.agg(F.count("*").alias("n"), F.count_if(right).alias("right"), F.count_distinct("wide").alias("d"), F.count_if(F.col("few") == "hot").alias("hot")).first()
    made.unpersist()
    assert r.n == r.right == 3000 and r.d > 2950 and abs(r.hot - 1000) < 150


def test_ranges_are_found_whatever_the_counts(spark):
    rows = [("p", "big")] * 500 + [("p", f"x{i}") for i in range(40)] + [("q", "only")] * 7
    codes = spark.createDataFrame(rows, "g string, c string")
    parents, ranges = ge.conditional_table(codes, "c", "g")
    assert {(r.p, r.total) for r in parents.collect()} == {("p", 540), ("q", 7)} and ranges.count() <= 3 * 42
    asked = spark.range(540).select("id", F.lit("p").alias("g"), ((F.col("id") + 0.5) / 540).alias("u")).unionByName(spark.createDataFrame([(900, "q", 0.999), (901, "none", 0.5)], "id bigint, g string, u double"))
    got = Counter(r.c for r in ge.draw_values(asked, parents, ranges, F.col("g"), F.col("u"), "c").collect())
    assert got == Counter({"big": 500, "only": 1} | {f"x{i}": 1 for i in range(40)})


def test_all_names_that_roles_allow_and_each_table_once(spark, real, monkeypatch):
    made = []
    keep = ev.Base._once

    def counting(self, name, make, where=None):
        if name not in (self.kept if where is None else where):
            made.append(name)
        return keep(self, name, make, where)

    monkeypatch.setattr(ev.Base, "_once", counting)
    few = ev.Config("key", ["u", "v"], ["c", "e"])
    whole = ev.Config("key", ["u", "v"], ["c", "e"], ["c"], "v", target="c", positive="a", protected=["e"])
    named = {*ev.METRICS, *ev.SINGLE}
    assert set(ev.allowed(whole, True)) == named - ev.ON_REQUEST and not {"k-map", "xgb", "mia_recall", "statistical_parity", "att_discl_risk"} & set(ev.allowed(few, False))
    names = ["jensenshannon_dist", "h_dist", "chi_squared_test", "ks_test", "wasserstein_dist", "nndr", "dcr", "eps_risk", "close_values_probability", "prdc", "att_discl_risk", "ks_tvd", "frac_ks_sigs", "data_mismatch"]
    syn = real.withColumn("model", F.lit("copy")).unionByName(real.withColumn("model", F.lit("far")).withColumn("u", F.col("u") + 50))
    found, errors = ev.measure(real, syn, ev.Config("key", ["u", "v"], ["c", "e"], ["c"], "v", permutations=50), names)
    assert not errors.collect() and len(made) == len(set(made))
    value = {(r.model, r.metric): r.value for r in found.collect()}
    assert len(value) == 2 * len(names)
    assert value["copy", "close_values_probability"] == 1.0 and value["copy", "ks_test"] == 1.0 and value["far", "ks_test"] < 1.0 and value["far", "frac_ks_sigs"] > value["copy", "frac_ks_sigs"] == 0.0


def test_the_registered_evaluation_leaves_no_name_out(spark, monkeypatch):
    """All names, those on fitted models too, with real rows held out from the candidates' side of the comparison."""
    from quarrystone.plans import catalog, registry

    data, asked = "/root/testdata/sf0.001", {}
    monkeypatch.setattr(ev, "evaluate", lambda r, c, config, more=None, holdout=None: asked.update(real=r, config=config, holdout=holdout) or {"combined": None})
    registry.queries()["evaluate"](spark, data)
    assert sorted(asked["config"].metrics) == sorted([*ev.METRICS, *ev.SINGLE])
    ids = lambda df: [r.row_id for r in df.select("row_id").collect()]
    assert sorted(ids(asked["real"]) + ids(asked["holdout"])) == sorted(ids(catalog.real(spark, data))) and not set(ids(asked["real"])) & set(ids(asked["holdout"]))
