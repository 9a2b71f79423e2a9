"""Learned metrics on small tables with known answers."""

import inspect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import learned as le, mixture


def test_mixture_detection_sees_outlying_rows(spark):
    """Candidates around a far wider ring are told from real rows by density, though each is sure of its cluster."""
    rng = random.Random(1)
    real = spark.createDataFrame([(f"r{i}", rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(600)], "key string, a double, b double")
    syn = spark.createDataFrame([(f"s{i}", rng.gauss(0, 6), rng.gauss(0, 6)) for i in range(600)], "key string, a double, b double")
    assert le.detection(real, syn, ["a", "b"], "key", "gmm").first()["auc"] > 0.85


def test_f1_difference_compares_real_and_candidate_models(spark):
    """Candidates with swapped labels teach the opposite: real models are right, theirs are wrong."""
    rng = random.Random(2)
    rows = [(f"k{i}", x := rng.uniform(-1, 1), rng.gauss(0, 1), "p" if x > 0 else "n") for i in range(200)]
    real = spark.createDataFrame(rows, "key string, a double, b double, y string")
    syn = spark.createDataFrame([(k, a, b, "n" if y == "p" else "p") for k, a, b, y in rows], real.schema)
    r = le.f1_difference(real, syn, "y", ["a", "b"], "key", ["linear"]).first()
    assert r["learner"] == "linear" and r["f1_real"] > 0.9 and r["f1_syn"] < 0.1 and r["value"] > 0.8


def test_p_mse_predicts_out_of_fold(spark, monkeypatch):
    rng = random.Random(3)
    make = lambda p: spark.createDataFrame([(f"{p}{i}", rng.gauss(0, 1)) for i in range(100)], "key string, a double")
    fitted, fit = [], le.LogisticRegression.fit
    monkeypatch.setattr(le.LogisticRegression, "fit", lambda self, df: fitted.append(df.count()) or fit(self, df))
    value = le.p_mse(make("r"), make("s"), ["a"], "key").first()["value"]
    assert len(fitted) == 5 and sum(fitted) == 4 * 200 and max(fitted) < 200
    assert 0 <= value < 0.05


def test_mia_and_grid_trials_do_the_operators_whole_job(spark, monkeypatch):
    from quarrystone.operators import fidelity as fi
    from quarrystone.plans import catalog, registry, storing

    d, asked = "/root/testdata/sf0.001", {}
    bind = inspect.signature(le.membership_attack).bind

    def attack(*a, **k):
        b = bind(*a, **k)
        b.apply_defaults()
        asked["rounds"] = b.arguments["rounds"]

    monkeypatch.setattr(le, "membership_attack", attack)
    registry.queries()["mia"](spark, d)
    assert asked["rounds"] == 5
    score, sizes, columns = fi.wasserstein_dist, [], []
    monkeypatch.setattr(fi, "wasserstein_dist", lambda x, made, c: (sizes.append(made.count()), columns.append(c)) and score(x, made, c))
    assert registry.queries()["grid_trials"](spark, d).count() == 2
    assert sizes == [catalog.real(spark, d).count()] * 2 and columns == [storing._COLS] * 2


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        x = rng.gauss(0, 1)
        rows.append((f"k{i}", x, 2 * x + rng.gauss(0, 0.2), "abc"[min(2, max(0, int(x + 1.5)))], rng.choice("pq"), rng.gauss(0, 1)))
    return spark.createDataFrame(rows, "key string, x double, y double, c string, noise string, z double").repartition(3)


@pytest.mark.parametrize("name", ["linear", "xgb", "mlp"])
def test_leakage_of_every_sensitive_column(people, name):
    """What depends on known columns leaks, what doesn't, doesn't; a constant column has no value."""
    both = people.withColumn("one", F.lit("o"))
    syn, rest = both.filter("crc32(key) % 2 = 0"), both.filter("crc32(key) % 2 = 1")
    got = {r.column: r for r in le.data_leakage(syn, rest, ["y", "c", "noise", "z", "one"], ["x"], name).collect()}
    assert {c: r.kind for c, r in got.items()} == {"y": "number", "c": "category", "noise": "category", "z": "number", "one": "category"}
    assert got["y"].value > 0.7 and got["c"].value > 0.7 and got["one"].value is None
    assert got["noise"].value < 0.7 and got["z"].value < 0.3


def test_leakage_of_candidates_without_the_relation(people):
    shuffled = people.withColumns({"y": F.col("z"), "c": F.lit("a")})
    other = {r.column: r.value for r in le.data_leakage(shuffled, people, ["y", "c"], ["x"], "linear").collect()}
    assert other["y"] < 0.3 and other["c"] is None


def test_auc_of_two_and_three_classes(people):
    for target, least in (("c", 0.95), ("noise", 0.0)):
        r = le.train_test_score(people, people, target, ["x", "y"], "linear").first()
        assert least <= r.auc <= 1
    assert le.train_test_score(people, people.filter("c = 'a'"), "c", ["x", "y"], "linear").first().auc is None
    by_hand = people.select((F.col("noise") == "p").cast("double").alias("label"), "z").collect()
    pairs = [(a.z > b.z) + 0.5 * (a.z == b.z) for a in by_hand if a.label for b in by_hand if not b.label]
    from pyspark.ml.functions import array_to_vector

    scored = people.select((F.col("noise") == "p").cast("double").alias("label"), array_to_vector(F.array(-F.col("z"), F.col("z"))).alias("rawPrediction"))
    assert abs(le.mean_auc(scored, 2) - sum(pairs) / len(pairs)) < 1e-9


def test_trials_survive_errors_and_restarts(spark, people, tmp_path):
    path, calls = str(tmp_path / "trials"), []
    specs = [{"k": 1}, {"k": 2}, {"k": 3}]

    def score(spec):
        calls.append(spec["k"])
        if spec["k"] == 2:
            people.select(F.raise_error(F.lit("broken"))).collect()  # Spark's own error
        if spec["k"] == 3 and len(calls) == 3:
            raise KeyboardInterrupt  # the run is broken off
        return spec["k"] / 10

    with pytest.raises(KeyboardInterrupt):
        le.grid_trials(spark, specs, score, "s", path)
    assert [(r.number, r.state[:4], r.value) for r in le.read_trials(spark, path).orderBy("number").collect()] == [(0, "COMP", 0.1), (1, "FAIL", None)]
    done = le.grid_trials(spark, specs, score, "s", path).orderBy("number").collect()
    assert calls == [1, 2, 3, 3] and [(r.number, r.state[:4], r.value, r.params["k"]) for r in done] == [(0, "COMP", 0.1, "1"), (1, "FAIL", None, "2"), (2, "COMP", 0.3, "3")]
    le.grid_trials(spark, specs, score, "s", path)
    assert len(calls) == 4
    assert le.grid_trials(spark, specs, lambda spec: 1.0, "s", path, retry=True).count() == 4 and le.grid_trials(spark, [{"k": 9}], lambda spec: 2.0, "other", path).count() == 1


def test_mixture_rounds_equal_mllib(spark, monkeypatch):
    """Same start, same rounds, same end, over many small blocks; the data are read by one pass for the blocks."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import VectorAssembler

    monkeypatch.setattr(mixture, "BLOCK_NUMBERS", 64)
    rng = random.Random(6)
    rows = [(rng.gauss(0, 1) + 40 * (i % 3), rng.gauss(0, 2) - 30 * (i % 3), float(i % 5)) for i in range(900)]
    x = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v").transform(spark.createDataFrame(rows, "a double, b double, c double").repartition(3, "a"))
    want = GaussianMixture(k=3, seed=7, featuresCol="v").fit(x)
    parts, likelihood, n = mixture.fit(x, "v", 3)
    assert n == want.summary.numIter and likelihood == pytest.approx(want.summary.logLikelihood, rel=1e-9)
    for (w, mean, cov), v, g in zip(parts, want.weights, want.gaussiansDF.collect()):
        assert w == pytest.approx(v, rel=1e-6)
        assert list(mean) == pytest.approx(list(g["mean"]), rel=1e-6, abs=1e-9) and cov.ravel().tolist() == pytest.approx(g["cov"].toArray().ravel().tolist(), rel=1e-6, abs=1e-9)


def test_leakage_takes_equal_rows_once(spark, monkeypatch):
    """Boosted trees see each distinct candidate with its number, and tell the same."""
    rows = spark.createDataFrame([(float(i), float(i % 5), float(i % 5)) for i in range(60)], "x double, k double, y double")
    seen, fit = [], le._number_r2
    monkeypatch.setattr(le, "_number_r2", lambda name, known, *more: (seen.append(known.count()), fit(name, known, *more))[1])
    value = lambda syn: le.data_leakage(syn, rows, ["y"], ["x", "k"], "xgb").first()["value"]
    assert value(rows.unionByName(rows).unionByName(rows)) == value(rows) and seen == [60, 60]


def _fold_by_fold(real, syn, target, columns, key, name, folds):
    """Micro F1 of MLlib's own models, fitted one by one."""
    from pyspark.ml.feature import StringIndexer

    index = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(real.unionByName(syn))
    real, syn = (le.hash_folds(index.transform(x), key, folds).cache() for x in (real, syn))
    hits = [0, 0]
    for i in range(folds):
        for side, source in enumerate((real, syn)):
            train, test = source.filter(F.col("_fold") != i), real.filter(F.col("_fold") == i)
            prep = le._features(train, columns).fit(train)
            got = le.learner(name, len(columns), len(index.labels)).fit(prep.transform(train).cache()).transform(prep.transform(test))
            hits[side] += got.filter("prediction = label").count()
    return [h / real.count() for h in hits]


@pytest.mark.parametrize("labels, slack", [("pq", {"xgb": 1e-9, "svm": 0.03}), ("abc", {"linear": 0.003, "forest": 0.05})])
def test_models_of_all_folds_at_once_tell_what_single_ones_tell(spark, labels, slack):
    """Few values a column, so that trees have the same cuts; boosted trees have no chance in them and are the same."""
    rng = random.Random(4)

    def make(p, noise):
        rows = [(f"{p}{i}", a := float(rng.randrange(12)), b := float(rng.randrange(9)), labels[min(len(labels) - 1, max(0, int((a + b + rng.gauss(0, noise)) * len(labels) / 20)))]) for i in range(400)]
        return spark.createDataFrame(rows, "key string, a double, b double, y string").coalesce(1).cache()

    real, syn = make("r", 2), make("s", 6)
    got = {r.learner: r for r in le.f1_difference(real, syn, "y", ["a", "b"], "key", list(slack), 2).collect()}
    for name, most in slack.items():
        want = _fold_by_fold(real, syn, "y", ["a", "b"], "key", name, 2)
        assert [got[name].f1_real, got[name].f1_syn] == pytest.approx(want, abs=most + 1e-6), name


def test_folds_and_classes_cost_no_jobs(spark, people):
    """Forty models of three classes are fitted in as many rounds as one has, and rows with a null number are told by none."""
    syn = people.withColumn("x", F.when(F.col("key") != "k7", F.col("x")))
    context = spark.sparkContext
    context.setJobGroup("folds", "")
    try:
        got = le.f1_difference(people.withColumn("y", F.when(F.col("key") != "k5", F.col("y"))), syn, "c", ["x", "y", "noise"], "key", ["forest", "xgb", "svm", "linear"]).collect()
        jobs = len(context.statusTracker().getJobIdsForGroup("folds"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs < 500
    assert {r.learner for r in got} == {"forest", "xgb", "svm", "linear"} and all(r.f1_real > 0.8 and abs(r.value) < 0.1 for r in got)


def test_lbfgs_ends_at_the_least():
    import numpy as np

    from quarrystone.operators import folds

    scale = np.array([1.0, 30.0, 900.0])
    search, at = folds.lbfgs(np.array([5.0, -3.0, 2.0])), None
    try:
        point = next(search)
        while True:
            point = search.send((float((scale * (point - 1) ** 2).sum()), 2 * scale * (point - 1)))
    except StopIteration as e:
        at = e.value
    assert at == pytest.approx([1, 1, 1], abs=1e-3)


def test_attack_and_relabelling_count_rows_once(spark, monkeypatch):
    """Forests of all rounds grow together on counted rows; no learner reads the rows, and rows without a number are left out."""
    rng = random.Random(8)
    rows = [(f"k{i}", rng.gauss(0, 1) + 9 * (i % 2), rng.choice("pq") if i % 2 else "r", "ab"[i % 2]) for i in range(600)]
    df = spark.createDataFrame([*rows, ("none", None, "p", "a")], "key string, x double, t string, y string").repartition(3).cache()
    monkeypatch.setattr(le, "learner", None)
    members, others = df.filter("y = 'a'"), df.filter("y = 'b'")
    r = le.membership_attack(members, others, members, ["x", "t"], "key").first()
    assert (r.mia_recall, r.mia_precision) == (1.0, 1.0)
    mixed = le.membership_attack(df, df, df, ["x", "t"], "key", 3).first()
    assert mixed.mia_recall > 0.9 and 0.55 < mixed.mia_precision < 0.8
    got = {r.key: r.y for r in le.relabel_by_classifier(df.withColumn("y", F.lit("?")), df, "y", ["x", "t"]).collect()}
    assert got == {k: y for k, _, _, y in rows}


def test_mixture_takes_equal_rows_once(spark):
    from pyspark.ml.feature import VectorAssembler

    rng = random.Random(9)
    rows = [(rng.gauss(0, 1) + 8 * (i % 2), rng.gauss(0, 2)) for i in range(200)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(spark.createDataFrame(rows * 3 + rows[:50], "a double, b double").repartition(3))
    blocks = mixture._blocks(df, "v").collect()
    assert sum(len(r.x) for r in blocks) == 200 * 16
    s = sum(mixture.sums(np.frombuffer(r.x).reshape(-1, r.width).T, np.frombuffer(r.n), [(1.0, np.zeros(2), np.eye(2))]) for r in blocks)
    assert s[1] == 650 and s[3:5] == pytest.approx(np.sum(rows * 3 + rows[:50], axis=0))


def test_scores_of_equal_rows_are_those_of_rows(spark, monkeypatch):
    """Learners that take weights fit each distinct row once, and every row counts in what is told right."""
    rows = [(float(i % 4), float(i % 3), "ab"[(i * i) % 7 % 2]) for i in range(420)]
    df = spark.createDataFrame(rows, "x double, y double, c string").repartition(3)
    fitted, learner = [], le.learner

    def watched(*a):
        model = learner(*a)
        fit = model.fit
        model.fit = lambda data: (fitted.append(data.count()), fit(data))[1]
        return model

    monkeypatch.setattr(le, "learner", watched)
    r = le.train_test_score(df, df.filter("x < 2"), "c", ["x", "y"], "linear").first()
    assert fitted == [len(set(rows))]
    monkeypatch.setattr(le, "WEIGHTED", ())
    assert le.train_test_score(df, df.filter("x < 2"), "c", ["x", "y"], "linear").first() == r and fitted[1] == 420
