"""Order statistics and marginal metrics against numpy, and on constant columns and empty tables."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quarrystone.operators import fidelity as fi, order


def sides(spark, n=200, constant=False):
    rng = random.Random(1)
    row = lambda i: (i, 5.0 if constant else rng.gauss(0, 1), float(rng.randrange(4)), rng.choice("ab"), rng.choice("xyz"))
    real = spark.createDataFrame([row(i) for i in range(n)], "id bigint, u double, v double, c string, e string")
    syn = spark.createDataFrame([("m", *row(i)) for i in range(n)], "model string, id bigint, u double, v double, c string, e string")
    return real, syn


def test_quantiles_and_running_totals(spark, monkeypatch):
    monkeypatch.setattr(order, "BUCKETS", 5)
    rng = random.Random(2)
    rows = [(k, rng.choice([None, rng.gauss(0, 1), float(rng.randrange(3))])) for k in "pq" for _ in range(300)] + [("one", 7.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {(r.k, r.share): r.value for r in order.quantiles(df, "x", shares, ["k"]).collect()}
    for k in ("p", "q", "one"):
        x = [v for a, v in rows if a == k and v is not None]
        for s in shares:
            assert math.isclose(got[k, s], float(np.quantile(x, s)), rel_tol=1e-12, abs_tol=1e-12)
    counts = df.dropna().groupBy("k", "x").agg(F.count("*").alias("n"))
    for k in ("p", "q", "one"):
        r = order.running(counts, ["k"], "x", ["n"]).filter(F.col("k") == k).orderBy("x").collect()
        assert [t.cum_n for t in r] == np.cumsum([t.n for t in r]).tolist()
        assert [t.next for t in r] == [t.x for t in r[1:]] + [None]
    assert order.quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_many_values_are_numbered_in_order(spark, monkeypatch):
    monkeypatch.setattr(order, "CUT_SAMPLE", 64)
    monkeypatch.setattr(order, "BUCKETS", 8)
    names = sorted({f"w{random.Random(i).randrange(10**6)}" for i in range(500)})
    got = order.number_values(spark.createDataFrame([(n,) for n in names], "value string").repartition(3)).collect()
    assert {r.value: r.code for r in got} == {n: i for i, n in enumerate(names)}


def test_constant_columns_give_values(spark):
    real, syn = sides(spark, 60, constant=True)
    m = fi.marginals(real, syn, ["c"], ["u", "v"])
    for f in (fi.jensenshannon_dist, fi.chi_squared_test, fi.inv_kl_divergence, fi.h_dist, fi.total_variation, fi.chi_squared_statistic):
        assert f(m).first().value is not None
    one = real.withColumn("u", F.lit(5.0))
    assert fi.cio(one, syn, ["u"]).first().value == 1.0
    assert fi.cio(one, syn.withColumn("u", F.lit(6.0)), ["u"]).first().value == 0.0
    assert fi.hit_rate(one, syn, ["c"], ["u"], "id").first().value == 1.0
    assert fi.hit_rate(one, syn.withColumn("u", F.lit(6.0)), ["c"], ["u"], "id").first().value == 0.0
    assert fi.corr_diff(one, syn, ["u", "v"]).first().value == 0.0
    assert fi.ks_test(one, syn, ["u"]).first().value == 1.0 and fi.wasserstein_dist(one, syn, ["u"]).first().value == 0.0


def test_identical_sides_are_perfect(spark):
    real, _ = sides(spark)
    syn = real.withColumn("model", F.lit("m"))
    m = fi.marginals(real, syn, ["c", "e"], ["u", "v"])
    assert abs(fi.jensenshannon_dist(m).first().value) < 1e-9 and fi.chi_squared_test(m).first().value > 0.99
    assert fi.ks_test(real, syn, ["u", "v"]).first().value == 1.0
    r = fi.max_mean_discrepancy(real, syn, ["u", "v"], 50).first()
    assert abs(r.value) < 1e-9 and abs(r.linear) < 1e-12
    assert fi.corr_diff(real, syn, ["u", "v"], ["c", "e"]).first().value < 1e-9 and fi.hit_rate(real, syn, ["c"], ["u", "v"], "id").first().value == 1.0


def test_gaussian_discrepancy_sees_spread_where_means_agree(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(0, 1, 150), rng.normal(0, 3, 150)
    y = y - y.mean() + x.mean()
    real = spark.createDataFrame([(float(v),) for v in x], "u double")
    syn = spark.createDataFrame([("m", float(v)) for v in y], "model string, u double")
    s = x.std()
    k = lambda a, b: np.exp(-(((a[:, None] - b[None]) / s) ** 2) / 2).mean()
    for block in (16, 4096):
        r = fi.max_mean_discrepancy(real, syn, ["u"], block).first()
        assert abs(r.value - (k(x, x) + k(y, y) - 2 * k(x, y))) < 1e-9 and r.value > 0.05 and r.linear < 1e-12


def test_pairs_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(1000, 1, (300, 4))
    x[:, 1] += 0.5 * x[:, 0]
    rows = [[None if rng.random() < 0.1 else float(v) for v in r] for r in x]
    df = spark.createDataFrame([(("a", "b")[i % 2], *r) for i, r in enumerate(rows)], "k string, x0 double, x1 double, x2 double, x3 double")
    got = {(r.k, r.i, r.j): r.r for r in fi.correlations(df, ["k"], ["x0", "x1", "x2", "x3"]).collect()}
    assert len(got) == 12
    for (k, i, j), r in got.items():
        pairs = [(a[i], a[j]) for n, a in enumerate(rows) if ("a", "b")[n % 2] == k and a[i] is not None and a[j] is not None]
        assert abs(r - np.corrcoef(np.array(pairs).T)[0, 1]) < 1e-9


def test_chi_squared_tail_is_near_the_exact_one(spark):
    exact = [(3.841459, 1, 0.05), (11.0705, 5, 0.05), (18.307, 10, 0.05), (2.0, 2, math.exp(-1.0)), (9.21034, 2, 0.01), (0.5, 2, math.exp(-0.25))]
    df = spark.createDataFrame([(float(a), b) for a, b, _ in exact], "s double, k int")
    got = [r.p for r in df.select(fi.chi_squared_p(F.col("s"), F.col("k")).alias("p")).collect()]
    assert all(abs(p - w) < 0.01 for p, (_, _, w) in zip(got, exact))
