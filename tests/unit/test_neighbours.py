"""Exact neighbours against brute force, whatever the blocks are."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import neighbours as nn


def table(spark, x, start=0):
    return spark.createDataFrame([(start + i, [float(v) for v in row]) for i, row in enumerate(x)], "id bigint, v array<double>").repartition(3)


def brute(q, x, k, same=False):
    d = np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    if same:
        np.fill_diagonal(d, np.inf)
    out = {}
    for i, row in enumerate(d):
        order = sorted(range(len(row)), key=lambda j: (row[j], j))[:k]
        out[i] = [(j, row[j]) for j in order if np.isfinite(row[j])]
    return out


@pytest.mark.parametrize("block", [7, 40, 4096])
def test_neighbours_equal_brute_force(spark, block):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.1, (40, 5)) for c in (-5, 0, 5)] + [np.zeros((9, 5))])
    q = np.concatenate([rng.normal(0, 4, (30, 5)), x[:10], np.zeros((2, 5))])
    for k, same, a in ((1, False, q), (3, False, q), (2, True, x)):
        got = {}
        for r in nn.nn_join(table(spark, a).withColumnRenamed("id", "q"), table(spark, x).withColumnRenamed("id", "n"), "q", "n", "v", k, same, block).collect():
            got.setdefault(r.q, []).append((r.n, r.distance, r["rank"]))
        for i, want in brute(a, x, k, same).items():
            found = sorted(got[i], key=lambda t: t[2])
            assert [f[0] for f in found] == [w[0] for w in want] and np.allclose([f[1] for f in found], [w[1] for w in want], atol=1e-12)


def test_copies_are_at_distance_zero_at_full_block_size(spark):
    """4,096 rows of 64 numbers near 1000: products cancel there, differences don't."""
    rng = np.random.default_rng(2)
    x = rng.normal(1000, 1, (4096, 64))
    at = np.arange(4096)
    rows, cols, d = nn.nearest(x, at, x, at, 1, False)
    assert (rows == at).all() and (cols == at).all() and (d == 0).all()
    some = rng.choice(4096, 60, replace=False)
    rows, cols, d = nn.nearest(x[some], some, x, at, 3, True)
    want = brute(x[some], x, 4)
    for i in range(60):
        mine = [(j, v) for j, v in want[i] if j != some[i]][:3]
        assert cols[rows == i].tolist() == [j for j, _ in mine] and np.allclose(np.sqrt(d[rows == i]), [v for _, v in mine], rtol=1e-14)


@pytest.mark.parametrize("block", [6, 4096])
def test_balls(spark, block):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(25, 3)), rng.normal(size=(30, 3))
    r = rng.uniform(0.2, 1.5, 25)
    radius = spark.createDataFrame([(i, float(v)) for i, v in enumerate(r)], "q bigint, r double")
    got = {t.n: t.balls for t in nn.ball_counts(table(spark, x), table(spark, y), "id", "v", radius, block).collect()}
    inside = (np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2)) <= r[:, None]).sum(axis=0)
    assert got == {j: int(n) for j, n in enumerate(inside) if n}


def test_empty_sides_and_copies(spark):
    x = table(spark, np.ones((6, 2)))
    none = x.limit(0)
    assert nn.nn_join(x.withColumnRenamed("id", "q"), none.withColumnRenamed("id", "n"), "q", "n", "v").count() == 0
    assert nn.nn_join(none.withColumnRenamed("id", "q"), x.withColumnRenamed("id", "n"), "q", "n", "v").count() == 0
    assert nn.dcr(x, x, "id", "v").first().value is None  # all real rows are copies
    p = nn.prdc(x, x, "id", "v", 2).first()
    assert (p.precision, p.recall, p.coverage) == (1.0, 1.0, 1.0) and p.density == 6 / 2


def test_nnaa_by_hand(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(12, 2)), rng.normal(0.5, 1, (12, 2))
    real, syn = table(spark, a), table(spark, b, 100)
    own = lambda x: [v[0][1] for v in brute(x, x, 1, True).values()]
    other = lambda x, y: [v[0][1] for v in brute(x, y, 1).values()]
    want = (np.mean(np.array(other(a, b)) > own(a)) + np.mean(np.array(other(b, a)) > own(b))) / 2
    assert abs(nn.nnaa(syn, real, "id", "v").first().value - want) < 1e-12
    assert nn.nnaa(syn.limit(0), real, "id", "v").first().value is None
    many = nn.nnaa(syn.filter("id < 104"), real, "id", "v", 5).first().value
    assert 0 <= many <= 1


def test_disclosure_tolerance(spark):
    real = table(spark, [[0, 0], [1, 1], [2, 2]]).withColumn("a", F.col("id") * 10.0)
    syn = table(spark, [[0, 0], [1, 1], [2, 2]]).withColumn("a", F.col("id") * 10.0 + F.col("id"))
    value = lambda t: nn.attribute_disclosure(real, syn, "id", "v", "a", t).first().value
    assert (value(None), value(1 / 20), value(1 / 10)) == (1 / 3, 2 / 3, 1.0)


def test_rounds_meet_fewer_blocks_than_all_pairs(spark, monkeypatch):
    """Unclustered rows of low dimension; a third of the searched side are copies of one row."""
    rng = np.random.default_rng(5)
    x, q = rng.uniform(size=(900, 2)), rng.uniform(size=(600, 2))
    x = np.concatenate([x, np.repeat(x[:1], 450, axis=0)])
    met, products = [], []
    real = nn.met_blocks

    def counting(asking, blocks):
        out = real(asking, blocks)
        met.append(out.count())
        products.append(out.select(F.sum(F.size("qs") * F.size("xs"))).first()[0])
        return out

    monkeypatch.setattr(nn, "met_blocks", counting)
    got = {}
    for r in nn.nn_join(table(spark, q).withColumnRenamed("id", "q"), table(spark, x).withColumnRenamed("id", "n"), "q", "n", "v", 2, False, 30).collect():
        got.setdefault(r.q, []).append((r["rank"], r.n, r.distance))
    for i, want in brute(q, x, 2).items():
        assert [g[1] for g in sorted(got[i])] == [w[0] for w in want] and np.allclose([g[2] for g in sorted(got[i])], [w[1] for w in want], atol=1e-12)
    assert len(met) == 2 and sum(met) < (1350 // 30) * (600 // 30) / 3 and sum(products) < 600 * 1350 / 8


@pytest.mark.parametrize("own", [True, False])
def test_rounds_of_subsets(spark, own):
    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(120, 2)), rng.normal(size=(50, 2))
    share, rounds = 0.3, 4
    b = table(spark, x)
    got = {(r.i, r.q): r.distance for r in nn.nearest_in_rounds(b if own else table(spark, q), b, "id", "v", share, rounds, own, 20).collect()}
    want = {}
    for i in range(rounds):
        chosen = [j for j in range(120) if nn.unit_hash_of(f"{j}|nnaa|{i}") < share]
        for j in chosen if own else range(50):
            d = [np.linalg.norm((x if own else q)[j] - x[m]) for m in chosen if not (own and m == j)]
            want[i, j] = min(d)
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-12 for t in want)


def test_copies_of_rows_are_met_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    real, syn = (rng.integers(0, 6, (n, 2)).astype(float) for n in (900, 500))
    tables = table(spark, syn, 5000), table(spark, real)
    met, pairs = nn.met_blocks, []

    def counting(asking, blocks):
        out = met(asking, blocks).persist()
        pairs.append(out.agg(F.sum(F.size("qs").cast("bigint") * F.size("xs"))).first()[0] or 0)
        return out

    monkeypatch.setattr(nn, "met_blocks", counting)
    d = lambda a, b: np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    rr, rs, ss = d(real, real), d(real, syn), d(syn, syn)
    for x in (rr, ss):
        np.fill_diagonal(x, np.inf)
    r5, s5 = np.sort(rr, axis=1)[:, 4], np.sort(ss, axis=1)[:, 4]
    inside = rs <= r5[:, None]
    want = inside.any(axis=0).mean(), (rs <= s5[None, :]).any(axis=1).mean(), inside.sum() / len(syn) / 5, (rs.min(axis=1) <= r5).mean()
    balls = spark.createDataFrame([(i, float(r)) for i, r in enumerate(r5)], "q bigint, r double")
    got = nn.distinct_ball_counts(tables[1], tables[0], "id", "v", balls)
    assert got.agg(F.sum("copies")).first()[0] == round(want[0] * len(syn)) and sum(pairs) <= 36 * 36
    np.testing.assert_allclose(tuple(nn.prdc(*tables, "id", "v").first()), want)
    share, rounds, scores = 500 / 900, 30, []
    pairs.clear()
    for i in range(rounds):
        on = np.array([nn.unit_hash_of(f"{j}|nnaa|{i}") < share for j in range(900)])
        first, second = (rs.min(axis=1) > np.where(on[None, :], rr, np.inf).min(axis=1))[on], rs[on].min(axis=0) > ss.min(axis=1)
        scores.append((first.mean() + second.mean()) / 2)
    assert abs(nn.nnaa(*tables, "id", "v").first().value - np.mean(scores)) < 1e-12
    assert sum(pairs) < 36 * 900 * 2  # never rows against rows


def test_visits_of_many_cells_shuffle_no_vectors(spark):
    """Over 64 cells, so that visits take two words of bits: what meets is read from checkpoints, and all neighbours are found."""
    rng = np.random.default_rng(8)
    x, q = rng.uniform(size=(700, 3)), rng.uniform(-0.5, 1.5, size=(90, 3))
    a, b = (table(spark, v).select(F.col("id").cast("bigint").alias("id"), "v", F.lit(0).cast("bigint").alias("tag")) for v in (q, x))
    cells = nn.Cells(b, 8)
    assert len(cells.radius) > 64
    met = cells.met(nn._unbound(nn._celled(a, cells.pivots)), None, 3)
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    assert met.select(F.explode("qs")).distinct().count() == 90
    got = {}
    for r in nn.nn_join(table(spark, q).withColumnRenamed("id", "q"), table(spark, x).withColumnRenamed("id", "n"), "q", "n", "v", 3, False, 8).collect():
        got.setdefault(r.q, []).append((r["rank"], r.n, r.distance))
    for i, want in brute(q, x, 3).items():
        assert [g[1] for g in sorted(got[i])] == [w[0] for w in want] and np.allclose([g[2] for g in sorted(got[i])], [w[1] for w in want], atol=1e-12)


def test_homes_hold_all_cells_and_no_more_rows_than_asked(spark):
    cells = nn.Cells(nn._sides(table(spark, np.random.default_rng(9).uniform(size=(400, 2))), "id", "v"), 10)
    sizes = {c: 3 + c % 5 for c in range(1, len(cells.radius))} | {0: 50}
    homes, held = cells.homes(sizes, 20)
    assert homes.keys() == sizes.keys() and sum(held.values()) == sum(sizes.values()) and all(n <= 20 or n == 50 for n in held.values())
    assert len(held) < len(sizes) / 2 and cells.homes({}, 20) == ({}, {})


@pytest.mark.parametrize("same", [False, True])
def test_copies_ask_once(spark, monkeypatch, same):
    """Equal rows of the asking side find what each finds by itself."""
    rng = random.Random(12)
    rows = [(i, [float(rng.randrange(4)), float(rng.randrange(3)) if i % 50 else -0.0]) for i in range(300)] + [(300, None), (301, [9.5, 1.0])]
    a = spark.createDataFrame(rows, "k long, v array<double>").repartition(3).cache()
    b = a if same else spark.createDataFrame([(1000 + i, [rng.random() * 4, rng.random() * 3]) for i in range(40)], a.schema)
    asked, join = [], nn._nn_join
    monkeypatch.setattr(nn, "_nn_join", lambda x, *more: (asked.append(x.count()), join(x, *more))[1])
    got = {(r.q, r["rank"]): r.distance for r in nn.distances(a, b, "k", "v", 3, same).collect()}
    assert asked == [len({tuple(v) for _, v in rows if v})]
    other = rows if same else [(r.k, r.v) for r in b.collect()]
    for i, v in rows:
        if v:
            d = sorted(math.dist(v, w) for j, w in other if w and not (same and i == j))
            assert [got[i, n + 1] for n in range(3)] == pytest.approx(d[:3])
    assert len(got) == 301 * 3
    if not same:
        one = {(r.k, r["rank"]): r.n for r in nn.nn_join(a, b.withColumnRenamed("k", "n"), "k", "n", "v", 2).collect()}
        each = {(r.k, r["rank"]): r.n for r in join(a, b.withColumnRenamed("k", "n"), "k", "n", "v", 2, False, 4096).collect()}
        assert one == each
