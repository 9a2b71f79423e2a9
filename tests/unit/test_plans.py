"""Plans that must not grow faster than the columns, and choices that must not shuffle what is decided."""

import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import clean, impute as im, split as sp


def nodes(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("\n"), plan.count("LogicalRDD") + plan.count("Relation")


def wide(spark, k, n=60):
    rng = random.Random(1)
    rows = [tuple(None if rng.random() < 0.2 else f"v{rng.randrange(1 + i % 7)}" for i in range(k)) for _ in range(n)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"c{i} string" for i in range(k))), rows


def test_modes_and_labels_of_fifty_columns(spark):
    df, rows = wide(spark, 50)
    columns = [f"c{i}" for i in range(50)]
    size, scans = nodes(im.mode_fill(df, columns))
    assert scans == 2 and size < 40
    filled = {r.id: r for r in im.mode_fill(df, columns).collect()}
    for i, c in enumerate(columns):
        seen = [r[i] for r in rows if r[i] is not None]
        top = min(set(seen), key=lambda v: (-seen.count(v), v))
        assert all(filled[n][c] == (r[i] if r[i] is not None else top) for n, r in enumerate(rows))
    small, _ = nodes(clean.label_encode(df, columns[:10]))
    size, _ = nodes(clean.label_encode(df, columns))
    assert size < 5 * small + 20
    coded = {r.id: r for r in clean.label_encode(df, columns).collect()}
    for i, c in enumerate(columns):
        order = sorted({r[i] for r in rows} - {None})
        assert all(coded[n][c] == (None if r[i] is None else order.index(r[i])) for n, r in enumerate(rows))


def test_label_encode_of_types_and_many_values(spark, monkeypatch):
    monkeypatch.setattr(clean, "SORTED_HERE", 3)
    rng = random.Random(2)
    rows = [(i, rng.choice([None, *range(-40, 40)]), f"é{rng.randrange(90)}", f"b{rng.randrange(2)}", None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, n int, s string, t string, e double").repartition(3)
    got = {r.id: r for r in clean.label_encode(df, ["n", "s", "t", "e"]).collect()}
    for at, c in ((1, "n"), (2, "s"), (3, "t"), (4, "e")):
        order = sorted({r[at] for r in rows} - {None})
        assert all(got[r[0]][c] == (None if r[at] is None else order.index(r[at])) for r in rows)
    assert clean.label_encode(df.limit(0), ["n", "s"]).count() == 0
    typed = im.mode_fill(df.select("id", "n", "t", "e"), ["n", "t", "e"])
    seen = [r[1] for r in rows if r[1] is not None]
    top = min(set(seen), key=lambda v: (-seen.count(v), v))
    assert all(r.n == (rows[r.id][1] if rows[r.id][1] is not None else top) and r.e is None for r in typed.collect())


@pytest.mark.parametrize("slices", [1, 7, 4096])
def test_exactly_k_and_only_the_edge_is_ranked(spark, monkeypatch, slices):
    monkeypatch.setattr(sp, "SLICES", slices)
    df = spark.createDataFrame([(f"k{i}", "abc"[i % 3] if i % 11 else "d") for i in range(500)], "key string, g string").repartition(3)
    rows = df.withColumn("u", sp.unit_hash(F.col("key"), 1))
    for share in (0.0, 0.01, 0.37, 1.0):
        got = {}
        for r in sp.take_smallest(rows, ["g"], "u", "key", lambda n: F.floor(n * share).cast("bigint")).collect():
            got.setdefault(r.g, set()).add(r.key)
        for g in "abcd":
            own = sorted((r.u, r.key) for r in rows.filter(F.col("g") == g).collect())
            assert got.get(g, set()) == {k for _, k in own[: int(len(own) * share)]}
    split = sp.train_test_split(df, "key", 0.6667, 42, "g")
    assert split.columns == ["key", "g", "split"]
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Window" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_mask_difference_makes_each_mask_once(spark):
    a = spark.createDataFrame([("x", "1"), ("x", "1"), ("x", "2"), (None, "3")], "column string, key string")
    b = spark.createDataFrame([("x", "1"), ("y", "2"), (None, "3")], a.schema)
    got = sp.mask_difference(a, b)
    assert sorted(map(tuple, got.collect())) == [("x", "1"), ("x", "2"), ("y", "2")] and got.columns == a.columns
    assert nodes(got)[1] == 2


def test_masks_keep_their_size_where_a_sum_comes_out_differently_each_time(spark, monkeypatch):
    import time

    import pandas as pd

    @F.pandas_udf("double")
    def stirred(v: pd.Series) -> pd.Series:
        return v * (1 + (time.time_ns() // 1000 % 1000) / 500)

    df = spark.range(4000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 97).cast("double").alias("a"), F.lit(1.0).alias("b")).repartition(4)
    agg, unsteady = type(df).agg, stirred.asNondeterministic()

    def other_each_time(self, *columns):
        out = agg(self, *columns)
        return out.select(*(unsteady(c).alias(c) if c.startswith("_m_") else F.col(c) for c in out.columns))

    monkeypatch.setattr(type(df), "agg", other_each_time)
    for mechanism in ("mar", "mnar"):
        got = sp.artificial_mask(df, "k", ["b", "a"], mechanism=mechanism).groupBy("column").count().collect()
        assert {r["column"]: r["count"] for r in got} == {"a": 800, "b": 800}


def test_only_rows_of_repeated_keys_are_numbered(spark, tmp_path):
    from quarrystone.plans import catalog

    row = "cast({0} as bigint) l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, cast({1} as double) l_quantity, 10d l_extendedprice, 0d l_discount, 0d l_tax, 'A' l_returnflag, 'F' l_linestatus, timestamp'2020-01-01' l_shipdate"
    for name, rows in (("some", [(1, 2), (2, 5), (1, 1), (3, 4)]), ("none", [(1, 2), (2, 5)])):
        spark.sql(" UNION ALL ".join(f"SELECT {row.format(*r)}" for r in rows)).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        out = catalog.unique_li(spark, f"{tmp_path}/{name}")
        got = {(r.l_orderkey, r.l_quantity): r.row_id.rsplit("-", 1)[1] for r in out.collect()}
        assert got == {(1, 1.0): "1", (1, 2.0): "2", (2, 5.0): "1", (3, 4.0): "1"} if name == "some" else got == {(1, 2.0): "1", (2, 5.0): "1"}
        assert ("Window" in out._jdf.queryExecution().executedPlan().toString()) == (name == "some")


def test_fills_join_no_rows_and_keep_observed_cells(spark):
    rows = [(None if i == 5 else i, None if i % 5 == 0 else float(i % 7), None if i % 4 == 0 else float(i % 3), None if i % 6 == 0 else "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, x double, y double, t string")
    for how in ({}, {"method": "model", "passes": 2}, {"method": "model", "refine": ["x", "t"]}):
        joins = []

        def kept(frame):
            joins.append(frame._jdf.queryExecution().optimizedPlan().toString())
            return frame.localCheckpoint()

        out = im.impute(df, "id", ["x", "y"], ["t"], checkpoint=kept, **how)
        joins.append(out._jdf.queryExecution().optimizedPlan().toString())
        assert not any("Join Inner" in p or "Join LeftOuter" in p for p in joins)
        got = {r.id: r for r in out.collect()}
        assert len(got) == 60 and out.columns == df.columns
        for i, x, y, t in rows:  # a row without a key is filled, too
            assert all(g is not None and o in (None, g) for o, g in zip((x, y, t), got[i][1:]))


def test_masks_as_bits_hide_the_same_cells_without_joins(spark):
    rng = random.Random(4)
    rows = [(f"k{i}", None if i % 9 == 0 else rng.gauss(0, 1), float(rng.randrange(5)), rng.choice("aab") if i % 7 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, x double, y double, t string").repartition(3)
    how = (df, "key", ["x", "y", "t"], ["mar", "mcar", "mnar"], 2, 5)
    bits, cells = sp.hidden_grid(*how), sp.mask_grid(*how)
    plan = bits.rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan.replace("hashpartitioning(_c", "")
    hidden = {(m, i, c, r["key"]) for r in bits.rows.collect() for at, (m, i, c) in enumerate(bits.names) if r["_hidden"] >> at & 1}
    assert hidden == {tuple(r) for r in cells.collect()} and len(hidden) > 1000
    fills = {"means": lambda f: im.mode_fill(im.mean_fill(f, ["x", "y"]), ["t"])}
    score = lambda masks: {tuple(r)[:3]: round(r["objective"], 9) for r in im.masked_benchmark(df, "key", ["x", "y"], ["t"], masks, fills).collect()}
    found = score(bits)
    assert found == score(cells) and len(found) == 6
    with pytest.raises(ValueError):
        im.masked_benchmark(df, "key", ["x", "y"], ["t"], bits, {"drops": lambda f: f.select("key", "x", "y", "t")})
