"""Models on counted rows tell what models on the rows themselves tell; fills by model leave no column to its mean."""

import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import counted, impute as im
from quarrystone.plans import registry

DATA = "/root/testdata/sf0.001"


def test_trees_of_counts_equal_trees_of_rows(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rng = random.Random(3)
    rows = [(float(a := rng.randrange(6)), float(b := rng.randrange(9)), a * b + rng.gauss(0, 1)) for _ in range(900)]
    df = spark.createDataFrame(rows, "a double, b double, y double").repartition(3).cache()
    cuts = counted.cut_points(df, ["a", "b"])
    assert cuts == {"a": [i + 0.5 for i in range(5)], "b": [i + 0.5 for i in range(8)]}
    seen = counted.interval(counted.interval(df, "a", "_a", cuts["a"]), "b", "_b", cuts["b"]).cache()
    cells = seen.groupBy("_a", "_b").agg(F.avg("y").alias("_y"), F.count("*").alias("n"))
    assert cells.count() <= 54
    got = counted.fit(cells, ["_a", "_b"], {}, None).transform(counted.assembled(seen, ["_a", "_b"], {}))
    plain = VectorAssembler(inputCols=["_a", "_b"], outputCol="_v").transform(got)
    both = GBTRegressor(labelCol="y", featuresCol="_v", maxIter=10, maxDepth=4, seed=7).fit(plain).transform(plain)
    assert both.agg(F.max(F.abs(F.col("prediction") - F.col("_p")))).first()[0] < 1e-6


def test_intervals_of_odd_values(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, -5.0), (4, 0.5), (5, 9.0)], "k int, v double")
    of = lambda cuts: [r.b for r in counted.interval(df, "v", "b", cuts).orderBy("k").collect()]
    assert of([0.0, 1.0]) == [3.0, 3.0, 0.0, 1.0, 2.0] and of([]) == [2.0, 2.0, 0.0, 0.0, 0.0]
    many = spark.range(1000).select(F.col("id").cast("double").alias("v"), F.lit(1.0).alias("one"), F.lit(None).cast("double").alias("none"))
    cuts = counted.cut_points(many, ["v", "one", "none"])
    assert len(cuts["v"]) == counted.BINS - 1 and cuts["one"] == cuts["none"] == []


def test_columns_that_no_model_can_fill(spark):
    rows = [(i, None if i % 4 == 0 else "only", None, float(i), None if i % 5 == 0 else float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, t string, empty double, x double, y double")
    got = im.impute(df, "id", ["empty", "x", "y"], ["t"], "model", checkpoint=lambda x: x.localCheckpoint()).collect()
    assert all(r["t"] == "only" and r["empty"] is None and r["x"] == r["id"] and r["y"] is not None for r in got)


@pytest.mark.parametrize("name", ["model_fill", "polish"])
def test_fills_come_from_models_in_every_column(spark, name, monkeypatch):
    passes, fit = [], counted.fit
    monkeypatch.setattr(counted, "fit", lambda *a: (passes.append(a[3]), fit(*a))[1])
    got = registry.queries()[name](spark, DATA).persist()
    from quarrystone.plans.masking import lnu

    was = lnu(spark, DATA).select(F.col("row_id").alias("k"), *(F.col(c).alias(f"o_{c}") for c in ("l_quantity", "l_extendedprice", "l_returnflag")))
    both = got.join(was, F.col("row_id") == F.col("k")).persist()
    assert both.count() == got.count() == was.count()
    for c in ("l_quantity", "l_extendedprice"):
        r = both.agg(F.count_distinct(F.when(F.col(f"o_{c}").isNull(), F.col(c))).alias("fills"), F.count_if(F.col(c).isNull() | (F.col(f"o_{c}") != F.col(c))).alias("wrong")).first()
        assert r["fills"] > 5 and r["wrong"] == 0, c
    assert both.filter("l_returnflag IS NULL OR o_l_returnflag <> l_returnflag").isEmpty()
    assert passes == [None, None, 3] * (2 if name == "polish" else 1)  # polish goes on from a whole pass of the models
    got.unpersist(), both.unpersist()
