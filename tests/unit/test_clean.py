import pytest
from pyspark.sql import functions as F

from quarrystone.functions.numeric import erfc, format_4g, json_array
from quarrystone.operators import clean as c


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_remap_needs_exactly_one_and_two(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (None, 1, 2)], "a int, b int, c int")
    assert rows(c.remap_binary_one_two(df)) == [(0, 1, 0), (1, 1, 1), (None, 1, 2)]


def test_ordinal_round_trip_and_errors(spark):
    order = {"s": ["low", "mid", "high"]}
    df = spark.createDataFrame([("high",), (None,), ("low",)], "s string")
    coded = c.encode_ordinal(df, order)
    assert rows(coded) == [(2.0,), (None,), (0.0,)] and rows(c.decode_ordinal(coded, order)) == rows(df)
    with pytest.raises(ValueError, match="outside"):
        c.encode_ordinal(spark.createDataFrame([("odd",)], "s string"), order)
    with pytest.raises(ValueError, match="range"):
        c.decode_ordinal(spark.createDataFrame([(1.5,)], "s double"), order)
    with pytest.raises(ValueError, match="no such"):
        c.encode_ordinal(df, {"t": ["x"]})


def test_outliers_in_one_pass_constants_stay(spark):
    df = spark.createDataFrame([(float(i % 3), 5.0, "x") for i in range(50)] + [(1000.0, 5.0, "x")], "a double, k double, t string")
    out = c.mask_outliers(df, ["a", "k", "t"])
    assert out.filter("a IS NULL").count() == 1 and out.filter("k IS NULL").count() == 0


def test_integer_like(spark):
    df = spark.createDataFrame([(1.0, 1.5, None), (2.0, 2.0, 3.0)], "a double, b double, n double")
    assert [f.dataType.simpleString() for f in c.cast_integer_like(df, ["a", "b", "n", "zz"]).schema] == ["bigint", "double", "double"]


def test_bins(spark):
    assert c.bin_labels([7, 18, 30]) == ["7-18", "19-30"] and c.bin_labels([0.5, 1.5, 2.5]) == ["0.50-1.50", "1.51-2.50"]
    df = spark.createDataFrame([(7.0,), (18.0,), (18.5,), (30.0,), (200.0,), (None,)], "x double")
    assert [r[0] for r in df.select(c.bin_column("x", [7, 18, 30])).collect()] == ["7-18", "7-18", "19-30", "19-30", "OutOfRange", "OutOfRange"]
    with pytest.raises(ValueError):
        c.bin_labels([1])


def test_bits_nearest_valid_takes_the_lowest(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0)], "b0 double, b1 double, b2 double")  # 7: 3, 5 and 6 differ by one bit
    assert c.decode_bits(df, ["b0", "b1", "b2"], list("abcdef"), "nearest_valid").first().decoded == "d"
    with pytest.raises(ValueError):
        c.decode_bits(df, ["b0", "b1", "b2"], list("abc"), "error")


def test_standardize_inverse_and_constant(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (None, 4.0)], "a double, k double")
    stats = c.scale_stats(df, ["a", "k"])
    z = c.standardize(df, ["a", "k"], stats)
    assert rows(z) == [(-0.5, 0.0), (0.5, 0.0), (None, 0.0)] and rows(c.destandardize(z, ["a", "k"], stats)) == rows(df)


def test_binary_target(spark):
    df = spark.createDataFrame([("F",), ("O",), ("P",)], "s string")
    assert [r[0] for r in c.binary_target(df, "s", ["F", "O"], ["P"]).collect()] == [1, 1, 0]
    with pytest.raises(ValueError):
        c.binary_target(df, "s", ["F"], ["P"])


def test_groups_are_checked(spark):
    df = spark.createDataFrame([(1, None)], "y int, g string")
    assert tuple(c.prepare_groups(df, "y", ["g"]).select("TARGET_LABEL", "g__GROUP").first()) == ("1", "nan")
    for bad in ([], ["y"], ["zz"]):
        with pytest.raises(ValueError):
            c.prepare_groups(df, "y", bad)


def test_numeric_functions(spark):
    import math

    xs = [0.0, 0.1, 0.7, 1.5, 3.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(erfc(F.col("x"))).collect()]
    assert all(abs(g - math.erfc(x)) < 2e-7 for g, x in zip(got, xs))
    vals = [0.0, 1.0, 0.05, 0.123456, 12345.678, 1e-5, 0.00012346, 99999.0, -2.5, 9999.6]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "x double").select(format_4g(F.col("x"))).collect()]
    assert got == [f"{v:.4g}" for v in vals]
    df = spark.createDataFrame([('["a","b"]',), ('["a","a"]',), ("[]",), ("x",)], "t string")
    assert [r[0] for r in df.select(json_array(F.col("t"))).collect()] == [["a", "b"], None, None, None]


def test_complete_cases_of_many_computed_columns(spark):
    wide = spark.range(10).select("id", *(F.when(F.col("id") != i % 10, F.col("id") * 1.5).alias(f"c {i}.x") for i in range(8)))
    rows = [r.id for r in c.complete_cases(wide).collect()]
    assert rows == [8, 9]
    lists = spark.range(6).select(F.array(*(F.when((F.col("id") != 3) | (F.lit(i) != 40), F.col("id") + i) for i in range(64))).alias("v"), "id")
    cells = lists.select("id", *(F.get("v", F.lit(i)).cast("double").alias(f"x{i}") for i in range(64)))
    full = c.complete_cases(cells, [f"x{i}" for i in range(64)]).select("id", *(F.col(f"x{i}").alias(f"y{i}") for i in range(64)))
    assert sorted(r.id for r in full.filter("y0 IS NOT NULL").collect()) == [0, 1, 2, 4, 5]
    odd = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3), (2.0, None)], "a double, b int")
    assert [tuple(r) for r in c.complete_cases(odd).collect()] == [(1.0, 1)]
    assert c.complete_cases(odd, []).count() == 4
