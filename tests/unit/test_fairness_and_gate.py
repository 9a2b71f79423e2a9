import math

from pyspark.sql import functions as F

from quarrystone.operators import combine as k, fairness as f, impute as im, sections as se, split as sp, pii


def test_log_disparity_sentinels(spark):
    cases = [(0.0, 0.0, f.NO_INFO), (0.5, 0.0, -math.inf), (0.0, 0.5, f.NO_BASE), (1.0, 1.0, 0.0), (0.5, 1.0, math.inf), (1.0, 0.5, -math.inf), (0.5, 0.6, math.log(1.5))]
    df = spark.createDataFrame([c[:2] for c in cases], "a double, b double")
    got = [r[0] for r in df.select(f.log_disparity(F.col("a"), F.col("b"))).collect()]
    assert all(g == w or abs(g - w) < 1e-12 for g, (*_, w) in zip(got, cases))


def test_labels(spark):
    cases = [(-math.inf, 0.9, "Absent"), (f.NO_INFO, 0.1, "No Info"), (f.NO_BASE, 0.1, "No Base Data"), (f.INSUFFICIENT, None, "Insufficient Data"), (0.05, 0.8, "Equitable(p)"),
             (-0.25, 0.01, "Highly Underrepresented"), (-0.15, 0.01, "Underrepresented"), (0.05, 0.01, "Equitable"), (0.15, None, "Overrepresented"), (0.3, 0.01, "Highly Overrepresented")]
    df = spark.createDataFrame([c[:2] for c in cases], "v double, p double")
    assert [r[0] for r in df.select(f.equity_label(F.col("v"), F.col("p"))).collect()] == [c[2] for c in cases]


def test_bh(spark):
    p = [0.01, 0.04, 0.03, 0.005, -1.0, None]
    df = spark.createDataFrame(list(enumerate(p)), "i int, p double").withColumn("g", F.lit(1))
    got = {r.i: r.bh_p for r in f.bh_adjust(df, "p", ["g"]).collect()}
    assert [None if got[i] is None else round(got[i], 10) for i in range(6)] == [0.02, 0.04, 0.04, 0.02, None, None]


def test_scaling_and_gate(spark):
    m = spark.createDataFrame([("a", "family2", "privacy", "hit_rate", 0.01), ("b", "family2", "privacy", "hit_rate", 0.2), ("c", "family2", "privacy", "hit_rate", None), ("a", "family1", "utility", "ks_test", 0.5), ("b", "family1", "utility", "ks_test", 0.5), ("c", "family1", "utility", "ks_test", 0.5)], "model string, framework string, type string, metric string, value double")
    s = {(r.model, r.metric): r.scaled for r in k.minmax_scale(k.orient(m)).collect()}
    assert s == {("a", "hit_rate"): 1.0, ("b", "hit_rate"): 0.0, ("c", "hit_rate"): None, ("a", "ks_test"): 0.5, ("b", "ks_test"): 0.5, ("c", "ks_test"): 0.5}
    gate = {r.model: (r["pass"], r.violations) for r in k.privacy_gate(m).collect()}
    assert gate == {"a": (True, ""), "b": (False, "hit_rate=0.2 > 0.05"), "c": (False, "hit_rate=nan > 0.05")}
    assert k.privacy_gate(m.filter("metric = 'ks_test'")).count() == 0
    none = k.recommend(k.combined_table(m), k.privacy_gate(m).filter("NOT pass"))
    assert none.first().model is None


def test_mask_counts_and_exact_choice(spark):
    df = spark.range(11).select(sp.mask_count(F.col("id"), 0.25).alias("k"))
    assert [r.k for r in df.collect()] == [0, 0, 1, 1, 1, 1, 2, 2, 2, 2, 2]
    x = spark.range(5000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 3).alias("y"))
    train = sp.train_test_split(x, "key", 0.7, 1, "y").filter("split = 'train'").groupBy("y").count()
    assert {r.y: r["count"] for r in train.collect()} == {0: 1167, 1: 1167, 2: 1166}
    b = sp.bootstrap(x, "key", 777, 3)
    assert b.count() == 777 and b.select("key").distinct().count() < 777


def test_observed_cells_stay(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, "a"), (3, 3.0, None)], "k int, x double, c string")
    out = {r.k: (r.x, r.c) for r in im.impute(df, "k", ["x"], ["c"]).collect()}
    assert out == {1: (1.0, "a"), 2: (2.0, "a"), 3: (3.0, "a")}


def test_levels():
    h = lambda text, marker, n, case="mixed_case", inline=False: {"is_header": True, "content": text, "marker": marker, "marker_count": n, "case": case, "signature": f"{marker}{n}", "inline": inline}
    c = {"is_header": False, "content": "x"}
    tokens = [c, h("A", "#", 2), h("B", "#", 3), c, h("C", "*", 2), h("D", "*", 1), h("E", "*", 3), h("N", "*", 2, inline=True), c, c, h("CAPS", "#", 1, "all_caps"), h("F", "*", 2), h("CAPS2", "*", 2, "all_caps"), h("G", "#", 2)]
    assert [x[0] for x in se.fold_levels(tokens)] == [1, 1, 2, 3, 3, 4, 3, 4, 5, 4, 4, 5, 4, 1]
    assert se.fold_levels(tokens)[8][1] == ["A", "B", "E", "N"] and se.fold_levels(tokens)[9][1] == ["A", "B", "E"]
    assert se.fold_levels([]) == []


def test_fuzzy_and_findings(spark):
    df = spark.createDataFrame([("kitten",), ("sitting",), ("",)], "s string")
    got = [round(r[0], 4) for r in df.select(se.fuzzy_ratio(F.col("s"), "sitting")).collect()]
    assert got == [round(200 * 4 / 13, 4), 100.0, 0.0]
    d = spark.createDataFrame([(1, "mail a.b@c.org, card 4111 1111 1111 1111 or 4111 1111 1111 1112"), (2, ""), (3, None)], "id int, text string")
    found = pii.pattern_findings(d, entities=["EMAIL_ADDRESS", "CREDIT_CARD"])
    rows = {(r.id, r.entity, r.text, r.start) for r in pii.findings_table(found, ["id"]).collect()}
    assert rows == {(1, "EMAIL_ADDRESS", "a.b@c.org", 5), (1, "CREDIT_CARD", "4111 1111 1111 1111", 21)}
    masked = pii.anonymise(found, "mask", n=4).filter("id = 1").first().anonymised
    assert masked == "mail ****c.org, card **** 1111 1111 1111 or 4111 1111 1111 1112".replace("****c.org", "****" + "a.b@c.org"[4:])
    red = {r.id: r.anonymised for r in pii.anonymise(found, "redact").collect()}
    assert red == {1: "mail , card  or 4111 1111 1111 1112", 2: "", 3: None}
