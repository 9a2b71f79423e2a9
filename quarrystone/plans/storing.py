"""Queries of sources, sinks, provenance and learned metrics."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from quarrystone.functions.numeric import base_model, json_array, slug
from quarrystone.operators import combine as co, evaluate as ev, generate as ge, impute as im, learned as le, provenance as pr, split as sp
from quarrystone.plans.catalog import LI, li, query, real, cand, t
from quarrystone.plans.masking import _LN1, _mask_sql, lnu, mask, u
from quarrystone.plans.reports import SECTIONS, sections
from quarrystone.sources import tables as so


@query("read_table", "SELECT * FROM supplier")
def _(s, d):
    return so.read_table(s, f"{d}/supplier.parquet")


@query("read_csv_consistent", "SELECT n_nationkey, n_name, CASE WHEN n_nationkey = 7 THEN 'late' END AS note FROM nation")
def _(s, d):
    path = so.shared_folder(s)
    t(s, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") == 7, "late").alias("note")).write.csv(path, header=True)
    return so.read_csv_consistent(s, path)


@query("bind_feature_target", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 3 > 0")
def _(s, d):
    o = t(s, d, "orders")
    return so.bind_feature_target(o.select("o_orderkey", "o_totalprice"), o.filter("o_orderkey % 3 > 0").select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("write_splits", f"WITH {LI} SELECT split, count(*)::BIGINT AS n, sum(l_quantity) AS q FROM (SELECT l_quantity, CASE WHEN {u('row_id', 42)} < 0.6667 THEN 'train' ELSE 'test' END AS split FROM li) GROUP BY split")
def _(s, d):
    path = so.shared_folder(s)
    so.write_splits(sp.split_by_threshold(li(s, d), "row_id", 0.6667, 42), path)
    return s.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


@query("read_candidates", "SELECT 'even' AS model, p_partkey, p_size FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 'odd', p_partkey, p_size FROM part WHERE p_partkey % 2 = 1")
def _(s, d):
    path, p = so.shared_folder(s), t(s, d, "part").select("p_partkey", "p_size")
    for name, k in (("even", 0), ("odd", 1)):
        p.filter(f"p_partkey % 2 = {k}").write.csv(f"{path}/{name}.csv", header=True)
    out = so.read_candidates(s, path)
    return out.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("write_candidate", "SELECT 'a' AS model, count(*)::BIGINT AS n FROM part WHERE p_size > 10")
def _(s, d):
    path, p = so.shared_folder(s), t(s, d, "part")
    so.write_candidate(p.filter("p_size > 10"), path, "a")
    so.write_candidate(p, path, "a")  # kept as it is
    return s.read.parquet(path).groupBy("model").agg(F.count("*").alias("n"))


@query("load_imputed", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'train' ELSE 'test' END AS split, 'seed' AS differing FROM part")
def _(s, d):
    path, p = so.shared_folder(s), t(s, d, "part").withColumn("split", F.when(F.col("p_partkey") % 2 == 0, "train").otherwise("test"))
    so.write_imputed(p, path, {"seed": 1, "method": "mean"})
    good, _ = so.load_imputed(s, path, {"seed": 1, "method": "mean"})
    bad, diff = so.load_imputed(s, path, {"seed": 2, "method": "mean"})
    if bad is not None:
        raise AssertionError("splits of another seed were taken")
    return good.select("p_partkey", "split").crossJoin(diff.select(F.col("field").alias("differing")))


@query("load_variable_schema", """SELECT p_brand AS "column", CASE WHEN max(p_size) % 3 = 0 THEN 'ordinal' WHEN max(p_size) % 3 = 1 THEN 'nominal' ELSE 'continuous' END AS kind,
CASE WHEN max(p_size) % 3 = 0 THEN array_to_string(list(DISTINCT p_type ORDER BY p_type), '|') END AS levels FROM part WHERE p_brand <> (SELECT min(p_brand) FROM part) GROUP BY p_brand""")
def _(s, d):
    path, p = so.shared_folder(s), t(s, d, "part")
    kind = F.when(F.max("p_size") % 3 == 0, "ordinal").when(F.max("p_size") % 3 == 1, "nominal").otherwise("continuous")
    g = p.groupBy(F.col("p_brand").alias("column")).agg(kind.alias("kind"), F.to_json(F.sort_array(F.collect_set("p_type"))).alias("ordinal_order"))
    g.withColumn("ordinal_order", F.when(F.col("kind") == "ordinal", F.col("ordinal_order"))).write.option("escape", '"').csv(path, header=True)
    names = sorted(r[0] for r in p.select("p_brand").distinct().collect())  # the columns of a data set
    out = so.load_variable_schema(s, path, names, target=names[0])
    return out.select("column", "kind", F.array_join("ordinal_order", "|").alias("levels"))


@query("slug", "SELECT p_partkey, regexp_replace(p_name || '/' || p_type, '[^A-Za-z0-9._-]+', '_', 'g') || '-' || substr(sha256(p_name || '/' || p_type), 1, 12) AS slug, regexp_replace(p_brand || '_hpo', '_hpo$', '') AS base FROM part")
def _(s, d):
    name = F.concat("p_name", F.lit("/"), "p_type")
    return t(s, d, "part").select("p_partkey", slug(name).alias("slug"), base_model(F.concat("p_brand", F.lit("_hpo"))).alias("base"))


@query("json_array", "SELECT p_partkey, CASE WHEN p_size % 4 > 0 THEN p_brand || '|' || p_type END AS levels FROM part")
def _(s, d):
    good = F.to_json(F.array("p_brand", "p_type"))
    text = F.when(F.col("p_size") % 4 > 0, good).when(F.col("p_size") % 8 == 0, F.to_json(F.array("p_brand", "p_brand"))).otherwise("[]")
    return t(s, d, "part").select("p_partkey", F.array_join(json_array(text), "|").alias("levels"))


@query("write_mask", f"WITH {_LN1} {_mask_sql('mcar', 5)}")
def _(s, d):
    path = so.shared_folder(s)
    rows = lnu(s, d)
    so.write_mask(mask(s, d, rows=rows), path)
    return so.read_mask(s, path, mask(s, d, rows=rows))


@query("write_sections", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, content FROM sec")
def _(s, d):
    path = so.shared_folder(s)
    so.write_sections(sections(s, d), path)
    return so.read_sections(path, s).select("id", "start_line", "content")


@query("report_bundle", "SELECT 'big' AS name, count(*)::BIGINT AS n FROM part WHERE p_size > 25 UNION ALL SELECT 'all', count(*)::BIGINT FROM part")
def _(s, d):
    path, p = so.shared_folder(s), t(s, d, "part")
    so.write_report_bundle({"big": p.filter("p_size > 25"), "all": p}, path)
    parts = [df.agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, df in so.load_report_bundle(s, path).items()]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query("dataset_manifest", f"""WITH {LI}, x AS (SELECT CASE WHEN {u('row_id', 42)} < 0.6667 THEN 'train' ELSE 'test' END AS split FROM li)
SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (split = 'train')::BIGINT AS n_train, count(*) FILTER (split = 'test')::BIGINT AS n_test, '{{"target": ["l_returnflag"]}}' AS roles, 42 AS seed FROM x""")
def _(s, d):
    return so.dataset_manifest(sp.split_by_threshold(li(s, d), "row_id", 0.6667, 42), {"target": ["l_returnflag"]}, 42).drop("digest")


@query("undeclared_columns", "SELECT DISTINCT p_brand AS \"column\" FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_size > 49)")
def _(s, d):
    p = t(s, d, "part").select(F.col("p_brand").alias("column"), "p_size")
    return so.undeclared_columns(p, p.filter("p_size > 49")).distinct()


@query("fingerprint", "SELECT count(*)::BIGINT AS n_rows, true AS same, false AS same_after_change FROM lineitem")
def _(s, d):
    x = t(s, d, "lineitem")
    a, b, c = pr.fingerprint(x), pr.fingerprint(x.orderBy(F.rand(1))), pr.fingerprint(x.withColumn("l_tax", F.when(F.col("l_orderkey") == 1, 9.0).otherwise(F.col("l_tax"))))
    j = a.crossJoin(b.select(F.col("digest").alias("b"))).crossJoin(c.select(F.col("digest").alias("c")))
    return j.select("n_rows", (F.col("digest") == F.col("b")).alias("same"), (F.col("digest") == F.col("c")).alias("same_after_change"))


@query("file_fingerprint")
def _(s, d):
    return pr.file_fingerprint(s, f"{d}/part.parquet").select("bytes", "sha256")


@query("changed_files", "SELECT 'f' || p_partkey AS path, p_partkey % 5 = 0 AS missing FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0")
def _(s, d):
    p = t(s, d, "part").select("p_partkey", F.concat(F.lit("f"), "p_partkey").alias("path"), F.sha2(F.col("p_name").cast("binary"), 256).alias("sha256"))
    now = p.filter("p_partkey % 5 > 0").withColumn("sha256", F.when(F.col("p_partkey") % 7 == 0, "other").otherwise(F.col("sha256")))
    return pr.changed_files(p.select("path", "sha256"), now)


@query("verify_provenance", "SELECT 'same' AS case, true AS ok, 0::BIGINT AS n_different FROM (SELECT 1 FROM part LIMIT 1) UNION ALL SELECT 'changed', count(*) = 0, count(*)::BIGINT FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand LIKE '%1') UNION ALL SELECT 'lacking', count(*) = 0, count(*)::BIGINT FROM (SELECT DISTINCT p_brand FROM part WHERE p_brand LIKE '%2')")
def _(s, d):
    a = t(s, d, "part").groupBy(F.col("p_brand").alias("field")).agg(F.count("*").alias("value"))
    cases = {"same": a, "changed": a.withColumn("value", F.col("value") + F.when(F.col("field").endswith("1"), 1).otherwise(0)), "lacking": a.filter("field NOT LIKE '%2'")}
    parts = [pr.verify_provenance(a, b).select(F.lit(k).alias("case"), "ok", "n_different") for k, b in cases.items()]
    return functools.reduce(lambda x, y: x.unionByName(y), parts)


@query("run_registry", "SELECT event_type AS dataset, count(*)::BIGINT AS n FROM events GROUP BY 1")
def _(s, d):
    path = so.shared_folder(s)
    e = t(s, d, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("dataset"), (F.col("user_id") % 3).alias("version"), F.lit("evaluate").alias("stage"), F.col("ts").alias("created_at"))
    pr.append_run(e.filter("run_id % 2 = 0"), path)
    pr.append_run(e.filter("run_id % 2 = 1"), path)
    return s.read.parquet(path).groupBy("dataset").agg(F.count("*").alias("n"))


_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sides(s, d):
    return real(s, d), cand(s, d).filter("model = 'cand_b'")


for _name, _learner in (("linear_model", "linear"), ("mlp", "mlp"), ("xgb", "xgb")):
    def _score(s, d, name=_learner):
        r, c = _sides(s, d)
        return le.train_test_score(c, r, "l_linestatus", _COLS, name)

    def _augmented(s, d, name=_learner):
        r, c = _sides(s, d)
        r = sp.split_by_threshold(r, "row_id", 0.5, 1)
        train = sp.augment(r.filter("split = 'train'").select("l_linestatus", *_COLS), c.select("l_linestatus", *_COLS))
        return le.train_test_score(train, r.filter("split = 'test'"), "l_linestatus", _COLS, name)

    def _leak(s, d, name=_learner):
        r, c = _sides(s, d)
        return le.data_leakage(c, r, ["l_returnflag", "l_linestatus", "l_quantity"], ["l_extendedprice", "l_discount", "l_tax"], name)

    query(_name)(_score)
    query(f"{_name}_augmentation")(_augmented)
    query(f"data_leakage_{_learner}")(_leak)

for _learner in ("linear", "mlp", "xgb", "gmm"):
    query(f"detection_{_learner}")(lambda s, d, name=_learner: le.detection(*_sides(s, d), _COLS, "row_id", name))


@query("p_mse")
def _(s, d):
    return le.p_mse(*_sides(s, d), _COLS, "row_id")


@query("pca")
def _(s, d):
    return le.pca_difference(*_sides(s, d), _COLS)


@query("feat_rank_distance")
def _(s, d):
    return le.feature_rank_distance(*_sides(s, d), "l_linestatus", _COLS)


@query("cls_acc")
def _(s, d):
    r, c = _sides(s, d)
    return le.f1_difference(r, c, "l_returnflag", _COLS, "row_id", ["forest", "xgb", "svm", "linear"])


@query("gmm_generate")
def _(s, d):
    x = li(s, d)
    return le.gmm_generate(x, _COLS, x.count())


@query("bayes_net_generate")
def _(s, d):
    x = li(s, d)
    return ge.bayes_net_generate(x, [*_COLS, "l_returnflag", "l_linestatus"], x.count())


@query("generate_all")
def _(s, d):
    path, x = so.shared_folder(s), real(s, d).select("row_id", "l_returnflag", *_COLS)
    specs = [{"name": "mixture", "kind": "mixture", "params": {"k": 2}, "tuned": {"k": 4}}, {"name": "net", "kind": "bayes_net", "source": "masked"}, {"name": "copy", "kind": "bootstrap"}, {"name": "odd", "kind": "unheard"}]
    log = ge.generate_all({"raw": x, "masked": x.withColumn("l_tax", F.when(F.col("l_tax") > 0, F.col("l_tax")))}, specs, _COLS, x.count(), "row_id", path)
    sizes = s.read.parquet(path).groupBy("model").agg(F.count("*").alias("n"))
    return log.join(sizes, "model", "left").select("model", "state", "n")


def _config(**more):
    return ev.Config(
        "row_id", ["l_quantity", "l_discount"], ["l_returnflag", "l_linestatus"], ["l_returnflag", "l_linestatus"], "l_quantity",
        target="l_linestatus", positive="F", protected=["l_returnflag"], attributes=["l_quantity", "l_returnflag"], **more,
    )


@query("evaluate")
def _(s, d):
    r = sp.split_by_threshold(real(s, d), "row_id", 0.5, 1)  # models are judged on rows that none was fitted on, attacks need them
    train, rest = (r.filter(F.col("split") == x).drop("split") for x in ("train", "test"))
    names = [*ev.allowed(_config(), True), *sorted(ev.ON_REQUEST)]
    return ev.evaluate(train, cand(s, d), _config(metrics=names), holdout=rest)["combined"]


@query("candidate_score")
def _(s, d):
    e = t(s, d, "embeddings").select(F.col("vec_id").cast("string").alias("row_id"), "vec_id", *(F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(64)), F.col("label").cast("string").alias("kind"))
    syn = e.filter("vec_id % 2 = 1").withColumn("model", F.lit("odd")).unionByName(e.filter("vec_id % 4 = 0").withColumn("model", F.lit("copies")))
    return ev.candidate_score(e.filter("vec_id % 2 = 0"), syn, ev.Config("row_id", [f"x{i}" for i in range(64)], ["kind"]))


@query("fairness_metrics")
def _(s, d):
    r, c = _sides(s, d)
    return le.fairness_metrics(r, c, "l_linestatus", "F", ["l_returnflag"], ["l_quantity", "l_extendedprice"], "row_id")


@query("binary_pass")
def _(s, d):
    train, rest, c = _halves(s, d)
    more = le.binary_pass(train, rest, c.withColumn("model", F.lit("cand_b")), "l_returnflag", ["A", "R"], ["N"], ["l_linestatus"], ["l_quantity", "l_discount"], "row_id")
    main = t(s, d, "lineitem").groupBy(F.lit("cand_b").alias("model")).agg(F.avg("l_tax").alias("value")).select("model", F.lit("family2").alias("framework"), F.lit("utility").alias("type"), F.lit("auroc_diff").alias("metric"), "value")
    return co.merge_binary_pass(main, more)


@query("model_fill")
def _(s, d):
    x = lnu(s, d).select("row_id", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    return im.impute(x, "row_id", ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag"], "model")


@query("polish")
def _(s, d):
    x = lnu(s, d).select("row_id", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    num, cat = ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag"]
    return im.polish(x, im.impute(x, "row_id", num, cat, "model", marked=True), "row_id", num, cat)


def _halves(s, d):
    r, c = _sides(s, d)
    r = sp.split_by_threshold(r, "row_id", 0.5, 1)
    return r.filter("split = 'train'"), r.filter("split = 'test'"), c


@query("relabel_by_classifier", f"WITH {LI} SELECT count(*)::BIGINT AS n, true AS known FROM li WHERE l_orderkey % 2 = 1 AND NOT (l_returnflag = 'R' AND l_orderkey % 3 = 0)")
def _(s, d):
    r, c = _sides(s, d)
    x = le.relabel_by_classifier(c.select("row_id", "l_returnflag", *_COLS), r, "l_returnflag", _COLS)
    return x.agg(F.count("*").alias("n"), F.bool_and(F.col("l_returnflag").isin("A", "N", "R")).alias("known"))


@query("oversample_then_subsample")
def _(s, d):
    x = real(s, d)
    return le.oversample_then_subsample(x, "l_linestatus", _COLS, x.count()).select("l_linestatus", *_COLS)


@query("mia")
def _(s, d):
    return le.membership_attack(*_halves(s, d), _COLS, "row_id")


@query("DomiasMIA_prior")
def _(s, d):
    return le.domias(*_halves(s, d), _COLS, "row_id")


@query("auroc_diff")
def _(s, d):
    return le.auroc_difference(*_halves(s, d), "l_linestatus", "F", _COLS)


@query("grid_trials")
def _(s, d):
    from quarrystone.operators import fidelity as fi

    x = real(s, d)
    n = x.count()

    def score(spec):
        made = le.gmm_generate(x, _COLS, n, spec["k"]).withColumn("model", F.lit("gmm"))
        return fi.wasserstein_dist(x, made, _COLS).first()["value"]

    return le.grid_trials(s, [{"k": 2}, {"k": 3}], score, "gmm", so.shared_folder(s))
