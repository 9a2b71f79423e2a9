"""Queries of metric tables, gates, trials and run registries; all derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.functions.numeric import format_4g
from quarrystone.operators import combine as c
from quarrystone.plans.catalog import query, t

#: metric -> (framework, type, expression over a model's rows)
METRICS = {
    "ks_test": ("family1", "utility", "avg(l_discount) * 10"), "wasserstein_dist": ("family1", "utility", "avg(l_tax) * 7"),
    "identifiability_score": ("family1", "privacy", "avg(l_quantity) / 100"), "k-anonymization": ("family1", "privacy", "min(l_quantity) + 4.5"),
    "detection_naive": ("family1", "privacy", "max(l_tax)"), "dwm": ("family2", "utility", "stddev_pop(l_quantity)"),
    "hit_rate": ("family2", "privacy", "avg(CASE WHEN l_suppkey % 5 <> 3 THEN l_discount END)"), "mia_recall": ("family2", "privacy", "avg(l_tax) * 12"),
    "statistical_parity": ("family2", "fairness", "avg(CASE WHEN l_returnflag = 'R' THEN cast(1 as double) ELSE cast(0 as double) END)"),
    "equalized_odds": ("custom", "fairness", "avg(CASE WHEN l_linestatus = 'F' THEN cast(1 as double) ELSE cast(0 as double) END)"), "log_disparity_mean_abs": ("custom", "fairness", "avg(CASE WHEN l_returnflag = 'A' THEN cast(1 as double) ELSE cast(0 as double) END)"),
    "log_disparity_median_abs": ("custom", "fairness", "median(l_discount)"),
}
_MODEL = "CASE l_suppkey % 5 WHEN 0 THEN 'gmm' WHEN 1 THEN 'gmm_hpo' WHEN 2 THEN 'tree' WHEN 3 THEN 'tree_hpo' ELSE 'copy' END"


def metrics(s, d):
    g = t(s, d, "lineitem").groupBy(F.expr(_MODEL).alias("model")).agg(*(F.expr(e).cast("double").alias(m) for m, (_, _, e) in METRICS.items()))
    long = g.unpivot("model", list(METRICS), "metric", "value")
    kind = lambda i: F.create_map(*(F.lit(x) for m, v in METRICS.items() for x in (m, v[i])))[F.col("metric")]
    return long.select("model", kind(0).alias("framework"), kind(1).alias("type"), "metric", F.round("value", 6).alias("value"))


MET = "met AS (" + " UNION ALL ".join(f"SELECT {_MODEL} AS model, '{f}' AS framework, '{ty}' AS type, '{m}' AS metric, round(({e})::DOUBLE, 6) AS value FROM lineitem GROUP BY 1" for m, (f, ty, e) in METRICS.items()) + ")"
_MIN = ", ".join(f"'{m}'" for m, v in c.CATALOG.items() if v[2] == "minimize")
ORI = f"{MET}, ori AS (SELECT *, CASE WHEN metric IN ({_MIN}) THEN -value ELSE value END AS oriented FROM met WHERE metric NOT LIKE '%\\_naive' ESCAPE '\\')"
SCA = f"{ORI}, sca AS (SELECT *, CASE WHEN oriented IS NOT NULL THEN CASE WHEN max(oriented) OVER w = min(oriented) OVER w THEN 0.5 ELSE (oriented - min(oriented) OVER w) / (max(oriented) OVER w - min(oriented) OVER w) END END AS scaled FROM ori WINDOW w AS (PARTITION BY framework, type, metric))"
GRP = f"{SCA}, grp AS (SELECT model, framework, type, avg(scaled) AS rank FROM sca GROUP BY ALL)"
TYP = f"{GRP}, typ AS (SELECT model, type, avg(rank) AS rank FROM grp GROUP BY ALL)"
OVR = f"{TYP}, ovr AS (SELECT model, sum(coalesce(rank, 0) / 3) AS rank FROM typ GROUP BY ALL)"
COM = f"""{OVR}, com AS (SELECT model, framework, type, metric, value FROM sca UNION ALL SELECT model, framework, 'rank', type, rank FROM grp
UNION ALL SELECT model, 'rank', 'type', type, rank FROM typ UNION ALL SELECT model, 'rank', 'overall', 'overall', rank FROM ovr)"""
_S4 = "CASE WHEN value IS NULL THEN 'nan' ELSE printf('%.4g', value) END"
GATE = f"""{COM}, lim AS (SELECT * FROM (VALUES {', '.join(f"('{m}', '{k}', {v})" for m, k, v in c.GATE)}) AS v(metric, kind, lim) WHERE metric IN (SELECT metric FROM met)),
cel AS (SELECT m.model, l.metric, kind, lim, value, coalesce(CASE kind WHEN 'max' THEN value <= lim ELSE value >= lim END, false) AS ok FROM (SELECT DISTINCT model FROM met) m CROSS JOIN lim l LEFT JOIN met USING (model, metric)),
gat AS (SELECT model, bool_and(ok) AS pass, coalesce(string_agg(CASE WHEN NOT ok THEN metric || '=' || {_S4} || CASE kind WHEN 'max' THEN ' > ' ELSE ' < ' END || printf('%.4g', lim::DOUBLE) END, '; ' ORDER BY metric), '') AS violations FROM cel GROUP BY model)"""


def _r(df, *cols):
    return df.withColumns({x: F.round(x, 6) for x in cols})


def combined(s, d):
    return c.combined_table(metrics(s, d))


def gate(s, d):
    return c.privacy_gate(metrics(s, d))


@query("minmax_scale", f"WITH {SCA} SELECT model, framework, type, metric, round(scaled, 6) AS scaled FROM sca")
def _(s, d):
    return _r(c.minmax_scale(c.orient(c.drop_redundant(metrics(s, d)))), "scaled").select("model", "framework", "type", "metric", "scaled")


@query("group_rank", f"WITH {GRP} SELECT model, framework, type, round(rank, 6) AS rank FROM grp")
def _(s, d):
    return _r(c.group_rank(c.minmax_scale(c.orient(c.drop_redundant(metrics(s, d))))), "rank")


@query("type_rank", f"WITH {TYP} SELECT model, type, round(rank, 6) AS rank FROM typ")
def _(s, d):
    return _r(c.type_rank(c.group_rank(c.minmax_scale(c.orient(c.drop_redundant(metrics(s, d)))))), "rank")


@query("overall_rank", f"WITH {OVR} SELECT model, round(rank, 6) AS rank FROM ovr")
def _(s, d):
    return _r(c.overall_rank(c.type_rank(c.group_rank(c.minmax_scale(c.orient(c.drop_redundant(metrics(s, d))))))), "rank")


@query("combined_table", f"WITH {COM} SELECT model, framework, type, metric, round(value, 6) AS value FROM com")
def _(s, d):
    return _r(combined(s, d), "value")


@query("ranking_strategy", f"WITH {ORI} SELECT model, framework, type, round(avg(oriented), 6) AS rank FROM ori GROUP BY ALL")
def _(s, d):
    x = c.combined_table(metrics(s, d), strategy="summation").filter("type = 'rank'")
    return x.select("model", "framework", F.col("metric").alias("type"), F.round("value", 6).alias("rank"))


_WIDE = ["family1|utility|ks_test", "family2|privacy|hit_rate", "rank|overall|overall"]


@query("combined_wide", f"WITH {COM} SELECT model, " + ", ".join(f"""round(max(value) FILTER (concat_ws('|', framework, type, metric) = '{x}'), 6) AS "{x}" """ for x in _WIDE) + "FROM com GROUP BY model")
def _(s, d):
    return _r(c.combined_wide(combined(s, d), _WIDE), *_WIDE)


@query("combined_long", f"WITH {COM} SELECT model, framework, type, metric, round(value, 6) AS value FROM com WHERE concat_ws('|', framework, type, metric) IN ({', '.join(repr(x) for x in _WIDE)})")
def _(s, d):
    return _r(c.combined_long(c.combined_wide(combined(s, d), _WIDE)), "value")


@query("privacy_gate", f"WITH {GATE} SELECT * FROM gat")
def _(s, d):
    return gate(s, d)


@query("merge_gate", f"WITH {GATE} SELECT model, framework, type, metric, pass, violations FROM com LEFT JOIN gat USING (model)")
def _(s, d):
    return c.merge_gate(combined(s, d), gate(s, d)).drop("value")


@query("gate_counts", f"WITH {GATE} SELECT pass, count(*)::BIGINT AS n, string_agg(model, ', ' ORDER BY model) AS models FROM gat GROUP BY pass")
def _(s, d):
    return c.gate_counts(gate(s, d))


@query("rank_summary", f"WITH {COM} SELECT model, " + ", ".join(f"round_even(max(value) FILTER (framework = 'rank' AND metric = '{k}'), 3) AS {k}" for k in ("overall", "utility", "privacy", "fairness")) + " FROM com GROUP BY model")
def _(s, d):
    return c.rank_summary(combined(s, d))


@query("recommend", f"WITH {GATE} SELECT max_by(o.model, o.rank) AS model, CASE WHEN count(*) = 0 THEN 'no model passes the privacy gate' ELSE 'best overall rank among passing models' END AS reason FROM ovr o JOIN gat USING (model) WHERE pass")
def _(s, d):
    return c.recommend(combined(s, d), gate(s, d))


@query("composite_score", f"WITH {MET} SELECT model, round(-avg(CASE WHEN metric IN ({_MIN}) THEN -value ELSE value END), 6) AS score FROM met GROUP BY model")
def _(s, d):
    return _r(c.composite_score(metrics(s, d)), "score")


@query("fairness_gap_table", f"WITH {MET} SELECT model, max(value) FILTER (metric = 'statistical_parity') AS statistical_parity, max(value) FILTER (metric = 'equalized_odds') AS equalized_odds, max(value) FILTER (metric = 'equal_opportunity') AS equal_opportunity FROM met GROUP BY model")
def _(s, d):
    return c.fairness_gap_table(metrics(s, d))


@query("tradeoff_points", f"WITH {TYP} SELECT model, regexp_replace(model, '_hpo$', '') AS base, model LIKE '%\\_hpo' ESCAPE '\\' AS tuned, " + ", ".join(f"round(max(rank) FILTER (type = '{k}'), 6) AS {k}" for k in ("utility", "privacy", "fairness")) + " FROM typ GROUP BY model")
def _(s, d):
    return _r(c.tradeoff_points(combined(s, d)), "utility", "privacy", "fairness")


@query("align_metrics", f"WITH {MET}, a AS (SELECT * FROM met WHERE NOT (model = 'copy' AND metric = 'dwm')) SELECT m.model, k.framework, k.type, k.metric, a.value FROM (SELECT DISTINCT model FROM met) m CROSS JOIN (SELECT DISTINCT framework, type, metric FROM a) k LEFT JOIN a USING (model, metric)")
def _(s, d):
    x = metrics(s, d)
    return c.align_metrics(x.filter("NOT (model = 'copy' AND metric = 'dwm')"), x)


@query("merge_binary_pass", f"WITH {MET}, b AS (SELECT model, framework, type, metric, value + 1 AS value FROM met WHERE type = 'fairness') SELECT * FROM met WHERE type <> 'fairness' UNION ALL SELECT model, framework, type, metric, round(value, 6) FROM b")
def _(s, d):
    x = metrics(s, d)
    b = x.filter("type = 'fairness'").withColumn("value", F.round(F.col("value") + 1, 6))
    ranks = b.withColumn("metric", F.concat("metric", F.lit("_rank")))
    return c.merge_binary_pass(x, b.unionByName(ranks))


@query("orient_family1", f"WITH {ORI} SELECT model, metric, oriented FROM ori WHERE framework = 'family1'")
def _(s, d):
    x = metrics(s, d)
    return c.orient_family1(x, x).select("model", "metric", "oriented")


@query("orient_family2", f"WITH {ORI} SELECT model, metric, oriented FROM ori WHERE framework = 'family2'")
def _(s, d):
    return c.orient_family2(metrics(s, d)).select("model", "metric", "oriented")


@query("orient_disparity", f"WITH {MET} SELECT model, metric, CASE WHEN metric <> 'log_disparity_median_abs' THEN -value END AS oriented FROM met WHERE metric LIKE 'log_disparity%'")
def _(s, d):
    return c.orient_disparity(metrics(s, d)).select("model", "metric", "oriented")


@query("drop_redundant", f"WITH {MET} SELECT * FROM met WHERE metric <> 'detection_naive'")
def _(s, d):
    return c.drop_redundant(metrics(s, d))


@query("classify_metric", f"""WITH {MET}, n AS (SELECT DISTINCT metric AS m FROM met UNION SELECT DISTINCT 'eo_' || metric FROM met UNION SELECT DISTINCT 'auroc_' || metric FROM met)
SELECT m AS metric, CASE WHEN m LIKE 'eo\\_%' ESCAPE '\\' THEN 'custom' WHEN m LIKE 'auroc\\_%' ESCAPE '\\' THEN 'family2' WHEN m IN ('log_disparity_median_abs', 'detection_naive') THEN 'family2' ELSE (SELECT any_value(framework) FROM met WHERE met.metric = m) END AS framework,
CASE WHEN m LIKE 'eo\\_%' ESCAPE '\\' THEN 'fairness' WHEN m LIKE 'auroc\\_%' ESCAPE '\\' THEN 'utility' WHEN m IN ('log_disparity_median_abs', 'detection_naive') THEN 'utility' ELSE (SELECT any_value(type) FROM met WHERE met.metric = m) END AS type FROM n""")
def _(s, d):
    m = metrics(s, d).select("metric").distinct()
    m = m.unionByName(m.select(F.concat(F.lit("eo_"), "metric").alias("metric"))).unionByName(m.select(F.concat(F.lit("auroc_"), "metric").alias("metric")))
    fw, ty = c.classify_metric(F.col("metric"))
    return m.select("metric", fw.alias("framework"), ty.alias("type"))


@query("resolve_selection", f"WITH {MET} SELECT model, metric, value FROM met WHERE metric IN ({', '.join(repr(m) for m, v in c.CATALOG.items() if v[1] == 'privacy')})")
def _(s, d):
    chosen = c.resolve_selection(c.metric_catalog(s), types=["privacy"])
    return metrics(s, d).join(F.broadcast(chosen.select("metric")), "metric", "left_semi").select("model", "metric", "value")


@query("metric_catalog", f"WITH {MET} SELECT model, metric, CASE WHEN metric IN ({_MIN}) THEN 'minimize' ELSE 'maximize' END AS direction FROM met WHERE metric NOT IN ('detection_naive', 'log_disparity_median_abs')")
def _(s, d):
    return metrics(s, d).join(F.broadcast(c.metric_catalog(s).select("metric", "direction")), "metric").select("model", "metric", "direction")


@query("binary_preset", f"WITH {MET} SELECT model, metric, value FROM met WHERE metric IN ('statistical_parity', 'equalized_odds')")
def _(s, d):
    return metrics(s, d).join(F.broadcast(c.binary_preset(c.metric_catalog(s)).select("metric")), "metric", "left_semi").select("model", "metric", "value")


@query("format_4g", "SELECT o_orderkey, printf('%.4g', sqrt(o_totalprice) / pow(10, o_orderkey % 9)) AS x FROM orders")
def _(s, d):
    return t(s, d, "orders").select("o_orderkey", format_4g(F.sqrt("o_totalprice") / F.pow(F.lit(10), F.col("o_orderkey") % 9)).alias("x"))


TRIALS = "tri AS (SELECT o_orderpriority AS study, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS number, CASE o_orderstatus WHEN 'F' THEN 'COMPLETE' WHEN 'O' THEN 'FAIL' ELSE CASE WHEN o_orderpriority = '1-URGENT' THEN 'RUNNING' ELSE 'FAIL' END END AS state, o_totalprice AS value, o_custkey % 7 AS depth, o_custkey % 3 AS rate FROM orders)"


def trials(s, d):
    from pyspark.sql import Window as W

    o = t(s, d, "orders")
    state = F.when(F.col("o_orderstatus") == "F", "COMPLETE").when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), "RUNNING").otherwise("FAIL")
    return o.select(F.col("o_orderpriority").alias("study"), F.row_number().over(W.partitionBy("o_orderpriority").orderBy("o_orderkey")).alias("number"), state.alias("state"), F.col("o_totalprice").alias("value"), F.create_map(F.lit("depth"), F.col("o_custkey") % 7, F.lit("rate"), F.col("o_custkey") % 3).alias("params"))


@query("best_trial", f"WITH {TRIALS} SELECT study, min_by(number, value)::BIGINT AS number, min(value) AS value, min_by(rate, value) AS rate FROM tri WHERE state = 'COMPLETE' GROUP BY study")
def _(s, d):
    return c.best_trial(trials(s, d), ["depth"]).select("study", F.col("number").cast("bigint").alias("number"), "value", F.col("params")["rate"].alias("rate"))


@query("trials_to_keep", f"WITH {TRIALS}, k AS (SELECT study, min_by(number, value) FILTER (state = 'COMPLETE') AS best, max(number) AS latest, bool_or(state = 'RUNNING') AS busy FROM tri GROUP BY study) SELECT study, number::BIGINT AS number FROM tri JOIN k USING (study) WHERE NOT busy AND number <> best AND number <> latest")
def _(s, d):
    return c.trials_to_keep(trials(s, d)).select("study", F.col("number").cast("bigint").alias("number"))


@query("trial_history", f"WITH {TRIALS} SELECT study, number::BIGINT AS number, value, min(value) OVER (PARTITION BY study ORDER BY number ROWS UNBOUNDED PRECEDING) AS best FROM tri WHERE state = 'COMPLETE'")
def _(s, d):
    return c.trial_history(trials(s, d)).withColumn("number", F.col("number").cast("bigint"))


@query("trial_slices", f"WITH {TRIALS} SELECT study, number::BIGINT AS number, value, 'depth' AS param, depth AS setting FROM tri WHERE state = 'COMPLETE' UNION ALL SELECT study, number, value, 'rate', rate FROM tri WHERE state = 'COMPLETE'")
def _(s, d):
    return c.trial_slices(trials(s, d)).withColumn("number", F.col("number").cast("bigint"))


@query("compare_params", """WITH a AS (SELECT p_brand AS name, max(p_size) AS v FROM part WHERE p_size > 10 GROUP BY 1), b AS (SELECT p_brand AS name, max(p_size) AS v FROM part WHERE p_partkey % 3 = 0 GROUP BY 1)
SELECT coalesce(a.name, b.name) AS name, a.v AS "default", b.v AS tuned, a.v IS DISTINCT FROM b.v AS changed FROM a FULL JOIN b ON a.name = b.name""")
def _(s, d):
    p = t(s, d, "part")
    f = lambda x: x.groupBy(F.col("p_brand").alias("name")).agg(F.max("p_size").alias("value"))
    return c.compare_params(f(p.filter("p_size > 10")), f(p.filter("p_partkey % 3 = 0")))


@query("provenance_diff", """WITH a AS (SELECT p_brand AS f, count(*) AS v FROM part GROUP BY 1), b AS (SELECT p_brand AS f, count(*) + CASE WHEN p_brand LIKE '%1' THEN 1 ELSE 0 END AS v FROM part WHERE p_brand NOT LIKE '%2' GROUP BY 1)
SELECT coalesce(a.f, b.f) AS field, a.v AS expected, b.v AS recorded FROM a FULL JOIN b ON a.f = b.f WHERE a.v IS DISTINCT FROM b.v""")
def _(s, d):
    a = t(s, d, "part").groupBy(F.col("p_brand").alias("field")).agg(F.count("*").alias("value"))
    b = a.filter("field NOT LIKE '%2'").withColumn("value", F.col("value") + F.when(F.col("field").endswith("1"), 1).otherwise(0))
    return c.provenance_diff(a, b)


@query("latest_run", "SELECT event_type AS dataset, user_id % 3 AS version, max_by(event_id, ts) AS run_id FROM events GROUP BY ALL")
def _(s, d):
    e = t(s, d, "events")
    return c.latest_run(e.select(F.col("event_type").alias("dataset"), (F.col("user_id") % 3).alias("version"), F.col("event_id").alias("run_id"), F.col("ts").alias("created_at")))


@query("pending_models", "SELECT 'm' || c_custkey AS model, md5(c_name) AS fingerprint FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 8 = 0")
def _(s, d):
    x = t(s, d, "customer").select("c_custkey", F.concat(F.lit("m"), "c_custkey").alias("model"), F.md5(F.col("c_name").cast("binary")).alias("fingerprint"))
    done = x.filter("c_custkey % 4 = 0").withColumn("fingerprint", F.when(F.col("c_custkey") % 8 == 0, "old").otherwise(F.col("fingerprint")))
    return c.pending_models(x, done).select("model", "fingerprint")


@query("result_cache", "SELECT c_custkey, true AS reused FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, false FROM customer WHERE c_custkey % 2 = 1")
def _(s, d):
    x = t(s, d, "customer").select("c_custkey", c.cache_key({"name": F.col("c_name"), "segment": F.col("c_mktsegment")}).alias("cache_key"))
    reuse, todo = c.result_cache(x, x.filter("c_custkey % 2 = 0"))
    return reuse.select("c_custkey", F.lit(True).alias("reused")).unionByName(todo.select("c_custkey", F.lit(False).alias("reused")))
