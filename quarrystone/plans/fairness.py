"""Queries of representation fairness."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.functions.numeric import ERFC, pretty_name
from quarrystone.operators import fairness as f
from quarrystone.operators.clean import prepare_groups
from quarrystone.plans.catalog import CAND, LI, REAL, cand, query, real
from quarrystone.plans.cleaning import _BIN, EDGES

T, P1, P2 = "TARGET_LABEL", "l_linestatus__GROUP", "l_quantity__GROUP"


def groups(df, *more):
    keep = [*more, "l_returnflag", "l_linestatus", "l_quantity"]
    return prepare_groups(df.select(*keep), "l_returnflag", ["l_linestatus", "l_quantity"], bins={"l_quantity": EDGES}).select(*more, T, P1, P2)


def sides(s, d):
    return groups(real(s, d)), groups(cand(s, d), "model")


def leaf(s, d):
    return f.disparity_leaf(*sides(s, d), T, [P1, P2])


def tree(s, d):
    return f.disparity_hierarchy(*sides(s, d), T, [P1, P2])


_poly = str(ERFC[0])
for _c in ERFC[1:]:
    _poly = f"({_poly} * t + {_c})"
_G = f'l_returnflag AS "{T}", l_linestatus AS "{P1}", {_BIN} AS "{P2}"'
BASE = f"""{LI}, {REAL}, {CAND}, rg AS (SELECT {_G} FROM rl), sg AS (SELECT model, {_G} FROM cand), models AS (SELECT DISTINCT model FROM sg)"""
_K = f'"{T}", "{P1}", "{P2}"'
LEAF_COUNTS = f"""b AS (SELECT {_K}, count(*) AS background_n FROM rg GROUP BY ALL), u AS (SELECT model, {_K}, count(*) AS user_n FROM sg GROUP BY ALL),
c0 AS (SELECT coalesce(x.model, u.model) AS model, coalesce(x."{T}", u."{T}") AS "{T}", coalesce(x."{P1}", u."{P1}") AS "{P1}", coalesce(x."{P2}", u."{P2}") AS "{P2}", coalesce(background_n, 0) AS background_n, coalesce(user_n, 0) AS user_n
  FROM (SELECT model, b.* FROM b, models) x FULL JOIN u ON x.model = u.model AND x."{T}" = u."{T}" AND x."{P1}" = u."{P1}" AND x."{P2}" = u."{P2}")"""
_SETS = [("target", [T]), ("target_chain_1", [T, P1]), ("target_chain_2", [T, P1, P2]), (f"protected::{P1}", [P1]), (f"protected::{P2}", [P2])]


def _levels(src: str, n: str, more: str = "") -> str:
    parts = []
    for level, cols in _SETS:
        names = ", ".join(f'"{k}"' if k in cols else f'NULL::VARCHAR AS "{k}"' for k in (T, P1, P2))
        parts.append(f"SELECT {more} '{level}' AS level, {names}, count(*) AS {n} FROM {src} GROUP BY ALL")
    return " UNION ALL ".join(parts)


TREE_COUNTS = f"""b AS ({_levels('rg', 'background_n')}), u AS ({_levels('sg', 'user_n', 'model,')}),
c0 AS (SELECT coalesce(x.model, u.model) AS model, coalesce(x.level, u.level) AS level, coalesce(x."{T}", u."{T}") AS "{T}", coalesce(x."{P1}", u."{P1}") AS "{P1}", coalesce(x."{P2}", u."{P2}") AS "{P2}", coalesce(background_n, 0) AS background_n, coalesce(user_n, 0) AS user_n
  FROM (SELECT model, b.* FROM b, models) x FULL JOIN u ON x.model = u.model AND x.level = u.level AND x."{T}" IS NOT DISTINCT FROM u."{T}" AND x."{P1}" IS NOT DISTINCT FROM u."{P1}" AND x."{P2}" IS NOT DISTINCT FROM u."{P2}")"""
ATTACH = f"""c1 AS (SELECT c0.*, (SELECT count(*) FROM rg) AS tb, (SELECT count(*) FROM sg WHERE sg.model = c0.model) AS tu FROM c0),
c2 AS (SELECT *, CASE WHEN tb = 0 THEN 0 ELSE background_n / tb END AS br, CASE WHEN tu = 0 THEN 0 ELSE user_n / tu END AS orr,
  user_n::DOUBLE AS pa, (tu - user_n)::DOUBLE AS pb, background_n::DOUBLE AS pc, (tb - background_n)::DOUBLE AS pd FROM c1),
c3 AS (SELECT *, sqrt((pa + pb + pc + pd) * (pa * pd - pb * pc) * (pa * pd - pb * pc) / ((pa + pb) * (pc + pd) * (pa + pc) * (pb + pd)) / 2) AS z FROM c2),
c4 AS (SELECT *, 1 / (1 + z / 2) AS t FROM c3),
c5 AS (SELECT *, CASE WHEN least(pa, pb, pc, pd) >= 5 THEN t * exp(-z * z + {_poly}) WHEN user_n = 0 AND background_n = 0 THEN -9999999 WHEN background_n = 0 THEN -8888888 ELSE -7777777 END AS p_value FROM c4),
c6 AS (SELECT *, p_value BETWEEN 0 AND 1 AS v FROM c5),
c7 AS (SELECT *, row_number() OVER (PARTITION BY model, v ORDER BY p_value) AS k, count(*) OVER (PARTITION BY model, v) AS n FROM c6),
c8 AS (SELECT *, CASE WHEN v THEN least(1, min(p_value * n / k) OVER (PARTITION BY model, v ORDER BY k DESC ROWS UNBOUNDED PRECEDING)) END AS bh_p,
  CASE WHEN orr = 0 AND br = 0 THEN -9999999 WHEN orr = 0 THEN '-inf'::DOUBLE WHEN br = 0 THEN -8888888 WHEN orr = 1 AND br = 1 THEN 0 WHEN orr = 1 THEN 'inf'::DOUBLE WHEN br = 1 THEN '-inf'::DOUBLE
    ELSE ln(orr / (1 - orr)) - ln(br / (1 - br)) END AS ev FROM c7),
c9 AS (SELECT *, CASE WHEN ev = '-inf'::DOUBLE THEN 'Absent' WHEN ev = -9999999 THEN 'No Info' WHEN ev = -8888888 THEN 'No Base Data' WHEN ev = -7777777 THEN 'Insufficient Data' WHEN bh_p > 0.05 THEN 'Equitable(p)'
  WHEN ev < ln(0.8) THEN 'Highly Underrepresented' WHEN ev < ln(0.9) THEN 'Underrepresented' WHEN ev > -ln(0.8) THEN 'Highly Overrepresented' WHEN ev > -ln(0.9) THEN 'Overrepresented' ELSE 'Equitable' END AS equity_label FROM c8),
cx AS (SELECT *, CASE equity_label {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in f.COLORS.items())} END AS equity_color,
  CASE WHEN ev = '-inf'::DOUBLE THEN '-Inf' WHEN ev = 'inf'::DOUBLE THEN '+Inf' WHEN ev IN (-9999999, -8888888, -7777777) THEN ev::BIGINT::VARCHAR ELSE printf('%.3f', ev) END || CASE WHEN bh_p > 0.05 THEN '*' ELSE '' END AS equity_text,
  CASE WHEN bh_p IS NULL THEN 'NA' ELSE printf('%.3f', bh_p) END AS p_text FROM c9)"""
WITH_LEAF, WITH_TREE = f"WITH {BASE}, {LEAF_COUNTS}, {ATTACH}", f"WITH {BASE}, {TREE_COUNTS}, {ATTACH}"
_SHOWN = "CASE WHEN abs(ev) = 'inf'::DOUBLE THEN NULL ELSE round(ev, 6) END AS equity_value, round(bh_p, 6) AS bh_p, round(p_value, 6) AS p_value, equity_label, equity_color"


def shown(df, *keys):
    value = F.when(F.abs("equity_value") < float("inf"), F.round("equity_value", 6))
    return df.select(*keys, "background_n", "user_n", value.alias("equity_value"), F.round("bh_p", 6).alias("bh_p"), F.round("p_value", 6).alias("p_value"), "equity_label", "equity_color")


@query("disparity_leaf", f"{WITH_LEAF} SELECT model, {_K}, background_n, user_n, {_SHOWN} FROM cx")
def _(s, d):
    return shown(leaf(s, d), "model", T, P1, P2)


@query("disparity_hierarchy", f"{WITH_TREE} SELECT model, level, {_K}, background_n, user_n, {_SHOWN} FROM cx")
def _(s, d):
    return shown(tree(s, d), "model", "level", T, P1, P2)


@query("attach_disparity", f"{WITH_LEAF} SELECT model, {_K}, round(br, 6) AS background_rate, round(orr, 6) AS observed_rate, equity_label FROM cx")
def _(s, d):
    return leaf(s, d).select("model", T, P1, P2, F.round("background_rate", 6).alias("background_rate"), F.round("observed_rate", 6).alias("observed_rate"), "equity_label")


@query("subgroup_table", f"""{WITH_TREE}, r AS (SELECT *, CASE level WHEN 'target' THEN 'Target' ELSE substr(level, 12) END AS characteristic,
  CASE level WHEN 'target' THEN 2 WHEN 'protected::{P1}' THEN 0 ELSE 1 END AS char_order, coalesce(CASE level WHEN 'target' THEN "{T}" WHEN 'protected::{P1}' THEN "{P1}" ELSE "{P2}" END) AS subgroup FROM cx WHERE level NOT LIKE 'target_chain%')
SELECT model, characteristic, char_order, dense_rank() OVER (PARTITION BY model, characteristic ORDER BY subgroup)::INT AS sub_order, subgroup, equity_text, p_text, equity_label, equity_color FROM r""")
def _(s, d):
    return f.subgroup_table(tree(s, d), T, [P1, P2])


@query("leaf_table", f"""{WITH_TREE}, r AS (SELECT *, concat_ws(' × ', {_K}) AS subgroup FROM cx WHERE level = 'target_chain_2')
SELECT model, 'Intersectional' AS characteristic, 0 AS char_order, dense_rank() OVER (PARTITION BY model ORDER BY subgroup)::INT AS sub_order, subgroup, equity_text, p_text, equity_label, equity_color FROM r""")
def _(s, d):
    return f.leaf_table(tree(s, d), T, [P1, P2])


_TIP = "CASE WHEN ev = -9999999 THEN 'No Info' WHEN ev = -8888888 THEN 'No Base Data' WHEN ev = '-inf'::DOUBLE THEN '-Inf (Absent)' WHEN ev = 'inf'::DOUBLE THEN '+Inf' ELSE printf('%+.4f', ev) END"


@query("sunburst_nodes", f"""{WITH_TREE} SELECT model, 't::' || "{T}" || CASE WHEN level >= 'target_chain_1' THEN '|{P1}::' || "{P1}" ELSE '' END || CASE WHEN level >= 'target_chain_2' THEN '|{P2}::' || "{P2}" ELSE '' END AS id,
  CASE level WHEN 'target' THEN '' WHEN 'target_chain_1' THEN 't::' || "{T}" ELSE 't::' || "{T}" || '|{P1}::' || "{P1}" END AS parent,
  CASE level WHEN 'target' THEN "{T}" WHEN 'target_chain_1' THEN "{P1}" ELSE "{P2}" END AS label, user_n AS value, equity_color AS color,
  'Target: ' || "{T}" || '<br>' || CASE WHEN level >= 'target_chain_1' THEN 'L Linestatus: ' || "{P1}" || '<br>' ELSE '' END || CASE WHEN level >= 'target_chain_2' THEN 'L Quantity: ' || "{P2}" || '<br>' ELSE '' END
  || 'Equity label: ' || equity_label || '<br>Log disparity: ' || {_TIP} || printf('<br>Real rate: %.4f<br>Synthetic rate: %.4f<br>Real n: %d<br>Synthetic n: %d<br>BH-adjusted p: ', br::DOUBLE, orr::DOUBLE, background_n, user_n) || CASE WHEN bh_p IS NULL THEN 'NA' ELSE printf('%.4f', bh_p) END AS hover
FROM cx WHERE level LIKE 'target%'""")
def _(s, d):
    return f.sunburst_nodes(tree(s, d), T, [P1, P2])


_USABLE = "CASE WHEN ev NOT IN (-9999999, -8888888, -7777777) AND abs(ev) < 'inf'::DOUBLE THEN abs(ev) END"
_SUM = f"count(*)::BIGINT AS n_subgroups, round(avg({_USABLE}), 6) AS mean_abs, round(quantile_cont({_USABLE}, 0.5), 6) AS median_abs, round(avg(CASE WHEN bh_p BETWEEN 0 AND 0.05 THEN 1.0 ELSE 0.0 END), 6) AS share_significant"


def _round(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("disparity_summary", f"{WITH_LEAF} SELECT {_SUM} FROM cx WHERE model = 'cand_b'")
def _(s, d):
    return _round(f.disparity_summary(leaf(s, d).filter("model = 'cand_b'")), "mean_abs", "median_abs", "share_significant")


@query("summarize_models", f"{WITH_LEAF} SELECT model, {_SUM} FROM cx GROUP BY model")
def _(s, d):
    return _round(f.summarize_models(leaf(s, d)), "mean_abs", "median_abs", "share_significant")


@query("disparity_report", f"{WITH_LEAF} SELECT model, {_SUM} FROM cx GROUP BY model")
def _(s, d):
    return _round(f.disparity_report(*sides(s, d), T, [P1, P2])["summary"], "mean_abs", "median_abs", "share_significant")


@query("label_counts", f"{WITH_LEAF} SELECT model, equity_label, count(*)::BIGINT AS n FROM cx GROUP BY ALL")
def _(s, d):
    return f.label_counts(leaf(s, d))


@query("label_counts_pivot", f"{WITH_LEAF} SELECT model, {', '.join(f'''count(*) FILTER (equity_label = '{x}')::BIGINT AS "{x}"''' for x in f.COLORS)} FROM cx GROUP BY model")
def _(s, d):
    return f.label_counts_pivot(leaf(s, d))


@query("disparity_for_candidates", f"{WITH_LEAF} SELECT model, {_K}, background_n, user_n, equity_label FROM cx")
def _(s, d):
    r, c = sides(s, d)
    parts = {m: c.filter(F.col("model") == m).drop("model") for m in ("cand_a", "cand_b")} | {"broken": r.drop(P1)}
    found, errors = f.disparity_for_candidates(r, parts, T, [P1, P2])
    return found.select("model", T, P1, P2, "background_n", "user_n", "equity_label")


@query("disparity_metric_table", f"""{WITH_LEAF}, w AS (SELECT model, {_SUM} FROM cx GROUP BY model UNION ALL SELECT 'broken', NULL, NULL, NULL, NULL)
SELECT model, 'log_disparity_mean_abs' AS metric, mean_abs AS value FROM w UNION ALL SELECT model, 'log_disparity_median_abs', median_abs FROM w UNION ALL SELECT model, 'log_disparity_share_significant', share_significant FROM w""")
def _(s, d):
    errors = s.createDataFrame([("broken", "no such columns")], "model string, error string")
    return _round(f.disparity_metric_table(leaf(s, d), errors), "value")


@query("group_counts", f"WITH {BASE} SELECT {_K}, count(*)::BIGINT AS n FROM rg GROUP BY ALL")
def _(s, d):
    return f.group_counts(sides(s, d)[0], [T, P1, P2])


@query("hierarchy_counts", f"WITH {BASE} {_levels('rg', 'n')}")
def _(s, d):
    return f.hierarchy_counts(sides(s, d)[0], T, [P1, P2])


@query("join_counts", f"WITH {BASE}, {LEAF_COUNTS} SELECT * FROM c0")
def _(s, d):
    r, c = sides(s, d)
    return f.join_counts(f.group_counts(r, [T, P1, P2], "background_n"), f.group_counts(c, ["model", T, P1, P2], "user_n"), [T, P1, P2])


@query("join_level_counts", f"WITH {BASE}, {TREE_COUNTS} SELECT * FROM c0")
def _(s, d):
    return f.join_level_counts(*sides(s, d), T, [P1, P2])


@query("union_levels", f"WITH {BASE}, {TREE_COUNTS} SELECT level, count(*)::BIGINT AS n, sum(user_n)::BIGINT AS user_n FROM c0 GROUP BY level")
def _(s, d):
    return f.join_level_counts(*sides(s, d), T, [P1, P2]).groupBy("level").agg(F.count("*").alias("n"), F.sum("user_n").alias("user_n"))


@query("union_model_leaves", f"{WITH_LEAF} SELECT model, count(*)::BIGINT AS n, sum(user_n)::BIGINT AS user_n FROM cx GROUP BY model")
def _(s, d):
    r, c = sides(s, d)
    one = lambda m: f.disparity_leaf(r, c.filter(F.col("model") == m), T, [P1, P2])
    return one("cand_a").unionByName(one("cand_b")).groupBy("model").agg(F.count("*").alias("n"), F.sum("user_n").alias("user_n"))


@query("dense_rank_in_group", f"{WITH_TREE} SELECT model, level, {_K}, dense_rank() OVER (PARTITION BY model, level ORDER BY user_n)::INT AS r FROM cx")
def _(s, d):
    from pyspark.sql import Window as W

    return tree(s, d).select("model", "level", T, P1, P2, F.dense_rank().over(W.partitionBy("model", "level").orderBy("user_n")).alias("r"))


@query("bh_adjust", f"{WITH_TREE} SELECT model, level, {_K}, round(bh_p, 6) AS bh_p FROM cx")
def _(s, d):
    return f.bh_adjust(tree(s, d).drop("bh_p"), "p_value", ["model"]).select("model", "level", T, P1, P2, F.round("bh_p", 6).alias("bh_p"))


@query("rate", f"WITH {BASE}, {LEAF_COUNTS} SELECT model, {_K}, CASE WHEN background_n = 0 THEN 0.0 ELSE round(user_n / background_n, 6) END AS rate FROM c0")
def _(s, d):
    r, c = sides(s, d)
    x = f.join_counts(f.group_counts(r, [T, P1, P2], "background_n"), f.group_counts(c, ["model", T, P1, P2], "user_n"), [T, P1, P2])
    return x.select("model", T, P1, P2, F.round(f.rate(F.col("user_n"), F.col("background_n")), 6).alias("rate"))


@query("log_disparity", f"{WITH_TREE} SELECT model, level, {_K}, CASE WHEN ev = '-inf'::DOUBLE THEN 'minus' WHEN ev = 'inf'::DOUBLE THEN 'plus' ELSE 'finite' END AS kind, CASE WHEN abs(ev) < 'inf'::DOUBLE THEN round(ev, 6) END AS value FROM cx")
def _(s, d):
    v = f.log_disparity(F.col("background_rate"), F.col("observed_rate"))
    kind = F.when(v == -float("inf"), "minus").when(v == float("inf"), "plus").otherwise("finite")
    return tree(s, d).select("model", "level", T, P1, P2, kind.alias("kind"), F.when(F.abs(v) < float("inf"), F.round(v, 6)).alias("value"))


@query("proportion_test", f"{WITH_TREE} SELECT model, level, {_K}, round(p_value, 6) AS p FROM cx")
def _(s, d):
    p = f.proportion_test(F.col("background_n"), F.col("total_background"), F.col("user_n"), F.col("total_user"))
    return tree(s, d).select("model", "level", T, P1, P2, F.round(p, 6).alias("p"))


@query("equity_label", f"{WITH_TREE} SELECT model, level, {_K}, equity_label, equity_color FROM cx")
def _(s, d):
    label = f.equity_label(F.col("equity_value"), F.col("bh_p"))
    return tree(s, d).select("model", "level", T, P1, P2, label.alias("equity_label"), f.equity_color(label).alias("equity_color"))


@query("equity_color", f"{WITH_LEAF} SELECT equity_color, count(*)::BIGINT AS n FROM cx GROUP BY 1")
def _(s, d):
    return leaf(s, d).groupBy(f.equity_color(F.col("equity_label")).alias("equity_color")).agg(F.count("*").alias("n"))


@query("format_equity", f"{WITH_TREE} SELECT model, level, {_K}, equity_text, p_text, {_TIP} AS tooltip FROM cx")
def _(s, d):
    return tree(s, d).select("model", "level", T, P1, P2, f.format_equity(F.col("equity_value"), F.col("bh_p")).alias("equity_text"), f.format_p(F.col("bh_p")).alias("p_text"), f.tooltip_value(F.col("equity_value")).alias("tooltip"))


@query("pretty_name", "SELECT DISTINCT event_type, array_to_string(list_transform(string_split(replace(event_type, '_', ' '), ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS pretty FROM events")
def _(s, d):
    return s.read.parquet(f"{d}/events.parquet").select("event_type", pretty_name(F.col("event_type")).alias("pretty")).distinct()
