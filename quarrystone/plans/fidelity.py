"""Queries of distributions, marginal and distance metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.operators import fidelity as f, impute as im, neighbours as nn, permutation as pt
from quarrystone.plans.catalog import CAND, LI, REAL, cand, li, query, real, t
from quarrystone.plans.fairness import _poly
from quarrystone.plans.masking import _FILLED, _LN1, CAT, NUM, filled, lnu, u

SIDES = f"{LI}, {REAL}, {CAND}"
CATS, NUMS = ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"]


def _r(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols or ("value",)})


@query("category_frequencies", "SELECT p_brand AS value, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM part GROUP BY 1")
def _(s, d):
    return _r(f.frequencies(t(s, d, "part"), "p_brand"), "share")


@query("class_proportions", "SELECT l_returnflag AS value, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, count(*) = max(count(*)) OVER () AS top FROM lineitem GROUP BY 1")
def _(s, d):
    return _r(f.class_proportions(t(s, d, "lineitem"), "l_returnflag"), "share")


_HIST = """WITH b AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS w, count(*) AS c FROM lineitem)
SELECT least(19, floor((l_extendedprice - lo) / w))::INT AS bin, count(*)::BIGINT AS n, round(count(*) / (any_value(c) * any_value(w)), 9) AS density FROM lineitem, b GROUP BY 1"""


@query("density_histogram", _HIST)
def _(s, d):
    return f.histogram(t(s, d, "lineitem"), "l_extendedprice", 20).select("bin", "n", F.round("density", 9).alias("density"))


@query("kde_grid", """WITH v AS (SELECT l_quantity AS v, count(*) AS w FROM lineitem GROUP BY 1), b AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, stddev_samp(l_quantity) * pow(count(*), -0.2) AS h, count(*) AS n FROM lineitem),
g AS (SELECT i, lo + i * (hi - lo) / 199 AS x, h, n FROM b, range(200) AS r(i)) SELECT i::INT AS i, round(any_value(x), 6) AS x, round(sum(w * exp(-((x - v) / h) * ((x - v) / h) / 2)) / (any_value(n) * any_value(h) * 2.5066282746310002), 6) AS density FROM g, v GROUP BY i""")
def _(s, d):
    return _r(f.kde_grid(t(s, d, "lineitem"), "l_quantity"), "x", "density")


@query("observed_vs_imputed", f"WITH {_LN1}, {_FILLED} SELECT CASE WHEN orf IS NULL THEN 'imputed' ELSE 'observed' END AS source, l_returnflag AS value, count(*)::BIGINT AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY orf IS NULL), 6) AS share FROM fl GROUP BY orf IS NULL, l_returnflag")
def _(s, d):
    return _r(f.observed_vs_imputed(lnu(s, d), filled(s, d), "row_id", "l_returnflag"), "share")


@query("real_vs_synthetic", f"""WITH {SIDES}, a AS (SELECT l_returnflag AS value, count(*) / sum(count(*)) OVER () AS p FROM rl GROUP BY 1), b AS (SELECT model, l_returnflag AS value, count(*) / sum(count(*)) OVER (PARTITION BY model) AS q FROM cand GROUP BY model, l_returnflag)
SELECT m.model, v.value, round(coalesce(p, 0), 6) AS real, round(coalesce(q, 0), 6) AS share, CASE v.value WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS place FROM (SELECT value FROM a UNION SELECT value FROM b) v CROSS JOIN (SELECT DISTINCT model FROM cand) m LEFT JOIN a USING (value) LEFT JOIN b ON b.model = m.model AND b.value = v.value""")
def _(s, d):
    return _r(f.real_vs_synthetic(real(s, d), cand(s, d), "l_returnflag", ["R", "A"]), "real", "share")


@query("order_categories", "SELECT DISTINCT o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END AS place FROM orders")
def _(s, d):
    return f.order_categories(t(s, d, "orders"), "o_orderpriority", ["5-LOW", "1-URGENT"])


@query("category_union", f"WITH {SIDES} SELECT l_returnflag FROM rl UNION SELECT l_returnflag FROM cand")
def _(s, d):
    return f.category_union(real(s, d), cand(s, d), "l_returnflag")


@query("column_distributions", """SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*)::BIGINT AS n FROM lineitem GROUP BY 2 UNION ALL SELECT 'l_linestatus', l_linestatus, count(*)::BIGINT FROM lineitem GROUP BY 2""")
def _(s, d):
    return f.column_distributions(t(s, d, "lineitem"), CATS)


@query("stack_sources", f"WITH {SIDES} SELECT 'real' AS source, row_id, l_quantity FROM rl UNION ALL SELECT 'cand_b', row_id, l_quantity FROM cand WHERE model = 'cand_b'")
def _(s, d):
    return f.stack_sources({"real": real(s, d), "cand_b": cand(s, d).filter("model = 'cand_b'")}, ["row_id", "l_quantity"])


@query("unmapped_values", "SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F')")
def _(s, d):
    o = t(s, d, "orders").select("o_orderstatus")
    return o.distinct().subtract(o.filter("o_orderstatus = 'F'"))


_BINS = {c: f"least(9, greatest(0, floor(({c} - (SELECT min({c}) FROM rl)) / (((SELECT max({c}) FROM rl) - (SELECT min({c}) FROM rl)) / 10))))::INT::VARCHAR" for c in NUMS}


def _cells(src: str, more: str = "") -> str:
    return " UNION ALL ".join(f"""SELECT {more} '{c}' AS "column", {_BINS.get(c, c)} AS value FROM {src}""" for c in [*CATS, *NUMS])


MARG = f"""{SIDES}, ca AS (SELECT "column", value, count(*) / sum(count(*)) OVER (PARTITION BY "column") AS p FROM ({_cells('rl')}) GROUP BY "column", value),
cb AS (SELECT model, "column", value, count(*) / sum(count(*)) OVER (PARTITION BY model, "column") AS q FROM ({_cells('cand', 'model,')}) GROUP BY model, "column", value),
mg AS (SELECT coalesce(x.model, cb.model) AS model, coalesce(x."column", cb."column") AS "column", coalesce(p, 0) AS p, coalesce(q, 0) AS q FROM (SELECT model, ca.* FROM ca, (SELECT DISTINCT model FROM cand)) x FULL JOIN cb ON x.model = cb.model AND x."column" = cb."column" AND x.value = cb.value)"""


def _metric(term: str, final: str = "{}") -> str:
    return f"""WITH {MARG} SELECT model, round(avg(d), 6) AS value FROM (SELECT model, "column", {final.format(f'sum({term})')} AS d FROM mg GROUP BY ALL) GROUP BY model"""


def marg(s, d):
    return f.marginals(real(s, d), cand(s, d), CATS, NUMS)


@query("marginals", f"""WITH {MARG} SELECT model, "column", count(*)::BIGINT AS n, round(sum(p), 6) AS p, round(sum(q), 6) AS q FROM mg GROUP BY ALL""")
def _(s, d):
    return _r(marg(s, d).groupBy("model", "column").agg(F.count("*").alias("n"), F.sum("p").alias("p"), F.sum("q").alias("q")), "p", "q")


@query("jensenshannon_dist", _metric("(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2", "sqrt(greatest({}, 0))"))
def _(s, d):
    return _r(f.jensenshannon_dist(marg(s, d)))


@query("inv_kl_divergence", _metric("greatest(p, 1e-6) * ln(greatest(p, 1e-6) / greatest(q, 1e-6))", "1 / (1 + {})"))
def _(s, d):
    return _r(f.inv_kl_divergence(marg(s, d)))


@query("h_dist", _metric("(sqrt(p) - sqrt(q)) * (sqrt(p) - sqrt(q))", "sqrt({} / 2)"))
def _(s, d):
    return _r(f.h_dist(marg(s, d)))


@query("total_variation", _metric("abs(p - q) / 2"))
def _(s, d):
    return _r(f.total_variation(marg(s, d)))


_MARGN = MARG.replace("AS p, coalesce(q, 0) AS q FROM", 'AS p, coalesce(q, 0) AS q, (SELECT count(*) FROM cand c2 WHERE c2.model = coalesce(x.model, cb.model)) AS n FROM')
_T = "(2.0 / (9 * k))"
_ERFC = f"(t * exp(-z * z + {_poly}))"
_Z = f"((cbrt(s / k) - (1 - {_T})) / sqrt({_T}) / sqrt(2.0))"


@query("chi_squared_test", f"""WITH {_MARGN}, st AS (SELECT model, "column", sum(CASE WHEN p > 0 THEN n * (q - p) * (q - p) / p ELSE 0 END) AS s, count(*) FILTER (p > 0) - 1 AS k, bool_or(p = 0 AND q > 0) AS new FROM mg GROUP BY ALL),
zz AS (SELECT *, abs({_Z}) AS z, 1 / (1 + abs({_Z}) / 2) AS t, {_Z} >= 0 AS up FROM st) SELECT model, round(avg(CASE WHEN new THEN 0.0 WHEN k < 1 OR s <= 0 THEN 1.0 WHEN up THEN {_ERFC} / 2 ELSE 1 - {_ERFC} / 2 END), 6) AS value FROM zz GROUP BY model""")
def _(s, d):
    return _r(f.chi_squared_test(marg(s, d)))


@query("chi_squared_statistic", _metric("CASE WHEN p > 0 THEN (q - p) * (q - p) / p ELSE 0 END"))
def _(s, d):
    return _r(f.chi_squared_statistic(marg(s, d)))


CUM = f"""{SIDES}, lv AS (SELECT model, 'q' AS c, l_quantity AS v, 1 AS a, 0 AS b FROM rl, (SELECT DISTINCT model FROM cand) UNION ALL SELECT model, 'q', l_quantity, 0, 1 FROM cand UNION ALL SELECT model, 'd', l_discount, 1, 0 FROM rl, (SELECT DISTINCT model FROM cand) UNION ALL SELECT model, 'd', l_discount, 0, 1 FROM cand),
cu AS (SELECT model, c, v, sum(sum(a)) OVER w / sum(sum(a)) OVER (PARTITION BY model, c) AS fa, sum(sum(b)) OVER w / sum(sum(b)) OVER (PARTITION BY model, c) AS fb, lead(v) OVER w AS nx FROM lv GROUP BY model, c, v WINDOW w AS (PARTITION BY model, c ORDER BY v))"""


@query("ks_test", f"WITH {CUM} SELECT model, round(avg(1 - d), 6) AS value FROM (SELECT model, c, max(abs(fa - fb)) AS d FROM cu GROUP BY ALL) GROUP BY model")
def _(s, d):
    return _r(f.ks_test(real(s, d), cand(s, d), NUMS))


_TV = " UNION ALL ".join(f"""SELECT model, '{c}' AS "column", 'c' AS kind, sum(abs(coalesce(p, 0) - coalesce(q, 0))) / 2 AS statistic FROM (SELECT * FROM (SELECT model, {c} AS v, n / sum(n) OVER () AS p FROM (SELECT {c}, count(*) AS n FROM rl GROUP BY 1), (SELECT DISTINCT model FROM cand)) x
  FULL JOIN (SELECT model, {c} AS v, count(*) / sum(count(*)) OVER (PARTITION BY model) AS q FROM cand GROUP BY 1, 2) y USING (model, v)) GROUP BY model""" for c in CATS).replace("n / sum(n) OVER ()", "n / sum(n) OVER (PARTITION BY model)")


@query("ks_statistics", f"""WITH {CUM} SELECT model, "column", kind, round(statistic, 6) AS statistic FROM (SELECT model, CASE c WHEN 'q' THEN 'l_quantity' ELSE 'l_discount' END AS "column", 'n' AS kind, max(abs(fa - fb)) AS statistic FROM cu GROUP BY ALL UNION ALL {_TV})""")
def _(s, d):
    return _r(pt.marginal_statistics(real(s, d), cand(s, d), NUMS, CATS), "statistic")


@query("ks_permutation_test")
def _(s, d):
    return pt.permutation_test(real(s, d), cand(s, d), NUMS, CATS)


@query("wasserstein_dist", f"WITH {CUM} SELECT model, round(sum(abs(fa - fb) * (nx - v)), 6) AS value FROM cu WHERE nx IS NOT NULL GROUP BY model")
def _(s, d):
    return _r(f.wasserstein_dist(real(s, d), cand(s, d), NUMS))


@query("data_mismatch", f"WITH {SIDES} SELECT DISTINCT model, 0.25::DOUBLE AS value FROM cand")
def _(s, d):
    cols = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    return f.data_mismatch(real(s, d).select(*cols), cand(s, d).select("model", "l_quantity", "l_discount", F.col("l_tax").cast("string").alias("l_tax"), "l_returnflag"))


@query("common_rows_proportion", f"WITH {SIDES} SELECT model, round(avg((EXISTS (SELECT 1 FROM rl WHERE rl.l_quantity = cand.l_quantity AND rl.l_discount = cand.l_discount AND rl.l_tax = cand.l_tax AND rl.l_suppkey = cand.l_suppkey))::INT), 6) AS value FROM cand GROUP BY model")
def _(s, d):
    return _r(f.common_rows_proportion(real(s, d), cand(s, d), ["l_quantity", "l_discount", "l_tax", "l_suppkey"]))


@query("dwm", f"WITH {SIDES} SELECT model, round((abs(avg(l_quantity) - (SELECT avg(l_quantity) FROM rl)) / (SELECT max(l_quantity) - min(l_quantity) FROM rl) + abs(avg(l_discount) - (SELECT avg(l_discount) FROM rl)) / (SELECT max(l_discount) - min(l_discount) FROM rl)) / 2, 6) AS value FROM cand GROUP BY model")
def _(s, d):
    return _r(f.dwm(real(s, d), cand(s, d), NUMS))


def _ci(c: str) -> str:
    z = 1.959963984540054
    return f"(SELECT avg({c}) - {z} * stddev_samp({c}) / sqrt(count(*)) FROM rl) AS rl_{c}, (SELECT avg({c}) + {z} * stddev_samp({c}) / sqrt(count(*)) FROM rl) AS rh_{c}, avg({c}) - {z} * stddev_samp({c}) / sqrt(count(*)) AS sl_{c}, avg({c}) + {z} * stddev_samp({c}) / sqrt(count(*)) AS sh_{c}"


def _ov(c: str) -> str:
    w = f"(least(rh_{c}, sh_{c}) - greatest(rl_{c}, sl_{c}))"
    return f"greatest(0, {w} / (rh_{c} - rl_{c}) / 2 + {w} / (sh_{c} - sl_{c}) / 2)"


@query("cio", f"WITH {SIDES}, ci AS (SELECT model, {_ci('l_quantity')}, {_ci('l_discount')} FROM cand GROUP BY model) SELECT model, round(({_ov('l_quantity')} + {_ov('l_discount')}) / 2, 6) AS value FROM ci")
def _(s, d):
    return _r(f.cio(real(s, d), cand(s, d), NUMS))


@query("corr_diff", f"WITH {SIDES} SELECT model, round(abs(corr(l_quantity, l_discount) - (SELECT corr(l_quantity, l_discount) FROM rl)) + abs(corr(l_quantity, l_extendedprice) - (SELECT corr(l_quantity, l_extendedprice) FROM rl)) + abs(corr(l_discount, l_extendedprice) - (SELECT corr(l_discount, l_extendedprice) FROM rl)), 6) AS value FROM cand GROUP BY model")
def _(s, d):
    return _r(f.corr_diff(real(s, d), cand(s, d), ["l_quantity", "l_discount", "l_extendedprice"]))


def _eta(src: str, key: str) -> str:
    """The correlation ratio of return flag and quantity."""
    return f"(SELECT {key} AS model, sqrt(sum(n * (m - mm) * (m - mm)) / any_value(v)) AS r FROM (SELECT {key}, count(*) AS n, avg(l_quantity) AS m FROM {src} GROUP BY {key}, l_returnflag) g JOIN (SELECT {key} AS k2, avg(l_quantity) AS mm, var_pop(l_quantity) * count(*) AS v FROM {src} GROUP BY {key}) w ON g.{key} = w.k2 GROUP BY {key})"


def _cv(src: str, key: str) -> str:
    """Cramer's V of return flag and line status, from the classic sum of squares over expected counts."""
    return f"""(SELECT {key} AS model, sqrt(sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e) / any_value(t) / least(count(DISTINCT a) - 1, count(DISTINCT b) - 1)) AS r FROM
  (SELECT x.{key}, x.a, y.b, x.n * y.n / t AS e, t FROM (SELECT {key}, l_returnflag AS a, count(*)::DOUBLE AS n FROM {src} GROUP BY ALL) x JOIN (SELECT {key}, l_linestatus AS b, count(*)::DOUBLE AS n FROM {src} GROUP BY ALL) y ON x.{key} = y.{key} JOIN (SELECT {key}, count(*)::DOUBLE AS t FROM {src} GROUP BY ALL) z ON x.{key} = z.{key})
  LEFT JOIN (SELECT {key}, l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS o FROM {src} GROUP BY ALL) USING ({key}, a, b) GROUP BY {key})"""


_K1 = "r1 AS (SELECT 'r' AS k, * FROM rl), c1 AS (SELECT model AS k, * EXCLUDE (model) FROM cand)"


@query("corr_diff_mixed", f"WITH {SIDES}, {_K1} SELECT e.model, round(abs(e.r - f.r) + abs(g.r - h.r), 6) AS value FROM {_eta('c1', 'k')} e JOIN {_cv('c1', 'k')} g ON e.model = g.model, {_eta('r1', 'k')} f, {_cv('r1', 'k')} h")
def _(s, d):
    r, c = real(s, d), cand(s, d)
    mixed = f._pair_difference(f.correlation_ratios(r, [], ["l_returnflag"], ["l_quantity"]), f.correlation_ratios(c, ["model"], ["l_returnflag"], ["l_quantity"]))
    both = mixed.unionByName(f._pair_difference(f.cramers_v(r, [], CATS), f.cramers_v(c, ["model"], CATS)))
    return _r(both.groupBy("model").agg(F.sum("value").alias("value")))


def _mi(src: str, key: str) -> str:
    return f"(SELECT {key} AS model, sum(p * ln(p / (pa * pb))) / sqrt(sum(p * ln(pa)) * sum(p * ln(pb))) AS mi FROM (SELECT {key} AS model, p / sum(p) OVER w AS p, sum(p) OVER (PARTITION BY {key}, a) / sum(p) OVER w AS pa, sum(p) OVER (PARTITION BY {key}, b) / sum(p) OVER w AS pb, {key} FROM (SELECT {key}, l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS p FROM {src} GROUP BY ALL) WINDOW w AS (PARTITION BY {key})) GROUP BY 1)"


@query("mi_diff", f"WITH {SIDES}, r1 AS (SELECT 'r' AS k, * FROM rl), c1 AS (SELECT model AS k, * EXCLUDE (model) FROM cand) SELECT c.model, round(abs(c.mi - r.mi), 6) AS value FROM {_mi('c1', 'k')} c, {_mi('r1', 'k')} r")
def _(s, d):
    return _r(f.mi_diff(real(s, d), cand(s, d), CATS))


def _qb(src: str, more: str = "") -> str:
    one = lambda c: f"SELECT {more} '{c}' AS c, len(list_filter((SELECT quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) FROM rl), lambda q: q < {c})) AS b FROM {src}"
    return " UNION ALL ".join(one(c) for c in ("l_extendedprice",))


@query("q_mse", f"""WITH {SIDES}, a AS (SELECT c, b, count(*) / sum(count(*)) OVER (PARTITION BY c) AS p FROM ({_qb('rl')}) GROUP BY c, b), e AS (SELECT model, c, b, count(*) / sum(count(*)) OVER (PARTITION BY model, c) AS q FROM ({_qb('cand', 'model,')}) GROUP BY model, c, b)
SELECT x.model, round(avg((p - coalesce(q, 0)) * (p - coalesce(q, 0))), 9) AS value FROM (SELECT model, a.* FROM a, (SELECT DISTINCT model FROM cand)) x LEFT JOIN e ON e.model = x.model AND e.c = x.c AND e.b = x.b GROUP BY x.model""")
def _(s, d):
    return f.q_mse(real(s, d), cand(s, d), ["l_extendedprice"]).withColumn("value", F.round("value", 9))


_QUASI = "l_returnflag, l_linestatus, l_linenumber"
QUASI = _QUASI.split(", ")


@query("k_anonymization", f"WITH {SIDES} SELECT model, min(n)::BIGINT AS value FROM (SELECT model, {_QUASI}, count(*) AS n FROM cand GROUP BY ALL) GROUP BY model")
def _(s, d):
    return f.k_anonymization(cand(s, d), QUASI)


@query("k_map", f"WITH {SIDES} SELECT c.model, min(coalesce(r.n, 0))::BIGINT AS value FROM (SELECT DISTINCT model, {_QUASI} FROM cand) c LEFT JOIN (SELECT {_QUASI}, count(*) AS n FROM rl GROUP BY ALL) r USING ({_QUASI}) GROUP BY c.model")
def _(s, d):
    return f.k_map(real(s, d), cand(s, d), QUASI)


@query("distinct_l_diversity", f"WITH {SIDES} SELECT model, min(n)::BIGINT AS value FROM (SELECT model, {_QUASI}, count(DISTINCT l_quantity) AS n FROM cand GROUP BY ALL) GROUP BY model")
def _(s, d):
    return f.l_diversity(cand(s, d), QUASI, "l_quantity")


@query("delta_presence", f"WITH {SIDES} SELECT c.model, round(max(c.n / r.n), 6) AS value FROM (SELECT model, {_QUASI}, count(*) AS n FROM cand GROUP BY ALL) c JOIN (SELECT {_QUASI}, count(*) AS n FROM rl GROUP BY ALL) r USING ({_QUASI}) GROUP BY c.model")
def _(s, d):
    return _r(f.delta_presence(real(s, d), cand(s, d), QUASI))


_GAPS = "CASE WHEN l_returnflag <> 'N' THEN l_returnflag END"  # a quasi-identifier with nulls on both sides, and a model without any real class
_GAPPED = f"{SIDES}, rg AS (SELECT {_GAPS} AS f, l_linestatus, l_linenumber FROM rl), cg AS (SELECT model, {_GAPS} AS f, l_linestatus, l_linenumber FROM cand UNION ALL SELECT 'strange', 'X', l_linestatus, l_linenumber FROM cand WHERE model = 'cand_a'), rn AS (SELECT f, l_linestatus, l_linenumber, count(*) AS n FROM rg GROUP BY ALL), cn AS (SELECT model, f, l_linestatus, l_linenumber, count(*) AS n FROM cg GROUP BY ALL)"
_SAME = "r.f IS NOT DISTINCT FROM c.f AND r.l_linestatus = c.l_linestatus AND r.l_linenumber = c.l_linenumber"


def _gapped(s, d):
    cut = lambda df: df.withColumn("f", F.expr(_GAPS))
    c = cut(cand(s, d))
    strange = c.filter("model = 'cand_a'").withColumns({"model": F.lit("strange"), "f": F.lit("X")})
    return cut(real(s, d)), c.unionByName(strange), ["f", "l_linestatus", "l_linenumber"]


@query("k_map_nulls", f"WITH {_GAPPED} SELECT model, min(coalesce(r.n, 0))::BIGINT AS value FROM cn c LEFT JOIN rn r ON {_SAME} GROUP BY model")
def _(s, d):
    return f.k_map(*_gapped(s, d))


@query("delta_presence_nulls", f"WITH {_GAPPED} SELECT model, round(max(c.n / r.n), 6) AS value FROM cn c LEFT JOIN rn r ON {_SAME} GROUP BY model")
def _(s, d):
    return _r(f.delta_presence(*_gapped(s, d)))


@query("hit_rate", """WITH o AS (SELECT *, c_custkey % 2 AS side FROM customer), tol AS (SELECT (max(c_acctbal) - min(c_acctbal)) / 30 AS w FROM o WHERE side = 0),
h AS (SELECT DISTINCT a.c_custkey FROM o a JOIN o b ON a.side = 0 AND b.side = 1 AND a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment, tol WHERE abs(a.c_acctbal - b.c_acctbal) <= w)
SELECT 'm' AS model, round((SELECT count(*) FROM h) / (SELECT count(*) FROM o WHERE side = 0), 6) AS value""")
def _(s, d):
    c = t(s, d, "customer")
    syn = c.filter("c_custkey % 2 = 1").withColumn("model", F.lit("m"))
    return _r(f.hit_rate(c.filter("c_custkey % 2 = 0"), syn, ["c_nationkey", "c_mktsegment"], ["c_acctbal"], "c_custkey"))


# neighbours: even vec_id are real, odd ones candidates

_D = "sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"
EMB = f"""e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings), er AS (SELECT * FROM e WHERE vec_id % 2 = 0), es AS (SELECT * FROM e WHERE vec_id % 2 = 1),
rr AS (SELECT a.vec_id AS q, b.vec_id AS n, {_D} AS d FROM er a JOIN er b ON a.vec_id <> b.vec_id), rs AS (SELECT a.vec_id AS q, b.vec_id AS n, {_D} AS d FROM er a, es b), ss AS (SELECT a.vec_id AS q, b.vec_id AS n, {_D} AS d FROM es a JOIN es b ON a.vec_id <> b.vec_id)"""


def emb(s, d, side):
    return t(s, d, "embeddings").filter(f"vec_id % 2 = {side}")


#: A third of the rows against the rest.
_EMB3 = f"e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), el AS (SELECT * FROM e WHERE vec_id % 3 > 0), es AS (SELECT * FROM e WHERE vec_id % 3 = 0)"


@query("nn_join", f"WITH {EMB} SELECT n AS s, row_number() OVER (PARTITION BY n ORDER BY d, q)::INT AS rank, q AS r, round(d, 6) AS distance FROM rs QUALIFY row_number() OVER (PARTITION BY n ORDER BY d, q) <= 3")
def _(s, d):
    return _r(nn.nn_join(emb(s, d, 1).withColumnRenamed("vec_id", "s"), emb(s, d, 0).withColumnRenamed("vec_id", "r"), "s", "r", "embedding", 3), "distance")


@query("relabel_by_neighbour", f"WITH {EMB}, nr AS (SELECT n AS vec_id, min_by(q, d) AS q FROM rs GROUP BY n) SELECT vec_id, er.label, es.label <> er.label AS changed FROM nr JOIN er ON er.vec_id = nr.q JOIN es USING (vec_id)".replace("SELECT vec_id, er.label", "SELECT nr.vec_id, er.label").replace("JOIN es USING (vec_id)", "JOIN es ON es.vec_id = nr.vec_id"))
def _(s, d):
    return nn.relabel_by_neighbour(emb(s, d, 1), emb(s, d, 0), "vec_id", "vec_id", "embedding", "label").select("vec_id", "label", "changed")


@query("nearest_syn_neighbor_distance", f"WITH {EMB}, m AS (SELECT n, min(d) / 10 AS x FROM rs GROUP BY n) SELECT round(avg(x), 6) AS nearest_syn_neighbor_distance, round(avg((x <= 0.2)::INT), 6) AS close_values_probability, round(avg((x >= 0.8)::INT), 6) AS distant_values_probability FROM m")
def _(s, d):
    return _r(nn.nearest_distance_stats(emb(s, d, 1), emb(s, d, 0), "vec_id", "embedding", 10.0), "nearest_syn_neighbor_distance", "close_values_probability", "distant_values_probability")


@query("nndr", f"WITH {EMB}, k AS (SELECT n, d, row_number() OVER (PARTITION BY n ORDER BY d) AS r FROM rs) SELECT round(avg(a.d / b.d), 6) AS value FROM k a JOIN k b ON a.n = b.n AND a.r = 1 AND b.r = 2")
def _(s, d):
    return _r(nn.nndr(emb(s, d, 1), emb(s, d, 0), "vec_id", "embedding"))


@query("dcr", f"WITH {EMB} SELECT round((SELECT quantile_cont(x, 0.5) FROM (SELECT min(d) AS x FROM rs GROUP BY n)) / (SELECT quantile_cont(x, 0.5) FROM (SELECT min(d) AS x FROM rr GROUP BY q)), 6) AS value")
def _(s, d):
    return _r(nn.dcr(emb(s, d, 1), emb(s, d, 0), "vec_id", "embedding"))


_SHARE = "(SELECT count(*) FROM es) / (SELECT count(*) FROM el)"


@query("nnaa", f"""WITH {_EMB3}, rd AS (SELECT i, vec_id FROM el, range(30) AS r(i) WHERE {u("vec_id::VARCHAR || '|nnaa|' || i")} < {_SHARE}),
ll AS (SELECT a.vec_id AS a, b.vec_id AS b, {_D} AS d FROM el a JOIN el b ON a.vec_id <> b.vec_id), ls AS (SELECT a.vec_id AS a, b.vec_id AS b, {_D} AS d FROM el a, es b), ss AS (SELECT a.vec_id AS a, min({_D}) AS d FROM es a JOIN es b ON a.vec_id <> b.vec_id GROUP BY 1),
lo AS (SELECT x.i, x.vec_id, min(ll.d) AS own FROM rd x JOIN rd y USING (i) JOIN ll ON ll.a = x.vec_id AND ll.b = y.vec_id GROUP BY ALL), lx AS (SELECT a AS vec_id, min(d) AS other FROM ls GROUP BY 1),
s1 AS (SELECT i, avg((other > own)::INT) AS s FROM lo JOIN lx USING (vec_id) GROUP BY i), s2 AS (SELECT i, avg((other > ss.d)::INT) AS s FROM (SELECT i, b AS vec_id, min(d) AS other FROM rd JOIN ls ON rd.vec_id = ls.a GROUP BY ALL) JOIN ss ON ss.a = vec_id GROUP BY i)
SELECT round(avg((s1.s + s2.s) / 2), 6) AS value FROM s1 JOIN s2 USING (i)""")
def _(s, d):
    e = t(s, d, "embeddings")
    return _r(nn.nnaa(e.filter("vec_id % 3 = 0"), e.filter("vec_id % 3 > 0"), "vec_id", "embedding"))


_W = "wt AS (SELECT list(1 / greatest(h, 1e-6) ORDER BY i) AS w FROM (SELECT i, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM (SELECT i, round(v[i]) AS x, count(*) AS n FROM er0, range(1, 65) AS r(i) GROUP BY ALL) GROUP BY i))"
_WEMB = f"e0 AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), er0 AS (SELECT * FROM e0 WHERE vec_id % 2 = 0), {_W}, " + EMB.replace("embedding::DOUBLE[] AS v, label FROM embeddings", "list_transform(list_zip(embedding::DOUBLE[], w), lambda z: z[1] * z[2]) AS v, label FROM embeddings, wt")


@query("identifiability_score", f"WITH {_WEMB} SELECT round(avg((o.d < w.d)::INT), 6) AS value FROM (SELECT q, min(d) AS d FROM rs GROUP BY q) o JOIN (SELECT q, min(d) AS d FROM rr GROUP BY q) w USING (q)")
def _(s, d):
    return _r(nn.identifiability(emb(s, d, 1), emb(s, d, 0), "vec_id", "embedding"))


@query("prdc", f"""WITH {EMB}, b AS (SELECT q, d AS r FROM rr QUALIFY row_number() OVER (PARTITION BY q ORDER BY d) = 5), c AS (SELECT q, d AS r FROM ss QUALIFY row_number() OVER (PARTITION BY q ORDER BY d) = 5)
SELECT round((SELECT count(DISTINCT n) FROM rs JOIN b USING (q) WHERE d <= r) / (SELECT count(*) FROM es), 6) AS precision, round((SELECT count(DISTINCT rs.q) FROM rs JOIN c ON rs.n = c.q WHERE d <= r) / (SELECT count(*) FROM er), 6) AS recall,
round((SELECT count(*) FROM rs JOIN b USING (q) WHERE d <= r) / (SELECT count(*) FROM es) / 5, 6) AS density, (SELECT round(avg((m.d <= r)::INT), 6) FROM b JOIN (SELECT q, min(d) AS d FROM rs GROUP BY q) m USING (q)) AS coverage""")
def _(s, d):
    return _r(nn.prdc(emb(s, d, 1), emb(s, d, 0), "vec_id", "embedding"), "precision", "recall", "density", "coverage")


# group fairness of given predictions: quality predicts toxic, groups are languages

_GAP = "g AS (SELECT lang, avg((quality = 1)::INT) AS pr, avg(CASE WHEN toxic = 1 THEN (quality = 1)::INT END) AS tpr, avg(CASE WHEN toxic = 0 THEN (quality = 1)::INT END) AS fpr FROM labels JOIN documents USING (doc_id) GROUP BY lang)"


@query("group_fairness_gaps", f"WITH {_GAP} SELECT round(max(pr) - min(pr), 6) AS statistical_parity, round(greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)), 6) AS equalized_odds, round(max(tpr) - min(tpr), 6) AS equal_opportunity FROM g")
def _(s, d):
    x = t(s, d, "labels").join(t(s, d, "documents").select("doc_id", "lang"), "doc_id")
    hit = (F.col("quality") == 1).cast("double")
    g = x.groupBy("lang").agg(F.avg(hit).alias("pr"), F.avg(F.when(F.col("toxic") == 1, hit)).alias("tpr"), F.avg(F.when(F.col("toxic") == 0, hit)).alias("fpr"))
    gap = lambda c: F.max(c) - F.min(c)
    return _r(g.agg(gap("pr").alias("statistical_parity"), F.greatest(gap("tpr"), gap("fpr")).alias("equalized_odds"), gap("tpr").alias("equal_opportunity")), "statistical_parity", "equalized_odds", "equal_opportunity")


_MMD = f"""st AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, stddev_pop(l_discount) AS sd FROM rl),
pt AS (SELECT s, (l_quantity - mq) / sq AS x, (l_discount - md) / sd AS y, count(*)::DOUBLE AS n FROM (SELECT 'r' AS s, * FROM rl UNION ALL SELECT model, * EXCLUDE (model) FROM cand), st GROUP BY ALL), sz AS (SELECT s, sum(n) AS t FROM pt GROUP BY s),
kk AS (SELECT a.s AS s1, b.s AS s2, sum(a.n * b.n * exp(-((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / 4)) AS k FROM pt a, pt b WHERE a.s = b.s OR a.s = 'r' GROUP BY ALL), km AS (SELECT s1, s2, k / u.t / v.t AS k FROM kk JOIN sz u ON u.s = s1 JOIN sz v ON v.s = s2),
li2 AS (SELECT model, pow((avg(l_quantity) - (SELECT mq FROM st)) / (SELECT sq FROM st), 2) + pow((avg(l_discount) - (SELECT md FROM st)) / (SELECT sd FROM st), 2) AS linear FROM cand GROUP BY model)"""


@query("max_mean_discrepancy", f"""WITH {SIDES}, {_MMD} SELECT model, round(greatest(0, (SELECT k FROM km WHERE s1 = 'r' AND s2 = 'r') + (SELECT k FROM km WHERE s1 = model AND s2 = model) - 2 * (SELECT k FROM km WHERE s1 = 'r' AND s2 = model)), 9) AS value, round(linear, 9) AS linear FROM li2""")
def _(s, d):
    return f.max_mean_discrepancy(real(s, d), cand(s, d), NUMS).select("model", F.round("value", 9).alias("value"), F.round("linear", 9).alias("linear"))


@query("att_discl", f"WITH {EMB} SELECT round(avg((er.label = es.label)::INT), 6) AS value FROM (SELECT q, min_by(n, d) AS n FROM rs GROUP BY q) m JOIN er ON er.vec_id = m.q JOIN es ON es.vec_id = m.n")
def _(s, d):
    return _r(nn.attribute_disclosure(emb(s, d, 0), emb(s, d, 1), "vec_id", "embedding", "label"))


_KNOWN = EMB.replace("embedding::DOUBLE[] AS v, label", "embedding[2:]::DOUBLE[] AS v, embedding[1]::DOUBLE AS label")


@query("att_discl_risk", f"WITH {_KNOWN} SELECT round(avg((abs(er.label - es.label) <= (SELECT (max(label) - min(label)) / 30 FROM er))::INT), 6) AS value FROM (SELECT q, min_by(n, d) AS n FROM rs GROUP BY q) m JOIN er ON er.vec_id = m.q JOIN es ON es.vec_id = m.n")
def _(s, d):
    x, y = (emb(s, d, i).select("vec_id", F.slice("embedding", 2, 64).alias("known"), F.get("embedding", F.lit(0)).cast("double").alias("asked")) for i in (0, 1))
    return _r(nn.attribute_disclosure(x, y, "vec_id", "known", "asked", 1 / 30))


@query("authenticity", f"WITH {EMB} SELECT round(avg((m.d > w.d)::INT), 6) AS value FROM (SELECT n, min_by(q, d) AS q, min(d) AS d FROM rs GROUP BY n) m JOIN (SELECT q, min(d) AS d FROM rr GROUP BY q) w USING (q)")
def _(s, d):
    return _r(nn.authenticity(emb(s, d, 0), emb(s, d, 1), "vec_id", "embedding"))


def _ball(a: str, b: str) -> str:
    c = f"(SELECT list(m ORDER BY i) FROM (SELECT i, avg(v[i]) AS m FROM {a}, range(1, 65) AS r(i) GROUP BY i))"
    d = f"sqrt(list_sum(list_transform(list_zip(v, {c}), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))"
    return f"(SELECT round(avg((d <= (SELECT quantile_cont(d, 0.9) FROM (SELECT {d} AS d FROM {a})))::INT), 6) FROM (SELECT {d} AS d FROM {b}))"


@query("alpha_precision", f"WITH {EMB} SELECT {_ball('er', 'es')} AS alpha_precision, {_ball('es', 'er')} AS beta_recall")
def _(s, d):
    return _r(nn.alpha_precision(emb(s, d, 0), emb(s, d, 1), "embedding"), "alpha_precision", "beta_recall")
