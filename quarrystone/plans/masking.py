"""Queries of splits, samples, masks, and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.functions.session import checkpointed
from quarrystone.operators import impute as im, split as sp
from quarrystone.plans.catalog import CAND, LI, LI1 as _LI1, LN, LN1 as _LN1, REAL, cand, li, ln, query, real, t, unique_li

FEATURES = ["l_discount", "l_tax", "l_extendedprice", "l_quantity", "l_returnflag"]
NUM, CAT = ["l_quantity", "l_extendedprice"], ["l_returnflag"]


def u(key: str, *seed: object) -> str:
    text = " || ".join([key, *(f"'|{x}'" for x in seed)])
    return f"((('0x' || substr(md5({text}), 1, 12))::BIGINT + 0.5) / {float(1 << 48)})"


def _order(name: str) -> str:
    return f"{name}"


SPLIT = f"""sx AS (SELECT *, {u('row_id', 42)} AS u FROM li), sp AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY l_returnflag ORDER BY u, row_id) <= round_even(count(*) OVER (PARTITION BY l_returnflag) * 0.6667, 0) THEN 'train' ELSE 'test' END AS split FROM sx)"""


def rolled(s, d):
    return unique_li(s, d)


@query("train_test_split", f"WITH {_LI1}, {SPLIT} SELECT row_id, split FROM sp")
def _(s, d):
    return sp.train_test_split(checkpointed(rolled(s, d).select("row_id", "l_returnflag")), "row_id", stratify="l_returnflag").select("row_id", "split")


@query("split_by_threshold", f"WITH {LI} SELECT row_id, CASE WHEN {u('row_id', 42)} < 0.6667 THEN 'train' ELSE 'test' END AS split FROM li")
def _(s, d):
    return sp.split_by_threshold(li(s, d).select("row_id"), "row_id", 0.6667, 42)


@query("split_by_membership", f"WITH {_LI1}, {SPLIT} SELECT row_id, l_quantity, split FROM sp WHERE l_quantity > 10")
def _(s, d):
    x = checkpointed(rolled(s, d).select("row_id", "l_quantity", "l_returnflag"))
    return sp.split_by_membership(x.filter("l_quantity > 10").select("row_id", "l_quantity"), sp.train_test_split(x.select("row_id", "l_returnflag"), "row_id", stratify="l_returnflag"), "row_id")


@query("semi_rows", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def _(s, d):
    return sp.semi_rows(t(s, d, "orders").select("o_orderkey", "o_totalprice"), t(s, d, "lineitem").filter("l_quantity > 45").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("anti_rows", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def _(s, d):
    return sp.anti_rows(t(s, d, "orders").select("o_orderkey", "o_totalprice"), t(s, d, "lineitem").filter("l_quantity > 45").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("bootstrap", f"""WITH p AS (SELECT row_number() OVER (ORDER BY {u('p_partkey::VARCHAR', 'rows')}, p_partkey) - 1 AS i, p_partkey, p_brand FROM part), n AS (SELECT count(*) AS n FROM part),
dr AS (SELECT draw, floor({u('draw::VARCHAR', 3)} * n)::BIGINT AS i FROM (SELECT unnest(range(n)) AS draw, n FROM n)) SELECT draw, p_partkey, p_brand FROM dr JOIN p USING (i)""")
def _(s, d):
    p = t(s, d, "part")
    return sp.bootstrap(p.select("p_partkey", "p_brand"), "p_partkey", p.count(), 3).select("draw", "p_partkey", "p_brand")


@query("number_rows", f"SELECT p_partkey, row_number() OVER (ORDER BY {u('p_partkey::VARCHAR', 'rows')}, p_partkey)::BIGINT - 1 AS row_no FROM part")
def _(s, d):
    return sp.number_rows(t(s, d, "part").select("p_partkey"), "p_partkey")


@query("augment", f"WITH {LI}, {REAL}, {CAND} SELECT row_id, l_quantity FROM rl UNION ALL SELECT row_id, l_quantity FROM cand")
def _(s, d):
    return sp.augment(real(s, d).select("row_id", "l_quantity"), cand(s, d).select("row_id", "l_quantity"))


@query("mask_count", "SELECT o_orderkey, CASE WHEN o_orderkey % 50 < 2 THEN 0 ELSE least(greatest(1, round_even((o_orderkey % 50) * 0.25, 0)), o_orderkey % 50 - 1) END::BIGINT AS k FROM orders")
def _(s, d):
    return t(s, d, "orders").select("o_orderkey", sp.mask_count(F.col("o_orderkey") % 50, 0.25).alias("k"))


def _mask_sql(mechanism: str, seed: int, frac: float = 0.2, features: list[str] = FEATURES) -> str:
    parts = []
    for c in features:
        src = None if mechanism == "mcar" else c if mechanism == "mnar" else next(x for x in features if x != c)
        v = u("row_id", c, seed)
        if src:
            x = f"(dense_rank() OVER (ORDER BY {src}) - 1)::DOUBLE" if src in ("l_returnflag", "l_linestatus") else f"{src}::DOUBLE"
            parts.append(f"""SELECT '{c}' AS "column", row_id, 1 - pow(u0, 1 / (CASE WHEN nn > 0 OR coalesce(sd, 0) = 0 THEN 1.0 ELSE 1 / (1 + exp(-greatest(-4.0, least(4.0, (x - m) / sd)))) END)) AS v FROM (
  SELECT row_id, x, {v} AS u0, avg(x) OVER () AS m, stddev_pop(x) OVER () AS sd, count(*) OVER () - count(x) OVER () AS nn FROM (SELECT row_id, {x} AS x FROM ln WHERE {c} IS NOT NULL))""")
        else:
            parts.append(f"""SELECT '{c}' AS "column", row_id, {v} AS v FROM ln WHERE {c} IS NOT NULL""")
    return f"""SELECT "column", row_id FROM ({' UNION ALL '.join(parts)}) QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY v, row_id) <= least(greatest(1, round_even(count(*) OVER (PARTITION BY "column") * {frac}, 0)), count(*) OVER (PARTITION BY "column") - 1)"""


def lnu(s, d):
    return ln(s, d, unique_li(s, d))


def mask(s, d, mechanism="mcar", seed=5, rows=None):
    return sp.artificial_mask(lnu(s, d) if rows is None else rows, "row_id", [*FEATURES, "l_linestatus"], ["l_linestatus"], 0.2, mechanism, seed)


@query("artificial_mask", f"WITH {_LN1} {_mask_sql('mcar', 5)}")
def _(s, d):
    return mask(s, d)


@query("artificial_mask_mar", f"WITH {_LN1} {_mask_sql('mar', 5)}")
def _(s, d):
    return mask(s, d, "mar")


@query("artificial_mask_mnar", f"WITH {_LN1} {_mask_sql('mnar', 5)}")
def _(s, d):
    return mask(s, d, "mnar")


_APPLY = f"""mk AS ({_mask_sql('mcar', 5)}), mf AS (SELECT row_id, {', '.join(f'''bool_or("column" = '{c}') AS m_{c}''' for c in FEATURES)} FROM mk GROUP BY row_id),
ms AS (SELECT row_id, {', '.join(f'CASE WHEN coalesce(m_{c}, false) THEN NULL ELSE {c} END AS {c}' for c in FEATURES)} FROM ln LEFT JOIN mf USING (row_id))"""


def masked(s, d):
    rows = lnu(s, d)
    return sp.apply_mask(rows.select("row_id", *FEATURES), mask(s, d, rows=rows), "row_id")


@query("apply_mask", f"WITH {_LN1}, {_APPLY} SELECT * FROM ms")
def _(s, d):
    return masked(s, d)


@query("mask_grid", f"""WITH {_LN1} SELECT 'mcar' AS mechanism, 0 AS mask_index, * FROM ({_mask_sql('mcar', 7)}) UNION ALL SELECT 'mcar', 1, * FROM ({_mask_sql('mcar', 8)})
UNION ALL SELECT 'mnar', 0, * FROM ({_mask_sql('mnar', 10007)}) UNION ALL SELECT 'mnar', 1, * FROM ({_mask_sql('mnar', 10008)})""")
def _(s, d):
    return sp.mask_grid(lnu(s, d), "row_id", FEATURES, ["mcar", "mnar"], 2, 7)


@query("mask_difference", f"WITH {_LN1}, a AS ({_mask_sql('mcar', 5)}), b AS ({_mask_sql('mcar', 6)}) (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def _(s, d):
    rows = lnu(s, d)
    return sp.mask_difference(mask(s, d, rows=rows), mask(s, d, seed=6, rows=rows))


def _resample_sql(want: str, seed: int) -> str:
    """Rows of each class: all of them as often as they fit into what is wanted, and the smallest hashes for the rest."""
    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY {u('row_id', seed)}, row_id) AS r, count(*) OVER (PARTITION BY l_returnflag) AS n FROM li),
wn AS (SELECT rk.*, {want} AS w FROM rk), rs AS (SELECT * FROM (SELECT *, unnest(range(w // n)) AS c FROM wn) UNION ALL SELECT *, -1 FROM wn WHERE r <= w % n)"""


@query("proportional_resample", f"WITH {_LI1}, {_resample_sql("CASE l_returnflag WHEN 'A' THEN 50000 WHEN 'N' THEN 30000 ELSE 20000 END", 0)} SELECT row_id, l_returnflag, count(*)::BIGINT AS n FROM rs GROUP BY ALL")
def _(s, d):
    r = sp.proportional_resample(rolled(s, d).select("row_id", "l_returnflag"), "l_returnflag", {"A": 0.5, "N": 0.3, "R": 0.2}, 100_000, "row_id")
    return r.groupBy("row_id", "l_returnflag").agg(F.count("*").alias("n"))


_NORMAL = f"sqrt(-2 * ln({u('row_id', 'l_quantity', 0, 'r')})) * cos({u('row_id', 'l_quantity', 0, 'a')} * 6.283185307179586)"


@query("balanced_seed_sample", f"WITH {_LI1}, {_resample_sql('1000', 0)} SELECT row_id, l_returnflag, round(l_quantity + {_NORMAL} * 0.01 * (SELECT stddev_pop(l_quantity) FROM li), 6) AS l_quantity FROM rs")
def _(s, d):
    r = sp.balanced_seed_sample(rolled(s, d).select("row_id", "l_returnflag", "l_quantity"), "l_returnflag", 3000, "row_id", ["l_quantity"])
    return r.select("row_id", "l_returnflag", F.round("l_quantity", 6).alias("l_quantity"))


@query("sample_column", f"SELECT p_retailprice FROM part ORDER BY {u('p_partkey::VARCHAR', 1)}, p_partkey LIMIT 500")
def _(s, d):
    return sp.sample_column(t(s, d, "part").withColumn("k", F.col("p_partkey").cast("string")), "p_retailprice", "k", 500, 1)


@query("shuffle", "SELECT o_orderkey, md5(o_orderkey::VARCHAR || '|9') AS place FROM orders ORDER BY place")
def _(s, d):
    return sp.shuffle(t(s, d, "orders").select("o_orderkey"), "o_orderkey", 9)


# imputation


@query("missing_count", f"WITH {LN} SELECT count(*) FILTER (l_quantity IS NULL) + count(*) FILTER (l_extendedprice IS NULL) + count(*) FILTER (l_returnflag IS NULL) AS n_missing FROM ln")
def _(s, d):
    return im.missing_count(ln(s, d), ["l_quantity", "l_extendedprice", "l_returnflag"])


@query("missing_fraction", f"""WITH {LN} SELECT * FROM (SELECT 'l_quantity' AS "column", avg((l_quantity IS NULL)::DOUBLE) AS fraction FROM ln UNION ALL SELECT 'l_extendedprice', avg((l_extendedprice IS NULL)::DOUBLE) FROM ln
UNION ALL SELECT 'l_returnflag', avg((l_returnflag IS NULL)::DOUBLE) FROM ln UNION ALL SELECT 'l_tax', avg((l_tax IS NULL)::DOUBLE) FROM ln) WHERE fraction > 0""")
def _(s, d):
    return im.missing_fraction(ln(s, d), ["l_quantity", "l_extendedprice", "l_returnflag", "l_tax"])


@query("mean_fill", f"WITH {LN} SELECT row_id, round(coalesce(l_quantity, avg(l_quantity) OVER ()), 6) AS l_quantity, round(coalesce(l_extendedprice, avg(l_extendedprice) OVER ()), 4) AS l_extendedprice FROM ln")
def _(s, d):
    return im.mean_fill(ln(s, d).select("row_id", *NUM), NUM).select("row_id", F.round("l_quantity", 6).alias("l_quantity"), F.round("l_extendedprice", 4).alias("l_extendedprice"))


@query("constant_shortcut", f"WITH {LN} SELECT row_id, 7 AS c, l_returnflag FROM ln")
def _(s, d):
    return im.constant_shortcut(ln(s, d).select("row_id", F.when(F.col("l_quantity").isNotNull(), 7).alias("c"), "l_returnflag"), ["c", "l_returnflag"])


@query("clamp_observed", f"WITH {_LN1} SELECT row_id, coalesce(l_quantity, -1) AS l_quantity FROM ln")
def _(s, d):
    x = lnu(s, d).select("row_id", "l_quantity")
    return im.clamp_observed(x, x.withColumn("l_quantity", F.lit(-1.0)), "row_id", ["l_quantity"])


@query("average_draws", f"WITH {_LN1} SELECT row_id, round(coalesce(l_quantity, 0) + 2, 6) AS q FROM ln")
def _(s, d):
    x = lnu(s, d).select("row_id", F.coalesce("l_quantity", F.lit(0.0)).alias("q"))
    draws = x.withColumn("q", F.explode(F.array(F.col("q") + 1, F.col("q") + 2, F.col("q") + 3)))
    return im.average_draws(draws, "row_id", ["q"]).select("row_id", F.round("q", 6).alias("q"))


_MODE = "(SELECT l_returnflag FROM ln WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
_FILLED = f"fl AS (SELECT row_id, l_quantity AS oq, l_extendedprice AS oe, l_returnflag AS orf, coalesce(l_quantity, avg(l_quantity) OVER ()) AS l_quantity, coalesce(l_extendedprice, avg(l_extendedprice) OVER ()) AS l_extendedprice, coalesce(l_returnflag, {_MODE}) AS l_returnflag FROM ln)"


def filled(s, d):
    return im.impute(lnu(s, d).select("row_id", *NUM, *CAT), "row_id", NUM, CAT)


@query("impute", f"WITH {_LN1}, {_FILLED} SELECT row_id, round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 4) AS l_extendedprice, l_returnflag FROM fl")
def _(s, d):
    return filled(s, d).select("row_id", F.round("l_quantity", 6).alias("l_quantity"), F.round("l_extendedprice", 4).alias("l_extendedprice"), "l_returnflag")


@query("run_imputation", f"WITH {LI}, {_LN1}, {_FILLED} SELECT row_id, round_even(l_quantity, 0)::BIGINT AS l_quantity, l_returnflag, CASE WHEN {u('row_id', 42)} < 0.6667 THEN 'train' ELSE 'test' END AS split FROM fl")
def _(s, d):
    x = lnu(s, d).select("row_id", *NUM, *CAT)
    return im.run_imputation(x, sp.split_by_threshold(x, "row_id", 0.6667, 42), "row_id", NUM, CAT, {"l_extendedprice": 2}).select("row_id", "l_quantity", "l_returnflag", "split")


_VALID = f"""WITH {_LN1}, {_FILLED}, b AS (SELECT min(oq) - 0.2 * (max(oq) - min(oq)) AS ql, max(oq) + 0.2 * (max(oq) - min(oq)) AS qh, min(oe) - 0.2 * (max(oe) - min(oe)) AS el, max(oe) + 0.2 * (max(oe) - min(oe)) AS eh FROM fl)
SELECT *, n_imputed = n_valid AS all_valid FROM (SELECT 'l_quantity' AS "column", count(*)::BIGINT AS n_imputed, count(*) FILTER (l_quantity BETWEEN ql AND qh)::BIGINT AS n_valid FROM fl, b WHERE oq IS NULL
UNION ALL SELECT 'l_extendedprice', count(*)::BIGINT, count(*) FILTER (l_extendedprice BETWEEN el AND eh)::BIGINT FROM fl, b WHERE oe IS NULL
UNION ALL SELECT 'l_returnflag', count(*)::BIGINT, count(*) FILTER (l_returnflag IN (SELECT orf FROM fl))::BIGINT FROM fl WHERE orf IS NULL)"""


@query("validate_imputed", _VALID)
def _(s, d):
    return im.validate_imputed(lnu(s, d).select("row_id", *NUM, *CAT), filled(s, d), "row_id", NUM, CAT)


@query("validation_report", f"""WITH {_LN1}, {_FILLED} SELECT 'l_quantity' AS "column", count(*) FILTER (oq IS NULL)::BIGINT AS n_imputed, round(avg(oq), 4) AS obs_mean, round(stddev_samp(oq), 4) AS obs_std, round(avg(l_quantity) FILTER (oq IS NULL), 4) AS imp_mean FROM fl
UNION ALL SELECT 'l_extendedprice', count(*) FILTER (oe IS NULL)::BIGINT, round(avg(oe), 4), round(stddev_samp(oe), 4), round(avg(l_extendedprice) FILTER (oe IS NULL), 4) FROM fl
UNION ALL SELECT 'l_returnflag', count(*) FILTER (orf IS NULL)::BIGINT, NULL, NULL, NULL FROM fl""")
def _(s, d):
    r = im.validation_report(lnu(s, d).select("row_id", *NUM, *CAT), filled(s, d), "row_id", NUM, CAT)
    return r.select("column", "n_imputed", *(F.round(c, 4).alias(c) for c in ("obs_mean", "obs_std", "imp_mean")))


@query("validation_pass_rate", f"""WITH {_LN1}, b AS (SELECT min(l_quantity) - 0.2 * (max(l_quantity) - min(l_quantity)) AS lo, max(l_quantity) + 0.2 * (max(l_quantity) - min(l_quantity)) AS hi FROM ln)
SELECT 'l_quantity' AS "column", round(avg((l_linenumber * 20.0 BETWEEN lo AND hi)::INT), 6) AS pass_rate FROM ln, b WHERE l_quantity IS NULL UNION ALL SELECT 'l_returnflag', round(avg((l_linenumber % 2 = 0)::INT), 6) FROM ln WHERE l_returnflag IS NULL""")
def _(s, d):
    x = lnu(s, d)
    fills = {"l_quantity": F.coalesce("l_quantity", F.col("l_linenumber") * 20.0), "l_returnflag": F.coalesce("l_returnflag", F.when(F.col("l_linenumber") % 2 == 0, "A").otherwise("X"))}
    report = im.validate_imputed(x, x.withColumns(fills), "row_id", ["l_quantity"], ["l_returnflag"])
    return im.validation_pass_rate(report).withColumn("pass_rate", F.round("pass_rate", 6))


# scores: the hidden cells of ln's complete columns, filled with means and modes
_SCN, _SCC = ["l_discount", "l_tax"], ["l_linestatus"]
_SC_MASK = f"""mk AS (SELECT 'l_discount' AS "column", row_id FROM ln WHERE {u('row_id', 'd')} < 0.2 UNION ALL SELECT 'l_tax', row_id FROM ln WHERE {u('row_id', 't')} < 0.2 UNION ALL SELECT 'l_linestatus', row_id FROM ln WHERE {u('row_id', 's')} < 0.2)"""
_CELLS = f"""{_SC_MASK}, cell AS (SELECT c, k, tr, m, avg(CASE WHEN NOT m THEN tr END) OVER (PARTITION BY c) AS pr FROM (
  SELECT 'l_discount' AS c, row_id AS k, l_discount AS tr, row_id IN (SELECT row_id FROM mk WHERE "column" = 'l_discount') AS m FROM ln UNION ALL SELECT 'l_tax', row_id, l_tax, row_id IN (SELECT row_id FROM mk WHERE "column" = 'l_tax') FROM ln)),
num AS (SELECT c AS "column", count(*) FILTER (m)::BIGINT AS n_masked, avg(CASE WHEN m THEN abs(pr - tr) END) / stddev_pop(CASE WHEN NOT m THEN tr END) AS mae, sqrt(avg(CASE WHEN m THEN (pr - tr) * (pr - tr) END)) / stddev_pop(CASE WHEN NOT m THEN tr END) AS rmse FROM cell GROUP BY c),
cc AS (SELECT l_linestatus AS tr, CASE WHEN l_orderkey % 3 = 0 THEN 'O' ELSE 'F' END AS pr FROM ln WHERE row_id IN (SELECT row_id FROM mk WHERE "column" = 'l_linestatus')),
lab AS (SELECT v, (SELECT count(*) FROM cc WHERE tr = v) AS t, (SELECT count(*) FROM cc WHERE pr = v) AS p, (SELECT count(*) FROM cc WHERE pr = v AND tr = v) AS h FROM (SELECT tr AS v FROM cc UNION SELECT pr FROM cc)),
cat AS (SELECT 'l_linestatus' AS "column", sum(t)::BIGINT AS n_masked, sum(h) / sum(t) AS accuracy, avg(CASE WHEN t > 0 THEN h / t END) AS balanced_accuracy, avg(2 * h / (t + p)) AS macro_f1 FROM lab)"""


def _score_frames(s, d):
    x = lnu(s, d).select("row_id", *_SCN, *_SCC, "l_orderkey")
    m = None
    for c, k in (("l_discount", "d"), ("l_tax", "t"), ("l_linestatus", "s")):
        part = x.filter(sp.unit_hash(F.col("row_id"), k) < 0.2).select(F.lit(c).alias("column"), "row_id")
        m = part if m is None else m.unionByName(part)
    truth = x.drop("l_orderkey")
    guess = F.when(F.col("l_orderkey") % 3 == 0, "O").otherwise("F")
    pred = im.mean_fill(sp.apply_mask(truth, m, "row_id"), _SCN).join(x.select("row_id", "l_orderkey"), "row_id").withColumn("l_linestatus", F.coalesce("l_linestatus", guess)).drop("l_orderkey")
    return truth, pred, m


@query("score_numeric", f"""WITH {_LN1}, {_CELLS} SELECT "column", n_masked, round(mae, 6) AS mae, round(rmse, 6) AS rmse FROM num""")
def _(s, d):
    r = im.score_numeric(im.masked_rows(*_score_frames(s, d), "row_id", _SCN), _SCN)
    return r.select("column", "n_masked", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"))


@query("score_categorical", f"""WITH {_LN1}, {_CELLS} SELECT "column", n_masked, round(accuracy, 6) AS accuracy, round(balanced_accuracy, 6) AS balanced_accuracy, round(macro_f1, 6) AS macro_f1 FROM cat""")
def _(s, d):
    r = im.score_categorical(im.masked_rows(*_score_frames(s, d), "row_id", _SCC), _SCC)
    return r.select("column", "n_masked", *(F.round(c, 6).alias(c) for c in ("accuracy", "balanced_accuracy", "macro_f1")))


_SUMMARY = f"WITH {_LN1}, {_CELLS} SELECT (SELECT round(avg(mae), 6) FROM num) AS macro_mae, (SELECT round(avg(rmse), 6) FROM num) AS macro_rmse, (SELECT round(balanced_accuracy, 6) FROM cat) AS macro_balanced_accuracy, (SELECT round((avg(rmse) + 1 - (SELECT balanced_accuracy FROM cat)) / 2, 6) FROM num) AS objective"


@query("score_masked", _SUMMARY)
def _(s, d):
    _, summary = im.score_masked(*_score_frames(s, d), "row_id", _SCN, _SCC)
    return summary.select(*(F.round(c, 6).alias(c) for c in ("macro_mae", "macro_rmse", "macro_balanced_accuracy", "objective")))


@query("write_mask_scores", f"""WITH {_LN1}, {_CELLS} SELECT "column", 'mae' AS metric, round(mae, 6) AS value FROM num UNION ALL SELECT "column", 'rmse', round(rmse, 6) FROM num
UNION ALL SELECT "column", 'accuracy', round(accuracy, 6) FROM cat UNION ALL SELECT "column", 'balanced_accuracy', round(balanced_accuracy, 6) FROM cat UNION ALL SELECT "column", 'macro_f1', round(macro_f1, 6) FROM cat""")
def _(s, d):
    long, _ = im.score_masked(*_score_frames(s, d), "row_id", _SCN, _SCC)
    return long.withColumn("value", F.round("value", 6))


def _means(frame):
    return im.mode_fill(im.mean_fill(frame, _SCN), _SCC)


def _objective(mechanism: str, seed: int, fill: str) -> str:
    """A scalar subquery: the objective of one fill under one mask of the complete columns."""
    hidden = lambda c: f"""row_id IN (SELECT row_id FROM mk WHERE "column" = '{c}') AS m"""
    cells = " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS tr, {hidden(c)} FROM ln" for c in _SCN)
    number = "avg(CASE WHEN NOT m THEN tr END) OVER (PARTITION BY c)" if fill == "means" else "0.0"
    level = "(SELECT v FROM lv WHERE NOT m GROUP BY v ORDER BY count(*) DESC, v LIMIT 1)" if fill == "means" else "'F'"
    return f"""(WITH mk AS ({_mask_sql(mechanism, seed, features=[*_SCN, *_SCC])}), cell AS (SELECT c, tr, m, {number} AS pr FROM ({cells})),
  num AS (SELECT sqrt(avg((pr - tr) * (pr - tr)) FILTER (m)) / stddev_pop(tr) FILTER (NOT m) AS rmse FROM cell GROUP BY c), lv AS (SELECT l_linestatus AS v, {hidden('l_linestatus')} FROM ln)
  SELECT (avg(rmse) + 1 - (SELECT avg((v = {level})::INT) FROM (SELECT DISTINCT v FROM lv WHERE m))) / 2 FROM num)"""


_BENCHMARK = " UNION ALL ".join(
    f"SELECT '{fill}' AS candidate, '{m}' AS mechanism, 0 AS mask_index, round({_objective(m, seed, fill)}, 6) AS objective"
    for fill in ("means", "zeros") for m, seed in (("mcar", 7), ("mnar", 10007))
)


@query("masked_benchmark", f"WITH {_LN1} {_BENCHMARK}")
def _(s, d):
    x = lnu(s, d).select("row_id", *_SCN, *_SCC)
    masks = sp.hidden_grid(x, "row_id", [*_SCN, *_SCC], ["mcar", "mnar"], 1, 7)
    zero = lambda f: f.fillna(0.0, _SCN).fillna("F", _SCC)
    return im.masked_benchmark(x, "row_id", _SCN, _SCC, masks, {"means": _means, "zeros": zero}).withColumn("objective", F.round("objective", 6))


@query("benchmark_objective", f"WITH {_LN1} SELECT 'means' AS candidate, round(({_objective('mcar', 7, 'means')} + {_objective('mcar', 8, 'means')}) / 2, 6) AS objective, 2::BIGINT AS n_masks")
def _(s, d):
    x = lnu(s, d).select("row_id", *_SCN, *_SCC)
    masks = sp.hidden_grid(x, "row_id", [*_SCN, *_SCC], ["mcar"], 2, 7)
    done = im.masked_benchmark(x, "row_id", _SCN, _SCC, masks, {"means": _means})
    return im.benchmark_objective(done).withColumn("objective", F.round("objective", 6))
