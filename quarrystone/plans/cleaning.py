"""Queries of column cleaning and typing."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.operators import clean as c
from quarrystone.plans.catalog import CAND, LI, LN, cand, li, ln, query, t

PRIORITY = {"o_orderpriority": ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]}
_PRI = "['5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT']"
EDGES = [1, 10, 20, 30, 40, 50]
_BIN = """CASE WHEN l_quantity >= 1 AND l_quantity <= 10 THEN '1-10' WHEN l_quantity > 10 AND l_quantity <= 20 THEN '11-20' WHEN l_quantity > 20 AND l_quantity <= 30 THEN '21-30'
  WHEN l_quantity > 30 AND l_quantity <= 40 THEN '31-40' WHEN l_quantity > 40 AND l_quantity <= 50 THEN '41-50' ELSE 'OutOfRange' END"""


@query("uppercase_columns", 'SELECT n_nationkey AS "N_NATIONKEY", n_name AS "N_NAME", n_regionkey AS "N_REGIONKEY" FROM nation')
def _(s, d):
    return c.uppercase_columns(t(s, d, "nation"))


@query("drop_columns", "SELECT * EXCLUDE (l_shipdate, l_tax) FROM lineitem")
def _(s, d):
    return c.drop_columns(t(s, d, "lineitem"), ["l_shipdate", "l_tax", "no_such_column"])


@query("rename_target", "SELECT o_orderkey, o_custkey, o_orderstatus AS target, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def _(s, d):
    return c.rename_target(t(s, d, "orders"), "o_orderstatus", "target")


@query("remap_binary_one_two", "SELECT o_orderkey, o_orderkey % 2 AS flag, o_custkey FROM orders")
def _(s, d):
    return c.remap_binary_one_two(t(s, d, "orders").select("o_orderkey", (1 + F.col("o_orderkey") % 2).alias("flag"), "o_custkey"))


@query("drop_missing_target", f"WITH {LN} SELECT * FROM ln WHERE l_returnflag IS NOT NULL")
def _(s, d):
    return c.drop_missing_target(ln(s, d), "l_returnflag")


@query("infer_nominal", """SELECT 'p_brand' AS "column", true AS nominal UNION ALL SELECT 'p_name', true UNION ALL SELECT 'p_type', true
UNION ALL SELECT 'p_partkey', count(DISTINCT p_partkey) <= 10 FROM part UNION ALL SELECT 'p_size', count(DISTINCT p_size) <= 10 FROM part UNION ALL SELECT 'p_retailprice', count(DISTINCT p_retailprice) <= 10 FROM part""")
def _(s, d):
    return c.infer_nominal(t(s, d, "part"))


@query("encode_ordinal", f"SELECT o_orderkey, (list_position({_PRI}, o_orderpriority) - 1)::DOUBLE AS o_orderpriority FROM orders")
def _(s, d):
    return c.encode_ordinal(t(s, d, "orders").select("o_orderkey", "o_orderpriority"), PRIORITY)


@query("decode_ordinal", "SELECT o_orderkey, o_orderpriority FROM orders")
def _(s, d):
    return c.decode_ordinal(c.encode_ordinal(t(s, d, "orders").select("o_orderkey", "o_orderpriority"), PRIORITY), PRIORITY)


@query("non_numeric_features", """SELECT 'lang' AS "column", count(*) FILTER (try_cast(lang AS DOUBLE) IS NULL)::BIGINT AS n_bad FROM documents
UNION ALL SELECT 'source', count(*) FILTER (try_cast(source AS DOUBLE) IS NULL)::BIGINT FROM documents""")
def _(s, d):
    return c.non_numeric_features(t(s, d, "documents"), ["doc_id", "lang", "source", "n_chars"])


@query("cast_integer_like", "SELECT l_orderkey, l_quantity::BIGINT AS l_quantity, l_discount, l_returnflag FROM lineitem")
def _(s, d):
    return c.cast_integer_like(t(s, d, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag"), ["l_quantity", "l_discount", "l_returnflag", "absent"])


@query("label_encode", f"WITH {LI}, v AS (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag)::INT - 1 AS c FROM (SELECT DISTINCT l_returnflag FROM li)) SELECT row_id, c AS l_returnflag FROM li LEFT JOIN v USING (l_returnflag)")
def _(s, d):
    return c.label_encode(li(s, d).select("row_id", "l_returnflag"), ["l_returnflag"])


@query("label_decode", f"WITH {LI} SELECT row_id, ['A', 'N', 'R'][greatest(0, least(2, round_even(l_discount * 40, 0)::INT)) + 1] AS code FROM li")
def _(s, d):
    return c.label_decode(li(s, d).select("row_id", (F.col("l_discount") * 40).alias("code")), {"code": ["A", "N", "R"], "absent": ["x"]})


@query("mask_outliers", """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey = 0 THEN 1e9 ELSE o_totalprice END AS p FROM orders), m AS (SELECT avg(p) AS a, stddev_samp(p) AS z FROM o)
SELECT o_orderkey, CASE WHEN abs(p - a) / z > 3 THEN NULL ELSE p END AS p FROM o, m""")
def _(s, d):
    o = t(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") == 0, 1e9).otherwise(F.col("o_totalprice")).alias("p"))
    return c.mask_outliers(o, ["p"])


@query("round_columns", f"WITH {LI} SELECT row_id, round_even(l_discount * 10, 1) AS d, round_even(l_quantity / 4, 0)::BIGINT AS q, l_returnflag FROM li")
def _(s, d):
    return c.round_columns(li(s, d).select("row_id", (F.col("l_discount") * 10).alias("d"), (F.col("l_quantity") / 4).alias("q"), "l_returnflag"), {"d": 1})


@query("complete_cases", f"WITH {LN} SELECT * FROM ln WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL AND l_returnflag IS NOT NULL")
def _(s, d):
    return c.complete_cases(ln(s, d))


_BRANDS = "v AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand)::INT - 1 AS c FROM (SELECT DISTINCT p_brand FROM part))"


def _n_brands(p):
    return p.agg(F.count_distinct("p_brand")).first()[0]


@query("encode_bits", f"WITH {_BRANDS} SELECT p_partkey, p_brand, (c & 1)::INT AS p_brand_b0, ((c >> 1) & 1)::INT AS p_brand_b1, ((c >> 2) & 1)::INT AS p_brand_b2, ((c >> 3) & 1)::INT AS p_brand_b3, ((c >> 4) & 1)::INT AS p_brand_b4 FROM part JOIN v USING (p_brand)")
def _(s, d):
    p = t(s, d, "part").select("p_partkey", "p_brand")
    return c.encode_bits(p, "p_brand", _n_brands(p))


@query("decode_bits", "SELECT p_partkey, ['a','b','c','d','e','f'][CASE p_size % 8 WHEN 6 THEN 3 WHEN 7 THEN 4 ELSE p_size % 8 + 1 END] AS decoded, p_size % 8 >= 6 AS invalid FROM part")
def _(s, d):
    bit = lambda k: F.shiftright(F.col("p_size"), k).bitwiseAND(1).cast("double")
    p = t(s, d, "part").select("p_partkey", bit(0).alias("b0"), bit(1).alias("b1"), bit(2).alias("b2"))
    return c.decode_bits(p, ["b0", "b1", "b2"], list("abcdef"), "nearest_valid").select("p_partkey", "decoded", "invalid")


@query("decode_diagnostics", """SELECT * FROM (SELECT 'brand' AS "column", count(*)::BIGINT AS n_rows, 20 AS n_categories, count(*) FILTER (p_size % 32 >= 20)::BIGINT AS n_invalid, round(avg((p_size % 32 >= 20)::INT), 6) AS invalid_rate, 'clip' AS policy FROM part
UNION ALL SELECT 'kind', count(*)::BIGINT, 3, count(*) FILTER (p_partkey % 4 >= 3)::BIGINT, round(avg((p_partkey % 4 >= 3)::INT), 6), 'clip' FROM part) WHERE n_invalid > 0""")
def _(s, d):
    bit = lambda c, k: F.shiftright(F.col(c).cast("int"), k).bitwiseAND(1)
    x = t(s, d, "part").select(*(bit("p_size", k).alias(f"b{k}") for k in range(5)), *(bit("p_partkey", k).alias(f"k{k}") for k in range(2)))
    bits = {"brand": [f"b{k}" for k in range(5)], "kind": ["k0", "k1"], "whole": ["k0"]}
    return c.decode_diagnostics(x, bits, {"brand": 20, "kind": 3, "whole": 2}).withColumn("invalid_rate", F.round("invalid_rate", 6))


@query("standardize", f"WITH {LN}, m AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS z FROM ln) SELECT row_id, round((l_quantity - a) / z / 2, 6) AS q FROM ln, m")
def _(s, d):
    return c.standardize(ln(s, d).select("row_id", F.col("l_quantity").alias("q")), ["q"]).select("row_id", F.round("q", 6).alias("q"))


@query("destandardize", f"WITH {LN} SELECT row_id, round(l_quantity, 6) AS q FROM ln")
def _(s, d):
    x = ln(s, d).select("row_id", F.col("l_quantity").alias("q"))
    stats = c.scale_stats(x, ["q"])
    return c.destandardize(c.standardize(x, ["q"], stats), ["q"], stats).select("row_id", F.round("q", 6).alias("q"))


@query("binary_target", "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END AS o_orderstatus FROM orders")
def _(s, d):
    return c.binary_target(t(s, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O"], ["P"])


@query("align_dtypes", f"WITH {LI} SELECT row_id, l_quantity, try_cast(l_returnflag AS DOUBLE) AS l_discount FROM li")
def _(s, d):
    x = li(s, d)
    return c.align_dtypes(x.select("row_id", F.col("l_quantity").cast("string").alias("l_quantity"), F.col("l_returnflag").alias("l_discount")), x)


@query("map_labels", f"WITH {LN} SELECT row_id, CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE coalesce(l_returnflag, 'nan') END AS label FROM ln")
def _(s, d):
    return ln(s, d).select("row_id", c.map_labels("l_returnflag", {"A": "accepted", "R": "returned"}).alias("label"))


@query("bin_column", f"WITH {LN} SELECT row_id, {_BIN} AS bin FROM ln")
def _(s, d):
    return ln(s, d).select("row_id", c.bin_column("l_quantity", EDGES).alias("bin"))


@query("prepare_groups", f'WITH {LI} SELECT row_id, l_returnflag AS "TARGET_LABEL", l_linestatus AS "l_linestatus__GROUP", {_BIN} AS "l_quantity__GROUP" FROM li')
def _(s, d):
    x = li(s, d).select("row_id", "l_returnflag", "l_linestatus", "l_quantity")
    return c.prepare_groups(x, "l_returnflag", ["l_linestatus", "l_quantity"], bins={"l_quantity": EDGES}).select("row_id", "TARGET_LABEL", "l_linestatus__GROUP", "l_quantity__GROUP")


@query("numeric_codes_for_counting", "SELECT round_even(p_size / 4, 0)::INT AS code, count(*)::BIGINT AS n FROM part GROUP BY 1")
def _(s, d):
    p = t(s, d, "part").select((F.col("p_size") / 4).alias("x"))
    return p.groupBy(c.numeric_codes_for_counting(p, "x").alias("code")).agg(F.count("*").alias("n"))


@query("clip_label", f"WITH {LI} SELECT row_id, greatest(0, least(2, l_linenumber - 2))::INT AS label FROM li")
def _(s, d):
    return li(s, d).withColumn("k", F.col("l_linenumber") - 2).select("row_id", c.clip_label("k", 3).cast("int").alias("label"))


@query("select_models", f"WITH {LI}, {CAND} SELECT model, row_id FROM cand WHERE model = 'cand_b'")
def _(s, d):
    return c.select_models(cand(s, d), ["cand_b", "absent"]).select("model", "row_id")


@query("missing_models", f"WITH {LI}, {CAND} SELECT m AS model FROM (VALUES ('cand_b'), ('absent')) AS v(m) WHERE m NOT IN (SELECT model FROM cand)")
def _(s, d):
    return c.missing_models(cand(s, d), ["cand_b", "absent"])


@query("infer_binary_columns", """SELECT 'quality' AS "column" FROM labels HAVING bool_and(quality IN (0, 1)) UNION ALL SELECT 'doc_id' FROM labels HAVING bool_and(doc_id IN (0, 1))""")
def _(s, d):
    return c.infer_binary_columns(t(s, d, "labels"), "toxic")


@query("distinct_profile", """SELECT 'l_quantity' AS "column", count(DISTINCT l_quantity)::BIGINT AS n_distinct, count(*) FILTER (l_quantity IS NULL)::BIGINT AS n_null, min(l_quantity)::VARCHAR AS low, max(l_quantity)::VARCHAR AS high FROM lineitem
UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag)::BIGINT, count(*) FILTER (l_returnflag IS NULL)::BIGINT, min(l_returnflag), max(l_returnflag) FROM lineitem""")
def _(s, d):
    return c.distinct_profile(t(s, d, "lineitem"), ["l_quantity", "l_returnflag"])
