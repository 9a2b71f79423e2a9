"""Where queries are registered: a callable on (spark, sf_dir), and its DuckDB text if SQL can state it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from quarrystone.functions.session import small

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: A row key of lineitem that is unique at every size.
ROW_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint))"
_M = "((l_partkey * 31 + l_linenumber * 7 + l_orderkey) % 10)"
#: lineitem with a row key; with missing values made by rule; real and candidate rows.
LI = f"li AS (SELECT *, {ROW_ID} AS row_id FROM lineitem)"
LN = f"""ln AS (SELECT {ROW_ID} AS row_id, l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN {_M} = 4 THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN {_M} < 3 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
  l_discount, l_tax, CASE WHEN {_M} = 5 THEN NULL ELSE l_returnflag END AS l_returnflag, l_linestatus FROM lineitem)"""
#: Rows that share a key are told apart by a number, so that none is lost where a key has to be unique.
_TIES = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LU = f"(SELECT * EXCLUDE (row_id), row_id || '-' || row_number() OVER (PARTITION BY row_id ORDER BY {', '.join(_TIES)}) AS row_id FROM (SELECT *, {ROW_ID} AS row_id FROM lineitem))"
LI1 = f"li AS (SELECT * FROM {_LU})"
LN1 = LN.replace(f"{ROW_ID} AS row_id", "row_id").replace("FROM lineitem", f"FROM {_LU}")
CAND = """cand AS (SELECT 'cand_a' AS model, * FROM li WHERE l_orderkey % 2 = 1
  UNION ALL SELECT 'cand_b' AS model, * FROM li WHERE l_orderkey % 2 = 1 AND NOT (l_returnflag = 'R' AND l_orderkey % 3 = 0))"""
REAL = "rl AS (SELECT * FROM li WHERE l_orderkey % 2 = 0)"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql.strip()
        return f

    return register


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def li(spark, d) -> DataFrame:
    return t(spark, d, "lineitem").withColumn("row_id", F.expr(ROW_ID))


def unique_li(spark, d) -> DataFrame:
    """lineitem with numbered row keys; only rows whose key repeats, found by a hash of it, are shuffled to be numbered."""
    rows, h = li(spark, d), F.xxhash64("row_id").alias("_h")
    repeated = small(rows.groupBy(h).agg(F.count("*").alias("_n")).filter("_n > 1").select("_h"))
    alone = lambda df: df.withColumn("row_id", F.concat_ws("-", "row_id", F.lit("1")))
    if repeated.isEmpty():
        return alone(rows)
    hashed, place = rows.withColumn("_h", h), F.row_number().over(W.partitionBy("row_id").orderBy(*_TIES))
    again = hashed.join(repeated, "_h", "left_semi").withColumn("row_id", F.concat_ws("-", "row_id", place))
    return alone(hashed.join(repeated, "_h", "left_anti")).unionByName(again).drop("_h")


def ln(spark, d, rows: DataFrame | None = None) -> DataFrame:
    x = li(spark, d) if rows is None else rows
    m = F.expr(_M)
    return x.select("row_id", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(m != 4, F.col("l_quantity")).alias("l_quantity"), F.when(m >= 3, F.col("l_extendedprice")).alias("l_extendedprice"), "l_discount", "l_tax", F.when(m != 5, F.col("l_returnflag")).alias("l_returnflag"), "l_linestatus")


def real(spark, d) -> DataFrame:
    return li(spark, d).filter("l_orderkey % 2 = 0")


def cand(spark, d) -> DataFrame:
    odd = li(spark, d).filter("l_orderkey % 2 = 1")
    b = odd.filter("NOT (l_returnflag = 'R' AND l_orderkey % 3 = 0)")
    return odd.withColumn("model", F.lit("cand_a")).unionByName(b.withColumn("model", F.lit("cand_b")))
