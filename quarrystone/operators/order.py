"""Order statistics of columns that no single task could sort.

Values are dealt into buckets between cut points (a bounded number of them, taken from
the data), summed and numbered inside their buckets, and shifted by the totals of the
buckets before. Counting distinct values first makes a frequent value one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from quarrystone.functions.session import checkpointed

BUCKETS = 64
#: Values looked at to find cut points where they aren't numbers.
CUT_SAMPLE = 4096


def _bucketed(rows: DataFrame, keys: list[str], value: str, cuts: DataFrame) -> DataFrame:
    """rows with _b, the number of cut points below the value; ``cuts`` has the keys and an array _cuts."""
    both = rows.join(F.broadcast(cuts), keys) if keys else rows.crossJoin(F.broadcast(cuts))
    return both.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")


def running(counts: DataFrame, keys: list[str], value: str, sums: list[str]) -> DataFrame:
    """counts with cum_<x> for each of ``sums``, the total of x up to this value within the keys, all_<x>, their total, and ``next``, the value after it.

    ``counts`` has a row for each (keys, value), the value a double; it is computed once. There are to be no more
    keys than a table of columns and models has; BUCKETS cut points for each of them go over the driver.
    """
    counts = checkpointed(counts)
    spark, schema = counts.sparkSession, StructType([*(counts.schema[k] for k in keys), StructField("_cuts", ArrayType(counts.schema[value].dataType))])
    points = F.percentile_approx(value, [i / BUCKETS for i in range(1, BUCKETS)], 1000).alias("_cuts")
    cuts = spark.createDataFrame((counts.groupBy(*keys) if keys else counts).agg(points).filter("_cuts IS NOT NULL").collect(), schema)
    rows = _bucketed(counts, keys, value, cuts)
    totals = rows.groupBy(*keys, "_b").agg(*(F.sum(x).alias(f"_t_{x}") for x in sums), F.min(value).alias("_first"))
    buckets, every = W.partitionBy(*keys).orderBy("_b"), W.partitionBy(*keys)
    before = buckets.rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        *keys, "_b", *(F.coalesce(F.sum(f"_t_{x}").over(before), F.lit(0)).alias(f"_o_{x}") for x in sums), *(F.sum(f"_t_{x}").over(every).alias(f"all_{x}") for x in sums), F.lead("_first").over(buckets).alias("_after")
    )  # BUCKETS rows for each key
    inside = W.partitionBy(*keys, "_b").orderBy(value)
    rows = rows.withColumns({f"cum_{x}": F.sum(x).over(inside.rowsBetween(W.unboundedPreceding, 0)) for x in sums} | {"next": F.lead(value).over(inside)})
    rows = rows.join(F.broadcast(shifts), [*keys, "_b"])
    rows = rows.withColumns({f"cum_{x}": F.col(f"cum_{x}") + F.col(f"_o_{x}") for x in sums} | {"next": F.coalesce("next", "_after")})
    return rows.select(*counts.columns, *(f"cum_{x}" for x in sums), *(f"all_{x}" for x in sums), "next")


def cumulative(df: DataFrame, order: list[str], amount: str, name: str) -> DataFrame:
    """df with ``name``, the total of ``amount`` (whole numbers, not null) up to each row in the order of columns that sort, nulls first.

    Rows are range-partitioned, so that no task has more than its range; the ranges' totals (one
    number for each partition) are broadcast. Rows that are equal in ``order`` follow each other in some way.
    """
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shifts = ranged.groupBy("_range").agg(F.sum(amount).alias("_t")).select("_range", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_o"))
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return ranged.withColumn(name, F.sum(amount).over(inside)).join(F.broadcast(shifts), "_range").withColumn(name, F.col(name) + F.col("_o")).select(*df.columns, name)


def quantiles(df: DataFrame, column: str, shares: list[float], keys: list[str] = ()) -> DataFrame:
    """(keys, share, value): exact quantiles, between two values by linear interpolation; nulls are left out."""
    keys = list(keys)
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    rows = running(counts, keys, "v", ["n"]).withColumnRenamed("all_n", "_all")
    place = lambda s: F.lit(s) * (F.col("_all") - 1)
    asked = lambda s, at, weight: F.struct(F.lit(s).alias("share"), at.cast("bigint").alias("at"), weight.alias("w"))
    ends = F.array(*(x for s in shares for x in (asked(s, F.floor(place(s)), 1 - (place(s) - F.floor(place(s)))), asked(s, F.ceil(place(s)), place(s) - F.floor(place(s))))))
    here = F.filter(ends, lambda a: (a["at"] >= F.col("cum_n") - F.col("n")) & (a["at"] < F.col("cum_n")))
    hits = rows.select(*keys, "v", F.explode(here).alias("a"))
    return hits.groupBy(*keys, F.col("a.share").alias("share")).agg(F.sum(F.col("v") * F.col("a.w")).alias("value"))


def number_values(values: DataFrame, column: str = "value", name: str = "code") -> DataFrame:
    """Distinct values of any type that sorts, numbered from 0 in their order."""
    spark, kind = values.sparkSession, values.schema[column].dataType
    sample = sorted(r[0] for r in values.select(column).orderBy(F.xxhash64(column), column).limit(CUT_SAMPLE).collect())
    if len(sample) < CUT_SAMPLE:  # these are all
        return spark.createDataFrame(list(enumerate(sample)), StructType().add(name, "integer").add(column, kind)).select(column, name)
    cuts = spark.createDataFrame([(sample[:: CUT_SAMPLE // BUCKETS][1:],)], StructType().add("_cuts", ArrayType(kind)))
    rows = _bucketed(values.select(column), [], column, cuts)
    sizes = rows.groupBy("_b").agg(F.count("*").alias("_n"))  # BUCKETS rows
    shifts = sizes.select("_b", F.coalesce(F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    inside = F.row_number().over(W.partitionBy("_b").orderBy(column)) - 1
    return rows.withColumn("_i", inside).join(F.broadcast(shifts), "_b").select(column, (F.col("_i") + F.col("_o")).cast("int").alias(name))
