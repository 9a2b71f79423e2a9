"""Column cleaning: names, types, codes, bins and scales.

Statistics that a column operation needs are computed as one-row (or one row per
distinct value) tables and joined back by broadcast; their size doesn't depend on
the number of rows. Nothing is collected except where a result's schema hangs on it.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quarrystone.functions.session import BROADCAST_BYTES, BROADCAST_ROWS, checkpointed
from quarrystone.operators.order import cumulative, number_values

#: Values of the columns of a type that are sorted on the driver rather than by ranges.
SORTED_HERE = 4096
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, NUMERIC)


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Every row beside the one row of ``stats``."""
    return df.crossJoin(F.broadcast(stats))


def uppercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


def rename_target(df: DataFrame, raw: str, target: str) -> DataFrame:
    return df.withColumnRenamed(raw, target)


def remap_binary_one_two(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns whose non-null values are exactly 1 and 2 become 0 and 1."""
    columns = columns or [c for c in df.columns if is_numeric(df, c)]
    flag = lambda c: (F.min(c) == 1) & (F.max(c) == 2) & (F.count_if(~F.col(c).isin(1, 2)) == 0)
    stats = df.agg(*(flag(c).alias(f"_is_{c}") for c in columns))
    return with_stats(df, stats).select(*(F.when(F.col(f"_is_{c}"), F.col(c) - 1).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(F.col(target).isNotNull())


def infer_nominal(df: DataFrame, explicit: list[str] = (), ordinal: list[str] = (), limit: int = 10) -> DataFrame:
    """(column, nominal): named, or text or boolean, or of few distinct values; ordinal columns aren't."""
    columns = [c for c in df.columns if c not in ordinal]
    counts = df.agg(*(F.count_distinct(c).alias(c) for c in columns))
    rows = counts.unpivot([], columns, "column", "n")
    by_type = [c for c in columns if c in explicit or isinstance(df.schema[c].dataType, (T.StringType, T.BooleanType))]
    return rows.select("column", (F.col("column").isin(by_type) | (F.col("n") <= limit)).alias("nominal"))


def unknown_values(df: DataFrame, orders: dict[str, list[str]]) -> DataFrame:
    """(column, value) of values that no declared order holds; nulls are fine."""
    parts = [df.filter(~F.col(c).isin(order)).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")).distinct() for c, order in orders.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _raise_if_any(rows: DataFrame, message: str) -> None:
    found = rows.limit(5).collect()
    if found:
        raise ValueError(f"{message}: {[tuple(r) for r in found]}")


def encode_ordinal(df: DataFrame, orders: dict[str, list[str]], strict: bool = True) -> DataFrame:
    """Labels become 0-based codes (double); null stays null. An unknown label is an error if strict."""
    absent = [c for c in orders if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns: {absent}")
    if strict:
        _raise_if_any(unknown_values(df, orders), "values outside the declared order")
    code = lambda c: F.nullif(F.array_position(F.array(*map(F.lit, orders[c])), F.col(c)), F.lit(0)) - 1
    return df.withColumns({c: code(c).cast("double") for c in orders})


def decode_ordinal(df: DataFrame, orders: dict[str, list[str]], strict: bool = True) -> DataFrame:
    """Codes become labels; null stays null. A code that isn't whole or in range is an error if strict."""
    if strict:
        for c, order in orders.items():
            number = F.expr(f"try_cast(`{c}` as double)")
            _raise_if_any(df.filter(F.col(c).isNotNull() & (number.isNull() | (number % 1 != 0) | (number < 0) | (number >= len(order)))).select(c).distinct(), f"codes of {c} out of range")
    return df.withColumns({c: F.get(F.array(*map(F.lit, o)), F.col(c).cast("int")) for c, o in orders.items()})


def non_numeric_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_bad): columns assumed numeric that hold values that aren't."""
    counts = df.agg(*(F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(cast(`{c}` as string) as double)").isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column", "n_bad").filter("n_bad > 0")


def cast_integer_like(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns without nulls and fractions become bigint; others stay."""
    columns = [c for c in columns if c in df.columns and is_numeric(df, c)]
    if not columns:
        return df
    whole = df.agg(*(F.bool_and(F.col(c).isNotNull() & (F.col(c) % 1 == 0)).alias(c) for c in columns)).first()
    return df.withColumns({c: F.col(c).cast("bigint") for c in columns if whole[c]})


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): distinct values in order, numbered from 0."""
    return number_values(df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct())


def label_tables(df: DataFrame, columns: list[str]) -> list[tuple[list[str], DataFrame]]:
    """Codes of all columns' values, a table (column, value, code) for each data type; a column goes by its place in ``columns``.

    Values are numbered from 0 in their order. All columns of a type are stacked and numbered in one pass.
    """
    out = []
    for kind in dict.fromkeys(df.schema[c].dataType for c in columns):
        own = [c for c in columns if df.schema[c].dataType == kind]
        names = [str(columns.index(c)) for c in own]
        long = df.select(*(F.col(c).alias(n) for c, n in zip(own, names))).unpivot([], names, "column", "value")
        values = checkpointed(long.filter("value IS NOT NULL").distinct())
        few = values.limit(SORTED_HERE + 1).collect()
        if len(few) <= SORTED_HERE:  # these are all
            by: dict[str, list] = {}
            for r in few:
                by.setdefault(r["column"], []).append(r["value"])
            rows = [(n, v, i) for n, of in by.items() for i, v in enumerate(sorted(of))]
            out.append((own, df.sparkSession.createDataFrame(rows, T.StructType().add("column", "string").add("value", kind).add("code", "integer"))))
            continue
        placed = cumulative(values.withColumn("_one", F.lit(1).cast("bigint")), ["column", "value"], "_one", "_cum")
        first = placed.groupBy("column").agg(F.min("_cum").alias("_first"))  # a row for each column
        out.append((own, checkpointed(placed.join(F.broadcast(first), "column").select("column", "value", (F.col("_cum") - F.col("_first")).cast("int").alias("code")))))
    return out


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each value's place among its column's distinct values in order, from 0; null stays null.

    The codes of all columns are made first and from ``df`` itself; then each column is joined with its
    own, by broadcast up to BROADCAST_ROWS values, so the plan grows by one join a column.
    """
    names, rows = df.columns, df
    for own, codes in label_tables(df, columns):
        sizes = {r["column"]: (r["n"], r["b"]) for r in codes.groupBy("column").agg(F.count("*").alias("n"), F.sum(F.octet_length(F.col("value").cast("string"))).alias("b")).collect()}
        for c in own:
            place = str(columns.index(c))
            n, size = sizes.get(place, (0, 0))
            table = codes.filter(F.col("column") == place).select(F.col("value").alias(f"_v_{place}"), F.col("code").alias(f"_c_{place}"))
            rows = rows.join(F.broadcast(table) if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else table, F.col(c) == F.col(f"_v_{place}"), "left")
    return rows.select(*(F.col(f"_c_{columns.index(c)}").alias(c) if c in columns else F.col(c) for c in names))


def label_decode(df: DataFrame, maps: dict[str, list]) -> DataFrame:
    """Codes, rounded half to even and clipped to the range, become labels; absent columns are skipped."""
    index = lambda c, n: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.bround(c, 0).cast("int")))
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.get(F.array(*map(F.lit, v)), index(c, len(v)))) for c, v in maps.items() if c in df.columns})


def mask_outliers(df: DataFrame, columns: list[str], z: float = 3.0) -> DataFrame:
    """Null where a value lies over z sample standard deviations off the mean; one pass, constants stay."""
    columns = [c for c in columns if is_numeric(df, c)]
    stats = df.agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))))
    out = lambda c: (F.col(f"_s_{c}") > 0) & (F.abs(F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") > z)
    return with_stats(df, stats).select(*(F.when(~F.coalesce(out(c), F.lit(False)), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def round_columns(df: DataFrame, rules: dict[str, int], columns: list[str] | None = None) -> DataFrame:
    """Half-even rounding to the decimals of ``rules``, other numeric columns to whole numbers."""
    columns = columns or [c for c in df.columns if is_numeric(df, c)]
    return df.withColumns({c: F.bround(c, rules[c]) if c in rules else F.bround(c, 0).cast("bigint") for c in columns if is_numeric(df, c)})


def complete_cases(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null or NaN in the columns, all by default.

    A condition for each column: from a single one over all of them the optimiser derives new ones for every
    subset of columns that were computed below, which takes forever from some 20 columns on.
    """
    real = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    full = lambda c: quoted(c).isNotNull() & ~F.isnan(quoted(c)) if c in real else quoted(c).isNotNull()
    tests = [full(c) for c in (df.columns if columns is None else columns)]
    while len(tests) > 1:  # pair by pair, so that the expression stays flat
        tests = [x & tests[i + 1] if i + 1 < len(tests) else x for i, x in enumerate(tests) if i % 2 == 0]
    return df.filter(tests[0]) if tests else df


def bit_width(n: int) -> int:
    return max(1, ceil(log2(n))) if n > 1 else 1


def encode_bits(df: DataFrame, column: str, n: int) -> DataFrame:
    """A category's code in the order of its values, as bit columns <column>_b0 (lowest) and so on."""
    coded = label_encode(df.withColumn("_code", F.col(column)), ["_code"])
    return coded.withColumns({f"{column}_b{k}": F.shiftright("_code", k).bitwiseAND(1).cast("int") for k in range(bit_width(n))}).drop("_code")


def decode_bits(df: DataFrame, bits: list[str], values: list[str], policy: str = "clip", column: str = "decoded") -> DataFrame:
    """Bits over 0.5 make an index into ``values``; ``invalid`` marks indexes beyond them.

    clip: the last value; nearest_valid: the index with the fewest differing bits, the lowest of
    them; error: raise.
    """
    code = sum((F.when(F.col(b) > 0.5, 1 << k).otherwise(0) for k, b in enumerate(bits)), F.lit(0))
    df = df.withColumn("_code", code).withColumn("invalid", F.col("_code") >= len(values))
    if policy == "error":
        _raise_if_any(df.filter("invalid").select("_code").distinct(), "invalid codes")
    if policy == "nearest_valid":
        options = F.transform(F.sequence(F.lit(0), F.lit(len(values) - 1)), lambda i: F.struct(F.bit_count(F.col("_code").bitwiseXOR(i)).alias("d"), i.alias("i")))
        index = F.array_min(options)["i"]
    else:
        index = F.least(F.col("_code"), F.lit(len(values) - 1))
    return df.withColumn(column, F.get(F.array(*map(F.lit, values)), index.cast("int"))).drop("_code")


def decode_diagnostics(df: DataFrame, bits: dict[str, list[str]], sizes: dict[str, int], policy: str = "clip") -> DataFrame:
    """(column, n_rows, n_categories, n_invalid, invalid_rate, policy) of the columns whose bits make indexes beyond their categories.

    ``bits``: column -> its bit columns, lowest first; ``sizes``: column -> number of categories. All
    columns are counted in one pass. With policy 'error' any invalid code is an error.
    """
    code = lambda c: sum((F.when(F.col(b) > 0.5, 1 << k).otherwise(0) for k, b in enumerate(bits[c])), F.lit(0))
    one = df.agg(F.count("*").alias("_n"), *(F.count_if(code(c) >= sizes[c]).alias(c) for c in bits))
    size = F.create_map(*(F.lit(x) for c in bits for x in (c, sizes[c])))[F.col("column")]
    out = one.unpivot("_n", list(bits), "column", "n_invalid").filter("n_invalid > 0")
    out = out.select("column", F.col("_n").alias("n_rows"), size.alias("n_categories"), "n_invalid", (F.col("n_invalid") / F.col("_n")).alias("invalid_rate"), F.lit(policy).alias("policy"))
    if policy == "error":
        _raise_if_any(out.select("column", "n_invalid"), "invalid codes")
    return out


def scale_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: mean and population deviation (1 if zero or none) of the observed values."""
    sd = lambda c: F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(1.0)
    return df.agg(*(x for c in columns for x in (F.coalesce(F.avg(c), F.lit(0.0)).alias(f"_m_{c}"), sd(c).alias(f"_s_{c}"))))


def standardize(df: DataFrame, columns: list[str], stats: DataFrame | None = None) -> DataFrame:
    """(value - mean) / deviation / 2, by observed values only."""
    both = with_stats(df, stats if stats is not None else scale_stats(df, columns))
    return both.select(*(((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}") / 2).alias(c) if c in columns else F.col(c) for c in df.columns))


def destandardize(df: DataFrame, columns: list[str], stats: DataFrame) -> DataFrame:
    return with_stats(df, stats).select(*((F.col(c) * 2 * F.col(f"_s_{c}") + F.col(f"_m_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns))


def binary_target(df: DataFrame, column: str, positive: list, negative: list, strict: bool = True) -> DataFrame:
    """Classes become 1 or 0; a null or an uncovered class is an error if strict."""
    if strict:
        _raise_if_any(df.filter(F.col(column).isNull() | ~F.col(column).isin(*positive, *negative)).select(column).distinct(), f"classes of {column} not covered")
    return df.withColumn(column, F.when(F.col(column).isin(positive), 1).when(F.col(column).isin(negative), 0))


def align_dtypes(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Cast shared columns to the reference's types; what can't be cast becomes null."""
    return df.select(*(F.expr(f"try_cast(`{c}` as {reference.schema[c].dataType.simpleString()})").alias(c) if c in reference.columns else F.col(c) for c in df.columns))


def failed_casts(df: DataFrame, reference: DataFrame) -> DataFrame:
    """(column, n_failed) of align_dtypes."""
    shared = [c for c in df.columns if c in reference.columns]
    counts = df.agg(*(F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` as {reference.schema[c].dataType.simpleString()})").isNull()).alias(c) for c in shared))
    return counts.unpivot([], shared, "column", "n_failed")


def map_labels(column: str, labels: dict) -> Column:
    """A value's label, else the value as text ('nan' for null)."""
    value = F.col(column).cast("string")
    if labels:
        value = F.coalesce(F.create_map(*(F.lit(str(x)) for kv in labels.items() for x in kv))[value], value)
    return F.coalesce(value, F.lit("nan"))


def bin_labels(edges: list) -> list[str]:
    """'7-18', '19-30' for whole edges; others start one step of the finest decimal above the last edge."""
    from decimal import Decimal

    if not isinstance(edges, (list, tuple)) or len(edges) < 2:
        raise ValueError("bins need two edges at least")
    texts = [Decimal(str(e)).normalize() for e in edges]
    places = max(0, *(-x.as_tuple().exponent for x in texts))
    step = Decimal(1) if places == 0 else Decimal(1).scaleb(-(places + 1))
    show = lambda x: f"{x:.{places + 1}f}" if places else str(int(x))
    return [f"{show(a if i == 0 else a + step)}-{show(b)}" for i, (a, b) in enumerate(zip(texts[:-1], texts[1:]))]


def bin_column(column: str, edges: list, labels: list[str] | None = None) -> Column:
    """Right-closed bins, the lowest edge included; null and values outside become OutOfRange."""
    c, out = F.col(column), None
    for i, (low, high, name) in enumerate(zip(edges[:-1], edges[1:], labels or bin_labels(edges))):
        test = ((c >= low) if i == 0 else (c > low)) & (c <= high)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise("OutOfRange")


def prepare_groups(df: DataFrame, target: str, protected: list[str], maps: dict[str, dict] | None = None, bins: dict[str, list] | None = None) -> DataFrame:
    """Add TARGET_LABEL and <column>__GROUP; bins override maps. The target may not be protected."""
    maps, bins = maps or {}, bins or {}
    if target in protected or not protected:
        raise ValueError("protected columns are needed, without the target")
    missing = [c for c in [target, *protected] if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    group = lambda c: bin_column(c, bins[c]) if c in bins else map_labels(c, maps.get(c, {}))
    return df.withColumns({"TARGET_LABEL": group(target)} | {f"{c}__GROUP": group(c) for c in protected})


def numeric_codes_for_counting(df: DataFrame, column: str) -> Column:
    return F.bround(column, 0).cast("int") if is_numeric(df, column) else F.col(column)


def clip_label(column: str, n: int) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.col(column)))


def select_models(candidates: DataFrame, names: list[str]) -> DataFrame:
    return candidates.filter(F.col("model").isin(names))


def missing_models(candidates: DataFrame, names: list[str]) -> DataFrame:
    asked = candidates.sparkSession.createDataFrame([(n,) for n in names], "model string")
    return asked.join(candidates.select("model").distinct(), "model", "left_anti")


def infer_binary_columns(df: DataFrame, target: str) -> DataFrame:
    """(column) of numeric columns whose non-null values are 0 or 1, the target left out."""
    columns = [c for c in df.columns if c != target and is_numeric(df, c)]
    flags = df.agg(*(F.coalesce(F.bool_and(F.col(c).isin(0, 1)), F.lit(False)).alias(c) for c in columns))
    return flags.unpivot([], columns, "column", "binary").filter("binary").select("column")


def distinct_profile(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """(column, n_distinct, n_null, low, high), values as text; sketches where exact counts cost too much."""
    n = F.count_distinct if exact else F.approx_count_distinct
    one = df.agg(*(F.struct(n(c).alias("n_distinct"), F.count_if(F.col(c).isNull()).alias("n_null"), F.min(c).cast("string").alias("low"), F.max(c).cast("string").alias("high")).alias(c) for c in columns))
    return one.unpivot([], columns, "column", "s").select("column", "s.*")
