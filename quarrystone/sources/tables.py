"""Reading and writing tables, splits, candidates, masks and report bundles."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarrystone.functions.numeric import json_array
from quarrystone.functions.session import shared_base
from quarrystone.operators.provenance import fingerprint
from quarrystone.operators.split import mask_difference

KINDS = ("nominal", "ordinal", "continuous")


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir, or in local mode a temporary one where that's unset."""
    return f"{shared_base(spark)}/{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """By extension: .parquet, .pq or .csv."""
    name = path.rstrip("/").lower()
    if name.endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    if name.endswith(".csv"):
        return read_csv_consistent(spark, path)
    raise ValueError(f"can't read {path}: not .parquet, .pq or .csv")


def read_csv_consistent(spark: SparkSession, path: str) -> DataFrame:
    """Types inferred from all rows, so that a sparse column gets one type."""
    return spark.read.csv(path, header=True, inferSchema=True, samplingRatio=1.0)


def bind_feature_target(features: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    return features.join(targets, key)


def load_variable_schema(spark: SparkSession, path: str, columns: list[str], target: str | None = None) -> DataFrame:
    """(column, kind, ordinal_order array) of a CSV; all faults are raised together."""
    raw = spark.read.csv(path, header=True, inferSchema=False, escape='"')
    lacking = [c for c in ("column", "kind", "ordinal_order") if c not in raw.columns]
    if lacking:
        raise ValueError(f"schema lacks columns {lacking}")
    df = raw.select(F.trim("column").alias("column"), F.trim("kind").alias("kind"), "ordinal_order").withColumn("parsed", json_array(F.col("ordinal_order")))
    names = spark.createDataFrame([(c,) for c in columns], "column string")
    faults = {
        "blank names": df.filter("column IS NULL OR column = ''").select(F.lit("").alias("column")),
        "declared twice": df.groupBy("column").count().filter("count > 1").select("column"),
        "not declared": undeclared_columns(names, df), "not in the data": undeclared_columns(df, names),
        "unknown kind": df.filter(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))).select("column"),
        "order on a continuous column": df.filter("kind = 'continuous' AND ordinal_order IS NOT NULL").select("column"),
        "ordinal without a valid order": df.filter("kind = 'ordinal' AND parsed IS NULL").select("column"),
    }
    found = {k: [r[0] for r in v.limit(20).collect()] for k, v in faults.items()}
    if any(found.values()):
        raise ValueError(f"variable schema: { {k: v for k, v in found.items() if v} }")
    out = df.select("column", "kind", F.col("parsed").alias("ordinal_order"))
    return out.filter(F.col("column") != target) if target else out


def undeclared_columns(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("column").join(b.select("column"), "column", "left_anti").filter("column IS NOT NULL AND column <> ''")


def write_splits(df: DataFrame, path: str) -> None:
    """One folder for each split."""
    df.write.partitionBy("split").parquet(path)


def _exists(spark: SparkSession, folder: str) -> bool:
    """Is there a table in the folder?"""
    try:
        spark.read.parquet(folder)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def write_candidate(df: DataFrame | Callable[[], DataFrame], path: str, model: str, force: bool = False) -> bool:
    """Write a candidate under its model's folder; an existing one stays unless forced, and then ``df``, if a function, isn't called. True if written."""
    folder = f"{path}/model={model}"
    spark = SparkSession.active()
    if not force and _exists(spark, folder):
        return False
    (df() if callable(df) else df).write.mode("overwrite").parquet(folder)
    return True


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """All CSV files of a folder as one table with the file's name as ``model``."""
    df = spark.read.csv(f"{path}/*.csv", header=True, inferSchema=True, samplingRatio=1.0)
    return df.withColumn("model", F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv", 1))


def write_imputed(splits: DataFrame, path: str, provenance: dict) -> None:
    splits.write.mode("overwrite").partitionBy("split").parquet(f"{path}/data")
    rows = [(k, json.dumps(v, sort_keys=True)) for k, v in sorted(provenance.items())]
    splits.sparkSession.createDataFrame(rows, "field string, value string").write.mode("overwrite").parquet(f"{path}/provenance")


def load_imputed(spark: SparkSession, path: str, expected: dict) -> tuple[DataFrame | None, DataFrame]:
    """The stored splits if their provenance is as expected, else None; and the fields that differ."""
    from quarrystone.operators.combine import provenance_diff

    want = spark.createDataFrame([(k, json.dumps(v, sort_keys=True)) for k, v in sorted(expected.items())], "field string, value string")
    diff = provenance_diff(want, spark.read.parquet(f"{path}/provenance"))
    return (None if diff.limit(1).count() else spark.read.parquet(f"{path}/data")), diff


def write_mask(mask: DataFrame, path: str) -> None:
    mask.write.mode("errorifexists").parquet(path)


def read_mask(spark: SparkSession, path: str, regenerated: DataFrame) -> DataFrame:
    """The stored mask; an error if its seed makes another one."""
    stored = spark.read.parquet(path)
    if mask_difference(stored, regenerated).limit(1).count():
        raise ValueError("the stored mask isn't the one its seed makes")
    return stored


def write_report_bundle(reports: dict[str, DataFrame], path: str, version: int = 1) -> None:
    """Each table as Parquet, and a manifest of their fingerprints."""
    some = next(iter(reports.values()))
    manifest = None
    for name, df in reports.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        row = fingerprint(df.sparkSession.read.parquet(f"{path}/{name}")).select(F.lit(version).alias("version"), F.lit(name).alias("name"), "n_rows", "digest")
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/_manifest_table")
    assert some is not None


def load_report_bundle(spark: SparkSession, path: str, version: int = 1) -> dict[str, DataFrame]:
    """The bundle's tables; an error if the version, a table or a fingerprint isn't right."""
    out = {}
    for r in spark.read.option("pathGlobFilter", "*.parquet").parquet(f"{path}/_manifest_table").collect():
        if r["version"] != version:
            raise ValueError(f"bundle version {r['version']}, expected {version}")
        df = spark.read.parquet(f"{path}/{r['name']}")
        now = fingerprint(df).first()
        if (now["n_rows"], now["digest"]) != (r["n_rows"], r["digest"]):
            raise ValueError(f"table {r['name']} has changed")
        out[r["name"]] = df
    return out


def write_sections(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_sections(source: DataFrame | str, spark: SparkSession | None = None) -> DataFrame:
    df = spark.read.parquet(source) if isinstance(source, str) else source
    if "parents" not in df.columns:
        raise ValueError("sections need a column parents")
    return df


def dataset_manifest(splits: DataFrame, roles: dict[str, list[str]], seed: int) -> DataFrame:
    """One row: counts by split, roles, seed and the table's fingerprint."""
    counts = splits.agg(F.count("*").alias("n_rows"), F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    return counts.crossJoin(fingerprint(splits).select("digest")).withColumns({"roles": F.lit(json.dumps(roles, sort_keys=True)), "seed": F.lit(seed)})
