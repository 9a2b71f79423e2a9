"""Fingerprints of tables and files, and the run registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def fingerprint(df: DataFrame) -> DataFrame:
    """n_rows and a digest of names, types and all rows, whatever their order."""
    row = F.xxhash64(F.lit(0), *(F.coalesce(F.col(c).cast("string") if "map" not in k else F.to_json(c), F.lit("\0null")) for c, k in df.dtypes))
    sums = df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("s"), F.coalesce(F.bit_xor(row), F.lit(0)).alias("x"))
    schema = ",".join(f"{c}:{k}" for c, k in sorted(df.dtypes))
    return sums.select("n_rows", F.sha2(F.concat_ws("|", F.lit(schema), "n_rows", F.col("s").cast("string"), "x"), 256).alias("digest"))


#: Files up to this size are read as one value; larger ones as a stream.
WHOLE_BYTES = 64 << 20


def file_fingerprint(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes and sha256 of files, empty ones left out. A file is read by one task; one over WHOLE_BYTES piece by piece, where Arrow knows its file system."""
    import hashlib

    import pyarrow as pa
    from pyarrow import fs

    files = spark.read.format("binaryFile").load(path)
    whole = files.filter(F.col("length") <= WHOLE_BYTES).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))

    def streamed(batches):
        for b in batches:
            out = []
            for name in b.column("path").to_pylist():
                system, at = fs.FileSystem.from_uri(name.replace("file:/", "file:///", 1) if name.startswith("file:/") and not name.startswith("file://") else name)
                h = hashlib.sha256()
                with system.open_input_stream(at, compression=None) as f:
                    while piece := f.read(1 << 20):
                        h.update(piece)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("bytes"), pa.array(out, pa.string())], names=["path", "bytes", "sha256"])

    large = files.filter(F.col("length") > WHOLE_BYTES).select("path", F.col("length").alias("bytes"))
    return whole.unionByName(large.mapInArrow(streamed, "path string, bytes bigint, sha256 string"))


def changed_files(recorded: DataFrame, now: DataFrame) -> DataFrame:
    """Recorded (path, sha256) that are missing or differ now."""
    n = now.select("path", F.col("sha256").alias("now"))
    return recorded.join(n, "path", "left").filter(~F.col("sha256").eqNullSafe(F.col("now"))).select("path", F.col("now").isNull().alias("missing"))


def verify_provenance(expected: DataFrame, recorded: DataFrame) -> DataFrame:
    """(ok, n_different) of two (field, value) tables."""
    from quarrystone.operators.combine import provenance_diff

    return provenance_diff(expected, recorded).agg((F.count("*") == 0).alias("ok"), F.count("*").alias("n_different"))


def append_run(runs: DataFrame, path: str) -> None:
    """Append run entries (run_id, dataset, version, stage, created_at); nothing is replaced.

    A run keeps its dataset and version: an entry that changes them is an error.
    """
    spark = runs.sparkSession
    try:
        old = spark.read.parquet(path).select("run_id", F.col("dataset").alias("_d"), F.col("version").alias("_v"))
    except Exception as e:  # the first entry
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = None
    if old is not None and runs.join(old, "run_id").filter("NOT (dataset <=> _d AND version <=> _v)").limit(1).count():
        raise ValueError("a run can't change its dataset or version")
    runs.write.mode("append").parquet(path)
