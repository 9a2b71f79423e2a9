"""Personal data in texts: pattern findings, lists, overlap resolution, anonymising.

A text's findings are an array of structs (entity, start, end, score, text), positions
from 0 in characters, end exclusive. Patterns are searched once each in Arrow batches,
which gives positions at no further cost; all else is expressions on the row.
"""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: (entity, pattern, score); written to mean the same in Python's (ASCII classes) and RE2's syntax.
PATTERNS = [
    ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", 1.0),
    ("URL", r"https?://[^\s<>\"]+", 0.6),
    ("IP_ADDRESS", r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b", 0.6),
    ("CREDIT_CARD", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", 0.5),
    ("US_SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", 0.5),
    ("PHONE_NUMBER", r"(?:\+[0-9]{1,3}[ .-]?)?\(?\b[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b", 0.4),
    ("IBAN_CODE", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}\b", 0.5),
    ("CRYPTO", r"\b(?:bc1[a-z0-9]{25,59}|[13][a-km-zA-HJ-NP-Z1-9]{25,34})\b", 0.5),
    ("DATE_TIME", r"\b(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4})\b", 0.6),
    ("US_PASSPORT", r"\b[A-Z][0-9]{8}\b", 0.1), ("US_DRIVER_LICENSE", r"\b[A-Z][0-9]{7}\b", 0.2), ("US_BANK_NUMBER", r"\b[0-9]{8,17}\b", 0.05),
]
FINDING = "array<struct<entity:string,start:int,end:int,score:double,text:string>>"


_FOUND = pa.list_(pa.struct([("entity", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))


def luhn(digits: str) -> bool:
    """Luhn's check of a string of ASCII digits."""
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(int(d) for d in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


#: A word of the context adds so much to a finding's score, which is then no less than the second number (fixed values).
CONTEXT_GAIN, CONTEXT_LEAST = 0.35, 0.4
#: Words before and after a finding that are its context.
CONTEXT_BEFORE, CONTEXT_AFTER = 5, 0
#: Characters of text searched at once in a task; a longer text is a slice of its own.
SLICE_CHARS = 1 << 20
_WORD = re.compile(r"[A-Za-z0-9_]+")


def supported(text: str, start: int, end: int, words: frozenset[str], before: int, after: int) -> bool:
    """Does one of the nearest words before or after a finding, in lower case, belong to ``words``?"""
    near, width = [], 32 * before
    while before:  # look back until there are enough words or the text begins
        low = max(0, start - width)
        near = _WORD.findall(text, low, start)
        if low == 0 or len(near) > before:
            break
        width *= 4
    near = near[-before:] if before else []
    if after:
        for i, m in enumerate(_WORD.finditer(text, end)):
            if i == after:
                break
            near.append(m[0])
    return any(w.lower() in words for w in near)


def pattern_table(spark, patterns: list[tuple]) -> DataFrame:
    """(entity, pattern, score, context): patterns as rows, to be stored and joined with others; context may be left out."""
    rows = [(p[0], p[1], float(p[2]), list(p[3]) if len(p) > 3 and p[3] else None) for p in patterns]
    return spark.createDataFrame(rows, "entity string, pattern string, score double, context array<string>")


def search(df: DataFrame, text: str, patterns: list[tuple] | DataFrame, out: str, before: int = CONTEXT_BEFORE, after: int = CONTEXT_AFTER) -> DataFrame:
    """df with the array ``out`` of all matches, pattern by pattern, each in order of place; a null text has none.

    A pattern is (entity, regular expression, score) or has a list of context words as well, any of which
    near a match raises its score; or ``patterns`` is a table like that of ``pattern_table``, of a bounded
    number of rows.
    """
    df = df.drop(out)
    names = df.columns
    if isinstance(patterns, DataFrame):
        patterns = [tuple(r) for r in patterns.select("entity", "pattern", "score", "context").orderBy("entity", "pattern").collect()]

    def run(batches):
        compiled = [(p[0], re.compile(p[1], re.ASCII), float(p[2]), frozenset(w.lower() for w in p[3]) if len(p) > 3 and p[3] else None) for p in patterns]
        for whole in batches:
            sizes = pc.fill_null(pc.binary_length(whole.column(text)), 0).to_numpy(zero_copy_only=False)
            for start, n in _runs(sizes):
                b = whole.slice(start, n)
                rows = []
                for t in b.column(text).to_pylist():
                    found = []
                    for e, p, s, context in compiled:
                        for m in p.finditer(t or ""):
                            if m.end() > m.start() and (e != "CREDIT_CARD" or luhn(m[0].translate({32: None, 45: None}))):
                                raised = context is not None and supported(t, m.start(), m.end(), context, before, after)
                                score = min(1.0, max(s + CONTEXT_GAIN, CONTEXT_LEAST)) if raised else s
                                found.append({"entity": e, "start": m.start(), "end": m.end(), "score": score, "text": m[0]})
                    rows.append(found)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, _FOUND)], names=[*names, out])

    schema = df.limit(0).withColumn(out, F.array().cast(FINDING)).schema
    return df.mapInArrow(run, schema)


def _runs(sizes):
    """(first row, rows) of slices of about SLICE_CHARS bytes."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_CHARS:
            yield start, i - start
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes) - start


def pattern_findings(df: DataFrame, text: str = "text", patterns: list[tuple] | DataFrame = PATTERNS, entities: list[str] | None = None) -> DataFrame:
    """Add ``findings``; card numbers must pass Luhn's check, context words raise scores (``search``)."""
    if not entities or "All" in entities:
        return search(df, text, patterns, "findings")
    known = patterns.filter(F.col("entity").isin(entities)) if isinstance(patterns, DataFrame) else [p for p in patterns if p[0] in entities]
    return search(df, text, known, "findings")


def deny_list(df: DataFrame, words: list[str], text: str = "text", entity: str = "GENERIC_PII") -> DataFrame:
    """Add listed words (whole, case as it is) to ``findings``."""
    pattern = r"\b(?:" + "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True)) + r")\b"
    found = search(df, text, [(entity, pattern, 1.0)], "_denied")
    base = F.col("findings") if "findings" in df.columns else F.array().cast(FINDING)
    return found.withColumn("findings", F.concat(base, "_denied")).drop("_denied")


def allow_list(df: DataFrame, words: list[str]) -> DataFrame:
    """``findings`` without those of the given texts."""
    return df.withColumn("findings", F.filter("findings", lambda f: ~f["text"].isin(words)))


def allow_texts(findings: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows of a findings table whose text isn't in the column ``text`` of ``allowed``, however many there are."""
    return findings.join(allowed.select("text").distinct(), "text", "left_anti").select(*findings.columns)


def entity_filter(df: DataFrame, entities: list[str] | None = None, threshold: float = 0.35) -> DataFrame:
    known = lambda f: F.lit(True) if not entities or "All" in entities else f["entity"].isin(entities)
    return df.withColumn("findings", F.filter("findings", lambda f: (f["score"] >= threshold) & known(f)))


def map_entities(findings: DataFrame, mapping: dict[str, str], low: list[str] = (), ignore: list[str] = (), factor: float = 0.4) -> DataFrame:
    """Model labels to entities in a findings table; listed labels lose confidence, ignored ones go."""
    name = F.coalesce(F.create_map(*(F.lit(x) for kv in mapping.items() for x in kv))[F.col("entity")], F.col("entity"))
    kept = findings.filter(~F.col("entity").isin(*ignore)) if ignore else findings
    score = F.when(F.col("entity").isin(*low), F.col("score") * factor).otherwise(F.col("score")) if low else F.col("score")
    return kept.withColumns({"score": score, "entity": name})


def resolve_overlaps(findings: Column) -> Column:
    """The best of overlapping findings (score, then length, then place), in order of place."""
    ranked = F.array_sort(findings, lambda a, b: F.when(a["score"] != b["score"], F.when(a["score"] > b["score"], -1).otherwise(1)).when((a["end"] - a["start"]) != (b["end"] - b["start"]), (b["end"] - b["start"]) - (a["end"] - a["start"])).when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(F.when(a["entity"] < b["entity"], -1).when(a["entity"] > b["entity"], 1).otherwise(0)))
    add = lambda kept, f: F.when(F.exists(kept, lambda k: (k["start"] < f["end"]) & (f["start"] < k["end"])), kept).otherwise(F.concat(kept, F.array(f)))
    kept = F.aggregate(ranked, F.array().cast(FINDING), add)
    return F.array_sort(kept, lambda a, b: a["start"] - b["start"])


def _replacement(f: Column, how: str, **o) -> Column:
    if how == "redact":
        return F.lit("")
    if how == "replace":
        return F.lit(o["value"]) if o.get("value") is not None else F.concat(F.lit("<"), f["entity"], F.lit(">"))
    if how == "mask":
        n = F.least(F.lit(o.get("n", 4)), F.length(f["text"]))
        stars = F.repeat(F.lit(o.get("char", "*")), n)
        return F.concat(stars, F.substring(f["text"], n + 1, F.length(f["text"]))) if o.get("from_start", True) else F.concat(F.substring(f["text"], F.lit(1), F.length(f["text"]) - n), stars)
    if how == "hash":
        return F.sha2(f["text"], 256)
    if how == "encrypt":
        return F.base64(F.aes_encrypt(f["text"], F.lit(o["key"])))
    if how == "highlight":
        return F.concat(F.lit("["), f["text"], F.lit("|"), f["entity"], F.lit("]"))
    raise ValueError(f"unknown operator {how!r}")


def pieces(text: Column, findings: Column) -> Column:
    """The text cut into plain and found pieces: array of (text, entity or null), ``findings`` without overlaps."""
    plain = lambda a, b: F.struct(F.substring(text, a + 1, b - a).alias("text"), F.lit(None).cast("string").alias("entity"))
    end = lambda i: F.when(i == 0, 0).otherwise(F.get(findings, i - 1)["end"])
    cut = F.flatten(F.transform(findings, lambda f, i: F.array(plain(end(i), f["start"]), F.struct(f["text"].alias("text"), f["entity"].alias("entity")))))
    tail = F.array(plain(F.when(F.size(findings) == 0, 0).otherwise(F.element_at(findings, -1)["end"]), F.length(text)))
    return F.filter(F.concat(cut, tail), lambda p: p["entity"].isNotNull() | (p["text"] != ""))


def annotate(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("findings", resolve_overlaps(F.col("findings"))).withColumn("pieces", pieces(F.col(text), F.col("findings")))


def anonymise(df: DataFrame, how: str = "replace", text: str = "text", out: str = "anonymised", **options) -> DataFrame:
    """Replace all findings; overlaps are resolved first."""
    df = df.withColumn("findings", resolve_overlaps(F.col("findings")))
    fs = F.col("findings")
    end = lambda i: F.when(i == 0, 0).otherwise(F.get(fs, i - 1)["end"])
    parts = F.transform(fs, lambda f, i: F.concat(F.substring(F.col(text), end(i) + 1, f["start"] - end(i)), _replacement(f, how, **options)))
    last = F.when(F.size(fs) == 0, 0).otherwise(F.element_at(fs, -1)["end"])
    return df.withColumn(out, F.concat(F.array_join(parts, ""), F.substring(F.col(text), last + 1, F.length(text))))


def findings_table(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.explode("findings").alias("f")).select(*keys, "f.entity", "f.text", "f.start", "f.end", "f.score")


def offsets(df: DataFrame) -> DataFrame:
    """Add ``offsets``: start -> (end, entity, score)."""
    return df.withColumn("offsets", F.map_from_entries(F.transform("findings", lambda f: F.struct(f["start"], F.struct(f["end"].alias("end"), f["entity"].alias("entity"), f["score"].alias("score"))))))


def anonymise_sections(filters: list[DataFrame], how: str = "replace", **options) -> DataFrame:
    """Stacked section filters, every text scanned and replaced, with offsets, beside the source."""
    rows = reduce(DataFrame.unionByName, filters)
    found = pattern_findings(rows.withColumnRenamed("content", "text"))
    return offsets(anonymise(found, how, **({"value": "<ANONYMIZED>"} | options))).withColumnRenamed("text", "content")


def write_anonymised(df: DataFrame, path: str, key: str = "id", text: str = "text") -> None:
    """Parquet rows of an anonymised frame: key, the source text, the anonymised text, its items and their offsets."""
    offsets(df).select(key, F.col(text).alias("source"), "anonymised", F.col("findings").alias("items"), "offsets").write.mode("overwrite").parquet(path)


def corpus_pii_report(df: DataFrame, keys: list[str]) -> DataFrame:
    return findings_table(df, keys).groupBy(*keys, "entity").agg(F.count("*").alias("n"))
