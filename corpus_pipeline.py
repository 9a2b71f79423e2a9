"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage works on all that its predecessor kept and returns the columns of documents,
whatever further columns there are and however they are named; the last returns the
pieces with their places in the sequences. n_chars, where there is one, follows the text.
No stage needs ids to be there or to be unique, and empty tables pass through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarrystone.llm import decontaminate, language_id, line_dedup, packing, shingle_dedup, simhash
from quarrystone.llm._base import checkpointed, held_out, spare, table

#: A document stays if this share of its letters is in one language.
MIN_LANGUAGE_SHARE = 0.5


def _with_length(docs: DataFrame) -> DataFrame:
    """n_chars follows the text that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with no language that has half of them, go.

    So null and empty texts go. Repeated rows are judged each; without a training row with a
    language nothing can be identified and every document goes.
    """
    model = language_id.train(docs.filter(~held_out(F.col("doc_id"), 4, 2)).select("text", "lang"))
    lang, score, spans = spare(docs.columns, "lang_pred", "score", "spans")
    found = language_id.detect(docs, model, names=(lang, score, spans))
    return found.filter((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SHARE)).drop(lang, score)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three or more documents share stay in the last of them only.

    Every row stays, with what is left of its text; null texts stay null. Rows of one id count
    as one document, and so do rows without an id.
    """
    return _with_length(line_dedup.apply_keep(docs, line_dedup.line_keeps(docs)))


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles at a Jaccard similarity of 0.8 or more.

    Pairs are found by op2's fingerprints within 3 bits, and by bands of minima those that differ in more; whole
    sets of shingles decide on both. It's the one with the smallest id; null texts, empty texts and texts without words are one
    group. Of repeated rows (id and text) one stays.
    """
    return shingle_dedup.drop_near_duplicates(docs, radius=simhash.RADIUS)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go.

    Texts without words stay as they are; repeated rows are judged each.
    """
    return _with_length(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, in sequences of at most 4096 tokens; every row has its pieces, a null text that of an empty document."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", remove_benchmarks),
    ("packing", pack_sequences),
]
#: Models, fingerprints by XXH64 and token ids can't be stated in SQL; the tests hold a brute-force version against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
