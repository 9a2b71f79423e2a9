"""The pipeline's stages and run() against a brute-force version on a small corpus."""

import importlib.util
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
_spec = importlib.util.spec_from_file_location("llm_ops", Path(__file__).with_name("test_ops.py"))
ops = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(ops)

import corpus_pipeline  # noqa: E402
from quarrystone.llm import tokens  # noqa: E402


def words_of(x):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))


def hit_words(text, items):
    w, hit = words_of(text), set()
    for _, t in items:
        b = words_of(t)
        k = min(10, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(w) - k + 1 if b else 0):
            if tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
    return w, hit


def expected(rows, items):
    """Ids and texts after each filtering stage."""
    stages, now = [], [(d, t) for d, t in rows if any(c.isalpha() for c in t or "")]
    stages.append(now)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for d, t in now:
        for x in t.split("\n"):
            held.setdefault(key(x), set()).add(d)
    now = [(d, "\n".join(x for x in t.split("\n") if not (len(key(x)) >= 20 and len(held[key(x)]) >= 3 and max(held[key(x)]) != d))) for d, t in now]
    stages.append(now)
    label = ops.brute_components([ops.fingerprint(t) for _, t in now])
    first = {}
    for (d, _), c in zip(now, label):
        first[c] = min(d, first.get(c, d))
    now = [(d, t) for (d, t), c in zip(now, label) if first[c] == d]
    stages.append(now)
    kept = []
    for d, t in now:
        w, hit = hit_words(t, items)
        if not hit or len(hit) <= 0.5 * len(w):
            kept.append((d, [x for i, x in enumerate(w) if i not in hit]))
    return stages, kept


def corpus(rng):
    shared = ops.prose(rng, 9)
    items = [(i, ops.prose(rng, 20)) for i in range(5)]
    rows = [(i, "\n".join(ops.prose(rng, rng.randrange(6, 25)) + "." for _ in range(rng.randrange(1, 5)))) for i in range(40)]
    rows += [(100 + i, rows[i][1] + "\n" + shared) for i in range(6)] + [(200, rows[7][1]), (201, rows[8][1])]
    rows += [(300, ops.prose(rng, 60) + " " + items[1][1] + " " + ops.prose(rng, 30)), (301, items[2][1]), (302, None), (303, ""), (304, "123 456 !!"), (305, ops.prose(rng, 900))]
    return rows, items


def test_stages_and_run_match_brute_force(spark, make, tmp_path):
    rows, items = corpus(random.Random(20))
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages, clean = expected(rows, items)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        assert docs.columns == columns, name
        if k < 3:
            assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(stages[k]), name
    assert sorted((r.doc_id, words_of(r.text)) for r in docs.collect()) == sorted(clean)
    assert docs.filter(F.col("n_chars") != F.length("text")).count() == 0
    whole, want = ops.word_ids(), Counter()
    for r in docs.collect():
        ids = np.array([*whole(r.text), 1], "<u4")
        for k, s in enumerate(range(0, len(ids), 4096)):
            want[r.doc_id, k, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())] += 1
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in last) == want
    ops.check_packed(last, 4096)
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in ran) == want
    assert tokens.default_path()


def test_stages_survive_empty_and_null_documents(spark, make, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in ([], [(None, None), (None, "a word"), (1, "a word"), (1, "a word")]):
        docs = make(rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == (1 if rows else 0)
