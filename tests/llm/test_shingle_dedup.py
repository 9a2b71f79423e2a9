"""The pipeline's near-duplicate stage against brute-force Jaccard similarity on edited copies."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarrystone.llm import shingle_dedup, simhash
from quarrystone.llm._base import checkpointed
from quarrystone.llm.components import connected_components

WORDS = [f"w{i}" for i in range(500)]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def edited(rng):
    """Texts with copies in which 1 to 8 of 240 words differ, so that similarities lie on both sides of 0.8."""
    rows = []
    for g in range(30):
        base = [rng.choice(WORDS) for _ in range(240)]
        rows.append((100 * g + 1, " ".join(base)))
        for i in range(8):
            words = list(base)
            for at in rng.sample(range(240), i + 1):
                words[at] = rng.choice(WORDS).upper()
            rows.append((100 * g + 2 + i, " ".join(words)))
    return rows + [(9001, ""), (9002, " \n"), (9003, None), (9004, "Two words"), (9005, "two  words"), (9006, "two words more"), (None, rows[0][1])]


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    label, near = list(range(len(rows))), 0
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                near += sets[i] != sets[j]
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label, near


def test_near_copies_at_four_fifths_go(spark, make):
    rows = edited(random.Random(3))
    label, near = brute(rows)
    assert near > 100
    low = {}
    for (d, _), c in zip(rows, label):
        low[c] = min(d or 10**9, low.get(c, 10**9))
    out = corpus_pipeline.dedup_documents(spark, make(rows), "").collect()
    assert sorted(r.doc_id for r in out) == sorted(low.values())


@pytest.mark.parametrize("place_bytes", [3000, 8 << 20])
def test_blocks_don_t_change_components(make, place_bytes):
    rows = [r for r in edited(random.Random(5)) if r[0] is not None]
    label, _ = brute(rows)
    docs = make(rows).withColumn("ver", F.xxhash64(F.coalesce("text", F.lit(""))))
    sig = checkpointed(shingle_dedup.signatures(docs.select("doc_id", "ver", "text")))
    nodes = checkpointed(sig.groupBy("node").agg(F.min("ver").alias("ver"), F.first("bands").alias("bands")))
    roots = {r.node: r.root for r in connected_components(shingle_dedup.near_links(nodes, docs.select("ver", "text"), place_bytes)).collect()}
    got = {r.doc_id: roots.get(r.node, r.node) for r in sig.collect()}
    pairs = {(c, got[d]) for (d, _), c in zip(rows, label)}
    assert len(pairs) == len({c for c, _ in pairs}) == len({g for _, g in pairs})


def test_stage_finds_pairs_by_fingerprints(spark, make, monkeypatch):
    """Without bands, near copies within 3 bits still go; sets that are too far apart stay, whatever their fingerprints."""
    from quarrystone.llm import simhash

    rng = random.Random(8)
    words = [rng.choice(WORDS) for _ in range(900)]
    other = [*words[:-1], "changed"]
    rows = [(2, " ".join(words)), (1, " ".join(other)), (3, "a b a b"), (4, "a b a b a b"), (5, ""), (6, None), (7, "something else altogether")]
    a, b = simhash._fingerprints(pa.array([rows[0][1], rows[1][1]]), 3).tolist()
    assert (a ^ b).bit_count() <= 3
    label, _ = brute(rows)
    low = {}
    for (d, _), c in zip(rows, label):
        low[c] = min(d, low.get(c, d))
    whole = shingle_dedup.near_links
    monkeypatch.setattr(shingle_dedup, "near_links", lambda nodes, *rest, **more: whole(nodes.withColumn("bands", F.expr("slice(bands, 1, 0)")), *rest, **more))
    out = corpus_pipeline.dedup_documents(spark, make(rows), "").collect()
    assert sorted(r.doc_id for r in out) == sorted(low.values()) and 2 not in low.values()


def test_texts_pass_through_one_worker(make, spark):
    """Fingerprints and bands come from one pass, and texts go to it in batches that the session's setting doesn't change."""
    df = make([(i, t) for i, t in edited(random.Random(2))]).select("doc_id", "text")
    found = shingle_dedup.signatures(df.withColumn("ver", F.xxhash64("text")), True)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    want = simhash.fingerprints(df).collect()
    assert sorted(str((r["doc_id"], r["fp"])) for r in found.collect()) == sorted(str((r["doc_id"], r["fp"])) for r in want)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    sizes = spark.range(0, 100, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint")
    assert max(r["n"] for r in checkpointed(sizes, 7).collect()) == 7 and spark.conf.get(key) == before
