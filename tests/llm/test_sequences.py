"""Runs, byte-level BPE and the Merkle manifest against brute force, and on nulls, ties, repeats, empty and clashing inputs."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import test_ops as ops
from quarrystone.llm import bpe, merkle, runs

SHA = lambda x: hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()
CLASHING = ["g", "b", "i", "d", "row", "path", "part", "first", "salt", "leaf_number", "is_node", "name", "runs", "ids", "n"]


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# op11


def brute_runs(w, least=12):
    """Maximal stretches with period p, for every p, in quadratic time; (start, period, length)."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j - i + p >= max(least, 2 * p) and j > i:
                found.setdefault((i, j - i + p), p)
            i = max(j, i) + 1
    return sorted((s, p, n) for (s, n), p in found.items())


def documents(rng):
    out = []
    for _ in range(rng.randrange(1, 6)):
        n, kind = rng.randrange(0, 260), rng.randrange(5)
        w = [rng.randrange([1, 2, 3, 20, 1000][kind]) for _ in range(n)]
        if n > 8 and rng.random() < 0.5:
            a, p = rng.randrange(n // 2), rng.randrange(1, n // 2)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        out.append(list(out[-1]) if out and rng.random() < 0.2 else w)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_runs_are_those_of_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(runs, "PAIRS", rng.choice([1, 50, 1 << 20]))
    docs = documents(rng)
    got = [[] for _ in docs]
    for d, s, n, p in zip(*(x.tolist() for x in runs.find_runs(np.array(sum(docs, []), np.int64), np.array([len(w) for w in docs])))):
        got[d].append((s, p, n))
    assert got == [brute_runs(w) for w in docs]


def test_every_difference_has_its_pair_in_the_cover():
    for a in range(runs.PERIOD):
        for b in range(runs.PERIOD):
            assert {(x + runs.SHIFTS[a, b]) % runs.PERIOD for x in (a, b)} <= set(runs.COVER)


@given(st.lists(st.integers(0, 2), min_size=2, max_size=400), st.data())
@settings(max_examples=60, deadline=None)
def test_common_prefixes(w, data):
    own = np.array([*w, 99])
    i = data.draw(st.lists(st.integers(0, len(w)), min_size=1, max_size=9))
    pairs = [(a, b) for a in i for b in range(0, len(w), 7) if a != b]
    a, b = np.array(pairs or [(0, 1)]).T

    def common(x, y):
        n = 0
        while max(x, y) + n < len(own) and own[x + n] == own[y + n]:
            n += 1
        return n

    assert runs.CommonPrefixes(own)(a, b).tolist() == [common(x, y) for x, y in zip(a, b)]


def test_runs_query(spark, tmp_path, make):
    rng = random.Random(12)
    rows = ops.awkward(rng) + [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(80)))) for i in range(20, 90)] + [(100, "x " * 5000), (101, "é ß\té ß\x0b" * 9 + "tail")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))

    def brute(d, text):
        w = words(text)
        h = zlib.crc32(str(d).encode()) if d is not None else 1
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = brute_runs(w)
        gone = {i for s, p, m in found for i in range(s + p, s + m)}
        s, p, m = min(found, key=lambda r: (-r[2], r[0], r[1]), default=(None, None, None))
        return (d, len(found), s, m, p, 1000 * m // p if found else None, SHA("".join(f"{s},{m},{p}\n" for s, p, m in found)), SHA(" ".join(x for i, x in enumerate(w) if i not in gone)))

    key = lambda r: tuple(map(str, r))
    got = [tuple(r) for r in runs.query(spark, str(tmp_path)).collect()]
    assert sorted(got, key=key) == sorted((brute(*r) for r in rows), key=key)
    assert sum(1 for r in got if r[1]) > 20


def test_runs_operators(make):
    rows = ops.awkward(random.Random(13)) + [(20, "a b c a b c a b c a b c end"), (21, "w " * 30)]
    out = runs.periodic_runs(make(rows, *CLASHING)).collect()
    assert {c for c in CLASHING if c != "runs"} <= set(out[0].asDict())
    assert {(r.doc_id, len(r.runs)) for r in out if r.doc_id in (1, 2, 20, 21)} == {(1, 0), (2, 0), (20, 1), (21, 1)}
    assert next(tuple(r.runs[0]) for r in out if r.doc_id == 20) == (0, 12, 3)
    texts = {r.doc_id: r.text for r in runs.collapse(make(rows)).collect()}
    assert texts[20] == "a b c end" and texts[21] == "w" and texts[1] is None and texts[2] == ""
    assert runs.periodic_runs(make([])).count() == runs.collapse(make([])).count() == 0


# op12


@pytest.fixture(scope="module")
def own():
    import public_tokenizers
    import tiktoken

    v = bpe.Vocabulary.of(None)
    return v, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.ranks, special_tokens={})


@given(st.lists(st.text(alphabet="ab's'tre vlmd0١2\n\n\t \x85 é—　²中'\U0001f600<|endoftext|>", max_size=25), max_size=6))
@settings(max_examples=400, deadline=None)
def test_ids_are_the_librarys(own, texts):
    v, library = own
    ids, at = v.encode(pa.array(texts, pa.string()))
    assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:])] == [library.encode_ordinary(t) for t in texts]


def test_classes_and_tokens(own):
    v, library = own
    for i, t in list(v.tokens.items())[::97]:
        assert bpe.Prefixes(v, t).ids() == [i]
    rng = random.Random(4)
    for _ in range(400):
        raw = b"".join(v.tokens[rng.randrange(50_000)] for _ in range(rng.randrange(1, 9)))
        assert bpe.Prefixes(v, raw).ids() == library._encode_single_piece(raw)


@pytest.mark.parametrize("seed", range(30))
def test_appends_and_edits_of_a_piece(own, seed):
    v, _ = own
    rng = random.Random(seed)
    bit = lambda n: "".join(rng.choice(rng.choice(["ab", "the ing ", "éß中", "0123"])) for _ in range(rng.randrange(n))).encode()
    p = bpe.Prefixes(v, bit(400))
    for _ in range(6):
        p.append(bit(30))
        a = rng.randrange(len(p.raw) + 1)
        p.replace(a, min(len(p.raw), a + rng.randrange(8)), bit(9))
        assert p.last == bpe.Prefixes(v, p.raw).last and b"".join(v.tokens[i] for i in p.ids()) == p.raw


def test_an_edit_computes_few_prefixes(own):
    v, _ = own
    p = bpe.Prefixes(v, b"windows of the house " * 2000)
    assert p.replace(10, 12, b"zz") < 300 and p.last == bpe.Prefixes(v, p.raw).last


def test_encode_decode_reencode(own, make, monkeypatch):
    v, library = own
    monkeypatch.setattr(bpe, "SLICE_BYTES", 200)
    rows = ops.awkward(random.Random(14)) + [(20, "it's  a\n\ntest's'll <|endoftext|>\t\t x")]
    made = bpe.encode(make(rows, *CLASHING))
    back = bpe.decode(made.drop("text")).collect()
    key = lambda x: (str(x[0]), x[1] or "")
    assert sorted(((r.doc_id, r.text) for r in back), key=key) == sorted(((d, t or "") for d, t in rows), key=key)
    assert all(r.ids == library.encode_ordinary(r.text or "") for r in made.collect())
    assert bpe.encode(make([])).count() == 0
    rng = random.Random(15)
    texts = [(i, "".join(rng.choice(["the ", "house", "'s", "\n", " ", "é", "x1", "中文"]) for _ in range(rng.randrange(60)))) for i in range(60)]
    edits = {}
    for i, t in texts:
        a = rng.randrange(len(t) + 1)
        b = min(len(t), a + rng.randrange(4))
        new = rng.choice(["", "'s", " ", "zz", "\n\n", "ll"])
        edits[i] = (len(t[:a].encode()), len(t[:b].encode()), new, t[:a] + new + t[b:])
    spark = made.sparkSession
    table = spark.createDataFrame([(i, *e[:3]) for i, e in edits.items() if i % 7], "doc_id bigint, edit_start int, edit_stop int, edit_text string")
    for r in bpe.reencode(bpe.encode(make(texts)).join(table, "doc_id", "left")).collect():
        want = edits[r.doc_id][3] if r.doc_id % 7 else dict(texts)[r.doc_id]
        assert (r.text, r.ids) == (want, library.encode_ordinary(want))


def test_bpe_query(own, spark, make, tmp_path):
    _, library = own
    rows = ops.awkward(random.Random(16)) + [(30, "word " * 300_000 + "é"), (31, "x" * 5000)]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d, len(ids), SHA(" ".join(map(str, ids))), SHA(t or "")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, bpe.query(spark, str(tmp_path)).collect()), key=key) == sorted(want, key=key)


# op13


def brute_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([SHA("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def brute_path(levels, i):
    return [(level[i // 16**k * 1 // 16 * 16 : i // 16**k // 16 * 16 + 16], i // 16**k % 16) for k, level in enumerate(levels[:-1])]


def brute_leaf(d, source, lang, n, text):
    return SHA("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, source, lang, n, text)))


def brute_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        leaves = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(*r)))
        trees[s] = leaves, brute_levels([brute_leaf(*r) for r in leaves])
    top = brute_levels([trees[s][1][-1][0] for s in order])
    fold_ascii = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for j, s in enumerate(order):
        leaves, levels = trees[s]
        for i, r in enumerate(leaves):
            path = brute_path(levels, i) + brute_path(top, j)
            x = brute_leaf(*r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                x = brute_leaf(*r[:4], r[4].translate(fold_ascii) if r[4] is not None else None)
            for run, at in path:
                x = SHA("".join(run[:at] + [x] + run[at + 1 :]))
            siblings = "".join("".join(run[:at] + run[at + 1 :]) for run, at in path)
            yield (r[0], brute_leaf(*r), levels[-1][0], top[-1][0], SHA(siblings), x, x == top[-1][0])


@pytest.mark.parametrize("hot, others", [(700, 40), (256, 1), (257, 17), (16, 300), (1, 0), (4200, 2)])
def test_merkle_query(spark, tmp_path, hot, others):
    rng = random.Random(hot)
    rows = [(i if i % 9 else None, "hot" if i % 3 else None, "en", i, rng.choice(["Text A", "b", "", None, "É Ü"])) for i in range(hot)]
    rows += [(10_000 + i, f"s{i}é" if i % 2 else f"S{i}", None, None, "Words") for i in range(others)] + [(7, "hot", "de", 1, "Same")] * 5
    rng.shuffle(rows)
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, merkle.query(spark, str(tmp_path)).collect()), key=key) == sorted(brute_manifest(rows), key=key)


def test_proofs_tell_a_changed_row(make, spark):
    rows = [r for r in ops.awkward(random.Random(17)) if r[0] is not None] + [(i, f"text {i}") for i in range(100, 400)]
    df = make(rows, *CLASHING)
    columns = ["doc_id", "source", "text"]
    held = merkle.build(df.drop("path").withColumn("leaf", merkle.leaf_digest(*columns)), "source", "doc_id", "leaf")
    proofs = merkle.proofs(held)
    assert set(df.drop("path").columns) < set(proofs.columns) and proofs.filter("name <> 'x' or g <> 'x'").count() == 0
    later = proofs.withColumn("text", F.when(F.col("doc_id") == 150, "else").otherwise(F.col("text"))).withColumn("now", merkle.leaf_digest(*columns))
    assert [r.doc_id for r in merkle.verified(later, "now").filter("not verified").collect()] == [150]
    assert held.root().count() == held.subroots().count() == 1
    none = merkle.build(make([]).withColumn("leaf", merkle.leaf_digest(*columns)), "source", "doc_id", "leaf")
    assert merkle.proofs(none).count() == none.root().count() == 0
