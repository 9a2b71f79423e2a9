"""Queries against their SQL, brute-force versions of scores, other id types, clashing names, long texts, files."""

import gzip
import importlib.util
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

_spec = importlib.util.spec_from_file_location("llm_ops_more", Path(__file__).with_name("test_ops.py"))
ops = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(ops)

import corpus_pipeline  # noqa: E402
from quarrystone.llm import decontaminate, language_id, line_dedup, packing, quality_fm, registry, shingle_dedup, simhash, token_counts, tokens, toxicity, warc  # noqa: E402

TABLES = ["documents", "benchmark", "labels", "pages"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Small tables with everything awkward that a unique id allows."""
    rng, at = random.Random(30), tmp_path_factory.mktemp("tables")
    items = [(i, ops.prose(rng, rng.choice([3, 10, 25]))) for i in range(12)]
    shared = ops.prose(rng, 9)
    texts = [ops.prose(rng, rng.randrange(1, 60)) + rng.choice(["", "\n" + shared, "\nHome\nzurück\n" + shared.upper(), "\n| a | b | c |", "\nAlle Rechte vorbehalten!"]) for _ in range(150)]
    texts += [None, "", " \n\t", "é—ß 日本", "x" * 30_000, ops.prose(rng, 8000), f"{ops.prose(rng, 20)}, {items[5][1].upper()}. {ops.prose(rng, 5)}", "K politique de cookies", "one two three four five six. " * 6]
    lang = ["en", "de", None]
    docs = [(i, t, lang[i % 3], "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(0, 150)], "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(i, f"http://a/{i}", f"<p>{t}</p>") for i, t in enumerate(texts)], "page_id bigint, url string, html string").write.parquet(f"{at}/pages.parquet")
    return str(at)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    want = con.sql(registry.oracle_sql()[name])
    got = registry.queries()[name](spark, folder)
    assert sorted(want.columns) == sorted(got.columns)
    assert Counter(tuple(r) for r in got.select(*want.columns).collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_covers_every_row(spark, folder, name):
    out = registry.queries()[name](spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").count()
    if name == "op1_token_counts":
        assert out.agg(F.sum("n_docs")).first()[0] == docs
    elif name == "op6_warc":
        assert out.count() == 2 * docs
    else:
        assert out.select("doc_id").distinct().count() == docs


def test_op10_is_one_pass_over_the_documents(spark, folder):
    plan = registry.queries()["op10_decontaminate"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_blocks_of_the_benchmark_never_chain(spark, folder, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontaminate.find_hits(docs, bench)
    want = {r.doc_id: ops.brute_hits(r.text, [tuple(b) for b in bench.collect()]) for r in docs.collect()}
    assert {r.doc_id: (r.n_words, decontaminate.hit_words(r.hit_spans), list(r["items"])) for r in got.collect()} == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


# brute-force versions


def naive_hits(lexicon, words):
    out = []
    for i, w in enumerate(words):
        found = [(len(e), x) for e, x in lexicon.weights.items() if (e.endswith(" ") and f" {w} " == e) or (not e.endswith(" ") and w.startswith(e[1:]))]
        around = {" ".join(words[i : i + 2])} if i + 1 < len(words) else set()
        around |= {" ".join(words[i - 1 : i + 1])} if i else set()
        if found and not around & lexicon.exceptions:
            out.append((i, max(found)[1]))
    return out


def test_lexicon_hits_are_those_of_a_scan():
    rng = random.Random(31)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 8)))
    for _ in range(60):
        entries = {f" {word()}" + rng.choice(["", " "]): rng.random() for _ in range(12)} | {" " + "b" * 50 + " ": 1.0}
        words = [word() for _ in range(40)] + ["b" * 50, "b" * 49]
        lex = toxicity.Lexicon(entries, {" ".join(words[k : k + 2]) for k in (3, 9)}, (-1.0, 0.5, 0.2, 0.1))
        want = naive_hits(lex, words)
        assert lex.hits(lex.automaton(), words) == want
        total = sum(w for _, w in want)
        x = [np.log1p(total), total / np.sqrt(len(words) + 10), max((w for _, w in want), default=0)]
        assert np.allclose(lex.features(lex.automaton(), words), x)
        assert abs(lex.probability(np.array([x]))[0] - 1 / (1 + np.exp(1.0 - np.dot(x, [0.5, 0.2, 0.1])))) < 1e-12


def test_long_words_are_entries_and_folding_goes_by_neighbours():
    w = "q" * 45
    assert f" {w} " in toxicity.entries_of([w])
    looks = dict(zip("013457@$!|8", "oieastasilb"))

    def slow(text):  # sign runs before a letter; a digit after a letter and before no digit
        out = []
        for m in re.finditer(r"[013457@$!|8]+|[^013457@$!|8]+", text.lower()):
            s, after, before = m[0], text[m.end() : m.end() + 1], text[m.start() - 1 : m.start()] if m.start() else ""
            if s[0] not in looks:
                out.append(s)
            elif after.isalpha():
                out.append("".join(looks[c] for c in s))
            elif before.isalpha() and s[0].isdigit() and not (s[1:2] or after).isdigit():
                out.append(looks[s[0]] + s[1:])
            else:
                out.append(s)
        return "".join(out)

    rng = random.Random(32)
    for _ in range(400):
        t = "".join(rng.choice("ab1249$!@ é_") for _ in range(rng.randrange(0, 14)))
        assert toxicity.fold(t) == slow(t), t


def test_quality_features_by_hand():
    rng = random.Random(33)
    texts = ["", None, "One two two\nThree; #four!\n\nOne two two", "ÄÖ 12", *(ops.prose(rng, 40) + "\n" + ops.prose(rng, 3) for _ in range(6))]
    stated = np.array([np.nan if t is None else len(t) for t in texts])
    slot, value, at = quality_fm.read_features(pa.array(texts, pa.string()), stated)
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        count = Counter(words)
        raw = (t or "").encode()
        got_slots, got_values = slot[at[i] : at[i + 1]], value[at[i] : at[i + 1]]
        word_part = got_slots < quality_fm._WORD_SLOTS
        assert word_part.sum() == len(count) and (~word_part).sum() == len(quality_fm.STATS)
        assert np.allclose(sorted(got_values[word_part]), sorted(np.sqrt(c / len(words)) for c in count.values()))
        bins = {s: int(b) for s, b in zip(quality_fm.STATS, (np.sort(got_slots[~word_part]) - quality_fm._WORD_SLOTS) % quality_fm.BINS)}
        cut = lambda x, root: min(int((x**0.5 if root else x) * quality_fm.BINS), quality_fm.BINS - 1)
        size, lines = max(len(raw), 1), (t or "").split("\n")
        lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        assert bins["upper"] == cut(sum(65 <= c <= 90 for c in raw) / size, True)
        assert bins["symbols"] == cut(sum(chr(c) in "#*$%&|<>~^=+_\\{}[]@" for c in raw) / size, True)
        assert bins["distinct"] == cut(len(count) / max(len(words), 1), False)
        assert bins["repeats"] == cut(sum(a == b for a, b in zip(words, words[1:])) / max(len(words), 1), True)
        assert bins["dup_lines"] == cut(1 - len(set(lines)) / max(len(lines), 1) if lines else 1, True)
        assert bins["short_lines"] == cut(sum(len(x.encode()) < 30 for x in lines) / max(len(lines), 1), False)


def slow_buckets(word):
    """All n-grams of one word between spaces, none of which reaches beyond it."""
    raw, out = b" " + word.lower().encode() + b" ", []
    for k in language_id.ORDERS:
        for i in range(len(raw) - k + 1):
            h = 0
            for c in raw[i : i + k]:
                h = (h * 0x100000001B3 + c) % 2**64
            out.append((h + k) * 0x9E3779B97F4A7C15 % 2**64 >> 47)
    return out


def test_word_scores_by_hand(make):
    rng = random.Random(34)
    words = {"en": ["the", "house", "thing"], "de": ["der", "nicht", "schön"], "ru": ["это", "вода"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(12)) + rng.choice([".", " 12"]), x) for i, x in enumerate(["en", "de", "ru"] * 6)]
    model = language_id.train(make(rows))
    count = {x: Counter() for x in words}
    for _, t, x in rows:
        for w in re.findall(r"[^\W\d_]+", t):
            count[x].update(slow_buckets(w))
    tested = ["the", "schön", "вода", "thehouse", "nichts", "x"]
    got = model.scores(w := language_id.read_words(pa.array([" ".join(tested)])))[w.codes]
    for word, row in zip(tested, got):
        script = "cyrillic" if word == "вода" else "latin"
        want = []
        for x in model.languages:
            total = sum(count[x].values()) + 0.5 * language_id.BUCKETS
            score = sum(np.log((count[x][b] + 0.5) / total) for b in slow_buckets(word)) / len(language_id.ORDERS)
            want.append((score, 0.0 if (x == "ru") == (script == "cyrillic") else -50.0))
        top = max(s for s, _ in want)
        assert np.allclose(row, [s - top + away for s, away in want]), word


def test_bit_distances_of_a_chain_are_exact_for_a_chain():
    rng = np.random.default_rng(5)
    bits = np.zeros((4000, 6), int)
    bits[:, 0] = rng.random(4000) < 0.4
    for i in range(1, 6):  # a Markov chain, so that pairs of neighbours say all
        bits[:, i] = np.where(rng.random(4000) < 0.85, bits[:, i - 1], rng.random(4000) < 0.5)
    got = simhash.distances(bits.T @ bits / 4000, list(range(6)))
    x = bits @ (1 << np.arange(6))
    d = np.bincount(np.bitwise_count((x[:1500, None] ^ x[None, :1500]).astype(np.uint64)).ravel(), minlength=7) / 1500**2
    assert abs(got.sum() - 1) < 1e-9 and np.abs(got - d).max() < 0.02


# any id type, clashing names, long texts


def test_string_ids(make, spark):
    rng = random.Random(35)
    base, line = ops.prose(rng, 60), "a line that many documents hold"
    rows = [(f"doc-{i}", ops.prose(rng, 40) + "\n" + line) for i in range(5)] + [("b", base), ("a", base), (None, base)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    cut = {r.doc_id: r.text for r in line_dedup.apply_keep(df, line_dedup.line_keeps(df)).collect()}
    assert [d for d, t in cut.items() if d and d.startswith("doc") and t.endswith(line)] == ["doc-4"]
    for drop in (simhash.drop_near_duplicates, shingle_dedup.drop_near_duplicates):
        kept = {r.doc_id for r in drop(df).collect()}
        assert "a" in kept and "b" not in kept and None not in kept
    labels = spark.createDataFrame([(f"doc-{i}", i % 2) for i in range(5)], "doc_id string, quality int")
    machine = quality_fm.learn(toxicity.labelled_sample(df.withColumn("n_chars", F.length("text")), labels, "quality", F.lit(True), 10, "n_chars"))
    assert quality_fm.score_texts(df, machine).count() == len(rows)
    assert packing.pack(df).select("doc_id").distinct().count() == 8


def test_sample_is_bounded_when_ids_repeat(make, spark):
    df = make([(1, "b"), (1, "a"), (1, None)] * 5 + [(2, "c")])
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 0)], "doc_id bigint, toxic int")
    found = toxicity.labelled_sample(df, labels, "toxic", F.lit(True), 3)
    assert sorted((r.doc_id, r.y, r.text) for r in found.collect()) == [(1, 0, None), (2, 0, "c"), (2, 1, "c")]
    assert toxicity.labelled_sample(df, labels, "toxic", F.lit(True), 2).count() == 2


CLASHING = ["lang_pred", "score", "spans", "keep", "n_dropped", "doc", "ver", "key", "node", "root", "bands", "fp", "n_words", "hit_spans", "items", "_n", "_d", "_v", "y"]


def test_stages_keep_clashing_columns_and_long_texts(make, spark, tmp_path):
    rng = random.Random(36)
    spark.createDataFrame([(1, ops.prose(rng, 12))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    long = "\n".join(ops.prose(rng, 30) for _ in range(20_000))
    rows = [(i, ops.prose(rng, 50)) for i in range(12)] + [(50, long), (51, long), (52, ops.prose(rng, 300_000))]
    docs = make(rows, *CLASHING)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        assert docs.filter(" OR ".join(f"{c} <> 'x'" for c in CLASHING)).count() == 0, name
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert {50, 52} <= set(kept) and 51 not in kept and kept[50] == long
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    whole = ops.word_ids()
    assert {r.doc_id: r.n for r in placed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {d: len(whole(t)) + 1 for d, t in kept.items()}


def test_a_long_text_is_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 50)
    rng = random.Random(37)
    texts = [ops.prose(rng, 200), "x" * 300 + " é" + ops.prose(rng, 60), "<|endoftext|> " + ops.prose(rng, 50), "", None, "z" * 200]
    for t in texts:
        ids, at = tokens.ChunkTokenizer.of(None).encode_long(pa.array([t], pa.string()))
        assert ids.tolist() == ops.word_ids()(t) and at.tolist() == [0, len(ids)]


@pytest.mark.parametrize("held", [1, 3, 50_000])
def test_lines_of_very_many_versions_are_decided_by_the_join(make, monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD_ROWS", held)
    rng = random.Random(38)
    line = "the line that everyone holds"
    rows = [(None, f"{ops.prose(rng, 3)}\n{line}") for _ in range(60)] + [(4, f"{ops.prose(rng, 3)}\n{line}") for _ in range(30)] + [(i, line) for i in (2, 9)] + ops.line_rows(rng)
    df = make(rows)
    both = line_dedup.with_keeps(df.select("doc_id", "text"), line_dedup.line_keeps(df)).collect()
    import hashlib

    got = Counter((r.doc_id, (r.text or "").count("\n") + 1, r.n_dropped, hashlib.sha256((line_dedup.cut(r.text, r.keep) or "").encode()).hexdigest()) for r in both)
    assert got == ops.brute_lines(rows)


# files


def test_warc_files_hold_a_member_for_each_record(spark, tmp_path):
    rng = random.Random(39)
    pages = spark.createDataFrame([(i, f"http://a/{i}", "" if i == 3 else ops.prose(rng, rng.choice([5, 60_000]))) for i in range(20)], "page_id bigint, url string, html string").repartition(3)
    made = warc.derivatives(warc.responses(pages, ["page_id", "url"]), ["page_id", "url"])
    assert made.columns[:2] == ["page_id", "url"]
    rows, out = made.collect(), tmp_path / "out"
    warc.write_warc(made, str(out))
    files = sorted(out.iterdir())
    assert files and all(f.name.endswith(".warc.gz") for f in files)
    members = 0
    for f in files:
        data = f.read_bytes()
        while data:
            d = zlib.decompressobj(31)
            assert d.decompress(data).endswith(b"\r\n\r\n")
            data, members = d.unused_data, members + 1
    assert members == len(rows)
    want = sorted(bytes(r.record) for r in rows)
    assert sorted(bytes(r.record) for r in warc.read_warc(spark, str(out)).collect()) == want
    (tmp_path / "plain.warc").write_bytes(b"".join(gzip.decompress(f.read_bytes()) for f in files))
    assert sorted(bytes(r.record) for r in warc.read_warc(spark, str(tmp_path / "plain.warc")).collect()) == want
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(gzip.decompress(f.read_bytes()) for f in files)))
    assert sorted(bytes(r.record) for r in warc.read_warc(spark, str(tmp_path / "one.warc.gz")).collect()) == want
    warc.write_warc(made.limit(0), str(tmp_path / "none"))
    assert warc.read_warc(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        warc.responses(pages.withColumnRenamed("page_id", "record"), "record")


def test_histogram_blocks_carry_over(make):
    rows = [(i, "word " * (i * 7 % 400)) for i in range(120)]
    n = np.array([i * 7 % 400 for i in range(120)])
    for r in token_counts.length_histogram(make(rows)).collect():
        assert (r.docs_from, r.tokens_from) == ((n >= r.n_tokens).sum(), n[n >= r.n_tokens].sum())


def test_hits_of_a_long_text_are_found_in_one_pass():
    import time

    lexicon = toxicity.Lexicon({" badword ": 1.0, " bad": 0.5}, {"badword fine"})
    words = ["badword", "ok"] * 80_000 + ["badword", "fine"]
    began = time.process_time()
    hits = lexicon.hits(lexicon.automaton(), words)
    assert time.process_time() - began < 2 and [i for i, _ in hits] == list(range(0, 160_000, 2))


def test_stated_length_counts_characters():
    texts = ["plain words here", "ße öä ü straße größe", "слово за словом и ещё", "", None]
    slot, _, at = quality_fm.read_features(pa.array(texts, pa.string()), np.array([np.nan if t is None else len(t) for t in texts], float))
    first = quality_fm._WORD_SLOTS + quality_fm.STATS.index("stated") * quality_fm.BINS
    assert [first in slot[a:b] for a, b in zip(at[:-1], at[1:])] == [True, True, True, True, False]
