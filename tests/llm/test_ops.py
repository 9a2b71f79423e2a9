"""Every operator against a brute-force version, and on nulls, ties, repeats, empty and clashing inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from quarrystone.llm import decontaminate, language_id, line_dedup, packing, quality_fm, quality_rules, simhash, token_counts, tokens, toxicity, warc
from quarrystone.llm.components import connected_components

WORDS = "the of and to in is that for on with as was by at from house river stone light water paper music".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward(rng):
    base = prose(rng, 60)
    return [(1, None), (2, ""), (3, " \n\t "), (4, base), (4, base), (5, base), (None, base), (None, None), (6, "é—ß 日本"), (7, "x" * 3000), (8, prose(rng, 3000)), (9, base.upper())]


# op1, op4


def word_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_path())
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@given(st.lists(st.text(alphabet="abAZ019 '!.<|>\n\t\x0b̸̌éİσς—…中² ", max_size=30), max_size=8))
@settings(max_examples=200, deadline=None)
def test_chunked_ids_are_the_tokenizers_own(texts):
    ids, at = tokens.ChunkTokenizer.of(None).encode(pa.array(texts, pa.string()))
    whole = word_ids()
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [whole(t) for t in texts]


def test_special_token_strings_are_read_as_the_tokenizer_reads_them():
    texts = ["a<|endoftext|>b it's", "<|startoftext|> X'LL", None]
    ids, at = tokens.ChunkTokenizer.of(None).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [word_ids()(t) for t in texts]


def test_cache_generations_don_t_change_ids(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 3)
    t = tokens.ChunkTokenizer()
    for text in ("one two three four", "two five six seven eight", "one nine"):
        assert t.encode(pa.array([text]))[0].tolist() == word_ids()(text)


def test_token_histogram(make, spark):
    rows = awkward(random.Random(1))
    n = np.array([len(word_ids()(t)) for _, t in rows])
    h = token_counts.with_limits(token_counts.length_histogram(make(rows, "n_tokens", "block"))).collect()
    assert {r.n_tokens: r.n_docs for r in h} == Counter(n.tolist())
    for r in h:
        assert (r.docs_from, r.tokens_from) == ((n >= r.n_tokens).sum(), n[n >= r.n_tokens].sum())
        assert r.tokens_at_limit == np.minimum(n, r.n_tokens).sum() and r.docs_cut == (n > r.n_tokens).sum()
    hist = token_counts.length_histogram(make(rows))
    for r in token_counts.at_limits(hist, [0, 7, 50, 10**6]).collect():
        assert (r.tokens_at_limit, r.docs_cut) == (np.minimum(n, r.limit).sum(), (n > r.limit).sum())
    assert {r.share: r.n_tokens for r in token_counts.quantiles(hist, [0.5, 1.0]).collect()} == {0.5: np.sort(n)[(len(n) - 1) // 2], 1.0: n.max()}
    assert token_counts.length_histogram(make([])).count() == 0


def check_packed(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing(make, spark):
    rows = awkward(random.Random(2))
    out = packing.pack(make(rows, "sequence_id", "salt"), capacity=50).collect()
    want = Counter()
    for d, t in rows:
        ids = np.array([*word_ids()(t), 1], "<u4")
        for k, s in enumerate(range(0, len(ids), 50)):
            want[d, k, s, len(ids[s : s + 50]), zlib.crc32(ids[s : s + 50].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    n = check_packed(out, 50)
    assert n <= -(-sum(r.length for r in out) // 50) + 1
    assert packing.pack(make([])).count() == 0


def test_sequences_hold_the_documents(make):
    rng = random.Random(3)
    df = make([(i, prose(rng, rng.randrange(1, 40))) for i in range(30)])
    placed = packing.pack(df, capacity=64)
    found = packing.sequences(df, capacity=64).collect()
    assert sorted(sum((list(r.doc_ids) for r in found), [])) == sorted(r.doc_id for r in placed.collect())
    assert all(len(r.ids) <= 64 for r in found)
    rows = [(None, "one two"), (None, "one two"), (None, None), (7, "three"), (7, "four " * 100)]
    found, whole = packing.sequences(make(rows), capacity=16).collect(), word_ids()
    assert sum(len(r.ids) for r in found) == sum(len(whole(t)) + 1 for _, t in rows)
    assert sum(r.doc_ids.count(None) for r in found) == 3 and all(len(r.ids) <= 16 for r in found)


def test_place_with_many_buckets_a_length(make, spark):
    rows = [(i, "word " * (i % 3)) for i in range(60)]
    out = packing.place(packing.pieces(make(rows)), 8, bucket_pieces=4).collect()
    assert len(out) == 60 and check_packed(out, 8) == -(-sum(r.length for r in out) // 8)


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), min_size=1, max_size=12))
@settings(max_examples=150, deadline=None)
def test_plan_places_every_rank_once(counts):
    plan = packing.pack_histogram(counts, 30)
    fill = Counter()
    for length, n in counts.items():
        at = np.flatnonzero(plan["length"] == length)
        for rank in range(n):
            i = at[np.searchsorted(plan["rank"][at], rank, "right") - 1]
            k = rank - plan["rank"][i]
            fill[int(plan["base"][i] + k // plan["each"][i])] += length
    assert max(fill.values()) <= 30
    assert len(fill) <= 2 * -(-sum(k * v for k, v in counts.items()) // 30)


def test_reduction_fixes_what_nothing_beats():
    stock = packing._Stock({29: 2, 20: 3, 10: 2, 7: 1})
    fixed = packing.reduce_dominated(stock, 30)
    assert ([(29, 1)], 2) in fixed and ([(20, 1), (10, 1)], 2) in fixed
    exact = lambda items: min_bins([k for k, v in items.items() for _ in range(v)], 12)
    rng = random.Random(5)
    for _ in range(150):
        items = Counter(rng.randrange(1, 13) for _ in range(8))
        stock = packing._Stock(dict(items))
        done = sum(m for _, m in packing.reduce_dominated(stock, 12))
        assert done + exact(stock.n) == exact(items), items


def min_bins(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {x: k for k, x in enumerate(bins)}.values():
            if bins[b] + items[i] <= capacity:
                bins[b] += items[i]
                go(i + 1, bins)
                bins[b] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


# op2


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    k = min(3, len(w))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + k]).encode(), 42) for i in range(len(w) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    x = np.array(fps, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    label = np.arange(len(x))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(x))])
        if (new == label).all():
            return label
        label = new


def test_simhash_components(make):
    rng = random.Random(4)
    rows = awkward(rng)
    for g in range(6):
        base = prose(rng, 200).split()
        for i in range(8):
            words = list(base)
            for _ in range(i):
                words[rng.randrange(200)] = rng.choice(WORDS)
            rows.append((100 + 10 * g + i, " ".join(words)))
    out = simhash.components(make(rows, "fp", "root", "ver")).collect()
    fps = [fingerprint(t) for _, t in rows]
    label = brute_components(fps)
    low = {}
    for (d, _), c in zip(rows, label):
        if d is not None:
            low[c] = min(d, low.get(c, d))
    want = Counter((d, f - (1 << 64) if f >> 63 else f, low.get(c)) for (d, _), f, c in zip(rows, fps, label))
    assert Counter((r.doc_id, r.fp, r.component_id) for r in out) == want
    kept = simhash.drop_near_duplicates(make(rows, "fp", "_n", "_d", "_v", "root")).collect()
    assert all(r._n == r._d == r._v == r.fp == r.root == "x" for r in kept)
    assert len(kept) == len(set(label.tolist())) and {r.doc_id for r in kept if r.doc_id is not None} == set(low.values())
    assert simhash.components(make([])).count() == 0


@pytest.mark.parametrize("place_rows", [5, 20_000])
def test_links_connect_what_brute_force_connects(spark, place_rows):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = set(base)
    for b in base[:6]:
        for _ in range(40):
            x = b
            for _ in range(rng.randrange(1, 6)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    nodes = spark.createDataFrame(signed, "fp bigint")
    roots = {r.node: r.root for r in connected_components(simhash.near_links(nodes, 3, place_rows)).collect()}
    label = brute_components(fps)
    groups = {}
    for (s,), c in zip(signed, label):
        groups.setdefault(c, set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_plan_keeps_the_pigeonhole_bound():
    rng = np.random.default_rng(1)
    bits = rng.random((500, 64)) < rng.random(64)
    both = bits.T.astype(int) @ bits
    for n in (500, 10**6, 10**10):
        plan = simhash.allocate(n, (both * (n / 500)).astype(np.int64))
        used = sum(t + 1 for _, t in plan)
        assert used >= 4  # sum of (threshold + 1) over partitions reaches radius + 1
        assert sorted(b for g, _ in plan for b in g) == sorted({b for g, _ in plan for b in g})


@given(st.lists(st.integers(0, 2**64 - 1), max_size=600))
@settings(max_examples=50, deadline=None)
def test_majority_bits(values):
    want = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))
    assert simhash.majority_bits(np.array(values, np.uint64)) == want


def test_components_of_a_long_chain(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}
    assert connected_components(edges.limit(0)).count() == 0


# op8


def brute_lines(rows, min_chars=20, min_docs=3):
    ascii_lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    key = lambda line: ascii_lower(line.strip(" \t\n\x0b\x0c\r"))
    docs = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            docs.setdefault(key(line), set()).add(-1 if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(docs[key(x)]) >= min_docs and max(docs[key(x)]) != (-1 if d is None else d))]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


def line_rows(rng):
    pool = [prose(rng, 8) for _ in range(12)] + ["Ünïcödé lïne öf twénty", "short"]
    rows = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r", " \x0b"]) for _ in range(rng.randrange(1, 7)))) for i in range(80)]
    hot = pool[0].upper()
    return rows + [(i, hot) for i in range(100, 160)] + [(3, rows[3][1]), (3, hot), (None, hot), (None, hot), (500, None), (501, ""), (502, "\n\n")]


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_line_dedup(make, spark, partitions):
    rows = line_rows(random.Random(7))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = make(rows, "keep", "n_dropped", "ver", "h1")
        keeps = line_dedup.line_keeps(df)
        both = line_dedup.with_keeps(df.select("doc_id", "text"), keeps).collect()
        got = Counter((r.doc_id, (r.text or "").count("\n") + 1, r.n_dropped, hashlib.sha256((line_dedup.cut(r.text, r.keep) or "").encode()).hexdigest()) for r in both)
        assert got == brute_lines(rows)
        cut = line_dedup.apply_keep(df, keeps)
        assert cut.columns == df.columns and cut.count() == len(rows)
        assert cut.filter("keep = 'x' AND n_dropped = 'x' AND ver = 'x' AND h1 = 'x'").count() == len(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert line_dedup.line_keeps(make([])).count() == 0


@given(st.lists(st.booleans(), min_size=1, max_size=300))
def test_bitmap_round_trip(keep):
    drop = np.flatnonzero(~np.array(keep))
    assert line_dedup.read_bitmap(line_dedup.keep_bitmap(drop, len(keep)), len(keep)).tolist() == keep


# op9


def test_quality_rules(make):
    rng = random.Random(8)
    good = "\n".join(prose(rng, 12) + "." for _ in range(6))
    rep = "one two three four five six. " * 4
    rows = [*awkward(rng), (20, good), (21, good + "\nHome | About | Contact | Login | Help"), (22, rep), (23, "\n".join(["### $$$ %%% ***"] * 9) + "\n" + prose(rng, 12)), (24, good + "\n" + good)]
    out = {r.doc_id: r for r in quality_rules.quality_rules(make(rows, "kept", "_words", "_Lines")).collect()}
    assert all(r._words == r._Lines == "x" for r in out.values())
    for d, t in rows:
        r, w = out[d], re.findall(r"[^\x20\x09-\x0D]+", t or "")
        if d is None or d == 4:
            continue
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
        lines = [x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(hit), len(lines) - len(set(lines))), d
        assert r.base_failed == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
    assert out[20].kept and out[21].kept and out[21].n_failed_lines == 1 and out[21].clean_text == good
    assert not out[22].kept and not out[23].kept and not out[1].kept
    assert quality_rules.quality_rules(make([])).count() == 0


# op10


def brute_hits(text, items, window=10):
    words = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        k = min(window, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(w) - k + 1 if b else 0):
            if tuple(w[i : i + k]) in grams:
                hit |= set(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [200, 4 << 20])
def test_decontamination(make, spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice([1, 4, 10, 11, 30])) + f" item{i}") for i in range(12)] + [(12, None), (13, "... !!"), (14, "Ünï cödé")]
    items += [(15, items[2][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [*awkward(rng), (30, f"{prose(rng, 9)} {items[3][1].upper()} tail"), (31, "a, ÜNÏ-cödé? ünï cödé"), (32, items[4][1].replace(" ", ",\n")), (33, " ".join(t for _, t in items[:6]))]
    out = decontaminate.find_hits(make(rows, "items", "n_words", "hit_spans"), bench).collect()
    got = Counter((r.doc_id, r.n_words, decontaminate.hit_words(r.hit_spans), ",".join(r["items"])) for r in out)
    want = Counter((d, n, h, ",".join(i)) for d, t in rows for n, h, i in [brute_hits(t, items)])
    assert got == want
    clean = decontaminate.decontaminate(make(rows), bench, max_share=1.0).collect()
    assert len(clean) == len(rows) and all(brute_hits(r.text, items)[1] == 0 for r in clean if r.doc_id in (30, 32))
    assert {r.doc_id for r in decontaminate.decontaminate(make(rows), bench, "documents").collect()} == {d for d, t in rows if not brute_hits(t, items)[1]}
    assert decontaminate.find_hits(make(rows), bench.limit(0)).filter("size(items) > 0").count() == 0


# op7


def test_language_id(make):
    rng = random.Random(10)
    words = {"en": ["the", "house", "with", "thing"], "de": ["der", "und", "nicht", "schön"], "ru": ["это", "дом", "вода", "они"]}
    say = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, say(lang, 30), lang) for i, lang in enumerate(["en", "de", "ru"] * 8)] + [(90, say("en", 5), None)]
    model = language_id.train(make(rows))
    assert model.languages == ["de", "en", "ru"]
    tests = [(1, say("en", 12)), (2, say("de", 12)), (3, say("ru", 12)), (4, None), (5, ""), (6, "123 !!"), (7, say("en", 20) + " " + say("de", 40)), (None, say("en", 3)), (8, say("ru", 2) * 900)]
    out = language_id.detect(make(tests, "lang_pred", "spans"), model, spans=True).collect()
    got = {r.doc_id: r.lang_pred for r in out}
    assert got == {1: "en", 2: "de", 3: "ru", 4: "und", 5: "und", 6: "und", 7: "de", None: "en", 8: "ru"}
    mixed = next(r for r in out if r.doc_id == 7)
    assert [(s.a, s.b, s.lang) for s in mixed.spans] == [(0, 20, "en"), (20, 60, "de")]
    assert all(r.score == 0 for r in out if r.lang_pred == "und")
    none = language_id.detect(make(tests), language_id.train(make([])))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_viterbi_is_the_best_path_and_the_shortcut_agrees():
    rng = np.random.default_rng(2)
    for trial in range(60):
        s = [rng.normal(0, 2, (rng.integers(1, 7), 3)) for _ in range(4)]
        value = lambda path, x: sum(x[i, p] for i, p in enumerate(path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:]))
        for x, path in zip(s, language_id.viterbi(s, 3.0)):
            best = max(value(p, x) for p in np.ndindex(*[3] * len(x)))
            assert abs(value(path.tolist(), x) - best) < 1e-9
            codes = np.arange(len(x))
            short = language_id.label_words(x, codes, np.array([0, len(x)]), 3.0)
            assert abs(value(short.tolist(), x) - best) < 1e-9


# op3, op5


def auc(score, y):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(y))
    ranks[order] = np.arange(1, len(y) + 1)
    return (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


def test_folding():
    assert toxicity.fold("Tr4sh іdiоt $tupid l0ser 2023") == "trash idiot stupid loser 2023"
    assert toxicity.fold("ｆｏｏ b​ad") == "foo bad"


def test_lexicon_hits_and_exceptions():
    lex = toxicity.Lexicon({" vile": 3.0, " vile ": 5.0, " scum ": 2.0}, {"pond scum"})
    hits = lambda t: lex.hits(lex.automaton(), toxicity.folded_words(t))
    assert hits("V1le vileness pond scum, scum!") == [(0, 5.0), (1, 3.0), (4, 2.0)]
    assert hits("") == [] and toxicity.Lexicon({}).hits(None, ["a"]) == []


def test_toxicity_learns(make, spark):
    rng = random.Random(11)
    rows, y = [], {}
    for i in range(240):
        bad = i % 4 == 0
        words = prose(rng, 40).split()
        if bad:
            for w in rng.sample(["vile", "vileness", "wretch", "scum"], 2):
                words.insert(rng.randrange(40), w)
        rows.append((i, " ".join(words)))
        y[i] = int(bad)
    labels = spark.createDataFrame(list(y.items()) + [(999, None), (None, 1)], "doc_id bigint, toxic int")
    lex = toxicity.learn(toxicity.labelled_sample(make(rows[:160]), labels, "toxic", labels.doc_id.isNotNull(), 1000))
    more = [*rows[160:], (900, None), (901, ""), (902, "W R E T C H"), (903, "you wr3tch, what sсum"), (903, "fine")]
    out = toxicity.score_texts(make(more, "score"), lex).collect()
    s = {r.doc_id: r.score for r in out if r.text is None or r.text != "fine"}
    held = [i for i, _ in rows[160:]]
    assert auc(np.array([s[i] for i in held]), np.array([y[i] for i in held])) > 0.99
    assert s[903] > 0.7 and s[900] < 0.5 and all(0 <= v <= 1 for v in s.values())
    none = toxicity.learn(toxicity.labelled_sample(make(rows), labels.limit(0), "toxic", labels.doc_id.isNotNull(), 10))
    assert {round(r.score, 6) for r in toxicity.score_texts(make(rows[:5]), none).collect()} == {0.0}


def test_factorisation_identity():
    rng = np.random.default_rng(3)
    slots = rng.choice(quality_fm._SLOTS, 12, replace=False)
    x, at = rng.normal(size=12), np.array([0, 5, 12])
    m = quality_fm.Machine(0.3, rng.normal(size=quality_fm._SLOTS), rng.normal(size=(quality_fm._SLOTS, quality_fm.RANK)))
    for got, a, b in zip(m.raw(slots, x, at), at[:-1], at[1:]):
        pairs = sum(m.factors[slots[i]] @ m.factors[slots[j]] * x[i] * x[j] for i in range(a, b) for j in range(i + 1, b))
        assert abs(got - (0.3 + (m.linear[slots[a:b]] * x[a:b]).sum() + pairs)) < 1e-9


def test_quality_learns(make, spark):
    rng = random.Random(12)
    rows, y = [], {}
    for i in range(240):
        good = i % 3 > 0
        rows.append((i, prose(rng, 50) + "." if good else " ".join(w.upper() + "!!" for w in prose(rng, 50).split())))
        y[i] = int(good)
    labels = spark.createDataFrame(list(y.items()), "doc_id bigint, quality int")
    m = quality_fm.learn(toxicity.labelled_sample(make(rows[:160]), labels, "quality", labels.doc_id.isNotNull(), 1000, "n_chars"))
    more = [*rows[160:], (900, None), (901, ""), (902, "\n\n"), (None, "x" * 5000)]
    out = quality_fm.score_texts(make(more, "score"), m).collect()
    s = {r.doc_id: r.score for r in out}
    held = [i for i, _ in rows[160:]]
    assert auc(np.array([s[i] for i in held]), np.array([y[i] for i in held])) > 0.99
    assert len(out) == len(more) and all(0 <= v <= 1 for v in s.values())
    assert quality_fm.score_texts(make(more).drop("n_chars"), quality_fm.fit(np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64), np.zeros(0))).filter("score = 0.5").count() == len(more)


# op6


def test_warc(spark, tmp_path):
    html = '<html><head><title>A &amp; B</title><style>x{}</style></head><body><p>One<br>two &lt;3</p><script>no()</script><a href="/x?a=1&amp;b">link</a><!-- c --></body></html>'
    pages = spark.createDataFrame([(1, "http://a/b", html, "z"), (2, None, None, "z"), (3, "http://c", "", "z"), (1, "http://a/b", html, "z")], "page_id bigint, url string, html string, record string")
    made = warc.derivatives(warc.responses(pages))
    rows = made.collect()
    assert len(rows) == 8
    one = [r for r in rows if r.page_id == 1]
    meta, text = next(r for r in one if r.warc_type == "metadata"), next(r for r in one if r.warc_type == "conversion")
    assert len({(r.record_id, bytes(r.record)) for r in one}) == 2
    assert meta.refers_to == text.refers_to and meta.concurrent_to == text.record_id and text.concurrent_to == meta.record_id
    head, headers, body = warc.parse_head(bytes(text.record))
    assert head == "WARC/1.1" and body.decode() == "One\ntwo <3\nlink" and warc.digest(body) == text.block_digest and dict(headers)["Content-Length"] == str(len(body))
    _, _, data = warc.parse_head(bytes(meta.record))
    import json

    m = json.loads(data)
    assert m["HTML"] == {"Title": "A & B", "Links": ["/x?a=1&b"]} and m["Payload"]["Digest"] == m["Payload"]["Declared-Digest"] == warc.digest(html.encode())
    assert dict(map(tuple, m["Source"]["WARC-Headers"]))["WARC-Record-ID"] == meta.refers_to
    two = [r for r in rows if r.page_id == 2]
    assert {r.content_length for r in two if r.warc_type == "conversion"} == {0} and all(r.target_uri is None for r in two)
    warc.write_warc(made, str(tmp_path / "out"))
    back = warc.read_warc(spark, str(tmp_path / "out"))
    assert sorted(bytes(r.record) for r in back.collect()) == sorted(bytes(r.record) for r in rows)
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_warc_codings_and_damage():
    import gzip

    payload = gzip.compress("<p>é</p>".encode("latin-1"))
    chunked = b"%x\r\n" % len(payload) + payload + b"\r\n0\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\nX-A: b\r\n c\r\n\r\n" + chunked
    rows = warc.derive(warc.build_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block))
    assert rows[1]["record"].endswith("\r\n\r\né".encode()) and rows[1]["refers_to"] == "<urn:x>"
    for bad in (None, b"", b"junk", b"WARC/1.1\r\nWARC-Type: response\r\n\r\nno http"):
        rows = warc.derive(bad)
        assert len(rows) == 1 and b'"error"' in rows[0]["record"]
