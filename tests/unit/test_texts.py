"""Sections, personal data, logs, schemas and fingerprints against plain Python."""

import hashlib
import json
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import clean, impute as im, pii, provenance as pr, sections as se
from quarrystone.sources import tables as so


def test_later_siblings_equal_the_definition():
    rng = random.Random(7)
    for _ in range(200):
        levels = [rng.randrange(1, 5) for _ in range(rng.randrange(0, 12))]
        want = []
        for i, level in enumerate(levels):
            later = next((x for x in levels[i + 1 :] if x <= level), None)
            want.append(later == level)
        assert se.later_siblings(levels) == want


def test_fuzzy_matches_go_by_case(spark):
    df = spark.createDataFrame([(["HISTORY"],), (["History"],), ([],)], "parents array<string>")
    assert [r.parents for r in se.filter_sections(df, ["HISTORY"], "fuzzy", 90).collect()] == [["HISTORY"]]
    assert [r.parents for r in se.filter_sections(df, ["History"], "fuzzy", 90).collect()] == [["History"]]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, x in enumerate(b):
            new.append(row[j] + 1 if x == c else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_fuzzy_ratio_is_that_of_the_common_subsequence(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 9))) for _ in range(30)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for b in ("abcab", "é a", ""):
        for r in df.select("w", se.fuzzy_ratio(F.col("w"), b).alias("f")).collect():
            assert abs(r.f - (200 * lcs(r.w, b) / (len(r.w) + len(b)) if r.w or b else 100)) < 1e-9


def test_headers_by_marks(spark):
    lines = [(1, i, x) for i, x in enumerate(["# One", "###### Six", "####### Seven", "##", "**Bold**", "***B I***", "*it*", "**A:** b", "plain # no", "#" * 3 + " " + "w " * 13])]
    got = {r.line_no: (r.kind, r.marker_count, r.label) for r in se.classify_lines(spark.createDataFrame(lines, "id int, line_no int, line string")).collect()}
    assert got == {0: ("hash", 1, "One"), 1: ("hash", 6, "Six"), 2: ("hash", 6, "# Seven"), 3: ("hash", 2, ""), 4: ("asterisk", 2, "Bold"), 5: ("asterisk", 3, "B I"), 6: ("asterisk", 1, "it"), 7: ("inline", 2, "A"), 8: ("content", None, None), 9: ("content", None, None)}


def test_losses_of_both_formats(spark):
    log = "x\nEpoch: 0 | critic_loss: -0.5 | generator_loss: 1e-3\nEpoch: 1 | disc_loss: 2 | gen_loss: .25 junk Epoch: 2 | disc_loss: 1.2.3 | gen_loss: 3"
    got = se.training_losses(spark.createDataFrame([(1, log), (2, None), (3, "")], "id int, text string")).collect()
    assert sorted((r.id, r.epoch, r.critic_loss, r.generator_loss) for r in got if r.critic_loss is not None) == [(1, 0, -0.5, 0.001), (1, 1, 2.0, 0.25)]
    assert [(r.epoch, r.critic_loss, r.generator_loss) for r in got if r.critic_loss is None] == [(2, None, 3.0)]


def test_findings_have_their_places(spark):
    texts = ["", None, "é a@b.co x 4111 1111 1111 1111 and 4111-1111-1111-1112", "call 555-123-4567, 10.0.0.1! A1234567 é1@x.yz"]
    rows = pii.pattern_findings(spark.createDataFrame(list(enumerate(texts)), "id int, text string")).collect()
    for r in rows:
        assert all(r.text[f.start : f.end] == f.text for f in r.findings or [])
    assert [f.text for f in rows[2].findings if f.entity == "CREDIT_CARD"] == ["4111 1111 1111 1111"]
    assert {f.entity for f in rows[3].findings} >= {"PHONE_NUMBER", "IP_ADDRESS", "US_DRIVER_LICENSE"} and not rows[0].findings and not rows[1].findings
    assert pii.luhn("79927398713") and not pii.luhn("79927398710")


def greedy(findings):
    kept = []
    for f in sorted(findings, key=lambda f: (-f[3], f[1] - f[2], f[1], f[0])):
        if all(f[2] <= k[1] or k[2] <= f[1] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[1])


def test_overlaps_go_to_the_best(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        found = []
        for _ in range(rng.randrange(0, 7)):
            a = rng.randrange(0, 20)
            found.append((rng.choice("ABC"), a, a + rng.randrange(1, 6), rng.choice([0.2, 0.5]), "t"))
        rows.append((i, found))
    df = spark.createDataFrame(rows, f"id int, findings {pii.FINDING}")
    for r in df.select("id", pii.resolve_overlaps(F.col("findings")).alias("f")).collect():
        assert [tuple(f) for f in r.f] == greedy(rows[r.id][1]), rows[r.id]


def test_anonymised_sections_put_back_give_the_source(spark, tmp_path):
    rows = [(1, "mail a@b.co or 10.0.0.1 now"), (2, "nothing"), (3, "")]
    df = spark.createDataFrame(rows, "id int, content string")
    out = {r.id: r for r in pii.anonymise_sections([df.filter("id < 2"), df.filter("id >= 2")]).collect()}
    assert out[1].anonymised == "mail <ANONYMIZED> or <ANONYMIZED> now" and out[2].anonymised == "nothing" and out[3].anonymised == ""
    assert sorted((k, v.end) for k, v in out[1].offsets.items()) == [(5, 11), (15, 23)]
    pii.write_anonymised(pii.anonymise(pii.pattern_findings(df.withColumnRenamed("content", "text"))), str(tmp_path / "w"))
    back = {r.id: r for r in spark.read.parquet(str(tmp_path / "w")).collect()}
    assert back[1].source == rows[0][1] and len(back[1]["items"]) == 2 and back[2].offsets == {}
    allowed = spark.createDataFrame([("a@b.co",)], "text string")
    table = pii.findings_table(pii.pattern_findings(df.withColumnRenamed("content", "text")), ["id"])
    assert [r.text for r in pii.allow_texts(table, allowed).collect()] == ["10.0.0.1"]


def test_schema_file_and_its_faults(spark, tmp_path):
    def write(lines):
        (tmp_path / "s.csv").write_text("column,kind,ordinal_order\n" + "\n".join(lines))
        return str(tmp_path / "s.csv")

    good = ["age,continuous,", 'level,ordinal,"[""low"", ""high""]"', "site,nominal,", "y,nominal,"]
    out = so.load_variable_schema(spark, write(good), ["age", "level", "site", "y"], "y")
    assert {r.column: (r.kind, r.ordinal_order) for r in out.collect()} == {"age": ("continuous", None), "level": ("ordinal", ["low", "high"]), "site": ("nominal", None)}
    bad = ["age,continuous,[1]", "level,ordinal,", "site,odd,", "site,nominal,", "stale,nominal,"]
    with pytest.raises(ValueError) as e:
        so.load_variable_schema(spark, write(bad), ["age", "level", "site", "new"])
    assert all(x in str(e.value) for x in ("declared twice", "not declared", "not in the data", "unknown kind", "order on a continuous", "without a valid order"))


def test_fingerprints(spark, tmp_path, monkeypatch):
    (tmp_path / "a").write_bytes(b"x" * 3_000_000)
    (tmp_path / "b").write_bytes(b"y")
    want = {("a", 3_000_000, hashlib.sha256(b"x" * 3_000_000).hexdigest()), ("b", 1, hashlib.sha256(b"y").hexdigest())}
    for limit in (1 << 26, 10):  # whole, and as a stream
        monkeypatch.setattr(pr, "WHOLE_BYTES", limit)
        got = pr.file_fingerprint(spark, str(tmp_path)).collect()
        assert {(r.path.rsplit("/", 1)[1], r.bytes, r.sha256) for r in got} == want
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "k int, s string")
    d = lambda x: pr.fingerprint(x).first().digest
    assert d(df) == d(df.repartition(3)) and len({d(df), d(df.distinct()), d(df.withColumnRenamed("s", "z")), d(df.fillna(""))}) == 4


def test_second_pass_starts_from_the_first(spark):
    rng = random.Random(10)
    rows = [(f"k{i}", x := rng.gauss(0, 1), None if i % 5 == 0 else 2 * x, None if i % 7 == 0 else "p" if x > 0 else "n") for i in range(200)]
    df = spark.createDataFrame(rows, "key string, x double, y double, c string")
    first = im.impute(df, "key", ["x", "y"], ["c"], "model", refine=["y", "c"])
    both = im.polish(df, first, "key", ["x", "y"], ["c"], ["y", "c"])
    for out in (first, both, im.impute(df, "key", ["x", "y"], ["c"], "model", passes=2, refine=["y", "c"])):
        got = {r.key: r for r in out.collect()}
        assert all(got[k].y == y for k, _, y, _ in rows if y is not None)
        gaps = [(got[k].y - 2 * x) ** 2 for k, x, y, _ in rows if y is None]
        assert sum(gaps) / len(gaps) < 0.5
        assert sum(got[k].c == ("p" if x > 0 else "n") for k, x, _, c in rows if c is None) > 24


def test_decode_diagnostics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.2, 0.9)], "a double, b double")
    got = clean.decode_diagnostics(df, {"x": ["a", "b"], "y": ["a"]}, {"x": 3, "y": 2}).collect()
    assert [(r.column, r.n_rows, r.n_categories, r.n_invalid, r.policy) for r in got] == [("x", 3, 3, 1, "clip")]
    with pytest.raises(ValueError):
        clean.decode_diagnostics(df, {"x": ["a", "b"]}, {"x": 3}, "error")


def test_json_reports(spark):
    df = spark.createDataFrame([(1, 4, 2, ["A"], ["#1"], "é\n\"q\""), (1, 2, 1, [], [], "x")], "id int, start_line int, level int, parents array<string>, parent_types array<string>, content string")
    r = json.loads(se.sections_json(df).first().json)
    assert [s["content"] for s in r["sections"]] == ["x", 'é\n"q"'] and re.match("A", r["sections"][1]["parents"][0])


def test_context_raises_scores(spark):
    rows = [(1, "please CALL me at 1234"), (2, "call one two three four five 1234 and 9"), (3, None), (4, "1234 call"), (5, "call " + "-" * 700 + " 1234"), (6, "recall 1234")]
    df = spark.createDataFrame(rows, "id int, text string")
    found = {r.id: [round(f.score, 6) for f in r.findings] for r in pii.pattern_findings(df, patterns=[("N", r"[0-9]{4}", 0.01, ["Call"])]).collect()}
    assert found == {1: [0.4], 2: [0.01], 3: [], 4: [0.01], 5: [0.4], 6: [0.01]}
    both = {r.id: [round(f.score, 6) for f in r.f] for r in pii.search(df, "text", pii.pattern_table(spark, [("N", r"[0-9]{4}", 0.5, ["call"])]), "f", 5, 1).collect()}
    assert both == {1: [0.85], 2: [0.5], 3: [], 4: [0.85], 5: [0.85], 6: [0.5]}
    assert pii.pattern_findings(df, patterns=pii.pattern_table(spark, [("N", r"[0-9]{4}", 0.5), ("X", r"call", 1.0)]), entities=["X"]).selectExpr("sum(size(findings)) n").first().n == 4


def test_texts_are_searched_in_slices(spark, monkeypatch):
    monkeypatch.setattr(pii, "SLICE_CHARS", 10)
    df = spark.createDataFrame([(i, "x1 " * i if i else None) for i in range(12)], "id int, text string")
    assert all(len(r.findings) == r.id for r in pii.pattern_findings(df, patterns=[("D", "[0-9]", 1.0)]).collect())


def test_trees(spark):
    docs = [(1, "# Alpha\nintro\n## Beta\ndeep\n# Gamma\n**Key:** v", 5), (2, None, 6), (3, "  ", None), (4, "no header", 7)]
    got = {r.id: json.loads(r.json) for r in se.sections_tree(spark.createDataFrame(docs, "id int, content string, m int"), metadata=["m"]).collect()}
    brief = lambda s: [(x["text"], x["level"], brief(x["sections"])) if x["type"] == "header" else x["text"] for x in s]
    assert {i: (v["id"], v.get("m"), brief(v["sections"])) for i, v in got.items()} == {
        1: (1, 5, [("Alpha", 1, ["intro", ("Beta", 2, ["deep"])]), ("Gamma", 1, [("Key", 2, ["v"])])]), 2: (2, 6, []), 3: (3, None, []), 4: (4, 7, ["no header"]),
    }


def test_documents_of_equal_content_keep_their_rows(spark):
    docs = spark.createDataFrame([("# A\none\ntwo", 1), ("# A\none\ntwo", 2), ("three", 3), (None, 4)], "content string, m int")
    rows = se.parse_sections(docs, metadata=["m"]).collect()
    assert sorted((r.m, r.content, r.parents) for r in rows) == [(1, "one\ntwo", ["A"]), (2, "one\ntwo", ["A"]), (3, "three", [])]


def test_levels_leave_content_outside_python(spark):
    long = "word " * 5000
    docs = [(i, f"# Head {i}\n{long}\n## Sub\n**Name:** x{i}\n{long}") for i in range(30)] + [(99, None)]
    tokens = se.content_blocks(se.classify_lines(se.markdown_lines(spark.createDataFrame(docs, "id int, content string"))))
    out = se.header_levels(tokens)
    plan = out._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    rows = {(r.id, r.start_line, r.part): r for r in out.collect()}
    assert len(rows) == 30 * 6
    assert (rows[3, 2, 0].level, rows[3, 2, 0].parents, rows[3, 2, 0].length) == (2, ["Head 3"], len(long) - 1)
    assert (rows[3, 4, 1].parents, rows[3, 4, 1].content, rows[3, 5, 0].parents) == (["Head 3", "Sub", "Name"], "x3", ["Head 3", "Sub"])


def test_token_slices_cover_all_lists():
    lists = [[1] * 5, [], None, [1] * 30, [1], [1]]
    parts = [p.to_pylist() for p in se.token_slices(pa.array(lists, pa.list_(pa.int32())), 8)]
    assert sum(parts, []) == lists and max(sum(len(x or []) for x in p[:-1]) for p in parts) <= 8
