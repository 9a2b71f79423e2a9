"""Queries of Markdown sections and personal data over documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.operators import pii, sections as se
from quarrystone.plans.catalog import query, t

#: Documents have no headings of their own; every one gets these around its text.
_MD = "'# REPORT TITLE\n**Name:** doc_' || doc_id || '\n**REASON FOR VISIT**\n' || text || '\n## Part ' || lang || '\n*note*\nseen by staff\n\n**History**: none\n***deep***\nend ' || source"
MD = f"md AS (SELECT doc_id AS id, {_MD} AS content FROM documents)"


def md(s, d):
    return t(s, d, "documents").select(F.col("doc_id").alias("id"), F.expr(_MD.replace("\n", "\\n")).alias("content"))


LINES = f"{MD}, ln AS (SELECT id, i::INT AS line_no, ls[i] AS line FROM (SELECT id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT id, string_split(content, chr(10)) AS ls FROM md)))"
_WORDS = r"len(list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')) <= 12"


def _q(p: str) -> str:
    return "'" + p.replace("'", "''") + "'"


def _chain(patterns, what: str) -> str:
    out = []
    for n, p in patterns:
        then = str(n) if what == "n" else f"trim(regexp_extract(line, {_q(p)}, {1 if what == 'l' else 2}))"
        out.append(f"WHEN regexp_matches(line, {_q(p)}) THEN {then}")
    return f"CASE {' '.join(out)} END"


_PLAIN = f"NOT regexp_matches(regexp_replace(label, '[A-Za-z]', '', 'g'), {_q(se._OTHER_WORD)})"
CASE_SQL = f"""CASE WHEN label IS NULL THEN NULL WHEN NOT regexp_matches(label, '[A-Za-z]') THEN 'mixed_case' WHEN NOT regexp_matches(label, '[a-z]') THEN 'all_caps' WHEN NOT regexp_matches(label, '[A-Z]') THEN 'all_lowercase'
 WHEN {_PLAIN} AND NOT regexp_matches(label, {_q(se._SMALL_START)}) THEN 'title_case' WHEN {_PLAIN} AND regexp_matches(label, '^[A-Z]') AND NOT regexp_matches(substr(label, 2), '[A-Z]') THEN 'sentence_case' ELSE 'mixed_case' END"""
CLS = f"""{LINES}, k0 AS (SELECT *, {_chain(se.INLINE, 'n')} AS i_n, {_chain(se.INLINE, 'l')} AS i_l, {_chain(se.INLINE, 'r')} AS i_r, CASE WHEN regexp_matches(line, {_q(se.HASH)}) THEN length(regexp_extract(line, {_q(se.HASH)}, 1))::INT END AS h_n, CASE WHEN regexp_matches(line, {_q(se.HASH)}) THEN trim(regexp_extract(line, {_q(se.HASH)}, 2)) END AS h_l, {_chain(se.ASTERISK, 'n')} AS a_n, {_chain(se.ASTERISK, 'l')} AS a_l FROM ln),
k1 AS (SELECT *, CASE WHEN i_n IS NOT NULL AND {_WORDS.format(x='i_l')} THEN 'inline' WHEN h_n IS NOT NULL AND {_WORDS.format(x='h_l')} THEN 'hash' WHEN a_n IS NOT NULL AND {_WORDS.format(x='a_l')} THEN 'asterisk' ELSE 'content' END AS kind FROM k0),
k2 AS (SELECT *, CASE kind WHEN 'inline' THEN i_l WHEN 'hash' THEN h_l WHEN 'asterisk' THEN a_l END AS label, CASE kind WHEN 'inline' THEN i_n WHEN 'hash' THEN h_n WHEN 'asterisk' THEN a_n END AS marker_count, CASE WHEN kind = 'hash' THEN '#' WHEN kind <> 'content' THEN '*' END AS marker FROM k1),
cls AS (SELECT *, {CASE_SQL} AS "case", CASE WHEN kind = 'inline' THEN i_r END AS inline_text FROM k2)"""
SIG = """marker || marker_count || CASE WHEN "case" = 'all_caps' THEN '-CAPS' ELSE '' END || CASE WHEN kind = 'inline' THEN '-inline' ELSE '' END"""
BLOCKS = f"""{CLS}, isl AS (SELECT *, sum((kind <> 'content')::INT) OVER (PARTITION BY id ORDER BY line_no) AS g FROM cls),
blk AS (SELECT id, line_no AS start_line, 0 AS part, true AS is_header, label AS content FROM cls WHERE kind <> 'content' UNION ALL SELECT id, line_no, 1, false, inline_text FROM cls WHERE kind = 'inline'
UNION ALL SELECT * FROM (SELECT id, min(line_no), 0, false, regexp_replace(string_agg(line, chr(10) ORDER BY line_no), '^\\s+|\\s+$', '', 'g') AS content FROM isl WHERE kind = 'content' GROUP BY id, g) WHERE content <> '')"""
#: Texts bring no headings, so every document has the same skeleton and its rows can be stated.
SECTIONS = f"""{MD}, d AS (SELECT doc_id AS id, len(string_split(text, chr(10))) AS n, lang, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS body, source FROM documents),
sec AS (SELECT id, 2 AS start_line, 3 AS level, ['REPORT TITLE', 'Name'] AS parents, ['#1-CAPS', '*2-inline'] AS parent_types, 'doc_' || id AS content FROM d
UNION ALL SELECT id, 4, 2, ['REASON FOR VISIT'], ['*2-CAPS'], body FROM d WHERE body <> ''
UNION ALL SELECT id, 6 + n, 4, ['REASON FOR VISIT', 'Part ' || lang, 'note'], ['*2-CAPS', '#2', '*1'], 'seen by staff' FROM d
UNION ALL SELECT id, 8 + n, 5, ['REASON FOR VISIT', 'Part ' || lang, 'note', 'History'], ['*2-CAPS', '#2', '*1', '*2-inline'], 'none' FROM d
UNION ALL SELECT id, 10 + n, 3, ['REASON FOR VISIT', 'deep'], ['*2-CAPS', '*3'], 'end ' || source FROM d)"""


def tokens(s, d):
    return se.content_blocks(se.classify_lines(se.markdown_lines(md(s, d))))


def sections(s, d):
    return se.parse_sections(md(s, d), "content", "id")


@query("markdown_lines", f"WITH {LINES} SELECT * FROM ln")
def _(s, d):
    return se.markdown_lines(md(s, d))


@query("classify_lines", f"""WITH {CLS} SELECT id, line_no, kind, marker, marker_count, label, inline_text, "case", {SIG} AS signature FROM cls""")
def _(s, d):
    return se.classify_lines(se.markdown_lines(md(s, d))).drop("line")


@query("detect_case", f"""WITH lab AS (SELECT doc_id, string_split(text, chr(10))[1] AS label FROM documents) SELECT doc_id, {CASE_SQL} AS kind FROM lab""")
def _(s, d):
    return t(s, d, "documents").select("doc_id", se.detect_case(F.get(F.split("text", "\n"), F.lit(0))).alias("kind"))


@query("header_signature", f"""WITH {CLS} SELECT {SIG} AS signature, count(*)::BIGINT AS n FROM cls WHERE kind <> 'content' GROUP BY 1""")
def _(s, d):
    return se.classify_lines(se.markdown_lines(md(s, d))).filter("kind <> 'content'").groupBy("signature").agg(F.count("*").alias("n"))


@query("word_count", r"SELECT doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))::INT AS n FROM documents")
def _(s, d):
    return t(s, d, "documents").select("doc_id", se.word_count(F.col("text")).alias("n"))


@query("content_id", "SELECT doc_id, sha256(text) AS id FROM documents")
def _(s, d):
    return t(s, d, "documents").select("doc_id", se.content_id(F.col("text")).alias("id"))


@query("content_blocks", f"WITH {BLOCKS} SELECT id, start_line, part, is_header, content FROM blk")
def _(s, d):
    return tokens(s, d).select("id", "start_line", "part", "is_header", "content")


@query("header_levels", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, level, len(parents)::INT AS depth FROM sec")
def _(s, d):
    return se.header_levels(tokens(s, d)).filter("NOT is_header").select("id", "start_line", "level", F.size("parents").alias("depth"))


@query("parse_sections", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, level, length(content)::INT AS length, array_to_string(parents, '|') AS parents, array_to_string(parent_types, '|') AS parent_types, content FROM sec")
def _(s, d):
    return sections(s, d).withColumns({"parents": F.array_join("parents", "|"), "parent_types": F.array_join("parent_types", "|")})


@query("has_more_siblings", f"WITH {MD}, d AS (SELECT doc_id AS id, len(string_split(text, chr(10))) AS n FROM documents) SELECT id, unnest([1, 2, 3, 4 + n, 5 + n, 8 + n, 9 + n])::INT AS start_line, unnest([true, false, false, true, false, false, false]) AS more FROM d")
def _(s, d):
    return se.has_more_siblings(se.header_levels(tokens(s, d))).select("id", "start_line", "more")


@query("filter_sections", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, content FROM sec WHERE parents[-1] IN ('Name', 'History')")
def _(s, d):
    return se.filter_sections(sections(s, d), ["Name", "History", "Absent"]).select("id", "start_line", "content")


@query("filter_sections_ci", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, content FROM sec WHERE lower(parents[-1]) = 'reason for visit'")
def _(s, d):
    return se.filter_sections(sections(s, d), ["Reason for Visit"], "case_insensitive").select("id", "start_line", "content")


@query("filter_sections_fuzzy", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, content FROM sec WHERE parents[-1] IN ('REASON FOR VISIT')")
def _(s, d):
    return se.filter_sections(sections(s, d), ["REASONS FOR VISITS", "HISTORY"], "fuzzy", 85.0).select("id", "start_line", "content")


# brands differ in their one or two digits only, and those that are 3 are in common with "33"
@query("fuzzy_ratio", "SELECT p_partkey, round(200 * (6 + length(p_brand) - length(replace(p_brand, '3', ''))) / (length(p_brand) + 8), 6) AS ratio FROM part")
def _(s, d):
    p = t(s, d, "part")
    return p.select("p_partkey", F.round(se.fuzzy_ratio(F.col("p_brand"), "Brand#33"), 6).alias("ratio"))


@query("add_name", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, 'doc_' || id AS name FROM sec")
def _(s, d):
    return se.add_name(sections(s, d)).select("id", "start_line", "name")


@query("lookup_by_id", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, min_by(content, start_line) FILTER (level >= 4) OVER (PARTITION BY id) AS found FROM sec")
def _(s, d):
    return se.lookup_by_id(sections(s, d), F.col("level") >= 4).select("id", "start_line", "found")


@query("first_per_id", f"WITH {SECTIONS} SELECT id, min(start_line)::INT AS start_line, min_by(content, start_line) AS content FROM sec GROUP BY id")
def _(s, d):
    return se.first_per_id(sections(s, d)).select("id", "start_line", "content")


@query("union_sections", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, content FROM sec WHERE level = 2 UNION ALL SELECT id, start_line::INT, content FROM sec WHERE level <= 3")
def _(s, d):
    x = sections(s, d)
    return se.union_sections(x.filter("level = 2"), x.filter("level <= 3")).select("id", "start_line", "content")


@query("join_by_id", f"WITH {SECTIONS} SELECT documents.doc_id AS id, start_line::INT AS start_line, documents.lang FROM documents LEFT JOIN (SELECT * FROM sec WHERE level = 5 AND id % 2 = 0) x ON x.id = doc_id")
def _(s, d):
    docs = t(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    return se.join_by_id(docs, sections(s, d).filter("level = 5 AND id % 2 = 0").select("id", "start_line"))


@query("sections_json", f"WITH {SECTIONS} SELECT id, count(*)::INT AS n, min_by(content, start_line) AS first, max_by(array_to_string(parents, '|'), start_line) AS last_parents FROM sec GROUP BY id")
def _(s, d):
    kind = "struct<sections:array<struct<start_line:int,level:int,parents:array<string>,parent_types:array<string>,content:string>>>"
    rows = se.sections_json(sections(s, d)).select("id", F.from_json("json", kind)["sections"].alias("s"))
    return rows.select("id", F.size("s").alias("n"), F.get("s", F.lit(0))["content"].alias("first"), F.array_join(F.element_at("s", -1)["parents"], "|").alias("last_parents"))


_BODY = "(body <> '')::INT"


@query("sections_tree", f"""WITH {SECTIONS} SELECT id, lang, 2 AS n_top, 'REPORT TITLE' AS title, 'doc_' || id AS name, 2 + {_BODY} AS n_inside, 'Part ' || lang AS part, 'seen by staff' AS note, 'none' AS history, 'end ' || source AS last, 9 + n AS last_line, '*3' AS last_mark FROM d""")
def _(s, d):
    x = md(s, d).join(t(s, d, "documents").select(F.col("doc_id").alias("id"), "lang"), "id")
    tree = se.sections_tree(x, metadata=["lang"])
    at = lambda p: F.get_json_object("json", f"$.{p}")
    shallow = tree.select("id", at("lang").alias("lang"), F.json_array_length(at("sections")).alias("n_top"), at("sections[0].text").alias("title"), at("sections[0].sections[0].sections[0].text").alias("name"), at("sections[1].sections").alias("json"))
    rows = shallow.withColumn("n_inside", F.json_array_length("json")).withColumn("i", F.col("n_inside") - 2)
    inside = F.get(F.from_json("json", "array<string>"), F.col("i")), F.get(F.from_json("json", "array<string>"), F.col("i") + 1)
    rows = rows.withColumns({"_part": inside[0], "_deep": inside[1]})
    of = lambda c, p: F.get_json_object(c, f"$.{p}")
    return rows.select(
        "id", "lang", "n_top", "title", "name", "n_inside", of("_part", "text").alias("part"), of("_part", "sections[0].sections[0].text").alias("note"), of("_part", "sections[0].sections[1].sections[0].text").alias("history"),
        of("_deep", "sections[0].text").alias("last"), of("_deep", "line_number").cast("bigint").alias("last_line"), of("_deep", "metadata.signature").alias("last_mark"),
    )


@query("parse_sections_copies", f"WITH {SECTIONS}, two AS (SELECT * FROM sec UNION ALL SELECT * FROM sec) SELECT start_line::INT AS start_line, level::INT AS level, array_to_string(parents, '|') AS parents, content, count(*)::BIGINT AS n FROM two GROUP BY ALL")
def _(s, d):
    x = md(s, d).select("content")
    rows = se.parse_sections(x.unionByName(x), "content")  # every document twice, without ids
    return rows.groupBy("start_line", "level", F.array_join("parents", "|").alias("parents"), "content").agg(F.count("*").alias("n"))


_LOG = "'Epoch: ' || l_linenumber || ' | critic_loss: -' || l_tax || ' | generator_loss: ' || l_discount || '; Epoch: 7 | disc_loss: ' || l_tax || 'e2 | gen_loss: 1'"


@query("training_losses", "SELECT l_orderkey AS id, l_linenumber::BIGINT AS epoch, round(-l_tax, 6) AS critic_loss, round(l_discount, 6) AS generator_loss FROM lineitem UNION ALL SELECT l_orderkey, 7, round(l_tax * 100, 6), 1.0 FROM lineitem")
def _(s, d):
    x = t(s, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.expr(_LOG).alias("text"))
    return se.training_losses(x).select("id", "epoch", F.round("critic_loss", 6).alias("critic_loss"), F.round("generator_loss", 6).alias("generator_loss"))


_R = "r AS (SELECT doc_id AS id, 'opening' || chr(10) || '**MEDICAL HISTORY**' || chr(10) || text || chr(10) || '# PAST ILLNESS' || chr(10) || 'none **Care** given' || chr(10) || '**RECOMMENDATIONS** rest' AS text FROM documents)"


@query("split_report", r"""SELECT doc_id AS id, 'INTRO' AS s1, 'FULL_TEXT' AS s2, 'FULL_TEXT' AS s3, 'opening' AS text FROM documents UNION ALL SELECT doc_id, 'RECOMMENDATIONS', 'FULL_TEXT', 'FULL_TEXT', 'rest' FROM documents
UNION ALL SELECT doc_id, 'MEDICAL HISTORY', 'INTRO', 'FULL_TEXT', trim(replace(replace(text, '*', ''), '#', ''), chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) FROM documents
UNION ALL SELECT doc_id, 'MEDICAL HISTORY', 'PAST ILLNESS', 'INTRO', 'none' FROM documents UNION ALL SELECT doc_id, 'MEDICAL HISTORY', 'PAST ILLNESS', 'Care', 'given' FROM documents""")
def _(s, d):
    r = t(s, d, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("opening \n**MEDICAL HISTORY**\n"), F.translate("text", "*#", ""), F.lit("\n# PAST ILLNESS\n none **Care** given \n**RECOMMENDATIONS** rest")).alias("text"))
    return se.split_report(r).withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", ""))


@query("pick_sections", "SELECT doc_id AS id, text AS \"BODY\", 'rest' AS \"RECOMMENDATIONS\" FROM (SELECT doc_id, regexp_replace(replace(replace(text, '*', ''), '#', ''), '^\\s+|\\s+$', '', 'g') AS text FROM documents)")
def _(s, d):
    clean = F.translate("text", "*#", "")
    r = t(s, d, "documents").select(F.col("doc_id").alias("id"), F.concat(F.lit("**BODY**\n"), clean, F.lit("\n**RECOMMENDATIONS** rest")).alias("text"))
    p = se.pick_sections(se.split_report(r), ["BODY", "RECOMMENDATIONS"])
    return p.select("id", F.regexp_replace("BODY", r"^\s+|\s+$", "").alias("BODY"), "RECOMMENDATIONS")


# personal data

_SQLP = [p for p in pii.PATTERNS if p[0] != "CREDIT_CARD"]
FOUND = "fnd AS (" + " UNION ALL ".join(f"SELECT doc_id, '{e}' AS entity, unnest(regexp_extract_all(text, {_q('(' + p + ')')}, 1)) AS text, {s}::DOUBLE AS score FROM documents" for e, p, s in _SQLP) + ")"


def docs(s, d):
    return t(s, d, "documents").select("doc_id", "text", "lang", "source")


def found(s, d):
    return pii.pattern_findings(docs(s, d), patterns=_SQLP)


@query("pattern_findings", f"WITH {FOUND} SELECT doc_id, entity, text, score FROM fnd")
def _(s, d):
    return pii.findings_table(found(s, d), ["doc_id"]).select("doc_id", "entity", "text", "score")


@query("findings_table", f"WITH {FOUND} SELECT f.doc_id, entity, f.text, length(f.text)::INT AS n, true AS placed FROM fnd f")
def _(s, d):
    r = pii.findings_table(found(s, d), ["doc_id"]).withColumnRenamed("text", "part").join(docs(s, d).select("doc_id", "text"), "doc_id")
    return r.select("doc_id", "entity", F.col("part").alias("text"), (F.col("end") - F.col("start")).alias("n"), (F.substring(F.col("text"), F.col("start") + 1, F.col("end") - F.col("start")) == F.col("part")).alias("placed"))


@query("builtin_patterns", f"WITH {FOUND} SELECT entity, count(*)::BIGINT AS n FROM fnd GROUP BY entity")
def _(s, d):
    return pii.findings_table(found(s, d), ["doc_id"]).groupBy("entity").agg(F.count("*").alias("n"))


_NUMBER, _NEAR = r"\b[0-9]{4,}\b", ["of", "and", "the", "token", "der", "la", "Version"]
#: Everything before a match, put together from the pieces between matches, gives its five words of context.
_CONTEXT = f"""WITH p AS (SELECT doc_id, string_split_regex(text, {_q(_NUMBER)}) AS ps, regexp_extract_all(text, {_q(_NUMBER)}) AS ms FROM documents WHERE text IS NOT NULL),
q AS (SELECT doc_id, i, ms[i] AS text, array_to_string(list_transform(range(1, i + 1), lambda k: ps[k] || CASE WHEN k < i THEN ms[k] ELSE '' END), '') AS before FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM p)),
r AS (SELECT *, list_has_any(list_transform(regexp_extract_all(before, '[A-Za-z0-9_]+')[-5:], lambda w: lower(w)), {[w.lower() for w in _NEAR]}) AS near FROM q)"""


@query("pattern_context", f"{_CONTEXT} SELECT doc_id, i::INT AS place, text, 0.2::DOUBLE AS plain, CASE WHEN near THEN 0.55 ELSE 0.2 END::DOUBLE AS raised FROM r")
def _(s, d):
    on = pii.pattern_table(s, [("NUMBER", _NUMBER, 0.2, _NEAR)])
    both = pii.search(pii.pattern_findings(docs(s, d), patterns=[("NUMBER", _NUMBER, 0.2)]), "text", on, "with_context")
    pairs = both.select("doc_id", F.posexplode(F.arrays_zip("findings", "with_context")).alias("p", "f"))
    return pairs.select("doc_id", (F.col("p") + 1).alias("place"), F.col("f.findings.text").alias("text"), F.col("f.findings.score").alias("plain"), F.round("f.with_context.score", 6).alias("raised"))


_CARD = next(p for e, p, _ in pii.PATTERNS if e == "CREDIT_CARD")
_DIGITS = "string_split(regexp_replace(text, '[ -]', '', 'g'), '')"


@query("card_findings", f"""WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, {_q('(' + _CARD + ')')}, 1)) AS text FROM documents)
SELECT doc_id, text FROM c WHERE list_sum(list_transform({_DIGITS}, lambda x, i: CASE WHEN i % 2 = 1 THEN CASE WHEN x::INT * 2 > 9 THEN x::INT * 2 - 9 ELSE x::INT * 2 END ELSE x::INT END)) % 10 = 0""")
def _(s, d):
    return pii.findings_table(pii.pattern_findings(docs(s, d), entities=["CREDIT_CARD"]), ["doc_id"]).select("doc_id", "text")


_DENY = r"(\b(?:that|then|der)\b)"


@query("deny_list", f"SELECT doc_id, unnest(regexp_extract_all(text, '{_DENY}', 1)) AS text, 'GENERIC_PII' AS entity FROM documents")
def _(s, d):
    return pii.findings_table(pii.deny_list(docs(s, d), ["that", "then", "der"]), ["doc_id"]).select("doc_id", "text", "entity")


@query("allow_list", f"WITH {FOUND} SELECT doc_id, entity, text FROM fnd WHERE text NOT LIKE '1%' OR text NOT IN (SELECT text FROM fnd WHERE entity = 'IP_ADDRESS')")
def _(s, d):
    rows = pii.findings_table(found(s, d), ["doc_id"])
    return pii.allow_texts(rows, rows.filter("entity = 'IP_ADDRESS' AND text LIKE '1%'")).select("doc_id", "entity", "text")


@query("allow_words", f"WITH {FOUND} SELECT doc_id, entity, text FROM fnd WHERE text NOT IN ('10.0.0.1', '127.0.0.1')")
def _(s, d):
    return pii.findings_table(pii.allow_list(found(s, d), ["10.0.0.1", "127.0.0.1"]), ["doc_id"]).select("doc_id", "entity", "text")


@query("entity_filter", f"WITH {FOUND} SELECT doc_id, entity, text FROM fnd WHERE score >= 0.35 AND entity IN ('EMAIL_ADDRESS', 'PHONE_NUMBER', 'US_PASSPORT')")
def _(s, d):
    return pii.findings_table(pii.entity_filter(found(s, d), ["EMAIL_ADDRESS", "PHONE_NUMBER", "US_PASSPORT"]), ["doc_id"]).select("doc_id", "entity", "text")


@query("map_entities", f"WITH {FOUND} SELECT doc_id, CASE entity WHEN 'IP_ADDRESS' THEN 'NETWORK' ELSE entity END AS entity, round(CASE WHEN entity = 'PHONE_NUMBER' THEN score * 0.4 ELSE score END, 6) AS score FROM fnd WHERE entity <> 'URL'")
def _(s, d):
    r = pii.map_entities(pii.findings_table(found(s, d), ["doc_id"]), {"IP_ADDRESS": "NETWORK"}, ["PHONE_NUMBER"], ["URL"])
    return r.select("doc_id", "entity", F.round("score", 6).alias("score"))


def _placed(patterns) -> str:
    """Findings with their places: what stands before the k-th match is put together from the parts between matches."""
    return "placed AS (" + " UNION ALL ".join(
        f"SELECT doc_id, '{e}' AS entity, {s}::DOUBLE AS score, ms[k] AS text, (list_sum(list_transform(ps[:k], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[:k - 1], lambda x: length(x))), 0))::INT AS start "
        f"FROM (SELECT doc_id, string_split_regex(text, {_q(p)}) AS ps, regexp_extract_all(text, {_q('(' + p + ')')}, 1) AS ms, unnest(range(1, len(regexp_extract_all(text, {_q(p)})) + 1)) AS k FROM documents)"
        for e, p, s in patterns
    ) + ")"


def _resolved(patterns) -> str:
    """The best finding is taken first, then each next one that meets none of those taken."""
    return f"""WITH RECURSIVE {_placed(patterns)},
ranked AS (SELECT *, (start + length(text))::INT AS stop, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, length(text) DESC, start, entity) AS i FROM placed),
chosen AS (
  SELECT doc_id, i, [struct_pack(a := start, z := stop, i := i)] AS kept FROM ranked WHERE i = 1
  UNION ALL
  SELECT r.doc_id, r.i, CASE WHEN len(list_filter(c.kept, lambda k: k.a < r.stop AND r.start < k.z)) > 0 THEN c.kept ELSE list_append(c.kept, struct_pack(a := r.start, z := r.stop, i := r.i)) END
  FROM chosen c JOIN ranked r ON r.doc_id = c.doc_id AND r.i = c.i + 1),
final AS (SELECT doc_id, unnest(list_transform(arg_max(kept, i), lambda k: k.i)) AS i FROM chosen GROUP BY doc_id)
SELECT r.doc_id, r.entity, r.start, r.stop AS "end", r.score, r.text FROM ranked r JOIN final USING (doc_id, i)"""


def _best(df):
    return pii.findings_table(df.withColumn("findings", pii.resolve_overlaps(F.col("findings"))), ["doc_id"])


@query("placed_findings", f"WITH {_placed(_SQLP)} SELECT doc_id, entity, start, (start + length(text))::INT AS \"end\", score, text FROM placed")
def _(s, d):
    return pii.findings_table(found(s, d), ["doc_id"])


@query("resolve_overlaps", _resolved(_SQLP))
def _(s, d):
    return _best(found(s, d))


#: Patterns that meet the built-in ones, with higher, equal and lower scores.
_MEETING = [*_SQLP, ("NUMBERS", "[0-9]+(?:[.-][0-9]+)*", 0.3), ("LOCAL_PART", "[A-Za-z0-9._]+@", 1.0), ("HOST", "[a-z0-9]+[.][a-z]+", 0.7), ("AREA", "[0-9]{3}[ .-][0-9]{3}", 0.4)]


@query("resolve_overlaps_meeting", _resolved(_MEETING))
def _(s, d):
    return _best(pii.pattern_findings(docs(s, d), patterns=_MEETING))


_EMAIL = next(p for e, p, _ in pii.PATTERNS if e == "EMAIL_ADDRESS")


@query("anonymise", f"SELECT doc_id, regexp_replace(text, {_q(_EMAIL)}, '<EMAIL_ADDRESS>', 'g') AS anonymised FROM documents")
def _(s, d):
    return pii.anonymise(pii.pattern_findings(docs(s, d), entities=["EMAIL_ADDRESS"])).select("doc_id", "anonymised")


@query("anonymise_redact", f"SELECT doc_id, regexp_replace(text, {_q(_EMAIL)}, '', 'g') AS anonymised FROM documents")
def _(s, d):
    return pii.anonymise(pii.pattern_findings(docs(s, d), entities=["EMAIL_ADDRESS"]), "redact").select("doc_id", "anonymised")


@query("annotate", f"SELECT doc_id, len(regexp_extract_all(text, {_q('(' + _EMAIL + ')')}, 1))::INT AS n_found, text FROM documents")
def _(s, d):
    r = pii.annotate(pii.pattern_findings(docs(s, d), entities=["EMAIL_ADDRESS"]))
    return r.select("doc_id", F.size(F.filter("pieces", lambda p: p["entity"].isNotNull())).alias("n_found"), F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text"))


@query("anonymise_sections", f"WITH {SECTIONS} SELECT id, start_line::INT AS start_line, content FROM sec WHERE parents[-1] IN ('Name', 'REASON FOR VISIT')")
def _(s, d):
    x = sections(s, d)
    rows = pii.anonymise_sections([se.filter_sections(x, ["Name"]), se.filter_sections(x, ["REASON FOR VISIT"])])
    # with every item put back at its offset the texts are those of the sources
    parts = F.split("anonymised", "<ANONYMIZED>")
    texts = F.transform(F.array_sort(F.map_keys("offsets")), lambda k: F.substring(F.col("content"), k + 1, F.col("offsets")[k]["end"] - k))
    back = F.array_join(F.zip_with(parts, F.concat(texts, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return rows.select("id", "start_line", back.alias("content"))


@query("write_anonymised", f"SELECT doc_id AS id, text AS source, regexp_replace(text, {_q(_EMAIL)}, '<EMAIL_ADDRESS>', 'g') AS anonymised, len(regexp_extract_all(text, {_q('(' + _EMAIL + ')')}, 1))::INT AS n FROM documents")
def _(s, d):
    from quarrystone.sources.tables import shared_folder

    path = shared_folder(s)
    pii.write_anonymised(pii.anonymise(pii.pattern_findings(docs(s, d).withColumnRenamed("doc_id", "id"), entities=["EMAIL_ADDRESS"])), path)
    return s.read.parquet(path).select("id", "source", "anonymised", F.size("items").alias("n"))


@query("corpus_pii_report", "WITH " + FOUND.replace("SELECT doc_id,", "SELECT doc_id, lang, source,") + " SELECT lang, source, entity, count(*)::BIGINT AS n FROM fnd GROUP BY ALL")
def _(s, d):
    return pii.corpus_pii_report(found(s, d), ["lang", "source"])
