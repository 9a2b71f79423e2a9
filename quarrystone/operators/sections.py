"""Markdown reports as section rows: lines, headers, blocks, levels, filters, splits.

Lines and blocks are plain expressions and windows within a document; only the level
rules, which carry state from header to header, run as a small fold over a document's
headers in Arrow batches; content stays on Spark's side. A document is the unit of work,
so nothing grows past one.
"""

from __future__ import annotations

import json

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window as W, functions as F

MAX_HEADER_WORDS = 12
#: A small letter that starts a word.
_SMALL_START = r"(?:^|[^\p{L}\p{N}_])[a-z]"
#: What is left of a text without its ASCII letters holds no other letter, digit or underscore.
_OTHER_WORD = r"[\p{L}\p{N}_]"


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))


def detect_case(text: Column) -> Column:
    """all_caps, all_lowercase, title_case, sentence_case or mixed_case, by ASCII letters."""
    plain = ~F.regexp_replace(text, "[A-Za-z]", "").rlike(_OTHER_WORD)
    return (
        F.when(~text.rlike("[A-Za-z]"), "mixed_case").when(~text.rlike("[a-z]"), "all_caps").when(~text.rlike("[A-Z]"), "all_lowercase")
        .when(plain & ~text.rlike(_SMALL_START), "title_case")
        .when(plain & text.rlike("^[A-Z]") & ~F.substring(text, 2, 1 << 30).rlike("[A-Z]"), "sentence_case").otherwise("mixed_case")
    )


def header_signature(marker: Column, count: Column, case: Column, inline: Column) -> Column:
    return F.concat(marker, count.cast("string"), F.when(case == "all_caps", "-CAPS").otherwise(""), F.when(inline, "-inline").otherwise(""))


def content_id(text: Column) -> Column:
    return F.sha2(text, 256)


def markdown_lines(df: DataFrame, id_col: str = "id", text: str = "content") -> DataFrame:
    """id, line_no (from 1), line."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def _first_match(line: Column, patterns: list[tuple[int, str]]):
    """(marker count, pattern) chains: the count and the groups of the first pattern that matches."""
    count, label, rest = F.lit(None).cast("int"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for n, p in reversed(patterns):
        hit = line.rlike(p)
        count, label = F.when(hit, n).otherwise(count), F.when(hit, F.trim(F.regexp_extract(line, p, 1))).otherwise(label)
        if "(.+)" in p:
            rest = F.when(hit, F.trim(F.regexp_extract(line, p, 2))).otherwise(rest)
    return count, label, rest


_STARS = {3: r"\*\*\*", 2: r"\*\*", 1: r"\*"}
# The closing markers are spelled out, one pattern for each count, as back-references aren't known to every engine.
INLINE = [(n, rf"^{s}\s*(.*?):\s*{s}\s*(.+)$") for n, s in _STARS.items()] + [(n, rf"^{s}\s*(.*?)\s*{s}:\s*(.+)$") for n, s in _STARS.items()]
#: One to six hash signs; what comes after the sixth belongs to the label.
HASH = r"^(#{1,6})\s*(.*)"
ASTERISK = [(n, rf"^{s}\s*(.*?)\s*{s}$") for n, s in _STARS.items()]


def classify_lines(lines: DataFrame, max_words: int = MAX_HEADER_WORDS) -> DataFrame:
    """Add kind (inline, hash, asterisk, content), marker, marker_count, label, inline_text, case, signature."""
    line = F.col("line")
    found = {"inline": _first_match(line, INLINE), "asterisk": _first_match(line, ASTERISK)}
    hashes = line.rlike(HASH)
    found["hash"] = (F.when(hashes, F.length(F.regexp_extract(line, HASH, 1))), F.when(hashes, F.trim(F.regexp_extract(line, HASH, 2))), F.lit(None).cast("string"))
    df = lines.withColumns({f"_{k}_{x}": v for k, m in found.items() for x, v in zip("nlr", m)})
    kind = F.lit("content")
    for k in ("asterisk", "hash", "inline"):  # the last one that fits wins
        kind = F.when(F.col(f"_{k}_n").isNotNull() & (word_count(F.col(f"_{k}_l")) <= max_words), k).otherwise(kind)
    df = df.withColumn("kind", kind)
    pick = lambda x: F.coalesce(*(F.when(F.col("kind") == k, F.col(f"_{k}_{x}")) for k in found))
    df = df.withColumns({"marker": F.when(F.col("kind") == "hash", "#").when(F.col("kind") != "content", "*"), "marker_count": pick("n"), "label": pick("l"), "inline_text": F.when(F.col("kind") == "inline", F.col("_inline_r"))})
    df = df.withColumn("case", F.when(F.col("kind") != "content", detect_case(F.col("label"))))
    df = df.withColumn("signature", header_signature(F.col("marker"), F.col("marker_count"), F.col("case"), F.col("kind") == "inline"))
    return df.drop(*(f"_{k}_{x}" for k in found for x in "nlr"))


def content_blocks(classified: DataFrame) -> DataFrame:
    """Tokens in order: headers, and runs of other lines joined and trimmed (blank ones left out).

    id, start_line, part (0, or 1 for the text of an inline header), is_header, content, and the header's fields.
    """
    header = F.col("kind") != "content"
    island = F.sum(header.cast("int")).over(W.partitionBy("id").orderBy("line_no"))
    rows = classified.withColumn("_i", F.when(~header, island))
    blocks = rows.filter("kind = 'content'").groupBy("id", "_i").agg(F.min("line_no").alias("start_line"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("content"))
    blocks = blocks.select("id", "start_line", F.lit(0).alias("part"), F.lit(False).alias("is_header"), F.regexp_replace("content", r"^\s+|\s+$", "").alias("content")).filter("content <> ''")
    fields = ["marker", "marker_count", "case", "signature"]
    heads = classified.filter(header).select("id", F.col("line_no").alias("start_line"), F.lit(0).alias("part"), F.lit(True).alias("is_header"), F.col("label").alias("content"), *fields, (F.col("kind") == "inline").alias("inline"))
    texts = classified.filter("kind = 'inline'").select("id", F.col("line_no").alias("start_line"), F.lit(1).alias("part"), F.lit(False).alias("is_header"), F.col("inline_text").alias("content"))
    return heads.unionByName(blocks, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)


#: Asterisk headers from outer to inner: bold, bold italic, italic.
_DEPTH = {2: 1, 3: 2, 1: 3}


def fold_levels(tokens: list[dict]) -> list[tuple[int, list[str], list[str]]]:
    """(level, parents, parent signatures) of a document's tokens in order.

    Capitals keep the level of their first use and forget the asterisk level; hash headers move by
    the difference of their markers; asterisk headers by one, in or out; an inline header stands
    one below the top of the stack and leaves it after its text.
    """
    stack: list[tuple[int, str, str]] = []
    caps = star = hashed = None  # level of capitals; (level, markers) of the last asterisk and hash header
    last, after_hash, out, inline_open = 0, False, [], False
    for t in tokens:
        parents, kinds = [s[1] for s in stack], [s[2] for s in stack]
        if not t["is_header"]:
            out.append((stack[-1][0] + 1 if stack else 1, parents, kinds))
            if inline_open:
                stack.pop()
            inline_open = False
            continue
        n, inline = t["marker_count"], bool(t["inline"])
        if inline:
            level = stack[-1][0] + 1 if stack else 1
        elif t["case"] == "all_caps":
            if caps is None:
                caps = last + 1 if stack else 1
            level, star = caps, None
        elif t["marker"] == "#":
            level = 1 if not stack else hashed[0] + n - hashed[1] if hashed else last + 1
            hashed, after_hash = (level, n), True
        else:
            if not stack:
                level = 1
            elif after_hash or star is None:
                level = last + 1
            else:
                a, b = _DEPTH.get(n, n), _DEPTH.get(star[1], star[1])
                level = star[0] + (a > b) - (a < b)
            star, after_hash = (level, n), False
        out.append((level, parents, kinds))
        while stack and stack[-1][0] >= level:
            stack.pop()
        stack.append((level, t["content"], t["signature"]))
        last = last if inline else level
        inline_open = inline
    return out


#: What the level rules read of a token; of content only that it is there.
_FOLD = ["is_header", "label", "marker", "marker_count", "case", "signature", "inline"]
_LEVELS = pa.list_(pa.struct([("level", pa.int32()), ("parents", pa.list_(pa.string())), ("kinds", pa.list_(pa.string()))]))
#: Tokens that are Python objects at once; a longer document is folded by itself.
FOLD_TOKENS = 20_000
#: The same where contents come along.
TREE_TOKENS = 1_000


def token_slices(tokens: pa.Array, most: int = FOLD_TOKENS):
    """Slices of an array of lists with about ``most`` elements each, one list at least."""
    ends, start = pa.compute.cumulative_sum(pa.compute.fill_null(pa.compute.list_value_length(tokens), 0)).to_pylist(), 0
    for i, end in enumerate(ends):
        if i + 1 == len(ends) or ends[i + 1] - (ends[start - 1] if start else 0) > most:
            yield tokens.slice(start, i + 1 - start)
            start = i + 1


def _fold_batch(tokens: pa.Array) -> pa.Array:
    parts = []
    for part in token_slices(tokens):
        docs = ([t | {"content": t["label"]} for t in toks] for toks in part.to_pylist())
        parts.append(pa.array([[{"level": level, "parents": parents, "kinds": kinds} for level, parents, kinds in fold_levels(doc)] for doc in docs], _LEVELS))
    return pa.concat_arrays(parts) if parts else pa.array([], _LEVELS)


def header_levels(tokens: DataFrame) -> DataFrame:
    """All tokens with level, parents and parent_types.

    Python sees the headers and where content stands between them, never content itself; that waits on Spark's side.
    """
    fields = ["start_line", "part", "is_header", "content", "marker", "marker_count", "case", "signature", "inline"]
    docs = tokens.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("tokens"))
    label = lambda t: F.when(t["is_header"], t["content"]).alias("label")
    slim = F.transform("tokens", lambda t: F.struct(*(label(t) if f == "label" else t[f].alias(f) for f in _FOLD)))
    fold = F.arrow_udf(_fold_batch, "array<struct<level: int, parents: array<string>, kinds: array<string>>>")
    both = F.arrays_zip("tokens", "levels")
    rows = docs.withColumn("levels", fold(slim)).select("id", F.explode(both).alias("_x"))
    t, level = F.col("_x.tokens"), F.col("_x.levels")
    return rows.select(
        "id", t["start_line"].alias("start_line"), t["part"].alias("part"), t["is_header"].alias("is_header"), level["level"].alias("level"),
        F.length(t["content"]).alias("length"), level["parents"].alias("parents"), level["kinds"].alias("parent_types"), t["content"].alias("content"),
    )


def parse_sections(df: DataFrame, content: str = "content", id_col: str | None = None, metadata: list[str] = (), max_words: int = MAX_HEADER_WORDS) -> DataFrame:
    """Content rows with their headers: id, metadata, start_line, level, length, parents, parent_types, content.

    Without an id column the id is the content's hash; then each distinct content is parsed once, and documents
    of equal content have their rows each. Ids of an id column are to be unique.
    """
    missing = [c for c in [content, *([id_col] if id_col else []), *metadata] if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    docs = df.select((F.col(id_col) if id_col else content_id(F.col(content))).alias("id"), F.col(content).alias("content"), *metadata)
    texts = docs if id_col else docs.select("id", "content").dropDuplicates(["id"])
    rows = header_levels(content_blocks(classify_lines(markdown_lines(texts), max_words))).filter("NOT is_header").drop("part", "is_header")
    if metadata or not id_col:
        rows = rows.join(docs.select("id", *metadata), "id")
    return rows.select("id", *metadata, "start_line", "level", "length", "parents", "parent_types", "content")


def later_siblings(levels: list[int]) -> list[bool]:
    """For each header: is there a later one of its level before a shallower one?"""
    out, waiting = [False] * len(levels), []  # headers without a successor at their level or above, levels rising
    for i, level in enumerate(levels):
        while waiting and levels[waiting[-1]] >= level:
            j = waiting.pop()
            out[j] = levels[j] == level
        waiting.append(i)
    return out


def has_more_siblings(tokens: DataFrame) -> DataFrame:
    """The headers with ``more``: is there a later one of its level before a shallower one? One pass over each document."""
    heads = tokens.filter("is_header")
    marked = heads.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start_line", "level"))).alias("h"))

    def run(batches):
        for b in batches:
            for i, h in zip(b.column("id"), b.column("h").to_pylist()):
                more = later_siblings([x["level"] for x in h])
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * len(h), b.schema.field("id").type), pa.array([x["start_line"] for x in h], pa.int32()), pa.array(more, pa.bool_())], names=["id", "start_line", "more"])

    found = marked.mapInArrow(run, f"id {tokens.schema['id'].dataType.simpleString()}, start_line int, more boolean")
    return heads.join(found, ["id", "start_line"])


def section_match(section: str, match: str = "exact") -> Column:
    """Does the last parent equal the section, as it stands or whatever its case?"""
    last = F.element_at("parents", -1)
    hit = last == section if match == "exact" else F.lower(last) == section.lower()
    return F.when(F.size("parents") > 0, hit).otherwise(False)


def fuzzy_ratio(a: Column, b: str) -> Column:
    """0 to 100: twice the longest common subsequence over the lengths' sum (for short texts)."""
    chars = F.filter(F.split(a, ""), lambda c: c != "")
    zero = F.array(*[F.lit(0)] * (len(b) + 1))
    fold = lambda row, c: F.aggregate(
        F.sequence(F.lit(1), F.lit(len(b))), F.array(F.lit(0)),
        lambda new, j: F.concat(new, F.array(F.when(F.substring(F.lit(b), j, F.lit(1)) == c, F.get(row, j - 1) + 1).otherwise(F.greatest(F.get(row, j), F.element_at(new, -1))))),
    )
    lcs = F.element_at(F.aggregate(chars, zero, fold), -1) if b else F.lit(0)
    total = F.length(a) + len(b)
    return F.when(total == 0, 100.0).otherwise(200.0 * lcs / total)


def filter_sections(df: DataFrame, sections: list[str], match: str = "exact", threshold: float = 80.0) -> DataFrame:
    """Rows whose last parent matches any of the sections. Fuzzy ratios are taken on distinct parents, case as it is."""
    if match not in ("exact", "case_insensitive", "fuzzy") or not 0 <= threshold <= 100:
        raise ValueError("match is exact, case_insensitive or fuzzy; threshold 0 to 100")
    if match != "fuzzy":
        test = F.lit(False)
        for s in sections:
            test = test | section_match(s, match)
        return df.filter(test)
    last = F.when(F.size("parents") > 0, F.element_at("parents", -1))
    names = df.select(last.alias("_p")).filter("_p IS NOT NULL").distinct()
    test = F.lit(False)
    for s in sections:
        test = test | (fuzzy_ratio(F.col("_p"), s) >= threshold)
    return df.withColumn("_p", last).join(names.filter(test), "_p", "left_semi").select(*df.columns)


def lookup_by_id(df: DataFrame, test: Column, column: str = "content", order: str = "start_line", name: str = "found") -> DataFrame:
    """Every row with the ``column`` of the first matching row of its id."""
    first = df.filter(test).groupBy("id").agg(F.min_by(column, order).alias(name))
    return df.join(first, "id", "left")


def add_name(df: DataFrame) -> DataFrame:
    test = (F.size("parents") > 0) & (F.element_at("parents", -1) == "Name") & (F.element_at("parent_types", -1) == "*2-inline")
    return lookup_by_id(df, F.when(F.size("parents") > 0, test).otherwise(False), name="name")


def first_per_id(df: DataFrame, order: str = "start_line") -> DataFrame:
    others = [c for c in df.columns if c != "id"]
    return df.groupBy("id").agg(F.min_by(F.struct(*others), order).alias("r")).select("id", "r.*")


def union_sections(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def join_by_id(source: DataFrame, results: DataFrame, key: str = "id") -> DataFrame:
    return source.join(results, key, "left")


#: Report levels: header patterns and what is cut off a match to get its title.
_REPORT = [r"\*\*[A-Z]+(?: [A-Z]+)*\*\*", r"# [A-Z]+(?:\s+[A-Z]+)*(?=[^A-Za-z]|$)", r"\*\*[^*]+\*\*"]


def _strip(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def _split_level(df: DataFrame, pattern: str, out: str, keys: list[str]) -> DataFrame:
    heads = F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))
    df = df.withColumns({"_h": heads, "_p": F.split("text", pattern)})
    title = lambda h: _strip(F.regexp_replace(h, r"[*#]", ""))
    named = F.transform("_h", lambda h, i: F.struct((i + 1).alias("pos"), title(h).alias("title"), _strip(F.get("_p", i + 1)).alias("text")))
    intro = F.array(F.struct(F.lit(0).alias("pos"), F.lit("INTRO").alias("title"), _strip(F.get("_p", F.lit(0))).alias("text")))
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.lit("FULL_TEXT").alias("title"), _strip(F.col("text")).alias("text")))
    parts = F.when(F.size("_h") == 0, whole).otherwise(F.concat(intro, named))
    rows = df.select(*keys, F.explode(parts).alias("_s")).select(*keys, "_s.*").filter("NOT (title IN ('INTRO', 'FULL_TEXT') AND text = '')")
    return rows.groupBy(*keys, F.col("title").alias(out)).agg(F.max_by("text", "pos").alias("text"))


def split_report(df: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """id, s1, s2, s3, text: three nested splits; a title that repeats keeps its last text."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    keys = ["id"]
    for i, p in enumerate(_REPORT, 1):
        rows = _split_level(rows, p, f"s{i}", keys)
        keys = [*keys, f"s{i}"]
    return rows


def pick_sections(split: DataFrame, names: list[str]) -> DataFrame:
    """One row for each report: its text under the chosen top sections, parts in title order."""
    top = split.filter(F.col("s1").isin(names)).groupBy("id", "s1").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s2", "s3", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return top.groupBy("id").pivot("s1", names).agg(F.first("text"))


#: Loss lines of training logs (fixed values of the two log formats): epoch and the losses of critic and generator.
LOSS_LINES = {
    "critic": r"Epoch:\s*(\d+)\s*\|\s*critic_loss:\s*([-\d.eE+]+)\s*\|\s*generator_loss:\s*([-\d.eE+]+)",
    "disc": r"Epoch:\s*(\d+)\s*\|\s*disc_loss:\s*([-\d.eE+]+)\s*\|\s*gen_loss:\s*([-\d.eE+]+)",
}


def training_losses(df: DataFrame, text: str = "text", keys: list[str] = ("id",)) -> DataFrame:
    """(keys, place, epoch, critic_loss, generator_loss) of every loss line of the logs, of either format; numbers that can't be read are null."""
    parts = []
    for pattern in LOSS_LINES.values():
        lines = F.arrays_zip(*(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(i)).alias(f"g{i}") for i in (1, 2, 3)))
        rows = df.select(*keys, F.posexplode(lines).alias("place", "m"))
        parts.append(rows.select(*keys, "place", F.expr("try_cast(m.g1 AS bigint)").alias("epoch"), F.expr("try_cast(m.g2 AS double)").alias("critic_loss"), F.expr("try_cast(m.g3 AS double)").alias("generator_loss")))
    return parts[0].unionByName(parts[1])


def sections_json(df: DataFrame) -> DataFrame:
    """id, json: a document's sections in order, as a flat list; ``sections_tree`` nests them."""
    rows = F.sort_array(F.collect_list(F.struct("start_line", "level", "parents", "parent_types", "content")))
    return df.groupBy("id").agg(F.to_json(F.struct(rows.alias("sections"))).alias("json"))


def nested(tokens: list[dict]) -> list[dict]:
    """A document's tokens in order as a tree: a header holds what follows at deeper levels, a text what it says."""
    root: list[dict] = []
    open_: list[tuple[int, list[dict]]] = [(0, root)]
    for t, (level, _, _) in zip(tokens, fold_levels(tokens)):
        while len(open_) > 1 and open_[-1][0] >= level:
            open_.pop()
        item = {"type": "header" if t["is_header"] else "content", "text": t["content"], "level": level, "line_number": t["start_line"]}
        if t["is_header"]:
            item |= {"metadata": {k: t[k] for k in ("marker", "marker_count", "case", "signature")}, "sections": []}
        open_[-1][1].append(item)
        if t["is_header"]:
            open_.append((level, item["sections"]))
    return root


def sections_tree(df: DataFrame, content: str = "content", id_col: str = "id", metadata: list[str] = (), max_words: int = MAX_HEADER_WORDS) -> DataFrame:
    """id, json: for each document an object of its id, its metadata, and its sections inside one another.

    Null and blank documents have no sections; ids are to be unique. Metadata columns may be of any type.
    """
    docs = df.select(F.col(id_col).alias("id"), F.col(content).alias("content"), F.to_json(F.struct(F.col(id_col).alias("id"), *metadata)).alias("meta"))
    tokens = content_blocks(classify_lines(markdown_lines(docs.select("id", "content")), max_words))
    fields = ["start_line", "part", "is_header", "content", "marker", "marker_count", "case", "signature", "inline"]
    lists = tokens.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("tokens"))
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            at = 0
            for part in token_slices(b.column("tokens"), TREE_TOKENS):
                rows, out = b.slice(at, len(part)), []
                for meta, toks in zip(rows.column("meta").to_pylist(), part.to_pylist()):
                    out.append(json.dumps(json.loads(meta) | {"sections": nested(toks or [])}, ensure_ascii=False))
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(out, pa.string())], names=["id", "json"])
                at += len(part)

    return docs.select("id", "meta").join(lists, "id", "left").mapInArrow(run, f"id {kind}, json string")
