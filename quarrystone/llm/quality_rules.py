"""Quality rules, line first (native): clean lines, then judge what is left.

Every line is tested for navigation, boilerplate and punctuation faults; failed
lines are removed, and a document that loses too large a share of its characters
is rejected. Repetition and length rules come before. Everything is DataFrame
expressions on the row itself: no shuffle, no Python, one pass over the text.

A line fails if it is a menu entry alone, holds a phrase of page furniture, has MAX_PIPES
or more ``|``, has more than 1 in 10 characters of SYMBOLS or 1 in 8 of ``!``, or has no
letter or digit of any script. Phrases are given by language (English, German, French and
Spanish here; other lists are parameters), the other rules go by character shape and hold
for any language. Defaults of the document rules: 10 words at least, 20 percent of words
in repeated windows of five at most, 50 percent of characters lost with lines at most.

Defined results: a null text has no words and one empty line, so it fails the
length rule; an empty text likewise. Repeated rows are judged each on their own.
Extra columns, whatever their names, pass through, but those named like an output are
replaced. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarrystone.llm._base import spare, table

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MAX_PIPES = 3
#: Menu entries that make a line of their own, by language; ASCII letters match in either case.
MENUS = {
    "en": ["home", "menu", "log ?in", "sign (in|up)", "next", "previous", "back", "search", "contact( us)?", "about( us)?", "share", "subscribe", "read more", "click here", "skip to content"],
    "de": ["startseite", "anmelden", "abmelden", "registrieren", "weiter", "zur[üÜ]ck", "suche", "kontakt", "[üÜ]ber uns", "teilen", "abonnieren", "weiterlesen", "mehr lesen", "zum inhalt springen"],
    "fr": ["accueil", "connexion", "se connecter", "s'inscrire", "suivant", "pr[éÉ]c[éÉ]dent", "retour", "recherche", "contact(ez-nous)?", "partager", "lire la suite", "[àÀ] propos", "aller au contenu"],
    "es": ["inicio", "iniciar sesi[óÓ]n", "registrarse", "siguiente", "anterior", "volver", "buscar", "contacto", "compartir", "suscribirse", "leer m[áÁ]s", "sobre nosotros", "ir al contenido"],
}
#: Phrases of page furniture, by language, in lower case.
FURNITURE = {
    "en": ["cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "enable javascript", "lorem ipsum", "powered by wordpress", "subscribe to our newsletter", "accept cookies", "accept all cookies"],
    "de": ["cookie-richtlinie", "alle rechte vorbehalten", "javascript aktivieren", "newsletter abonnieren", "cookies akzeptieren"],
    "fr": ["politique de cookies", "droits r[éÉ]serv[éÉ]s", "activer javascript", "accepter les cookies", "abonnez-vous"],
    "es": ["pol[íÍ]tica de cookies", "pol[íÍ]tica de privacidad", "todos los derechos reservados", "aceptar cookies", "aceptar las cookies"],
}


def menu_pattern(menus: dict[str, list[str]] = MENUS) -> str:
    return rf"(?i)^[ \t]*({'|'.join(x for v in menus.values() for x in v)})[ \t.!:>]*$"


def furniture_pattern(phrases: dict[str, list[str]] = FURNITURE) -> str:
    """A phrase at the start of the text or after anything but an ASCII letter."""
    return f"(?i)(?:^|[^a-z])({'|'.join(x for v in phrases.values() for x in v)})"


NAVIGATION, BOILERPLATE = menu_pattern(), furniture_pattern()
#: A letter or digit in any script, or a byte beyond ASCII.
CONTENT = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_fails(line: Column, max_pipes: int = MAX_PIPES, symbol_share: int = 10, shout_share: int = 8, navigation: str = NAVIGATION, boilerplate: str = BOILERPLATE, furnished: Column | None = None) -> Column:
    """True if a line is navigation, boilerplate or mostly punctuation.

    ``symbol_share`` n: fails if over 1/n of the characters are symbols;
    ``shout_share`` the same for exclamation marks. Blank lines never fail. ``furnished``,
    if given, tells whether the text has a phrase of page furniture anywhere.
    """
    phrase = line.rlike(boilerplate) if furnished is None else furnished & line.rlike(boilerplate)
    return (F.length(F.btrim(line, F.lit(SPACES))) > 0) & (
        (_count(line, "|") >= max_pipes)
        | (_count(line, SYMBOLS) * symbol_share > F.length(line))
        | (_count(line, "!") * shout_share > F.length(line))
        | line.rlike(navigation)
        | phrase
        | ~line.rlike(CONTENT)
    )


def _repeat_words(hashes: Column, windows: Column, n: int) -> Column:
    """Words in windows of n words that occur twice or more, first occurrences included."""

    def covered(s):  # s: (hash, position) in order
        found = F.filter(
            F.transform(s, lambda e, i: F.when((F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]), e["p"])),
            lambda p: p.isNotNull(),
        )
        steps = lambda at: F.transform(at, lambda p, i: F.when(i == 0, n).otherwise(F.least(F.lit(n), p - F.get(at, i - 1))))
        return F.aggregate(_let(F.sort_array(found), steps), F.lit(0).cast("bigint"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(_let(pairs, covered))


def quality_rules(df: DataFrame, text: str = "text", min_words: int = 10, window: int = 5, max_repeat: int = 20, max_loss: int = 50, menus: dict[str, list[str]] = MENUS, furniture: dict[str, list[str]] = FURNITURE) -> DataFrame:
    """Add rule statistics, the cleaned text and the verdict ``kept`` to every row.

    ``max_repeat`` and ``max_loss`` are percentages: of words in repeated windows,
    and of characters lost with failed lines. ``menus`` and ``furniture`` hold regular
    expressions by language.
    """
    navigation, boilerplate = menu_pattern(menus), furniture_pattern(furniture)
    _words, _lines, _windows, _worded, _kept, _furnished = spare(df.columns, "_words", "_lines", "_windows", "_worded", "_kept_lines", "_furnished")
    words = F.filter(F.split(F.col(text), SPACE), lambda w: w != "")
    df = df.withColumns({
        _words: F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<bigint>")), _lines: F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
        _furnished: F.coalesce(F.col(text).rlike(boilerplate), F.lit(False)),
    })
    last = F.size(_words) - window
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*(F.get(_words, i + k) for k in range(window))))).otherwise(F.array().cast("array<bigint>"))
    worded = F.filter(_lines, lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
    total = lambda lines: F.aggregate(lines, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
    df = df.withColumns({_windows: windows, _worded: worded, _kept: F.filter(_lines, lambda x: ~line_fails(x, navigation=navigation, boilerplate=boilerplate, furnished=F.col(_furnished)))})
    df = df.withColumns({
        "n_words": F.size(_words).cast("bigint"),
        "word_chars": F.coalesce(F.length(F.translate(text, SPACES, "")), F.lit(0)).cast("bigint"),
        "n_symbols": F.coalesce(_count(F.col(text), SYMBOLS), F.lit(0)).cast("bigint"),
        "n_dup_lines": (F.size(_worded) - F.size(F.array_distinct(_worded))).cast("bigint"),
        "n_repeat_words": _repeat_words(F.col(_words), F.col(_windows), window),
        "n_lines": F.size(_lines).cast("bigint"),
        "n_failed_lines": (F.size(_lines) - F.size(_kept)).cast("bigint"),
        "line_chars": total(_lines),
        "lost_chars": total(_lines) - total(_kept),
        "clean_text": F.array_join(_kept, "\n"),
    })
    df = df.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    df = df.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_loss * F.col("line_chars")))
    return df.drop(_words, _lines, _windows, _worded, _kept, _furnished)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines", "lost_chars", "base_failed", "kept"]


def query(spark, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*COLUMNS)


_QUOTED = [x.replace("'", "''") for x in (NAVIGATION, BOILERPLATE)]
_LINE_FAILS = rf"""length(trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))) > 0 AND (
  length(x) - length(replace(x, '|', '')) >= {MAX_PIPES}
  OR (length(x) - length(translate(x, '{SYMBOLS}', ''))) * 10 > length(x)
  OR (length(x) - length(replace(x, '!', ''))) * 8 > length(x)
  OR regexp_matches(x, '{_QUOTED[0]}') OR regexp_matches(x, '{_QUOTED[1]}')
  OR NOT regexp_matches(x, '{CONTENT}'))"""
SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '{SPACE}'), lambda x: x <> '') AS w,
    string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), e AS (
  SELECT *, len(w) AS n, list_filter(ls, lambda x: length(trim(x, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))) > 0) AS wl,
    list_filter(ls, lambda x: {_LINE_FAILS}) AS bad FROM d
), g AS (SELECT doc_id, p, array_to_string(w[p:p+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, n - 3)) AS p FROM e)),
r AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
c AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM r, range(5) AS t(k) GROUP BY doc_id),
s AS (
  SELECT e.doc_id, e.n::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(wl) - len(list_distinct(wl)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines, len(bad)::BIGINT AS n_failed_lines,
    coalesce(list_sum(list_transform(bad, lambda x: length(x))), 0)::BIGINT AS lost_chars,
    list_sum(list_transform(ls, lambda x: length(x)))::BIGINT AS line_chars
  FROM e LEFT JOIN c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_failed_lines, lost_chars,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 50 * line_chars AS kept
FROM s
"""
