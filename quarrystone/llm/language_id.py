"""Language ID: script ranges narrow candidates, Viterbi over word scores labels spans.

Learning counts hashed byte n-grams of every training word for each language, and the
scripts a language is written in, in one pass over all training rows; the table has
languages x BUCKETS cells whatever the data's size. A word's score for a language is
the log likelihood of its n-grams; languages never seen in the word's script are out.
Viterbi with a switching penalty then gives each word a language. Where no stretch of a
text gains half a penalty under another language, the best single language is already
the best path, and the recursion is left out; the rest of a slice runs step by step
side by side. A document's language is the one with the most letters in its spans.

Defined results: null texts and texts without letters are ``und`` with score 0. With no
training rows every text is ``und``. Training rows with a null language are passed over.
Ties go to the first language in sorted order. Repeated rows count in training as often
as they occur. Extra columns pass through ``detect``; those named like its outputs are
replaced, and the outputs can be given other names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from quarrystone.llm._base import byte_class, held_out, table, text_bytes, text_slices, word_spans

BUCKETS = 1 << 17
ORDERS = (2, 3, 4)
SWITCH = 8.0
UNKNOWN = "und"
#: Letters of ASCII, and all bytes of other characters.
LETTERS = byte_class([(0x00, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
#: First code points of script ranges (fixed values of the Unicode standard).
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "indic"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "burmese"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]
_STARTS = np.array([s for s, _ in SCRIPTS])
_NAMES = sorted({n for _, n in SCRIPTS})
_SCRIPT_OF = np.array([_NAMES.index(n) for _, n in SCRIPTS])


@dataclass
class Words:
    """The words of some rows: distinct ones with their n-grams, and each occurrence's index."""

    codes: np.ndarray
    bounds: np.ndarray  # of rows in codes
    letters: np.ndarray  # of each distinct word, 0 if it has none
    script: np.ndarray
    gram: np.ndarray  # buckets of all n-grams
    owner: np.ndarray  # their distinct words


def read_words(text: pa.Array) -> Words:
    data, offsets = text_bytes(pc.utf8_lower(pc.fill_null(text, "")))
    starts, ends, bounds = word_spans(data, offsets, LETTERS)
    ends_at = np.cumsum(ends - starts)
    packed = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.concatenate([[0], ends_at]).astype(np.int64)), pa.py_buffer(data[LETTERS[data]]))
    coded = packed.dictionary_encode()
    codes = coded.indices.to_numpy()
    raw, at = text_bytes(coded.dictionary)
    sizes = np.diff(at)
    n = len(sizes)
    # each distinct word between single spaces
    spaced = np.full(len(raw) + n + 1, 32, np.uint8)
    owner = np.repeat(np.arange(n), sizes + 1)
    inside = np.ones(len(raw) + n + 1, bool)
    inside[np.concatenate([[0], np.cumsum(sizes + 1)])] = False
    spaced[inside] = raw
    letters = np.zeros(n, np.int64)
    script = np.full(n, _NAMES.index("latin"))
    if n:
        filled = sizes > 0
        letters[filled] = np.add.reduceat(((raw & 0xC0) != 0x80).astype(np.int64), at[:-1][filled])
        wide = np.zeros(n, bool)
        wide[filled] = np.add.reduceat((raw >= 0x80).astype(np.int64), at[:-1][filled]) > 0
        for i in np.flatnonzero(wide):
            alpha = [c for c in coded.dictionary[int(i)].as_py() if c.isalpha()]
            letters[i] = len(alpha)
            if alpha:
                script[i] = _SCRIPT_OF[np.searchsorted(_STARTS, max(map(ord, alpha)) if alpha[0] > "˿" else ord(alpha[0]), "right") - 1]
    grams, owners = [], []
    value = spaced.astype(np.uint64)
    for k in ORDERS:
        m = len(spaced) - k + 1
        if m <= 0:
            continue
        h = np.zeros(m, np.uint64)
        clean = np.ones(m, bool)
        for j in range(k):
            h = h * np.uint64(0x100000001B3) + value[j : j + m]
            if 0 < j < k - 1:
                clean &= spaced[j : j + m] != 32
        h = (h + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        use = np.flatnonzero(clean)
        use = use[use < len(owner)]
        grams.append((h[use] >> np.uint64(64 - 17)).astype(np.int64))
        owners.append(owner[use])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return Words(codes, bounds, letters, script, join(grams), join(owners))


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # BUCKETS x languages
    allowed: np.ndarray  # scripts x languages

    def scores(self, w: Words) -> np.ndarray:
        """Distinct words x languages; words without letters score 0 everywhere."""
        out = np.zeros((len(w.letters), len(self.languages)))
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(w.owner, self.logp[w.gram, i], minlength=len(out)) / len(ORDERS)
        out -= out.max(axis=1, initial=-np.inf, keepdims=True)
        out[~self.allowed[w.script]] -= 50.0
        out[w.letters == 0] = 0
        return out


def train(df: DataFrame, text: str = "text", lang: str = "lang", smoothing: float = 0.5) -> Model:
    """Count n-grams and scripts by language over all rows with a language."""
    df = df.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for whole in batches:
            for b in text_slices([whole], "text"):
                names = b.column("lang").to_pylist()
                w = read_words(b.column("text"))
                row = np.repeat(np.arange(len(names)), np.diff(w.bounds))
                known = sorted(set(names))
                of = np.array([known.index(x) for x in names], np.int64)[row]
                for i, name in enumerate(known):
                    n = np.bincount(w.codes[of == i], minlength=len(w.letters)) * (w.letters > 0)
                    if name not in sums:
                        sums[name], scripts[name] = np.zeros(BUCKETS), np.zeros(len(_NAMES))
                    sums[name] += np.bincount(w.gram, n[w.owner], minlength=BUCKETS)
                    scripts[name] += np.bincount(w.script, n, minlength=len(_NAMES))
        for name, s in sums.items():
            whole = np.concatenate([s, scripts[name]])
            at = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(whole[at].astype(np.int64))], names=["lang", "at", "n"])

    counts = df.mapInArrow(count, "lang string, at int, n bigint").groupBy("lang", "at").agg(F.sum("n").alias("n"))
    found = counts.toArrow()  # languages x (BUCKETS + scripts) at most
    languages = sorted(found.column("lang").unique().to_pylist())
    table_ = np.zeros((BUCKETS + len(_NAMES), len(languages)))
    if languages:
        at = np.array([languages.index(x) for x in found.column("lang").to_pylist()])
        table_[found.column("at").to_numpy(), at] = found.column("n").to_numpy()
    grams, scripts = table_[:BUCKETS] + smoothing, table_[BUCKETS:]
    allowed = scripts > 0.001 * scripts.sum(axis=0, keepdims=True)
    allowed[~allowed.any(axis=1)] = True  # a script never seen excludes nobody
    return Model(languages, np.log(grams / np.maximum(grams.sum(axis=0, keepdims=True), 1)), allowed)


def viterbi(scores: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """The best language of each word for several texts (words x languages each), side by side."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    n = np.array([len(scores[i]) for i in order])
    first = np.cumsum(n) - n
    flat = np.concatenate([scores[i] for i in order]) if order else np.zeros((0, 1))
    best, stay = np.zeros(len(flat), np.int16), np.ones(flat.shape, bool)
    v = np.zeros((len(order), flat.shape[1]))
    alive = np.searchsorted(-n, -np.arange(int(n.max(initial=0))), "left")  # texts with more than t words
    for t, k in enumerate(alive):
        at = first[:k] + t
        if t:
            top = v[:k].argmax(axis=1)
            moved = v[np.arange(k), top][:, None] - switch
            best[at], stay[at] = top, v[:k] >= moved
            v[:k] = np.maximum(v[:k], moved)
        v[:k] += flat[at]
    out = np.zeros(len(flat), np.int16)
    now = v.argmax(axis=1)
    for t in range(len(alive) - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        out[at] = now[:k]
        if t:
            now[:k] = np.where(stay[at, now[:k]], now[:k], best[at])
    paths: list = [None] * len(order)
    for i, a, m in zip(order, first, n):
        paths[i] = out[a : a + m]
    return paths


def label_words(scores: np.ndarray, codes: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """The language of every word of several texts."""
    out = np.zeros(len(codes), np.int16)
    hard = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if a == b:
            continue
        s = scores[codes[a:b]]
        top = int(s.sum(axis=0).argmax())
        gain = np.cumsum(s - s[:, top : top + 1], axis=0)
        low = np.minimum(np.minimum.accumulate(gain, axis=0), 0)
        low[1:], low[0] = low[:-1].copy(), 0
        if (gain - low).max() <= switch / 2:
            out[a:b] = top
        else:
            hard.append((a, b, s))
    for (a, b, _), path in zip(hard, viterbi([s for *_, s in hard], switch)):
        out[a:b] = path
    return out


def detect(df: DataFrame, model: Model, text: str = "text", switch: float = SWITCH, spans: bool = False, names: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """Add lang_pred and score (share of letters in that language), and if asked ``spans``:
    (first word, end word, language) over the text's words of letters."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS doubles
    df = df.drop(*names)
    kept, more_names = df.columns, list(names[: 2 + spans])
    schema = StructType([*df.schema.fields]).add(names[0], "string").add(names[1], "double")
    if spans:
        schema = schema.add(names[2], ArrayType(StructType.fromDDL("a int, b int, lang string")))

    def run(batches):
        model = shared.value
        for whole in batches:
            for b in text_slices([whole], text):
                w = read_words(b.column(text))
                labels = label_words(model.scores(w), w.codes, w.bounds, switch) if model.languages else None
                weight = w.letters[w.codes]
                pred, score, found = [], [], []
                for a, z in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist()):
                    total = weight[a:z].sum()
                    if labels is None or not total:
                        pred.append(UNKNOWN)
                        score.append(0.0)
                        found.append([])
                        continue
                    n = np.bincount(labels[a:z], weight[a:z])
                    pred.append(model.languages[int(n.argmax())])
                    score.append(float(n.max() / total))
                    if spans:
                        cut = [0, *(np.flatnonzero(np.diff(labels[a:z])) + 1).tolist(), z - a]
                        found.append([{"a": x, "b": y, "lang": model.languages[labels[a + x]]} for x, y in zip(cut[:-1], cut[1:])])
                more = [pa.array(pred, pa.string()), pa.array(score, pa.float64())]
                if spans:
                    more.append(pa.array(found, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*kept, *more_names])

    return df.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    model = train(docs.filter(~out).select("text", "lang"))
    found = detect(docs.select("doc_id", "text"), model)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
