"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: compatibility forms, Cyrillic and Greek look-alikes, digits
and signs inside words. A lexicon entry is a whole word of MIN_LETTERS or more, or a
word's beginning of MIN_LETTERS + 1 to MAX_LETTERS letters (longer beginnings would only
repeat the whole words), with a weight (its log odds in toxic against other texts); the
longest entry at a word counts, unless the word and its neighbour are an exception
phrase. Weights are summed, set against the text's length, and a logistic curve turns
that into a probability.

Lexicon, exception phrases and curve are learned from at most ``sample_rows`` labelled
rows, taken in the order of a hash of the id; entries must be likelier than chance after
testing all candidates. The sample is folded once and checkpointed. Scoring goes over
every text, whole.

Defined results: null and empty texts and texts without words score like a text without
hits of length zero. Without labels, or with one class only, the lexicon is empty and
every score is the share of toxic labels (0 without labels). Repeated rows are scored
each. In learning, a document counts once for each distinct label it has, and the
smallest text stands for rows that share an id. Extra columns pass through
``score_texts``; ``score`` of the input is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarrystone.llm._base import checkpointed, held_out, table, text_slices

SAMPLE_ROWS = 20_000
MIN_LETTERS, MAX_LETTERS = 3, 12
#: Letters of other scripts that look like Latin ones, and signs that stand for letters (fixed values).
LOOKS = str.maketrans(
    "аеорсхуіјѕԁԛԝһкмтвнαεορυικντχηıłøɑɡ",
    "aeopcxyijsdqwhkmtbhaeopuikvtxnilo" + "ag",
)
SIGNS = str.maketrans("013457@$!|8", "oieastasilb")
#: Zero-width and soft-hyphen characters that split words unseen.
_FOLDS = LOOKS | dict.fromkeys([0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_ODD = re.compile(f"[{''.join(map(chr, _FOLDS))}]")
_SIGN_RUN = re.compile(r"[013457@$!|8]+")
_WORD = re.compile(r"[^\W\d_]+")


def _in_word(m: re.Match) -> str:
    """A run of digits and signs as letters if a letter follows; a digit that ends a word likewise."""
    s, a, b = m.string, m.start(), m.end()
    letter = lambda i: 0 <= i < len(s) and s[i].isalnum() and not s[i].isdecimal()
    if letter(b):
        return m[0].translate(SIGNS)
    if letter(a - 1) and m[0][0].isdigit() and not s[a + 1 : a + 2].isdecimal():
        return m[0][0].translate(SIGNS) + m[0][1:]
    return m[0]


def fold(text: str) -> str:
    """Lower case, with disguised letters undone."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).lower()
        text = text.translate(_FOLDS) if _ODD.search(text) else text
    else:
        text = text.lower()
    return _SIGN_RUN.sub(_in_word, text)


def folded_words(text: str | None) -> list[str]:
    return _WORD.findall(fold(text)) if text else []


def entries_of(words) -> set[str]:
    """All lexicon entries that the words could match: ' begin' and ' whole '."""
    out = set()
    for w in set(words):
        if len(w) >= MIN_LETTERS:
            out.add(f" {w} ")
            out.update(f" {w[:k]}" for k in range(MIN_LETTERS + 1, min(len(w), MAX_LETTERS) + 1))
    return out


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)  # 'word next' or 'before word'
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            a.add_word(entry, (len(entry), w))
        a.make_automaton()
        return a

    def hits(self, automaton, words: list[str]) -> list[tuple[int, float]]:
        """(index of the word, weight) of each word with an entry, exceptions left out."""
        if not words or not self.weights:
            return []
        line = f" {' '.join(words)} "
        best: dict[int, tuple[int, float]] = {}
        for end, (n, w) in automaton.iter(line):
            start = end - n + 1
            if n > best.get(start, (0, 0.0))[0]:
                best[start] = (n, w)
        out = []
        begins = {at: i for i, at in enumerate(accumulate((len(w) + 1 for w in words), initial=0))} if best else {}  # the space before each word
        for start, (_, w) in sorted(best.items()):
            i = begins[start]
            if self.exceptions:
                around = {f"{words[i]} {words[i + 1]}" if i + 1 < len(words) else "", f"{words[i - 1]} {words[i]}" if i else ""}
                if around & self.exceptions:
                    continue
            out.append((i, w))
        return out

    def features(self, automaton, words: list[str]) -> tuple[float, float, float]:
        found = self.hits(automaton, words)
        total = sum(w for _, w in found)
        return (np.log1p(total), total / np.sqrt(len(words) + 10.0), max((w for _, w in found), default=0.0))

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.curve[0] + x @ np.array(self.curve[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> tuple[float, ...]:
    """Newton's method with a ridge on all but the constant."""
    x1 = np.column_stack([np.ones(len(x)), x])
    b, penalty = np.zeros(x1.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ b, -30, 30)))
        h = (x1 * (p * (1 - p))[:, None]).T @ x1 + penalty
        b += np.clip(np.linalg.solve(h, x1.T @ (y - p) - penalty @ b), -5, 5)
    return tuple(float(v) for v in b)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train, sample_rows: int, *more: str) -> DataFrame:
    """doc_id, y, text (and ``more`` columns) of at most ``sample_rows`` pairs of a labelled training document and its label.

    They are taken in the order of a hash of doc_id. A document counts once for each distinct
    label; where rows share an id, the smallest (text, more) stands for them.
    """
    y = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & train).select("doc_id", F.col(label).cast("int").alias("y")).distinct()
    y = y.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows)
    rows = docs.select("doc_id", F.struct("text", *more).alias("row")).join(F.broadcast(y), "doc_id")  # sample_rows pairs of numbers
    return rows.groupBy("doc_id", "y").agg(F.min("row").alias("row")).select("doc_id", "y", "row.*")


def learn(sample: DataFrame, max_entries: int = 5000, min_docs: int = 4) -> Lexicon:
    """Lexicon, exceptions and curve from rows (text, y), a bounded sample.

    The lexicon keeps the ``max_entries`` entries of the greatest weight at most, and as many exception
    phrases, whatever the sample holds; like the sample's size that bounds what is sent to the tasks.
    """

    def folded(batches):
        for whole in batches:
            for b in text_slices([whole], "text"):
                yield pa.RecordBatch.from_arrays([pa.array([" ".join(folded_words(t)) for t in b.column("text").to_pylist()], pa.string()), b.column("y")], names=["words", "y"])

    sample = checkpointed(sample.select("text", "y").mapInArrow(folded, "words string, y int"))

    def count(batches):
        n: Counter = Counter()
        for b in batches:
            for words, y in zip(b.column("words").to_pylist(), b.column("y").to_pylist()):
                n.update((e, y) for e in entries_of(words.split()))
        yield pa.RecordBatch.from_arrays([pa.array([k for (k, _) in n], pa.string()), pa.array([y for (_, y) in n], pa.int32()), pa.array(list(n.values()), pa.int64())], names=["entry", "y", "n"])

    classes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}  # as many as labels have values
    bad, good = classes.get(1, 0), classes.get(0, 0)
    if not bad or not good:
        share = min(max(bad / max(bad + good, 1), 1e-12), 1 - 1e-12)
        return Lexicon({}, set(), (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    counts = sample.mapInArrow(count, "entry string, y int, n bigint").groupBy("entry").agg(
        F.coalesce(F.sum(F.when(F.col("y") == 1, F.col("n"))), F.lit(0)).alias("bad"), F.coalesce(F.sum(F.when(F.col("y") == 0, F.col("n"))), F.lit(0)).alias("good")
    )
    counts = checkpointed(counts.filter(F.col("bad") + F.col("good") >= min_docs))
    weight = F.log((F.col("bad") + 0.5) / (bad + 1)) - F.log((F.col("good") + 0.5) / (good + 1))
    # log likelihood ratio of the entry's label share against the overall one
    share, rate = bad / (bad + good), F.col("bad") / (F.col("bad") + F.col("good"))
    ratio = F.col("bad") * F.log(rate / share) + F.when(F.col("good") > 0, F.col("good") * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    tested = F.lit(float(np.log(max(counts.count(), 1))))
    chosen = counts.filter(F.col("bad") >= min_docs).select("entry", weight.alias("w"), ratio.alias("r")).filter((F.col("w") > 1) & (F.col("r") > tested))
    rows = chosen.orderBy(F.desc("r"), "entry").limit(max_entries).collect()
    lexicon = Lexicon({r["entry"]: r["w"] for r in rows})

    def neighbours(batches):
        a, n = lexicon.automaton(), Counter()
        for b in batches:
            for line, y in zip(b.column("words").to_pylist(), b.column("y").to_pylist()):
                words, seen = line.split(), set()
                for i, _ in lexicon.hits(a, words):
                    seen.update(" ".join(words[k : k + 2]) for k in (i - 1, i) if k >= 0 and k + 1 < len(words))
                n.update((p, y) for p in seen)
        yield pa.RecordBatch.from_arrays([pa.array([k for (k, _) in n], pa.string()), pa.array([y for (_, y) in n], pa.int32()), pa.array(list(n.values()), pa.int64())], names=["phrase", "y", "n"])

    phrases = sample.mapInArrow(neighbours, "phrase string, y int, n bigint").groupBy("phrase").agg(F.sum("n").alias("all"), F.sum(F.col("y") * F.col("n")).alias("bad"))
    lexicon.exceptions = {r["phrase"] for r in phrases.filter((F.col("all") >= 5) & (F.col("bad") <= 0.1 * F.col("all"))).orderBy(F.desc("all"), "phrase").limit(max_entries).collect()}

    def measure(batches):
        a = lexicon.automaton()
        for b in batches:
            x = [lexicon.features(a, line.split()) for line in b.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in x], pa.float64()) for i in range(3)), b.column("y")], names=["x0", "x1", "x2", "y"])

    m = sample.mapInArrow(measure, "x0 double, x1 double, x2 double, y int").toPandas().to_numpy(float)  # sample_rows of four numbers
    m = m[np.lexsort(m.T)]
    lexicon.curve = fit_logistic(m[:, :3], m[:, 3])
    return lexicon


def score_texts(df: DataFrame, lexicon: Lexicon, text: str = "text", keep_text: bool = True) -> DataFrame:
    """df with ``score``, the probability of the toxic label; without the text if so asked."""
    df = df.drop("score")
    fields = [f for f in df.schema.fields if keep_text or f.name != text]
    names = [f.name for f in fields]
    shared = df.sparkSession.sparkContext.broadcast(lexicon)  # bounded by max_entries

    def run(batches):
        lexicon = shared.value
        a = lexicon.automaton()
        for whole in batches:
            for b in text_slices([whole], text):
                x = np.array([lexicon.features(a, folded_words(t)) for t in b.column(text).to_pylist()]).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(lexicon.probability(x))], names=[*names, "score"])

    return df.mapInArrow(run, type(df.schema)([*fields]).add("score", "double"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 3, 1)
    lexicon = learn(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", ~out, SAMPLE_ROWS))
    scored = score_texts(docs.select("doc_id", "text"), lexicon, keep_text=False)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
