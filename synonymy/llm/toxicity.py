"""Toxicity by a weighted lexicon.

Texts are folded (case, accents' homoglyphs, digit and sign substitutions, invisible
characters), then one Aho-Corasick automaton finds every lexicon entry.  The sum of
weights is normalised by length, and exception phrases (words that contain an entry
but stand in clean texts) take their hits back.

The lexicon is learned: entries are folded words and word beginnings that mark
labelled toxic documents, weighted by their smoothed log odds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, only

#: Characters that look like a Latin letter, and digits or signs used for one.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "з": "3", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ɑ": "a", "ⅼ": "l",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = "­​‌‍⁠﻿"

#: Bound on the labelled rows that the lexicon and the score's scale are fitted on.
LABELLED_ROWS = 40_000
STEM = (4, 9)


def _table() -> dict[int, str | None]:
    full_width = {chr(0xFF21 + i): chr(97 + i) for i in range(26)} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)} | {chr(0xFF10 + i): str(i) for i in range(10)}
    return str.maketrans(HOMOGLYPHS | full_width | dict.fromkeys(INVISIBLE))


_FOLD = _table()
_LEET = str.maketrans(SUBSTITUTES)


@lru_cache(maxsize=1 << 18)
def fold_word(word: str) -> str:
    """A lower-case word without homoglyphs; digits and signs inside a word that also
    has letters become letters."""
    word = word.translate(_FOLD).strip(".,;:?\"'()[]{}<>*_~`#&-")
    if word.isalpha() or not any(c.isalpha() for c in word):
        return word
    if word[-1] == "!":
        word = word.rstrip("!")
    return word.translate(_LEET)


def folded(text: str | None) -> list[str]:
    """Folded words of any length; only short ones are remembered."""
    return [fold_word(w) if len(w) < 64 else fold_word.__wrapped__(w) for w in (text or "").lower().split()]


def _terms(word: str) -> Iterator[str]:
    """Entries that a word could match: its beginnings and itself, with the mark of a word's start."""
    for n in range(STEM[0], min(STEM[1], len(word) - 1) + 1):
        yield f" {word[:n]}"
    if len(word) >= 3:
        yield f" {word} "


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a partition each term stands, by label."""
    seen = {0: Counter(), 1: Counter()}

    def flush():
        terms = sorted(set(seen[0]) | set(seen[1]))
        out = [terms, [seen[0][t] for t in terms], [seen[1][t] for t in terms]]
        for c in seen.values():
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], names=["term", "clean", "toxic"])

    for batch in batches:
        for text, label in zip(column(batch, "text").to_pylist(), column(batch, "toxic").to_pylist(), strict=True):
            seen[label].update({t for w in set(folded(text)) for t in _terms(w)})
            if len(seen[0]) + len(seen[1]) > 1_000_000:
                yield flush()
    yield flush()


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, toxic) to learn from: labels of 0 or 1, rows whose crc32(doc_id) mod 5 is
    not 0, and of these at most ``most``, first by crc32.  Labels that disagree on an id drop it."""
    y = only(labels, "doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").cast("int").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    y = y.where("crc32(cast(doc_id as string)) % 5 <> 0").select("doc_id", "toxic").orderBy(F.expr("crc32(cast(doc_id as string))"), "doc_id").limit(most)
    # Copies of one text teach once, or one document's copies would fill the lexicon.
    return only(docs, "doc_id", "text").where("text is not null").join(y, "doc_id").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).select("doc_id", "text", "toxic")


class Lexicon:
    """Weighted entries, exception words, and the scale that makes sums probabilities."""

    def __init__(self, weights: dict[str, float], exceptions: list[str], scale: tuple[float, float, float]):
        self.weights, self.exceptions, self.scale = weights, exceptions, scale
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def sums(self, text: str | None) -> tuple[float, int]:
        """(sum of the weights of the words' best entries, number of words)."""
        import ahocorasick

        if self._automaton is None and self.weights:
            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(entry, (len(entry), weight))
            for word in self.exceptions:
                self._automaton.add_word(f" {word} ", (len(word) + 2, -math.inf))
            self._automaton.make_automaton()
        words = folded(text)
        if not self.weights or not words:
            return 0.0, len(words)
        best: dict[int, float] = {}  # by where the word begins
        for end, (n, weight) in self._automaton.iter(" " + " ".join(words) + " "):
            at = end - n + 1
            best[at] = -math.inf if -math.inf in (weight, best.get(at)) else max(weight, best.get(at, weight))
        return sum(w for w in best.values() if w > 0), len(words)

    def score(self, total: float, words: int) -> float:
        """0 to 1, higher: likelier toxic; an empty text has the score of no hit."""
        a, b, c = self.scale
        z = a + b * math.log1p(total) + c * math.log1p(total / math.sqrt(1 + words / 100))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Newton's method for a few hundred thousand numbers at most (LABELLED_ROWS rows)."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + ridge * len(y) * np.r_[0, w[1:]] / len(y)
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return w


def _leading(entries: dict[str, tuple[float, float]]) -> dict[str, float]:
    """term -> odds, best g2 first, without terms that begin with one taken before, and without beginnings of a taken term with odds as good."""
    weights: dict[str, float] = {}
    below: dict[str, float] = {}  # the best odds of taken terms by each of their beginnings
    for term, (_, odds) in sorted(entries.items(), key=lambda e: (-e[1][0], -len(e[0]), e[0])):
        starts = [term[:n] for n in range(1, len(term) + 1)]
        if not any(x in weights for x in starts) and below.get(term.rstrip(), -math.inf) < odds:
            weights[term] = odds
            for x in starts:
                below[x] = max(below.get(x, odds), odds)
    return weights


def _summed(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [lexicon.sums(x) for x in column(batch, "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.int64()), column(batch, "toxic")], names=["total", "words", "toxic"])

    return run


def learn(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> Lexicon:
    """Without both labels among the rows to learn from, a lexicon that scores every text the share of label 1 (0 if none)."""
    rows = labelled(docs, labels, most).persist()
    try:
        n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        n0, n1 = n.get(0, 0), n.get(1, 0)
        if not n0 or not n1:
            return Lexicon({}, [], (30.0 if n1 else -30.0, 0.0, 0.0))
        counts = rows.mapInArrow(_document_counts, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        odds = F.log((F.col("toxic") + 0.5) / (n1 + 1.0)) - F.log((F.col("clean") + 0.5) / (n0 + 1.0))
        # Likelihood-ratio statistic: unlike odds over their error, it ranks entries that clean texts never have first.
        both = F.col("toxic") + F.col("clean")
        part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / (both * share))).otherwise(0.0)
        g2 = 2 * (part(F.col("toxic"), F.lit(n1 / (n0 + n1))) + part(F.col("clean"), F.lit(n0 / (n0 + n1))))
        # As many rows as terms of the bounded sample pass both tests.
        entries = counts.where("toxic >= 3").select("term", odds.alias("odds"), g2.alias("g2")).where("odds > 2 and g2 > 15").collect()
        weights = _leading({r["term"]: (r["g2"], r["odds"]) for r in entries})
        stems = [e for e in weights if not e.endswith(" ")]
        exceptions = []
        if stems:
            beginnings = F.transform(F.sequence(F.lit(STEM[0]), F.lit(STEM[1])), lambda n: F.substring(F.col("term"), F.lit(1), n + 1))
            hit = F.arrays_overlap(beginnings, F.array(*map(F.lit, stems)))
            exceptions = [r["term"].strip() for r in counts.where(F.expr("term like '% '") & hit & (F.col("clean") >= 3) & (F.col("clean") > 20 * F.col("toxic"))).collect()]
        lexicon = Lexicon(weights, exceptions, (0, 0, 0))
        got = rows.mapInArrow(_summed(lexicon), "total double, words long, toxic int").toPandas()
    finally:
        rows.unpersist()
    t, w = got.total.to_numpy(), got.words.to_numpy()
    lexicon.scale = tuple(float(x) for x in _logistic(np.c_[np.ones(len(t)), np.log1p(t), np.log1p(t / np.sqrt(1 + w / 100))], got.toxic.to_numpy().astype(float)))
    return lexicon


def _scored(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                s = [lexicon.score(*lexicon.sums(x)) for x in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return run


def _tolerated(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                yield batch.filter(pa.array([lexicon.score(*lexicon.sums(x)) < 0.5 for x in column(batch, "text").to_pylist()], pa.bool_()))

    return run


def tolerated(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score`` does not predict toxic."""
    return docs.mapInArrow(_tolerated(learn(docs, labels, most)), docs.schema)


def score(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text).

    A null or empty text has the score of a text without hits.  A null doc_id is kept
    (held_out null); repeated rows are scored each.  Labels that are null, unknown
    or contradictory teach nothing.  Other columns are ignored.
    """
    out = only(docs, "doc_id", "text").mapInArrow(_scored(learn(docs, labels, most)), "doc_id long, score double")
    return out.select("doc_id", F.expr("crc32(cast(doc_id as string)) % 5 = 0").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_toxicity(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
