"""Secret scan: base patterns, and character Markov models for the rest.

Two first-order models over the 64 characters of base 64 and a word's end: one of
random strings, one of ordinary identifiers.  The labelled sample for the first is
what the base rules match plus generated keys; for the second every other run of
such characters in the corpus that does not keep switching between letters and digits.  A run that the random model explains better by a
likelihood ratio is a secret too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, only

KINDS = ("assign", "access", "hex", "markov")


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join([*map(_either, ("password", "passwd", "secret", "token")), f"{_either('api')}_?{_either('key')}"])
ASSIGN = re.compile(rf"""(?:{_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SWITCHES = re.compile(r"(?:[0-9]+[^0-9]+){3}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
SYMBOLS = len(ALPHABET) + 1
_CODE = np.full(256, -1, np.int64)
for _i, _c in enumerate(ALPHABET.encode()):
    _CODE[_c] = _i
_CODE[ord("=")] = SYMBOLS - 1
#: Least log-likelihood ratio of a secret: in all, and a character (nats).
LEAST_TOTAL, LEAST_MEAN = 12.0, 0.5
GENERATED = 4000


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the base rules, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _pairs(data: bytes) -> np.ndarray:
    """Counts of neighbouring characters of the alphabet."""
    c = _CODE[np.frombuffer(data, np.uint8)]
    a, b = c[:-1], c[1:]
    ok = (a >= 0) & (b >= 0)
    return np.bincount(a[ok] * SYMBOLS + b[ok], minlength=SYMBOLS * SYMBOLS)


def generated_keys(n: int = GENERATED, seed: int = 11) -> bytes:
    """Random keys in four alphabets, one a line."""
    rng = np.random.default_rng(seed)
    sets = [ALPHABET[52:62] + "abcdef", ALPHABET[:62], ALPHABET[:64], ALPHABET[:26] + "234567"]
    return "\n".join("".join(rng.choice(list(sets[i % 4]), 32)) for i in range(n)).encode()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    plain, secret = np.zeros(SYMBOLS * SYMBOLS, np.int64), np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for whole in batches:
        for batch in chunks(whole):
            texts = [x for x in column(batch, "text").to_pylist() if x]
            every = _pairs("\n".join(texts).encode())
            hidden = _pairs("\n".join(t[m.start(1) : m.end(1)] if k == 0 else m[0] for t in texts for k, m in _matches(t)).encode())
            open_ = _pairs("\n".join(x for t in texts for x in _unlabelled(t)).encode())
            secret += hidden
            plain += np.maximum(every - hidden - open_, 0)
    at = np.arange(SYMBOLS * SYMBOLS)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(plain), pa.array(secret)], names=["pair", "plain", "secret"])


def _unlabelled(text: str) -> Iterator[str]:
    """Runs outside the base spans that switch between letters and digits too often to be taken for ordinary ones."""
    runs = [m for m in RUN.finditer(text) if SWITCHES.search(m[0])]
    taken = base_spans(text) if runs else []
    yield from (m[0] for m in runs if not any(s < m.end() and m.start() < e for s, _, e in taken))


def _matches(text: str) -> Iterator[tuple[int, re.Match]]:
    """Base matches to learn from, none inside another."""
    end = 0
    found = [(m.start(), 0, m) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    found += [(m.start(), 1, m) for m in ACCESS.finditer(text) if len(m[0]) >= 20] + [(m.start(), 2, m) for m in HEX.finditer(text)]
    for start, kind, m in sorted(found, key=lambda x: x[:2]):
        if start >= end:
            end = m.end()
            yield kind, m


def ratios(plain: np.ndarray, secret: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each character given the one before, random against ordinary.

    The corpus' own secrets weigh as much as the generated keys at most, so that
    one common kind of key does not hide the others.
    """

    def model(n: np.ndarray) -> np.ndarray:
        n = n.reshape(SYMBOLS, SYMBOLS)
        back = (n.sum(axis=0) + 0.5) / (n.sum() + 0.5 * SYMBOLS)
        return (n + 8 * back) / (n.sum(axis=1, keepdims=True) + 8)

    made = _pairs(generated_keys()).astype(float)
    share = min(1.0, made.sum() / max(secret.sum(), 1))
    return np.log(model(made + secret * share)) - np.log(model(plain.astype(float)))


def _scanned(ratio: np.ndarray):
    def markov(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
        for m in RUN.finditer(text):
            a, b = m.span()
            if any(s < b and a < e for s, _, e in taken):
                continue
            c = _CODE[np.frombuffer(m[0].encode(), np.uint8)]
            r = ratio[c[:-1], c[1:]]
            if r.sum() >= LEAST_TOTAL and r.mean() >= LEAST_MEAN and len(set(m[0])) >= 8:
                yield a, 3, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        show = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        for whole in batches:
            for batch in chunks(whole):
                n, digest, spans = [], [], []
                for text in column(batch, "text").to_pylist():
                    base = base_spans(text or "")
                    n.append([sum(k == i for _, k, _ in base) for i in range(3)])
                    digest.append(hashlib.sha256(show(base).encode()).hexdigest())
                    spans.append(show(sorted([*base, *markov(text or "", base)])))
                n = np.array(n, np.int64).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(n[:, i]) for i in range(3)), pa.array(digest, pa.string()), pa.array(spans, pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of ``docs`` (doc_id, text).

    Spans are kind:start:end in code points, end exclusive; kind markov is added by the
    models and never overlaps a base span.  Null or empty texts have none.  Null
    or repeated doc_ids are scanned row by row; columns other than doc_id and text are ignored.
    """
    docs = only(docs, "doc_id", "text")
    counts = docs.mapInArrow(_counted, "pair long, plain long, secret long").groupBy("pair").agg(F.sum("plain").alias("plain"), F.sum("secret").alias("secret"))
    got = counts.toPandas()  # one row for each pair of characters
    plain, secret = np.zeros((2, SYMBOLS * SYMBOLS), np.int64)
    plain[got.pair], secret[got.pair] = got.plain, got.secret
    return docs.mapInArrow(_scanned(ratios(plain, secret)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def op10_secret_scan(spark, sf_dir):
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
