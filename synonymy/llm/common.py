"""Scratch tables and word kernels that the training-data operators share.

Text kernels run inside ``mapInArrow``: they look at one Arrow column as one byte
buffer and work on whole buffers with numpy, a few MB at a time, whatever the
number of rows.  Both word classes of the contracts are classes of *bytes* (every
byte of a multi-byte code point is a word byte), so no text is decoded.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from synonymy.sources.shared import new_folder, written

CHUNK_BYTES = 1 << 21


# ---------------------------------------------------------------- scratch tables
def scratch(spark: SparkSession) -> str:
    """A new folder below the shared folder that the cluster names.

    Only on one machine where ``spark.checkpoint.dir`` is unset (tests) a temporary
    folder is made and set.
    """
    return new_folder(spark, "llm")


def cut(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    return written(df, f"{folder}/{name}")


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete scratch that no DataFrame reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def put(path: str, parts: Iterable[bytes]) -> None:
    """A file of the shared folder, renamed into place, so a task that runs twice does no harm."""
    fs, inner = pafs.FileSystem.from_uri(path)
    fs.create_dir(os.path.dirname(inner))
    temporary = f"{inner}.{os.getpid()}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary) as f:
        for part in parts:
            f.write(part)
    fs.move(temporary, inner)


def fetched(path: str) -> bytes:
    fs, inner = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(inner) as f:
        return f.read()


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact name, found by position: extra columns never reach the
    operator, not even ones whose names differ by case alone."""
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"c{have.index(n)}").alias(n) for n in names])


# ---------------------------------------------------------------- word kernels
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: words [^\x20\x09-\x0D]+
SPACE_WORDS = np.ones(256, bool)
SPACE_WORDS[[0x20, *range(0x09, 0x0E)]] = False
#: words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text
ALNUM_WORDS = np.zeros(256, bool)
ALNUM_WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_RNG = np.random.default_rng(20240229)
_SYMBOL = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1024)
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, b & (2**64 - 1), np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """All words of a text column: byte ``start`` and ``end`` in ``low`` (the lower-cased
    bytes), row number ``doc``, and ``first`` (a row's words are first[i]:first[i+1])."""

    def __init__(self, column: pa.Array, word_bytes: np.ndarray):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        n = len(column)
        off = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
        data = column.buffers()[2] if n else None
        raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        self.raw, self.off, self.rows = raw, off - off[0], n
        self.low = _LOWER[raw]
        w = word_bytes[self.low]
        before, after = np.zeros(len(w), bool), np.zeros(len(w), bool)
        before[1:], after[:-1] = w[:-1], w[1:]
        cut_at = self.off[1:-1]
        before[cut_at[cut_at < len(w)]] = False
        after[cut_at[cut_at > 0] - 1] = False
        self.start, self.end = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
        self.doc = np.searchsorted(self.off, self.start, "right") - 1
        self.first = np.searchsorted(self.start, self.off)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, the same for equal words anywhere."""
        power, inverse = _powers(len(self.low) + 1)
        total = np.zeros(len(self.low) + 1, np.uint64)
        np.cumsum(_SYMBOL[self.low] * power[: len(self.low)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start])

    def word(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def hash_word(word: str) -> int:
    """``Words.hashes`` of one word."""
    return int(Words(pa.array([word]), np.ones(256, bool)).hashes()[0])


def windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, where all are of one row; and where they start."""
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - k + 1
    x = np.zeros(m, np.uint64)
    for i in range(k):
        x = (x ^ h[i : i + m]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    at = np.flatnonzero(doc[:m] == doc[k - 1 :])
    return mix(x)[at], at


def chunks(batch: pa.RecordBatch, text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``most`` bytes of text each (a longer row is one slice)."""
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
    total, at = np.cumsum(size), 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
