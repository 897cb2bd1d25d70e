"""md5 of a prefix and decimal numbers, for whole arrays: what resampling draws and orders by, as ``md5`` in SQL does for single rows."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_K = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURN = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
#: Messages of one block, and how many of them are hashed at once (so that they stay in the cache).
_LONGEST, _AT_ONCE = 55, 16384


def md5_words(prefix: str, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last 64 bits of md5(prefix || number), for each number."""
    start = prefix.encode()
    first, last = np.empty(len(numbers), np.uint64), np.empty(len(numbers), np.uint64)
    if len(start) + 20 > _LONGEST or (len(numbers) and numbers.min() < 0):
        both = np.frombuffer(b"".join(hashlib.md5(start + b"%d" % k).digest() for k in numbers.tolist()), ">u8").reshape(-1, 2)
        return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)
    numbers = numbers.astype(np.uint64)
    digits = np.maximum(1, np.searchsorted(np.array([10**k for k in range(20)], np.uint64), numbers, "right"))
    for n in np.unique(digits):
        rows = np.flatnonzero(digits == n)
        for at in range(0, len(rows), _AT_ONCE):
            some = rows[at : at + _AT_ONCE]
            first[some], last[some] = _block(start, numbers[some], int(n))
    return first, last


def md5_numbers(prefix: str, numbers: np.ndarray) -> np.ndarray:
    """The first 15 hexadecimal digits of md5(prefix || number) as a number."""
    return (md5_words(prefix, numbers)[0] >> np.uint64(4)).astype(np.int64)


#: Draws of a permutation test.
DRAWS = 999


def words_below(gene: pa.Array, bound: pa.Array) -> pa.Array:
    """For each gene those draws i, as (i, first, last), whose md5(i || '-' || gene) starts with 15 digits below the bound ('g': all), its halves ordered as the digits are."""
    numbers, limits = gene.to_numpy(zero_copy_only=False), np.array([2**60 if b == "g" else int(b, 16) for b in bound.to_pylist()], np.uint64)
    found = []
    for i in range(DRAWS):
        first, last = md5_words(f"{i}-", numbers)
        at = np.flatnonzero((first >> np.uint64(4)) < limits)
        found.append((at, np.full(len(at), i), *((x[at] ^ np.uint64(1 << 63)).view(np.int64) for x in (first, last))))
    rows, *columns = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(rows, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(numbers)))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c[order], pa.int64()) for c in columns], ["i", "first", "last"]))


def register(spark: SparkSession) -> None:
    """Make words_below known to SQL."""
    spark.udf.register("words_below", F.arrow_udf(words_below, "array<struct<i: bigint, first: bigint, last: bigint>>"))


def _block(start: bytes, numbers: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """One block of md5 for numbers of equally many digits; words of the message that all share stay single numbers."""
    size = len(start) + digits
    fixed = start + bytes(digits) + b"\x80" + bytes(_LONGEST - size) + (8 * size).to_bytes(8, "little")
    words: list = [int.from_bytes(fixed[4 * i : 4 * i + 4], "little") for i in range(16)]
    rest = numbers
    for at in range(size - 1, len(start) - 1, -1):
        rest, digit = np.divmod(rest, np.uint64(10))
        words[at // 4] = words[at // 4] + ((digit.astype(np.uint32) + np.uint32(48)) << np.uint32(8 * (at % 4)))
    a, b, c, d = (np.full(len(numbers), x, np.uint32) for x in _START)
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        if isinstance(words[g], int):
            f += np.uint32((_K[i] + words[g]) & 0xFFFFFFFF)
        else:
            f += words[g]
            f += np.uint32(_K[i])
        turned = f << np.uint32(_TURN[i])
        f >>= np.uint32(32 - _TURN[i])
        turned |= f
        turned += b
        a, d, c, b = d, c, b, turned
    a, b, c, d = ((x + np.uint32(s)).astype("<u4").byteswap().astype(np.uint64) for x, s in zip((a, b, c, d), _START, strict=True))
    return (a << np.uint64(32)) | b, (c << np.uint64(32)) | d
