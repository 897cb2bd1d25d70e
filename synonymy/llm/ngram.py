"""Language-model scores from an Elias-Fano n-gram trie of order three.

The trie is a set of shard files in the shared folder, memory-mapped by the tasks
that query it.

* Level one: a shard's words as a monotone sequence of hashes, with exact counts; a
  word's id is its place over all shards.
* Level two: the words with successors, and for each a range of successors given by
  monotone pointers.
* Level three: for each node of level two the range of its successors, given by
  monotone pointers; a trigram lies in the shard of its context.

A successor's id is stored relative to its context (context times vocabulary, plus id),
which makes a level's ids one monotone sequence.  All sequences are Elias-Fano coded.
A lookup reads the context's two pointers and searches the successor between them.

Each node holds, in 16 bits each, the quantised logarithm of the probability that its
own order adds and of the weight that the order below keeps:
p1 = (c - D) / N with the mass D * V / N for all unknown words together,
D = n1 / (n1 + 2 n2); p2(w|v) = c(v,w) / (c(v) + K) + K / (c(v) + K) * p1(w), and
p3(w|u,v) = c(u,v,w) / (c(u,v) + K) + K / (c(u,v) + K) * p2(w|v).  A context that was
never seen leaves the order below as it is.

Counting is exact and distributed, in one pass for words and one for pairs and
trigrams: tasks pre-aggregate their own n-grams, blobs of sorted keys go to their shard by the hash of their context, or of the whole pair where
the context is a frequent word (so no word fills a shard), and one task merges a shard.  Nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORDS, Words, chunks, column, cut, hash_word, mix, only, put, scratch, uri

STRENGTH = 20.0
STEP = 1 / 2048  # of quantised log10 probabilities
END = np.uint64(hash_word("\x00end\x00"))
MOST_PENDING = 1 << 23
#: Bytes of text that are looked up at once; n-grams that stand in it more than once are sought once.
LOOKUP_BYTES = 1 << 23
#: Of each shard so many of the most frequent words may be frequent ones, whose successors are spread over all shards.
FREQUENT = 64
_U = np.uint64


# ---------------------------------------------------------------- Elias-Fano
EVERY = 16  # so many ones, or zeros, from one sampled place to the next


def ef_arrays(values: np.ndarray, universe: int) -> list[np.ndarray]:
    """[n, low bits, buckets], packed low bits, bitmap of high bits (ones: elements, zeros: ends of buckets), places of every 16th zero and of every 16th one."""
    n = len(values)
    low = max(0, (universe // max(n, 1)).bit_length() - 1)
    high = (values >> _U(low)).astype(np.int64)
    packed = np.zeros(n * low // 64 + 2, np.uint64)
    if low:
        part, at = values & _U((1 << low) - 1), np.arange(n, dtype=np.uint64) * _U(low)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        np.bitwise_or.at(packed, word, part << shift)
        over = shift + _U(low) > 64
        np.bitwise_or.at(packed, word[over] + 1, part[over] >> (_U(64) - shift[over]))
    buckets = (universe >> low) + 1
    size = n + buckets
    bits = np.zeros((size + 63) // 64 * 64 + 64, np.uint8)
    ones = high + np.arange(n)
    bits[ones] = 1
    bitmap = np.packbits(bits, bitorder="little").view(np.uint64)
    kind = np.uint32 if size < 1 << 32 else np.uint64
    return [np.array([n, low, buckets], np.int64), packed, bitmap, np.flatnonzero(bits == 0)[::EVERY].astype(kind), ones[::EVERY].astype(kind)]


_BYTE = np.zeros((256, 8), np.uint8)  # place of the r-th one of a byte
for _b in range(256):
    for _r, _p in enumerate(p for p in range(8) if _b >> p & 1):
        _BYTE[_b, _r] = _p
_BYTE = _BYTE.ravel()
_ONES, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)


def _bit(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one (from 0) of each word, which has that many."""
    s = x - ((x >> _U(1)) & _U(0x5555555555555555))
    s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
    s = ((s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES  # ones up to each byte's end
    r = r.astype(np.uint64)
    # Bytes up to whose end there are at most r ones lie before the one sought.
    before = ((((r * _ONES) | _TOPS) - s) & _TOPS) >> _U(7)
    shift = ((before * _ONES) >> _U(56)) << _U(3)
    rest = r - (((s << _U(8)) >> shift) & _U(0xFF))
    return (shift + _BYTE[((((x >> shift) & _U(0xFF)) << _U(3)) + rest).astype(np.int64)]).astype(np.int64)


class EliasFano:
    def __init__(self, arrays: list[np.ndarray]):
        (self.n, self.low, self.buckets), self.packed, self.bitmap, self.zeros, self.ones = (int(x) for x in arrays[0]), *arrays[1:]

    def _select(self, k: np.ndarray, sample: np.ndarray, flip: np.uint64) -> np.ndarray:
        """Place of the k-th one (flip 0) or zero (flip all ones) of the bitmap."""
        at, need = sample[k // EVERY].astype(np.int64), k % EVERY
        word = at >> 6
        x = (self.bitmap[word] ^ flip) & (~_U(0) << (at & 63).astype(np.uint64))
        count = np.bitwise_count(x)
        more = np.flatnonzero(count <= need)
        while len(more):
            need[more] -= count[more]
            word[more] += 1
            x[more] = self.bitmap[word[more]] ^ flip
            count[more] = np.bitwise_count(x[more])
            more = more[count[more] <= need[more]]
        return (word << 6) + _bit(x, need)

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.low)
        word, shift = (at >> _U(6)).astype(np.int64), at & _U(63)
        upper = np.where(shift == 0, _U(0), self.packed[word + 1] << ((_U(64) - shift) & _U(63)))
        return ((self.packed[word] >> shift) | upper) & _U((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Elements by place."""
        return ((self._select(i, self.ones, _U(0)) - i).astype(np.uint64) << _U(self.low)) | self._lows(i)

    def get_two(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The elements at each place and at the one after it."""
        at = self._select(i, self.ones, _U(0))
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        rest = self.bitmap[word] & ((~_U(0) << shift) << _U(1))
        after = (word << 6) + np.bitwise_count((rest & (~rest + _U(1))) - _U(1)).astype(np.int64)
        far = np.flatnonzero(rest == 0)
        after[far] = self._select(i[far] + 1, self.ones, _U(0))
        low = _U(self.low)
        return ((at - i).astype(np.uint64) << low) | self._lows(i), ((after - i - 1).astype(np.uint64) << low) | self._lows(i + 1)

    def find(self, x: np.ndarray, first: np.ndarray | None = None, last: np.ndarray | None = None) -> np.ndarray:
        """Place of each x in the sequence, or in the places first:last of it; -1 if it is not there."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        high, low = (x >> _U(self.low)).astype(np.int64), x & _U((1 << self.low) - 1)
        known = (high >= 0) & (high < self.buckets)
        high = np.where(known, high, 0)
        # The bucket begins after the zero that ends the one before, and holds the ones up to the next zero.
        begin = np.where(high > 0, self._select(np.maximum(high - 1, 0), self.zeros, ~_U(0)) + 1, 0)
        word, shift = begin >> 6, (begin & 63).astype(np.uint64)
        run = self.bitmap[word] >> shift
        size = np.bitwise_count(run & ~(run + _U(1))).astype(np.int64)  # ones below the lowest zero
        long = np.flatnonzero(size + (begin & 63) >= 64)
        size[long] = self._select(high[long], self.zeros, ~_U(0)) - begin[long]
        b = begin - high
        e = np.where(known, b + size, b)
        if first is not None:
            b, e = np.maximum(b, first), np.minimum(e, last)
        some = b < e
        live = np.flatnonzero(e - b > 1)
        while len(live):
            mid = (b[live] + e[live]) >> 1
            upto = self._lows(mid) <= low[live]
            b[live[upto]] = mid[upto]
            e[live[~upto]] = mid[~upto]
            live = live[e[live] - b[live] > 1]
        b = np.where(some, b, 0)
        return np.where(some & (self._lows(b) == low), b, -1)


class Level:
    """Successors by context: monotone pointers to each context's range, and in it ids relative to the context."""

    def __init__(self, arrays: list[np.ndarray], vocabulary: int):
        self.pointers, self.ids, self.vocabulary = EliasFano(arrays[:5]), EliasFano(arrays[5:10]), _U(vocabulary)

    @staticmethod
    def arrays(edges: np.ndarray, child: np.ndarray, vocabulary: int) -> list[np.ndarray]:
        """``edges``: where each context's successors begin, and the end; ``child``: sorted within a context."""
        contexts = len(edges) - 1
        if contexts * vocabulary >= 1 << 63:
            raise ValueError("a shard's contexts and the vocabulary need more than 63 bits: use more shards")
        context = np.repeat(np.arange(contexts, dtype=np.uint64), np.diff(edges))
        return [*ef_arrays(edges.astype(np.uint64), len(child) + 1), *ef_arrays(context * _U(vocabulary) + child.astype(np.uint64), contexts * vocabulary)]

    def find(self, context: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Place of each successor, -1 if the context has none such.  Equal contexts should stand together."""
        if not len(context) or not self.ids.n:
            return np.full(len(context), -1, np.int64)
        new = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        repeat = np.diff(np.append(new, len(context)))
        first, last = (np.repeat(x.astype(np.int64), repeat) for x in self.pointers.get_two(context[new]))
        return self.ids.find(context.astype(np.uint64) * self.vocabulary + child.astype(np.uint64), first, last)


# ---------------------------------------------------------------- shard files
def write_arrays(path: str, arrays: list[np.ndarray]) -> None:
    """One file: the arrays' kinds and lengths, then the arrays, each at a multiple of 8 bytes."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.dtype.itemsize + 16 * (a.dtype.kind == "i"), len(a))]], np.int64)
    put(path, (raw + b"\0" * (-len(raw) % 8) for raw in (a.tobytes() for a in (head, *arrays))))


def read_arrays(path: str) -> list[np.ndarray]:
    """Memory-mapped; a store that is no file system is copied to a temporary file first, a cache of the task that goes when the mapping does."""
    fs, inner = pafs.FileSystem.from_uri(path)
    if isinstance(fs, pafs.LocalFileSystem):
        raw = np.asarray(np.memmap(inner, np.uint8, "r"))
    else:
        with tempfile.TemporaryFile() as f:
            with fs.open_input_stream(inner) as g:
                while block := g.read(1 << 22):
                    f.write(block)
            f.flush()
            raw = np.asarray(np.memmap(f, np.uint8, "r"))
    n = int(raw[:8].view(np.int64)[0])
    head, at, out = raw[8 : 8 + 16 * n].view(np.int64), 8 + 16 * n, []
    for kind, length in head.reshape(-1, 2):
        width = int(kind) % 16
        out.append(raw[at : at + width * int(length)].view(f"{'i' if kind >= 16 else 'u'}{width}"))
        at += -(-width * int(length) // 8) * 8
    return out


# ---------------------------------------------------------------- counting
def _squeezed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and counts as compressed planes of bytes."""
    d = np.diff(keys, prepend=_U(0))
    planes = np.ascontiguousarray(np.concatenate([d.view(np.uint8).reshape(-1, 8), counts.astype(np.uint32).view(np.uint8).reshape(-1, 4)], axis=1).T)
    return len(keys).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _loosened(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], decompressed_size=12 * n, codec="zstd", asbytes=True), np.uint8).reshape(12, n).T
    keys = np.cumsum(np.ascontiguousarray(planes[:, :8]).view(np.uint64).ravel(), dtype=np.uint64)
    return keys, np.ascontiguousarray(planes[:, 8:]).view(np.uint32).ravel().astype(np.int64)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


def _squeezed_triples(pairs: np.ndarray, words: np.ndarray, counts: np.ndarray) -> bytes:
    planes = np.concatenate([np.diff(pairs, prepend=_U(0)).view(np.uint8).reshape(-1, 8), words.astype(np.uint32).view(np.uint8).reshape(-1, 4), counts.astype(np.uint32).view(np.uint8).reshape(-1, 4)], axis=1)
    return len(pairs).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes.T).tobytes(), codec="zstd", asbytes=True)


def _loosened_triples(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(pa.decompress(blob[8:], decompressed_size=16 * n, codec="zstd", asbytes=True), np.uint8).reshape(16, n).T
    part = lambda a, b, kind: np.ascontiguousarray(planes[:, a:b]).view(kind).ravel()
    return np.cumsum(part(0, 8, np.uint64), dtype=np.uint64), part(8, 12, np.uint32), part(12, 16, np.uint32).astype(np.int64)


def _merged_triples(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, word) in order, with summed counts."""
    p, w, c = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(parts) == 1 or not len(p):
        return p, w, c
    order = np.lexsort((w, p))
    p, w, c = p[order], w[order], c[order]
    first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (w[1:] != w[:-1])])
    return p[first], w[first], np.add.reduceat(c, first)


def _dealt(shard: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """(shard, its rows of the columns), in their order."""
    order = np.argsort(shard.astype(np.uint16), kind="stable")
    shard, columns = shard[order], [c[order] for c in columns]
    edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(shard) else np.zeros(0, np.int64)
    for a, b in zip(edges, np.append(edges[1:], len(shard)) if len(shard) else edges, strict=True):
        yield int(shard[a]), tuple(c[a:b] for c in columns)


def _blobs(parts: Iterator[list[Iterator]], merges: list, squeezes: list) -> Iterator[pa.RecordBatch]:
    """Pre-aggregated blobs of a task, a column for each kind of n-gram: ``parts`` has dealt rows of each kind, ``merges`` and ``squeezes`` sum up and pack them."""
    pending: list[dict[int, list]] = [{} for _ in merges]
    held = 0

    def flush():
        shards = sorted(set().union(*pending))
        rows = [[squeeze(*merge(kind[s])) if s in kind else None for s in shards] for kind, merge, squeeze in zip(pending, merges, squeezes, strict=True)]
        for kind in pending:
            kind.clear()
        return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), *(pa.array(r, pa.binary()) for r in rows)], names=["shard", *(f"blob{i}" for i in range(len(rows)))])

    for part in parts:
        for kind, dealt in zip(pending, part, strict=True):
            for s, columns in dealt:
                kind.setdefault(s, []).append(columns)
                held += len(columns[0])
        if held > MOST_PENDING:
            held = 0
            for kind, merge in zip(pending, merges, strict=True):
                for s, rows in kind.items():
                    kind[s] = [merge(rows)]
                    held += len(kind[s][0][0])
            if held > MOST_PENDING // 2:
                yield flush()
                held = 0
    yield flush()


def _merged_rows(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return _merged(*map(list, zip(*rows, strict=True)))


class Tokens:
    """A slice's words with an end after each row's."""

    def __init__(self, batch: pa.RecordBatch):
        counts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for part in chunks(batch):
            w = Words(column(part, "text"), SPACE_WORDS)
            counts.append(np.diff(w.first)), hashes.append(w.hashes())
        self.first = np.concatenate([[0], np.cumsum(np.concatenate(counts) + 1)])
        self.hash = np.full(int(self.first[-1]), END)
        body = np.ones(len(self.hash), bool)
        body[self.first[1:] - 1] = False
        self.hash[body] = np.concatenate(hashes)

    def before(self, x: np.ndarray, end) -> np.ndarray:
        """x of the token before; a row's first token comes after an end."""
        out = np.empty_like(x)
        out[1:] = x[:-1]
        out[self.first[:-1]] = end
        return out


def _word_shard(shards: int):
    bits = max(shards.bit_length() - 1, 0)
    return lambda h: (h >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for whole in batches for b in chunks(whole, most=LOOKUP_BYTES) if b.num_rows)


def _count_words(shards: int):
    def run(batches):
        shard = _word_shard(shards)
        words = (np.unique(Tokens(b).hash, return_counts=True) for b in _sliced(batches))
        yield from _blobs(([_dealt(shard(k), k, c)] for k, c in words), [_merged_rows], [_squeezed])

    return run


def _build_words(folder: str):
    def run(table: pa.Table) -> pa.Table:
        shard, (k, c) = table["shard"][0].as_py(), _merged_rows([_loosened(b) for b in table["blob0"].to_pylist()])
        write_arrays(f"{folder}/words-{shard}", [*ef_arrays(k, 1 << 64), c])
        top = np.sort(np.argsort(-c, kind="stable")[:FREQUENT])
        one = lambda x, t: pa.array([x], t)
        return pa.table({"shard": one(shard, pa.int32()), "words": one(len(k), pa.int64()), "tokens": one(int(c.sum()), pa.int64()), "once": one(int((c == 1).sum()), pa.int64()), "twice": one(int((c == 2).sum()), pa.int64()), "top": one(top, pa.list_(pa.int64())), "counts": one(c[top], pa.list_(pa.int64()))})

    return run


def _code(p: np.ndarray) -> np.ndarray:
    """Probabilities as multiples of STEP of their negative log10."""
    return np.clip(np.round(-np.log10(p) / STEP), 0, 65535).astype(np.uint16)


_SHARES = np.power(10.0, np.arange(65536) * -STEP)


def _share(code: np.ndarray) -> np.ndarray:
    return _SHARES[code]


class Trie:
    """Where the shard files are, and totals over them (a number for each shard)."""

    def __init__(self, folder: str, shards: int, rows: list, strength: float):
        """``rows``: what _build_words says of each shard."""
        self.folder, self.shards, self.strength = folder, shards, strength
        self.tokens, once, twice = (sum(r[c] for r in rows) for c in ("tokens", "once", "twice"))
        sizes = np.zeros(shards, np.int64)
        for r in rows:
            sizes[r["shard"]] = r["words"]
        self.base, self.vocabulary = np.cumsum(sizes) - sizes, int(sizes.sum())
        if self.vocabulary >= 1 << 32:
            raise ValueError("pairs of word ids need more than 64 bits")
        often = [self.base[r["shard"]] + i for r in rows for i, c in zip(r["top"], r["counts"], strict=True) if c * shards * 16 > self.tokens]
        self.frequent = np.sort(np.array([*often, np.iinfo(np.int64).max], np.int64)).astype(np.uint64)
        self.discount = once / (once + 2 * twice) if once and twice else 0.5
        self.pairs, self.triples = {}, {}  # nodes of the shards that have files of that level
        self._open: dict[str, object] = {}

    def shard_of(self, pairs: np.ndarray) -> np.ndarray:
        """Shards of pairs: by the first word, by both where it is frequent."""
        context = pairs // _U(max(self.vocabulary, 1))
        often = self.frequent[np.searchsorted(self.frequent, context)] == context
        return (mix(np.where(often, pairs, context + _U(1))) & _U(self.shards - 1)).astype(np.int64)

    def __getstate__(self):
        return self.__dict__ | {"_open": {}}

    def _file(self, name: str, make):
        if name not in self._open:
            self._open[name] = make(read_arrays(f"{self.folder}/{name}"))
        return self._open[name]

    def _words(self, s: int):
        return self._file(f"words-{s}", lambda a: (EliasFano(a[:5]), a[5]))

    def _pairs(self, s: int):
        return self._file(f"pairs-{s}", lambda a: (EliasFano(a[:5]), Level(a[5:15], self.vocabulary), a[15]))

    def _triples(self, s: int):
        return self._file(f"triples-{s}", lambda a: (Level(a[:10], self.vocabulary), a[10]))

    def _by_shard(self, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(shard, which); each shard's in their order."""
        order = np.argsort(shard.astype(np.uint16), kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0]) if len(order) else []
        for a, b in zip(edges, np.r_[edges[1:], len(order)] if len(order) else [], strict=True):
            yield int(shard[order[a]]), order[a:b]

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of words by hash; unknown: (-1, 0)."""
        u, inverse = np.unique(h, return_inverse=True)
        ids, counts = np.full(len(u), -1, np.int64), np.zeros(len(u), np.int64)
        if self.vocabulary:
            sizes = np.diff(np.append(self.base, self.vocabulary))
            for s, at in self._by_shard(_word_shard(self.shards)(u)):
                if sizes[s]:
                    ef, c = self._words(s)
                    i = ef.find(u[at])
                    ids[at] = np.where(i >= 0, i + self.base[s], -1)
                    counts[at] = np.where(i >= 0, c[np.maximum(i, 0)], 0)
        return ids[inverse], counts[inverse]

    def count(self, ids: np.ndarray) -> np.ndarray:
        """Counts of words by id."""
        out = np.zeros(len(ids), np.int64)
        for s, at in self._by_shard(np.searchsorted(self.base, ids, "right") - 1):
            out[at] = self._words(s)[1][ids[at] - self.base[s]]
        return out

    def p1(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, (counts - self.discount) / self.tokens, self.discount * self.vocabulary / self.tokens)

    def end(self) -> tuple[int, int]:
        ids, counts = self.look(np.array([END]))
        return int(ids[0]), int(counts[0])

    def pairs_of(self, before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs of known words in order, and which of them each token ends (-1: none)."""
        which = np.full(len(ids), -1, np.int64)
        both = np.flatnonzero((before >= 0) & (ids >= 0))
        keys, which[both] = np.unique(before[both].astype(np.uint64) * _U(self.vocabulary) + ids[both].astype(np.uint64), return_inverse=True)
        return keys, which

    def second(self, before: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: which of the distinct pairs it ends, and of each of these its shard, node (-1: unseen), and codes (own share high, lower order's low)."""
        keys, which = self.pairs_of(before, ids)
        shard, node = self.shard_of(keys), np.full(len(keys), -1, np.int64)
        codes = np.zeros(len(keys), np.uint32)
        context = keys // _U(max(self.vocabulary, 1))
        child = keys - context * _U(max(self.vocabulary, 1))
        for s, at in self._by_shard(shard):
            if s in self.pairs:
                parents, level, code = self._pairs(s)
                own = context[at]
                new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                parent = np.repeat(parents.find(own[new]), np.diff(np.append(new, len(at))))
                some = np.flatnonzero(parent >= 0)
                i = level.find(parent[some], child[at[some]])
                hit = i >= 0
                node[at[some[hit]]] = i[hit]
                codes[at[some[hit]]] = code[i[hit]]
        return which, shard, node, codes

    def contexts(self, tokens: Tokens, which: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Of each token the pair before it that is a node of level two, -1 if there is none."""
        out = tokens.before(which, -1)
        return np.where((out >= 0) & (node[np.maximum(out, 0)] >= 0), out, -1) if len(node) else np.full(len(which), -1, np.int64)

    def log10(self, tokens: Tokens, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Each token's log10 probability after the two before (the first one's: after an end)."""
        e, n = self.end()
        before, before_n = tokens.before(ids, e), tokens.before(counts, n)
        which, shard, node, codes = self.second(before, ids)
        p = self.p1(counts)
        p = np.where(before >= 0, self.strength / (before_n + self.strength) * p, p)
        del before, before_n
        own = _share(codes >> np.uint32(16)) * (node >= 0)
        seen = np.flatnonzero(which >= 0)
        p[seen] += own[which[seen]]
        context = self.contexts(tokens, which, node)
        after = np.flatnonzero(context >= 0)
        p[after] *= _share(codes & np.uint32(0xFFFF))[context[after]]
        after = after[ids[after] >= 0]
        keys, inverse = np.unique(context[after].astype(np.uint64) * _U(self.vocabulary) + ids[after].astype(np.uint64), return_inverse=True)
        pair = keys // _U(max(self.vocabulary, 1))
        child, pair = keys - pair * _U(max(self.vocabulary, 1)), pair.astype(np.int64)
        adds = np.zeros(len(keys))
        for s, at in self._by_shard(shard[pair]):
            if s in self.triples:
                level, share = self._triples(s)
                i = level.find(node[pair[at]], child[at])
                hit = i >= 0
                adds[at[hit]] = _share(share[i[hit]])
        p[after] += adds[inverse]
        return np.log10(p)


def _count_grams(trie: Trie):
    """Pairs, and trigrams as a pair and the word after it."""

    def grams(batch: pa.RecordBatch) -> list[Iterator]:
        t = Tokens(batch)
        ids, _ = trie.look(t.hash)
        keys, which = trie.pairs_of(t.before(ids, trie.end()[0]), ids)
        context = t.before(which, -1)
        at = np.flatnonzero(context >= 0)
        triples, counts = np.unique(context[at].astype(np.uint64) * _U(trie.vocabulary) + ids[at].astype(np.uint64), return_counts=True)
        pair = triples // _U(trie.vocabulary)
        shard = trie.shard_of(keys)
        own = pair.astype(np.int64)
        return [_dealt(shard, keys, np.bincount(which, minlength=len(keys))), _dealt(shard[own], keys[own], (triples - pair * _U(trie.vocabulary)).astype(np.uint32), counts)]

    def run(batches):
        yield from _blobs(map(grams, _sliced(batches)), [_merged_rows, _merged_triples], [_squeezed, _squeezed_triples])

    return run


def _build_grams(trie: Trie):
    """Levels two and three of a shard; a trigram's context is the place of its pair."""

    def run(table: pa.Table) -> pa.Table:
        shard, v = table["shard"][0].as_py(), trie.vocabulary
        k, c = _merged_rows([_loosened(b) for b in table["blob0"].to_pylist() if b])
        parent, child = k // _U(v), k % _U(v)
        edges = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        parents, edges = parent[edges], np.append(edges, len(k))
        total = np.repeat(trie.count(parents.astype(np.int64)), np.diff(edges))
        codes = _code(c / (total + trie.strength)).astype(np.uint32) << np.uint32(16) | _code(trie.strength / (c + trie.strength))
        write_arrays(f"{trie.folder}/pairs-{shard}", [*ef_arrays(parents, v), *Level.arrays(edges, child, v), codes])
        blobs = [_loosened_triples(b) for b in table["blob1"].to_pylist() if b]
        if blobs:
            pair, word, n = _merged_triples(blobs)
            context = np.searchsorted(k, pair)
            # Each time a context stands in the text one successor follows it, so their counts add up to its own.
            total = np.bincount(context, n, len(k))
            write_arrays(f"{trie.folder}/triples-{shard}", [*Level.arrays(np.searchsorted(context, np.arange(len(k) + 1)), word, v), _code(n / (total[context] + trie.strength))])
        return pa.table({"shard": pa.array([shard], pa.int32()), "pairs": pa.array([len(k)], pa.int64()), "triples": pa.array([len(word) if blobs else 0], pa.int64())})

    return run


def _scored(trie: Trie):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            t = Tokens(batch)
            ids, counts = trie.look(t.hash)
            at = t.first[:-1]
            base = np.add.reduceat(np.log10((counts + 1) / (trie.tokens + 1.0 * (trie.vocabulary + 1))), at)
            score = np.add.reduceat(trie.log10(t, ids, counts), at)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(np.diff(t.first)), pa.array(np.add.reduceat((counts > 0).astype(np.int64), at)), pa.array(np.full(len(at), trie.tokens, np.int64)), pa.array(base), pa.array(score)],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def train(docs: DataFrame, strength: float = STRENGTH, shards: int | None = None) -> Trie:
    """The trie of ``docs`` (text).  Without ``shards`` there are as many as input partitions, as a power of two (a task merges one shard)."""
    folder = uri(scratch(docs.sparkSession))
    docs = only(docs, "text")
    shards = shards or 1 << max(3, (docs.rdd.getNumPartitions() - 1).bit_length())

    def built(count, kinds: int, build, schema: str, name: str) -> list:
        blobs = docs.mapInArrow(count, "shard int" + "".join(f", blob{i} binary" for i in range(kinds)))
        return cut(blobs.groupBy("shard").applyInArrow(build, schema), folder, name).collect()  # a row for each shard

    trie = Trie(folder, shards, built(_count_words(shards), 1, _build_words(folder), "shard int, words long, tokens long, once long, twice long, top array<long>, counts array<long>", "word-sizes"), strength)
    if trie.tokens:
        for r in built(_count_grams(trie), 2, _build_grams(trie), "shard int, pairs long, triples long", "gram-sizes"):
            trie.pairs[r["shard"]] = r["pairs"]
            if r["triples"]:
                trie.triples[r["shard"]] = r["triples"]
    return trie


def score(docs: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text).

    Learns from rows whose crc32(doc_id) mod 7 is not 2; a null doc_id (held_out
    null) teaches nothing.  A null, empty or blank text is one token, the end.
    Repeated rows count each time.  If nothing teaches, base_score is that of
    N = V = 0 and score is 0 for every token.  Columns other than doc_id and text are ignored.
    """
    docs = only(docs, "doc_id", "text")
    trie = train(docs.where("crc32(cast(doc_id as string)) % 7 <> 2"), strength)
    out = docs.mapInArrow(_scored(trie), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.select("doc_id", F.expr("crc32(cast(doc_id as string)) % 7 = 2").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_lm_scoring(spark, sf_dir):
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"))
