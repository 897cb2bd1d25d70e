"""Benchmark decontamination.

Word n-grams of the test items seed the search.  A seed is rare if its words'
corpus frequencies make chance hits rare for each word that is read, whatever the
size of the corpus; and of each stretch of an item its rarest seed is kept, so every
part of an item is sought, however often it leaked.  Documents stream past the
seeds; hits on near diagonals open a window of the document, and Smith-Waterman on
words aligns the window with the item, so edited copies keep their score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, Words, chunks, column, only, windows

SEED_WORDS = 4
#: A seed is rare if chance would put it at fewer than one in so many words.
CHANCE = 1e-8
#: Of so many seeds in a row the rarest is kept in any case.
STRETCH = 4
#: Cells of an alignment that are held at once; larger ones keep one row.
CELLS = 1 << 22
MATCH, MISMATCH, GAP = 2, -1, -1
#: Least share of the best possible score, and least number of matching words.
LEAST_SCORE, LEAST_MATCHES = 0.4, 8
#: An item shorter than LEAST_MATCHES words must stand there whole.
#: Words of test items that are broadcast at once; a larger benchmark goes in blocks.
BLOCK_WORDS = 2_000_000


def _counted(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(len(vocabulary), np.int64), 0
        for whole in batches:
            for batch in chunks(whole):
                h = Words(column(batch, "text"), ALNUM_WORDS).hashes()
                total += len(h)
                at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
                n += np.bincount(at[vocabulary[at] == h], minlength=len(vocabulary))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[vocabulary[seen].view(np.int64), 0]), pa.array(np.r_[n[seen], 0]), pa.array(np.r_[np.zeros(len(seen), np.int64), total])], names=["word", "n", "total"])

    return run


class Items:
    """A block of test items: their words, and rare seeds sorted by hash."""

    def __init__(self, rows: list[tuple[int, str]]):
        w = Words(pa.array([t for _, t in rows], pa.large_string()), ALNUM_WORDS)
        self.ids, self.first, self.words, self.doc = [i for i, _ in rows], w.first, w.hashes(), w.doc
        self.vocabulary = np.unique(self.words)

    def seed(self, counts: dict[int, int], total: int) -> None:
        """Keep rare n-grams, and the rarest of each stretch of an item."""
        p = np.array([max(counts.get(int(x), 0), 0.5) for x in self.words.view(np.int64)], float) / max(total, 1)
        g, at = windows(self.words, self.doc, SEED_WORDS)
        chance = np.prod([p[at + i] for i in range(SEED_WORDS)], axis=0) if len(at) else np.zeros(0)
        use = chance < CHANCE
        stretch = (at - self.first[self.doc[at]]) // STRETCH
        order = np.lexsort((at, chance, stretch, self.doc[at]))
        if len(at):
            new = np.r_[True, (np.diff(stretch[order]) != 0) | (np.diff(self.doc[at][order]) != 0)]
            use[order[new]] = True
        g, at = g[use], at[use]
        # Items of fewer words than a seed are sought whole.
        short = [i for i in range(len(self.ids)) if 0 < self.first[i + 1] - self.first[i] < SEED_WORDS]
        self.short = {i: self.words[self.first[i] : self.first[i + 1]] for i in short}
        order = np.argsort(g, kind="stable")
        self.seeds, self.at = g[order], at[order]
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.seeds & np.uint64(0xFFFF)).astype(np.int64)] = True


def align(a: np.ndarray, b: np.ndarray, cells: int = CELLS) -> tuple[int, int, int, int, int]:
    """Best local alignment of item ``a`` in window ``b``: score, matches, item start, b start, b end (word numbers).

    Small alignments keep all rows and walk back; larger ones keep one row and carry the start and the matches along.  Both take the same path.
    """
    return _walked(a, b) if (len(a) + 1) * (len(b) + 1) <= cells else _carried(a, b)


def _walked(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, int]:
    m, j = len(b), np.arange(len(b) + 1) * -GAP
    h = np.zeros((len(a) + 1, m + 1), np.int32)
    for i in range(len(a)):
        row = np.zeros(m + 1, np.int32)
        row[1:] = np.maximum(h[i, :-1] + np.where(b == a[i], MATCH, MISMATCH), h[i, 1:] + GAP)
        np.maximum(row, 0, out=row)
        h[i + 1] = np.maximum.accumulate(row + j) - j
    i, k = np.unravel_index(int(h.argmax()), h.shape)
    score, end, matches = int(h[i, k]), int(k), 0
    while h[i, k] > 0:
        if h[i, k] == h[i - 1, k - 1] + (MATCH if a[i - 1] == b[k - 1] else MISMATCH):
            matches += int(a[i - 1] == b[k - 1])
            i, k = i - 1, k - 1
        elif h[i, k] == h[i - 1, k] + GAP:
            i -= 1
        else:
            k -= 1
    return score, matches, int(i), int(k), end


def _carried(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, int]:
    m, place = len(b), np.arange(len(b) + 1)
    j = place * -GAP
    # Of each cell: score, matches, and where its path began.
    h, matches, item, begin = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64), place.copy()
    best = (0, 0, 0, 0, 0)
    for i in range(len(a)):
        same = b == a[i]
        diagonal, up = h[:-1] + np.where(same, MATCH, MISMATCH), h[1:] + GAP
        across = diagonal >= up
        row, row_matches, row_item, row_begin = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64), np.full(m + 1, i + 1), place.copy()
        row[1:] = np.maximum(np.maximum(diagonal, up), 0)
        live = np.flatnonzero(row[1:] > 0)
        source = np.where(across[live], live, live + 1)
        row_matches[live + 1] = matches[source] + (same[live] & across[live])
        row_item[live + 1], row_begin[live + 1] = item[source], begin[source]
        run = np.maximum.accumulate(row + j)
        left = np.maximum.accumulate(np.where(row + j >= run, place, 0))  # the cell that a gap along b comes from
        h = run - j
        zero = h == 0
        matches = np.where(zero, 0, row_matches[left])
        item, begin = np.where(zero, i + 1, row_item[left]), np.where(zero, place, row_begin[left])
        k = int(h.argmax())
        if h[k] > best[0]:
            best = (int(h[k]), int(matches[k]), int(item[k]), int(begin[k]), k)
    return best


def _aligned(items: Items, least: float, least_matches: int, rows_too: bool = False):
    def found(w: Words, h: np.ndarray) -> Iterator[tuple]:
        g, at = windows(h, w.doc, SEED_WORDS)
        maybe = np.flatnonzero(items.filter[(g & np.uint64(0xFFFF)).astype(np.int64)])
        g, at = g[maybe], at[maybe]
        lo, hi = np.searchsorted(items.seeds, g, "left"), np.searchsorted(items.seeds, g, "right")
        n = hi - lo
        hit = np.repeat(np.arange(len(g)), n)
        place = items.at[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        pos, item = at[hit], items.doc[place]
        doc = w.doc[pos]
        origin = pos - (place - items.first[item])  # where the item would begin
        size = items.first[item + 1] - items.first[item]
        order = np.lexsort((origin, item, doc))
        doc, item, origin, size = doc[order], item[order], origin[order], size[order]
        slack = np.maximum(8, size // 4)
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (origin[1:] - origin[:-1] > slack[1:])
        begin = np.flatnonzero(new)
        for s, e in zip(begin, np.append(begin[1:], len(doc)), strict=False):
            d, i = int(doc[s]), int(item[s])
            a = max(int(w.first[d]), int(origin[s] - slack[s]))
            b = min(int(w.first[d + 1]), int(origin[e - 1] + size[s] + slack[s]))
            words = items.words[items.first[i] : items.first[i + 1]]
            for x in range(a, b, 4 * len(words) + 64):  # a run of one repeated passage opens a long window: align it in pieces
                y = min(b, x + 6 * len(words) + 96)
                score, matches, item_start, k, end = align(words, h[x:y])
                yield d, i, score / (MATCH * len(words)), matches, len(words), item_start, x + k - int(w.first[d]), x + end - int(w.first[d])
                if y == b:
                    break
        for i, words in items.short.items():
            for p in np.flatnonzero(np.all([h[k : len(h) - len(words) + 1 + k] == words[k] for k in range(len(words))], axis=0)) if len(h) >= len(words) else ():
                if w.doc[p] == w.doc[p + len(words) - 1]:
                    q = int(p - w.first[w.doc[p]])
                    yield int(w.doc[p]), i, 1.0, len(words), len(words), 0, q, q + len(words)

    def best(batch: pa.RecordBatch) -> list[tuple]:
        w = Words(column(batch, "text"), ALNUM_WORDS)
        top: dict[tuple[int, int], tuple] = {}
        for x in found(w, w.hashes()):
            if x[3] >= min(least_matches, x[4]) and x[2] >= least:
                top[x[:2]] = max(top.get(x[:2], x), x, key=lambda y: (y[2], y[3], -y[6]))
        return sorted(top.values())

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                keep = np.ones(batch.num_rows, bool)
                keep[[x[0] for x in best(batch)]] = False
                yield batch.filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                rows = best(batch)
                ids = column(batch, "doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                more = [pa.array([f(r) for r in rows], t) for f, t in ((lambda r: items.ids[r[1]], pa.int64()), (lambda r: r[2], pa.float64()), (lambda r: r[3], pa.int64()), (lambda r: r[4], pa.int64()), (lambda r: r[6], pa.int64()), (lambda r: r[7], pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids, *more], names=["doc_id", "item_id", "score", "n_matches", "item_words", "first_word", "end_word"])

    return clean if rows_too else run


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, least_matches: int = LEAST_MATCHES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, item_id, score, n_matches, item_words, first_word, end_word of each pair whose best
    alignment has at least ``least`` of the item's greatest score and ``least_matches`` matching words.

    Word numbers count words of letters and digits from 0, end exclusive.  Null or
    empty texts on either side match nothing.  A null doc_id is kept; repeated rows give
    a row each; repeated item ids give a row for each of their texts.  Of equally good places the first counts.  A benchmark of
    more than ``block_words`` words is searched in blocks, so that what is broadcast
    stays below 16 bytes times ``block_words``.
    """
    out = None
    for block in _blocks(only(docs, "doc_id", "text"), benchmark, block_words):
        part = only(docs, "doc_id", "text").mapInArrow(_aligned(block, least, least_matches), "doc_id long, item_id long, score double, n_matches long, item_words long, first_word long, end_word long")
        out = part if out is None else out.union(part)
    return out


def uncontaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST_SCORE, least_matches: int = LEAST_MATCHES, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``contaminated`` does not list."""
    for block in _blocks(only(docs, "doc_id", "text"), benchmark, block_words):
        docs = docs.mapInArrow(_aligned(block, least, least_matches, rows_too=True), docs.schema)
    return docs


def _blocks(docs: DataFrame, benchmark: DataFrame, block_words: int) -> Iterator[Items]:
    """The benchmark in blocks with their seeds; one block at least, maybe empty."""
    items = only(benchmark, "item_id", "text").where("item_id is not null and length(trim(text)) > 0")
    sizes = items.select(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-sizes // block_words))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        block = Items([(r["item_id"], r["text"]) for r in rows])
        counts, total = {}, 0
        if len(block.vocabulary):
            counted = docs.mapInArrow(_counted(block.vocabulary), "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            got = counted.collect()  # at most a row for each word of the block
            counts, total = {r["word"]: r["n"] for r in got}, sum(r["total"] for r in got)
        block.seed(counts, total)
        yield block


def op6_decontamination(spark, sf_dir):
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
