"""Ranked lexical search: block-max WAND over posting blocks of variable length.

Documents are indexed in shards, each made of the documents that one task reads, up to
a bound of postings, so no posting is shuffled to build the index.  The index is a table:
a row for each shard and term with the documents (by their place in the shard) and
frequencies, and a row for each shard with its documents and their lengths.

A search brings together a shard's lists of the terms asked.  Their impacts, the terms'
exact contributions to a score, are cut into blocks by dynamic programming: the cuts
minimise the sum of (block's maximum - impact) plus a price for each block.  The bounds
of all blocks that cover a stretch of documents add up to a bound of every score there.
Stretches are taken by descending bound, their postings are found by binary search and
scored, and the search of the shard ends at the first bound below the k-th best score so
far; all other blocks are skipped unread.  Equal bounds are still read, so ties by doc_id
are exact.

Queries are read from the shared folder block by block, and each shard's best are merged
by a window that keeps k rows a task.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ALNUM_WORDS, Words, chunks, column, cut, fetched, only, put, scratch, uri

#: Postings of a shard (a document's are in one shard), and queries of a block.
SHARD_POSTINGS, QUERY_BLOCK = 1 << 21, 1000
#: Cuts lie at every STEP-th posting; a block has at most WIDTH steps and costs as much as PRICE postings of the list's mean error.
STEP, WIDTH, PRICE = 8, 64, 8
#: Stretches that are scored at once, first; then twice as many, and so on.
FIRST = 16
INDEX = "shard long, term long, doc array<long>, tf array<long>"
#: Stands for a null doc_id in the index: it comes last among equals.
NO_ID = (1 << 63) - 1


def _counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the distinct terms of each text, and each text's terms."""
    words = Words(texts, ALNUM_WORDS)
    h = words.hashes().view(np.int64)
    order = np.lexsort((h, words.doc))
    row, h = words.doc[order], h[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, np.int64)
    return row[first], h[first], np.diff(np.append(first, len(h))), np.diff(words.first)


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(first, len(values)), pa.int32()), pa.array(values, pa.int64()))


def _shard(number: int, parts: list[tuple]) -> pa.RecordBatch:
    """The index rows of a shard: parts are (doc_ids, lengths, row, term, times)."""
    begin = np.cumsum([0, *(len(p[0]) for p in parts)])
    ids, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    doc, term, tf = (np.concatenate([p[i] + (b if i == 2 else 0) for p, b in zip(parts, begin, strict=False)]) for i in (2, 3, 4))
    by_id = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[by_id] = np.arange(len(ids))
    order = np.lexsort((place[doc], term))
    doc, term, tf = place[doc][order], term[order], tf[order]
    first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    docs, tfs = _lists(np.concatenate([ids[by_id], doc]), np.append(0, first + len(ids))), _lists(np.concatenate([n[by_id], tf]), np.append(0, first + len(ids)))
    terms = pa.array(np.append(0, term[first]), pa.int64(), mask=np.r_[True, np.zeros(len(first), bool)])
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), number), pa.int64()), terms, docs, tfs], names=["shard", "term", "doc", "tf"])


def _indexed(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for piece in chunks(batch):
                row, term, times, n = _counted(column(piece, "text"))
                ids = column(piece, "doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                parts.append((ids, n, row, term, times))
                size += len(row)
                if size >= most:
                    yield _shard(number, parts)
                    number, parts, size = number + 1, [], 0
        if parts:
            yield _shard(number, parts)

    return run


def indexed(documents: DataFrame, folder: str, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """shard, term, doc, tf: a posting list for each term of a shard; in the row of null term its documents' ids, ascending, and lengths.

    Terms are 64-bit hashes of the words.  Written to the folder.
    """
    rows = only(documents, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return cut(rows.mapInArrow(_indexed(shard_postings), INDEX), folder, "index")


def blocks(impact: np.ndarray) -> np.ndarray:
    """Where the blocks of a list begin: the cuts of least sum of (block's maximum - impact) and the blocks' price."""
    if len(impact) <= 2 * STEP:
        return np.zeros(1, np.int64)
    at = np.arange(0, len(impact), STEP)
    top, place = np.maximum.reduceat(impact, at), np.append(at, len(impact))
    price = PRICE * (int(impact.max()) - int(impact.mean()))
    cost, back, running = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64), np.zeros(len(at), np.int64)
    for i in range(1, len(at) + 1):
        lo = max(0, i - WIDTH)
        window = running[lo:i]
        np.maximum(window, top[i - 1], out=window)
        total = cost[lo:i] + window * (place[i] - place[lo:i])
        j = int(total.argmin())
        cost[i], back[i] = total[j] + price, lo + j
    cuts, i = [], len(at)
    while i:
        i = int(back[i])
        cuts.append(place[i])
    return np.array(cuts[::-1], np.int64)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places from lo to hi of each pair, and which pair each is of."""
    n = hi - lo
    of = np.repeat(np.arange(len(lo)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[of], of


class Shard:
    """A shard's lists of the terms asked, with blocks and their bounds."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, terms: list[int], weights: list[int], docs: list[np.ndarray], tfs: list[np.ndarray], n: int, total: int):
        order = np.argsort(terms)
        self.ids, self.term = ids, np.array(terms, np.int64)[order]
        distinct, inverse = np.unique(lengths, return_inverse=True)
        m = np.array([25 + 75 * int(x) * n // total for x in distinct], np.int64)[inverse]
        impacts = [weights[i] * (1_000_000_000 * tfs[i] // (1000 * tfs[i] + 8 * m[docs[i]])) for i in order]
        docs = [docs[i] for i in order]
        starts = [blocks(x) for x in impacts]
        ends = [np.append(s[1:], len(x)) for s, x in zip(starts, impacts, strict=True)]
        none = [np.zeros(0, np.int64)]
        self.block_of = np.cumsum([0, *map(len, starts)])
        self.low = np.concatenate(none + [d[s] for d, s in zip(docs, starts, strict=True)])
        self.high = np.concatenate(none + [d[e - 1] + 1 for d, e in zip(docs, ends, strict=True)])
        self.bound = np.concatenate(none + [np.maximum.reduceat(x, s) for x, s in zip(impacts, starts, strict=True)])
        self.doc, self.impact = np.concatenate(none + docs), np.concatenate(none + impacts)
        # Ascending over terms and documents: a place in any list is found by one search.
        self.key = np.concatenate(none + [d + t * len(ids) for t, d in enumerate(docs)])
        self.score = np.zeros(len(ids), np.int64)

    def search(self, terms: np.ndarray, times: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best by score and then id, and the postings read."""
        t = np.searchsorted(self.term, terms)
        t[t == len(self.term)] = 0
        known = self.term[t] == terms if len(self.term) else np.zeros(len(t), bool)
        t, times = t[known], times[known]
        place, of = _ranges(self.block_of[t], self.block_of[t + 1])
        rise = self.bound[place] * times[of]
        edge, change = np.concatenate([self.low[place], self.high[place]]), np.concatenate([rise, -rise])
        order = np.argsort(edge, kind="stable")
        edge, bound = edge[order], np.cumsum(change[order])
        last = np.flatnonzero(np.r_[edge[1:] != edge[:-1], True]) if len(edge) else np.zeros(0, np.int64)
        edge, bound = edge[last], bound[last]
        by_bound = np.argsort(-bound[:-1], kind="stable") if len(edge) else last
        best, scores, at, size = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, FIRST
        self.read = 0
        while at < len(by_bound):
            least = max(1, int(scores[-1])) if len(scores) == k else 1
            some = by_bound[at : at + size]
            some = np.sort(some[bound[some] >= least])
            if not len(some):
                break
            at, size = at + size, size * 2
            low, high = (t[:, None] * len(self.ids) + x[None, :] for x in (edge[some], edge[some + 1]))
            place, of = _ranges(np.searchsorted(self.key, low.ravel()), np.searchsorted(self.key, high.ravel()))
            self.read += len(place)
            doc = self.doc[place]
            np.add.at(self.score, doc, self.impact[place] * times[of // len(some)])
            seen = np.unique(doc)
            got = self.score[seen]
            self.score[seen] = 0
            best, scores = np.concatenate([best, seen]), np.concatenate([scores, got])
            top = np.lexsort((best, -scores))[:k]
            best, scores = best[top], scores[top]
        keep = scores > 0
        return best[keep], scores[keep]


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in chunks(batch):
            row, term, times, _ = _counted(column(piece, "text"))
            yield pa.RecordBatch.from_arrays([column(piece, "query").take(pa.array(row)), pa.array(term, pa.int64()), pa.array(times, pa.int64())], names=["query", "term", "times"])


def _put_block(folder: str):
    def run(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        parts = [(int(q), x.term.to_numpy(np.int64), x.times.to_numpy(np.int64)) for q, x in rows.sort_values(["query", "term"]).groupby("query")]
        put(f"{folder}/block-{key[0]}", [pickle.dumps(parts, protocol=5)])
        return pd.DataFrame({"block": [key[0]]})

    return run


def _searched(folder: str, numbers: list[int], n: int, total: int, k: int):
    def run(table: pa.Table) -> pa.Table:
        term, weight = table["term"].to_pylist(), table["w"].to_pylist()
        flat = lambda name, i: table[name][i].values.to_numpy()
        own = term.index(None)
        lists = [i for i in range(len(term)) if i != own]
        shard = Shard(flat("doc", own), flat("tf", own), [term[i] for i in lists], [weight[i] for i in lists], [flat("doc", i) for i in lists], [flat("tf", i) for i in lists], n, total)
        out: list[list] = [[], [], []]
        for number in numbers:
            for query, terms, times in pickle.loads(fetched(f"{folder}/block-{number}")):
                best, scores = shard.search(terms, times, k)
                out[0].append(np.full(len(best), query))
                out[1].append(shard.ids[best])
                out[2].append(scores)
        return pa.table({c: pa.array(np.concatenate([*x, np.zeros(0, np.int64)]), pa.int64()) for c, x in zip(("query", "doc_id", "score"), out, strict=True)})

    return run


def ranked(documents: DataFrame, items: DataFrame, k: int = 10, shard_postings: int = SHARD_POSTINGS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k documents of highest score above 0.

    Every row of ``documents`` is a document, repeated ones too; null texts have no term and
    no part in the counts.  Documents without doc_id are ranked, last among equals.  Every row
    of ``items`` is a query of its own; one without terms has no rows.  Ties go by ascending
    doc_id.  Empty tables give no rows; other columns are ignored.  Different words with one
    64-bit hash would be one term.
    """
    spark, folder = documents.sparkSession, scratch(documents.sparkSession)
    index = indexed(documents, folder, shard_postings)
    own = index.where("term is null")
    size = own.agg(F.coalesce(F.sum(F.size(F.filter("tf", lambda x: x > 0))), F.lit(0)).alias("n"), F.coalesce(F.sum(F.aggregate("tf", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)).alias("total")).first()
    n, total = int(size["n"]), int(size["total"])
    named = cut(only(items, "item_id", "text").withColumn("query", F.monotonically_increasing_id()), folder, "items")
    asked = cut(named.select("query", "text").mapInArrow(_asked, "query long, term long, times long"), folder, "asked")
    terms = cut(asked.select("term").distinct(), folder, "terms")
    df = index.join(terms, "term").groupBy("term").agg(F.sum(F.size("doc")).alias("df"))
    weights = cut(df.select("term", F.floor(1000 * F.log((2 * F.lit(float(n)) + 2) / (2 * F.col("df") + 1))).cast("long").alias("w")), folder, "weights")
    store, blocks_ = uri(f"{folder}/queries"), max(1, -(-asked.select("query").distinct().count() // query_block))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks_)).cast("int"))
    numbers = sorted(r["block"] for r in cut(dealt.groupBy("block").applyInPandas(_put_block(store), "block int"), folder, "blocks").collect())  # a number for each block
    lists = index.join(weights, "term").select("shard", "term", "w", "doc", "tf").unionByName(own.select("shard", "term", F.lit(None).cast("long").alias("w"), "doc", "tf"))
    found = lists.groupBy("shard").applyInArrow(_searched(store, numbers, n, total, k), "query long, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "doc_id", "shuffle_")
    best = found.withColumn("shuffle_", F.monotonically_increasing_id()).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(named.select("query", "item_id"), "query").select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def op12_lexical_search(spark, sf_dir):
    return ranked(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: The same scores of all documents that share a term with an item.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM d WHERE len(ws) > 0),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * s.n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, s.n_docs),
q AS (SELECT item_id, term, count(*) AS r FROM (SELECT item_id, unnest(ws) AS term FROM i) GROUP BY ALL),
c AS (SELECT item_id, doc_id, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total)))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY 1, 2)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM c WHERE score > 0) WHERE rank <= 10
"""
