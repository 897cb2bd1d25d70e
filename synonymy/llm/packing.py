"""Packing by concatenate and cut.

Pass one tokenises each partition once, with a running total of its tokens, and
writes the ids to the shared folder.  Prefix sums over the partitions' totals (one
number a partition) turn running totals into global offsets.  Pass two cuts at
multiples of the window: a piece is a boundary record (document, start, length,
sequence, offset) and can carry its ids.  No document moves between partitions.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, column, cut, only, scratch

WINDOW = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k"
SPECIAL = {"<|endoftext|>": 50256}


def _encoder(vocabulary: str):
    """Ids of the public vocabulary.  The rank file holds the vocabulary of the JSON file;
    its library gives the same ids (tests compare them) at four times the speed."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return lambda text: e.encode_to_numpy(text, allowed_special="all")


def _tokens(vocabulary: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, encode = TaskContext.get().partitionId(), 0, _encoder(vocabulary)
        for whole in batches:
            for batch in chunks(whole):
                ids = [np.append(encode(x or ""), np.uint32(end_id)).astype("<u4") for x in column(batch, "text").to_pylist()]
                n = np.array([len(x) for x in ids], np.int64)
                local = at + np.cumsum(n) - n
                at += int(n.sum())
                narrow = [x.astype("<u2").tobytes() if x.max() < 65536 else x.tobytes() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int64)), pa.array(local), pa.array(n), column(batch, "doc_id"), pa.array(narrow, pa.binary())],
                    names=["part", "local", "doc_tokens", "doc_id", "ids"],
                )

    return run


def _pieces(window: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole, "ids"):
                n = column(batch, "doc_tokens").to_numpy()
                where = pc.add(column(batch, "local"), column(batch, "base")).to_numpy()
                row, start, length, crc, kept = [], [], [], [], []
                for i, raw in enumerate(column(batch, "ids")):
                    buf = raw.as_buffer()
                    ids = np.frombuffer(buf, "<u2" if buf.size == 2 * n[i] else "<u4").astype("<u4")
                    cuts = [0, *range(window - int(where[i] % window), int(n[i]), window), int(n[i])]
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        piece = ids[a:b].tobytes()
                        row.append(i), start.append(a), length.append(b - a), crc.append(zlib.crc32(piece))
                        if keep_ids:
                            kept.append(piece)
                row, start = np.array(row, np.int64), np.array(start, np.int64)
                place = where[row] + start
                out = [column(batch, "doc_id").take(pa.array(row)), pa.array(start), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(n[row]), pa.array(place // window), pa.array(place % window)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays(out + [pa.array(kept, pa.binary())] * keep_ids, names=names + ["ids"] * keep_ids)

    return run


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``keep_ids``, ids (little-endian unsigned 32-bit).

    All sequences but the last are full, so only the last one needs padding.  A null
    or empty text is the end id alone.  Rows with null or repeated doc_id are
    packed like any other; an empty table gives no pieces.  A text of any length is
    cut as often as needed.  Columns other than doc_id and text are ignored.
    """
    folder = scratch(docs.sparkSession)
    tokens = cut(
        only(docs, "doc_id", "text").mapInArrow(_tokens(vocabulary, end_id), "part long, local long, doc_tokens long, doc_id long, ids binary"), folder, "tokens"
    )
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # Two longs for each partition of the input: a bound of a few MB for a million partitions.
    placed = tokens.join(F.broadcast(base), "part")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * keep_ids
    return placed.mapInArrow(_pieces(window, keep_ids), schema)


def op7_packing(spark, sf_dir):
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_ids=False)
