"""Codons of each gene and their neighbours, counted where the gene is: no position is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.functions.codons import MIN_LENGTH, codon_rows
from synonymy.llm.common import chunks, column
from synonymy.plans.relations import KEPT, Run, needs, on_spark

_BASE = np.full(256, -1, np.int8)
_BASE[[ord(b) for b in "ACGTacgt"]] = [*range(4)] * 2
_CODONS = [x + y + z for x in "ACGU" for y in "ACGU" for z in "ACGU"]
_ROWS = codon_rows()
_SENSE = np.array([r[5] for r in _ROWS])
_FFOLD = np.array([r[4] for r in _ROWS])
#: Which codons share an amino acid, and a family.
_AA, _FAMILY = (np.array([[x[c] == y[c] for y in _ROWS] for x in _ROWS], np.int64) for c in (1, 2))
_CODING = np.isin(_CODONS, [r[0] for r in _ROWS if r[6]])


def _codons(base: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The row and the number of each whole codon of sequences (numbers of letters) between these offsets."""
    whole = (off[1:] - off[:-1]) // 3
    gene = np.repeat(np.arange(len(off) - 1), whole)
    at = off[gene] + 3 * (np.arange(len(gene)) - np.repeat(np.cumsum(whole) - whole, whole))
    return gene, 16 * base[at] + 4 * base[at + 1] + base[at + 2]


def _letters(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The letters A, C, G and T (a, c, g and t) of a column as numbers, all others left out, and the rows' offsets in them."""
    text = column(batch, name).cast(pa.large_string()).fill_null("")
    off = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
    base = _BASE[np.frombuffer(text.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]]
    kept = base >= 0
    return base[kept].astype(np.int64), np.concatenate([[0], np.cumsum(kept)])[off - off[0]]


def tallied(batch: pa.RecordBatch, least: int = MIN_LENGTH) -> pa.RecordBatch:
    """The rows of at least so many letters, with length and ns, the number of each of the 64 codons in their order, in place of text."""
    base, off = _letters(batch, "text")
    length = np.diff(off)
    gene, codon = _codons(base, off)
    n = np.bincount(gene * 64 + codon, minlength=64 * batch.num_rows)
    out = batch.drop_columns(["text"]).append_column("length", pa.array(length)).append_column("ns", _lists(pa.array(n, pa.int32())))
    return out.filter(pa.array(length >= least))


def _lists(values: pa.Array) -> pa.ListArray:
    """Lists of 64 values each."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(values) + 1, 64), pa.int32()), values)


def shared(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows with what their counts share: rs, usage within the family; n_aa, counts of the amino acid; total; present, the number of amino acids.

    As in the SQL, a row without gene has no counts here and one with several lengths counts for each.
    """
    known = np.array(column(batch, "gene").is_valid())[:, None]
    times = pc.list_value_length(column(batch, "lengths")).to_numpy()[:, None]
    n = column(batch, "ns").flatten().to_numpy().reshape(-1, 64) * known * _SENSE
    family, n_aa = n @ _FAMILY * times, n @ _AA * times
    rs = n * _FFOLD / np.maximum(family, 1)
    names = ["rs", "n_aa", "total", "present"]
    added = [_lists(pa.array(rs.ravel(), mask=(family == 0).ravel())), _lists(pa.array(n_aa.ravel())), pa.array(n.sum(axis=1) * times[:, 0]), pa.array((n_aa > 0) @ (1 / _AA.sum(axis=1)) + 0.5, pa.float64()).cast(pa.int32(), safe=False)]
    return pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])


def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """gene, a, b, n of rows (gene, seq) of the letters A, C, G and T."""
    gene, codon = _codons(*_letters(batch, "seq"))
    near = (gene[:-1] == gene[1:]) & _CODING[codon[:-1]] & _CODING[codon[1:]]
    key, n = np.unique((gene[:-1] * 4096 + codon[:-1] * 64 + codon[1:])[near], return_counts=True)
    word = lambda k: pa.DictionaryArray.from_arrays(pa.array(k, pa.int32()), pa.array(_CODONS)).cast(pa.string())
    return pa.RecordBatch.from_arrays([column(batch, "gene").take(pa.array(key // 4096)), word(key // 64 % 64), word(key % 64), pa.array(n, pa.int64())], names=["gene", "a", "b", "n"])


@needs("documents")
def gene_ns(run: Run) -> DataFrame:
    """gene, sample_id, genome, cond, lengths: those of its sequences, once; ns: how often each of the 64 codons stands in them, in their order; and what ``shared`` adds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in chunks(batch):
                yield tallied(some)

    keys = ["gene", "sample_id", "genome", "cond"]
    texts = run("documents").select(F.col("doc_id").alias("gene"), F.concat_ws("-", "source", "lang").alias("sample_id"), F.col("source").alias("genome"), F.col("lang").alias("cond"), "text")
    rows = texts.mapInArrow(count, "gene long, sample_id string, genome string, cond string, length long, ns array<int>")
    sums = rows.groupBy(*keys).agg(F.sort_array(F.collect_set("length")).alias("lengths"), *[F.sum(F.col("ns")[k]).alias(f"n{k}") for k in range(64)])
    whole = sums.select(*keys, "lengths", F.array(*[f"n{k}" for k in range(64)]).alias("ns"))
    kinds = "gene long, sample_id string, genome string, cond string, lengths array<long>, ns array<long>, rs array<double>, n_aa array<long>, total long, present int"
    return whole.mapInArrow(lambda batches: (shared(b) for b in batches), kinds)


@needs("cds")
def pair(run: Run) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in chunks(batch, "seq"):
                yield counted(some)

    return run("cds").select("gene", "seq").mapInArrow(count, "gene long, a string, b string, n long")


on_spark("gene_ns", gene_ns)
on_spark("pair", pair)
KEPT.add("gene_ns")
