"""Draws and random orders on Spark, whole arrays at a time.

The reference SQL hashes a row for each draw and groups the draws again.  Here a task
takes some of the resamples and the numbers that they draw from, packed into arrays by
their place, so only these numbers are shuffled and no draw is.  A draw's hash is the
reference's, so both draw the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synonymy.functions.digests import md5_numbers, md5_words
from synonymy.operators.enrichment import ORDERS, within
from synonymy.operators.ranking import ordered
from synonymy.plans.relations import Run, needs, on_spark

#: Places of one packed array, and resamples of a permutation test or an interval.
CHUNK, PERMUTATIONS, BOOTS, INTERVALS = 65_536, 1000, 500, 1000
#: Rows that a genome's genes are packed into.
PARTS = 64


def packed(rows: DataFrame, by: list[str], place: str, *columns: str) -> DataFrame:
    """by, chunk_ and the columns as arrays, in the order of ``place`` (from 1)."""
    chunk = ((F.col(place) - 1) / CHUNK).cast("long").alias("chunk_")
    return rows.groupBy(*by, chunk).agg(F.array_sort(F.collect_list(F.struct(place, *columns))).alias("rows_")).select(*by, "chunk_", *[F.col(f"rows_.{c}").alias(c) for c in columns])


def dealt(rows: DataFrame, blocks: int, tasks: int, *by: str) -> DataFrame:
    """Each row once for every block of resamples, spread by ``by`` and block over so many tasks."""
    return rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, *by, "block")


def joined(part: pd.DataFrame, column: str) -> np.ndarray:
    """The column's arrays, one after the other."""
    return np.concatenate(part.sort_values("chunk_")[column].to_list()) if len(part) else np.zeros(0)


def walked(at: np.ndarray, weights: np.ndarray, n: int) -> float:
    """The extreme of the running sum of hits at these places (from 1, ascending) of n."""
    up, size = np.cumsum(weights), len(at)
    falls = (at - np.arange(1, size + 1)) / (n - size)
    high = max(0.0, float(np.round(up / up[-1] - falls, 9).max()))
    low = min(0.0, float(np.round((up - weights) / up[-1] - falls, 9).min()))
    return high if high >= -low else low


def first_different(drawn: np.ndarray, most: int, room: np.ndarray) -> np.ndarray:
    """The first so many different places among those drawn, ascending; ``room`` has an element for each place there is."""
    nth = np.arange(len(drawn))
    room[drawn[::-1]] = nth[::-1]
    return np.sort(drawn[room[drawn] == nth][:most])


@needs("set_plan", "ranked")
def null_es(run: Run) -> DataFrame:
    """perm, gene_set, size, es: the walks of random sets, of each gene set's size."""
    blocks = 100

    def draw(plan: pd.DataFrame, weights: pd.DataFrame) -> pd.DataFrame:
        w, out = joined(weights, "w"), []
        room = np.empty(len(w), np.int64)
        for perm in range(int(plan.block.iloc[0]) if len(plan) else PERMUTATIONS, PERMUTATIONS, blocks):
            for s in plan.itertuples():
                at = first_different(md5_numbers(f"{perm}-{s.gene_set}-", np.arange(1, s.tries + 1)) % s.n, s.size, room)
                if len(at) < s.n:
                    out.append((perm, s.gene_set, len(at), walked(at + 1, w[at], s.n)))
        return pd.DataFrame(out, columns=["perm", "gene_set", "size", "es"])

    plan, weights = dealt(run("set_plan"), blocks, blocks), dealt(packed(run("ranked"), [], "r", "w"), blocks, blocks)
    return plan.groupBy("block").cogroup(weights.groupBy("block")).applyInPandas(draw, "perm long, gene_set string, size long, es double")


@needs("metric", "split")
def goi_values(run: Run) -> DataFrame:
    rows = run.sql("SELECT m.metric, s.is_goi, round(m.v, 9) AS v, m.gene FROM metric m JOIN split s ON s.gene = m.gene WHERE m.v IS NOT NULL")
    return within(ordered(rows, F.col("metric"), F.col("is_goi"), F.col("gene")).drop("n"), ["metric", "is_goi"], "k", "n").select("metric", "is_goi", "v", "k", "n")


@needs("goi_values")
def goi_boot_test(run: Run) -> DataFrame:
    """item, g1, g2, n1, n2, u, delta: Cliff's delta of each resample of genes of interest and of the rest."""
    blocks = 50

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        metric, out = rows.metric.iloc[0], []
        one, rest = (joined(rows[rows.is_goi == k], "v") for k in (1, 0))
        if len(one) and len(rest):
            values, one = np.unique(one, return_inverse=True)
            # Twice the values of interest that lie below a value, and one more where one is equal.
            rest = np.searchsorted(values, rest, "left") + np.searchsorted(values, rest, "right")
            n1, n2 = len(one), len(rest)
            for i in range(int(rows.block.iloc[0]), BOOTS, blocks):
                a = np.bincount(one[md5_numbers(f"{i}-{metric}-1-", np.arange(1, n1 + 1)) % n1], minlength=len(values))
                b = np.bincount(rest[md5_numbers(f"{i}-{metric}-0-", np.arange(1, n2 + 1)) % n2], minlength=2 * len(values) + 1)
                u = float((a * (np.cumsum(b)[:-1:2] + b[1::2] / 2)).sum())
                out.append((metric, str(i), "", float(n1), float(n2), u, 2 * u / (float(n1) * n2) - 1))
        return pd.DataFrame(out, columns=["item", "g1", "g2", "n1", "n2", "u", "delta"])

    rows = dealt(packed(run("goi_values").where("n >= 3"), ["metric", "is_goi"], "k", "v"), blocks, 4 * blocks, "metric")
    return rows.groupBy("metric", "block").applyInPandas(draw, "item string, g1 string, g2 string, n1 double, n2 double, u double, delta double")


@needs("ref_cai")
def ref_means(run: Run) -> DataFrame:
    """i, genome, m: the mean adaptation of each resample of a genome's reference genes."""
    blocks = 10

    def draw(rows: pd.DataFrame) -> pd.DataFrame:
        genome, v = rows.genome.iloc[0], joined(rows, "v")
        k = np.arange(1, len(v) + 1)
        return pd.DataFrame([(i, genome, float(v[md5_numbers(f"{i}-{genome}-", k) % len(v)].mean())) for i in range(int(rows.block.iloc[0]), INTERVALS, blocks)], columns=["i", "genome", "m"])

    rows = dealt(packed(run("ref_cai").where("n >= 3 AND genome IS NOT NULL"), ["genome"], "k", "v"), blocks, 20 * blocks, "genome")
    return rows.groupBy("genome", "block").applyInPandas(draw, "i long, genome string, m double")


@needs("sample_ranked", "sample_sizes")
def sample_null_es(run: Run) -> DataFrame:
    """sample_id, i, drawn, size, es: the walks of the first genes of random orders of a sample, for each size that its sets have."""
    blocks = 8

    def draw(genes: pd.DataFrame, sizes: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(genes) and len(sizes):
            sample, block, gene, w = genes.sample_id.iloc[0], int(genes.block.iloc[0]), joined(genes, "gene"), joined(genes, "w")
            drawn = [z for z in sorted(sizes["size"]) if z < len(gene)]
            for i in range(block, ORDERS, blocks) if drawn else ():
                first, last = md5_words(f"{i}-", gene)
                order = np.lexsort((gene, last, first))[: drawn[-1]]
                for z in drawn:
                    at = np.sort(order[:z])
                    out.append((sample, i, z, z, walked(at + 1, w[at], len(gene))))
        return pd.DataFrame(out, columns=["sample_id", "i", "drawn", "size", "es"])

    genes = dealt(packed(run("sample_ranked"), ["sample_id"], "r", "gene", "w"), blocks, 20 * blocks, "sample_id")
    sizes = dealt(run("sample_sizes"), blocks, 20 * blocks, "sample_id")
    return genes.groupBy("sample_id", "block").cogroup(sizes.groupBy("sample_id", "block")).applyInPandas(draw, "sample_id string, i long, drawn long, size long, es double")


def steps(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Distances of neighbours in an order of columns, summed row by row as the SQL does."""
    out = np.zeros(max(len(order) - 1, 0))
    for values in x:
        step = np.diff(values[order])
        step *= step
        out += step
    return np.sqrt(out)


def shuffled(i: int, gene: np.ndarray) -> np.ndarray:
    """The places of the genes in the order of md5(i || '-' || gene)."""
    first, last = md5_words(f"{i}-", gene)
    order = np.argsort(first)
    return order if (np.diff(first[order]) > 0).all() else np.lexsort((gene, last, first))


@needs("gene_vector", "near_distance")
def null_share(run: Run) -> DataFrame:
    """genome, d, seen, p: for each distance between neighbours the share of distances in random orders of the genome's genes that are no greater.

    A task counts the distances of its orders among those between neighbours, so none of them is a row.
    """
    blocks = 16
    part = lambda key: F.pmod(F.xxhash64(key), F.lit(PARTS)).alias("chunk_")

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        gene, x, d = (joined(rows, c) for c in ("gene", "xs", "d"))
        d = np.sort(d)
        if len(gene) < 2 or not len(d):
            return pd.DataFrame({"genome": [], "chunk_": [], "d": [], "below": [], "n": []})
        x = np.ascontiguousarray(x.reshape(len(gene), -1).T)
        # A distance is rounded to nine digits, half up, before it is compared.
        gene, bounds, below, orders = gene.astype(np.int64), d + 5e-10, np.zeros(len(d), np.int64), range(int(rows.block.iloc[0]), PERMUTATIONS, blocks)
        for i in orders:
            below += np.searchsorted(np.sort(steps(x, shuffled(i, gene))), bounds)
        at = range(0, len(d), CHUNK)
        return pd.DataFrame({"genome": rows.genome.iloc[0], "chunk_": [k // CHUNK for k in at], "d": [d[k : k + CHUNK] for k in at], "below": [below[k : k + CHUNK] for k in at], "n": (len(gene) - 1) * len(orders)})

    genes = run("gene_vector").where("gene IS NOT NULL").groupBy("genome", part("gene")).agg(F.collect_list(F.struct("gene", "xs")).alias("r"))
    near = run("near_distance").select("genome", "d").distinct().groupBy("genome", part("d")).agg(F.collect_list("d").alias("d"))
    none = lambda kind: F.expr(f"cast(array() as array<{kind}>)")
    both = genes.select("genome", "chunk_", F.col("r.gene").alias("gene"), F.flatten("r.xs").alias("xs"), none("double").alias("d")).unionByName(near.select("genome", "chunk_", none("bigint").alias("gene"), none("double").alias("xs"), "d"))
    counts = dealt(both, blocks, 20 * blocks, "genome").groupBy("genome", "block").applyInPandas(count, "genome string, chunk_ long, d array<double>, below array<long>, n long")
    each = counts.select("genome", "n", F.explode(F.arrays_zip("d", "below")).alias("e")).groupBy("genome", F.col("e.d").alias("d")).agg(F.sum("e.below").alias("c"), F.sum("n").alias("n"))
    return each.select("genome", "d", F.lit(1).alias("seen"), ((1 + F.col("c")) / (1 + F.col("n"))).alias("p"))


for form in (null_es, goi_values, goi_boot_test, ref_means, sample_null_es, null_share):
    on_spark(form.__name__, form)
