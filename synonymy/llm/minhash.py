"""Near-duplicate detection by MinHash.

Universal hash minima of each document's shingle set, banding, signature
verification, an exact check on full sets, and connected components by alternating
large-star and small-star.

Cost. Documents with equal sets collapse to one representative first, by an
aggregation.  A band bucket of m representatives never yields m*m pairs: its most
central member (the one with the most collisions) is paired with the others.  Only
members that these links leave outside its component are then compared with the
group's other members, in blocks of bounded size out of which only links come.

Chance of a lost link. With 32 bands of 4 rows a pair at similarity 0.8 shares no
bucket with probability (1 - 0.8^4)^32 = 5e-8.  Signature verification drops a pair
whose 128 minima agree in under 60 % of places: 5.6 standard deviations below 0.8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_WORDS, Words, chunks, column, cut, drop, mix, only, scratch, windows

BANDS, ROWS = 32, 4
SIGNATURE_AGREEMENT = 0.6
#: Shingle sets, in bytes, that are compared with as many others at once.
BLOCK_BYTES = 1 << 20
#: Sets with more than this part (one in so many) of all rows are hot.
HOT_SHARE = 1000


def shingle_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit shingle hashes) of a slice; fewer than k words are one shingle."""
    w = Words(column(batch, "text"), SPACE_WORDS)
    h = w.hashes()
    g, at = windows(h, w.doc, k)
    bounds = np.searchsorted(at, w.first)
    for i in range(w.rows):
        a, b = w.first[i], w.first[i + 1]
        if b - a >= k:
            yield i, np.unique(g[bounds[i] : bounds[i + 1]])
        elif b > a:
            yield i, np.frombuffer(hashlib.blake2b(h[a:b].tobytes() + bytes([b - a]), digest_size=8).digest(), np.uint64)
        else:
            yield i, np.zeros(0, np.uint64)


def _signer(k: int, bands: int, rows: int):
    rng = np.random.default_rng(97)
    n = bands * rows
    a = rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    salt = mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def minima(x: np.ndarray) -> np.ndarray:
        """Minimum of each universal hash (a*x+b mod 2^64) >> 32 over a set."""
        out = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        for i in range(0, len(x), 512):
            out = np.minimum(out, (x[i : i + 512, None] * a + b).min(axis=0))
        return out >> np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                size, key, band, sig = [], [], [], []
                for _, s in shingle_sets(batch, k):
                    size.append(len(s))
                    if not len(s):
                        key.append(None), band.append(None), sig.append(None)
                        continue
                    key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    m = minima(s)
                    x = salt.copy()
                    for r in range(rows):
                        x = mix(x ^ m[r::rows])
                    band.append(x.view(np.int64))
                    sig.append(m.astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id"), pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array(band, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "bands", "sig"],
                )

    return run


def signatures(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, set_key, bands, sig of each row."""
    return only(docs, "doc_id", "text").mapInArrow(_signer(k, bands, rows), "doc_id long, n_shingles long, set_key binary, bands array<long>, sig binary")


def _sets(k: int, out: str):
    """Each document's id, under the name out, and its sorted set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in chunks(whole):
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array([s.tobytes() for _, s in shingle_sets(batch, k)], pa.binary())], names=[out, "shingles"])

    return run


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs whose signatures agree often enough."""
    for batch in batches:
        a, b = column(batch, "sig_a").to_pylist(), column(batch, "sig_b").to_pylist()
        ok = [np.mean(np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16)) >= SIGNATURE_AGREEMENT for x, y in zip(a, b, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(column(batch, "set_a"), column(batch, "set_b"), strict=True):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(s) > len(t):
                    s, t = t, s
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                both = int(np.count_nonzero(t[at] == s))
                ok.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def links(docs: DataFrame, pairs: DataFrame, sigs: DataFrame, k: int, percent: int, folder: str, tag: str) -> DataFrame:
    """The candidate pairs (a, b) that are at ``percent`` or more on full shingle sets."""
    sig = sigs.select("rep", "sig")
    likely = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b").mapInArrow(_agreement, "a long, b long")
    likely = cut(likely, folder, f"likely{tag}")
    ids = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct()
    sets = cut(
        only(docs, "doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(_sets(k, "id"), "id long, shingles binary").dropDuplicates(["id"]),
        folder,
        f"sets{tag}",
    )
    both = likely.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b")
    out = cut(both.mapInArrow(_verified(percent), "a long, b long"), folder, f"links{tag}")
    drop(docs.sparkSession, f"{folder}/sets{tag}", f"{folder}/likely{tag}")
    return out


def components(edges: DataFrame, folder: str, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Alternating large-star and small-star; each round's edges are written to the
    shared folder.  Every quantity is a minimum by key, so hot nodes pre-aggregate.
    Raises if it has not converged after ``most_rounds`` (paths of 2**30 nodes need fewer).
    """
    spark = edges.sparkSession
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = cut(e, folder, "stars0")
    before = None
    for i in range(1, most_rounds + 1):
        two = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = two.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = two.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e2 = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e2 = cut(e2, folder, f"stars{i}")
        drop(spark, f"{folder}/stars{i - 1}")
        e = e2
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select(F.col("v"), F.col("v"))).distinct()
        before = now
    raise RuntimeError(f"components did not converge in {most_rounds} rounds")


def _block_links(percent: int):
    """Links between two blocks of documents, exact, one for each document and component it meets."""

    def incidence(rows: list[np.ndarray], low: int, high: int) -> np.ndarray:
        out = np.zeros((len(rows), high - low), np.float32)
        for i, r in enumerate(rows):
            out[i, r[np.searchsorted(r, low) : np.searchsorted(r, high)] - low] = 1
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for left, right in zip(column(batch, "outside").to_pylist(), column(batch, "members").to_pylist(), strict=True):
                sets = [np.frombuffer(x["shingles"], np.uint64) for x in left + right]
                size = np.array([len(x) for x in sets])
                seen, number = np.unique(np.concatenate(sets), return_inverse=True)
                rows = np.split(number.ravel(), np.cumsum(size)[:-1])
                both = np.zeros((len(left), len(right)), np.float32)
                for low in range(0, len(seen), 8192):
                    high = min(low + 8192, len(seen))
                    both += incidence(rows[: len(left)], low, high) @ incidence(rows[len(left) :], low, high).T
                both = np.rint(both).astype(np.int64)
                near = 100 * both >= percent * (size[: len(left), None] + size[None, len(left) :] - both)
                met = set()
                for i, j in np.argwhere(near).tolist():
                    x, y = left[i], right[j]
                    if x["comp"] != y["comp"] and (i, y["comp"]) not in met:
                        met.add((i, y["comp"]))
                        a.append(min(x["rep"], y["rep"])), b.append(max(x["rep"], y["rep"]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def with_groups(rows: DataFrame, groups: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups`` (key, copies, ...; one row a key).

    A key that more than one row of ``total`` in HOT_SHARE has is joined by broadcast, so
    its rows stay where they are; there are fewer than HOT_SHARE such keys at any size.
    """
    often = F.col("copies") * HOT_SHARE > total
    hot = F.broadcast(groups.where(often))
    rest = rows.join(F.broadcast(groups.where(often).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(groups.where(~often), key))


def cross_links(docs: DataFrame, stars: DataFrame, roots: DataFrame, k: int, percent: int, folder: str) -> DataFrame:
    """(a, b): links between members of one center's group that ``roots`` leaves in different components.

    Any two documents that share a bucket stand in the group of its center.  Members
    outside the center's component are compared with all members, block by block:
    a block is a bounded number of bytes of shingle sets, so a large group is many
    small tasks, and only links leave a task.
    """
    root = roots.withColumnRenamed("node", "rep").withColumnRenamed("root", "comp")
    group = stars.union(stars.select("center", F.col("center").alias("rep")).distinct()).join(root, "rep", "left").select("center", "rep", F.coalesce("comp", "rep").alias("comp"))
    group = cut(group, folder, "members-of-centers")
    total = group.count()
    center = group.groupBy("center").agg(F.count("*").alias("copies"), F.max(F.when(F.col("center") == F.col("rep"), F.col("comp"))).alias("center_comp"), (F.min("comp") != F.max("comp")).alias("mixed"))
    center = cut(center.where("mixed").drop("mixed"), folder, "mixed-centers")
    group = cut(with_groups(group, center, "center", total).select("center", "rep", "comp", (F.col("comp") != F.col("center_comp")).alias("out")), folder, "group")
    ids = group.select(F.col("rep").alias("doc_id")).distinct()
    sets = cut(only(docs, "doc_id", "text").join(ids, "doc_id", "left_semi").mapInArrow(_sets(k, "rep"), "rep long, shingles binary").dropDuplicates(["rep"]).withColumn("bytes", F.length("shingles")), folder, "group-sets")
    # Block numbers are found on thin rows; sets join by rep afterwards, so no task holds a group's sets.
    thin = cut(group.join(sets.select("rep", "bytes"), "rep"), folder, "thin")
    blocks = thin.groupBy("center").agg(F.count("*").alias("copies"), F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("m"), F.ceil(F.sum(F.when(F.col("out"), F.col("bytes"))) / BLOCK_BYTES).cast("int").alias("o"))
    thin = with_groups(thin, blocks, "center", total).select("center", "rep", "comp", "out", "m", F.pmod(F.xxhash64("rep"), "m").alias("block"), F.pmod(F.xxhash64("rep", F.lit(1)), "o").alias("own"))
    rows = thin.join(sets.select("rep", "shingles"), "rep")
    packed = F.collect_list(F.struct("rep", "comp", "shingles"))
    members = rows.groupBy("center", "block").agg(packed.alias("members"))
    outside = rows.where("out").groupBy("center", "own", "m").agg(packed.alias("outside"))
    outside = outside.select("center", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long") - 1)).alias("block"), "outside")
    return outside.join(members, ["center", "block"]).select("outside", "members").mapInArrow(_block_links(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Links: 100 * |A & B| >= percent * |A | B| on sets of k-word shingles.  A null,
    empty or blank text has no shingles and is alone.  A null doc_id takes no part
    and has component_id null and kept true.  Rows that repeat a doc_id are one
    document, which links what any of its texts links; each of them is returned, with the
    size of its own set.  Ties do not arise: component_id is the smallest id reachable.  Columns other than doc_id and text are ignored.
    """
    spark, folder = docs.sparkSession, scratch(docs.sparkSession)
    table = cut(signatures(docs, k), folder, "signatures")
    known = table.where("doc_id is not null")
    if not known.groupBy("doc_id").agg(F.count_distinct(F.coalesce("set_key", F.lit(b""))).alias("n")).where("n > 1").isEmpty():
        drop(spark, f"{folder}/signatures")
        return _of_repeated_ids(docs, k, percent, folder)
    groups = cut(known.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), folder, "groups")
    reps = cut(known.join(groups, (known["doc_id"] == groups["rep"]) & (known["set_key"] == groups["set_key"])).select("rep", "bands", "sig").dropDuplicates(["rep"]), folder, "reps")

    rows = reps.select("rep", F.explode("bands").alias("band"))
    full = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(rows.join(full, "band"), folder, "members")
    degree = members.groupBy("rep").agg(F.sum("n").alias("degree"))
    ranked = members.join(degree, "rep")
    central = ranked.groupBy("band").agg(F.max_by("rep", F.struct("degree", -F.col("rep"))).alias("center"))
    stars = cut(members.join(central, "band").where("rep <> center").select("center", "rep").distinct(), folder, "centers")
    pairs = stars.select(F.least("rep", "center").alias("a"), F.greatest("rep", "center").alias("b")).distinct()
    found = links(docs, pairs, reps, k, percent, folder, "1")
    roots = components(found, folder)

    # Groups of a center that still hold several components: members outside the center's meet the rest.
    crossed = cut(cross_links(docs, stars, roots, k, percent, folder), folder, "crossed")
    if not crossed.isEmpty():
        found = cut(found.union(crossed), folder, "found")
        roots = components(found, folder)

    filled = known.where("set_key is not null")
    rooted = groups.join(roots, groups["rep"] == roots["node"], "left").select("set_key", "copies", F.coalesce("root", "rep").alias("root"))
    ends = with_groups(filled.select("doc_id", "n_shingles", "set_key"), rooted, "set_key", known.count()).select("doc_id", "n_shingles", F.col("root").alias("component_id"))
    out = ends.union(table.where("doc_id is null or set_key is null").select("doc_id", "n_shingles", "doc_id"))
    out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    out = cut(out, folder, "result")
    drop(spark, *[f"{folder}/{x}" for x in ("signatures", "groups", "reps", "members", "centers", "members-of-centers", "mixed-centers", "group", "group-sets", "thin", "links1", "crossed", "found")])
    return out


def _of_repeated_ids(docs: DataFrame, k: int, percent: int, folder: str) -> DataFrame:
    """``near_duplicates`` where an id stands on rows with different texts: rows are compared by numbers of their own, then rows of one id are tied."""
    rows = cut(only(docs, "doc_id", "text").withColumn("row", F.monotonically_increasing_id()), folder, "numbered")
    known = rows.where("doc_id is not null")
    found = near_duplicates(known.select(F.col("row").alias("doc_id"), "text"), k, percent).select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("near"))
    first = known.groupBy("doc_id").agg(F.min("row").alias("first"))
    tied = known.select("doc_id", "row").join(first, "doc_id")
    roots = components(found.select(F.col("row").alias("a"), F.col("near").alias("b")).union(tied.select("row", "first")), folder)
    linked = cut(known.select("doc_id", "row").join(found.select("row", "n_shingles"), "row").join(roots, F.col("row") == F.col("node"), "left").select("doc_id", "n_shingles", F.coalesce("root", "row").alias("root")), folder, "tied")
    groups = linked.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("copies"))
    out = with_groups(linked, groups, "root", linked.count()).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    alone = signatures(rows.where("doc_id is null").select("doc_id", "text"), k).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return cut(out.union(alone), folder, "result")


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``near_duplicates`` keeps; of rows that repeat a doc_id one stays, the least by its columns. Rows without an id stay."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key = F.col(f"c{names.index('doc_id')}")
    gone = near_duplicates(docs, k, percent).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    kept = plain.join(gone, key == F.col("gone"), "left_anti")
    again = plain.where(key.isNotNull()).groupBy(key.alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again")
    if not again.isEmpty():
        one = kept.join(again, key == F.col("again"), "left_semi").groupBy(key.alias("again")).agg(F.min(F.struct(*plain.columns)).alias("r")).select("r.*")
        kept = kept.join(again, key == F.col("again"), "left_anti").union(one)
    return kept.toDF(*names)


def op9_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=4, percent=80)
