"""Document fingerprints by one-permutation MinHash, with DataFrame functions only.

Each shingle of five words is hashed once; the eight highest bits choose its bin, the
others are its value, and a bin keeps its least value.  An empty bin borrows from another
by optimal densification: a pseudo-random order of all bins, its own, names the first that
is not empty.  Of each bin eight low-order bits are stored, eight bins in a word of 64
bits; unequal values agree in b bits by chance once in 2^b, which the likeness takes off.
A borrowed value is hashed again with the number of the bin that borrows it, so that
chance agreements of different bins stay independent.

A bin's least value comes from one sort: an entry for each bin above all its values is
added, so the first entry of each bin stands for it, empty bins included.

The order by doc_id is cut into buckets at values that occur, and the document at a cut
goes to both sides, so every row finds the next one in its own bucket: one shuffle.
"""

from __future__ import annotations

import json

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import only

SHINGLE, BIN_BITS, BITS = 5, 8, 8
BINS, VALUE, PER_WORD = 1 << BIN_BITS, 64 - BIN_BITS, 64 // BITS
LAST = (1 << VALUE) - 1
SPACE = r"[\x20\x09-\x0D]+"
#: Buckets of the order for each partition of a shuffle, so that they are dealt evenly.
BUCKETS = 4


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(text: Column) -> Column:
    """Hashes of the text's shingles; of fewer words than one has, the hash of all; none of a blank text."""
    trimmed = F.btrim(text, F.lit("\t\n\x0b\x0c\r "))
    none = F.expr("cast(array() as array<bigint>)")

    def joined(h):
        each = F.transform(F.sequence(F.lit(0), F.size(h) - SHINGLE), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(h) < SHINGLE, F.array(F.xxhash64(h))).otherwise(each)

    return F.when(trimmed == "", none).otherwise(let(F.transform(F.split(trimmed, SPACE, -1), lambda w: F.xxhash64(w)), joined))


def _bins(hashes: Column) -> Column:
    """The least hash of each bin, in the bins' order; an empty bin's has the value ``LAST``."""
    empty = F.array(*[F.lit((b << VALUE) + LAST) for b in range(-BINS // 2, BINS // 2)])
    return let(F.sort_array(F.concat(hashes, empty)), lambda s: F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, VALUE) != F.shiftright(F.get(s, i - 1), VALUE))))


def _value(x: Column) -> Column:
    return x.bitwiseAND(F.lit(LAST))


def _stored(bins: Column) -> Column:
    """Each bin's low-order bits, empty bins filled.

    An empty bin tries the bins that the digits of its own hash name.  Where all of these are
    empty, few bins are not, and the first of them is taken in an order of all bins by an odd
    stride, again its own.
    """
    low, last_bin = F.lit((1 << BITS) - 1).cast("long"), F.lit(BINS - 1).cast("long")

    def filled(values):
        def borrowed(digits):
            tried = [F.get(values, F.shiftrightunsigned(digits, BIN_BITS * t).bitwiseAND(last_bin).cast("int")) for t in range(64 // BIN_BITS)]
            turn = lambda x: ((F.shiftright(x, VALUE) + digits.bitwiseAND(last_bin)) * F.shiftright(digits, VALUE).bitwiseOR(F.lit(1))).bitwiseAND(last_bin)
            rest = F.transform(F.filter(bins, lambda x: _value(x) != LAST), lambda x: F.struct(turn(x).alias("turn"), _value(x).alias("value")))
            return F.coalesce(*tried, F.array_min(rest)["value"])

        return F.transform(values, lambda v, i: F.coalesce(v, F.xxhash64(let(F.xxhash64(i), borrowed), i)).bitwiseAND(low))

    return let(F.transform(bins, lambda x: F.when(_value(x) != LAST, _value(x))), filled)


def packed_bits(text: Column) -> Column:
    """The fingerprint of a text (not null) as 64-bit words; none for a blank text."""
    words = lambda stored: F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_WORD - 1)), lambda k: F.aggregate(F.slice(stored, k * PER_WORD + 1, F.lit(PER_WORD)), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x)))
    made = lambda h: let(_bins(h), lambda bins: let(_stored(bins), words))
    return let(_shingles(text), lambda h: F.when(F.size(h) == 0, h).otherwise(made(h)))


def as_text(packed: Column) -> Column:
    return F.array_join(F.transform(packed, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal shingles (0 to 1) that two packed fingerprints show, without chance agreements; two blank texts are alike, one is like no other.  Null if either is."""
    lanes = sum(1 << (BITS * k) for k in range(PER_WORD))

    def differing(x, y):
        z = x.bitwiseXOR(y)
        for k in (1, 2, 4):
            z = z.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(z.bitwiseAND(F.lit(lanes))).cast("long")

    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0).cast("long"), lambda s, x: s + x)
    chance = 2.0**-BITS
    some = F.greatest((1 - apart / BINS - chance) / (1 - chance), F.lit(0.0))
    return F.when(a.isNull() | b.isNull(), None).when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(some)


def with_next(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows (doc_id, text, ...) with next_<column> of the following row by descending doc_id, then text; after the last the first.

    Rows without doc_id stand outside the order and have no next one.
    """
    spark = rows.sparkSession
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    back = -F.col("doc_id").cast("double")
    shares = F.from_json(F.lit(json.dumps([k / buckets for k in range(1, buckets)])), "array<double>")
    cuts = rows.agg(F.min(back).alias("least"), F.percentile_approx(back, shares, 4 * buckets).alias("cuts")).first()  # a number for each bucket
    at = sorted({cuts["least"], *(cuts["cuts"] or [])} - {None}) or [0.0]
    splits = [*at, float("inf")]
    x = rows.withColumn("x_", back)
    if len(at) > 1:
        x = Bucketizer(splits=splits, inputCol="x_", outputCol="bucket_", handleInvalid="keep").transform(x).withColumn("bucket_", F.col("bucket_").cast("long"))
    else:
        x = x.withColumn("bucket_", F.lit(0).cast("long"))
    on_cut = F.element_at(F.from_json(F.lit(json.dumps(at)), "array<double>"), (F.col("bucket_") + 1).cast("int")) == F.col("x_")
    before = F.when(F.col("bucket_") == 0, len(at) - 1).otherwise(F.col("bucket_") - 1)
    real, ghost = F.struct(F.col("bucket_").alias("b"), F.lit(0).alias("ghost")), F.struct(before.alias("b"), F.lit(1).alias("ghost"))
    outside = F.struct((-1 - F.pmod(F.xxhash64("text"), F.lit(buckets))).alias("b"), F.lit(0).alias("ghost"))
    places = F.when(F.col("doc_id").isNull(), F.array(outside)).when(on_cut, F.array(real, ghost)).otherwise(F.array(real))
    dealt = x.withColumn("place_", F.explode(places)).select("*", F.col("place_.b").alias("b_"), F.col("place_.ghost").alias("ghost_")).drop("x_", "bucket_", "place_")
    order = Window.partitionBy("b_").orderBy("ghost_", F.col("doc_id").desc_nulls_last(), "text")
    for c in columns:
        dealt = dealt.withColumn(f"next_{c}", F.when(F.col("doc_id").isNotNull(), F.lead(c).over(order)))
    return dealt.where("ghost_ = 0").drop("b_", "ghost_")


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    A null text is empty; an empty or blank text has an empty fingerprint, is like another
    such text (1) and like no other (0).  Fewer than five words are one shingle.  Rows that
    repeat a doc_id follow each other by text.  A row without doc_id has no next document:
    its edited text is its first half and near_next is null.  One document alone is its own
    next.  An empty table gives no rows; other columns are ignored.
    """
    rows = only(documents, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("packed", packed_bits(F.col("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.coalesce(F.substring("next_text", F.lit(1), half), F.lit("")))
    out = with_next(rows, "text", "packed").select("doc_id", F.length("text").cast("long").alias("n_chars"), "packed", "next_packed", edited.alias("edited"))
    out = out.withColumn("edited_packed", packed_bits(F.col("edited")))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("packed")).alias("fingerprint"), as_text(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"), likeness(F.col("packed"), F.col("next_packed")).alias("near_next"),
    )


def op13_fingerprints(spark, sf_dir):
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
