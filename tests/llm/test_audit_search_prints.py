"""Filter audit, lexical search and fingerprints against plain Python that follows their definitions."""

import hashlib
import itertools
import math
import re
import string
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from synonymy.llm import filter_audit, fingerprint, lexical

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string"
ROWS = [
    (1, "one two three four five six", "en"), (2, "one two three four five six", "de"), (3, None, "en"), (4, "", None), (5, " \t\n ", "en"), (None, "one two three four five six", "en"), (None, None, None),
    (7, "HELLO World $ " * 80, "en"), (7, "HELLO World $ " * 80, "de"), (8, "HELLO World $ " * 80, ""), (9, "Ünï 😀 straße " * 300, "en"), (10, " ".join(f"w{i}" for i in range(5000)), "fr"), (11, "a b", "en"),
    (12, "a b", "en"), (12, "a b", "en"), (13, "A\x0bB\x1fC a b", "xx"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, DOCS).select("*", F.lit("x").alias("TEXT"), F.lit(1).alias("mask"), F.lit(2).alias("part"), F.lit(3).alias("term"), F.lit(4).alias("packed"))


# ---------------------------------------------------------------- audit
def audited(rows, labels):
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, t in labels if t == 1 and d is not None}
    failed = []
    for d, t, lang in rows:
        t = t or ""
        words = SPACE.findall(t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and d > least[t]}
        failed.append((lang or "", {f for f, x in fails.items() if x}, d in good, d in toxic))
    out = {}
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in {f[0] for f in failed}:
        own = [f[1:] for f in failed if f[0] == part]
        share = Counter()
        for o in orders:
            for fails, _, _ in own:
                share.update([x for x in o if x in fails][:1])
        for o in orders:
            for k, f in enumerate(o, 1):
                before, here = set(o[: k - 1]), [x for x in own if f in x[0] and not x[0] & set(o[: k - 1])]
                out[part, o, k] = (
                    sum(not x[0] & set(o[:k]) for x in own), len(here), sum(f in x[0] and bool(x[0] & before) for x in own), sum(x[0] == {f} for x in own), sum(x[1] for x in here), sum(x[2] for x in here), share[f]
                )
    return out


def counts(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def test_audit_equals_all_orders_run_one_by_one(spark, odd, docs):
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (7, 1, 1), (12, 1, 0), (None, 1, 1), (3, None, 1)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    got = counts(filter_audit.audit(odd, labelled))
    assert got == audited(ROWS, labels) and len(got) == 600 * len({r[2] or "" for r in ROWS})
    table = spark.read.parquet(f"{SF}/labels.parquet")
    want = audited([(r.doc_id, r.text, r.lang) for r in docs.collect()], [(r.doc_id, r.quality, r.toxic) for r in table.collect()])
    assert counts(filter_audit.audit(docs, table)) == want


def test_audit_of_empty_tables(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], DOCS), none).count() == 0
    assert counts(filter_audit.audit(odd, none)) == audited(ROWS, [])


def test_parity_sums_invert_to_the_masks(spark):
    rng = np.random.default_rng(3)
    masks = rng.integers(0, 32, 500)
    rows = spark.createDataFrame([("p", bool(m % 3 == 0), False, int(m)) for m in masks], "part string, good boolean, toxic boolean, mask int")
    sums = {r.label: r.w for r in filter_audit.parity_sums(rows).collect()}
    assert sums["all"] == [sum((-1) ** bin(int(m) & s).count("1") for m in masks) for s in range(32)]
    cells = filter_audit.inverted(filter_audit.parity_sums(rows)).first()
    assert cells["all"] == [int((masks == m).sum()) for m in range(32)] and cells["good"] == [int((masks == m).sum()) if m % 3 == 0 else 0 for m in range(32)] and cells["toxic"] == [0] * 32


# ---------------------------------------------------------------- search
def best(rows, items, k=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    texts = [(d, Counter(words(t))) for d, t in rows]
    n, total = sum(bool(c) for _, c in texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(w for _, c in texts for w in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in texts:
            m = 25 + 75 * sum(c.values()) * n // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in words(text) if c[w])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_search_equals_all_scores(spark, odd, docs):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    pairs, asked = [(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()]
    want = best(pairs, asked)
    assert found(lexical.ranked(docs, items)) == want
    assert found(lexical.ranked(docs.repartition(5), items, shard_postings=3000, query_block=7)) == want


def test_search_of_odd_rows(spark, odd):
    asked = [(1, "one TWO two a"), (2, None), (3, "..."), (None, "world Hello"), (5, "straße 😀 ünï w17"), (5, "one"), (6, "nowhere")]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = best([(d, t) for d, t, _ in ROWS], asked, 3)
    assert found(lexical.ranked(odd, items, k=3)) == want and found(lexical.ranked(odd, items, k=3, shard_postings=4, query_block=2)) == want
    assert lexical.ranked(odd, items.limit(0)).count() == 0 and lexical.ranked(spark.createDataFrame([], DOCS), items).count() == 0


def test_blocks_have_the_least_cost():
    rng = np.random.default_rng(1)
    impact = (rng.pareto(1.0, 90) * 1000).astype(np.int64) + 1
    price = lexical.PRICE * (int(impact.max()) - int(impact.mean()))
    cost = lambda cuts: sum((b - a) * int(impact[a:b].max()) + price for a, b in itertools.pairwise([*cuts, len(impact)]))
    places = range(lexical.STEP, len(impact), lexical.STEP)
    least = min(cost([0, *some]) for n in range(len(places) + 1) for some in itertools.combinations(places, n))
    assert cost(lexical.blocks(impact).tolist()) == least and lexical.blocks(impact[:9]).tolist() == [0]


def test_search_skips_blocks():
    rng = np.random.default_rng(2)
    n = 20000
    docs = [np.sort(rng.choice(n, c, replace=False)) for c in (8000, 3000, 500)]
    tfs = [np.where(np.abs(d - 7000) < 300, rng.integers(20, 40, len(d)), 1) for d in docs]
    shard = lexical.Shard(np.arange(n), np.full(n, 100), [3, 1, 2], [100, 300, 900], docs, tfs, n, 100 * n)
    got, scores = shard.search(np.array([1, 2, 3, 99]), np.array([1, 2, 1, 1]), 10)
    every = np.zeros(n, np.int64)
    for d, tf, w in zip(docs, tfs, (100, 300, 1800), strict=True):
        every[d] += w * (1_000_000_000 * tf // (1000 * tf + 800))
    want = np.lexsort((np.arange(n), -every))[:10]
    assert got.tolist() == want.tolist() and scores.tolist() == every[want].tolist()
    assert 0 < shard.read < sum(map(len, docs)) / 2


# ---------------------------------------------------------------- fingerprints
MASK = (1 << 64) - 1


def long_hash(*values):
    """A hash of longs, each seeded by the one before."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", v & MASK), seed)
    return seed


def shingles(text):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in SPACE.findall(text)]
    return [long_hash(*h)] if 0 < len(h) < 5 else [long_hash(*h[i : i + 5]) for i in range(len(h) - 4)]


def printed(text):
    """(bins' stored bytes, fingerprint)."""
    least = {}
    for h in shingles(text):
        b, v = ((h >> 56) + 128) % 256, h & ((1 << 56) - 1)
        least[b] = min(v, least.get(b, v))
    if not least:
        return [], ""
    out = []
    for i in range(256):
        v = least.get(i)
        if v is None:
            digits = xxhash_int(i)
            for t in range(8):
                v = least.get((digits >> (8 * t)) & 255)
                if v is not None:
                    break
            else:
                signed = digits - (1 << 64) if digits >> 63 else digits
                odd = (signed >> 56) | 1
                _, v = min((((b - 128 + (digits & 255)) * odd) & 255, v) for b, v in least.items())
            v = hash_long_int(v, i)
        out.append(v & 255)
    return out, "".join(f"{x:02x}" for x in out)


def xxhash_int(i):
    """Spark hashes an int as four bytes."""
    return xxhash.xxh64_intdigest(struct.pack("<I", i), 42)


def hash_long_int(v, i):
    return xxhash.xxh64_intdigest(struct.pack("<I", i), xxhash.xxh64_intdigest(struct.pack("<Q", v), 42))


def like(a, b):
    if not a or not b:
        return 1.0 if not a and not b else 0.0
    return max((np.mean([x == y for x, y in zip(a, b, strict=True)]) - 1 / 256) / (1 - 1 / 256), 0.0)


def expected(rows):
    placed = sorted((r for r in rows if r[0] is not None), key=lambda r: (-r[0], r[1] or ""))
    out = []
    for i, (d, t) in enumerate(placed):
        t, nxt = t or "", placed[(i + 1) % len(placed)][1] or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        (a, x), (b, y), (c, _) = printed(t), printed(edited), printed(nxt)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), x, y, round(like(a, b), 9), round(like(a, c), 9)))
    for d, t in rows:
        if d is None:
            t = t or ""
            edited = t[: len(t) - len(t) // 2]
            out.append((None, len(t), hashlib.sha256(edited.encode()).hexdigest(), printed(t)[1], printed(edited)[1], round(like(printed(t)[0], printed(edited)[0]), 9), None))
    return sorted(out, key=str)


def prints(df):
    return sorted(((*tuple(r)[:5], round(r.near_edited, 9), None if r.near_next is None else round(r.near_next, 9)) for r in df.collect()), key=str)


def test_fingerprints_equal_plain_python(spark, odd, docs):
    assert prints(fingerprint.fingerprints(odd)) == expected([(d, t) for d, t, _ in ROWS])
    some = docs.where("doc_id < 60")
    assert prints(fingerprint.fingerprints(some)) == expected([(r.doc_id, r.text) for r in some.collect()])


def test_one_document_is_its_own_next(spark):
    for rows in ([(5, "a b c d e f g")], [(5, "")], [(None, "a b c d e f")], [(5, None), (5, "x y z"), (-3, "x y")]):
        assert prints(fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)
    assert fingerprint.fingerprints(spark.createDataFrame([], DOCS)).count() == 0


def test_likeness_is_near_the_share_of_equal_shingles(spark, docs):
    rows = [(i, " ".join(f"{'x' if j < i * 6 else 'y'}{j}" for j in range(600))) for i in range(100)]
    got = fingerprint.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "near_next").collect()
    sets = {d: set(shingles(t)) for d, t in rows}
    off = [r.near_next - len(sets[r.doc_id] & sets[(r.doc_id - 1) % 100]) / len(sets[r.doc_id] | sets[(r.doc_id - 1) % 100]) for r in got]
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.04
    short = spark.createDataFrame([(i, f"word{i} only") for i in range(300)], "doc_id long, text string")
    assert fingerprint.fingerprints(short).agg(F.max("near_next")).first()[0] < 0.1
