"""The n-gram trie against a model of dictionaries."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from synonymy.llm import ngram

SF = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), None]  # bytes.lower() folds A-Z alone; None is the end


class Model:
    def __init__(self, texts, k):
        one, two, three = Counter(), Counter(), Counter()
        for t in map(tokens, texts):
            one.update(t)
            two.update(zip([None, *t], t, strict=False))
            three.update(zip([None, *t], t, t[1:], strict=False))
        self.one, self.two, self.three, self.k = one, two, three, k
        self.n, self.v = sum(one.values()), len(one)
        once, twice = (sum(c == x for c in one.values()) for x in (1, 2))
        self.d = once / (once + 2 * twice) if once and twice else 0.5

    def base(self, text):
        return sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in tokens(text))

    def p(self, u, v, w):
        c = self.one[w]
        p = (c - self.d) / self.n if c else self.d * self.v / self.n
        if self.one[v]:
            p = (self.two[v, w] + self.k * p) / (self.one[v] + self.k)
        if u is not Ellipsis and self.two[u, v] and v is not None:
            p = (self.three[u, v, w] + self.k * p) / (self.two[u, v] + self.k)
        return p

    def score(self, text):
        t = [..., None, *tokens(text)]
        return sum(math.log10(self.p(*t[i : i + 3])) for i in range(len(t) - 2))


@pytest.mark.parametrize("parts", [1, 5])
def test_scores_equal_a_model_of_dictionaries(spark, parts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(["", None, " \t", "a b a b a b", "a", "never seen words here", "a b a b a b", "É é Ab aB"])], "doc_id long, text string")
    every = docs.union(odd).repartition(parts)
    rows = every.collect()
    held = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 2}
    model = Model([r.text for r in rows if r.doc_id not in held], ngram.STRENGTH)
    text = {r.doc_id: r.text for r in rows}
    got = ngram.score(every).collect()
    assert len(got) == len(rows) and held
    for r in got:
        t = tokens(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id in held, len(t), sum(model.one[w] > 0 for w in t), model.n)
        assert r.base_score == pytest.approx(model.base(text[r.doc_id]), rel=1e-9)
        assert r.score == pytest.approx(model.score(text[r.doc_id]), abs=len(t) * ngram.STEP)


def test_level_searches_within_its_context():
    rng = np.random.default_rng(3)
    v = 1000
    ranges = [np.sort(rng.choice(v, n, replace=False)) for n in (3, 0, 1, 900, 0, 0, 40, 2)]
    edges = np.r_[0, np.cumsum([len(r) for r in ranges])]
    level = ngram.Level(ngram.Level.arrays(edges, np.concatenate(ranges), v), v)
    for i, r in enumerate(ranges):
        got = level.find(np.full(v, i), np.arange(v, dtype=np.uint64))
        want = np.full(v, -1)
        want[r] = edges[i] + np.arange(len(r))
        assert (got == want).all()


def test_neighbouring_elements():
    rng = np.random.default_rng(5)
    for n, u in ((2, 5), (3000, 40000), (500, 1 << 40)):
        v = np.sort(rng.integers(0, u, n)).astype(np.uint64)
        e = ngram.EliasFano(ngram.ef_arrays(v, u))
        a, b = e.get_two(np.arange(n - 1))
        assert (a == v[:-1]).all() and (b == v[1:]).all()


def test_third_order_tells_repeated_texts_from_single_ones(spark):
    """Held-out likelihood gains from the third level, and a text seen twice scores above one seen once."""
    rng = np.random.default_rng(4)
    make = lambda: " ".join(f"w{x}" for x in rng.zipf(1.4, 60) % 500)
    texts = [make() for _ in range(300)]
    rows = list(enumerate(texts + texts[:50]))
    got = {r.doc_id: r for r in ngram.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    taught = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    twice = [got[i].score / got[i].n_tokens for i in range(50) if taught(i) and taught(300 + i)]
    once = [got[i].score / got[i].n_tokens for i in range(50, 300) if taught(i)]
    assert np.mean(twice) > np.mean(once) + 0.05
