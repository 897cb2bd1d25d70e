"""Draws in arrays against the relations' SQL, which hashes and groups a row for each draw, and against hashlib."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from synonymy.functions.digests import md5_numbers, md5_words, words_below
from synonymy.operators.resampling import first_different
from synonymy.plans import registry, relations  # noqa: F401  the registry defines all relations

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("prefix", ["", "12-src-", "é-7-", "x" * 40])
def test_digests(prefix):
    numbers = np.array([0, 9, 10, 99, 100, 12345, 10**15, 2**62, 5])
    want = [hashlib.md5(f"{prefix}{k}".encode()).hexdigest() for k in numbers]
    assert [f"{a:016x}{b:016x}" for a, b in zip(*(w.tolist() for w in md5_words(prefix, numbers)), strict=True)] == want
    assert md5_numbers(prefix, numbers).tolist() == [int(w[:15], 16) for w in want]
    assert f"{md5_words(prefix, np.array([-3]))[0][0]:016x}" == hashlib.md5(f"{prefix}-3".encode()).hexdigest()[:16]


def test_first_different_places():
    assert first_different(np.array([4, 1, 4, 0, 1, 3]), 3, np.empty(5, np.int64)).tolist() == [0, 1, 4]
    assert first_different(np.array([2, 2]), 3, np.empty(5, np.int64)).tolist() == [2]


def same(got, want, keys, values):
    got, want = ({tuple(r[k] for k in keys): [r[v] for v in values] for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys() and len(want) > 50
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=2e-9)


@pytest.mark.parametrize(
    ("name", "keys", "values"),
    [("null_es", ["perm", "gene_set", "size"], ["es"]), ("goi_boot_test", ["item", "g1", "g2"], ["n1", "n2", "u", "delta"]), ("ref_means", ["i", "genome"], ["m"]), ("sample_null_es", ["sample_id", "i", "drawn", "size"], ["es"])],
)
def test_draws_are_those_of_the_sql(spark, monkeypatch, name, keys, values):
    run = relations.Run(spark, SF)
    got = run._fresh(name)
    assert "md5" not in got._jdf.queryExecution().toString()  # no row for each draw
    monkeypatch.delitem(relations.SPARK, name)
    same(got, run._fresh(name), keys, values)


def test_rounding_of_adjusted_values(spark, monkeypatch):
    """A q halfway between two numbers of six digits, as a p of six digits makes it."""
    row = spark.sql("SELECT 's' AS sample_id, 'letter' AS source, 'L' AS gene_set, 2L AS size, 5e-1 AS es, 1e0 AS nes, 0.094527e0 AS p, 0.094527e0 * 3 / 2 AS q")
    monkeypatch.setitem(relations.SPARK, "sample_nes_q", relations.needs()(lambda run: row))
    assert relations.Run(spark, SF)("be14_sample_gsea").first().q == 0.141791


def test_words_below_a_bound():
    genes, bounds = list(range(40)), ["4" + "0" * 14, "g"] * 20
    got = words_below(pa.array(genes), pa.array(bounds)).to_pylist()
    for gene, bound, words in zip(genes, bounds, got, strict=True):
        want = {i: w for i in range(999) if (w := hashlib.md5(f"{i}-{gene}".encode()).hexdigest()) < bound}
        assert {x["i"]: f"{x['first'] + 2**63:016x}{x['last'] + 2**63:016x}" for x in words} == want


def test_draws_take_no_row_for_each_word(spark):
    plan = relations.Run(spark, SF)._fresh("drawn")._jdf.queryExecution().toString()
    assert "words_below" in plan


def test_shares_of_random_neighbours_are_those_of_the_sql(spark, monkeypatch):
    run = relations.Run(spark, SF)
    got = run._fresh("null_share")
    assert "md5" not in got._jdf.queryExecution().toString()  # no row for each order
    monkeypatch.delitem(relations.SPARK, "null_share")
    want = run._fresh("null_share").where("seen = 1")
    same(got, want, ["genome", "d"], ["p"])
