"""Global orders by ranges against sorted lists."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from synonymy.operators.ranking import ordered, tie_ranks
from synonymy.operators.statistics import quantile


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    # A value that a third of all rows share.
    v = np.where(rng.random(2000) < 0.35, 7.0, np.round(rng.normal(7, 2, 2000), 1))
    return spark.createDataFrame([(int(i), float(x), "ab"[i % 2]) for i, x in enumerate(v)], "id long, v double, g string").repartition(7)


def test_order_and_running_sums(spark, rows):
    want = sorted(((r.v, r.id) for r in rows.collect()), key=lambda x: (-x[0], x[1]))
    got = {r.id: r for r in ordered(rows, F.col("v").desc(), F.col("id"), sums={"total": "v"}).collect()}
    total = 0.0
    for k, (v, i) in enumerate(want, 1):
        total += v
        assert (got[i].r, got[i].n) == (k, 2000) and got[i].total == pytest.approx(total)
    assert ordered(rows.limit(0), F.col("v"), sums={"t": "v"}).count() == 0


def test_average_ranks_within_groups(spark, rows):
    got = {r.id: r.k for r in tie_ranks(rows, "g", "v", "id", "k").collect()}
    every = rows.collect()
    for g in "ab":
        values = [r.v for r in every if r.g == g]
        for r in every:
            if r.g == g:
                assert got[r.id] == sum(x < r.v for x in values) + (values.count(r.v) + 1) / 2


def test_quantiles_of_an_order(spark, rows):
    values = [r.v for r in rows.collect()]
    ordered(rows, F.col("v"), F.col("id")).createOrReplaceTempView("order_of_rows")
    for q in (0.1, 0.25, 0.5, 0.9):
        assert spark.sql(f"SELECT {quantile('v', q)} AS x FROM order_of_rows").first().x == pytest.approx(np.quantile(values, q))
    spark.catalog.dropTempView("order_of_rows")
