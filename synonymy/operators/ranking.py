"""Global order without one task that sees every row.

Rows are cut into ranges of the order, numbered inside each, and moved on by the
number (or sum) of the ranges before, of which there are as many as partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from synonymy.plans.relations import Run, needs, on_spark
from synonymy.sources.shared import new_folder, written


def ordered(df: DataFrame, *order: Column, sums: dict[str, str] | None = None) -> DataFrame:
    """df with r (from 1 in the given order, which must be total), n (all rows), and running sums named by ``sums`` (name -> expression)."""
    sums = sums or {}
    cut = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at_", F.monotonically_increasing_id())
    for name, expression in sums.items():
        cut = cut.withColumn(name, F.expr(expression).cast("double"))
    # The place in a range is the id's low 33 bits, the range its high ones; written, so that they stay.
    rows = written(cut, new_folder(df.sparkSession, "order")).withColumn("part_", F.shiftright("at_", 33)).withColumn("at_", F.col("at_").bitwiseAND(F.lit((1 << 33) - 1)))
    ranges = rows.groupBy("part_").agg(F.count("*").alias("n_"), *[F.sum(s).alias(f"{s}_") for s in sums])
    before = Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    ranges = ranges.select(F.col("part_").alias("p_"), F.sum("n_").over(Window.partitionBy()).alias("n"), F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("n_"), *[F.coalesce(F.sum(f"{s}_").over(before), F.lit(0.0)).alias(f"{s}_") for s in sums])
    inside = Window.partitionBy("part_").orderBy("at_").rowsBetween(Window.unboundedPreceding, 0)
    for s in sums:
        rows = rows.withColumn(s, F.sum(s).over(inside))
    out = rows.join(F.broadcast(ranges), F.col("part_") == F.col("p_")).withColumn("r", F.col("at_") + 1 + F.col("n_"))
    for s in sums:
        out = out.withColumn(s, F.col(s) + F.col(f"{s}_"))
    return out.drop("part_", "p_", "at_", "n_", *[f"{s}_" for s in sums])


def tie_ranks(df: DataFrame, group: str, value: str, key: str, name: str) -> DataFrame:
    """df with the average rank of ``value`` within ``group``; ``key`` makes the order total."""
    rows = ordered(df, F.col(group), F.col(value), F.col(key)).drop("n")
    first = rows.groupBy(group).agg((F.min("r") - 1).alias("first_"))
    mean = rows.groupBy(group, value).agg(((F.min("r") + F.max("r")) / 2).alias("mean_"))
    return rows.drop("r").join(mean, [group, value]).join(F.broadcast(first), group).withColumn(name, F.col("mean_") - F.col("first_")).drop("mean_", "first_")  # a row for each metric


@needs("scores")
def cai_order(run: Run) -> DataFrame:
    return ordered(run("scores"), F.col("cai"), F.col("gene"))


@needs("scores")
def length_order(run: Run) -> DataFrame:
    return ordered(run("scores").select("gene", "length", "enc"), F.col("length"), F.col("gene"))


@needs("scores")
def enc_order(run: Run) -> DataFrame:
    rows = ordered(run("scores").select("gene", "enc"), F.col("enc").desc(), F.col("gene"), sums={"run": "enc"})
    total = rows.agg(F.sum("enc").alias("total"))
    return rows.crossJoin(F.broadcast(total)).select("gene", "enc", "r", (F.col("run") / F.col("total")).alias("share"))  # one row


@needs("scores")
def ranked(run: Run) -> DataFrame:
    rows = ordered(run("scores").select("gene", "genome", "cai"), F.col("cai").desc(), F.col("gene"))
    return rows.select("gene", "genome", F.abs("cai").alias("w"), "r", "n")


@needs("split")
def below_goi(run: Run) -> DataFrame:
    """cai, below, same, total: how many others lie below each value that a gene of interest has, and on it."""
    rows = ordered(run("split").select("gene", "cai", "is_goi"), F.col("cai"), F.col("gene"), sums={"others": "1 - is_goi"})
    values = rows.groupBy("cai").agg(F.min(F.col("others") - (1 - F.col("is_goi"))).alias("below"), F.max("others").alias("upto"), F.max("is_goi").alias("any_goi"))
    total = rows.agg(F.max("others").alias("total"))
    return values.where("any_goi = 1").crossJoin(F.broadcast(total)).select("cai", "below", (F.col("upto") - F.col("below")).alias("same"), "total")  # one row


@needs("metric", "genes")
def len_rank(run: Run) -> DataFrame:
    rows = run.sql("SELECT m.metric, m.gene, round(m.v, 9) AS v, ln(g.length) / ln(10e0) AS lg FROM metric m JOIN genes g ON g.gene = m.gene")
    return tie_ranks(tie_ranks(rows, "metric", "v", "gene", "rv"), "metric", "lg", "gene", "rl")


@needs("metric", "split")
def cdf_steps(run: Run) -> DataFrame:
    """metric, f1, f0: both groups' distribution functions at each value."""
    steps = run.sql("SELECT m.metric, round(m.v, 9) AS v, CAST(sum(s.is_goi) AS DOUBLE) AS a, CAST(count(*) - sum(s.is_goi) AS DOUBLE) AS b FROM metric m JOIN split s ON s.gene = m.gene GROUP BY m.metric, round(m.v, 9)")
    rows = ordered(steps, F.col("metric"), F.col("v"), sums={"run_a": "a", "run_b": "b"})
    ends = rows.groupBy("metric").agg(F.min(F.col("run_a") - F.col("a")).alias("a0"), F.min(F.col("run_b") - F.col("b")).alias("b0"), F.sum("a").alias("na"), F.sum("b").alias("nb"))
    return rows.join(F.broadcast(ends), "metric").select("metric", F.expr("(run_a - a0) / nullif(na, 0)").alias("f1"), F.expr("(run_b - b0) / nullif(nb, 0)").alias("f0"))  # a row for each metric


for name, form in (("cai_order", cai_order), ("length_order", length_order), ("enc_order", enc_order), ("ranked", ranked), ("below_goi", below_goi), ("len_rank", len_rank), ("cdf_steps", cdf_steps)):
    on_spark(name, form)
