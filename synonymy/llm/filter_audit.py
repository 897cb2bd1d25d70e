"""How filters interact: orders, redundancy and fair shares from Walsh-Hadamard sums.

Five filters judge every document; the failures make a mask of five bits.  For each
part and label (all, good, toxic) one pass adds up the 32 signed parities of the masks,
W[s] = sum of (-1)^|mask & s|.  The transform is its own inverse but for the factor 32,
so the sums give back exactly how many documents have each mask.  What any order of
the filters keeps, removes or finds removed is a sum over these 32 cells, and a filter's
share over all 120 orders is closed: a document that fails k filters is removed by each
of them in 120 / k orders.

A text's duplicates are found by the least doc_id of its digest, an aggregation with
partial minima, and joined back by digest and doc_id, so a group of copies never meets
in one task.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
#: Thresholds of the five filters.
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, MARKS = 200, 50, 3, "[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
LABELS = ("all", "good", "toxic")


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failures(text: Column) -> Column:
    """Bits A to D of a text (not null)."""
    trimmed = F.btrim(text, F.lit("\t\n\x0b\x0c\r "))

    def judged(words):
        n = F.when(trimmed == "", 0).otherwise(F.size(words))
        distinct = F.when(trimmed == "", 0).otherwise(F.size(F.array_distinct(words)))
        upper = F.regexp_count(text, F.lit("[A-Z]"))
        conditions = (n < LEAST_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * upper > UPPER_PERCENT * F.length(text), F.rlike(text, F.lit(MARKS)))
        return sum((F.when(c, _bit(f)).otherwise(0) for f, c in zip(FILTERS, conditions, strict=False)), F.lit(0))

    # A lambda's variable, so that the text is split once.
    return F.get(F.transform(F.array(F.split(trimmed, SPACE, -1)), judged), F.lit(0))


def masks(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, good, toxic, mask: one row a document."""
    text = F.coalesce("text", F.lit(""))
    rows = only(documents, "doc_id", "lang", "text").select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), failures(text).alias("mask"), F.sha2(text, 256).alias("digest"),
    )
    first = rows.where("doc_id is not null").groupBy(F.col("digest").alias("first_digest")).agg(F.min("doc_id").alias("first_id"))
    # Rows without doc_id match nothing; the digest in the keys deals them out.
    copied = F.col("doc_id").isNotNull() & F.col("first_id").isNull()
    judged = rows.join(first, (F.col("digest") == F.col("first_digest")) & (F.col("doc_id") == F.col("first_id")), "left").select(
        "doc_id", "part", (F.col("mask") + F.when(copied, _bit("E")).otherwise(0)).alias("mask"), F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0).alias("salt"),
    )
    known = only(labels, "doc_id", "quality", "toxic").where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = known.withColumnRenamed("doc_id", "labelled").withColumn("zero", F.lit(0).cast("long"))
    return judged.join(known, (F.col("doc_id") == F.col("labelled")) & (F.col("salt") == F.col("zero")), "left").select("part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "mask")


def sign(a: Column, b: Column) -> Column:
    """(-1) to the number of bits that both have."""
    return 1 - 2 * (F.bit_count(a.bitwiseAND(b)) % 2)


def parity_sums(rows: DataFrame) -> DataFrame:
    """part, label, w: the 32 signed parity sums of each part's masks under each label."""
    held = F.array_compact(F.array(F.lit("all"), F.when(F.col("good"), "good"), F.when(F.col("toxic"), "toxic")))
    each = rows.select("part", "mask", F.explode(held).alias("label"))
    sums = [F.sum(sign(F.col("mask"), F.lit(s)).cast("long")).alias(f"w{s}") for s in range(CELLS)]
    return each.groupBy("part", "label").agg(*sums).select("part", "label", F.array(*[f"w{s}" for s in range(CELLS)]).alias("w"))


def inverted(sums: DataFrame) -> DataFrame:
    """part, and for each label an array of the 32 cells' documents."""
    cell = lambda m: F.aggregate(F.transform("w", lambda w, s: w * sign(s, m)), F.lit(0).cast("long"), lambda a, x: a + x)
    cells = sums.select("part", "label", F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), lambda m: (cell(m) / CELLS).cast("long")).alias("cells"))
    none = F.array_repeat(F.lit(0).cast("long"), CELLS)
    return cells.groupBy("part").agg(*[F.coalesce(F.max(F.when(F.col("label") == x, F.col("cells"))), none).alias(x) for x in LABELS])


def _where(cells: str, test) -> Column:
    """Documents in the cells whose mask passes."""
    return F.aggregate(F.transform(cells, lambda n, m: F.when(test(m), n).otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x)


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row for each value of lang (null: empty string), each of the 120 orders and each
    step.  A null text is empty.  Every row is a document, repeated ones too; rows of one
    doc_id and text do not make each other duplicates, nor do rows without doc_id.  A
    document is good (toxic) if any of its labels has quality (toxic) 1; labels without
    doc_id count for nothing.  Ties cannot occur.  Empty tables give no rows; other
    columns are ignored.
    """
    cells = inverted(parity_sums(masks(documents, labels)))
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    rows = cells.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    before, own = F.substring("filter_order", F.lit(1), F.col("step") - 1), F.substring("filter_order", F.col("step"), F.lit(1))
    rows = rows.withColumn("before", sum((F.when(F.contains(before, F.lit(f)), _bit(f)).otherwise(0) for f in FILTERS), F.lit(0)))
    rows = rows.withColumn("own", sum((F.when(own == f, _bit(f)).otherwise(0) for f in FILTERS), F.lit(0)))
    has = lambda m, bits: m.bitwiseAND(F.col(bits)) != 0
    here = lambda m: has(m, "own") & ~has(m, "before")
    shares = F.aggregate(F.transform("all", lambda n, m: F.when(has(m, "own"), n * (120 / F.bit_count(m)).cast("long")).otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "part", "filter_order", "step", _where("all", lambda m: ~has(m, "own") & ~has(m, "before")).alias("kept"), _where("all", here).alias("removed"), _where("all", lambda m: has(m, "own") & has(m, "before")).alias("redundant"),
        _where("all", lambda m: m == F.col("own")).alias("unique_fails"), _where("good", here).alias("good_lost"), _where("toxic", here).alias("toxic_lost"), shares.alias("shapley"),
    )


def op11_filter_audit(spark, sf_dir):
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: The same counts document by document.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
m AS (
  SELECT doc_id, part, CAST(len(ws) < 200 AS INT) AS a, CAST(100 * len(list_distinct(ws)) < 50 * len(ws) AS INT) AS b, CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT) AS c,
    CAST(regexp_matches(t, '[#$%&*|]') AS INT) AS d, CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS e FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
x AS (SELECT m.part, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, a + b + c + d + e AS k, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic FROM m LEFT JOIN l ON l.doc_id = m.doc_id),
y AS (SELECT part, MAP {'A': f.A, 'B': f.B, 'C': f.C, 'D': f.D, 'E': f.E} AS f, k, good, toxic, count(*) AS n FROM x GROUP BY ALL),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS s),
o AS (SELECT p.s || q.s || r.s || t.s || u.s AS filter_order FROM s p JOIN s q ON q.s <> p.s JOIN s r ON r.s NOT IN (p.s, q.s) JOIN s t ON t.s NOT IN (p.s, q.s, r.s) JOIN s u ON u.s NOT IN (p.s, q.s, r.s, t.s)),
g AS (SELECT filter_order, step, filter_order[step] AS own, list_transform(range(1, step), lambda i: filter_order[i]) AS before FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
z AS (SELECT y.*, g.filter_order, g.step, y.f[g.own] AS now, CAST(coalesce(list_max(list_transform(g.before, lambda b: y.f[b])), 0) AS INT) AS gone FROM y, g)
SELECT part, filter_order, step, CAST(sum(n * (1 - now) * (1 - gone)) AS BIGINT) AS kept, CAST(sum(n * now * (1 - gone)) AS BIGINT) AS removed, CAST(sum(n * now * gone) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN now = 1 AND k = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails, CAST(sum(CASE WHEN good THEN n * now * (1 - gone) ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN toxic THEN n * now * (1 - gone) ELSE 0 END) AS BIGINT) AS toxic_lost, CAST(sum(CASE WHEN now = 1 THEN n * (120 // k) ELSE 0 END) AS BIGINT) AS shapley
FROM z GROUP BY 1, 2, 3
"""
