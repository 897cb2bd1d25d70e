"""Tests between groups, permutations and enrichment, built from a few shared forms.

Each form registers relations under a name.  Rank tests count equal values first, so
one value that many rows share is one row, and need no rank of single rows.
"""

from collections.abc import Callable

from synonymy.operators.statistics import chi_square_tail, chi_square_tail_reference, erfc, every, hypergeometric, hypergeometric_reference
from synonymy.plans.relations import KEPT, on_spark, query, relation


class Reference:
    """Words of the reference SQL that Spark says otherwise."""

    tail = staticmethod(chi_square_tail_reference)
    hypergeometric = staticmethod(hypergeometric_reference)

    @staticmethod
    def number(words: str) -> str:
        return f"CAST(('0x' || substr(md5({words}), 1, 15)) AS BIGINT)"

    @staticmethod
    def every(lo: str, hi: str, columns: str, source: str) -> str:
        return f"SELECT {columns}, unnest(range({lo}, {hi} + 1)) AS i FROM {source} h"

    @staticmethod
    def vector(codon: str, x: str) -> str:
        return f"list({x} ORDER BY {codon})"

    @staticmethod
    def distance(x: str, y: str) -> str:
        return f"list_distance({x}, {y})"


class Spark:
    """The same words on Spark."""

    tail = staticmethod(chi_square_tail)
    hypergeometric = staticmethod(hypergeometric)
    every = staticmethod(every)

    @staticmethod
    def number(words: str) -> str:
        return f"CAST(conv(substr(md5({words}), 1, 15), 16, 10) AS BIGINT)"

    @staticmethod
    def vector(codon: str, x: str) -> str:
        return f"transform(array_sort(collect_list(struct({codon} AS k, {x} AS x))), e -> e.x)"

    @staticmethod
    def distance(x: str, y: str) -> str:
        return f"sqrt(aggregate(zip_with({x}, {y}, (p, q) -> (p - q) * (p - q)), 0e0, (s, t) -> s + t))"


def both(name: str, text: Callable) -> None:
    """A relation whose text differs by engine in a few words."""
    relation(name, text(Reference))
    on_spark(name, text(Spark))


def two_sample(name: str, source: str, least: int = 5) -> None:
    """item, g1, g2, n1, n2, u, m1, m2, delta, p: Mann-Whitney tests (exact for up to 8 values on both sides without ties, else by the normal law with tie correction), and Cliff's delta, of (item, g1, g2, first_one, v)."""
    relation(f"{name}_v", f"SELECT item, g1, g2, v, CAST(sum(first_one) AS DOUBLE) AS a, CAST(count(*) - sum(first_one) AS DOUBLE) AS b FROM {source} WHERE v IS NOT NULL GROUP BY item, g1, g2, v")
    relation(f"{name}_c", f"SELECT item, g1, g2, v, a, b, sum(b) OVER (PARTITION BY item, g1, g2 ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - b / 2 AS below FROM {name}_v")
    relation(f"{name}_u", f"SELECT item, g1, g2, sum(a) AS n1, sum(b) AS n2, sum(a * below) AS u, sum((a + b) * ((a + b) * (a + b) - 1)) AS tie, sum(a * v) / nullif(sum(a), 0) AS m1, sum(b * v) / nullif(sum(b), 0) AS m2 FROM {name}_c GROUP BY item, g1, g2")
    z = "greatest(abs(u - n1 * n2 / 2) - 5e-1, 0e0) / sqrt(2 * var)"
    relation(name, f"""SELECT item, g1, g2, n1, n2, u, m1, m2, 2 * u / (n1 * n2) - 1 AS delta, coalesce(e.p, CASE WHEN var > 0 THEN least(1e0, {erfc(z)}) END) AS p
  FROM (SELECT *, n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1))) AS var FROM {name}_u WHERE n1 >= {least} AND n2 >= {least}) x LEFT JOIN u_exact e ON e.small = least(x.n1, x.n2) AND e.large = greatest(x.n1, x.n2) AND e.far = greatest(x.u, x.n1 * x.n2 - x.u) AND x.tie = 0""")


def kruskal(name: str, source: str, least: int = 5, groups: int = 3) -> None:
    """item, n, k, h, p: Kruskal-Wallis tests with tie correction of (item, grp, v), groups of fewer than ``least`` values dropped first."""
    relation(f"{name}_v", f"SELECT item, grp, v, count(*) AS c FROM (SELECT item, grp, v, count(*) OVER (PARTITION BY item, grp) AS k FROM {source} WHERE v IS NOT NULL) x WHERE k >= {least} GROUP BY item, grp, v")
    relation(f"{name}_t", f"SELECT item, v, sum(c) AS c, sum(sum(c)) OVER (PARTITION BY item ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - (sum(c) - 1) / 2e0 AS rk FROM {name}_v GROUP BY item, v")
    relation(f"{name}_s", f"SELECT item, sum(CAST(n AS DOUBLE)) AS n, count(*) AS k, sum(s * s / n) AS ss FROM (SELECT x.item, x.grp, sum(x.c) AS n, sum(x.c * t.rk) AS s FROM {name}_v x JOIN {name}_t t ON t.item = x.item AND t.v = x.v GROUP BY x.item, x.grp) y GROUP BY item")
    relation(f"{name}_h", f"""SELECT s.item, s.n, s.k, CASE WHEN t.tie < s.n * s.n * s.n - s.n THEN (12 / (s.n * (s.n + 1)) * s.ss - 3 * (s.n + 1)) / (1 - t.tie / (s.n * s.n * s.n - s.n)) END AS h
  FROM {name}_s s JOIN (SELECT item, sum(CAST(c AS DOUBLE) * c * c - c) AS tie FROM {name}_t GROUP BY item) t ON t.item = s.item WHERE s.k >= {groups}""")
    both(name, lambda e: f"SELECT item, n, k, h, CASE WHEN h IS NOT NULL THEN {e.tail('h', '(k - 1)')} END AS p FROM {name}_h")


def fisher(name: str, source: str, keys: str) -> None:
    """keys, a, c, s, n, p: two-sided exact tests of a marked ones among c, where s of n are marked."""
    columns = ", ".join(f"h.{k.strip()}" for k in keys.split(",")) + ", h.a, h.c, h.s, h.n"
    both(f"{name}_terms", lambda e: f"SELECT {keys}, a, c, s, n, i, {e.hypergeometric('i', 'c', 's', 'n')} AS q, {e.hypergeometric('a', 'c', 's', 'n')} AS seen FROM ({e.every('greatest(0, h.c + h.s - h.n)', 'least(h.c, h.s)', columns, source)}) h")
    relation(name, f"SELECT {keys}, a, c, s, n, least(1e0, sum(CASE WHEN q <= seen * (1e0 + 1e-7) THEN q ELSE 0e0 END)) AS p FROM {name}_terms GROUP BY {keys}, a, c, s, n")


def adjusted(name: str, source: str, by: str = "", order: str = "item, g1, g2") -> None:
    """The source's rows with q: Benjamini-Hochberg over those with a p, within ``by``."""
    part = f"PARTITION BY {by}" if by else ""
    relation(name, f"""SELECT x.*, CASE WHEN p IS NOT NULL THEN least(1e0, min(p * m / r) OVER ({part} ORDER BY r DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS q
  FROM (SELECT y.*, row_number() OVER ({part} ORDER BY CASE WHEN p IS NULL THEN 1 ELSE 0 END, p, {order}) AS r, count(p) OVER ({part}) AS m FROM {source} y) x""")


# ---------------------------------------------------------------- tests between conditions
query("st06_batch_statistics", f"""SELECT grp AS aa, item AS codon, g1, g2, round(p, 6) AS p, round(qf, 6) AS q_family, round(qg, 6) AS q_global, qf < 1e-2 AS significant_family, qg < 1e-2 AS significant_global
  FROM (SELECT *, {"least(1e0, min(p * mf / rf) OVER (PARTITION BY grp ORDER BY rf DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"} AS qf, least(1e0, min(p * n_tests / r2) OVER (ORDER BY r2 DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS qg
  FROM (SELECT *, row_number() OVER (ORDER BY p, item, g1, g2) AS r2, count(*) OVER () AS n_tests FROM mwu_r WHERE grp <> 'metric') x) y""")
relation("pair_of_conds", "SELECT x.cond AS g1, y.cond AS g2 FROM conds x JOIN conds y ON x.cond < y.cond")

relation("class_gene", "SELECT 'reference' AS class, gene FROM refset UNION ALL SELECT 'high' AS class, gene FROM tier WHERE tier = 'high'")
relation("class_rscu", """SELECT class, sample_id, cond, codon, CAST(n * ffold AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY class, sample_id, family), 0) AS v
  FROM (SELECT m.class, g.sample_id, g.cond, g.codon, g.family, g.ffold, sum(g.n) AS n FROM grid g JOIN class_gene m ON m.gene = g.gene GROUP BY m.class, g.sample_id, g.cond, g.codon, g.family, g.ffold) x""")
relation("class_two", "SELECT s.class || ' ' || s.codon AS item, p.g1, p.g2, CASE WHEN s.cond = p.g1 THEN 1 ELSE 0 END AS first_one, round(s.v, 9) AS v FROM class_rscu s JOIN pair_of_conds p ON s.cond = p.g1 OR s.cond = p.g2")
two_sample("class_test", "class_two")
relation("class_split", "SELECT *, split_part(item, ' ', 1) AS class, split_part(item, ' ', 2) AS codon FROM class_test")
adjusted("class_q", "class_split", "class, g1, g2")
query("st19_class_rscu_between", """SELECT class, codon, g1, g2, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(ln((m2 + 1e-4) / (m1 + 1e-4)) / ln(2e0), 5) AS log2_fold, round(delta, 6) AS delta, round(p, 6) AS p, round(q, 6) AS q FROM class_q""")

relation("strand_sample", """SELECT p.codon AS item, p.cond AS grp, round(p.v - m.v, 9) AS v FROM (SELECT sample_id, cond, codon, avg(rscu) AS v FROM stranded WHERE strand = '+' GROUP BY sample_id, cond, codon) p
  JOIN (SELECT sample_id, codon, avg(rscu) AS v FROM stranded WHERE strand = '-' GROUP BY sample_id, codon) m ON m.sample_id = p.sample_id AND m.codon = p.codon""")
# Sources alternate with the parity of ids here, so a sample's strands come from a hash.
relation("stranded", "SELECT sample_id, cond, codon, CASE WHEN substr(md5(CAST(gene AS VARCHAR(20))), 1, 1) < '8' THEN '+' ELSE '-' END AS strand, rscu FROM rscu WHERE rscu IS NOT NULL")
relation("strand_two", "SELECT s.item, p.g1, p.g2, CASE WHEN s.grp = p.g1 THEN 1 ELSE 0 END AS first_one, s.v FROM strand_sample s JOIN pair_of_conds p ON s.grp = p.g1 OR s.grp = p.g2")
two_sample("strand_test", "strand_two")
kruskal("strand_kw", "strand_sample")
relation("strand_all", "SELECT 'mann_whitney' AS test, item, g1, g2, delta, p FROM strand_test UNION ALL SELECT 'kruskal_wallis' AS test, item, '' AS g1, '' AS g2, h AS delta, p FROM strand_kw")
adjusted("strand_q", "strand_all", "test")
query("st21_strand_patterns", "SELECT test, item AS codon, g1, g2, round(delta, 5) AS effect, round(p, 6) AS p, round(q, 6) AS q FROM strand_q")

relation("sample_delta", "SELECT r.sample_id, r.cond, r.aa, r.codon, avg(CASE WHEN t.tier = 'high' THEN r.rscu END) - avg(r.rscu) AS d FROM rscu r JOIN tier t ON t.gene = r.gene GROUP BY r.sample_id, r.cond, r.aa, r.codon")
relation("cond_delta", "SELECT k.codon, k.aa, c.cond, coalesce(d.d, 0e0) AS d FROM (SELECT codon, aa FROM codon_dim WHERE sense) k CROSS JOIN conds c LEFT JOIN (SELECT codon, cond, avg(d) AS d FROM sample_delta WHERE d IS NOT NULL GROUP BY codon, cond) d ON d.codon = k.codon AND d.cond = c.cond")
query("st22_optimal_codons_between", """SELECT aa, codon, count(CASE WHEN round(d, 9) > 0 THEN 1 END) AS n_conditions_optimal, count(CASE WHEN round(d, 9) > 0 THEN 1 END) IN (0, count(*)) AS unanimous, round(max(d) - min(d), 4) AS delta_difference,
  round(min(d), 6) AS least_delta, round(max(d), 6) AS greatest_delta FROM cond_delta GROUP BY aa, codon""")
query("st24_gc3_gc12", "SELECT gene, sample_id, cond, round(gc3, 6) AS gc3, round(gc12, 6) AS gc12 FROM gc WHERE gc3 IS NOT NULL AND gc12 IS NOT NULL")
relation("metric_two", "SELECT s.metric AS item, p.g1, p.g2, CASE WHEN s.cond = p.g1 THEN 1 ELSE 0 END AS first_one, s.v FROM sample_metric s JOIN pair_of_conds p ON s.cond = p.g1 OR s.cond = p.g2")
two_sample("metric_test", "metric_two")
relation("metric_by_cond", "SELECT metric AS item, cond AS grp, v FROM sample_metric")
kruskal("metric_kw", "metric_by_cond")
relation("metric_all", "SELECT 'mann_whitney' AS test, item, g1, g2, u AS statistic, delta, p FROM metric_test UNION ALL SELECT 'kruskal_wallis' AS test, item, '' AS g1, '' AS g2, h AS statistic, CAST(NULL AS DOUBLE) AS delta, p FROM metric_kw")
adjusted("metric_q", "metric_all", "", "test, item, g1, g2")
query("st16_between_conditions", "SELECT test, item AS metric, g1, g2, round(statistic, 5) AS statistic, round(delta, 6) AS delta, round(p, 6) AS p, round(q, 6) AS q, q < 5e-2 AS significant FROM metric_q")

# ---------------------------------------------------------------- tests within a genome's genes
relation("tier_cpb", "SELECT 'cpb' AS item, 'high' AS g1, 'low' AS g2, CASE WHEN t.tier = 'high' THEN 1 ELSE 0 END AS first_one, round(c.cpb, 9) AS v FROM cpb c JOIN tier t ON t.gene = c.gene WHERE t.tier IN ('high', 'low')")
two_sample("cpb_test", "tier_cpb")
query("st15_cpb_by_tier", "SELECT CAST(n1 AS BIGINT) AS n_high, CAST(n2 AS BIGINT) AS n_low, round(m1, 6) AS mean_high, round(m2, 6) AS mean_low, round(u, 4) AS u, round(delta, 6) AS delta, round(p, 6) AS p FROM cpb_test")

# Tiers of three metrics, each by its own percentiles.
relation("score_long", "SELECT gene, 'CAI' AS metric, cai AS v FROM scores UNION ALL SELECT gene, 'Fop' AS metric, fop AS v FROM scores UNION ALL SELECT gene, 'MELP' AS metric, round(melp, 9) AS v FROM melp WHERE melp IS NOT NULL")
relation("score_cut", "SELECT metric, percentile(v, 0.1) AS lo, percentile(v, 0.9) AS hi, min(v) AS least, count(*) AS n FROM score_long GROUP BY metric")
relation("score_floor", "SELECT s.metric, count(*) AS ties FROM score_long s JOIN score_cut c ON c.metric = s.metric AND s.v = c.lo AND c.lo = c.least GROUP BY s.metric")
relation("floor_kept", """SELECT metric, gene FROM (SELECT s.metric, s.gene, c.n, f.ties, row_number() OVER (PARTITION BY s.metric ORDER BY s.gene) AS nth FROM score_long s JOIN score_cut c ON c.metric = s.metric AND s.v = c.lo JOIN score_floor f ON f.metric = s.metric) x WHERE ties > 0.1e0 * n AND nth > ceil(0.1e0 * n)""")
relation("tiers", """SELECT s.gene, s.metric, s.v, CASE WHEN c.lo = c.hi THEN 'medium' WHEN k.gene IS NOT NULL THEN 'low_floor' WHEN s.v <= c.lo THEN 'low' WHEN s.v >= c.hi THEN 'high' ELSE 'medium' END AS tier
  FROM score_long s JOIN score_cut c ON c.metric = s.metric LEFT JOIN floor_kept k ON k.metric = s.metric AND k.gene = s.gene""")
# The metric whose tiers count: the first of MELP, CAI and Fop that has a high and a low one; MELP if none has.
relation("tier_choice", """SELECT CASE WHEN count(DISTINCT CASE WHEN metric = 'MELP' THEN tier END) = 2 THEN 'MELP' WHEN count(DISTINCT CASE WHEN metric = 'CAI' THEN tier END) = 2 THEN 'CAI' WHEN count(DISTINCT CASE WHEN metric = 'Fop' THEN tier END) = 2 THEN 'Fop' ELSE 'MELP' END AS metric
  FROM tiers WHERE tier IN ('high', 'low')""")
query("ag23_expression_table", """SELECT gene, round(max(CASE WHEN t.metric = 'CAI' THEN v END), 6) AS cai, max(CASE WHEN t.metric = 'CAI' THEN tier END) AS cai_class, round(max(CASE WHEN t.metric = 'Fop' THEN v END), 6) AS fop, max(CASE WHEN t.metric = 'Fop' THEN tier END) AS fop_class,
  round(max(CASE WHEN t.metric = 'MELP' THEN v END), 6) AS melp, max(CASE WHEN t.metric = 'MELP' THEN tier END) AS melp_class, coalesce(max(CASE WHEN t.metric = c.metric THEN tier END), 'unknown') AS expression_class FROM tiers t CROSS JOIN tier_choice c GROUP BY gene""")
relation("tier_goi", """SELECT t.metric, k.tier, count(CASE WHEN t.tier = k.tier AND g.gene IS NOT NULL THEN 1 END) AS a, count(CASE WHEN t.tier = k.tier THEN 1 END) AS c, count(g.gene) AS s, count(*) AS n
  FROM tiers t CROSS JOIN (SELECT 'high' AS tier UNION ALL SELECT 'medium' AS tier UNION ALL SELECT 'low' AS tier) k LEFT JOIN goi g ON g.gene = t.gene GROUP BY t.metric, k.tier""")
relation("tier_goi_known", "SELECT * FROM tier_goi WHERE s >= 5 AND n - s >= 30")
fisher("tier_fisher", "tier_goi_known", "metric, tier")
adjusted("tier_q", "tier_fisher", "", "metric, tier")
query("st26_tier_breakdown", "SELECT metric, tier, a AS n_goi, c - a AS n_background, round(CAST(a AS DOUBLE) / s, 6) AS share_goi, round(CAST(c - a AS DOUBLE) / (n - s), 6) AS share_background, round(p, 6) AS p, round(q, 6) AS q FROM tier_q")

relation("codon_two", "SELECT r.codon AS item, 'goi' AS g1, 'rest' AS g2, CASE WHEN g.gene IS NULL THEN 0 ELSE 1 END AS first_one, round(r.rscu, 9) AS v FROM rscu r LEFT JOIN goi g ON g.gene = r.gene WHERE r.rscu IS NOT NULL")
two_sample("codon_test", "codon_two")
relation("codon_refs", "SELECT s.gene_set AS reference, t.item, t.g1, t.g2, t.n1, t.n2, t.m1, t.m2, t.delta, t.p, t.m1 - s.rscu AS off FROM codon_test t JOIN set_rscu s ON s.codon = t.item")
adjusted("codon_refs_q", "codon_refs", "", "reference, item")
query("st28_codon_references", "SELECT reference, item AS codon, CAST(n1 AS BIGINT) AS n_goi, CAST(n2 AS BIGINT) AS n_background, round(m1, 6) AS mean_goi, round(m2, 6) AS mean_background, round(off, 6) AS delta_to_reference, round(delta, 6) AS delta, round(p, 6) AS p, round(q, 6) AS q FROM codon_refs_q")

relation("parts", "SELECT s.gene, s.is_goi, CASE WHEN r.gene IS NOT NULL THEN 'cluster' WHEN f.flag THEN 'outlier' ELSE 'bulk' END AS part FROM split s LEFT JOIN refset r ON r.gene = s.gene LEFT JOIN foreign_gene f ON f.gene = s.gene")
relation("part_n", "SELECT part, sum(is_goi) AS a, count(*) AS c, sum(sum(is_goi)) OVER () AS s, sum(count(*)) OVER () AS n FROM parts GROUP BY part")
relation("part_fit", "SELECT part, CAST(a AS BIGINT) AS a, CAST(c AS BIGINT) AS c, CAST(s AS BIGINT) AS s, CAST(n AS BIGINT) AS n FROM part_n WHERE s > 0 AND s < n")
fisher("part_fisher", "part_fit", "part")
adjusted("part_q", "part_fisher", "", "part")
relation("part_chi", "SELECT count(*) AS k, max(s) AS s, max(n) AS n, sum(pow(a - CAST(c AS DOUBLE) * s / n, 2) / (CAST(c AS DOUBLE) * s / n) + pow((c - a) - CAST(c AS DOUBLE) * (n - s) / n, 2) / (CAST(c AS DOUBLE) * (n - s) / n)) AS x FROM part_fit")
both("part_omnibus", lambda e: f"SELECT s, n, sqrt(x / n) AS v, {e.tail('x', '(k - 1)')} AS p FROM part_chi WHERE k >= 3")
query("st29_partition_enrichment", """SELECT part AS category, a AS n_goi, c - a AS n_background, round(CAST(a AS DOUBLE) / s, 6) AS share_goi, round(CAST(c - a AS DOUBLE) / (n - s), 6) AS share_background, round(CAST(a AS DOUBLE) * ((n - s) - (c - a)) / nullif(CAST(s - a AS DOUBLE) * (c - a), 0), 6) AS odds_ratio, round(p, 6) AS p, round(q, 6) AS q FROM part_q
  UNION ALL SELECT 'OMNIBUS' AS category, s AS n_goi, n - s AS n_background, 1e0 AS share_goi, 1e0 AS share_background, round(v, 6) AS odds_ratio, round(p, 6) AS p, round(p, 6) AS q FROM part_omnibus""")

# Tiers against condition and against genome: chi-square with p, and its adjustment.
relation("cell", "SELECT 'condition' AS item, cond AS grp, tier, count(*) AS o FROM tier GROUP BY cond, tier UNION ALL SELECT 'genome' AS item, genome AS grp, tier, count(*) AS o FROM tier GROUP BY genome, tier")
relation("cell_chi", """SELECT item, sum(o) AS n, sum(CAST(o AS DOUBLE) * o / (CAST(g AS DOUBLE) * t)) AS s, count(DISTINCT grp) AS rows_, count(DISTINCT tier) AS cols_
  FROM (SELECT item, grp, tier, o, sum(o) OVER (PARTITION BY item, grp) AS g, sum(o) OVER (PARTITION BY item, tier) AS t FROM cell) x GROUP BY item""")
relation("cell_x", "SELECT item, CAST(n AS BIGINT) AS n, n * (s - 1) AS x, (rows_ - 1) * (cols_ - 1) AS df, least(rows_, cols_) - 1 AS k FROM cell_chi WHERE n >= 10 AND rows_ >= 2 AND cols_ >= 2")
both("cell_p", lambda e: f"SELECT item, n, x, df, sqrt(x / n / k) AS v, {e.tail('x', 'df')} AS p FROM cell_x WHERE df >= 2")
adjusted("cell_q", "cell_p", "", "item")
query("st34_contingency", "SELECT item, n, round(x, 5) AS chi2, CAST(df AS BIGINT) AS df, round(v, 6) AS cramers_v, round(p, 6) AS p, round(q, 6) AS q FROM cell_q")

# Spearman correlation of codon usage and decoding capacity, for all, high and low genes.
relation("class_mean", """SELECT class, codon, avg(rscu) AS v FROM (SELECT 'all' AS class, codon, rscu FROM rscu UNION ALL SELECT t.tier AS class, r.codon, r.rscu FROM rscu r JOIN tier t ON t.gene = r.gene WHERE t.tier IN ('high', 'low')) x WHERE rscu IS NOT NULL GROUP BY class, codon""")
relation("class_decoded", "SELECT m.class, round(coalesce(t.effective, 0e0), 9) AS e, round(m.v, 9) AS v FROM class_mean m LEFT JOIN trna_codon t ON t.codon = m.codon")
query("st13_trna_by_class", """SELECT class, count(*) AS n_codons, round(corr(a, b), 6) AS rho FROM (SELECT class, rank() OVER (PARTITION BY class ORDER BY e) + (count(*) OVER (PARTITION BY class, e) - 1) / 2e0 AS a, rank() OVER (PARTITION BY class ORDER BY v) + (count(*) OVER (PARTITION BY class, v) - 1) / 2e0 AS b FROM class_decoded) x GROUP BY class HAVING count(*) >= 6""")

# Strand tests adjusted over codons.
relation("strand_pair", "SELECT codon AS item, aa AS g1, '' AS g2, CASE WHEN strand = '+' THEN 1 ELSE 0 END AS first_one, v FROM by_strand")
two_sample("strand_codon", "strand_pair", 2)
adjusted("strand_codon_q", "strand_codon")
query("be04_strand_adjusted", "SELECT item AS codon, g1 AS aa, CAST(n1 AS BIGINT) AS n_plus, CAST(n2 AS BIGINT) AS n_minus, round(m1, 6) AS mean_plus, round(m2, 6) AS mean_minus, round(p, 6) AS p, round(q, 6) AS q, greatest(n1, n2) / least(n1, n2) > 3 AS imbalanced FROM strand_codon_q")

# ---------------------------------------------------------------- pathways of tier genes
relation("gene_ko", "SELECT DISTINCT p_partkey AS gene, p_type AS ko, p_brand AS pathway FROM part")
relation("annotated", "SELECT t.metric, t.tier, k.ko, k.pathway FROM tiers t JOIN gene_ko k ON k.gene = t.gene")
relation("slice", "SELECT metric, tier, count(DISTINCT ko) AS s FROM annotated WHERE tier IN ('high', 'low') GROUP BY metric, tier HAVING count(DISTINCT ko) >= 2")
relation("path_n", "SELECT metric, pathway, count(DISTINCT ko) AS c FROM annotated GROUP BY metric, pathway HAVING count(DISTINCT ko) >= 3")
relation("universe", "SELECT metric, count(DISTINCT ko) AS n FROM annotated GROUP BY metric")
relation("path_k", "SELECT metric, tier, pathway, count(DISTINCT ko) AS a FROM annotated GROUP BY metric, tier, pathway")
relation("path_slice", "SELECT s.metric, s.tier, p.pathway, coalesce(k.a, 0) AS a, p.c, s.s, u.n FROM slice s JOIN path_n p ON p.metric = s.metric JOIN universe u ON u.metric = s.metric LEFT JOIN path_k k ON k.metric = s.metric AND k.tier = s.tier AND k.pathway = p.pathway")
both("path_terms", lambda e: f"SELECT metric, tier, pathway, a, c, s, n, sum({e.hypergeometric('i', 'c', 's', 'n')}) AS p FROM ({e.every('greatest(h.a, h.c + h.s - h.n)', 'least(h.c, h.s)', 'h.metric, h.tier, h.pathway, h.a, h.c, h.s, h.n', 'path_slice')}) h GROUP BY metric, tier, pathway, a, c, s, n")
adjusted("path_q", "path_terms", "metric, tier", "pathway")
query("st08_tier_enrichment", "SELECT metric, tier, pathway, a AS k, c AS n, s AS n_test, n AS n_universe, round(least(100e0, a / (CAST(c AS DOUBLE) * s / n)), 5) AS fold, round(least(1e0, p), 6) AS p, round(q, 6) AS q, q <= 5e-2 AS significant FROM path_q")
query("fg06_enrichment_dots", "SELECT metric, tier, pathway, round(CAST(a AS DOUBLE) / s, 6) AS gene_ratio, round(-ln(greatest(q, 1e-300)) / ln(10e0), 5) AS minus_log10_q FROM (SELECT *, row_number() OVER (PARTITION BY metric, tier ORDER BY q, p, pathway) AS nth FROM path_q) x WHERE nth <= 30")

# In how many samples of each condition a pathway is enriched among genes of high adaptation.
relation("sample_ko", "SELECT g.sample_id, g.cond, t.tier, k.ko, k.pathway FROM tier t JOIN genes g ON g.gene = t.gene JOIN gene_ko k ON k.gene = t.gene")
relation("sample_slice", """SELECT p.sample_id, p.cond, p.pathway, p.a, p.c, u.s, u.n FROM (SELECT sample_id, cond, pathway, count(DISTINCT CASE WHEN tier = 'high' THEN ko END) AS a, count(DISTINCT ko) AS c FROM sample_ko GROUP BY sample_id, cond, pathway) p
  JOIN (SELECT sample_id, count(DISTINCT CASE WHEN tier = 'high' THEN ko END) AS s, count(DISTINCT ko) AS n FROM sample_ko GROUP BY sample_id) u ON u.sample_id = p.sample_id WHERE u.s > 0""")
both("sample_terms", lambda e: f"SELECT sample_id, cond, pathway, sum({e.hypergeometric('i', 'c', 's', 'n')}) AS p FROM ({e.every('greatest(h.a, h.c + h.s - h.n)', 'least(h.c, h.s)', 'h.sample_id, h.cond, h.pathway, h.a, h.c, h.s, h.n', 'sample_slice')}) h GROUP BY sample_id, cond, pathway, a, c, s, n")
adjusted("sample_path", "sample_terms", "sample_id", "pathway")
relation("cond_path", "SELECT pathway AS item, cond AS grp, count(CASE WHEN q <= 5e-2 THEN 1 END) AS a, count(*) AS c FROM sample_path GROUP BY pathway, cond")
relation("cond_path_pair", "SELECT x.item, x.grp AS g1, y.grp AS g2, x.a, x.c, x.a + y.a AS s, x.c + y.c AS n FROM cond_path x JOIN cond_path y ON y.item = x.item AND x.grp < y.grp")
fisher("cond_path_fisher", "cond_path_pair", "item, g1, g2")
relation("cond_path_chi", """SELECT item, k, CASE WHEN s > 0 AND s < n THEN x END AS x FROM (SELECT item, count(*) AS k, max(s) AS s, max(n) AS n, sum(pow(a - c * (s / n), 2) / nullif(c * (s / n), 0) + pow((c - a) - c * (1 - s / n), 2) / nullif(c * (1 - s / n), 0)) AS x
  FROM (SELECT item, grp, CAST(a AS DOUBLE) AS a, CAST(c AS DOUBLE) AS c, CAST(sum(a) OVER (PARTITION BY item) AS DOUBLE) AS s, CAST(sum(c) OVER (PARTITION BY item) AS DOUBLE) AS n FROM cond_path) z GROUP BY item) y WHERE k >= 3""")
both("cond_path_omnibus", lambda e: f"SELECT item, x, CASE WHEN x IS NOT NULL THEN {e.tail('x', '(k - 1)')} END AS p FROM cond_path_chi")
relation("cond_path_all", "SELECT 'chi_square' AS test, item, '' AS g1, '' AS g2, x AS statistic, p FROM cond_path_omnibus UNION ALL SELECT 'fisher' AS test, item, g1, g2, CAST(a AS DOUBLE) AS statistic, p FROM cond_path_fisher")
adjusted("cond_path_q", "cond_path_all", "", "test, item, g1, g2")
query("st20_pathways_between", "SELECT test, item AS pathway, g1, g2, round(statistic, 5) AS statistic, round(p, 6) AS p, round(q, 6) AS q FROM cond_path_q")

# ---------------------------------------------------------------- resampling
relation("seeds", "SELECT CAST(i AS BIGINT) AS i FROM range(0, 1000) AS t(i)")
# Percentile intervals of the reference genes' mean adaptation, by 1000 resamples of each genome's.
relation("ref_cai", "SELECT s.genome, s.gene, round(s.cai, 9) AS v, row_number() OVER (PARTITION BY s.genome ORDER BY s.gene) AS k, count(*) OVER (PARTITION BY s.genome) AS n FROM scores s JOIN refset r ON r.gene = s.gene")
both("ref_draw", lambda e: f"SELECT t.i, c.genome, {e.number("t.i || '-' || c.genome || '-' || c.k")} % c.n + 1 AS k FROM ref_cai c CROSS JOIN seeds t WHERE c.n >= 3")
relation("ref_means", "SELECT d.i, d.genome, avg(c.v) AS m FROM ref_draw d JOIN ref_cai c ON c.genome = d.genome AND c.k = d.k GROUP BY d.i, d.genome")
query("rs09_growth_interval", """SELECT genome, round(percentile(m, 0.025), 6) AS cai_lo, round(percentile(m, 0.975), 6) AS cai_hi, round(exp(7.15e0 - 7.38e0 * percentile(m, 0.975)), 6) AS hours_lo, round(exp(7.15e0 - 7.38e0 * percentile(m, 0.025)), 6) AS hours_hi FROM ref_means GROUP BY genome""")

# Cliff's delta of genes of interest against the rest: percentile interval of 500 resamples of both.
relation("boots", "SELECT CAST(i AS BIGINT) AS i FROM range(0, 500) AS t(i)")
relation("goi_values", "SELECT m.metric, s.is_goi, round(m.v, 9) AS v, row_number() OVER (PARTITION BY m.metric, s.is_goi ORDER BY m.gene) AS k, count(*) OVER (PARTITION BY m.metric, s.is_goi) AS n FROM metric m JOIN split s ON s.gene = m.gene WHERE m.v IS NOT NULL")
both("goi_draw", lambda e: f"SELECT t.i, c.metric, c.is_goi, {e.number("t.i || '-' || c.metric || '-' || c.is_goi || '-' || c.k")} % c.n + 1 AS k FROM goi_values c CROSS JOIN boots t WHERE c.n >= 3")
relation("goi_boot", "SELECT c.metric AS item, CAST(d.i AS VARCHAR(20)) AS g1, '' AS g2, d.is_goi AS first_one, c.v FROM goi_draw d JOIN goi_values c ON c.metric = d.metric AND c.is_goi = d.is_goi AND c.k = d.k")
two_sample("goi_boot_test", "goi_boot", 1)
relation("goi_now", "SELECT metric AS item, 'goi' AS g1, 'rest' AS g2, is_goi AS first_one, v FROM goi_values")
two_sample("goi_test", "goi_now")
query("st27_scalar_tests", """SELECT t.item AS metric, CAST(t.n1 AS BIGINT) AS n_goi, CAST(t.n2 AS BIGINT) AS n_background, round(t.u, 4) AS u, round(t.p, 6) AS p, round(t.delta, 6) AS delta, b.delta_lo, b.delta_hi
  FROM goi_test t JOIN (SELECT item, round(percentile(delta, 0.025), 6) AS delta_lo, round(percentile(delta, 0.975), 6) AS delta_hi FROM goi_boot_test GROUP BY item) b ON b.item = t.item""")

# Distance of the genes of interest to each reference against 999 matched draws, in log-ratio space.
relation("indep_rscu", "SELECT gene, codon, rscu FROM rscu WHERE indep AND rscu IS NOT NULL")
relation("draw_mean", """SELECT i, codon, ln(greatest(m, 1e-6)) - avg(ln(greatest(m, 1e-6))) OVER (PARTITION BY i) AS x FROM (SELECT t.i, d.codon, coalesce(z.m, 0e0) AS m FROM (SELECT -1 AS i UNION ALL SELECT i FROM iters) t CROSS JOIN (SELECT codon FROM codon_dim WHERE indep) d
  LEFT JOIN (SELECT i, codon, avg(rscu) AS m FROM drawn_or_goi g JOIN indep_rscu r ON r.gene = g.gene GROUP BY i, codon) z ON z.i = t.i AND z.codon = d.codon) y""")
relation("drawn_or_goi", "SELECT i, gene FROM drawn UNION ALL SELECT -1 AS i, gene FROM binned WHERE is_goi = 1")
relation("draw_distance", "SELECT d.i, s.gene_set, round(sqrt(sum(pow(d.x - s.x, 2))), 9) AS dist FROM draw_mean d JOIN set_clr s ON s.codon = d.codon GROUP BY d.i, s.gene_set")
query("rs05_aitchison_permutation", """SELECT reference, observed, perm_mean, perm_median, perm_sd, p_more, p_less, least(1e0, 2 * least(p_more, p_less)) AS p FROM (SELECT o.gene_set AS reference, round(max(o.dist), 5) AS observed, round(avg(d.dist), 5) AS perm_mean, round(percentile(d.dist, 0.5), 5) AS perm_median, round(stddev_samp(d.dist), 5) AS perm_sd,
  round((1e0 + count(CASE WHEN d.dist >= o.dist THEN 1 END)) / (1e0 + count(*)), 6) AS p_more, round((1e0 + count(CASE WHEN d.dist <= o.dist THEN 1 END)) / (1e0 + count(*)), 6) AS p_less
  FROM draw_distance o JOIN draw_distance d ON d.gene_set = o.gene_set AND d.i >= 0 WHERE o.i = -1 GROUP BY o.gene_set) x""")
# Membership of the reference set among genes of interest, two-sided.
relation("ref_flag", "SELECT b.gene, b.is_goi, CASE WHEN r.gene IS NULL THEN 0e0 ELSE 1e0 END AS flag FROM binned b LEFT JOIN refset r ON r.gene = b.gene")
relation("ref_rate", "SELECT d.i, round(avg(f.flag), 9) AS m FROM drawn d JOIN ref_flag f ON f.gene = d.gene GROUP BY d.i")
query("rs07_membership_permutation", """SELECT observed, null_mean, p_more, p_less, least(1e0, 2 * least(p_more, p_less)) AS p FROM (SELECT round(o.m, 6) AS observed, round(avg(d.m), 6) AS null_mean, round((1e0 + count(CASE WHEN d.m >= o.m THEN 1 END)) / (1e0 + count(*)), 6) AS p_more, round((1e0 + count(CASE WHEN d.m <= o.m THEN 1 END)) / (1e0 + count(*)), 6) AS p_less
  FROM ref_rate d CROSS JOIN (SELECT round(avg(flag), 9) AS m FROM ref_flag WHERE is_goi = 1) o GROUP BY o.m) x""")

# Neighbours on a strand against 1000 random orders of their genome's genes.
relation("gene_vector", f"SELECT gene, genome, {Reference.vector('codon', 'coalesce(rscu, 0e0)')} AS xs FROM rscu GROUP BY gene, genome")
on_spark("gene_vector", "SELECT gene, genome, xs FROM gene_codons")
relation("shuffled", "SELECT genome, gene AS gene1, lead(gene) OVER (PARTITION BY i, genome ORDER BY md5(CAST(i AS VARCHAR(20)) || '-' || CAST(gene AS VARCHAR(20))), gene) AS gene2 FROM genes CROSS JOIN seeds")
both("null_distance", lambda e: f"SELECT s.genome, round({e.distance('x.xs', 'y.xs')}, 9) AS d FROM shuffled s JOIN gene_vector x ON x.gene = s.gene1 JOIN gene_vector y ON y.gene = s.gene2 WHERE s.gene2 IS NOT NULL")
both("near_distance", lambda e: f"SELECT a.genome, a.strand, a.gene1, a.gene2, a.gap, round({e.distance('x.xs', 'y.xs')}, 9) AS d FROM adjacent a JOIN gene_vector x ON x.gene = a.gene1 JOIN gene_vector y ON y.gene = a.gene2")
relation("null_count", "SELECT genome, d, count(*) AS c, 0 AS seen FROM null_distance GROUP BY genome, d UNION ALL SELECT DISTINCT genome, d, 0 AS c, 1 AS seen FROM near_distance")
relation("null_share", "SELECT genome, d, seen, (1e0 + sum(c) OVER (PARTITION BY genome ORDER BY d RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / (1e0 + sum(c) OVER (PARTITION BY genome)) AS p FROM null_count")
relation("near_p", "SELECT n.genome, n.strand, n.gene1, n.gene2, n.gap, n.d, s.p FROM near_distance n JOIN null_share s ON s.genome = n.genome AND s.d = n.d AND s.seen = 1")
adjusted("near_q", "near_p", "", "gene1, gene2")
query("rs08_operon_null", "SELECT genome, strand, gene1, gene2, CAST(gap AS BIGINT) AS intergenic_bp, round(d, 6) AS rscu_distance, round(p, 6) AS p, round(q, 6) AS q, q < 5e-2 AS same_operon FROM near_q")

# Mantel test: genomes' names permuted by md5, two-sided.
relation("genome_name", "SELECT genome, row_number() OVER (ORDER BY genome) AS k FROM genome_gc")
relation("genome_swap", "SELECT t.i, a.genome, b.genome AS other FROM (SELECT t.i, g.genome, row_number() OVER (PARTITION BY t.i ORDER BY md5(CAST(t.i AS VARCHAR(20)) || '-' || g.genome), g.genome) AS k FROM genome_gc g CROSS JOIN iters t) a JOIN genome_name b ON b.k = a.k JOIN iters t ON t.i = a.i")
relation("dist_all", "SELECT x, y, d1, d2 FROM dist2 UNION ALL SELECT y AS x, x AS y, d1, d2 FROM dist2")
relation("mantel_null", "SELECT a.i, round(corr(d.d1, e.d2), 9) AS r FROM dist2 d JOIN genome_swap a ON a.genome = d.x JOIN genome_swap b ON b.i = a.i AND b.genome = d.y JOIN dist_all e ON e.x = a.other AND e.y = b.other GROUP BY a.i")
query("st33_mantel_test", "SELECT o.n_genomes, round(o.r, 6) AS r, round((1e0 + count(CASE WHEN abs(m.r) >= abs(o.r) THEN 1 END)) / (1e0 + count(*)), 6) AS p FROM mantel_null m CROSS JOIN (SELECT round(corr(d1, d2), 9) AS r, (SELECT count(*) FROM genome_gc) AS n_genomes FROM dist2) o WHERE o.n_genomes >= 4 AND o.r IS NOT NULL GROUP BY o.n_genomes, o.r")

# ---------------------------------------------------------------- preranked enrichment
#: The sizes of sets that are tested. The sets are genomes, which grow with the tables, so no upper bound holds for them.
LEAST_SET, MOST_SET = 5, None
relation("gsets", f"SELECT genome AS gene_set, count(*) AS size, sum(w) AS sw FROM ranked GROUP BY genome HAVING count(*) >= {LEAST_SET}{f' AND count(*) <= {MOST_SET}' if MOST_SET else ''}")


def walk(name: str, source: str, keys: str) -> None:
    """keys, es, peak: the extreme of the running sum of (keys, r, w, n), from the hits alone: between two of them it only falls."""
    relation(f"{name}_k", f"SELECT {keys}, r, w, n, row_number() OVER (PARTITION BY {keys} ORDER BY r) AS k, count(*) OVER (PARTITION BY {keys}) AS size, sum(w) OVER (PARTITION BY {keys} ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS up, sum(w) OVER (PARTITION BY {keys}) AS sw FROM {source}")
    relation(f"{name}_p", f"SELECT {keys}, k, size, round(up / sw - CAST(r - k AS DOUBLE) / (n - size), 9) AS after, round((up - w) / sw - CAST(r - k AS DOUBLE) / (n - size), 9) AS before FROM {name}_k WHERE n > size")
    relation(f"{name}_e", f"SELECT {keys}, size, greatest(0e0, max(after)) AS hi, least(0e0, min(before)) AS lo FROM {name}_p GROUP BY {keys}, size")
    relation(name, f"SELECT {keys}, size, CASE WHEN hi >= -lo THEN hi ELSE lo END AS es FROM {name}_e")


relation("set_hits", "SELECT s.gene_set, r.r, r.w, r.n FROM gsets s JOIN ranked r ON r.genome = s.gene_set")
walk("set_es", "set_hits", "gene_set")
query("rs10_enrichment_score", "SELECT gene_set, CAST(size AS BIGINT) AS size, round(es, 6) AS es FROM set_es")
relation("set_plan", "SELECT gene_set, size, n, CAST(ceil(1.3e0 * n * ln(CAST(n AS DOUBLE) / (n - size))) + 60 AS BIGINT) AS tries FROM (SELECT s.gene_set, s.size, max(r.n) AS n FROM gsets s JOIN ranked r ON r.genome = s.gene_set GROUP BY s.gene_set, s.size) x WHERE n > size")
both("set_tries", lambda e: f"SELECT t.i AS perm, p.gene_set, p.size, p.n, {e.number("t.i || '-' || p.gene_set || '-' || p.i")} % p.n + 1 AS r, p.i AS nth FROM ({e.every('1', 'h.tries', 'h.gene_set, h.size, h.n', 'set_plan')}) p CROSS JOIN seeds t")
relation("set_drawn", "SELECT perm, gene_set, r, n FROM (SELECT perm, gene_set, size, n, r, row_number() OVER (PARTITION BY perm, gene_set ORDER BY nth) AS k FROM (SELECT perm, gene_set, size, n, r, min(nth) AS nth FROM set_tries GROUP BY perm, gene_set, size, n, r) x) y WHERE k <= size")
relation("null_hits", "SELECT d.perm, d.gene_set, d.r, k.w, d.n FROM set_drawn d JOIN ranked k ON k.r = d.r")
walk("null_es", "null_hits", "perm, gene_set")
relation("null_mean", "SELECT gene_set, count(*) AS n_perm, avg(CASE WHEN es >= 0 THEN es END) AS up, avg(CASE WHEN es < 0 THEN -es END) AS down FROM null_es GROUP BY gene_set")
relation("set_nes", "SELECT s.gene_set, s.size, s.es, round(CASE WHEN s.es >= 0 THEN s.es / nullif(m.up, 0) ELSE s.es / nullif(m.down, 0) END, 4) AS nes, m.n_perm FROM set_es s JOIN null_mean m ON m.gene_set = s.gene_set")
relation("null_nes", "SELECT n.gene_set, n.es, round(CASE WHEN n.es >= 0 THEN n.es / nullif(m.up, 0) ELSE n.es / nullif(m.down, 0) END, 6) AS nes FROM null_es n JOIN null_mean m ON m.gene_set = n.gene_set")
relation("set_p", "SELECT s.gene_set, round((1e0 + count(CASE WHEN (s.es >= 0 AND n.es >= s.es) OR (s.es < 0 AND n.es <= s.es) THEN 1 END)) / (1e0 + count(*)), 6) AS p FROM set_nes s JOIN null_es n ON n.gene_set = s.gene_set GROUP BY s.gene_set")
# Tails of the pooled null and of the observed scores, by sign.
relation("null_steps", "SELECT CASE WHEN nes >= 0 THEN 1 ELSE -1 END AS side, abs(nes) AS x, count(*) AS c, 0 AS o FROM null_nes WHERE nes IS NOT NULL GROUP BY CASE WHEN nes >= 0 THEN 1 ELSE -1 END, abs(nes) UNION ALL SELECT CASE WHEN nes >= 0 THEN 1 ELSE -1 END AS side, abs(nes) AS x, 0 AS c, count(*) AS o FROM set_nes WHERE nes IS NOT NULL GROUP BY CASE WHEN nes >= 0 THEN 1 ELSE -1 END, abs(nes)")
relation("null_tail", "SELECT DISTINCT side, x, CAST(sum(c) OVER w AS DOUBLE) / nullif(sum(c) OVER (PARTITION BY side), 0) AS nulls, CAST(sum(o) OVER w AS DOUBLE) / nullif(sum(o) OVER (PARTITION BY side), 0) AS seen FROM null_steps WINDOW w AS (PARTITION BY side ORDER BY x DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
relation("set_edge", "SELECT p.gene_set, min(CASE WHEN e.hi >= -e.lo AND p.after = e.hi THEN p.k WHEN e.hi < -e.lo AND p.before = e.lo THEN p.k - 1 END) AS edge FROM set_es_p p JOIN set_es_e e ON e.gene_set = p.gene_set GROUP BY p.gene_set")
query("rs11_preranked_gsea", """SELECT s.gene_set, CAST(s.size AS BIGINT) AS size, round(s.es, 6) AS es, s.nes, p.p, round(coalesce(least(1e0, t.nulls / nullif(t.seen, 0)), 1e0), 6) AS fdr, CAST(coalesce(g.edge, 0) AS BIGINT) AS leading_edge_size
  FROM set_nes s JOIN set_p p ON p.gene_set = s.gene_set LEFT JOIN null_tail t ON t.side = CASE WHEN s.nes >= 0 THEN 1 ELSE -1 END AND t.x = abs(s.nes) LEFT JOIN set_edge g ON g.gene_set = s.gene_set""")
query("fg17_top_sets", "SELECT gene_set, nes, rank FROM (SELECT gene_set, nes, row_number() OVER (ORDER BY abs(nes) DESC, gene_set) AS rank FROM set_nes WHERE nes IS NOT NULL) x WHERE rank <= 20")

# ---------------------------------------------------------------- a third reference frame: genes of high adaptation
relation("high_rscu", """SELECT codon, aa, family, fold, n, rscu, rscu / nullif(max(rscu) OVER (PARTITION BY family), 0) AS w FROM (SELECT codon, aa, family, fold, n, CAST(n * ffold AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY family), 0) AS rscu
  FROM (SELECT g.codon, g.aa, g.family, g.fold, g.ffold, sum(g.n) AS n FROM grid g JOIN tier t ON t.gene = g.gene AND t.tier = 'high' GROUP BY g.codon, g.aa, g.family, g.fold, g.ffold) x) y""")
relation("frame_w", "SELECT gene_set AS frame, codon, greatest(w, 1e-3) AS w FROM set_w WHERE sense AND w IS NOT NULL UNION ALL SELECT 'high' AS frame, codon, greatest(w, 1e-3) AS w FROM high_rscu WHERE w IS NOT NULL")
relation("frame_cai", "SELECT c.gene, f.frame, sum(c.n) AS n, exp(sum(c.n * ln(f.w)) / sum(c.n)) AS cai FROM cl c JOIN frame_w f ON f.codon = c.codon GROUP BY c.gene, f.frame")
relation("three_cai", "SELECT gene, max(n) AS n, max(CASE WHEN frame = 'all' THEN cai END) AS a, max(CASE WHEN frame = 'reference' THEN cai END) AS r, max(CASE WHEN frame = 'high' THEN cai END) AS h FROM frame_cai GROUP BY gene")
query("ag31_three_way_cai", "SELECT gene, CAST(n AS BIGINT) AS n_codons, round(a, 6) AS cai_all, round(r, 6) AS cai_ref, round(h, 6) AS cai_high, round(h - a, 6) AS gain_high_all, round(h - r, 6) AS gain_high_ref, round(r - a, 6) AS gain_ref_all FROM three_cai")
relation("frame_weight", "SELECT 'reference' AS frame, codon, aa, fold, weight FROM weights UNION ALL SELECT 'high' AS frame, h.codon, h.aa, h.fold, ln((h.rscu + 1e-2) / (a.rscu + 1e-2)) AS weight FROM high_rscu h JOIN set_rscu a ON a.codon = h.codon AND a.gene_set = 'all'")
relation("frame_best", """SELECT frame, aa, codon, fold FROM (SELECT frame, aa, codon, fold, weight, row_number() OVER (PARTITION BY frame, aa ORDER BY weight DESC, codon) AS r, lead(weight) OVER (PARTITION BY frame, aa ORDER BY weight DESC, codon) AS second FROM frame_weight WHERE weight IS NOT NULL) x WHERE r = 1 AND (second IS NULL OR weight - second > 1e-6)""")
relation("frame_cbi", """SELECT gene, frame, CASE WHEN tot - rnd <= 0 THEN 0e0 ELSE (opt - rnd) / (tot - rnd) END AS cbi FROM (SELECT g.gene, o.frame, sum(g.n) AS tot, sum(CASE WHEN g.codon = o.codon THEN g.n ELSE 0 END) AS opt, sum(CAST(g.n AS DOUBLE) / o.fold) AS rnd FROM grid g JOIN frame_best o ON o.aa = g.aa GROUP BY g.gene, o.frame) x WHERE tot > 0""")
relation("two_cbi", "SELECT gene, max(CASE WHEN frame = 'reference' THEN cbi END) AS r, max(CASE WHEN frame = 'high' THEN cbi END) AS h FROM frame_cbi GROUP BY gene")
query("co05_gene_gain", "SELECT gene, round(r, 5) AS cbi_ref, round(h, 5) AS cbi_high, round(h - r, 5) AS gain, round(100 * (h - r) / greatest(abs(r), 1e-3), 3) AS gain_percent FROM two_cbi")

# ---------------------------------------------------------------- pairs, matrices and figures' data
relation("pair_cosine", "SELECT a.genome AS x, b.genome AS y, sum(a.f * b.f) / sqrt(max(na.s) * max(nb.s)) AS cosine FROM genome_vec a JOIN genome_vec b ON b.codon = a.codon AND a.genome < b.genome JOIN genome_norm na ON na.genome = a.genome JOIN genome_norm nb ON nb.genome = b.genome GROUP BY a.genome, b.genome")
relation("genome_norm", "SELECT genome, sum(f * f) AS s FROM genome_vec GROUP BY genome")
query("mv27_similarity_network", "SELECT x, y, round(cosine, 6) AS cosine FROM pair_cosine WHERE round(cosine, 9) >= 0.92e0")
query("jn06_sample_metadata", "SELECT m.sample_id, m.metric, round(m.v, 6) AS v, c.n_samples, c.n_genes FROM sample_metric m LEFT JOIN (SELECT cond, count(DISTINCT sample_id) AS n_samples, count(*) AS n_genes FROM genes GROUP BY cond) c ON c.cond = m.cond")
query("jn07_annotated_genes", "SELECT s.gene, round(s.cai, 6) AS cai, coalesce(k.ko, '') AS ko, coalesce(k.pathway, '') AS pathway FROM scores s LEFT JOIN gene_ko k ON k.gene = s.gene")
query("be16_inefficiency_report", """SELECT gene, ko, cai, ratio, row_number() OVER (ORDER BY cai, gene) AS rank FROM (SELECT s.gene, coalesce(k.ko, '') AS ko, round(s.cai, 6) AS cai, round(s.enc / 61e0, 6) AS ratio FROM scores s LEFT JOIN gene_ko k ON k.gene = s.gene LEFT JOIN refset r ON r.gene = s.gene WHERE r.gene IS NULL) x""")
query("fg03_histogram", "SELECT metric, bin, count(*) AS n FROM (SELECT m.metric, least(29, CAST(floor((m.v - r.lo) / nullif(r.hi - r.lo, 0) * 30) AS BIGINT)) AS bin FROM metric m JOIN (SELECT metric, min(v) AS lo, max(v) AS hi FROM metric GROUP BY metric) r ON r.metric = m.metric) x GROUP BY metric, bin")
query("fg04_group_boxes", "SELECT m.metric, m.cond, count(*) AS n, round(percentile(m.v, 0.25), 6) AS q1, round(percentile(m.v, 0.5), 6) AS med, round(percentile(m.v, 0.75), 6) AS q3 FROM metric m GROUP BY m.metric, m.cond")
query("fg05_volcano", "SELECT codon, g1, g2, round(fold, 6) AS log2_fold, round(-ln(greatest(p, 1e-300)) / ln(10e0), 5) AS minus_log10_p, nth FROM (SELECT item AS codon, g1, g2, p, ln((m2 + 1e-4) / (m1 + 1e-4)) / ln(2e0) AS fold, row_number() OVER (PARTITION BY g1, g2 ORDER BY abs(round(ln((m2 + 1e-4) / (m1 + 1e-4)), 9)) DESC, item) AS nth FROM mwu WHERE grp <> 'metric' AND p IS NOT NULL) x WHERE nth <= 20")
query("fg14_usage_deviation", "SELECT t.codon, round(t.low - s.rscu, 6) AS deviation FROM (SELECT r.codon, avg(r.rscu) AS low FROM rscu r JOIN tier t ON t.gene = r.gene AND t.tier = 'low' WHERE r.rscu IS NOT NULL GROUP BY r.codon) t JOIN set_rscu s ON s.codon = t.codon AND s.gene_set = 'reference'")
relation("mobile_two", "SELECT 'CAI' AS item, 'mobile' AS g1, 'core' AS g2, CASE WHEN p.p_brand = 'Brand#11' THEN 1 ELSE 0 END AS first_one, round(s.cai, 9) AS v FROM scores s JOIN part p ON p.p_partkey = s.gene")
two_sample("mobile_test", "mobile_two")
query("fg13_mobile_core", "SELECT item AS metric, CAST(n1 AS BIGINT) AS n_mobile, CAST(n2 AS BIGINT) AS n_core, round(m1, 6) AS mean_mobile, round(m2, 6) AS mean_core, round(delta, 6) AS delta, round(p, 6) AS p FROM mobile_test")
query("cm02_sample_table", """SELECT c.sample_id, c.cond, c.mean_enc, c.mean_gc3, c.mean_cai, c.mean_fop, g.n_genes, f.foreign_share FROM (SELECT sample_id, cond, round(max(CASE WHEN metric = 'ENC' THEN v END), 6) AS mean_enc, round(max(CASE WHEN metric = 'GC3' THEN v END), 6) AS mean_gc3, round(max(CASE WHEN metric = 'CAI' THEN v END), 6) AS mean_cai, round(max(CASE WHEN metric = 'Fop' THEN v END), 6) AS mean_fop FROM sample_metric GROUP BY sample_id, cond) c
  JOIN (SELECT sample_id, count(*) AS n_genes FROM genes GROUP BY sample_id) g ON g.sample_id = c.sample_id LEFT JOIN (SELECT s.sample_id, round(avg(CASE WHEN f.flag THEN 1e0 ELSE 0e0 END), 6) AS foreign_share FROM scores s JOIN foreign_gene f ON f.gene = s.gene GROUP BY s.sample_id) f ON f.sample_id = c.sample_id""")

# Read several times by a query, or by several.
KEPT.update({"tiers", "drawn", "null_es", "set_es_e", "goi_boot_test", "goi_values", "null_distance", "near_distance", "draw_distance", "gene_vector", "class_rscu", "path_terms", "frame_cai"})
