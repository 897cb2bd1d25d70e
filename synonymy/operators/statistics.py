"""Ranks, tests, resampling and gene-set statistics over the usage relations."""

from synonymy.plans.relations import KEPT, on_spark, query, relation

ERFC = "({t} * (0.254829592e0 + {t} * (-0.284496736e0 + {t} * (1.421413741e0 + {t} * (-1.453152027e0 + {t} * 1.061405429e0)))) * exp(-{x} * {x}))"


def erfc(x: str) -> str:
    """A rational approximation (error under 2e-7) for x >= 0, in SQL."""
    return ERFC.format(x=f"({x})", t=f"(1e0 / (1e0 + 0.3275911e0 * ({x})))")


def bh(p: str, by: str = "") -> str:
    """Benjamini-Hochberg needs ranks first; this is the running minimum from the largest p down."""
    part = f"PARTITION BY {by} " if by else ""
    return f"least(1e0, min({p} * m / r) OVER ({part}ORDER BY r DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"


def log_rest(k: str) -> str:
    """ln k! - k ln k + k: exact to 20, the Stirling series from 21 on (error under 1e-14), in Spark SQL."""
    d = f"CAST({k} AS DOUBLE)"
    small = f"ln(CAST(factorial(CAST(least({k}, 20) AS INT)) AS DOUBLE)) - {d} * ln(greatest({d}, 1e0)) + {d}"
    return f"(CASE WHEN {k} <= 20 THEN {small} ELSE 5e-1 * ln(2 * pi() * {d}) + (1e0 / 12 - (1e0 / 360 - (1e0 / 1260 - 1e0 / 1680 / {d} / {d}) / {d} / {d}) / {d} / {d}) / {d} END)"


def hypergeometric(x: str, c: str, s: str, n: str) -> str:
    """P(X = x) for x of c among s of n. Each cell is taken against its expected count, so large logarithms need not cancel."""
    margins = (c, f"({n} - {c})"), (s, f"({n} - {s})")
    cells = ((x, 0, 0), (f"({c} - {x})", 0, 1), (f"({s} - {x})", 1, 0), (f"({n} - {c} - {s} + {x})", 1, 1))
    off = " + ".join(f"CASE WHEN {k} > 0 THEN {k} * ln(CAST({k} AS DOUBLE) * {n} / (CAST({margins[0][i]} AS DOUBLE) * {margins[1][j]})) ELSE 0e0 END + {log_rest(k)}" for k, i, j in cells)
    return f"exp({' + '.join(log_rest(k) for m in margins for k in m)} - {log_rest(n)} - ({off}))"


def every(lo: str, hi: str, columns: str, source: str) -> str:
    """Rows of a source h, each once for every i from lo to hi, made by blocks so that no array grows with the input."""
    blocks = f"SELECT {columns}, {lo} AS lo, {hi} AS hi, explode(sequence({lo} DIV 65536, {hi} DIV 65536)) AS b FROM {source} h WHERE {lo} <= {hi}"
    return f"SELECT {columns}, explode(sequence(greatest(lo, b * 65536), least(hi, b * 65536 + 65535))) AS i FROM ({blocks}) h"


def chi_square_tail(x: str, df: str) -> str:
    """P(chi-square >= x) for df >= 2, in Spark SQL: the finite sum in logarithms, and erfc where df is odd."""
    h = f"(({x}) / 2)"
    first = f"(CASE WHEN {df} % 2 = 0 THEN -{h} ELSE 5e-1 * ln({h}) - {h} - ln(sqrt(pi()) / 2) END)"
    step = f"a_.l + ln({h} / (j_ + ({df} % 2) / 2e0))"
    terms = f"aggregate(filter(sequence(1, CAST({df} DIV 2 AS INT)), j_ -> j_ < {df} DIV 2), named_struct('l', {first}, 's', exp({first})), (a_, j_) -> named_struct('l', {step}, 's', a_.s + exp({step})), a_ -> a_.s)"
    return f"CASE WHEN {x} <= 0 THEN 1e0 ELSE least(1e0, {terms} + CASE WHEN {df} % 2 = 1 THEN {erfc(f'sqrt({h})')} ELSE 0e0 END) END"


def chi_square_tail_reference(x: str, df: str) -> str:
    """The same tail for the reference SQL, by its log-gamma function."""
    h = f"(({x}) / 2)"
    terms = f"coalesce(list_sum(list_transform(range(0, CAST({df} // 2 AS BIGINT)), lambda j_: exp((j_ + ({df} % 2) / 2e0) * ln({h}) - {h} - lgamma(j_ + 1 + ({df} % 2) / 2e0)))), 0e0)"
    return f"CASE WHEN {x} <= 0 THEN 1e0 ELSE least(1e0, {terms} + CASE WHEN {df} % 2 = 1 THEN {erfc(f'sqrt({h})')} ELSE 0e0 END) END"


def log_choose(n: str, k: str) -> str:
    """ln of n over k for the reference SQL."""
    return f"(lgamma({n} + 1e0) - lgamma({k} + 1e0) - lgamma({n} - {k} + 1e0))"


def hypergeometric_reference(x: str, c: str, s: str, n: str) -> str:
    return f"exp({log_choose(c, x)} + {log_choose(f'({n} - {c})', f'({s} - {x})')} - {log_choose(n, s)})"


def u_counts(m: int, n: int) -> list[int]:
    """In how many orders of m and n values the statistic U is 0, 1, ... m * n."""
    counts = [1]
    for k in range(1, m + 1):  # one value more of the first: times (1 - x^(n + k)) / (1 - x^k)
        wide = counts + [0] * n
        for i in range(len(wide) - 1, n + k - 1, -1):
            wide[i] -= wide[i - n - k]
        for i in range(k, len(wide)):
            wide[i] += wide[i - k]
        counts = wide
    return counts


#: Up to so many values on both sides, none equal, the distribution of U is counted.
EXACT = 8


def exact_u() -> str:
    """small, large, far, p: two-sided tails of U at least as far from the middle."""
    rows = []
    for m in range(2, EXACT + 1):
        for n in range(m, EXACT + 1):
            counts = u_counts(m, n)
            total, tail = sum(counts), 0
            for u in range(m * n, -1, -1):
                tail += counts[u]
                if 2 * u >= m * n:
                    rows.append(f"({m}e0, {n}e0, {u}e0, {min(1.0, 2 * tail / total):.16e})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(small, large, far, p)"


def need(source: str) -> str:
    """bin, need, pool, bound: genes of interest and others of each bin. The need lowest of pool md5 words lie below bound; that they do is checked where it is used."""
    reach = "need + 10 * sqrt(need) + 100"
    return f"""SELECT *, CASE WHEN {reach} >= pool THEN 'g' ELSE lower(lpad(hex(CAST(1152921504606846975e0 * ({reach}) / pool AS BIGINT)), 15, '0')) END AS bound
  FROM (SELECT bin, count(CASE WHEN is_goi = 1 THEN 1 END) AS need, count(CASE WHEN is_goi = 0 THEN 1 END) AS pool FROM {source} GROUP BY bin) x WHERE need > 0"""


#: Tasks that hash the genes of a permutation test: the rows are few and small, their 999 words are the work.
TASKS = 48


def draws(source: str, v: str) -> str:
    """i, gene, v: for each i and bin as many others as genes of interest, by the order of md5; with replacement where there are too few."""
    slot = "CASE WHEN g.pool = 0 THEN raise_error('no gene of this length to draw') ELSE CAST(conv(substr(md5(t.i || '-' || g.bin || '-' || g.i), 1, 15), 16, 10) AS BIGINT) % g.pool + 1 END"
    return f"""SELECT i, gene, v FROM (SELECT w.i AS i, gene, v, need, row_number() OVER (PARTITION BY w.i, bin ORDER BY w.first, w.last, gene) AS r, count(*) OVER (PARTITION BY w.i, bin) AS found
  FROM (SELECT gene, v, bin, need, explode(ws) AS w FROM (SELECT gene, v, bin, need, words_below(gene, bound) AS ws FROM (SELECT /*+ REPARTITION({TASKS}) */ b.gene, b.{v} AS v, b.bin, g.need, g.bound FROM {source} b JOIN {source}_need g ON g.bin = b.bin WHERE b.is_goi = 0 AND g.need <= g.pool) u) z) y) x
  WHERE CASE WHEN found < need THEN raise_error('too few words below the bound') ELSE r <= need END
  UNION ALL SELECT s.i, p.gene, p.v FROM (SELECT t.i, g.bin, {slot} AS r FROM ({every('1L', 'h.need', 'h.bin, h.pool, h.need', f'(SELECT * FROM {source}_need WHERE need > pool)')}) g CROSS JOIN iters t) s
  JOIN (SELECT b.bin, b.gene, b.{v} AS v, row_number() OVER (PARTITION BY b.bin ORDER BY b.gene) AS r FROM {source} b JOIN {source}_need g ON g.bin = b.bin WHERE b.is_goi = 0 AND g.need > g.pool) p ON p.bin = s.bin AND p.r = s.r"""


# Rounded, so that equal genes stay equal whatever the order of their sums.
relation("scores", "SELECT e.gene, e.sample_id, e.genome, e.cond, e.length, round(e.enc, 9) AS enc, round(g.gc3, 9) AS gc3, round(g.gc12, 9) AS gc12, round(c.cai, 9) AS cai, round(c.fop, 9) AS fop FROM enc e JOIN gc g ON g.gene = e.gene JOIN cai c ON c.gene = e.gene", kept=True)
relation("metric", """SELECT gene, sample_id, cond, 'ENC' AS metric, enc AS v FROM scores UNION ALL SELECT gene, sample_id, cond, 'GC3' AS metric, gc3 AS v FROM scores
  UNION ALL SELECT gene, sample_id, cond, 'CAI' AS metric, cai AS v FROM scores UNION ALL SELECT gene, sample_id, cond, 'Fop' AS metric, fop AS v FROM scores""")
relation("sample_metric", "SELECT sample_id, cond, metric, round(avg(v), 9) AS v FROM metric GROUP BY sample_id, cond, metric", kept=True)
relation("conds", "SELECT DISTINCT cond FROM cds")
relation("cond_pair", "SELECT x.cond AS g1, y.cond AS g2 FROM conds x JOIN conds y ON x.cond < y.cond")
# Values of two groups side by side, with average ranks inside each comparison.
relation("sample_codon", """SELECT sample_id, cond, codon, aa, round(CAST(n * ffold AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY sample_id, family), 0), 9) AS v
  FROM (SELECT sample_id, cond, codon, aa, family, ffold, sum(n) AS n FROM grid GROUP BY sample_id, cond, codon, aa, family, ffold) x""", kept=True)
relation("two", """SELECT s.codon AS item, s.aa AS grp, p.g1, p.g2, CASE WHEN s.cond = p.g1 THEN 1 ELSE 0 END AS first_one, s.v FROM sample_codon s JOIN cond_pair p ON s.cond = p.g1 OR s.cond = p.g2 WHERE s.v IS NOT NULL
  UNION ALL SELECT s.metric AS item, 'metric' AS grp, p.g1, p.g2, CASE WHEN s.cond = p.g1 THEN 1 ELSE 0 END AS first_one, s.v FROM sample_metric s JOIN cond_pair p ON s.cond = p.g1 OR s.cond = p.g2 WHERE s.v IS NOT NULL""")
relation("two_rank", "SELECT *, rank() OVER (PARTITION BY item, g1, g2 ORDER BY v) + (count(*) OVER (PARTITION BY item, g1, g2, v) - 1) / 2e0 AS rk, count(*) OVER (PARTITION BY item, g1, g2, v) AS ties FROM two")
relation("mwu0", """SELECT item, grp, g1, g2, CAST(sum(first_one) AS DOUBLE) AS n1, CAST(count(*) - sum(first_one) AS DOUBLE) AS n2, sum(CASE WHEN first_one = 1 THEN rk ELSE 0e0 END) AS r1,
  sum(CAST(ties AS DOUBLE) * ties - 1e0) AS tie, avg(CASE WHEN first_one = 1 THEN v END) AS m1, avg(CASE WHEN first_one = 0 THEN v END) AS m2 FROM two_rank GROUP BY item, grp, g1, g2""")
relation("u_exact", exact_u())
KEPT.add("u_exact")
relation("mwu1", "SELECT *, r1 - n1 * (n1 + 1) / 2 AS u, n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1))) AS var FROM mwu0 WHERE n1 >= 5 AND n2 >= 5")
relation("mwu", f"""SELECT x.*, 2 * u / (n1 * n2) - 1 AS delta, coalesce(e.p, CASE WHEN var > 0 THEN {erfc('greatest(abs(u - n1 * n2 / 2) - 5e-1, 0e0) / sqrt(2 * var)')} END) AS p
  FROM mwu1 x LEFT JOIN u_exact e ON e.small = least(x.n1, x.n2) AND e.large = greatest(x.n1, x.n2) AND e.far = greatest(x.u, x.n1 * x.n2 - x.u) AND x.tie = 0""")
relation("mwu_r", "SELECT *, row_number() OVER (ORDER BY p, item, g1, g2) AS r, count(*) OVER () AS m, row_number() OVER (PARTITION BY grp ORDER BY p, item, g1, g2) AS rf, count(*) OVER (PARTITION BY grp) AS mf FROM mwu WHERE p IS NOT NULL")

query("st01_benjamini_hochberg", f"SELECT item, g1, g2, round(p, 6) AS p, round({bh('p')}, 6) AS q FROM mwu_r")
query("st02_mannwhitney", "SELECT item AS codon, g1, g2, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(u, 4) AS u, round(p, 6) AS p FROM mwu WHERE grp <> 'metric'")
query("st03_cliffs_delta", """SELECT item, g1, g2, round(delta, 6) AS delta, CASE WHEN abs(delta) < 0.147e0 THEN 'negligible' WHEN abs(delta) < 0.33e0 THEN 'small' WHEN abs(delta) < 0.474e0 THEN 'medium' ELSE 'large' END AS effect FROM mwu""")
query("st04_per_amino_acid", "SELECT grp AS aa, item AS codon, g1, g2, round(least(1e0, min(p * mf / rf) OVER (PARTITION BY grp ORDER BY rf DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS q_family FROM mwu_r WHERE grp <> 'metric'")
query("st05_clr_normalised", """SELECT sample_id, codon, round(ln(greatest(coalesce(v, 0e0), 1e-6)) - avg(ln(greatest(coalesce(v, 0e0), 1e-6))) OVER (PARTITION BY sample_id), 6) AS clr FROM sample_codon""")
query("st05_zscore", "SELECT sample_id, codon, round((v - avg(v) OVER (PARTITION BY codon)) / nullif(stddev_samp(v) OVER (PARTITION BY codon), 0), 6) AS z FROM sample_codon WHERE v IS NOT NULL")
query("st17_effect_summary", "SELECT item AS metric, g1, g2, round(m1, 6) AS mean1, round(m2, 6) AS mean2, round(100 * (m2 - m1) / nullif(abs(m1), 0), 4) AS percent, round(delta, 6) AS delta FROM mwu WHERE grp = 'metric'")
query("st18_rscu_fold_change", "SELECT item AS codon, g1, g2, round(ln((m2 + 1e-4) / (m1 + 1e-4)) / ln(2e0), 6) AS log2_fold, round(p, 6) AS p FROM mwu WHERE grp <> 'metric'")
relation("kw_rank", """SELECT metric, cond, v, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2e0 AS rk, count(*) OVER (PARTITION BY metric, v) AS ties, count(*) OVER (PARTITION BY metric) AS n
  FROM (SELECT metric, cond, v, count(*) OVER (PARTITION BY metric, cond) AS k FROM sample_metric WHERE v IS NOT NULL) x WHERE k >= 5""")
relation("kw_grp", "SELECT metric, cond, max(n) AS n, sum(rk) * sum(rk) / count(*) AS s, sum(CAST(ties AS DOUBLE) * ties - 1e0) AS tie, count(*) AS k FROM kw_rank GROUP BY metric, cond HAVING count(*) >= 5")
relation("kw", "SELECT metric, count(*) AS grps, (12e0 / (max(n) * (max(n) + 1e0)) * sum(s) - 3e0 * (max(n) + 1e0)) / (1e0 - sum(tie) / (CAST(max(n) AS DOUBLE) * max(n) * max(n) - max(n))) AS h FROM kw_grp GROUP BY metric HAVING count(*) >= 3")
query("st16_kruskal_wallis", f"SELECT metric, grps AS n_groups, round(h, 6) AS h, CASE WHEN h IS NOT NULL THEN round({chi_square_tail_reference('h', '(grps - 1)')}, 6) END AS p FROM kw")
on_spark("st16_kruskal_wallis", f"SELECT metric, grps AS n_groups, round(h, 6) AS h, CASE WHEN h IS NOT NULL THEN round({chi_square_tail('h', '(grps - 1)')}, 6) END AS p FROM kw")

query("ag33_within_condition", """SELECT cond, metric, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, round(percentile(v, 0.5), 6) AS med, round(percentile(v, 0.25), 6) AS q25, round(percentile(v, 0.75), 6) AS q75, round(min(v), 6) AS lo, round(max(v), 6) AS hi
  FROM sample_metric GROUP BY cond, metric""")
query("ag34_rscu_dispersion", "SELECT cond, codon, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, round(stddev_samp(v) / nullif(avg(v), 0), 4) AS cv FROM sample_codon WHERE v IS NOT NULL GROUP BY cond, codon HAVING count(*) >= 2")
query("ag35_group_means", "SELECT cond, aa, round(avg(v), 6) AS mean_rscu, count(DISTINCT sample_id) AS n_samples FROM sample_codon WHERE v IS NOT NULL GROUP BY cond, aa")
query("ag39_grouping_sets", "SELECT genome, cond, CAST(sum(n) AS BIGINT) AS n FROM cl GROUP BY GROUPING SETS ((genome, cond), (cond), ())")

# Expression tiers: percentiles 10 and 90; a floor shared by many keeps its first tenth as low.
# Orders of all genes; on Spark they are cut into ranges (ranking).
relation("cai_order", "SELECT *, row_number() OVER (ORDER BY cai, gene) AS r, count(*) OVER () AS n FROM scores", kept=True)
relation("length_order", "SELECT gene, length, enc, row_number() OVER (ORDER BY length, gene) AS r, count(*) OVER () AS n FROM scores", kept=True)
relation("enc_order", "SELECT gene, enc, row_number() OVER (ORDER BY enc DESC, gene) AS r, sum(enc) OVER (ORDER BY enc DESC, gene ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / sum(enc) OVER () AS share FROM scores")


def quantile(v: str, q: float) -> str:
    """The interpolated quantile of an order (v, r, n), which names two of its rows."""
    at = f"((n - 1) * {q}e0 + 1)"
    low, high = f"max(CASE WHEN r = floor({at}) THEN CAST({v} AS DOUBLE) END)", f"max(CASE WHEN r = ceil({at}) THEN CAST({v} AS DOUBLE) END)"
    return f"{low} + ({high} - {low}) * max({at} - floor({at}))"


relation("tier_cut", "SELECT percentile(cai, 0.1) AS lo, percentile(cai, 0.9) AS hi, min(cai) AS least_cai, count(*) AS n FROM scores")
on_spark("tier_cut", f"SELECT {quantile('cai', 0.1)} AS lo, {quantile('cai', 0.9)} AS hi, min(cai) AS least_cai, count(*) AS n FROM cai_order")
relation("tier0", "SELECT s.gene, s.sample_id, s.genome, s.cond, s.cai, s.fop, s.enc, s.gc3, s.length, t.lo, t.hi, t.least_cai, t.n, count(CASE WHEN s.cai = t.lo THEN 1 END) OVER () AS ties, row_number() OVER (PARTITION BY s.cai ORDER BY s.gene) AS nth FROM scores s CROSS JOIN tier_cut t")
# Among the lowest values a gene's place is its rank in all.
on_spark("tier0", "SELECT s.gene, s.sample_id, s.genome, s.cond, s.cai, s.fop, s.enc, s.gc3, s.length, t.lo, t.hi, t.least_cai, t.n, u.ties, s.r AS nth FROM cai_order s CROSS JOIN tier_cut t CROSS JOIN (SELECT count(*) AS ties FROM cai_order o JOIN tier_cut c ON o.cai = c.lo) u")
relation("tier", """SELECT gene, sample_id, genome, cond, cai, fop, enc, gc3, length, CASE WHEN lo = hi THEN 'medium' WHEN ties > 0.1e0 * n AND lo = least_cai AND cai = lo AND nth > ceil(0.1e0 * n) THEN 'low_floor' WHEN cai <= lo THEN 'low' WHEN cai >= hi THEN 'high' ELSE 'medium' END AS tier FROM tier0""", kept=True)
query("wn02_expression_tiers", "SELECT gene, tier, round(cai, 6) AS cai FROM tier")
query("fg07_tier_summary", "SELECT genome, count(CASE WHEN tier = 'high' THEN 1 END) AS n_high, count(CASE WHEN tier = 'medium' THEN 1 END) AS n_medium, count(CASE WHEN tier = 'low' THEN 1 END) AS n_low FROM tier GROUP BY genome")
query("wn04_quintiles", "SELECT q AS quintile, count(*) AS n, round(avg(fop), 6) AS mean_fop, round(stddev_pop(fop), 6) AS sd_fop FROM (SELECT fop, least(CAST(floor((r - 1) / floor(n / 5e0)) AS BIGINT), 4) + 1 AS q FROM cai_order) x GROUP BY q")
query("wn07_position_bins", "SELECT genome, bin, round(avg(enc), 6) AS mean_enc FROM (SELECT genome, enc, CAST(floor((row_number() OVER (PARTITION BY genome ORDER BY gene) - 1) / 30) AS BIGINT) AS bin, count(*) OVER (PARTITION BY genome) AS n FROM scores) x WHERE (bin + 1) * 30 <= n GROUP BY genome, bin")
query("wn08_sliding_mean", "SELECT gene, round(m, 6) AS mean_gc3 FROM (SELECT gene, genome, avg(gc3) OVER (PARTITION BY genome ORDER BY gene ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS m, count(*) OVER (PARTITION BY genome ORDER BY gene ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS k FROM scores) x WHERE k = 10")
relation("split", "SELECT s.*, CASE WHEN g.gene IS NULL THEN 0 ELSE 1 END AS is_goi FROM scores s LEFT JOIN goi g ON g.gene = s.gene")
relation("below_goi", """SELECT DISTINCT cai, count(CASE WHEN is_goi = 0 THEN 1 END) OVER (ORDER BY cai RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - count(CASE WHEN is_goi = 0 THEN 1 END) OVER (PARTITION BY cai) AS below,
  count(CASE WHEN is_goi = 0 THEN 1 END) OVER (PARTITION BY cai) AS same, count(CASE WHEN is_goi = 0 THEN 1 END) OVER () AS total FROM split""")
query("wn09_percentile_rank", "SELECT s.gene, round(100 * (b.below + b.same / 2e0) / b.total, 6) AS pct FROM split s JOIN below_goi b ON b.cai = s.cai WHERE s.is_goi = 1")
query("wn11_quantile_bins", "SELECT bin, count(*) AS n, round(percentile(enc, 0.5), 6) AS med_enc FROM (SELECT enc, least(CAST(floor((r - 1) * 10e0 / n) AS BIGINT), 9) AS bin FROM length_order) x GROUP BY bin")
query("wn12_cumulative_share", "SELECT gene, r AS rank, round(share, 6) AS share FROM enc_order WHERE r IN (20, 100, 200)")
relation("quart", "SELECT percentile(CAST(length AS DOUBLE), 0.25) AS a, percentile(CAST(length AS DOUBLE), 0.5) AS b, percentile(CAST(length AS DOUBLE), 0.75) AS c FROM scores")
on_spark("quart", f"SELECT {quantile('length', 0.25)} AS a, {quantile('length', 0.5)} AS b, {quantile('length', 0.75)} AS c FROM length_order")
relation("binned", "SELECT s.gene, s.is_goi, s.cai, s.enc, CASE WHEN s.length < q.a THEN 0 WHEN s.length < q.b THEN 1 WHEN s.length < q.c THEN 2 ELSE 3 END AS bin FROM split s CROSS JOIN quart q")
query("wn14_length_quartiles", "SELECT gene, CAST(bin AS BIGINT) AS bin FROM binned")
# 999 draws of controls by length bin, in the order of md5; with replacement where a bin has too few.
relation("iters", "SELECT CAST(i AS BIGINT) AS i FROM range(0, 999) AS t(i)")


def draws_reference(source: str, v: str) -> str:
    """The draws for the reference SQL, which ranks every word of every permutation."""
    counted = f"(SELECT bin, count(CASE WHEN is_goi = 1 THEN 1 END) AS need, count(CASE WHEN is_goi = 0 THEN 1 END) AS pool FROM {source} GROUP BY bin)"
    slot = "CAST(('0x' || substr(md5(t.i || '-' || g.bin || '-' || g.k), 1, 15)) AS BIGINT) % g.pool + 1"
    return f"""SELECT i, gene, v FROM (SELECT t.i, b.gene, b.{v} AS v, b.bin, row_number() OVER (PARTITION BY t.i, b.bin ORDER BY md5(CAST(t.i AS VARCHAR) || '-' || CAST(b.gene AS VARCHAR)), b.gene) AS r FROM {source} b CROSS JOIN iters t WHERE b.is_goi = 0) x
  JOIN {counted} g ON g.bin = x.bin AND g.need <= g.pool WHERE r <= need
  UNION ALL SELECT s.i, p.gene, p.v FROM (SELECT t.i, g.bin, {slot} AS r FROM (SELECT bin, pool, unnest(range(1, need + 1)) AS k FROM {counted} c WHERE need > pool) g CROSS JOIN iters t) s
  JOIN (SELECT bin, gene, {v} AS v, row_number() OVER (PARTITION BY bin ORDER BY gene) AS r FROM {source} b WHERE is_goi = 0) p ON p.bin = s.bin AND p.r = s.r"""


relation("flagged", "SELECT b.gene, b.is_goi, b.bin, CASE WHEN f.flag THEN 1e0 ELSE 0e0 END AS flag FROM binned b JOIN foreign_gene f ON f.gene = b.gene WHERE f.flag IS NOT NULL")
relation("drawn", draws_reference("binned", "cai"))
relation("drawn_flags", draws_reference("flagged", "flag"))
query("rs03_length_matched", "SELECT i AS iter, count(*) AS n, round(avg(v), 6) AS mean_cai FROM drawn GROUP BY i")
query("rs06_matched_permutation", """SELECT round(o.m, 6) AS observed, round(avg(d.m), 6) AS null_mean, round((1e0 + count(CASE WHEN d.m >= o.m THEN 1 END)) / (1e0 + count(*)), 6) AS p_more, round((1e0 + count(CASE WHEN d.m <= o.m THEN 1 END)) / (1e0 + count(*)), 6) AS p_less
  FROM (SELECT i, round(avg(v), 9) AS m FROM drawn_flags GROUP BY i) d CROSS JOIN (SELECT round(avg(CASE WHEN is_goi = 1 THEN flag END), 9) AS m FROM flagged HAVING count(CASE WHEN is_goi = 1 THEN 1 END) >= 3 AND count(CASE WHEN is_goi = 0 THEN 1 END) >= 30) o GROUP BY o.m""")
# On Spark only words below a bound are ranked, which a check at use proves wide enough.
on_spark("binned_need", need("binned"))
on_spark("drawn", draws("binned", "cai"))
on_spark("flagged_need", need("flagged"))
on_spark("drawn_flags", draws("flagged", "flag"))
relation("cdf_steps", """SELECT metric, count(CASE WHEN is_goi = 1 THEN 1 END) OVER (PARTITION BY metric ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / nullif(CAST(count(CASE WHEN is_goi = 1 THEN 1 END) OVER (PARTITION BY metric) AS DOUBLE), 0) AS f1,
  count(CASE WHEN is_goi = 0 THEN 1 END) OVER (PARTITION BY metric ORDER BY v RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / nullif(CAST(count(CASE WHEN is_goi = 0 THEN 1 END) OVER (PARTITION BY metric) AS DOUBLE), 0) AS f0
  FROM (SELECT m.metric, round(m.v, 9) AS v, s.is_goi FROM metric m JOIN split s ON s.gene = m.gene) z""")
query("st27_ks_two_sample", "SELECT metric, round(max(abs(f1 - f0)), 6) AS d FROM cdf_steps GROUP BY metric")

# Spearman and least squares against log10 length.
relation("len_rank", "SELECT metric, v, lg, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2e0 AS rv, rank() OVER (PARTITION BY metric ORDER BY lg) + (count(*) OVER (PARTITION BY metric, lg) - 1) / 2e0 AS rl FROM (SELECT m.metric, round(m.v, 9) AS v, ln(g.length) / ln(10e0) AS lg FROM metric m JOIN genes g ON g.gene = m.gene) x")
query("st11_length_bias", "SELECT metric, count(*) AS n, round(corr(rv, rl), 6) AS rho, round(regr_slope(v, lg), 6) AS slope, round(regr_intercept(v, lg), 6) AS intercept, round(regr_r2(v, lg), 6) AS r2 FROM len_rank GROUP BY metric HAVING count(*) >= 30")
query("st35_neutrality", "SELECT sample_id, count(*) AS n, round(regr_slope(gc12, gc3), 6) AS slope, round(regr_r2(gc12, gc3), 6) AS r2 FROM scores GROUP BY sample_id HAVING count(*) > 10")
query("st36_metric_correlation", "SELECT round(corr(cai, fop), 6) AS cai_fop, round(corr(cai, enc), 6) AS cai_enc, round(avg(CASE WHEN fop = 0 THEN 1e0 ELSE 0e0 END), 6) AS share_zero FROM scores")
query("st37_range_check", "SELECT count(CASE WHEN encprime < 20 OR encprime > 61.5e0 THEN 1 END) AS out_of_range, count(CASE WHEN encprime IS NULL THEN 1 END) AS missing, count(*) AS n FROM encprime")

# Exact tests by log factorials.
relation("ko", "SELECT DISTINCT p_type AS ko, p_brand AS pathway FROM part")
relation("ko_metric", "SELECT p.p_type AS ko, sum(l.l_quantity) AS v FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey GROUP BY p.p_type")
relation("ko_top", "SELECT ko FROM (SELECT ko, row_number() OVER (ORDER BY v DESC, ko) AS r, count(*) OVER () AS n FROM ko_metric) x WHERE r <= ceil(n * 0.2e0)")
relation("hyper", """SELECT k.pathway, count(*) AS n, count(t.ko) AS k, (SELECT count(DISTINCT ko) FROM ko) AS m, (SELECT count(DISTINCT k2.ko) FROM ko k2 JOIN ko_top t2 ON t2.ko = k2.ko) AS nn FROM ko k LEFT JOIN ko_top t ON t.ko = k.ko GROUP BY k.pathway HAVING count(*) >= 3""")
relation("hyper_terms", f"SELECT pathway, i, {hypergeometric_reference('i', 'n', 'nn', 'm')} AS p FROM (SELECT *, unnest(range(k, least(n, nn) + 1)) AS i FROM hyper) h WHERE nn - i <= m - n")
query("st07_hypergeometric", "SELECT h.pathway, h.k, h.n, h.nn AS n_test, h.m AS n_universe, round(least(100e0, h.k / (h.n * h.nn / CAST(h.m AS DOUBLE))), 6) AS fold, CASE WHEN t.p IS NOT NULL THEN round(least(1e0, t.p), 6) END AS p FROM hyper h LEFT JOIN (SELECT pathway, sum(p) AS p FROM hyper_terms GROUP BY pathway) t ON t.pathway = h.pathway")
on_spark("hyper_terms", f"SELECT pathway, i, {hypergeometric('i', 'n', 'nn', 'm')} AS p FROM ({every('h.k', 'least(h.n, h.nn)', 'h.pathway, h.k, h.n, h.nn, h.m', 'hyper')}) h")
relation("fish", """SELECT t.genome AS category, tt.tier, count(CASE WHEN t.tier = tt.tier THEN 1 END) AS a, (SELECT count(*) FROM tier x WHERE x.tier = 'high') AS hi, (SELECT count(*) FROM tier x WHERE x.tier = 'low') AS lo, count(*) AS c, (SELECT count(*) FROM tier x) AS n
  FROM tier t CROSS JOIN (SELECT 'high' AS tier UNION ALL SELECT 'low' AS tier) tt GROUP BY t.genome, tt.tier""")
relation("fish2", "SELECT category, tier, a, CASE WHEN tier = 'high' THEN hi ELSE lo END AS s, c, n FROM fish")
relation("fish_terms", f"SELECT category, tier, a, c, i, {hypergeometric_reference('i', 'c', 's', 'n')} AS p, {hypergeometric_reference('a', 'c', 's', 'n')} AS seen FROM (SELECT *, unnest(range(greatest(0, c + s - n), least(c, s) + 1)) AS i FROM fish2) h")
# One pass over the tiers, which are costly: the margins are sums over the few rows that it leaves.
on_spark("fish2", """SELECT genome AS category, tt.tier, CASE WHEN tt.tier = 'high' THEN hi ELSE lo END AS a, sum(CASE WHEN tt.tier = 'high' THEN hi ELSE lo END) OVER (PARTITION BY tt.tier) AS s, c, sum(c) OVER (PARTITION BY tt.tier) AS n
  FROM (SELECT genome, count(CASE WHEN tier = 'high' THEN 1 END) AS hi, count(CASE WHEN tier = 'low' THEN 1 END) AS lo, count(*) AS c FROM tier GROUP BY genome) t CROSS JOIN (SELECT 'high' AS tier UNION ALL SELECT 'low' AS tier) tt""")
on_spark("fish_terms", f"SELECT category, tier, a, c, i, {hypergeometric('i', 'c', 's', 'n')} AS p, {hypergeometric('a', 'c', 's', 'n')} AS seen FROM ({every('greatest(0, h.c + h.s - h.n)', 'least(h.c, h.s)', 'h.category, h.tier, h.a, h.s, h.c, h.n', 'fish2')}) h")
query("st09_fisher", "SELECT category, tier, a AS n_in_tier, c AS n_total, round(least(1e0, sum(CASE WHEN p <= seen * (1e0 + 1e-7) THEN p ELSE 0e0 END)), 6) AS p FROM fish_terms GROUP BY category, tier, a, c")
query("st34_chi_square", """SELECT round(sum(pow(o - e, 2) / e), 6) AS chi2, CAST((count(DISTINCT tier) - 1) * (count(DISTINCT cond) - 1) AS BIGINT) AS df, round(sqrt(sum(pow(o - e, 2) / e) / max(n) / nullif(least(count(DISTINCT tier), count(DISTINCT cond)) - 1, 0)), 6) AS cramers_v
  FROM (SELECT a.tier, b.cond, CAST(coalesce(c.o, 0) AS DOUBLE) AS o, CAST(a.na AS DOUBLE) * b.nb / t.n AS e, t.n FROM (SELECT tier, count(*) AS na FROM tier GROUP BY tier) a CROSS JOIN (SELECT cond, count(*) AS nb FROM tier GROUP BY cond) b
  CROSS JOIN (SELECT count(*) AS n FROM tier) t LEFT JOIN (SELECT tier, cond, count(*) AS o FROM tier GROUP BY tier, cond) c ON c.tier = a.tier AND c.cond = b.cond) x""")

# Pseudo-F without a distance matrix: sums of squares about group means in CLR space.
relation("clr", "SELECT sample_id, cond, codon, ln(greatest(coalesce(v, 0e0), 1e-6)) - avg(ln(greatest(coalesce(v, 0e0), 1e-6))) OVER (PARTITION BY sample_id) AS x FROM sample_codon WHERE codon IN (SELECT codon FROM codon_dim WHERE indep)")
relation("labels_i", """SELECT i, sample_id, cond FROM (SELECT t.i, s.sample_id, row_number() OVER (PARTITION BY t.i ORDER BY md5(CAST(t.i AS VARCHAR(20)) || '-' || s.sample_id), s.sample_id) AS r FROM (SELECT DISTINCT sample_id FROM clr) s CROSS JOIN iters t) a
  JOIN (SELECT cond, row_number() OVER (ORDER BY sample_id) AS r FROM (SELECT DISTINCT sample_id, cond FROM clr) d) b USING (r) UNION ALL SELECT -1 AS i, sample_id, cond FROM (SELECT DISTINCT sample_id, cond FROM clr) o""")
relation("ssw", "SELECT i, sum(ss) AS ssw, count(DISTINCT cond) AS k FROM (SELECT l.i, l.cond, c.codon, sum(c.x * c.x) - sum(c.x) * sum(c.x) / count(*) AS ss FROM labels_i l JOIN clr c ON c.sample_id = l.sample_id GROUP BY l.i, l.cond, c.codon) z GROUP BY i")
relation("sst", "SELECT sum(ss) AS sst, max(n) AS n FROM (SELECT codon, sum(x * x) - sum(x) * sum(x) / count(*) AS ss, count(*) AS n FROM clr GROUP BY codon) z")
relation("pseudo_f", "SELECT w.i, round(((t.sst - w.ssw) / (w.k - 1)) / (w.ssw / (t.n - w.k)), 9) AS f, 1e0 - w.ssw / t.sst AS r2 FROM ssw w CROSS JOIN sst t")
query("st25_permanova", "SELECT round(o.f, 6) AS f, round(max(o.r2), 6) AS r2, round((1e0 + count(CASE WHEN p.f >= o.f THEN 1 END)) / (1e0 + count(*)), 6) AS p FROM pseudo_f p CROSS JOIN (SELECT f, r2 FROM pseudo_f WHERE i = -1) o WHERE p.i >= 0 GROUP BY o.f")
relation("genome_vec", "SELECT genome, codon, CAST(sum(n) AS DOUBLE) / sum(sum(n)) OVER (PARTITION BY genome) AS f FROM grid GROUP BY genome, codon")
relation("genome_gc", "SELECT genome, avg(gc3) AS g FROM gc GROUP BY genome")
relation("dist2", "SELECT a.genome AS x, b.genome AS y, sqrt(sum(pow(a.f - b.f, 2))) AS d1, max(abs(ga.g - gb.g)) AS d2 FROM genome_vec a JOIN genome_vec b ON a.codon = b.codon AND a.genome < b.genome JOIN genome_gc ga ON ga.genome = a.genome JOIN genome_gc gb ON gb.genome = b.genome GROUP BY a.genome, b.genome")
query("st33_mantel_statistic", "SELECT count(*) AS n_pairs, round(corr(d1, d2), 6) AS r FROM dist2")

# A ranking of all genes; the walks of gene sets along it are in comparisons.
relation("ranked", "SELECT gene, genome, abs(cai) AS w, row_number() OVER (ORDER BY cai DESC, gene) AS r, count(*) OVER () AS n FROM scores", kept=True)
