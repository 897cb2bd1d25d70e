"""Genome order, foreign genes, selection, optimisation, joins and set operations."""

from synonymy.functions.codons import codon_rows
from synonymy.operators.statistics import erfc
from synonymy.operators.usage import CODON
from synonymy.plans.relations import on_spark, query, relation

relation("placed", """SELECT gene, genome, length, CASE WHEN gene % 2 = 0 THEN '+' ELSE '-' END AS strand, 1 + sum(length) OVER (PARTITION BY genome ORDER BY gene ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length AS start_bp FROM genes""")
relation("adjacent", """SELECT * FROM (SELECT genome, strand, gene AS gene1, lead(gene) OVER (PARTITION BY genome, strand ORDER BY start_bp, gene) AS gene2, greatest(0, lead(start_bp) OVER (PARTITION BY genome, strand ORDER BY start_bp, gene) - (start_bp + length - 1)) AS gap FROM placed) x WHERE gene2 IS NOT NULL""")
query("jn12_adjacent_genes", "SELECT genome, strand, gene1, gene2, CAST(gap AS BIGINT) AS intergenic_bp FROM adjacent")
query("be05_operon_distance", """SELECT a.gene1, a.gene2, round(sqrt(sum(pow(coalesce(x.rscu, 0e0) - coalesce(y.rscu, 0e0), 2))), 6) AS rscu_distance FROM adjacent a JOIN rscu x ON x.gene = a.gene1 JOIN rscu y ON y.gene = a.gene2 AND y.codon = x.codon GROUP BY a.gene1, a.gene2""")
relation("by_strand", "SELECT r.codon, r.aa, p.strand, round(r.rscu, 9) AS v FROM rscu r JOIN placed p ON p.gene = r.gene WHERE r.rscu IS NOT NULL")
relation("strand_rank", "SELECT *, rank() OVER (PARTITION BY codon ORDER BY v) + (count(*) OVER (PARTITION BY codon, v) - 1) / 2e0 AS rk, count(*) OVER (PARTITION BY codon, v) AS ties FROM by_strand")
relation("strand_u", """SELECT codon, aa, n1, n2, mp, mm, r1 - n1 * (n1 + 1) / 2 AS u, n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1))) AS var FROM (SELECT codon, aa, CAST(count(CASE WHEN strand = '+' THEN 1 END) AS DOUBLE) AS n1, CAST(count(CASE WHEN strand = '-' THEN 1 END) AS DOUBLE) AS n2,
  avg(CASE WHEN strand = '+' THEN v END) AS mp, avg(CASE WHEN strand = '-' THEN v END) AS mm, sum(CASE WHEN strand = '+' THEN rk ELSE 0e0 END) AS r1, sum(CAST(ties AS DOUBLE) * ties - 1e0) AS tie FROM strand_rank GROUP BY codon, aa) x WHERE n1 > 1 AND n2 > 1""")
query("be04_strand_asymmetry", f"SELECT codon, aa, round(mp, 6) AS mean_plus, round(mm, 6) AS mean_minus, round(u, 2) AS u, CASE WHEN var > 0 THEN round({erfc('greatest(abs(u - n1 * n2 / 2) - 5e-1, 0e0) / sqrt(2 * var)')}, 6) END AS p, greatest(n1, n2) / least(n1, n2) > 3 AS imbalanced FROM strand_u")
# Intercept and slope of the growth regression, in hours.
query("be01_growth_rate", """SELECT s.genome, count(*) AS n_ref, round(avg(s.cai), 6) AS mean_cai, round(exp(7.15e0 - 7.38e0 * avg(s.cai)), 6) AS doubling_hours, CASE WHEN exp(7.15e0 - 7.38e0 * avg(s.cai)) < 2 THEN 'fast' WHEN exp(7.15e0 - 7.38e0 * avg(s.cai)) <= 8 THEN 'moderate' ELSE 'slow' END AS growth
  FROM scores s JOIN refset r ON r.gene = s.gene GROUP BY s.genome HAVING count(*) >= 3""")
relation("high_mean", "SELECT r.codon, r.aa, r.family, avg(r.rscu) AS all_mean, avg(CASE WHEN t.tier = 'high' THEN r.rscu END) AS high_mean FROM rscu r JOIN tier t ON t.gene = r.gene GROUP BY r.codon, r.aa, r.family")
on_spark("high_mean", f"""SELECT d.codon, d.aa, d.family, avg(x.rscu) AS all_mean, avg(CASE WHEN x.tier = 'high' THEN x.rscu END) AS high_mean
  FROM (SELECT {CODON}[s.k] AS codon, s.rscu, g.tier FROM (SELECT u.rs, u.lengths, t.tier FROM gene_ns u JOIN tier t ON t.gene = u.gene) g LATERAL VIEW explode(g.lengths) l AS length LATERAL VIEW posexplode(g.rs) s AS k, rscu) x
  JOIN codon_dim d ON d.codon = x.codon AND d.sense GROUP BY d.codon, d.aa, d.family""")
query("st10_delta_rscu", """SELECT codon, aa, round(all_mean, 6) AS ref_rscu, round(high_mean, 6) AS high_rscu, round(high_mean - all_mean, 6) AS delta_rscu,
  round((ln(greatest(high_mean, 1e-6)) - avg(ln(greatest(high_mean, 1e-6))) OVER ()) - (ln(greatest(all_mean, 1e-6)) - avg(ln(greatest(all_mean, 1e-6))) OVER ()), 6) AS delta_clr FROM high_mean WHERE high_mean IS NOT NULL AND all_mean IS NOT NULL""")
query("be02_optimal_codons", "SELECT codon, family, CASE WHEN row_number() OVER (PARTITION BY family ORDER BY d DESC, codon) = 1 THEN 2 WHEN d > 5e-2 THEN 1 ELSE 0 END AS is_optimal, round(d, 6) AS delta FROM (SELECT codon, family, high_mean - all_mean AS d FROM high_mean WHERE high_mean IS NOT NULL) x")
query("wn05_positional_fop", """SELECT region, count(DISTINCT gene) AS n_genes, round(CAST(sum(CASE WHEN w.w >= 1e0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*), 6) AS fop
  FROM (SELECT p.gene, p.codon, CASE WHEN p.pos <= k.region THEN 'five_prime' WHEN p.pos > k.total - k.region THEN 'three_prime' ELSE 'middle' END AS region
  FROM codon_pos p JOIN (SELECT gene, floor(length / 3) AS total, least(200, greatest(30, floor(floor(length / 3) / 5))) AS region FROM genes WHERE length >= 300) k ON k.gene = p.gene) z JOIN w_ref w USING (codon) GROUP BY region""")
query("mv03_rscu_distance", """SELECT r.gene, round(sqrt(sum(pow(r.rscu - s.rscu, 2))), 6) AS euclidean, round(sqrt(sum(pow(r.rscu - s.rscu, 2) / greatest(s.rscu, 1e-10))), 6) AS chi_squared FROM rscu r JOIN set_rscu s ON s.codon = r.codon AND s.gene_set = 'reference'
  WHERE r.rscu IS NOT NULL AND s.rscu IS NOT NULL GROUP BY r.gene HAVING count(*) = 59""")
relation("gene_clr", "SELECT gene, codon, ln(greatest(coalesce(rscu, 0e0), 1e-6)) - avg(ln(greatest(coalesce(rscu, 0e0), 1e-6))) OVER (PARTITION BY gene) AS x FROM rscu WHERE indep")
on_spark("gene_clrs", "SELECT gene, aggregate(ls, 0e0, (a, l) -> a + l, a -> transform(ls, l -> l - a / size(ls))) AS xs FROM (SELECT gene, transform(ind, x -> ln(greatest(coalesce(x, 0e0), 1e-6))) AS ls FROM gene_codons) y")
INDEP = [r[0] for r in codon_rows() if r[7]]
on_spark("indep_place", f"SELECT * FROM (VALUES {', '.join(f'({c!r}, {k})' for k, c in enumerate(INDEP))}) AS t(codon, k)")
on_spark("gene_clr", "SELECT /*+ BROADCAST(d) */ g.gene, d.codon, g.xs[d.k] AS x FROM gene_clrs g CROSS JOIN indep_place d")
relation("set_clr", "SELECT gene_set, s.codon, ln(greatest(coalesce(rscu, 0e0), 1e-6)) - avg(ln(greatest(coalesce(rscu, 0e0), 1e-6))) OVER (PARTITION BY gene_set) AS x FROM set_rscu s JOIN (SELECT codon FROM codon_dim WHERE indep) d ON d.codon = s.codon")
# Without a join its size is known to be small, so it is the side that is broadcast.
on_spark("set_clr", f"SELECT gene_set, codon, ln(greatest(coalesce(rscu, 0e0), 1e-6)) - avg(ln(greatest(coalesce(rscu, 0e0), 1e-6))) OVER (PARTITION BY gene_set) AS x FROM set_rscu WHERE codon IN ({', '.join(map(repr, INDEP))})")
query("sf05_aitchison", "SELECT g.gene, round(sqrt(sum(pow(g.x - s.x, 2))), 6) AS aitchison FROM gene_clr g JOIN set_clr s ON s.codon = g.codon AND s.gene_set = 'reference' GROUP BY g.gene")
query("sg01_gene_signature", "SELECT g.gene, g.codon, round(g.x - s.x, 6) AS delta_clr FROM gene_clr g JOIN set_clr s ON s.codon = g.codon AND s.gene_set = 'all'")
query("sg02_genome_signature", "SELECT s.sample_id, s.codon, round(s.x - r.x, 6) AS delta_clr FROM clr s JOIN set_clr r ON r.codon = s.codon AND r.gene_set = 'reference'")
query("mv04_enc_diff", "SELECT e.gene, round(e.enc, 6) AS enc, round(p.encprime, 6) AS encprime, round(e.enc - p.encprime, 6) AS enc_diff, round(2 + g.gc3 + 29 / (pow(g.gc3, 2) + pow(1 - g.gc3, 2)), 6) AS wright FROM enc e JOIN encprime p ON p.gene = e.gene JOIN gc g ON g.gene = e.gene")
relation("med", "SELECT metric, percentile(v, 0.5) AS med FROM sample_metric GROUP BY metric")
relation("mad", "SELECT s.metric, percentile(abs(s.v - m.med), 0.5) AS mad FROM sample_metric s JOIN med m ON m.metric = s.metric GROUP BY s.metric")
query("mv19_robust_z", "SELECT s.sample_id, s.metric, round(CASE WHEN d.mad < 1e-12 THEN 0e0 ELSE (s.v - m.med) / (1.4826e0 * d.mad) END, 6) AS z FROM sample_metric s JOIN med m ON m.metric = s.metric JOIN mad d ON d.metric = s.metric")
query("mv05_gc3_outliers", "SELECT gene, round(gc3 - m, 6) AS gc3_deviation, abs(gc3 - m) > 2 * s AS gc3_outlier FROM (SELECT gene, gc3, avg(gc3) OVER (PARTITION BY genome) AS m, stddev_pop(gc3) OVER (PARTITION BY genome) AS s, count(*) OVER (PARTITION BY genome) AS n FROM gc) x WHERE n > 5")
relation("foreign_gene", "SELECT gene, genome, gc3, abs(gc3 - avg(gc3) OVER (PARTITION BY genome)) > 1.5e0 * stddev_pop(gc3) OVER (PARTITION BY genome) AS flag FROM gc")
query("be06_islands", """SELECT genome, count(*) AS n_genes, min(gene) AS first_gene, max(gene) AS last_gene FROM (SELECT genome, gene, flag, sum(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY genome ORDER BY gene ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM foreign_gene) x WHERE flag GROUP BY genome, island HAVING count(*) >= 2""")
query("be03_mobile_elements", """SELECT f.gene, p.p_brand AS category, CASE WHEN p.p_brand = 'Brand#11' AND f.flag THEN 'category;foreign' WHEN p.p_brand = 'Brand#11' THEN 'category' ELSE 'foreign' END AS method FROM foreign_gene f LEFT JOIN part p ON p.p_partkey = f.gene WHERE f.flag OR p.p_brand = 'Brand#11'""")
query("co01_three_way_table", """SELECT a.codon, a.aa, a.family, round(a.rscu, 6) AS rscu_all, round(r.rscu, 6) AS rscu_ref, round(a.w, 6) AS w_all, round(r.w, 6) AS w_ref, row_number() OVER (PARTITION BY a.family ORDER BY a.w DESC, a.codon) = 1 AS best_all, row_number() OVER (PARTITION BY a.family ORDER BY r.w DESC, a.codon) = 1 AS best_ref
  FROM set_w a JOIN set_w r ON r.codon = a.codon AND r.gene_set = 'reference' WHERE a.gene_set = 'all' AND a.sense AND a.w IS NOT NULL AND r.w IS NOT NULL""")
relation("shifted", """SELECT a.codon, a.aa, a.family, a.w AS w_all, r.w AS w_ref, a.w - r.w AS delta, row_number() OVER (PARTITION BY a.family ORDER BY a.w DESC, a.codon) = 1 AS best_all, row_number() OVER (PARTITION BY a.family ORDER BY r.w DESC, a.codon) = 1 AS best_ref
  FROM set_w a JOIN set_w r ON r.codon = a.codon AND r.gene_set = 'reference' WHERE a.gene_set = 'all' AND a.sense AND a.w IS NOT NULL AND r.w IS NOT NULL""")
relation("best", """SELECT family, max(aa) AS aa, count(*) AS n_codons, max(CASE WHEN best_all THEN codon END) AS all_codon, max(CASE WHEN best_ref THEN codon END) AS ref_codon, max(CASE WHEN best_all THEN delta END) AS delta_all, max(CASE WHEN best_ref THEN delta END) AS delta_ref,
  max(CASE WHEN best_ref THEN w_all END) AS rec_w_all, max(CASE WHEN best_ref THEN w_ref END) AS rec_w_ref, max(abs(delta)) AS shift FROM shifted GROUP BY family""")
query("co02_optimization_summary", "SELECT family, aa, n_codons, all_codon, ref_codon, all_codon = ref_codon AS agree, round(delta_all, 6) AS delta_at_all, round(delta_ref, 6) AS delta_at_ref, round(shift, 6) AS max_shift FROM best")
query("co03_top_line", """SELECT b.n_families, b.n_agree, b.n_families - b.n_agree AS n_disagree, round(CAST(b.n_agree AS DOUBLE) / greatest(1, b.n_families), 6) AS agreement, s.median_shift, s.max_shift
  FROM (SELECT count(*) AS n_families, count(CASE WHEN all_codon = ref_codon THEN 1 END) AS n_agree FROM best) b CROSS JOIN (SELECT round(percentile(abs(delta), 0.5), 6) AS median_shift, round(max(abs(delta)), 6) AS max_shift FROM shifted) s""")
query("co04_recommendation", """SELECT aa, family, ref_codon AS recommended, CASE WHEN all_codon <> ref_codon THEN all_codon END AS alternative, CASE WHEN all_codon = ref_codon THEN 'both agree' ELSE ref_codon || ' differs from ' || all_codon END AS rationale, round(rec_w_all, 6) AS w_all, round(rec_w_ref, 6) AS w_ref,
  CASE WHEN all_codon = ref_codon OR shift >= 0.5e0 THEN 'high' WHEN shift >= 0.2e0 THEN 'medium' ELSE 'low' END AS confidence FROM best""")
query("gs03_partition", "SELECT s.gene, CASE WHEN r.gene IS NOT NULL THEN 'cluster' WHEN f.flag THEN 'outlier' ELSE 'bulk' END AS part FROM scores s LEFT JOIN refset r ON r.gene = s.gene LEFT JOIN foreign_gene f ON f.gene = s.gene")
query("gs02_goi_summary", "SELECT s.gene, round(s.enc, 6) AS enc, round(s.cai, 6) AS cai, s.is_goi = 1 AS is_goi, coalesce(f.flag, false) AS foreign_flag FROM split s LEFT JOIN foreign_gene f ON f.gene = s.gene WHERE s.is_goi = 1")
query("jn03_outer_join", "SELECT coalesce(a.gene, b.gene) AS gene, a.gene IS NOT NULL AS in_reference, b.gene IS NOT NULL AS in_interest FROM refset a FULL OUTER JOIN goi b ON a.gene = b.gene")
query("jn09_semi_anti", "SELECT 'in' AS side, count(*) AS n FROM genes WHERE gene IN (SELECT gene FROM refset) UNION ALL SELECT 'out' AS side, count(*) AS n FROM genes g WHERE NOT EXISTS (SELECT 1 FROM refset r WHERE r.gene = g.gene)")
query("jn10_bridge_join", "SELECT k.pathway, count(DISTINCT k.ko) AS n_ko, round(sum(m.v), 2) AS total FROM ko k JOIN ko_metric m ON m.ko = k.ko GROUP BY k.pathway")
query("so01_union", "SELECT gene, 'reference' AS origin FROM refset UNION ALL SELECT gene, 'interest' AS origin FROM goi")
query("so02_set_operations", "SELECT (SELECT count(*) FROM (SELECT gene FROM refset INTERSECT SELECT gene FROM goi) a) AS n_both, (SELECT count(*) FROM (SELECT gene FROM refset EXCEPT SELECT gene FROM goi) b) AS n_only, (SELECT count(*) FROM (SELECT gene FROM refset UNION SELECT gene FROM goi) c) AS n_any")
query("so03_jaccard", "SELECT round(count(CASE WHEN a.gene IS NOT NULL AND b.gene IS NOT NULL THEN 1 END) / CAST(nullif(count(*), 0) AS DOUBLE), 6) AS jaccard FROM refset a FULL OUTER JOIN goi b ON a.gene = b.gene")
query("dd01_keep_longest", "SELECT genome, cond, gene, length FROM (SELECT *, row_number() OVER (PARTITION BY genome, cond ORDER BY length DESC, gene) AS r FROM genes) x WHERE r = 1")
query("sl02_top_pairs", "SELECT a, b, round(cps, 6) AS cps, side FROM (SELECT a, b, cps, 'top' AS side, row_number() OVER (ORDER BY round(cps, 9) DESC, a, b) AS r FROM cps UNION ALL SELECT a, b, cps, 'bottom' AS side, row_number() OVER (ORDER BY round(cps, 9), a, b) AS r FROM cps) x WHERE r <= 10")
query("sl04_sample", "SELECT gene FROM genes ORDER BY md5(CAST(gene AS VARCHAR(20))), gene LIMIT 200")
query("sf01_02_sequences", "SELECT gene, md5(translate(seq, 'T', 'U')) AS rna, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS revcomp FROM cds")
# Wobble weights (Crick pairing; selective constraints as published by dos Reis and others, 2004).
relation("wobble", "SELECT * FROM (VALUES ('U', 'A', 1e0), ('U', 'G', 0.561e0), ('C', 'G', 1e0), ('G', 'C', 1e0), ('G', 'U', 0.561e0), ('A', 'U', 0.9999e0), ('A', 'C', 0.72e0), ('A', 'A', 0.32e0)) AS t(anticodon_base, codon_base, weight)")
relation("trna", "SELECT reverse(translate(codon, 'ACGU', 'UGCA')) AS anticodon, CAST(1 + n % 5 AS BIGINT) AS copies FROM codon_n WHERE n % 2 = 0")
relation("trna_codon", "SELECT d.codon, d.aa, sum(t.copies * w.weight) AS effective FROM trna t JOIN wobble w ON w.anticodon_base = substr(t.anticodon, 1, 1) JOIN codon_dim d ON substr(d.codon, 3, 1) = w.codon_base AND substr(d.codon, 1, 2) = translate(reverse(substr(t.anticodon, 2, 2)), 'ACGU', 'UGCA') GROUP BY d.codon, d.aa")
query("sf06_trna_wobble", "SELECT codon, aa, round(effective, 6) AS effective_trna FROM trna_codon")
query("st13_trna_correlation", "SELECT count(*) AS n_codons, round(corr(a, b), 6) AS rho FROM (SELECT rank() OVER (ORDER BY e) + (count(*) OVER (PARTITION BY e) - 1) / 2e0 AS a, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2e0 AS b FROM (SELECT round(coalesce(t.effective, 0e0), 9) AS e, round(s.rscu, 9) AS v FROM set_rscu s LEFT JOIN trna_codon t ON t.codon = s.codon WHERE s.gene_set = 'all' AND s.sense) z) x")
query("cm01_sample_metrics", "SELECT s.sample_id, s.cond, round(max(CASE WHEN metric = 'ENC' THEN v END), 6) AS mean_enc, round(max(CASE WHEN metric = 'GC3' THEN v END), 6) AS mean_gc3, round(max(CASE WHEN metric = 'CAI' THEN v END), 6) AS mean_cai FROM sample_metric s GROUP BY s.sample_id, s.cond")
query("cm03_sample_medians", """SELECT sample_id, cond, median_enc, median_encprime, round(median_enc - median_encprime, 6) AS median_enc_diff FROM (SELECT e.sample_id, e.cond, round(percentile(round(e.enc, 9), 0.5), 6) AS median_enc, round(percentile(round(p.encprime, 9), 0.5), 6) AS median_encprime
  FROM enc e JOIN encprime p ON p.gene = e.gene GROUP BY e.sample_id, e.cond) x""")
query("fg01_family_shares", "SELECT aa, codon, round(CAST(n AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY aa), 0), 6) AS share FROM set_rscu WHERE gene_set = 'all' AND sense")
query("fg15_genome_pairs", "SELECT x, y, round(d1, 6) AS distance, round(d2, 6) AS gc3_difference FROM dist2")
