"""Codon counts, synonymous usage, effective numbers of codons, adaptation and pairs."""

from synonymy.functions.codons import codon_rows
from synonymy.plans.relations import on_spark, query, relation

# On Spark a gene's counts of the 64 codons are one array (gene_ns), so what its codons share needs no shuffle.
CODON = f"array({', '.join(repr(r[0]) for r in codon_rows())})"

relation("genes", "SELECT DISTINCT gene, sample_id, genome, cond, length FROM cds")
on_spark("genes", "SELECT gene, sample_id, genome, cond, length FROM gene_ns g LATERAL VIEW explode(g.lengths) t AS length")
relation("cl", "SELECT gene, sample_id, genome, cond, codon, count(*) AS n FROM codon_pos JOIN codon_dim USING (codon) GROUP BY gene, sample_id, genome, cond, codon")
# A row for each place is made by a join: Spark takes exploded arrays to be no larger than the compressed files they are in, and would send these rows to all workers through the driver.
on_spark("codon_place", f"SELECT * FROM (VALUES {', '.join(f'({r[0]!r}, {k})' for k, r in enumerate(codon_rows()))}) AS t(codon, k)")
on_spark("cl", "SELECT /*+ BROADCAST(d) */ g.gene, g.sample_id, g.genome, g.cond, d.codon, g.ns[d.k] AS n FROM gene_ns g CROSS JOIN codon_place d WHERE g.ns[d.k] > 0")
relation("grid", """SELECT g.gene, g.sample_id, g.genome, g.cond, d.codon, d.aa, d.family, d.fold, d.ffold, d.indep, coalesce(c.n, 0) AS n
  FROM genes g CROSS JOIN (SELECT * FROM codon_dim WHERE sense) d LEFT JOIN cl c ON c.gene = g.gene AND c.codon = d.codon""")
on_spark("grid_rs", f"""SELECT x.gene, x.sample_id, x.genome, x.cond, d.codon, d.aa, d.family, d.fold, d.ffold, d.indep, CASE WHEN x.gene IS NULL THEN 0L ELSE x.n END AS n, x.rscu
  FROM (SELECT g.gene, g.sample_id, g.genome, g.cond, {CODON}[t.k] AS codon, t.n, g.rs[t.k] AS rscu FROM gene_ns g LATERAL VIEW explode(g.lengths) s AS length LATERAL VIEW posexplode(g.ns) t AS k, n) x JOIN codon_dim d ON d.codon = x.codon AND d.sense""")
on_spark("grid", "SELECT gene, sample_id, genome, cond, codon, aa, family, fold, ffold, indep, n FROM grid_rs")
relation("rscu", "SELECT *, CAST(n * ffold AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY gene, family), 0) AS rscu FROM grid")
on_spark("rscu", "SELECT * FROM grid_rs")
relation("refset", "SELECT DISTINCT doc_id AS gene FROM labels WHERE quality = 1")
relation("goi", "SELECT DISTINCT doc_id AS gene FROM labels WHERE toxic = 1")
relation("member", "SELECT 'all' AS gene_set, gene FROM genes UNION ALL SELECT 'reference' AS gene_set, gene FROM refset")
relation("pooled", "SELECT gene_set, codon, sum(n) AS n FROM member JOIN cl USING (gene) GROUP BY gene_set, codon")
relation("set_rscu", """SELECT s.gene_set, d.codon, d.aa, d.family, d.fold, d.ffold, d.sense, coalesce(p.n, 0) AS n,
  CASE WHEN d.sense THEN CAST(coalesce(p.n, 0) * d.ffold AS DOUBLE) / nullif(sum(coalesce(p.n, 0)) OVER (PARTITION BY s.gene_set, d.family), 0) END AS rscu
  FROM (SELECT DISTINCT gene_set FROM member) s CROSS JOIN codon_dim d LEFT JOIN pooled p ON p.gene_set = s.gene_set AND p.codon = d.codon""", kept=True)
relation("set_w", "SELECT *, rscu / nullif(max(rscu) OVER (PARTITION BY gene_set, family), 0) AS w FROM set_rscu")
relation("w_ref", "SELECT codon, aa, family, rscu, greatest(w, 1e-3) AS w FROM set_w WHERE gene_set = 'reference' AND sense AND w IS NOT NULL")
relation("weights", """SELECT r.codon, r.aa, r.family, r.fold, r.rscu AS rscu_ref, a.rscu AS rscu_all, ln((r.rscu + 1e-2) / (a.rscu + 1e-2)) AS weight
  FROM set_rscu r JOIN set_rscu a ON a.codon = r.codon AND a.gene_set = 'all' WHERE r.gene_set = 'reference' AND r.sense""")
relation("optimal", """SELECT aa, codon, fold, weight FROM (SELECT *, row_number() OVER (PARTITION BY aa ORDER BY weight DESC, codon) AS r,
  lead(weight) OVER (PARTITION BY aa ORDER BY weight DESC, codon) AS second FROM weights WHERE weight IS NOT NULL) x WHERE r = 1 AND (second IS NULL OR weight - second > 1e-6)""")
relation("enc_aa", """SELECT gene, aa, fold, (tot * sq - 1e0) / (tot - 1e0) AS f FROM (SELECT gene, aa, fold, sum(n) AS tot, sum(CAST(n AS DOUBLE) * n) / (CAST(sum(n) AS DOUBLE) * sum(n)) AS sq
  FROM cl JOIN (SELECT * FROM codon_dim WHERE sense) d USING (codon) GROUP BY gene, aa, fold) x WHERE tot > 1""")
relation("enc_fold", "SELECT gene, fold, avg(f) AS f FROM enc_aa GROUP BY gene, fold")
relation("enc", """SELECT g.gene, g.sample_id, g.genome, g.cond, g.length, least(61e0, 2e0 + sum(CASE WHEN e.f > 0 THEN k.fams / e.f ELSE k.fams * k.fold END)) AS enc
  FROM genes g CROSS JOIN (SELECT fold, CAST(count(DISTINCT aa) AS DOUBLE) AS fams FROM codon_dim WHERE sense GROUP BY fold) k LEFT JOIN enc_fold e ON e.gene = g.gene AND e.fold = k.fold
  GROUP BY g.gene, g.sample_id, g.genome, g.cond, g.length""")
relation("gc", """SELECT gene, sample_id, genome, cond, sum(n) AS codons, CAST(sum(n * gc1) AS DOUBLE) / sum(n) AS gc1, CAST(sum(n * gc2) AS DOUBLE) / sum(n) AS gc2,
  CAST(sum(n * (gc1 + gc2)) AS DOUBLE) / (2 * sum(n)) AS gc12, CAST(sum(n * gc3) AS DOUBLE) / sum(n) AS gc3 FROM cl JOIN codon_dim USING (codon) GROUP BY gene, sample_id, genome, cond""")
relation("cai", """SELECT c.gene, c.sample_id, c.genome, c.cond, exp(sum(c.n * ln(w.w)) / sum(c.n)) AS cai, CAST(sum(CASE WHEN w.w >= 1e0 THEN c.n ELSE 0 END) AS DOUBLE) / sum(c.n) AS fop
  FROM cl c JOIN w_ref w USING (codon) GROUP BY c.gene, c.sample_id, c.genome, c.cond""")
relation("freq", """SELECT gene_set, codon, CAST(n AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY gene_set, aa), 0) AS f FROM set_rscu WHERE sense""")
relation("aa_n", "SELECT gene, aa, fold, codon, n, sum(n) OVER (PARTITION BY gene, aa) AS n_aa, sum(n) OVER (PARTITION BY gene) AS total FROM grid")
on_spark("aa_n", f"""SELECT x.gene, d.aa, d.fold, d.codon, CASE WHEN x.gene IS NULL THEN 0L ELSE x.n END AS n, x.n_aa, x.total, x.present
  FROM (SELECT g.gene, {CODON}[t.k] AS codon, t.n, g.n_aa[t.k] AS n_aa, g.total, g.present FROM gene_ns g LATERAL VIEW explode(g.lengths) s AS length LATERAL VIEW posexplode(g.ns) t AS k, n) x JOIN codon_dim d ON d.codon = x.codon AND d.sense""")
MILC = """SELECT a.gene, f.gene_set, sum(CASE WHEN a.n > 0 AND f.f > 0 THEN 2e0 * a.n * ln(a.n / (a.n_aa * f.f)) ELSE 0e0 END) / max(a.total)
  - ((sum(CASE WHEN a.n > 0 THEN 1e0 ELSE 0e0 END) - count(DISTINCT CASE WHEN a.n > 0 THEN a.aa END)) / max(a.total) - 5e-1) AS milc
  FROM aa_n a JOIN freq f USING (codon) WHERE a.total > 0 GROUP BY a.gene, f.gene_set"""
relation("milc", MILC, kept=True)
on_spark("milc", MILC.replace("count(DISTINCT CASE WHEN a.n > 0 THEN a.aa END)", "max(a.present)"))
relation("melp", "SELECT a.gene, a.milc AS milc_all, r.milc AS milc_ref, a.milc / nullif(r.milc, 0) AS melp FROM milc a JOIN milc r ON r.gene = a.gene AND r.gene_set = 'reference' WHERE a.gene_set = 'all'")
relation("encp_aa", """SELECT gene, aa, fold, (n_aa + x2 - fold) / (fold * (n_aa - 1e0)) AS f FROM (SELECT a.gene, a.aa, a.fold, max(a.n_aa) AS n_aa,
  sum(CASE WHEN f.f > 0 THEN a.n_aa * pow(CAST(a.n AS DOUBLE) / a.n_aa - f.f, 2) / f.f ELSE 0e0 END) AS x2 FROM aa_n a JOIN freq f ON f.codon = a.codon AND f.gene_set = 'all' WHERE a.n_aa > 1 GROUP BY a.gene, a.aa, a.fold) x""")
relation("encprime", """SELECT g.gene, least(61e0, 2e0 + sum(CASE WHEN e.f > 0 THEN k.fams / e.f ELSE k.fams * k.fold END)) AS encprime
  FROM genes g CROSS JOIN (SELECT fold, CAST(count(DISTINCT aa) AS DOUBLE) AS fams FROM codon_dim WHERE sense GROUP BY fold) k
  LEFT JOIN (SELECT gene, fold, avg(f) AS f FROM encp_aa GROUP BY gene, fold) e ON e.gene = g.gene AND e.fold = k.fold GROUP BY g.gene""")

query("pf01_min_length", "SELECT gene, sample_id, length FROM cds WHERE length >= 300")
query("ag01_codon_counts", "SELECT gene, codon, n FROM cl")
query("ag02_rscu_gene", "SELECT gene, family || '-' || codon AS rscu_col, round(rscu, 6) AS rscu FROM rscu")
query("ag03_rscu_median", "SELECT sample_id, codon, round(percentile(rscu, 0.5), 6) AS med, round(percentile(rscu, 0.75) - percentile(rscu, 0.25), 6) AS iqr FROM rscu GROUP BY sample_id, codon")
query("ag04_codon_frequency", """SELECT codon, aa, family, CAST(n AS BIGINT) AS n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS frequency, round(rscu, 4) AS rscu,
  round(1000e0 * n / sum(n) OVER (), 2) AS per_thousand FROM set_rscu WHERE gene_set = 'all'""")
query("ag05_rscu_pooled", """SELECT sample_id, codon, round(CAST(n * ffold AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY sample_id, family), 0), 6) AS rscu
  FROM (SELECT sample_id, codon, family, ffold, sum(n) AS n FROM grid GROUP BY sample_id, codon, family, ffold) x""")
query("ag06_enc", "SELECT gene, length, round(enc, 6) AS enc FROM enc")
query("ag07_gc3", "SELECT gene, round(gc3, 6) AS gc3 FROM gc")
query("ag08_gc12_gc3", "SELECT gene, round(gc1, 6) AS gc1, round(gc2, 6) AS gc2, round(gc12, 6) AS gc12, round(gc3, 6) AS gc3 FROM gc")
query("ag09_pr2", """SELECT gene, round(CAST(a AS DOUBLE) / (a + t), 6) AS a3, round(CAST(g AS DOUBLE) / (g + c), 6) AS g3, CAST(a + t + g + c AS BIGINT) AS n_fourfold
  FROM (SELECT gene, sum(CASE WHEN substr(codon, 3, 1) = 'A' THEN n ELSE 0 END) AS a, sum(CASE WHEN substr(codon, 3, 1) = 'U' THEN n ELSE 0 END) AS t, sum(CASE WHEN substr(codon, 3, 1) = 'G' THEN n ELSE 0 END) AS g,
  sum(CASE WHEN substr(codon, 3, 1) = 'C' THEN n ELSE 0 END) AS c FROM cl JOIN codon_dim USING (codon) WHERE fourfold GROUP BY gene) x WHERE a + t > 0 AND g + c > 0 AND a + t + g + c >= 30""")
query("ag10_12_set_tables", """SELECT gene_set, codon, aa, CAST(n AS BIGINT) AS n, round(1000e0 * n / sum(n) OVER (PARTITION BY gene_set), 2) AS per_thousand,
  round(CASE WHEN aa IN ('Met', 'Trp') THEN 1e0 ELSE rscu END, 4) AS rscu FROM set_rscu""")
query("ag13_relative_adaptiveness", "SELECT gene_set, codon, aa, round(CASE WHEN aa IN ('Met', 'Trp') THEN 1e0 ELSE w END, 4) AS w FROM set_w")
query("ag14_adaptation_weights", "SELECT codon, aa, round(rscu_ref, 6) AS rscu_ref, round(rscu_all, 6) AS rscu_all, round(weight, 6) AS weight, weight > 0 AS is_optimal FROM weights")
query("ag15_optimal_codons", "SELECT aa, codon, round(weight, 6) AS weight FROM optimal")
query("ag16_cbi", """SELECT gene, CAST(tot AS BIGINT) AS n_total, CAST(opt AS BIGINT) AS n_optimal, round(CASE WHEN tot - rnd <= 0 THEN 0e0 ELSE (opt - rnd) / (tot - rnd) END, 4) AS cbi
  FROM (SELECT g.gene, sum(g.n) AS tot, sum(CASE WHEN g.codon = o.codon THEN g.n ELSE 0 END) AS opt, sum(CAST(g.n AS DOUBLE) / o.fold) AS rnd FROM grid g JOIN optimal o ON o.aa = g.aa GROUP BY g.gene) x WHERE tot > 0""")
query("ag24_expression_scores", "SELECT c.gene, round(c.cai, 6) AS cai, round(c.fop, 6) AS fop, round(m.milc_all, 6) AS milc, round(m.melp, 6) AS melp, round(e.encprime, 6) AS encprime FROM cai c JOIN melp m ON m.gene = c.gene JOIN encprime e ON e.gene = c.gene")
query("ag25_weighted_set_rscu", """SELECT codon, round(n * ffold / nullif(sum(n) OVER (PARTITION BY family), 0), 6) AS rscu
  FROM (SELECT codon, family, ffold, sum(g.n * (1e0 + g.gene % 3)) AS n FROM grid g JOIN refset r ON r.gene = g.gene GROUP BY codon, family, ffold) x""")
query("ag28_30_rare_codons", """SELECT c.gene, round(sum(CASE WHEN w.w < 3e-1 THEN c.n * (1e0 - w.w) ELSE 0e0 END) / sum(c.n), 6) AS burden, CAST(sum(CASE WHEN w.rscu < 1e-1 THEN c.n ELSE 0 END) AS BIGINT) AS n_rare, CAST(max(floor(g.length / 3)) AS BIGINT) AS length_codons
  FROM cl c JOIN w_ref w USING (codon) JOIN genes g ON g.gene = c.gene GROUP BY c.gene""")
query("ag31_two_way_cai", """SELECT c.gene, round(exp(sum(CASE WHEN w.gene_set = 'all' THEN c.n * ln(greatest(w.w, 1e-3)) END) / sum(CASE WHEN w.gene_set = 'all' THEN c.n END)), 6) AS cai_all,
  round(exp(sum(CASE WHEN w.gene_set = 'reference' THEN c.n * ln(greatest(w.w, 1e-3)) END) / sum(CASE WHEN w.gene_set = 'reference' THEN c.n END)), 6) AS cai_ref
  FROM cl c JOIN set_w w ON w.codon = c.codon AND w.sense AND w.w IS NOT NULL GROUP BY c.gene""")

relation("pair", """SELECT x.gene, x.codon AS a, x.nxt AS b, count(*) AS n FROM (SELECT gene, codon, lead(codon) OVER (PARTITION BY gene ORDER BY pos) AS nxt FROM codon_pos) x
  JOIN codon_dim da ON da.codon = x.codon AND da.coding JOIN codon_dim db ON db.codon = x.nxt AND db.coding GROUP BY x.gene, x.codon, x.nxt""", kept=True)
relation("codon_n", "SELECT d.codon, d.aa, sum(c.n) AS n, sum(sum(c.n)) OVER (PARTITION BY d.aa) AS n_aa FROM cl c JOIN codon_dim d ON d.codon = c.codon AND d.coding GROUP BY d.codon, d.aa")
relation("cps", """SELECT p.a, p.b, p.n, ln(p.n / ((CAST(x.n AS DOUBLE) * y.n) / (CAST(x.n_aa AS DOUBLE) * y.n_aa) * p.n_aa)) AS cps
  FROM (SELECT q.a, q.b, q.n, da.aa AS aa1, db.aa AS aa2, sum(q.n) OVER (PARTITION BY da.aa, db.aa) AS n_aa FROM (SELECT a, b, sum(n) AS n FROM pair GROUP BY a, b) q JOIN codon_dim da ON da.codon = q.a JOIN codon_dim db ON db.codon = q.b) p
  JOIN codon_n x ON x.codon = p.a JOIN codon_n y ON y.codon = p.b""", kept=True)
relation("cpb", "SELECT p.gene, sum(p.n) AS n_pairs, sum(p.n * c.cps) / sum(p.n) AS cpb FROM pair p JOIN cps c ON c.a = p.a AND c.b = p.b GROUP BY p.gene")
relation("bases", "SELECT DISTINCT substr(codon, 1, 1) AS base FROM codon_dim")
relation("junction", "SELECT substr(a, 3, 1) AS x, substr(b, 1, 1) AS y, sum(n) AS n FROM pair GROUP BY substr(a, 3, 1), substr(b, 1, 1)")
relation("bridge", """SELECT x.base || y.base AS dinucleotide, CAST(coalesce(j.n, 0) AS DOUBLE) AS n, sum(CAST(coalesce(j.n, 0) AS DOUBLE)) OVER () AS total,
  sum(CAST(coalesce(j.n, 0) AS DOUBLE)) OVER (PARTITION BY x.base) AS nx, sum(CAST(coalesce(j.n, 0) AS DOUBLE)) OVER (PARTITION BY y.base) AS ny FROM bases x CROSS JOIN bases y LEFT JOIN junction j ON j.x = x.base AND j.y = y.base""")
query("ag17_codon_pairs", "SELECT a, b, CAST(sum(n) AS BIGINT) AS n FROM pair GROUP BY a, b")
query("ag18_cps", "SELECT a, b, CAST(n AS BIGINT) AS n, round(cps, 6) AS cps FROM cps")
query("ag19_gene_cpb", "SELECT gene, CAST(n_pairs AS BIGINT) AS n_pairs, round(cpb, 6) AS cpb FROM cpb")
query("ag20_foreign_cpb", """SELECT f.gene AS item_id, count(*) AS n_pairs, count(c.cps) AS n_scored, round(avg(c.cps), 6) AS cpb, round(avg(coalesce(c.cps, -1e0)), 6) AS cpb_penalised
  FROM (SELECT gene, codon AS a, lead(codon) OVER (PARTITION BY gene ORDER BY pos) AS b FROM foreign_pos) f JOIN codon_dim x ON x.codon = f.a AND x.coding JOIN codon_dim y ON y.codon = f.b AND y.coding
  LEFT JOIN cps c ON c.a = f.a AND c.b = f.b GROUP BY f.gene""")
query("ag21_bridge_bias", "SELECT dinucleotide, CAST(n AS BIGINT) AS n, round(n / total / nullif(nx / total * (ny / total), 0), 4) AS rho, dinucleotide = 'CG' AS is_cpg, dinucleotide = 'UA' AS is_upa FROM bridge")
query("ag22_pair_summary", "SELECT (SELECT round(avg(cpb), 6) FROM cpb) AS mean_cpb, (SELECT round(percentile(cpb, 0.5), 6) FROM cpb) AS median_cpb, round(sum(n * cps) / sum(n), 6) AS overall_cps, round(count(*) / 3721e0, 6) AS share_observed FROM cps")
