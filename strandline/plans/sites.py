"""Queries over scoring rows, target sites and genotype records."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions import alleles as A
from strandline.operators import genotypes as G
from strandline.operators import targets as T
from strandline.plans.registry import query

_RAW = """SELECT accession, CASE WHEN row_nr % 2 = 0 THEN chrom ELSE substr(chrom, 4) END AS chr_name, CASE WHEN row_nr % 17 = 0 THEN 'NA' ELSE CAST(pos AS string) END AS position,
 lower(effect_allele) AS effect_allele, CASE WHEN row_nr % 3 = 0 THEN '' ELSE other_allele END AS other_allele, CASE WHEN row_nr % 2 = 0 THEN other_allele ELSE '' END AS inferred_other FROM {scorefile}"""


@query("q01_scan_normalise", f"""SELECT pgs_id, chrom, count(*) AS n_rows, count(pos) AS n_pos, count(other_allele) AS n_other, CAST(sum(pos) AS bigint) AS sum_pos, min(concat(effect_allele, coalesce(other_allele, '-'))) AS first_pair FROM (
 SELECT regexp_extract(accession, '^(PGS[0-9]+)', 1) AS pgs_id, CASE WHEN chr_name LIKE 'chr%' THEN chr_name ELSE 'chr' || chr_name END AS chrom, try_cast(position AS bigint) AS pos, upper(effect_allele) AS effect_allele,
 coalesce(nullif(upper(other_allele), ''), nullif(upper(inferred_other), '')) AS other_allele FROM ({_RAW})) GROUP BY 1, 2""")
def q01(v):
    rows = T.normalised(v.sql(_RAW))
    return rows.groupBy("pgs_id", "chrom").agg(F.count(F.lit(1)).alias("n_rows"), F.count("pos").alias("n_pos"), F.count("other_allele").alias("n_other"), F.sum("pos").alias("sum_pos"), F.min(F.concat("effect_allele", F.coalesce("other_allele", F.lit("-")))).alias("first_pair"))


_DIRTY = """SELECT CASE WHEN row_nr % 29 = 0 THEN 'chrX' WHEN row_nr % 31 = 0 THEN 'chrUn_1' ELSE chrom END AS chrom, CASE WHEN row_nr % 23 = 0 THEN 0 ELSE pos END AS pos,
 CASE WHEN row_nr % 19 = 0 THEN 'N' ELSE effect_allele END AS effect_allele, other_allele, substr(concat(a1, 'ACGTACGT'), 1, 9) AS genome, number * 100000000 + row_nr AS ord
 FROM (SELECT s.*, v2.a1, CAST(substr(pgs_id, 4) AS bigint) AS number FROM {scorefile} s JOIN {variant2} v2 ON s.row_nr = v2.vid)"""
_REF = """CASE WHEN effect_allele = other_allele THEN NULL WHEN genome LIKE effect_allele || '%' AND (NOT genome LIKE other_allele || '%' OR length(effect_allele) >= length(other_allele)) THEN effect_allele WHEN genome LIKE other_allele || '%' THEN other_allele END"""
_AUTO = ", ".join(f"'{c}'" for c in A.AUTOSOMES)


@query("q02_reject_reasons", f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (SELECT CASE WHEN chrom IN ('chrX', 'chrY', 'chrM') THEN 'sex_chromosome' WHEN chrom NOT IN ({_AUTO}) THEN 'off_contig' WHEN pos IS NULL OR pos <= 0 THEN 'bad_position'
 WHEN effect_allele IS NULL OR other_allele IS NULL THEN 'missing_allele' WHEN NOT regexp_matches(effect_allele, '^[ACGT]+$') OR NOT regexp_matches(other_allele, '^[ACGT]+$') THEN 'not_acgt' WHEN ({_REF}) IS NULL THEN 'reference_mismatch' END AS reason FROM ({_DIRTY})) GROUP BY 1""")
def q02(v):
    return v.sql(_DIRTY).groupBy(F.coalesce(T.reject_reason("genome"), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_SITES = f"""WITH known AS (SELECT *, CASE WHEN ref = effect_allele THEN other_allele ELSE effect_allele END AS alt FROM (SELECT *, {_REF} AS ref FROM ({_DIRTY}) WHERE other_allele IS NOT NULL) WHERE ref IS NOT NULL),
 firsts AS (SELECT chrom, pos, arg_min(ref, ord) AS site_ref, count(*) AS n FROM known GROUP BY 1, 2),
 same AS (SELECT k.chrom, k.pos, k.ref, n, alt, min(ord) AS ord, count(*) AS k FROM known k JOIN firsts f ON k.chrom = f.chrom AND k.pos = f.pos AND k.ref = f.site_ref GROUP BY 1, 2, 3, 4, 5)
 SELECT chrom, pos, ref, string_agg(alt, ',' ORDER BY ord) AS alts, CAST(n - sum(k) AS bigint) AS conflicts FROM same GROUP BY chrom, pos, ref, n"""


@query("q03_target_sites", _SITES)
def q03(v):
    return T.target_sites(v.sql(_DIRTY).where("other_allele is not null")).withColumn("alts", F.array_join("alts", ","))


@query("q04_first_alt_table", f"SELECT chrom, pos, ref, split_part(alts, ',', 1) AS first_alt FROM ({_SITES})".replace("SELECT chrom, pos, ref, split_part", "SELECT chrom, pos, ref, split_part", 1))
def q04(v):
    return T.first_alt_table(T.target_sites(v.sql(_DIRTY).where("other_allele is not null")))


@query("q05_gt_classes", """SELECT gt, kind, called, count(*) AS n FROM (SELECT gt, CASE WHEN len(a) = 2 AND NOT list_contains(a, '.') THEN CASE WHEN a[1] <> a[2] THEN 'het' WHEN a[1] <> '0' THEN 'homalt' END END AS kind, NOT list_contains(a, '.') AS called
 FROM (SELECT gt, string_split(replace(gt, '|', '/'), '/') AS a FROM {record})) GROUP BY 1, 2, 3""")
def q05(v):
    return v.record.groupBy("gt", A.gt_class("gt").alias("kind"), A.gt_called("gt").alias("called")).agg(F.count(F.lit(1)).alias("n"))


_GTS = "SELECT iid, CASE WHEN dosage = 0 THEN '0/0' WHEN dosage = 1 AND vid % 25 < iid THEN '0/1' ELSE '1/1' END AS gt FROM {g25}"


@query("q06_sex_from_gt", f"""SELECT *, CASE WHEN n_het + n_hom < 50 THEN 'unknown' WHEN n_het / (n_het + n_hom) >= 0.25 THEN 'female' WHEN n_het / (n_het + n_hom) < 0.10 THEN 'male' ELSE 'unknown' END AS sex
 FROM (SELECT iid, count(*) FILTER (gt = '0/1') AS n_het, count(*) FILTER (gt = '1/1') AS n_hom FROM ({_GTS}) GROUP BY iid)""")
def q06(v):
    return G.sex_from_genotypes(v.sql(_GTS))


@query("q07_sex_from_coverage", f"""SELECT *, CASE WHEN x_ratio >= 0.80 AND y_ratio <= 0.15 THEN 'female' WHEN x_ratio <= 0.70 AND y_ratio >= 0.12 THEN 'male' ELSE 'unknown' END AS sex FROM (
 SELECT iid, round(max(cov) FILTER (contig = 'chrX') / avg(cov) FILTER (contig IN ({_AUTO}) AND cov > 0), 6) AS x_ratio, round(max(cov) FILTER (contig = 'chrY') / avg(cov) FILTER (contig IN ({_AUTO}) AND cov > 0), 6) AS y_ratio
 FROM (SELECT *, mapped / length AS cov FROM {{idxstat}}) GROUP BY iid)""")
def q07(v):
    return G.sex_from_coverage(v.idxstat)


_REPAIR = """SELECT *, CASE WHEN alt = '.' AND variant THEN 'dropped_homref' WHEN nth > 1 THEN 'dropped_dup' ELSE 'kept' END AS fate FROM (
 SELECT *, count(*) OVER (PARTITION BY iid, chrom, pos) > 1 AS multi, bool_or(alt <> '.') OVER (PARTITION BY iid, chrom, pos) AS variant, row_number() OVER (PARTITION BY iid, chrom, pos, ref, alt ORDER BY ord) AS nth FROM {record})"""


@query("q08_multirecord_repair", f"SELECT iid, chrom, fate, multi, count(*) AS n, CAST(sum(ord) AS bigint) AS sum_ord FROM ({_REPAIR}) GROUP BY 1, 2, 3, 4")
def q08(v):
    return G.repaired(v.record).groupBy("iid", "chrom", "fate", "multi").agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("sum_ord"))


_FILL = f"""SELECT r.*, t.first_alt IS NOT NULL AS filled, coalesce(t.first_alt, r.alt) AS new_alt, CASE WHEN t.first_alt IS NOT NULL THEN CAST(depth AS string) || ',0' ELSE CAST(depth AS string) END AS ad
 FROM ({_REPAIR}) r LEFT JOIN {{allele}} t ON r.chrom = t.chrom AND r.pos = t.pos AND upper(r.ref) = t.ref AND r.alt = '.' AND NOT r.multi"""


@query("q09_alt_fill", f"SELECT iid, chrom, pos, ord, new_alt, ad FROM ({_FILL}) WHERE fate = 'kept' AND filled")
def q09(v):
    return G.alt_filled(G.repaired(v.record), v.allele).where("fate = 'kept' and filled").select("iid", "chrom", "pos", "ord", "new_alt", "ad")


@query("q10_repair_counters", f"""SELECT iid, count(*) FILTER (alt = '.') AS homref, count(*) FILTER (filled) AS filled, count(DISTINCT CASE WHEN multi THEN concat(chrom, ':', pos) END) AS skipped_multirecord,
 count(*) FILTER (fate = 'dropped_homref') AS dropped_homref, count(*) FILTER (fate = 'dropped_dup') AS dropped_dup FROM ({_FILL}) GROUP BY iid""")
def q10(v):
    return G.repair_counters(G.alt_filled(G.repaired(v.record), v.allele))


_TARGETS = "SELECT DISTINCT chrom, pos FROM {record} WHERE pos % 7 < 3 UNION SELECT DISTINCT chrom + 0, pos + 1 FROM {record} WHERE pos % 7 = 5"


@query("q11_footprint_fraction", f"""WITH targets AS ({_TARGETS}), span AS (SELECT iid, chrom, min(pos) AS lo, max(pos) AS hi FROM {{record}} GROUP BY 1, 2),
 inside AS (SELECT iid, count(DISTINCT (t.chrom, t.pos)) AS n_targets FROM targets t JOIN span s ON t.chrom = s.chrom AND t.pos BETWEEN lo AND hi GROUP BY 1),
 explicit AS (SELECT r.iid, count(DISTINCT (r.chrom, r.pos)) AS n_explicit FROM {{record}} r JOIN targets t ON r.chrom = t.chrom AND r.pos = t.pos WHERE NOT r.gt LIKE '%.%' GROUP BY 1)
 SELECT i.iid, coalesce(n_explicit, 0) AS n_explicit, n_targets, round(coalesce(n_explicit, 0) / n_targets, 6) AS fraction, coalesce(n_explicit, 0) / n_targets >= 0.5 AS all_sites FROM inside i LEFT JOIN explicit e ON i.iid = e.iid""")
def q11(v):
    return G.explicit_fraction(v.record, v.sql(_TARGETS))


_IMPORT = "SELECT vid, chrom, pos, CASE WHEN vid % 13 = 0 THEN repeat(a1, 101) ELSE a1 END AS ref, CASE WHEN vid % 9 = 0 THEN concat(a2, ',', a1) ELSE a2 END AS alt FROM {variant}"


@query("q12_import_filter_ids", f"SELECT vid, CASE WHEN greatest(length(ref), length(alt)) <= 100 THEN concat(chrom, ':', CAST(pos AS string), ':', ref, ':', alt) END AS id FROM ({_IMPORT}) WHERE NOT contains(alt, ',')")
def q12(v):
    return v.sql(_IMPORT).where(F.size(F.split("alt", ",")) == 1).select("vid", G.variant_id().alias("id"))


@query("q13_freq_missing", """SELECT vid, round(alt / (2 * called), 6) AS alt_freq, round(1 - called / n, 6) AS f_miss, round(least(alt / (2 * called), 1 - alt / (2 * called)), 6) AS maf
 FROM (SELECT vid, sum(dosage) AS alt, nullif(count(dosage), 0) AS called, count(*) AS n FROM {g200} GROUP BY vid) WHERE called IS NOT NULL
 UNION ALL SELECT vid, NULL, 1.0, NULL FROM (SELECT vid FROM {g200} GROUP BY vid HAVING count(dosage) = 0)""")
def q13(v):
    return G.frequencies(v.g200)


@query("q13b_panel_qc", """SELECT vid, round(q, 6) AS alt_freq, round(chi, 6) AS hwe_chi FROM (SELECT *, CASE WHEN (1-q)*(1-q)*c > 0 THEN pow(n0 - (1-q)*(1-q)*c, 2) / ((1-q)*(1-q)*c) ELSE 0 END + CASE WHEN 2*q*(1-q)*c > 0 THEN pow(n1 - 2*q*(1-q)*c, 2) / (2*q*(1-q)*c) ELSE 0 END + CASE WHEN q*q*c > 0 THEN pow(n2 - q*q*c, 2) / (q*q*c) ELSE 0 END AS chi
 FROM (SELECT *, (n1 + 2 * n2) / (2 * c) AS q FROM (SELECT vid, count(*) FILTER (dosage = 0) AS n0, count(*) FILTER (dosage = 1) AS n1, count(*) FILTER (dosage = 2) AS n2, count(dosage) AS c, count(*) AS n FROM {g200} GROUP BY vid) WHERE c > 0))
 WHERE 1 - c / n <= 0.1 AND least(q, 1 - q) >= 0.05 AND chi < 15.136705""")
def q13b(v):
    return G.panel_qc(v.g200, v.variant)
