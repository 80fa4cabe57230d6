"""Queries over matches, scores and calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import calibrate as C
from strandline.operators import match as M
from strandline.operators import score as S
from strandline.plans.registry import query
from strandline.plans.views import VIEWS

VIEWS["scoredup"] = """
    SELECT accession, pgs_id, trait, row_nr, chrom, pos, w, effect_type, effect_allele, CASE WHEN row_nr % 7 = 0 THEN NULL ELSE other_allele END AS other_allele FROM {scorefile}
    UNION ALL SELECT accession, pgs_id, trait, row_nr + 1000000, chrom, pos, -w, effect_type, effect_allele, other_allele FROM {scorefile} WHERE row_nr % 37 = 0
    UNION ALL SELECT accession, pgs_id, trait, row_nr + 2000000, chrom, pos + 1, w, effect_type, effect_allele, other_allele FROM {scorefile} WHERE row_nr % 41 = 0"""

_FIT = """SELECT s.*, v.vid, v.a1, v.a2, unnest(list_filter([CASE WHEN effect_allele = a1 AND other_allele = a2 THEN 1 END, CASE WHEN effect_allele = a2 AND other_allele = a1 THEN 2 END,
 CASE WHEN translate(effect_allele, 'ACGT', 'TGCA') = a1 AND translate(other_allele, 'ACGT', 'TGCA') = a2 THEN 3 END, CASE WHEN translate(effect_allele, 'ACGT', 'TGCA') = a2 AND translate(other_allele, 'ACGT', 'TGCA') = a1 THEN 4 END,
 CASE WHEN other_allele IS NULL AND effect_allele = a1 THEN 5 END, CASE WHEN other_allele IS NULL AND effect_allele = a2 THEN 6 END, CASE WHEN other_allele IS NULL AND translate(effect_allele, 'ACGT', 'TGCA') = a1 THEN 7 END,
 CASE WHEN other_allele IS NULL AND translate(effect_allele, 'ACGT', 'TGCA') = a2 THEN 8 END], lambda x: x IS NOT NULL)) AS priority FROM {scoredup} s JOIN {variant2} v ON s.chrom = v.chrom AND s.pos = v.pos"""
_CAND = f"SELECT *, priority IN (3, 4, 7, 8) AS flipped, priority IN (2, 4, 6, 8) AS effect_is_alt, a1 = translate(a2, 'ACGT', 'TGCA') AS ambiguous FROM ({_FIT})"
_LAB = f"""SELECT *, CASE WHEN NOT best_match THEN 'not_best' WHEN exclude THEN 'excluded' ELSE 'matched' END AS match_status FROM (SELECT *, ambiguous OR duplicate_id AS exclude FROM (
 SELECT *, count(*) FILTER (best_match) OVER (PARTITION BY accession, vid) > 1 AS duplicate_id, count(*) FILTER (best_match) OVER (PARTITION BY accession, row_nr) > 1 AS duplicate_best_match
 FROM (SELECT *, rank() OVER (PARTITION BY accession, row_nr ORDER BY priority, vid) = 1 AS best_match FROM ({_CAND}))))"""
_ROWS = f"SELECT accession, row_nr, trait, vid, w, effect_type, effect_is_alt, CASE WHEN effect_is_alt THEN a2 ELSE a1 END AS matched_allele FROM ({_LAB}) WHERE best_match AND NOT exclude"


def labels(v):
    return M.labelled(M.candidates(v.scoredup, v.variant2))


def rows(v):
    own = M.matched(labels(v))
    return own.select("accession", "row_nr", "trait", "vid", "w", "effect_type", "effect_is_alt", F.when(F.col("effect_is_alt"), F.col("a2")).otherwise(F.col("a1")).alias("matched_allele"))


@query("q15_variant_match", f"SELECT accession, row_nr, vid, ['refalt', 'altref', 'refalt_flip', 'altref_flip', 'no_oa_ref', 'no_oa_alt', 'no_oa_ref_flip', 'no_oa_alt_flip'][priority] AS match_type, ambiguous, effect_is_alt FROM ({_CAND})")
def q15(v):
    return M.candidates(v.scoredup, v.variant2).select("accession", "row_nr", "vid", "match_type", "ambiguous", "effect_is_alt")


@query("q16_best_match_labels", f"SELECT accession, row_nr, vid, CAST(priority AS int) AS priority, best_match, duplicate_best_match, duplicate_id, exclude, match_status FROM ({_LAB})")
def q16(v):
    return labels(v).select("accession", "row_nr", "vid", "priority", "best_match", "duplicate_best_match", "duplicate_id", "exclude", "match_status")


_SUMMARY = f"""SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY accession), 6) AS percent FROM (SELECT s.accession, coalesce(match_status, 'unmatched') AS match_status, ambiguous, flipped, duplicate_id, count(*) AS n
 FROM {{scoredup}} s FULL JOIN (SELECT * FROM ({_LAB}) WHERE best_match) l ON s.accession = l.accession AND s.row_nr = l.row_nr GROUP BY 1, 2, 3, 4, 5)"""


@query("q17_match_summary", _SUMMARY)
def q17(v):
    return M.summary(v.scoredup, labels(v))


_COVER = f"""WITH rows AS ({_ROWS}), total AS (SELECT accession, count(*) AS n_rows FROM {{scoredup}} GROUP BY 1)
 SELECT iid, accession, coalesce(n_matched, 0) AS n_matched, n_rows, round(coalesce(n_matched, 0) / n_rows, 6) AS match_rate FROM (SELECT iid, accession, n_rows FROM (SELECT DISTINCT iid FROM {{grain}}) CROSS JOIN total) p
 LEFT JOIN (SELECT iid, accession, count(*) AS n_matched FROM {{grain}} JOIN rows USING (vid) WHERE dosage IS NOT NULL GROUP BY 1, 2) g USING (iid, accession)"""


def coverage(v, genotypes):
    every = v.scoredup.select("accession", "row_nr").join(rows(v).select("accession", "row_nr", "vid"), ["accession", "row_nr"], "left")
    return S.coverage(every, genotypes)


@query("q18_coverage", _COVER.replace("{grain}", "{g12}"))
def q18(v):
    return coverage(v, v.g12)


@query("q18b_overlap_pass", f"SELECT *, 1 - match_rate <= 1 - 0.1 AS score_pass FROM ({_COVER.replace('{grain}', '{g200}')})".replace("SELECT *, 1", "SELECT *, 1"))
def q18b(v):
    return S.passing(coverage(v, v.g200), 0.1)


_DOSE = "CASE WHEN effect_is_alt THEN dosage ELSE 2 - dosage END"


def _sums(grain, dose=_DOSE):
    return f"SELECT iid, accession, CAST(sum(({dose}) * w) AS bigint) AS score_sum, 2 * count(*) AS denom, round(CAST(sum(({dose}) * w) AS bigint) / (2 * count(*)), 6) AS score_avg FROM {{{grain}}} JOIN ({_ROWS}) r USING (vid) WHERE dosage IS NOT NULL GROUP BY 1, 2"


@query("q19_score_sum", _sums("gc"))
def q19(v):
    return S.sums(rows(v), v.gc)


@query("q20_score_effect_types", _sums("gc", f"CASE effect_type WHEN 'dominant' THEN least({_DOSE}, 1) WHEN 'recessive' THEN greatest(({_DOSE}) - 1, 0) ELSE {_DOSE} END"))
def q20(v):
    return S.sums(rows(v), v.gc, by_type=True)


@query("q21_score_imputed", f"""WITH f AS (SELECT vid, CAST(round(2 * round(sum(dosage) / (2 * nullif(count(dosage), 0)), 6) * 1000000) AS bigint) AS mean FROM {{g200}} GROUP BY vid)
 SELECT iid, accession, CAST(sum(CASE WHEN effect_is_alt THEN alt ELSE 2000000 - alt END * w) AS bigint) AS score_sum, 2 * count(*) AS denom, count(*) FILTER (dosage IS NULL) AS n_imputed
 FROM (SELECT g.*, r.accession, r.w, r.effect_is_alt, coalesce(CAST(dosage AS bigint) * 1000000, mean) AS alt FROM {{g200}} g JOIN ({_ROWS}) r USING (vid) LEFT JOIN f USING (vid)) GROUP BY 1, 2""")
def q21(v):
    from strandline.operators import genotypes as G

    return S.imputed_sums(rows(v), v.g200, G.frequencies(v.g200))


@query("q22_score_aggregate_splits", f"SELECT iid, accession, score_sum, denom, CAST(n AS bigint) AS n_splits, score_avg FROM ({_sums('g25')}) JOIN (SELECT iid, accession, count(DISTINCT vid % 3) AS n FROM {{g25}} JOIN ({_ROWS}) r USING (vid) WHERE dosage IS NOT NULL GROUP BY 1, 2) USING (iid, accession)")
def q22(v):
    own = rows(v)
    parts = [S.sums(own.where(F.col("vid") % 3 == k), v.g25) for k in range(3)]
    return S.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]))


_GC = f"SELECT s.iid, accession, score_sum, pop, sampleset, pc1 FROM ({_sums('gc')}) s JOIN {{sample}} p USING (iid)"


def scored(v):
    return v.once("scored", lambda: S.sums(rows(v), v.gc).select("iid", "accession", "score_sum").join(v.sample, "iid"))


def _rank(keys):
    return f"""SELECT s.iid, s.accession, s.pop, (SELECT 1) AS one, n_panel, round(100.0 * n_below / nullif(n_panel, 0), 4) AS percentile FROM (SELECT *, coalesce(sum(r) OVER (PARTITION BY {keys} ORDER BY score_sum RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(r) OVER (PARTITION BY {keys}, score_sum) AS n_below,
 CAST(sum(r) OVER (PARTITION BY {keys}) AS bigint) AS n_panel FROM (SELECT *, CASE WHEN sampleset = 'reference' THEN 1 ELSE 0 END AS r FROM ({_GC}))) s"""


_PCT = f"SELECT iid, accession, pop, n_panel, percentile FROM ({_rank('accession, pop')})"


@query("q23_percentile_in_pop", _PCT)
def q23(v):
    return C.panel_ranks(scored(v), ["accession", "pop"]).select("iid", "accession", "pop", "n_panel", "percentile")


@query("q24_z_in_pop", f"""SELECT s.iid, s.accession, s.pop, round(CASE WHEN sd > 0 THEN (score_sum - mean) / sd END, 6) AS z FROM ({_GC}) s
 JOIN (SELECT accession, pop, avg(CAST(score_sum AS double)) AS mean, stddev_samp(CAST(score_sum AS double)) AS sd FROM ({_GC}) WHERE sampleset = 'reference' GROUP BY 1, 2) m USING (accession, pop)""")
def q24(v):
    return C.panel_z(scored(v), ["accession", "pop"]).select("iid", "accession", "pop", "z")


@query("q25_exact_rank_vs_panel", f"SELECT iid, accession, n_panel, percentile FROM ({_rank('accession')})")
def q25(v):
    return C.panel_ranks(scored(v), ["accession"]).select("iid", "accession", "n_panel", "percentile")


@query("q26_mean_var_norm", f"""WITH s AS ({_GC}), f AS (SELECT accession, regr_slope(CAST(score_sum AS double), CAST(pc1 AS double)) AS b, regr_intercept(CAST(score_sum AS double), CAST(pc1 AS double)) AS a FROM s WHERE sampleset = 'reference' GROUP BY 1),
 r AS (SELECT s.*, score_sum - a - b * pc1 AS res FROM s JOIN f USING (accession)), g AS (SELECT accession, stddev_samp(res) AS sd, regr_slope(res * res, CAST(pc1 AS double)) AS b2, regr_intercept(res * res, CAST(pc1 AS double)) AS a2 FROM r WHERE sampleset = 'reference' GROUP BY 1)
 SELECT iid, accession, round(CASE WHEN sd > 0 THEN res / sd END, 4) + 0e0 AS z_mean, round(CASE WHEN a2 + b2 * pc1 > 0 THEN res / sqrt(a2 + b2 * pc1) END, 4) + 0e0 AS z_var FROM r JOIN g USING (accession)""")
def q26(v):
    return C.adjusted(scored(v), ["accession"], "pc1").select("iid", "accession", "z_mean", "z_var")


@query("q27_calibration_uniformity", f"""SELECT accession, n, mean_pct, max_dev, n >= 100 AND max_dev <= 0.06 AND mean_pct BETWEEN 45 AND 55 AS uniform FROM (SELECT accession, n, round(mean, 4) AS mean_pct, round(greatest({', '.join(f'abs(d{k} / n - 0.1)' for k in range(10))}), 6) AS max_dev
 FROM (SELECT accession, count(*) AS n, avg(percentile) AS mean, {', '.join(f'count(*) FILTER (least(9, greatest(0, floor(percentile / 10))) = {k}) AS d{k}' for k in range(10))} FROM ({_rank('accession')}) WHERE percentile IS NOT NULL GROUP BY 1))""")
def q27(v):
    return C.uniformity(C.panel_ranks(scored(v), ["accession"]), ["accession"])


#: Numbers of all scores that the tables have: 25 brands, and kinds by the code of their second letter.
_NUMBERS = (*range(1, 26), 965, 967, 969, 977, 982, 984)


@query("q35_wide_scorefile", f"SELECT vid, matched_allele, {', '.join(f'''CAST(sum(CASE WHEN accession LIKE 'PGS{n:06d}%' THEN w ELSE 0 END) AS bigint) AS pgs{n}''' for n in _NUMBERS)} FROM ({_ROWS}) GROUP BY 1, 2")
def q35(v):
    names = [f"PGS{n:06d}_hmPOS_GRCh38" for n in _NUMBERS]
    return M.wide_weights(rows(v), names).toDF("vid", "matched_allele", *(f"pgs{n}" for n in _NUMBERS))


_CHANGED = "SELECT vid FROM {variant2} WHERE vid % 101 = 5"


@query("q28_semi_restrict", f"SELECT accession, count(*) AS n FROM ({_CAND}) WHERE vid IN (SELECT vid FROM {{g25}} WHERE iid = 3) GROUP BY 1")
def q28(v):
    return M.candidates(v.scoredup, v.variant2).join(v.g25.where("iid = 3").select("vid"), "vid", "left_semi").groupBy("accession").agg(F.count(F.lit(1)).alias("n"))


@query("q29_anti_absent", "SELECT vid FROM {variant2} WHERE vid NOT IN (SELECT vid FROM {g25} WHERE iid = 3)")
def q29(v):
    return v.variant2.select("vid").join(v.g25.where("iid = 3").select("vid"), "vid", "left_anti")


@query("q30_anti_extra", "SELECT vid FROM {g25} WHERE iid = 4 AND vid % 9 <> 0 AND vid NOT IN (SELECT vid FROM {g25} WHERE iid = 3)")
def q30(v):
    return v.g25.where("iid = 4 and vid % 9 <> 0").select("vid").join(v.g25.where("iid = 3").select("vid"), "vid", "left_anti")


_KEYS = "accession, match_status, ambiguous, flipped, duplicate_id"


@query("q31_delta_summary", f"""SELECT accession, coalesce(match_status, 'unmatched') AS match_status, ambiguous, flipped, duplicate_id, count(*) AS n FROM (SELECT s.accession, s.row_nr, match_status, ambiguous, flipped, duplicate_id FROM {{scoredup}} s
 LEFT JOIN (SELECT * FROM ({_LAB}) WHERE best_match AND vid NOT IN ({_CHANGED})) l ON s.accession = l.accession AND s.row_nr = l.row_nr) GROUP BY 1, 2, 3, 4, 5""")
def q31(v):
    """Counts after some variants leave the target, by maintenance of the cached counts; the oracle counts anew. What a row that lost a candidate counts for now follows from all rows and best candidates of its number, as several may share one."""
    keys = ["accession", *M.LABELS]
    gone = v.sql(_CHANGED).withColumn("gone", F.lit(True))
    best = v.once("best-labels", lambda: labels(v).where("best_match").join(gone, "vid", "left").select("accession", "row_nr", *M.LABELS, F.coalesce("gone", F.lit(False)).alias("gone")))
    touched = best.where("gone").select("accession", "row_nr").distinct()
    own = best.join(touched, ["accession", "row_nr"], "left_semi")
    rows_ = v.scoredup.select("accession", "row_nr").join(touched, ["accession", "row_nr"], "left_semi")
    before, after = (M.counted(rows_, labels_, "left") for labels_ in (own, own.where("not gone")))
    return M.maintained(M.counted(v.scoredup, best), before, after, keys)


# Each row's own variant, and for most the one of the next row: chains of rows, some long.
_EDGE = "SELECT accession, row_nr, row_nr AS vid FROM {scorefile} UNION SELECT accession, row_nr, row_nr + 1 + row_nr % 2 FROM {scorefile} WHERE row_nr % 13 < 11"


@query("q32_affected_closure", f"""WITH RECURSIVE e AS ({_EDGE}), reach AS (SELECT accession, row_nr FROM e WHERE vid % 101 = 5 UNION SELECT b.accession, b.row_nr FROM reach r JOIN e a ON r.accession = a.accession AND r.row_nr = a.row_nr JOIN e b ON a.accession = b.accession AND a.vid = b.vid)
 SELECT accession, row_nr FROM reach""".replace("WITH RECURSIVE", "WITH", 1))
def q32(v):
    edges = v.sql(_EDGE)
    return M.affected(edges, edges.select("vid").distinct().where("vid % 101 = 5"))
