"""Queries over grades, risk, consensus and meta-scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions.math import norm_cdf, norm_ppf
from strandline.operators import calibrate as C
from strandline.operators import grade as G
from strandline.operators import score as S
from strandline.plans.registry import query
from strandline.plans.scoring import _ROWS, rows
from strandline.plans.views import VIEWS

# Cohort of 12 x 25 people: percentiles among them by score, coverage from the target's own list.
VIEWS["cohort"] = "SELECT nation * 12 + cust % 12 AS iid, vid, CAST(max(line) % 3 AS int) AS dosage FROM {call} GROUP BY 1, 2"
VIEWS["people"] = "SELECT n_nationkey * 12 + k AS iid, r_name AS pop, CASE WHEN (n_nationkey + k) % 4 = 0 THEN 'target' ELSE 'reference' END AS sampleset, CASE (n_nationkey + k) % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'unknown' END AS sex FROM {nation} JOIN {region} ON n_regionkey = r_regionkey JOIN (SELECT l_linenumber - 1 AS k FROM {lineitem} WHERE l_linenumber <= 7 GROUP BY 1 UNION ALL SELECT l_linenumber + 6 AS k FROM {lineitem} WHERE l_linenumber <= 5 GROUP BY 1) ON k <= 11"
_COHORT = f"SELECT iid, r.accession, substr(r.accession, 1, 9) AS pgs_id, trait, CAST(sum((CASE WHEN effect_is_alt THEN dosage ELSE 2 - dosage END) * w) AS bigint) AS score_sum, count(*) AS n_matched FROM {{cohort}} JOIN ({_ROWS}) r USING (vid) GROUP BY 1, 2, 3, 4"
_SCORED = f"""SELECT s.iid AS sample, s.pgs_id, s.trait, pop, sex, sampleset, score_sum, n_matched, n_panel, CASE WHEN n_panel > 60 THEN 100e0 * n_below / n_panel END AS percentile FROM (
 SELECT *, coalesce(sum(r) OVER (PARTITION BY pgs_id ORDER BY score_sum RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(r) OVER (PARTITION BY pgs_id, score_sum) AS n_below, CAST(sum(r) OVER (PARTITION BY pgs_id) AS bigint) AS n_panel
 FROM (SELECT c.*, p.pop, p.sex, p.sampleset, CASE WHEN sampleset = 'reference' THEN 1 ELSE 0 END AS r FROM ({_COHORT}) c JOIN {{people}} p USING (iid))) s"""
# A match summary lists every second score; metadata lacks the size of every fifth.
_TOTAL, _SIZE = "CASE WHEN number % 2 = 0 THEN CAST(ceil(0.3e0 * n_variants) AS bigint) END", "CASE WHEN number % 5 > 0 THEN n_variants END"
_TARGET = f"""SELECT * EXCLUDE (n_hit, total, size), CASE WHEN total IS NULL THEN n_hit ELSE least(n_hit, total) END AS n_matched, coalesce(size, total) AS n_variants, CASE WHEN total IS NOT NULL THEN least(n_hit, total) / CAST(total AS double) WHEN size > 0 THEN n_hit / CAST(size AS double) END AS match_rate
 FROM (SELECT t.* EXCLUDE (n_matched), n_matched AS n_hit, base_grade, training_ancestry, gwas_n, {_TOTAL} AS total, {_SIZE} AS size FROM ({_SCORED}) t LEFT JOIN {{meta}} m ON t.pgs_id = m.pgs_id WHERE sampleset = 'target')"""


def scored(v):
    return v.once("cohort-scored", lambda: _scored(v))


def _scored(v):
    own = v.cohort.join(rows(v), "vid").withColumn("pgs_id", F.substring("accession", 1, 9))
    s = own.groupBy("iid", "pgs_id", "trait").agg(F.sum(S.effect_dosage().cast("bigint") * F.col("w")).alias("score_sum"), F.count(F.lit(1)).alias("n_matched")).join(v.people, "iid")
    out = C.panel_ranks(s, ["pgs_id"]).withColumn("percentile", F.when(F.col("n_panel") > 60, 100.0 * F.col("n_below") / F.col("n_panel")))
    return out.withColumnRenamed("iid", "sample")


def target(v):
    meta = v.meta.select("pgs_id", "base_grade", "training_ancestry", "gwas_n", F.expr(_TOTAL).alias("in_summary"), F.expr(_SIZE).alias("n_variants"))
    own = scored(v).where("sampleset = 'target'").withColumn("denom", 2 * F.col("n_matched"))
    covered = own.join(meta.where("in_summary is not null"), "pgs_id").select("sample", "pgs_id", F.least("n_matched", "in_summary").alias("matched"), F.col("in_summary").alias("total"))
    known = S.coverage_or_denominator(own.drop("n_matched"), covered, meta.select("pgs_id", "n_variants")).drop("denom")
    return known.join(meta.drop("in_summary", "n_variants"), "pgs_id", "left")


_EFF = """SELECT t.*, coalesce(e.per_sd, f.per_sd) AS per_sd FROM ({0}) t LEFT JOIN (SELECT pgs_id, arg_max(per_sd, ord) AS per_sd FROM {{effect}} WHERE per_sd IS NOT NULL GROUP BY 1) e ON t.pgs_id = e.pgs_id
 LEFT JOIN (SELECT lower(trim(trait)) AS k, arg_min(per_sd, ord) AS per_sd FROM {{effect}} WHERE per_sd IS NOT NULL GROUP BY 1) f ON lower(trim(t.trait)) = f.k""".format(_TARGET).replace("{{", "{").replace("}}", "}")
_BASE = """SELECT e.*, coalesce(b0.baseline_risk, b1.baseline_risk, b2.baseline_risk, b3.baseline_risk) AS baseline_risk, CASE WHEN b0.sex IS NOT NULL OR b1.sex IS NOT NULL THEN want WHEN b2.sex IS NOT NULL OR b3.sex IS NOT NULL THEN 'overall' END AS baseline_sex
 FROM (SELECT *, CASE trait WHEN 'trait_3' THEN 'female' WHEN 'trait_5' THEN 'male' ELSE coalesce(nullif(sex, 'unknown'), 'overall') END AS want FROM (%s)) e
 LEFT JOIN {baseline_known} b0 ON e.trait = b0.trait AND b0.sex = want AND b0.ancestry = e.pop LEFT JOIN {baseline_known} b1 ON e.trait = b1.trait AND b1.sex = want AND b1.ancestry = 'overall'
 LEFT JOIN {baseline_known} b2 ON e.trait = b2.trait AND b2.sex = 'overall' AND b2.ancestry = e.pop LEFT JOIN {baseline_known} b3 ON e.trait = b3.trait AND b3.sex = 'overall' AND b3.ancestry = 'overall'""" % _EFF


def effects(v):
    return G.effect_of(target(v), v.effect)


def risks(v):
    return G.baseline_of(effects(v).withColumn("ancestry", F.col("pop")), v.baseline, {"trait_3": "female", "trait_5": "male"})


@query("q36_effect_lookup", f"SELECT sample, pgs_id, trait, per_sd FROM ({_EFF})")
def q36(v):
    return effects(v).select("sample", "pgs_id", "trait", "per_sd")


@query("q37_baseline_fallback", f"SELECT sample, pgs_id, baseline_risk, baseline_sex FROM ({_BASE})")
def q37(v):
    return risks(v).select("sample", "pgs_id", "baseline_risk", "baseline_sex")


_RISK = f"SELECT *, baseline_risk / (1 - baseline_risk) * rr AS odds FROM (SELECT *, exp(ln(per_sd) * z - ln(per_sd) * ln(per_sd) / 2) AS rr FROM (SELECT *, {norm_ppf('percentile / 100e0')} AS z FROM ({_BASE})))"


@query("q38_absolute_risk", f"SELECT sample, pgs_id, round(odds / (1 + odds), 4) AS absolute_risk, round(rr, 3) AS risk_ratio FROM ({_RISK}) WHERE percentile IS NOT NULL AND per_sd IS NOT NULL AND baseline_risk IS NOT NULL")
def q38(v):
    rr, ar = G.risk_columns()
    return risks(v).where("percentile is not null and per_sd is not null and baseline_risk is not null").select("sample", "pgs_id", F.round(ar, 4).alias("absolute_risk"), F.round(rr, 3).alias("risk_ratio"))


_EURO = "(upper(trim(training_ancestry)) IN ('EUR', 'EUR100%', 'EUR (100%)', 'EUROPEAN') OR upper(trim(training_ancestry)) LIKE 'EUR (%')"
_GRADED = f"""SELECT sample, pgs_id, trait, pop, round(match_rate, 4) AS match_rate, round(percentile, 1) AS percentile, flag AS portability_flag, CASE WHEN percentile IS NULL THEN 'D' ELSE substr('ABCD', least(4, strpos('ABCD', coalesce(base_grade, 'C')) + (CASE WHEN low THEN 2 ELSE 0 END) + (CASE WHEN flag THEN 1 ELSE 0 END)), 1) END AS evidence_grade,
 CASE WHEN known THEN round(odds / (1 + odds), 4) END AS absolute_risk, CASE WHEN known THEN round(rr, 3) END AS risk_ratio,
 concat_ws(' | ', CASE WHEN low THEN '{G.COVERAGE}' END, CASE WHEN percentile IS NULL THEN '{G.UNCALIBRATED}' END, CASE WHEN flag THEN '{G.PORTABILITY}' END, CASE WHEN known THEN concat('absolute risk ~', CAST(CAST(round(100 * round(odds / (1 + odds), 4)) AS int) AS string), '% for ', coalesce(baseline_sex, 'overall'), ' vs ~', CAST(CAST(round(100 * baseline_risk) AS int) AS string), '% baseline (odds scale, illustrative)') END, '{G.GENERAL}') AS allowed_statement
 FROM (SELECT *, coalesce(match_rate < 0.75, false) AS low, percentile IS NOT NULL AND upper(pop) <> 'EUR' AND coalesce({_EURO}, false) AS flag, percentile IS NOT NULL AND per_sd IS NOT NULL AND baseline_risk IS NOT NULL AS known FROM ({_RISK}))"""


def graded(v):
    return G.graded(risks(v)).select("sample", "pgs_id", "trait", "pop", "match_rate", "percentile", "portability_flag", "evidence_grade", "absolute_risk", "risk_ratio", "allowed_statement")


@query("q39_grade_gates", _GRADED)
def q39(v):
    return graded(v)


@query("q40_portability", f"SELECT pop, evidence_grade, portability_flag, count(*) AS n FROM ({_GRADED}) GROUP BY 1, 2, 3")
def q40(v):
    return graded(v).groupBy("pop", "evidence_grade", "portability_flag").agg(F.count(F.lit(1)).alias("n"))


_CONS = f"""SELECT sample, trait, n AS robustness_n_scores, CASE WHEN k >= 2 THEN round_even(greatest(0.0, 1 - (hi - lo) / 100), 3) END AS robustness_concordance, CASE WHEN k >= 2 THEN t = 1 END AS same_tertile FROM (
 SELECT sample, trait, count(*) AS n, count(p) AS k, max(p) AS hi, min(p) AS lo, count(DISTINCT CASE WHEN p < 100e0 / 3 THEN 0 WHEN p > 200e0 / 3 THEN 2 WHEN p IS NOT NULL THEN 1 END) AS t FROM (SELECT sample, trait, round(percentile, 1) AS p FROM ({_TARGET})) GROUP BY 1, 2)"""


@query("q41_consensus", _CONS)
def q41(v):
    return G.consensus(target(v))


_FLAGGED = f"SELECT g.*, robustness_n_scores, coalesce(robustness_n_scores >= 2 AND (NOT same_tertile OR robustness_concordance < 0.67), false) AS low_robustness FROM ({_GRADED}) g LEFT JOIN ({_CONS}) c ON g.sample = c.sample AND g.trait = c.trait"


@query("q42_consensus_flag", f"SELECT sample, pgs_id, low_robustness, CASE WHEN low_robustness THEN allowed_statement || ' | {G.ROBUSTNESS}' ELSE allowed_statement END AS allowed_statement FROM ({_FLAGGED})")
def q42(v):
    return G.flagged(graded(v), G.consensus(target(v))).select("sample", "pgs_id", "low_robustness", "allowed_statement")


_Z = f"SELECT s.sample, s.sampleset, s.pgs_id, s.trait, round((score_sum - mean) / sd, 6) AS z FROM ({_SCORED}) s JOIN (SELECT pgs_id, avg(CAST(score_sum AS double)) AS mean, stddev_samp(CAST(score_sum AS double)) AS sd FROM ({_SCORED}) WHERE sampleset = 'reference' GROUP BY 1) m USING (pgs_id) WHERE sd > 0"


def standard(v):
    return C.panel_z(scored(v), ["pgs_id"]).where("z is not null")


@query("q43_meta_score", f"""SELECT sample, trait, n_scores, round(mz, 6) AS meta_z, round(({norm_cdf('mz')}) * 100, 3) AS meta_percentile FROM (SELECT sample, trait, count(*) AS n_scores, sum(gwas_n * z) / sum(gwas_n) AS mz FROM ({_Z}) z JOIN (SELECT pgs_id, gwas_n FROM {{meta}}) USING (pgs_id) WHERE sampleset = 'target' GROUP BY 1, 2 HAVING count(*) >= 2)""")
def q43(v):
    own = standard(v).where("sampleset = 'target'").join(v.meta.select("pgs_id", F.col("gwas_n").alias("weight")), "pgs_id")
    return G.meta_scores(own)


_META = f"SELECT sample AS iid, sampleset, z.trait, count(*) AS n_scores, CAST(sum(CAST(round(z * 1000000) AS bigint)) AS bigint) AS sum_z FROM ({_Z}) z JOIN (SELECT trait, count(DISTINCT pgs_id) AS members FROM ({_Z}) GROUP BY 1 HAVING count(DISTINCT pgs_id) >= 2) m ON z.trait = m.trait GROUP BY 1, 2, 3, members HAVING count(*) = members"


@query("q44_meta_exact", f"""SELECT iid, sampleset, trait, n_scores, sum_z, n_panel, round(CASE WHEN n_panel > 0 THEN 100.0 * n_below / n_panel END, 4) AS percentile FROM (SELECT *, coalesce(sum(r) OVER (PARTITION BY trait ORDER BY sum_z RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) - sum(r) OVER (PARTITION BY trait, sum_z) AS n_below,
 CAST(sum(r) OVER (PARTITION BY trait) AS bigint) AS n_panel FROM (SELECT *, CASE WHEN sampleset = 'reference' THEN 1 ELSE 0 END AS r FROM ({_META})))""")
def q44(v):
    return G.exact_meta(standard(v).withColumnRenamed("sample", "iid"))


_MUTATED = f"""SELECT sample, pgs_id, match_rate, CASE WHEN sample % 7 = 1 THEN 140.0 ELSE percentile END AS percentile, CASE WHEN sample % 5 = 2 THEN 'E' ELSE evidence_grade END AS evidence_grade, CASE WHEN sample % 11 = 3 THEN NULL ELSE portability_flag END AS portability_flag,
 CASE WHEN sample % 6 = 4 THEN 1.5 ELSE absolute_risk END AS absolute_risk, CASE WHEN sample % 4 = 3 THEN '' ELSE allowed_statement END AS allowed_statement FROM ({_GRADED})"""


@query("q60_contract_violations", f"""SELECT sample, pgs_id, unnest(list_filter([CASE WHEN NOT coalesce(evidence_grade IN ('A', 'B', 'C', 'D'), false) THEN 'grade' END, CASE WHEN portability_flag IS NULL THEN 'flag' END, CASE WHEN coalesce(trim(allowed_statement), '') = '' THEN 'statement' END,
 CASE WHEN NOT coalesce(percentile BETWEEN 0 AND 100, true) THEN 'percentile' END, CASE WHEN NOT coalesce(absolute_risk BETWEEN 0 AND 1, true) THEN 'risk' END, CASE WHEN absolute_risk IS NOT NULL AND percentile IS NULL THEN 'risk without percentile' END,
 CASE WHEN coalesce(match_rate < 0.75, false) AND NOT coalesce(contains(allowed_statement, 'coverage'), false) THEN 'coverage not said' END], lambda x: x IS NOT NULL)) AS problem FROM ({_MUTATED})""")
def q60(v):
    s = F.col("sample")
    bad = graded(v).withColumns({"percentile": F.when(s % 7 == 1, 140.0).otherwise(F.col("percentile")), "evidence_grade": F.when(s % 5 == 2, "E").otherwise(F.col("evidence_grade")), "portability_flag": F.when(s % 11 != 3, F.col("portability_flag")), "absolute_risk": F.when(s % 6 == 4, 1.5).otherwise(F.col("absolute_risk")), "allowed_statement": F.when(s % 4 == 3, "").otherwise(F.col("allowed_statement"))})
    return G.violations(bad)


_CAT = "CASE WHEN percentile IS NULL THEN 'uncalibrated' WHEN evidence_grade IN ('C', 'D') AND percentile >= 90 THEN 'weak-high' WHEN evidence_grade IN ('C', 'D') THEN 'weak' WHEN percentile >= 90 THEN 'elevated' WHEN percentile <= 10 THEN 'protective' ELSE 'average' END"
_REP = f"SELECT sample, trait, pgs_id, evidence_grade, percentile, {_CAT} AS category FROM (SELECT *, row_number() OVER (PARTITION BY sample, trait ORDER BY evidence_grade, percentile DESC NULLS LAST, pgs_id) AS place FROM ({_GRADED})) WHERE place = 1"


def representative(v):
    from strandline.operators.targets import best_of

    own = best_of(graded(v), ["sample", "trait"], F.col("evidence_grade"), F.col("percentile").desc_nulls_last(), F.col("pgs_id"))
    return own.select("sample", "trait", "pgs_id", "evidence_grade", "percentile", G.category().alias("category"))


@query("q61_representative_trait", _REP)
def q61(v):
    return representative(v)


@query("q62_grade_tally", f"SELECT sample, evidence_grade, count(*) AS n FROM ({_REP}) GROUP BY 1, 2")
def q62(v):
    return representative(v).groupBy("sample", "evidence_grade").agg(F.count(F.lit(1)).alias("n"))


@query("q63_report_order", f"""SELECT sample, trait, CAST(row_number() OVER (PARTITION BY sample ORDER BY coalesce(nullif(percentile, 0), -1) DESC, trait) AS int) AS place, CASE WHEN percentile IS NULL THEN '-' WHEN percentile >= 50 THEN 'top ' || CAST(CAST(round_even(greatest(1.0, 100 - percentile), 0) AS int) AS string) || '%' ELSE 'bottom ' || CAST(CAST(round_even(greatest(1.0, percentile), 0) AS int) AS string) || '%' END AS phrase FROM ({_REP})""")
def q63(v):
    from pyspark.sql import Window

    order = Window.partitionBy("sample").orderBy(F.coalesce(F.nullif("percentile", F.lit(0.0)), F.lit(-1.0)).desc(), "trait")
    return representative(v).select("sample", "trait", F.row_number().over(order).alias("place"), G.rank_phrase(F.col("percentile")).alias("phrase"))


@query("q65_caveat_segments", f"""SELECT sample, trait, string_agg(part, ' | ' ORDER BY first) AS caveats FROM (SELECT sample, trait, part, min(n) AS first FROM (SELECT sample, trait, unnest(string_split(allowed_statement, ' | ')) AS part, pgs_id || '/' || CAST(generate_subscripts(string_split(allowed_statement, ' | '), 1) AS string) AS n FROM ({_GRADED})) WHERE part <> '{G.GENERAL}' GROUP BY 1, 2, 3) GROUP BY 1, 2""")
def q65(v):
    parts = graded(v).select("sample", "trait", "pgs_id", F.posexplode(F.split("allowed_statement", r" \| ")).alias("n", "part")).where(F.col("part") != G.GENERAL)
    first = parts.groupBy("sample", "trait", "part").agg(F.min(F.struct("pgs_id", "n")).alias("first"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("first", "part"))), lambda x: x["part"])
    return first.groupBy("sample", "trait").agg(F.array_join(ordered, " | ").alias("caveats"))


@query("q69_provenance", f"SELECT sample, count(DISTINCT pgs_id) AS n_scores, bool_or(percentile IS NOT NULL) AS any_calibrated, sha256(string_agg(DISTINCT pgs_id, ',' ORDER BY pgs_id)) AS score_set FROM ({_GRADED}) GROUP BY 1")
def q69(v):
    return graded(v).groupBy("sample").agg(F.count_distinct("pgs_id").alias("n_scores"), F.bool_or(F.col("percentile").isNotNull()).alias("any_calibrated"), F.sha2(F.array_join(F.array_sort(F.collect_set("pgs_id")), ","), 256).alias("score_set"))
