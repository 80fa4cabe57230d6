"""Queries over report cells, checks of batches, and whole recomputations."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions import report as R
from strandline.operators import batch as B
from strandline.operators import calibrate as C
from strandline.operators import match as M
from strandline.operators import panel as P
from strandline.plans import extensions
from strandline.plans.catalogue import _FILES, _INTER, _LOADED, _REPORT, intersect
from strandline.operators import grade as G
from strandline.plans.grading import _BASE, _CONS, _FLAGGED, _REP, _Z, representative, risks, scored, target
from strandline.sources.files import CONTRACT
from strandline.plans.registry import query
from strandline.plans.scoring import _FIT, _LAB, _ROWS, labels, rows
from strandline.plans.views import VIEWS, numbered
from strandline.streaming import events as E

_ROW = f"""SELECT f.sample, f.trait, CAST(NULL AS string) AS efo_id, f.pgs_id, CAST(NULL AS string) AS source_pmid, CAST(NULL AS string) AS source_doi, n_variants, training_ancestry, n_matched, f.match_rate, f.pop AS inferred_ancestry, f.pop AS most_similar_pop, CAST(NULL AS string) AS ancestry_distance,
 f.percentile, z AS z_score, CAST(NULL AS string) AS ci_low, CAST(NULL AS string) AS ci_high, f.absolute_risk, baseline_risk AS baseline_incidence, f.risk_ratio, robustness_n_scores, robustness_concordance, f.evidence_grade, f.portability_flag, CASE WHEN low_robustness THEN f.allowed_statement || ' | {G.ROBUSTNESS}' ELSE f.allowed_statement END AS allowed_statement
 FROM ({_FLAGGED}) f JOIN (SELECT sample, pgs_id, training_ancestry, n_matched, n_variants, baseline_risk FROM ({_BASE})) b ON f.sample = b.sample AND f.pgs_id = b.pgs_id LEFT JOIN (SELECT sample AS zs, pgs_id AS zp, z FROM ({_Z.replace(', 6) AS z', ', 4) AS z')})) ON f.sample = zs AND f.pgs_id = zp LEFT JOIN (SELECT sample AS cs, trait AS ct, robustness_concordance FROM ({_CONS})) c ON f.sample = cs AND f.trait = ct"""


@query("q39b_contract", _ROW)
def q39b(v):
    rows_ = G.graded(risks(v)).withColumns({"most_similar_pop": F.col("pop"), "inferred_ancestry": F.col("pop"), "baseline_incidence": F.col("baseline_risk")})
    rows_ = rows_.join(C.panel_z(scored(v), ["pgs_id"], places=4).select("sample", "pgs_id", F.col("z").alias("z_score")), ["sample", "pgs_id"], "left")
    return G.contract(rows_, G.consensus(target(v)), CONTRACT)


@query("q50b_worst_bin", _LOADED.replace("SELECT CAST(p.bin AS int) AS bin, name, size FROM pack p JOIN o ON o.k = p.k", "SELECT CAST(p.bin AS int) AS bin, count(*) AS n_files, CAST(sum(size) AS bigint) AS size, row_number() OVER (ORDER BY sum(size) DESC, p.bin) = 1 AS worst FROM pack p JOIN o ON o.k = p.k GROUP BY p.bin"))
def q50b(v):
    return B.bin_summary(B.least_loaded(v.sql(_FILES), 4))


@query("q84_unmapped", f"SELECT DISTINCT vid FROM ({_ROWS}) WHERE vid NOT IN (SELECT id_target FROM ({_INTER}))")
def q84(v):
    return P.unmapped(rows(v), intersect(v).select(F.col("id_target").alias("old")))


_SITES = "SELECT DISTINCT CASE WHEN chrom % 2 = 0 THEN 'chr' ELSE '' END || CAST(chrom AS string) AS chrom, pos, ref AS archaic FROM {record} WHERE pos % 5 = 1"
_RECS = "SELECT iid, CASE WHEN ord % 3 = 0 THEN 'chr' ELSE '' END || CAST(chrom AS string) AS chrom, pos, ref, alt, gt, ord FROM {record}"


@query("q85_archaic_calls", f"""WITH r AS (SELECT iid, chrom, pos, arg_min(struct_pack(r := ref, a := alt, g := gt), ord) AS x FROM ({_RECS}) WHERE gt <> '' AND NOT contains(gt, '.') GROUP BY 1, 2, 3), s AS (SELECT 'chr' || replace(chrom, 'chr', '') AS chrom, pos, archaic FROM ({_SITES})),
 p AS (SELECT iid, list_transform(string_split(replace(x.g, '|', '/'), '/'), lambda a: CAST(a AS int)) AS said, list_concat([x.r], CASE WHEN x.a = '.' THEN [] ELSE string_split(x.a, ',') END) AS names, archaic FROM r JOIN s ON 'chr' || replace(r.chrom, 'chr', '') = s.chrom AND r.pos = s.pos),
 n AS (SELECT *, list_filter(said, lambda a: a < len(names)) AS called FROM p)
 SELECT iid, CAST(sum(len(list_filter(called, lambda a: names[a + 1] = archaic))) AS bigint) AS archaic, CAST(sum(len(called)) AS bigint) AS total, count(*) AS sites FROM n WHERE len(called) > 0 GROUP BY 1""")
def q85(v):
    """Lines of an order may share a number, and so ord; the first of the table counts then."""
    record = v.spark.sql(VIEWS["record"].replace(" AS ord", " AS ord, nth"), lineitem=numbered(v.lineitem), orders=v.orders)
    return B.archaic_calls(v.spark.sql(_RECS.replace("gt, ord ", "gt, ord, nth "), record=record), v.sql(_SITES))


_CELLS = "SELECT pgs_id, metric, CAST(max(estimate) AS double) AS value FROM ({0}) GROUP BY 1, 2".replace("{0}", _REPORT)


@query("q71_report_cells", f"""SELECT pgs_id, metric, CASE WHEN value IS NULL THEN '—' ELSE concat(CASE metric WHEN 'C-index' THEN 'C-idx' WHEN 'R2' THEN 'R²' ELSE metric END, ' ', CAST(value AS string)) END AS cell,
 CASE WHEN value > 0 AND value < 1 THEN CAST(round_even(1 / value, 0) AS bigint) END AS one_in, coalesce(format('{{:g}}', value), '—') AS short, coalesce(CAST(CAST(round_even(value * 100, 0) AS bigint) AS string) || '%', '—') AS percent FROM ({_CELLS})""".replace("{{:g}}", "{:g}"))
def q71(v):
    text = F.col("value").cast("string")
    return v.sql(_CELLS).select("pgs_id", "metric", R.performance_cell(F.col("metric"), F.col("value")).alias("cell"), R.natural_frequency(F.col("value")).alias("one_in"), R.formatted(text).alias("short"), R.formatted(text, percent=True).alias("percent"))


_TERMS = "SELECT number, CASE number % 7 WHEN 0 THEN 'MONDO_' WHEN 1 THEN 'EFO_' WHEN 2 THEN 'Orphanet_' WHEN 3 THEN 'XX_' WHEN 4 THEN 'HP_x' WHEN 5 THEN 'NA' ELSE 'GO_' END || CASE WHEN number % 7 = 5 THEN '' ELSE CAST(number AS string) END AS term FROM {meta}"


@query("q72_ontology_url", f"""SELECT number, CASE WHEN term = 'NA' THEN NULL WHEN term LIKE 'MONDO\\_%' ESCAPE '\\' THEN 'https://monarchinitiative.org/' || replace(term, '_', ':') WHEN slug IS NOT NULL AND regexp_matches(split_part(term, '_', 2), '^[0-9]+$') THEN 'https://www.ebi.ac.uk/ols4/ontologies/' || slug || '/classes?obo_id=' || replace(term, '_', ':') ELSE 'https://www.ebi.ac.uk/ols4/search?q=' || term END AS url
 FROM (SELECT *, CASE upper(split_part(term, '_', 1)) WHEN 'EFO' THEN 'efo' WHEN 'HP' THEN 'hp' WHEN 'ORPHANET' THEN 'ordo' WHEN 'GO' THEN 'go' END AS slug FROM ({_TERMS}))""")
def q72(v):
    return v.sql(_TERMS).select("number", R.ontology_url(F.col("term")).alias("url"))


#: Names of traits: a part's name and a word or two that a list of traits has.
_TRAITS = (
    "SELECT p_partkey, concat(p_name, ' ', CASE p_partkey % 24 WHEN 0 THEN 'Thyroid Cancer' WHEN 1 THEN 'LDL cholesterol' WHEN 2 THEN 'liver fat' WHEN 3 THEN 'Parkinson disease' WHEN 4 THEN 'Lupus with kidney disease' "
    "WHEN 5 THEN 'Crohn disease or lupus' WHEN 6 THEN 'heart rate in asthma' WHEN 7 THEN 'COPD' WHEN 8 THEN 'Osteoarthritis' WHEN 9 THEN 'eGFR' WHEN 10 THEN 'macular degeneration' WHEN 11 THEN 'atopic asthma' "
    "WHEN 12 THEN 'Body mass index' WHEN 13 THEN 'bone density' WHEN 14 THEN 'waist in diabetes' WHEN 15 THEN 'hypothyroidism' WHEN 16 THEN 'venous thrombosis' WHEN 17 THEN 'C-reactive protein' "
    "WHEN 18 THEN 'freckles' WHEN 19 THEN 'arterial hypertension' ELSE '' END) AS trait FROM {part}"
)
_WORDS = ", ".join(f"({k}, '{w}', '{s}', '{R.SYSTEM_NAMES[s]}')" for k, (s, w) in enumerate((s, w) for s, words in R.BODY_SYSTEMS for w in words))


@query("q64b_body_system", f"""SELECT p_partkey, coalesce(arg_min(system, ord), 'default') AS system, coalesce(arg_min(name, ord), 'general') AS system_name
 FROM ({_TRAITS}) LEFT JOIN (VALUES {_WORDS}) w (ord, word, system, name) ON contains(lower(trait), word) GROUP BY 1""")
def q64b(v):
    system = R.body_system(F.col("trait"))
    return v.sql(_TRAITS).select("p_partkey", system.alias("system"), R.system_name(system).alias("system_name"))


_TIER = "SELECT pgs_id, trait, CASE number % 3 WHEN 0 THEN 'core' WHEN 1 THEN 'extended' ELSE 'gated' END AS tier FROM {meta}"


@query("q73_trait_tiers", f"SELECT 'core' AS wanted, pgs_id FROM ({_TIER}) WHERE tier = 'core' UNION ALL SELECT 'extended', pgs_id FROM ({_TIER}) WHERE tier IN ('core', 'extended') UNION ALL SELECT 'all', pgs_id FROM ({_TIER}) UNION ALL SELECT 'gated', pgs_id FROM ({_TIER}) WHERE tier = 'gated' UNION ALL SELECT 'other', pgs_id FROM ({_TIER}) WHERE tier IN ('core', 'extended')")
def q73(v):
    own = v.sql(_TIER)
    each = F.explode(F.array(*(F.when(R.in_tier(F.col("tier"), w), F.lit(w)) for w in ("core", "extended", "all", "gated", "other")))).alias("wanted")
    return own.select(each, "pgs_id").where("wanted is not null")


@query("q74_panel_id_clash", "SELECT DISTINCT iid FROM {g12} WHERE iid IN (SELECT iid FROM {people} WHERE sampleset = 'reference')")
def q74(v):
    return P.clashing(v.g12, v.people.where("sampleset = 'reference'"))


_KEPT = "SELECT vid FROM {variant} WHERE vid % 4 <> 1"


@query("q75_thinned_intersect", f"SELECT key, id_ref, id_target FROM ({_INTER}) WHERE pca_eligible AND id_ref IN ({_KEPT})")
def q75(v):
    return P.thinned(intersect(v), v.sql(_KEPT)).select("key", "id_ref", "id_target")


_SPOILT = f"SELECT name FROM ({_FILES}) WHERE hash_of(name) <> 3".replace("hash_of(name)", "size % 5") + f" UNION ALL SELECT name FROM ({_FILES}) WHERE size % 7 = 2 UNION ALL SELECT 'other' AS name FROM {{region}} WHERE r_regionkey = 0"


@query("q76_partition_invariant", f"SELECT name, coalesce(a.n, 0) AS n_files, coalesce(b.n, 0) AS n_bins FROM (SELECT name, count(*) AS n FROM ({_FILES}) GROUP BY 1) a FULL JOIN (SELECT name, count(*) AS n FROM ({_SPOILT}) GROUP BY 1) b USING (name) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)")
def q76(v):
    return B.partition_faults(v.sql(_FILES), v.sql(_SPOILT))


_WANT = "SELECT pgs_id, count(*) / 8 AS score_sum, count(*) AS n_matched FROM {scorefile} GROUP BY 1"
_GOT = "SELECT pgs_id, CASE WHEN n_matched % 5 = 1 THEN score_sum + 0.00001e0 WHEN n_matched % 5 = 2 THEN score_sum + 0.0000001e0 ELSE score_sum END AS score_sum, CASE WHEN n_matched % 7 = 3 THEN n_matched + 1 ELSE n_matched END AS n_matched FROM ({0}) WHERE n_matched % 11 <> 4".replace("{0}", _WANT)


@query("q77_smoke_compare", f"SELECT w.pgs_id, w.score_sum, w.n_matched, g.score_sum AS got_sum, CAST(g.n_matched AS string) AS got_n FROM ({_WANT}) w LEFT JOIN ({_GOT}) g ON w.pgs_id = g.pgs_id WHERE NOT coalesce(abs(w.score_sum - g.score_sum) < 1e-6 AND w.n_matched = g.n_matched, false)")
def q77(v):
    return B.smoke(v.sql(_WANT), v.sql(_GOT))


_GONE = "SELECT vid FROM {variant2} WHERE vid % 29 = 5"


@query("q78_guarded_rewrite", f"""WITH s AS (SELECT *, row_number() OVER (PARTITION BY accession, vid, matched_allele, effect_type ORDER BY row_nr) - 1 AS split, vid % 29 = 5 AS is_gone FROM ({_ROWS})), n AS (SELECT effect_type, CAST(split AS int) AS split, count(*) AS n_before, count(*) FILTER (is_gone) AS n_deleted, count(*) - count(*) FILTER (is_gone) AS n_after FROM s GROUP BY 1, 2)
 SELECT *, n_after > 0 AND coalesce(n_after < lag(n_after) OVER (PARTITION BY effect_type ORDER BY split), true) AS usable FROM n""")
def q78(v):
    return M.rewritten(M.splits(rows(v)), v.sql(_GONE))[1]


# What goes: matched rows of one accession's list, some of which leave others of their variant behind, and some of no cached row.
_DELETED = f"SELECT accession, vid, matched_allele, effect_type FROM ({_ROWS}) WHERE vid % 29 = 5 UNION ALL SELECT accession, vid, matched_allele, effect_type FROM ({_ROWS}) WHERE vid % 31 = 7 AND accession < 'PGS000020' UNION ALL SELECT accession, -vid, matched_allele, effect_type FROM ({_ROWS}) WHERE vid % 97 = 1"
_CACHED, _PASSING = "SELECT DISTINCT accession FROM {scorefile}", "SELECT DISTINCT accession FROM {scorefile} WHERE accession NOT LIKE 'PGS%3_hmPOS%'"


@query("q78b_rewrite_faults", f"""WITH s AS (SELECT *, CAST(row_number() OVER (PARTITION BY accession, vid, matched_allele, effect_type ORDER BY row_nr) - 1 AS int) AS split FROM ({_ROWS})), d AS (SELECT d.* FROM ({_DELETED}) d SEMI JOIN ({_PASSING}) USING (accession)),
 ids AS (SELECT DISTINCT vid, matched_allele, effect_type, split FROM s), j AS (SELECT d.*, split FROM d LEFT JOIN ids USING (vid, matched_allele, effect_type)), n AS (SELECT effect_type, split, accession, count(*) AS n FROM s GROUP BY 1, 2, 3),
 k AS (SELECT effect_type, split, accession, count(*) AS gone FROM j WHERE split IS NOT NULL GROUP BY 1, 2, 3), t AS (SELECT *, before - gone AS after FROM (SELECT effect_type, split, CAST(sum(n) AS bigint) AS before, CAST(coalesce(any_value(gone), 0) AS bigint) AS gone FROM n LEFT JOIN (SELECT effect_type, split, sum(gone) AS gone FROM k GROUP BY 1, 2) USING (effect_type, split) GROUP BY 1, 2)),
 o AS (SELECT *, before >= lag(before) OVER w OR after >= lag(after) OVER w AS badly FROM t WINDOW w AS (PARTITION BY effect_type ORDER BY split)),
 x AS (SELECT effect_type, split, count(*) AS removed FROM ids SEMI JOIN (SELECT vid FROM j WHERE split IS NOT NULL) USING (vid) GROUP BY 1, 2), e AS (SELECT effect_type, split, count(*) AS expected FROM (SELECT DISTINCT vid, matched_allele, effect_type, split FROM j WHERE split IS NOT NULL) GROUP BY 1, 2)
 SELECT 'passing set changed' AS fault, NULL AS effect_type, NULL::INT AS split, accession, count(*) AS n FROM (SELECT accession FROM ({_CACHED}) ANTI JOIN ({_PASSING}) USING (accession) UNION ALL SELECT accession FROM ({_PASSING}) ANTI JOIN ({_CACHED}) USING (accession)) GROUP BY 4
 UNION ALL SELECT 'no cached row', effect_type, NULL, accession, count(*) FROM j WHERE split IS NULL GROUP BY 2, 4
 UNION ALL SELECT 'empty', effect_type, split, NULL, after FROM t WHERE after <= 0 UNION ALL SELECT 'sizes do not fall', effect_type, split, NULL, after FROM o WHERE badly
 UNION ALL SELECT 'accession vanishes', effect_type, split, accession, n - coalesce(gone, 0) FROM n LEFT JOIN k USING (effect_type, split, accession) WHERE n <= coalesce(gone, 0)
 UNION ALL SELECT 'removes others', effect_type, split, NULL, coalesce(removed, 0) - coalesce(expected, 0) FROM x FULL JOIN e USING (effect_type, split) WHERE coalesce(removed, 0) <> coalesce(expected, 0)""")
def q78b(v):
    own = rows(v).select("accession", "vid", "matched_allele", "effect_type")
    deleted = own.where("vid % 29 = 5").union(own.where("vid % 31 = 7 and accession < 'PGS000020'")).union(own.where("vid % 97 = 1").withColumn("vid", -F.col("vid")))
    return M.rewrite_faults(M.splits(rows(v)), deleted, v.sql(_CACHED), v.sql(_PASSING))


_OWN = "SELECT vid FROM {g25} WHERE iid = 3"
_LAB_OWN = _LAB.replace(_FIT, f"SELECT * FROM ({_FIT}) WHERE vid IN ({_OWN})")


@query("q79_restrict_and_match", f"SELECT accession, row_nr, vid, match_status, duplicate_id FROM ({_LAB_OWN})")
def q79(v):
    return M.restricted(v.scoredup, v.variant2, v.sql(_OWN)).select("accession", "row_nr", "vid", "match_status", "duplicate_id")


@query("q80_largest_files", f"SELECT name, size, CASE WHEN row_number() OVER (ORDER BY size DESC, name) <= 8 THEN 'head' ELSE 'tail' END AS part FROM ({_FILES})")
def q80(v):
    return B.largest(v.sql(_FILES))


@query("q81_genome_chunks", "SELECT true AS in_order, 8 AS n_chunks, count(*) AS n FROM {variant}")
def q81(v):
    """Chunks follow each other in the genome: by chunk the first and last place, none of which may overlap the next."""
    from pyspark.sql import Window

    from strandline.operators.targets import genome_order

    place = F.struct(genome_order().alias("c"), "pos")
    ends = B.chunks(v.variant, 8).groupBy("chunk").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count(F.lit(1)).alias("n"))
    after = F.lead("lo").over(Window.orderBy("chunk"))
    return ends.select(F.coalesce(F.col("hi") <= after, F.lit(True)).alias("fine"), "n").agg(F.bool_and("fine").alias("in_order"), F.count(F.lit(1)).cast("int").alias("n_chunks"), F.sum("n").alias("n"))


@query("q82_label_counts", f"""SELECT accession, match_status, ambiguous, is_multiallelic, duplicate_best_match, duplicate_id, flipped, ['refalt', 'altref', 'refalt_flip', 'altref_flip', 'no_oa_ref', 'no_oa_alt', 'no_oa_ref_flip', 'no_oa_alt_flip'][priority] AS match_type, exclude, count(*) AS n
 FROM (SELECT l.*, m.is_multiallelic FROM ({_LAB}) l JOIN (SELECT chrom, pos, count(DISTINCT vid) > 1 AS is_multiallelic FROM ({_LAB}) GROUP BY 1, 2) m ON l.chrom = m.chrom AND l.pos = m.pos) WHERE best_match GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9""")
def q82(v):
    return M.label_counts(labels(v))


@query("q83_notable", f"SELECT sample, trait, pgs_id, percentile, category FROM ({_REP}) WHERE percentile IS NOT NULL QUALIFY row_number() OVER (ORDER BY percentile DESC, sample, trait) <= 12")
def q83(v):
    return representative(v).where("percentile is not null").orderBy(F.desc("percentile"), "sample", "trait").limit(12).select("sample", "trait", "pgs_id", "percentile", "category")


VIEWS["shipped"] = "SELECT l_orderkey % 25 AS iid, l_partkey % 22 AS chrom, l_partkey AS pos, l_returnflag AS ref, l_linestatus AS alt, l_shipdate AS ts FROM {lineitem}"


@query("x03_stream_first_records", "SELECT DISTINCT iid, chrom, pos, ref, alt, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day FROM {shipped}")
def x03(v):
    """First records of a stream by key and day; the watermark lets the state of past days go."""
    lines = E.stream_of(v.spark, v.sf_dir, "lineitem")
    own = lines.selectExpr("l_orderkey % 25 as iid", "l_partkey % 22 as chrom", "l_partkey as pos", "l_returnflag as ref", "l_linestatus as alt", "date_trunc('day', l_shipdate) as at")
    out = E.first_records(own.withWatermark("at", "30000 days"), "at")
    return E.drained(out.select("iid", "chrom", "pos", "ref", "alt", F.date_format("at", "yyyy-MM-dd").alias("day")), extensions._folder(v, "x03"), "append")
