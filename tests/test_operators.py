"""Small cases of the operators, with known results."""

from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from strandline.functions import alleles as A
from strandline.functions import report
from strandline.functions.math import norm_cdf, norm_ppf
from strandline.operators import batch, calibrate, catalogue, genotypes, grade, match, panel, score, targets


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_normal_functions(spark):
    ps = [1e-6, 0.001, 0.07, 0.2, 0.5, 0.87, 0.99, 0.999999]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select("p", F.expr(norm_ppf("p")).alias("z")).withColumn("back", F.expr(norm_cdf("z"))).collect()
    for r in got:
        assert r["z"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-12)
        assert r["back"] == pytest.approx(r["p"], abs=1e-12)


@pytest.mark.parametrize("per_sd, base, pct, rr, ar", [(1.61, 0.129, 20.0, 0.598, 0.0814), (1.61, 0.129, 87.0, 1.527, 0.1844), (1.61, 0.129, 0.0, 0.093, 0.0136), (1.61, 0.129, 100.0, 8.588, 0.5598), (1.71, 0.49, 95.0, 2.093, 0.6679), (1.5, 0.4, 50.0, 0.921, 0.3804)])
def test_absolute_risk(spark, per_sd, base, pct, rr, ar):
    a, b = grade.risk_columns()
    got = spark.createDataFrame([(pct, per_sd, base)], "percentile double, per_sd double, baseline_risk double").select(F.round(a, 3), F.round(b, 4)).first()
    assert tuple(got) == (rr, ar)


def test_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("EUR", "EUR100%", "European", "EUR (x", " eur ", "EUR, EAS", "multi", "EUR/AFR", "", None)], "x string")
    assert [r[0] for r in df.select(A.european_only("x")).collect()] == [True] * 5 + [False] * 5
    df = spark.createDataFrame([("AB_12.x",), ("_.-",), ("reference",), (None,)], "x string")
    assert [r[0] for r in df.select(A.internal_id("x")).collect()] == ["AB12x", None, None, None]
    df = spark.createDataFrame([(x,) for x in ("0/1", "1|1", "0/0", "./.", "1", "0|.")], "x string")
    assert [r[0] for r in df.select(A.gt_class("x")).collect()] == ["het", "homalt", None, None, None, None]


def test_sex_from_genotypes(spark):
    people = {1: (40, 60), 2: (3, 97), 3: (15, 85), 4: (3, 2)}
    gts = spark.createDataFrame([(i, "0/1") for i, (h, _) in people.items() for _ in range(h)] + [(i, "1/1") for i, (_, h) in people.items() for _ in range(h)], "iid int, gt string")
    assert dict(rows(genotypes.sex_from_genotypes(gts), "iid", "sex")) == {1: "female", 2: "male", 3: "unknown", 4: "unknown"}


def test_repair_and_fill(spark):
    recs = spark.createDataFrame([(1, 1, 10, "A", ".", "0/0", 9, 1), (1, 1, 20, "C", ".", "0/0", 9, 2), (1, 1, 20, "C", "T", "0/1", 9, 3), (1, 1, 20, "C", "T", "0/1", 9, 4), (1, 1, 30, "G", ".", "0/0", 5, 5)], "iid int, chrom int, pos int, ref string, alt string, gt string, depth int, ord int")
    fixed = genotypes.repaired(recs)
    assert rows(fixed, "ord", "fate") == [(1, "kept"), (2, "dropped_homref"), (3, "kept"), (4, "dropped_dup"), (5, "kept")]
    table = spark.createDataFrame([(1, 10, "A", "G"), (1, 30, "T", "C"), (2, 30, "G", "C")], "chrom int, pos int, ref string, first_alt string")
    assert rows(genotypes.alt_filled(fixed, table).where("fate = 'kept'"), "ord", "new_alt", "ad") == [(1, "G", "9,0"), (3, "T", "9"), (5, ".", "5")]


def test_repair_counters(spark):
    """Eight records at four positions: a variant with its reference twin, an indel with a repeat and a reference record, one reference record, two of them."""
    cases = [(10, "G", "1/1", "1,9"), (10, ".", "0/0", "9"), (20, "AGG", "0/1", "5,4"), (20, "AGG", "0/1", "5,4"), (20, ".", "0/0", "9"), (30, ".", "0/0", "9"), (31, ".", "0/0", "9"), (31, ".", "0/0", "9")]
    recs = spark.createDataFrame([(1, "chr1", p, "A", alt, gt, ad, i) for i, (p, alt, gt, ad) in enumerate(cases)], "iid int, chrom string, pos int, ref string, alt string, gt string, depth string, ord int")
    table = spark.createDataFrame([(c, p, "A", "T") for c in ("chr1", "chr2") for p in (10, 20, 30, 31)], "chrom string, pos int, ref string, first_alt string")
    out = genotypes.alt_filled(genotypes.repaired(recs), table)
    assert rows(out.where("fate = 'kept'"), "pos", "new_alt") == [(10, "G"), (20, "AGG"), (30, "T"), (31, ".")]
    assert genotypes.repair_counters(out).first()[1:] == (5, 1, 3, 2, 2)
    missing = recs.where("pos = 30").withColumn("depth", F.lit("."))
    assert genotypes.alt_filled(genotypes.repaired(missing), table).first()["ad"] == "."


def test_places_of_one_sex_chromosome_and_forced_genotypes(spark):
    recs = spark.createDataFrame([(1, "chrX", 2781480, "A", "T", "0/1"), (1, "chrX", 2781479, "A", "T", "0/1"), (1, "chrX", 3000000, "A", "T", "./."), (1, "chr1", 3000000, "A", "T", "0/1")], "iid int, chrom string, pos int, ref string, alt string, gt string")
    assert rows(genotypes.on_chrx_alone(recs), "pos") == [(2781480,)]
    sites = spark.createDataFrame([("chr1", 3000000, "A"), ("chr1", 5, "C"), ("chr1", 6, "C")], "chrom string, pos int, ref string")
    depth = spark.createDataFrame([(1, "chr1", 3000000, 9), (1, "chr1", 5, 4), (1, "chr1", 6, 0)], "iid int, chrom string, pos int, depth int")
    assert rows(genotypes.genotyped_at_targets(recs, sites, depth), "pos", "alt", "gt") == [(5, ".", "0/0"), (6, ".", "./."), (3000000, "T", "0/1")]


def test_evidence_grade_truth_table(spark):
    sizes, flags = (300000, 250000, 100000, 50000, 10000, 9999), [(e, m) for e in (True, False) for m in (True, False)]
    df = spark.createDataFrame([(n, e, m) for n in sizes for e, m in flags], "n long, e boolean, m boolean")
    for r in df.select("*", catalogue.evidence_grade(F.col("n"), F.col("e"), F.col("m")).alias("g")).collect():
        want = "A" if r["n"] >= 100000 and r["e"] and (r["m"] or r["n"] >= 250000) else "B" if r["n"] >= 50000 and r["e"] else "C" if r["n"] >= 10000 else "D"
        assert r["g"] == want, r
    dist = spark.sql("SELECT 1 AS k, map('EUR', 5.0D, 'AFR', 0.0D) AS d UNION ALL SELECT 2, map('European', 5.0D) UNION ALL SELECT 3, map('EAS', 2.0D, 'AFR', 2.0D) UNION ALL SELECT 4, map('EUR', 1.0D)")
    assert rows(dist.select("k", catalogue.multi_ancestry(F.col("d")).alias("m"), catalogue.major_ancestry(F.col("d")).alias("a")), "k", "m", "a") == [(1, True, "EUR"), (2, False, "European"), (3, True, "EAS"), (4, False, "EUR")]


def test_coverage_of_scores_without_a_match(spark):
    own = spark.createDataFrame([("a", 1), ("a", None), ("b", 9)], "accession string, vid int")
    calls = spark.createDataFrame([(1, 1, 2), (2, 1, None)], "iid int, vid int, dosage int")
    assert rows(score.coverage(own, calls), "iid", "accession", "n_matched", "match_rate") == [(1, "a", 1, 0.5), (1, "b", 0, 0.0), (2, "a", 0, 0.0), (2, "b", 0, 0.0)]
    scores = spark.createDataFrame([(1, "a", 8.0), (1, "b", 9.0), (1, "c", None)], "sample int, pgs_id string, denom double")
    covered = spark.createDataFrame([("a", 3, 4)], "pgs_id string, matched long, total long")
    sizes = spark.createDataFrame([("a", 100), ("b", 5)], "pgs_id string, n_variants int")
    assert rows(score.coverage_or_denominator(scores, covered, sizes), "pgs_id", "n_matched", "match_rate") == [("a", 3, 0.75), ("b", 4, 0.8), ("c", None, None)]


def test_explicit_fraction(spark):
    recs = spark.createDataFrame([(1, "1", 10, "0/0"), (1, "1", 20, "0/1"), (1, "1", 30, "./.")], "iid int, chrom string, pos int, gt string")
    sites = spark.createDataFrame([("1", 10), ("1", 20), ("1", 30), ("2", 5)], "chrom string, pos int")
    r = genotypes.explicit_fraction(recs, sites).first()
    assert (r["n_explicit"], r["n_targets"], round(r["fraction"], 3), r["all_sites"]) == (2, 3, 0.667, True)


def test_match_status_truth_table(spark):
    cases = [(b, e) for b in (None, True, False) for e in (None, True, False)]
    got = spark.createDataFrame(cases, "b boolean, e boolean").select(match.match_status(F.col("b"), F.col("e"))).collect()
    assert [r[0] for r in got] == [None, "excluded", "unmatched", "matched", "excluded", "matched", "not_best", "not_best", "not_best"]


def test_consensus_and_meta(spark):
    df = spark.createDataFrame([(1, "CAD", 82.0), (1, "CAD", 88.0), (1, "T2D", 15.0), (1, "T2D", 71.0), (1, "LDL", 60.0)], "sample int, trait string, percentile double")
    got = {r["trait"]: r for r in grade.consensus(df).collect()}
    assert got["CAD"]["robustness_concordance"] == 0.94 and got["CAD"]["same_tertile"]
    assert got["T2D"]["robustness_concordance"] == 0.44 and not got["T2D"]["same_tertile"]
    assert got["LDL"]["robustness_concordance"] is None
    z = spark.createDataFrame([(1, "a", 1.5, 1.0), (1, "a", 2.5, 1.0), (2, "a", 1.5, 1.0), (2, "a", 2.5, 3.0), (3, "a", 1.0, 1.0)], "sample int, trait string, z double, weight double")
    assert rows(grade.meta_scores(z), "sample", "meta_z") == [(1, 2.0), (2, 2.25)]


def test_gates_stack(spark):
    cols = "sample int, pgs_id string, trait string, base_grade string, training_ancestry string, pop string, match_rate double, percentile double, per_sd double, baseline_risk double"
    df = spark.createDataFrame([(1, "p", "t", "A", "EUR", "EUR", 0.9, 80.0, 1.5, 0.1), (2, "p", "t", "A", "EUR", "AFR", 0.5, 80.0, 1.5, 0.1), (3, "p", "t", "B", "EUR", "AFR", 0.9, None, 1.5, 0.1), (4, "p", "t", None, "multi", "AFR", 0.9, 5.0, None, None)], cols)
    out = grade.graded(df)
    assert rows(out, "sample", "evidence_grade", "portability_flag") == [(1, "A", False), (2, "D", True), (3, "D", False), (4, "C", False)]
    assert grade.violations(out).count() == 0
    assert out.where("sample = 3").first()["absolute_risk"] is None


def test_panel_rank_is_strictly_below(spark):
    df = spark.createDataFrame([(i, "a", "reference", v) for i, v in enumerate((-2, -1, 0, 1))] + [(9, "a", "target", 1), (8, "b", "target", 1)], "iid int, trait string, sampleset string, score_sum long")
    assert rows(calibrate.panel_ranks(df, ["trait"]).where("iid >= 8"), "iid", "percentile") == [(8, None), (9, 75.0)]


def test_effect_types(spark):
    g = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (1, 3, None)], "iid int, vid int, dosage int")
    r = spark.createDataFrame([("s", 1, 10, True, "dominant"), ("s", 2, 10, True, "recessive"), ("s", 3, 10, True, "additive")], "accession string, vid int, w long, effect_is_alt boolean, effect_type string")
    assert rows(score.sums(r, g, by_type=True), "score_sum", "denom") == [(10, 4)]
    f = spark.createDataFrame([(3, 0.25)], "vid int, alt_freq double")
    assert rows(score.imputed_sums(r, g, f), "score_sum", "denom", "n_imputed") == [(35000000, 6, 1)]


def test_bins(spark):
    files = spark.createDataFrame([("a", 90), ("b", 60), ("c", 60), ("d", 30), ("e", 150), ("f", 10)], "name string, size long")
    got = rows(batch.first_fit_decreasing(files, 100), "bin", "name")
    assert got == [(1, "e"), (2, "a"), (2, "f"), (3, "b"), (3, "d"), (4, "c")]
    assert batch.first_fit_decreasing(files.limit(0), 100).count() == 0


def test_budget(spark):
    pts = spark.createDataFrame([(0.5, 25.0), (1.0, 45.0), (2.0, 85.0)], "x double, y double")
    assert tuple(batch.budget_fit(pts, 35.0).first()) == (40.0, 5.0, 0.75)


def test_relabel_stops(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "vid int, c string")
    names = spark.createDataFrame([(1, 10)], "old int, new int")
    assert rows(panel.unmapped(df, names), "vid") == [(2,)]
    with pytest.raises(Exception, match="no new id for 2"):
        panel.relabelled(df, names).collect()


def test_target_sites(spark):
    df = spark.createDataFrame([("chr1", 10, "A", "G", "ACGT", 1), ("chr1", 10, "T", "A", "ACGT", 2), ("chr1", 10, "AC", "G", "ACGT", 3), ("chr1", 20, "G", "G", "GGGG", 4)], "chrom string, pos int, effect_allele string, other_allele string, genome string, ord int")
    assert rows(targets.target_sites(df), "chrom", "pos", "ref", "alts", "conflicts") == [("chr1", 10, "A", ["G", "T"], 1)]


def test_uniformity(spark):
    df = spark.createDataFrame([("even", i / 20) for i in range(2000)] + [("two", 5.0 + 10 * (i % 2)) for i in range(2000)] + [("few", 1.0)] * 3, "k string, percentile double")
    got = {r["k"]: (r["uniform"], r["max_dev"]) for r in calibrate.uniformity(df, ["k"]).collect()}
    assert got["even"][0] and got["even"][1] < 0.02 and not got["two"][0] and got["two"][1] > 0.1 and not got["few"][0]


def test_selection_with_pin(spark):
    df = spark.createDataFrame([("t", "a", "A", 10, 1), ("t", "b", "B", 99, 1), ("u", "c", "C", 1, 1)], "trait string, pgs_id string, grade string, gwas_n long, n_variants long")
    pins = spark.createDataFrame([("t", "b"), ("u", "z")], "trait string, pgs_id string")
    assert rows(catalogue.selected(df, 1, pins), "trait", "pgs_id", "pinned") == [("t", "b", True), ("u", "z", True)]


# --- rules of loaders, calls, gates and rewrites


def test_effects_without_a_number_do_not_win(spark):
    effects = spark.createDataFrame([("P9", "CAD", None, 1), ("P8", " CAD", 1.6, 2), ("P1", "x", 1.5, 3), ("P1", "x", None, 4), ("P2", "Y ", 1.2, 5), ("P2", "y", 1.4, 6)], "pgs_id string, trait string, per_sd double, ord int")
    scores = spark.createDataFrame([("P1", "x"), ("Q", "cad "), ("P9", "CAD"), ("P2", "z"), ("Q", "y"), ("Q", "none")], "pgs_id string, trait string")
    assert rows(grade.effect_of(scores, effects), "pgs_id", "trait", "per_sd") == [("P1", "x", 1.5), ("P2", "z", 1.4), ("P9", "CAD", 1.6), ("Q", "cad ", 1.6), ("Q", "none", None), ("Q", "y", 1.2)]


def test_baselines_without_a_risk_do_not_win(spark):
    base = spark.createDataFrame([("CAD ", "male", "overall", None, 1), ("cad", "overall", "overall", 0.3, 2), ("CAD ", "female", "overall", 0.1, 3), ("T2D", "overall", "overall", 0.5, 4), ("T2D", "overall", "overall", 0.4, 5)], "trait string, sex string, ancestry string, baseline_risk double, ord int")
    scores = spark.createDataFrame([(1, "p", "CAD", "male", "EUR"), (2, "p", " cad", "female", "EUR"), (3, "p", "t2d", None, None)], "sample int, pgs_id string, trait string, sex string, ancestry string")
    assert rows(grade.baseline_of(scores, base), "sample", "baseline_risk", "baseline_sex") == [(1, 0.3, "overall"), (2, 0.1, "female"), (3, 0.4, "overall")]


def test_archaic_calls_take_the_first_whole_call(spark):
    records = spark.createDataFrame([
        (1, "chr1", 10, "A", "G", "./1", 1), (1, "chr1", 10, "A", "G", "0/1", 2), (1, "1", 20, "A", "G", "1|1", 3), (1, "1", 20, "A", "G", "0/0", 4), (1, "2", 30, "C", ".", "0/1", 5), (1, "2", 31, "C", "T", ".", 6), (1, "2", 32, "C", "T", None, 7), (2, "2", 31, "C", "T,g", "2", 8),
    ], "iid int, chrom string, pos int, ref string, alt string, gt string, ord int")
    panel = spark.createDataFrame([("chr1", 10, "G"), ("1", 20, "g"), ("chr2", 30, "T"), ("chr2", 31, "G"), ("chr2", 32, "T")], "chrom string, pos int, archaic string")
    assert rows(batch.archaic_calls(records, panel), "iid", "archaic", "total", "sites") == [(1, 3, 5, 3), (2, 1, 1, 1)]


def test_gates_go_by_what_is_not_rounded(spark):
    cols = "sample int, pgs_id string, trait string, base_grade string, training_ancestry string, pop string, match_rate double, percentile double, per_sd double, baseline_risk double"
    out = grade.graded(spark.createDataFrame([(1, "p", "t", "A", "EUR", "EUR", 0.74996, 80.04, 1.5, 0.1), (2, "p", "t", "A", "EUR", "EUR", 0.75, 80.0, 1.5, 0.1)], cols))
    assert rows(out, "sample", "evidence_grade", "match_rate", "percentile") == [(1, "C", 0.75, 80.0), (2, "A", 0.75, 80.0)]
    one, two = (r["absolute_risk"] for r in out.orderBy("sample").collect())
    assert one > two


def test_consensus_counts_scores_without_a_percentile(spark):
    df = spark.createDataFrame([(1, "CAD", 82.0), (1, "CAD", None), (1, "CAD", 88.0), (1, "T2D", None), (1, "LDL", 60.0), (1, "LDL", None)], "sample int, trait string, percentile double")
    assert rows(grade.consensus(df), "trait", "robustness_n_scores", "robustness_concordance", "same_tertile") == [("CAD", 3, 0.94, True), ("LDL", 2, None, None), ("T2D", 1, None, None)]


def test_a_rewritten_file_is_a_new_one_where_no_guard_speaks(spark):
    data = [(a, i, v, "A", "additive", 10 * v + i) for i, a in enumerate("abc") for v in range(8)] + [("a", 90 + v, v, "A", "additive", v) for v in range(5)] + [("b", 80, 0, "A", "additive", 7)]
    cached = match.splits(spark.createDataFrame(data, "accession string, row_nr int, vid int, matched_allele string, effect_type string, w int"))
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "accession string")
    deleted = cached.where("vid in (6, 7)").select("accession", "vid", "matched_allele", "effect_type")
    assert match.rewrite_faults(cached, deleted, names, names).count() == 0
    kept, _ = match.rewritten(cached, deleted)
    wide = lambda df: rows(match.wide_weights(df.where("split = 0"), ["a", "b", "c"]), "vid", "a", "b", "c")
    assert wide(kept) == wide(match.splits(cached.drop("split").where("vid not in (6, 7)")))
    faults = lambda d, before=names, now=names: {r["fault"] for r in match.rewrite_faults(cached, d, before, now).collect()}
    assert faults(deleted, names, names.where("accession <> 'c'")) == {"passing set changed"}
    assert "no cached row" in faults(deleted.withColumn("vid", F.col("vid") + 100))
    assert {"accession vanishes", "sizes do not fall"} & faults(cached.where("split = 1 and accession = 'b'").select("accession", "vid", "matched_allele", "effect_type"))
    assert "empty" in faults(cached.select("accession", "vid", "matched_allele", "effect_type"))


def test_body_systems_go_by_the_first_word_of_the_list(spark):
    cases = {"Thyroid cancer": "cancer", "hypoTHYROIDism": "endo", "Lupus nephritis of the kidney": "msk", "lupus and colitis": "gut", "atopic asthma": "resp", "height": "anthro", "freckles": "default", "": "default", None: "default"}
    rows = spark.createDataFrame([(t,) for t in cases], "trait string").select("trait", report.body_system(F.col("trait")).alias("s"), report.system_name(report.body_system(F.col("trait"))).alias("n")).collect()
    assert {r["trait"]: r["s"] for r in rows} == cases
    assert {r["s"]: r["n"] for r in rows}["msk"] == "bones & joints" and all(r["n"] for r in rows)


def test_ancestries_of_samples_are_one_text(spark):
    df = spark.createDataFrame([([("European",), (None,), ("East Asian",)],), ([],)], "samples array<struct<ancestry_broad:string>>")
    assert [r[0] for r in df.select(report.ancestry_text(F.col("samples"))).collect()] == ["European  East Asian", ""]
