"""Readers and writers by round trips over small files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from strandline.sources import files, shared


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def lines_of(folder):
    return [x for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def test_scoring_files_of_several_headers(spark, tmp_path):
    with gzip.open(tmp_path / "PGS000001_hmPOS_GRCh38.txt.gz", "wt") as f:
        f.write("#pgs_id=PGS000001\n##x\nrsID\tchr_name\tchr_position\teffect_allele\tother_allele\teffect_weight\thm_chr\thm_pos\thm_inferOtherAllele\n"
                "rs1\t9\t1\ta\tg\t0.5\t1\t100\t\nrs2\t1\t2\tC\t\tNA\tX\t200\tt\nrs3\t2\t7\tc\n")
    (tmp_path / "PGS000002.txt").write_text("chr_name\tchr_position\teffect_allele\teffect_weight\n1\t30\tT\t1e-3\n\n")
    got = files.scorefiles(spark, [str(tmp_path / n) for n in ("PGS000001_hmPOS_GRCh38.txt.gz", "PGS000002.txt")])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, [
        ("PGS000001_hmPOS_GRCh38", "1", "100", "A", "G", None, 0.5), ("PGS000001_hmPOS_GRCh38", "X", "200", "C", None, "T", None), ("PGS000001_hmPOS_GRCh38", "2", "7", "C", None, None, None), ("PGS000002", "1", "30", "T", None, None, 0.001),
    ]))
    assert [tuple(r) for r in files.loci(got).collect()] == [("chr1", 30), ("chr1", 100), ("chr2", 7), ("chrX", 200)]


def test_vcf_of_several_samples_and_a_region(spark, tmp_path):
    head = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"
    (tmp_path / "a.vcf").write_text(head + "s1\ts2\nchr1\t10\t.\tA\tG\t.\t.\t.\tGT:AD\t0/1:3,4\t./.\nchr2\t20\t.\tC\t.\t.\t.\t.\tGT\t0/0\t0|0\n")
    with gzip.open(tmp_path / "b.vcf.gz", "wt") as f:
        f.write(head + "s3\nchr1\t10\t.\tA\tG\t.\t.\t.\tGT:AD\t1/1:0,9\n")
    own = [str(tmp_path / n) for n in ("a.vcf", "b.vcf.gz")]
    got = files.vcf(spark, own)
    assert rows(got.select("iid", "chrom", "pos", "gt", F.coalesce(F.col("fields")["AD"], F.lit("-")).alias("ad")), "iid", "chrom", "pos", "gt", "ad") == [("s1", "chr1", 10, "0/1", "3,4"), ("s1", "chr2", 20, "0/0", "-"), ("s2", "chr1", 10, "./.", "-"), ("s2", "chr2", 20, "0|0", "-"), ("s3", "chr1", 10, "1/1", "0,9")]
    assert rows(files.vcf(spark, own, "chr1", 5, 10), "iid") == [("s1",), ("s2",), ("s3",)] and files.vcf(spark, own, "chr1", 11).count() == 0


def test_depths_get_a_zero_unless_missing(spark):
    df = spark.createDataFrame([(["GT", "AD", "ADF"], ["0/0", "9", "."])], "k array<string>, v array<string>")
    assert df.select(files.appended_zero(F.col("k"), F.col("v"))).first()[0] == "0/0:9,0:."


def test_summary_population_and_discovery(spark, tmp_path):
    run = tmp_path / "run" / "score"
    run.mkdir(parents=True)
    (run / "x_pgs.txt.gz").write_bytes(gzip.compress(b"a"))
    assert files.long_scores(spark, str(tmp_path)).endswith("x_pgs.txt.gz")
    (run / "aggregated_scores.txt.gz").write_bytes(gzip.compress(b"a"))
    assert files.long_scores(spark, str(tmp_path)).endswith("aggregated_scores.txt.gz") and files.found(spark, str(tmp_path), "*.none") is None
    (run / "s.csv").write_text("dataset,accession,score_pass,match_status,count,percent\nd,PGS1,true,matched,7,70.0\nd,PGS1,true,unmatched,x,y,3,30.0\nshort,row\n")
    assert rows(files.match_summary(spark, str(run / "s.csv")), "accession", "match_status", "n") == [("PGS1", "matched", 7), ("PGS1", "unmatched", 3)]
    (run / "pop.csv").write_text("Most similar population,s1,reference\nAFR,NA,10\nEUR,0.9,12\nEAS,0.1,3\n")
    assert [r["pop"] for r in files.population(spark, str(run / "pop.csv")).collect()] == ["EUR"]
    assert files.one_content(spark, [str(run / "s.csv")]) and not files.one_content(spark, [str(run / "s.csv"), str(run / "pop.csv")])


def test_catalogue_panel_calibration_and_resources(spark, tmp_path):
    (tmp_path / "meta.json").write_text(json.dumps({"PGS1": {"trait": "t", "n_variants": 5, "pinned": True, "more": {"a": [1]}}, "PGS2": {"trait": "u"}}))
    got = {r["pgs_id"]: r["record"] for r in files.catalogue(spark, str(tmp_path / "meta.json")).collect()}
    assert got["PGS1"] == {"trait": "t", "n_variants": "5", "pinned": "true", "more": '{"a":[1]}'} and got["PGS2"]["trait"] == "u"
    (tmp_path / "panel.tsv").write_text("# note\nchrom\tpos\tref\tarchaic_allele\tweight\n1\t10\ta\tg\t2\nchr2\tx\tA\tG\t1\nchr3\t30\tC\t\t1\nchr3\t31\tC\tT\tbad\n")
    assert rows(files.archaic_panel(spark, str(tmp_path / "panel.tsv")), "chrom", "pos", "ref", "archaic", "weight") == [("chr1", 10, "A", "G", 2.0), ("chr3", 31, "C", "T", 1.0)]
    (tmp_path / "cal.json").write_text('{"version": "v0.1",\n "slope": 3.0, "intercept": 0.0}')
    assert files.calibration(spark, str(tmp_path / "cal.json")) == {"slope": 3.0, "intercept": 0.0, "clamp_max": 10.0, "version": "v0.1"}
    assert files.calibration(spark, None)["slope"] == 1.0
    (tmp_path / "eff.tsv").write_text("pgs_id\ttrait\tmetric\tper_sd\nNA\tCAD\tOR\t1.6\nPGS1\tcad\tOR\tNA\n")
    assert [(r["pgs_id"], r["per_sd"]) for r in files.effects(spark, str(tmp_path / "eff.tsv")).orderBy("ord").collect()] == [(None, 1.6), ("PGS1", None)]
    (tmp_path / "base.tsv").write_text("trait\tsex\tancestry\tbaseline_risk\nCAD\tmale\tEUR\t0.2\n")
    assert rows(files.baselines(spark, str(tmp_path / "base.tsv")), "trait", "sex", "baseline_risk") == [("cad", "male", 0.2)]


def test_contract_and_other_tables_come_back(spark, tmp_path):
    df = spark.createDataFrame([("s", "PGS1", 87.0, None, "note | more")], "sample string, pgs_id string, percentile double, evidence_grade string, allowed_statement string")
    files.write_contract(df.withColumn("_private", F.lit(1)), str(tmp_path / "c"))
    back = files.table(spark, str(tmp_path / "c"))
    assert back.columns == list(files.CONTRACT) and back.first()["percentile"] == "87.0" and back.first()["trait"] == "NA"
    files.write_json(df.withColumn("_private", F.lit(1)), str(tmp_path / "j"))
    assert "_private" not in spark.read.json(str(tmp_path / "j")).columns
    files.write_archaic(spark.createDataFrame([("s", 1.5, "m"), ("t", None, "m")], "sample string, neanderthal_pct double, method string"), str(tmp_path / "a"))
    assert rows(files.archaic(spark, str(tmp_path / "a")), "sample", "neanderthal_pct")[0] == ("s", 1.5) and files.archaic(spark, str(tmp_path / "a")).where("neanderthal_pct is null").count() == 1
    files.write_performance(spark.createDataFrame([("P", "AUROC", 0.7, 3, None, 0.8)], "pgs_id string, metric string, value double, n_reports long, lo double, hi double"), str(tmp_path / "p"))
    assert tuple(files.performance(spark, str(tmp_path / "p")).first()) == ("P", "AUROC", 0.7, 3, None, 0.8)
    files.write_samplesheet(spark.createDataFrame([("x", "/p", None, "pfile")], "sampleset string, path_prefix string, chrom string, format string"), str(tmp_path / "s"))
    assert tuple(files.samplesheet(spark, str(tmp_path / "s")).first()) == ("x", "/p", None, "pfile")
    files.write_summary(spark.createDataFrame([("PGS1", "matched", 4)], "accession string, match_status string, count long"), str(tmp_path / "m"))
    assert rows(files.match_summary(spark, str(tmp_path / "m")).where("match_status = 'matched'"), "accession", "n") == [("PGS1", 4)]
    files.write_meta_scores(df.select("sample"), str(tmp_path / "e"))
    assert lines_of(tmp_path / "e")[0].split("\t") == list(files.META)
    assert files.card(df.withColumns({"trait": F.lit("t"), "absolute_risk": F.lit(None).cast("double")})).first()["card"] == "PGS1  t  percentile 87.0  risk -"


def test_contract_check_of_a_file(spark, tmp_path):
    from strandline.operators import grade

    good = [("s", "P1", "A", "true", "fine", "80.5", "0.1", "0.9"), ("s", "P2", "E", "maybe", "NA", "140", "NA", "0.5"), ("s", "P3", "B", "false", "fine", "NA", "0.2", "NA")]
    df = spark.createDataFrame(good, "sample string, pgs_id string, evidence_grade string, portability_flag string, allowed_statement string, percentile string, absolute_risk string, match_rate string")
    got = rows(grade.file_problems(df, ("sample", "trait", "evidence_grade")).na.fill("-"), "pgs_id", "problem")
    assert got == sorted([("-", "no column trait"), ("P2", "grade"), ("P2", "flag"), ("P2", "statement"), ("P2", "percentile"), ("P2", "coverage not said"), ("P3", "risk without percentile")])
    assert grade.file_problems(df.where("pgs_id = 'P1'"), ("sample",)).count() == 0


def test_contigs_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([("chr1", p, "A", "G") for p in range(5)] + [("chr2", 7, "C", "T")], "chrom string, pos long, ref string, first_alt string")
    files.write_alleles(df, str(tmp_path / "t"))
    got = files.contig(spark, str(tmp_path / "t"), "chr1", 2, 3)
    assert rows(got, "pos") == [(2,), (3,)] and files.contig(spark, str(tmp_path / "t"), "chr9").count() == 0
    assert "PartitionFilters: [isnotnull(chrom" in got._jdf.queryExecution().toString()


def test_checks_raise(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2)], "id string, pos long")
    f, m = (spark.createDataFrame([(i, 0.5) for i in "ab"], f"id string, {c} double") for c in ("alt_freq", "f_miss"))
    assert files.aligned(v, f, m).count() == 2
    with pytest.raises(Exception, match="not in all three"):
        files.aligned(v, f.where("id = 'a'"), m).collect()
    names = spark.createDataFrame([("s1",), ("other",)], "iid string")
    assert rows(files.renamed(names, "s1", "new", ["iid"]), "iid") == [("new",), ("other",)]
    with pytest.raises(Exception, match="survives"):
        files.renamed(names.union(names.selectExpr("'xs1'")), "s1", "new", ["iid"]).collect()
    listing = spark.createDataFrame([("P1", "/a"), ("P2", "/b")], "pgs_id string, path string")
    assert files.cached_paths(listing.where("pgs_id = 'P1'"), listing).count() == 1
    with pytest.raises(FileNotFoundError, match="P9"):
        files.cached_paths(listing.selectExpr("'P9' as pgs_id"), listing)
    assert rows(files.preferred(listing.where("pgs_id = 'P1'").withColumn("path", F.lit("own")), listing), "path") == [("/b",), ("own",)]
    with pytest.raises(ValueError):
        files.same_header(listing, listing.select("path", "pgs_id"))
    assert files.same_header(listing, listing).count() == 4
    assert files.column_of(listing, "pgs", "PGS_ID") == "pgs_id"
    text = spark.createDataFrame([('{"s1": ["s1", "xs1", {"s1": 1}]}',)], "j string")
    assert text.select(files.swapped_json(F.col("j"), "s1", "n")).first()[0] == '{"n": ["n", "xs1", {"n": 1}]}'


def test_shared_tables(spark):
    assert rows(shared.kept(spark.range(3), "three"), "id") == [(0,), (1,), (2,)]
