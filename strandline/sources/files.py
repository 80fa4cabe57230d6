"""Readers and writers of scoring files, VCF text, tables and results. Lists of files are few; rows are read by executors."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.alleles import number, with_chr
from strandline.operators.targets import genome_order

CONTRACT = (
    "sample", "trait", "efo_id", "pgs_id", "source_pmid", "source_doi", "n_variants", "training_ancestry", "n_matched", "match_rate", "inferred_ancestry", "most_similar_pop", "ancestry_distance",
    "percentile", "z_score", "ci_low", "ci_high", "absolute_risk", "baseline_incidence", "risk_ratio", "robustness_n_scores", "robustness_concordance", "evidence_grade", "portability_flag", "allowed_statement",
)


def _optional(df: DataFrame, *names: str) -> Column:
    """The first of the columns that df has and that is not empty; null where it has none."""
    have = [F.nullif(F.trim(F.col(n)), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*have) if have else F.lit(None).cast("string")


def table(spark: SparkSession, path, sep: str = "\t", comment: str | None = None) -> DataFrame:
    """A table with a header, whose names become lower case; all columns are text."""
    options = {"sep": sep, "header": True, **({"comment": comment} if comment else {})}
    df = spark.read.options(**options).csv(path)
    return df.toDF(*(c.lower().lstrip("#") for c in df.columns))


def _by_name(names: Column, cells: Column, *wanted: str) -> Column:
    """The first of the cells under these names that is not empty; null where the file has none."""
    cell = lambda n: F.nullif(F.trim(F.get(cells, F.nullif(F.array_position(names, n), F.lit(0)).cast("int") - 1)), F.lit(""))
    return F.coalesce(*map(cell, wanted))


def scorefiles(spark: SparkSession, paths) -> DataFrame:
    """Scoring rows of files with # comment lines and a header; harmonised columns win over the author's. Columns that a file lacks are null; the accession is the file's name. All files are one scan: each file's header, a row, is joined to its lines."""
    lines = spark.read.text(paths).where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.col("_metadata.file_name").alias("file"), F.split("value", "\t").alias("cells"))
    lower = F.transform("cells", lambda x: F.lower(F.trim(x)))
    header = F.array_contains(lower, "effect_allele") & F.array_contains(lower, "effect_weight")
    heads = lines.where(header).groupBy("file").agg(F.first(lower).alias("names"))
    get = lambda *n: _by_name(F.col("names"), F.col("cells"), *n)
    return lines.where(~header).join(heads, "file").select(
        F.regexp_extract("file", r"([^/]+?)(?:\.txt|\.tsv)?(?:\.gz)?$", 1).alias("accession"), get("hm_chr", "chr_name").alias("chr_name"), get("hm_pos", "chr_position").alias("position"),
        F.upper(get("effect_allele")).alias("effect_allele"), F.upper(get("other_allele")).alias("other_allele"), F.upper(get("hm_inferotherallele")).alias("inferred_other"), number(get("effect_weight")).alias("effect_weight"),
    )


def loci(rows: DataFrame) -> DataFrame:
    """The distinct places of scoring rows, in the order of the genome."""
    own = rows.select(with_chr("chr_name").alias("chrom"), F.col("position").try_cast("bigint").alias("pos")).where("pos is not null").distinct()
    return own.orderBy(genome_order("chrom"), "chrom", "pos")


def vcf(spark: SparkSession, path, chrom: str | None = None, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Genotype records of VCF text, a row for each sample and record: iid, chrom, pos, id, ref, alt, gt, fields (a map by FORMAT key). Files may have samples of their own. chrom, lo and hi leave other places out before samples are told apart."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.split(F.rtrim("value"), "\t").alias("c"))
    first = F.get("c", F.lit(0))
    heads = lines.where(first == "#CHROM").groupBy("file").agg(F.first(F.slice("c", 10, F.greatest(F.lit(0), F.size("c") - 9))).alias("samples"))
    cell = lambda i: F.get("c", F.lit(i))
    rows = lines.where(~first.startswith("#") & (F.size("c") > 9)).withColumn("pos", cell(1).try_cast("bigint"))
    if chrom is not None:
        rows = rows.where(first == chrom)
    if lo is not None or hi is not None:
        rows = rows.where((F.col("pos") >= (lo or 0)) & (F.lit(True) if hi is None else F.col("pos") <= hi))
    rows = rows.join(heads, "file").select(*(cell(i).alias(n) for i, n in ((0, "chrom"), (2, "id"), (3, "ref"), (4, "alt"), (8, "format"))), "pos", F.explode(F.arrays_zip("samples", F.slice("c", 10, F.size("c") - 9).alias("cells"))).alias("s"))
    keys, values = F.split("format", ":"), F.split(F.col("s.cells"), ":")
    fields = F.map_from_entries(F.filter(F.transform(keys, lambda k, i: F.struct(k.alias("key"), F.get(values, i).alias("value"))), lambda e: e["value"].isNotNull()))
    return rows.withColumn("fields", fields).select(F.col("s.samples").alias("iid"), "chrom", "pos", "id", "ref", "alt", F.col("fields")["GT"].alias("gt"), "fields")


def appended_zero(keys: Column, values: Column) -> Column:
    """FORMAT values with ,0 appended to the depths by allele, for a record that gets an ALT; missing ones stay so."""
    return F.array_join(F.transform(keys, lambda k, i: F.when(k.isin("AD", "ADF", "ADR") & ~F.get(values, i).isin(".", ""), F.concat(F.get(values, i), F.lit(",0"))).otherwise(F.get(values, i))), ":")


def match_summary(spark: SparkSession, path) -> DataFrame:
    """Rows of a ragged summary by place: the second column, the fourth and the last but one; shorter rows are dropped."""
    c = F.split("value", ",")
    own = spark.read.text(path).where(F.size(c) >= 5)
    return own.select(F.get(c, F.lit(1)).alias("accession"), F.get(c, F.lit(3)).alias("match_status"), F.element_at(c, -2).try_cast("bigint").alias("n")).where("n is not null")


def catalogue(spark: SparkSession, path) -> DataFrame:
    """A JSON object of score ids as rows: pgs_id, record (a map of text; numbers and nested values as their JSON)."""
    text = spark.read.text(path, wholetext=True)
    each = text.select(F.explode(F.from_json("value", "map<string,variant>")).alias("pgs_id", "v"))
    return each.select("pgs_id", F.from_json(F.to_json("v"), "map<string,string>").alias("record"))


def found(spark: SparkSession, folder: str, *patterns: str) -> str | None:
    """The first file, by path, of the first pattern that any file below the folder fits; only names are read."""
    for pattern in patterns:
        if hit := spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(folder).agg(F.min("path")).first()[0]:
            return hit
    return None


def long_scores(spark: SparkSession, folder: str) -> str | None:
    """The file of long scores of a run."""
    return found(spark, folder, "aggregated_scores.txt.gz", "aggregated_scores*.txt.gz", "*_pgs.txt.gz", "*scores*.txt*")


def population(spark: SparkSession, path: str) -> DataFrame:
    """The most similar population of a summary: the first row whose second column is given. One row or none: pop."""
    rows = spark.read.option("header", True).csv(path)
    pop, own = rows.columns[:2]
    given = rows.select(F.col(pop).alias("pop"), F.col(own).alias("own"), F.monotonically_increasing_id().alias("ord")).where((F.col("own") != "") & (F.upper("own") != "NA"))
    return given.orderBy("ord").limit(1).select("pop")


def column_of(df: DataFrame, *names: str) -> str:
    """The first of the names that df has, whatever the case; raises where it has none."""
    have = {c.lower().lstrip("#"): c for c in df.columns}
    for n in names:
        if n.lower() in have:
            return have[n.lower()]
    raise ValueError(f"none of {', '.join(names)} among {', '.join(df.columns)}")


def archaic_panel(spark: SparkSession, path: str) -> DataFrame:
    """Sites of an archaic panel: chrom (with prefix), pos, ref, archaic (upper case), weight (1 where it is not a number). Rows without a place or an allele are left out."""
    raw = table(spark, path, comment="#")
    ref, archaic = (F.upper(_optional(raw, *n)) for n in (("ref",), ("archaic_allele", "archaic")))
    out = raw.select(with_chr("chrom").alias("chrom"), F.col("pos").try_cast("bigint").alias("pos"), ref.alias("ref"), archaic.alias("archaic"), F.coalesce(number(_optional(raw, "weight")), F.lit(1.0)).alias("weight"))
    return out.where("pos is not null and ref is not null and archaic is not null")


CALIBRATION = {"slope": 1.0, "intercept": 0.0, "clamp_max": 10.0}


def calibration(spark: SparkSession, path: str | None) -> dict:
    """Slope, intercept, clamp_max and version of a JSON calibration; what it lacks, or all of it where there is no path, is CALIBRATION's."""
    got = spark.read.text(path, wholetext=True).select(F.from_json("value", "slope double, intercept double, clamp_max double, version string").alias("c")).first() if path else None
    known = {k: v for k, v in (got["c"].asDict() if got and got["c"] else {}).items() if v is not None}
    return {**CALIBRATION, "version": "v1", **known}


def contig(spark: SparkSession, path: str, chrom: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Rows of one contig, and of a region of it, of a table that write_genotypes or write_alleles wrote: other contigs' folders are not read, and row groups of other places are skipped."""
    out = spark.read.parquet(path).where(F.col("chrom") == chrom)
    return out if lo is None else out.where(F.col("pos").between(lo, hi))


def aligned(variants: DataFrame, frequencies: DataFrame, missing: DataFrame) -> DataFrame:
    """A panel's variants with their frequencies and shares of missing genotypes, all keyed by id; an id that not all three have is an error when it is met."""
    out = variants.join(frequencies, "id", "full").join(missing, "id", "full")
    whole = F.col("pos").isNotNull() & F.col("alt_freq").isNotNull() & F.col("f_miss").isNotNull()
    return out.where(F.coalesce(F.assert_true(whole, F.concat(F.lit("not in all three files: "), "id")).isNull(), F.lit(True)))


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """sampleset, path_prefix, chrom (null: all), format."""
    return spark.read.schema("sampleset string, path_prefix string, chrom string, format string").option("header", True).csv(path)


def write_samplesheet(df: DataFrame, path: str) -> None:
    df.select("sampleset", "path_prefix", "chrom", "format").write.mode("overwrite").option("header", True).csv(path)


def cached_paths(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """Paths of all wanted scores (pgs_id) in a cache's listing (pgs_id, path); raises where any is lacking."""
    lacking = wanted.select("pgs_id").distinct().join(listing, "pgs_id", "left_anti")
    if some := lacking.orderBy("pgs_id").limit(5).collect():
        raise FileNotFoundError("not in the cache: " + ", ".join(r["pgs_id"] for r in some))
    return listing.join(wanted.select("pgs_id").distinct(), "pgs_id", "left_semi")


def preferred(own: DataFrame, shipped: DataFrame) -> DataFrame:
    """Rows of a run's own table (by pgs_id), and of the shipped one for ids that it lacks."""
    return own.unionByName(shipped.join(own.select("pgs_id"), "pgs_id", "left_anti"))


def effects(spark: SparkSession, path: str) -> DataFrame:
    """Effect sizes in file order: pgs_id (null for NA), trait, per_sd, ord."""
    raw = table(spark, path)
    return raw.select(F.nullif("pgs_id", F.lit("NA")).alias("pgs_id"), "trait", number("per_sd").alias("per_sd"), F.monotonically_increasing_id().alias("ord"))


def baselines(spark: SparkSession, path: str) -> DataFrame:
    """Baseline risks keyed by trait in lower case, sex and ancestry."""
    return table(spark, path).select(F.lower("trait").alias("trait"), "sex", "ancestry", number("baseline_risk").alias("baseline_risk"))


def one_content(spark: SparkSession, paths) -> bool:
    """Whether files that ought to be copies are equal to the byte."""
    return spark.read.format("binaryFile").load(paths).agg(F.count_distinct(F.sha2("content", 256))).first()[0] <= 1


def same_header(*frames: DataFrame) -> DataFrame:
    """All rows of tables whose columns are the same, in the same order; raises otherwise."""
    if len({tuple(f.columns) for f in frames}) > 1:
        raise ValueError("tables with other headers cannot be joined end to end")
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _delimited(df: DataFrame, path: str, sep: str, columns: tuple[str, ...]) -> None:
    have = set(df.columns)
    df.select(*((F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in columns)).write.mode("overwrite").options(sep=sep, header=True, nullValue="NA").csv(path)


SUMMARY = ("dataset", "accession", "score_pass", "match_status", "ambiguous", "is_multiallelic", "duplicate_best_match", "duplicate_ID", "match_flipped", "match_IDs", "count", "percent")
ARCHAIC = ("sample", "neanderthal_pct", "method")
META = ("sample", "trait", "n_scores", "meta_z", "meta_percentile")
PERFORMANCE = ("pgs_id", "metric", "value", "n_reports", "lo", "hi")


def write_summary(df: DataFrame, path: str) -> None:
    _delimited(df, path, ",", SUMMARY)


def write_archaic(df: DataFrame, path: str) -> None:
    _delimited(df, path, "\t", ARCHAIC)


def archaic(spark: SparkSession, path: str) -> DataFrame:
    """What write_archaic wrote: sample, neanderthal_pct (null for NA), method."""
    raw = table(spark, path)
    return raw.select("sample", number("neanderthal_pct").alias("neanderthal_pct"), "method")


def write_meta_scores(df: DataFrame, path: str) -> None:
    _delimited(df, path, "\t", META)


def write_performance(df: DataFrame, path: str) -> None:
    _delimited(df, path, "\t", PERFORMANCE)


def performance(spark: SparkSession, path: str) -> DataFrame:
    raw = table(spark, path)
    return raw.select("pgs_id", "metric", number("value").alias("value"), F.col("n_reports").try_cast("bigint").alias("n_reports"), number("lo").alias("lo"), number("hi").alias("hi"))


def swapped_json(text: Column, old: str, new: str) -> Column:
    """JSON text with a name replaced where a whole key or a whole text value is that name, however deep."""
    quoted = lambda x: '"' + x.replace("\\", "\\\\").replace('"', '\\"') + '"'
    return F.replace(text, F.lit(quoted(old)), F.lit(quoted(new)))


def card(df: DataFrame) -> DataFrame:
    """A line of text for each graded score: card."""
    dash = lambda c, f: F.when(F.col(c).isNotNull(), F.format_string(f, F.col(c))).otherwise("-")
    return df.select("sample", "pgs_id", F.concat_ws("  ", "pgs_id", "trait", F.concat(F.lit("grade "), "evidence_grade"), F.concat(F.lit("percentile "), dash("percentile", "%.1f")), F.concat(F.lit("risk "), dash("absolute_risk", "%.4f"))).alias("card"))


def write_genotypes(df: DataFrame, path: str) -> None:
    """Genotypes by contig, ordered by position, so readers skip what they do not ask for."""
    df.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode("overwrite").partitionBy("chrom").parquet(path)


def write_alleles(df: DataFrame, path: str) -> None:
    """Sites with their first ALT (chrom, pos, ref, first_alt), laid out like genotypes."""
    write_genotypes(df.select("chrom", "pos", "ref", "first_alt"), path)


def write_contract(df: DataFrame, path: str) -> None:
    """The graded table as TSV with its columns in order; absent columns and nulls are NA."""
    _delimited(df, path, "\t", CONTRACT)


def write_json(df: DataFrame, path: str) -> None:
    df.select(*(c for c in df.columns if not c.startswith("_"))).write.mode("overwrite").json(path)


def renamed(df: DataFrame, old: str, new: str, columns: list[str]) -> DataFrame:
    """df with a sample's name replaced where a whole field is the old one; a field of these that still holds the name in part is an error when it is met."""
    out = df.withColumns({c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)) for c in columns})
    left = [F.coalesce(F.contains(F.col(c).cast("string"), F.lit(old)), F.lit(False)) for c in columns if old not in new]
    return out if not left else out.where(F.coalesce(F.assert_true(~reduce(or_, left), F.lit(f"{old} survives")).isNull(), F.lit(True)))


def provenance(spark: SparkSession, graded: DataFrame, **settings: str) -> DataFrame:
    """One row: engine version, time, settings, number of scores, whether any is calibrated."""
    facts = graded.agg(F.count_distinct("pgs_id").alias("n_scores"), F.bool_or(F.col("percentile").isNotNull()).alias("any_calibrated"))
    return facts.select(F.lit(spark.version).alias("engine"), F.current_timestamp().alias("generated"), F.create_map(*(F.lit(x) for kv in settings.items() for x in kv)).alias("settings") if settings else F.lit(None).cast("map<string,string>").alias("settings"), "*")
