"""Genotype tables with an index of their files, and what lies in lists of regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bases of a bin of the range join.
WIDTH = 10_000


def write_indexed(records: DataFrame, path: str, files: int) -> None:
    """Records (chrom, pos and what else) as Parquet files in the order of the genome, below path/data, and path/index: for each file and contig its first and last place and its number of records."""
    records.repartitionByRange(files, "chrom", "pos").sortWithinPartitions("chrom", "pos").write.mode("overwrite").parquet(f"{path}/data")
    written = records.sparkSession.read.parquet(f"{path}/data").select("chrom", "pos", F.col("_metadata.file_name").alias("file"))
    written.groupBy("file", "chrom").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count(F.lit(1)).alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def files_hit(spark: SparkSession, path: str, regions: DataFrame) -> list[str]:
    """Names of the files that hold a place of a region (chrom, start, end; both ends count). Names of files are what any plan holds on the driver."""
    index = spark.read.parquet(f"{path}/index")
    spans = regions.groupBy(F.col("chrom").alias("of")).agg(F.min("start").alias("from"), F.max("end").alias("to"))
    near = index.join(spans, (F.col("chrom") == F.col("of")) & (F.col("last") >= F.col("from")) & (F.col("first") <= F.col("to"))).select("file", "chrom", "first", "last")
    r = regions.select(F.col("chrom").alias("of"), "start", "end")
    return sorted(x["file"] for x in near.join(r, (F.col("chrom") == F.col("of")) & (F.col("last") >= F.col("start")) & (F.col("first") <= F.col("end")), "left_semi").select("file").distinct().collect())


def within(points: DataFrame, regions: DataFrame, width: int = WIDTH) -> DataFrame:
    """Points (chrom, pos and what else) with each region (region, chrom, start, end) that they lie in: an equi-join on bins of the genome, so a long region is a row for each of its bins, and a pair is met in the point's bin alone."""
    r = regions.select("region", F.col("chrom").alias("of"), "start", "end", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width))).alias("of_bin"))
    own = points.withColumn("the bin", F.floor(F.col("pos") / width))
    return own.join(r, (F.col("chrom") == F.col("of")) & (F.col("the bin") == F.col("of_bin")) & F.col("pos").between(F.col("start"), F.col("end"))).select("region", *points.columns)


def fetched(spark: SparkSession, path: str, regions: DataFrame, width: int = WIDTH) -> DataFrame:
    """Records of an indexed table in regions (region, chrom, start, end), with their region. Only files that the index names are opened, and of these Parquet's own statistics skip row groups."""
    files = files_hit(spark, path, regions)
    if not files:
        data = spark.read.parquet(f"{path}/data").where("1 = 0")
    else:
        data = spark.read.parquet(*(f"{path}/data/{f}" for f in files))
    return within(data, regions, width)
