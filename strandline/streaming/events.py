"""Structured Streaming over event tables and genotype records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_of(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A stream of a Parquet table's files."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{table}.parquet").parquet(folder)


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums (in hundredths) by window and type."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    out = timed.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", "cents")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by user and session."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    out = timed.groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def first_records(records: DataFrame, at: str) -> DataFrame:
    """The first record of each sample, position, allele pair and time (at, which has the stream's watermark) in a stream; its state is a row for each such key that the watermark has not passed."""
    return records.dropDuplicates(["iid", "chrom", "pos", "ref", "alt", at])


def drained(stream: DataFrame, path: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what there is now, and gives its result. Each batch of a complete result replaces the last one."""
    save = lambda df, _: df.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{path}/result")
    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).foreachBatch(save).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/result")
