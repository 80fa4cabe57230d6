"""Places for intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, else the session's checkpoint folder; a local session without either gets a new one, a cluster has none to fall back to."""
    sc = spark.sparkContext
    if root := sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir():
        return root.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir().rstrip("/")


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is there goes when the session ends."""
    path = f"{_root(spark)}/{name}-{uuid.uuid4().hex}"
    fs, at = _files(spark, path)
    fs.deleteOnExit(at)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to a scratch table and read again: its lineage ends here, and a lost executor takes nothing with it. The job's shuffle files go when it has ended."""
    path, conf = scratch(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing reads any more."""
    for t in tables:
        fs, at = _files(t.sparkSession, t.scratch)
        fs.delete(at, True)
