"""Tables between the steps of a plan, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, else the session's checkpoint folder. A local session without either gets a new one; on a cluster there is none to fall back to."""
    sc = spark.sparkContext
    if named := sc.getConf().get("spark.checkpoint.dir"):
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.getCheckpointDir():
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; what is written there goes when the session ends."""
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read again, so that a plan which uses it several times does not work it out several times."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables of kept() that nothing reads any more."""
    for t in tables:
        at = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t.kept_at)
        at.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
