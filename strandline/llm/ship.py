"""Sends this package to the executors, so its functions run where the package is not installed."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    _once(spark.sparkContext.applicationId, spark)


@functools.lru_cache(maxsize=1)
def _once(application: str, spark: SparkSession) -> None:
    top = Path(__file__).resolve().parents[1]
    name = os.path.join(tempfile.mkdtemp(), f"{top.name}.zip")
    with zipfile.ZipFile(name, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(p.relative_to(top.parent)))
    spark.sparkContext.addPyFile(name)
