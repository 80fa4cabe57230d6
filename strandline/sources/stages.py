"""Builds of tables in stages, each kept under a key of what it depends on, resumable and committed by a rename."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.operators.digests import multiset_digest


class Build:
    """A folder of stages. stage() gives a stage's table: the kept one where its key is the one that it was made under, else a new one. A key is made of the digests of the stage's inputs, of the keys of stages before it, and of a version; digests do not depend on the order of rows. A table is written aside and renamed, and then the manifest is written aside and renamed, so what the manifest names is whole, and an interrupted build goes on behind its last whole stage."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.made, self.kept = spark, folder.rstrip("/"), [], []
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.folder))

    def _at(self, name: str):
        return self._path(f"{self.folder}/{name}")

    def manifest(self) -> dict[str, dict]:
        """What is kept: by stage its key and folder. The newest whole manifest counts."""
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)) if s.getPath().getName().startswith("manifest-"))
        if not names:
            return {}
        lines = self.spark.read.text(f"{self.folder}/{names[-1]}", wholetext=True).first()
        return json.loads(lines[0])

    def _save(self, manifest: dict) -> None:
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)) if s.getPath().getName().startswith("manifest-"))
        new, aside = f"manifest-{int(names[-1].split('-')[1]) + 1 if names else 1:08d}", self._at(f"_aside-{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest, indent=1, sort_keys=True).encode()))
        out.close()
        if not self._fs.rename(aside, self._at(new)):
            raise OSError(f"{new} is there already: another build writes to {self.folder}")
        for name in names:
            self._fs.delete(self._at(name), False)

    def key(self, inputs: dict[str, DataFrame], after: list[str], version: str) -> str:
        """Composite key of a stage."""
        own = {name: list(multiset_digest(df, [], sorted(df.columns)).first()) + sorted(f"{c} {t}" for c, t in df.dtypes) for name, df in sorted(inputs.items())}
        manifest = self.manifest()
        return json.dumps({"version": version, "inputs": own, "after": {s: manifest[s]["key"] for s in sorted(after)}}, sort_keys=True)

    def stage(self, name: str, make: Callable[[], DataFrame], inputs: dict[str, DataFrame] | None = None, after: list[str] | None = None, version: str = "1") -> DataFrame:
        """The table of a stage. after: stages of this build that make() reads."""
        key, manifest = self.key(inputs or {}, after or [], version), self.manifest()
        if manifest.get(name, {}).get("key") == key:
            self.kept.append(name)
            return self.spark.read.parquet(f"{self.folder}/{manifest[name]['folder']}")
        folder, aside = f"{name}-{uuid.uuid4().hex}", f"_aside-{uuid.uuid4().hex}"
        make().write.parquet(f"{self.folder}/{aside}")
        if not self._fs.rename(self._at(aside), self._at(folder)):
            raise OSError(f"{folder} could not be put in place")
        self._save(manifest | {name: {"key": key, "folder": folder}})
        if name in manifest:
            self._fs.delete(self._at(manifest[name]["folder"]), True)
        self.made.append(name)
        return self.spark.read.parquet(f"{self.folder}/{folder}")

    def swept(self) -> int:
        """Deletes what no manifest names, as an interrupted build leaves it; how many things."""
        named = {x["folder"] for x in self.manifest().values()}
        lost = [s.getPath() for s in self._fs.listStatus(self._path(self.folder)) if not s.getPath().getName().startswith("manifest-") and s.getPath().getName() not in named]
        for path in lost:
            self._fs.delete(path, True)
        return len(lost)
