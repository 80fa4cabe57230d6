"""What a run did, as a table: rows by observation, rows, bytes and seconds by job and stage of the engine."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = "step string, stage int, tasks int, seconds double, rows_in bigint, bytes_in bigint, rows_shuffled bigint, bytes_shuffled bigint, rows_out bigint, bytes_out bigint, bytes_spilled bigint"


class Timings:
    """A log of steps. step() groups the jobs that run inside it; log() reads their stages from the session's status store, a row each, and a row with a null stage for the step's wall time and the rows that it observed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.steps, self._rows = spark, [], {}

    @contextmanager
    def step(self, name: str):
        sc, group, began = self.spark.sparkContext, f"timings-{id(self)}-{len(self.steps)}", time.time()
        sc.setJobGroup(group, name)
        try:
            yield
        finally:
            self.steps.append((name, group, time.time() - began))
            sc._jsc.clearJobGroup()

    def observed(self, df: DataFrame, name: str) -> DataFrame:
        """df; the rows that pass here in the first run of it are the step's."""
        self._rows[name] = Observation(name)
        return df.observe(self._rows[name], F.count(F.lit(1)).alias("n"))

    def log(self) -> DataFrame:
        sc, rows = self.spark.sparkContext, []
        sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        store, tracker = sc._jsc.sc().statusStore(), sc.statusTracker()
        for name, group, seconds in self.steps:
            stages = sorted({s for job in tracker.getJobIdsForGroup(group) if (info := tracker.getJobInfo(job)) for s in info.stageIds})
            for s in stages:
                x = store.lastStageAttempt(s)
                if x.numCompleteTasks():
                    rows.append((
                        name, s, x.numCompleteTasks(), x.executorRunTime() / 1000, x.inputRecords() + x.shuffleReadRecords(), x.inputBytes() + x.shuffleReadBytes(), x.shuffleWriteRecords(), x.shuffleWriteBytes(),
                        x.outputRecords(), x.outputBytes(), x.diskBytesSpilled(),
                    ))
            seen = self._rows[name].get["n"] if name in self._rows else None
            rows.append((name, None, None, seconds, None, None, None, None, seen, None, None))
        return self.spark.createDataFrame(rows, LOG)
