"""A record of the steps of a run, so that a run that broke off goes on behind its last good step."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import BIGINT, INT, STRING, table
from ..sources.storage import VersionedTable

STEPS = table(run=STRING, attempt=INT, step=STRING, path=STRING, n_rows=BIGINT, checksum=T.DecimalType(38, 0))
_DONE = "done"


class Steps:
    """Steps of one run, named by ``run``. A run that ended is over: the same name begins a new attempt."""

    def __init__(self, spark: SparkSession, out: str, run: str):
        self.spark, self.run = spark, run
        self.record = VersionedTable(spark, f"{out}/steps", STEPS, grows=True)
        own = self.record.read().filter(F.col("run") == run)
        self.attempt = own.filter(F.col("step") == _DONE).count() + 1
        self.done = {r["step"]: r["path"] for r in own.filter(F.col("attempt") == self.attempt).collect()}

    @property
    def stream_id(self) -> str:
        """With the attempt as batch number, the name under which a run commits to accumulating tables."""
        return f"run {self.run}"

    def _note(self, step: str, path: str | None = None, n_rows: int | None = None, checksum=None) -> None:
        self.record.write(self.spark.createDataFrame([(self.run, self.attempt, step, path, n_rows, checksum)], STEPS))

    def table(self, step: str, path: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step: built and written, or read where this attempt has written it.

        The record gets its rows and a checksum that ignores their order, counted by the job that writes.
        """
        if step not in self.done:
            df = build()
            watch = Observation()
            mark = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
            df.observe(watch, F.count(F.lit(1)).alias("n_rows"), mark.alias("checksum")).write.mode("overwrite").parquet(path)
            self._note(step, path, watch.get["n_rows"], watch.get["checksum"])
            self.done[step] = path
        return self.spark.read.parquet(path)

    def once(self, step: str, act: Callable[[], object]) -> None:
        """A step that commits by itself and may be repeated."""
        if step not in self.done:
            act()
            self._note(step)

    def finish(self) -> None:
        self._note(_DONE)
