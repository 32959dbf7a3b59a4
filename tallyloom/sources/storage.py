"""The shared folder for checkpoints, and the readers and writers of result tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import BIGINT, STRING, table

NO_MONTH = "none"  # the month of rows without a date


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    path = f"{shared_folder(spark)}/tallyloom/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_MADE: dict[str, list[str]] = {}  # fresh paths of each application, in order


def made_paths(spark: SparkSession) -> list[str]:
    """The fresh paths this application has asked for and not removed."""
    return list(_MADE.get(spark.sparkContext.applicationId, []))


def remove_intermediates(spark: SparkSession, paths: Collection[str] | None = None) -> None:
    """Delete tables under fresh paths, all of this application or some of them, once nothing reads them any more."""
    own = _MADE.get(spark.sparkContext.applicationId, [])
    for path in own[:] if paths is None else paths:
        delete_folder(spark, path)
        own.remove(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are fixed from here on, whatever executor is lost."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result table kept as CSV with a header; the schema is given, never inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_csv(df: DataFrame, path: str) -> str:
    """A result table as CSV with a header; blanks around a text are kept."""
    writer = df.write.mode("overwrite").option("header", True)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def write_table(df: DataFrame, path: str) -> str:
    """Replace a table. A job that reads its own target must use VersionedTable instead."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_audit(enriched: DataFrame, raw_lookup: DataFrame, path: str) -> dict[str, str]:
    """The enriched table, and beside it the lookup it was made from."""
    return {
        "sales": write_table(enriched, f"{path}/sales"),
        "dp_status_data": write_table(raw_lookup, f"{path}/dp_status_data"),
    }


def write_breakdown(tables: dict[str, DataFrame], path: str, data_date: str, mode: str) -> dict[str, str]:
    """One directory per table, partitioned by data date and run mode.

    A re-run of one data date replaces the partition of that date and mode only, also by
    an empty one.
    """
    written = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}/data_date={data_date}/run_mode={mode}")
        written[name] = f"{path}/{name}"
    return written


def load_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The accumulated table, or an empty one with the same schema before the first run."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class VersionedTable:
    """An accumulating table as a row of complete Parquet versions.

    Every write makes a new folder and then commits it as the next version, so a reader never
    sees half a version and a job may read the table it replaces. A commit is a folder of its
    own that must not exist yet: of two writers of the same version one fails. Each commit names
    the stream and the batch it holds, if any. With ``grows`` a version adds its rows to those of
    the versions before it.
    """

    _COMMIT = table(folder=STRING, stream_id=STRING, batch_id=BIGINT)

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, grows: bool = False):
        self.spark, self.path, self.schema, self.grows = spark, path, schema, grows

    def _commits(self) -> DataFrame:
        fields = [*self._COMMIT.fields, T.StructField("version", T.LongType())]
        return load_or_empty(self.spark, f"{self.path}/commits", T.StructType(fields))

    def latest(self) -> int:
        return self._commits().agg(F.max("version")).first()[0] or 0

    def has_batch(self, stream_id: str, batch_id: int) -> bool:
        return not self._commits().filter((F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)).isEmpty()

    def read(self) -> DataFrame:
        newest_first = self._commits().orderBy(F.desc("version"))
        folders = [r["folder"] for r in (newest_first if self.grows else newest_first.limit(1)).select("folder").collect()]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{folder}" for folder in folders])

    def write(self, df: DataFrame, stream_id: str | None = None, batch_id: int | None = None) -> int:
        version, folder = self.latest() + 1, uuid.uuid4().hex
        df.select(*self.schema.names).write.parquet(f"{self.path}/data/{folder}")
        commit = self.spark.range(1, numPartitions=1).select(
            F.lit(folder).alias("folder"),
            F.lit(stream_id).cast("string").alias("stream_id"),
            F.lit(batch_id).cast("bigint").alias("batch_id"),
        )
        commit.write.mode("errorifexists").parquet(f"{self.path}/commits/version={version}")
        return version


@dataclass(frozen=True)
class Fold:
    """What a fold did: its version, the months it rewrote, and what it measured."""

    version: int
    months: frozenset[str]
    measured: dict[str, int]


class MonthlyTable:
    """An accumulating table in one folder per month of a date; a fold rewrites the months it touches.

    Each version is an index of month folders, committed as a folder that must not exist yet.
    Folders of months that a fold does not touch are named again by the next version, not copied,
    so the work of a daily batch does not grow with the table. A commit also holds the stream
    and batch it came from, the last number given to a delivery, and what the fold measured.

    Rows are stored in ``order`` (sort columns, total within a month; none where no order is
    needed) with their place in it. The index has a row for each month and partition that wrote
    it, with the rows it holds; so the number of a row in the whole table is a sum over the index
    plus its place, and a fold gives new places to the months it touches only.
    """

    _COMMIT = table(
        month=STRING, folder=STRING, part=BIGINT, first_place=BIGINT, n_rows=BIGINT,
        stream_id=STRING, batch_id=BIGINT, last_seq=BIGINT, measured=T.MapType(STRING, BIGINT),
    )
    _PLACE_BITS = 33  # layout of monotonically_increasing_id

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, date: str = "sale_date", order: Sequence[Column] = ()
    ):
        self.spark, self.path, self.schema, self.order = spark, path, schema, list(order)
        self.stored = T.StructType([*schema.fields, T.StructField("row_place", T.LongType())])
        self.month = F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_MONTH))

    def _commits(self) -> DataFrame:
        fields = [*self._COMMIT.fields, T.StructField("version", T.LongType())]
        return load_or_empty(self.spark, f"{self.path}/commits", T.StructType(fields))

    def latest(self) -> int:
        return self._commits().agg(F.max("version")).first()[0] or 0

    def last_seq(self) -> int:
        return self._commits().agg(F.max("last_seq")).first()[0] or 0

    has_batch = VersionedTable.has_batch

    def _index(self, version: int | None = None) -> DataFrame:
        """Segments of a version, the newest unless given: month, folder, part, first_place, n_rows."""
        newest = self.latest() if version is None else version
        rows = self._commits().filter((F.col("version") == newest) & F.col("month").isNotNull())
        return rows.select("month", "folder", "part", "first_place", "n_rows")

    def folders(self, version: int | None = None) -> dict[str, str]:
        """Folder of every month of a version."""
        return {r["month"]: r["folder"] for r in self._index(version).select("month", "folder").distinct().collect()}

    def _read(self, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        paths = [f"{self.path}/data/{folder}/month={month}" for month, folder in folders.items()]
        return self.spark.read.schema(self.stored).parquet(*paths)

    def read(self, months: Collection[str] | None = None) -> DataFrame:
        """The newest version, or only some months (``yyyy-MM``) of it."""
        folders = self.folders()
        chosen = {m: f for m, f in folders.items() if months is None or m in months}
        return self._read(chosen).select(*self.schema.names)

    def numbered(self, name: str = "serial_no", newest_first: bool = True) -> DataFrame:
        """The newest version with 1..n by month and the order inside it; rows without a date come last.

        Only the index, a row for each month and writing partition, is sorted: no row moves.
        """
        month = F.col("month").desc() if newest_first else F.col("month").asc()
        before = Window.orderBy(F.col("month") == NO_MONTH, month, "part").rowsBetween(Window.unboundedPreceding, -1)
        index = self._index().select("month", "part", (F.coalesce(F.sum("n_rows").over(before), F.lit(0)) - F.col("first_place")).alias("offset"))
        rows = self._read(self.folders())
        placed = rows.withColumn("month", self.month).withColumn("part", F.shiftright("row_place", self._PLACE_BITS))
        numbered = placed.join(index, ["month", "part"]).withColumn(name, F.col("offset") + F.col("row_place") + 1)
        return numbered.select(*self.schema.names, name)

    def rows_by_version(self) -> DataFrame:
        """version, stream_id, batch_id, measured and n_rows (of the whole table) of every commit."""
        keys = ["version", "stream_id", "batch_id"]
        return self._commits().groupBy(*keys).agg(F.any_value("measured").alias("measured"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))

    def fold(
        self,
        batch: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        stream_id: str | None = None,
        batch_id: int | None = None,
        measures: dict[str, Column] | None = None,
    ) -> Fold:
        """Commit ``merge(rows of the months that the batch touches, batch)`` for those months.

        ``merge`` must leave every month of the batch some row, and touch no other month.
        ``measures`` are aggregates over what it gives, whole numbers, taken by the job that
        writes. They stand behind the last shuffle, where each row counts once even if tasks
        run again.
        """
        folder, newest = uuid.uuid4().hex, self.latest()
        index = self._index(newest)
        head = self._commits().filter(F.col("version") == newest).select("month", "folder", "last_seq").distinct().collect()
        touched = {r["month"] for r in batch.select(self.month.alias("month")).distinct().collect()}  # a calendar
        known = self._read({r["month"]: r["folder"] for r in head if r["month"] in touched}).select(*self.schema.names)
        merged = merge(known, batch).withColumn("month", self.month)
        keys = [F.col("month").asc(), *self.order]
        ordered = merged.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("row_place", F.monotonically_increasing_id())
        last = F.max("batch_seq") if "batch_seq" in self.schema.names else F.lit(None)
        asked = {"written": F.count(F.lit(1)), "last_seq": last, **(measures or {})}
        watch = Observation()
        watched = ordered.observe(watch, *[c.cast("bigint").alias(n) for n, c in asked.items()])
        path = f"{self.path}/data/{folder}"
        watched.select(*self.stored.names, "month").write.partitionBy("month").parquet(path)
        found = watch.get
        measured = {n: int(found[n] or 0) for n in measures or {}}
        constants = {
            "stream_id": F.lit(stream_id).cast("string"),
            "batch_id": F.lit(batch_id).cast("bigint"),
            "last_seq": F.lit(max([found["last_seq"] or 0, *(r["last_seq"] or 0 for r in head)])).cast("bigint"),
            "measured": F.create_map(*[F.lit(x) for pair in measured.items() for x in pair]).cast(self._COMMIT["measured"].dataType),
        }
        if found["written"]:
            index = index.filter(~F.col("month").isin(*touched)).unionByName(self._segments(path, folder))
        elif not any(r["month"] for r in head):  # an empty batch into an empty table is committed as well
            index = self.spark.createDataFrame([(None,) * 5], index.schema)
        commit = index.coalesce(1).withColumns(constants).select(*self._COMMIT.names)
        commit.write.mode("errorifexists").parquet(f"{self.path}/commits/version={newest + 1}")
        return Fold(newest + 1, frozenset(touched), measured)

    def _segments(self, path: str, folder: str) -> DataFrame:
        """The index of a folder just written: two columns of it are read."""
        schema = T.StructType([T.StructField("row_place", T.LongType()), T.StructField("month", T.StringType())])
        part = F.shiftright("row_place", self._PLACE_BITS).alias("part")
        rows = self.spark.read.schema(schema).option("basePath", path).parquet(path)
        sizes = rows.groupBy("month", part).agg(F.min("row_place").alias("first_place"), F.count(F.lit(1)).alias("n_rows"))
        return sizes.select("month", F.lit(folder).alias("folder"), "part", "first_place", "n_rows")

    def remove_old(self, keep_last: int = 2) -> list[str]:
        """Delete data that none of the last versions names; the commits stay. Returns the folders deleted.

        Call it when no job reads or writes the table.
        """
        newest = self.latest()
        kept = {f for v in range(max(1, newest - keep_last + 1), newest + 1) for f in self.folders(v).values()}
        named = {r["folder"] for r in self._commits().filter("folder is not null").select("folder").distinct().collect()}
        return [f for f in sorted(named - kept) if delete_folder(self.spark, f"{self.path}/data/{f}")]


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store its path names; False if there is none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
