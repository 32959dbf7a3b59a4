"""Which batch, which snapshot, which table: choices made on file and table metadata."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DATE_IN_NAME = r"_(\d{4}-\d{2}-\d{2})"


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Name and time of the files of a folder. Spark lists them; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("modificationTime").alias("arrived_at"),
    )


def usable_batches(files: DataFrame, extensions: Iterable[str], prefix: str = "") -> DataFrame:
    """Leave out lock files (``~$...``), other extensions and other prefixes."""
    name = F.col("file_name")
    right_extension = F.lit(False)
    for extension in extensions:
        right_extension = right_extension | name.endswith(extension)
    return files.filter(~name.startswith("~$") & right_extension & name.startswith(prefix))


def latest_batch(files: DataFrame, extensions: Iterable[str], prefix: str = "") -> DataFrame:
    """The one usable file that arrived last (by name where two arrived together)."""
    usable = usable_batches(files, extensions, prefix)
    return usable.orderBy(F.col("arrived_at").desc(), F.col("file_name").desc()).limit(1)


def snapshot_date_from_name(file_name) -> "F.Column":
    """``InactiveSupply_2024-05-31.csv`` -> 2024-05-31; null where the name has no date."""
    return F.try_to_date(F.nullif(F.regexp_extract(file_name, _DATE_IN_NAME, 1), F.lit("")), "yyyy-MM-dd")


def read_dated_csv(spark: SparkSession, path: str, schema, prefix: str = "") -> DataFrame:
    """A series of dated CSV files as one table with a ``snapshot_date`` column.

    The date is made from the file's name, so a filter on it is decided on the list of files, and
    files outside it are not opened. Files of other names (lock files too) do not take part.
    """
    reader = spark.read.schema(schema).option("header", True)
    name = F.col("_metadata.file_name")
    dated = reader.csv(path).filter(name.startswith(prefix) & ~name.startswith("~$"))
    return dated.select("*", snapshot_date_from_name(name).alias("snapshot_date"))


def read_newest_csv(spark: SparkSession, folder: str, schema, prefix: str = "") -> DataFrame:
    """The dated CSV file of a folder that arrived last; an empty table where there is none."""
    newest = latest_batch(list_files(spark, folder), [".csv"], prefix).first()
    if newest is None:
        return read_dated_csv(spark, folder, schema, prefix).limit(0)
    return read_dated_csv(spark, newest["path"], schema, prefix)


def write_dated_csv(df: DataFrame, folder: str, prefix: str) -> str:
    """A small result table with a ``snapshot_date`` as a file ``<prefix>_<date>.csv`` per date.

    Spark writes a file for each date; the files are then given their names. Dates that are there
    already are replaced.
    """
    spark = df.sparkSession
    parts = f"{folder}/_parts_{uuid.uuid4().hex}"  # not seen by readers of the folder
    writer = df.repartition("snapshot_date").write.partitionBy("snapshot_date").option("header", True)
    writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(parts)
    where = spark._jvm.org.apache.hadoop.fs.Path
    files = where(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for day in files.globStatus(where(f"{parts}/snapshot_date=*/part-*.csv")):
        name = f"{prefix}_{day.getPath().getParent().getName().removeprefix('snapshot_date=')}.csv"
        files.delete(where(f"{folder}/{name}"), False)
        files.rename(day.getPath(), where(f"{folder}/{name}"))
    files.delete(where(parts), True)
    return folder


def set_arrival(spark: SparkSession, path: str, day) -> None:
    """Give a file the time at which it arrived, as a copy from elsewhere keeps it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    moment = int(dt.datetime.combine(day, dt.time(), dt.timezone.utc).timestamp() * 1000)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(where, moment, -1)


def snapshot_or_latest(snapshots: DataFrame, data_date) -> DataFrame:
    """Rows of the data date's snapshot; if there is none, rows of the newest snapshot.

    The date is found first (from the partition column alone), so only the chosen
    partition is scanned.
    """
    day = F.lit(data_date).cast("date")
    exact = F.max(F.when(F.col("snapshot_date") == day, F.col("snapshot_date")))
    chosen = snapshots.agg(F.coalesce(exact, F.max("snapshot_date")).alias("snapshot_date"))
    return snapshots.filter(F.col("snapshot_date") == chosen.scalar())


def missing_snapshots(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required (table_name, snapshot_date) pairs without a snapshot."""
    keys = ["table_name", "snapshot_date"]
    return required.join(present.select(*keys).distinct(), keys, "left_anti")


class SnapshotMissing(LookupError):
    """A job was started before the snapshots it needs exist."""


def require_snapshots(snapshots: dict[str, DataFrame], data_date) -> None:
    """Raise SnapshotMissing naming every table without a snapshot of the data date."""
    day = F.lit(data_date).cast("date")
    missing = [name for name, df in snapshots.items() if df.filter(F.col("snapshot_date") == day).isEmpty()]
    if missing:
        raise SnapshotMissing(f"no snapshot of {data_date} for: {', '.join(missing)}")


def resolve_table(names: Iterable[str], include: str = "health", exclude: str = "unique") -> str:
    """The one table whose name contains ``include`` and not ``exclude``."""
    found = [n for n in names if include in n.strip().lower() and exclude not in n.strip().lower()]
    if len(found) != 1:
        raise LookupError(f"expected one table like {include!r}, found {found}")
    return found[0]
