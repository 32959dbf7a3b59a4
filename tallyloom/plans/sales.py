"""Sales batches: cleaning, enrichment and the collated master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import coerce_number
from ..functions.text import clean_name, normalize_id, strip_dp_prefix
from ..operators.aggregates import batch_quality
from ..operators.fuzzy import map_lookup, match_names
from ..operators.joins import enrich_status
from ..operators.ordering import union_by_name
from ..operators.windows import dedup_keep_last, keep_last_counted, serial_no, unique_dps_first
from ..sources.schemas import COLLATE_REQUIRED, MASTER, validate_columns
from ..sources.storage import Fold, MonthlyTable
from .directory import NameDirectory


def clean_sales(sales: DataFrame) -> DataFrame:
    """Sales with plain partner ids (prefix and ``.0`` removed once, here)."""
    return sales.withColumn("dp_id", normalize_id(strip_dp_prefix(F.col("dp_id"))))


def unique_sales(cleaned: DataFrame) -> DataFrame:
    """The first row of every partner."""
    return unique_dps_first(cleaned)


def enrich_sales(cleaned: DataFrame, status: DataFrame) -> DataFrame:
    """Every sales row with its partner's status."""
    return enrich_status(cleaned, status, clean_ids=True)


def enrich_unique(unique: DataFrame, status: DataFrame) -> DataFrame:
    """The first row of every partner with its status."""
    return enrich_status(unique, status, spread_by=None, clean_ids=True)


def daily_rows(
    daily: DataFrame, roster: DataFrame, overrides: DataFrame, batch_seq: int | Column, names: NameDirectory | None = None
) -> DataFrame:
    """A checked daily batch in the columns of the master, team included; ``names`` keeps what names were matched to."""
    checked = validate_columns(daily, COLLATE_REQUIRED)
    seq = batch_seq if isinstance(batch_seq, Column) else F.lit(batch_seq)
    rows = checked.select(
        seq.alias("batch_seq"),
        "row_seq",
        "sale_date",
        "bdm_name",
        normalize_id(F.col("dp_id")).alias("dp_id"),
        coerce_number(F.col("net_premium")).alias("net_premium"),
        "dp_status",
        clean_name(F.col("bdm_name")).alias("clean_name"),
    )
    match = match_names if names is None else names.match
    return map_lookup(rows, roster, overrides, spread_by="row_seq", match=match).drop("clean_name", "email")


def collate_master(
    master: DataFrame, daily: DataFrame, roster: DataFrame, overrides: DataFrame, *, batch_seq: int | Column
) -> DataFrame:
    """The master with a daily batch folded in; later deliveries of a sale replace earlier ones."""
    return dedup_keep_last(union_by_name(master, daily_rows(daily, roster, overrides, batch_seq)))


def master_order() -> list[Column]:
    """Newest first; total, since no two rows of a master have the same day, partner and premium."""
    return [
        F.col("sale_date").desc_nulls_last(),
        F.col("dp_id").asc_nulls_last(),
        F.col("net_premium").asc_nulls_last(),
    ]


def numbered_master(master: DataFrame) -> DataFrame:
    """The master as reported: newest first, with serial numbers."""
    return serial_no(master, master_order())


def master_table(spark: SparkSession, path: str) -> MonthlyTable:
    """The master in month folders, whose rows can be numbered without being moved."""
    return MonthlyTable(spark, path, MASTER, order=master_order())


def fold_sales(
    master: MonthlyTable,
    daily: DataFrame,
    roster: DataFrame,
    overrides: DataFrame,
    *,
    batch_seq: int | Column,
    names: NameDirectory | None = None,
    stream_id: str | None = None,
    batch_id: int | None = None,
) -> Fold:
    """collate_master for a kept master: only the months of the batch are read and written.

    The job that writes also counts what it took in, for collation_counts.
    """
    def merge(known: DataFrame, rows: DataFrame) -> DataFrame:
        return keep_last_counted(known, daily_rows(rows, roster, overrides, batch_seq, names))

    return master.fold(daily, merge, stream_id, batch_id, {"rows_batch": F.sum("fresh"), "rows_taken": F.sum("copies")})


def collation_counts(master: MonthlyTable) -> DataFrame:
    """What each fold took in and dropped: rows of the batch, of old master and batch together, duplicates, rows left.

    Read from the commits, one row for each fold; no sale is read.
    """
    versions = master.rows_by_version()
    before = F.coalesce(F.lag("n_rows").over(Window.orderBy("version")), F.lit(0))
    rows_in = before + F.col("measured")["rows_batch"]
    return versions.select(
        "version", "stream_id", "batch_id", F.col("measured")["rows_batch"].alias("rows_batch"),
        rows_in.alias("rows_in"), (rows_in - F.col("n_rows")).alias("duplicates"), F.col("n_rows").alias("rows_out"),
    )


def collation_quality(master: DataFrame, daily: DataFrame) -> DataFrame:
    """What a collation took in and dropped; needs neither roster nor team."""
    columns = ["dp_id", "sale_date", "net_premium"]
    rows = daily.select(
        normalize_id(F.col("dp_id")).alias("dp_id"), "sale_date", coerce_number(F.col("net_premium")).alias("net_premium")
    )
    return batch_quality(master.select(*columns).unionByName(rows))
