"""Collation of daily batches as they arrive.

A folder of daily batches is read as a file stream, and every micro-batch is folded into
the master exactly once: a commit names the stream and the number of its batch, and a batch
delivered again after a failure is recognised by them. Each file is a delivery; the file
written later wins, whichever trigger it falls into. No watermark is used, since a sale may
be re-delivered at any later time and is compared with all sales of its month.

A micro-batch may feed the trend as well. Master and trend are committed one after the other, each
commit naming the batch, so a failure between them is made good when the batch is delivered again:
what is committed is left alone, what is missing is done.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.aggregates import max_date
from ..plans.directory import NameDirectory
from ..plans.metrics import trend_row, trend_upsert
from ..plans.sales import clean_sales, fold_sales, unique_sales
from ..sources.batches import snapshot_or_latest
from ..sources.schemas import SALES_ENRICHED
from ..sources.storage import MonthlyTable, VersionedTable, cut_lineage, fresh_path, read_parquet, remove_intermediates, write_table

_DELIVERY = ["delivered_at", "delivery"]


def read_batches(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Enriched daily sales, one Parquet file or more per trigger, with the file they came in."""
    reader = spark.readStream.schema(SALES_ENRICHED).option("maxFilesPerTrigger", files_per_batch)
    file = [F.col("_metadata.file_modification_time").alias("delivered_at"), F.col("_metadata.file_path").alias("delivery")]
    return reader.parquet(folder).select("*", *file)


def in_delivery_order(batch: DataFrame, base: int) -> DataFrame:
    """Rows with ``batch_seq``: above ``base``, rising with the time (and name) of the file they came in."""
    if not set(_DELIVERY) <= set(batch.columns):
        return batch.withColumn("batch_seq", F.lit(base + 1))
    rank = F.row_number().over(W.orderBy(*_DELIVERY))  # one row per file of a trigger
    order = batch.select(*_DELIVERY).distinct().select(*_DELIVERY, (rank + base).alias("batch_seq"))
    return batch.join(F.broadcast(order), _DELIVERY).drop(*_DELIVERY)


def spread_out(batch: DataFrame) -> tuple[DataFrame, str]:
    """The batch stored once in parts of like size, and where.

    A delivered file may be a single row group. One task reads that, whatever the cluster, and would sort
    and reduce all of it as well each time the batch is used. Here it only deals the rows out.
    """
    path = write_table(batch.repartition(*batch.columns), fresh_path(batch.sparkSession, "micro_batch"))
    return read_parquet(batch.sparkSession, path, batch.schema), path


def fold_batch(
    master: MonthlyTable,
    batch: DataFrame,
    batch_id: int,
    roster: DataFrame,
    overrides: DataFrame,
    stream_id: str,
    names: NameDirectory | None = None,
) -> bool:
    """Fold one batch into the master unless that has been done; True if it was done now."""
    if master.has_batch(stream_id, batch_id):
        return False
    rows = in_delivery_order(batch, master.last_seq())
    fold_sales(master, rows, roster, overrides, batch_seq=F.col("batch_seq"), names=names, stream_id=stream_id, batch_id=batch_id)
    return True


@dataclass(frozen=True)
class TrendFeed:
    """The trend that micro-batches add to, and the snapshots their denominators come from."""

    trend: VersionedTable
    supply: DataFrame
    pool: DataFrame
    mode: str = "REGULAR"

    def add(self, batch: DataFrame, batch_id: int, stream_id: str) -> bool:
        """Put in the row of the batch's newest day unless that has been done; True if it was done now."""
        if self.trend.has_batch(stream_id, batch_id):
            return False
        newest = max_date(batch).first()["data_date"]
        if newest is None:
            return False
        day = newest.isoformat()
        rows = clean_sales(batch)
        supply, pool = (snapshot_or_latest(df, day) for df in (self.supply, self.pool))
        row = cut_lineage(trend_row(unique_sales(rows), rows, supply, pool, data_date=day, mode=self.mode))
        self.trend.write(trend_upsert(self.trend.read(), row, data_date=day), stream_id, batch_id)
        return True


def collate_stream(
    batches: DataFrame,
    master: MonthlyTable,
    roster: DataFrame,
    overrides: DataFrame,
    checkpoint: str,
    stream_id: str | None = None,
    feed: TrendFeed | None = None,
    names: NameDirectory | None = None,
) -> StreamingQuery:
    """Fold all batches that are there now, then stop; start again for later ones.

    Batch numbers start at 0 in every checkpoint folder, so they count within a stream only.
    The stream is named by its checkpoint folder unless ``stream_id`` names it; give a new name
    if a folder is emptied and used again. With ``feed`` every micro-batch also adds to the trend.
    """
    stream = stream_id or checkpoint

    def fold(batch: DataFrame, batch_id: int) -> None:
        if master.has_batch(stream, batch_id) and (feed is None or feed.trend.has_batch(stream, batch_id)):
            return
        rows, path = spread_out(batch)
        try:
            fold_batch(master, rows, batch_id, roster, overrides, stream, names)
            if feed is not None:
                feed.add(rows, batch_id, stream)
        finally:
            remove_intermediates(batch.sparkSession, [path])

    return (
        batches.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
