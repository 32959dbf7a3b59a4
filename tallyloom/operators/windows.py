"""First-row-per-key choices, deltas and serial numbers.

``row_number() = 1`` is the form Spark limits before the shuffle (WindowGroupLimit): each
task sends at most one row per key, so a hot key is no burden to its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import month_start, parse_mixed_date
from ..functions.labels import STAGE_SALE_DONE
from ..sources.storage import cut_lineage


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(window)).filter(F.col("rn") == 1).drop("rn")


def unique_dps_first(sales: DataFrame) -> DataFrame:
    """A partner is credited to the manager of its first sales row; missing ids count as one key."""
    return first_per_key(sales, ["dp_id"], [F.col("row_seq").asc_nulls_last()])


def dedup_keep_last(rows: DataFrame) -> DataFrame:
    """Same partner, date and premium is the same sale; the row delivered last stays."""
    order = [F.col("batch_seq").desc_nulls_last(), F.col("row_seq").desc_nulls_last()]
    return first_per_key(rows, ["dp_id", "sale_date", "net_premium"], order)


def keep_last_counted(known: DataFrame, new: DataFrame) -> DataFrame:
    """dedup_keep_last of both, with the rows each kept one stands for (``copies``), new ones among them (``fresh``).

    One aggregation: tasks reduce their copies of a sale before the shuffle, and the counts come
    with the result.
    """
    both = known.withColumn("fresh", F.lit(0)).unionByName(new.withColumn("fresh", F.lit(1)))
    keys = ["dp_id", "sale_date", "net_premium"]
    others = [c for c in known.columns if c not in (*keys, "batch_seq", "row_seq")]
    last = F.max(F.struct("batch_seq", "row_seq", *others)).alias("last")  # a null is the smallest
    kept = both.groupBy(*keys).agg(last, F.count(F.lit(1)).alias("copies"), F.sum("fresh").alias("fresh"))
    return kept.select(*[c if c in keys else F.col(f"last.{c}").alias(c) for c in known.columns], "copies", "fresh")


def latest_quote_stage(quotes: DataFrame) -> DataFrame:
    """One row per quote and day, the one with the highest stage (in text order)."""
    order = [F.col("stage").desc_nulls_last(), F.col("dp_id").asc_nulls_last()]
    return first_per_key(quotes, ["quote_id", "creation_day"], order)


def latest_dp_snapshot(dp_master: DataFrame, as_of: str | None = None) -> DataFrame:
    """Newest snapshot row with an agent per partner; with ``as_of`` later snapshots are not seen."""
    rows = dp_master.filter(F.col("agent_mapped").isNotNull())
    if as_of is not None:
        rows = rows.filter(F.col("sqldate") <= as_of)
    order = [
        F.col("sqldate").desc_nulls_last(),
        F.col("agent_mapped").asc_nulls_last(),
        F.col("dp_category").asc_nulls_last(),
    ]
    return first_per_key(rows.select("dp_id", "agent_mapped", "dp_category", "sqldate"), ["dp_id"], order)


def first_sale_done(quotes: DataFrame) -> DataFrame:
    """Earliest readable last-update date of a completed sale per partner."""
    done = quotes.filter(F.col("stage") == STAGE_SALE_DONE)
    dated = done.select("dp_id", parse_mixed_date(F.col("last_update_date")).alias("done_on"))
    return dated.filter(F.col("done_on").isNotNull()).groupBy("dp_id").agg(F.min("done_on").alias("first_sale_done"))


def supply_delta(totals: DataFrame) -> DataFrame:
    """Supply added since the previous snapshot of the month, and the period it was added in.

    The window holds the snapshots of one month: at most 31 rows.
    """
    month = W.partitionBy(month_start(F.col("snapshot_date"))).orderBy("snapshot_date")
    previous = F.lag("snapshot_date").over(month)
    return totals.select(
        "snapshot_date",
        F.coalesce(F.date_add(previous, 1), month_start(F.col("snapshot_date"))).alias("period_start"),
        (F.col("mtd") - F.lag("mtd", 1, 0).over(month)).alias("act_den"),
    )


def serial_no(rows: DataFrame, order: list[Column], name: str = "serial_no") -> DataFrame:
    """1..n in the given order, without a one-partition window.

    ``order`` must be total (no two rows equal), which also lets the range shuffle cut a
    day that holds a third of the rows. Rows are range partitioned and sorted; Spark's
    monotonically increasing id then gives partition and position of each row; adding the
    sizes of the partitions before it makes the serial number. The checkpoint fixes which
    row got which position, so that sizes and positions always belong together. The table
    of sizes has one row per partition.
    """
    position_bits = 33  # layout of monotonically_increasing_id
    placed = cut_lineage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("row_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("row_place", position_bits)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("part", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("offset")))
    position = F.col("row_place").bitwiseAND(F.lit((1 << position_bits) - 1))
    return (
        placed.withColumn("part", part)
        .join(offsets, "part")
        .withColumn(name, F.col("offset") + position + 1)
        .drop("part", "offset", "row_place")
    )
