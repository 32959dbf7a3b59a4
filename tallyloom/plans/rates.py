"""Rates per period between snapshots and per week, from the collated master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_shift, month_start, week_start
from ..operators import aggregates, joins, windows
from .presence import Presence


def _with_pool_and_rates(df: DataFrame, pool: DataFrame, month_of: str) -> DataFrame:
    pools = joins.month_pool(pool)
    joined = df.withColumn("month_first", month_start(F.col(month_of))).join(pools, "month_first", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("act_num", "fav_num", "con_num", "act_den", "fav_den")]
    kept = [c for c in df.columns if c not in ("act_num", "fav_num", "con_num", "act_den")]
    whole = joined.select(*kept, *counts)
    return aggregates.with_rates(whole.withColumn("con_den", F.col("act_den") + F.col("fav_den")))


def period_sales(master: DataFrame, supply: DataFrame) -> DataFrame:
    """Distinct partners who sold, per period between two snapshots."""
    periods = windows.supply_delta(aggregates.snapshot_totals(supply))
    rows = master.select("sale_date", "dp_id", "dp_status")
    return aggregates.distinct_dps(joins.range_join_period(rows, periods), ["snapshot_date"])


def period_rates_of(counts: DataFrame, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """One row per supply snapshot, from the distinct partners of the period up to it."""
    periods = windows.supply_delta(aggregates.snapshot_totals(supply))
    counted = periods.join(counts, "snapshot_date", "left")
    return _with_pool_and_rates(counted, pool, "snapshot_date").orderBy(F.col("snapshot_date").desc())


def period_rates(master: DataFrame, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """One row per supply snapshot: what the period up to it added."""
    return period_rates_of(period_sales(master, supply), supply, pool)


def kept_period_rates(presence: Presence, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """period_rates from the kept day bitmaps: no sale is read."""
    periods = windows.supply_delta(aggregates.snapshot_totals(supply))
    return period_rates_of(presence.periods(periods), supply, pool)


def week_sales(master: DataFrame) -> DataFrame:
    """Distinct partners who sold, per week that starts on Monday; every week with a sale has a row."""
    rows = master.filter(F.col("sale_date").isNotNull()).select(
        week_start(F.col("sale_date")).alias("week_start"), "dp_id", "dp_status"
    )
    return aggregates.distinct_dps(rows, ["week_start"])


def weekly_supply(weeks: DataFrame, supply: DataFrame) -> DataFrame:
    """Weeks with their supply: month-to-date at the end less month-to-date on the day before.

    The two values may belong to different months, and the difference may be negative.
    Each week asks for both days at once, and its other columns travel along, so neither
    the weeks nor the supply are computed twice.
    """
    start = F.col("week_start")
    at_end = F.struct(date_shift(start, 6).alias("day"), F.lit(1).alias("sign"))
    before = F.struct(date_shift(start, -1).alias("day"), F.lit(-1).alias("sign"))
    asked = weeks.select("*", F.inline(F.array(at_end, before)))
    known = joins.asof_supply(asked, aggregates.snapshot_totals(supply), "day", "mtd")
    return known.groupBy(*weeks.columns).agg(F.sum(F.col("sign") * F.col("mtd")).alias("act_den"))


def weekly_rates_of(weeks: DataFrame, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """One row per week with sales, from its distinct partners; weeks with neither supply nor an inactive seller drop out."""
    counted = weekly_supply(weeks, supply)
    kept = counted.filter((F.col("act_den") != 0) | (F.col("act_num") != 0))
    return _with_pool_and_rates(kept, pool, "week_start").orderBy(F.col("week_start").desc())


def weekly_rates(master: DataFrame, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """One row per week with sales; weeks with neither supply nor an inactive seller drop out."""
    return weekly_rates_of(week_sales(master), supply, pool)


def kept_weekly_rates(presence: Presence, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """weekly_rates from the kept day bitmaps: no sale is read."""
    return weekly_rates_of(presence.weeks(), supply, pool)
