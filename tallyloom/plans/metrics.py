"""Conversion rates per e-mail, per team and overall, and the trend."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, month_end, month_name
from ..functions.text import clean_name
from ..operators import aggregates, joins
from ..operators.fuzzy import match_names
from ..operators.ordering import order_trend, union_by_name
from ..sources.schemas import TREND
from .directory import NameDirectory


def email_counts(
    unique_dps: DataFrame, roster: DataFrame, overrides: DataFrame, names: NameDirectory | None = None
) -> DataFrame:
    """Numerators per e-mail.

    Partners are counted per clean name before the names are matched, so the matcher sees
    one row per name however many partners a manager has. ``names`` keeps what names were matched to.
    """
    named = unique_dps.select(clean_name(F.col("bdm_name")).alias("clean_name"), "dp_status")
    by_name = aggregates.status_counts(named, "clean_name")
    match = match_names if names is None else names.match
    return aggregates.email_numerators(match(by_name, roster, overrides))


def email_level(
    unique_dps: DataFrame,
    supply: DataFrame,
    pool: DataFrame,
    roster: DataFrame,
    overrides: DataFrame,
    names: NameDirectory | None = None,
) -> DataFrame:
    """Numerators and denominators of everyone who has either, with team and rates."""
    merged = joins.outer_num_den(
        email_counts(unique_dps, roster, overrides, names),
        aggregates.supply_by_agent(supply),
        aggregates.pool_by_agent(pool),
    )
    full = merged.withColumn("con_den", F.col("act_den") + F.col("fav_den"))
    return aggregates.with_rates(joins.with_team(full, roster))


def team_level(by_email: DataFrame) -> DataFrame:
    return aggregates.team_rollup(by_email)


def trend_row(
    unique_dps: DataFrame,
    sales: DataFrame,
    supply: DataFrame,
    pool: DataFrame,
    *,
    data_date: str,
    mode: str,
    run_timestamp: dt.datetime | None = None,
) -> DataFrame:
    """The overall result of a data date as one row of the trend."""
    overall = aggregates.overall_row(unique_dps, supply, pool)
    stats = aggregates.premium_stats(sales).select(
        "avg_premium_inactive", "avg_premium_fav", "nop_per_dp_inactive", "nop_per_dp_fav"
    )
    stacked = union_by_name(overall, stats)
    row = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    stamp = F.current_timestamp() if run_timestamp is None else F.lit(run_timestamp)
    return row.select(
        as_date(data_date).alias("data_date"),
        F.col("act_num").alias("act_numerator"),
        F.col("act_den").alias("act_denominator"),
        "activation_rate",
        F.col("fav_num").alias("fav_numerator"),
        F.col("fav_den").alias("fav_denominator"),
        "favourite_rate",
        F.col("con_num").alias("con_numerator"),
        F.col("con_den").alias("con_denominator"),
        "consolidated_rate",
        "avg_premium_inactive",
        "avg_premium_fav",
        "nop_per_dp_inactive",
        "nop_per_dp_fav",
        F.lit(mode).alias("run_mode"),
        stamp.alias("run_timestamp"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in TREND.fields])


def trend_upsert(trend: DataFrame, row: DataFrame, *, data_date: str) -> DataFrame:
    """The trend with the row of a data date put in or replaced."""
    others = trend.filter(~F.col("data_date").eqNullSafe(as_date(data_date)))
    return order_trend(union_by_name(others, row))


def month_gap(trend: DataFrame, *, today: str) -> DataFrame:
    """The month whose end the trend never reached although it is over; no row if none."""
    last = trend.agg(F.max("data_date").alias("last_date"))
    end = month_end(F.col("last_date"))
    return last.filter((F.col("last_date") < end) & (as_date(today) > end)).select(
        "last_date", month_name(F.col("last_date")).alias("missing_month")
    )
