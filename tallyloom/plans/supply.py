"""Denominators: favourite pool and inactive supply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, labels
from ..functions.dates import as_date, iso_text, month_start, month_to_date, parse_mixed_date, prev_month_end
from ..operators import aggregates, joins, windows


def favourite_rows(dp_master: DataFrame, *, data_date: str) -> DataFrame:
    """Favourite partners in the snapshot of the last day of the month before the data date.

    ``sqldate`` is compared with a constant, so only that partition is read. A missing
    disposition is not kept: NOT IN is unknown for it.
    """
    snapshot = iso_text(prev_month_end(as_date(data_date)))
    return dp_master.filter(
        (F.col("sqldate") == snapshot)
        & (F.col("dp_category") == labels.CATEGORY_FAVOURITE)
        & ~F.col("last_call_disposition").isin(labels.DISPOSITION_REMAP)
    )


def fav_pool(dp_master: DataFrame, roster: DataFrame, *, data_date: str) -> DataFrame:
    """Favourite partners per agent and team. Counted first, so the roster meets one row per agent."""
    counted = aggregates.favourite_count(favourite_rows(dp_master, data_date=data_date))
    return joins.with_team(counted, roster, "agent_mapped").select("agent_mapped", "team", "dp_count")


def month_quotes(quotes: DataFrame, *, data_date: str) -> DataFrame:
    """Quotes created from the first of the data date's month up to the data date.

    Blank and unreadable dates are null and thus not in the month. The filter is a set of at
    most 31 days: it reads the text once per row, where BETWEEN, pushed below the projection,
    would parse it once per bound.
    """
    dated = quotes.select(
        "quote_id", "dp_id", "stage", parse_mixed_date(F.col("creation_date")).alias("creation_day")
    )
    return dated.filter(F.col("creation_day").isin(month_to_date(data_date)))


def agent_quotes(
    quotes: DataFrame, dp_master: DataFrame, *, data_date: str, as_of: str | None = None
) -> DataFrame:
    """Partners that created quotes in the month, with agent and category.

    Snapshots and completed sales are restricted to these partners before they are reduced: their
    history is the large part.
    """
    latest = windows.latest_quote_stage(month_quotes(quotes, data_date=data_date))
    per_dp = aggregates.quotes_per_dp_month(latest.withColumn("quote_month", month_start(F.col("creation_day"))))
    own = latest.select("dp_id")
    joined = joins.join_dp_details(
        per_dp,
        windows.latest_dp_snapshot(dp_master.join(own, "dp_id", "left_semi"), as_of),
        windows.first_sale_done(quotes.filter(F.col("stage") == labels.STAGE_SALE_DONE).join(own, "dp_id", "left_semi")),
    )
    category = classify.classify_category(F.col("dp_category"), F.col("first_sale_done"), F.col("quote_month"))
    return joined.select("dp_id", "agent_mapped", "quote_month", "quotes_count", category.alias("category_type"))


def inactive_supply(
    quotes: DataFrame,
    dp_master: DataFrame,
    *,
    data_date: str,
    as_of: str | None = None,
    drop_markers: bool = True,
) -> DataFrame:
    """Inactive partners creating quotes this month, per agent.

    ``as_of`` keeps a late run from seeing partner snapshots newer than its data date;
    ``drop_markers`` leaves out agents that are spreadsheet errors.
    """
    rows = agent_quotes(quotes, dp_master, data_date=data_date, as_of=as_of)
    if drop_markers:
        rows = rows.filter(~F.col("agent_mapped").isin(*labels.ERROR_MARKERS))
    return aggregates.supply_resum(aggregates.distinct_dps_by_agent(rows))
