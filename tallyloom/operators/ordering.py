"""Order of the reports. Every order ends in a tie-breaker, so the result is one fixed list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_status(status: DataFrame) -> DataFrame:
    return status.orderBy("dpno", "login_id")


def order_trend(trend: DataFrame) -> DataFrame:
    return trend.orderBy("data_date")


def order_desc(df: DataFrame, date: str, *ties: str) -> DataFrame:
    """Newest first."""
    return df.orderBy(F.col(date).desc(), *ties)


def top_supply(supply: DataFrame, rows: int) -> DataFrame:
    """The agents with the largest supply."""
    largest = F.col("sum_inactive_dps_creating_quotes").desc()
    return supply.orderBy(largest, F.col("agent_mapped"), F.col("quote_month")).limit(rows)


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both tables, columns matched by name."""
    return first.unionByName(second, allowMissingColumns=True)
