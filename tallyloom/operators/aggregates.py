"""Aggregations. Each has a map-side partial step, so a hot key reaches its reducer as one
row per task. Distinct counts first reduce to one row per (group, partner)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify, labels
from ..functions.numbers import coerce_number_or_zero, safe_rate


def first_sale(policy: DataFrame) -> DataFrame:
    return policy.groupBy("login_id").agg(F.min("created_at").alias("first_sale_date"))


def policy_totals(policy: DataFrame, keys: list[str]) -> DataFrame:
    """Policies and premium per key."""
    return policy.groupBy(*keys).agg(
        F.count_distinct("policy_id").alias("policy_count"), F.sum("net_premium").alias("total_netpremium")
    )


def login_totals(policy: DataFrame, since, keys: Sequence[str] = ("login_id",)) -> DataFrame:
    """Per login (and what goes with it) in one pass: first sale of all time, and what was sold from ``since`` on.

    Logins without a policy since then drop out, as they have no row in the report.
    """
    recent = F.col("created_at") >= since
    return (
        policy.groupBy(*keys)
        .agg(
            F.min("created_at").alias("first_sale_date"),
            F.count_if(recent).alias("n_recent"),
            F.count_distinct(F.when(recent, F.col("policy_id"))).alias("policy_count"),
            F.sum(F.when(recent, F.col("net_premium"))).alias("total_netpremium"),
        )
        .filter(F.col("n_recent") > 0)
        .drop("n_recent")
    )


def favourite_count(dp_master: DataFrame) -> DataFrame:
    """Favourite partners per agent (rows, not distinct partners)."""
    return dp_master.groupBy("agent_mapped").agg(F.count("dp_id").alias("dp_count"))


def quotes_per_dp_month(quotes: DataFrame) -> DataFrame:
    return quotes.groupBy("dp_id", "quote_month").agg(F.count(F.lit(1)).alias("quotes_count"))


def distinct_dps_by_agent(dp_quotes: DataFrame) -> DataFrame:
    """Inactive partners with quotes, per agent and month."""
    return (
        dp_quotes.filter(F.col("agent_mapped").isNotNull() & (F.col("category_type") == labels.CATEGORY_INACTIVE))
        .groupBy("agent_mapped", "quote_month")
        .agg(F.count_distinct("dp_id").alias("inactive_dps_creating_quotes"))
    )


def supply_resum(by_agent: DataFrame) -> DataFrame:
    return by_agent.groupBy("quote_month", "agent_mapped").agg(
        F.sum("inactive_dps_creating_quotes").alias("sum_inactive_dps_creating_quotes")
    )


def status_counts(rows: DataFrame, key: str, status: str = "dp_status") -> DataFrame:
    """Numerators per key: inactive, favourite and all rows with a status."""
    column = F.col(status)
    return rows.groupBy(key).agg(
        F.count_if(column == labels.STATUS_INACTIVE).alias("act_num"),
        F.count_if(column.isin(*labels.FAVOURITE_STATUSES)).alias("fav_num"),
        F.count(column).alias("con_num"),
    )


def email_numerators(by_name: DataFrame) -> DataFrame:
    """Numerators per e-mail from numerators per name."""
    return by_name.groupBy("email").agg(*[F.sum(c).alias(c) for c in ("act_num", "fav_num", "con_num")])


def supply_by_agent(supply: DataFrame) -> DataFrame:
    return (
        supply.filter(F.col("agent_mapped").isNotNull())
        .groupBy("agent_mapped")
        .agg(F.sum("sum_inactive_dps_creating_quotes").alias("act_den"))
    )


def pool_by_agent(pool: DataFrame) -> DataFrame:
    return pool.filter(F.col("agent_mapped").isNotNull()).groupBy("agent_mapped").agg(F.sum("dp_count").alias("fav_den"))


def with_rates(df: DataFrame, rate=safe_rate) -> DataFrame:
    """The three rates beside the numerators and denominators."""
    return df.select(
        "*",
        rate(F.col("act_num"), F.col("act_den")).alias("activation_rate"),
        rate(F.col("fav_num"), F.col("fav_den")).alias("favourite_rate"),
        rate(F.col("con_num"), F.col("con_den")).alias("consolidated_rate"),
    )


def team_rollup(by_email: DataFrame) -> DataFrame:
    names = ("act_num", "fav_num", "con_num", "act_den", "fav_den", "con_den")
    return with_rates(by_email.groupBy("team").agg(*[F.sum(c).alias(c) for c in names]))


def overall_row(unique_dps: DataFrame, supply: DataFrame, pool: DataFrame) -> DataFrame:
    """Overall numerators and denominators as one row.

    The denominators are those of the whole tables, agents without a name included. The
    three one-row results are stacked and summed up, which needs no cross join.
    """
    status = F.col("dp_status")
    numerators = unique_dps.agg(
        F.count_if(status == labels.STATUS_INACTIVE).alias("act_num"),
        F.count_if(status.isin(*labels.FAVOURITE_STATUSES)).alias("fav_num"),
        F.count(status).alias("con_num"),
    )
    act = supply.agg(F.sum("sum_inactive_dps_creating_quotes").alias("act_den"))
    fav = pool.agg(F.sum("dp_count").alias("fav_den"))
    stacked = numerators.unionByName(act, allowMissingColumns=True).unionByName(fav, allowMissingColumns=True)
    names = ("act_num", "fav_num", "con_num", "act_den", "fav_den")
    row = stacked.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    return with_rates(row.withColumn("con_den", F.col("act_den") + F.col("fav_den")))


def premium_stats(sales: DataFrame) -> DataFrame:
    """Premium and policies of inactive and favourite partners as one row.

    Sales are first reduced to one row per partner, so both distinct counts are plain
    counts afterwards.
    """
    status = F.col("dp_status")
    premium = coerce_number_or_zero(F.col("net_premium"))
    inactive, favourite = classify.is_inactive(status), classify.is_favourite(status)
    per_dp = sales.groupBy("dp_id").agg(
        F.sum(F.when(inactive, premium)).alias("inactive_premium"),
        F.count_if(inactive).alias("inactive_nop"),
        F.sum(F.when(favourite, premium)).alias("fav_premium"),
        F.count_if(favourite).alias("fav_nop"),
    )
    known = F.col("dp_id").isNotNull()
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("inactive_premium", "inactive_nop", "fav_premium", "fav_nop")]
    row = per_dp.agg(
        *sums,
        F.count_if(known & (F.col("inactive_nop") > 0)).alias("inactive_dps"),
        F.count_if(known & (F.col("fav_nop") > 0)).alias("fav_dps"),
    )
    return row.select(
        "*",
        safe_rate(F.col("inactive_premium"), F.col("inactive_nop")).alias("avg_premium_inactive"),
        safe_rate(F.col("fav_premium"), F.col("fav_nop")).alias("avg_premium_fav"),
        safe_rate(F.col("inactive_nop"), F.col("inactive_dps")).alias("nop_per_dp_inactive"),
        safe_rate(F.col("fav_nop"), F.col("fav_dps")).alias("nop_per_dp_fav"),
    )


def max_date(sales: DataFrame) -> DataFrame:
    """The data date of a batch."""
    return sales.agg(F.max("sale_date").alias("data_date"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_dps(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct partners per key: inactive, favourite, all.

    Two steps: one row per (key, partner) with flags, then sums of flags. The first shuffle
    is spread over partners, the second carries one row per key and task. A key whose rows
    all lack a partner keeps its row, with zeros.
    """
    status, known = F.col("dp_status"), F.col("dp_id").isNotNull()
    per_dp = sales.groupBy(*keys, "dp_id").agg(
        F.max(classify.is_inactive(status)).alias("inactive"), F.max(classify.is_favourite(status)).alias("favourite")
    )
    return per_dp.groupBy(*keys).agg(
        F.count_if(known & F.col("inactive")).alias("act_num"),
        F.count_if(known & F.col("favourite")).alias("fav_num"),
        F.count("dp_id").alias("con_num"),
    )


def snapshot_totals(supply: DataFrame) -> DataFrame:
    """Month-to-date supply of each snapshot over all agents."""
    return supply.groupBy("snapshot_date").agg(F.sum("sum_inactive_dps_creating_quotes").alias("mtd"))


def batch_quality(rows: DataFrame) -> DataFrame:
    """Rows in, duplicates, rows out and distinct partners of a collation, as one row."""
    per_key = rows.groupBy("dp_id", "sale_date", "net_premium").agg(F.count(F.lit(1)).alias("copies"))
    per_dp = per_key.groupBy("dp_id").agg(F.sum("copies").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"))
    total = per_dp.agg(
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("rows_out"), F.lit(0)).alias("rows_out"),
        F.count("dp_id").alias("distinct_dps"),
    )
    return total.select("rows_in", (F.col("rows_in") - F.col("rows_out")).alias("duplicates"), "rows_out", "distinct_dps")
