"""Joins between sales, partners, policies, quotes, pools and the roster.

Small sides (roster, pools) carry no broadcast hint: Spark broadcasts them when their size
is under its limit and joins them by shuffle when not. Only a calendar, whose size has a
fixed bound, is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import classify, labels
from ..functions.dates import month_start
from ..functions.text import fill_status, normalize_id
from .skew import lookup_join


def unique_roster(roster: DataFrame) -> DataFrame:
    """The roster with one team per e-mail: of an entry listed twice the last one counts."""
    return roster.groupBy("email").agg(F.max_by("team", "roster_seq").alias("team"))


def semi_partner_ids(partner: DataFrame, ids: DataFrame) -> DataFrame:
    """Partners that occur in a sales file (``ids.dp_id``)."""
    wanted = ids.select(F.col("dp_id").alias("dpno")).filter(F.col("dpno").isNotNull()).distinct()
    return partner.join(wanted, "dpno", "left_semi")


def join_partner_policy(policy: DataFrame, partner: DataFrame) -> DataFrame:
    """Policies with the partner number of their login."""
    logins = partner.select("dpno", F.col("partner_id").alias("login_id"))
    return lookup_join(policy, logins, "login_id", spread_by="policy_id", how="inner")


def join_first_sale(policy: DataFrame) -> DataFrame:
    """Policies with the first sale of their login.

    The minimum is a small pre-aggregated table joined back; a window over the login
    would put all policies of a busy login into one task.
    """
    first = policy.groupBy("login_id").agg(F.min("created_at").alias("first_sale_date"))
    return lookup_join(policy, first, "login_id", spread_by="policy_id", how="inner")


def _status_key(status: DataFrame) -> DataFrame:
    return status.select(normalize_id(F.col("dpno")).alias("dp_id"), "client_status").filter(F.col("dp_id").isNotNull())


def status_lookup(status: DataFrame) -> DataFrame:
    """One status per partner: the longest-standing one of its logins."""
    rank = (
        F.when(F.col("client_status") == labels.STATUS_ALREADY_ACTIVE, 3)
        .when(F.col("client_status") == labels.STATUS_ACTIVATED, 2)
        .otherwise(1)
    )
    best = _status_key(status).groupBy("dp_id").agg(F.max(rank).alias("rank"))
    name = (
        F.when(F.col("rank") == 3, F.lit(labels.STATUS_ALREADY_ACTIVE))
        .when(F.col("rank") == 2, F.lit(labels.STATUS_ACTIVATED))
        .otherwise(F.lit(labels.STATUS_INACTIVE))
    )
    return best.select("dp_id", name.alias("client_status"))


def _attach_status(sales: DataFrame, lookup: DataFrame, spread_by: str | None, clean_ids: bool) -> DataFrame:
    bare = sales.drop("dp_status")
    if not clean_ids:
        bare = bare.withColumn("dp_id", normalize_id(F.col("dp_id")))
    joined = bare.join(lookup, "dp_id", "left") if spread_by is None else lookup_join(bare, lookup, "dp_id", spread_by)
    return joined.withColumn("dp_status", fill_status(F.col("client_status"))).drop("client_status")


def enrich_status(
    sales: DataFrame, status: DataFrame, spread_by: str | None = "row_seq", clean_ids: bool = False
) -> DataFrame:
    """Sales with the status of their partner; every sales row comes out once.

    Ids are cleaned on both sides. With ``clean_ids`` the sales ids are taken as clean_sales
    leaves them, so that sales already distributed by partner need no further shuffle.
    ``spread_by`` is the unique column that cuts partners with very many sales; None where
    partners are known to occur once.
    """
    return _attach_status(sales, status_lookup(status), spread_by, clean_ids)


def enrich_status_raw(sales: DataFrame, status: DataFrame, spread_by: str = "row_seq") -> DataFrame:
    """As enrich_status, but a partner with several logins yields one row per login."""
    return _attach_status(sales, _status_key(status), spread_by, clean_ids=False)


def join_dp_details(quotes_per_dp: DataFrame, details: DataFrame, first_done: DataFrame) -> DataFrame:
    """Quotes per partner and month with partner details and first completed sale.

    All three sides have been aggregated to one row per partner (and month) before.
    """
    return quotes_per_dp.join(details.select("dp_id", "agent_mapped", "dp_category"), "dp_id", "left").join(
        first_done.select("dp_id", "first_sale_done"), "dp_id", "left"
    )


def outer_num_den(numerators: DataFrame, supply_by_agent: DataFrame, pool_by_agent: DataFrame) -> DataFrame:
    """Everyone with a numerator or a denominator, one row per e-mail, gaps as 0.

    A full outer join of three tables on one key is a union followed by one aggregation,
    which needs a single shuffle and cannot leave an agent on two rows.
    """
    parts = numerators.select("email", "act_num", "fav_num", "con_num")
    parts = parts.unionByName(
        supply_by_agent.select(F.col("agent_mapped").alias("email"), "act_den"), allowMissingColumns=True
    )
    parts = parts.unionByName(
        pool_by_agent.select(F.col("agent_mapped").alias("email"), "fav_den"), allowMissingColumns=True
    )
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("act_num", "fav_num", "con_num", "act_den", "fav_den")]
    return parts.groupBy("email").agg(*sums)


def left_map_denominators(
    numerators: DataFrame, supply_by_agent: DataFrame, pool_by_agent: DataFrame
) -> DataFrame:
    """Older rule: denominators looked up for e-mails with sales only; other agents are left out."""
    supply = supply_by_agent.select(F.col("agent_mapped").alias("email"), "act_den")
    pool = pool_by_agent.select(F.col("agent_mapped").alias("email"), "fav_den")
    return numerators.join(supply, "email", "left").join(pool, "email", "left").fillna(0, ["act_den", "fav_den"])


def with_team(by_email: DataFrame, roster: DataFrame, key: str = "email") -> DataFrame:
    """A table of one row per e-mail with the team of the roster, ``unknown`` off the roster."""
    teams = unique_roster(roster).select(F.col("email").alias(key), "team")
    return by_email.join(teams, key, "left").withColumn("team", classify.classify_team(F.col("team")))


def days_of_periods(periods: DataFrame) -> DataFrame:
    """Each calendar day inside a period (``period_start``..``snapshot_date``) with that period."""
    days = F.explode(F.sequence("period_start", "snapshot_date"))
    return periods.select(days.alias("sale_date"), "period_start", "snapshot_date")


def range_join_period(sales: DataFrame, periods: DataFrame) -> DataFrame:
    """Sales with the period they fall in; sales after the last snapshot of a month drop out.

    Periods do not overlap, so listing their days turns the range condition into plain
    equality on the day. The list has at most one row per calendar day (a few thousand for
    ten years), whatever the number of sales, and is broadcast: sales are not shuffled by
    day, where one busy day would fill one task.
    """
    return sales.join(F.broadcast(days_of_periods(periods)), "sale_date")


def asof_supply(targets: DataFrame, totals: DataFrame, target: str, out: str) -> DataFrame:
    """``targets`` with the month-to-date supply known at their ``target`` day: that of the newest
    snapshot on or before it in the same month, 0 where there is none.

    Targets and snapshots are merged and the last snapshot value is carried forward, so
    the work is linear and no target-snapshot pair is formed. Both are calendars: a month
    has at most 31 snapshots, and a few targets per day.
    """
    snapshots = totals.select(F.col("snapshot_date").alias(target), F.col("mtd").alias(out), F.lit(0).alias("is_target"))
    merged = targets.withColumn("is_target", F.lit(1)).unionByName(snapshots, allowMissingColumns=True)
    carried = W.partitionBy(month_start(F.col(target))).orderBy(target, "is_target")
    filled = merged.withColumn(out, F.coalesce(F.last(out, ignorenulls=True).over(carried), F.lit(0)))
    return filled.filter("is_target = 1").drop("is_target")


def month_pool(pool: DataFrame) -> DataFrame:
    """Favourite pool per month: the total of the month's first snapshot."""
    totals = pool.groupBy("snapshot_date").agg(F.sum("dp_count").alias("fav_den"))
    first = F.min(F.struct("snapshot_date", "fav_den"))
    return totals.groupBy(month_start(F.col("snapshot_date")).alias("month_first")).agg(
        first["fav_den"].alias("fav_den")
    )


def anti_replace(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``existing`` that ``new`` does not replace."""
    return existing.join(new.select(key).distinct(), key, "left_anti")
