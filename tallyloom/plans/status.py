"""Partner status by first sale."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify, labels
from ..functions.dates import as_date, month_start
from ..operators.aggregates import login_totals
from ..operators.joins import semi_partner_ids
from ..operators.ordering import order_status


def filter_policy(policy: DataFrame) -> DataFrame:
    return policy.filter(
        (F.col("vertical") == labels.VERTICAL_HEALTH) & F.col("businesstype").isin(*labels.BUSINESS_TYPES)
    )


def dp_status(
    partner: DataFrame,
    policy: DataFrame,
    ids: DataFrame,
    *,
    data_date: str,
    already_before: str = labels.ALREADY_ACTIVE_BEFORE,
    since: str = labels.POLICIES_SINCE,
    ordered: bool = True,
) -> DataFrame:
    """Policies, premium and status of the partners of a sales file, per login.

    The policies, the one large table, are read once and joined with the wanted logins (which Spark
    broadcasts when they are few), so only their policies are shuffled and reduced to a row per
    login; a login's partners travel along, as a short list, and become rows at the end.
    """
    # A partner listed twice counts its premium twice, as a join on the raw list would.
    listed = semi_partner_ids(partner, ids).groupBy("dpno", "partner_id").agg(F.count(F.lit(1)).alias("listed"))
    # One row per login with its partners, mostly one, so that policies meet the logins once.
    logins = listed.groupBy(F.col("partner_id").alias("login_id")).agg(F.collect_list(F.struct("dpno", "listed")).alias("partners"))
    wanted = filter_policy(policy).join(logins, "login_id")
    per_login = login_totals(wanted, F.lit(since).cast("timestamp_ntz"), ["login_id", "partners"])
    status = classify.classify_status(
        F.col("first_sale_date"),
        F.lit(already_before).cast("timestamp_ntz"),
        month_start(as_date(data_date)).cast("timestamp_ntz"),
    )
    result = per_login.select("*", F.inline("partners")).select(
        "dpno",
        "login_id",
        "policy_count",
        (F.col("total_netpremium") * F.col("listed")).cast("decimal(28,2)").alias("total_netpremium"),
        status.alias("client_status"),
    )
    return order_status(result) if ordered else result


# The same report for users who prefer SQL: dates are named parameters, never pasted text.
STATUS_SQL = """
WITH clients AS (
  SELECT p.dpno, p.partner_id AS login_id
  FROM {partner} p LEFT SEMI JOIN {ids} i ON p.dpno = i.dp_id
), per_login AS (
  SELECT login_id, min(created_at) AS first_sale_date,
         count(DISTINCT policy_id) FILTER (WHERE created_at >= :since) AS policy_count,
         sum(net_premium) FILTER (WHERE created_at >= :since) AS total_netpremium,
         max(created_at) AS last_sale_date
  FROM {policy}
  WHERE vertical = 'HEALTH' AND businesstype IN ('NEW', 'PORTABILITY')
    AND login_id IN (SELECT login_id FROM clients)
  GROUP BY login_id
)
SELECT c.dpno, c.login_id, l.policy_count, l.total_netpremium,
       CASE WHEN l.first_sale_date < :already_before THEN 'Already Active'
            WHEN l.first_sale_date < trunc(:data_date, 'month') THEN 'Activated by LGLC'
            ELSE 'Inactive' END AS client_status
FROM per_login l JOIN clients c ON c.login_id = l.login_id
WHERE l.last_sale_date >= :since
ORDER BY dpno, login_id
"""


def status_param_sql(
    spark: SparkSession, partner: DataFrame, policy: DataFrame, ids: DataFrame, *, data_date: str,
    already_before: str = labels.ALREADY_ACTIVE_BEFORE, since: str = labels.POLICIES_SINCE,
) -> DataFrame:
    texts = {"data_date": data_date, "already_before": already_before, "since": since}
    dates = {name: dt.date.fromisoformat(text) for name, text in texts.items()}
    return spark.sql(STATUS_SQL, args=dates, partner=partner, policy=policy, ids=ids)
