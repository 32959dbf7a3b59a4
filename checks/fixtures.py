"""The input tables of the reports, derived from the test tables by Spark.

``checks/oracle.py`` holds the same tables as SQL; the names match. All people, addresses
and rosters are invented.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.schemas import BIGINT, DOUBLE, INT, MOMENT, STRING, table

REPORT_DATE = "1998-06-15"
QUOTES_DATE = "2024-01-31"
CUTOFFS = {"data_date": REPORT_DATE, "already_before": "1996-08-01", "since": "1996-01-01"}
BATCH1_LAST = "1998-06-15"
BATCH2_FIRST = "1998-06-08"
SENDERS = ["reports@example.com", "lead@example.com"]
PREFERRED = "lead@example.com"
MONTHS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

TABLES = {
    "nation": table(n_nationkey=INT, n_name=STRING, n_regionkey=INT),
    "customer": table(c_custkey=BIGINT, c_name=STRING, c_nationkey=INT, c_acctbal=DOUBLE, c_mktsegment=STRING),
    "supplier": table(s_suppkey=BIGINT, s_name=STRING, s_nationkey=INT, s_acctbal=DOUBLE),
    "orders": table(
        o_orderkey=BIGINT,
        o_custkey=BIGINT,
        o_orderstatus=STRING,
        o_totalprice=DOUBLE,
        o_orderdate=MOMENT,
        o_orderpriority=STRING,
    ),
    "events": table(event_id=BIGINT, ts=MOMENT, user_id=BIGINT, event_type=STRING, value=DOUBLE, props=STRING),
}


def _text(c: Column) -> Column:
    return c.cast("string")


class Fixtures:
    """One attribute per input table, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        """A test table; its schema is given, so that no job is needed to infer it."""
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def roster(self) -> DataFrame:
        return self.spark.sql("""SELECT * FROM VALUES
          (1,'asha.rao1@example.com','old'), (2,'binod.kumar@example.com','old'), (3,'carla.mendes9@example.com','new'),
          (4,'dev.patel2@example.com','old'), (5,'e.farah@example.com','new'), (6,'gita.nair7@example.com','new'),
          (7,'hari.om@example.com','old'), (8,'iris.wong@example.com','new') AS t(roster_seq, email, team)""")

    @cached_property
    def override(self) -> DataFrame:
        return self.spark.sql("SELECT * FROM VALUES ('ZED ALIAS','dev.patel2@example.com') AS t(clean_name, email)")

    @cached_property
    def bdm(self) -> DataFrame:
        return self.spark.sql("""SELECT * FROM VALUES
          (0,'Asha Rao'), (1,'RAO  ASHA.'), (2,'Binod Kumaar'), (3,'Mendes, Carla'), (4,'Zed-Alias'), (5,'Farah E'),
          (6,'Geeta Nair'), (7,'Quentin Xylophone'), (8,CAST(NULL AS STRING)), (9,'12345') AS t(bdm_no, bdm_name)""")

    @cached_property
    def agent(self) -> DataFrame:
        nation = self.table("nation")
        on = self.roster.roster_seq == nation.n_nationkey % 10 + 1
        return nation.join(self.roster, on, "left").select("n_nationkey", F.col("email").alias("agent_mapped"))

    @cached_property
    def sales(self) -> DataFrame:
        o = self.table("orders")
        key, cust = F.col("o_orderkey"), _text(F.col("o_custkey"))
        dp_id = (
            F.when(key % 211 == 0, F.lit(None))
            .when(key % 3 == 0, F.concat(F.lit("DP-"), cust))
            .when(key % 3 == 1, F.concat(cust, F.lit(".0")))
            .otherwise(F.concat(F.lit(" "), cust, F.lit(" ")))
        )
        price = _text(F.col("o_totalprice"))
        premium = F.when(key % 50 == 0, F.lit("n/a")).when(key % 7 == 0, F.concat(price, F.lit("014"))).otherwise(price)
        return o.join(self.bdm, self.bdm.bdm_no == o.o_custkey % 10).select(
            key.alias("row_seq"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
            "bdm_name",
            dp_id.alias("dp_id"),
            premium.alias("net_premium"),
        )

    @cached_property
    def partner(self) -> DataFrame:
        cust = _text(F.col("c_custkey"))
        return self.table("customer").select(cust.alias("dpno"), F.concat(F.lit("L"), cust).alias("partner_id"))

    @cached_property
    def policy(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.concat(F.lit("L"), _text(F.col("o_custkey"))).alias("login_id"),
            F.concat(F.lit("P"), _text(F.col("o_orderkey"))).alias("policy_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("net_premium"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "HEALTH").otherwise("MOTOR").alias("vertical"),
            F.when(status == "F", "NEW").when(status == "P", "PORTABILITY").otherwise("RENEWAL").alias("businesstype"),
        )

    @cached_property
    def quotes(self) -> DataFrame:
        event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
        day, month, year = (_text(f("ts")) for f in (F.day, F.month, F.year))
        slash = F.lit("/")
        day_first = F.concat(day, slash, month, slash, year)
        month_first = F.concat(
            F.lit(" "), F.lpad(month, 2, "0"), slash, F.lpad(day, 2, "0"), slash, year, F.lit(" 10:15")
        )
        return self.table("events").select(
            F.concat(F.lit("Q"), _text(user), F.lit("-"), _text(event % 3)).alias("quote_id"),
            _text(user).alias("dp_id"),
            F.when(kind == "purchase", "Sale-Done")
            .when(kind == "signup", "Quote-Created")
            .when(kind == "click", "Proposal")
            .when(kind == "view", "Follow-Up")
            .otherwise("Lost")
            .alias("stage"),
            F.when(event % 97 == 0, "")
            .when(event % 89 == 0, "bad date")
            .when(event % 83 == 0, F.lit(None))
            .when(event % 4 == 0, day_first)
            .otherwise(month_first)
            .alias("creation_date"),
            F.when(event % 5 != 0, F.concat(month, slash, day, slash, _text(2023 + user % 2))).alias(
                "last_update_date"
            ),
        )

    @cached_property
    def dp_master(self) -> DataFrame:
        cust = F.col("c_custkey")
        dates = F.explode(F.array(F.lit("2023-11-30"), F.lit("2023-12-31")))
        favourite = (F.col("sqldate") != "2023-11-30") & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
        return (
            self.table("customer")
            .join(self.agent, F.col("n_nationkey") == F.col("c_nationkey"))
            .withColumn("sqldate", dates)
            .select(
                _text(cust).alias("dp_id"),
                F.when(cust % 41 == 0, F.lit(None))
                .when(cust % 43 == 0, "#N/A")
                .otherwise(F.col("agent_mapped"))
                .alias("agent_mapped"),
                F.when(favourite, "Favourite").otherwise("Regular").alias("dp_category"),
                F.when(cust % 11 == 0, "Remap-DP")
                .when(cust % 11 == 1, F.lit(None))
                .otherwise("Connected")
                .alias("last_call_disposition"),
                "sqldate",
            )
        )

    @cached_property
    def snapshot_days(self) -> DataFrame:
        """The days that have a snapshot: at most four a month."""
        day = F.col("o_orderdate").cast("date").alias("snapshot_date")
        return self.table("orders").select(day).filter(F.day("snapshot_date").isin(5, 12, 19, 28)).distinct()

    @cached_property
    def supply(self) -> DataFrame:
        """Distinct customers of the month up to each snapshot, per agent.

        A customer counts from its first order of the month on, so customers are reduced to
        (first day, agent) counts before they meet the snapshots.
        """
        orders = self.table("orders")
        day = F.col("o_orderdate").cast("date")
        first = orders.groupBy("o_custkey", F.trunc(day, "month").alias("month_first")).agg(F.min(day).alias("first_day"))
        customer = self.table("customer").select("c_custkey", "c_nationkey")
        starts = (
            first.join(customer, F.col("c_custkey") == F.col("o_custkey"))
            .join(self.agent, F.col("n_nationkey") == F.col("c_nationkey"))
            .groupBy("month_first", "first_day", "agent_mapped")
            .agg(F.count(F.lit(1)).alias("new_dps"))
        )
        days = self.snapshot_days.withColumn("month_first", F.trunc("snapshot_date", "month"))
        return (
            starts.join(days, "month_first")
            .filter(F.col("first_day") <= F.col("snapshot_date"))
            .groupBy("snapshot_date", "agent_mapped")
            .agg(F.sum("new_dps").alias("sum_inactive_dps_creating_quotes"))
        )

    @cached_property
    def fav_pool(self) -> DataFrame:
        """Favourites per agent, the same on every snapshot day; April has no pool."""
        counted = (
            self.table("customer")
            .filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
            .join(self.agent, F.col("n_nationkey") == F.col("c_nationkey"))
            .groupBy("agent_mapped")
            .agg(F.count("c_custkey").alias("dp_count"))
        )
        days = self.snapshot_days.filter(F.month("snapshot_date") != 4)
        all_days = days.agg(F.collect_set("snapshot_date")).scalar()  # four days a month
        return counted.select(F.explode(all_days).alias("snapshot_date"), "agent_mapped", "dp_count")

    @cached_property
    def files(self) -> DataFrame:
        """A log of arrived files, one per sale day: workbooks, lock files and status results."""
        days = self.table("orders").select(F.col("o_orderdate").cast("date").alias("sale_date")).distinct()
        day, text = F.day("sale_date"), _text(F.col("sale_date"))
        name = (
            F.when(day % 7 == 0, F.concat(F.lit("~$Health_"), text, F.lit(".xlsx")))
            .when(day % 5 == 0, F.concat(F.lit("DP_Status_"), text, F.lit(".csv")))
            .otherwise(F.concat(F.lit("Health_"), text, F.lit(".xlsx")))
        )
        return days.select(
            "sale_date", name.alias("file_name"), F.date_add("sale_date", day * 37 % 11).alias("arrived_at")
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Message metadata, one message per order."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month("o_orderdate"))
        return self.table("orders").select(
            key.alias("message_id"),
            F.when(cust % 5 == 0, "Lead <LEAD@example.com>")
            .when(cust % 5 == 1, "reports@example.com")
            .when(cust % 5 == 2, F.lit(None))
            .otherwise("other@example.com")
            .alias("sender"),
            F.concat(month, F.when(key % 2 == 0, " Sale's file").otherwise(" premium data")).alias("subject"),
            F.col("o_orderdate").alias("received_at"),
            F.when(key % 3 == 0, F.array(F.lit("notes.pdf"), F.lit("Health.XLSX"), F.lit("old.xls")))
            .when(key % 3 == 1, F.array(F.lit("notes.pdf")))
            .otherwise(F.array(F.lit("sales.xls")))
            .alias("attachments"),
        )

    @cached_property
    def wide_names(self) -> DataFrame:
        """A manager name per customer: letters for the digits of its key, and a first name."""
        letters = F.translate(_text(F.col("c_custkey") * 7919), "0123456789", "aeinorstlm")
        first = F.when(F.col("c_custkey") % 3 == 0, " Asha").when(F.col("c_custkey") % 3 == 1, " Binod").otherwise(" Carla")
        return self.table("customer").select(F.col("c_custkey"), F.concat(letters, first).alias("bdm_name"))

    @cached_property
    def wide_roster(self) -> DataFrame:
        """A roster entry per supplier."""
        letters = F.translate(_text(F.col("s_suppkey") * 104729), "0123456789", "aeinorstlm")
        first = F.when(F.col("s_suppkey") % 3 == 0, "binod.").when(F.col("s_suppkey") % 3 == 1, "asha.").otherwise("c")
        return self.table("supplier").select(
            F.col("s_suppkey").cast("int").alias("roster_seq"),
            F.concat(first, letters, _text(F.col("s_suppkey")), F.lit("@example.com")).alias("email"),
            F.when(F.col("s_suppkey") % 2 == 0, "old").otherwise("new").alias("team"),
        )
