"""Every registered query with the SQL that gives the same rows."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
from collections.abc import Callable

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import classify, dates, labels, numbers, text
from tallyloom.operators import aggregates, fuzzy, joins, ordering, windows
from tallyloom.plans import directory, metrics, presence, rates, report, sales, status, steps, supply
from tallyloom.sources import batches, messages, schemas, storage
from tallyloom.streaming import collation

from .fixtures import (
    BATCH1_LAST,
    BATCH2_FIRST,
    CUTOFFS,
    PREFERRED,
    QUOTES_DATE,
    REPORT_DATE,
    SENDERS,
    Fixtures,
)
from .oracle import MIXED_CREATION, MIXED_UPDATE, RATES, statement, with_rates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SNAPSHOT = "1998-06-12"
MODE = "REGULAR"


def edge(df: DataFrame) -> DataFrame:
    """Values as they leave: dates and times as text, money as double, rates with six digits."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = dates.iso_text(column)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.BooleanType):
            column = column.cast("int")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, **formats):
    """Register a function of the fixtures under a name, with its SQL."""

    def register(build: Callable[[Fixtures], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: edge(build(Fixtures(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = statement(sql, **formats)
        return build

    return register


# --- tables several queries start from -----------------------------------------------------
def shared(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    """Define such a table once per query, however often it is used there."""

    def get(fx: Fixtures) -> DataFrame:
        if build.__name__ not in fx.__dict__:
            fx.__dict__[build.__name__] = build(fx)
        return fx.__dict__[build.__name__]

    return get


@shared
def cleaned(fx: Fixtures) -> DataFrame:
    return sales.clean_sales(fx.sales)


@shared
def unique(fx: Fixtures) -> DataFrame:
    return sales.unique_sales(cleaned(fx))


@shared
def status_of(fx: Fixtures) -> DataFrame:
    return status.dp_status(fx.partner, fx.policy, cleaned(fx), ordered=False, **CUTOFFS)


@shared
def enriched(fx: Fixtures) -> DataFrame:
    return sales.enrich_sales(cleaned(fx), status_of(fx))


@shared
def unique_enriched(fx: Fixtures) -> DataFrame:
    return sales.enrich_unique(unique(fx), status_of(fx))


@shared
def day_supply(fx: Fixtures) -> DataFrame:
    return fx.supply.filter(F.col("snapshot_date") == F.lit(SNAPSHOT).cast("date"))


@shared
def day_pool(fx: Fixtures) -> DataFrame:
    return fx.fav_pool.filter(F.col("snapshot_date") == F.lit(SNAPSHOT).cast("date"))


@shared
def by_email(fx: Fixtures) -> DataFrame:
    return metrics.email_level(unique_enriched(fx), day_supply(fx), day_pool(fx), fx.roster, fx.override)


@shared
def new_trend_row(fx: Fixtures) -> DataFrame:
    return metrics.trend_row(
        unique_enriched(fx), enriched(fx), day_supply(fx), day_pool(fx), data_date=REPORT_DATE, mode=MODE
    )


@shared
def two_batches(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """A first delivery, and a later one that overlaps it with other statuses."""
    return split_batches(enriched(fx))


@shared
def written_sales(fx: Fixtures) -> DataFrame:
    """The enriched table as a run leaves it, written once."""
    path = storage.write_table(enriched(fx), storage.fresh_path(fx.spark, "enriched"))
    return storage.read_parquet(fx.spark, path, schemas.SALES_ENRICHED)


@shared
def written_batches(fx: Fixtures) -> tuple[DataFrame, DataFrame]:
    """Two batches of that table."""
    return split_batches(written_sales(fx))


def split_batches(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    first = rows.filter(F.col("sale_date") <= F.lit(BATCH1_LAST).cast("date"))
    # A premium that differs in its third digit only is another sale.
    exact = (numbers.coerce_number(F.col("net_premium")) + F.lit("0.001").cast("decimal(10,3)")).cast("string")
    first = first.unionByName(first.filter(F.col("row_seq") % 11 == 0).withColumn("net_premium", exact))
    second = rows.filter(F.col("sale_date") >= F.lit(BATCH2_FIRST).cast("date"))
    return first, second.withColumn("dp_status", F.lit(labels.STATUS_ACTIVATED))


@shared
def rate_master(fx: Fixtures) -> DataFrame:
    return enriched(fx).select("row_seq", "sale_date", "dp_id", "dp_status")


@shared
def trend_seed(fx: Fixtures) -> DataFrame:
    """Two earlier trend rows made from the sales up to their dates."""
    days = [dt.date(1998, 5, 20), dt.date(1998, 6, 15)]
    rows = None
    for day in days:
        part = fx.sales.filter(F.col("sale_date") <= F.lit(day)).agg(F.count(F.lit(1)).alias("act_numerator"))
        row = part.select(F.lit(day).alias("data_date"), "act_numerator", F.lit("MANUAL").alias("run_mode"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


TREND_SEED = """
SELECT DATE '1998-05-20' AS data_date, COUNT(*) AS act_numerator, 'MANUAL' AS run_mode FROM fx_sales WHERE sale_date <= DATE '1998-05-20'
UNION ALL SELECT DATE '1998-06-15', COUNT(*), 'MANUAL' FROM fx_sales WHERE sale_date <= DATE '1998-06-15'
"""


# --- sources and sinks --------------------------------------------------------------------
@query("scan_sales", "SELECT * FROM fx_sales", dates=("sale_date",))
def _(fx):
    path = storage.write_csv(fx.sales, storage.fresh_path(fx.spark, "scan_sales"))
    return storage.read_csv(fx.spark, path, schemas.SALES_RAW)


@query("scan_status", "SELECT * FROM dp_status", doubles=("total_netpremium",))
def _(fx):
    path = storage.write_csv(status_of(fx), storage.fresh_path(fx.spark, "scan_status"))
    return storage.read_csv(fx.spark, path, schemas.DP_STATUS)


@query("scan_supply", "SELECT quote_month, agent_mapped, SUM(inactive_dps_creating_quotes) AS sum_inactive_dps_creating_quotes FROM agent_supply WHERE agent_mapped NOT IN ('#N/A','#REF!') GROUP BY 1, 2",
       dates=("quote_month",))
def _(fx):
    result = supply.inactive_supply(fx.quotes, fx.dp_master, data_date=QUOTES_DATE)
    path = storage.write_csv(result, storage.fresh_path(fx.spark, "scan_supply"))
    return storage.read_csv(fx.spark, path, schemas.SUPPLY)


FAV_POOL_SQL = """
SELECT agent_mapped, team, COUNT(dp_id) AS dp_count FROM (
  SELECT f.agent_mapped, f.dp_id, coalesce(r.team, 'unknown') AS team FROM fav_rows f LEFT JOIN fx_roster r ON r.email = f.agent_mapped) t
GROUP BY agent_mapped, team
"""


@query("scan_fav", FAV_POOL_SQL)
def _(fx):
    result = supply.fav_pool(fx.dp_master, fx.roster, data_date=QUOTES_DATE)
    path = storage.write_csv(result, storage.fresh_path(fx.spark, "scan_fav"))
    return storage.read_csv(fx.spark, path, schemas.FAV_POOL)


@query("scan_warehouse", """
SELECT 'partner' AS table_name, COUNT(*) AS n_rows FROM fx_partner UNION ALL SELECT 'policy', COUNT(*) FROM fx_policy
UNION ALL SELECT 'dp_master', COUNT(*) FROM fx_dp_master UNION ALL SELECT 'quotes', COUNT(*) FROM fx_quotes
""")
def _(fx):
    tables = {"partner": fx.partner, "policy": fx.policy, "dp_master": fx.dp_master, "quotes": fx.quotes}
    counts = None
    for name, df in tables.items():
        df.createOrReplaceTempView(f"warehouse_{name}")
        count = fx.spark.table(f"warehouse_{name}").agg(F.count(F.lit(1)).alias("n_rows"))
        fx.spark.catalog.dropTempView(f"warehouse_{name}")  # the plan above keeps the table
        count = count.select(F.lit(name).alias("table_name"), "n_rows")
        counts = count if counts is None else counts.unionByName(count)
    return counts


@query("latest_batch", r"""
SELECT s.* FROM fx_sales s WHERE s.sale_date = (
  SELECT sale_date FROM fx_files WHERE file_name NOT LIKE '~$%' AND (file_name LIKE '%.xlsx' OR file_name LIKE '%.xls')
  ORDER BY arrived_at DESC, file_name DESC LIMIT 1)
""", dates=("sale_date",))
def _(fx):
    newest = batches.latest_batch(fx.files, [".xlsx", ".xls"]).select("sale_date")
    return fx.sales.filter(F.col("sale_date") == newest.scalar())


@query("snapshot_or_latest", """
SELECT * FROM fx_supply WHERE snapshot_date = coalesce(
  (SELECT MAX(snapshot_date) FROM fx_supply WHERE snapshot_date = DATE '1998-06-15'), (SELECT MAX(snapshot_date) FROM fx_supply))
""", dates=("snapshot_date",))
def _(fx):
    return batches.snapshot_or_latest(fx.supply, REPORT_DATE)


@query("snapshot_date_from_name", r"""
SELECT file_name, CAST(nullif(regexp_extract(file_name, '_(\d{4}-\d{2}-\d{2})', 1), '') AS DATE) AS snapshot_date FROM fx_files
""", dates=("snapshot_date",))
def _(fx):
    return fx.files.select("file_name", batches.snapshot_date_from_name(F.col("file_name")).alias("snapshot_date"))


@query("require_snapshots", """
SELECT t.table_name, d.snapshot_date FROM (SELECT DISTINCT snapshot_date FROM fx_supply) d
CROSS JOIN (VALUES ('fav_pool'), ('supply')) AS t(table_name)
WHERE NOT EXISTS (SELECT 1 FROM (SELECT 'supply' AS table_name, snapshot_date FROM fx_supply UNION ALL
                                 SELECT 'fav_pool', snapshot_date FROM fx_fav_pool) p
                  WHERE p.table_name = t.table_name AND p.snapshot_date = d.snapshot_date)
""", dates=("snapshot_date",))
def _(fx):
    names = F.explode(F.array(F.lit("supply"), F.lit("fav_pool")))
    required = fx.snapshot_days.select(names.alias("table_name"), "snapshot_date")
    present = fx.supply.select(F.lit("supply").alias("table_name"), "snapshot_date").unionByName(
        fx.fav_pool.select(F.lit("fav_pool").alias("table_name"), "snapshot_date")
    )
    return batches.missing_snapshots(required, present)


@query("validate_columns", "SELECT 'dp_status' AS missing_column, COUNT(*) AS rows_skipped FROM fx_sales")
def _(fx):
    missing = schemas.missing_columns(fx.sales, schemas.COLLATE_REQUIRED)
    named = F.explode(F.array(*[F.lit(name) for name in missing]))
    return fx.sales.agg(F.count(F.lit(1)).alias("rows_skipped")).select(named.alias("missing_column"), "rows_skipped")


@query("resolve_table", "SELECT sale_date, COUNT(*) AS n_rows, COUNT(DISTINCT dp_id) AS n_ids FROM fx_sales GROUP BY sale_date", dates=("sale_date",))
def _(fx):
    prefix = "resolve_table_"
    sheets = {"Daily_Health": fx.sales, "health_unique_dps": unique(fx), "quotes": fx.quotes}
    for name, df in sheets.items():
        df.createOrReplaceTempView(prefix + name)
    known = [t.name for t in fx.spark.catalog.listTables() if t.name.lower().startswith(prefix)]
    chosen = fx.spark.table(batches.resolve_table(known))
    for name in sheets:
        fx.spark.catalog.dropTempView(prefix + name)
    return chosen.groupBy("sale_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("dp_id").alias("n_ids")
    )


@query("write_table", "SELECT * FROM sales_clean", dates=("sale_date",))
def _(fx):
    return storage.read_parquet(
        fx.spark, storage.write_table(cleaned(fx), storage.fresh_path(fx.spark, "write_table")), schemas.SALES_RAW
    )


@query("write_audit", """
SELECT 'sales' AS table_name, dp_status, COUNT(*) AS n_rows FROM sales_enriched GROUP BY dp_status
UNION ALL SELECT 'dp_status_data', client_status, COUNT(*) FROM dp_status GROUP BY client_status
""")
def _(fx):
    written = storage.write_audit(enriched(fx), status_of(fx), storage.fresh_path(fx.spark, "write_audit"))
    rows = storage.read_parquet(fx.spark, written["sales"]).groupBy("dp_status")
    audit = storage.read_parquet(fx.spark, written["dp_status_data"]).groupBy(F.col("client_status").alias("dp_status"))
    return (
        rows.agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit("sales").alias("table_name"), "dp_status", "n_rows")
        .unionByName(
            audit.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit("dp_status_data").alias("table_name"), "dp_status", "n_rows"
            )
        )
    )


@query("write_breakdown", """
SELECT 'email_level' AS table_name, email AS name, act_num, act_den, DATE '1998-06-15' AS data_date, 'REGULAR' AS run_mode FROM email_counts
UNION ALL SELECT 'team_level', team, act_num, act_den, DATE '1998-06-15', 'REGULAR' FROM team_counts
UNION ALL SELECT 'summary', 'overall', act_num, act_den, DATE '1998-06-15', 'REGULAR' FROM overall
""", dates=("data_date",))
def _(fx):
    emails = storage.cut_lineage(by_email(fx))  # two of the tables start from it
    tables = {
        "email_level": emails.withColumnRenamed("email", "name"),
        "team_level": metrics.team_level(emails).withColumnRenamed("team", "name"),
        "summary": aggregates.overall_row(unique_enriched(fx), day_supply(fx), day_pool(fx)).withColumn(
            "name", F.lit("overall")
        ),
    }
    path = storage.fresh_path(fx.spark, "write_breakdown")
    written = storage.write_breakdown(tables, path, REPORT_DATE, MODE)
    back = None
    for name, where in written.items():
        part = storage.read_parquet(fx.spark, where).select(
            F.lit(name).alias("table_name"), "name", "act_num", "act_den", F.col("data_date").cast("date"), "run_mode"
        )
        back = part if back is None else back.unionByName(part)
    return back


MESSAGE_WHERE = """
FROM fx_messages WHERE (contains(lower(coalesce(sender, '')), 'reports@example.com') OR contains(lower(coalesce(sender, '')), 'lead@example.com'))
  AND contains(lower(subject), 'june') AND contains(lower(subject), 'sale')
"""


@query("select_message", f"""
SELECT message_id, sender, subject, received_at, workbook {MESSAGE_WHERE}
  AND CAST(received_at AS DATE) BETWEEN DATE '1998-06-14' AND DATE '1998-06-16'
ORDER BY contains(lower(sender), 'lead@example.com') DESC, received_at DESC, message_id DESC LIMIT 1
""", dates=("received_at",))
def _(fx):
    return messages.select_message(
        fx.messages, SENDERS, PREFERRED, "June Sale", dt.date.fromisoformat(REPORT_DATE)
    )


@query("load_or_empty", TREND_SEED, dates=("data_date",))
def _(fx):
    schema = schemas.table(data_date=schemas.DATE, act_numerator=schemas.BIGINT, run_mode=schemas.STRING)
    path = storage.fresh_path(fx.spark, "load_or_empty")
    first_run = storage.load_or_empty(fx.spark, path, schema)
    storage.write_table(ordering.union_by_name(first_run, trend_seed(fx)), path)
    return storage.load_or_empty(fx.spark, path, schema)


# --- projections, filters, scalar functions ---------------------------------------------------
@query("trim_headers", "SELECT row_seq, sale_date, dp_id FROM fx_sales", dates=("sale_date",))
def _(fx):
    padded = fx.sales.select("row_seq", F.col("sale_date").alias(" sale_date"), F.col("dp_id").alias("dp_id  "))
    return schemas.trim_headers(padded)


@query("strip_dp_prefix", "SELECT row_seq, trim(split_part(dp_id, '-', -1)) AS dp_id FROM fx_sales")
def _(fx):
    return fx.sales.select("row_seq", text.strip_dp_prefix(F.col("dp_id")).alias("dp_id"))


@query("normalize_id", r"SELECT row_seq, trim(regexp_replace(dp_id, '\.0$', '')) AS dp_id FROM fx_sales")
def _(fx):
    return fx.sales.select("row_seq", text.normalize_id(F.col("dp_id")).alias("dp_id"))


@query("select_columns", "SELECT sale_date, bdm_name, dp_id, net_premium FROM fx_sales", dates=("sale_date",))
def _(fx):
    return fx.sales.select("sale_date", "bdm_name", "dp_id", "net_premium")


@query("positional_select", "SELECT dpno AS key_id, client_status AS new_status FROM dp_status")
def _(fx):
    return schemas.positional_select(status_of(fx), {0: "key_id", 4: "new_status"})


@query("drop_matching_columns", "SELECT row_seq, dp_id FROM sales_enriched")
def _(fx):
    extra = enriched(fx).select(
        "row_seq", "dp_id", F.col("dp_status").alias("DP Status_x"), F.col("dp_id").alias("Key_ID")
    )
    return schemas.drop_matching_columns(extra, "DP Status", "Key_ID")


@query("rename_columns", "SELECT dpno AS key_id, client_status AS dp_status FROM dp_status")
def _(fx):
    return status_of(fx).select("dpno", "client_status").withColumnsRenamed(
        {"dpno": "key_id", "client_status": "dp_status"}
    )


@query("clean_name", "SELECT row_seq, clean_name FROM named_sales")
def _(fx):
    return fx.sales.select("row_seq", text.clean_name(F.col("bdm_name")).alias("clean_name"))


@query("email_local_part", """
SELECT s_suppkey AS roster_seq, email, trim(regexp_replace(upper(split_part(email, '@', 1)), '[^A-Z]+', ' ', 'g')) AS local
FROM (SELECT roster_seq AS s_suppkey, email FROM fx_wide_roster) t
""")
def _(fx):
    return fx.wide_roster.select("roster_seq", "email", text.email_local_part(F.col("email")).alias("local"))


@query("coerce_number", """
SELECT row_seq, TRY_CAST(trim(net_premium) AS DECIMAL(38,10)) AS premium, coalesce(TRY_CAST(trim(net_premium) AS DECIMAL(38,10)), 0) AS premium_or_zero FROM fx_sales
""", doubles=("premium", "premium_or_zero"))
def _(fx):
    raw = F.col("net_premium")
    return fx.sales.select(
        "row_seq", numbers.coerce_number(raw).alias("premium"), numbers.coerce_number_or_zero(raw).alias("premium_or_zero")
    )


@query("coerce_date", "SELECT sale_text, CAST(try_strptime(sale_text, '%Y-%m-%d') AS DATE) AS sale_date FROM (SELECT CASE WHEN row_seq % 9 = 0 THEN 'soon' ELSE CAST(sale_date AS VARCHAR) END AS sale_text FROM fx_sales) t",
       dates=("sale_date",))
def _(fx):
    raw = F.when(F.col("row_seq") % 9 == 0, "soon").otherwise(dates.iso_text(F.col("sale_date")))
    return fx.sales.select(raw.alias("sale_text")).select(
        "sale_text", dates.coerce_date(F.col("sale_text")).alias("sale_date")
    )


@query("fill_status", """
SELECT row_seq, CASE WHEN s IS NULL OR lower(s) IN ('nan', '') THEN 'Inactive' ELSE s END AS dp_status FROM (
  SELECT row_seq, CASE row_seq % 4 WHEN 0 THEN NULL WHEN 1 THEN 'NaN' WHEN 2 THEN '' ELSE 'Already Active' END AS s FROM fx_sales) t
""")
def _(fx):
    number = F.col("row_seq") % 4
    raw = F.when(number == 1, "NaN").when(number == 2, "").when(number == 3, labels.STATUS_ALREADY_ACTIVE)
    return fx.sales.select("row_seq", text.fill_status(raw).alias("dp_status"))


@query("fill_zero", """
SELECT s.snapshot_date, s.agent_mapped, s.sum_inactive_dps_creating_quotes AS act_den, coalesce(p.dp_count, 0) AS fav_den
FROM fx_supply s LEFT JOIN fx_fav_pool p ON p.snapshot_date = s.snapshot_date AND p.agent_mapped = s.agent_mapped
""", dates=("snapshot_date",))
def _(fx):
    joined = fx.supply.join(fx.fav_pool, ["snapshot_date", "agent_mapped"], "left")
    return joined.fillna(0, ["dp_count"]).select(
        "snapshot_date",
        "agent_mapped",
        F.col("sum_inactive_dps_creating_quotes").alias("act_den"),
        F.col("dp_count").alias("fav_den"),
    )


@query("coalesce_keys", "SELECT email FROM outer_nd")
def _(fx):
    n = metrics.email_counts(unique_enriched(fx), fx.roster, fx.override).select("email")
    a = aggregates.supply_by_agent(day_supply(fx)).select(F.col("agent_mapped").alias("agent_x"))
    f = aggregates.pool_by_agent(day_pool(fx)).select(F.col("agent_mapped").alias("agent_y"))
    merged = n.join(a, F.col("email") == F.col("agent_x"), "full")
    merged = merged.join(f, F.coalesce("email", "agent_x") == F.col("agent_y"), "full")
    return merged.select(F.coalesce("email", "agent_x", "agent_y").alias("email"))


@query("filter_status", "SELECT row_seq, dp_id, dp_status FROM sales_enriched WHERE trim(dp_status) IN ('Activated by LGLC','Already Active')")
def _(fx):
    return enriched(fx).filter(classify.is_favourite(F.col("dp_status"))).select("row_seq", "dp_id", "dp_status")


@query("filter_policy", "SELECT policy_id, vertical, businesstype FROM fx_policy WHERE vertical = 'HEALTH' AND businesstype IN ('NEW','PORTABILITY')")
def _(fx):
    return status.filter_policy(fx.policy).select("policy_id", "vertical", "businesstype")


@query("filter_since")
def _(fx):
    since = F.lit(CUTOFFS["since"]).cast("timestamp_ntz")
    rows = joins.join_partner_policy(status.filter_policy(fx.policy), joins.semi_partner_ids(fx.partner, cleaned(fx)))
    return rows.filter(F.col("created_at") >= since).select("policy_id", "created_at")


ORACLES["filter_since"] = statement(
    "SELECT policy_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM policy_filtered WHERE created_at >= TIMESTAMP '1996-01-01'"
)


@query("filter_not_in_null", "SELECT dp_id, sqldate FROM fx_dp_master WHERE last_call_disposition NOT IN ('Remap-DP')")
def _(fx):
    return fx.dp_master.filter(~F.col("last_call_disposition").isin(labels.DISPOSITION_REMAP)).select("dp_id", "sqldate")


@query("filter_nonblank", "SELECT quote_id, creation_date FROM fx_quotes WHERE creation_date IS NOT NULL AND trim(creation_date) <> ''")
def _(fx):
    return fx.quotes.filter(~text.is_blank(F.col("creation_date"))).select("quote_id", "creation_date")


@query("filter_mtd", "SELECT quote_id, dp_id, stage, creation_day FROM month_quotes", dates=("creation_day",))
def _(fx):
    return supply.month_quotes(fx.quotes, data_date=QUOTES_DATE)


@query("filter_error_markers", "SELECT dp_id, agent_mapped FROM fx_dp_master WHERE agent_mapped IS NOT NULL AND agent_mapped NOT IN ('#N/A','#REF!')")
def _(fx):
    return fx.dp_master.filter(~F.col("agent_mapped").isin(*labels.ERROR_MARKERS)).select("dp_id", "agent_mapped")


@query("filter_snapshot", "SELECT dp_id, agent_mapped, sqldate FROM fx_dp_master WHERE sqldate = '2023-12-31'")
def _(fx):
    day = dates.iso_text(dates.prev_month_end(dates.as_date(QUOTES_DATE)))
    return fx.dp_master.filter(F.col("sqldate") == day).select("dp_id", "agent_mapped", "sqldate")


@query("parse_mixed_date", f"SELECT quote_id, {MIXED_CREATION} AS creation_day, {MIXED_UPDATE} AS update_day FROM fx_quotes",
       dates=("creation_day", "update_day"))
def _(fx):
    return fx.quotes.select(
        "quote_id",
        dates.parse_mixed_date(F.col("creation_date")).alias("creation_day"),
        dates.parse_mixed_date(F.col("last_update_date")).alias("update_day"),
    )


@query("classify_status", "SELECT login_id, client_status FROM status_flag")
def _(fx):
    rows = joins.join_partner_policy(status.filter_policy(fx.policy), joins.semi_partner_ids(fx.partner, cleaned(fx)))
    flag = classify.classify_status(
        F.col("first_sale_date"),
        F.lit(CUTOFFS["already_before"]).cast("timestamp_ntz"),
        dates.month_start(dates.as_date(REPORT_DATE)).cast("timestamp_ntz"),
    )
    return aggregates.first_sale(rows).select("login_id", flag.alias("client_status"))


@query("classify_category", "SELECT dp_id, category_type FROM agent_quotes")
def _(fx):
    return supply.agent_quotes(fx.quotes, fx.dp_master, data_date=QUOTES_DATE).select("dp_id", "category_type")


@query("classify_team", "SELECT m.dp_id, m.sqldate, coalesce(r.team, 'unknown') AS team FROM fx_dp_master m LEFT JOIN fx_roster r ON r.email = m.agent_mapped")
def _(fx):
    return joins.with_team(fx.dp_master, fx.roster, "agent_mapped").select("dp_id", "sqldate", "team")


NATION_TOTALS = "SELECT n_nationkey, COUNT(o_orderkey) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'P') - (n_nationkey % 3) * 1000 AS d FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY n_nationkey"


def _nation_totals(fx: Fixtures) -> DataFrame:
    """Counts with positive, zero-crossing and negative denominators."""
    c, o = fx.table("customer").select("c_custkey", "c_nationkey"), fx.table("orders").select("o_custkey", "o_orderstatus")
    grouped = c.join(o, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("n_nationkey"))
    pending = F.count_if(F.col("o_orderstatus") == "P") - F.col("n_nationkey") % 3 * 1000
    return grouped.agg(F.count(F.lit(1)).alias("n"), pending.alias("d"))


@query("safe_rate", f"SELECT *, CASE WHEN d > 0 THEN CAST(n AS DOUBLE) / CAST(d AS DOUBLE) ELSE 0.0 END AS rate FROM ({NATION_TOTALS}) t", rates=("rate",))
def _(fx):
    return _nation_totals(fx).withColumn("rate", numbers.safe_rate(F.col("n"), F.col("d")))


@query("safe_rate_one", f"SELECT *, CAST(n AS DOUBLE) / CASE WHEN z = 0 THEN 1 ELSE CAST(z AS DOUBLE) END AS rate FROM (SELECT *, d * (n_nationkey % 2) AS z FROM ({NATION_TOTALS}) t) t2", rates=("rate",))
def _(fx):
    rows = _nation_totals(fx).withColumn("z", F.col("d") * (F.col("n_nationkey") % 2))
    return rows.withColumn("rate", numbers.safe_rate_one(F.col("n"), F.col("z")))


CALENDAR_COLUMNS = {
    "month_start": ("CAST(date_trunc('month', sale_date) AS DATE)", dates.month_start, True),
    "prev_month_end": ("CAST(date_trunc('month', sale_date) AS DATE) - 1", dates.prev_month_end, True),
    "month_end": ("last_day(sale_date)", dates.month_end, True),
    "week_start": ("CAST(date_trunc('week', sale_date) AS DATE)", dates.week_start, True),
    "month_key": ("strftime(sale_date, '%Y-%m')", dates.month_key, False),
    "month_name": ("monthname(sale_date)", dates.month_name, False),
}


def _register_calendar(name: str, sql: str, function, is_date: bool) -> None:
    @query(name, f"SELECT row_seq, sale_date, {sql} AS {name} FROM fx_sales", dates=("sale_date", name) if is_date else ("sale_date",))
    def _(fx):
        return fx.sales.select("row_seq", "sale_date", function(F.col("sale_date")).alias(name))


for _name, (_sql, _function, _is_date) in CALENDAR_COLUMNS.items():
    _register_calendar(_name, _sql, _function, _is_date)


@query("date_shift", "SELECT row_seq, sale_date + 6 AS week_end, sale_date - 1 AS day_before FROM fx_sales", dates=("week_end", "day_before"))
def _(fx):
    day = F.col("sale_date")
    return fx.sales.select(
        "row_seq", dates.date_shift(day, 6).alias("week_end"), dates.date_shift(day, -1).alias("day_before")
    )


@query("status_param_sql", "SELECT * FROM dp_status", doubles=("total_netpremium",))
def _(fx):
    return status.status_param_sql(fx.spark, fx.partner, fx.policy, unique(fx), **CUTOFFS)


@query("run_mode_tag", """
SELECT sale_date, COUNT(*) AS n_rows, 'MANUAL' AS manual, 'CATCH-UP' AS catch_up, 'REGULAR' AS regular FROM fx_sales GROUP BY sale_date
""", dates=("sale_date",))
def _(fx):
    modes = [
        F.lit(classify.run_mode("June Sale", "15-Jun-1998", None)).alias("manual"),
        F.lit(classify.run_mode(None, None, "May")).alias("catch_up"),
        F.lit(classify.run_mode(None, None, None)).alias("regular"),
    ]
    return fx.sales.groupBy("sale_date").agg(F.count(F.lit(1)).alias("n_rows")).select("*", *modes)


@query("quote_id_list", "SELECT DISTINCT concat('''', dp_id, '''') AS quoted_id FROM sales_clean WHERE dp_id IS NOT NULL")
def _(fx):
    ids = cleaned(fx).filter(F.col("dp_id").isNotNull())
    return ids.select(text.quoted(F.col("dp_id")).alias("quoted_id")).distinct()


@query("cast_quote_month", "SELECT dp_id, strftime(CAST(quote_month AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS quote_month FROM dp_month")
def _(fx):
    return supply.agent_quotes(fx.quotes, fx.dp_master, data_date=QUOTES_DATE).select(
        "dp_id", F.col("quote_month").cast("timestamp_ntz").alias("quote_month")
    )


@query("tokenize_subject", """
SELECT message_id, unnest(list_filter(string_split(lower(replace(subject, '''', '')), ' '), lambda w: w <> '')) AS token FROM fx_messages
""")
def _(fx):
    return fx.messages.select("message_id", F.explode(text.tokenize_subject(F.col("subject"))).alias("token"))


# --- joins -----------------------------------------------------------------------------------
@query("semi_partner_ids", "SELECT dpno, partner_id FROM fx_partner WHERE dpno IN (SELECT dp_id FROM sales_unique WHERE dp_id IS NOT NULL)")
def _(fx):
    return joins.semi_partner_ids(fx.partner, unique(fx)).select("dpno", "partner_id")


@query("join_partner_policy", "SELECT p.policy_id, p.login_id, c.dpno FROM fx_policy p JOIN fx_partner c ON c.partner_id = p.login_id")
def _(fx):
    return joins.join_partner_policy(fx.policy, fx.partner).select("policy_id", "login_id", "dpno")


@query("join_first_sale", """
SELECT p.policy_id, p.login_id, strftime(f.first_sale_date, '%Y-%m-%d %H:%M:%S') AS first_sale_date FROM fx_policy p
JOIN (SELECT login_id, MIN(created_at) AS first_sale_date FROM fx_policy GROUP BY login_id) f ON f.login_id = p.login_id
""")
def _(fx):
    return joins.join_first_sale(fx.policy).select("policy_id", "login_id", "first_sale_date")


@query("enrich_status", "SELECT row_seq, dp_id, dp_status FROM sales_enriched")
def _(fx):
    return joins.enrich_status(cleaned(fx), status_of(fx)).select("row_seq", "dp_id", "dp_status")


def _doubled_status(fx: Fixtures) -> DataFrame:
    """Every third partner with a second login."""
    single = status_of(fx)
    second = single.filter(F.col("dpno").cast("bigint") % 3 == 0).withColumn("login_id", F.concat("login_id", F.lit("b")))
    return single.unionByName(second)


@query("enrich_status_raw", """
SELECT s.row_seq, s.dp_id, coalesce(l.client_status, 'Inactive') AS dp_status FROM sales_clean s LEFT JOIN (
  SELECT * FROM dp_status UNION ALL SELECT * FROM dp_status WHERE CAST(dpno AS BIGINT) % 3 = 0) l ON l.dpno = s.dp_id
""")
def _(fx):
    return joins.enrich_status_raw(cleaned(fx), _doubled_status(fx)).select("row_seq", "dp_id", "dp_status")


@query("join_dp_details", "SELECT * FROM dp_details", dates=("quote_month", "first_sale_done"))
def _(fx):
    latest = windows.latest_quote_stage(supply.month_quotes(fx.quotes, data_date=QUOTES_DATE))
    per_dp = aggregates.quotes_per_dp_month(latest.withColumn("quote_month", dates.month_start(F.col("creation_day"))))
    return joins.join_dp_details(per_dp, windows.latest_dp_snapshot(fx.dp_master), windows.first_sale_done(fx.quotes))


@query("outer_num_den", "SELECT * FROM outer_nd")
def _(fx):
    return joins.outer_num_den(
        metrics.email_counts(unique_enriched(fx), fx.roster, fx.override),
        aggregates.supply_by_agent(day_supply(fx)),
        aggregates.pool_by_agent(day_pool(fx)),
    )


@query("map_lookup", """
SELECT n.row_seq, n.clean_name, coalesce(m.email, 'Unmapped') AS email, coalesce(r.team, 'unknown') AS team FROM named_sales n
LEFT JOIN fuzzy_map m ON m.clean_name = n.clean_name LEFT JOIN fx_roster r ON r.email = m.email
""")
def _(fx):
    rows = fx.sales.select("row_seq", text.clean_name(F.col("bdm_name")).alias("clean_name"))
    return fuzzy.map_lookup(rows, fx.roster, fx.override, spread_by="row_seq")


@query("left_map_denominators", """
SELECT n.email, act_num, fav_num, con_num, coalesce(act_den, 0) AS act_den, coalesce(fav_den, 0) AS fav_den FROM numerators n
LEFT JOIN act_dens a ON a.agent_mapped = n.email LEFT JOIN fav_dens f ON f.agent_mapped = n.email
""")
def _(fx):
    return joins.left_map_denominators(
        metrics.email_counts(unique_enriched(fx), fx.roster, fx.override),
        aggregates.supply_by_agent(day_supply(fx)),
        aggregates.pool_by_agent(day_pool(fx)),
    )


@query("fuzzy_map", "SELECT * FROM fuzzy_map")
def _(fx):
    names = fx.sales.select(text.clean_name(F.col("bdm_name")).alias("clean_name"))
    return fuzzy.fuzzy_map(names, fx.roster, fx.override)


@query("fuzzy_map_wide", "SELECT * FROM wide_map")
def _(fx):
    names = fx.wide_names.select(text.clean_name(F.col("bdm_name")).alias("clean_name"))
    return fuzzy.fuzzy_map(names, fx.wide_roster, fx.override, pack_size=64)


@query("range_join_period", "SELECT s.row_seq, d.snapshot_date, d.period_start FROM rate_master s JOIN deltas d ON s.sale_date BETWEEN d.period_start AND d.snapshot_date",
       dates=("snapshot_date", "period_start"))
def _(fx):
    periods = windows.supply_delta(aggregates.snapshot_totals(fx.supply))
    return joins.range_join_period(cleaned(fx), periods).select("row_seq", "snapshot_date", "period_start")


@query("asof_supply", "SELECT week_start, mtd_end - mtd_before AS act_den FROM week_supply", dates=("week_start",))
def _(fx):
    weeks = fx.sales.select(dates.week_start(F.col("sale_date")).alias("week_start")).distinct()
    return rates.weekly_supply(weeks, fx.supply)


@query("month_pool", "SELECT * FROM pools", dates=("month_first",))
def _(fx):
    return joins.month_pool(fx.fav_pool)


@query("anti_replace", "SELECT snapshot_date, agent_mapped, sum_inactive_dps_creating_quotes FROM fx_supply WHERE snapshot_date NOT IN (SELECT snapshot_date FROM fx_fav_pool)",
       dates=("snapshot_date",))
def _(fx):
    return joins.anti_replace(fx.supply, fx.fav_pool, "snapshot_date")


# --- aggregations --------------------------------------------------------------------------------
@query("first_sale", "SELECT login_id, strftime(MIN(created_at), '%Y-%m-%d %H:%M:%S') AS first_sale_date FROM fx_policy GROUP BY login_id")
def _(fx):
    return aggregates.first_sale(fx.policy)


@query("policy_totals", "SELECT login_id, vertical, COUNT(DISTINCT policy_id) AS policy_count, SUM(net_premium) AS total_netpremium FROM fx_policy GROUP BY 1, 2",
       doubles=("total_netpremium",))
def _(fx):
    return aggregates.policy_totals(fx.policy, ["login_id", "vertical"])


@query("favourite_count", "SELECT agent_mapped, COUNT(dp_id) AS dp_count FROM fav_rows GROUP BY agent_mapped")
def _(fx):
    return aggregates.favourite_count(supply.favourite_rows(fx.dp_master, data_date=QUOTES_DATE))


@query("quotes_per_dp_month", f"SELECT dp_id, CAST(date_trunc('month', d) AS DATE) AS quote_month, COUNT(*) AS quotes_count FROM (SELECT dp_id, {MIXED_CREATION} AS d FROM fx_quotes) t GROUP BY 1, 2",
       dates=("quote_month",))
def _(fx):
    day = dates.parse_mixed_date(F.col("creation_date"))
    return aggregates.quotes_per_dp_month(fx.quotes.select("dp_id", dates.month_start(day).alias("quote_month")))


@query("distinct_dps_by_agent", "SELECT * FROM agent_supply", dates=("quote_month",))
def _(fx):
    return aggregates.distinct_dps_by_agent(supply.agent_quotes(fx.quotes, fx.dp_master, data_date=QUOTES_DATE))


@query("supply_resum", "SELECT quote_month, agent_mapped, SUM(inactive_dps_creating_quotes) AS sum_inactive_dps_creating_quotes FROM agent_supply GROUP BY 1, 2",
       dates=("quote_month",))
def _(fx):
    return supply.inactive_supply(fx.quotes, fx.dp_master, data_date=QUOTES_DATE, drop_markers=False)


@query("email_numerators", "SELECT * FROM numerators")
def _(fx):
    return metrics.email_counts(unique_enriched(fx), fx.roster, fx.override)


@query("den_by_agent", """
SELECT coalesce(a.agent_mapped, f.agent_mapped) AS agent_mapped, act_den, fav_den FROM
  (SELECT agent_mapped, SUM(sum_inactive_dps_creating_quotes) AS act_den FROM fx_supply WHERE agent_mapped IS NOT NULL GROUP BY 1) a
FULL JOIN (SELECT agent_mapped, SUM(dp_count) AS fav_den FROM fx_fav_pool WHERE agent_mapped IS NOT NULL GROUP BY 1) f ON f.agent_mapped = a.agent_mapped
""")
def _(fx):
    return aggregates.supply_by_agent(fx.supply).join(aggregates.pool_by_agent(fx.fav_pool), "agent_mapped", "full")


@query("team_rollup", with_rates("team_counts"), rates=RATES)
def _(fx):
    return aggregates.team_rollup(by_email(fx))


@query("overall_row", with_rates("overall"), rates=RATES)
def _(fx):
    return aggregates.overall_row(unique_enriched(fx), day_supply(fx), day_pool(fx))


AVERAGES = ("avg_premium_inactive", "avg_premium_fav", "nop_per_dp_inactive", "nop_per_dp_fav")


@query("premium_stats", "SELECT * FROM premium_rates", rates=AVERAGES)
def _(fx):
    return aggregates.premium_stats(enriched(fx))


@query("max_date", "SELECT MAX(sale_date) AS data_date FROM fx_sales", dates=("data_date",))
def _(fx):
    return aggregates.max_date(fx.sales)


@query("unique_dps_first", "SELECT row_seq, sale_date, bdm_name, net_premium, dp_id FROM sales_unique", dates=("sale_date",))
def _(fx):
    return windows.unique_dps_first(cleaned(fx))


@query("dedup_keep_last", "SELECT batch_seq, row_seq, dp_id, dp_status FROM master")
def _(fx):
    first, second = two_batches(fx)
    both = first.withColumn("batch_seq", F.lit(1)).unionByName(second.withColumn("batch_seq", F.lit(2)))
    both = both.withColumn("net_premium", numbers.coerce_number(F.col("net_premium")))
    return windows.dedup_keep_last(both).select("batch_seq", "row_seq", "dp_id", "dp_status")


@query("distinct_values", "SELECT DISTINCT dp_id FROM sales_clean")
def _(fx):
    return aggregates.distinct_values(cleaned(fx), "dp_id")


@query("period_distinct", "SELECT * FROM period_counts", dates=("snapshot_date",))
def _(fx):
    return rates.period_sales(rate_master(fx), fx.supply)


@query("week_distinct", "SELECT * FROM week_counts", dates=("week_start",))
def _(fx):
    return rates.week_sales(rate_master(fx))


@query("snapshot_totals", "SELECT * FROM totals", dates=("snapshot_date",))
def _(fx):
    return aggregates.snapshot_totals(fx.supply)


@query("batch_quality", """
SELECT (SELECT COUNT(*) FROM collate_rows) AS rows_in, (SELECT COUNT(*) FROM collate_rows) - (SELECT COUNT(*) FROM master) AS duplicates,
       (SELECT COUNT(*) FROM master) AS rows_out, (SELECT COUNT(DISTINCT dp_id) FROM collate_rows) AS distinct_dps
""")
def _(fx):
    first, second = two_batches(fx)
    taken = first.withColumn("net_premium", numbers.coerce_number(F.col("net_premium")))
    return sales.collation_quality(taken, second)


# --- windows ----------------------------------------------------------------------------------------
@query("latest_quote_stage", "SELECT quote_id, dp_id, stage, creation_day FROM stage_quotes", dates=("creation_day",))
def _(fx):
    return windows.latest_quote_stage(supply.month_quotes(fx.quotes, data_date=QUOTES_DATE))


@query("latest_dp_snapshot", "SELECT dp_id, agent_mapped, dp_category, sqldate FROM dp_latest")
def _(fx):
    return windows.latest_dp_snapshot(fx.dp_master)


@query("first_sale_done", "SELECT * FROM first_done", dates=("first_sale_done",))
def _(fx):
    return windows.first_sale_done(fx.quotes)


@query("supply_delta", "SELECT * FROM deltas", dates=("snapshot_date", "period_start"))
def _(fx):
    return windows.supply_delta(aggregates.snapshot_totals(fx.supply))


NUMBERED = """
SELECT row_number() OVER (ORDER BY sale_date DESC NULLS LAST, dp_id NULLS LAST, net_premium NULLS LAST) AS serial_no, {columns} FROM {source}
"""


@query("serial_no", NUMBERED.format(columns="row_seq, dp_id, sale_date", source="""
(SELECT * EXCLUDE (rn) FROM (SELECT row_seq, dp_id, sale_date, p AS net_premium, row_number() OVER (PARTITION BY dp_id, sale_date, p ORDER BY row_seq DESC) AS rn
  FROM (SELECT *, TRY_CAST(trim(net_premium) AS DECIMAL(38,10)) AS p FROM sales_clean) t) t2 WHERE rn = 1) t3"""), dates=("sale_date",))
def _(fx):
    rows = cleaned(fx).withColumn("net_premium", numbers.coerce_number(F.col("net_premium")))
    master = windows.dedup_keep_last(rows.withColumn("batch_seq", F.lit(1)))
    return sales.numbered_master(master).select("serial_no", "row_seq", "dp_id", "sale_date")


# --- order, limit, union -------------------------------------------------------------------------------
@query("order_status", "SELECT * FROM dp_status ORDER BY dpno, login_id", doubles=("total_netpremium",))
def _(fx):
    return ordering.order_status(status_of(fx))


@query("order_trend", f"SELECT * FROM ({TREND_SEED}) t ORDER BY data_date", dates=("data_date",))
def _(fx):
    return ordering.order_trend(trend_seed(fx))


@query("order_desc", "SELECT row_seq, sale_date FROM fx_sales ORDER BY sale_date DESC, row_seq", dates=("sale_date",))
def _(fx):
    return ordering.order_desc(fx.sales.select("row_seq", "sale_date"), "sale_date", "row_seq")


SUPPLY_SQL = """
SELECT quote_month, agent_mapped, SUM(inactive_dps_creating_quotes) AS sum_inactive_dps_creating_quotes FROM agent_supply
WHERE agent_mapped NOT IN ('#N/A','#REF!') GROUP BY 1, 2
"""


@query("top_supply", f"SELECT * FROM ({SUPPLY_SQL}) t ORDER BY sum_inactive_dps_creating_quotes DESC, agent_mapped, quote_month LIMIT 20", dates=("quote_month",))
def _(fx):
    return ordering.top_supply(supply.inactive_supply(fx.quotes, fx.dp_master, data_date=QUOTES_DATE), rows=20)


@query("pick_top1", """
SELECT message_id, sender, subject FROM fx_messages WHERE sender IS NOT NULL
ORDER BY contains(lower(sender), 'lead@example.com') DESC, received_at DESC, message_id DESC LIMIT 1
""")
def _(fx):
    known = fx.messages.filter(F.col("sender").isNotNull())
    return messages.pick_top1(known, PREFERRED).select("message_id", "sender", "subject")


@query("union_master", "SELECT batch_seq, row_seq, dp_id, dp_status, CAST(NULL AS VARCHAR) AS note FROM collate_rows WHERE batch_seq = 1 UNION ALL SELECT batch_seq, row_seq, dp_id, dp_status, 'late' FROM collate_rows WHERE batch_seq = 2")
def _(fx):
    first, second = two_batches(fx)
    columns = ["batch_seq", "row_seq", "dp_id", "dp_status"]
    return ordering.union_by_name(
        first.withColumn("batch_seq", F.lit(1)).select(*columns),
        second.withColumn("batch_seq", F.lit(2)).select(*reversed(columns), F.lit("late").alias("note")),
    ).select(*columns, "note")


@query("union_trend", f"SELECT * FROM ({TREND_SEED}) t UNION ALL SELECT DATE '1998-07-15', COUNT(*), 'REGULAR' FROM fx_sales WHERE sale_date <= DATE '1998-07-15'", dates=("data_date",))
def _(fx):
    day = dt.date(1998, 7, 15)
    new = fx.sales.filter(F.col("sale_date") <= F.lit(day)).agg(F.count(F.lit(1)).alias("act_numerator"))
    row = new.select("act_numerator", F.lit(MODE).alias("run_mode"), F.lit(day).alias("data_date"))
    return ordering.union_by_name(trend_seed(fx), row)


# --- reports ---------------------------------------------------------------------------------------------
@query("dp_status", "SELECT * FROM dp_status", doubles=("total_netpremium",))
def _(fx):
    return ordering.order_status(status_of(fx))


@query("fav_pool", FAV_POOL_SQL)
def _(fx):
    return supply.fav_pool(fx.dp_master, fx.roster, data_date=QUOTES_DATE)


@query("inactive_supply", SUPPLY_SQL, dates=("quote_month",))
def _(fx):
    return supply.inactive_supply(fx.quotes, fx.dp_master, data_date=QUOTES_DATE)


@query("clean_sales", """
SELECT 'health' AS sheet, row_seq, dp_id, sale_date FROM sales_clean UNION ALL SELECT 'unique', row_seq, dp_id, sale_date FROM sales_unique
""", dates=("sale_date",))
def _(fx):
    rows = cleaned(fx).select(F.lit("health").alias("sheet"), "row_seq", "dp_id", "sale_date")
    return rows.unionByName(unique(fx).select(F.lit("unique").alias("sheet"), "row_seq", "dp_id", "sale_date"))


@query("enrich_sales", """
SELECT 'health' AS sheet, row_seq, dp_id, dp_status FROM sales_enriched UNION ALL SELECT 'unique', row_seq, dp_id, dp_status FROM unique_enriched
""")
def _(fx):
    columns = ["row_seq", "dp_id", "dp_status"]
    rows = enriched(fx).select(F.lit("health").alias("sheet"), *columns)
    return rows.unionByName(unique_enriched(fx).select(F.lit("unique").alias("sheet"), *columns))


@query("email_level", with_rates("email_counts"), rates=RATES)
def _(fx):
    return by_email(fx)


@query("team_level", with_rates("team_counts"), rates=RATES)
def _(fx):
    return metrics.team_level(by_email(fx))


TREND_ROW = f"""
SELECT DATE '1998-06-15' AS data_date, act_num AS act_numerator, act_den AS act_denominator, activation_rate, fav_num AS fav_numerator,
       fav_den AS fav_denominator, favourite_rate, con_num AS con_numerator, con_den AS con_denominator, consolidated_rate,
       (SELECT avg_premium_inactive FROM premium_rates) AS avg_premium_inactive, (SELECT avg_premium_fav FROM premium_rates) AS avg_premium_fav,
       (SELECT nop_per_dp_inactive FROM premium_rates) AS nop_per_dp_inactive, (SELECT nop_per_dp_fav FROM premium_rates) AS nop_per_dp_fav,
       'REGULAR' AS run_mode
FROM ({with_rates("overall")}) o
"""


@query("trend_row", TREND_ROW, dates=("data_date",), rates=RATES + AVERAGES)
def _(fx):
    return new_trend_row(fx).drop("run_timestamp")


@query("trend_upsert", f"""
SELECT data_date, act_numerator, run_mode, CAST(NULL AS DOUBLE) AS activation_rate FROM ({TREND_SEED}) t WHERE data_date <> DATE '1998-06-15'
UNION ALL SELECT data_date, act_numerator, run_mode, activation_rate FROM ({TREND_ROW}) n
""", dates=("data_date",), rates=("activation_rate",))
def _(fx):
    return metrics.trend_upsert(trend_seed(fx), new_trend_row(fx), data_date=REPORT_DATE).select(
        "data_date", "act_numerator", "run_mode", "activation_rate"
    )


def folded(fx: Fixtures, path: str, *deliveries: DataFrame) -> tuple[storage.MonthlyTable, list[storage.Fold]]:
    """A kept master that has taken the deliveries in, one fold each."""
    master, names = sales.master_table(fx.spark, f"{path}/master"), directory.NameDirectory(fx.spark, f"{path}/names")
    folds = [
        sales.fold_sales(master, rows, fx.roster, fx.override, batch_seq=seq, names=names)
        for seq, rows in enumerate(deliveries, 1)
    ]
    return master, folds


@query("collate_master", NUMBERED.format(columns="sale_date, bdm_name, dp_id, net_premium, dp_status, team", source="master"),
       dates=("sale_date",), doubles=("net_premium",))
def _(fx):
    """A master built at once from two overlapping deliveries, whose names are matched together."""
    first, second = (rows.withColumn("batch_seq", F.lit(seq)) for seq, rows in enumerate(written_batches(fx), 1))
    nothing = fx.spark.createDataFrame([], schemas.MASTER)
    master = sales.collate_master(nothing, first.unionByName(second), fx.roster, fx.override, batch_seq=F.col("batch_seq"))
    return sales.numbered_master(master).drop("batch_seq", "row_seq")


LATE = "sale_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-31'"


@query("serial_no_incremental", NUMBERED.format(columns="row_seq, dp_id, sale_date, dp_status", source=f"""
(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dp_id, sale_date, net_premium ORDER BY batch_seq DESC, row_seq DESC) AS rn FROM (
  SELECT * FROM collate_rows UNION ALL SELECT 3, * REPLACE ('Inactive' AS dp_status) FROM daily_all WHERE {LATE}) a) t WHERE rn = 1) m"""), dates=("sale_date",))
def _(fx):
    """A late delivery of one old month: only that month is placed anew, and every number is right."""
    late = written_sales(fx).filter(F.expr(LATE)).withColumn("dp_status", F.lit(labels.STATUS_INACTIVE))
    master, _ = folded(fx, storage.fresh_path(fx.spark, "serial_no_incremental"), *written_batches(fx), late)
    return master.numbered().select("serial_no", "row_seq", "dp_id", "sale_date", "dp_status")


@query("run_collation_counts", """
SELECT v.version, v.rows_batch, v.rows_in, v.rows_in - v.rows_out AS duplicates, v.rows_out FROM (
  SELECT 1 AS version, n1 AS rows_batch, n1 AS rows_in, o1 AS rows_out FROM c UNION ALL SELECT 2, n2, o1 + n2, o2 FROM c UNION ALL SELECT 3, n2, o2 + n2, o2 FROM c) v
""".replace(" FROM c", """ FROM (SELECT (SELECT COUNT(*) FROM collate_rows WHERE batch_seq = 1) AS n1, (SELECT COUNT(*) FROM collate_rows WHERE batch_seq = 2) AS n2,
  (SELECT COUNT(*) FROM (SELECT DISTINCT dp_id, sale_date, net_premium FROM collate_rows WHERE batch_seq = 1) d) AS o1, (SELECT COUNT(*) FROM master) AS o2) c"""))
def _(fx):
    """A first run, one that overlaps it, and the overlapping batch once more."""
    first, second = written_batches(fx)
    master, _ = folded(fx, storage.fresh_path(fx.spark, "run_collation_counts"), first, second, second)
    return sales.collation_counts(master).drop("stream_id", "batch_id")


RATE_COLUMNS = "act_num, fav_num, con_num, act_den, fav_den, act_den + fav_den AS con_den"


@query("period_rates", with_rates(f"""(
SELECT d.snapshot_date, d.period_start, coalesce(c.act_num, 0) AS act_num, coalesce(c.fav_num, 0) AS fav_num, coalesce(c.con_num, 0) AS con_num,
       d.act_den, coalesce(p.fav_den, 0) AS fav_den, d.act_den + coalesce(p.fav_den, 0) AS con_den
FROM deltas d LEFT JOIN period_counts c ON c.snapshot_date = d.snapshot_date
LEFT JOIN pools p ON p.month_first = CAST(date_trunc('month', d.snapshot_date) AS DATE)) t"""),
       dates=("snapshot_date", "period_start"), rates=RATES)
def _(fx):
    return rates.period_rates(rate_master(fx), fx.supply, fx.fav_pool)


@query("weekly_rates", with_rates("""(
SELECT c.week_start, c.act_num, c.fav_num, c.con_num, w.mtd_end - w.mtd_before AS act_den, coalesce(p.fav_den, 0) AS fav_den,
       w.mtd_end - w.mtd_before + coalesce(p.fav_den, 0) AS con_den
FROM week_counts c JOIN week_supply w ON w.week_start = c.week_start
LEFT JOIN pools p ON p.month_first = CAST(date_trunc('month', c.week_start) AS DATE)
WHERE NOT (w.mtd_end - w.mtd_before = 0 AND c.act_num = 0)) t"""), dates=("week_start",), rates=RATES)
def _(fx):
    return rates.weekly_rates(rate_master(fx), fx.supply, fx.fav_pool)


def kept_presence(fx: Fixtures, name: str) -> presence.Presence:
    """The day bitmaps of two deliveries, the second taken over for its months only."""
    path = storage.fresh_path(fx.spark, name)
    master, kept = sales.master_table(fx.spark, f"{path}/master"), presence.Presence(fx.spark, path)
    names = directory.NameDirectory(fx.spark, f"{path}/names")
    for seq, rows in enumerate(written_batches(fx), 1):
        fold = sales.fold_sales(master, rows, fx.roster, fx.override, batch_seq=seq, names=names)
        kept.refresh(master, fold.months)
    return kept


@query("kept_period_rates", with_rates("""(
SELECT d.snapshot_date, d.period_start, coalesce(c.act_num, 0) AS act_num, coalesce(c.fav_num, 0) AS fav_num, coalesce(c.con_num, 0) AS con_num,
       d.act_den, coalesce(p.fav_den, 0) AS fav_den, d.act_den + coalesce(p.fav_den, 0) AS con_den
FROM deltas d LEFT JOIN kept_period_counts c ON c.snapshot_date = d.snapshot_date
LEFT JOIN pools p ON p.month_first = CAST(date_trunc('month', d.snapshot_date) AS DATE)) t"""),
       dates=("snapshot_date", "period_start"), rates=RATES)
def _(fx):
    return rates.kept_period_rates(kept_presence(fx, "kept_period_rates"), fx.supply, fx.fav_pool)


@query("kept_weekly_rates", with_rates("""(
SELECT c.week_start, c.act_num, c.fav_num, c.con_num, w.mtd_end - w.mtd_before AS act_den, coalesce(p.fav_den, 0) AS fav_den,
       w.mtd_end - w.mtd_before + coalesce(p.fav_den, 0) AS con_den
FROM kept_week_counts c JOIN kept_week_supply w ON w.week_start = c.week_start
LEFT JOIN pools p ON p.month_first = CAST(date_trunc('month', c.week_start) AS DATE)
WHERE NOT (w.mtd_end - w.mtd_before = 0 AND c.act_num = 0)) t"""), dates=("week_start",), rates=RATES)
def _(fx):
    return rates.kept_weekly_rates(kept_presence(fx, "kept_weekly_rates"), fx.supply, fx.fav_pool)


def deliver(rows: DataFrame, folder: str) -> None:
    """One file, as a delivery is, in row groups that several tasks can read."""
    one = rows.select(*schemas.SALES_ENRICHED.names).repartition(1)
    one.write.mode("append").option("parquet.block.size", 16 << 20).parquet(folder)


@query("stream_collate", """
SELECT sale_date, bdm_name, dp_id, net_premium, dp_status, team FROM (
  SELECT *, row_number() OVER (PARTITION BY dp_id, sale_date, net_premium ORDER BY batch_seq DESC, row_seq DESC) AS rn FROM (
    SELECT * FROM collate_rows UNION ALL SELECT 3, * REPLACE ('Inactive' AS dp_status) FROM daily_all WHERE row_seq % 13 = 0) a) t
WHERE rn = 1
""", dates=("sale_date",), doubles=("net_premium",))
def _(fx):
    """Two overlapping deliveries in one trigger, then a third by a stream with a checkpoint of its own."""
    first, second = written_batches(fx)
    third = written_sales(fx).filter(F.col("row_seq") % 13 == 0).withColumn("dp_status", F.lit(labels.STATUS_INACTIVE))
    path = storage.fresh_path(fx.spark, "stream_collate")
    master = sales.master_table(fx.spark, f"{path}/master")
    for stream, deliveries in enumerate([(first, second), (third,)]):
        for rows in deliveries:
            deliver(rows, f"{path}/in{stream}")
        arriving = collation.read_batches(fx.spark, f"{path}/in{stream}")
        collation.collate_stream(arriving, master, fx.roster, fx.override, f"{path}/checkpoint{stream}").awaitTermination()
    return master.read().select("sale_date", "bdm_name", "dp_id", "net_premium", "dp_status", "team")


class FailingOnce(storage.VersionedTable):
    """A table whose first write is lost, as if the job had died before it."""

    failed = False

    def write(self, *args):
        if not self.failed:
            self.failed = True
            raise RuntimeError("interrupted between two commits")
        return super().write(*args)


@query("stream_trend", """
SELECT d.data_date, u.act_numerator, u.fav_numerator, u.con_numerator, (SELECT SUM(sum_inactive_dps_creating_quotes) FROM fx_supply WHERE snapshot_date = d.supply_day) AS act_denominator,
       (SELECT SUM(dp_count) FROM fx_fav_pool WHERE snapshot_date = d.pool_day) AS fav_denominator, 'REGULAR' AS run_mode, (SELECT COUNT(*) FROM master) AS master_rows
FROM stream_days d JOIN (SELECT delivery, COUNT(*) FILTER (WHERE dp_status = 'Inactive') AS act_numerator,
  COUNT(*) FILTER (WHERE dp_status IN ('Activated by LGLC','Already Active')) AS fav_numerator, COUNT(dp_status) AS con_numerator FROM stream_unique GROUP BY delivery) u ON u.delivery = d.delivery
""", dates=("data_date",))
def _(fx):
    """Two deliveries feed master and trend. The stream dies between the first batch's commits and is started again."""
    path = storage.fresh_path(fx.spark, "stream_trend")
    master, trend = sales.master_table(fx.spark, f"{path}/master"), FailingOnce(fx.spark, f"{path}/trend", schemas.TREND)
    kept = [storage.write_table(df, f"{path}/{name}") for name, df in (("supply", fx.supply), ("pool", fx.fav_pool))]
    feed = collation.TrendFeed(trend, *[storage.read_parquet(fx.spark, at) for at in kept])  # a few rows a snapshot, read by every batch
    for rows in written_batches(fx):
        deliver(rows, f"{path}/in")
    for attempt in range(2):
        arriving = collation.read_batches(fx.spark, f"{path}/in", files_per_batch=1)
        run = collation.collate_stream(arriving, master, fx.roster, fx.override, f"{path}/checkpoint", feed=feed)
        try:
            run.awaitTermination()
        except StreamingQueryException:
            if attempt:
                raise
    names = ["data_date", "act_numerator", "fav_numerator", "con_numerator", "act_denominator", "fav_denominator", "run_mode"]
    rows = master.read().agg(F.count(F.lit(1)).alias("master_rows"))
    return trend.read().select(*names, rows.scalar().alias("master_rows"))


@query("name_directory", """
SELECT clean_name, email, best_score, CASE WHEN clean_name IN (SELECT DISTINCT clean_name FROM named_sales WHERE bdm_name < 'D') THEN 1 ELSE 2 END AS matched_in FROM fuzzy_map
UNION ALL SELECT m.clean_name, CASE WHEN m.best_score > 55 THEN s.email ELSE 'Unmapped' END, m.best_score, 3 FROM fuzzy_map m
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY clean_name ORDER BY score DESC, roster_seq) AS rn FROM fuzzy_scores) s ON s.clean_name = m.clean_name AND s.rn = 1
""")
def _(fx):
    """Names of a first batch, of a second with new ones, and all of them again after the overrides have changed."""
    kept = directory.NameDirectory(fx.spark, storage.fresh_path(fx.spark, "name_directory"))
    named = fx.sales.select("bdm_name", text.clean_name(F.col("bdm_name")).alias("clean_name"))
    every, none = named.select("clean_name").distinct(), fx.override.limit(0)
    kept.match(named.filter("bdm_name < 'D'").select("clean_name").distinct(), fx.roster, fx.override)
    kept.match(every, fx.roster, fx.override)
    kept.match(every, fx.roster, none)
    versions = [directory.roster_version(fx.roster, o) for o in (fx.override, none)]
    return kept.known(versions[0]).unionByName(kept.known(versions[1]))


def dated_files(fx: Fixtures, name: str) -> str:
    """A folder with a CSV file per snapshot of the supply; each arrived some days after its date."""
    folder = storage.fresh_path(fx.spark, name)
    batches.write_dated_csv(fx.supply, folder, "Supply")
    for row in fx.supply.select("snapshot_date").distinct().collect():  # four files a month
        arrived = row["snapshot_date"] + dt.timedelta(days=row["snapshot_date"].day * 37 % 11)
        batches.set_arrival(fx.spark, f"{folder}/Supply_{row['snapshot_date']}.csv", arrived)
    return folder


SUPPLY_FILE = schemas.table(agent_mapped=schemas.STRING, sum_inactive_dps_creating_quotes=schemas.BIGINT)


@query("dated_csv_series", "SELECT agent_mapped, sum_inactive_dps_creating_quotes, snapshot_date FROM fx_supply WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'",
       dates=("snapshot_date",))
def _(fx):
    series = batches.read_dated_csv(fx.spark, dated_files(fx, "dated_csv_series"), SUPPLY_FILE, prefix="Supply")
    return series.filter(F.col("snapshot_date").between(F.lit("1996-01-01").cast("date"), F.lit("1997-06-30").cast("date")))


@query("latest_file", """
SELECT agent_mapped, sum_inactive_dps_creating_quotes, snapshot_date FROM fx_supply WHERE snapshot_date = (
  SELECT snapshot_date FROM fx_supply ORDER BY snapshot_date + CAST(day(snapshot_date) * 37 % 11 AS INTEGER) DESC, snapshot_date DESC LIMIT 1)
""", dates=("snapshot_date",))
def _(fx):
    return batches.read_newest_csv(fx.spark, dated_files(fx, "latest_file"), SUPPLY_FILE, prefix="Supply")


RUN_STEPS = 19


@query("run_report_tables", f"""
SELECT 'sales_clean' AS table_name, COUNT(*) AS n_rows, SUM(row_seq) AS total FROM run_sales WHERE run_no = 2
UNION ALL SELECT 'sales_unique', COUNT(*), SUM(row_seq) FROM run_unique WHERE run_no = 2
UNION ALL SELECT 'dp_status', COUNT(*), SUM(policy_count) FROM run_status
UNION ALL SELECT 'master', COUNT(*), SUM(row_seq) FROM run_master
UNION ALL SELECT 'master_report', COUNT(*), COUNT(*) * (COUNT(*) + 1) // 2 FROM run_master
UNION ALL SELECT 'collation_counts', 2, (SELECT COUNT(*) FROM run_master WHERE run_no = 1) + (SELECT COUNT(*) FROM run_master)
UNION ALL SELECT 'trend', 3, 7 + (SELECT COUNT(*) FROM run_unique)
UNION ALL SELECT 'steps', {2 * RUN_STEPS}, {2 * RUN_STEPS}
""")
def _(fx):
    """A run for a gap month that is broken off, then the same call again: it resumes, closes the gap and runs the current batch."""
    out = storage.fresh_path(fx.spark, "run_report_tables")
    seed = fx.spark.createDataFrame([(dt.date(1998, 5, 20), 7)], "data_date date, con_numerator long")
    trend = report.trend_table(fx.spark, out)
    trend.write(ordering.union_by_name(trend.read(), seed))
    day = F.col("sale_date")
    of_month = lambda month: fx.sales.filter(F.date_format(day, "yyyy-MM") == month)
    current = of_month("1998-06").filter(day <= F.lit(BATCH1_LAST).cast("date"))
    inputs = report.Inputs(current, fx.partner, fx.policy, fx.quotes, fx.dp_master, fx.roster, fx.override)
    unreadable = F.raise_error(F.concat(F.lit("interrupted at "), "policy_id")).cast("decimal(18,2)")
    broken = dataclasses.replace(inputs, policy=fx.policy.withColumn("net_premium", unreadable))
    options = report.Options(already_before=CUTOFFS["already_before"], since=CUTOFFS["since"])
    for attempt in (broken, inputs):
        try:
            report.run_with_catch_up(fx.spark, attempt, out, options, today="1998-06-16", sales_of=of_month)
        except PySparkException as error:
            if "interrupted" not in str(error):
                raise
    tables = {
        "sales_clean": (fx.spark.read.parquet(f"{out}/sales_clean"), "row_seq"),
        "sales_unique": (fx.spark.read.parquet(f"{out}/sales_unique"), "row_seq"),
        "dp_status": (fx.spark.read.parquet(f"{out}/dp_status"), "policy_count"),
        "master": (sales.master_table(fx.spark, f"{out}/master").read(), "row_seq"),
        "master_report": (report.master_report(fx.spark, out), "serial_no"),
        "collation_counts": (fx.spark.read.parquet(f"{out}/collation_counts"), "rows_out"),
        "trend": (trend.read(), "con_numerator"),
        "steps": (steps.Steps(fx.spark, out, "any").record.read(), "attempt"),
    }
    rows = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.sum(total).cast("bigint").alias("total")) for name, (df, total) in tables.items()]
    return functools.reduce(DataFrame.unionByName, rows)


@query("dp_status_few", "SELECT * FROM dp_status WHERE CAST(dpno AS INTEGER) % 20 = 3", doubles=("total_netpremium",))
def _(fx):
    """The status of a short list of partners: only their policies are aggregated."""
    few = cleaned(fx).filter(F.col("dp_id").try_cast("int") % 20 == 3)
    return status.dp_status(fx.partner, fx.policy, few, ordered=False, **CUTOFFS)


@query("enrich_status_uncleaned", "SELECT row_seq, dp_status FROM sales_enriched")
def _(fx):
    """Ids that carry the trailing .0 of a spreadsheet on the sales side."""
    raw = cleaned(fx).withColumn("dp_id", F.concat("dp_id", F.lit(".0")))
    return joins.enrich_status(raw, status_of(fx)).select("row_seq", "dp_status")


@query("enrich_fallback", "SELECT row_seq, dp_status FROM sales_enriched")
def _(fx):
    """No status snapshot of the data date: the newest one serves, not the older one of other statuses."""
    newest = status_of(fx).withColumn("snapshot_date", F.lit("1998-06-10").cast("date"))
    older = newest.withColumn("snapshot_date", F.lit("1998-05-31").cast("date")).withColumn("client_status", F.lit(labels.STATUS_INACTIVE))
    chosen = batches.snapshot_or_latest(older.unionByName(newest), REPORT_DATE)
    return sales.enrich_sales(cleaned(fx), chosen).select("row_seq", "dp_status")


@query("roster_duplicates", "SELECT row_seq, team FROM daily_all")
def _(fx):
    """Roster and overrides listed twice: the later entry of an e-mail counts, and no sale is multiplied."""
    older = fx.roster.withColumn("roster_seq", F.col("roster_seq") - 100).withColumn("team", F.lit("former"))
    roster, override = fx.roster.unionByName(older), fx.override.unionByName(fx.override)
    return sales.daily_rows(enriched(fx), roster, override, batch_seq=1).select("row_seq", "team")


@query("month_gap", "SELECT MAX(sale_date) AS last_date, monthname(MAX(sale_date)) AS missing_month FROM fx_sales", dates=("last_date",))
def _(fx):
    trend = fx.sales.groupBy(F.col("sale_date").alias("data_date")).agg(F.count(F.lit(1)).alias("act_numerator"))
    return metrics.month_gap(trend, today="2001-09-01")
