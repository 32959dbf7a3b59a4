"""A whole run: from a sales batch to rates, one table after the other.

Every table that later steps share is written once and read back, so nothing is computed
twice and a lost executor costs one step at most. Steps that are done are recorded: a run that
broke off goes on behind them, with the batch it began with.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.dates import month_key
from ..operators.aggregates import max_date
from ..sources import storage
from ..sources.batches import snapshot_or_latest
from ..sources.schemas import TREND
from . import metrics, rates, sales, status, supply
from .directory import NameDirectory
from .presence import Presence
from .steps import Steps


@dataclass(frozen=True)
class Inputs:
    """The tables a run reads."""

    sales: DataFrame
    partner: DataFrame
    policy: DataFrame
    quotes: DataFrame
    dp_master: DataFrame
    roster: DataFrame
    overrides: DataFrame


@dataclass(frozen=True)
class Options:
    """Cut-offs and mode of a run; the data date is the newest sale unless given."""

    data_date: str | None = None
    already_before: str = labels.ALREADY_ACTIVE_BEFORE
    since: str = labels.POLICIES_SINCE
    mode: str = "REGULAR"
    as_of: str | None = None


def _series(spark: SparkSession, path: str, part: DataFrame, data_date: str) -> DataFrame:
    """The dated series that a snapshot of this data date belongs to."""
    dated = part.withColumn("snapshot_date", F.lit(data_date).cast("date"))
    return spark.read.schema(dated.schema).option("basePath", path).parquet(path)


def trend_table(spark: SparkSession, out: str) -> storage.VersionedTable:
    return storage.VersionedTable(spark, f"{out}/trend", TREND)


def run_report(spark: SparkSession, inputs: Inputs, out: str, options: Options = Options()) -> str:
    """Run all reports of a batch into the folder ``out``; returns the data date.

    A run is named by data date and mode. If one of that name broke off, its done steps are read.
    """
    newest = None if options.data_date else max_date(inputs.sales).first()["data_date"]
    if newest is None and options.data_date is None:
        raise ValueError("the batch has no dated sale: give a data date")
    data_date = options.data_date or newest.isoformat()
    steps = Steps(spark, out, f"{data_date} {options.mode}")
    on_day = F.col("snapshot_date") == F.lit(data_date).cast("date")

    cleaned = steps.table("sales_clean", f"{out}/sales_clean", lambda: sales.clean_sales(inputs.sales))
    first_rows = steps.table("sales_unique", f"{out}/sales_unique", lambda: sales.unique_sales(cleaned))

    def dated(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        part = steps.table(name, f"{out}/{name}/snapshot_date={data_date}", build)
        return _series(spark, f"{out}/{name}", part, data_date)

    cutoffs = {"data_date": data_date, "already_before": options.already_before, "since": options.since}
    all_statuses = dated("dp_status", lambda: status.dp_status(inputs.partner, inputs.policy, first_rows, ordered=False, **cutoffs))
    statuses = snapshot_or_latest(all_statuses, data_date)
    supplies = dated(
        "inactive_supply",
        lambda: supply.inactive_supply(inputs.quotes, inputs.dp_master, data_date=data_date, as_of=options.as_of),
    )
    pools = dated("fav_pool", lambda: supply.fav_pool(inputs.dp_master, inputs.roster, data_date=data_date))

    health = steps.table("enriched_sales", f"{out}/enriched/sales", lambda: sales.enrich_sales(cleaned, statuses))
    steps.table("enriched_audit", f"{out}/enriched/dp_status_data", lambda: statuses)
    unique = steps.table("enriched_unique", f"{out}/enriched/unique", lambda: sales.enrich_unique(first_rows, statuses))

    master, presence = sales.master_table(spark, f"{out}/master"), Presence(spark, f"{out}/presence")
    names = NameDirectory(spark, f"{out}/names")

    def fold() -> None:
        if not master.has_batch(steps.stream_id, steps.attempt):
            seq = master.last_seq() + 1
            sales.fold_sales(
                master, health, inputs.roster, inputs.overrides, batch_seq=seq, names=names,
                stream_id=steps.stream_id, batch_id=steps.attempt,
            )

    def take_over() -> None:
        months = health.select(master.month.alias("month")).distinct().collect()
        presence.refresh(master, {r["month"] for r in months})

    steps.once("master", fold)
    steps.once("presence", take_over)
    steps.table("collation_counts", f"{out}/collation_counts", lambda: sales.collation_counts(master))

    day_supply, day_pool = supplies.filter(on_day), pools.filter(on_day)
    row = steps.table(
        "trend_row",
        f"{out}/trend_row",
        lambda: metrics.trend_row(unique, health, day_supply, day_pool, data_date=data_date, mode=options.mode),
    )
    trend = trend_table(spark, out)

    def put_in() -> None:
        if not trend.has_batch(steps.stream_id, steps.attempt):
            upserted = metrics.trend_upsert(trend.read(), row, data_date=data_date)
            trend.write(upserted, steps.stream_id, steps.attempt)

    steps.once("trend", put_in)
    place = f"data_date={data_date}/run_mode={options.mode}"
    by_email = steps.table(
        "email_level",
        f"{out}/breakdown/email_level/{place}",
        lambda: metrics.email_level(unique, day_supply, day_pool, inputs.roster, inputs.overrides, names),
    )
    steps.table("team_level", f"{out}/breakdown/team_level/{place}", lambda: metrics.team_level(by_email))
    steps.table("summary", f"{out}/breakdown/summary/{place}", lambda: row.drop("data_date", "run_mode"))

    steps.table("daily_rates", f"{out}/daily_rates", lambda: rates.kept_period_rates(presence, supplies, pools))
    steps.table("weekly_rates", f"{out}/weekly_rates", lambda: rates.kept_weekly_rates(presence, supplies, pools))
    steps.finish()
    return data_date


def master_report(spark: SparkSession, out: str) -> DataFrame:
    """The master of a run's folder as reported: newest first, with serial numbers."""
    return sales.master_table(spark, f"{out}/master").numbered()


def run_with_catch_up(
    spark: SparkSession,
    inputs: Inputs,
    out: str,
    options: Options = Options(),
    *,
    today: str,
    sales_of: Callable[[str], DataFrame],
) -> list[str]:
    """run_report, and before it a run for a month whose end the trend never reached; returns the data dates.

    ``sales_of`` gives the sales of a month (``yyyy-MM``). A month without any is left open.
    """
    days = []
    gap = metrics.month_gap(trend_table(spark, out).read(), today=today).select(month_key(F.col("last_date")).alias("month")).first()
    if gap is not None:
        missing = sales_of(gap["month"])
        if max_date(missing).first()["data_date"] is not None:
            days.append(run_report(spark, replace(inputs, sales=missing), out, replace(options, mode=labels.RUN_MODES[1], data_date=None)))
    return [*days, run_report(spark, inputs, out, options)]
