"""What Spark makes of the queries."""

import pytest

from checks.registry import QUERIES
from tallyloom.operators import windows
from tallyloom.plans import status, supply

from .conftest import SF_DIR


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["email_level", "trend_row", "period_rates", "weekly_rates", "fuzzy_map_wide", "inactive_supply", "dp_status", "dedup_keep_last"])
def test_no_cross_joins(spark, name):
    plan = physical(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_first_row_choices_are_cut_before_the_shuffle(fx):
    for df in (windows.unique_dps_first(fx.sales), windows.latest_dp_snapshot(fx.dp_master)):
        assert "WindowGroupLimit" in physical(df) and "Partial" in physical(df)


def test_filters_reach_the_scan(spark, fx, tmp_path):
    fx.policy.write.parquet(str(tmp_path / "policy"))
    plan = physical(status.filter_policy(spark.read.parquet(str(tmp_path / "policy"))).select("policy_id"))
    assert "EqualTo(vertical,HEALTH)" in plan and "In(businesstype, [NEW,PORTABILITY])" in plan
    assert "ReadSchema: struct<policy_id:string,vertical:string,businesstype:string>" in plan


def test_one_snapshot_partition_is_read(spark, fx, tmp_path):
    fx.dp_master.write.partitionBy("sqldate").parquet(str(tmp_path / "dp"))
    # Partition values look like dates; the schema keeps the snapshot key as text.
    table = spark.read.schema(fx.dp_master.schema).parquet(str(tmp_path / "dp"))
    plan = physical(supply.favourite_rows(table, data_date="2024-01-31"))
    assert "(sqldate" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "2023-12-31" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def scans(plan, table):
    return plan.count(f"/{table}.parquet")


def test_statuses_read_partners_once_and_orders_twice(spark):
    plan = physical(QUERIES["dp_status"](spark, SF_DIR))
    assert (scans(plan, "customer"), scans(plan, "orders")) == (1, 2)  # orders are both the sales file and the policies


def test_lookups_of_the_supply_are_restricted_before_they_are_reduced(fx):
    plan = supply.inactive_supply(fx.quotes, fx.dp_master, data_date="2024-01-31")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftSemi") == 2
    for reduced in ("min(done_on", "rn#"):
        assert "LeftSemi" in plan[plan.index(reduced) :]
