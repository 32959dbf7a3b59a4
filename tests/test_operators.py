"""Properties and edge cases of operators and reports."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import registry
from tallyloom.functions import text
from tallyloom.operators import aggregates, fuzzy, joins, skew, windows
from tallyloom.plans import metrics, rates, sales
from tallyloom.sources.schemas import MASTER, MissingColumns


def bag(df):
    return Counter(tuple(r) for r in df.collect())


# --- hot keys -----------------------------------------------------------------------------
def hot_rows(spark, n=3000):
    """A third of the rows on one key, a third without a key, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 400).cast("string"))
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_gives_the_plain_join(spark, how):
    rows = hot_rows(spark)
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3), ("absent", 4)], "k string, v int")
    found = skew.hot_keys_of(rows.groupBy("k").count(), "k", "count")
    assert [key for key, _ in found.pieces] == ["hot"] and found.nulls
    cut = skew.lookup_join(rows, lookup, "k", "id", how, found).select("id", "k", "v")
    assert bag(cut) == bag(rows.join(lookup, "k", how).select("id", "k", "v"))


def test_lookup_join_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
        rows = hot_rows(spark)
        found = skew.hot_keys_of(rows.groupBy("k").count(), "k", "count")
        joined = skew.lookup_join(rows, lookup, "k", "id", hot_keys=found)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 3000 / 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_lookup_join_without_hot_keys_is_plain(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 500).cast("string").alias("k"))
    assert skew.hot_keys_of(rows.groupBy("k").count(), "k", "count") == skew.HotKeys([], False)


def test_lookup_join_of_no_rows(spark):
    none = hot_rows(spark).filter("id < 0")
    assert skew.lookup_join(none, spark.createDataFrame([("a", 1)], "k string, v int"), "k", "id").count() == 0


# --- names ---------------------------------------------------------------------------------
GOLDEN = {
    "": ("Unmapped", 0),
    "ASHA RAO": ("asha.rao1@example.com", 105),
    "BINOD KUMAAR": ("binod.kumar@example.com", 101),
    "FARAH E": ("e.farah@example.com", 100),
    "GEETA NAIR": ("gita.nair7@example.com", 89),
    "MENDES CARLA": ("carla.mendes9@example.com", 100),
    "QUENTIN XYLOPHONE": ("Unmapped", 31),
    "RAO ASHA": ("asha.rao1@example.com", 100),
    "ZED ALIAS": ("dev.patel2@example.com", 57),
}


@pytest.mark.parametrize("pack_size", [256, 3])
def test_fuzzy_map_golden(spark, fx, pack_size):
    names = fx.bdm.select(text.clean_name(F.col("bdm_name")).alias("clean_name"))
    found = fuzzy.fuzzy_map(names, fx.roster, fx.override, pack_size)
    assert {r["clean_name"]: (r["email"], r["best_score"]) for r in found.collect()} == GOLDEN


def test_first_roster_entry_wins_ties_across_packs(spark, fx):
    roster = spark.createDataFrame([(9, "rao.b@x.org", "new"), (2, "b.rao@x.org", "old")], "roster_seq int, email string, team string")
    names = spark.createDataFrame([("RAO B",), ("B RAO",), ("C RAO",)], "clean_name string")
    for pack_size in (1, 256):
        found = {r[0]: r[1] for r in fuzzy.fuzzy_map(names, roster, fx.override, pack_size).collect()}
        assert found == {"RAO B": "rao.b@x.org", "B RAO": "b.rao@x.org", "C RAO": "b.rao@x.org"}


def test_packs_meet_a_block_together(spark, fx, monkeypatch):
    local = [f"{a}{b}{a}.{c}" for a in "abc" for b in "defgh" for c in "xyz"]
    roster = spark.createDataFrame([(100 - i, f"{t}@x.org", "new") for i, t in enumerate(local)], "roster_seq int, email string, team string")
    packs = fuzzy.pack_roster(roster, 2)
    whole = fuzzy.shelve(packs, 2).collect()  # a row for each pack met a block before
    assert [[e["email"] for e in row["entries"]] for row in whole] == [[f"{t}@x.org" for t in reversed(local)]]
    names = spark.createDataFrame([(f"{a}{b}{a} {c}",) for a in "ABC" for b in "DQ" for c in "XYQ"], "clean_name string")
    expected = sorted(map(tuple, fuzzy.fuzzy_map(names, roster, fx.override, 2).collect()))
    monkeypatch.setattr(fuzzy, "SHELF", 8)
    assert max(len(row["entries"]) for row in fuzzy.shelve(packs, 2).collect()) <= 8
    assert sorted(map(tuple, fuzzy.fuzzy_map(names, roster, fx.override, 2).collect())) == expected
    assert ("ADA X", "ada.x@x.org", 105) in expected and len(expected) == 18


def test_parts_hold_several_blocks_and_shelves(spark, fx, monkeypatch):
    local = [f"{a}{b}{a}.{c}" for a in "abc" for b in "defgh" for c in "xyz"]
    roster = spark.createDataFrame([(3 * i - 20, f"{t}@x.org", "new") for i, t in enumerate(local)], "roster_seq int, email string, team string")
    roster = roster.union(roster.limit(9)).union(spark.createDataFrame([(None, "qqq.q@x.org", "new"), (500, None, "new")], roster.schema))
    names = spark.createDataFrame([(f"{a}{b}{a} {c}",) for a in "ABCQ" for b in "DEQ" for c in "XYQ"] + [("",), (None,)] * 2, "clean_name string")
    expected = sorted(map(str, fuzzy.fuzzy_map(names, roster, fx.override).collect()))
    for name, value in (("BLOCK_NAMES", 2), ("SHELF", 8), ("LANES", 5)):
        monkeypatch.setattr(fuzzy, name, value)
        assert sorted(map(str, fuzzy.fuzzy_map(names, roster, fx.override, 2).collect())) == expected
    assert len(expected) == 38 and "Row(clean_name='ADA X', email='ada.x@x.org', best_score=105)" in expected


def test_a_name_listed_twice_is_matched_once(spark, fx):
    names = spark.createDataFrame([(1, "ASHA RAO"), (2, "ASHA RAO"), (3, None)], "n int, clean_name string")
    found = [tuple(row) for row in fuzzy.match_names(names, fx.roster, fx.override).orderBy("n").collect()]
    assert found == [(1, "ASHA RAO", "asha.rao1@example.com", 105), (2, "ASHA RAO", "asha.rao1@example.com", 105), (3, None, "Unmapped", 0)]


def test_empty_roster(spark, fx):
    names = spark.createDataFrame([("ASHA",)], "clean_name string")
    assert [r[1] for r in fuzzy.fuzzy_map(names, fx.roster.filter("false"), fx.override).collect()] == ["Unmapped"]


# --- serial numbers ----------------------------------------------------------------------------
def test_serial_numbers_with_one_busy_day(spark):
    day = F.when(F.col("id") % 3 > 0, F.lit("2024-01-05")).otherwise(F.concat(F.lit("2024-01-"), F.lpad(F.col("id") % 28 + 1, 2, "0")))
    rows = spark.range(2000).select(F.col("id").cast("string").alias("dp_id"), day.cast("date").alias("sale_date"))
    order = [F.col("sale_date").desc(), F.col("dp_id").asc()]
    got = [(r["serial_no"], r["sale_date"], r["dp_id"]) for r in windows.serial_no(rows, order).collect()]
    expected = sorted(((r["sale_date"], r["dp_id"]) for r in rows.collect()), key=lambda p: (-p[0].toordinal(), p[1]))
    assert sorted(got) == [(i, *pair) for i, pair in enumerate(expected, 1)]


# --- collation -------------------------------------------------------------------------------
def daily(fx):
    return registry.two_batches(fx)


def test_collating_twice_changes_nothing(spark, fx):
    first, second = daily(fx)
    empty = spark.createDataFrame([], MASTER)
    once = sales.collate_master(empty, first, fx.roster, fx.override, batch_seq=1)
    columns = ["sale_date", "bdm_name", "dp_id", "net_premium", "dp_status", "team"]
    twice = sales.collate_master(once, first, fx.roster, fx.override, batch_seq=2)
    assert bag(twice.select(*columns)) == bag(once.select(*columns))
    both = sales.collate_master(once, second, fx.roster, fx.override, batch_seq=2)
    keys = both.groupBy("dp_id", "sale_date", "net_premium").count().filter("count > 1")
    assert keys.isEmpty()


def test_collation_needs_its_columns(fx):
    with pytest.raises(MissingColumns) as error:
        sales.daily_rows(fx.sales.drop("bdm_name"), fx.roster, fx.override, batch_seq=1)
    assert error.value.missing == ["bdm_name", "dp_status"]


# --- metrics ----------------------------------------------------------------------------------
def test_email_sums_are_team_sums_are_overall(fx):
    by_email = registry.by_email(fx)
    names = ("act_num", "fav_num", "con_num", "act_den", "fav_den", "con_den")
    total = by_email.agg(*[F.sum(c).alias(c) for c in names]).first()
    teams = metrics.team_level(by_email).agg(*[F.sum(c).alias(c) for c in names]).first()
    assert total == teams
    overall = aggregates.overall_row(registry.unique_enriched(fx), registry.day_supply(fx), registry.day_pool(fx)).first()
    assert [overall[c] for c in names[:3]] == [total[c] for c in names[:3]]
    assert overall["act_den"] >= total["act_den"]  # agents without a name count overall only


def test_agent_with_two_denominators_has_one_row(spark):
    numbers = spark.createDataFrame([("a", 1, 2, 3)], "email string, act_num long, fav_num long, con_num long")
    act = spark.createDataFrame([("b", 5), ("a", 1)], "agent_mapped string, act_den long")
    fav = spark.createDataFrame([("b", 7)], "agent_mapped string, fav_den long")
    assert bag(joins.outer_num_den(numbers, act, fav)) == Counter([("a", 1, 2, 3, 1, 0), ("b", 0, 0, 0, 5, 7)])


def test_status_lookup_takes_the_longest_standing_login(spark):
    status = spark.createDataFrame(
        [("1", "Inactive"), ("1", "Already Active"), ("2", "Activated by LGLC"), ("2.0", "Inactive"), (None, "Inactive")],
        "dpno string, client_status string",
    )
    assert bag(joins.status_lookup(status)) == Counter([("1", "Already Active"), ("2", "Activated by LGLC")])


def test_month_gap(spark):
    def gap(last, today):
        trend = spark.createDataFrame([(dt.date.fromisoformat(last),)], "data_date date")
        return [r["missing_month"] for r in metrics.month_gap(trend, today=today).collect()]

    assert gap("2024-04-29", "2024-05-01") == ["April"]
    assert gap("2024-04-30", "2024-05-01") == []
    assert gap("2024-04-29", "2024-04-30") == []
    empty = spark.createDataFrame([], "data_date date")
    assert metrics.month_gap(empty, today="2024-05-01").isEmpty()


# --- rates ---------------------------------------------------------------------------------------
def test_period_supply_adds_up_to_the_last_snapshot(fx):
    totals = aggregates.snapshot_totals(fx.supply)
    deltas = windows.supply_delta(totals)
    month = F.trunc("snapshot_date", "month").alias("month")
    added = deltas.groupBy(month).agg(F.sum("act_den").alias("n"))
    last = totals.groupBy(month).agg(F.max_by("mtd", "snapshot_date").alias("n"))
    assert bag(added) == bag(last)


def test_each_sale_is_in_one_period_at_most(fx):
    periods = windows.supply_delta(aggregates.snapshot_totals(fx.supply))
    matched = joins.range_join_period(registry.cleaned(fx), periods)
    assert matched.count() == matched.select("row_seq").distinct().count() > 0


def small_rates(spark, sold, supply, pool):
    day = dt.date.fromisoformat
    master = spark.createDataFrame([(day(d), dp, s) for d, dp, s in sold], "sale_date date, dp_id string, dp_status string")
    supplies = spark.createDataFrame(
        [(day(d), "a", n) for d, n in supply], "snapshot_date date, agent_mapped string, sum_inactive_dps_creating_quotes long"
    )
    pools = spark.createDataFrame([(day(d), "a", n) for d, n in pool], "snapshot_date date, agent_mapped string, dp_count long")
    return master, supplies, pools


def test_week_across_months_may_have_negative_supply(spark):
    inputs = small_rates(
        spark,
        sold=[("2024-07-30", "1", " Inactive "), ("2024-08-01", "1", "Inactive"), ("2024-08-02", "2", "Already Active"), ("2024-09-10", None, "Inactive")],
        supply=[("2024-07-28", 40), ("2024-08-03", 10)],
        pool=[("2024-07-05", 20), ("2024-07-28", 99)],
    )
    (week,) = rates.weekly_rates(*inputs).collect()
    assert (week["week_start"], week["act_num"], week["fav_num"], week["con_num"]) == (dt.date(2024, 7, 29), 1, 1, 2)
    assert (week["act_den"], week["fav_den"], week["con_den"]) == (-30, 20, -10)
    assert (week["activation_rate"], week["favourite_rate"], week["consolidated_rate"]) == (0.0, 0.05, 0.0)


def test_periods_of_two_months(spark):
    inputs = small_rates(
        spark,
        sold=[("2024-07-01", "1", "Inactive"), ("2024-07-05", "1", "Inactive"), ("2024-07-06", "1", "Inactive"), ("2024-07-31", "9", "Inactive")],
        supply=[("2024-07-05", 4), ("2024-07-20", 10), ("2024-08-02", 3)],
        pool=[("2024-07-20", 5)],
    )
    found = [(r["snapshot_date"].day, r["period_start"].day, r["act_num"], r["act_den"], r["fav_den"]) for r in rates.period_rates(*inputs).collect()]
    assert found == [(2, 1, 0, 3, 0), (20, 6, 1, 6, 5), (5, 1, 1, 4, 5)]


def test_premium_stats_by_hand(spark):
    rows = [("1", "10", "Inactive"), ("1", "n/a", " Inactive"), (None, "5", "Inactive"), ("2", "8", "Already Active")]
    row = aggregates.premium_stats(spark.createDataFrame(rows, "dp_id string, net_premium string, dp_status string")).first()
    assert (float(row["inactive_premium"]), row["inactive_nop"], row["inactive_dps"]) == (15.0, 3, 1)
    assert (row["avg_premium_inactive"], row["nop_per_dp_inactive"], row["avg_premium_fav"]) == (5.0, 3.0, 8.0)


# --- lookups listed twice, ids that are not clean ---------------------------------------------
def test_a_roster_entry_listed_twice_multiplies_nothing(spark):
    roster = spark.createDataFrame(
        [(1, "asha.rao@example.com", "old"), (2, "asha.rao@example.com", "new")], "roster_seq int, email string, team string"
    )
    overrides = spark.createDataFrame([("BOSS", "asha.rao@example.com")] * 2, "clean_name string, email string")
    rows = spark.createDataFrame([(1, "ASHA RAO"), (2, "BOSS")], "row_seq long, clean_name string")
    mapped = fuzzy.map_lookup(rows, roster, overrides, spread_by="row_seq").collect()
    assert sorted((r["row_seq"], r["team"]) for r in mapped) == [(1, "new"), (2, "new")]
    assert joins.with_team(spark.createDataFrame([("asha.rao@example.com",)], "email string"), roster).count() == 1


def test_ids_are_cleaned_on_both_sides(spark):
    sales = spark.createDataFrame([(1, "12.0"), (2, "12"), (3, None)], "row_seq long, dp_id string")
    status = spark.createDataFrame([("12", "Already Active")], "dpno string, client_status string")
    found = {r["row_seq"]: r["dp_status"] for r in joins.enrich_status(sales, status).collect()}
    assert found == {1: "Already Active", 2: "Already Active", 3: "Inactive"}


def test_missing_names_and_blocks_of_fixed_size(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "BLOCK_NAMES", 3)
    names = spark.createDataFrame([("ASHA RAO",), (None,), ("",)] + [(f"NAME {chr(65 + i)}",) for i in range(20)], "clean_name string")
    blocks = fuzzy.block_names(names.dropna()).selectExpr("max(size(names))", "sum(size(names))", "count(distinct block) = count(1)")
    assert tuple(blocks.first()) == (3, 22, True)
    roster = spark.createDataFrame([(1, "asha.rao@example.com", "old")], "roster_seq int, email string, team string")
    none = spark.createDataFrame([], "clean_name string, email string")
    found = {r["clean_name"]: r["email"] for r in fuzzy.fuzzy_map(names, roster, none).collect()}
    assert len(found) == 23 and found["ASHA RAO"] == "asha.rao@example.com" and found[None] == "Unmapped"


def test_policies_are_restricted_before_they_are_aggregated(spark, fx):
    from checks.fixtures import CUTOFFS
    from tallyloom.plans import status

    few = spark.createDataFrame([("3",)], "dp_id string")
    plan = status.dp_status(fx.partner, fx.policy, few, ordered=False, **CUTOFFS)._jdf.queryExecution().optimizedPlan().toString()
    first_aggregate = plan.index("min(created_at")
    assert "LeftSemi" in plan[first_aggregate:]


def test_no_job_runs_while_enrichment_is_planned(spark, fx):
    from checks import registry

    spark.sparkContext.setJobGroup("planning", "planning")
    fresh = type(fx)(spark, fx.sf_dir)
    registry.enriched(fresh)
    registry.by_email(fresh)
    assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning"))
