"""What is kept between batches: months, numbers, bitmaps, names, files, steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import directory, presence, rates, sales
from tallyloom.plans.steps import Steps
from tallyloom.sources import batches, schemas, storage

from .test_sources import _sale, _sales


@pytest.fixture
def master(spark, tmp_path):
    return sales.master_table(spark, str(tmp_path / "m"))


def fold(master, fx, rows, seq, **names):
    return sales.fold_sales(master, rows, fx.roster, fx.override, batch_seq=seq, **names)


def months_sales(spark, days, first=1, status="Inactive"):
    rows = [(first + i, dt.date.fromisoformat(d), "Asha Rao", str(i % 5), str(i), status) for i, d in enumerate(days)]
    return _sales(spark, *rows)


def test_counts_of_a_first_run_an_overlap_and_a_repetition(spark, fx, master):
    fold(master, fx, _sales(spark, _sale(1)), 1)
    fold(master, fx, _sales(spark, _sale(2), _sale(3, premium="11"), _sale(4, premium="11")), 2)
    fold(master, fx, _sales(spark, _sale(5, day="2024-06-01")), 3)
    fold(master, fx, _sales(spark), 4)
    found = [tuple(r)[3:] for r in sales.collation_counts(master).orderBy("version").collect()]
    assert found == [(1, 1, 0, 1), (3, 4, 2, 2), (1, 3, 0, 3), (0, 3, 0, 3)]


def test_an_empty_batch_into_an_empty_table_is_committed(spark, fx, master):
    done = sales.fold_sales(master, _sales(spark), fx.roster, fx.override, batch_seq=1, stream_id="s", batch_id=0)
    assert (done.version, done.months, master.has_batch("s", 0), master.read().count()) == (1, frozenset(), True, 0)


def test_numbers_follow_the_index_and_untouched_months_keep_their_files(spark, fx, master, tmp_path):
    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "m" / "data").rglob("part-*.parquet")}

    days = ["2024-03-05", "2024-03-07", "2024-04-01", "2024-05-09", "2024-05-30", "2024-05-30"]
    fold(master, fx, months_sales(spark, days), 1)
    fold(master, fx, _sales(spark, (90, None, "x", "8", "1", "Inactive")), 2)
    before = files()
    fold(master, fx, months_sales(spark, ["2024-04-20", "2024-04-01"], first=50, status="Already Active"), 3)
    assert before.items() <= files().items()
    numbered = master.numbered()
    wanted = sales.numbered_master(master.read()).select(*numbered.columns)
    assert sorted(map(str, numbered.collect())) == sorted(map(str, wanted.collect()))
    assert [r["serial_no"] for r in numbered.orderBy("serial_no").collect()] == list(range(1, numbered.count() + 1))


def test_old_versions_can_be_removed(spark, fx, master):
    for seq, day in enumerate(["2024-03-05", "2024-04-05", "2024-03-05", "2024-03-06"], 1):
        fold(master, fx, months_sales(spark, [day], first=seq * 10), seq)
    rows = sorted(map(str, master.read().collect()))
    assert len(master.remove_old(keep_last=2)) == 1  # March of version 1; April and the last two are named
    assert sorted(map(str, master.read().collect())) == rows and master.remove_old(keep_last=2) == []


class Watched:
    """A master that notes the months it is asked for."""

    def __init__(self, master):
        self.master, self.asked = master, []

    def read(self, months):
        self.asked.append(set(months))
        return self.master.read(months)


def test_bitmaps_give_the_rates_of_the_sales_and_read_touched_months_only(spark, fx, master, tmp_path):
    kept, watched = presence.Presence(spark, str(tmp_path / "p")), Watched(master)
    days = [f"2024-{m:02d}-{d:02d}" for m in (3, 4, 5) for d in (1, 2, 28, 29, 30)]
    nobody = _sales(spark, (99, dt.date(2024, 5, 14), "x", None, "1", "Inactive"))
    kept.refresh(watched, fold(master, fx, months_sales(spark, days).unionByName(nobody), 1).months)
    late = months_sales(spark, ["2024-04-30", "2024-04-29"], first=70, status="Already Active")
    for _ in range(2):  # taking a month over again changes nothing
        kept.refresh(watched, fold(master, fx, late, 2).months)
    assert watched.asked == [{"2024-03", "2024-04", "2024-05"}, {"2024-04"}, {"2024-04"}]
    assert sorted(map(str, kept.weeks().collect())) == sorted(map(str, rates.week_sales(master.read()).collect()))
    supply = spark.createDataFrame([(dt.date(2024, 3, 29), "a", 5), (dt.date(2024, 4, 12), "a", 3), (dt.date(2024, 4, 30), "a", 9)], "snapshot_date date, agent_mapped string, sum_inactive_dps_creating_quotes long")
    pool = spark.createDataFrame([(dt.date(2024, 4, 12), "a", 4)], "snapshot_date date, agent_mapped string, dp_count long")
    for of_sales, of_bitmaps in ((rates.period_rates, rates.kept_period_rates), (rates.weekly_rates, rates.kept_weekly_rates)):
        columns = of_sales(master.read(), supply, pool).columns
        wanted = of_sales(master.read(), supply, pool).collect()
        assert wanted and of_bitmaps(kept, supply, pool).select(*columns).collect() == wanted


def test_partner_numbers_stay_and_are_dense(spark, fx, master, tmp_path):
    kept = presence.Presence(spark, str(tmp_path / "p"))
    kept.refresh(master, fold(master, fx, months_sales(spark, ["2024-03-01"] * 4), 1).months)
    first = {r["dp_id"]: r["dp_no"] for r in kept.numbers.read().collect()}
    kept.refresh(master, fold(master, fx, months_sales(spark, ["2024-04-01"] * 5), 2).months)
    then = {r["dp_id"]: r["dp_no"] for r in kept.numbers.read().collect()}
    assert first.items() <= then.items() and sorted(then.values()) == [1, 2, 3, 4, 5]


def test_bitmaps_over_several_buckets(spark):
    n = 70_000
    rows = spark.range(1, n + 1).select(
        F.lit(dt.date(2024, 3, 1)).alias("sale_date"), F.col("id").cast("string").alias("dp_id"), F.when(F.col("id") % 2 == 0, "Inactive").otherwise("Already Active").alias("dp_status")
    )
    numbers = rows.select("dp_id", F.col("dp_id").cast("long").alias("dp_no"))
    again = rows.limit(10).withColumn("sale_date", F.lit(dt.date(2024, 3, 2)))
    days = presence.day_bitmaps(rows.unionByName(again), numbers).withColumn("week", F.lit(1))
    assert tuple(presence.distinct_partners(days, "week").first()) == (1, n // 2, n // 2, n)


def test_names_are_matched_once_for_a_roster(spark, fx, tmp_path, monkeypatch):
    kept, asked = directory.NameDirectory(spark, str(tmp_path / "n")), []

    def match(names, roster, overrides):
        asked.append(sorted(r["clean_name"] for r in names.collect()))
        return real(names, roster, overrides)

    real = directory.match_names
    monkeypatch.setattr(directory, "match_names", match)

    def names(*values):
        return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "clean_name string, n_rows int")

    kept.match(names("ASHA RAO", "BINOD KUMAAR"), fx.roster, fx.override)
    second = kept.match(names("ASHA RAO", None, "ZED ALIAS"), fx.roster, fx.override).collect()
    teams = fx.roster.withColumn("team", F.lit("other")).orderBy(F.desc("email"))
    kept.match(names("ASHA RAO"), teams, fx.override)
    kept.match(names("ASHA RAO"), fx.roster.filter("roster_seq > 1"), fx.override)
    assert asked == [["ASHA RAO", "BINOD KUMAAR"], ["ZED ALIAS"], ["ASHA RAO"]]
    assert {(r["clean_name"], r["n_rows"]): r["email"] for r in second} == {
        ("ASHA RAO", 0): "asha.rao1@example.com", (None, 1): "Unmapped", ("ZED ALIAS", 2): "dev.patel2@example.com",
    }


FILE = schemas.table(agent_mapped=schemas.STRING, dp_count=schemas.BIGINT)


def files_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_files_outside_the_dates_are_not_opened(spark, tmp_path):
    folder = str(tmp_path / "dated")
    rows = [(dt.date(2024, m, d), f" a{m} ", m * d) for m in (3, 4, 5) for d in (1, 15)]
    batches.write_dated_csv(spark.createDataFrame(rows, "snapshot_date date, agent_mapped string, dp_count long"), folder, "Pool")
    (tmp_path / "dated" / "Other_2024-04-01.csv").write_text("agent_mapped,dp_count\nx,1\n")
    (tmp_path / "dated" / "~$Pool_2024-04-01.csv").write_text("lock")
    series = batches.read_dated_csv(spark, folder, FILE, prefix="Pool")
    assert sorted(tuple(r)[::-1] for r in series.collect()) == sorted((d, n, a) for d, a, n in rows)
    april = series.filter(F.month("snapshot_date") == 4)
    assert april.count() == 2 and files_read(series.filter(F.col("snapshot_date") >= F.lit("2024-04-15").cast("date"))) == 3
    batches.write_dated_csv(spark.createDataFrame([(dt.date(2024, 5, 15), "b", 7)], "snapshot_date date, agent_mapped string, dp_count long"), folder, "Pool")
    batches.set_arrival(spark, f"{folder}/Pool_2024-05-01.csv", dt.date(2050, 1, 1))
    assert [r["dp_count"] for r in batches.read_newest_csv(spark, folder, FILE, prefix="Pool").collect()] == [5]
    assert batches.read_newest_csv(spark, folder, FILE, prefix="None").count() == 0


def test_steps_are_done_once_in_an_attempt(spark, tmp_path):
    out, built = str(tmp_path), []

    def attempt(stop=False):
        steps = Steps(spark, out, "day mode")
        for name in ("a", "b"):
            rows = steps.table(name, f"{out}/{name}", lambda name=name: built.append(name) or spark.range(3))
            assert rows.count() == 3
            if stop:
                raise RuntimeError("interrupted")
        steps.once("c", lambda: built.append("c"))
        steps.finish()

    with pytest.raises(RuntimeError):
        attempt(stop=True)
    attempt()
    assert built == ["a", "b", "c"]
    attempt()
    assert built == ["a", "b", "c"] * 2
    record = Steps(spark, out, "day mode").record.read().filter("step = 'a'").collect()
    assert [(r["attempt"], r["n_rows"]) for r in sorted(record)] == [(1, 3), (2, 3)] and len({r["checksum"] for r in record}) == 1


def test_versions_that_grow(spark, tmp_path):
    table = storage.VersionedTable(spark, str(tmp_path / "v"), schemas.ROSTER, grows=True)
    for n in (1, 2):
        table.write(spark.createDataFrame([(n, "a@x.org", "old")], schemas.ROSTER))
    assert sorted(r["roster_seq"] for r in table.read().collect()) == [1, 2]
