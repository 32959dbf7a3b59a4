"""Files, snapshots, versions, messages, the stream and a whole run."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.fixtures import PREFERRED, SENDERS
from tallyloom.plans.report import Inputs, Options, master_report, run_report
from tallyloom.plans.sales import collate_master, master_table
from tallyloom.sources import batches, messages, schemas, storage
from tallyloom.streaming import collation
from tallyloom.streaming.collation import collate_stream, fold_batch, read_batches


def test_latest_batch_skips_locks_and_other_files(spark, tmp_path):
    for at, name in enumerate(["Health_a.xlsx", "Health_b.xlsx", "~$Health_b.xlsx", "notes.txt"]):
        path = tmp_path / name
        path.write_text("x")
        os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))
    found = batches.latest_batch(batches.list_files(spark, str(tmp_path)), [".xlsx", ".xls"]).collect()
    assert [r["file_name"] for r in found] == ["Health_b.xlsx"]


def test_dated_csv_series(spark, tmp_path):
    for day, n in (("2024-05-30", 3), ("2024-05-31", 4)):
        (tmp_path / f"Fav_DP_Count_{day}.csv").write_text(f"agent_mapped,team,dp_count\na@x.org,old,{n}\n")
    series = batches.read_dated_csv(spark, str(tmp_path), schemas.FAV_POOL)
    chosen = {d: batches.snapshot_or_latest(series, d).collect()[0]["dp_count"] for d in ("2024-05-30", "2024-06-09")}
    assert chosen == {"2024-05-30": 3, "2024-06-09": 4}
    batches.require_snapshots({"pool": series}, "2024-05-31")
    with pytest.raises(batches.SnapshotMissing, match="pool"):
        batches.require_snapshots({"pool": series}, "2024-06-01")


def test_resolve_table():
    assert batches.resolve_table([" Health ", "Health Unique DPs", "x"]) == " Health "
    for names in (["Motor"], ["Health", "health 2"]):
        with pytest.raises(LookupError):
            batches.resolve_table(names)


class FakeSession:
    """A session without the checkpoint setting."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.dir = master, setting, None
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return self.setting or default

    def getCheckpointDir(self):  # noqa: N802
        return self.dir

    def setCheckpointDir(self, path):  # noqa: N802
        self.dir = path


def test_shared_folder_is_the_one_the_cluster_names():
    assert storage.shared_folder(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert os.path.isdir(storage.shared_folder(local)) and storage.shared_folder(local) == local.dir


def test_load_or_empty(spark, tmp_path):
    assert storage.load_or_empty(spark, str(tmp_path / "none"), schemas.TREND).schema == schemas.TREND


def test_breakdown_rerun_replaces_its_own_partition_only(spark, tmp_path):
    def write(n, day, mode):
        storage.write_breakdown({"t": spark.range(n)}, str(tmp_path), day, mode)

    write(3, "2024-01-01", "REGULAR")
    write(2, "2024-01-02", "REGULAR")
    write(1, "2024-01-01", "REGULAR")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3


def test_versioned_table_may_read_what_it_replaces(spark, tmp_path):
    table = storage.VersionedTable(spark, str(tmp_path / "v"), schemas.ROSTER)
    assert table.read().isEmpty()
    table.write(spark.createDataFrame([(1, "a@x.org", "old")], schemas.ROSTER))
    table.write(table.read().unionByName(table.read()), "s", 7)
    assert (table.latest(), table.read().count(), table.has_batch("s", 7), table.has_batch("s", 8)) == (2, 2, True, False)


def test_a_version_without_commit_is_not_read(spark, tmp_path):
    table = storage.VersionedTable(spark, str(tmp_path / "v"), schemas.ROSTER)
    table.write(spark.createDataFrame([(1, "a@x.org", "old")], schemas.ROSTER))
    spark.createDataFrame([(2, "b@x.org", "new")], schemas.ROSTER).write.parquet(str(tmp_path / "v/data/version=2"))
    assert [r["email"] for r in table.read().collect()] == ["a@x.org"]


def test_messages(spark):
    at = dt.datetime
    rows = [
        (1, "reports@example.com", "June sale", at(2024, 6, 2), ["a.pdf", "b.XLSX"]),
        (2, "Lead <lead@example.com>", "Sale of June", at(2024, 6, 1), ["c.xls"]),
        (3, "lead@example.com", "June claims", at(2024, 6, 9), []),
        (4, "else@example.com", "June sale", at(2024, 6, 9), []),
        (5, None, "June sale", at(2024, 6, 9), []),
    ]
    table = spark.createDataFrame(rows, schemas.MESSAGES)

    def pick(subject, received=None):
        return [(r["message_id"], r["workbook"]) for r in messages.select_message(table, SENDERS, PREFERRED, subject, received).collect()]

    assert pick("June sale") == [(2, "c.xls")]
    assert pick("June sale", dt.date(2024, 6, 3)) == [(1, "b.XLSX")]
    assert pick("July sale") == []


def test_stream_folds_every_batch_once(spark, fx, tmp_path):
    first, second = registry.two_batches(fx)
    columns = schemas.SALES_ENRICHED.names
    folder, master = str(tmp_path / "in"), master_table(spark, str(tmp_path / "master"))

    def arrive(df):
        df.select(*columns).coalesce(1).write.mode("append").parquet(folder)
        collate_stream(read_batches(spark, folder), master, fx.roster, fx.override, str(tmp_path / "cp")).awaitTermination()

    arrive(first)
    arrive(second)
    assert master.latest() == 2
    empty = spark.createDataFrame([], schemas.MASTER)
    once = collate_master(empty, first, fx.roster, fx.override, batch_seq=1)
    expected = collate_master(once, second, fx.roster, fx.override, batch_seq=2)
    assert sorted(map(str, master.read().collect())) == sorted(map(str, expected.select(*schemas.MASTER.names).collect()))
    assert not fold_batch(master, second, 1, fx.roster, fx.override, str(tmp_path / "cp"))


def _sale(row_seq, premium="10", status="Inactive", day="2024-05-01"):
    return (row_seq, dt.date.fromisoformat(day), "Asha Rao", "7", premium, status)


def _sales(spark, *rows):
    kinds = "row_seq long, sale_date date, bdm_name string, dp_id string, net_premium string, dp_status string"
    return spark.createDataFrame(rows, kinds).select(*schemas.SALES_ENRICHED.names)


def test_premiums_that_differ_after_the_second_digit_are_different_sales(spark, fx):
    rows = _sales(spark, _sale(1, "10.001"), _sale(2, "10.004"), _sale(3, "10.00"), _sale(4, "10"))
    master = collate_master(spark.createDataFrame([], schemas.MASTER), rows, fx.roster, fx.override, batch_seq=1)
    assert sorted(r["row_seq"] for r in master.collect()) == [1, 2, 4]


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_the_later_delivery_wins_inside_a_trigger(spark, fx, tmp_path, files_per_batch):
    folder = str(tmp_path / "in")
    for rows in (_sale(5), _sale(1, status="Already Active")):
        _sales(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    master = master_table(spark, str(tmp_path / "master"))
    stream = read_batches(spark, folder, files_per_batch)
    collate_stream(stream, master, fx.roster, fx.override, str(tmp_path / "cp")).awaitTermination()
    (row,) = master.read().collect()
    assert row["dp_status"] == "Already Active"


def test_a_stream_with_a_new_checkpoint_loses_no_sale(spark, fx, tmp_path):
    master = master_table(spark, str(tmp_path / "master"))
    for at in (1, 2):
        _sales(spark, _sale(at, day=f"2024-05-0{at}")).write.parquet(str(tmp_path / f"in{at}"))
        stream = read_batches(spark, str(tmp_path / f"in{at}"))
        collate_stream(stream, master, fx.roster, fx.override, str(tmp_path / f"cp{at}")).awaitTermination()
    assert master.read().count() == 2


def test_a_delivery_of_one_row_group_is_work_for_several_tasks(spark, fx, tmp_path, monkeypatch):
    found = []

    def folded(master, batch, *_):
        found.extend(r["count"] for r in batch.groupBy(F.spark_partition_id()).count().collect())

    monkeypatch.setattr(collation, "fold_batch", folded)
    kept, off = storage.made_paths(spark), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(off, False)  # few rows, which would be put together
    try:
        rows = _sales(spark, *[_sale(i, premium=str(i)) for i in range(400)])
        rows.coalesce(1).write.parquet(str(tmp_path / "in"))
        master = master_table(spark, str(tmp_path / "master"))
        stream = read_batches(spark, str(tmp_path / "in"))
        collate_stream(stream, master, fx.roster, fx.override, str(tmp_path / "cp")).awaitTermination()
    finally:
        spark.conf.unset(off)
    assert sum(found) == 400 and max(found) < 250
    assert storage.made_paths(spark) == kept


def test_two_writers_cannot_commit_one_version(spark, tmp_path):
    one = storage.VersionedTable(spark, str(tmp_path / "t"), schemas.FAV_POOL)
    two = storage.VersionedTable(spark, str(tmp_path / "t"), schemas.FAV_POOL)
    rows = spark.createDataFrame([("a", "old", 1)], schemas.FAV_POOL)
    two.latest = lambda: 0
    one.write(rows)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        two.write(rows.filter("false"))
    assert one.read().count() == 1


def test_whole_run(spark, fx, tmp_path):
    shifted = fx.sales.withColumn("sale_date", F.date_add("sale_date", 9361))  # 1998-06-15 -> 2024-01-31
    batch = shifted.filter(F.col("sale_date").between(F.lit("2023-12-01"), F.lit("2024-01-31")))
    inputs = Inputs(batch, fx.partner, fx.policy, fx.quotes, fx.dp_master, fx.roster, fx.override)
    options = Options(already_before="1996-08-01", since="1996-01-01")
    out = str(tmp_path / "out")
    newest = run_report(spark, inputs, out, options)
    sizes = {n: spark.read.parquet(f"{out}/{n}").count() for n in ("daily_rates", "weekly_rates", "breakdown/email_level")}
    sizes["master"] = master_report(spark, out).count()
    assert run_report(spark, inputs, out, options) == newest
    again = {n: spark.read.parquet(f"{out}/{n}").count() for n in sizes if n != "master"}
    assert sizes == {**again, "master": master_report(spark, out).count()} and all(sizes.values())
    counts = {r["version"]: r for r in spark.read.parquet(f"{out}/collation_counts").collect()}
    n = batch.count()
    assert counts[1]["rows_in"] == n == counts[1]["rows_out"] + counts[1]["duplicates"]
    assert counts[2]["duplicates"] == n and counts[2]["rows_out"] == counts[1]["rows_out"]  # the same batch once more
    trend = storage.VersionedTable(spark, f"{out}/trend", schemas.TREND)
    (row,) = trend.read().collect()
    assert row["data_date"].isoformat() == newest and row["act_denominator"] > 0


def test_a_fold_leaves_the_files_of_other_months_alone(spark, fx, tmp_path):
    master = storage.MonthlyTable(spark, str(tmp_path / "m"), schemas.MASTER)

    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "m" / "data").rglob("part-*.parquet")}

    def merge(seq):
        return lambda old, new: collate_master(old, new, fx.roster, fx.override, batch_seq=seq)

    master.fold(_sales(spark, _sale(1), _sale(2, day="2024-06-01"), (3, None, "x", "8", "1", "Inactive")), merge(1))
    before = files()
    master.fold(_sales(spark, _sale(4, status="Already Active")), merge(2))
    after = files()
    assert before.items() <= after.items() and len(after) > len(before)
    assert {(r["row_seq"], r["dp_status"]) for r in master.read().collect()} == {(4, "Already Active"), (2, "Inactive"), (3, "Inactive")}
    assert master.read({"2024-06"}).count() == 1 and (master.latest(), master.last_seq()) == (2, 2)


def test_empty_snapshots_replace_older_ones(spark, tmp_path):
    from tallyloom.plans.report import _series

    rows, path = spark.createDataFrame([("a@x.org", "old", 3)], schemas.FAV_POOL), str(tmp_path / "pool")
    for part, n in ((rows.limit(0), 0), (rows, 1), (rows.limit(0), 0)):
        storage.write_table(part, f"{path}/snapshot_date=2024-05-31")
        assert _series(spark, path, part, "2024-05-31").count() == n
