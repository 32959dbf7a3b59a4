"""Who sold on which day, as bitmaps that add up to exact distinct counts.

Partners have dense numbers, given once and kept. A day holds three bitmaps for each bucket of
32,768 numbers: partners who sold as inactive, as favourite, and at all. The distinct partners of
any period are the bits of its days' union, so a fold recomputes the days of its own months and
every report reads bitmaps, not sales.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify
from ..functions.dates import week_start
from ..operators import joins
from ..operators.windows import serial_no
from ..sources.schemas import BIGINT, DATE, STRING, table
from ..sources.storage import NO_MONTH, MonthlyTable, VersionedTable

PARTNER_NUMBERS = table(dp_id=STRING, dp_no=BIGINT)
DAYS = table(sale_date=DATE, bucket=BIGINT, inactive=T.BinaryType(), favourite=T.BinaryType(), anyone=T.BinaryType())
_COUNTS = {"inactive": "act_num", "favourite": "fav_num", "anyone": "con_num"}


def day_bitmaps(sales: DataFrame, numbers: DataFrame) -> DataFrame:
    """The bitmaps of the days of some sales. A day without any partner has one row, of empty bitmaps."""
    status = F.col("dp_status")
    dated = sales.filter(F.col("sale_date").isNotNull())
    per_dp = dated.groupBy("sale_date", "dp_id").agg(
        F.max(classify.is_inactive(status)).alias("is_inactive"), F.max(classify.is_favourite(status)).alias("is_favourite")
    )
    numbered = per_dp.join(numbers, "dp_id", "left")
    place = F.bitmap_bit_position("dp_no")
    return numbered.groupBy("sale_date", F.bitmap_bucket_number("dp_no").alias("bucket")).agg(
        F.bitmap_construct_agg(F.when(F.col("is_inactive"), place)).alias("inactive"),
        F.bitmap_construct_agg(F.when(F.col("is_favourite"), place)).alias("favourite"),
        F.bitmap_construct_agg(place).alias("anyone"),
    )


def distinct_partners(days: DataFrame, key: str) -> DataFrame:
    """act_num, fav_num and con_num per key from days (with the key): the bits of the union of its bitmaps."""
    union = days.groupBy(key, "bucket").agg(*[F.bitmap_or_agg(name).alias(name) for name in _COUNTS])
    bits = [F.coalesce(F.sum(F.bitmap_count(name)), F.lit(0)).alias(out) for name, out in _COUNTS.items()]
    return union.groupBy(key).agg(*bits)


class Presence:
    """The kept numbers and day bitmaps of a master."""

    def __init__(self, spark: SparkSession, path: str):
        self.numbers = VersionedTable(spark, f"{path}/numbers", PARTNER_NUMBERS, grows=True)
        self.days = MonthlyTable(spark, f"{path}/days", DAYS)

    def refresh(self, master: MonthlyTable, months: Collection[str]) -> None:
        """Take over the months that a fold has rewritten; no other month is read. Doing it again changes nothing."""
        dated = set(months) - {NO_MONTH}
        if not dated:
            return
        sales = master.read(dated)
        known = self.numbers.read()
        new = sales.select("dp_id").dropna().distinct().join(known.select("dp_id"), "dp_id", "left_anti")
        if not new.isEmpty():
            last = known.agg(F.coalesce(F.max("dp_no"), F.lit(0))).first()[0]
            self.numbers.write(serial_no(new, [F.col("dp_id").asc()], "dp_no").withColumn("dp_no", F.col("dp_no") + last))
        self.days.fold(day_bitmaps(sales, self.numbers.read()), lambda old, fresh: fresh)

    def weeks(self) -> DataFrame:
        """Distinct partners per week that starts on Monday."""
        return distinct_partners(self.days.read().withColumn("week_start", week_start(F.col("sale_date"))), "week_start")

    def periods(self, periods: DataFrame) -> DataFrame:
        """Distinct partners per period (snapshot_date, period_start)."""
        return distinct_partners(joins.range_join_period(self.days.read(), periods), "snapshot_date")
