"""What names were matched to, kept between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..operators.fuzzy import match_names
from ..sources.schemas import BIGINT, INT, STRING, table
from ..sources.storage import VersionedTable

NAMES = table(roster_version=STRING, clean_name=STRING, email=STRING, best_score=INT, matched_in=BIGINT)


def roster_version(roster: DataFrame, overrides: DataFrame) -> str:
    """A mark of the entries of roster and overrides, whatever their order; teams do not matter to matching."""
    entries = roster.select(F.xxhash64(F.lit("roster"), "roster_seq", "email").alias("h"))
    entries = entries.unionByName(overrides.select(F.xxhash64(F.lit("override"), "clean_name", "email").alias("h")))
    row = entries.agg(F.count("h"), F.bit_xor("h"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return "-".join(str(value) for value in row)


class NameDirectory:
    """E-mails of the names met so far. A name is matched once for each version of the roster."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path, NAMES, grows=True)

    def known(self, version: str) -> DataFrame:
        """clean_name, email, best_score, matched_in (the version of the directory that learned it)."""
        return self.table.read().filter(F.col("roster_version") == version).drop("roster_version")

    def match(self, by_name: DataFrame, roster: DataFrame, overrides: DataFrame) -> DataFrame:
        """As match_names; only names that the directory lacks meet the roster, and are added to it."""
        version, added = roster_version(roster, overrides), self.table.latest() + 1
        names = by_name.select("clean_name").dropna()
        unseen = names.join(self.known(version).select("clean_name"), "clean_name", "left_anti")
        if not unseen.isEmpty():
            found = match_names(unseen, roster, overrides)
            self.table.write(found.select(F.lit(version).alias("roster_version"), "*", F.lit(added).cast("bigint").alias("matched_in")))
        known = self.known(version).select("clean_name", "email", "best_score")
        email = F.coalesce("email", F.lit(labels.UNMAPPED)).alias("email")  # a missing name
        return by_name.join(known, "clean_name", "left").select(*by_name.columns, email, F.coalesce("best_score", F.lit(0)).alias("best_score"))
