"""Joins of a large table to a lookup when one key may hold a third of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_HOT_KEYS = 10_000  # bound of the broadcast table of hot keys


@dataclass(frozen=True)
class HotKeys:
    """Keys that exceed a fair share of the rows: (key, pieces to cut it into)."""

    pieces: list[tuple]
    nulls: bool  # whether the missing key exceeds a fair share too


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _fair_share(counts: list[tuple], total: int, width: int) -> HotKeys:
    """Of (key, rows) pairs those above 1/width of all rows, cut into pieces of about that size."""
    hot = [(key, n) for key, n in counts if n * width > total]
    pieces = [(key, min(width, -(-n * width // total))) for key, n in hot if key is not None]
    return HotKeys(pieces, any(key is None for key, _ in hot))


def hot_keys_of(counts: DataFrame, key: str, n_rows: str) -> HotKeys:
    """Keys with more rows than one of the shuffle partitions should get, from a table of rows per key.

    Fewer than ``partitions`` keys can exceed 1/partitions of the rows and at most MAX_HOT_KEYS
    are returned, so the driver gets a short list. The counts only decide how finely a key is
    cut; a wrong estimate cannot change a result.
    """
    width = shuffle_width(counts)
    total = counts.agg(F.coalesce(F.sum(n_rows), F.lit(0))).first()[0]
    top = counts.orderBy(F.col(n_rows).desc()).limit(min(width, MAX_HOT_KEYS) + 1).select(key, n_rows).collect()
    return _fair_share([tuple(row) for row in top], total, width)


def lookup_join(
    rows: DataFrame, lookup: DataFrame, key: str, spread_by: str, how: str = "left", hot_keys: HotKeys | None = None
) -> DataFrame:
    """``rows JOIN lookup`` on ``key``, with hot keys cut into pieces of about a partition.

    Without known hot keys this is the plain join: in an inner or left join of two shuffled
    tables Spark splits the large partitions of ``rows`` itself at run time, and no pass over
    the rows is spent on looking for them. Otherwise each row of a hot key goes to one of
    the key's pieces and the lookup rows of that key are repeated once per piece; all other
    keys stay whole. ``spread_by`` is a column unique per row. It decides the piece, so a
    task that runs again after a lost executor sends every row to the same piece. Missing
    keys match nothing and are spread out as well.
    """
    if hot_keys is None or not hot_keys.pieces and not hot_keys.nulls:
        return rows.join(lookup, key, how)
    schema = T.StructType([rows.schema[key], T.StructField("pieces", T.IntegerType())])
    hot = F.broadcast(rows.sparkSession.createDataFrame(hot_keys.pieces, schema))  # <= MAX_HOT_KEYS rows
    width = shuffle_width(rows)
    whole = F.lit(1)
    parts = F.when(F.col(key).isNull(), F.lit(width)).otherwise(F.coalesce("pieces", whole))
    cut_rows = rows.join(hot, key, "left").withColumn("piece", F.pmod(F.xxhash64(spread_by), parts).cast("int"))
    each_piece = F.explode(F.sequence(F.lit(0), F.coalesce("pieces", whole) - 1))
    cut_lookup = lookup.join(hot, key, "left").withColumn("piece", each_piece)
    return cut_rows.drop("pieces").join(cut_lookup.drop("pieces"), [key, "piece"], how).drop("piece")
