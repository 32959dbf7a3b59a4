"""Mapping of free-text manager names to the roster."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..functions.similarity import Block, Shelf
from ..functions.text import email_local_part
from ..sources.storage import cut_lineage
from .joins import unique_roster
from .skew import hot_keys_of, lookup_join, shuffle_width

# The tasks carry this module with them, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_NAMES = 4096  # names per block, at most
ROSTER_PACK = 1024  # roster entries per pack, at most
SHELF = 16384  # roster entries per row that travels, at most (or one pack)
LANES = 131072  # roster entries that a task gathers before its names meet them, about

def pack_roster(roster: DataFrame, pack_size: int = ROSTER_PACK) -> DataFrame:
    """The roster as rows of at most ``pack_size`` entries in roster order (``roster_seq`` is unique)."""
    entry = F.struct("roster_seq", "email", email_local_part(F.col("email")).alias("local"))
    pack = F.floor(F.col("roster_seq") / pack_size).cast("int")
    return roster.groupBy(pack.alias("pack")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))


def shelve(packs: DataFrame, pack_size: int = ROSTER_PACK) -> DataFrame:
    """Packs put together in rows of at most SHELF entries, still in roster order."""
    shelf = F.floor(F.col("pack") / max(1, SHELF // pack_size)).cast("int")
    held = packs.groupBy(shelf.alias("shelf")).agg(F.array_sort(F.collect_list(F.struct("pack", "entries"))).alias("packs"))
    return held.select("shelf", F.flatten(F.col("packs.entries")).alias("entries"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_NAMES):
            part = batch.column(0).slice(start, BLOCK_NAMES)
            ends = pa.array([0, len(part)], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, part.cast(pa.string()))], names=["names"])


def block_names(names: DataFrame) -> DataFrame:
    """Rows of at most BLOCK_NAMES names each: those that lie together, so nothing is counted or moved."""
    return names.select("clean_name").mapInArrow(_blocks, "names array<string>").withColumn("block", F.monotonically_increasing_id())


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a part: first its blocks of names, then, in roster order, the shelves they all meet."""
    blocks: list[tuple[pa.Array, Block]] = []
    shelves: list[int] = []  # and the number of the first entry of each
    firsts, n_entries, waiting = [], 0, []

    def meet() -> None:
        shelf = Shelf(waiting, n_entries - len(waiting))
        for _, block in blocks:
            block.meet(shelf)
        waiting.clear()

    for batch in batches:
        for shelf, texts in zip(batch.column("shelf").to_pylist(), batch.column("texts")):
            if shelf is None:
                blocks.append((texts.values.cast(pa.string()), Block(texts.as_py())))
            elif blocks:
                shelves.append(shelf)
                firsts.append(n_entries)
                waiting.extend(texts.as_py())
                n_entries += len(texts)
                if len(waiting) >= LANES:
                    meet()
    if waiting:
        meet()
    for names, block in blocks:
        if shelves:
            at = np.searchsorted(firsts, block.entries(), side="right") - 1
            found = [pa.array(np.array(shelves)[at], pa.int32()), pa.array(block.entries() - np.array(firsts)[at], pa.int32())]
        else:
            found = [pa.nulls(len(names), pa.int32())] * 2
        yield pa.RecordBatch.from_arrays([names, pa.array(block.scores()), *found], names=["clean_name", "score", "shelf", "entry"])


def match_names(
    by_name: DataFrame, roster: DataFrame, overrides: DataFrame, pack_size: int = ROSTER_PACK
) -> DataFrame:
    """A table of one row per ``clean_name`` with the e-mail (or Unmapped) and best score of the name.

    Every name has to meet every roster entry, though few pairs are scored to the end. Names are put in order of
    size, first letter and text, so a block (of at most BLOCK_NAMES names) shares the beginnings of its names. Blocks
    are dealt to parts, as many as shuffle partitions, and each part gets the roster once, as rows of
    several packs (shelves) that carry texts only. A task holds the names of its part and at most LANES entries and a
    shelf, and carries the best of each name on from shelf to shelf; so no pair is ever a row, and a name comes back
    once. E-mails and other columns are joined back. A missing name is Unmapped. No job runs before the result is asked for.
    """
    width = shuffle_width(by_name)
    shelves = shelve(pack_roster(roster, pack_size), pack_size).filter(F.col("shelf").isNotNull())
    text = F.array_join(F.array_sort(F.split("clean_name", " ")), " ")
    names = by_name.select("clean_name").dropna()
    ordered = [F.length("clean_name"), F.substring("clean_name", 1, 1), text, F.col("clean_name")]
    near = names.repartitionByRange(width, *ordered).sortWithinPartitions(*ordered)
    # The number of a block has its partition in the upper bits and its place there in the lower 33.
    place = F.col("block").bitwiseAND(F.lit((1 << 33) - 1)) + F.shiftright("block", 33)
    blocks = block_names(near).select(F.pmod(place, F.lit(width)).cast("int").alias("part"), F.lit(None).cast("int").alias("shelf"), F.col("names").alias("texts"))
    each_part = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("part")
    locals_ = F.transform("entries", lambda entry: entry["local"]).alias("texts")
    meetings = blocks.union(shelves.select(each_part, "shelf", locals_)).repartitionById(width, "part")
    meetings = meetings.sortWithinPartitions(F.col("shelf").asc_nulls_first()).select("shelf", "texts")
    met = meetings.mapInArrow(_meet, "clean_name string, score int, shelf int, entry int")
    entries = shelves.select("shelf", F.posexplode("entries").alias("entry", "found"))
    per_name = met.join(entries, ["shelf", "entry"], "left")
    # The maximum of (score, -roster_seq) is the highest score and, among equals, the first entry.
    ranked = F.struct("score", (-F.col("found.roster_seq")).alias("order"), F.col("found.email").alias("email"))
    best = per_name.groupBy("clean_name").agg(F.max(ranked).alias("best"))
    best = by_name.join(best, "clean_name", "left")
    score = F.coalesce("best.score", F.lit(0))
    accepted = F.when(score > labels.MATCH_THRESHOLD, F.col("best.email")).otherwise(F.lit(labels.UNMAPPED))
    override = overrides.groupBy("clean_name").agg(F.max("email").alias("override_email"))  # one e-mail per name
    return best.join(override, "clean_name", "left").select(
        *by_name.columns, F.coalesce("override_email", accepted).alias("email"), score.alias("best_score")
    )


def fuzzy_map(
    names: DataFrame, roster: DataFrame, overrides: DataFrame, pack_size: int = ROSTER_PACK
) -> DataFrame:
    """Each distinct ``clean_name`` with its e-mail and best score."""
    return match_names(cut_lineage(names.select("clean_name").distinct()), roster, overrides, pack_size)


def map_lookup(
    rows: DataFrame,
    roster: DataFrame,
    overrides: DataFrame,
    spread_by: str,
    match: Callable[[DataFrame, DataFrame, DataFrame], DataFrame] = match_names,
) -> DataFrame:
    """Rows with the ``email`` and ``team`` of their clean name.

    One pass counts the rows per name. That short table serves twice, so it is kept: its
    names are matched, and its counts show which names hold so many rows that the join has
    to cut them. ``match`` is match_names, or the form of it that keeps its results.
    """
    counts = cut_lineage(rows.groupBy("clean_name").agg(F.count(F.lit(1)).alias("n_rows")))
    teams = unique_roster(roster)
    lookup = match(counts, roster, overrides).select("clean_name", "email").join(teams, "email", "left")
    hot = hot_keys_of(counts, "clean_name", "n_rows")
    joined = lookup_join(rows, lookup, "clean_name", spread_by, hot_keys=hot)
    return joined.withColumn("team", F.coalesce("team", F.lit(labels.TEAM_UNKNOWN)))
