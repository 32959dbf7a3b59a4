"""Repair of conversations by weighted interval parsing.

A repaired conversation has an optional system row, then user and assistant rows in turn, or nothing.
Its roles' initials are the language (s?(ua)+)?, and the repair grammar derives every conversation
from it: a row may be kept, given another role, or deleted, and rows may be inserted, each at a cost.

In Chomsky normal form the nonterminals are pairs [p, q] of places in the pattern: [p, q] derives
the edited rows that lead from p to q. [p, q] -> row is an edit of one row, [p, q] -> [p, r] [r, q]
joins two neighbouring spans, and insertions close every span on both sides. A cell holds the
cheapest (cost, audit) of a span for each nonterminal; spans are combined bottom-up by length. As the
nonterminals name both ends of a span, each way to split it gives the same cell, so spans of 1, 2,
4, 8 ... rows suffice. (Equal costs mean equally many insertions after equal edits, so no audit is
the beginning of another of the same cell and ASCII order survives concatenation.)

Spans of a block are combined in a task, blocks of a conversation by Spark level by level, so a
conversation may hold any share of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spark_schema, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Places in the pattern, and where a role's initial leads: start, after s, after u, after a.
_PLACES = 4
_STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_ENDS = (0, 3)
_ROLES = {"u": "user", "a": "assistant"}
#: Nonterminals [p, q]: those that some edited rows can derive.
_PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
_RULES = {(p, q): [(p, r, q) for r in range(_PLACES) if (p, r) in _PAIRS and (r, q) in _PAIRS] for p, q in _PAIRS}
_BLANK = " \t\n\x0b\x0c\r"
#: Rows of a block, and blocks joined at a time.
_BLOCK_BITS, _FAN = 8, 64
#: Characters of a row that its range is chosen by.
_LEAD = 256

Cells = dict[tuple[int, int], tuple[int, str]]


def _least(cells: Cells, pair: tuple[int, int], cost: int, audit: str) -> None:
    if pair in _RULES and (pair not in cells or (cost, audit) < cells[pair]):
        cells[pair] = (cost, audit)


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts."""
    out: Cells = {}
    for pair, rules in _RULES.items():
        best = None
        for p, r, q in rules:
            if (p, r) in left and (r, q) in right:
                (c0, a0), (c1, a1) = left[p, r], right[r, q]
                if best is None or c0 + c1 < best[0]:
                    best = (c0 + c1, a0 + a1)
                elif c0 + c1 == best[0]:
                    best = min(best, (c0 + c1, a0 + a1))
        if best is not None:
            out[pair] = best
    return out


def _inserted() -> Cells:
    """Insertions alone: rows of either role that lead from one place to another."""
    cells: Cells = {(p, p): (0, "") for p in range(_PLACES)}
    for _ in range(_PLACES):
        for (p, q), (cost, audit) in list(cells.items()):
            for initial in _ROLES:
                if (q, initial) in _STEPS:
                    _least(cells, (p, _STEPS[q, initial]), cost + INSERT, audit + "I")
    return cells


_CLOSURE = _inserted()


def row_cells(initial: str, must_go: bool, truncated: bool) -> Cells:
    """Cells of one row: its edits, closed under insertions."""
    cells: Cells = {}
    for p in range(_PLACES):
        _least(cells, (p, p), DELETE, "D")
        if not must_go:
            extra = TRUNCATED if truncated else 0
            if (p, initial) in _STEPS:
                _least(cells, (p, _STEPS[p, initial]), KEEP + extra, "K")
            for other in _ROLES:
                if (p, other) in _STEPS:
                    _least(cells, (p, _STEPS[p, other]), REROLE + extra, "R")
    return joined(joined(_CLOSURE, cells), _CLOSURE)


def deleted_cells(n: int) -> Cells:
    """Cells of n rows that all must go."""
    return joined(joined(_CLOSURE, {(p, p): (n * DELETE, "D" * n) for p in range(_PLACES)}), _CLOSURE)


def span_cells(parts: list[Cells]) -> Cells:
    """Cells of a span of neighbouring spans, combined by length: neighbours first, then pairs of them."""
    while len(parts) > 1:
        parts = [joined(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else dict(_CLOSURE)


def best(cells: Cells) -> tuple[int, str]:
    """The cheapest repair of a whole conversation; of equally cheap ones the ASCII-least audit."""
    return min(cells[0, q] for q in _ENDS if (0, q) in cells)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n) of the rows after damage, equal rows of a turn counted once.

    The crc32 of `conv_id:turn`, modulo 20, drops a row (0), empties its text (1), takes its stops
    out (2), repeats it (3) or makes it the user's (4). A null is one space.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(key) % 20).alias("kind"),
    ).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("n"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _with_faults(rows: DataFrame) -> DataFrame:
    """blank, duplicate, truncated: the first fault of each row; copies of a sound row are duplicates."""
    rows = rows.withColumn("mark", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    firsts = rows.groupBy(F.col("conv_id").alias("in_conv"), F.col("mark").alias("of_mark")).agg(F.min(order).alias("first"))
    rows = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("mark") == F.col("of_mark")))
    ends = F.rtrim(F.col("text"), F.lit(_BLANK))
    blank = ends == ""
    duplicate = ~blank & (order != F.col("first"))
    truncated = ~blank & ~duplicate & ~F.substring(ends, -1, 1).isin(".", "!", "?")
    rows = rows.withColumn("blank", blank).withColumn("duplicate", duplicate).withColumn("truncated", truncated)
    return rows.drop("mark", "in_conv", "of_mark", "first")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with their faults and `place`, which follows the order of a conversation: by turn (nulls first), then `role:text`.

    Rows are dealt by ranges of conversation, turn and the line's first characters, so a long
    conversation lies in several partitions, one after another.
    """
    line = F.concat_ws(":", "role", "text")
    lead = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.substring(line, 1, _LEAD).asc()]
    rows = _with_faults(rows).repartitionByRange(*lead).sortWithinPartitions(*lead[:2], line.asc(), "role")
    return stored(rows.withColumn("place", F.monotonically_increasing_id()), "ordered")


_CELL = pa.struct([("cost", pa.int64()), ("audit", pa.string())])
_BLOCKS = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("n", pa.int64()), ("illegal", pa.int64()), ("cells", pa.list_(_CELL))])
_LEGAL = ("su", "ua", "au")


def _listed(cells: Cells) -> list[dict | None]:
    return [None if pair not in cells else {"cost": cells[pair][0], "audit": cells[pair][1]} for pair in _PAIRS]


def _read(cells: list[dict | None]) -> Cells:
    return {pair: (cell["cost"], cell["audit"]) for pair, cell in zip(_PAIRS, cells) if cell is not None}


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of so many rows: each may hold a long list or text."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _run_of(initial: str, must_go: bool, truncated: bool, n: int) -> Cells:
    """Cells of a row and its copies, which must go."""
    first = row_cells(initial, must_go, truncated)
    return joined(first, deleted_cells(n - 1)) if n > 1 else first


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows (conv_id, block, rows in order) to cells."""
    memo: dict[tuple, Cells] = {}
    for batch in _few(batches, 64):
        out = {f.name: [] for f in _BLOCKS}
        for conv_id, block, rows in zip(*(c.to_pylist() for c in batch.columns)):
            parts, illegal = [], 0
            for row, after in zip(rows, [*rows[1:], None]):
                kind = (row["initial"], row["blank"] or row["duplicate"], row["truncated"], row["n"])
                cells = memo.get(kind) or _run_of(*kind)
                if row["n"] < 3 and len(memo) < 10_000:
                    memo[kind] = cells
                parts.append(cells)
                illegal += row["n"] - 1  # a copy follows its like
                illegal += after is not None and row["initial"] + after["initial"] not in _LEGAL
            values = (conv_id, block, rows[0]["initial"], rows[-1]["initial"], sum(r["n"] for r in rows), illegal, _listed(span_cells(parts)))
            for name, value in zip(out, values):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _BLOCKS], schema=_BLOCKS)


def _join_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring blocks (conv_id, block, blocks in order) to one."""
    for batch in _few(batches, 16):
        out = {f.name: [] for f in _BLOCKS}
        for conv_id, block, parts in zip(*(c.to_pylist() for c in batch.columns)):
            seams = sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:]))
            illegal = seams + sum(p["illegal"] for p in parts)
            cells = span_cells([_read(p["cells"]) for p in parts])
            values = (conv_id, block, parts[0]["first"], parts[-1]["last"], sum(p["n"] for p in parts), illegal, _listed(cells))
            for name, value in zip(out, values):
                out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _BLOCKS], schema=_BLOCKS)


def blocks(rows: DataFrame) -> DataFrame:
    """(conv_id, block, first, last, n, illegal, cells) of each run of up to 256 neighbouring rows of a conversation."""
    row = F.struct("place", F.substring("role", 1, 1).alias("initial"), "blank", "duplicate", "truncated", "n")
    made = rows.groupBy("conv_id", F.shiftright("place", _BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return stored(made.mapInArrow(_parse, spark_schema(_BLOCKS)), "blocks")


def parsed(parts: DataFrame) -> DataFrame:
    """(conv_id, n, illegal, cells) of whole conversations: blocks are joined, _FAN at a time, until each has one."""
    while True:
        most = parts.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts.drop("block", "first", "last")
        place = F.row_number().over(Window.partitionBy("conv_id").orderBy("block")) - 1
        whole = F.struct("block", *[f.name for f in _BLOCKS if f.name not in ("conv_id", "block")])
        grouped = parts.withColumn("next", F.floor(place / _FAN).cast("long")).groupBy("conv_id", "next").agg(F.sort_array(F.collect_list(whole)).alias("parts"))
        parts = stored(grouped.mapInArrow(_join_blocks, spark_schema(_BLOCKS)), "blocks")


_CHOSEN = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _few(batches, 256):
        found = [best(_read(cells)) for cells in batch.column("cells").to_pylist()]
        columns = [*(batch.column(c) for c in ("conv_id", "n", "illegal")), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, schema=_CHOSEN)


_SLICES = pa.schema([("in_conv", pa.int64()), ("of_block", pa.int64()), ("audit", pa.string()), ("made", pa.int64()), ("system", pa.int64())])


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (conv_id, audit, blocks as (block, n) in order): the edits of each block's rows, and the repaired rows before them.

    The insertions after the last row belong to its block. User and assistant rows come in pairs, so
    an odd number of repaired rows says that there is a system row.
    """
    for batch in _few(batches, 256):
        out = {f.name: [] for f in _SLICES}
        for conv_id, audit, parts in zip(*(c.to_pylist() for c in batch.columns)):
            at, made, system = 0, 0, (len(audit) - audit.count("D")) % 2
            for k, part in enumerate(parts):
                start, left = at, part["n"]
                while left:
                    left -= audit[at] != "I"
                    at += 1
                end = len(audit) if k + 1 == len(parts) else at
                for name, value in zip(out, (conv_id, part["block"], audit[start:end], made, system)):
                    out[name].append(value)
                made += at - start - audit.count("D", start, at)
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _SLICES], schema=_SLICES)


_EDITS = pa.schema([("of_place", pa.int64()), ("before", pa.list_(pa.string())), ("becomes", pa.string()), ("after", pa.list_(pa.string()))])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (rows in order, audit, made, system): roles inserted before and after each row, and its own: null if it goes, empty if kept."""
    for batch in _few(batches, 64):
        out = {f.name: [] for f in _EDITS}
        for rows, audit, made, system in zip(*(c.to_pylist() for c in batch.columns)):
            letters = iter(audit)
            for k, row in enumerate(rows):
                before, after, becomes, left = [], [], None, row["n"]
                while left or k + 1 == len(rows):
                    edit = next(letters, None)
                    if edit is None:
                        break
                    due = "assistant" if (made - system) % 2 else "user"
                    if edit == "I":
                        (before if left == row["n"] else after).append(due)
                    else:
                        left -= 1
                        becomes = {"K": "", "R": due, "D": becomes}[edit]
                    made += edit != "D"
                for name, value in zip(out, (row["place"], before, becomes, after)):
                    out[name].append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _EDITS], schema=_EDITS)


def _same_conversation():
    return F.col("conv_id").eqNullSafe(F.col("in_conv"))


def _repaired(rows: DataFrame, parts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(conv_id, place, number, role, text) of the repaired rows, in the order of place and number."""
    pieces = parts.groupBy(F.col("conv_id").alias("in_conv")).agg(F.sort_array(F.collect_list(F.struct("block", "n"))).alias("blocks"))
    pieces = chosen.join(pieces, _same_conversation()).select("conv_id", "audit", "blocks")
    slices = pieces.mapInArrow(_slices, spark_schema(_SLICES))
    block = F.shiftright("place", _BLOCK_BITS).alias("block")
    grouped = rows.groupBy("conv_id", block).agg(F.sort_array(F.collect_list(F.struct("place", "n"))).alias("rows"))
    grouped = grouped.join(slices, _same_conversation() & (F.col("block") == F.col("of_block"))).select("rows", "audit", "made", "system")
    edits = grouped.mapInArrow(_edits, spark_schema(_EDITS))
    edited = rows.join(edits, F.col("place") == F.col("of_place"))
    new = lambda role: F.struct(role.alias("role"), F.lit("").alias("text"))
    role = F.when(F.col("becomes") == "", F.col("role")).otherwise(F.col("becomes"))
    own = F.filter(F.array(F.struct(role.alias("role"), "text")), lambda x: x["role"].isNotNull())
    lines = F.concat(F.transform("before", new), own, F.transform("after", new))
    return edited.select("conv_id", "place", F.posexplode(lines).alias("number", "line")).select("conv_id", "place", "number", "line.*")


_HASHES = pa.schema([("in_conv", pa.int64()), ("repaired_sha256", pa.string())])
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (conv_id, line) in order: a hash of each conversation, which is never held whole."""
    current, digest, started = None, hashlib.sha256(), False
    out: list[tuple] = []
    for batch in _few(batches, 1024):
        for conv_id, line in zip(*(c.to_pylist() for c in batch.columns)):
            if started and conv_id == current:
                digest.update(b"\n")
            else:
                if started:
                    out.append((current, digest.hexdigest()))
                current, digest, started = conv_id, hashlib.sha256(), True
            digest.update(line.encode())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], f.type) for i, f in enumerate(_HASHES)], schema=_HASHES)
        out = []
    if started:
        yield pa.RecordBatch.from_arrays([pa.array([current]).cast(pa.int64()), pa.array([digest.hexdigest()])], schema=_HASHES)


def _parsed(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows in order, blocks, and (conv_id, n, illegal, cost, audit) of each conversation that has rows."""
    rows = ordered(damaged(conversations))
    parts = blocks(rows)
    return rows, parts, stored(parsed(parts).select("conv_id", "n", "illegal", "cells").mapInArrow(_choose, spark_schema(_CHOSEN)), "chosen")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, place (order within a conversation), number (order within a place), role, text."""
    return _repaired(*_parsed(conversations))


def repairs(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations: conv_id, turn, role, text; other columns are not read. A null conv_id is a
    conversation of its own, null turns come first, null roles and texts are one space. Rows of one
    turn come in the order of `role:text`; repeated rows are duplicates. A role that starts with no
    letter of the pattern, the empty one included, can only be changed or deleted. A conversation
    without rows after damage has zeros, an empty audit and the hash of nothing; an empty table
    gives no rows. The audit is one string, so a conversation has fewer than 2^31 edits.
    """
    rows, parts, chosen = _parsed(conversations)
    sound = ~F.col("blank") & ~F.col("duplicate")
    count = lambda n: F.sum(n).cast("long")
    measures = rows.groupBy(F.col("conv_id").alias("in_conv")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        count(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        count(F.when(F.col("duplicate"), F.col("n")).when(sound, F.col("n") - 1).otherwise(0)).alias("duplicate"),
        count(F.col("truncated").cast("int")).alias("truncated"),
    )
    lines = _repaired(rows, parts, chosen).select("conv_id", "place", "number", F.concat_ws(":", "role", "text").alias("line"))
    in_order = lines.repartition("conv_id").sortWithinPartitions("conv_id", "place", "number")
    hashes = in_order.select("conv_id", "line").mapInArrow(_hash, spark_schema(_HASHES))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for more in (measures, chosen.withColumnRenamed("conv_id", "in_conv").drop("n"), hashes):
        out = out.join(more, _same_conversation(), "left").drop("in_conv")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    numbers = [zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_HASH)).alias("repaired_sha256"))
