"""Repeated byte spans by a range-partitioned sparse suffix array.

A byte goes when a span of `span` bytes that starts elsewhere too covers it. Only suffixes at
content-defined anchors (anchors.py) are looked at; a repeated span has its anchor at the same
place in both copies, so its anchor's suffix has an equal beginning, the gram, elsewhere.

1. Each document gives its anchors: the suffix's leading bytes, its gram's hash, the windows the
   anchor stands for, and a digest of the bytes of those windows (the context).
2. Anchors are dealt out by range of leading bytes, then gram and context (Spark samples the
   splitters), and sorted: suffixes that begin alike are neighbours. Neighbours with an equal context
   make all its windows repeats; neighbours with one gram and several contexts are left for step 3.
   A common suffix is split between ranges like any others, so the grams at the ends of a range are
   compared with those of the ranges beside it, by what each range has found out about them.
3. Contexts that share a gram but not all bytes are dealt out by range of the leading bytes again. A
   bucket sorts the suffixes of their windows by multikey quicksort and marks equal neighbours; all
   contexts of one gram are in one bucket. A gram with more than GROUP contexts is not sorted in one
   task: its windows are counted by digest instead, which Spark aggregates before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import PIECE, anchors
from .common import map_batches, spark_schema, stored

#: Contexts of one gram that one task sorts.
GROUP = 2048
_GRAM = 40
#: Windows sorted at once.
_WINDOWS = 1 << 16
_KEY = ["id", "mark"]


def _pieces(texts: list[bytes], span: int) -> Iterator[tuple[bytes, list[tuple[int, int, int, int]]]]:
    """Buffers of about PIECE bytes and what they hold: document, place in buffer, place in document, bytes."""
    parts, held, size = [], [], 0
    for doc, text in enumerate(texts):
        for start in range(0, max(len(text) - span + 1, 0), PIECE):
            part = text[start : start + PIECE + span - 1]
            if size and size + len(part) > PIECE:
                yield b"".join(parts), held
                parts, held, size = [], [], 0
            parts.append(part)
            held.append((doc, size, start, len(part)))
            size += len(part)
    if held:
        yield b"".join(parts), held


def _anchor_rows(batch: pa.RecordBatch, span: int) -> dict:
    texts = [(t or "").encode() for t in batch[2].to_pylist()]
    marks = np.asarray(batch[1])
    out: dict[str, list] = {c: [] for c in ("doc", "lead", "place", "gram", "lo", "hi", "context")}
    for data, held in _pieces(texts, span):
        valid = np.zeros(len(data) - span + 1, bool)
        for _, at, _, size in held:
            valid[at : at + size - span + 1] = True
        place, gram, lo, hi = anchors(np.frombuffer(data, np.uint8), valid, span, _GRAM)
        starts = np.array([h[1] for h in held])
        which = np.searchsorted(starts, lo, "right") - 1
        moved = np.array([h[2] - h[1] for h in held])[which]
        digest = xxhash.xxh3_64_intdigest
        context = [digest(data[i:j]) for i, j in zip(lo.tolist(), (hi + span).tolist())]
        out["doc"].append(np.array([h[0] for h in held])[which])
        out["context"].append(np.array(context, np.uint64).view(np.int64))
        out["gram"].append(gram.view(np.int64))
        out["lead"].append(_leading(data, place))
        for name, values in (("place", place), ("lo", lo), ("hi", hi)):
            out[name].append((values + moved).astype(np.int32))
    if not out["doc"]:
        return None
    rows = {name: np.concatenate(values) for name, values in out.items()}
    doc = rows.pop("doc")
    return {"id": batch[0].take(pa.array(doc)), "mark": marks[doc], **rows}


def _leading(data: bytes, place: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as a number that sorts as they do."""
    values = np.frombuffer(data + bytes(8), np.uint8)
    words = np.stack([values[place + i] for i in range(8)], axis=1)
    return (np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)


_ANCHORS = pa.schema(
    [("id", pa.int64()), ("mark", pa.int64()), ("lead", pa.int64()), ("gram", pa.int64()), ("context", pa.int64()), ("place", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())]
)
_WHOLE, _PART, _EDGE = 0, 1, 2
_NEIGHBOURS = pa.schema([("kind", pa.int32()), *[f for f in _ANCHORS if f.name != "lead"], ("n", pa.int64())])
#: Anchors compared at once.
_ROWS_HELD = 1 << 16


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors in order of lead, gram and context: those whose context a neighbour has too (_WHOLE); of each other
    context that shares its gram, one anchor and their number (_PART). The first and last gram of the range may go on
    in others: one anchor of each of their contexts, and their number (_EDGE).
    """
    held: list[pa.RecordBatch] = []
    first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if first is None:
            first = batch.column("gram")[0].as_py()
        held.append(batch)
        if sum(b.num_rows for b in held) >= _ROWS_HELD:
            rows = pa.Table.from_batches(held).combine_chunks()
            gram = rows["gram"].to_numpy()
            others = np.flatnonzero(gram != gram[-1])
            cut = int(others[-1]) + 1 if len(others) else 0  # the last gram may go on
            if cut:
                yield from _compared(rows.slice(0, cut), {first})
            held = rows.slice(cut).to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield from _compared(rows, {first, rows["gram"][rows.num_rows - 1].as_py()})


def _compared(rows: pa.Table, edges: set[int]) -> Iterator[pa.RecordBatch]:
    gram, context = rows["gram"].to_numpy(), rows["context"].to_numpy()
    new_gram = np.concatenate(([True], gram[1:] != gram[:-1]))
    starts = np.flatnonzero(new_gram | np.concatenate(([True], context[1:] != context[:-1])))
    n = np.diff(np.append(starts, len(gram)))
    of_gram = np.cumsum(new_gram)[starts] - 1
    several = np.bincount(of_gram)[of_gram] > 1
    edge = np.isin(gram[starts], list(edges))
    again = np.flatnonzero(np.repeat(n > 1, n))
    for kind, at, number in ((_WHOLE, again, np.zeros(len(again), np.int64)), (_PART, starts[several & ~edge], n[several & ~edge]), (_EDGE, starts[edge], n[edge])):
        chosen = rows.take(pa.array(at))
        columns = {"kind": pa.array(np.full(len(at), kind, np.int32)), "n": pa.array(number)}
        yield from pa.table([columns[f.name] if f.name in columns else chosen[f.name] for f in _NEIGHBOURS], schema=_NEIGHBOURS).to_batches(max_chunksize=10_000)


_SUFFIXES = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("lead", pa.binary()), ("gram", pa.int64()), ("lo", pa.int32()), ("alone", pa.bool_()), ("bytes", pa.binary()), ("digest", pa.binary())])


def _suffix_rows(batch: pa.RecordBatch, span: int) -> dict:
    """Contexts with their bytes; of a gram with too many contexts, one row for each window."""
    out: dict[str, list] = {f.name: [] for f in _SUFFIXES}
    for doc_id, mark, text, wanted in zip(*(batch[c].to_pylist() for c in range(4))):
        data = (text or "").encode()
        for w in wanted:
            for at in range(w["lo"], w["hi"] + 1) if w["hot"] else (w["lo"],):
                row = {"id": doc_id, "mark": mark, "lead": data[w["place"] : w["place"] + 16], "gram": w["gram"], "lo": at, "alone": w["n"] == 1}
                row |= {"bytes": None, "digest": xxhash.xxh3_128_digest(data[at : at + span])} if w["hot"] else {"bytes": data[w["lo"] : w["hi"] + span], "digest": None}
                for name, value in row.items():
                    out[name].append(value)
    return out


def multikey_quicksort(suffixes: list[bytes]) -> list[int]:
    """Order of byte strings of one length: three-way partition by one 8-byte word after the other."""
    if not suffixes:
        return []
    length = len(suffixes[0])
    width = -(-length // 8)
    words = np.frombuffer(b"".join(s.ljust(width * 8, b"\0") for s in suffixes), ">u8").reshape(-1, width).astype(np.uint64)
    done: list[np.ndarray | list[int]] = []
    stack = [(np.arange(len(suffixes)), 0)]
    while stack:
        rows, depth = stack.pop()
        if depth == width or len(rows) < 2:
            done.append(rows)
        elif len(rows) <= 512:
            done.append(sorted(rows.tolist(), key=lambda i: suffixes[i][8 * depth :]))
        else:
            column = words[rows, depth]
            pivot = np.partition(column, len(column) // 2)[len(column) // 2]
            stack.append((rows[column > pivot], depth))
            stack.append((rows[column == pivot], depth + 1))
            stack.append((rows[column < pivot], depth))
    return np.concatenate([np.asarray(d, np.int64) for d in done]).tolist()


def _runs(at: list[int]) -> Iterator[tuple[int, int]]:
    start = before = at[0]
    for place in at[1:]:
        if place != before + 1:
            yield start, before
            start = place
        before = place
    yield start, before


def _sort_bucket(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """batches: contexts in order of lead and gram. Spans of contexts that occur once and repeat in part."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        suffixes = [r[5][i : i + span] for r in rows for i in range(len(r[5]) - span + 1)]
        owner = [k for k, r in enumerate(rows) for _ in range(len(r[5]) - span + 1)]
        place = [i for r in rows for i in range(len(r[5]) - span + 1)]
        order = multikey_quicksort(suffixes)
        found: dict[int, list[int]] = {}
        for left, right in zip(order, order[1:]):
            if suffixes[left] == suffixes[right]:
                for i in (left, right):
                    found.setdefault(owner[i], []).append(place[i])
        out = [
            (rows[k][0], rows[k][1], rows[k][3] + i, rows[k][3] + j + span)
            for k, at in found.items()
            if rows[k][4]
            for i, j in _runs(sorted(set(at)))
        ]
        columns = zip(*out) if out else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPANS)], schema=_SPANS)

    held: list[tuple] = []
    windows = 0
    for batch in batches:
        for row in zip(*(batch[c].to_pylist() for c in range(6))):
            if windows >= _WINDOWS and row[2] != held[-1][2]:
                yield flush(held)
                held, windows = [], 0
            held.append(row)
            windows += len(row[5]) - span + 1
    if held:
        yield flush(held)


_SPANS = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("mark", F.xxhash64(text))


def repeated_spans(docs: DataFrame, span: int = 200) -> DataFrame:
    """(id, mark, start, end): pieces of texts whose every byte a repeated span covers; they may overlap.

    docs: id (may be null or repeat), text. mark is a hash of the text: rows with the same id and
    mark are copies of each other and have the same pieces.
    """
    keyed = _keyed(docs).select("id", "mark", "text")
    found = map_batches(keyed, lambda batch: _anchor_rows(batch, span), _ANCHORS)
    found = stored(found, "anchors")
    order = ["lead", "gram", "context", "id", "lo"]
    found = found.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(found.mapInArrow(_neighbours, spark_schema(_NEIGHBOURS)), "neighbours")
    one = [*_KEY, "place", "lo", "hi", "gram"]
    # What lies at the ends of the ranges: the contexts of a gram or two of each range.
    edges = found.filter(F.col("kind") == _EDGE)
    totals = edges.groupBy("gram", "context").agg(F.sum("n").alias("n"), F.min(F.struct(*_KEY, "place", "lo", "hi")).alias("first"))
    totals = stored(totals, "edges")
    across = edges.filter("n = 1").join(totals.filter("n > 1").select("gram", "context"), ["gram", "context"], "left_semi")
    whole = found.filter(F.col("kind") == _WHOLE).select(*one).unionByName(across.select(*one))
    whole = whole.select(*_KEY, F.col("lo").alias("start"), (F.col("hi") + span).alias("end"))
    mixed = totals.groupBy("gram").agg(F.count("*").alias("m")).filter("m > 1").select("gram")
    at_ends = totals.join(mixed, "gram", "left_semi").select("first.*", "gram", "n")
    border = found.filter(F.col("kind") == _PART).select(*one, "n").unionByName(at_ends.select(*one, "n"))
    border = stored(border, "border")
    many = border.groupBy("gram").agg(F.count("*").alias("m")).filter(F.col("m") > GROUP).select("gram", F.lit(True).alias("many"))
    border = border.join(many, "gram", "left").withColumn("hot", F.coalesce("many", F.lit(False))).drop("many")
    wanted = border.groupBy(*_KEY).agg(F.collect_list(F.struct("place", "lo", "hi", "gram", "n", "hot")).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"id": "wanted_id", "mark": "wanted_mark"})
    once = keyed.join(wanted, F.col("id").eqNullSafe(F.col("wanted_id")) & (F.col("mark") == F.col("wanted_mark"))).dropDuplicates(_KEY)
    suffixes = map_batches(once.select("id", "mark", "text", "wanted"), lambda batch: _suffix_rows(batch, span), _SUFFIXES)
    suffixes = stored(suffixes, "suffixes")
    sorted_ = suffixes.filter("digest is null").select("id", "mark", "gram", "lo", "alone", "bytes", "lead")
    sorted_ = sorted_.repartitionByRange("lead", "gram").sortWithinPartitions("lead", "gram").drop("lead")
    by_sort = sorted_.mapInArrow(lambda batches: _sort_bucket(batches, span), spark_schema(_SPANS))
    counted = suffixes.filter("digest is not null")
    again = stored(counted.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest"), "again")
    by_count = counted.filter("alone").join(again, "digest", "left_semi").select("id", "mark", F.col("lo").alias("start"), (F.col("lo") + span).alias("end"))
    return whole.unionByName(by_sort).unionByName(by_count)


def _cut(text: str | None, pieces: list | None) -> tuple[bytes, bytes, int]:
    """The text's bytes, those left, and the number of maximal removed runs."""
    data = (text or "").encode()
    gone: list[list[int]] = []
    for start, end in sorted((p["start"], p["end"]) for p in pieces or ()):
        if gone and start <= gone[-1][1]:
            gone[-1][1] = max(gone[-1][1], end)
        else:
            gone.append([start, end])
    edges = [0, *(edge for run in gone for edge in run), len(data)]
    return data, b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2])), len(gone)


def _with_pieces(docs: DataFrame, span: int) -> DataFrame:
    keyed = _keyed(docs)
    pieces = repeated_spans(docs.select("id", "text"), span)
    # Rows of one id and text have the same pieces: as a set they are no more than the text has anchors.
    pieces = pieces.groupBy(*_KEY).agg(F.collect_set(F.struct("start", "end")).alias("pieces"))
    pieces = pieces.withColumnsRenamed({"id": "piece_id", "mark": "piece_mark"})
    same = F.col("id").eqNullSafe(F.col("piece_id")) & (F.col("mark") == F.col("piece_mark"))
    return keyed.join(pieces, same, "left").drop("mark", "piece_id", "piece_mark")


_REMOVED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def removal_digest(docs: DataFrame, span: int = 200) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts count as empty; texts shorter than the span lose nothing; of repeated rows each
    loses all that a span covers. A null doc_id is kept. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))

    def make(batch: pa.RecordBatch) -> dict:
        cut = [_cut(*row) for row in zip(batch[1].to_pylist(), batch[2].to_pylist())]
        return {
            "doc_id": batch[0],
            "n_bytes": [len(data) for data, _, _ in cut],
            "n_removed": [len(data) - len(left) for data, left, _ in cut],
            "n_spans": [n for _, _, n in cut],
            "kept_sha256": [hashlib.sha256(left).hexdigest() for _, left, _ in cut],
        }

    return map_batches(_with_pieces(docs, span).select("id", "text", "pieces"), make, _REMOVED)


def without_repeats(docs: DataFrame, span: int = 200) -> DataFrame:
    """`docs`, all columns, with every repeated span cut out of `text` (what is left of a split character is dropped).

    A document's other copies lose the span too, as the contract of removal says; no row goes. Null
    texts stay null, empty and short ones as they are; repeated rows are cut alike, with or without a
    doc_id; an empty table stays empty.
    """
    names = docs.columns
    held = docs.select(F.col("doc_id").alias("id"), F.col("text"), F.struct("*").alias("doc"))

    @F.pandas_udf("string")
    def left(text, pieces):
        cut = [None if t is None else _cut(t, None if p is None else list(p))[1].decode("utf-8", "ignore") for t, p in zip(text, pieces)]
        return pd.Series(cut, dtype=object)

    rows = _with_pieces(held.select("id", "text", "doc"), span)
    changed = F.when(F.col("pieces").isNull(), F.col("text")).otherwise(left("text", "pieces"))
    return rows.select(*[(changed if c == "text" else F.col(f"doc.`{c}`")).alias(c) for c in names])
