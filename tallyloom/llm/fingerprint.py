"""Context-triggered piecewise hashing.

A rolling hash of seven bytes ends a chunk wherever it takes a certain value modulo the block size.
Each chunk gives one of 64 characters; the signatures at a block size and at twice that size form
the fingerprint. The block size is the largest at which the signature has enough characters, so it
follows the length of the text. Two fingerprints are compared by the edit distance of signatures at
a block size that both have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ROWS, spark_schema, stored

_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_LEAST, _LENGTH, _COMMON = 3, 64, 7
_WINDOW = 7
_STEP, _BACK = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(11).integers(0, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 16) * 2
        _tables[:] = [np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size, m, np.uint64)))) for m in (_STEP, _BACK)]
    return _tables


def _signature(sums: np.ndarray, ends: np.ndarray, n: int) -> str:
    """One character for each chunk; what follows the last boundary is a chunk too."""
    if len(ends) >= _LENGTH:  # the last character takes all that is left
        ends = ends[: _LENGTH - 1]
    ends = np.append(ends, n) if not len(ends) or ends[-1] < n else ends
    starts = np.concatenate(([0], ends[:-1]))
    value = (sums[ends] - sums[starts]) * _powers(n)[1][starts]
    value ^= value >> np.uint64(32)
    value *= _STEP
    return _LETTERS[(value >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    """block size : signature : signature at twice the block size; of no bytes, 3::."""
    n = len(data)
    if not n:
        return f"{_LEAST}::"
    values = np.frombuffer(data, np.uint8)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[values] * up[:n], out=sums[1:])
    roll = np.zeros(0, np.uint64)
    if n >= _WINDOW:
        roll = (sums[_WINDOW:] - sums[:-_WINDOW]) * down[: n - _WINDOW + 1]
        roll ^= roll >> np.uint64(33)
        roll *= _STEP
        roll >>= np.uint64(16)
    size = _LEAST
    while size * _LENGTH < n:
        size *= 2
    while True:
        ends = np.flatnonzero(roll % np.uint64(size) == np.uint64(size - 1)) + _WINDOW
        if size == _LEAST or len(ends) + 1 >= _LENGTH // 2:
            break
        size //= 2
    wide = ends[roll[ends - _WINDOW] % np.uint64(2 * size) == np.uint64(2 * size - 1)]
    return f"{size}:{_signature(sums, ends, n)}:{_signature(sums, wide, n)}"


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with one bit for each character of a."""
    if not a:
        return 0
    full = (1 << len(a)) - 1
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    rest = full
    for c in b:
        u = rest & masks.get(c, 0)
        rest = (rest + u | rest - u) & full
    return len(a) - rest.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    short = min(len(a), len(b))
    if not short:
        return 0.0
    if short >= _COMMON:  # unlike texts share characters, but no run of them
        runs = {a[i : i + _COMMON] for i in range(len(a) - _COMMON + 1)}
        if runs.isdisjoint(b[i : i + _COMMON] for i in range(len(b) - _COMMON + 1)):
            return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """1 minus the edit distance (insertions and deletions) over both lengths, at the best block size in common."""
    if a == b:
        return 1.0
    size_a, *signatures_a = a.split(":")
    size_b, *signatures_b = b.split(":")
    at_a = {int(size_a): signatures_a[0], 2 * int(size_a): signatures_a[1]}
    at_b = {int(size_b): signatures_b[0], 2 * int(size_b): signatures_b[1]}
    return max((_alike(s, at_b[size]) for size, s in at_a.items() if size in at_b), default=0.0)


_ROWS = pa.schema(
    [(c, t) for c, t in zip(
        ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"),
        (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()),
    )]
)


_INSIDE, _HEAD, _TAIL = 0, 1, 2
_WALKED = pa.schema([*_ROWS, ("edge", pa.int32()), ("part", pa.int32()), ("text", pa.string())])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, text) in order: each row compared with the next; the first and the last row of the task as its edges."""
    part, before = TaskContext.get().partitionId(), None
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            out: list[tuple] = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.slice(start, ROWS).columns)):
                row = (doc_id, text or "", fingerprint((text or "").encode()))
                if before is None:
                    out.append(_edge(row, _HEAD, part))
                else:
                    out.append((*_compare(*before, row[1], row[2]), _INSIDE, part, None))
                before = row
            yield _batch(out, _WALKED)
    if before is not None:
        yield _batch([_edge(before, _TAIL, part)], _WALKED)


def _edge(row: tuple, edge: int, part: int) -> tuple:
    return (row[0], None, None, None, None, None, None, edge, part, row[1])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, text, following text): the last rows of the tasks."""
    for batch in batches:
        for start in range(0, batch.num_rows, 16):
            rows = zip(*(c.to_pylist() for c in batch.slice(start, 16).columns))
            yield _batch([_compare(d, t, fingerprint(t.encode()), f, fingerprint(f.encode())) for d, t, f in rows], _ROWS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _compare(doc_id: int | None, text: str, own: str, following: str, near: str) -> tuple:
    third = len(text) // 3
    edited = (text[: len(text) - third] + following[:third]).encode()
    changed = fingerprint(edited)
    return doc_id, len(text), hashlib.sha256(edited).hexdigest(), own, changed, likeness(own, changed), likeness(own, near)


def compared(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and the likeness to that and to the next document's.

    Documents follow each other by falling doc_id, nulls last, rows of one id by a hash of the text;
    after the last comes the first (a single document follows itself). Null texts are empty. Other
    columns are not read. The documents are range partitioned in this order, so that rows of one id
    or without one spread as well; each task compares its rows in passing, and its last row is joined
    with the first of the next task that has rows. ``partitions`` is the number of ranges, Spark's
    choice unless given.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("nth", F.monotonically_increasing_id())  # copies spread too
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash").asc(), F.col("nth").asc()]
    dealt = rows.repartitionByRange(*([partitions] if partitions else []), *order).sortWithinPartitions(*order)
    walked = stored(dealt.select("doc_id", "text").mapInArrow(_walk, spark_schema(_WALKED)), "walked")
    tails, heads = (walked.filter(F.col("edge") == edge).select("part", "doc_id", "text") for edge in (_TAIL, _HEAD))
    parts = heads.select("part").orderBy("part")  # a number for each task
    follows = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    pairs = tails.join(parts.select("part", follows.alias("next_part")), "part")
    heads = heads.select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    ends = pairs.join(heads, "next_part").select("doc_id", "text", "following").mapInArrow(_across, spark_schema(_ROWS))
    return walked.filter(F.col("edge") == _INSIDE).select(*_ROWS.names).unionByName(ends)
