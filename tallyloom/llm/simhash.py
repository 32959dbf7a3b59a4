"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint is the bitwise majority of the XXH64 values of a text's word shingles. Distinct
fingerprints are linked where they differ in at most `radius` bits: the 64 bits are cut into
blocks, and two such fingerprints agree on all but `radius` of them, so one table for each choice
of agreeing blocks brings every linked pair into one bucket. Inside the buckets fingerprints lie
as vertical bit planes: one 64-bit word holds one bit of 64 fingerprints. A shift of the planes
compares each fingerprint with the one `d` places on; carry-save counters add the differing bits
of 64 comparisons at once, and words all of whose comparisons exceed the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, map_batches, numbered, stored

SEED = 42
#: Fingerprints that one task compares with each other; larger buckets are cut into pairs of parts.
BUCKET = 16384
#: Rows gathered before their bit planes are laid out.
_ROWS = 1 << 16
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """Signed 64-bit SimHash of one text; 0 without words, the whole sequence if it has fewer words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(words_per_shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(line[i:j], SEED) for i, j in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_column: str, words_per_shingle: int) -> DataFrame:
    """(id_column, fp) of every row."""
    schema = pa.schema([(id_column, pa.int64()), ("fp", pa.int64())])

    def make(batch: pa.RecordBatch) -> dict:
        return {id_column: batch[0], "fp": [fingerprint(t, words_per_shingle) for t in batch[1].to_pylist()]}

    return map_batches(docs.select(F.col(id_column).cast("long"), F.col("text").cast("string")), make, schema)


def agreement_masks(radius: int, rows: int) -> list[int]:
    """Bit masks, as signed longs, one for each choice of blocks that must agree.

    The number of blocks grows with the number of fingerprints until random ones fill a bucket with
    a quarter of BUCKET at most. Each choice of all but `radius` blocks is one table, so any two
    fingerprints within the radius agree under one of the masks, at every size.
    """
    for blocks in range(radius + 1, 65):
        if rows / 2.0 ** (64 * (blocks - radius) // blocks) <= BUCKET / 4 or comb(blocks + 1, radius) > 100:
            break
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(blocks)]
    chosen = [sum(c) for c in combinations(masks, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows of words: bit i of row p is bit p of value i."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    words = -(-len(values) // 64) + 1
    padded = np.zeros((64, words * 8), np.uint8)
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


def _pack(flags: np.ndarray, words: int) -> np.ndarray:
    out = np.zeros(words * 8, np.uint8)
    packed = np.packbits(flags, bitorder="little")
    out[: len(packed)] = packed
    return out.view(np.uint64)


def near(planes: np.ndarray, shift: int, valid: np.ndarray, radius: int) -> np.ndarray:
    """Places i whose value differs from that at i + shift in at most `radius` bits, where valid[i]."""
    words = -(-len(valid) // 64)
    live = _pack(valid, words)
    at = np.flatnonzero(live)
    live = live[at]
    step, rest = divmod(shift, 64)
    last = planes.shape[1] - 1
    counters = np.zeros((radius.bit_length(), len(at)), np.uint64)
    for group in range(0, 64, 8):
        rows = planes[group : group + 8]
        here = rows[:, at]
        there = rows[:, np.minimum(at + step, last)]
        if rest:
            there = (there >> np.uint64(rest)) | (rows[:, np.minimum(at + step + 1, last)] << np.uint64(64 - rest))
        for carry in here ^ there:
            for counter in counters:
                both = counter & carry
                counter ^= carry
                carry = both
            live &= ~carry  # counted past the largest number that the counters hold
        keep = live != 0
        if not keep.any():
            return np.empty(0, np.int64)
        if 2 * keep.sum() < len(keep):
            at, live, counters = at[keep], live[keep], counters[:, keep]
    more, same = np.zeros_like(live), ~np.zeros_like(live)
    for bit in range(len(counters) - 1, -1, -1):
        if radius >> bit & 1:
            same &= counters[bit]
        else:
            more |= same & counters[bit]
            same &= ~counters[bit]
    live &= ~more
    found = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, bit = np.nonzero(found)
    return at[word] * 64 + bit


def star_links(groups: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (value, root) that connect what lies within the radius inside each group.

    groups: numbers that rise from group to group. Within a group only a spanning star of what it
    connects is returned, never all pairs.
    """
    _, lengths = np.unique(groups, return_counts=True)
    sizes = np.repeat(lengths, lengths)
    order = np.argsort(-sizes, kind="stable")  # long groups first: a shift then needs a prefix only
    groups, values, sizes = groups[order], np.ascontiguousarray(values[order]), sizes[order]
    keep = int((sizes > 1).sum())
    groups, values, sizes = groups[:keep], values[:keep], sizes[:keep]
    root = np.arange(keep)
    if not keep:
        return values, values
    planes = bit_planes(values.view(np.uint64))
    for shift in range(1, int(sizes[0])):
        reach = int(np.searchsorted(-sizes, -shift, "left"))  # rows of groups longer than the shift
        valid = np.zeros(reach, bool)
        valid[: reach - shift] = groups[: reach - shift] == groups[shift:reach]
        i = near(planes, shift, valid, radius)
        apart = root[i] != root[i + shift]
        if apart.any():
            for x, y in zip(i[apart].tolist(), (i[apart] + shift).tolist()):
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                root[max(x, y)] = min(x, y)
            while (root[root] != root).any():
                root = root[root]
    linked = np.flatnonzero(root != np.arange(keep))
    return values[linked], values[root[linked]]


def _links_of(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """batches: (tag, key, fp) in order of tag and key."""
    held: list[tuple] = []
    rows = 0

    def flush(final: bool):
        tag, key, fp = (np.concatenate([h[c] for h in held]) for c in range(3))
        new = np.flatnonzero((tag[1:] != tag[:-1]) | (key[1:] != key[:-1])) + 1
        group = np.zeros(len(tag), np.int64)
        group[new] = 1
        end = len(tag) if final else int(new[-1]) if len(new) else 0
        rest = [] if final else [(tag[end:], key[end:], fp[end:])]
        a, b = star_links(np.cumsum(group)[:end], fp[:end], radius)
        return rest, pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_LINK)

    for batch in batches:
        held.append(tuple(np.asarray(batch[c]) for c in range(3)))
        rows += batch.num_rows
        if rows >= _ROWS:
            held, out = flush(False)
            rows = sum(len(h[0]) for h in held)
            yield out
    if held:
        yield flush(True)[1]


def links(values: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join all fingerprints of `values` (column fp, distinct) within the radius of each other."""
    masks = agreement_masks(radius, values.count())
    tables = F.array(*[F.struct(F.lit(i).cast("long").alias("tag"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    rows = values.select("fp", F.explode(tables).alias("t")).select("t.tag", "t.key", "fp")
    parts = F.ceil(F.col("n") / BUCKET)
    hot = rows.groupBy("tag", "key").agg(F.count("*").alias("n")).filter(F.col("n") > BUCKET).select("tag", "key", parts.alias("parts"))
    rows = rows.join(hot, ["tag", "key"], "left")
    # A bucket over the limit is cut into parts; each pair of parts is a bucket of its own.
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: F.least(p, mine) * (1 << 20) + F.greatest(p, mine))
    pair = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs))
    rows = rows.select("tag", "key", "fp", pair.alias("pair"))
    rows = rows.select((F.col("pair") * 128 + F.col("tag")).alias("tag"), "key", "fp")
    dealt = rows.repartition("tag", "key").sortWithinPartitions("tag", "key")
    return dealt.mapInArrow(lambda batches: _links_of(batches, radius), "a long, b long").distinct()


def classes(values: DataFrame, radius: int) -> DataFrame:
    """(fp, root) for every fingerprint that is linked to another; root is the smallest of its component."""
    return components(links(values, radius)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links of at most `radius` differing bits reach.
    Null and blank texts have fingerprint zero and are linked like any other. Repeated rows give
    repeated rows. A null doc_id is kept and takes the component's smallest id, null if no row of
    the component has one. Other columns are not read.
    """
    marked = stored(fingerprints(docs, "doc_id", words_per_shingle), "fingerprints")
    values = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "values")
    roots = classes(values.select("fp"), radius)
    placed = values.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_value = placed.join(least, "root").select("fp", "component_id")
    out = marked.join(by_value, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of `docs`, all columns, without all but one row of each component.

    The row with the smallest doc_id stays (nulls last; of equal ids any one row).
    """
    rows = numbered(docs, F.struct("*").alias("doc"))
    keyed = rows.select("row_id", F.col("doc.doc_id").alias("doc_id"), F.col("doc.text").alias("text"))
    marked = stored(fingerprints(keyed, "row_id", words_per_shingle), "fingerprints")
    roots = classes(marked.select("fp").distinct(), radius)
    known = marked.join(keyed.select("row_id", "doc_id"), "row_id").join(roots, "fp", "left")
    known = stored(known.select("row_id", "doc_id", F.coalesce("root", "fp").alias("root")), "known")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")
    first = stored(known.groupBy("root").agg(F.min(order).alias("first")), "first")  # so that Spark can split a large component
    out = known.join(first, "root").filter("row_id <> first.row_id").select("row_id")
    return rows.join(out, "row_id", "left_anti").select("doc.*")
