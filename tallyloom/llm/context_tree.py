"""Language-model scores by context-tree weighting.

A byte is eight binary decisions. Each decision has a context tree of its own, whose nodes are the
0 to DEPTH bytes before; a node counts the zeros and ones of its decision in the training texts.
A node's weighted probability is half its Krichevsky-Trofimov estimate and half the product of its
children's, from the deepest nodes up, so all depths are mixed. A text is scored with the counts as
they are: at each node the estimate and what the child says are averaged by their weights, and a
context that training never met gives way to the next shorter one.

The counts come from all training texts, by two aggregations. The commonest nodes are looked up in
the task; what a text's other grams need of the tree is found by a join, so every text is scored at
DEPTH whatever the size of the tree. The base score adds a word unigram: the commonest words are
looked up in the task, all others by a join.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, spark_schema, stored

DEPTH = 4
#: Nodes that are looked up in the task, the commonest; the others are joined. A node has 16 bytes, and each
#: worker, the driver and the broadcast hold the nodes once: 64 MB.
MOST_NODES = (64 << 20) // 16
#: Words looked up in the task; the others are joined.
COMMON_WORDS = 50_000
_END = b"\xff"  # not a byte of UTF-8: before and after each text
_CHUNK = 1 << 18
_MEMO = 20
#: Grams that a task counts before it gives them out; an eighth as many words.
_HELD = 1 << 21
#: Grams looked up at once.
_LOOKED_UP = 1 << 16
_HASH = np.uint64(0x9E3779B97F4A7C15)


def held_out(folds: int = 7, remainder: int = 2):
    """True where crc32 of the id's text leaves the remainder; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == remainder, F.lit(False))


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words; bytes are cut at ASCII white space, as the contract's pattern does."""
    return data.lower().split()


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(gram, text) of every byte and end: the byte in the low 8 bits, the DEPTH bytes before above it."""
    for start, end in _chunks(texts):
        held = texts[start:end]
        data = np.frombuffer(b"".join(_END * DEPTH + t + _END for t in held), np.uint8)
        sizes = np.array([len(t) + DEPTH + 1 for t in held])
        value = np.zeros(len(data) - DEPTH, np.uint64)
        for i in range(DEPTH + 1):
            value = (value << np.uint64(8)) | data[i : len(data) - DEPTH + i]
        own = np.ones(len(data), bool)
        first = np.cumsum(sizes) - sizes
        for i in range(DEPTH):
            own[first + i] = False
        yield value[own[DEPTH:]], np.repeat(np.arange(start, end), sizes - DEPTH)


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


_COUNTS = pa.schema([("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])


def _counts_batch(words: Counter[bytes], seen: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    value, place = np.unique(np.concatenate([np.zeros(0, np.uint64), *seen]), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate([np.zeros(0), *times]), minlength=len(value)).astype(np.int64)
    word = pa.concat_arrays([pa.array(list(words), pa.binary()), pa.nulls(len(value), pa.binary())])
    gram = pa.concat_arrays([pa.nulls(len(words), pa.int64()), pa.array(value.view(np.int64))])
    total = np.concatenate((np.fromiter(words.values(), np.int64, len(words)), n))
    return pa.RecordBatch.from_arrays([word, gram, pa.array(total)], schema=_COUNTS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and grams of a task with counts, given out whenever _HELD of either are held."""
    words: Counter[bytes] = Counter()
    seen: list[np.ndarray] = []
    times: list[np.ndarray] = []
    for batch in _sliced(batches):
        texts = [(t or "").encode() for t in batch[0].to_pylist()]
        words[b""] += len(texts)  # the ends
        for text in texts:
            words.update(words_of(text))
        for value, _ in grams(texts):
            value = np.sort(value)
            new = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
            seen.append(value[new])
            times.append(np.diff(np.append(new, len(value))).astype(np.int32))
            if sum(map(len, seen)) > _HELD:
                yield _counts_batch(Counter(), seen, times)
                seen, times = [], []
        if len(words) > _HELD // 8:
            yield _counts_batch(words, [], [])
            words = Counter()
    yield _counts_batch(words, seen, times)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ROWS rows at a time: so many are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _log_gamma(x):
    """Stirling's series seven places up, for x > 0."""
    z = x + 7
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)
    rise = x
    for i in range(1, 7):
        rise = rise * (x + i)
    return series - F.log(rise)


def _estimate():
    """Logarithm of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    zeros, ones = F.col("n0").cast("double"), F.col("n1").cast("double")
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


def tree(counts: DataFrame) -> DataFrame:
    """(depth, key, n, p1, beta) of all nodes. counts: (gram, n). key: context in the high bits, decision in the low 8.

    p1 is the node's own probability of a one, less 1 where that is over a half: a float near 1 would round to 1,
    and a zero after many ones would be impossible. beta is the weight of it against what its child says.
    """
    byte = F.col("gram").bitwiseAND(F.lit(255))
    bits = F.array(
        *[
            F.struct((F.lit(1 << i) + F.shiftright(byte, 8 - i)).alias("decision"), F.shiftright(byte, 7 - i).bitwiseAND(F.lit(1)).alias("bit"))
            for i in range(8)
        ]
    )
    leaves = counts.select(F.shiftright("gram", 8).alias("context"), F.explode(bits).alias("b"), "n")
    one = F.sum(F.when(F.col("b.bit") == 1, F.col("n")).otherwise(0))
    level = leaves.groupBy("context", F.col("b.decision").alias("decision")).agg((F.sum("n") - one).alias("n0"), one.alias("n1"))
    level = level.withColumn("own", _estimate()).withColumn("all", F.col("own")).withColumn("below", F.lit(None).cast("double"))
    levels = []
    for depth in range(DEPTH, -1, -1):
        if depth < DEPTH:
            shorter = F.col("context").bitwiseAND(F.lit((1 << 8 * depth) - 1)).alias("context")
            level = level.groupBy(shorter, "decision").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("all").alias("below"))
            level = level.withColumn("own", _estimate())
            high, low = F.greatest("own", "below"), F.least("own", "below")
            level = level.withColumn("all", high + F.log1p(F.exp(low - high)) - math.log(2))
        level = stored(level, "level")
        beta = F.exp(F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.col("own") - F.col("below"))))
        ones, zeros = F.col("n1") + 0.5, F.col("n0") + 0.5
        p1 = F.when(ones > zeros, -zeros).otherwise(ones) / (ones + zeros)
        key = F.shiftleft("context", 8) + F.col("decision")
        n = F.col("n0") + F.col("n1")
        levels.append(level.select(F.lit(depth).alias("depth"), key.alias("key"), n.alias("n"), p1.cast("float").alias("p1"), beta.cast("float").alias("beta")))
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)
    return nodes


class ContextTree:
    """Nodes as sorted arrays by depth, and a table of the grams met last.

    The nodes are all of the tree (complete), or those with at least `least` counts. A node's
    ancestors have no fewer counts than itself, so what is held of a path is always its upper part.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], least: int = 0):
        self.levels, self.least = levels, least
        self.keys = self.values = None

    @property
    def complete(self) -> bool:
        return self.least == 0

    def _path(self, context: np.ndarray, decision: np.ndarray) -> list[tuple]:
        """(held, p1, beta) of the nodes from depth 0 on."""
        path = []
        for depth, (keys, p1, beta) in enumerate(self.levels):
            key = ((context & np.uint64((1 << 8 * depth) - 1)) << np.uint64(8)) + decision
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            near = p1[at].astype(float) if len(keys) else np.full(len(key), 0.5)
            path.append((keys[at] == key, near + (near < 0), beta[at]) if len(keys) else (np.zeros(len(key), bool), near, 1.0))
        return path

    def _lookup(self, gram: np.ndarray) -> np.ndarray:
        """Logarithm (base 10) of the probability of the low byte after the bytes above it; nan if more nodes may count."""
        parts = [self._lookup_part(gram[i : i + _LOOKED_UP]) for i in range(0, len(gram), _LOOKED_UP)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def _lookup_part(self, gram: np.ndarray) -> np.ndarray:
        total = np.zeros(len(gram))
        byte, context = gram & np.uint64(255), gram >> np.uint64(8)
        for i in range(8):
            path = self._path(context, np.uint64(1 << i) + (byte >> np.uint64(8 - i)))
            said = np.full(len(gram), 0.5)
            below = np.zeros(len(gram), bool)
            for here, p1, beta in reversed(path):
                mixed = np.where(below, (beta * p1 + said) / (beta + 1), p1)
                said = np.where(here, mixed, said)
                below |= here
            one = (byte >> np.uint64(7 - i)) & np.uint64(1)
            total += np.log10(np.where(one == 1, said, 1 - said))
            if not self.complete:
                total[~path[-1][0]] = np.nan
        return total

    def parts(self, gram: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(decision, bit, depth, alone, add, times) of each of the eight decisions.

        depth is that of the deepest node held, -1 if none. The probability of a one is `alone`
        if the tree has no deeper node, else add + times * what the deeper nodes say.
        """
        byte, context = gram & np.uint64(255), gram >> np.uint64(8)
        for i in range(8):
            decision = np.uint64(1 << i) + (byte >> np.uint64(8 - i))
            depth = np.full(len(gram), -1, np.int32)
            alone, add, times = np.full(len(gram), 0.5), np.zeros(len(gram)), np.ones(len(gram))
            for d, (here, p1, beta) in enumerate(self._path(context, decision)):
                alone = np.where(here, add + times * p1, alone)
                add = np.where(here, add + times * beta * p1 / (beta + 1.0), add)
                times = np.where(here, times / (beta + 1.0), times)
                depth[here] = d
            yield decision, (byte >> np.uint64(7 - i)) & np.uint64(1), depth, alone, add, times

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
        """Sums over the grams that the nodes held decide, and (gram, text, times) of the others, chunk by chunk."""
        out = np.zeros(len(texts))
        others = []
        if self.keys is None:
            self.keys, self.values = np.zeros(1 << _MEMO, np.uint64), np.zeros(1 << _MEMO)
            self.values[0] = self._lookup(np.zeros(1, np.uint64))[0]  # the gram that empty places hold
        for gram, text in grams(texts):
            place = (gram * _HASH) >> np.uint64(64 - _MEMO)
            value = self.values[place]
            miss = np.flatnonzero(self.keys[place] != gram)
            if len(miss):
                new, back = np.unique(gram[miss], return_inverse=True)
                found = self._lookup(new)
                value[miss] = found[back]
                place = (new * _HASH) >> np.uint64(64 - _MEMO)
                place, last = np.unique(place, return_index=True)
                self.keys[place], self.values[place] = new[last], found[last]
            if not self.complete and len(open_ := np.flatnonzero(np.isnan(value))):
                value[open_] = 0
                pairs, n = np.unique((gram[open_] << np.uint64(24)) | text[open_].astype(np.uint64), return_counts=True)  # a gram has 40 bits
                others.append((pairs >> np.uint64(24), (pairs & np.uint64((1 << 24) - 1)).astype(np.int64), n))
            out += np.bincount(text, weights=value, minlength=len(texts))
        return out, others


def load(nodes: DataFrame) -> ContextTree:
    """The commonest nodes on the driver: all, or those with a power of two of counts at least, MOST_NODES at most."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["power"]: r["count"] for r in nodes.groupBy(power.alias("power")).count().collect()}
    total, least = 0, 1 << 62
    for power in sorted(sizes, reverse=True):
        total += sizes[power]
        if total > MOST_NODES:
            break
        least = 1 << power
    else:
        least = 0
    levels = []
    for depth in range(DEPTH + 1):
        beta = F.coalesce("beta", F.lit(1.0)).cast("float").alias("beta")
        rows = nodes.filter((F.col("depth") == depth) & (F.col("n") >= least)).select("key", "p1", beta).toArrow()
        order = np.argsort(rows["key"].to_numpy())
        key, p1, beta = (rows[c].to_numpy()[order] for c in ("key", "p1", "beta"))
        levels.append((key.view(np.uint64), p1, beta))
        del rows, order  # the driver holds a level twice at most
    return ContextTree(levels, least)


_PARTS = pa.schema(
    [
        ("gram", pa.int64()),
        ("decision", pa.int64()),
        ("bit", pa.int32()),
        ("depth", pa.int32()),
        ("alone", pa.float64()),
        ("add", pa.float64()),
        ("times", pa.float64()),
    ]
)


def joined(grams: DataFrame, nodes: DataFrame, shared) -> DataFrame:
    """(gram, value): scores of distinct grams at full depth. shared: broadcast of a tree that holds the common nodes, first.

    A gram asks only for the nodes below those held, so no node with many counts is joined.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch[0].to_numpy().astype(np.uint64)
            for part in shared.value[0].parts(gram):
                yield pa.RecordBatch.from_arrays([pa.array(c).cast(f.type) for c, f in zip((gram, *part), _PARTS)], schema=_PARTS)

    parts = stored(grams.mapInArrow(split, spark_schema(_PARTS)), "parts")
    deeper = parts.filter(F.col("depth") < DEPTH).select("gram", "decision", F.explode(F.sequence(F.col("depth") + 1, F.lit(DEPTH))).alias("depth"))
    masks = F.array(*[F.lit((1 << 8 * d) - 1).cast("long") for d in range(DEPTH + 1)])
    key = F.shiftleft(F.shiftright("gram", 8).bitwiseAND(F.get(masks, F.col("depth"))), 8) + F.col("decision")
    deeper = stored(deeper.withColumn("key", key), "deeper")
    met = deeper.join(nodes.select("depth", "key", "p1", "beta"), ["depth", "key"])
    met = met.groupBy("gram", "decision").agg(F.sort_array(F.collect_list(F.struct("depth", "p1", "beta")), asc=False).alias("met"))  # DEPTH + 1 at most
    p1 = lambda x: x["p1"].cast("double") + (x["p1"] < 0).cast("double")
    mixed = lambda said, x: F.when(said.isNull(), p1(x)).otherwise((x["beta"] * p1(x) + said) / (x["beta"] + 1))
    said = F.aggregate("met", F.lit(None).cast("double"), mixed)
    parts = parts.join(met.select("gram", "decision", said.alias("said")), ["gram", "decision"], "left")
    one = F.when(F.col("said").isNull(), F.col("alone")).otherwise(F.col("add") + F.col("times") * F.col("said"))
    return parts.groupBy("gram").agg(F.sum(F.log10(F.when(F.col("bit") == 1, one).otherwise(1 - one))).alias("value"))


_SCORED = pa.schema(
    [
        ("word", pa.binary()),
        ("gram", pa.int64()),
        ("rows", pa.list_(pa.int64())),
        ("times", pa.list_(pa.int32())),
        ("row_id", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("logs", pa.float64()),
        ("score", pa.float64()),
        ("n_bytes", pa.int64()),
    ]
)


def _lists(ends: np.ndarray, rows: np.ndarray, times: np.ndarray) -> dict[str, pa.Array]:
    """Columns rows and times: the values between neighbouring ends are a list."""
    ends = pa.array(ends, pa.int32())
    return {
        "rows": pa.ListArray.from_arrays(ends, pa.array(rows, pa.int64())),
        "times": pa.ListArray.from_arrays(ends, pa.array(times, pa.int32())),
    }


def _scored_batch(n: int, values: dict) -> pa.RecordBatch:
    columns = [pa.array(values[f.name], f.type) if f.name in values and not isinstance(values[f.name], pa.Array) else values.get(f.name, pa.nulls(n, f.type)) for f in _SCORED]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _SCORED)], schema=_SCORED)


def scored(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    score is the tree's log10 probability of the text and its end, bits_per_byte the code length.
    Null and empty texts are the end alone. Repeated rows train and are scored as often as they
    occur; a null doc_id trains. Without training texts every bit costs a bit. Other columns are not
    read.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = stored(texts.filter(~held_out()).select("text").mapInArrow(_count, spark_schema(_COUNTS)), "counts")
    words = stored(counted.filter("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    known = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    common = {bytes(r["word"]): r["n"] for r in words.orderBy(F.desc("n"), "word").limit(COMMON_WORDS).collect()}
    nodes = tree(counted.filter("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")))
    model = load(nodes)
    shared = spark.sparkContext.broadcast((model, {word: math.log10(n + 1) for word, n in common.items()}))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, logs_of = shared.value
        for batch in _sliced(batches):
            data = [(t or "").encode() for t in batch[2].to_pylist()]
            row_ids = batch[0].to_numpy()
            rare: dict[bytes, int] = {}
            rare_word, rare_row, rare_times = array("i"), array("i"), array("i")
            rows = {name: np.zeros(len(data), kind) for name, kind in (("n_tokens", np.int64), ("n_known", np.int64), ("logs", float))}
            for i, text in enumerate(data):
                times = Counter(words_of(text))
                times[b""] = 1
                rows["n_tokens"][i] = times.total()
                logs, n_known = 0.0, 0
                for word, n in times.items():
                    value = logs_of.get(word)
                    if value is None:
                        rare_word.append(rare.setdefault(word, len(rare)))
                        rare_row.append(i)
                        rare_times.append(n)
                    else:
                        logs += n * value
                        n_known += n
                rows["logs"][i], rows["n_known"][i] = logs, n_known
            score, others = own.scores(data)
            values = {"row_id": batch[0], "doc_id": batch[1], **rows, "score": score, "n_bytes": np.array([len(d) for d in data], np.int64)}
            yield _scored_batch(len(data), values)
            if rare:
                order = np.argsort(rare_word, kind="stable")
                rows_of, times_of = row_ids[np.array(rare_row, np.int32)[order]], np.array(rare_times, np.int32)[order]
                ends = np.searchsorted(np.array(rare_word, np.int32)[order], np.arange(len(rare) + 1))
                yield _scored_batch(len(rare), {"word": pa.array(list(rare), pa.binary()), **_lists(ends, rows_of, times_of)})
            for gram, text, n in others:
                first = np.flatnonzero(np.concatenate(([True], gram[1:] != gram[:-1])))
                ends = np.append(first, len(gram))
                yield _scored_batch(len(first), {"gram": gram[first].astype(np.int64), **_lists(ends, row_ids[text], n)})

    numbered = texts.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", "text")
    both = stored(numbered.mapInArrow(score, spark_schema(_SCORED)), "scored")
    rare = both.filter("row_id is null").select("word", "rows", "times").join(words, "word")
    pair = F.explode(F.arrays_zip("rows", "times")).alias("p")
    rare = rare.select(pair, F.log10(F.col("n") + 1).alias("log")).groupBy(F.col("p.rows").alias("rare_row")).agg(
        F.sum("p.times").alias("more_known"), F.sum(F.col("p.times") * F.col("log")).alias("more_logs")
    )
    rows = both.filter("row_id is not null").join(rare, F.col("row_id") == F.col("rare_row"), "left")
    if not model.complete:
        others = both.filter("gram is not null").select("gram", "rows", "times")
        values = stored(joined(others.select("gram").distinct(), nodes, shared), "values")
        others = others.join(values, "gram").select(pair, "value").groupBy(F.col("p.rows").alias("other_row")).agg(F.sum(F.col("p.times") * F.col("value")).alias("more_score"))
        rows = rows.join(others, F.col("row_id") == F.col("other_row"), "left").withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    bits = -F.col("score") / math.log10(2) / F.greatest(F.col("n_bytes"), F.lit(1))
    return rows.select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known["n"]).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(known["n"] + known["v"] + 1)).alias("base_score"),
        "score",
        bits.alias("bits_per_byte"),
    )
