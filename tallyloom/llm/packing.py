"""Packing documents into sequences: dominance reduction, then best fit.

A packing problem with lengths of 1 to `capacity` is a histogram, one count for each length; it has
`capacity` rows at most, however many documents there are. On the histogram the Martello-Toth
reduction fixes sets that some best packing contains, since they dominate every other set with the
longest piece left: that piece alone; with the piece that fills its sequence exactly; with the longest
piece that fits, where no two fit or any two fit into its place; with the longest and the longest
beside that, where no pair has a longer second piece. Where three pieces fit beside the longest,
nothing but an exact fill is fixed. What the reduction leaves is packed best-fit by decreasing length, whole groups of equal sequences at a
time. The plan is a list of patterns with multiplicities; Spark then numbers the pieces of each
length and looks up their places.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_worker, map_batches, stored

#: Entries of each of a worker's two tables of encoded words, and the length of a word that is kept.
KEPT = 700_000
_KEPT_LENGTH = 64
#: Parts into which the pieces of one length are dealt to be numbered.
SPREAD = 256
_SEPARATOR = "<|endoftext|>"


class WordIds:
    """Ids of whole texts by the tokenizers library, word by word.

    The tokenizer drops white space and cuts at it, so a text's ids are those of its words one after
    another; each word is encoded once and kept. Texts in which words may influence each other (the
    tokenizer's special tokens, characters that normalisation changes, unusual white space) are
    encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(_SEPARATOR)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _cut(self, words: list[str], between: str) -> dict[str, bytes] | None:
        """Ids of words that are encoded together: a blank between words of letters, whose last ids show where they
        end, or a special token between any. None where the ends do not tell the words apart."""
        ids = self._ids(between.join(words))
        if between == " ":
            stops = np.flatnonzero(self.ends[ids]) + 1
            starts = np.append(0, stops[:-1])
        else:
            stops = np.append(np.flatnonzero(ids == self.separator), len(ids))
            starts = np.append(0, stops[:-1] + 1)
        if len(stops) != len(words):
            return None
        data = ids.tobytes()
        return {w: data[i:j] for w, i, j in zip(words, (starts * 4).tolist(), (stops * 4).tolist())}

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words that are not known. Short ones are kept: a full table becomes the older one, whose words move up when they are met."""
        met = words.intersection(self.older)
        new = {w: self.older[w] for w in met}
        rest = words - met
        plain = [w for w in rest if w.isalpha()]
        for group, between in ((plain, " "), ([w for w in rest if not w.isalpha()], _SEPARATOR)):
            for start in range(0, len(group), 20_000):
                part = group[start : start + 20_000]
                found = self._cut(part, between)
                new |= self._cut(part, _SEPARATOR) if found is None else found
        if len(self.known) + len(new) > KEPT:
            self.known, self.older = {}, self.known
        for word in islice((w for w in new if len(w) <= _KEPT_LENGTH), KEPT):
            self.known[word] = new[word]
        return new

    def of(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = []
        for start in range(0, len(texts), 256):
            words: list[list[str] | None] = []
            part = texts[start : start + 256]
            for text in part:
                low = text.lower()
                usual = not any(c in text for c in _UNUSUAL) and (low.isascii() or unicodedata.is_normalized("NFC", low))
                words.append(_split(low) if usual else None)
            distinct: set[str] = set().union(*(ws for ws in words if ws))
            known = self.known
            new = self._learn(missing) if (missing := distinct.difference(known)) else {}
            kept = self.known is known and (not new or max(map(len, new)) <= _KEPT_LENGTH)
            get = known.__getitem__ if kept else lambda w: new[w] if w in new else known[w]
            out += [self._ids(t).tobytes() if ws is None else b"".join(map(get, ws)) for t, ws in zip(part, words)]
        return out


#: Texts with one of these are encoded whole.
_UNUSUAL = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "Σ", "İ")


def _split(text: str) -> list[str]:
    """Words; a single stop or comma behind a letter is a token of its own and counts as a word."""
    out = []
    for word in text.split():
        if word[-1] in ".," and len(word) > 1 and word[-2].isalpha():
            out.append(word[:-1])
            out.append(word[-1])
        else:
            out.append(word)
    return out


@kept_in_worker
@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One encoder for each worker process and vocabulary."""
    return WordIds(path)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, piece, start, length, ids_crc32 (and ids).

    A document's ids end with `end_id`; a null or empty text is that id alone.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def make(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {f.name: [] for f in schema}
        ids_of = word_ids(path).of([t or "" for t in batch[1].to_pylist()])
        for doc_id, ids in zip(batch[0].to_pylist(), ids_of):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                row = {"doc_id": doc_id, "piece": piece, "start": at // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                if with_ids:
                    row["ids"] = np.frombuffer(part, "<i4")
                for name, value in row.items():
                    out[name].append(value)
        return out

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, schema, keeps=True)


class Plan:
    """A packing of a histogram of lengths.

    Rows (length, first, count, sequence, offset, each): of the pieces of a length, numbered from 0,
    those from `first` on fill `count` sequences from number `sequence` on with `each` pieces in a
    row, the first at `offset`.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self.total = int((self.left * np.arange(capacity + 1)).sum())
        self.groups: list[tuple[int, list[tuple[int, int]]]] = []  # sequences alike, and (length, pieces in a row)
        self.fixed = self._reduce()
        self.rest = self.left.copy()
        self._best_fit()
        self.rows = self._places()
        self.sequences = sum(n for n, _ in self.groups)

    def _take(self, n: int, *lengths: int) -> None:
        for length in lengths:
            self.left[length] -= n
        runs = [(length, lengths.count(length)) for length in sorted(set(lengths), reverse=True)]
        self.groups.append((n, runs))

    def _reduce(self) -> int:
        """Fix sets that dominate all others with the longest piece; the number of pieces fixed."""
        before = int(self.left.sum())
        while self._reduce_once():
            pass
        return before - int(self.left.sum())

    def _reduce_once(self) -> bool:
        before = int(self.left.sum())
        for longest in range(self.capacity, 0, -1):
            while self.left[longest]:
                partners = self._dominating(longest)
                if partners is None:
                    break
                needed = Counter([longest, *partners])  # what holds for a set holds until one of its lengths is used up
                self._take(min(int(self.left[length]) // each for length, each in needed.items()), longest, *partners)
        return int(self.left.sum()) < before

    def _dominating(self, longest: int) -> list[int] | None:
        """Pieces that dominate everything else that could share a sequence with a longest piece; None if none is known to.

        A set dominates another if the other's pieces can be dealt to the places of its own, so that
        each place is long enough.
        """
        room = self.capacity - longest
        left = self.left[: room + 1].copy()
        if longest <= room:
            left[longest] -= 1
        lengths = np.flatnonzero(left)
        if not len(lengths):
            return []
        best = int(lengths[-1])
        few = np.repeat(lengths[:3], left[lengths[:3]].clip(max=3))[:3]  # the three shortest
        if best == room or len(few) < 2 or few[0] + few[1] > room:
            return [best]  # it fills the room, or no two fit beside the longest
        if len(few) > 2 and few.sum() <= room:
            return None
        # At most two fit. The longer piece of a pair, and the longest that fits beside it:
        at = np.searchsorted(lengths, np.minimum(room - lengths, lengths), "right") - 1
        at = np.where((at >= 0) & (lengths[at] == lengths) & (left[lengths] < 2), at - 1, at)
        pairs = lengths[at >= 0] + lengths[at[at >= 0]]
        if not len(pairs) or pairs.max() <= best:
            return [best]  # any pair fits into its place
        left[best] -= 1
        beside = np.flatnonzero(left[: room - best + 1])
        if not len(beside):
            return None
        second = int(beside[-1])
        left[best] += 1
        longer = np.flatnonzero(left[second + 1 :]) + second + 1
        two = np.repeat(longer[:2], left[longer[:2]].clip(max=2))[:2]
        if len(two) < 2 or two.sum() > room:
            return [best, second]  # the shorter piece of any pair is no longer than the second
        return None

    def _best_fit(self) -> None:
        """Decreasing lengths; each goes to the fullest open sequence with room for it."""
        open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
        rooms: list[int] = []

        def put(room: int, n: int, runs: list[tuple[int, int]]) -> None:
            if n:
                if room not in open_:
                    open_[room] = []
                    rooms.insert(bisect_left(rooms, room), room)
                open_[room].append((n, runs))

        for length in range(self.capacity, 0, -1):
            n = int(self.left[length])
            self.left[length] = 0
            while n:
                at = bisect_left(rooms, length)
                if at == len(rooms):
                    each = self.capacity // length
                    if full := n // each:
                        put(self.capacity - each * length, full, [(length, each)])
                    if rest := n % each:
                        put(self.capacity - rest * length, 1, [(length, rest)])
                    break
                room = rooms[at]
                held, runs = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
                each = room // length
                full = min(held, n // each)
                put(room - each * length, full, [*runs, (length, each)])
                n -= full * each
                held -= full
                if held and n and n < each:
                    put(room - n * length, 1, [*runs, (length, n)])
                    held, n = held - 1, 0
                put(room, held, runs)
        for held in open_.values():
            self.groups += held

    def _places(self) -> np.ndarray:
        used = np.zeros(self.capacity + 1, np.int64)
        rows, sequence = [], 0
        for n, runs in self.groups:
            offset = 0
            for length, each in runs:
                rows.append((length, used[length], n, sequence, offset, each))
                used[length] += n * each
                offset += length * each
            sequence += n
        return np.array(sorted(rows), np.int64).reshape(-1, 6)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these numbers among those of their length."""
        big = np.int64(1) << 44
        row = self.rows[np.searchsorted(self.rows[:, 0] * big + self.rows[:, 1], length * big + rank, "right") - 1]
        number = rank - row[:, 1]
        return row[:, 3] + number // row[:, 5], row[:, 4] + number % row[:, 5] * length


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """`pieces` (with doc_id, piece, length) and their place: sequence_id, offset.

    Only the histogram of lengths, at most `capacity` rows, and the plan made from it leave the
    executors. Pieces of one length are numbered part by part, so one length may have any share.
    """
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SPREAD)).alias("part")
    pieces = stored(pieces.withColumn("part", part), "pieces")
    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    plan = Plan({r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    starts = sizes.select("length", "part", before.alias("before"))
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = pieces.withColumn("number", number - 1).join(starts, ["length", "part"])  # both lie by these columns already
    ranked = ranked.withColumn("rank", F.col("number") + F.col("before")).drop("part", "number", "before")
    place = "struct<sequence_id: long, offset: long>"

    @F.pandas_udf(place)
    def placed(length, rank):
        import pandas as pd

        sequence, offset = plan.place(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("place", placed("length", "rank")).select(*[c for c in ranked.columns if c != "rank"], "place.*")


def packed_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Only documents over the capacity are cut. Null and empty texts are one piece with the end id.
    Repeated rows are packed each on its own; a null doc_id stays null. Other columns are not read.
    """
    pieces = token_pieces(docs, path, capacity, end_id, with_ids)
    columns = [*pieces.columns, "sequence_id", "offset"]
    return pack(pieces, capacity).select(*columns)
