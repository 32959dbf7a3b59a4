"""Byte-level BPE by a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves a pre-token that is a token as a whole.
Tier two: the bytes of any other pre-token form a linked list, and a heap of its neighbouring pairs
gives the next merge, the lowest rank first and the leftmost of equal ones.

Texts are cut at single blanks between other characters before the pattern runs: no match of the
pattern reaches across such a blank except by starting with it, so what stands between two of them
is encoded once and kept in a bounded table of the worker.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Entries of a worker's table of encoded pieces; a full one is emptied and filled anew.
KEPT = 400_000
#: Unicode's White_Space, which the tokenizer's \\s means; Python's also has U+001C to U+001F.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(r"(?<=\S) (?=\S)")


class PerfectHash:
    """Minimal perfect hash of byte strings by hash and displace: n keys, n slots.

    A key's first hash picks a bucket. The buckets with several keys, largest first, get the
    smallest displacement that sends all their keys to free slots; a bucket with one key names its
    slot (as -1 - slot).
    """

    def __init__(self, keys: list[bytes]):
        self.size = max(len(keys), 1)
        self.keys: list[bytes | None] = [None] * self.size
        self.moves = [0] * self.size
        buckets: dict[int, list[tuple[int, bytes]]] = {}
        for key in keys:
            value = xxhash.xxh64_intdigest(key)
            buckets.setdefault(value % self.size, []).append((value, key))
        free = self.size
        for bucket, held in sorted(buckets.items(), key=lambda b: -len(b[1])):
            if len(held) == 1:
                free -= 1
                while self.keys[free] is not None:
                    free -= 1
                self.moves[bucket] = -1 - free
                self.keys[free] = held[0][1]
                continue
            move = 0
            while True:
                move += 1
                slots = {self._place(value, move) for value, _ in held}
                if len(slots) == len(held) and all(self.keys[s] is None for s in slots):
                    break
            self.moves[bucket] = move
            for value, key in held:
                self.keys[self._place(value, move)] = key

    def _place(self, value: int, move: int) -> int:
        return ((value >> 20) * (2 * move + 1) ^ (value >> 7) * move) % self.size

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 if it is not one of the keys."""
        value = xxhash.xxh64_intdigest(key)
        move = self.moves[value % self.size]
        slot = -1 - move if move < 0 else self._place(value, move)
        return slot if self.keys[slot] == key else -1


class Ranks(dict):
    """Rank of every token, and lists of those of single bytes and of pairs of bytes (None: no token)."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks)
        self.one = [ranks.get(bytes([a])) for a in range(256)]
        self.two = [[ranks.get(bytes([a, b])) for b in range(256)] for a in range(256)]


_PLACE = 40  # bits of a heap entry that hold the place
_AT = (1 << _PLACE) - 1


def merge(piece: bytes, ranks: Ranks) -> list[int]:
    """Ids of a piece: its parts as a doubly linked list by their first bytes, pairs in a heap by rank and place."""
    size, two = len(piece), ranks.two
    find = ranks.get
    ids = [ranks.one[a] for a in piece]
    end = list(range(1, size + 1))  # where a part ends and the next begins
    before = list(range(-1, size - 1))
    pair: list[int | None] = []  # heap entry of a part and the next together
    for i, (a, b) in enumerate(zip(piece, piece[1:])):
        rank = two[a][b]
        pair.append(None if rank is None else rank << _PLACE | i)
    heap = [p for p in pair if p is not None]
    pair.append(None)
    heapify(heap)
    while heap:
        top = heappop(heap)
        i = top & _AT
        if pair[i] != top:
            continue  # one of the two has been merged since
        ids[i] = top >> _PLACE
        j = end[i]
        k = end[i] = end[j]
        pair[i] = pair[j] = None
        if k < size:
            before[k] = i
            rank = find(piece[i : end[k]])
            if rank is not None:
                pair[i] = rank = rank << _PLACE | i
                heappush(heap, rank)
        h = before[i]
        if h >= 0:
            pair[h] = None
            rank = find(piece[h:k])
            if rank is not None:
                pair[h] = rank = rank << _PLACE | h
                heappush(heap, rank)
    out = []
    i = 0
    while i < size:
        out.append(ids[i])
        i = end[i]
    return out


class Encoder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = Ranks({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.tokens}
        self.whole = PerfectHash(list(self.ranks))
        self.slot_ranks = [self.ranks.get(key, -1) for key in self.whole.keys]
        pattern = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
        self.matches = regex.compile(pattern).findall
        self.by_match: dict[str, tuple[int, ...]] = {}  # the garbage collector passes over tuples of numbers
        self.by_chunk: dict[str, tuple[str, int, bytes]] = {}

    def _match_ids(self, match: str) -> tuple[int, ...]:
        ids = self.by_match.get(match)
        if ids is None:
            data = match.encode()
            slot = self.whole.slot(data)
            ids = (self.slot_ranks[slot],) if slot >= 0 else tuple(merge(data, self.ranks))
            if len(self.by_match) >= KEPT:
                self.by_match.clear()
            self.by_match[match] = ids
        return ids

    def ids(self, text: str) -> list[int]:
        return [i for match in self.matches(text) for i in self._match_ids(match)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def _entry(self, chunk: str) -> tuple[str, int, bytes]:
        ids = self.ids(chunk)
        return " ".join([self.decimal[i] for i in ids]), len(ids), self.decode(ids)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal, SHA-256 of the decoded bytes."""
        first, *rest = _CUT.split(text)
        entries = [self._entry(first)] if first else []
        known = self.by_chunk
        for chunk in rest:
            entry = known.get(chunk)
            if entry is None:
                if len(known) >= KEPT:
                    known.clear()
                entry = known[chunk] = self._entry(" " + chunk)
            entries.append(entry)
        ids = " ".join([e[0] for e in entries])
        data = b"".join([e[2] for e in entries])
        return sum([e[1] for e in entries]), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(data).hexdigest()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    return Encoder(path, pattern)


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_TOKENS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids) of every document; a null text is empty and has no ids. Rows are kept as they are."""

    def make(batch: pa.RecordBatch) -> dict:
        own = encoder(path, pattern)
        return {"doc_id": batch[0], "ids": [own.ids(t or "") for t in batch[1].to_pylist()]}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, _TOKENS)


def encode_digest(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the ids decoded again).

    A null text is empty: no ids, and the digests of nothing. Repeated rows give repeated rows, a
    null doc_id stays null. Other columns are not read.
    """

    def make(batch: pa.RecordBatch) -> dict:
        own = encoder(path, pattern)
        rows = [own.digest(t or "") for t in batch[1].to_pylist()]
        return {"doc_id": batch[0], "n_tokens": [r[0] for r in rows], "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, _DIGEST)
