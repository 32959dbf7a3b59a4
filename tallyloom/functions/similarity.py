"""Similarity of short names.

The score is the token-sort ratio: sort the words of both names, take the length L of the
longest common subsequence (LCS) and return 100 * 2L / (|a| + |b|), rounded half to even.

A block of names meets a shelf of roster entries. LCS uses the bit-parallel recurrence of
Crochemore et al. (2001) and Hyyro (2004): one 32- or 64-bit integer, the lane of an entry, holds
a row of the dynamic program, so a letter costs four integer operations on all lanes. The names are
walked in order of their texts, so the rows of a beginning that several names share are computed
once, and a lane is dropped as soon as its unmatched letters rule out the best score known so far.
Below a beginning of few names or lanes, the letters two texts have in common bound their score as well.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import lru_cache, partial

import numpy as np
from pyspark import cloudpickle

from .labels import FIRST_LETTER_BONUS

# The tasks carry this module with them, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NEAR = 8  # neighbours of a name in alphabetical order that are scored first
_FIRST_LANES = 1024  # lanes that a name meets at first; the later ones have its best score to reach
_MORE_LANES = 8  # and how many times as many it meets after that
_FEW = 1 << 14  # pairs below a beginning that are put aside, to be scored with others
_PAIRS = 1 << 16  # pairs put aside that are scored at once, about
_LAST = (1 << 32) - 1

_CODES = np.full(256, 255, np.uint8)  # letter codes: 0 past the end, 1 for a blank, 2..27 for A..Z
_CODES[0], _CODES[32], _CODES[65:91] = 0, 1, np.arange(2, 28)


def sort_tokens(name: str) -> str:
    return " ".join(sorted(name.split())) if " " in name else name


def _letters(texts: list[str], width: int) -> np.ndarray:
    """Texts of at most ``width`` letters as rows of letter codes."""
    return _CODES[np.array(texts, dtype=f"S{width}").view(np.uint8).reshape(len(texts), width)]


def _as_texts(codes: np.ndarray) -> np.ndarray:
    """Rows of letter codes as texts that sort."""
    return np.ascontiguousarray(codes).view(f"S{codes.shape[1]}")[:, 0]


def _signatures(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as 64 bits for the first and second of each letter and the third of ten common ones, and the letters beyond.

    Letters in common are at most the common bits plus the smaller number of letters beyond, and a
    common subsequence has no more letters than that.
    """
    marks, beyond = np.zeros(len(codes), np.uint64), np.zeros(len(codes), np.int64)
    for letter in range(1, 28):
        count = (codes == letter).sum(axis=1)
        bits = [2 * letter - 2, 2 * letter - 1] + [54 + i for i, c in enumerate(_THIRD) if c == letter]
        for nth, bit in enumerate(bits):
            marks |= (count > nth).astype(np.uint64) << np.uint64(bit)
        beyond += np.maximum(count - len(bits), 0)
    return marks, np.minimum(beyond, 64).astype(np.uint8)  # entries in lanes have no more


_THIRD = [1, *(ord(c) - 63 for c in "AEINORSTL")]


def _ranks(score: np.ndarray, number: np.ndarray) -> np.ndarray:
    """By score, then the first entry."""
    return (score.astype(np.int64) << 32) + (_LAST - number)


def _ratio(common: np.ndarray, letters: np.ndarray) -> np.ndarray:
    return np.rint(200.0 * common / letters)


class _Lanes:
    """Entries side by side: in lane k, the bits of masks[c] are the places of letter c in entry k, the last place on top."""

    def __init__(self, texts: list[str], initials: np.ndarray, numbers: np.ndarray, kind: type):
        self.bits = np.dtype(kind).itemsize * 8
        self.initials, self.numbers = initials, numbers
        self.sizes = np.array([len(text) for text in texts], np.uint8)
        self.codes = _letters(texts, int(self.sizes.max()))
        self.masks = np.zeros((28, len(texts)), kind)
        for at in range(self.codes.shape[1]):
            lane = np.flatnonzero(self.codes[:, at])
            self.masks[self.codes[lane, at], lane] |= kind(1) << (self.bits - self.sizes[lane] + at).astype(kind)
        self.marks, self.beyond = _signatures(self.codes)
        self.unmatched = ~kind(0) << (self.bits - self.sizes).astype(kind)  # a bit for each letter
        as_texts = _as_texts(self.codes)
        self.alphabetical = np.argsort(as_texts, kind="stable")
        self.texts = as_texts[self.alphabetical]


class Shelf:
    """Entries (cleaned texts) that names meet together; the first of them is entry number ``first``."""

    def __init__(self, locals_: list[str], first: int = 0):
        texts = [sort_tokens(text) for text in locals_]
        sizes, initials = np.array([len(text) for text in texts]), np.array([text[:1] for text in locals_], dtype="U1")
        self.lanes = []
        for kind, shortest, longest in ((np.uint32, 1, 32), (np.uint64, 33, 64)):
            at = np.flatnonzero((sizes >= shortest) & (sizes <= longest))
            if len(at):
                self.lanes.append(_Lanes([texts[i] for i in at], initials[at], first + at, kind))
        beyond = np.flatnonzero(sizes > 64).tolist()  # too long for a lane
        self.long = [(_letters([texts[i]], len(texts[i]))[0], initials[i], first + i) for i in beyond]


@lru_cache(maxsize=4096)
def _slack(size: int, bits: int, score: int) -> np.ndarray:
    """How many letters of an entry a pair with a name of ``size`` letters may leave unmatched to reach a score, and one.

    By size of the entry, without and then with the bonus of the first letter; 0 is out of reach.
    """
    entry, common = np.arange(bits + 1), np.arange(size + 1)
    most = np.minimum(size, entry)
    scores = np.where(common <= most[:, None], _ratio(common, size + entry[:, None]), np.inf)
    needs = [(scores + bonus < score).sum(axis=1) for bonus in (0, FIRST_LETTER_BONUS)]
    return np.concatenate([np.where(need <= most, entry - need + 1, 0) for need in needs]).astype(np.uint8)


class _Chosen:
    """Lanes that a beginning still meets: masks, entry numbers, kinds (size and bonus) and which of all lanes they are."""

    def __init__(self, masks: np.ndarray, numbers: np.ndarray, kinds: np.ndarray, lane: np.ndarray, slack: Callable[[int], np.ndarray]):
        self.masks, self.numbers, self.kinds, self.lane, self.slack = masks, numbers, kinds, lane, slack
        self.by_score: dict[int, np.ndarray] = {}

    def take(self, at: np.ndarray) -> _Chosen:
        return _Chosen(self.masks.take(at, axis=1), self.numbers.take(at), self.kinds.take(at), self.lane.take(at), self.slack)

    def before(self, at: np.ndarray | None, rank: int) -> int:
        """How many of the lanes ``at`` (None: all) are of entries before that of the rank."""
        cut = int(self.numbers.searchsorted(_LAST - (rank & _LAST)))
        return cut if at is None else int(at.searchsorted(cut))

    def _reaching(self, score: int) -> np.ndarray:
        if score not in self.by_score:
            self.by_score[score] = self.slack(score).take(self.kinds)
        return self.by_score[score]

    def allowed(self, at: np.ndarray | None, rank: int) -> np.ndarray:
        """The slack of the lanes ``at`` (None: all) for a rank above ``rank``: entries before its entry need its score, later ones more."""
        same, more, cut = self._reaching(rank >> 32), self._reaching((rank >> 32) + 1), self.before(at, rank)
        if at is not None:
            same, more = same.take(at[:cut], mode="clip"), more.take(at[cut:], mode="clip")
        else:
            same, more = same[:cut], more[cut:]
        return more if cut == 0 else same if not len(more) else np.concatenate((same, more))


class _Walk:
    """Names of one size (sorted texts, as letter codes) and first letter meet lanes; ``best`` has their ranks and is raised."""

    def __init__(self, codes: np.ndarray, initial: str, best: np.ndarray):
        self.codes, self.initial, self.best = codes, initial, best
        self.n, self.size = codes.shape
        self.letters = codes.tolist()
        self.marks, self.beyond = _signatures(codes)
        shared = np.zeros(self.n, np.int64)  # letters at the beginning that a name shares with the one before
        equal = codes[1:] == codes[:-1]
        shared[1:] = np.where(equal.all(axis=1), self.size, equal.argmin(axis=1))
        self.shared = shared.tolist()
        self.ends = []  # by depth and name: the next name with another beginning of so many letters
        for depth in range(self.size + 1):
            other = np.where(shared < depth, np.arange(self.n), self.n)
            self.ends.append([*np.minimum.accumulate(other[::-1])[::-1][1:].tolist(), self.n])

    def meet(self, lanes: _Lanes) -> int:
        """Returns how many pairs were scored to the end."""
        self.lanes, self.scored = lanes, 0
        kind, width = lanes.masks.dtype.type, len(lanes.sizes)
        # Unmatched letters of an entry that are followed by at least so many others: the name's last letters cannot make up for them.
        self.before = [kind((1 << max(lanes.bits - left, 0)) - 1) for left in range(self.size + 1)]
        self.kinds = lanes.sizes + np.uint8(lanes.bits + 1) * (lanes.initials == self.initial)
        self.any_beyond = self.beyond.any() and lanes.beyond.any()
        self.offsets = self.codes.T.astype(np.int64) * width  # of the letters' masks
        self.flat_masks = lanes.masks.ravel()
        self.aside: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(self.size)]
        self.n_aside = 0
        slack = partial(_slack, self.size, lanes.bits)
        if width > _NEAR * _NEAR:
            self._meet_neighbours()
        low, step = 0, _FIRST_LANES
        while low < width:
            some = slice(low, min(width, low + step))
            chosen = _Chosen(lanes.masks[:, some], lanes.numbers[some], self.kinds[some], np.arange(width)[some], slack)
            self._walk(chosen, lanes.unmatched[some])
            low, step = some.stop, step * _MORE_LANES
        return self.scored

    def _meet_neighbours(self) -> None:
        lanes = self.lanes
        texts = _as_texts(self.codes[:, : lanes.codes.shape[1]])
        first = np.clip(np.searchsorted(lanes.texts, texts) - _NEAR // 2, 0, len(lanes.texts) - _NEAR)
        lane = lanes.alphabetical[(first[:, None] + np.arange(_NEAR)).ravel()]
        name, allowed = np.repeat(np.arange(self.n), _NEAR), np.full(len(lane), 255, np.uint8)
        self.aside[0].append((name, lane, lanes.unmatched.take(lane), allowed))
        self._score_aside()

    def _walk(self, chosen: _Chosen, state: np.ndarray) -> None:
        """All names, beginning by beginning, against some lanes."""
        open_ = np.bitwise_count(state & self.before[self.size]) < chosen.allowed(None, int(self.best.min()))
        which = np.flatnonzero(open_)
        if len(which) * self.n <= _FEW:
            self._put_aside(0, 0, self.n, chosen, which, state.take(which))
            self._score_aside()
            return
        if len(which) < len(open_):
            chosen, state = chosen.take(which), state.take(which)
        beginnings = [(chosen, None, state)] * (self.size + 1)  # by depth; None: all of the chosen lanes are left, or which
        name = 0
        while name < self.n:
            depth, letters = self.shared[name], self.letters[name]
            chosen, at, state = beginnings[depth]
            while True:
                hit = chosen.masks[letters[depth]]
                hit = state & (hit if at is None else hit.take(at, mode="clip"))
                more = state + hit
                np.bitwise_xor(state, hit, out=hit)
                state = np.bitwise_or(more, hit, out=more)
                depth += 1
                end = self.ends[depth][name]
                n_names = end - name
                rank = int(self.best[name] if n_names == 1 else self.best[name:end].min())
                missing = np.bitwise_count(state & self.before[self.size - depth])
                allowed = chosen.allowed(at, rank)
                open_ = missing < allowed
                n_open = int(np.count_nonzero(open_))
                if depth == self.size:
                    self.scored += len(open_) * n_names
                if not n_open:
                    break
                if depth == self.size:
                    which = np.flatnonzero(open_)
                    lane = chosen.lane.take(which if at is None else at.take(which))
                    np.maximum(self.best[name:end], self._ranked(lane, missing.take(which)).max(), out=self.best[name:end])
                    break
                if n_names == 1 or n_open * n_names <= _FEW:
                    which = np.flatnonzero(open_)
                    self._put_aside(depth, name, end, chosen, which if at is None else at.take(which), state.take(which))
                    break
                if n_open < 0.75 * len(open_):
                    which = np.flatnonzero(open_)
                    state, at = state.take(which), which if at is None else at.take(which)
                    if n_names > 8:  # enough to copy the masks for
                        chosen, at = chosen.take(at), None
                beginnings[depth] = chosen, at, state
            name = end
        self._score_aside()

    def _put_aside(self, depth: int, name: int, end: int, chosen: _Chosen, at: np.ndarray, state: np.ndarray) -> None:
        """Pairs of names of one beginning and chosen lanes, if the letters they have in common can do."""
        if not len(at):
            return
        lane = chosen.lane.take(at)
        kinds, by_score = chosen.kinds.take(at), {}
        allowed = np.empty((end - name, len(at)), np.uint8)
        for row, rank in zip(allowed, self.best[name:end].tolist()):
            score, cut = rank >> 32, chosen.before(at, rank)
            for reached in (score, score + 1):
                if reached not in by_score:
                    by_score[reached] = chosen.slack(reached).take(kinds)
            row[:cut], row[cut:] = by_score[score][:cut], by_score[score + 1][cut:]
        common = np.bitwise_count(self.marks[name:end, None] & self.lanes.marks.take(lane))
        if self.any_beyond:
            common += np.minimum(self.beyond[name:end, None], self.lanes.beyond.take(lane))
        found = np.flatnonzero(self.lanes.sizes.take(lane) - common < allowed)
        of_name, of_lane = np.divmod(found, len(lane))
        self.aside[depth].append((of_name + name, lane.take(of_lane), state.take(of_lane), allowed.ravel().take(found)))
        self.n_aside += len(found)
        if self.n_aside >= _PAIRS:
            self._score_aside()

    def _score_aside(self) -> None:
        """Pairs put aside go on letter by letter, each from the depth where it was put aside."""
        pairs = [np.empty(0, np.int64), np.empty(0, np.int64), self.lanes.unmatched[:0], np.empty(0, np.uint8)]
        for depth in range(self.size):
            if self.aside[depth]:
                pairs = [np.concatenate(columns) for columns in zip(pairs, *self.aside[depth])]
                self.aside[depth] = []
            name, lane, state, allowed = pairs
            if not len(name):
                continue
            at = self.offsets[depth].take(name)
            at += lane
            hit = self.flat_masks.take(at)
            hit &= state
            more = state + hit
            state = np.bitwise_or(more, state ^ hit, out=more)
            missing = np.bitwise_count(state & self.before[self.size - depth - 1])
            open_ = np.flatnonzero(missing < allowed)
            if depth + 1 == self.size:
                self.scored += len(name)
                lane = lane.take(open_)
                np.maximum.at(self.best, name.take(open_), self._ranked(lane, missing.take(open_)))
            elif len(open_) < 0.8 * len(name):
                pairs = [column.take(open_) for column in (name, lane, state, allowed)]
            else:
                pairs = [name, lane, state, allowed]
        self.n_aside = 0

    def _ranked(self, lane: np.ndarray, missing: np.ndarray) -> np.ndarray:
        sizes = self.lanes.sizes.take(lane).astype(np.int64)
        bonus = FIRST_LETTER_BONUS * (self.kinds.take(lane) > self.lanes.bits)
        return _ranks(_ratio(sizes - missing, self.size + sizes) + bonus, self.lanes.numbers.take(lane))


def _lcs_rows(names: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """LCS of names of one size with one entry of any length: a dynamic program row per letter."""
    row = np.zeros((len(names), len(entry) + 1), dtype=np.int64)
    for at in range(names.shape[1]):
        longer = row.copy()
        longer[:, 1:] = np.maximum(row[:, 1:], row[:, :-1] + (names[:, at : at + 1] == entry))
        row = np.maximum.accumulate(longer, axis=1)
    return row[:, -1]


class Block:
    """Names (cleaned texts) with the best score and entry each has met, which are carried on from shelf to shelf."""

    def __init__(self, names: list[str]):
        texts = [sort_tokens(name) for name in names]
        kinds = [(len(text), name[:1]) for name, text in zip(names, texts)]
        order = sorted((i for i, text in enumerate(texts) if text), key=lambda i: (kinds[i], texts[i]))
        cuts = [i for i in range(1, len(order)) if kinds[order[i]] != kinds[order[i - 1]]]
        runs = [order[low:high] for low, high in zip([0, *cuts], [*cuts, len(order)]) if low < high]
        self.runs = [(np.array(run), _letters([texts[i] for i in run], kinds[run[0]][0]), kinds[run[0]][1]) for run in runs]
        self.best = np.full(len(names), _LAST, np.int64)  # score 0 at the first entry

    def meet(self, shelf: Shelf) -> int:
        """Shelves come in order of their entries. Returns how many pairs were scored to the end."""
        scored = 0
        for at, codes, initial in self.runs:
            walk = _Walk(codes, initial, self.best[at])
            scored += sum(walk.meet(lanes) for lanes in shelf.lanes) + len(codes) * len(shelf.long)
            for entry, entry_initial, number in shelf.long:
                score = _ratio(_lcs_rows(codes, entry), codes.shape[1] + len(entry)) + FIRST_LETTER_BONUS * (initial == entry_initial)
                np.maximum(walk.best, _ranks(score, number), out=walk.best)
            self.best[at] = walk.best
        return scored

    def scores(self) -> np.ndarray:
        return (self.best >> 32).astype(np.int32)

    def entries(self) -> np.ndarray:
        """Numbers of the best entries, the first of equals."""
        return _LAST - (self.best & _LAST)


def best_of(names: list[str], locals_: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """For each name the best score (with first-letter bonus) and its entry, the first of equals; and the pairs scored to the end.

    Both are cleaned texts (A..Z, blanks). Neighbours in alphabetical order are scored first. A pair is left as soon
    as the letters it has missed rule out the best score so far, or one above it for an entry behind the best.
    """
    block = Block(names)
    scored = block.meet(Shelf(locals_))
    return block.scores(), block.entries(), scored
