"""License scans: phrases, and templates with optional and replaceable regions.

A template is words with markup: [[ ... ]] may be left out, {{n}} stands for at most n words of any
kind, and || ends a beginning. It is compiled into an automaton over words; a text is accepted where
the automaton ends with every mandatory word met exactly. A text that goes on otherwise behind a
beginning is not accepted, but scores more than a phrase. Short licenses are templates from their
first to their last condition; Apache, GPL and MPL are known by the notices that files carry. All
matching runs inside the scan of one text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

# Phrases of the base scan and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licenses and of the notices that stand for the longest of them, as words, with markup.
_BSD_HEAD = """redistribution and use in source and binary forms with or without modification are permitted
    provided that the following conditions are met || [[1]] redistributions of source code must retain the above
    copyright notice this list of conditions and the following disclaimer [[2]] redistributions in binary form must
    reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
    and or other materials provided with the distribution"""
_BSD_NAMES = """[[3]] neither the name of {{10}} nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission"""
_BSD_END = """this software is provided by {{10}} as is and any express or implied warranties including but not limited to
    the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall
    {{10}} be liable for any direct indirect incidental special exemplary or consequential damages including but not
    limited to procurement of substitute goods or services loss of use data or profits or business interruption however
    caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise
    arising in any way out of the use of this software even if advised of the possibility of such damage"""
TEMPLATES = {
    "mit-notice": "[[released]] [[licensed]] under the [[terms of the]] mit license",
    "mit-text": """permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the software to deal in the software without restriction including without
        limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
        and to permit persons to whom the software is furnished to do so subject to the following conditions ||
        the above copyright notice and this permission notice [[including the next paragraph]] shall be included in
        all copies or substantial portions of the software the software is provided as is without warranty of any kind
        express or implied including but not limited to the warranties of merchantability fitness for a particular
        purpose and noninfringement in no event shall {{8}} be liable for any claim damages or other liability whether
        in an action of contract tort or otherwise arising from out of or in connection with the software or the use or
        other dealings in the software""",
    "apache-2.0-reference": "licensed under the apache license version 2 0",
    "apache-2.0-notice": """licensed under the apache license version 2 0 the license || you may not use this file except
        in compliance with the license you may obtain a copy of the license at [[http]] [[https]] www apache org licenses
        license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is
        distributed on an as is basis without warranties or conditions of any kind either express or implied see the
        license for the specific language governing permissions and limitations under the license""",
    "gpl-reference": "licensed under the gnu [[lesser]] [[affero]] general public license version {{1}}",
    "gpl-notice": """free software you can redistribute it and or modify it under the terms of the gnu [[lesser]]
        [[library]] [[affero]] general public license as published by the free software foundation [[either]] version
        {{2}} [[of the license]] [[or at your option any later version]] || {{6}} is distributed in the hope that it will
        be useful but without any warranty without even the implied warranty of merchantability or fitness for a
        particular purpose see the gnu [[lesser]] [[library]] [[affero]] general public license for more details""",
    "mpl-2.0-notice": """this source code form is subject to the terms of the mozilla public license v 2 0 || if a copy of
        the mpl was not distributed with this file you can obtain one at [[http]] [[https]] mozilla org mpl 2 0""",
    "bsd-2-text": f"{_BSD_HEAD} {_BSD_END}",
    "bsd-3-text": f"{_BSD_HEAD} {_BSD_NAMES} {_BSD_END}",
    "isc-text": """permission to use copy modify and or distribute this software for any purpose with or without fee is
        hereby granted provided that the above copyright notice and this permission notice appear in all copies ||
        the software is provided as is and {{6}} disclaims all warranties with regard to this software including all
        implied warranties of merchantability and fitness in no event shall {{6}} be liable for any special direct
        indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether
        in an action of contract negligence or other tortious action arising out of or in connection with the use or
        performance of this software""",
    "zlib-text": """this software is provided as is without any express or implied warranty in no event will {{6}} be held
        liable for any damages arising from the use of this software permission is granted to anyone to use this software
        for any purpose including commercial applications and to alter it and redistribute it freely subject to the
        following restrictions || [[1]] the origin of this software must not be misrepresented you must not claim that you
        wrote the original software if you use this software in a product an acknowledgment in the product documentation
        would be appreciated but is not required [[2]] altered source versions must be plainly marked as such and must not
        be misrepresented as being the original software [[3]] this notice may not be removed or altered from any source
        distribution""",
    "cc-by-nc-4.0-notice": "[[this work is]] licensed under [[a]] [[the]] cc by nc 4 0 [[international]] [[license]]",
    "cc-by-4.0-notice": "[[this work is]] licensed under [[a]] [[the]] creative commons attribution 4 0 international license",
}

_words = re.compile(rb"[0-9a-z\x80-\xff]+").findall
_worth = re.compile(rb"licen|permission|redistribut|warrant").search
_IS_WORD = np.array([bool(re.match(rb"[0-9A-Za-z\x80-\xff]", bytes([b]))) for b in range(256)])
_MARKUP = re.compile(r"\[\[|\]\]|\{\{\d+\}\}|\|\||[^\s\[\]{}|]+")


class Automaton:
    """States and what leads on from them: a word, any word (None), or nothing at all (`skips`)."""

    def __init__(self, template: str):
        self.steps: list[dict[bytes | None, list[int]]] = [{}]
        self.skips: list[list[int]] = [[]]
        self.mandatory = 0
        opened: list[int] = []
        state, self.beginning = 0, None
        for mark in _MARKUP.findall(template):
            if mark == "||":
                self.beginning = state
            elif mark == "[[":
                opened.append(state)
            elif mark == "]]":
                self.skips[opened.pop()].append(state)
            elif mark.startswith("{{"):
                first, before = state, []
                for _ in range(int(mark[2:-2])):
                    before.append(state)
                    state = self._step(state, None)
                for earlier in before or [first]:
                    self.skips[earlier].append(state)
            else:
                self.mandatory += not opened
                state = self._step(state, mark.encode())
        self.end = state
        self.first = {word for s in self._closure({0}) for word in self.steps[s]}

    def _step(self, state: int, word: bytes | None) -> int:
        self.steps.append({})
        self.skips.append([])
        self.steps[state].setdefault(word, []).append(len(self.steps) - 1)
        return len(self.steps) - 1

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for after in self.skips[todo.pop()]:
                if after not in states:
                    states.add(after)
                    todo.append(after)
        return states

    def longest(self, words: list[bytes], start: int) -> tuple[int, bool]:
        """Words of the longest accepted run from `start`, 0 if none is; and whether a beginning stands there."""
        states, best, begun = self._closure({0}), 0, False
        for at in range(start, len(words)):
            word = words[at]
            states = self._closure({s for state in states for key in (word, None) for s in self.steps[state].get(key, ())})
            if not states:
                break
            begun |= self.beginning in states
            if self.end in states:
                best = at + 1 - start
        return best, begun


@lru_cache(maxsize=1)
def automata() -> dict[str, Automaton]:
    return {label: Automaton(template) for label, template in TEMPLATES.items()}


@lru_cache(maxsize=1)
def _first_words() -> frozenset[bytes]:
    return frozenset(w for automaton in automata().values() for w in automaton.first if w is not None)


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(place, label) of every place where a phrase's words stand one after another."""
    found = []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        for i, word in enumerate(words):
            if word == parts[0] and words[i : i + len(parts)] == parts:
                found.append((i, label))
    return found


def scan(text: str | None) -> dict:
    data = (text or "").encode()
    is_word = _IS_WORD[np.frombuffer(data, np.uint8)]
    row = {"n_words": int(np.count_nonzero(is_word[1:] & ~is_word[:-1])) + int(is_word[:1].sum()), "n_base": 0}
    row |= {"first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": []}
    data = data.lower()
    if not _worth(data):
        return row
    words = _words(data)
    if found := phrase_places(words):
        row |= {"n_base": len(found), "first_word": min(found)[0], "last_word": max(found)[0]}
    begun = False
    places: dict[bytes, list[int]] = {}
    for i, word in enumerate(words):
        if word in _first_words():
            places.setdefault(word, []).append(i)
    for label, automaton in automata().items():
        starts = range(len(words)) if None in automaton.first else sorted(i for w in automaton.first for i in places.get(w, ()))
        for i in starts:
            length, beginning = automaton.longest(words, i)
            begun |= beginning
            if length:
                row["spans"].append({"label": label, "start": i, "length": length})
    base = {label for _, label in found}
    row["base_labels"] = ",".join(sorted(base))
    row["labels"] = ",".join(sorted(base | {s["label"] for s in row["spans"]}))
    row["score"] = 1.0 if row["spans"] else 0.7 if begun else 0.5 if base else 0.0
    return row


_SPAN = pa.struct([("label", pa.string()), ("start", pa.int64()), ("length", pa.int64())])
_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
        ("spans", pa.list_(_SPAN)),
    ]
)


def licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    spans are the template's label, first word and length of each accepted place. score is 1 if a
    template is accepted, 0.7 if only the beginning of one occurs, 0.5 if only a phrase, else 0. Null and empty texts have no words,
    empty labels and null places. Repeated rows give repeated rows; a null doc_id stays null. Other
    columns are not read.
    """

    def make(batch: pa.RecordBatch) -> dict:
        rows = [scan(t) for t in batch[1].to_pylist()]
        return {"doc_id": batch[0], **{f.name: [r[f.name] for r in rows] for f in _ROW if f.name != "doc_id"}}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, _ROW)
