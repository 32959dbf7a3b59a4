"""Toxicity of texts whose wording may be disguised, by a noisy channel.

Words that look disguised (digits or symbols among letters, a letter three times or more, letters
kept apart by blanks or marks) become a lattice: every character may stand for itself, for a letter
it is used for, for nothing between letters, or repeat the letter before it. Viterbi decoding under
a character trigram model and the channel's costs restores the likeliest word. The restored text is
scored by a logistic regression over a lexicon of words and word beginnings, both learned from
labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, map_batches, spark_schema, stored

#: Words and beginnings in the lexicon at most, those with the most evidence: texts whose toxic words are all rarer score as clean.
LEXICON = 1_000
#: Letter trigrams of the character model at most, the commonest; others have its floor.
GRAMS = 100_000
#: Share of the toxic texts (copies counted once) that a lexicon entry occurs in at least.
SUPPORT = 0.01
#: Share of the toxic texts that an entry occurs in at least to decide alone, with next to no clean text.
SURE = 0.03
_BEGINNINGS = (4, 5, 6, 7)
_KEPT = 60_000
#: Length of a token that is kept, and of a run that is decoded at once.
_KEPT_LENGTH, _RUN = 64, 400
#: Texts whose features, some hundred rows each, a task holds at once.
_TEXTS = 256
#: Bits of the filter that texts pass before they are moved to their marks, 4 MB at every size.
_FILTER = 1 << 25

# Letters that other characters are used for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
_APART = " .,-_*~·'/\\|"
_CHANGE, _DROP, _REPEAT, _BREAK = 1.5, 0.7, 0.4, 1.0
_FLOOR = math.log(1e-5)

_edge = re.compile(r"^[^\w$@!|€£]+|(?:[^\w]|_)+$").sub
_disguised = re.compile(r"[^\W\d_].*[\d@$!|+(<€£¡*._~·'/\\-]|[\d@$!|+(<€£¡].*[^\W\d_]|([^\W\d_])\1\1").search
_tripled = re.compile(r"([^\W\d_])\1\1").search
_LETTER = r"[^\W_]|[@$!|+(<€£¡]"
#: Three or more letters, or characters used for one, each kept apart by up to three blanks or marks.
_spaced = re.compile(rf"(?<![^\W_])(?:{_LETTER})(?:[\s.*_~·,/\\'|-]{{1,3}}(?:{_LETTER})){{2,}}(?![^\W_])").finditer
_two_letters = re.compile(r"[^\W\d_].*?[^\W\d_]", re.S).search


class CharacterModel:
    """Trigram probabilities of letters inside words; ^ stands before a word, $ after it."""

    def __init__(self, counts: dict[str, float]):
        pairs: Counter[str] = Counter()
        for gram, n in counts.items():
            pairs[gram[:2]] += n
        self.log = {gram: math.log(0.98 * n / pairs[gram[:2]] + 0.02 / 40) for gram, n in counts.items()}

    def cost(self, before: str, letter: str) -> float:
        return -self.log.get(before + letter, _FLOOR)


def decode(token: str, model: CharacterModel, apart: bool = False) -> str:
    """The likeliest word behind a token: Viterbi over states of the two letters before.

    With ``apart`` letters are kept apart by blanks or marks, and any of these may also stand between two words.
    """
    paths: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
    seen = ""
    for char in token:
        letters = [(char, 0.0)] if char.isalpha() else []
        letters += [(letter, _CHANGE) for letter in LEET.get(char, "")]
        mark = char in _APART or char.isspace()
        reached: dict[str, tuple[float, str]] = {}

        def reach(state: str, cost: float, word: str) -> None:
            if state not in reached or (cost, word) < reached[state]:
                reached[state] = (cost, word)

        for state, (cost, word) in paths.items():
            for letter, change in letters:
                reach(state[1] + letter, cost + change + model.cost(state, letter), word + letter)
                if seen == char and word.endswith(letter):
                    reach(state, cost + _REPEAT, word)
            if not letters or mark:
                reach(state, cost + _DROP, word)
            if apart and mark and state != "^^":
                reach("^^", cost + _BREAK + model.cost(state, "$"), word + " ")
        paths = reached
        seen = char if not (apart and mark) else seen
    return min((cost + model.cost(state, "$"), word) for state, (cost, word) in paths.items())[1]


def _core(token: str) -> str:
    """A token without what stands around the word; usual marks are taken off without the pattern."""
    plain = token.lstrip("\"'([").rstrip(".,;:!?\"')]")
    return plain if plain.isalpha() else _edge("", token)


def _features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in _BEGINNINGS if len(word) > n)]


class Scorer:
    """sure: probabilities that single entries give a text, whatever else it holds."""

    def __init__(self, lexicon: dict[str, float], prior: float, grams: dict[str, float], sure: dict[str, float]):
        self.lexicon, self.prior, self.sure = lexicon, prior, sure
        self.model = CharacterModel(grams)
        self.heads = {f[:4] for f in lexicon}  # what every feature of a word with one in the lexicon begins with
        self.known: dict[str, tuple[str, ...]] = {}
        whole = sorted((re.escape(w) for w in lexicon if not w.endswith("*") and len(w) > 3), key=len, reverse=True)
        self.inside = re.compile("|".join(whole)).findall if whole else lambda text: []

    def _own(self, word: str) -> list[str]:
        return [f for f in _features(word) if f in self.lexicon] if word[:4] in self.heads else []

    def _token(self, token: str) -> tuple[str, ...]:
        core = _core(token)
        hits = self._own(core)
        if _disguised(core):
            hits += self._own(decode(core, self.model))
        return tuple(hits)

    def found(self, text: str) -> set[str]:
        text = text.lower()
        out: set[str] = set()
        known, heads = self.known, self.heads
        tokens = set(text.split())
        letters = [t for t in tokens if t.isalpha()]  # words as they stand, disguised only by repeated letters
        rest = tokens.difference(letters)
        for token in letters:
            if token[:4] in heads:
                out.update(self._own(token))
        if _tripled(" ".join(letters)):
            rest.update(filter(_tripled, letters))
        for token in rest:
            hits = known.get(token)
            if hits is None:
                if len(known) >= _KEPT:
                    known.clear()
                hits = self._token(token)
                if len(token) <= _KEPT_LENGTH:
                    known[token] = hits
            if hits:
                out.update(hits)
        for match in _spaced(text):
            if _two_letters(match.group()):
                out.update(self._apart(match.group()))
        return out

    def _apart(self, run: str) -> set[str]:
        """What letters kept apart spell: the words that the decoder makes of them, as other words, and what stands inside the whole."""
        out: set[str] = set()
        for start in range(0, len(run), _RUN):  # each part of a very long run overlaps the next
            words = decode(run[start : start + _RUN + _RUN // 4], self.model, apart=True).split()
            out.update(f for w in words for f in _features(w) if f in self.lexicon)
            out.update(self.inside("".join(words)))
        return out

    def score(self, text: str | None) -> float:
        return self.score_of(self.found(text or ""))

    def score_of(self, found: set[str]) -> float:
        logit = self.prior + math.fsum(self.lexicon[f] for f in found)
        return max(1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))), *(self.sure.get(f, 0.0) for f in found), 0.0)


_COUNTS = pa.schema([("feature", pa.string()), ("source", pa.int64())])
_PRESENT = pa.schema([("feature", pa.string()), ("n", pa.float64()), ("grams", pa.float64())])


def _words(text: str | None) -> set[str]:
    tokens = set((text or "").lower().split())
    letters = {t for t in tokens if t.isalpha()}
    return letters | {w for token in tokens - letters if (w := _core(token)).isalpha()}


def _sources(batch: pa.RecordBatch) -> dict:
    """Of (text): its features, each with a sketch of the text; the feature "" is in every text."""
    features, sources = [], []
    for text in batch[0].to_pylist():
        words = _words(text)
        sketch = min((xxhash.xxh3_64_intdigest(w) >> 1 for w in words), default=0)  # near copies share most words, so mostly their smallest hash
        own = {f for w in words for f in _features(w)} | {""}
        features += own
        sources += [sketch] * len(own)
    return {"feature": features, "source": sources}


def _counter(asked: frozenset[str]):
    """Of (text, share, toxic): sums of the shares of clean texts by the features asked for, and of all texts by letter trigram."""

    heads = {f[:4] for f in asked}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present: Counter[str] = Counter()
        words: dict[str, float] = {}
        grams: Counter[str] = Counter()

        def spell() -> None:
            for word, n in words.items():
                line = f"^^{word}$"
                for i in range(len(line) - 2):
                    gram = line[i : i + 3]
                    grams[gram] = grams.get(gram, 0.0) + n
            words.clear()

        for batch in (whole.slice(start, ROWS) for whole in batches for start in range(0, whole.num_rows, ROWS)):
            for text, share, toxic in zip(*(batch[i].to_pylist() for i in range(3))):
                own = _words(text)
                for word in own:
                    words[word] = words.get(word, 0.0) + share
                if not toxic:
                    present[""] += share
                    for f in {f for word in own if word[:4] in heads for f in _features(word) if f in asked}:
                        present[f] += share
            if len(words) > _KEPT:
                spell()
            if len(grams) > _KEPT:
                yield _present(Counter(), grams)
                grams.clear()
        spell()
        yield _present(present, grams)

    return run


def _present(present: Counter[str], grams: Counter[str]) -> pa.RecordBatch:
    columns = [[*present, *grams], [*present.values(), *[0.0] * len(grams)], [*[0.0] * len(present), *grams.values()]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PRESENT)], schema=_PRESENT)


def held_out(folds: int = 5):
    """True where crc32 of the id's text leaves the remainder 0; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == 0, F.lit(False))


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text, mark): null texts are empty, equal texts have equal marks."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.withColumn("mark", F.xxhash64("text"))


def marked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(mark, toxic, copies): the distinct labelled texts that are not held out, and the rows that hold each. No text moves."""
    toxic = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic") == 1).alias("toxic")).filter(~held_out())
    own = texts_of(docs).groupBy("doc_id", "mark").agg(F.count("*").alias("n"))
    own = stored(own.join(toxic, "doc_id", "left").groupBy("mark", "toxic").agg(F.sum("n").alias("n")), "marks")  # toxic: null if unlabelled
    copies = own.groupBy("mark").agg(F.sum("n").alias("copies"))
    return stored(own.filter("toxic is not null").select("mark", "toxic").join(copies, "mark"), "marked")


def labelled(docs: DataFrame, labels: DataFrame, most: int) -> tuple[DataFrame, dict[bool, float]]:
    """A sample of about ``most`` rows (text, toxic) of the labelled texts, to look at, and the rows that one of each class stands for.

    Copies of a text count once in a class. A class with more than half of ``most`` texts is thinned
    to about that by their hashes. The model does not use it: it is learned from all of them.
    """
    marks = marked(docs, labels)
    sizes = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
    share = {k: max(1.0, n / max(most // 2, 1)) for k, n in sizes.items()}
    part = F.when(F.col("toxic"), 1 / share.get(True, 1.0)).otherwise(1 / share.get(False, 1.0))
    chosen = marks.filter(F.pmod(F.xxhash64("mark"), F.lit(1 << 40)) < part * (1 << 40)).drop("copies")
    rows = texts_of(docs).select("text", "mark").join(chosen, "mark").groupBy("toxic", "mark").agg(F.min("text").alias("text"))
    return stored(rows.select("text", "toxic"), "labelled"), share


def among(marks: DataFrame):
    """A function of a mark: false only where it is not one of ``marks``, a fixed number of bits at every size."""
    word, bit = f"shiftright(pmod(mark, {_FILTER}), 6)", "cast(pmod(mark, 64) as int)"
    held = marks.groupBy(F.expr(word).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits")).toArrow()
    bits = np.zeros(_FILTER // 64, np.int64)
    bits[held["word"].to_numpy()] = held["bits"].to_numpy()

    @F.pandas_udf("boolean")
    def held_by(mark):
        place = mark.to_numpy() % _FILTER
        return pd.Series((bits[place >> 6] >> (place & 63) & 1).astype(bool))

    return held_by


def of_marks(texts: DataFrame, marks: DataFrame) -> DataFrame:
    """``texts`` joined with their marks: only those that pass a filter move, by a shuffle at every size."""
    return texts.filter(among(marks)("mark")).join(marks.hint("merge"), "mark")


def learned(docs: DataFrame, marks: DataFrame) -> Scorer:
    """Lexicon and character model from all labelled texts that are not held out; the weights are not fitted.

    Features of toxic texts first: those that enough of them have are then counted in the clean ones. So only
    candidates are counted there, at most 1 / SUPPORT times the features of a text, and each row of a text counts
    for one over its copies. Of the texts only those with such a mark (and a few more) move.
    """
    texts = texts_of(docs).select("text", "mark")
    toxic = of_marks(texts, marks.filter("toxic").select("mark")).groupBy("mark").agg(F.min("text").alias("text")).select("text")
    support = map_batches(toxic, _sources, _COUNTS, _TEXTS).distinct().groupBy("feature").agg(F.count("*").alias("toxic"))
    support = stored(support.filter("toxic >= 3 or feature = ''"), "support")
    total = support.filter("feature = ''").first()
    n_toxic = total["toxic"] if total else 0
    candidates = support.filter((F.col("feature") == "") | (F.col("toxic") >= max(3, SUPPORT * n_toxic)))
    asked = frozenset(r["feature"] for r in candidates.select("feature").collect()) - {""}
    rows = of_marks(texts, marks).select("text", (1 / F.col("copies")).alias("share"), "toxic")
    counts = rows.mapInArrow(_counter(asked), spark_schema(_PRESENT)).groupBy("feature").agg(F.sum("n").alias("clean"), F.sum("grams").alias("grams"))
    counts = stored(counts, "features")
    total = counts.filter("feature = ''").first()
    n_clean = total["clean"] if total else 0
    clean = F.coalesce("clean", F.lit(0.0))
    weight = F.log(((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((clean + 0.5) / (n_clean + 1)))
    kept = candidates.filter("feature <> ''").join(counts.filter("clean > 0").select("feature", "clean"), "feature", "left")
    kept = kept.select("feature", "toxic", clean.alias("clean"), weight.alias("weight")).filter("weight > 2")
    best = kept.orderBy(F.desc(F.round(F.col("toxic") * F.col("weight"), 9)), "feature").limit(LEXICON).collect()
    lexicon = {r["feature"]: r["weight"] for r in best}
    # Words that share a text share its weight in the regression; one alone may still say enough.
    precise = {r["feature"]: r["toxic"] / (r["toxic"] + r["clean"] + 2) for r in best if r["toxic"] >= max(20, SURE * n_toxic)}
    sure = {feature: share for feature, share in precise.items() if share >= 0.95}
    common = counts.filter("grams > 0").orderBy(F.desc(F.round("grams", 6)), "feature").limit(GRAMS).collect()
    grams = {r["feature"]: float(r["grams"]) for r in common}
    bulk, rare = sum(grams.values()), Counter()
    for word in lexicon:
        line = f"^^{word.rstrip('*')}$"
        rare.update(line[i : i + 3] for i in range(len(line) - 2 - word.endswith("*")))
    for gram, n in rare.items():  # half of the model's weight is on what is looked for
        grams[gram] = grams.get(gram, 0.0) + n * bulk / sum(rare.values())
    return Scorer(lexicon, math.log((n_toxic + 0.5) / (n_clean + n_toxic + 5.0)), grams, sure)


_FOUND = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("found", pa.list_(pa.int32()))])


def found_in(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, mark, found): places in the sorted lexicon of what each text holds, stored; no text is."""
    place = {f: i for i, f in enumerate(sorted(scorer.lexicon))}

    def make(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch[0], "mark": batch[2], "found": [sorted(place[f] for f in scorer.found(t)) for t in batch[1].to_pylist()]}

    return stored(map_batches(texts_of(docs), make, _FOUND), "found")


def fit(scorer: Scorer, found: DataFrame, marks: DataFrame, penalty: float = 0.03, steps: int = 100) -> None:
    """Weights of a logistic regression on 0/1 features over all labelled texts, by Spark ML; a text counts once.

    The bias stays what the classes say: a text without any of the words is no more or less toxic than others. Equal sets of features are one row with a weight. Without texts of both classes the lexicon's own weights stay.
    """
    names = sorted(scorer.lexicon)
    once = found.join(marks, "mark").groupBy("mark", "toxic").agg(F.min("found").alias("found"))
    rows = stored(once.groupBy("found", "toxic").agg(F.count("*").cast("double").alias("weight")), "patterns")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.sum("weight").alias("n")).collect()}
    if not names or len(sizes) < 2:
        return
    ones = F.udf(lambda places: Vectors.sparse(len(names), places, [1.0] * len(places)), VectorUDT())
    rows = rows.select(ones("found").alias("features"), F.col("toxic").cast("double").alias("label"), "weight")
    regression = LogisticRegression(weightCol="weight", regParam=penalty / sum(sizes.values()), standardization=False, maxIter=steps)
    bias = Vectors.dense([scorer.prior])
    model = regression.setLowerBoundsOnIntercepts(bias).setUpperBoundsOnIntercepts(bias).fit(rows)
    scorer.lexicon = dict(zip(names, model.coefficients.toArray().tolist()))


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts get the score of a text without lexicon words. Labels may be few, repeated
    (toxic if one row says so) or null (left out); without any toxic label no text is predicted.
    Repeated rows give repeated rows; a null doc_id is never held out. Other columns are not read.
    """
    marks = marked(docs, labels)
    scorer = learned(docs, marks)
    found = found_in(docs, scorer)
    fit(scorer, found, marks)
    names, score_of = sorted(scorer.lexicon), scorer.score_of

    def make(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch[0], "score": np.array([score_of({names[i] for i in row}) for row in batch[1].to_pylist()], float)}

    scored = map_batches(found.select("doc_id", "found"), make, _SCORES)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, whose text is not predicted toxic.

    Null and empty texts score as texts without lexicon words; rows of one text stay or go together,
    with or without a doc_id. An empty table stays empty, and without toxic labels every row stays.
    """
    marks = marked(docs, labels)
    scorer = learned(docs, marks)
    fit(scorer, found_in(docs, scorer), marks)

    @F.pandas_udf("double")
    def score(text):
        return text.map(lambda t: scorer.score(None if t is None or t != t else t)).astype("float64")

    return docs.filter(score(F.col("text").cast("string")) < 0.5)
