"""Language of texts by hierarchical discrimination.

A text's letters give hashed grams of two to four letters, word borders included. The family of its
language is predicted first, by naive Bayes over the grams of all training texts. Within the family
every two languages are told apart by a linear support vector machine, fitted on a bounded sample of
distinct training texts of either; the language with the most votes wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROWS, map_batches, spark_schema, stored

# Families of related languages, by their codes.
FAMILIES = {
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "dravidian": "kn ml ta te",
    "finnic": "et fi",
    "germanic": "af da de en fy is lb nb nl nn no sv",
    "indic": "bn gu hi mr ne pa ur",
    "iranian": "fa ku ps tg",
    "malayic": "id jv ms su",
    "romance": "ca es fr gl it oc pt ro",
    "semitic": "am ar he mt",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "turkic": "az kk ky tk tr tt uz",
}
#: Languages that are learned, the commonest among the training texts; it bounds the model.
LANGUAGES = 200
#: Distinct training texts of a language that the support vector machines are fitted on, about.
ROWS_PER_LANGUAGE = 600
_BITS = 15
_BINS = 1 << _BITS
_SIZES = (2, 3, 4)
_SPACE = 32
_CHUNK = 1 << 20
_UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(1_000_003)
#: Neighbouring grams say much the same: so many count as one in the probability of a family.
_OVERLAP = 9.0


def family_of(language: str, families: dict[str, str] = FAMILIES) -> str:
    """The family that lists the language or the part of its code before a mark; else a family of its own."""
    code = language.lower().replace("_", "-").split("-")[0]
    return next((family for family, codes in families.items() if code in codes.split()), f"language {language}")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.frombuffer(bytes(map(str.isalpha, map(chr, range(0x110000)))), bool)


def _chunks(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers of texts and texts, so many that they are some _CHUNK characters; a longer one in parts, each alone."""
    held, numbers, size = [], [], 0
    for i, text in enumerate(texts):
        if size and size + len(text) > _CHUNK:
            yield numbers, held
            held, numbers, size = [], [], 0
        if len(text) > _CHUNK:
            for start in range(0, len(text), _CHUNK):
                yield [i], [text[start : start + _CHUNK]]
        else:
            held.append(text)
            numbers.append(i)
            size += len(text) + 2
    if held:
        yield numbers, held


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bin, number of the text) of each gram, chunk by chunk; texts without a letter have none.

    A gram that a cut of a very long text divides is not counted.
    """
    for numbers, held in _chunks(texts):
        lower = [f" {t.lower()} " for t in held]
        codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where(_letters()[codes], codes, _SPACE).astype(np.uint64)
        number = np.repeat(np.array(numbers, np.int32), [len(t) for t in lower])
        space = codes == _SPACE
        kept = ~(space & np.concatenate(([False], space[:-1])))
        codes, number, space = codes[kept], number[kept], space[kept]
        for size in _SIZES:
            m = len(codes) - size + 1
            if m < 1:
                continue
            value = np.full(m, size, np.uint64)
            for i in range(size):
                value = value * _STEP + codes[i : i + m]
            inside = ~(space[:m] & space[size - 1 : size - 1 + m]) if size == 2 else np.ones(m, bool)
            for i in range(1, size - 1):
                inside &= ~space[i : i + m]
            owner = np.where(space[:m], number[1 : m + 1], number[:m])[inside]
            yield ((value[inside] * _MIX) >> np.uint64(64 - _BITS)).astype(np.int32), owner


_COUNTS = pa.schema([("family", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())])


def family_counts(train: DataFrame, family: dict[str, int]) -> np.ndarray:
    """Grams of all training texts, a row for each family. train: text, lang."""
    width = max(family.values()) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width * _BINS, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                of_text = np.array([family[lang] for lang in part[1].to_pylist()], np.int64)
                for place, number in grams(part[0].to_pylist()):
                    total += np.bincount(of_text[number] * _BINS + place, minlength=len(total))
        met = np.flatnonzero(total)
        columns = [(met // _BINS).astype(np.int32), (met % _BINS).astype(np.int32), total[met]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_COUNTS)

    sums = train.select("text", "lang").mapInArrow(count, spark_schema(_COUNTS)).groupBy("family", "bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((width, _BINS), np.int64)
    out[sums["family"].to_numpy(), sums["bin"].to_numpy()] = sums["n"].to_numpy()
    return out


def sample(train: DataFrame, languages: list[str], rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """(lang, mark, text) of about `rows` distinct texts of each language at most, chosen by their hashes."""
    marked = train.filter(F.col("lang").isin(languages)).withColumn("mark", F.xxhash64("text"))
    marks = stored(marked.select("lang", "mark").distinct(), "marks")
    sizes = [(r["lang"], min(1.0, rows / r["count"])) for r in marks.groupBy("lang").count().collect()]  # LANGUAGES at most
    part = F.coalesce(*[F.when(F.col("lang") == lang, F.lit(share)) for lang, share in sizes], F.lit(1.0))
    chosen = F.broadcast(marks.filter(F.pmod(F.xxhash64("mark"), F.lit(1 << 40)) < part * (1 << 40)))  # about LANGUAGES * rows at most
    return marked.join(chosen, ["lang", "mark"]).groupBy("lang", "mark").agg(F.min("text").alias("text"))


_ROWS = pa.schema([("lang", pa.string()), ("mark", pa.int64()), ("bins", pa.list_(pa.int32())), ("counts", pa.list_(pa.float32()))])


def _described(batch: pa.RecordBatch) -> dict:
    """Grams of texts (lang, mark, text) with their shares in the text."""
    texts = batch[2].to_pylist()
    met: dict[int, list[np.ndarray]] = {}
    for place, number in grams(texts):
        cells, n = np.unique(number.astype(np.int64) * _BINS + place, return_counts=True)
        for i in np.unique(cells // _BINS):
            own = slice(*np.searchsorted(cells, [i * _BINS, (i + 1) * _BINS]))
            total = met.setdefault(int(i), [np.zeros(0, np.int64), np.zeros(0)])
            total[0], total[1] = np.concatenate((total[0], cells[own] % _BINS)), np.concatenate((total[1], n[own]))
    bins, counts = [], []
    for i in range(len(texts)):
        place, n = met.get(i, (np.zeros(0, np.int64), np.zeros(0)))
        place, back = np.unique(place, return_inverse=True)
        n = np.bincount(back, weights=n, minlength=len(place))
        bins.append(place.astype(np.int32))
        counts.append((n / max(n.sum(), 1)).astype(np.float32))
    return {"lang": batch[0], "mark": batch[1], "bins": bins, "counts": counts}


def support_vectors(rows: list[tuple[np.ndarray, np.ndarray]], positive: np.ndarray, scale: np.ndarray, passes: int = 40) -> np.ndarray:
    """Weights of a linear support vector machine (squared hinge loss) by dual coordinate descent.

    rows: (bins, shares), scaled by `scale` and brought to length one. Classes weigh alike.
    """
    w = np.zeros(_BINS)
    values = [shares * scale[bins] for bins, shares in rows]
    values = [v / max(np.linalg.norm(v), 1e-12) for v in values]
    sign = np.where(positive, 1.0, -1.0)
    cost = np.where(positive, len(rows) / (2 * max(positive.sum(), 1)), len(rows) / (2 * max((~positive).sum(), 1)))
    alpha = np.zeros(len(rows))
    rng = np.random.default_rng(1)
    for _ in range(passes):
        most = 0.0
        for i in rng.permutation(len(rows)):
            bins, x = rows[i][0], values[i]
            slope = sign[i] * (w[bins] @ x) - 1 + alpha[i] / (2 * cost[i])
            new = max(alpha[i] - slope / (1 + 1 / (2 * cost[i])), 0.0)
            if new != alpha[i]:
                w[bins] += (new - alpha[i]) * sign[i] * x
                most = max(most, abs(new - alpha[i]))
                alpha[i] = new
        if most < 1e-3:
            break
    return w * scale


def _slope(margins: np.ndarray, positive: np.ndarray) -> float:
    """The factor that makes a margin the logit of a probability, by Newton steps, kept where it grows without bound."""
    sign = np.where(positive, 1.0, -1.0)
    unit = max(float(np.abs(margins).mean()), 1e-12)
    x, a = margins / unit, 1.0
    for _ in range(20):
        p = 1 / (1 + np.exp(np.clip(sign * a * x, -30, 30)))
        a += ((sign * x * p).sum() - 0.1 * a) / ((x * x * p * (1 - p)).sum() + 0.1)
        a = float(np.clip(a, 0.1, 20.0))
    return a / unit


class Languages:
    """A fitted model. pairs: of each family, (first, second) numbers of its languages, weights (bins by pairs), slopes."""

    def __init__(self, names: list[str], members: list[list[int]], families: np.ndarray, prior: np.ndarray):
        self.names, self.members, self.families, self.prior = names, members, families, prior
        self.pairs: dict[int, tuple[list[tuple[int, int]], np.ndarray, np.ndarray]] = {}

    def _means(self, texts: list[str], weights: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of each column of weights over the grams of the chosen texts, and how many grams these are."""
        out, n = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
        for place, number in grams(texts if chosen.all() else [t if c else "" for t, c in zip(texts, chosen.tolist())]):
            n += np.bincount(number, minlength=len(texts))
            for c in range(weights.shape[1]):
                out[:, c] += np.bincount(number, weights=weights[place, c], minlength=len(texts))
        return out, n

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [t or "" for t in texts]
        sums, n = self._means(texts, self.families, np.ones(len(texts), bool))
        logs = (sums + self.prior * np.minimum(n, 1)[:, None]) / _OVERLAP
        logs -= logs.max(axis=1, keepdims=True)
        family = logs.argmax(axis=1)
        score = 1 / np.exp(logs).sum(axis=1)
        language = np.array([self.members[f][0] for f in range(len(self.members))])[family]
        for f, (pairs, weights, slopes) in self.pairs.items():
            own = (family == f) & (n > 0)
            if not own.any():
                continue
            margins, _ = self._means(texts, weights, own)
            margins = margins[own] / n[own][:, None]
            likely = 1 / (1 + np.exp(-np.clip(margins * slopes, -30, 30)))
            votes = np.zeros((len(margins), len(self.names)))
            shares = np.zeros_like(votes)
            for c, (a, b) in enumerate(pairs):
                votes[:, a] += margins[:, c] >= 0
                votes[:, b] += margins[:, c] < 0
                shares[:, a] += likely[:, c]
                shares[:, b] += 1 - likely[:, c]
            best = (votes + shares / (len(self.names) + 1)).argmax(axis=1)  # ties by the sum of probabilities
            language[own] = best
            score[own] *= shares[np.arange(len(best)), best] / (len(self.members[f]) - 1)
        names = [self.names[i] if k else _UNKNOWN for i, k in zip(language, n.tolist())]
        return names, np.where(n > 0, score, 0.0)


def held_out(folds: int = 4, remainder: int = 2):
    """True where crc32 of the id's text leaves the remainder; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == remainder, F.lit(False))


def train(texts: DataFrame, families: dict[str, str] = FAMILIES, rows_per_language: int = ROWS_PER_LANGUAGE) -> Languages | None:
    """A model of (text, lang); None without a text that has a letter and a language."""
    texts = texts.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    common = texts.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not common:
        return None
    sizes = {r["lang"]: r["count"] for r in common}
    names = sorted(sizes)
    kinds = sorted({family_of(name, families) for name in names})
    members = [[i for i, name in enumerate(names) if family_of(name, families) == kind] for kind in kinds]
    family = {names[i]: f for f, own in enumerate(members) for i in own}
    texts = texts.filter(F.col("lang").isin(names))
    counts = family_counts(texts, family)
    logs = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * _BINS)).T
    prior = np.log([sum(sizes[names[i]] for i in own) / sum(sizes.values()) for own in members])
    model = Languages(names, members, np.ascontiguousarray(logs, np.float32), prior)
    pairs = [(f, a, b) for f, own in enumerate(members) for k, a in enumerate(own) for b in own[k + 1 :]]
    if not pairs:
        return model
    overall = counts.sum(axis=0)
    scale = 1 / np.sqrt((overall + 1.0) / (overall.sum() + _BINS))
    spark = texts.sparkSession
    related = [names[i] for own in members if len(own) > 1 for i in own]
    rows = stored(map_batches(sample(texts, related, rows_per_language).select("lang", "mark", "text"), _described, _ROWS), "described")
    of_pair = [(f, a, b, lang) for f, a, b in pairs for lang in (names[a], names[b])]
    of_pair = spark.createDataFrame(of_pair, "family int, a int, b int, lang string")

    def separate(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["lang", "mark"])  # the same rows give the same weights
        data = list(zip(group["bins"], group["counts"]))
        positive = (group["lang"] == names[group["a"].iat[0]]).to_numpy()
        weights = support_vectors(data, positive, scale)
        margins = np.array([weights[bins] @ shares for bins, shares in data])
        row = {"family": group["family"].iat[0], "a": group["a"].iat[0], "b": group["b"].iat[0], "weights": weights.astype("<f4").tobytes(), "slope": _slope(margins, positive)}
        return pd.DataFrame([row])

    fitted = rows.join(F.broadcast(of_pair), "lang").groupBy("family", "a", "b").applyInPandas(separate, "family int, a int, b int, weights binary, slope double")
    by: dict[int, list] = {}
    for row in fitted.collect():  # a row for every two related languages
        by.setdefault(row["family"], []).append(row)
    for f, own in by.items():
        own.sort(key=lambda r: (r["a"], r["b"]))
        weights = np.stack([np.frombuffer(r["weights"], "<f4") for r in own], axis=1)
        model.pairs[f] = ([(r["a"], r["b"]) for r in own], weights, np.array([r["slope"] for r in own]))
    return model


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predicted(docs: DataFrame, families: dict[str, str] = FAMILIES, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1, higher: surer).

    Learned from the rows that are not held out and have a language; doc_id, lang and source are
    never inputs of a prediction. Null, empty and letterless texts are `und` with score 0, and so is
    every text where nothing could be learned. Repeated rows give repeated rows; a null doc_id is
    never held out. Copies of a text count once in the support vector machines' sample. Other
    columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    model = train(texts.filter(~held_out()).select("text", "lang"), families, rows_per_language)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(batch: pa.RecordBatch) -> dict:
        if shared.value is None:
            return {"doc_id": batch[0], "lang_pred": [_UNKNOWN] * batch.num_rows, "score": np.zeros(batch.num_rows)}
        names, score = shared.value.predict(batch[1].to_pylist())
        return {"doc_id": batch[0], "lang_pred": names, "score": score}

    out = map_batches(texts.select("doc_id", "text"), make, _PREDICTED)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
