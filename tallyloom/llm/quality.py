"""Quality rules of single texts, and verdicts on the hosts that texts come from.

Each text is measured once. The failures of the rules are counted by host; the hosts' failure
rates are shrunk by a beta prior whose two parameters are estimated from all hosts (moments of the
rates, weighted by documents), so that a host with few documents tends to the common rate. The
verdict on a host is joined back to its documents. Counts are pre-aggregated before the shuffle and
the verdicts are one row per host, so a host with a third of all documents is no hot spot: where
its rows are joined by a shuffle, Spark splits them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

_symbols = re.compile(r"[#*$%&|<>]").findall
_blanks = re.compile(r"[\x20\x09-\x0D]").findall
_MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list, width: int = 8) -> int:
    """Words in windows of `width` words that occur twice or more, the first included."""
    windows = len(words) - width + 1
    if windows < 2:
        return 0
    known: dict = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words)) + np.uint64(1)
    mixed = np.zeros(windows, np.uint64)
    for i in range(width):
        mixed = (mixed ^ numbers[i : i + windows]) * _STEP
        mixed ^= mixed >> np.uint64(29)
    _, which, counts = np.unique(mixed, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[which] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.encode().split()  # at ASCII white space, as the rule says
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(words), len(text) - len(_blanks(text)), len(_symbols(text)), len(lines) - len(set(lines)), repeated_words(words)


def measured(docs: DataFrame, host: str) -> DataFrame:
    """doc_id, host and the measures of every text; a null text has no words, a null host is one of its own."""
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *((m, pa.int64()) for m in _MEASURES)])

    def make(batch: pa.RecordBatch) -> dict:
        rows = [measure(t or "") for t in batch[2].to_pylist()]
        return {"doc_id": batch[0], "host": batch[1], **{m: [r[i] for r in rows] for i, m in enumerate(_MEASURES)}}

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string"), F.col("text").cast("string")), make, schema)


def failed():
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rule_failures() -> dict:
    """The rules whose failures count for a host; the first two are the base rules of a document."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "few_words": F.col("n_words") < 20,
        "repeated_words": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": F.col("n_symbols") / words > 0.5,
        "repeated_lines": F.col("n_dup_lines") > 0.3 * words,
        "word_length": ~(F.col("word_chars") / words).between(2, 15),
    }


#: Least and greatest strength of the prior, in documents: hosts that differ as chance would have them give no end of it.
STRENGTH = (1.0, 10_000.0)


def host_verdicts(rows: DataFrame, limit: float = 0.5, bounds: tuple[float, float] = STRENGTH) -> DataFrame:
    """(host, n_docs, n_failed, rate, rejected): shrunk failure rates, rejected above `limit`.

    The prior is Beta(m s, (1 - m) s): m the rate of all documents, s the strength at which the
    spread of the hosts' rates is what the binomial spread leaves, within `bounds`.
    """
    any_rule = F.greatest(*[f.cast("int") for f in rule_failures().values()])
    hosts = rows.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(any_rule).alias("n_failed"))
    rate = F.col("n_failed") / F.col("n_docs")
    total = hosts.agg(
        F.sum("n_docs").alias("n"),
        F.sum("n_failed").alias("f"),
        F.count("*").alias("hosts"),
        F.sum(F.col("n_docs") * rate * rate).alias("squares"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("sizes"),
    ).first()
    mean, strength = 0.0, 1.0
    if total["n"]:
        mean = total["f"] / total["n"]
        inside = mean * (1 - mean)
        spread = total["squares"] / total["n"] - mean * mean
        freedom = total["n"] - total["sizes"] / total["n"]
        between = (total["n"] * spread - (total["hosts"] - 1) * inside) / freedom if freedom > 0 else 0.0
        strength = min(max(inside / between - 1, bounds[0]), bounds[1]) if between > 0 else bounds[1]
    shrunk = (F.col("n_failed") + mean * strength) / (F.col("n_docs") + strength)
    return hosts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") > limit)


def quality(docs: DataFrame, host: str = "source", limit: float = 0.5) -> DataFrame:
    """One row per document: doc_id, the five measures, base_failed, kept, host_rate.

    kept is false if a base rule fails, else the verdict on the document's host. Null texts have no
    words and fail; documents without a host form one. Repeated rows count and stay; a null doc_id
    stays null. Other columns are not read.
    """
    rows = stored(measured(docs, host), "measures")
    verdicts = host_verdicts(rows, limit).select(F.col("host").alias("verdict_host"), "rate", "rejected")
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("verdict_host")), "left")
    kept = ~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))
    return joined.withColumn("base_failed", failed()).select("doc_id", *_MEASURES, "base_failed", kept.alias("kept"), F.col("rate").alias("host_rate"))
