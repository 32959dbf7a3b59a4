import random
import zlib

import numpy as np
import pytest

from tallyloom.llm import language

from .helpers import TEXTS, documents

SYLLABLES = {
    "en": "th he in er an the or ing ly sh ble".split(),
    "de": "sch ein er ch ung keit be ver ich ü".split(),
    "fr": "eau ou ré le ment que eux la oi".split(),
    "es": "ción los ar el que ra osa lla ñ".split(),
}


def text(lang, n, rng):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    rows = [(i, text(lang, rng.randint(3, 60), rng), lang, "s", 0) for i, lang in enumerate(["en", "de", "fr", "es"] * 100)]
    rows += [(1000 + i, rows[0][1], "en", "s", 0) for i in range(200)]  # a third are copies
    return rows


KIND = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy(spark, rows):
    out = language.predicted(spark.createDataFrame(rows, KIND).repartition(5)).collect()
    truth = {r[0]: r[2] for r in rows}
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in out if r["held_out"]]
    assert len(right) > 50 and np.mean(right) >= 0.98


def test_held_out_rows_and_other_columns_have_no_influence(spark, rows):
    out = {r["doc_id"]: r for r in language.predicted(spark.createDataFrame(rows, KIND)).collect()}
    changed = [(i, t, "xx", "other", 7) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, lang, None, None) for i, t, lang, _, _ in rows]
    assert {r["doc_id"]: r for r in language.predicted(spark.createDataFrame(changed, KIND)).collect()} == out


def test_awkward_documents(spark):
    out = language.predicted(documents(spark)).collect()
    assert len(out) == len(TEXTS)
    letterless = {i for i, t in TEXTS if i is not None and not any(c.isalpha() for c in t or "")}
    assert {r["doc_id"] for r in out if r["lang_pred"] == "und"} - {None} == letterless
    assert {r["lang_pred"] for r in out} == {"und", "en"} and all(r["score"] == 0 for r in out if r["lang_pred"] == "und")


def test_nothing_learned(spark):
    docs = documents(spark).withColumn("lang", language.F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language.predicted(docs).collect()} == {("und", 0.0)}
    assert language.predicted(documents(spark).limit(0)).count() == 0


def test_very_long_texts(spark, rows):
    rng = random.Random(2)
    more = [(5000, text("de", 300_000, rng), "de", "s", 0), (5001, "a" * 3_000_000, None, "s", 0), (5002, "7 " * 1_000_000, None, "s", 0)]
    out = {r["doc_id"]: r for r in language.predicted(spark.createDataFrame(rows + more, KIND)).collect()}
    assert out[5000]["lang_pred"] == "de" and out[5001]["lang_pred"] in SYLLABLES and out[5002]["lang_pred"] == "und"


def test_grams_of_a_chunk_are_those_of_single_texts():
    texts = ["Ab c", "", "123", "ÉÈ x-y", "ab  c"]
    each = [[np.sort(p).tolist() for p, _ in language.grams([t])] for t in texts]
    together = [[] for _ in texts]
    for place, number in language.grams(texts):
        for i in range(len(texts)):
            together[i].append(np.sort(place[number == i]).tolist())
    assert [sum(e, []) for e in each] == [sum(t, []) for t in together]
    assert each[0] == each[4] and not any(each[2]) and not any(each[1])


def test_support_vectors_separate():
    rng = np.random.default_rng(0)
    rows, sign = [], np.arange(60) % 2 == 0
    for positive in sign:
        bins = np.sort(rng.choice(50, 10, replace=False)) + (0 if positive else 30)
        rows.append((bins.astype(np.int32), np.full(10, 0.1, np.float32)))
    weights = language.support_vectors(rows, sign, np.ones(language._BINS))
    margins = np.array([weights[b] @ x for b, x in rows])
    assert ((margins > 0) == sign).mean() > 0.95
    # the primal optimum: no small step lowers the objective
    cost = 1.0

    def objective(w):
        units = [x / np.linalg.norm(x) for _, x in rows]
        return 0.5 * w @ w + cost * sum(max(0, 1 - s * (w[b] @ x)) ** 2 for (b, _), x, s in zip(rows, units, np.where(sign, 1, -1)))

    best = objective(weights)
    assert all(objective(weights + rng.normal(scale=0.01, size=len(weights)) * (np.arange(len(weights)) < 80)) >= best for _ in range(30))


def test_families():
    assert language.family_of("pt-BR") == language.family_of("es") == "romance"
    assert language.family_of("xx") == "language xx" and language.family_of("xx", {"made": "xx yy"}) == "made"
