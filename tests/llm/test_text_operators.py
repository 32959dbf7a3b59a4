"""Operators that look at one text at a time, against plain versions of their contracts."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from tallyloom.llm import byte_bpe, fingerprint, licenses, quality, toxicity

from .helpers import TEXTS, by_id, documents, words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- byte-level BPE --------------------------------------------------------------------------
@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_is_that_of_the_library(spark, reference):
    found = byte_bpe.encode_digest(documents(spark), RANKS)
    assert found.count() == len(TEXTS)
    for doc_id, row in by_id(found).items():
        text = dict(TEXTS)[doc_id] or ""
        ids = reference.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert byte_bpe.encode_digest(documents(spark, []), RANKS).count() == 0


def test_bpe_of_odd_characters(reference):
    own = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    alphabet = list("ab c'sS  \n\t\r1290.,!?-éñ漢字😀\x1c\x85\xa0'tdmre")
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        assert own.ids(text) == reference.encode_ordinary(text)
        assert own.digest(text)[1] == hashlib.sha256(" ".join(map(str, own.ids(text))).encode()).hexdigest()
        assert own.decode(own.ids(text)) == text.encode()


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(3000)]
    found = byte_bpe.PerfectHash(keys)
    assert sorted(found.slot(k) for k in keys) == list(range(3000))
    assert found.slot(b"other") == -1


# --- licenses ----------------------------------------------------------------------------------
LICENSES = [
    (1, "Released under the MIT License."),
    (2, "x MIT license, the Apache-License; GNU General Public License mit  LICENSE"),
    (3, "Licensed under CC BY-NC 4.0."),
    (4, "under the mit of license"),
    (5, None),
    (6, "é MIT\nLicense"),
    (7, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License"),
    (8, "This program is free software: you can sell it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License"),
    (9, "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
        " any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
        " without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General"
        " Public License for more details."),
]


def test_license_phrases_and_templates(spark):
    rows = by_id(licenses.licenses(documents(spark, LICENSES)))
    for doc_id, text in LICENSES:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [
            (i, label)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(found))
            if found[i : i + len(phrase.split())] == phrase.split()
        ]
        row = rows[doc_id]
        assert (row["n_words"], row["n_base"]) == (len(found), len(places))
        assert (row["first_word"], row["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
    assert rows[1]["labels"] == "mit,mit-notice" and rows[1]["score"] == 1
    assert rows[3]["labels"] == "cc-by-nc-4.0-notice"
    assert rows[4]["labels"] == "" and rows[4]["score"] == 0
    assert (rows[7]["labels"], rows[7]["score"]) == ("gpl", 0.7)  # a beginning
    assert (rows[8]["labels"], rows[8]["score"]) == ("gpl", 0.5)  # mandatory wording differs
    assert (rows[9]["labels"], rows[9]["score"]) == ("gpl,gpl-notice", 1)
    assert licenses.licenses(documents(spark, [])).count() == 0


def test_template_regions():
    automaton = licenses.Automaton("start [[maybe [[more]]]] {{2}} end")
    accepted = {t: automaton.longest(t.encode().split(), 0)[0] for t in (
        "start end", "start maybe end", "start maybe more end", "start a b end", "start a b c end", "start more x end", "maybe end", "start",
    )}
    assert list(accepted.values()) == [2, 3, 4, 4, 0, 4, 0, 0]


def accepts(template, words):
    """The same by taking the template apart: every text that a short template stands for is listed."""

    def texts(parts):
        if not parts:
            return {()}
        head, rest = parts[0], texts(parts[1:])
        if head == "[[":
            depth, end = 1, 1
            while depth:
                depth += {"[[": 1, "]]": -1}.get(parts[end], 0)
                end += 1
            return {a + b for a in {(), *texts(parts[1 : end - 1])} for b in texts(parts[end:])}
        if head == "||":
            return rest
        if head.startswith("{{"):
            return {("*",) * n + t for n in range(int(head[2:-2]) + 1) for t in rest}
        return {(head, *t) for t in rest}

    ways = texts(licenses._MARKUP.findall(template))
    return max((len(w) for w in ways if len(w) <= len(words) and all(x in ("*", y) for x, y in zip(w, words))), default=0)


def test_automata_accept_what_the_template_lists():
    rng = random.Random(5)
    for _ in range(300):
        template, opened = [], 0
        for _ in range(rng.randint(1, 8)):
            kind = rng.random()
            if kind < 0.2:
                template.append("[[")
                opened += 1
                template.append(rng.choice("abc"))
            elif kind < 0.3 and opened:
                template.append("]]")
                opened -= 1
            elif kind < 0.4:
                template.append("{{%d}}" % rng.randint(1, 2))
            else:
                template.append(rng.choice("abc"))
        template = " ".join([*template, *["]]"] * opened])
        text = [rng.choice("abc") for _ in range(rng.randint(0, 8))]
        assert licenses.Automaton(template).longest([w.encode() for w in text], 0)[0] == accepts(template, text)


def wording(label, **fill):
    """A template as a text: optional parts left out, replaceable ones filled."""
    text = licenses.TEMPLATES[label].replace("||", "")
    while "[[" in text:
        text = re.sub(r"\[\[[^\[\]]*\]\]", "", text)
    return re.sub(r"\{\{\d+\}\}", "the acme people", text)


@pytest.mark.parametrize("label", [x for x in licenses.TEMPLATES if "||" in licenses.TEMPLATES[x]])
def test_whole_wording_is_accepted_and_altered_wording_is_not(label):
    text = wording(label)
    row = licenses.scan("Copyright (c) 2020 Acme. " + text.upper() + " The end.")
    assert label in row["labels"].split(",") and row["score"] == 1
    found = text.split()
    beginning = len(wording_of_beginning(label).split())
    for at in (at for at in (beginning, beginning + 3, len(found) - 1) if found[at] not in ("the", "acme", "people")):
        altered = licenses.scan(" ".join(found[:at] + ["never"] + found[at + 1 :]))
        assert label not in altered["labels"].split(",") and altered["score"] <= (1 if altered["labels"] else 0.7)
        cut = licenses.scan(" ".join(found[:at]) + " never by banks, and never commercially")
        assert label not in cut["labels"].split(",")
        assert cut["score"] == 0.7 or "reference" in cut["labels"]


def wording_of_beginning(label):
    saved = licenses.TEMPLATES[label]
    try:
        licenses.TEMPLATES[label] = saved.split("||")[0]
        return wording(label)
    finally:
        licenses.TEMPLATES[label] = saved


# --- quality -----------------------------------------------------------------------------------
def plain_measures(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(found[i : i + 8]) for i in range(len(found) - 7))
    covered = {j for i in range(len(found) - 7) if windows[tuple(found[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdicts(spark):
    texts = TEXTS + [(20, "a b\na b\n\nc #$\n"), (21, words(30, 2) + " " + words(30, 2))]
    found = quality.quality(documents(spark, texts))
    assert found.count() == len(texts)
    for doc_id, row in by_id(found).items():
        n, chars, symbols, lines, again = plain_measures(dict(texts)[doc_id] or "")
        assert tuple(row)[1:6] == (n, chars, symbols, lines, again)
        assert row["base_failed"] == (n < 20 or 100 * again > 30 * n)
        assert row["kept"] == (not row["base_failed"] and row["host_rate"] <= 0.5)
    assert quality.quality(documents(spark, [])).count() == 0


def test_hosts_are_shrunk_to_the_common_rate(spark):
    rows = [(f"good{h}", 40, 0) for h in range(20) for _ in range(30)] + [("bad", 1, 0)] * 60 + [("small", 1, 0)]
    rows = spark.createDataFrame(rows, "host string, n_words long, n_repeat_words long").selectExpr(
        "*", "n_words * 5 AS word_chars", "0L AS n_symbols", "0L AS n_dup_lines"
    )
    rates = {r["host"]: r for r in quality.host_verdicts(rows).collect()}
    assert rates["bad"]["rejected"] and not rates["good1"]["rejected"]
    assert rates["small"]["rate"] < 1.0 and rates["bad"]["rate"] > rates["small"]["rate"]


def test_hosts_may_be_those_of_addresses(spark):
    rows = [(i, words(40, i) if i % 2 else "short", f"https://{'bad' if i % 2 == 0 else 'good'}.example/p{i}") for i in range(60)]
    rows += [(100 + i, words(40, 100 + i), "https://bad.example/x") for i in range(5)] + [(200, words(40, 7), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, url string").withColumn("site", F.parse_url("url", F.lit("HOST")))
    found = {r["doc_id"]: r["kept"] for r in quality.quality(docs, host="site").collect()}
    assert all(found[i] == (i % 2 == 1) for i in range(60)) and not any(found[100 + i] for i in range(5)) and found[200]
    lenient = quality.host_verdicts(quality.measured(docs, "site"), bounds=(1e9, 1e9)).collect()
    assert not any(r["rejected"] for r in lenient)  # a prior as strong as that leaves every host at the common rate


# --- fingerprints ------------------------------------------------------------------------------
@pytest.mark.parametrize("partitions", [None, 1, 3, 50])
def test_fingerprints_follow_the_order_of_ids(spark, partitions):
    unique = [(i, t) for i, t in dict(TEXTS).items() if i is not None] + [(None, None)]
    found = fingerprint.compared(documents(spark, unique), partitions)
    assert found.count() == len(unique)
    rows = by_id(found)
    order = sorted((i for i, _ in unique if i is not None), reverse=True)
    texts = {i: t or "" for i, t in unique}
    for at, doc_id in enumerate(order):
        text, after = texts[doc_id], texts[order[at + 1]] if at + 1 < len(order) else texts[None]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        row = rows[doc_id]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == fingerprint.fingerprint(text.encode())
        assert row["edited_fingerprint"] == fingerprint.fingerprint(edited.encode())
        assert row["near_next"] == pytest.approx(fingerprint.likeness(row["fingerprint"], fingerprint.fingerprint(after.encode())))
        assert row["near_edited"] == pytest.approx(fingerprint.likeness(row["fingerprint"], row["edited_fingerprint"]))


def test_fingerprints_of_repeated_rows_and_of_none(spark):
    assert fingerprint.compared(documents(spark), 4).count() == len(TEXTS)
    assert fingerprint.compared(documents(spark, []), 2).count() == 0
    (row,) = fingerprint.compared(documents(spark, [(1, "abc def")]), 2).collect()
    assert row["near_next"] == 1


def test_rows_of_one_id_and_without_id_follow_each_other_too(spark):
    rows = [(7, words(20, i)) for i in range(100)] + [(None, words(20, 200 + i)) for i in range(100)] + [(i, "same") for i in (1, 2)] + [(9, "same")] * 100
    out = fingerprint.compared(documents(spark, rows), 8).collect()
    assert len(out) == len(rows) and sum(r["doc_id"] == 7 for r in out) == sum(r["doc_id"] is None for r in out) == 100
    assert sum(r["doc_id"] == 9 and r["near_next"] == 1 for r in out) == 99  # copies follow copies
    assert len({r["fingerprint"] for r in out}) == 201


def plain_fingerprint(data):
    """The signature byte by byte."""
    step, mask = int(fingerprint._STEP), (1 << 64) - 1
    value = [int(v) for v in fingerprint._VALUES]

    def mixed(chunk):
        return sum(value[b] * pow(step, i, 1 << 64) for i, b in enumerate(chunk)) & mask

    ends_at = []
    for end in range(7, len(data) + 1):
        x = mixed(data[end - 7 : end])
        ends_at.append(((x ^ x >> 33) * step & mask) >> 16)

    def ends(size):
        return [7 + i for i, x in enumerate(ends_at) if x % size == size - 1]

    def signature(size):
        cuts = ends(size)
        cuts = cuts[:63] if len(cuts) >= 64 else cuts
        cuts = cuts if cuts and cuts[-1] == len(data) else [*cuts, len(data)]
        out = ""
        for start, end in zip([0, *cuts], cuts):
            x = mixed(data[start:end])
            out += chr(fingerprint._LETTERS[((x ^ x >> 32) * step & mask) >> 58])
        return out

    size = 3
    while size * 64 < len(data):
        size *= 2
    while size > 3 and len(ends(size)) + 1 < 32:
        size //= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}" if data else "3::"


@pytest.mark.parametrize("n", [0, 1, 6, 7, 8, 100, 191, 192, 193, 1500, 5000])
def test_signatures_are_those_of_the_plain_form(n):
    data = words(2000, n).encode()[:n]
    assert fingerprint.fingerprint(data) == plain_fingerprint(data)


def test_likeness():
    text = words(400, 3)
    one = fingerprint.fingerprint(text.encode())
    changed = fingerprint.fingerprint((text[:1500] + "zzz" + text[1500:]).encode())
    assert fingerprint.likeness(one, one) == 1 and fingerprint.likeness(one, changed) > 0.8
    assert fingerprint.likeness(one, fingerprint.fingerprint(words(400, 4).encode())) < 0.3
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(0, 20))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert fingerprint._common(a, b) == table[-1][-1]


# --- toxicity ----------------------------------------------------------------------------------
INSULTS = "idiot moron stupid loser".split()


def toxic_rows(n=400):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = words(60, 1000 + i)
        if toxic:
            rng = random.Random(i)
            text = " ".join(text.split()[:30] + rng.sample(INSULTS, 3) + text.split()[30:])
        rows.append((i, text))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_is_learned_and_disguises_are_undone(spark):
    rows, labels = toxic_rows()
    hidden = ["you 1d10t m0r0n", "a s t u p i d loooser", "an 1d!ot and a l0s3r", "s.t.u.p.i.d m.o.r.o.n", "the 1st of 2024 $5 an&&&"]
    rows += [(1000 + i, words(20, i) + " " + h + " " + words(20, i + 50)) for i, h in enumerate(hidden)]
    labels = spark.createDataFrame(labels + [(1, None), (None, 1)], "doc_id long, toxic int")
    found = by_id(toxicity.toxicity(documents(spark, rows), labels))
    truth = {i: i % 4 == 0 for i in range(400)}
    held = [i for i in truth if found[i]["held_out"]]
    assert 40 < len(held) < 130 and all(bool(found[i]["predicted"]) == truth[i] for i in held)
    assert [found[1000 + i]["predicted"] for i in range(5)] == [1, 1, 1, 1, 0]
    assert toxicity.without_toxic(documents(spark, rows), labels).count() == len(rows) - 104


def plain_decode(token, model, apart):
    """Every path through the lattice."""
    best = []

    def walk(at, state, cost, word, seen):
        if at == len(token):
            best.append((cost + model.cost(state, "$"), word))
            return
        char = token[at]
        mark = char in toxicity._APART or char.isspace()
        letters = [(char, 0.0)] if char.isalpha() else []
        letters += [(x, toxicity._CHANGE) for x in toxicity.LEET.get(char, "")]
        then = seen if apart and mark else char
        for letter, change in letters:
            walk(at + 1, state[1] + letter, cost + change + model.cost(state, letter), word + letter, then)
            if seen == char and word.endswith(letter):
                walk(at + 1, state, cost + toxicity._REPEAT, word, then)
        if not letters or mark:
            walk(at + 1, state, cost + toxicity._DROP, word, then)
        if apart and mark and state != "^^":
            walk(at + 1, "^^", cost + toxicity._BREAK + model.cost(state, "$"), word + " ", then)

    walk(0, "^^", 0.0, "", "")
    return min(best)


def test_decoding_finds_the_cheapest_path():
    counts = Counter()
    for word in words(400, 3).split() + ["stupid"] * 20:
        line = f"^^{word}$"
        counts.update(line[i : i + 3] for i in range(len(line) - 2))
    model = toxicity.CharacterModel(counts)
    rng = random.Random(2)
    for _ in range(250):
        token = "".join(rng.choices("stupid1!$|. -é5", k=rng.randint(1, 7)))
        apart = rng.random() < 0.5
        found = toxicity.decode(token, model, apart)
        cost, word = plain_decode(token, model, apart)
        assert found == word, (token, apart, cost)


SPACED = [
    "s t u p ! d", "$ t u p i d", "i d ! o t", "s  t  u  p  i  d", "m\to\tr\to\tn", "m, o, r, o, n", "m|o|r|o|n", "l / o / s / e / r", "you s t u p i d x", "l o s e r s",
]


def test_letters_kept_apart_are_read_together(spark):
    rows, labels = toxic_rows()
    rows += [(2000 + i, words(20, i) + " " + h + " " + words(20, i + 50)) for i, h in enumerate(SPACED)]
    clean = ["a b c d e", "1 2 3 4 5 6", "x - y - z", "I I I", "1. 2. 3. a. b. c."]
    rows += [(3000 + i, words(20, i) + " " + h + " " + words(20, i + 50)) for i, h in enumerate(clean)]
    found = by_id(toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")))
    assert [h for i, h in enumerate(SPACED) if not found[2000 + i]["predicted"]] == []
    assert [h for i, h in enumerate(clean) if found[3000 + i]["predicted"]] == []


def test_a_labelled_id_on_many_rows_does_not_fill_the_sample(spark):
    rows, labels = toxic_rows(200)
    rows += [(1, words(30, 9000 + i)) for i in range(500)] + [(4, rows[4][1])] * 500
    sample, share = toxicity.labelled(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"), 60)
    sizes = Counter(r["toxic"] for r in sample.collect())
    assert 15 <= sizes[True] <= 45 and 10 <= sizes[False] <= 50 and share[False] > 10 and 1 < share[True] < 2


def test_every_labelled_text_is_counted_once(spark):
    """30,000 texts, more than a sample held; the 20,000 clean ones stand on three rows each, and a toxic one on a hundred."""
    n = F.col("id").cast("string")
    texts = F.when(F.col("id") % 3 == 0, F.concat(F.lit("idiot w"), F.translate(n, "0123456789", "abcdefghij"))).otherwise(F.concat(F.lit("kind person "), n))
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), texts.alias("text"))
    labels = rows.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    copies = rows.filter("doc_id % 3 <> 0").crossJoin(spark.range(2)).drop("id").unionByName(rows.filter("doc_id = 3").crossJoin(spark.range(99)).drop("id"))
    docs = rows.unionByName(copies)
    marks = toxicity.marked(docs, labels)
    letters = str.maketrans("0123456789", "abcdefghij")
    learned = [i for i in range(30_000) if zlib.crc32(str(i).encode()) % 5]
    n_toxic = sum(i % 3 == 0 for i in learned)
    assert {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()} == {True: n_toxic, False: len(learned) - n_toxic}
    scorer = toxicity.learned(docs, marks)
    sketches = {min(xxhash.xxh3_64_intdigest(w) >> 1 for w in ("idiot", "w" + str(i).translate(letters))) for i in learned if i % 3 == 0}
    n_clean = len(learned) - n_toxic
    assert scorer.prior == pytest.approx(math.log((len(sketches) + 0.5) / (n_clean + len(sketches) + 5.0)))
    toxicity.fit(scorer, toxicity.found_in(docs, scorer), marks)
    assert scorer.score("an idiot") > 0.9 and scorer.score("a kind person") < 0.5 and "kind" not in scorer.lexicon


def test_toxicity_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0), (5, 1)], "doc_id long, toxic int")
    found = toxicity.toxicity(documents(spark), labels)
    assert found.count() == len(TEXTS) and all(0 <= r["score"] <= 1 for r in found.collect())
    none = labels.limit(0)
    assert {r["predicted"] for r in toxicity.toxicity(documents(spark), none).collect()} == {0}
    assert toxicity.toxicity(documents(spark, []), none).count() == 0


def test_only_texts_of_the_marks_move_to_them(spark):
    docs = documents(spark, [(i, f"text {i % 400}") for i in range(1200)])
    texts = toxicity.texts_of(docs)
    marks = texts.filter("doc_id < 20").select("mark").distinct()
    found = toxicity.of_marks(texts, marks)
    assert sorted(r["doc_id"] for r in found.collect()) == sorted(i for i in range(1200) if i % 400 < 20)
    assert texts.filter(toxicity.among(marks)("mark")).count() < 80  # the others stay where they are
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan  # the same at every size
    assert toxicity.of_marks(texts, marks.limit(0)).count() == 0


def test_shortcuts_find_what_every_token_holds():
    scorer = toxicity.Scorer({"vile": 1.0, "vile*": 1.0, "bad": 1.0, "nasti*": 1.0}, -3.0, {"^^v": 1.0, "^vi": 1.0, "vil": 1.0, "ile": 1.0, "le$": 1.0}, {})
    for text in ("(vile)", "«vile»", "'bad!?", "viiile", "VILEness,", "v1le", "nastier_", "bad__", "plain words", "viiile. bad vileness"):
        expected = {f for token in text.lower().split() for f in scorer._token(token)}
        assert scorer.found(text) == expected and bool(expected) == (text != "plain words")
    assert toxicity._words("«Ab» (cd), E.F 12 gh_ 'ij'") == {"ab", "cd", "gh", "ij"}
