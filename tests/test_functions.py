"""Golden values and properties of the column expressions."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import classify, dates, labels, numbers, similarity, text
from tallyloom.functions.similarity import Block, Shelf, best_of


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", function(F.col("v"))).orderBy("i").collect()]


def test_ids(spark):
    assert apply(spark, text.strip_dp_prefix, ["DP-12", "12", "DP-A-7", " DP-9 ", None]) == ["12", "12", "7", "9", None]
    # The suffix is looked for before blanks are removed, so a padded one stays.
    assert apply(spark, text.normalize_id, ["12.0", " 12 ", "12.0 ", "1.00", None]) == ["12", "12", "12.0", "1.00", None]


def test_names(spark):
    raw = ["RAO  ASHA.", "Zed-Alias", "12345", None, "  o'Neil \t b", "Mendes, Carla"]
    assert apply(spark, text.clean_name, raw) == ["RAO ASHA", "ZED ALIAS", "", "", "O NEIL B", "MENDES CARLA"]
    assert apply(spark, text.email_local_part, ["asha.rao1@example.com"]) == ["ASHA RAO"]


def test_status_filling(spark):
    assert apply(spark, text.fill_status, [None, "", "NaN", "nan", "Already Active"]) == ["Inactive"] * 4 + ["Already Active"]


def test_numbers(spark):
    assert apply(spark, numbers.coerce_number, ["1,000", " 7 ", "x", "2.5", None]) == [
        None, Decimal("7.00"), None, Decimal("2.50"), None,
    ]
    assert apply(spark, numbers.coerce_number_or_zero, ["x"]) == [Decimal("0.00")]


def test_mixed_dates(spark):
    raw = ["03/04/2025 10:00", "25/12/2024", "1/2/2025", "13/45/2024", "3/4/25", "2025-01-02", "x", "", None, "05/01/2024"]
    day = dt.date
    expected = [day(2025, 3, 4), day(2024, 12, 25), day(2025, 1, 2)] + [None] * 6 + [day(2024, 5, 1)]
    assert apply(spark, dates.parse_mixed_date, raw) == expected


def test_calendar(spark):
    def on(function):
        return apply(spark, lambda v: function(v.cast("date")), ["2024-02-29", "2024-12-01", None])

    day = dt.date
    assert on(dates.month_start) == [day(2024, 2, 1), day(2024, 12, 1), None]
    assert on(dates.month_end) == [day(2024, 2, 29), day(2024, 12, 31), None]
    assert on(dates.prev_month_end) == [day(2024, 1, 31), day(2024, 11, 30), None]
    assert on(dates.week_start) == [day(2024, 2, 26), day(2024, 11, 25), None]
    assert on(dates.month_name) == ["February", "December", None]


def test_rates(spark):
    df = spark.createDataFrame([(3, 4), (3, 0), (3, -2), (3, None)], "n int, d int")
    assert [r[0] for r in df.select(numbers.safe_rate(F.col("n"), F.col("d"))).collect()] == [0.75, 0.0, 0.0, 0.0]
    assert [r[0] for r in df.select(numbers.safe_rate_one(F.col("n"), F.col("d"))).collect()] == [0.75, 3.0, -1.5, None]


def test_status_and_category(spark):
    first = spark.createDataFrame([("2023-01-01",), ("2024-09-09",), ("2025-02-01",), (None,)], "d string")
    status = classify.classify_status(
        F.col("d").cast("date"), dates.as_date("2024-08-01"), dates.as_date("2025-02-01")
    )
    assert [r[0] for r in first.select(status).collect()] == ["Already Active", "Activated by LGLC", "Inactive", "Inactive"]
    rows = [("Favourite", "2024-01-09"), ("Favourite", "2023-12-09"), ("Favourite", None), ("Regular", None), (None, None)]
    df = spark.createDataFrame(rows, "c string, d string")
    category = classify.classify_category(F.col("c"), F.col("d").cast("date"), dates.as_date("2024-01-01"))
    assert [r[0] for r in df.select(category).collect()] == ["Inactive", "Favourite", "Favourite", "Inactive", "Inactive"]


def test_run_mode():
    assert classify.run_mode("Sale", "15-Jun-1998", "May") == "MANUAL"
    assert classify.run_mode("Sale", None, "May") == "CATCH-UP"
    assert classify.run_mode(None, None, None) == "REGULAR"


def test_subject_words(spark):
    assert apply(spark, text.tokenize_subject, ["June's  Sale ", "", None]) == [["junes", "sale"], [], None]


# --- similarity ------------------------------------------------------------------------------
def brute_score(a: str, b: str) -> int:
    """The same score from the textbook dynamic program."""
    bonus = labels.FIRST_LETTER_BONUS if a and b and a[0] == b[0] else 0
    x, y = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    if not x or not y:
        return bonus
    row = [0] * (len(y) + 1)
    for c in x:
        row, old = [0], row
        for j, d in enumerate(y, 1):
            row.append(old[j - 1] + 1 if c == d else max(old[j], row[-1]))
    return round(200 * row[-1] / (len(x) + len(y))) + bonus


words = st.lists(st.text("ABCZ", min_size=1, max_size=9), max_size=14).map(" ".join)


def brute_best(names, entries):
    scores = [[brute_score(a, b) for b in entries] for a in names]
    return [max(row) for row in scores], [row.index(max(row)) for row in scores]


@settings(max_examples=120, deadline=None)
@given(st.lists(words, min_size=1, max_size=6), st.lists(words, min_size=1, max_size=6))
def test_best_entries_match_the_textbook(names, entries):
    score, entry, scored = best_of(names, entries)
    assert (score.tolist(), entry.tolist()) == brute_best(names, entries)
    assert scored <= len(names) * len(entries)


@pytest.mark.parametrize("size", [61, 62, 63, 64, 65, 130])
def test_scores_of_long_entries(size):
    entry = ("AB" * size)[:size]
    names = [entry, entry[::-1], "A", "", "AB BA" * 20]
    for entries in ([entry, "B"], ["B", entry], [entry]):
        score, best, _ = best_of(names, entries)
        assert (score.tolist(), best.tolist()) == brute_best(names, entries)


def test_only_pairs_that_can_be_best_are_scored():
    rng = random.Random(1)
    entries = ["".join(rng.choices("ABCDEFGHIJKLMNOPRSTUVWY", k=rng.randint(4, 8))) + " " + "".join(rng.choices("AEIORSTLN", k=6)) for _ in range(200)]
    names = [e.replace("A", "E", 1) for e in entries]
    score, best, scored = best_of(names, entries)
    assert (score.tolist(), best.tolist()) == brute_best(names, entries)
    assert scored < 0.15 * len(names) * len(entries)


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_first_gives_the_same_best(seed):
    rng = random.Random(seed)
    text = lambda most: " ".join("".join(rng.choices("ABCDE", k=rng.randint(1, 6))) for _ in range(rng.randint(0, most)))
    entries = [text(3) for _ in range(170)] + ["AB" * 40, "", "E" * 70, "ABCDE " * 13]
    rng.shuffle(entries)
    names = [text(4) for _ in range(40)] + ["", "AB" * 45, "E" * 300, entries[5]]
    score, best, scored = best_of(names, entries)
    assert (score.tolist(), best.tolist()) == brute_best(names, entries)
    assert scored <= len(names) * len(entries)


def test_a_larger_roster_needs_fewer_pairs_a_name_than_its_packs():
    rng = random.Random(2)
    texts = ["".join(rng.choices("AEINORSTLM", k=10)) + " " + rng.choice(["ASHA", "BINOD", "CARLA"]) for _ in range(2300)]
    names, entries = texts[:60], texts[60:]
    whole = best_of(names, entries)[2]
    packs = sum(best_of(names, entries[at : at + 64])[2] for at in range(0, len(entries), 64))
    assert whole < 0.2 * len(names) * len(entries) and whole < packs


def made_up(rng, n):
    """Texts of many letters and one of three words, of which no two are near copies."""
    return ["".join(rng.choices("AEINORSTLM", k=rng.randint(9, 11))) + " " + rng.choice(["ASHA", "BINOD", "CARLA"]) for _ in range(n)]


def test_few_pairs_are_scored_to_the_end_where_no_name_has_a_near_copy():
    rng = random.Random(3)
    names, entries = made_up(rng, 400), made_up(rng, 1500)
    score, best, scored = best_of(names, entries)
    assert scored < 0.04 * len(names) * len(entries)
    assert ([*score[:25]], [*best[:25]]) == brute_best(names[:25], entries)


@pytest.mark.parametrize("seed", range(4))
def test_the_best_is_carried_from_shelf_to_shelf(seed):
    rng = random.Random(seed)
    text = lambda most: " ".join("".join(rng.choices("ABCD", k=rng.randint(1, 7))) for _ in range(rng.randint(0, most)))
    entries = [text(3) for _ in range(150)] + ["AB" * 40, "", "E" * 70, "ABC " * 12, "ABCD" * 8, "ABCD" * 16]
    rng.shuffle(entries)
    names = [text(4) for _ in range(40)] + ["", "AB" * 45, "E" * 300, *entries[:9]]
    expected = brute_best(names, entries)
    for size in (1, 7, 70):
        block = Block(names)
        for first in range(0, len(entries), size):
            block.meet(Shelf(entries[first : first + size], first))
        assert (block.scores().tolist(), block.entries().tolist()) == expected


def test_beginnings_and_pairs_put_aside_give_the_same_best(monkeypatch):
    rng = random.Random(5)
    names, entries = made_up(rng, 120), made_up(rng, 300)
    expected = brute_best(names[:40], entries)
    for few, pairs, lanes in ((0, 1, 1000), (0, 1, 16), (300, 1000, 32), (1 << 20, 1 << 20, 64)):
        monkeypatch.setattr(similarity, "_FEW", few)
        monkeypatch.setattr(similarity, "_PAIRS", pairs)
        monkeypatch.setattr(similarity, "_FIRST_LANES", lanes)
        score, best, _ = best_of(names, entries)
        assert ([*score[:40]], [*best[:40]]) == expected
