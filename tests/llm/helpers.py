"""Small inputs: awkward rows, and texts of invented words."""

import random

SYLLABLES = "an the or ti on er ha ly sh ble nt re in of st ou".split()


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


PASSAGE = words(60, 999)
COPY = words(80, 5)
#: Nulls, empty and blank texts, a very long one, copies, repeated rows, a shared passage, odd characters.
TEXTS = [
    (1, words(120, 1)),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, COPY),
    (6, COPY),
    (6, COPY),
    (None, COPY),
    (None, None),
    (7, words(40, 7) + " " + PASSAGE + " " + words(40, 8)),
    (8, PASSAGE + "\n" + words(30, 9)),
    (9, "é" * 150 + " ñandú Ö\x1c\x85　漢字 " + "é" * 150),
    (10, "ab " * 400),
    (11, words(6000, 11)),
    (12, "x"),
    (13, "one two"),
]
#: Columns whose names the operators use inside.
_CLASHING = "row_id mark fp root gram word place bucket guest order length score value secrets rows".split()
_KIND = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in _CLASHING)


def documents(spark, rows=TEXTS):
    extra = ("x",) * len(_CLASHING)
    data = [(i, t, None if k % 3 == 0 else "en", None if k % 4 == 0 else f"src{k % 2}", None, *extra) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, _KIND)


def by_id(df):
    """Rows of documents with an id, by id; repeated rows must agree."""
    out = {}
    for row in df.collect():
        if row["doc_id"] is not None:
            assert out.setdefault(row["doc_id"], row)[1:3] == row[1:3]
            out[row["doc_id"]] = row
    return out
