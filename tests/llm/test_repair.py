import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyloom.llm import repair

KIND = "conv_id long, turn long, role string, text string"
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAME = {"u": "user", "a": "assistant"}


def after_damage(rows):
    by, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(by[c], key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}".encode(), r[1])) for c in ids}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not visible else "d" if (role, text) in seen else "t" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def slow(rows):
    """The contract, row by row, with a shortest path over the places of the pattern instead of spans."""
    out = {}
    for conv, own in after_damage(rows).items():
        def insert(paths):
            for _ in range(5):
                for p, (cost, audit, lines) in list(paths.items()):
                    for c in "ua":
                        if (p, c) in STEP:
                            offer(paths, STEP[p, c], (cost + 5, audit + "I", [*lines, NAME[c] + ":"]))
            return paths

        def offer(paths, place, path):
            if place not in paths or path[:2] < paths[place][:2]:
                paths[place] = path

        wrong = faults(own)
        paths = insert({0: (0, "", [])})
        for (_, role, text), fault in zip(own, wrong):
            new = {}
            for p, (cost, audit, lines) in paths.items():
                offer(new, p, (cost + 2, audit + "D", lines))
                if fault in ("b", "d"):
                    continue
                more = 5 * (fault == "t")
                if (p, role[:1]) in STEP:
                    offer(new, STEP[p, role[:1]], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
                for c in "ua":
                    if (p, c) in STEP:
                        offer(new, STEP[p, c], (cost + 1 + more, audit + "R", [*lines, f"{NAME[c]}:{text}"]))
            paths = insert(new)
        cost, audit, lines = min((paths[q] for q in (0, 3) if q in paths), key=lambda x: x[:2])
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, wrong.count("b"), wrong.count("d"), wrong.count("t"), illegal, cost, audit, digest)
    return out


def made_rows():
    rng = random.Random(3)
    texts = [None, "", " ", "\n", "Hi.", "Hi", "Ok!", "What?", "é漢.", "x.\n", "no stop ", "a:b", "w " * 50_000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "s", "umpire"]
    rows = [(c, rng.choice([None, *range(10)]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(50)] for _ in range(rng.randint(1, 12))]
    rows += [(999, None, "user", "same.")] * 700  # copies in one turn
    rows += [(999, i, rng.choice(["user", "assistant"]), f"line {i}" + rng.choice([".", ""])) for i in range(1200)]
    rows += [(1000, i, "user", "again.") for i in range(400)]  # one text in many turns
    return rows


def test_repairs_equal_the_slow_form(spark):
    rows = made_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND + ", place string, n int").repartition(7)
    got = {r[0]: tuple(r)[1:] for r in repair.repairs(df).collect()}
    assert got == slow(rows)


def test_repaired_rows_follow_the_pattern(spark):
    rows = repair.repaired(spark.createDataFrame(made_rows(), KIND)).orderBy("conv_id", "place", "number").collect()
    by = defaultdict(str)
    for row in rows:
        by[row["conv_id"]] += row["role"][:1]
    assert by and all(re.fullmatch("s?(ua)+", roles) for roles in by.values())


def test_a_long_conversation_is_joined_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(repair, "_FAN", 2)
    rng = random.Random(5)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"row {i}.") for i in range(3000)]
    got = {r[0]: tuple(r)[1:] for r in repair.repairs(spark.createDataFrame(rows, KIND)).collect()}
    assert got == slow(rows)


def test_nothing_in_nothing_out(spark):
    assert repair.repairs(spark.createDataFrame([], KIND)).count() == 0
    dropped = next(t for t in itertools.count() if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    row = repair.repairs(spark.createDataFrame([(7, dropped, "user", "Hi.")], KIND)).first()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


rows_of_edits = st.lists(st.tuples(st.sampled_from("suax "), st.sampled_from(["", "go", "cut"])), max_size=3)


@settings(max_examples=40, deadline=None)
@given(rows_of_edits)
def test_cells_find_the_cheapest_repair(rows):
    """Against every choice of edits, with up to two insertions between rows."""
    got = repair.best(repair.span_cells([repair.row_cells(i.strip(), k == "go", k == "cut") for i, k in rows]))
    found = []
    choices = [[("D", "", 2)] if k == "go" else [("D", "", 2), ("K", i, 5 * (k == "cut")), *[("R", c, 1 + 5 * (k == "cut")) for c in "ua"]] for i, k in rows]
    for picked in itertools.product(*choices):
        kept = [p for p in picked if p[1]]
        for where in itertools.product(["", "u", "a", "ua"], repeat=len(kept) + 1):
            roles = where[0] + "".join(p[1] + w for p, w in zip(kept, where[1:]))
            if re.fullmatch("(s?(ua)+)?", roles) and sum(map(len, where)) <= 4:
                cost = sum(p[2] for p in picked) + 5 * sum(map(len, where))
                if cost > got[0]:
                    continue
                gaps = iter(where)
                audits = [""]  # insertions may stand before or after deletions
                pending = len(next(gaps))
                run = 0
                for edit, role, _ in picked:
                    if not role:
                        run += 1
                        continue
                    audits = [a + m + edit for a in audits for m in {"".join(x) for x in itertools.permutations("D" * run + "I" * pending)}]
                    run, pending = 0, len(next(gaps))
                audits = [a + m for a in audits for m in {"".join(x) for x in itertools.permutations("D" * run + "I" * pending)}]
                found.append((cost, min(audits)))
    assert got == min(found)


@pytest.mark.parametrize("n", range(1, 9))
def test_every_split_of_a_span_gives_the_same_cells(n):
    rng = random.Random(n)
    rows = [repair.row_cells(rng.choice("sua "), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
    whole = repair.span_cells(rows)
    for cut in range(1, n):
        assert repair.joined(repair.span_cells(rows[:cut]), repair.span_cells(rows[cut:])) == whole
