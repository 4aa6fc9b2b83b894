"""Conversation repair next to a search over all edits."""

import hashlib
import itertools
import random
import zlib
from functools import cache

import pytest

from reviewlab.llm import queries, turns

SPACE = " \t\n\x0b\x0c\r"


def search(rows):
    """(cost, audit, repaired) of rows (role, text) by plain recursion over all edits."""
    faults, seen = [], set()
    for row in rows:
        end = row[1].rstrip(SPACE)
        fault = "b" if not end else "d" if row in seen else "t" if end[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add(row)

    @cache
    def best(place, shape, inserted):
        """shape: 0 nothing, 1 s, 2 ends in u, 3 ends in a."""
        found = []
        role = "assistant" if shape == 2 else "user"
        following = 3 if shape == 2 else 2
        if inserted < 3:
            cost, audit, lines = best(place, following, inserted + 1)
            found.append((cost + 3, "I" + audit, (f"{role}:",) + lines))
        if place == len(rows):
            if shape in (0, 3):
                found.append((0, "", ()))
        else:
            cost, audit, lines = best(place + 1, shape, 0)
            found.append((cost + 4, "D" + audit, lines))
            name, text = rows[place]
            if faults[place] not in ("b", "d"):
                extra = 3 if faults[place] == "t" else 0
                cost, audit, lines = best(place + 1, following, 0)
                found.append((cost + 3 + extra, "R" + audit, (f"{role}:{text}",) + lines))
                kept = f"{name}:{text}"
                if name[:1] == role[0]:
                    found.append((cost + extra, "K" + audit, (kept,) + lines))
                if name[:1] == "s" and shape == 0:
                    cost, audit, lines = best(place + 1, 1, 0)
                    found.append((cost + extra, "K" + audit, (kept,) + lines))
        return min(found, key=lambda f: f[:2]) if found else (1 << 40, "", ())

    cost, audit, lines = best(0, 0, 0)
    return faults, cost, audit, "\n".join(lines)


def expected(conversation):
    """Of rows (turn, role, text) in order."""
    faults, cost, audit, text = search([(r, t) for _, r, t in conversation])
    known = [n for n, _, _ in conversation if n is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(conversation)]
    return (
        max(known) - min(known) + 1 - len(set(known)) if known else 0,
        faults.count("b"),
        faults.count("d"),
        faults.count("t"),
        sum(pair not in ("su", "ua", "au") for pair in pairs),
        cost,
        audit,
        hashlib.sha256(text.encode()).hexdigest(),
    )


def damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        kept = out.setdefault(conv_id, [])
        show = [" " if v is None else v for v in (conv_id, turn, role, text)]
        kind = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        _, _, role, text = show
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate(str.maketrans("", "", ".!?"))
        row = (turn, "user" if kind == 4 else role, text)
        kept += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda row: (row[0] is not None, row[0]))
    return out


def result(frame):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    return {
        row["conv_id"]: (*[row[n] for n in names], row["repaired_sha256"])
        for row in frame.collect()
    }


def test_query_agrees_with_the_search(spark, small):
    rows = queries.table(spark, small, "conversations")
    given = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in rows.collect()]
    want = {conv: expected(kept) for conv, kept in damage(given).items()}
    found = queries.op12_turn_repair(spark, small)
    assert found.count() == len(want)
    assert result(found) == want


TEXTS = ["Yes.", "No!", "cut off", "", " \n", "Why?", "and. then ", "é."]
ROLES = ["user", "assistant", "system", "tool", "", "Sage"]


def random_rows(conversations, seed, weights=(8, 8, 2, 1, 1, 1), most=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        turn = 0
        for _ in range(rng.randrange(most)):
            turn += rng.choice((1, 1, 1, 2, 5))
            rows.append((conv, turn, rng.choices(ROLES, weights)[0], rng.choice(TEXTS)))
    return rows


@pytest.mark.parametrize("size", [3, turns.BLOCK_ROWS])
def test_random_rows(spark, monkeypatch, size):
    """Also with blocks of three rows, so that conversations are many blocks."""
    monkeypatch.setattr(turns, "BLOCK_ROWS", size)
    rows = random_rows(120, size)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    want = {conv: expected(kept) for conv, kept in groups.items()}
    assert result(turns.summaries(frame.repartition(5))) == want


def test_odd_rows(spark):
    """Nulls, equal rows, equal turns, dropped conversations, other columns, long runs."""
    rows = [
        (None, None, None, None, "x"),
        (None, 3, "user", "Hi.", "x"),
        (1, None, "user", "Null turn.", "x"),
        (1, 1, "assistant", "One.", "x"),
        (2, None, None, "Only null turns.", "x"),
        (3, 1, "user", "Same.", "x"),
        (3, 1, "user", "Same.", "x"),
        (4, 1, "system", "Alone.", "x"),
        (6, 2**40, "user", "Far.", "x"),
        (6, 0, "assistant", "Near.", "x"),
        *[(7, n, "user", f"Again {n}.", "x") for n in range(3000)],
        *[(8, n, "user", "More!" if n % 7 else "!", "x") for n in range(1000)],
    ]
    names = "conv_id long, turn long, role string, text string, key string"
    frame = spark.createDataFrame(rows, names)
    wanted = damage([row[:4] for row in rows])
    found = result(turns.summaries(turns.damaged(frame)))
    assert found.keys() == wanted.keys()
    for conv in (None, 1, 2, 3, 4, 6):
        assert found[conv] == expected(wanted[conv]), conv
    # One way to cost out a long run: an assistant row between any two, and one at the end.
    long = [row for row in wanted[7]]
    assert len(found[7][6].replace("I", "")) == len(long)
    dropped = spark.createDataFrame([(5, 1, False, "user", "x")], "conv_id long, turn long, present boolean, role string, text string")
    assert result(turns.summaries(dropped)) == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert turns.summaries(turns.damaged(frame.limit(0))).count() == 0


def test_powers_equal_steps():
    for text in ("uuuuuuu", "sxxxUUA--", "-" * 100, "", "suau" * 20):
        stepwise = turns.unit()
        for sign in text:
            stepwise = turns.product(stepwise, turns.power(sign, 0))
        assert turns.transition(text) == stepwise


def test_unrolled_costs_what_the_transition_says():
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices("suaxUA-", (1, 6, 6, 1, 1, 1, 1), k=rng.randrange(40)))
        edits, _ = turns.unrolled(text, turns.at_end(), turns.EMPTY, True)
        cost = 0
        for sign, letters in zip([*text, ""], edits):
            for letter in letters:
                cost += {"K": 0, "R": 3, "D": 4, "I": 3}[letter]
                cost += 3 if letter in "KR" and sign.isupper() else 0
        assert cost == turns.costs_before(turns.transition(text), turns.at_end())[turns.EMPTY]
