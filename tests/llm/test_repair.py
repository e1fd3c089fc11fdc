"""Repair of conversations against a plain search over audits."""

import functools
import hashlib
import random
import re
import zlib

import pytest

from visitry.llm import repair

COLUMNS = "conv_id long, turn long, role string, text string"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        held = out.setdefault(conv, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn is not None, turn or 0, "user" if kind == 4 else role, text)
        held += [] if kind == 0 else [row, row] if kind == 3 else [row]
    return {c: [(t if known else None, r, x) for known, t, r, x in sorted(v)] for c, v in out.items()}


def plain(rows):
    """Counts, cost, audit, repaired turns of one conversation, by trying every edit."""
    seen, wrong = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        wrong.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @functools.lru_cache(None)
    def best(i, state, inserted=0):
        tries = []
        if i == len(rows) and state in ("", "a"):
            tries.append((0, "", ()))
        if inserted < 2:
            rest = best(i, NEXT[state], inserted + 1)
            tries.append((3 + rest[0], "I" + rest[1], (({"u": "user", "a": "assistant"}[NEXT[state]], ""), *rest[2])))
        if i < len(rows):
            _, role, text = rows[i]
            rest = best(i + 1, state)
            tries.append((4 + rest[0], "D" + rest[1], rest[2]))
            if wrong[i] not in ("blank", "duplicate"):
                more = 3 * (wrong[i] == "truncated")
                to = role[:1]
                if to and (to == NEXT[state] or to == "s" and state == ""):
                    rest = best(i + 1, to)
                    tries.append((more + rest[0], "K" + rest[1], ((role, text), *rest[2])))
                rest = best(i + 1, NEXT[state])
                tries.append((more + 3 + rest[0], "R" + rest[1], (({"u": "user", "a": "assistant"}[NEXT[state]], text), *rest[2])))
        return min(tries, default=(1 << 30, "", ()))

    cost, audit, turns = best(0, "")
    known = {t for t, _, _ in rows if t is not None}
    initials = [r[:1] for _, r, _ in rows]
    bad = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in turns).encode()).hexdigest()
    return (gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), bad, cost, audit, digest), turns


def some_rows():
    draw = random.Random(3)
    rows = []
    for c in [None, *range(-5, 300)]:
        for t in range(draw.choice([1, 1, 2, 4, 7, 12])):
            rows.append((c, draw.choice([t, t, t, t + 3, None]), draw.choice(["user", "assistant", "assistant", "system", "sys", "tool", "", None]), draw.choice(["Yes.", "No!", "Why", "é?\n", "", " \t", None, f"text {t}."])))
    return rows


def by_conv(df):
    got = {}
    for row in df.collect():
        assert row["conv_id"] not in got
        got[row["conv_id"]] = tuple(row[1:])
    return got


def test_whole_conversations(spark):
    rows = some_rows()
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert by_conv(repair.repair_digest(repair.damage(df))) == {c: plain(v)[0] for c, v in damaged(rows).items()}


@pytest.mark.parametrize("whole", [3, 8])
def test_long_conversations_in_pieces(spark, monkeypatch, whole):
    """The same with pieces of a few rows: all but the shortest conversations are long ones."""
    monkeypatch.setattr(repair, "WHOLE", whole)
    rows = some_rows()[:900]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert by_conv(repair.repair_digest(repair.damage(df))) == {c: plain(v)[0] for c, v in damaged(rows).items()}


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello."), (1, 1, "user", "Hello."), (1, 2, "user", "And you?"), (2, None, None, None), (3, 0, "assistant", "Hi")]
    got = repair.repair_conversations(spark.createDataFrame(rows, COLUMNS))
    assert sorted(map(tuple, got.select("conv_id", "seq", "role", "text", "edit").collect())) == [
        (1, 1, "system", "Be kind.", "K"), (1, 2, "user", "Hello.", "K"), (1, 4, "assistant", "And you?", "R"),
    ]


def test_extra_columns_and_empty(spark):
    none = spark.createDataFrame([], COLUMNS + ", seq string, edit long, place long")
    assert repair.repair_digest(repair.damage(none)).count() == 0
    one = spark.createDataFrame([(1, 0, "user", "a.", "x", 1)], COLUMNS + ", seq string, kind long")
    assert repair.repair_digest(repair.damage(one)).count() == 1


def test_ranks_order_the_nodes_by_their_audits():
    draw = random.Random(1)
    for _ in range(50):
        n = draw.randrange(0, 12)
        code, gone, cut = [draw.randrange(4) for _ in range(n)], [draw.random() < 0.2 for _ in range(n)], [draw.random() < 0.3 for _ in range(n)]
        cost = repair.costs_to_go(code, gone, cut, repair.AT_END)
        optimal, target = repair.optimal_arcs(code, gone, cut, cost, True)
        letter, pointers = repair.least_paths(optimal, target)

        @functools.lru_cache(None)
        def audit(v):
            return min(("DIKR"[x] + audit(int(target[v, x])) for x in range(4) if optimal[v, x]), default="")  # noqa: B023

        for v in range(len(optimal)):
            assert "".join("DIKR"[x] for x in letter[repair.walk(v, letter, pointers)][:-1]) == audit(v)
