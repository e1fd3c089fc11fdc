"""The clause grammar against its transducers run one after another; learning on planted texts; held-out accuracy."""

import random

import pytest

from visitry.llm import toxicity as t

SMALL = "/root/testdata/sf0.01"

#: Null, empty, blank, one word, repeated rows, and a row without an id.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (4, "word"), (5, "é" * 40), (None, "no id")]
LABELS = "doc_id long, quality int, toxic int"


def test_composition_is_the_chain():
    draw = random.Random(2)
    table = t.grammar()
    symbols = list(table[0])
    for _ in range(300):
        text = "".join(draw.choices(symbols, k=draw.randrange(30)))
        chain = list(text)
        for states, step in (t._negation(), t._report(), t._target()):
            state, out = states[0], []
            for s in chain:
                state, made = step(state, s)
                assert state in states
                out.append(made)
            chain = out
        assert t.matches(text, table) == [(i, k) for i, k in enumerate(chain) if k in t.KINDS]


@pytest.mark.parametrize(
    "text,kinds",
    [
        ("You are an idiot.", "a"), ("An idiot, you are!", "1y"), ("You are not an idiot.", "n"), ("He said you are an idiot.", "r"), ("The word. Idiot", "1"),
        ("They will kill the process", "t"), ("kill the process", ""), ("She wrote: \"idiot. scum\" but scum", "rr1"), ("not really a very great big idiot", "1"),
        ("You idiot moron", "aa"), ("IDIOT###you", "1y"), ("", ""), (" \n", ""),
    ],
)
def test_clauses(text, kinds):
    symbols, _ = t.symbols_of(text, t.Lexicon({}))
    assert "".join(k for _, k in t.matches(symbols, t.grammar())) == kinds


def planted(n=600, seed=4):
    """Toxic texts hold words that begin with 'grumbo'; one toxic text is copied often, clean ones hold 'grum' words."""
    draw = random.Random(seed)
    plain = ["".join(draw.choices("abcdefgh", k=draw.randrange(3, 7))) for _ in range(80)] + ["grumpel", "grumal"]
    rows, labels = [], []
    for i in range(n):
        toxic = int(draw.random() < 0.2)
        words = draw.choices(plain, k=draw.randrange(30, 200))
        if toxic:
            for _ in range(len(words) // 15 + 1):
                words.insert(draw.randrange(len(words)), "Grumbo" + draw.choice(["ling", "rist", "an", ""]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    copied = " ".join(["copied", *draw.choices(plain, k=60), "grumbo", *draw.choices(plain, k=20), "grumbos"])
    for i in range(n, n + 200):
        rows.append((i, copied))
        labels.append((i, 0, 1))
    return rows, labels


def test_learns_stems_not_copies(spark, make):
    rows, labels = planted()
    docs, labels = make(rows), spark.createDataFrame(labels, LABELS)
    stems, _, _ = t.fit(docs, labels)
    assert set(stems) <= {"grumb", "grumbo"} and len(stems) == 1
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = t.score_toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got if r["held_out"]) >= 0.97 * sum(r["held_out"] for r in got)


def test_labels_of_held_out_rows_are_not_seen(spark, make):
    rows, labels = planted(200)
    held = {r["doc_id"] for r in t.score_toxicity(make(rows), spark.createDataFrame([], LABELS)).collect() if r["held_out"]}
    flipped = [(i, q, 1 - y if i in held else y) for i, q, y in labels]
    one, two = (sorted(map(tuple, t.score_toxicity(make(rows), spark.createDataFrame(x, LABELS)).collect())) for x in (labels, flipped))
    assert held and one == two


def test_odd_rows(spark, make):
    docs = make([*ODD, (7, "You idiot! " * 5), (8, "word " * 50_000 + "you idiot")])
    labels = spark.createDataFrame([(7, None, None), (None, 1, 1), (4, 1, 0), (4, 1, 0), (99, 1, 1)], LABELS)
    for known in (labels, labels.limit(0)):
        got = {}
        for r in t.score_toxicity(docs, known).collect():
            got.setdefault(r["doc_id"], []).append(r["score"])
        assert sorted(map(len, got.values())) == [1] * 7 + [2]
        assert got[1] == got[2] == got[3] and got[4][0] == got[4][1] and got[7][0] > 0.5 > got[4][0]
    assert t.score_toxicity(docs.limit(0), labels).count() == 0
    found = t.toxic_clauses(docs.where("doc_id = 7"), {}).collect()
    assert len(found) == 5 and {r["kinds"] for r in found} == {"a"} and found[0]["clause"] == "You idiot"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = [r for r in t.score_toxicity(docs, labels).collect() if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in got) >= 0.97 * len(got)
