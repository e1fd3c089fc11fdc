"""The trie of conversations against a plain dictionary of prefixes."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from visitry.llm.trie import conversation_trie, fattest, trie_nodes

COLUMNS = "conv_id long, turn long, role string, text string"


def nodes_of(sequences):
    members = collections.defaultdict(list)
    for c, q in sequences.items():
        for d in range(len(q) + 1):
            members[tuple(q[:d])].append(c)
    kids = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        value = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += value
            leaves[p[:d]] += not kids[p]
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(sequences[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = [x[2:] for x in sorted(turns.get(base, []))[:h] + sorted(turns[c])[h:]]
    return out


def same(df, want):
    assert sorted(map(tuple, df.collect()), key=str) == want


def test_random_conversations(spark):
    """Few different turns, so that sequences part, end inside others and repeat; nulls, ties and repeated rows."""
    draw = random.Random(5)
    rows = []
    for c in [*range(-12, 260), None]:
        for t in range(draw.choice([0, 1, 2, 5, 9, 14])):
            rows.append((c, draw.choice([t, t, t, None]), draw.choice(["user", "assistant", None]), draw.choice(["é", "", None, "long text"]) if draw.random() < 0.3 else "same"))
    df = spark.createDataFrame(rows, COLUMNS).withColumns({"depth": F.lit(1), "k": F.lit("x")}).repartition(3)
    same(conversation_trie(df), nodes_of(rebuilt(rows)))


def test_long_and_hot_sequences(spark):
    """A third of all turns in one conversation, many copies of another, ends at every depth of a third."""
    chain = [("u", str(i)) for i in range(300)]
    sequences = {0: chain, **{100 + i: chain[:i] for i in range(0, 60)}, **{1000 + i: [("u", "copy")] * 3 for i in range(90)}, 5000: chain[:37] + [("u", "other")], 7000: []}
    turns = spark.createDataFrame([(c, d + 1, r, x) for c, q in sequences.items() for d, (r, x) in enumerate(q)], "conv_id long, depth long, role string, text string")
    lengths = spark.createDataFrame([(c, len(q)) for c, q in sequences.items()], "conv_id long, n long")
    same(trie_nodes(turns, lengths), nodes_of(sequences))


def test_empty(spark):
    assert conversation_trie(spark.createDataFrame([], COLUMNS)).count() == 0


@pytest.mark.parametrize("a,b,want", [(0, 1, 1), (0, 9, 8), (4, 7, 6), (8, 9, 9), (3, 4, 4), (17, 31, 24)])
def test_fattest(spark, a, b, want):
    row = spark.range(1).select(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")).select(fattest(F.col("a"), F.col("b"))).first()
    assert row[0] == want == max(range(a + 1, b + 1), key=lambda x: x & -x)
