"""Structure repair of conversations: the cheapest edits that make roles alternate, and the least of them by name.

A conversation's rows are edited from first to last: Keep, Rerole (to user or assistant), Delete, Insert (an empty
turn). What is left must read (s?(ua)+)? by role initials. Edits are arcs between nodes (row, state), the states
being: nothing yet, after s, after u, after a. A cost recursion from the end gives each node's cost to go; arcs that
keep to it are optimal. Nodes are then ranked by the audit (initials of the edits) that follows them: first by one
letter, and in each round by twice as many, a node's rank and that of the node so many letters on being a pair.
Ranks select the arc of each node, and doubled pointers lead along the selected arcs to the audit of a whole piece.

Rows are ordered by turn (nulls first), then role, then text; null roles and texts are one space. A null conv_id is
a conversation like any other. Repeated rows are duplicates. A conversation of up to WHOLE rows is solved at once.
Longer ones are numbered by ordered exchange and cut in pieces of WHOLE rows: a piece is a matrix of least costs
between the states it is entered and left in, the pieces' matrices give every piece's costs to go, and each is
solved for all four states by itself. An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.text import SPACES, stored
from visitry.operators.ordered import number_in_order

#: Rows of a conversation that one task solves at once.
WHOLE = 16384
#: Conversations of so many rows in all are ranked together.
TOGETHER = 20_000
DELETE, INSERT, REROLE, CUT = 4, 3, 3, 3
LETTERS = np.array(list("DIKR"))
#: Following state by a user or assistant turn; states: 0 nothing yet, 1 after s, 2 after u, 3 after a.
NEXT = np.array([2, 2, 3, 2])
#: State that keeping a row leads to, by (state, initial), -1: not allowed. Initials: 0 other, 1 s, 2 u, 3 a.
KEPT = np.array([[-1, 1, 2, -1], [-1, -1, 2, -1], [-1, -1, -1, 3], [-1, -1, 2, -1]])
#: Cost to go after the last row: only insertions are left.
AT_END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
BLANKS = " \t\n\v\f\r"
INITIALS = {"s": 1, "u": 2, "a": 3}
ROLES = {2: "user", 3: "assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped of every row, broken by the hash of its name: see the contract of op12.

    0 drops the row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's.
    """
    name = F.concat(*(F.coalesce(c, F.lit(" ")) for c in (F.col("conv_id").cast("string"),)), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), kind.alias("kind"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text", (F.col("kind") == 0).alias("dropped"))


def costs_to_go(code: list[int], gone: list[bool], cut: list[bool], end: tuple) -> np.ndarray:
    """Least cost from (row, state) to the end, rows 0 to n; end: of row n."""
    out = [end]
    c0, c1, cu, ca = end
    for initial, away, short in zip(reversed(code), reversed(gone), reversed(cut), strict=True):
        b0, b1, bu, ba = c0 + DELETE, c1 + DELETE, cu + DELETE, ca + DELETE
        if not away:
            keep = CUT if short else 0
            to_u, to_a = keep + REROLE + cu, keep + REROLE + ca
            k0 = keep + (c1 if initial == 1 else cu) if initial in (1, 2) else FAR
            k1 = keep + cu if initial == 2 else FAR
            b0, b1, ba = min(b0, to_u, k0), min(b1, to_u, k1), min(ba, to_u, k1)
            bu = min(bu, to_a, keep + ca if initial == 3 else FAR)
        cu, ca = min(bu, ba + INSERT), min(ba, bu + INSERT)
        c0, c1 = min(b0, cu + INSERT), min(b1, cu + INSERT)
        out.append((c0, c1, cu, ca))
    return np.array(out[::-1], dtype=np.int64)


def optimal_arcs(code: list[int], gone: list[bool], cut: list[bool], cost: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """For every node (4 * row + state) and letter: whether its arc is optimal, and the node it leads to.

    last: insertions may follow row n; else row n belongs to the next piece.
    """
    n = len(code)
    optimal, target = np.zeros((n + 1, 4, 4), dtype=bool), np.zeros((n + 1, 4, 4), dtype=np.int64)
    state, row = np.arange(4), np.arange(n)[:, None]
    target[:n, :, 0] = 4 * (row + 1) + state
    optimal[:n, :, 0] = cost[:n] == DELETE + cost[1:]
    target[:, :, 1] = 4 * np.arange(n + 1)[:, None] + NEXT
    optimal[:, :, 1] = cost == INSERT + cost[:, NEXT]
    if n:
        kept = KEPT[:, np.array(code)].T
        stays = ~np.array(gone)[:, None]
        more = CUT * np.array(cut, dtype=np.int64)[:, None]
        target[:n, :, 2] = 4 * (row + 1) + np.maximum(kept, 0)
        optimal[:n, :, 2] = stays & (kept >= 0) & (cost[:n] == more + np.take_along_axis(cost[1:], np.maximum(kept, 0), 1))
        target[:n, :, 3] = 4 * (row + 1) + NEXT
        optimal[:n, :, 3] = stays & (cost[:n] == more + REROLE + cost[1:][:, NEXT])
    if not last:
        optimal[n] = False
    return optimal.reshape(-1, 4), target.reshape(-1, 4)


def least_paths(optimal: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Letter of every node (4: the audit ends here), and pointers 1, 2, 4, ... letters on, ends pointing to themselves.

    A node has at most one optimal arc of a letter. So the arcs with the least letter make one path, along which
    nodes are ranked by pairs; the ranks of all rounds together order the nodes by their whole audits.
    """
    nodes = np.arange(len(optimal))
    ends = ~optimal.any(axis=1)

    def doubled(letter):
        step = np.where(ends, nodes, target[nodes, np.minimum(letter, 3)])
        while True:
            yield step
            further = step[step]
            if np.array_equal(further, step):
                return
            step = further

    letter = np.where(ends, 4, optimal.argmax(axis=1))
    rank = np.where(ends, 0, letter + 1)  # an audit that ends comes before all that go on
    for step in doubled(letter):
        rank = np.unique(rank * (rank.max() + 1) + rank[step], return_inverse=True)[1]
    name = np.arange(4) * (rank.max() + 1) + rank[target]
    letter = np.where(ends, 4, np.where(optimal, name, np.iinfo(np.int64).max).argmin(axis=1))
    return letter, list(doubled(letter))


def walk(start: int, letter: np.ndarray, pointers: list[np.ndarray]) -> np.ndarray:
    """Nodes from start to an end, the end included."""
    path = np.array([start])
    for step in pointers:
        if letter[path[-1]] == 4:
            break
        path = np.concatenate([path, step[path]])
    return path[: int((letter[path] == 4).argmax()) + 1] if (letter[path] == 4).any() else path


def solved(pieces: list[tuple[list, list, list, np.ndarray, bool]], entries: tuple = (0,)) -> Iterator[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """For each piece (code, gone, cut, costs, last) and state it is entered in: rows, letters and states after them."""
    arcs = [optimal_arcs(*p) for p in pieces]
    starts = np.cumsum([0, *(len(a) for a, _ in arcs)])
    letter, pointers = least_paths(np.concatenate([a for a, _ in arcs]), np.concatenate([t + s for (_, t), s in zip(arcs, starts, strict=False)]))
    for start in starts[:-1]:
        out = []
        for entry in entries:
            path = walk(int(start) + entry, letter, pointers) - start
            out.append((path[:-1] // 4, letter[path[:-1] + start], path[1:] % 4 if len(path) > 1 else path[:0]))
        yield out


def faults(roles: list[str], texts: list[str]) -> list[str]:
    """The first fault of each row, of rows in order."""
    seen, out = set(), []
    for role, text in zip(roles, texts, strict=True):
        bare = text.strip(BLANKS)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            seen.add((role, text))
            out.append("" if bare[-1] in ".!?" else "truncated")
    return out


def illegal(code: list[int]) -> int:
    return sum((a, b) not in ((1, 2), (2, 3), (3, 2)) for a, b in zip(code, code[1:], strict=False))


def gaps(turns: list[int | None]) -> int:
    known = {t for t in turns if t is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def groups(batches, keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Runs of rows with equal first `keys` columns: the keys, and the other columns as lists."""
    now, held = None, []
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        begin = 0
        names = list(zip(*columns[:keys], strict=True))
        for i in range(len(names) + 1):
            if i == len(names) or names[i] != now:
                if now is not None:
                    for to, c in zip(held, columns[keys:], strict=True):
                        to.extend(c[begin:i])
                if i < len(names):
                    if now is not None:
                        yield now, held
                    now, held, begin = names[i], [[] for _ in columns[keys:]], i
    if now is not None:
        yield now, held


EDITS = "anonymous boolean, conv_id long, seq long, edit string, place long, role string, text string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_ARROW = pa.schema([("anonymous", pa.bool_()), ("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), *((c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))])


def _whole(batches):
    """EDITS of conversations, from anonymous, conv_id, turn, role, text, dropped, sorted: first a row of counts (seq 0)."""

    def flush(held):
        out = []
        pieces = []
        for _, turns, roles, texts in held:
            wrong = faults(roles, texts)
            code = [INITIALS.get(r[:1], 0) for r in roles]
            gone, cut = [w in ("blank", "duplicate") for w in wrong], [w == "truncated" for w in wrong]
            pieces.append((wrong, code, gone, cut, costs_to_go(code, gone, cut, AT_END)))
        for (key, turns, roles, texts), (wrong, code, _, _, cost), ((rows, letters, states),) in zip(held, pieces, solved([(*p[1:], True) for p in pieces]), strict=True):
            counts = (gaps(turns), wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), illegal(code), int(cost[0, 0]))
            out.append((*key, 0, None, None, None, None, *counts))
            for k, (i, x, s) in enumerate(zip(rows.tolist(), letters.tolist(), states.tolist(), strict=True), 1):
                role, text = (None, None) if x == 0 else (ROLES[s], "") if x == 1 else (roles[i] if x == 2 else ROLES[s], texts[i])
                out.append((*key, k, "DIKR"[x], i, role, text, *[None] * 6))
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    held, size = [], 0
    for key, (turns, roles, texts, dropped) in groups(batches, 2):
        there = [i for i, d in enumerate(dropped) if not d]
        held.append((key, *([c[i] for i in there] for c in (turns, roles, texts))))
        size += len(there) + 1
        if size >= TOGETHER:
            yield flush(held)
            held, size = [], 0
    if held:
        yield flush(held)


def _long_edits(rows: DataFrame) -> DataFrame:
    """EDITS of conversations with more than WHOLE rows, piece by piece."""
    key = ["anonymous", "conv_id"]
    bare = F.rtrim("text", F.lit(BLANKS))
    named = rows.select(*key, "turn", "role", "text")
    placed = stored(number_in_order(named, key, ["turn", "role", "text"], "place").withColumn("name", F.struct(F.xxhash64("role", "text"), F.xxhash64("text", "role"))), "placed")
    first = placed.groupBy(*key, "name").agg(F.min("place").alias("first"))
    wrong = F.when(~F.col("text").rlike(f"[^{SPACES[1:-1]}]"), "blank").when(F.col("place") > F.col("first"), "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    narrow = placed.join(first, [*key, "name"]).select(*key, F.floor(F.col("place") / WHOLE).alias("piece"), "place", "turn", code.alias("code"), wrong.alias("wrong"))
    narrow = stored(narrow, "faults")

    def in_pieces(df):
        return df.repartition(*key, "piece").sortWithinPartitions(*key, "piece", "place")

    def matrices(batches):
        for (anonymous, conv, piece), (_, turns, codes, wrong) in groups(batches, 3):
            gone, cut = [w in ("blank", "duplicate") for w in wrong], [w == "truncated" for w in wrong]
            least = [costs_to_go(codes, gone, cut, tuple(0 if j == k else FAR for k in range(4)))[0] for j in range(4)]
            known = [t for t in turns if t is not None]
            yield pa.RecordBatch.from_pylist([{
                "anonymous": anonymous, "conv_id": conv, "piece": piece, "least": np.minimum(np.array(least).T, FAR).ravel().tolist(),
                "blank": wrong.count("blank"), "duplicate": wrong.count("duplicate"), "truncated": wrong.count("truncated"), "illegal": illegal(codes),
                "first": codes[0], "last": codes[-1], "low": min(known, default=None), "high": max(known, default=None), "turns": len(set(known)),
            }], schema=kinds)

    names = ["blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns"]
    kinds = pa.schema([("anonymous", pa.bool_()), ("conv_id", pa.int64()), ("piece", pa.int64()), ("least", pa.list_(pa.int64())), *((c, pa.int64()) for c in names)])
    made = in_pieces(narrow.select(*key, "piece", "place", "turn", "code", "wrong")).mapInArrow(matrices, "anonymous boolean, conv_id long, piece long, least array<long>, " + ", ".join(f"{c} long" for c in names))
    made = stored(made, "matrices")

    def to_go(pieces: pd.DataFrame) -> pd.DataFrame:
        """Costs to go after each piece, and the conversation's counts; a row for WHOLE rows."""
        pieces = pieces.sort_values("piece", ignore_index=True)
        end, ends = np.array(AT_END), []
        for least in reversed(pieces["least"].tolist()):
            ends.append(end.tolist())
            end = (np.array(least).reshape(4, 4) + end).min(axis=1)
        low, high, turns = pieces["low"], pieces["high"], int(pieces["turns"].sum())
        turns -= int((low.iloc[1:].to_numpy() == high.iloc[:-1].to_numpy()).sum())
        borders = sum(illegal([int(a), int(b)]) for a, b in zip(pieces["last"].iloc[:-1], pieces["first"].iloc[1:], strict=True))
        missing = int(high.max() - low.min()) + 1 - turns if low.notna().any() else 0
        return pieces[["anonymous", "conv_id", "piece"]].assign(
            end=ends[::-1], n_pieces=len(pieces), gaps=missing, illegal=int(pieces["illegal"].sum()) + borders, cost=int(end[0]),
            blank=int(pieces["blank"].sum()), duplicate=int(pieces["duplicate"].sum()), truncated=int(pieces["truncated"].sum()),
        )

    plan = "anonymous boolean, conv_id long, piece long, end array<long>, n_pieces long, gaps long, illegal long, cost long, blank long, duplicate long, truncated long"
    plans = stored(made.groupBy(*key).applyInPandas(to_go, plan), "plans")

    def audits(batches):
        for (anonymous, conv, piece), (_, codes, wrong, ends, n_pieces) in groups(batches, 3):
            last = piece == n_pieces[0] - 1
            gone, cut = [w in ("blank", "duplicate") for w in wrong], [w == "truncated" for w in wrong]
            cost = costs_to_go(codes, gone, cut, tuple(ends[0]))
            (paths,) = solved([(codes, gone, cut, cost, last)], (0, 1, 2, 3))
            rows = [{"anonymous": anonymous, "conv_id": conv, "piece": piece, "entry": e, "exit": int(s[-1]) if len(s) else e, "rows": (r + piece * WHOLE).tolist(), "letters": x.tolist(), "states": s.tolist()} for e, (r, x, s) in enumerate(paths)]
            yield pa.RecordBatch.from_pylist(rows, schema=parts)

    parts = pa.schema([("anonymous", pa.bool_()), ("conv_id", pa.int64()), ("piece", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), *((c, pa.list_(pa.int64())) for c in ("rows", "letters", "states"))])
    each = in_pieces(narrow.join(plans.select(*key, "piece", "end", "n_pieces"), [*key, "piece"])).select(*key, "piece", "place", "code", "wrong", "end", "n_pieces")
    paths = stored(each.mapInArrow(audits, "anonymous boolean, conv_id long, piece long, entry int, exit int, rows array<long>, letters array<long>, states array<long>"), "paths")

    def chosen(pieces: pd.DataFrame) -> pd.DataFrame:
        """The state each piece is entered in, and the audit's letters before it."""
        leads = {(p, e): (x, n) for p, e, x, n in zip(pieces["piece"], pieces["entry"], pieces["exit"], pieces["n"], strict=True)}
        state, before, out = 0, 0, []
        for piece in range(len(leads) // 4):
            out.append((piece, state, before))
            state, n = leads[piece, state]
            before += n
        out = pd.DataFrame(out, columns=["piece", "entry", "before"])
        return out.assign(anonymous=pieces["anonymous"].iloc[0], conv_id=pieces["conv_id"].iloc[0])

    light = paths.select(*key, "piece", "entry", "exit", F.size("letters").cast("long").alias("n"))
    taken = light.groupBy(*key).applyInPandas(chosen, "piece long, entry int, before long, anonymous boolean, conv_id long")
    steps = paths.join(taken, [*key, "piece", "entry"]).select(*key, "before", F.posexplode(F.arrays_zip("rows", "letters", "states")).alias("at", "step"))
    steps = steps.select(*key, (F.col("before") + F.col("at") + 1).alias("seq"), F.col("step.rows").alias("place"), F.col("step.letters").alias("x"), F.col("step.states").alias("s"))
    told = steps.join(placed.select(*key, "place", F.col("role").alias("old"), F.col("text").alias("was")), [*key, "place"], "left")
    made_role = F.when(F.col("s") == 2, "user").otherwise("assistant")
    none = F.lit(None).cast("long")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    edits = told.select(
        *key, "seq", F.substring(F.lit("DIKR"), F.col("x").cast("int") + 1, F.lit(1)).alias("edit"), "place",
        F.when(F.col("x") == 0, None).when(F.col("x") == 2, F.col("old")).otherwise(made_role).alias("role"),
        F.when(F.col("x") == 0, None).when(F.col("x") == 1, "").otherwise(F.col("was")).alias("text"), *(none.alias(c) for c in counts),
    )
    text = F.lit(None).cast("string")
    heads = plans.where("piece = 0").select(*key, F.lit(0).cast("long").alias("seq"), text.alias("edit"), none.alias("place"), text.alias("role"), text.alias("text"), *counts)
    return edits.unionByName(heads).repartition(*key).sortWithinPartitions(*key, "seq")


def edits(rows: DataFrame) -> list[DataFrame]:
    """EDITS of all conversations in one or two tables, each with a conversation's rows together and in order.

    rows: conv_id, turn, role, text and, where it is there, dropped (the row only says that its conversation exists).
    A conversation's first row (seq 0) has its counts, the others its edits: the letter, the place of the row edited
    (of the row before which is inserted), the role and text after it (null if deleted).
    """
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    named = rows.select(
        F.col("conv_id").isNull().alias("anonymous"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), dropped.alias("dropped"),
    )
    key = ["anonymous", "conv_id"]
    long = stored(named.where(~F.col("dropped")).groupBy(*key).count().where(F.col("count") > WHOLE).select(*key), "long")
    some = not long.isEmpty()
    short = named.join(long, key, "left_anti") if some else named
    whole = short.repartition(*key).sortWithinPartitions(*key, "turn", "role", "text").mapInArrow(_whole, EDITS)
    return [whole, _long_edits(named.where(~F.col("dropped")).join(long, key, "left_semi"))] if some else [whole]


def _conv(df: DataFrame):
    return F.when(~F.col("anonymous"), F.col("conv_id")).alias("conv_id")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, seq, role, text, edit, place: the turns of every conversation after its repair, and how each was made."""
    every = edits(rows)
    both = every[0] if len(every) == 1 else every[0].unionByName(every[1])
    return both.where("edit <> 'D'").select(_conv(both), "seq", "role", "text", "edit", "place")


def _digests(batches):
    """A conversation's counts, audit and hash, from its EDITS as they stream past."""
    head, letters, digest, out = None, [], None, []

    def finished():
        return (*head[:2], *head[7:], "".join(letters), digest.hexdigest())

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[2] == 0:
                if head is not None:
                    out.append(finished())
                head, letters, digest, started = row, [], hashlib.sha256(), False
                continue
            letters.append(row[3])
            if row[3] != "D":
                digest.update((("\n" if started else "") + f"{row[5]}:{row[6]}").encode())
                started = True
        if out:
            yield _summaries(out)
            out = []
    if head is not None:
        yield _summaries([finished()])


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _summaries(rows):
    kinds = [pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string()]
    names = ["anonymous", "conv_id", *COUNTS, "audit", "repaired_sha256"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def repair_digest(rows: DataFrame) -> DataFrame:
    """conv_id, counts of faults, cost, audit and the hash of the repaired turns of every conversation."""
    schema = "anonymous boolean, conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    parts = [e.mapInArrow(_digests, schema) for e in edits(rows)]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.select(_conv(both), *COUNTS, "audit", "repaired_sha256")
