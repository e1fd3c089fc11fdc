"""Set algebra on id tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

WORD = 62  # membership bits per bigint


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` that are in ``b`` (null keys never match)."""
    return a.join(b.distinct(), a.columns, "left_semi").distinct()


def set_except(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b.distinct(), a.columns, "left_anti").distinct()


@dataclass(frozen=True)
class Filtered:
    """Ids given by a row test on a table; an equal ``name`` means the same table and key."""

    name: str
    base: DataFrame
    test: Column
    key: Column

    def ids(self, key: str) -> DataFrame:
        return self.base.where(self.test).select(self.key.alias(key))


def fold_membership(steps: Sequence[tuple[DataFrame | Filtered, str]], key: str) -> DataFrame:
    """Left fold of id sets by ``or`` / ``and`` / ``not``, in one shuffle."""
    return fold_memberships({"": steps}, key, "_group").select(key)


def fold_memberships(
    groups: Mapping[str, Sequence[tuple[DataFrame | Filtered, str]]], key: str, label: str
) -> DataFrame:
    """Several folds at once: rows (key, label) for every id a group's fold keeps.

    Instead of one union or join per step, each id row carries its group and the
    bit of its step; ``bit_or`` per (group, id), combined before the shuffle,
    tells which sets hold the id, and each fold becomes a boolean expression
    over the bits. Steps that test rows of one table (``Filtered``) share a
    single scan of it. Inputs may repeat ids; the result does not.
    """
    words = max((len(steps) + WORD - 1) // WORD for steps in groups.values())
    names = [f"_w{w}" for w in range(words)]
    tagged: list[DataFrame] = []
    shared: dict[str, list[tuple[Filtered, str, int]]] = {}
    keeps = F.lit(False)
    for name, steps in groups.items():
        state = F.lit(False)
        for i, (ids, op) in enumerate(steps):
            if isinstance(ids, Filtered):
                shared.setdefault(ids.name, []).append((ids, name, i))
            else:
                bits = _words([(F.lit(True), i)], words)
                tagged.append(ids.select(key, F.lit(name).alias(label), *bits))
            held = F.col(f"_w{i // WORD}").bitwiseAND(_bit(i)) != 0
            if op == "or":
                state = state | held
            elif op == "and":
                state = state & held
            elif op == "not":
                state = state & ~held
            else:
                raise ValueError(f"unknown step {op!r}")
        keeps = keeps | ((F.col(label) == name) & state)
    tagged += [_one_scan(uses, words, key, label) for uses in shared.values()]
    merged = union_all(*tagged).groupBy(label, key).agg(*[F.bit_or(n).alias(n) for n in names])
    return merged.where(keeps).select(key, label)


def _bit(step: int) -> Column:
    return F.lit(1 << (step % WORD)).cast("bigint")


def _words(tests: Sequence[tuple[Column, int]], words: int) -> list[Column]:
    """Bit words with the bits of the steps whose test holds."""
    out = []
    for w in range(words):
        total = F.lit(0).cast("bigint")
        for test, step in tests:
            if step // WORD == w:
                total = total + F.when(test, _bit(step)).otherwise(F.lit(0).cast("bigint"))
        out.append(total.alias(f"_w{w}"))
    return out


def _one_scan(
    uses: Sequence[tuple[Filtered, str, int]], words: int, key: str, label: str
) -> DataFrame:
    """All tests of one table in one pass, a row per (id, group) with a hit."""
    first = uses[0][0]
    hit = reduce(lambda a, b: a | b, [use.test for use, _, _ in uses])
    by_group: dict[str, list[tuple[Column, int]]] = {}
    for use, name, step in uses:
        by_group.setdefault(name, []).append((use.test, step))
    entries = [
        F.struct(F.lit(name).alias(label), *_words(tests, words)) for name, tests in by_group.items()
    ]
    rows = first.base.where(hit).select(first.key.alias(key), F.inline(F.array(*entries)))
    some = reduce(lambda a, b: a | b, [F.col(f"_w{w}") != 0 for w in range(words)])
    return rows.where(some)
