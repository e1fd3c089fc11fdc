"""Katz back-off language model: Good-Turing discounted counts, exactly normalised back-off weights.

Texts become blocks of about BLOCK_TOKENS tokens with a word list of their own. A block asks for the counts of its
distinct words and word pairs; the tables of counts are partitioned by the key's hash, so a part sees a key at most
once from each block, however frequent it is, and answers every block in the order it asked. Mass and lower-order
probability of the pairs seen behind a word are summed the same way, each pair by one block that owns it, and give
the back-off weights. Then every block evaluates its tokens: the discounted pair where it was seen in training, else
the back-off weight of the word before times the probability of the word alone. Texts are read once; between the
rounds only keys, counts and sums travel. Blocks lie in a table bucketed by block, so they stay where they are.

Tokens are the words in lower case and one end per text, which is also what the first word follows. Words unknown in
training share the mass that discounting leaves. The first DISCOUNTED counts are discounted by Katz's formula, where
the counts of counts allow it, otherwise by half an occurrence. Where all pairs behind a word are too frequent for
that, the word counts once more, so that something is left. Null and empty texts are one end. Repeated rows are
scored, and count in training, each. Without training texts every score is 0. Other columns are not read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.classifier import held_out
from visitry.llm.text import lower_words, stored
from visitry.session import scratch_path

BLOCK_TOKENS = 2_000_000
#: Aimed at: tokens asked for in one part of a table.
PART_TOKENS = 1_000_000
DISCOUNTED = 5
END = b"\n"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SCHEMA = "block long, docs array<long>, held array<boolean>, sizes array<int>, words array<long>, tokens array<int>"
_ANSWER = "block long, level int, part int, totals array<int>, owned array<boolean>, mass array<double>, lower array<double>, spectrum array<long>"


def to_blocks(docs: DataFrame, parts: int, part: int, buckets: int) -> DataFrame:
    """Token blocks as a table bucketed by block, in the shared folder."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, now = TaskContext.get().partitionId() << 32, []
        index: dict[bytes, int] = {}
        ids, held, sizes, tokens = [], [], [], []

        def full():
            words = np.array([xxhash.xxh3_64_intdigest(w) for w in index], dtype=np.uint64).view(np.int64)
            values = [[number + len(now)], [ids], [held], [sizes], [words], [np.concatenate(tokens)]]
            kinds = [pa.int64(), *(pa.list_(t) for t in (pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int32()))]
            now.append(1)
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["block", "docs", "held", "sizes", "words", "tokens"])

        size = 0
        for batch in batches:
            for doc, out, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = lower_words(text)
                words.append(END)
                tokens.append(np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int32))
                ids.append(doc)
                held.append(out)
                sizes.append(len(words))
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield full()
                    index, ids, held, sizes, tokens, size = {}, [], [], [], [], 0
        if ids:
            yield full()

    made = docs.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held"), "text").mapInArrow(run, _SCHEMA)
    name = f"katz_blocks_{uuid.uuid4().hex}"
    path = scratch_path(docs.sparkSession, name)
    made.write.bucketBy(buckets, "block").option("compression", "zstd").option("path", path).format("parquet").saveAsTable(name)
    return docs.sparkSession.table(name)


class Block:
    """Words and pairs of one block, in the order in which parts are asked about them."""

    def __init__(self, words, tokens, sizes, held, parts: int):
        self.words = np.asarray(words, dtype=np.int64).view(np.uint64)
        self.tokens = np.asarray(tokens, dtype=np.int64)
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.train = np.repeat(~np.asarray(held, dtype=bool), self.sizes)
        self.parts = parts
        self.order = self._order(self.words)

    def _order(self, keys: np.ndarray) -> list[np.ndarray]:
        """For each part the places of its keys, by key."""
        by = np.lexsort((keys, keys % np.uint64(self.parts)))
        bounds = np.searchsorted((keys % np.uint64(self.parts))[by], np.arange(self.parts + 1, dtype=np.uint64))
        return [by[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words))

    def pairs(self):
        """For every distinct pair: place of the first word, of the second, key, count in training; and each token's pair."""
        ends = np.cumsum(self.sizes)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        end = self.tokens[ends[0] - 1]
        before[np.concatenate([[0], ends[:-1]])] = end
        code, pair = np.unique(before * len(self.words) + self.tokens, return_inverse=True)
        first, second = code // len(self.words), code % len(self.words)
        with np.errstate(over="ignore"):
            key = self.words[first] * _MIX
            key = ((key ^ (key >> np.uint64(32))) + self.words[second]) * _MIX
            key ^= key >> np.uint64(29)
        return first, second, key, np.bincount(pair[self.train], minlength=len(code)), pair

    def spread(self, order: list[np.ndarray], answers: dict[int, np.ndarray], n: int, kind) -> np.ndarray:
        """What the parts answered, back in the block's own order."""
        out = np.zeros(n, dtype=kind)
        for part, places in enumerate(order):
            if len(places):
                out[places] = answers[part]
        return out


def _asked(block: int, keys: np.ndarray, order, counts: np.ndarray):
    for part, places in enumerate(order):
        if len(places):
            yield block, part, keys[places].view(np.int64), counts[places]


def ask(blocks: DataFrame, level: int, parts: int) -> DataFrame:
    """block, part, keys, counts: the distinct words (level 1) or pairs (2) of each block, with training counts."""

    def run(batches):
        for batch in batches:
            for b, words, tokens, sizes, held in zip(*(batch.column(c) for c in ("block", "words", "tokens", "sizes", "held")), strict=True):
                block = Block(words.values.to_numpy(), tokens.values.to_numpy(), sizes.values.to_numpy(), held.values.to_numpy(zero_copy_only=False), parts)
                if level == 1:
                    rows = _asked(b.as_py(), block.words, block.order, block.word_counts())
                else:
                    _, _, keys, counts, _ = block.pairs()
                    rows = _asked(b.as_py(), keys, block._order(keys), counts)
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["block", "part", "keys", "counts"])

    return blocks.select("block", "words", "tokens", "sizes", "held").mapInArrow(run, "block long, part int, keys array<long>, counts array<int>")


def answer_counts(asked: DataFrame, level: int) -> DataFrame:
    """For each question the totals over all blocks, and which keys this block owns: it is the first that trained on them.

    spectrum, in one row of each part: types with totals 1 to DISCOUNTED + 1, types and tokens.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block", ignore_index=True)
        keys, counts = np.concatenate(rows["keys"].to_list()), np.concatenate(rows["counts"].to_list())
        unique, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, counts, minlength=len(unique)).astype(np.int64)
        trained = np.nonzero(counts)[0]
        owned = np.zeros(len(keys), dtype=bool)
        owned[trained[np.unique(place[trained], return_index=True)[1]]] = True
        cuts = np.cumsum(rows["keys"].map(len))[:-1]
        some = totals[totals > 0]
        spectrum = [*(int((some == r).sum()) for r in range(1, DISCOUNTED + 2)), len(some), int(some.sum())]
        out = rows[["block", "part"]].assign(level=level, mass=None, lower=None)
        out["totals"], out["owned"] = np.split(totals[place].astype(np.int32), cuts), np.split(owned, cuts)
        out["spectrum"] = [spectrum] + [None] * (len(rows) - 1)
        return out[["block", "level", "part", "totals", "owned", "mass", "lower", "spectrum"]]

    return stored(asked.groupBy("part").applyInPandas(run, _ANSWER), f"counts{level}")


def discounts(answers: DataFrame) -> tuple[np.ndarray, int, int]:
    """Factor for counts 0 to DISCOUNTED + 1 (the last for all beyond, 1), types and tokens."""
    size = DISCOUNTED + 3
    row = answers.where("spectrum IS NOT NULL").agg(*(F.sum(F.col("spectrum")[i]) for i in range(size))).first()
    n = [0, *(int(x or 0) for x in row[: DISCOUNTED + 1])]
    factors = np.ones(DISCOUNTED + 2)
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        katz = (turing - common) / (1 - common) if common != 1 else 0.0
        factors[r] = katz if 0 < katz < 1 else (r - 0.5) / r
    return factors, int(row[size - 2] or 0), int(row[size - 1] or 0)


class Evaluator:
    """What a block knows once the parts have answered."""

    def __init__(self, row, answers: pd.DataFrame, parts: int, model: dict):
        self.block = Block(row["words"], row["tokens"], row["sizes"], row["held"], parts)
        by = {(level, part): i for i, (level, part) in enumerate(zip(answers["level"], answers["part"], strict=True))}
        self.answers, self.by, self.model = answers, by, model
        block = self.block
        self.count = self.told(1, "totals", block.order, len(block.words), np.int64)
        self.first, self.second, keys, _, self.pair = block.pairs()
        self.pair_order = block._order(keys)
        self.pair_count = self.told(2, "totals", self.pair_order, len(keys), np.int64)
        top = DISCOUNTED + 1
        self.pair_mass = self.pair_count * model["pair"][np.minimum(self.pair_count, top)]
        word_mass = self.count * model["word"][np.minimum(self.count, top)]
        self.alone = np.where(self.count > 0, word_mass / max(model["tokens"], 1), model["unknown"])

    def told(self, level: int, column: str, order, n: int, kind) -> np.ndarray:
        values = self.answers[column]
        return self.block.spread(order, {p: np.asarray(values.iloc[self.by[level, p]]) for p, o in enumerate(order) if len(o)}, n, kind)

    def behind(self):
        """For each word: mass and lower-order probability of the owned pairs that it begins."""
        owned = self.told(2, "owned", self.pair_order, len(self.pair_count), bool)
        n, first = len(self.block.words), self.first[owned]
        return np.bincount(first, self.pair_mass[owned], minlength=n), np.bincount(first, self.alone[self.second[owned]], minlength=n)

    def token_logs(self) -> np.ndarray:
        """log10 probability of every token."""
        mass = self.told(3, "mass", self.block.order, len(self.block.words), float)
        lower = self.told(3, "lower", self.block.order, len(self.block.words), float)
        known = self.count > 0
        whole = np.where(known, self.count, 1).astype(float)
        whole += known & (whole - mass < 1e-9 * whole)
        weight = np.where(known, (1 - mass / whole) / np.maximum(1 - lower, 1e-300), 1.0)
        seen = self.pair_count > 0
        with np.errstate(divide="ignore"):
            logs = np.where(seen, np.log10(self.pair_mass / whole[self.first]), np.log10(weight[self.first] * self.alone[self.second]))
        return logs[self.pair]


def _evaluate(blocks: DataFrame, answers: DataFrame, parts: int, model: dict, step, schema: str) -> DataFrame:
    """step(block's row, Evaluator) on every block, beside its answers; only the answers are shuffled."""

    def run(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        return pd.concat([step(row, Evaluator(row, told, parts, model)) for _, row in rows.iterrows()])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, schema)


def katz_scores(docs: DataFrame, parts: int = 7, part: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from the rows whose crc32 of the doc_id leaves another remainder than `part` by `parts`. base_score is
    the sum of log10((c + 1) / (N + V + 1)) over the tokens, with counts c, N tokens and V types in training.
    """
    spark = docs.sparkSession
    blocks = to_blocks(docs, parts, part, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8))
    total = blocks.agg(F.sum(F.size("tokens"))).first()[0] or 0
    shares = max(1, math.ceil(total / PART_TOKENS))
    words = answer_counts(ask(blocks, 1, shares), 1)
    pairs = answer_counts(ask(blocks, 2, shares), 2)
    word_factors, types, tokens = discounts(words)
    pair_factors, _, _ = discounts(pairs)
    row = words.where("spectrum IS NOT NULL").agg(*(F.sum(F.col("spectrum")[i]) for i in range(DISCOUNTED))).first()
    lost = sum((r + 1) * (1 - word_factors[r + 1]) * int(n or 0) for r, n in enumerate(row))
    if tokens and not lost:  # every word is frequent: one unknown word more
        word_factors, lost = word_factors * (tokens / (tokens + 1)), tokens / (tokens + 1)
    unknown = float(lost / tokens) if tokens else 1.0
    model = {"word": word_factors, "pair": pair_factors, "tokens": tokens, "unknown": unknown}

    def sums(row, known: Evaluator) -> pd.DataFrame:
        mass, lower = known.behind()
        order = [(p, o) for p, o in enumerate(known.block.order) if len(o)]
        return pd.DataFrame({
            "block": row["block"], "part": [p for p, _ in order], "keys": [known.block.words[o].view(np.int64) for _, o in order],
            "mass": [mass[o] for _, o in order], "lower": [lower[o] for _, o in order],
        })

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block", ignore_index=True)
        unique, place = np.unique(np.concatenate(rows["keys"].to_list()), return_inverse=True)
        cuts = np.cumsum(rows["keys"].map(len))[:-1]
        out = rows[["block", "part"]].assign(level=3, totals=None, owned=None, spectrum=None)
        for c in ("mass", "lower"):
            total = np.bincount(place, np.concatenate(rows[c].to_list()), minlength=len(unique))
            out[c] = np.split(total[place], cuts)
        return out[["block", "level", "part", "totals", "owned", "mass", "lower", "spectrum"]]

    counts = words.union(pairs)
    asked = _evaluate(blocks, counts, shares, model, sums, "block long, part int, keys array<long>, mass array<double>, lower array<double>")
    weights = stored(asked.groupBy("part").applyInPandas(added, _ANSWER), "weights")

    def scores(row, known: Evaluator) -> pd.DataFrame:
        block = known.block
        at = np.concatenate([[0], np.cumsum(block.sizes)[:-1]])
        base = np.log10((known.count + 1) / (tokens + types + 1))[block.tokens]
        return pd.DataFrame({
            "doc_id": pd.array(list(row["docs"]), dtype="Int64"), "n_tokens": block.sizes,
            "n_known": np.add.reduceat((known.count > 0)[block.tokens].astype(np.int64), at), "train_tokens": tokens,
            "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(known.token_logs(), at), "held_out": list(row["held"]),
        })

    schema = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, held_out boolean"
    out = _evaluate(blocks, counts.union(weights), shares, model, scores, schema)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
