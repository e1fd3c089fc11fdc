"""Benchmark decontamination by spaced seeds: overlaps that survive substituted words.

A mask looks at six of up to nine neighbouring words. Test items and documents are hashed at every place under
every mask; equal hashes are hits, and the words around a hit are compared along its diagonal. An overlap is a
stretch of WINDOW words (or of the whole item, if that is shorter) of which at least SIMILARITY are equal. The five
masks together hit every such stretch with substituted words, wherever these are (tests try all places).

Items and documents are hashed in tasks, and the two tables of hashes are joined. So that the documents' table stays
small, their hashes pass a Bloom filter of the items' first; it has at most 1 << FILTER_BITS bits, and a fuller filter
lets more hashes into the join, never fewer. Places that meet become diagonals (text, item, shift), which are verified
by text in groups of about PIECE. Equal texts are searched once, and of a document only the text is shuffled, if it
has a hit.

Words are runs of letters, digits and underscores in lower case, compared by 64-bit hashes. Items shorter than a
window must be equal but for a fifth of their words, and those of fewer than MIN_WORDS words match as they are, at any
place. Items with equal words go under the smallest of their ids; of equally good overlaps of a document with an item
the one at the least shift is reported. Null and empty texts and items have no overlap; repeated rows are reported
each; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.text import map_lists, stored

# The places each mask looks at.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8), (0, 1, 3, 4, 5, 7), (0, 1, 2, 3, 7, 8), (0, 2, 4, 5, 6, 7))
SPAN = 9
WINDOW = 13
SIMILARITY = 0.8
MIN_WORDS = 8
#: Words of documents that are hashed at once; a longer document is one such portion.
PORTION = 500_000
_WORD = re.compile(r"\w+")
_FACTORS = np.random.default_rng(11).integers(1, 1 << 62, SPAN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The filter has up to 1 << FILTER_BITS bits, 32 MB; each hash sets two.
FILTER_BITS = 28
#: Diagonals of one text that are verified in one group, about.
PIECE = 4_096


def benchmark_words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _word_ids(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) or 1 for w in words), np.uint64, len(words))


def _hashes(ids: np.ndarray, number: int, mask: tuple[int, ...]) -> np.ndarray:
    """Hash at every place of ids (padded by SPAN behind); 0 where the mask looks at a place without a word."""
    n = len(ids) - SPAN
    total, known = np.full(n, number * 0x9E3779B97F4A7C15 % (1 << 64), dtype=np.uint64), np.ones(n, dtype=bool)
    for offset in mask:
        part = ids[offset : offset + n]
        total += part * _FACTORS[offset]
        known &= part > 0
    total ^= total >> np.uint64(31)
    total *= _FACTORS[0]
    total ^= total >> np.uint64(29)
    return np.where(known, total | np.uint64(1), np.uint64(0))


def _masks(short: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """The masks with their numbers; for items of a few words, a mask that looks at all of them."""
    return [*enumerate(MASKS, 1), *((100 + n, tuple(range(n))) for n in short)]


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """item (digest), item_id, words (64-bit hashes): items with equal words are one, under their smallest id."""

    def make():
        return lambda ids, texts: (ids, [_word_ids(benchmark_words(t)).tobytes() for t in texts])

    rows = map_lists(benchmark.where("text IS NOT NULL"), ["item_id", "text"], "item_id long, words binary", make).where("length(words) > 0")
    return stored(rows.groupBy("words").agg(F.min("item_id").alias("item_id")).withColumn("item", F.md5("words")), "items")


def item_seeds(items: DataFrame) -> DataFrame:
    """hash, item, place: every mask at every place of the items; of short items the whole."""

    def make():
        def step(names, words):
            found = [[], [], []]
            for name, w in zip(names, words, strict=True):
                ids = np.concatenate([np.frombuffer(w, dtype=np.uint64), np.zeros(SPAN, np.uint64)])
                n = len(ids) - SPAN
                for number, mask in _masks([n])[-1:] if n < MIN_WORDS else _masks([]):
                    at = _hashes(ids, number, mask)
                    places = np.nonzero(at)[0]
                    found[0] += at[places].view(np.int64).tolist()
                    found[1] += [name] * len(places)
                    found[2] += places.tolist()
            return found

        return step

    return stored(map_lists(items, ["item", "words"], "hash long, item string, place long", make), "seeds")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """Bits of a Bloom filter, 64 in a number: two for every hash, from its upper and lower half."""
    bits = max(16, min(FILTER_BITS, math.ceil(math.log2(1 + seeds.count())) + 10))
    upper, lower = F.shiftrightunsigned("hash", 64 - bits), F.shiftrightunsigned("hash", 1).bitwiseAND((1 << bits) - 1)
    slots = seeds.select(F.explode(F.array(upper, lower)).alias("slot"))
    one = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _passes(found: np.ndarray, filter: np.ndarray) -> np.ndarray:
    bits = len(filter).bit_length() - 1 + 6

    def is_set(slots):
        return (filter[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) > 0

    at = np.nonzero((found > 0) & is_set(found >> np.uint64(64 - bits)))[0]
    return at[is_set((found[at] >> np.uint64(1)) & np.uint64((1 << bits) - 1))]


def _portions(texts: list[str | None]):
    """Row ranges of about PORTION words, with their words."""
    start, docs, size = 0, [], 0
    for k, text in enumerate(texts):
        docs.append(benchmark_words(text))
        size += len(docs[-1])
        if size >= PORTION or k == len(texts) - 1:
            yield start, docs
            start, docs, size = k + 1, [], 0


def _diagonals(texts: DataFrame, items: DataFrame) -> DataFrame:
    """text_id, item, shift: where a seed of the item stands in the text, once for each diagonal."""
    seeds = item_seeds(items)
    # at most MIN_WORDS - 1 lengths
    short = sorted(r["n"] for r in items.select((F.length("words") / 8).cast("int").alias("n")).where(F.col("n") < MIN_WORDS).distinct().collect())
    filter = texts.sparkSession.sparkContext.broadcast(seed_filter(seeds))

    def make():
        def step(ids, texts):
            found = [[], [], []]
            for start, docs in _portions(texts):
                starts = np.cumsum([0, *(len(d) + SPAN for d in docs)])
                words = np.zeros(starts[-1] + SPAN, dtype=np.uint64)
                for at, d in zip(starts, docs, strict=False):
                    words[at : at + len(d)] = _word_ids(d)
                for number, mask in _masks(short):
                    hashes = _hashes(words, number, mask)
                    at = _passes(hashes, filter.value)
                    doc = np.searchsorted(starts, at, side="right") - 1
                    found[0] += [ids[start + k] for k in doc.tolist()]
                    found[1] += hashes[at].view(np.int64).tolist()
                    found[2] += (at - starts[doc]).tolist()
            return found

        return step

    hits = stored(map_lists(texts, ["text_id", "text"], "text_id string, hash long, at long", make), "hits")
    return stored(hits.join(seeds, "hash").select("text_id", "item", (F.col("at") - F.col("place")).alias("shift")).distinct(), "diagonals")


def best_stretch(item: np.ndarray, words: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """first word, words and equal words of the overlap along a diagonal, from its first good window to its last."""
    first, last = max(0, -shift), min(len(item), len(words) - shift)
    window = min(WINDOW, len(item))
    if last - first < window:
        return None
    sums = np.concatenate([[0], np.cumsum(item[first:last] == words[shift + first : shift + last])])
    need = window if window < MIN_WORDS else SIMILARITY * window - 1e-9
    good = np.nonzero(sums[window:] - sums[:-window] >= need)[0]
    if not len(good):
        return None
    a, b = int(good[0]), int(good[-1]) + window
    return int(shift + first + a), b - a, int(sums[b] - sums[a])


def _verified(diagonals: DataFrame, texts: DataFrame, items: DataFrame) -> DataFrame:
    """text_id, item, first_word, n_words, n_equal, n_text: the best overlap of each text with each item."""
    pieces = diagonals.groupBy("text_id").agg((F.count(F.lit(1)) / PIECE).cast("int").alias("last"))
    # a piece holds all diagonals of an item, so the best of them is found inside it
    left = diagonals.join(pieces, "text_id").join(items.select("item", "words"), "item")
    left = left.select("text_id", F.expr("pmod(xxhash64(item), last + 1)").alias("piece"), "item", "shift", "words")
    right = texts.join(pieces, "text_id").select("text_id", F.explode(F.expr("sequence(0L, cast(last as long))")).alias("piece"), "text")

    def verify(of_text, text):
        columns = [[] for _ in range(6)]
        if of_text.num_rows and text.num_rows:
            name, words = text.column("text_id")[0].as_py(), _word_ids(benchmark_words(text.column("text")[0].as_py()))
            best = {}
            rows = zip(of_text.column("shift").to_pylist(), of_text.column("item").to_pylist(), of_text.column("words").to_pylist(), strict=True)
            for shift, item, looked_for in sorted(rows):
                found = best_stretch(np.frombuffer(looked_for, dtype=np.uint64), words, shift)
                if found and (item not in best or found[2] > best[item][2]):
                    best[item] = found
            for item, found in best.items():
                for column, value in zip(columns, (name, item, *found, len(words)), strict=True):
                    column.append(value)
        kinds = [pa.string()] * 2 + [pa.int64()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["text_id", "item", "first_word", "n_words", "n_equal", "n_text"])

    schema = "text_id string, item string, first_word long, n_words long, n_equal long, n_text long"
    return stored(left.groupBy("text_id", "piece").cogroup(right.groupBy("text_id", "piece")).applyInArrow(verify, schema), "overlaps")


def _searched(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Overlaps by text, the documents that may have one (doc_id, text_id, text), the items."""
    items = distinct_items(benchmark)
    texts = docs.select("doc_id", F.md5("text").alias("text_id"), "text")
    diagonals = _diagonals(texts, items)
    met = stored(texts.join(diagonals.select("text_id").distinct(), "text_id", "left_semi"), "met")
    return _verified(diagonals, met.select("text_id", "text").dropDuplicates(["text_id"]), items), met, items


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, n_words, n_equal: the best overlap of each document with each item it overlaps."""
    overlaps, met, items = _searched(docs, benchmark)
    named = overlaps.join(items.select("item", "item_id"), "item").join(met.select("doc_id", "text_id"), "text_id")
    return named.select("doc_id", "item_id", "first_word", "n_words", "n_equal")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that overlap no test item, with all their columns, whatever their names.

    An item of fewer than MIN_WORDS words is a phrase that clean texts may hold too: it drops the documents that say
    nothing else.
    """
    # plain names on the way, as the caller may use any
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    text, doc_id = (f"c{docs.columns.index(c)}" for c in ("text", "doc_id"))
    overlaps, _, items = _searched(plain.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark)
    whole = overlaps.join(items.select("item", (F.length("words") / 8).alias("n_item")), "item")
    gone = whole.where((F.col("n_item") >= MIN_WORDS) | (F.col("n_words") == F.col("n_text"))).select("text_id").distinct()
    return plain.join(stored(gone, "contaminated"), F.md5(text) == F.col("text_id"), "left_anti").toDF(*docs.columns)
