"""Near copies: texts with at least SIMILARITY (Jaccard) of their five-word shingles in common.

Candidates are texts whose fingerprints (simhash.py, of five-word shingles) differ in two bits or fewer. At SIMILARITY
most pairs differ in more, so keys of min-hashes bring together the rest: BANDS keys of ROWS min-hashes each bring candidates together: two texts of similarity s share no key in
(1 - s ** ROWS) ** BANDS of all cases, 3 in a million at 0.8 and fewer above. Every candidate pair is compared by its
whole shingle sets, unless their sizes, or parity bits that differ no more than the sets do, rule it out before these travel. Buckets of at most CROWDED texts are compared in full. In a larger one all texts are compared to
the first, so a bucket of n near copies costs n comparisons. The texts of larger buckets that this leaves in several
components meet again by their rare shingles: two sets that reach SIMILARITY share one among the 1 - SIMILARITY of
their shingles that come first in any common order, and the order here puts the frequent ones last. Texts that share
a boilerplate, but are not similar, so seldom meet, and no pair of these texts that is similar stays unlinked.

Equal texts are one text all along. Words are split and lowered as for fingerprints; fewer words than a shingle make
one shingle, and null, empty and blank texts are copies of each other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.components import connected_components
from visitry.llm.simhash import fingerprint_links, fingerprints
from visitry.llm.text import lower_words, map_lists, stored

WIDTH = 5
SIMILARITY = 0.8
ROWS = 5
BANDS = 32
#: A bucket above this many distinct texts is compared through its first text. Same components either way.
CROWDED = 8
SEED = 42
#: Counters by which shingles are ordered, rare ones first. Shared counters blur the order, never the result.
SLOTS = 1 << 20
#: Bits that tell apart most sets of some hundred shingles before these travel; a multiple of 64.
SKETCH = 512
#: Shingles hashed by all functions at once, so a text of any length needs the same memory for it.
AT_ONCE = 1_024
_HASH = np.random.default_rng(7).integers(1, 1 << 63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    words = lower_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    n, digest = max(1, len(words) - WIDTH + 1), xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + WIDTH]), SEED) for i in range(n)), np.uint64, n))


def band_keys(shingles: np.ndarray) -> list[int]:
    """Signed keys of a set, one a band; the empty set has one key."""
    if not len(shingles):
        return [0]
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), AT_ONCE):
        np.minimum(least, (shingles[at : at + AT_ONCE, None] * _HASH).min(axis=0), out=least)
    return [_signed(xxhash.xxh64_intdigest(b.tobytes(), k)) for k, b in enumerate(least.reshape(BANDS, ROWS))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH parity bits of a set. Two sets differ in as many shingles as bits, at least."""
    odd = np.bincount((shingles >> np.uint64(32)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach SIMILARITY; empty ones are equal."""
    if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= SIMILARITY * (len(a) + len(b) - common) - 1e-9


def prefix(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles in the order of counts (by slot), as many as any similar set must meet one of."""
    n = len(shingles)
    if not n:
        return shingles
    order = np.lexsort((shingles, counts[shingles % np.uint64(len(counts))]))
    return shingles[order[: n - math.ceil(SIMILARITY * n - 1e-9) + 1]]


def _sets(texts: DataFrame, named: DataFrame) -> DataFrame:
    """text_id, shingles (sorted, eight bytes each), size, sketch of the texts whose ids are in named; each text is shuffled once."""

    def make():
        def step(ids, texts):
            sets = [shingle_set(t) for t in texts]
            return ids, [x.tobytes() for x in sets], [len(x) for x in sets], [sketch(x) for x in sets]

        return step

    one = texts.join(named, "text_id", "left_semi").dropDuplicates(["text_id"])
    return stored(map_lists(one, ["text_id", "text"], "text_id long, shingles binary, size long, sketch array<long>", make), "sets")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b: text_id) whose texts are similar."""
    # stored, so that both sides of the join come straight from their shuffle and a hot text's side can be split
    pairs = stored(pairs.distinct(), "pairs")
    return _similar(pairs, _sets(texts, pairs.select(F.col("a").alias("text_id")).union(pairs.select("b")).distinct()))


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that may be similar by the sizes and sketches of their sets; all similar ones are among them."""
    known = sets.select("text_id", "size", "sketch")
    one = pairs.join(known, F.col("a") == known["text_id"]).select("a", "b", F.col("size").alias("size_a"), F.col("sketch").alias("sketch_a"))
    both = one.join(known, F.col("b") == known["text_id"])
    apart = sum((F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("sketch_a")[k])) for k in range(SKETCH // 64)), F.lit(0))
    sizes = F.col("size") + F.col("size_a")
    enough = F.least("size", "size_a") >= SIMILARITY * F.greatest("size", "size_a") - 1e-6
    return both.where(enough & (apart * (1 + SIMILARITY) <= sizes * (1 - SIMILARITY) + 1e-6)).select("a", "b")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    pairs = stored(_likely(pairs, sets), "likely")
    # no column of the sets has another name in either join, so they are shuffled once
    sets = sets.select("text_id", "shingles")
    one = pairs.join(sets, F.col("a") == sets["text_id"]).select("a", "b", F.col("shingles").alias("of_a"))
    both = one.join(sets, F.col("b") == sets["text_id"]).select("a", "b", "of_a", F.col("shingles").alias("of_b"))

    def run(batches):
        for batch in batches:
            sides = zip(batch.column(2), batch.column(3), strict=True)
            keep = [similar(*(np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in pair)) for pair in sides]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(both.mapInArrow(run, "a long, b long"), "verified")


def _slot_counts(sets: DataFrame) -> np.ndarray:
    """How many sets hold a shingle of each slot; SLOTS numbers, whatever the number of sets."""
    slots = SLOTS

    def run(batches):
        total = np.zeros(slots, dtype=np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount((np.frombuffer(x.as_buffer(), dtype=np.uint64) % np.uint64(slots)).astype(np.int64), minlength=slots)
        at = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])

    sums = sets.select("shingles").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(slots, dtype=np.int64)
    out[sums.column("slot").to_numpy()] = sums.column("n").to_numpy()
    return out


def _meeting(met: DataFrame) -> DataFrame:
    """Pairs of sets (the smaller one's columns end in _x) by every rare shingle they share, as far as these may be similar.

    met: shingle, text_id, size, left (shingles of the set behind this one), component, largest (component of the shingle).
    """
    # the first shingle that two similar sets share has at least as many behind it, in both, as they must share. For the
    # smaller set this is a shorter beginning than for the larger one, so few of a frequent shingle's texts are that side
    sides = "text_id", "size", "left", "component"
    share = SIMILARITY / (1 + SIMILARITY)
    begin = met.where(F.col("left") + 1 >= 2 * share * F.col("size") - 1e-6).select("shingle", "largest", *(F.col(c).alias(f"{c}_x") for c in sides))
    met = met.select("shingle", F.col("largest").alias("most_of"), *sides)
    both = (
        (F.col("component_x") != F.col("component"))
        & (F.struct("size_x", "text_id_x") < F.struct("size", "text_id"))
        & (F.least("left", "left_x") + 1 >= share * (F.col("size") + F.col("size_x")) - 1e-6)
    )
    # two texts of the largest component are connected, so one side of each pair is outside it
    pairs = begin.where("component_x <> largest").join(met, "shingle").where(both)
    return pairs.union(begin.where("component_x = largest").join(met.where("component <> most_of"), "shingle").where(both))


def _links_of_rare(placed: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between similar texts of different components. placed: text_id, component."""
    sets = _sets(texts, placed)
    counts = sets.sparkSession.sparkContext.broadcast(_slot_counts(sets))

    def make():
        def step(ids, sets):
            arrays = [np.frombuffer(x, dtype=np.uint64) for x in sets]
            firsts = [prefix(a, counts.value).view(np.int64) for a in arrays]
            lengths = [len(f) for f in firsts]
            left = [len(a) - k - 1 for a, f in zip(arrays, firsts, strict=True) for k in range(len(f))]
            return np.repeat(ids, lengths), np.repeat([len(a) for a in arrays], lengths), left, np.concatenate([*firsts, np.zeros(0, np.int64)])

        return step

    rows = map_lists(sets, ["text_id", "shingles"], "text_id long, size long, left long, shingle long", make)
    rows = stored(rows.join(placed, "text_id"), "rare")
    parts = rows.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("m"))
    largest = parts.groupBy("shingle").agg(F.max(F.struct("m", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("parts"))
    met = stored(rows.join(largest.where("parts > 1").drop("parts"), "shingle"), "met")
    pairs = _meeting(met)
    x_first = F.col("text_id_x") < F.col("text_id")
    pairs = pairs.select(
        F.least("text_id", "text_id_x").alias("a"), F.greatest("text_id", "text_id_x").alias("b"), (F.col("size") + F.col("size_x")).alias("sizes"),
        F.when(x_first, F.col("left_x")).otherwise(F.col("left")).alias("left_a"), F.when(x_first, F.col("left")).otherwise(F.col("left_x")).alias("left_b"),
    )
    # what two sets share is what they shared up to the last rare shingle that both hold, and at most all behind it
    most = F.count(F.lit(1)) + F.least(F.min("left_a"), F.min("left_b"))
    pairs = pairs.groupBy("a", "b").agg(most.alias("most"), F.first("sizes").alias("sizes"))
    pairs = pairs.where(F.col("most") * (1 + SIMILARITY) >= F.col("sizes") * SIMILARITY - 1e-6).select("a", "b")
    return _similar(stored(pairs, "pairs"), sets)


def print_candidates(texts: DataFrame) -> DataFrame:
    """a, b: texts to be compared as their fingerprints are close; a fingerprint's texts meet its first one."""
    prints = fingerprints(texts.select(F.col("text_id").alias("doc_id"), "text"), WIDTH)
    prints = stored(prints.select(F.col("doc_id").alias("text_id"), "fingerprint").distinct(), "prints")
    firsts = prints.groupBy("fingerprint").agg(F.min("text_id").alias("first"))
    same = prints.join(firsts, "fingerprint").where("text_id <> first").select(F.col("first").alias("a"), F.col("text_id").alias("b"))
    of_a, of_b = (firsts.select(F.col("fingerprint").alias(c), F.col("first").alias(f"first_{c}")) for c in "ab")
    close = fingerprint_links(firsts.select("fingerprint")).join(of_a, "a").join(of_b, "b").select("first_a", "first_b")
    return same.union(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_links(texts: DataFrame) -> DataFrame:
    """a, b: links between similar texts (text_id, text; repeats allowed). All similar candidates have a path of links."""

    def make():
        def step(ids, texts):
            keys = [band_keys(shingle_set(t)) for t in texts]
            return [i for i, k in zip(ids, keys, strict=True) for _ in k], [x for k in keys for x in k]

        return step

    keyed = stored(map_lists(texts, ["text_id", "text"], "text_id long, key long", make).distinct(), "bands")
    # stored, so that both sides of the join come straight from their shuffle and a hot bucket's side can be split
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("text_id").alias("first")).where("n > 1"), "sizes")
    members = stored(keyed.join(sizes, "key"), "buckets")
    small, crowd = members.where(F.col("n") <= CROWDED), members.where(F.col("n") > CROWDED)
    left, right = (small.select("key", F.col("text_id").alias(c)) for c in "ab")
    near = left.join(right, "key").where("a < b").select("a", "b")
    stars = crowd.where("text_id <> first").select(F.col("first").alias("a"), F.col("text_id").alias("b"))
    links = _verified(near.union(stars).union(print_candidates(texts)), texts)

    of = connected_components(links)
    placed = crowd.join(of, crowd["text_id"] == of["node"], "left").select("key", "text_id", F.coalesce("component", "text_id").alias("component"))
    placed = stored(placed, "placed")
    several = placed.groupBy("key").agg((F.min("component") < F.max("component")).alias("several")).where("several").select("key")
    return links.union(_links_of_rare(stored(placed.join(several, "key", "left_semi").drop("key").distinct(), "several"), texts))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of docs without those that are not the first of their component; all columns stay, whatever their names.

    The first is the least doc_id. Rows without a doc_id stay. Of rows that repeat a doc_id all stay if the doc_id is the first of its component.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.xxhash64(text).alias("text_id"), text.alias("text"))
    of = connected_components(near_links(texts.select("text_id", "text")))
    rows = stored(texts.select("doc_id", "text_id"), "text_ids")
    nodes = rows.groupBy("text_id").agg(F.min("doc_id").alias("first"))
    joined = nodes.join(of.withColumnRenamed("node", "text_id"), "text_id", "left").select("text_id", "first", F.coalesce("component", "text_id").alias("component"))
    least = joined.groupBy("component").agg(F.min("first").alias("least"))
    names = joined.join(least, "component").select("text_id", "least")
    name = "later"
    while name in docs.columns:
        name += "_"
    later = rows.join(names, "text_id").where("doc_id <> least").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(later, docs["doc_id"] == later[name], "left_anti")
