"""SimHash near-duplicates: 64-bit fingerprints, candidate pairs by shared blocks, Hamming distance, components.

A fingerprint is cut into blocks; two fingerprints with at most d differing bits agree on all but d of them, so
each choice of that many blocks is a join key and no close pair is missed. A crowded bucket (thousands of near
copies) is not paired with itself: each of its fingerprints names the points one flip away, within the blocks that
the bucket leaves open, and fingerprints that share such a point are within two flips of each other. That is
linear in the bucket and finds the same links. Documents with equal fingerprints count as one node all along.

Null and empty texts have fingerprint zero and link like any other; fewer words than a shingle make one shingle.
Every input row gives one output row, also where a doc_id repeats; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.components import connected_components
from visitry.llm.text import lower_words, map_lists, stored

SEED = 42
#: Shingles whose bits are counted at once, so a text of any length needs the same memory.
AT_ONCE = 20_000
BLOCKS = 5
#: A bucket above this many distinct fingerprints is linked through points instead of pairs. Same links either way.
CROWDED = 32


def fingerprint(text: str | None, width: int) -> int:
    """Signed 64-bit fingerprint of the word shingles of a whole text."""
    words = lower_words(text)
    if not words:
        return 0
    n, digest = max(1, len(words) - width + 1), xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, AT_ONCE):
        hashes = [digest(b" ".join(words[i : i + width]), SEED) for i in range(at, min(n, at + AT_ONCE))]
        rows = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (long) of every row."""

    def make():
        return lambda doc, text: (doc, [fingerprint(t, width) for t in text])

    return map_lists(docs, ["doc_id", "text"], "doc_id long, fingerprint long", make)


def _masks(distance: int, blocks: int) -> list[int]:
    """Signed masks of the bits that must agree, one for each choice of blocks - distance blocks."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:], strict=False)]
    masks = [sum(c) for c in combinations(block, blocks - distance)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def fingerprint_links(prints: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """a, b: links between distinct fingerprints (column fingerprint) that differ in one or two bits.

    All pairs of normal buckets; in crowded ones each link runs over a common point, so every two fingerprints
    that are close have a path of links.
    """
    masks = _masks(2, blocks)
    keyed = prints.select(
        "fingerprint",
        F.explode(F.array(*(F.struct(F.lit(i).alias("choice"), F.lit(m).alias("mask")) for i, m in enumerate(masks)))).alias("m"),
    ).select("fingerprint", "m.choice", (F.col("fingerprint").bitwiseAND(F.col("m.mask"))).alias("key"), "m.mask")
    # stored, so that both sides of the join come straight from their shuffle and a hot bucket's side can be split
    sizes = stored(keyed.groupBy("choice", "key").count().where("count > 1"), "sizes")
    keyed = stored(keyed.join(sizes, ["choice", "key"]), "buckets")
    small = keyed.where(F.col("count") <= CROWDED)
    left = small.select("choice", "key", F.col("fingerprint").alias("a"))
    right = small.select("choice", "key", F.col("fingerprint").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    pairs = left.join(right, ["choice", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")
    # a point one flip away, within the bits that the bucket's key leaves open
    bits = F.sequence(F.lit(0), F.lit(63))
    flips = F.filter(F.transform(bits, lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)),
                     lambda f: f.bitwiseAND(F.col("mask")) == 0)
    crowd = keyed.where(F.col("count") > CROWDED)
    points = crowd.select(
        "fingerprint",
        F.explode(F.concat(F.array("fingerprint"), F.transform(flips, lambda f: F.col("fingerprint").bitwiseXOR(f)))).alias("point"),
    ).distinct()
    first = points.groupBy("point").agg(F.min("fingerprint").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    over = points.join(first, "point").select("a", F.col("fingerprint").alias("b")).where("a <> b")
    return pairs.union(over).distinct()


def simhash_components(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (long), component_id: the smallest doc_id reachable over links of two bits or fewer."""
    prints = stored(fingerprints(docs, width), "fingerprints")
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    of = connected_components(fingerprint_links(nodes.select("fingerprint")))
    joined = nodes.join(of, nodes["fingerprint"] == of["node"], "left").select(
        nodes["fingerprint"].alias("print"), "first", F.coalesce("component", nodes["fingerprint"]).alias("component")
    )
    least = joined.groupBy("component").agg(F.min("first").alias("component_id"))
    names = joined.join(least, "component").select("print", "component_id")
    return prints.join(names, prints["fingerprint"] == names["print"]).select("doc_id", "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = 3) -> DataFrame:
    """The rows of docs without those that are not the first of their component; all columns stay.

    Of rows that repeat a doc_id all stay if the doc_id is the first of its component.
    """
    groups = simhash_components(docs, width)
    later = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__later")).distinct()
    return docs.join(later, docs["doc_id"] == later["__later"], "left_anti")
