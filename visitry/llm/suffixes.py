"""Exact repeats of LENGTH bytes by suffix arrays, built with difference covers over content-defined groups.

Every piece of PIECE bytes has an anchor: its leftmost gram (GRAM bytes) of least hash. Equal pieces have equal
anchors at equal places. Anchors are few, so counting their grams over the corpus is cheap, and a stretch of LENGTH
bytes with a piece whose anchor is unique cannot repeat. What is left is cut into contexts (neighbouring stretches
whose first pieces have one anchor, their bytes once); contexts with equal anchors meet in one group, equal contexts in one row.
Anchors all of whose contexts have copies are done with that. Over the contexts of a
group runs the difference-cover algorithm: sort the triples at two of three places, recurse on their names, merge
in the places left, then compare the prefixes of neighbours in the order. The recursion ends once all names
differ, so after few rounds, as contexts are short. Groups are small parts of the text (GROUP_BYTES); the stretches of a gram with more
contexts than that are rows of their own, and counted.

Texts are UTF-8 bytes; null is empty. Documents with equal texts repeat each other whole. Rows are kept apart also
where they repeat a doc_id. Texts are told apart, and contexts found again, by 64-bit digests. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitry.llm.text import map_lists, stored

LENGTH = 200
GRAM = 48
#: Every piece of this many bytes has an anchor: the leftmost of its grams with the least hash.
PIECE = 150
GRAMS = PIECE - GRAM + 1
#: Bytes that one suffix array is built over. Three ranks fit into 64 bits up to two million.
GROUP_BYTES = 1_000_000
_BASE = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hashes of all grams, by doubling: 16, 32, then 48 bytes."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(29)
    power, reach, half = _BASE, 1, None
    while reach < 32:
        h = h[:-reach] * power + h[reach:]
        power, reach = power * power if reach < 16 else power, 2 * reach
        if reach == 16:
            half = h
    h = h[: len(half) - 32] * _power(16) + half[32:]
    h ^= h >> np.uint64(32)
    h *= _MIX
    return (h ^ (h >> np.uint64(29))) | np.uint64(1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return least(values[: len(values) - rest], values[rest:]) if rest else values


def find_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all grams, the least of every piece, and the places of anchors."""
    with np.errstate(over="ignore"):
        hashes = gram_hashes(data)
    least = _sliding(hashes, GRAMS, np.minimum)
    pad = np.zeros(GRAMS - 1, dtype=np.uint64)
    return hashes, least, np.nonzero(_sliding(np.concatenate([pad, least, pad]), GRAMS, np.maximum) == hashes)[0]


def candidate_stretches(data: np.ndarray, repeated: np.ndarray) -> list[tuple[int, int, int]]:
    """(gram, first, last): neighbouring stretches with one first anchor, none with a piece of a unique anchor.

    repeated: places of the anchors whose gram is elsewhere too.
    """
    hashes, least, places = find_anchors(data)
    own = np.searchsorted(places, np.arange(len(least)))
    while (wrong := hashes[places[own]] != least).any():
        own[wrong] += 1
    own = places[own]
    unique = np.cumsum(np.r_[0, ~np.isin(own, repeated)])
    # a stretch holds the pieces that start at its first LENGTH - PIECE + 1 bytes
    starts = np.nonzero(unique[LENGTH - PIECE + 1 :] == unique[: len(least) - (LENGTH - PIECE)])[0]
    if not len(starts):
        return []
    own = own[starts]
    cuts = np.nonzero((np.diff(starts) != 1) | (np.diff(own) != 0))[0]
    first, last = np.r_[0, cuts + 1], np.r_[cuts, len(starts) - 1]
    return list(zip(hashes[own[first]].view(np.int64).tolist(), starts[first].tolist(), starts[last].tolist(), strict=True))


def _inverse(ranks: np.ndarray) -> np.ndarray:
    """The places in the order of their ranks, which are all different and without gaps."""
    order = np.empty(len(ranks), dtype=np.int64)
    order[ranks] = np.arange(len(ranks))
    return order


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Ranks of all suffixes. text: numbers from 1, below two million, as many at most.

    Triples at places 1 and 2 of three are named in sorted order; the names
    are a text of two thirds the length whose characters cover three times as much. Once all differ they are ranks.
    """
    n = len(text)
    s = np.concatenate([text.astype(np.uint64), np.zeros(4, dtype=np.uint64)])
    bits = np.uint64(21)
    sample = np.concatenate([np.arange(1, n + 1, 3), np.arange(2, n, 3)])
    triple = (s[sample] << (bits + bits)) | (s[sample + 1] << bits) | s[sample + 2]
    names, name = np.unique(triple, return_inverse=True)
    inner = suffix_ranks(name + 1) if len(names) < len(sample) else name
    rank = np.zeros(n + 4, dtype=np.uint64)
    order = _inverse(inner)
    rank[sample[order]] = np.arange(1, len(sample) + 1, dtype=np.uint64)
    rank[n:] = 0
    rest = np.arange(0, n, 3)
    key_rest = (s[rest] << bits) | rank[rest + 1]
    by = np.argsort(key_rest)
    rest, key_rest = rest[by], key_rest[by]
    sample = sample[order]
    sample = sample[sample < n]
    one, two = sample[sample % 3 == 1], sample[sample % 3 == 2]
    # place in the merged order: suffixes before it in its own list, and in the other
    before_one = np.searchsorted((s[one] << bits) | rank[one + 1], key_rest)
    key_two = (s[two] << (bits + bits)) | (s[two + 1] << bits) | rank[two + 2]
    before_two = np.searchsorted(key_two, (s[rest] << (bits + bits)) | (s[rest + 1] << bits) | rank[rest + 2])
    at_rest = np.arange(len(rest)) + before_one + before_two
    out = np.empty(n, dtype=np.int64)
    out[rest] = at_rest
    free = np.ones(n, dtype=bool)
    free[at_rest] = False
    out[sample] = np.nonzero(free)[0]
    return out


def repeated_stretches(contexts: list[bytes], counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """For each context the runs (first, last) of stretches that are elsewhere too: here, or in a copy of the context."""
    lengths = np.array([len(c) for c in contexts])
    starts = np.cumsum([0, *(lengths + 1)])[:-1]
    data = np.frombuffer(b"\0".join(contexts) + b"\0", dtype=np.uint8)
    text = data.astype(np.int64) + len(contexts) + 1
    text[starts + lengths] = np.arange(1, len(contexts) + 1)  # ends that differ
    order = _inverse(suffix_ranks(text))
    length_left = np.repeat(starts + lengths, lengths + 1) - np.arange(len(text))
    order = order[length_left[order] >= LENGTH]
    # neighbours with equal prefixes, eight bytes at a time
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.zeros(len(data), dtype=np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + len(data)]
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for k in range(0, LENGTH, 8):
        at = words[order + k]
        same &= at[1:] == at[:-1]
    hit = np.zeros(len(text), dtype=bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    hit |= np.repeat(counts > 1, lengths + 1) & (length_left >= LENGTH)
    # no run goes on over the end of a context, which is no stretch
    steps = np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8))
    first, last = np.nonzero(steps == 1)[0], np.nonzero(steps == -1)[0] - 1
    own = np.searchsorted(starts, first, side="right") - 1
    found = [[] for _ in contexts]
    for k, a, b in zip(own.tolist(), (first - starts[own]).tolist(), (last - starts[own]).tolist(), strict=True):
        found[k].append((a, b))
    return found


def _anchor_table(texts: DataFrame) -> DataFrame:
    """gram, text_id, place of every anchor."""

    def run(batches):
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                if len(data) < LENGTH:
                    continue
                hashes, _, places = find_anchors(data)
                columns = [pa.array(hashes[places].view(np.int64)), pa.array(np.full(len(places), i)), pa.array(places.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "text_id", "place"])

    return texts.select("text_id", "text").where("text_id IS NOT NULL").mapInArrow(run, "gram long, text_id long, place int")


_CONTEXT = "text_id long, text string, parts array<struct<gram:long,first:int,last:int,digest:long>>"


def _digest(context: bytes) -> int:
    x = xxhash.xxh64_intdigest(context, 42)
    return x - (1 << 64) if x >> 63 else x


def _context_table(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """text_id, text and the candidate stretches of every text that has some."""
    places = repeated.groupBy("text_id").agg(F.collect_list("place").alias("places"))
    kind = pa.list_(pa.struct([("gram", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("digest", pa.int64())]))

    def run(batches):
        for batch in batches:
            ids, texts, parts = [], [], []
            for i, text, places in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data = text.encode()
                found = candidate_stretches(np.frombuffer(data, dtype=np.uint8), np.array(places))
                if found:
                    ids.append(i)
                    texts.append(text)
                    parts.append([{"gram": g, "first": a, "last": b, "digest": _digest(data[a : b + LENGTH])} for g, a, b in found])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(parts, kind)], names=["text_id", "text", "parts"])

    return stored(texts.join(places, "text_id").select("text_id", "text", "places").mapInArrow(run, _CONTEXT), "candidates", "zstd")


def _found(candidates: DataFrame) -> DataFrame:
    """gram, digest, runs (array of first, last): the stretches of each context that are elsewhere too."""
    # what a gram has is told without texts, so the contexts are written once, and of grams that need it
    length = F.col("last") - F.col("first") + LENGTH
    place = F.min(F.struct("text_id", "first", length.alias("length")))
    digests = _parts(candidates).groupBy("gram", "digest").agg(place.alias("place"), F.count(F.lit(1)).alias("n"))
    digests = stored(digests.select("gram", "digest", "n", "place.*"), "digests")
    sizes = digests.groupBy("gram").agg(F.sum(F.col("length") + 1).alias("bytes"), F.sum("n").alias("all"), F.min("n").alias("least"))
    sizes = stored(sizes.where("all > 1"), "sizes")
    # where every context has a copy all stretches are elsewhere too, and there is nothing to sort
    whole = digests.join(sizes.where("least > 1").select("gram"), "gram")
    whole = whole.select("gram", "digest", F.array(F.struct(F.lit(0).alias("first"), (F.col("length") - LENGTH).cast("int").alias("last"))).alias("runs"))
    wanted = digests.join(sizes.where("least = 1").drop("least"), "gram")
    context = F.substring(F.encode("text", "UTF-8"), F.col("first") + 1, F.col("length"))
    sized = wanted.join(candidates.select("text_id", "text"), "text_id").select("gram", "digest", "n", "bytes", "all", context.alias("context"))
    sized = stored(sized, "sized", "zstd")
    total = sized.where(F.col("bytes") <= GROUP_BYTES).agg(F.sum(F.length("context"))).first()[0] or 0
    groups = max(1, math.ceil(total / GROUP_BYTES))

    def kernel(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["gram", "digest"], ignore_index=True)
        # whole grams, so many that their ranks fit
        ends = (rows["context"].map(len) + 1).groupby(rows["gram"]).sum().cumsum()
        part = (ends // GROUP_BYTES).reindex(rows["gram"]).to_numpy()
        out = []
        for _, some in rows.groupby(part):
            runs = repeated_stretches(some["context"].to_list(), some["n"].to_numpy())
            out.append(some[["gram", "digest"]].assign(runs=[[{"first": a, "last": b} for a, b in r] for r in runs]))
        return pd.concat(out)

    grouped = sized.where(F.col("bytes") <= GROUP_BYTES).withColumn("group", F.pmod(F.xxhash64("gram"), F.lit(groups)))
    runs = "gram long, digest long, runs array<struct<first:int,last:int>>"
    small = grouped.select("group", "gram", "digest", "context", "n").groupBy("group").applyInPandas(kernel, runs)
    # a crowded gram's stretches are counted by themselves
    places = F.sequence(F.lit(0), F.length("context") - LENGTH)
    single = sized.where(F.col("bytes") > GROUP_BYTES).select("gram", "digest", "context", "n", F.explode(places).alias("first"))
    single = single.select("gram", "digest", "first", "n", F.xxhash64(F.substring("context", F.col("first") + 1, F.lit(LENGTH))).alias("stretch"))
    often = single.groupBy("stretch").agg(F.sum("n").alias("all")).where("all > 1").select("stretch")
    run = F.struct("first", F.col("first").alias("last"))
    large = single.join(often, "stretch").groupBy("gram", "digest").agg(F.collect_list(run).alias("runs"))
    return stored(small.union(large).where(F.size("runs") > 0).union(whole), "runs")


def _parts(candidates: DataFrame) -> DataFrame:
    """text_id, gram, first, last, digest of every candidate part."""
    return candidates.select("text_id", F.explode("parts").alias("p")).select("text_id", "p.*")


def removed_runs(texts: DataFrame) -> DataFrame:
    """text_id, n_removed, n_spans, kept_sha256 of the distinct texts in which something repeats."""
    anchors = stored(_anchor_table(texts), "anchors")
    # stored, so that both sides of the join come straight from their shuffle and a hot gram's side can be split
    grams = stored(anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "grams")
    repeated = anchors.join(grams, "gram").select("text_id", "place").distinct()
    one = texts.where("text_id IS NOT NULL").select("text_id", "text").dropDuplicates(["text_id"])
    candidates = _context_table(one, repeated)
    places = _parts(candidates).select("text_id", "gram", "first", "digest").join(_found(candidates), ["gram", "digest"])
    spans = places.select("text_id", F.transform("runs", lambda r: F.struct((F.col("first") + r["first"]).alias("start"), (F.col("first") + r["last"] + LENGTH).alias("end"))).alias("spans"))
    spans = spans.groupBy("text_id").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def make():
        def one(text, spans):
            data, removed, runs, parts = text.encode(), 0, 0, hashlib.sha256()
            end = -1
            for start, stop in sorted((s["start"], s["end"]) for s in spans):
                if start > end:
                    runs += 1
                    parts.update(data[max(end, 0) : start])
                    removed += stop - start
                elif stop > end:
                    removed += stop - end
                end = max(end, stop)
            parts.update(data[max(end, 0) :])
            return removed, runs, parts.hexdigest()

        return lambda ids, texts, spans: (ids, *map(list, zip(*map(one, texts, spans), strict=True))) if ids else ([], [], [], [])

    joined = candidates.select("text_id", "text").join(spans, "text_id")
    return map_lists(joined, ["text_id", "text", "spans"], "text_id long, n_removed long, n_spans long, kept_sha256 string", make)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row: what is left without bytes that repeat."""
    texts = docs.select("doc_id", "text", F.when(F.octet_length("text") >= LENGTH, F.xxhash64("text")).alias("text_id"))
    text = F.coalesce("text", F.lit(""))
    rows = texts.select("doc_id", "text_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("whole"))
    copies = rows.where("text_id IS NOT NULL").groupBy("text_id").agg(F.count(F.lit(1)).alias("copies"))
    known = rows.join(copies, "text_id", "left").join(removed_runs(texts), "text_id", "left")
    copied = F.col("copies") > 1
    return known.select(
        "doc_id",
        "n_bytes",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copied, F.lit(hashlib.sha256().hexdigest())).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )
