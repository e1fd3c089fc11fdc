"""URL filter: a Bloom filter cascade decides exactly and without a join whether a url is listed.

Level 0 encodes the listed keys, level 1 those other keys of the corpus that level 0 takes for listed, level 2 the
listed keys that level 1 takes for others, and so on until a level has no false positives. As all keys of the corpus
were looked at, the answer for each of them is exact. Keys are spread by digest over shards of about SHARD_KEYS
keys, so one task holds one shard, however many keys there are.

Null urls and urls without "://" have an empty host and path, no rule, and are allowed. Repeated rows are judged
each. Other columns of the input are not read. An empty list makes an empty cascade, which allows everything.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitry.llm.text import ascii_lower, stored

#: Aimed at per shard, so that building one fits a task.
SHARD_KEYS = 250_000
#: Bytes of cascade that are broadcast at once. A larger cascade is applied in as many passes as it needs.
BROADCAST_BYTES = 64 << 20
HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null. A rule "net/fr/" fits host net, all its subdomains, and paths from /fr/."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def digests(keys: list[str]) -> np.ndarray:
    """Two 64-bit numbers of each key; two keys that share both would be seen in building and raise."""
    raw = b"".join(hashlib.blake2b(k.encode(), digest_size=16).digest() for k in keys)
    return np.frombuffer(raw, dtype="<u8").reshape(-1, 2)


def _level_places(hashes: np.ndarray, level: int, bits: int, probes: int) -> np.ndarray:
    """Bit numbers of each key on a level: double hashing, shifted by the level so that levels are independent."""
    with np.errstate(over="ignore"):
        start = hashes[:, 0] ^ (hashes[:, 1] * np.uint64(2 * level + 1))
        start ^= start >> np.uint64(29)
        start *= np.uint64(0xBF58476D1CE4E5B9)
        start ^= start >> np.uint64(32)
        step = (hashes[:, 1] >> np.uint64(7)) | np.uint64(1)
        return (start[:, None] + np.arange(probes, dtype=np.uint64) * step[:, None]) % np.uint64(bits)


class Cascade:
    """Levels of one shard: (bits, probes, bytes) each."""

    def __init__(self, levels: list[tuple[int, int, bytes]]):
        self.levels = [(bits, probes, np.frombuffer(data, dtype=np.uint8)) for bits, probes, data in levels]

    def has(self, hashes: np.ndarray, first: int = 0) -> np.ndarray:
        """Whether listed: the first level that says no decides, by whose turn it is."""
        out = np.zeros(len(hashes), dtype=bool)
        open_rows = np.arange(len(hashes))
        for level, (bits, probes, data) in enumerate(self.levels):
            places = _level_places(hashes[open_rows], level, bits, probes)
            yes = ((data[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
            out[open_rows[~yes]] = level % 2 == 1
            open_rows = open_rows[yes]
        out[open_rows] = len(self.levels) % 2 == 1
        return out


def build_levels(hashes: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """The cascade of a shard's complete keys. Sizes follow the set being encoded and the set to be told from it."""
    inside, outside, levels = hashes[listed], hashes[~listed], []
    both = np.intersect1d(inside.view("V16").ravel(), outside.view("V16").ravel())
    if len(both):
        raise ValueError("two keys share a digest of 128 bits")
    while len(inside):
        if not levels and len(outside):
            rate = min(0.5, max(1e-4, len(inside) / len(outside) / math.sqrt(2)))
        else:
            rate = 0.5
        bits = max(64, math.ceil(len(inside) * 1.44 * math.log2(1 / rate)))
        probes = max(1, round(math.log2(1 / rate)))
        flags = np.zeros(-(-bits // 8) * 8, dtype=np.uint8)
        flags[_level_places(inside, len(levels), bits, probes).ravel()] = 1
        wrong = flags[_level_places(outside, len(levels), bits, probes)].all(axis=1)
        levels.append((bits, probes, np.packbits(flags, bitorder="little").tobytes()))
        inside, outside = outside[wrong], inside
    return levels


def build_cascade(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """shard, level, bits, probes, data, shards: the cascade over `keys` (all keys of the corpus) for `listed`.

    Both inputs have a column key; repeats are allowed, null keys are left out. Keys that only `listed` has belong
    to the universe too.
    """
    marked = keys.select("key", F.lit(False).alias("listed")).union(listed.select("key", F.lit(True).alias("listed")))
    universe = stored(marked.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")), "universe")
    shards = max(1, math.ceil(universe.count() / SHARD_KEYS))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        levels = build_levels(digests(group["key"].tolist()), group["listed"].to_numpy(bool))
        out = pd.DataFrame(levels, columns=["bits", "probes", "data"])
        out.insert(0, "shard", group["shard"].iloc[0])
        out.insert(1, "level", range(len(levels)))
        return out.assign(shards=shards)

    sharded = universe.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return stored(sharded.groupBy("shard").applyInPandas(build, "shard int, level int, bits long, probes int, data binary, shards int"), "cascade")


def add_listed(rows: DataFrame, cascade: DataFrame) -> DataFrame:
    """`rows` with a boolean `listed` for their column key; a null key is not listed.

    Whole rows pass through, so nothing is joined back. Each pass broadcasts at most BROADCAST_BYTES and one shard.
    """
    sized = cascade.groupBy("shard").agg(F.sum(F.length("data")).alias("bytes"), F.first("shards").alias("shards"))
    passes, room = [], 0
    for row in sized.orderBy("shard").toLocalIterator():
        if not passes or row["bytes"] > room:
            passes.append([row["shard"], row["shard"], row["shards"]])
            room = BROADCAST_BYTES
        passes[-1][1] = row["shard"]
        room -= row["bytes"]
    answer = rows.withColumn("listed", F.lit(False))
    for k, (low, high, shards) in enumerate(passes):
        answer = _one_pass(stored(answer, "judged") if k else answer, cascade.where(F.col("shard").between(low, high)), shards)
    return answer


def _one_pass(rows: DataFrame, cascade: DataFrame, shards: int) -> DataFrame:
    levels: dict[int, list] = {}
    for r in cascade.orderBy("shard", "level").collect():
        levels.setdefault(r["shard"], []).append((r["bits"], r["probes"], bytes(r["data"])))
    shared = rows.sparkSession.sparkContext.broadcast(levels)
    names = rows.columns
    at_key, at_listed, width = rows.columns.index("key"), rows.columns.index("listed"), len(rows.columns)

    def judge(batches):
        cascades = {shard: Cascade(found) for shard, found in shared.value.items()}
        for batch in batches:
            listed = batch.column(at_listed).to_numpy(zero_copy_only=False).astype(bool)
            shard = batch.column(width).fill_null(-1).to_numpy(zero_copy_only=False)
            for s in np.unique(shard):
                if s in cascades:
                    at = np.nonzero(shard == s)[0]
                    listed[at] |= cascades[s].has(digests(batch.column(at_key).take(pa.array(at)).to_pylist()))
            columns = [*batch.columns[:width]]
            columns[at_listed] = pa.array(listed)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    shard = F.when(F.col("key").isNotNull(), F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return rows.withColumn("__shard", shard).mapInArrow(judge, rows.schema)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict. The longest rule decides; where none fits, the cascade.

    rules: ("host/path", "allow" or "block"). listed: column key, host and path joined, of urls to block. The
    cascade's universe is the keys of all pages that no rule decides.
    """
    url, rule = F.col("url"), F.col("rule")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("key", F.when(rule.isNull() & (F.col("host") != ""), F.concat("host", "path")))
    cascade = build_cascade(judged.select("key"), listed)
    by_rule = F.lit(None).cast("string")
    for name, verdict in rules:
        by_rule = F.when(rule == name, F.lit(verdict)).otherwise(by_rule)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return add_listed(judged, cascade).select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_list).alias("verdict"))
