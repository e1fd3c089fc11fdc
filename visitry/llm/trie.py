"""Prefix trie of conversations: a z-fast trie, built in batches from hashes of prefixes.

The sequences are conversations, the letters their turns (role and text). A prefix of d turns is named by d and two
64-bit hashes, each the exclusive or of a hash of every turn with its place. The compacted trie has one node for
each place where sequences part or one ends; the node's edge covers the depths (p, e] from its parent's to its own,
and its handle is the prefix whose length is the number in (p, e] that the largest power of two divides.

- locate: a table from handles to nodes is searched by fat binary search. An interval of lengths, first (0, n],
  shrinks around the exit node: where the prefix of the interval's two-fattest length is a handle, to the lengths
  past that node's edge, else to those below. The number of rounds is the logarithm of the longest sequence.
- insert: a batch's sequences leave the trie inside edges or at nodes. The edges are split there, all at once, and
  what is left of the batch is compacted and hung below. Batches double, as what is searched does.
- sums over subtrees: pointers to ancestors are doubled, so a chain of nodes takes a logarithm of its length too.
- expand: an edge becomes a row for each of its depths. All these have the members of the edge's lower node.

No conversation is one task's work: turns are numbered by ordered exchange, and hashes are combined in blocks.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitry.llm.text import stored
from visitry.operators.ordered import number_in_order, running

#: Shares of the sequences, in 16ths, that are inserted one after another.
BATCHES = (1, 5, 10)
#: Turns taken from the first conversation of a family, at most HEAD - 1.
FAMILY, HEAD = 5, 9
#: Edges meet the turns of their sequence in blocks of so many depths.
STRIDE = 64


def fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the largest power of two divides; a < b."""
    return F.call_function("shiftleft", F.call_function("shiftright", b, _log(a, b)), _log(a, b))


def _log(a: Column, b: Column) -> Column:
    return F.length(F.bin(a.bitwiseXOR(b))) - 1


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text in order of turn, nulls first; rows of one turn by role and text.

    Null roles and texts are empty. Rows without a conv_id belong to no conversation and are left out.
    """
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return number_in_order(rows, ["conv_id"], ["turn", "role", "text"], "place").drop("turn")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with borrowed heads: (conv_id, depth from 1, role, text) and (conv_id, n) of every conversation.

    turns: as of turns_of. A conversation begins with the first h turns of the first of its family of FAMILY ids, h
    being a hash of its id, and goes on with its own turns from the h-th on.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD
    sizes = stored(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}), "sizes")
    based = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    plan = sizes.join(based, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    plan = stored(plan.select("conv_id", "base", "own", "h", "taken"), "plan")
    heads = turns.where(F.col("place") < HEAD - 1).withColumnRenamed("conv_id", "base")
    borrowed = plan.select("conv_id", "base", "taken").join(heads, "base").where("place < taken").select("conv_id", (F.col("place") + 1).alias("depth"), "role", "text")
    kept = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("place >= h")
    kept = kept.select("conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "role", "text")
    lengths = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).cast("long").alias("n"))
    return borrowed.unionByName(kept), lengths


def prefixes(sequences: DataFrame) -> DataFrame:
    """c, depth, k, l (the prefix with this turn), up_k, up_l (without), size (bytes of texts up to here), stored.

    sequences: conv_id, depth (1, 2, ...), role, text.
    """
    a, b = F.xxhash64("role", "text"), F.xxhash64("text", "role")
    turn = stored(sequences.select(
        F.col("conv_id").alias("c"), F.col("depth").cast("long").alias("depth"), F.octet_length("text").cast("long").alias("bytes"),
        F.xxhash64(a, b, "depth").alias("x"), F.xxhash64("depth", b, a).alias("y"),
    ), "turns")
    before = running(turn, ["c"], "depth", {"up_k": (F.bit_xor, "x"), "up_l": (F.bit_xor, "y"), "earlier": (F.sum, "bytes")})
    zero = lambda name: F.coalesce(name, F.lit(0).cast("long"))
    return stored(before.select(
        "c", "depth", zero("up_k").bitwiseXOR(F.col("x")).alias("k"), zero("up_l").bitwiseXOR(F.col("y")).alias("l"),
        zero("up_k").alias("up_k"), zero("up_l").alias("up_l"), (zero("earlier") + F.col("bytes")).alias("size"),
    ), "prefixes")


NODE = ("e", "k", "l", "p", "pk", "pl", "rep")


def _root(paths: DataFrame) -> DataFrame:
    return paths.sparkSession.createDataFrame([(0, 0, 0, -1, 0, 0, None)], "e long, k long, l long, p long, pk long, pl long, rep long")


def handles(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes but the root with f, hk, hl (handle) and ck, cl (the prefix one turn below the parent)."""
    edges = nodes.where("e > 0").withColumns({"f": fattest(F.col("p"), F.col("e")), "first": F.col("p") + 1})
    handle = paths.select(F.col("c").alias("rep"), F.col("depth").alias("f"), F.col("k").alias("hk"), F.col("l").alias("hl"))
    first = paths.select(F.col("c").alias("rep"), F.col("depth").alias("first"), F.col("k").alias("ck"), F.col("l").alias("cl"))
    return stored(edges.join(handle, ["rep", "f"]).join(first, ["rep", "first"]).drop("first"), "handles")


def locate(batch: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """c, n, e, k, l, p, pk, pl, rep of the exit node, m: the turns that the sequence shares with the trie.

    batch: c, n. m lies in (p, e], or is 0 at the root.
    """
    table = handles(nodes, paths)
    exits = table.select(F.col("f"), F.col("hk"), F.col("hl"), *(F.col(c).alias(f"x_{c}") for c in NODE))
    none = {c: F.lit({"p": -1}.get(c, 0) if c != "rep" else None).cast("long") for c in NODE}
    state = stored(batch.select("c", "n", F.lit(0).cast("long").alias("a"), F.col("n").alias("b"), F.lit(0).cast("long").alias("low"), *(v.alias(c) for c, v in none.items())), "state")
    done = state.where("a >= b")
    while True:
        active = state.where("a < b")
        if active.isEmpty():
            break
        probe = active.withColumn("f", fattest(F.col("a"), F.col("b"))).join(
            paths.select("c", F.col("depth").alias("f"), F.col("k").alias("hk"), F.col("l").alias("hl")), ["c", "f"]
        )
        met = probe.join(exits, ["f", "hk", "hl"], "left")
        hit = F.col("x_e").isNotNull()
        state = stored(met.select(
            "c", "n", F.when(hit, F.col("x_e")).otherwise(F.col("a")).alias("a"), F.when(hit, F.col("b")).otherwise(F.col("f") - 1).alias("b"),
            F.when(hit, F.col("f")).otherwise(F.col("low")).alias("low"), *(F.when(hit, F.col(f"x_{c}")).otherwise(F.col(c)).alias(c) for c in NODE),
        ), "state")
        done = done.union(state.where("a >= b"))
    # the deepest node whose handle fits; if all its edge does, the exit may lie on an edge below
    at = paths.select("c", F.col("depth").alias("e"), F.col("k").alias("s_k"), F.col("l").alias("s_l"))
    below = paths.select("c", (F.col("depth") - 1).alias("e"), F.col("k").alias("ck"), F.col("l").alias("cl"))
    child = table.select(F.col("p").alias("e"), "ck", "cl", *(F.col(c).alias(f"x_{c}") for c in NODE))
    whole = (F.col("e") == 0) | ((F.col("s_k") == F.col("k")) & (F.col("s_l") == F.col("l")))
    full = done.join(at, ["c", "e"], "left").withColumn("whole", F.coalesce(whole, F.lit(False))).join(below, ["c", "e"], "left")
    full = full.join(child, ["e", "ck", "cl"], "left")
    deeper = F.col("whole") & F.col("x_e").isNotNull()
    low = F.when(deeper, F.col("e") + 1).when(F.col("whole"), F.col("e")).otherwise(F.col("low"))
    found = stored(full.select("c", "n", low.alias("low"), *(F.when(deeper, F.col(f"x_{c}")).otherwise(F.col(c)).alias(c) for c in NODE)), "found")
    # on the exit edge, prefixes agree up to a depth and differ from there on: the depth is a count
    own = paths.select("c", "depth", "k", "l")
    theirs = paths.select(F.col("c").alias("rep"), "depth", "k", "l")
    edge = found.select("c", "low", F.least("e", "n").alias("high"), "rep").where("low < high").join(own, "c").where("depth > low AND depth <= high")
    agreed = edge.join(theirs, ["rep", "depth", "k", "l"]).groupBy("c").agg(F.count(F.lit(1)).alias("more"))
    return stored(found.join(agreed, "c", "left").select("c", "n", *NODE, (F.col("low") + F.coalesce("more", F.lit(0))).alias("m")), "located")


def insert(located: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """The nodes of the trie that also holds the located sequences."""
    keys = paths.select("c", F.col("depth").alias("m"), F.col("k").alias("mk"), F.col("l").alias("ml"))
    left = located.join(keys, ["c", "m"], "left").withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("mk", "ml")})
    left = stored(left, "left")
    # split edges at all places where sequences leave them
    cuts = left.where("m > p AND m < e").select("e", "k", "l", "p", "pk", "pl", "rep", "m", "mk", "ml").groupBy("e", "k", "l", "m", "mk", "ml").agg(*(F.first(c).alias(c) for c in ("p", "pk", "pl", "rep")))
    cuts = stored(cuts, "cuts")
    above = Window.partitionBy("e", "k", "l").orderBy("m")  # as many rows as the edge has depths, at most
    parts = cuts.select(
        F.col("m").alias("e"), F.col("mk").alias("k"), F.col("ml").alias("l"),
        *(F.coalesce(F.lag(m).over(above), F.col(p)).alias(p) for m, p in (("m", "p"), ("mk", "pk"), ("ml", "pl"))), "rep",
    )
    lowest = cuts.groupBy("e", "k", "l").agg(F.max(F.struct("m", "mk", "ml")).alias("cut"))
    old = nodes.join(lowest, ["e", "k", "l"], "left").select(
        "e", "k", "l", F.coalesce("cut.m", "p").alias("p"), F.coalesce("cut.mk", "pk").alias("pk"), F.coalesce("cut.ml", "pl").alias("pl"), "rep"
    )
    # compact what is left of the sequences
    ends = left.select("c", "n", "m", "mk", "ml")
    rest = paths.join(ends, "c").where("depth > m")
    places = stored(rest.groupBy("depth", "k", "l", "up_k", "up_l").agg(F.min("c").alias("rep"), F.bool_or(F.col("depth") == F.col("n")).alias("ends")), "places")
    kids = places.groupBy((F.col("depth") - 1).alias("depth"), F.col("up_k").alias("k"), F.col("up_l").alias("l")).agg(F.count(F.lit(1)).alias("kids"))
    explicit = stored(places.join(kids, ["depth", "k", "l"], "left").where("ends OR kids > 1").select("depth", "k", "l", "rep"), "explicit")
    on_way = stored(rest.select("c", "depth", "k", "l", "m", "mk", "ml").join(explicit, ["depth", "k", "l"]).join(explicit.select(F.col("rep").alias("c")).distinct(), "c", "left_semi").withColumn("at", F.struct("depth", "k", "l")), "on_way")
    nearest = running(on_way, ["c"], "depth", {"up": (F.max, "at")}).where("c = rep")
    fresh = nearest.select(
        F.col("depth").alias("e"), "k", "l", F.coalesce("up.depth", "m").alias("p"), F.coalesce("up.k", "mk").alias("pk"), F.coalesce("up.l", "ml").alias("pl"), "rep"
    )
    return stored(old.unionByName(parts).unionByName(fresh), "nodes")


def build(lengths: DataFrame, paths: DataFrame) -> DataFrame:
    """e, k, l, p, pk, pl, rep of every node of the compacted trie; lengths: c, n."""
    nodes, start = _root(paths), 0
    slot = F.pmod(F.xxhash64("c"), F.lit(sum(BATCHES)))
    for share in BATCHES:
        batch = lengths.where((slot >= start) & (slot < start + share))
        if start:
            located = locate(batch, nodes, paths)
        else:
            located = batch.select("c", "n", *(F.lit(v).cast("long").alias(c) for c, v in zip(NODE, (0, 0, 0, -1, 0, 0, None), strict=True)), F.lit(0).cast("long").alias("m"))
        nodes = insert(located, nodes, paths)
        start += share
    return nodes


def subtree_sums(nodes: DataFrame, sums: list[str], least: str) -> DataFrame:
    """nodes with each of `sums` summed, and `least` minimised, over the subtree of each node.

    nodes: e, k, l, p, pk, pl. After round i every node holds what lies less than 2^i edges below, and a pointer to
    the node 2^i edges above, or none.
    """
    state = stored(nodes.select("e", "k", "l", "p", "pk", "pl", *sums, least), "sums")
    up = ["p", "pk", "pl"]
    while True:
        live = state.where("p >= 0")
        if live.isEmpty():
            return state
        given = live.groupBy(*up).agg(*(F.sum(c).alias(f"+{c}") for c in sums), F.min(least).alias(f"+{least}")).select(F.col("p").alias("e"), F.col("pk").alias("k"), F.col("pl").alias("l"), *(f"+{c}" for c in (*sums, least)))
        added = state.join(given, ["e", "k", "l"], "left").select(
            "e", "k", "l", *up, *(F.col(c) + F.coalesce(f"+{c}", F.lit(0)).alias(c) for c in sums), F.least(least, f"+{least}").alias(least)
        ).toDF("e", "k", "l", *up, *sums, least)
        added = stored(added, "sums")
        jump = added.select(F.col("e").alias("p"), F.col("k").alias("pk"), F.col("l").alias("pl"), F.col("p").alias("q"), F.col("pk").alias("qk"), F.col("pl").alias("ql"))
        moved = added.where("p >= 0").join(jump, up).select("e", "k", "l", F.col("q").alias("p"), F.col("qk").alias("pk"), F.col("ql").alias("pl"), *sums, least)
        state = stored(moved.union(added.where("p < 0")), "sums")


def _id_lists(ends: DataFrame) -> DataFrame:
    """depth, k, l, sha256 of the ascending decimal ids c, comma-joined. A node's ids are hashed as they stream past."""

    def run(batches):
        now, digest = None, None
        for batch in batches:
            out = []
            for *key, c in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if key != now:
                    if now is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(str(c).encode())
                else:
                    digest.update(b",%d" % c)
            yield listed(out)
        if now is not None:
            yield listed([(*now, digest.hexdigest())])

    def listed(out):
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["depth", "k", "l", "sha"])

    sorted_ends = ends.select("e", "k", "l", "c").repartition("e", "k", "l").sortWithinPartitions("e", "k", "l", "c")
    return sorted_ends.mapInArrow(run, "depth long, k long, l long, sha string")


def trie_nodes(sequences: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every distinct prefix of the sequences as a node, with sums over its subtree.

    sequences: conv_id, depth (1, 2, ...), role, text; lengths: conv_id, n (0: no turns). Returns conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256; repeated sequences are
    members of the same nodes. Without any conversation there is no node, not even a root.
    """
    paths = prefixes(sequences)
    lengths = stored(lengths.select(F.col("conv_id").alias("c"), "n"), "lengths")
    nodes = stored(build(lengths, paths), "trie")
    key = paths.select("c", F.col("depth").alias("n"), "k", "l", "size")
    zero = F.lit(0).cast("long")
    ends = lengths.join(key, ["c", "n"], "left").select("c", F.col("n").alias("e"), *(F.coalesce(x, zero).alias(x) for x in ("k", "l", "size")))
    ends = stored(ends, "ends")
    here = ends.groupBy("e", "k", "l").agg(F.count(F.lit(1)).alias("convs"), F.min("c").alias("least"), F.sum("size").alias("end_bytes"))
    kids = nodes.where("p >= 0").groupBy(F.col("p").alias("e"), F.col("pk").alias("k"), F.col("pl").alias("l")).agg(F.count(F.lit(1)).alias("kids"))
    bottom = paths.select(F.col("c").alias("rep"), F.col("depth").alias("e"), F.col("size").alias("bottom"))
    top = paths.select(F.col("c").alias("rep"), F.col("depth").alias("p"), F.col("size").alias("top"))
    full = nodes.join(bottom, ["rep", "e"], "left").join(top, ["rep", "p"], "left").join(here, ["e", "k", "l"], "left").join(kids, ["e", "k", "l"], "left")
    full = stored(full.select(
        *NODE, *(F.coalesce(x, zero).alias(x) for x in ("top", "convs", "end_bytes", "kids")), "least",
        F.when(F.col("kids").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
        (F.coalesce("bottom", zero) - F.coalesce("top", zero)).alias("edge_bytes"),
    ), "full")
    sums = stored(subtree_sums(full, ["convs", "end_bytes", "leaves", "edge_bytes"], "least").drop("p", "pk", "pl"), "subtrees")
    known = full.select(*NODE, "kids", "top").join(sums, ["e", "k", "l"])
    parent = sums.select(F.col("e").alias("p"), F.col("k").alias("pk"), F.col("l").alias("pl"), F.col("least").alias("parent_least"))
    known = stored(known.join(parent, ["p", "pk", "pl"], "left"), "known")
    # a row for each depth of an edge: a sequence's edges do not overlap, so each of its depths meets one edge
    block = lambda c: F.floor(c / STRIDE)
    edges = known.where("e > 0").select("*", F.explode(F.sequence(block(F.col("p") + 1), block(F.col("e")))).alias("block"))
    along = paths.select(F.col("c").alias("rep"), block(F.col("depth")).alias("block"), "depth", F.col("k").alias("dk"), F.col("l").alias("dl"), F.col("up_k"), "size")
    rows = edges.join(along, ["rep", "block"]).where("depth > p AND depth <= e")
    up_size = paths.select(F.col("c").alias("rep"), (F.col("depth") + 1).alias("depth"), F.col("size").alias("up_size"))
    rows = rows.join(up_size, ["rep", "depth"], "left").withColumn("up_size", F.coalesce("up_size", zero))
    last = F.col("depth") == F.col("e")
    every = F.col("end_bytes") - F.col("convs") * F.col("up_size")  # bytes of all members' turns from this depth on
    once = F.col("edge_bytes") - (F.col("up_size") - F.col("top"))  # bytes of the subtree's turns, each node's once
    columns = [
        F.col("least").alias("conv_id"), "depth", F.when(F.col("depth") - 1 == F.col("p"), F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("convs").alias("n_convs"), F.when(last, F.col("kids")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (every - once).alias("saved_tokens"), F.col("dk").alias("k"), F.col("dl").alias("l"),
    ]
    root = known.where("e = 0 AND convs > 0").select("*", F.lit(0).cast("long").alias("depth"), zero.alias("up_size"), F.col("k").alias("dk"), F.col("l").alias("dl"))
    out = rows.select(*columns).unionByName(root.select(*columns))
    out = out.join(_id_lists(ends), ["depth", "k", "l"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """trie_nodes of the conversations with borrowed heads (rebuild)."""
    sequences, lengths = rebuild(stored(turns_of(conversations), "numbered"))
    return trie_nodes(sequences, lengths)
