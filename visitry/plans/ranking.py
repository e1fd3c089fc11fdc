"""Item ranking learnt from pairs: a member's taken item should score above drawn ones.

A member or item is the sum of the embeddings of its features (its own id, its attribute token, any others), an item
has a bias besides. Pairs are dealt into cells by member. In an epoch every cell takes the vectors of its members and
items and of a pool of drawn items, runs through its pairs in small steps, and hands back how far each vector moved;
moves are averaged, by the steps behind them, per feature. Tables of embeddings stay in partitions; the driver sees
the loss of each epoch, one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.ordered import stored
from ..operators.products import Best, best_by_product
from ..operators.sets import union_all
from ..operators.windows import number_rows
from .hybrid import FACTORS, TOP_ITEMS

#: Pairs of a cell, items drawn for a cell and epoch, pairs of a step.
CELL_PAIRS, POOL, STEP = 200_000, 4096, 256
MOVES = "side string, id string, n double, loss double, bias double, move array<double>"


@dataclass
class Ranking:
    """users (member_id, features), items (item_id, features): their inner product is the score. losses: one per epoch."""

    users: DataFrame
    items: DataFrame
    losses: list[float]


def _entities(df: DataFrame, key: str, side: str, tokens: Sequence[str]) -> DataFrame:
    """(side, id, feature): one row per feature of every key; null tokens are no feature."""
    own = F.concat(F.lit(f"{side}:"), F.col(key).cast("string"))
    named = [F.concat(F.lit(f"{side}.{t}:"), F.col(t).cast("string")) for t in tokens]
    rows = df.where(F.col(key).isNotNull()).select(
        F.lit(side).alias("side"), F.col(key).cast("string").alias("id"), F.explode(F.array(own, *named)).alias("feature")
    )
    return rows.where("feature IS NOT NULL").distinct()


def _cells(pairs: DataFrame, size: int) -> DataFrame:
    """pairs with `cell`: about `size` pairs each, by member; a crowded cell is cut by pair."""
    many = max(1, math.ceil(pairs.count() / size))
    dealt = pairs.withColumn("_base", F.pmod(F.xxhash64("u"), F.lit(many)))
    slices = dealt.groupBy("_base").agg(F.ceil(F.count("*") / size).alias("_slices"))
    cut = F.pmod(F.xxhash64("u", "i"), F.col("_slices"))
    return dealt.join(slices, "_base").select("u", "i", "w", (cut * many + F.col("_base")).cast("long").alias("cell"))


def _start(features: DataFrame, rank: int, seed: int) -> DataFrame:
    """(feature, v, b): small values drawn from a hash of the feature, equal on every run."""
    drawn = F.transform(F.sequence(F.lit(1), F.lit(rank)), lambda k: (F.pmod(F.xxhash64("feature", k, F.lit(seed)), F.lit(1 << 20)) / (1 << 20) - 0.5) / rank)
    return features.select("feature", drawn.alias("v"), F.lit(0.0).alias("b"))


def _summed(entities: DataFrame, table: DataFrame, rank: int, keys: Sequence[str]) -> DataFrame:
    """(keys, v, b): embeddings of the features summed; zeros for those without a known feature."""
    rows = entities.join(table, "feature", "left").groupBy(*keys).agg(
        *(F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(rank)), F.sum("b").alias("b")
    )
    whole = F.array(*(F.coalesce(F.col(f"v{k}"), F.lit(0.0)) for k in range(rank)))
    return rows.select(*keys, whole.alias("v"), F.coalesce("b", F.lit(0.0)).alias("b"))


def train_cell(u: np.ndarray, i: np.ndarray, w: np.ndarray, pool: np.ndarray, vectors: tuple[np.ndarray, np.ndarray, np.ndarray], rng, draws: int, rate: float, decay: float, passes: int = 1) -> tuple[float, np.ndarray, np.ndarray]:
    """Runs through the pairs (u, i) and changes vectors (members, items, biases). Returns the loss and the steps of each row.

    Of `draws` items from the pool that the member has not taken, the one that scores highest is the pair's opponent.
    """
    of_user, of_item, bias = vectors
    taken = np.sort(u * len(of_item) + i)
    square = [np.full(len(x), 0.1) for x in vectors]
    steps, loss = [np.zeros(len(of_user)), np.zeros(len(of_item))], 0.0
    order = np.concatenate([rng.permutation(len(u)) for _ in range(passes)])
    for start in range(0, len(order) if len(pool) else 0, STEP):
        at = order[start : start + STEP]
        a, b, weight = u[at], i[at], w[at]
        others = pool[rng.integers(len(pool), size=(len(at), draws))]
        code = a[:, None] * len(of_item) + others
        place = np.minimum(np.searchsorted(taken, code), len(taken) - 1)
        score = np.where(taken[place] == code, -np.inf, np.einsum("nk,ndk->nd", of_user[a], of_item[others]) + bias[others])
        best = score.argmax(axis=1)
        rows = np.arange(len(at))
        good = np.isfinite(score[rows, best])
        a, b, weight, c = a[good], b[good], weight[good], others[rows, best][good]
        ahead = np.einsum("nk,nk->n", of_user[a], of_item[b]) + bias[b] - score[rows, best][good]
        loss += float((weight * np.logaddexp(0, -ahead)).sum())
        pull = weight / (1 + np.exp(np.clip(ahead, -50, 50)))
        moves = [
            (0, a, pull[:, None] * (of_item[b] - of_item[c]) - decay * of_user[a]),
            (1, b, pull[:, None] * of_user[a] - decay * of_item[b]), (1, c, -pull[:, None] * of_user[a] - decay * of_item[c]),
            (2, b, pull), (2, c, -pull),
        ]
        for side, row, move in moves:
            np.add.at(square[side], row, (move**2).mean(axis=1) if move.ndim > 1 else move**2)
        for side, row, move in moves:
            pace = rate / np.sqrt(square[side][row])
            if move.ndim > 1:  # by places of numbers, as adding whole rows is many times slower
                wide = move.shape[1]
                np.add.at(vectors[side].reshape(-1), (row[:, None] * wide + np.arange(wide)).ravel(), (pace[:, None] * move).ravel())
            else:
                np.add.at(vectors[side], row, pace * move)
        np.add.at(steps[0], a, 1)
        np.add.at(steps[1], np.concatenate([b, c]), 1)
    return loss, *steps


def _trainer(rank: int, seed: int, epoch: int, draws: int, rate: float, decay: float, passes: int):
    def run(pairs: pa.Table, held: pa.Table) -> Iterator[pa.RecordBatch]:
        # in one order on every run, as the steps depend on it
        rows, known = pairs.sort_by([("u", "ascending"), ("i", "ascending")]), held.sort_by([("side", "ascending"), ("id", "ascending")])
        sides = {s: known.filter(pc.equal(known["side"], s)) for s in "ui"}
        of = {s: np.array(t["v"].combine_chunks().flatten()).reshape(-1, rank) for s, t in sides.items()}
        before = of["u"].copy(), of["i"].copy(), np.array(sides["i"]["b"])
        now = tuple(x.copy() for x in before)
        index = [pc.index_in(rows[s], value_set=sides[s]["id"].combine_chunks()).to_numpy().astype(np.int64) for s in "ui"]
        pool = np.nonzero(sides["i"]["pool"].to_numpy())[0]
        rng = np.random.default_rng([seed, epoch, rows["cell"][0].as_py()])
        loss, by_user, by_item = train_cell(*index, rows["w"].to_numpy(), pool, now, rng, draws, rate, decay, passes)
        names = [f.split()[0] for f in MOVES.split(", ")]
        for s, steps, move, bias in (("u", by_user, now[0] - before[0], np.zeros(len(by_user))), ("i", by_item, now[1] - before[1], now[2] - before[2])):
            moved = np.nonzero(steps)[0]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(moved) + 1, dtype=np.int32) * rank), pa.array(move[moved].ravel()))
            ids = sides[s]["id"].combine_chunks().take(pa.array(moved))
            columns = [pa.array([s] * len(moved), pa.string()), ids, pa.array(steps[moved]), pa.nulls(len(moved), pa.float64()), pa.array(bias[moved]), lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        total = [pa.array(["loss"]), pa.nulls(1, pa.string()), pa.array([float(by_user.sum())]), pa.array([loss]), pa.nulls(1, pa.float64()), pa.nulls(1, pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(total, names=names)

    return lambda pairs, held: pa.Table.from_batches(run(pairs, held))


def fit_ranking(
    interactions: DataFrame, users: DataFrame, items: DataFrame, rank: int = FACTORS, epochs: int = 10, draws: int = 5, rate: float = 0.1,
    decay: float = 1e-4, passes: int = 1, seed: int = 42, tokens: Sequence[str] = ("token",), cell_pairs: int = CELL_PAIRS,
) -> Ranking:
    """Fits (member_id, item_id, ratings) with the attributes `tokens` of users (member_id, ...) and items (item_id, ...).

    Pairs weigh 1 + log of their rating (1 if null or below 1); pairs with a null id, or an item that is not in `items`,
    are left out, repeated pairs count once with their greatest rating. Members or items that nothing is known of get
    the sum of the features they have; a member without any known feature scores items by their biases. Moves of cells
    are averaged, so an epoch goes as far as one cell does: `passes` runs of a cell through its pairs make up for few
    pairs in a cell.
    """
    catalog = number_rows(items.select(F.col("item_id").cast("string").alias("id")).dropna().distinct(), ["id"], "no")
    catalog = stored(catalog, "ranking_items")
    n_items = catalog.count()
    weight = 1 + F.log(F.greatest(F.coalesce(F.max("ratings"), F.lit(1)), F.lit(1)).cast("double"))
    pairs = interactions.dropna(subset=["member_id", "item_id"]).groupBy(F.col("member_id").cast("string").alias("u"), F.col("item_id").cast("string").alias("i"))
    pairs = pairs.agg(weight.alias("w")).join(catalog.select(F.col("id").alias("i")), "i", "left_semi")
    pairs = stored(_cells(stored(pairs, "ranking_pairs"), cell_pairs), "ranking_cells")

    def of(c: str) -> DataFrame:
        return pairs.select("cell", F.lit(c).alias("side"), F.col(c).alias("id"), F.lit(False).alias("pool")).distinct()

    needed = stored(union_all(of("u"), of("i")), "ranking_needed")
    everyone, everything = _entities(users, "member_id", "u", tokens), _entities(items, "item_id", "i", tokens)
    # members of pairs who are not in `users` have their own feature only
    met = _entities(pairs.select(F.col("u").alias("member_id")), "member_id", "u", ())
    known = everyone.join(met.select("id"), "id", "left_semi").select("side", "id", "feature").union(met).distinct()
    entities = stored(known.union(everything), "ranking_entities")
    parts = entities.groupBy("side", "id").agg(F.count("*").alias("parts"))
    table = stored(_start(entities.select("feature").distinct(), rank, seed), "ranking_start")
    cells, losses = pairs.select("cell").distinct(), []
    for epoch in range(epochs if n_items else 0):
        drawn = cells.select("cell", F.explode(F.sequence(F.lit(1), F.lit(POOL))).alias("_k"))
        number = F.pmod(F.xxhash64("cell", "_k", F.lit(seed), F.lit(epoch)), F.lit(n_items)) + 1
        pool = drawn.select("cell", number.alias("no")).distinct().join(catalog, "no")
        pool = pool.select("cell", F.lit("i").alias("side"), "id", F.lit(True).alias("pool"))
        wanted = needed.union(pool).groupBy("cell", "side", "id").agg(F.bool_or("pool").alias("pool"))
        held = wanted.join(_summed(entities, table, rank, ["side", "id"]), ["side", "id"]).select("cell", "side", "id", "pool", "v", "b")
        run = _trainer(rank, seed, epoch, draws, rate / math.sqrt(epoch + 1), decay, passes)
        moved = stored(pairs.groupBy("cell").cogroup(held.groupBy("cell")).applyInArrow(run, MOVES), "ranking_moves")
        told = moved.where("side = 'loss'").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")).first()
        if not told["n"]:
            break
        losses.append(told["loss"] / told["n"])
        shared = moved.where("side <> 'loss'").join(parts, ["side", "id"])
        shared = shared.join(entities, ["side", "id"]).groupBy("feature").agg(
            *(_mean(F.col("move")[k] / F.col("parts")).alias(f"m{k}") for k in range(rank)), _mean(F.col("bias") / F.col("parts")).alias("mb")
        )
        after = [F.col("v")[k] + F.coalesce(F.col(f"m{k}"), F.lit(0.0)) for k in range(rank)]
        table = table.join(shared, "feature", "left").select("feature", F.array(*after).alias("v"), (F.col("b") + F.coalesce("mb", F.lit(0.0))).alias("b"))
        table = stored(table, "ranking_table")
    kinds = dict(users.dtypes)["member_id"], dict(items.dtypes)["item_id"]
    reached = table.join(entities.select("feature").distinct(), "feature", "left_semi")
    user_rows = _summed(everyone.union(met).distinct(), reached, rank, ["id"])
    item_rows = _summed(everything, reached, rank, ["id"])
    return Ranking(
        stored(user_rows.select(F.col("id").cast(kinds[0]).alias("member_id"), F.concat("v", F.array(F.lit(1.0))).alias("features")), "ranking_users"),
        stored(item_rows.select(F.col("id").cast(kinds[1]).alias("item_id"), F.concat("v", F.array("b")).alias("features")), "ranking_catalog"),
        losses,
    )


def _mean(move: Column) -> Column:
    return F.sum(move * F.col("n")) / F.sum("n")


def ranking_recommend(model: Ranking, k: int = TOP_ITEMS, taken: DataFrame | None = None) -> Best:
    """The k items that score highest for every member: rows (member_id, item_id, score, rank); pairs of `taken` left out."""
    return best_by_product(model.users, model.items, k, taken=taken)


def ranking_audience(model: Ranking, n: int) -> Best:
    """The n members who score highest for every item: rows (item_id, member_id, score, rank)."""
    return best_by_product(model.items, model.users, n, "item_id", "member_id")
