"""Item recommendations from weighted interactions and attribute tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from ..operators.aggregates import pivot_onehot
from ..operators.products import best_by_product
from ..operators.reshape import ranks_to_columns
from ..operators.sets import union_all
from ..operators.windows import number_rows, topn_per_group
from ..session import ensure_checkpoint_dir

# Weight per kind of interaction, items recommended, latent factors.
WEIGHTS = {"booking": 3, "reserve_click": 2, "case_click": 1, "line_label": 1}
TOP_ITEMS, FACTORS = 5, 50
UNKNOWN, UNKNOWN_AGE = "unknown", -1


def weighted_interactions(parts: Sequence[tuple[DataFrame, int]], items: DataFrame) -> DataFrame:
    """(member_id, item, ratings): weighted times per pair, for items of the catalog.

    Each part holds (member_id, item, times). All parts share one aggregate, and
    the catalog meets the pairs, not the events.
    """
    weighted = [
        df.where(F.col("member_id").isNotNull()).select(
            "member_id", "item", (F.col("times") * w).alias("ratings")
        )
        for df, w in parts
    ]
    pairs = union_all(*weighted).groupBy("member_id", "item").agg(
        F.sum("ratings").cast("bigint").alias("ratings")
    )
    known = pairs.join(items.select("item").distinct(), "item", "left_semi")
    return known.select("member_id", "item", "ratings")


def item_index(items: DataFrame, item: str = "item", out: str = "item_id") -> DataFrame:
    """Dense item ids, equal on every run."""
    return number_rows(items.select(item).where(F.col(item).isNotNull()).distinct(), [item], out)


def user_features(
    member: DataFrame, tags: DataFrame, columns: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Attributes without gaps, and one count column per tag of ``values`` (0 where absent).

    ``tags``: (member_id, tag). Unknown age is -1, other unknowns ``unknown``.
    """
    matrix = pivot_onehot(tags, "member_id", "tag", values)
    attributes = member.select("member_id", *columns)
    text = [c for c, kind in attributes.dtypes if kind == "string"]
    filled = attributes.na.fill(UNKNOWN, subset=text)
    if "age" in columns:
        filled = filled.na.fill({"age": UNKNOWN_AGE})
    counts = [c for c in matrix.columns if c != "member_id"]
    return filled.join(matrix, "member_id", "left").na.fill(0, subset=counts)


def feature_token(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, token): the whole attribute tuple as one category."""
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(key, F.sha2(text, 256).alias("token"))


def _best(scores: DataFrame, k: int) -> DataFrame:
    return topn_per_group(scores, ["member_id"], [F.desc("score"), F.asc("item_id")], k)


def hybrid_recommend(
    interactions: DataFrame,
    users: DataFrame,
    items: DataFrame,
    k: int = TOP_ITEMS,
    rank: int = FACTORS,
    **params,
) -> DataFrame:
    """Best k items (member_id, item_id, score, rank) for every user with a token.

    Implicit factorisation of (member_id, item_id, ratings), int ids; ``users``
    (member_id, token) and ``items`` (item_id, token) place those without
    interactions: a new item scores like the known items of its token, a new
    user gets the mean scores of its token's users, else of everybody.
    """
    return recommend_with_means(fit_implicit(interactions, rank, **params), users, items, k)


def fit_implicit(interactions: DataFrame, rank: int = FACTORS, **params) -> ALSModel:
    """Implicit factorisation of (member_id, item_id, ratings), int ids."""
    ensure_checkpoint_dir(interactions.sparkSession)
    blocks = max(10, interactions.sparkSession.sparkContext.defaultParallelism)
    settings = {"numUserBlocks": blocks, "numItemBlocks": blocks, **params}
    return ALS(
        userCol="member_id", itemCol="item_id", ratingCol="ratings", implicitPrefs=True,
        rank=rank, seed=42, **settings,
    ).fit(interactions)


def recommend_with_means(model: ALSModel, users: DataFrame, items: DataFrame, k: int = TOP_ITEMS) -> DataFrame:
    """``hybrid_recommend`` of a fitted model.

    Scores are linear in the factors, so the mean score of a token is the score of its mean factors: these are
    further items and users, and all are scored over the whole catalog before anything is ranked.
    """
    ensure_checkpoint_dir(users.sparkSession)
    known_users = model.userFactors.withColumnRenamed("id", "member_id")
    known_items = model.itemFactors.withColumnRenamed("id", "item_id")

    # new items of one token tie, so one mean stands for them and only the first k of each can be among a best k
    cold = items.join(known_items, "item_id", "left_anti")
    cold = topn_per_group(cold, ["token"], [F.asc("item_id")], k).drop("rank")
    lent = _mean_factors(known_items.join(items.distinct(), "item_id"), model.rank, "token")
    lent = lent.join(cold.select("token").distinct(), "token", "left_semi")
    scored = known_items.select("item_id", F.lit(None).cast("string").alias("token"), "features").unionByName(
        lent.select(F.lit(None).cast("int").alias("item_id"), "token", "features")
    )
    scored = number_rows(scored, ["token", "item_id"], "id").checkpoint()
    standing = scored.where(F.col("item_id").isNotNull()).select("id", F.col("item_id").alias("_item"))
    standing = standing.unionByName(
        scored.where(F.col("item_id").isNull()).join(cold, "token").select("id", cold["item_id"].alias("_item"))
    )

    def best(factors: DataFrame, key: str) -> DataFrame:
        """(key, item_id, score): the best k items of every (id, features)."""
        listed = best_by_product(factors.withColumnRenamed("id", key), scored.select("id", "features"), k, key, "id").rows
        pairs = listed.select(key, "id", "score").join(standing, "id").select(key, F.col("_item").alias("item_id"), "score")
        return topn_per_group(pairs, [key], [F.desc("score"), F.asc("item_id")], k).drop("rank")

    known = best(model.userFactors, "member_id")

    newcomers = users.join(known_users, "member_id", "left_anti")
    by_token = _mean_factors(known_users.join(users.distinct(), "member_id"), model.rank, "token")
    by_token = by_token.join(newcomers.select("token").distinct(), "token", "left_semi")
    overall = _mean_factors(known_users, model.rank).where("features[0] IS NOT NULL")
    groups = by_token.unionByName(overall.withColumn("token", F.lit(None).cast("string")))
    groups = number_rows(groups, ["token"], "id").checkpoint()
    lists = best(groups.select(F.col("id").cast("int"), "features"), "group").checkpoint()
    groups = groups.select("token", F.col("id").cast("int").alias("group"))
    everybody = groups.where(F.col("token").isNull()).select("group").scalar()  # one row
    placed = newcomers.join(groups, "token", "left").select("member_id", F.coalesce("group", everybody).alias("group"))
    filled = placed.join(lists, "group").select("member_id", "item_id", "score")
    return _best(known.unionByName(filled), k)


def _mean_factors(factors: DataFrame, rank: int, *keys: str) -> DataFrame:
    """(keys, features): mean factors of each group."""
    means = F.array(*(F.avg(F.col("features")[i]).cast("float") for i in range(rank)))
    return factors.groupBy(*keys).agg(means.alias("features"))


def topk_items_wide(scores: DataFrame, names: DataFrame, k: int = TOP_ITEMS) -> DataFrame:
    """One row per member with the names of its k best items.

    ``scores``: (member_id, item_id, score); ``names``: (item_id, item).
    """
    best = _best(scores, k).join(names, "item_id")
    return ranks_to_columns(best, ["member_id"], "rank", k, {"item": "case_name"})


def users_for_item(scores: DataFrame, names: DataFrame, min_score: float = 0.0) -> DataFrame:
    """Members per item with a score above ``min_score``, best first."""
    liked = scores.where(F.col("score") > min_score).join(names, "item_id")
    return liked.select("item", "member_id", "score").orderBy(
        F.desc("item"), F.desc("score"), F.asc("member_id")
    )
