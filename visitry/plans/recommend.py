"""Product recommendations: ratings, matrix factorisation, blending, fallbacks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import age_bucket, exclude_product_code
from ..operators.aggregates import quintile_rating
from ..operators.joins import join_lookup
from ..operators.ordered import stored
from ..operators.products import best_by_product
from ..operators.reshape import ranks_to_columns
from ..operators.sets import union_all
from ..operators.windows import cohort_id, number_rows, topk_global, topn_per_group
from ..session import ensure_checkpoint_dir

# Weights of the blend, ranks kept, event counted as a click.
BLEND_WEIGHTS = {"purchase": 0.7, "click": 0.3}
OWN_RANKS, COHORT_RANKS = 10, 5
CLICK_EVENT = "select_product"
COHORT_COLUMNS = ("gender", "age", "marriage", "birth_month", "region_sort", "level")
MISSING = "無資料"
# Hyperparameters searched.
ALS_GRID = {"rank": (10, 100, 2000), "regParam": (0.001, 0.01, 0.1)}
# Numbers that a block of a fit holds at most: its ratings, about ten for each, and the factors these need.
BLOCK_NUMBERS = 40_000_000
# Numbers that are shuffled before a checkpoint lets go of them.
SHUFFLED_NUMBERS = 200_000_000


def interactions_purchase(purchase: DataFrame) -> DataFrame:
    """(member_id, product_id, total_count): pieces bought, coded products left out. Ids stay as they are."""
    known = purchase.where(
        F.col("member_id").isNotNull() & exclude_product_code(F.col("product_id"), "prefix")
    )
    return known.groupBy("member_id", "product_id").agg(F.sum("count").cast("bigint").alias("total_count"))


def interactions_click(
    web: DataFrame, cid_map: DataFrame, brand: DataFrame, event: str = CLICK_EVENT
) -> DataFrame:
    """Clicks on priced products per (member, product); product names are mapped to ids.

    Counted per (visitor, name) first, so the joins see one row per pair. A name
    of several products stands for the smallest id; coded products are left out.
    """
    clicks = web.where(
        (F.col("event_name") == event)
        & F.col("product_price").isNotNull()
        & F.col("product_name").isNotNull()
    )
    pairs = clicks.groupBy("cid", "product_name").agg(F.count("*").alias("n"))
    members = join_lookup(pairs, cid_map.where(F.col("member_id").isNotNull()), "cid", "member_id")
    per_name = members.groupBy("member_id", "product_name").agg(F.sum("n").alias("total_count"))
    products = brand.where(F.col("product_id").isNotNull() & exclude_product_code(F.col("product_id"), "prefix"))
    ids = products.groupBy("product_name").agg(F.min("product_id").alias("product_id"))
    named = per_name.join(ids, "product_name")
    return named.groupBy("member_id", "product_id").agg(F.sum("total_count").alias("total_count"))


def _fit_size(ratings: int, rank: int, cores: int) -> dict[str, int]:
    """Blocks whose tasks need no more memory the larger the table, and checkpoints that keep the disk from holding all iterations.

    A block's task holds its ratings and, at the most, the factors of each of them; an iteration sends as many twice.
    """
    # the default of 10 blocks would bound the parallelism, however large the cluster
    blocks = max(10, cores, math.ceil(ratings * (rank + 10) / BLOCK_NUMBERS))
    return {
        "numUserBlocks": blocks, "numItemBlocks": blocks,
        "checkpointInterval": min(10, max(1, SHUFFLED_NUMBERS // max(1, 2 * ratings * rank))),
    }


def _als(known: DataFrame, rank: int = 10, **params) -> ALS:
    size = _fit_size(known.count(), rank, known.sparkSession.sparkContext.defaultParallelism)
    settings = {**size, "rank": rank, **params}
    return ALS(
        userCol="member_id", itemCol="product_id", ratingCol="rating", nonnegative=True,
        implicitPrefs=False, coldStartStrategy="drop", seed=0, **settings,
    )


def als_fit(ratings: DataFrame, **params) -> ALSModel:
    """Explicit non-negative factorisation of (member_id, product_id, rating), int ids.

    Ratings are counted before they are fitted: store them if they are not a table.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    known = ratings.dropna(subset=["member_id", "product_id"]).select("member_id", "product_id", "rating")
    return _als(known, **params).fit(known)


def als_scores(model: ALSModel, k: int = OWN_RANKS) -> DataFrame:
    """The k best products per member, as rows; equal to scoring all pairs."""
    return best_by_product(*_factors(model), k, item="product_id").rows.select("member_id", "product_id", F.col("score").alias("rating"))


def _factors(model: ALSModel) -> tuple[DataFrame, DataFrame]:
    return model.userFactors.withColumnRenamed("id", "member_id"), model.itemFactors.withColumnRenamed("id", "product_id")


def number_ids(ratings: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Ratings whose ids are ints, as the fit takes them, and (id, _n) of each numbered column."""
    numbers = {}
    for c in ("member_id", "product_id"):
        if dict(ratings.dtypes)[c] != "int":
            ids = ratings.select(c).where(F.col(c).isNotNull()).distinct()
            numbers[c] = number_rows(ids, [c], "_n").withColumn("_n", F.col("_n").cast("int"))
            ratings = ratings.join(numbers[c], c).drop(c).withColumnRenamed("_n", c)
    return ratings, numbers


def named_ids(scores: DataFrame, numbers: Mapping[str, DataFrame]) -> DataFrame:
    """Scores with the ids that ``number_ids`` numbered."""
    for c, table in numbers.items():
        names = table.select(F.col(c).alias("_name"), F.col("_n").alias(c))
        scores = scores.join(names, c).drop(c).withColumnRenamed("_name", c)
    return scores.select("member_id", "product_id", "rating")


def als_recommend(ratings: DataFrame, k: int = OWN_RANKS, **params) -> DataFrame:
    """Fit and recommend. Ids that are not ints (texts, bigints) are numbered for the
    fit, which takes 32-bit ids only, and given back in the result."""
    ratings, numbers = number_ids(ratings)
    return named_ids(als_scores(als_fit(stored(ratings, "fit_ratings"), **params), k), numbers)


def als_users(model: ALSModel, n: int) -> DataFrame:
    """The n members who score highest for each product, as rows."""
    members, products = _factors(model)
    return best_by_product(products, members, n, "product_id", "member_id").rows.select("member_id", "product_id", F.col("score").alias("rating"))


def als_cv(
    ratings: DataFrame, grid: Mapping[str, Sequence] = ALS_GRID, folds: int = 4, parallelism: int = 4, **params
) -> CrossValidatorModel:
    """Hyperparameter search by RMSE; the grid is a parameter (rank 2000 is rarely affordable).

    A rating's fold depends on a digest of its ids, so every run has the same folds. Ratings are
    stored first, as every fold and the last fit read them.
    """
    ensure_checkpoint_dir(ratings.sparkSession)
    known = ratings.dropna(subset=["member_id", "product_id"])
    fold = F.pmod(F.xxhash64("member_id", "product_id"), F.lit(folds)).cast("int").alias("fold")
    known = stored(known.select("member_id", "product_id", "rating", fold), "cv_ratings")
    als = _als(known, **{"rank": max(grid.get("rank", [10])), **params})
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(als.getParam(name), list(values))
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction")
    return CrossValidator(
        estimator=als, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds, seed=0,
        foldCol="fold", parallelism=parallelism,
    ).fit(known)


def blend_recs(parts: Sequence[tuple[DataFrame, float]]) -> DataFrame:
    """Weighted sum of scores per (member, product) over several score tables."""
    weighted = [
        df.select("member_id", "product_id", (F.col("rating") * w).alias("rating"))
        for df, w in parts
    ]
    return union_all(*weighted).groupBy("member_id", "product_id").agg(F.sum("rating").alias("rating"))


def rank_user_items(scores: DataFrame, k: int = OWN_RANKS) -> DataFrame:
    """Best k products per member with their rank (product id breaks ties)."""
    return topn_per_group(scores, ["member_id"], [F.desc("rating"), F.asc("product_id")], k)


def recs_wide(scores: DataFrame, k: int = OWN_RANKS) -> DataFrame:
    """One row per member: product_1..k and rating1..k."""
    return ranked_wide(rank_user_items(scores, k), k)


def ranked_wide(ranked: DataFrame, k: int = OWN_RANKS) -> DataFrame:
    """The same from rows that are ranked already."""
    return ranks_to_columns(
        ranked, ["member_id"], "rank", k, {"product_id": "product_", "rating": "rating"}
    )


def cohort_assign(member: DataFrame) -> DataFrame:
    """(member_id, cohort): members equal in age band and five more attributes share one."""
    banded = member.withColumn("age", age_bucket(F.coalesce("age", F.lit(0)), "ordinal5"))
    filled = banded.select("member_id", *COHORT_COLUMNS).na.fill(MISSING)
    return cohort_id(filled.dropna(subset=list(COHORT_COLUMNS)), COHORT_COLUMNS).select(
        "member_id", "cohort"
    )


def cohort_recs(ranked: DataFrame, cohorts: DataFrame, k: int = COHORT_RANKS) -> DataFrame:
    """Best k products per cohort from its members' ranked recommendations.

    Ratings are summed per (cohort, product, rank); a product's best rank sum
    counts; the k greatest are kept, product id breaking ties.
    """
    long = ranked.join(cohorts.where(F.col("cohort").isNotNull()), "member_id")
    long = long.dropna(subset=["product_id", "rating"])
    sums = long.groupBy("cohort", "product_id", "rank").agg(F.sum("rating").alias("rating"))
    best = sums.groupBy("cohort", "product_id").agg(F.max("rating").alias("rating"))
    top = topn_per_group(best, ["cohort"], [F.desc("rating"), F.asc("product_id")], k)
    return ranks_to_columns(top, ["cohort"], "rank", k, {"product_id": "product_"})


def popular_top(purchase: DataFrame, k: int = COHORT_RANKS) -> DataFrame:
    """The k best sellers with their rank (k rows)."""
    sold = purchase.where(exclude_product_code(F.col("product_id"), "prefix"))
    totals = sold.groupBy("product_id").agg(F.sum("count").alias("total"))
    best = topk_global(totals, [F.desc("total"), F.asc("product_id")], k)
    # k rows from here on
    return topn_per_group(
        best.withColumn("_all", F.lit(0)), ["_all"], [F.desc("total"), F.asc("product_id")], k
    ).select("rank", "product_id", "total")


def recs_final(
    own: DataFrame, cohort: DataFrame, popular: DataFrame, cohorts: DataFrame, k: int = COHORT_RANKS
) -> DataFrame:
    """k products for every member of ``cohorts``: own ones if any, else the cohort's,
    whose gaps take the best seller of the same rank.

    ``own``: wide by member; ``cohort``: wide by cohort; ``popular``: (rank, product_id).
    """
    names = [f"product_{i}" for i in range(1, k + 1)]
    mine = own.select("member_id", *[F.col(n).alias(f"own_{n}") for n in names])
    both = cohorts.join(mine, "member_id", "left").join(cohort.select("cohort", *names), "cohort", "left")
    has_own = F.col("own_product_1").isNotNull()
    # k rows folded to one struct: a single scalar subquery serves all ranks
    kind = dict(own.dtypes)["product_1"]
    places = [
        F.max(F.when(F.col("rank") == i, F.col("product_id").try_cast(kind))).alias(name)
        for i, name in enumerate(names, start=1)
    ]
    sellers = popular.agg(F.struct(*places).alias("s")).scalar()
    picked = [
        F.when(has_own, F.col(f"own_{n}")).otherwise(F.coalesce(F.col(n), sellers[n])).alias(n)
        for n in names
    ]
    return both.select("member_id", *picked)


def train_test_split(
    df: DataFrame, keys: Sequence[str], train: float = 0.8
) -> tuple[DataFrame, DataFrame]:
    """The rows of either side, for callers who need two frames."""
    sides = split_sides(df, keys, train)
    return tuple(sides.where(F.col("side") == s).drop("side") for s in ("train", "test"))


def recommend_all(
    purchase: DataFrame, web: DataFrame, cid_map: DataFrame, brand: DataFrame, member: DataFrame, **params
) -> DataFrame:
    """The whole chain: fit purchases and clicks, blend, rank, and fill up from cohorts and best sellers.

    One row per member of the cohorts with product_1..5. Ranks are stored once
    and serve the members' own lists and those of the cohorts.
    """
    ensure_checkpoint_dir(purchase.sparkSession)
    counts = {"purchase": interactions_purchase(purchase), "click": interactions_click(web, cid_map, brand)}
    scores = [
        (als_recommend(quintile_rating(df, "total_count"), **params), BLEND_WEIGHTS[name])
        for name, df in counts.items()
    ]
    ranked = rank_user_items(blend_recs(scores)).checkpoint()
    cohorts = cohort_assign(member)
    return recs_final(ranked_wide(ranked), cohort_recs(ranked, cohorts), popular_top(purchase), cohorts)


def split_sides(df: DataFrame, keys: Sequence[str], train: float = 0.8) -> DataFrame:
    """Repeatable random split in one pass: a row's ``side`` depends on a digest of its keys alone."""
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    slot = F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("bigint")
    return df.withColumn("side", F.when(slot < round(train * 16**6), "train").otherwise("test"))
