"""RFM scoring, clustering and value labels."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from ..functions import new_customer_flag, rfm_score
from ..functions.numbers import RFM_CUTS
from ..operators.joins import cross_grid

# Value labels.
NEW, BEST, LOST, LOYAL, SLEEPING, NO_PURCHASE = (
    "新客客群", "高價值客群", "流失客群", "忠誠客群", "沉睡客群", "無購買客戶",
)
SCORES = ["r_s", "f_s", "m_s"]
MEMBER_PREFIX = "M"


def rfm_features(
    stat: DataFrame, member: DataFrame, as_of: date, cuts: Mapping[str, tuple] = RFM_CUTS
) -> DataFrame:
    """Member figures with join date, new-customer flag and scores (null for new customers)."""
    joined = member.where(F.col("member").startswith(MEMBER_PREFIX)).select("member_id", "join_date")
    df = stat.join(joined, "member_id", "left")
    is_new = F.coalesce(new_customer_flag(F.col("join_date"), F.col("m"), as_of), F.lit(False))
    scores = rfm_score(F.col("r"), F.col("f"), F.col("m"), cuts)
    return df.select(
        "member_id", F.col("join_date").alias("date"), "r", "f", "m", is_new.alias("is_new"),
        *[F.when(~is_new, s).alias(name) for s, name in zip(scores, SCORES)],
    )


def score_profiles(features: DataFrame) -> DataFrame:
    """Members per score triple: at most 27 rows, the whole input of the clustering."""
    scored = features.where(~F.col("is_new")).dropna(subset=SCORES)
    return scored.groupBy(*SCORES).agg(F.count("*").cast("double").alias("n"))


def rfm_kmeans(features: DataFrame, k: int = 6, seed: int = 0) -> tuple[KMeansModel, DataFrame]:
    """k-means on the score triples, weighted by their members; and its centroids.

    Same objective as clustering the members one by one, but the iterations run
    over 27 rows at most, however many members there are. The centroid table
    (k rows) is read from the model on the driver.
    """
    vectors = VectorAssembler(inputCols=SCORES, outputCol="features")
    # 27 rows at most: one ordered partition makes the seeded start repeatable
    profiles = vectors.transform(score_profiles(features)).coalesce(1).sortWithinPartitions(*SCORES)
    model = KMeans(k=k, seed=seed, weightCol="n", predictionCol="cluster").fit(profiles)
    rows = [(i, *map(float, center)) for i, center in enumerate(model.clusterCenters())]
    centroids = features.sparkSession.createDataFrame(rows, "cluster int, r double, f double, m double")
    return model, centroids


def assign_clusters(model: KMeansModel, features: DataFrame) -> DataFrame:
    """(member_id, cluster), through the 27 possible score triples."""
    triples = cross_grid(features.sparkSession.range(1), **{c: (1, 2, 3) for c in SCORES})
    vectors = VectorAssembler(inputCols=SCORES, outputCol="features")
    known = model.transform(vectors.transform(triples)).select(*SCORES, "cluster")
    return features.join(F.broadcast(known), SCORES).select("member_id", "cluster")


def rfm_name_clusters(centroids: DataFrame) -> DataFrame:
    """Label per centroid (cluster, r, f, m): greatest sum best, least sum lost; of the
    others the one reaching the greatest F+M-R of all centroids is loyal, the rest sleep.

    The greatest F+M-R may belong to the best or lost cluster; then none is loyal.
    """
    scored = centroids.withColumns(
        {
            "total": F.col("r") + F.col("f") + F.col("m"),
            "fm_r": F.col("f") + F.col("m") - F.col("r"),
        }
    )
    everything = Window.partitionBy(F.lit(0))  # k rows
    label = (
        F.when(F.col("total") == F.max("total").over(everything), BEST)
        .when(F.col("total") == F.min("total").over(everything), LOST)
        .when(F.col("fm_r") == F.max("fm_r").over(everything), LOYAL)
        .otherwise(SLEEPING)
    )
    return scored.select("cluster", "total", "fm_r", label.alias("label"))


def rfm_labels(
    features: DataFrame, assigned: DataFrame, names: DataFrame, member: DataFrame
) -> DataFrame:
    """One label per registered member: new customer, its cluster's name, or no purchase.

    ``assigned``: (member_id, cluster); ``names``: (cluster, label).
    """
    # one name per cluster, k rows
    named = assigned.join(F.broadcast(names.select("cluster", "label")), "cluster")
    labelled = features.join(named.select("member_id", "label"), "member_id", "left").select(
        "member_id", "date", "r", "f", "m",
        F.when(F.col("is_new"), NEW).otherwise(F.col("label")).alias("value_label"),
    )
    everyone = member.where(F.col("member").startswith(MEMBER_PREFIX)).select("member_id")
    return everyone.join(labelled, "member_id", "left").withColumn(
        "value_label", F.coalesce("value_label", F.lit(NO_PURCHASE))
    )

