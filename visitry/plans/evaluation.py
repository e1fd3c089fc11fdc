"""Quality of recommendations against actual items; no list is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.reshape import melt_wide


def _hits(recs: DataFrame, actual: DataFrame, k: int, prefix: str = "product_") -> DataFrame:
    """Per member with both recommendations and actual items: hits and actual count.

    Both sides meet as rows of one aggregate per (member, item), then per member:
    each input is read once and nothing is joined. Repeated items count once;
    empty places keep their member.
    """
    places = [(f"{prefix}{i}",) for i in range(1, k + 1)]
    long = melt_wide(recs, ["member_id"], places, ["item"], "rank")
    both = long.select("member_id", "item", F.lit(True).alias("rec")).unionByName(
        actual.where(F.col("item").isNotNull()).select("member_id", "item", F.lit(False).alias("rec"))
    )
    pairs = both.groupBy("member_id", "item").agg(
        F.bool_or("rec").alias("rec"), F.bool_or(~F.col("rec")).alias("bought")
    )
    return (
        pairs.groupBy("member_id")
        .agg(
            F.bool_or("rec").alias("served"),
            F.count_if(F.col("rec") & F.col("bought")).alias("hits"),
            F.count_if("bought").alias("actual"),
        )
        .where(F.col("served") & (F.col("actual") > 0))
    )


def rec_hit_rate(recs: DataFrame, actual: DataFrame, k: int = 5) -> DataFrame:
    """Percent of members with at least one of k recommendations among their items.

    ``recs``: wide by member; ``actual``: (member_id, item).
    """
    hits = _hits(recs, actual, k)
    return hits.agg(
        F.count("*").alias("members"),
        F.count_if(F.col("hits") > 0).alias("hit"),
        (F.lit(100.0) * F.count_if(F.col("hits") > 0) / F.count("*")).alias("hit_rate"),
    )


def precision_recall_at_k(recs: DataFrame, actual: DataFrame, k: int = 5) -> DataFrame:
    """Mean share of the k places that hit, and mean share of the actual items found."""
    hits = _hits(recs, actual, k)
    return hits.agg(
        F.count("*").alias("members"),
        F.avg(F.col("hits") / k).alias("precision"),
        F.avg(F.col("hits") / F.col("actual")).alias("recall"),
    )


def rec_rmse_mae(pred: DataFrame) -> DataFrame:
    """Rating error of (rating, prediction) rows."""
    error = F.col("prediction") - F.col("rating")
    return pred.dropna(subset=["rating", "prediction"]).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae")
    )
