"""What the plans must and must not contain."""

import re

import pytest

from visitry.catalog import QUERIES
from visitry.operators.reshape import explode_params, flatten_params
from visitry.catalog import nested

SF_DIR = "/root/testdata/sf0.001"
# these fit a model while they are built
FITTED = {
    "als_recommend", "als_recommend_click", "als_recommend_contract", "als_click_contract", "recommend_all",
    "recommend_all_hit_rate", "als_cv", "rec_rmse_mae", "hybrid_recommend", "rfm_kmeans",
    "rfm_labels_kmeans",
}
FORBIDDEN = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
    "FlatMapGroupsInPandas", "MapPartitions",
)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in FITTED])
def test_no_cross_join_and_no_python(spark, key):
    text = plan(QUERIES[key](spark, SF_DIR))
    assert not [word for word in FORBIDDEN if word in text]


def test_flatten_is_row_local(tables):
    keys = ["ga_session_id", "item"]
    assert "Exchange" not in plan(flatten_params(nested.web(tables), keys))
    assert "Exchange" not in plan(explode_params(nested.web(tables), keys))


def test_fold_shuffles_once(spark):
    """Three rules, one shuffle for the fold besides those of the rules themselves."""
    text = plan(QUERIES["segment_content"](spark, SF_DIR))
    assert "Union" in text
    assert len(re.findall(r"Exchange hashpartitioning\(member_id", text)) <= 2


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["scan_table"](spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", text)
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double", text)


def test_day_shard_reads_one_folder(spark):
    df = QUERIES["scan_day_shard"](spark, SF_DIR)
    assert "PartitionFilters: [isnotnull(event_date" in plan(df)
    assert len({f.rsplit("/", 2)[1] for f in df.inputFiles()}) >= 1


def test_topn_is_limited_before_the_shuffle(spark):
    text = plan(QUERIES["topn_per_group"](spark, SF_DIR))
    assert "WindowGroupLimit" in text


def test_scalar_limits_are_subqueries(spark):
    text = plan(QUERIES["join_scalar"](spark, SF_DIR))
    assert "Subquery" in text and "Join" not in text


def test_dwell_window_is_cut_into_pieces(spark):
    """The row window is partitioned by session and time piece, not by session alone."""
    text = plan(QUERIES["dwell_time"](spark, SF_DIR))
    windows = re.findall(r"windowspecdefinition\(([^)]*)", text)
    assert any("_piece" in w.split(" ASC")[0] and "event_id" in w for w in windows)


def test_null_keys_are_spread(spark):
    """Rows without a key are hashed by their salt too, not all to one partition."""
    from pyspark.sql import functions as F

    from visitry.operators.joins import enrich_left

    facts = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"))
    dim = spark.range(7).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = enrich_left(facts, dim, ["k"])
        text = plan(out)
        assert len(re.findall(r"hashpartitioning\(k#\w+, _salt#\w+", text)) == 2
        assert out.count() == 1000 and out.where("v IS NULL").count() == 334
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rating_sides_are_computed_once(spark, monkeypatch):
    """The error of the factorisation fits one side and judges the other: both are read from one table."""
    from visitry.catalog import QUERIES, models

    names, written = [], models.stored
    monkeypatch.setattr(models, "stored", lambda df, name: names.append(name) or written(df, name))
    row = QUERIES["rec_rmse_mae"](spark, "/root/testdata/sf0.001").first()
    assert names == ["rating_sides"] and 0 < row["mae"] <= row["rmse"]
