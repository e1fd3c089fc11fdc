"""Ordered exchange against plain windows: hot keys, null keys, ties in time, many tasks."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from visitry.operators.ordered import next_in_order, number_in_order, running


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows belong to key 7, within one second; some keys are null."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.pmod(F.hash("id"), F.lit(40)))
    t = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.pmod(F.hash("id", F.lit(1)), F.lit(90)))
    return spark.range(6000).select(key.alias("k"), t.alias("t"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("tie"), "id").repartition(5)


@pytest.fixture(autouse=True)
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_number_equals_row_number(hot):
    got = {r["id"]: r["n"] for r in number_in_order(hot, ["k"], ["t", "tie"], "n").collect()}
    want = hot.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "tie")) - 1).collect()
    assert got == {r["id"]: r["n"] for r in want}


def test_next_equals_lead(hot):
    got = {r["id"]: r["n"] for r in next_in_order(hot, ["k"], ["t", "tie"], "tie", "n").collect()}
    want = hot.withColumn("n", F.lead("tie").over(Window.partitionBy("k").orderBy("t", "tie"))).collect()
    assert got == {r["id"]: r["n"] for r in want}


def test_one_key_over_all_tasks(spark):
    rows = spark.range(1000).select(F.lit("a").alias("k"), "id")
    assert [r["n"] for r in number_in_order(rows, ["k"], ["id"], "n").orderBy("id").collect()] == list(range(1000))
    nexts = [r["n"] for r in next_in_order(rows, ["k"], ["id"], "id", "n").orderBy("id").collect()]
    assert nexts == [*range(1, 1000), None]


def test_empty(spark):
    none = spark.createDataFrame([], "k string, t long")
    assert number_in_order(none, ["k"], ["t"]).count() == next_in_order(none, ["k"], ["t"], "t").count() == 0


def test_running_equals_window(hot):
    rows = number_in_order(hot.where("k IS NOT NULL"), ["k"], ["t", "tie"], "n").cache()
    got = running(rows, ["k"], "n", {"s": (F.sum, "id"), "x": (F.bit_xor, "id"), "m": (F.max, "id")}, block=16)
    earlier = Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.withColumns({"s": F.sum("id").over(earlier), "x": F.bit_xor("id").over(earlier), "m": F.max("id").over(earlier)})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
