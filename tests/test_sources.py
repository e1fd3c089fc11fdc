"""Sinks and loads: round trips, reruns, errors."""

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F

from visitry.session import scratch_path, shared_folder
from visitry.sources import (
    export_batches,
    jdbc_options,
    next_day_slice,
    number_batches,
    read_day,
    read_table,
    replace_partition,
    sink_append,
    sink_jdbc,
    sink_replace,
)


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="visitry-test-")


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_append_skips_empty(spark, folder):
    df = spark.createDataFrame([(1, "a")], "n int, d string")
    assert not sink_append(df.where("n > 1"), f"{folder}/t")
    assert not os.path.exists(f"{folder}/t")
    assert sink_append(df, f"{folder}/t", ["d"]) and sink_append(df, f"{folder}/t", ["d"])
    assert spark.read.parquet(f"{folder}/t").count() == 1  # a day loaded again replaces itself
    assert sink_append(df, f"{folder}/plain") and sink_append(df, f"{folder}/plain")
    assert spark.read.parquet(f"{folder}/plain").count() == 2


def test_replace_clears_emptied_partitions(spark, folder):
    path = f"{folder}/e"
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02"), (3, "2024-03")], "n int, month string")
    sink_append(df, path, ["month"])
    replace_partition(df.where("n = 3"), path, "month", ["2024-02", "2024-03", "2024-09"])
    assert counts(spark.read.parquet(path), "month") == {"2024-01": 1, "2024-03": 1}


def test_jdbc_writer_options(spark):
    df = spark.range(1)
    for bad in ({"mode": "replace"}, {"truncate": True}):
        with pytest.raises(ValueError):
            sink_jdbc(df, "jdbc:x:y", "t", **bad)
    assert sink_jdbc(df, "jdbc:x:y", "t", "overwrite", truncate=True, batch_rows=50_000, user="u") is not None


def test_append_writes_few_files_per_folder(spark, folder):
    df = spark.range(1000).repartition(8).selectExpr("id", "cast(id % 5 AS string) AS d")
    sink_append(df, f"{folder}/f", ["d"])
    files = [f for _, _, fs in os.walk(f"{folder}/f") for f in fs if f.endswith(".parquet")]
    assert len(files) == 5  # not 8 tasks x 5 folders
    assert spark.read.parquet(f"{folder}/f").count() == 1000


def test_replace_partition_is_idempotent(spark, folder):
    path = f"{folder}/m"
    both = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "n int, month string")
    sink_append(both, path, ["month"])
    again = spark.createDataFrame([(5, "2024-02"), (6, "2024-02")], "n int, month string")
    for _ in range(2):
        replace_partition(again, path, "month")
        assert counts(spark.read.parquet(path), "month") == {"2024-01": 1, "2024-02": 2}


def test_replace_drops_old_partitions(spark, folder):
    path = f"{folder}/r"
    sink_replace(spark.range(5), path)
    sink_replace(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_next_day_by_timestamp_and_by_date(spark, folder):
    days = spark.createDataFrame([(i, date(2024, 1, 1 + i % 3)) for i in range(9)], "id int, event_date date")
    loaded = days.where(F.col("event_date") == F.lit(date(2024, 1, 1)))
    assert counts(next_day_slice(days, loaded, "event_date"), "event_date") == {date(2024, 1, 2): 3}
    assert next_day_slice(days, days, "event_date").isEmpty()
    assert next_day_slice(days, days.where("id < 0"), "event_date").isEmpty()
    path = f"{folder}/days"
    sink_append(days, path, ["event_date"])
    stored = spark.read.parquet(path)
    plan = next_day_slice(stored, loaded, "event_date")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert read_day(spark, path, date(2024, 1, 3)).count() == 3


def test_exports_write_whole_batches(spark, folder):
    people = spark.range(1050).select(
        F.concat(F.lit("m"), "id").alias("member_id"), F.when(F.col("id") % 3 == 0, "r1").otherwise("r2").alias("rule_id")
    )
    senders = spark.createDataFrame([("r1", "s1"), ("r2", "s2")], "name string, sender string")
    export_batches(people, senders, folder, "email", "vice", "tenant", chunk=100)
    files = [f for d, _, fs in os.walk(f"{folder}/wait-send/email_vice") for f in fs if f.endswith(".csv")]
    assert len(files) == 11  # ten full files and one of 50 rows
    back = spark.read.option("header", True).csv(f"{folder}/wait-send/email_vice")
    assert back.count() == 1050 and counts(back, "batch") == {**{i: 100 for i in range(1, 11)}, 11: 50}
    export_batches(people.where("member_id = 'nobody'"), senders, folder, "sms", "trigger")
    assert not any(f.endswith(".csv") for _, _, fs in os.walk(f"{folder}/wait-send/sms_trigger") for f in fs)
    export_batches(people, None, folder, "sms", "type_type", immediate=True)
    sent = spark.read.option("header", True).csv(f"{folder}/send-immediate/sms_type_type")
    assert counts(sent, "sender") == {"None": 1050}


def test_exports_refuse_unknown_rules_and_kinds(spark):
    people = spark.createDataFrame([("m", "r9")], "member_id string, rule_id string")
    senders = spark.createDataFrame([("r1", "s1")], "name string, sender string")
    with pytest.raises(Exception, match="no sender for rule_id r9"):
        number_batches(people, senders, "email", "vice").collect()
    with pytest.raises(ValueError):
        number_batches(people, senders, "email", "type_type")


def test_jdbc_reads_can_be_split():
    options = jdbc_options("jdbc:mysql://h/db", "t", ("id", 0, 1000, 8), fetchsize="10000")
    assert options == {
        "url": "jdbc:mysql://h/db", "dbtable": "t", "fetchsize": "10000", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "8",
    }


def test_catalog_tables(spark):
    spark.range(3).createOrReplaceTempView("visitry_numbers")
    assert read_table(spark, "visitry_numbers", ["id"], "id > 0").count() == 2


class FakeSession:
    """Just enough of a session to read settings from."""

    def __init__(self, master, **settings):
        self.settings, self.sparkContext, self.conf = settings, self, self
        self.master = master

    def get(self, key, default=None):
        return self.settings.get(key, default)

    def set(self, key, value):
        self.settings[key] = value


def test_shared_folder_follows_the_session():
    named = FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(named) == "hdfs:///shared/"
    assert scratch_path(named, "x").startswith("hdfs:///shared/x-")
    assert scratch_path(named, "x") != scratch_path(named, "x")
    with pytest.raises(ValueError):
        shared_folder(FakeSession("yarn"))
    local = FakeSession("local[2]")
    assert shared_folder(local) == shared_folder(local) and os.path.isdir(shared_folder(local))
