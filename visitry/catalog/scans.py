"""Scans, incremental loads, sinks and exports on the driver tables.

Write paths run a round trip through a new folder below the session's shared
folder and return what is read back.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import parse_json_column, year_month
from ..operators.joins import join_lookup, keyed_delete, keyed_update
from ..session import scratch_path
from ..sources import (
    export_batches,
    next_day_slice,
    number_batches,
    read_day,
    read_docs,
    read_table,
    replace_partition,
    sender_lookup,
    sink_append,
    sink_replace,
)
from .bindings import SCHEMAS
from .registry import query


@query("scan_table", """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_returnflag = 'R'""")
def _(t):
    return read_table(
        t.spark, "lineitem", ["l_orderkey", "l_partkey", "l_quantity"],
        (F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")) & (F.col("l_returnflag") == "R"),
        root=t.root, schema=SCHEMAS["lineitem"],
    )


@query("scan_documents", """
    SELECT user_id, event_type, value FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 23:59:59'""")
def _(t):
    between = F.col("ts").between(
        F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12 23:59:59").cast("timestamp_ntz")
    )
    return read_docs(
        t.spark, "events", between, ["user_id", "event_type", "value"],
        root=t.root, schema=SCHEMAS["events"],
    )


def _dated_events(t):
    return t("events").withColumn("event_date", F.to_date("ts"))


@query("scan_day_shard", """
    SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def _(t):
    path = scratch_path(t.spark, "day_shards")
    sink_append(_dated_events(t), path, ["event_date"])
    schema = SCHEMAS["events"] + ", event_date date"
    return read_day(t.spark, path, date(2024, 1, 15), schema).select("event_id", "user_id", "event_type")


LOADED = "2024-01-11"


def _loaded(t):
    return t("events").where(F.col("ts") < F.lit(LOADED).cast("timestamp_ntz"))


@query("next_day_slice", f"""
    SELECT event_id, user_id, CAST(ts AS VARCHAR) AS ts FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) + 1 FROM events WHERE ts < TIMESTAMP '{LOADED}')""")
def _(t):
    return next_day_slice(t("events"), _loaded(t), "ts").select("event_id", "user_id", "ts")


@query("sink_append", """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, count(*) AS n FROM events
    WHERE ts < TIMESTAMP '2024-01-12' GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "appended")
    sink_append(_dated_events(t).where(F.col("event_date") < F.lit(date(2024, 1, 11))), path, ["event_date"])
    loaded = t.spark.read.parquet(path)
    sink_append(next_day_slice(_dated_events(t), loaded, "ts"), path, ["event_date"])
    # beyond the last day there is nothing, so nothing may be written
    sink_append(next_day_slice(_dated_events(t), t("events"), "ts"), path, ["event_date"])
    return t.spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"))


@query("sink_replace", """
    SELECT c_mktsegment AS level, count(*) AS n FROM customer GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "replaced")
    counts = t("customer").groupBy(F.col("c_mktsegment").alias("level")).agg(F.count("*").alias("n"))
    sink_replace(counts.withColumn("n", F.col("n") + 1), path)
    sink_replace(counts, path)
    return t.spark.read.parquet(path)


@query("replace_partition", """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n
    FROM orders GROUP BY 1, 2""")
def _(t):
    path = scratch_path(t.spark, "months")
    orders = t("orders").select(
        year_month(F.col("o_orderdate")).alias("month"), F.col("o_orderstatus").alias("status")
    )
    report = orders.groupBy("month", "status").agg(F.count("*").alias("n"))
    stale = report.withColumn("n", F.when(F.col("month") == "2000-05", 0).otherwise(F.col("n")).cast("bigint"))
    emptied = stale.where(F.col("month") == "2000-05").withColumn("month", F.lit("1900-01"))
    replace_partition(stale.unionByName(emptied), path, "month")
    replace_partition(report.where(F.col("month") == "2000-05"), path, "month", ["2000-05", "1900-01"])
    # the month is text, whatever it looks like in the folder names
    return t.spark.read.schema("status string, n bigint, month string").parquet(path)


@query("keyed_update", """
    SELECT o_orderkey, CASE WHEN n IS NULL THEN o_orderstatus ELSE 'heavy' END AS o_orderstatus
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 6)
      ON o_orderkey = l_orderkey""")
def _(t):
    heavy = t("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n > 6").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("heavy").alias("o_orderstatus")
    )
    return keyed_update(t("orders").select("o_orderkey", "o_orderstatus"), heavy, "o_orderkey", "o_orderstatus")


@query("keyed_delete", """
    SELECT o_custkey AS key, count(*) AS n, 'orders' AS kept FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1
    UNION ALL
    SELECT l_partkey, count(*), 'lines' FROM lineitem
    WHERE l_partkey NOT IN (SELECT o_orderkey FROM orders
      WHERE o_orderstatus = 'F' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
    GROUP BY 1""")
def _(t):
    # rules owned by members; deleting a member's rows deletes the children named SS_<order>
    orders = t("orders").select(
        "o_custkey",
        F.concat(F.when(F.col("o_orderstatus") == "F", "SS_").otherwise("C_"), "o_orderkey").alias("label"),
    )
    lines = t("lineitem").select(F.concat(F.lit("SS_"), "l_partkey").alias("label_id"), "l_partkey")
    doomed = t("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    kept, children = keyed_delete(orders, doomed, "o_custkey", lines, "label_id", "label")
    return (
        kept.groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n"), F.lit("orders").alias("kept"))
        .unionByName(
            children.groupBy(F.col("l_partkey").alias("key")).agg(F.count("*").alias("n"), F.lit("lines").alias("kept"))
        )
    )


def _recipients(t):
    sent = t("channel_touch").where((F.col("channel") == "Email") & (F.col("action") == "sent"))
    return sent.select("member_id", "rule_id").distinct()


def _senders(t):
    touches = t("channel_touch")
    named = touches.select(F.col("rule_id").alias("name"), F.concat("channel", F.lit("_"), "family").alias("sender"), "channel")
    return sender_lookup(named.where("channel = 'Email'"), named.where("channel = 'SMS'"))


SENDERS = "SELECT rule_id AS name, min(channel || '_' || family) AS sender FROM channel_touch GROUP BY rule_id"
BATCHED = """
    SELECT member_id, rule_id, rule_id AS template, 'tenant' AS configuration_set, sender,
           (row_number() OVER (ORDER BY substr(md5('{{"member_id":"' || member_id || '","rule_id":"' || rule_id || '"}}'), 1, 3),
             member_id, rule_id) - 1) // {chunk} + 1 AS batch
    FROM (SELECT DISTINCT member_id, rule_id FROM channel_touch WHERE channel = 'Email' AND action = 'sent') r
    JOIN ({senders}) s ON s.name = r.rule_id"""


@query("sender_lookup", f"""
    SELECT member_id, rule_id, sender FROM
      (SELECT DISTINCT member_id, rule_id FROM channel_touch WHERE channel = 'Email' AND action = 'sent') r
    JOIN ({SENDERS}) s ON s.name = r.rule_id""")
def _(t):
    senders = _senders(t).withColumnRenamed("name", "rule_id")
    return join_lookup(_recipients(t), senders, "rule_id", "sender", strict=True).select(
        "member_id", "rule_id", "sender"
    )


query("number_batches", BATCHED.format(chunk=100, senders=SENDERS))(
    lambda t: number_batches(_recipients(t), _senders(t), "email", "vice", "tenant", chunk=100)
)


@query("export_batches", f"""
    SELECT batch, count(*) AS n, count(DISTINCT sender) AS senders
    FROM ({BATCHED.format(chunk=500, senders=SENDERS)}) GROUP BY batch""")
def _(t):
    path = scratch_path(t.spark, "campaign")
    export_batches(_recipients(t), _senders(t), path, "email", "vice", "tenant", chunk=500)
    schema = "member_id string, rule_id string, template string, configuration_set string, sender string, batch bigint"
    written = t.spark.read.schema(schema).option("header", True).csv(f"{path}/wait-send/email_vice")
    return written.groupBy("batch").agg(F.count("*").alias("n"), F.countDistinct("sender").alias("senders"))


@query("parse_json_column", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
    UNION ALL SELECT c_custkey, c_custkey + 1 FROM customer""")
def _(t):
    objects = t("events").select("event_id", parse_json_column(F.col("props"), "k int")["k"].alias("k"))
    lists = t("stored_list").select(
        parse_json_column(F.get_json_object("list", "$.content"), "array<bigint>").alias("ids")
    )
    # the union widens both to bigint, as the check SQL does
    return objects.withColumn("k", F.col("k").cast("bigint")).union(lists.select(F.col("ids")[0], F.col("ids")[1]))
