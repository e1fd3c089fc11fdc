"""Nested event tables, packed by Spark from the flat bindings and stored once.

The check SQL reads the flat form, so flattening must give it back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..plans.visits import PARAMS_A, PARAMS_B
from .bindings import Tables

TYPED = {"string": "string_value", "int": "int_value", "bigint": "int_value", "double": "double_value"}
FIELDS = {"string_value": "string", "int_value": "bigint", "float_value": "double", "double_value": "double"}


def param(key: str, c: Column, kind: str) -> Column:
    field = TYPED[kind]
    values = [
        (c if name == field else F.lit(None)).cast(sql_type).alias(name)
        for name, sql_type in FIELDS.items()
    ]
    return F.struct(F.lit(key).alias("key"), F.struct(*values).alias("value"))


def pack(flat: DataFrame, params: Mapping[str, str]) -> Column:
    """``event_params`` of ``{key: column}``; null columns are absent, noise is added."""
    kinds = dict(flat.dtypes)
    noise = F.array(param("noise", F.col("event_id").cast("string"), "string"))
    parts = [
        F.when(F.col(c).isNotNull(), F.array(param(key, F.col(c), kinds[c]))).otherwise(F.slice(noise, 1, 0))
        for key, c in params.items()
    ]
    return F.concat(*parts, noise)


def micros(ts: str = "ts") -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))


def kiosk_a(t: Tables) -> DataFrame:
    return t.stored("kiosk_a", lambda: _kiosk(t("kiosk_a"), PARAMS_A))


def kiosk_b(t: Tables) -> DataFrame:
    return t.stored("kiosk_b", lambda: _kiosk(t("kiosk_b"), PARAMS_B))


def web(t: Tables) -> DataFrame:
    return t.stored("web", lambda: _web(t))


def _kiosk(flat: DataFrame, params: Mapping[str, str]) -> DataFrame:
    return flat.select(
        "event_id", "event_date", micros().alias("event_timestamp"), "event_name",
        pack(flat, params).alias("event_params"),
    )


def _web(t: Tables) -> DataFrame:
    """Web analytics events with device, traffic source and place."""
    flat = t("web_event").withColumns(
        {
            "item": F.when(F.col("event_name") == "view", F.concat(F.lit("item_"), F.col("k"))),
            "price": F.when(F.col("event_name") == "purchase", F.col("value")),
        }
    )
    params = {"ga_session_id": "ga_session_id", "item": "item", "product_price": "price"}
    number = {"ga_session_number": "k"}
    chosen = F.when(F.col("event_name") == "error", pack(flat, {})).otherwise(
        pack(flat, params | number)
    )
    return flat.select(
        "event_id", "event_date", micros().alias("event_timestamp"), "event_name",
        F.col("cid").alias("user_pseudo_id"),
        F.struct(F.when(F.col("k") % 2 == 0, "mobile").otherwise("desktop").alias("category")).alias("device"),
        F.struct(
            F.concat(F.lit("c"), F.col("k") % 5).alias("name"),
            F.when(F.col("k") % 3 == 0, "cpc").otherwise("organic").alias("medium"),
            F.when(F.col("k") % 4 == 0, "google").alias("source"),
        ).alias("traffic_source"),
        F.struct(F.lit("TW").alias("country"), F.concat(F.lit("r"), F.col("cid") % 7).alias("region")).alias("geo"),
        chosen.alias("event_params"),
    )


# flat form of ``web``, as a CTE body for the check SQL
WEB_FLAT = """
SELECT event_id, event_date, ts, event_name, cid, k, value,
       CASE WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS category,
       'c' || CAST(k % 5 AS VARCHAR) AS campaign,
       CASE WHEN k % 3 = 0 THEN 'cpc' ELSE 'organic' END AS medium,
       CASE WHEN k % 4 = 0 THEN 'google' END AS source,
       'TW' AS country, 'r' || CAST(cid % 7 AS VARCHAR) AS region,
       CASE WHEN event_name <> 'error' THEN ga_session_id END AS session,
       CASE WHEN event_name <> 'error' THEN CAST(k AS VARCHAR) END AS number,
       CASE WHEN event_name = 'view' THEN 'item_' || CAST(k AS VARCHAR) END AS item,
       CASE WHEN event_name = 'purchase' THEN CAST(value AS VARCHAR) END AS price
FROM web_event"""
