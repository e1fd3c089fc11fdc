"""Kiosk event loading: nested events + camera visits -> one flat record per event."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    between_times,
    blank_coalesce,
    classify_contains,
    classify_suffix,
    epoch_micros_to_ts,
    url_segment_map,
)
from ..operators.aggregates import precedence_group
from ..operators.joins import enrich_left, keyed_update
from ..operators.reshape import flatten_params
from ..operators.windows import dwell_time

# Kiosk locations by url fragment and by machine code.
URL_LOCATIONS = (("locationA1", "A1"), ("locationI", "I"))
MACHINE_LOCATIONS = {"17d5dffb": "A1", "b97bc201": "I"}
# The menu click event and its pages.
MENU_EVENT = "點擊下方項目"
MENU_PAGES = {
    "HomePage": "首頁",
    "MapArchive": "地圖",
    "Intro": "歷史",
    "CoursePage": "課程",
    "ShopPage": "購物",
}
# Events the first kiosk loads, and the parameters of each kiosk.
EVENTS_A = (
    "點擊下方項目", "點擊歷史事件圈圈", "點擊課程更多資訊", "點擊A1地圖項目", "點擊地圖項目", "點擊購物更多資訊",
)
PARAMS_A = {
    "ga_session_id": "ga_session_id", "項目名稱": "item_name", "目前網站": "page_url",
    "id": "group_id", "課程名稱": "course_name",
}
PARAMS_B = {
    "ga_session_id": "ga_session_id", "item_name": "item_name", "page_url": "page_url",
    "id": "group_id", "brand_name": "brand_name",
}
WINDOW_DAYS = 5


def visit_window(visits: DataFrame, ts: str, as_of: date, days: int = WINDOW_DAYS) -> DataFrame:
    """Visits from ``days`` days before to ``days`` days after ``as_of``, whole days."""
    start = datetime.combine(as_of - timedelta(days=days), time())
    end = datetime.combine(as_of + timedelta(days=days), time(23, 59, 59))
    return visits.where(between_times(F.col(ts), start, end, is_date=False))


def group_relations(
    visits: DataFrame, per_location: bool, locations: Mapping[str, str] = MACHINE_LOCATIONS
) -> DataFrame:
    """One relation per group; with ``per_location`` repeated for each place the group was seen."""
    relations = precedence_group(visits, "group_id", "relation", "relation")
    if not per_location:
        return relations
    seen = visits.select("group_id", classify_suffix(F.col("pcid"), "_", locations).alias("location"))
    return seen.dropna().distinct().join(relations, "group_id")


def visit_event_etl_60s(events: DataFrame, visits: DataFrame, as_of: date) -> DataFrame:
    """First kiosk: locate, repair item names, dwell up to 60 s, relation by group and location."""
    flat = flatten_params(
        events.where(F.col("event_name").isin(*EVENTS_A)), list(PARAMS_A), names=PARAMS_A
    )
    placed = flat.withColumn(
        "location", classify_contains(F.col("page_url"), URL_LOCATIONS)
    ).dropna(subset=["location"])
    item = blank_coalesce(F.col("course_name"), F.col("item_name"))
    item = url_segment_map(F.col("event_name"), item, F.col("page_url"), MENU_EVENT, MENU_PAGES)
    timed = placed.withColumn("item_name", item).withColumn(
        "event_timestamp", epoch_micros_to_ts(F.col("event_timestamp"))
    )
    timed = dwell_time(
        timed, ["event_date", "ga_session_id"], "event_timestamp", "event_id", cap_s=60
    )
    relations = group_relations(visit_window(visits, "visittime", as_of), per_location=True)
    return enrich_left(timed, relations, ["group_id", "location"]).select(
        "event_id", "event_date", "event_timestamp", "event_name", "item_name", "stay_time",
        "group_id", "relation", "location",
    )


def visit_event_etl_30s(events: DataFrame, visits: DataFrame, as_of: date) -> DataFrame:
    """Second kiosk: drop events without item, dwell up to 30 s, relation by group."""
    flat = flatten_params(events, list(PARAMS_B), names=PARAMS_B).dropna(subset=["item_name"])
    timed = flat.withColumn("event_timestamp", epoch_micros_to_ts(F.col("event_timestamp")))
    timed = dwell_time(
        timed, ["event_date", "ga_session_id"], "event_timestamp", "event_id", cap_s=30
    )
    relations = group_relations(visit_window(visits, "visittime", as_of), per_location=False)
    return enrich_left(timed, relations, ["group_id"]).select(
        "event_id", "event_date", "event_timestamp", "event_name", "item_name", "stay_time",
        F.nullif("group_id", F.lit("")).alias("group_id"), "relation", "brand_name",
    )


def relation_backfill(visits: DataFrame, scope: str) -> DataFrame:
    """Set ``relation_group`` on all rows of the groups seen in scope.

    ``latest_day``: groups of the newest visit's day; ``unset``: groups with a
    row that has no ``relation_group`` yet. The label comes from the rows in
    scope and is written to every row of the group.
    """
    if scope == "latest_day":
        kind = dict(visits.dtypes)["visittime"]
        newest = visits.agg(F.to_date(F.max("visittime")).alias("day")).scalar()
        # bounds on the bare column, so that row groups can be skipped
        start, end = newest.cast(kind), F.date_add(newest, 1).cast(kind)
        chosen = visits.where((F.col("visittime") >= start) & (F.col("visittime") < end))
    elif scope == "unset":
        chosen = visits.where(F.col("relation_group").isNull())
    else:
        raise ValueError(f"unknown scope {scope!r}")
    labels = precedence_group(chosen, "group_id", "relation", "relation_group")
    return keyed_update(visits, labels, "group_id", "relation_group")


def flatten_web_events(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Daily web analytics load: flat context columns + one column per listed parameter.

    Events without any listed parameter are dropped, and so are repeated rows.
    """
    context = events.select(
        "event_name",
        epoch_micros_to_ts(F.col("event_timestamp")).alias("event_timestamp"),
        F.col("device.category").alias("category"),
        F.col("user_pseudo_id").alias("cid"),
        F.col("traffic_source.name").alias("campaign"),
        F.col("traffic_source.medium").alias("medium"),
        F.col("traffic_source.source").alias("source"),
        F.col("geo.country").alias("country"),
        F.col("geo.region").alias("region"),
        "event_params",
    )
    return flatten_params(context, keys, keep_empty=False, dedup=True)


# Parameters the web analytics load keeps.
WEB_PARAMS = (
    "ga_session_id", "ga_session_number", "register_page", "account_email", "name", "phone",
    "method", "account", "product_name", "product_price", "menu_name", "social", "special",
    "banner", "product_share", "label", "keywords", "item", "tel", "add1", "add2", "add3",
    "gender", "birthday", "jobtype", "jobtitle", "marital", "chidren", "refer_url", "url",
    "refer_path", "current_page",
)
