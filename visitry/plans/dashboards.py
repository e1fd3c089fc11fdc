"""Dashboard aggregations over visits (camera) and kiosk records (clicks)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    age_bucket,
    between_times,
    classify_suffix,
    duration_minutes,
    parse_measure,
    round_half_even,
    value_map,
)
from ..operators.aggregates import (
    growth_percent,
    grouping_total,
    period_growth,
    share_of_total,
    two_level_agg,
    value_counts,
)
from ..operators.joins import cross_grid, densify
from ..operators.reshape import split_explode
from ..operators.windows import top_bottom_per_group, topk_global, topn_per_group
from .visits import MACHINE_LOCATIONS

# Names the dashboards show.
RELATION_NAMES = {"male": "男", "female": "女", "friend": "朋友", "couple": "情侶", "family": "家庭"}
EVENT_NAMES_A = {
    "點擊下方項目": "選單", "點擊地圖項目": "地圖", "點擊課程更多資訊": "課程", "點擊購物更多資訊": "購物",
}
EVENT_NAMES_B = {
    "select_brand": "品牌", "select_product": "產品", "select_activity": "活動",
    "select_related_product": "產品",
}
FILTER_NAMES = {"select_filter_activity": "活動", "select_filter_product": "產品"}
GENDERS = ("男", "女")
AGE_BANDS = ("25歲以下", "26-35歲", "36-45歲", "46歲以上")
HOMEPAGE_EVENT, RELATED_EVENT = "select_homepage", "select_related_product"
BLOCKED_ITEMS = ("茶2",)
DEFAULT_MINUTES = 0.5


def _days(c: Column, first: date, last: date) -> Column:
    """Timestamps of whole days, from midnight to the last second."""
    end = datetime.combine(last, time(23, 59, 59))
    return between_times(c, datetime.combine(first, time()), end, is_date=False)


def _visits_a(visits: DataFrame, first: date, last: date) -> DataFrame:
    return visits.where(_days(F.col("visittime"), first, last)).withColumn(
        "location", classify_suffix(F.col("pcid"), "_", MACHINE_LOCATIONS)
    )


def _stay(c: str = "staytime") -> Column:
    return parse_measure(F.col(c), " sec")


def dash_a_info(visits: DataFrame, first: date, last: date) -> DataFrame:
    """Per location: distinct groups, mean of the groups' total stay."""
    seen = _visits_a(visits, first, last).withColumn("stay", _stay())
    return two_level_agg(
        seen, ["group_id", "relation_group", "location"], ["location"], "stay", "group_id"
    )


def dash_a_timeline(visits: DataFrame, first: date, last: date) -> DataFrame:
    """The same per location and day."""
    seen = _visits_a(visits, first, last).withColumn("stay", _stay())
    seen = seen.withColumn("date", F.to_date("visittime"))
    return two_level_agg(
        seen, ["date", "group_id", "relation_group", "location"], ["location", "date"], "stay",
        "group_id",
    )


def dash_a_relation(visits: DataFrame, first: date, last: date) -> DataFrame:
    """Share of each relation per location, every group counted once, blanks left out."""
    groups = _visits_a(visits, first, last).select("group_id", "relation_group", "location")
    named = groups.distinct().where(F.col("relation_group") != "").withColumn(
        "relation", value_map(F.col("relation_group"), RELATION_NAMES, keep_unknown=True)
    )
    shares = share_of_total(named, ["location", "relation"], ["location"], "share")
    return shares.select("location", "relation", round_half_even(F.col("share"), 2).alias("share"))


def dash_a_age(visits: DataFrame, first: date, last: date) -> DataFrame:
    """Visits per location and age band."""
    age = parse_measure(F.col("age"), "歲")
    seen = _visits_a(visits, first, last).withColumn("age_range", age_bucket(age, "bands8"))
    return value_counts(seen, ["location"], "age_range")


def _clicks_a(records: DataFrame, first: date, last: date) -> DataFrame:
    chosen = records.where(
        F.col("event_date").between(F.lit(first), F.lit(last))
        & F.col("event_name").isin(*EVENT_NAMES_A)
    )
    return chosen.withColumn(
        "event_name", value_map(F.col("event_name"), EVENT_NAMES_A, keep_unknown=True)
    )


def _click_stay(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Clicks and minutes per key in one aggregate; keys with a null are left out."""
    return df.dropna(subset=list(by)).groupBy(*by).agg(
        F.count("*").alias("clicks"),
        duration_minutes(F.coalesce(F.sum("stay_time"), F.lit(0.0))).alias("minutes"),
    )


def dash_a_click_stay(records: DataFrame, first: date, last: date) -> DataFrame:
    return _click_stay(_clicks_a(records, first, last), ["location", "event_name", "item_name"])


def dash_a_click_stay_rel(records: DataFrame, first: date, last: date) -> DataFrame:
    """The same by relation, on the grid location x relation x items of the event."""
    named = _clicks_a(records, first, last).withColumn(
        "relation", value_map(F.col("relation"), RELATION_NAMES, keep_unknown=True)
    )
    keys = ["location", "event_name", "item_name", "relation"]
    cells = _click_stay(named, keys)
    items = cells.select("event_name", "item_name").distinct()
    grid = cross_grid(
        items, location=sorted(set(MACHINE_LOCATIONS.values())),
        relation=list(RELATION_NAMES.values()),
    ).join(cells.select("location").distinct(), "location", "left_semi")
    return densify(cells, grid, keys, {"clicks": 0, "minutes": 0.0})


def dash_a_top10(records: DataFrame, first: date, last: date) -> DataFrame:
    """Ten most clicked items per location and event (item name breaks ties)."""
    by = ["location", "event_name"]
    clicks = _clicks_a(records, first, last).dropna(subset=[*by, "item_name"])
    counts = clicks.groupBy(*by, "item_name").agg(F.count("*").alias("clicks"))
    return topn_per_group(counts, by, [F.desc("clicks"), F.asc("item_name")], 10).drop("rank")


def dash_b_info(
    visits: DataFrame, records: DataFrame, first: date, last: date, device: str
) -> DataFrame:
    """Four figures with growth over the equally long period before.

    No growth at all is shown when any of the earlier figures is zero.
    """
    seen = visits.where(F.col("pcid") == device)
    watched = period_growth(
        seen, F.to_date("visittime"), first, last,
        {
            "views": ("count", F.lit(1)),
            "groups": ("nunique", F.col("group_id")),
            "stay": ("mean", _stay()),
        },
    )
    clicked = period_growth(
        records.where(F.col("event_name") == HOMEPAGE_EVENT),
        F.to_date("event_timestamp"), first, last, {"home_clicks": ("count", F.lit(1))},
    )
    names = ("views", "groups", "stay", "home_clicks")
    columns = [f"{p}_{n}" for p in ("cur", "prev") for n in names]
    both = watched.unionByName(clicked, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in columns]
    )
    usable = F.lit(True)
    for name in names:
        usable = usable & (F.coalesce(F.col(f"prev_{name}"), F.lit(0.0)) != 0)
    rows = [
        F.struct(
            F.lit(name).alias("kpi"),
            round_half_even(F.col(f"cur_{name}"), 2).alias("value"),
            F.when(usable, growth_percent(F.col(f"cur_{name}"), F.col(f"prev_{name}"))).alias("growth"),
        )
        for name in names
    ]
    return both.select(F.inline(F.array(*rows)))


def dash_b_timeline(visits: DataFrame, first: date, last: date, device: str) -> DataFrame:
    """Visitors and mean stay per day and gender, plus a row for all."""
    seen = visits.where((F.col("pcid") == device) & _days(F.col("visittime"), first, last))
    seen = seen.select(F.to_date("visittime").alias("date"), "gender", _stay().alias("stay"))
    return grouping_total(
        seen, "date", "gender",
        [F.count("stay").alias("visitors"), round_half_even(F.avg("stay"), 2).alias("mean_stay")],
    )


def dash_b_relation(visits: DataFrame, first: date, last: date, device: str) -> DataFrame:
    """Share of the five relations over distinct groups, absent ones as zero."""
    seen = visits.where((F.col("pcid") == device) & _days(F.col("visittime"), first, last))
    groups = seen.select("relation_group", "group_id").distinct()
    known = groups.where(F.col("relation_group").isin(*RELATION_NAMES))
    shares = share_of_total(known, ["relation_group"], [], "share").select(
        "relation_group", round_half_even(F.col("share"), 2).alias("share")
    )
    grid = _literal_rows(visits, relation_group=list(RELATION_NAMES))
    return densify(shares, grid, ["relation_group"], {"share": 0.0})


def _literal_rows(df: DataFrame, **domains: Sequence) -> DataFrame:
    """Grid of fixed value lists."""
    return cross_grid(df.sparkSession.range(1), **domains).select(*domains)


def dash_b_age_gender(visits: DataFrame, first: date, last: date, device: str) -> DataFrame:
    """Visitors per gender and age band, all eight cells."""
    seen = visits.where((F.col("pcid") == device) & _days(F.col("visittime"), first, last))
    age = parse_measure(F.col("age"), "歲")
    counts = (
        seen.dropna(subset=["gender"])
        .groupBy("gender", age_bucket(age, "bands4").alias("age_range"))
        .agg(F.count("age").alias("counts"))
    )
    grid = _literal_rows(visits, gender=GENDERS, age_range=AGE_BANDS)
    return densify(counts, grid, ["gender", "age_range"], {"counts": 0})


def _clicks_b(
    records: DataFrame, first: date, last: date, names: Mapping[str, str] = EVENT_NAMES_B
) -> DataFrame:
    chosen = records.where(
        F.col("event_date").between(F.lit(first), F.lit(last)) & F.col("event_name").isin(*names)
    )
    return chosen.withColumn(
        "event_name", value_map(F.col("event_name"), names, keep_unknown=False)
    )


def dash_b_scatter(records: DataFrame, first: date, last: date) -> DataFrame:
    """Clicks and minutes per event and item; an unknown stay counts half a minute."""
    minutes = duration_minutes(F.col("stay_time"), null_as=DEFAULT_MINUTES)
    # hundredths of a minute as integers: sums do not depend on row order
    hundredths = F.rint(minutes * 100).cast("bigint")
    return (
        _clicks_b(records, first, last)
        .dropna(subset=["event_name", "item_name"])
        .groupBy("event_name", F.col("item_name").alias("name"))
        .agg(F.count("*").alias("click"), (F.sum(hundredths) / 100.0).alias("time"))
    )


def dash_b_visitors(records: DataFrame, first: date, last: date) -> DataFrame:
    """Relations behind each event's five most and five least clicked items."""
    keys = ["event_name", "item_name"]
    cells = (
        _clicks_b(records, first, last)
        .dropna(subset=[*keys, "relation"])
        .groupBy(*keys, "relation")
        .agg(F.count("*").alias("value"))
    )
    items = cells.groupBy(*keys).agg(F.sum("value").alias("clicks"))
    chosen = top_bottom_per_group(items, ["event_name"], "clicks", "item_name", 5)
    grid = cross_grid(chosen.select("TB", *keys), relation=list(RELATION_NAMES))
    return densify(cells, grid, [*keys, "relation"], {"value": 0})


def dash_b_recommend(
    records: DataFrame, first: date, last: date, blocked: Sequence[str] = BLOCKED_ITEMS
) -> DataFrame:
    """Ten most clicked related items, without the blocked ones."""
    clicks = records.where(
        F.col("event_date").between(F.lit(first), F.lit(last))
        & (F.col("event_name") == RELATED_EVENT)
        & F.col("item_name").isNotNull()
    )
    counts = clicks.groupBy("item_name").agg(F.count("*").alias("count"))
    return topk_global(counts, [F.desc("count"), F.asc("item_name")], 10, "item_name", blocked)


def dash_b_filters(records: DataFrame, first: date, last: date) -> DataFrame:
    """Ten most used filter names per event; both events appear in any case."""
    used = _clicks_b(records, first, last, FILTER_NAMES).select("event_name", "item_name")
    names = split_explode(used, "item_name", ",", "filter_name")
    counts = names.groupBy("event_name", "filter_name").agg(F.count("*").alias("count"))
    best = topn_per_group(
        counts, ["event_name"], [F.desc("count"), F.asc("filter_name")], 10
    ).drop("rank")
    grid = _literal_rows(records, event_name=list(FILTER_NAMES.values()))
    return grid.join(best, "event_name", "left")
