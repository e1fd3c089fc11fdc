"""Monthly label reports and the activity calendar."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions import exclude_product_code
from ..operators.joins import cross_grid, densify
from ..operators.sets import union_all

# Channels and reactions of the rating grid.
CHANNELS = ("email", "sms", "fb")
REACTIONS = ("高", "中", "低", "無")


def _month_bounds(month: str) -> tuple[date, date]:
    year, number = map(int, month.split("-"))
    first = date(year, number, 1)
    return first, date(year + number // 12, number % 12 + 1, 1)


def report_copurchase(
    purchase: DataFrame, members: DataFrame, labels: DataFrame, month: str
) -> DataFrame:
    """Distinct buyers per (label, online, product) of the month's main purchases.

    Purchases are reduced to distinct (member, online, product) before meeting
    the label memberships. Labels without purchases keep one row of nulls.
    """
    first, after = _month_bounds(month)
    bought = (
        purchase.where((F.col("date") >= F.lit(first)) & (F.col("date") < F.lit(after)))
        .where((F.col("add_on") == 0) & exclude_product_code(F.col("product_id"), "contains"))
        .where(F.col("member_id").isNotNull())
        .select(F.col("member_id").cast("string"), "online", "product_id")
        .distinct()
    )
    tagged = bought.join(members.select("member_id", "labelId", "label").distinct(), "member_id")
    # both inputs are distinct, so counting rows counts members
    counts = tagged.groupBy("labelId", "label", "online", "product_id").agg(
        F.count("*").alias("count")
    )
    return labels.select("labelId", "label").join(counts, ["labelId", "label"], "left").select(
        "labelId", "label", F.lit(month).alias("date"), "online", "product_id", "count"
    )


def report_channel_rating(
    users: DataFrame,
    members: DataFrame,
    labels: DataFrame,
    month: str | None = None,
    channels: Sequence[str] = CHANNELS,
    reactions: Sequence[str] = REACTIONS,
) -> DataFrame:
    """Percent of a label's members per channel and reaction, on the full grid.

    ``users``: (member_id, channel, response). Reactions outside the grid keep
    their rows. Labels are matched by id, so equal names do not mix.
    """
    rated = users.join(members.select("member_id", "labelId"), "member_id")
    keys = ["labelId", "channel", "response"]
    counts = rated.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n"))
    totals = counts.groupBy("labelId", "channel").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, ["labelId", "channel"]).select(
        *keys, (F.lit(100.0) * F.col("n") / F.col("total")).alias("percentage")
    )
    names = labels.select("labelId", "label").distinct()
    grid = cross_grid(names.select("labelId"), channel=channels, response=reactions)
    filled = densify(shares, grid, keys, {"percentage": 0.0}, extra=True)
    out = filled.join(names, "labelId").select(
        "labelId", "label", "channel", F.col("response").alias("reaction"), "percentage"
    )
    return out if month is None else out.withColumn("month", F.lit(month))


def activity_range(activity: DataFrame, schedules: Sequence[DataFrame]) -> DataFrame:
    """Activities with dates widened to their scripts' first and last schedule.

    ``schedules``: tables (script_name, schedule_time). The union need not be
    distinct, as only its extremes are used. Unscheduled activities stay.
    """
    spans = union_all(*[s.select("script_name", "schedule_time") for s in schedules])
    spans = spans.groupBy(F.col("script_name").alias("activity_id")).agg(
        F.to_date(F.min("schedule_time")).alias("_first"),
        F.to_date(F.max("schedule_time")).alias("_last"),
    )
    return spans.join(activity, "activity_id", "right").select(
        "activity_id",
        "activity_name",
        F.least("start_date", "_first").alias("start_date"),
        F.greatest("end_date", "_last").alias("end_date"),
        "time",
    )


