"""Campaign reactions: who was sent, opened, clicked, bought, by channel.

All reactions are rows of ``channel_touch`` (member_id, channel, family, action,
rule_id, touch_time): one filtered scan replaces a union of per-table queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import between_times, contact_id_clean, resolve_range
from ..operators.joins import below_limits
from .context import Ids, SegmentContext, among, as_ids, no_ids, rows_of

# Tag -> action recorded.
ACTIONS = {"有寄出過": "sent", "有開信過": "open", "有點擊過": "click", "有轉換過": "buy"}
SENDABLE, RATING = "可寄送名單", "互動評級"
# Channel -> its status column, and the prefix of its script rules.
CHANNELS = {"Email": ("email", "ve_"), "SMS": ("sms", "vs_")}
QUOTA_COLUMNS = ("daily", "weekly", "monthly", "yearly")
LIMIT_ROW = "limit"


def _clean(name: str, df: DataFrame, test: Column, unique: bool = False) -> Ids:
    return rows_of(name, df, test & contact_id_clean(F.col("member_id").cast("string")), unique)


def _by_rule(action: str, rule_id: str, script: bool, prefix: bool) -> Column:
    """Script tables record every recipient, so "sent" there needs no flag."""
    c = F.col("rule_id")
    wanted = c.startswith(rule_id) if prefix else c == rule_id
    wanted = wanted & (F.col("family") == ("script" if script else "main"))
    return wanted if script and action == "sent" else wanted & (F.col("action") == action)


def remarketing(ctx: SegmentContext, tag: str, value=(), web=None, more=None) -> Ids:
    if web not in CHANNELS:
        raise ValueError(f"unknown channel {web!r}")
    column, script_prefix = CHANNELS[web]
    more = more or {}
    time_range, rule_id = more.get("time_range") or {}, more.get("event")
    timed = time_range.get("days") or (time_range.get("start_time") and time_range.get("end_time"))

    if tag in (SENDABLE, RATING):
        if timed or rule_id:
            raise ValueError(f"{tag} takes neither a time range nor a rule")
        if tag == SENDABLE:
            status = ctx.tables("member_status")
            return _clean("member_status", status, F.col(column) == "normal", unique=True)
        rated = (F.col("channel") == column) & among(F.col("response"), value)
        return _clean("channel_user", ctx.tables("channel_user"), rated)
    if tag not in ACTIONS:
        raise ValueError(f"unknown tag {tag!r}")

    action = ACTIONS[tag]
    if web == "SMS" and action == "open":
        return no_ids(ctx)
    test = F.col("channel") == web
    if timed:
        start, end = resolve_range(time_range, ctx.as_of)
        moment = between_times(F.col("touch_time"), start, end, is_date=False)
        test = test & (F.col("action") == action) & moment
    elif rule_id:
        script = rule_id.startswith(script_prefix)
        test = test & _by_rule(action, rule_id, script, prefix=script or web == "Email")
    else:
        test = test & (F.col("action") == action)
    return _clean("channel_touch", ctx.tables("channel_touch"), test)


def sendable_below_quota(ctx: SegmentContext, web: str, limits=None) -> Ids:
    """Members the channel may still write to today: status normal, all quotas unused.

    ``limits`` is a one-row table; by default the quota table's own limit row.
    """
    column, _ = CHANNELS[web]
    quota = ctx.tables("quota")
    if limits is None:
        limits = quota.where(F.col("member_id") == LIMIT_ROW)
    below = below_limits(quota, limits, QUOTA_COLUMNS).select("member_id")
    status = ctx.tables("member_status").where(F.col(column) == "normal")
    return as_ids(status.select(F.col("member_id").cast("string")).join(below, "member_id", "left_semi"), True)
