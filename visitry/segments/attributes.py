"""Families read from one row per member: attributes, value label, AI labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import strict_translate
from .context import Ids, SegmentContext, among, as_ids, no_ids, rows_of

# Tag -> column of the member table.
LISTED = {
    "性別": "gender",
    "生日": "birth_month",
    "城市": "city",
    "線下門市名稱": "store_source",
    "會員等級": "level",
    "註冊管道": "source",
}
RANGED = {"年齡級距": "age", "註冊日期": "join_date"}
BRAND_TAG = "會員品牌歸屬"
BRAND_NAMES = "會員"

# Tag -> column of the behaviour table.
AI_COLUMNS = {
    "消費貢獻力": "b0",
    "顧客續購程度": "b1",
    "流失風險": "b2",
    "線上轉換潛力": "b3",
    "廣告回應程度": "b4",
    "顧客生命週期": "b5",
    "顧客終身價值": "b7",
}


def basic(ctx: SegmentContext, tag: str, value, web=None, more=None) -> Ids:
    member = ctx.tables("member")
    if tag in LISTED:
        return rows_of("member", member, among(F.col(LISTED[tag]), value), unique=True)
    if tag in RANGED:
        c = F.col(RANGED[tag])
        low, high = (F.lit(value[k]).cast(dict(member.dtypes)[RANGED[tag]]) for k in ("low", "high"))
        return rows_of("member", member, c.between(low, high), unique=True)
    if tag == BRAND_TAG:
        if not value:
            return no_ids(ctx)
        names = ctx.tables("name_map").where(F.col("type") == BRAND_NAMES)
        ids = strict_translate(value, names, "name", "id").select(F.col("id").alias("type"))
        return as_ids(member.join(ids, "type", "left_semi"), unique=True)
    return no_ids(ctx)


def value_label(ctx: SegmentContext, tag: str, value, web=None, more=None) -> Ids:
    if tag != "價值分群":
        raise ValueError(f"unknown tag {tag!r}")
    labels = ctx.tables("member_label")
    return rows_of("member_label", labels, among(F.col("value_label"), value), unique=True)


def ai_label(ctx: SegmentContext, tag: str, value, web=None, more=None) -> Ids:
    if tag not in AI_COLUMNS:
        return no_ids(ctx)
    behavior = ctx.tables("member_behavior")
    return rows_of("member_behavior", behavior, among(F.col(AI_COLUMNS[tag]), value), unique=True)
