"""Purchase behaviour: presence, products, amounts, frequency, recency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import between_times, cmp_predicate, resolve_range
from ..operators.sets import Filtered
from .context import Ids, SegmentContext, among, as_ids, rows_of

# Channel word -> values of the online flag.
CHANNELS = {"線上": (1,), "線下": (0,), "整體": (0, 1)}
# Tag -> product attribute / graded column of the label table.
PRODUCT_COLUMNS = {
    "購買的商品名稱": "product_name",
    "購買的類別名稱": "category_name",
    "購買的品牌名稱": "brand_name",
}
GRADE_COLUMNS = {
    "消費金額分級": "monetary",
    "客單價分級": "aov",
    "消費頻率分級": "frequency",
    "距離上次購買分級": "last_purchase",
}
# Tags decided by a member's totals.
BUYERS, FIRST_BUYERS = "有購買的人", "首購的人"
TOTALS = (BUYERS, "累計消費金額", "平均客單價", "累計消費次數")
EVERY_ORDER = (BUYERS, FIRST_BUYERS)


def _options(more) -> tuple[dict, dict]:
    """Comparison arguments for the order count and for the cost."""
    more = more or {}
    count, cost = more.get("count") or {}, more.get("cost") or {}
    return (
        {"op": count.get("moreOrless"), "value": count.get("count")},
        {
            "op": cost.get("moreOrlessForCost"),
            "value": cost.get("cost"),
            "low": cost.get("lowCost"),
            "high": cost.get("highCost"),
        },
    )


def _amount_test(c: Column, value) -> Column:
    value = value or {}
    return cmp_predicate(
        c, value.get("moreOrless"), value.get("cost"), value.get("low"), value.get("high")
    )


def member_totals(ctx: SegmentContext, docs: Sequence[Mapping]) -> list[Filtered]:
    """One test per rule on a shared table of per-member totals.

    Rules differ in channel, time range and limits; their sums and counts are
    conditional aggregates of a single pass over the purchases. Lines are first
    summed per order, so a member holding a third of all lines is spread over
    its orders.
    """
    scopes: dict[tuple, Column] = {}
    order_sums, member_sums, tests = {}, {}, []
    for i, doc in enumerate(docs):
        start, end = resolve_range((doc.get("more_option") or {}).get("time_range"), ctx.as_of)
        scope = (doc["web"], start, end)
        if scope not in scopes:
            dated = between_times(F.col("date"), start, end, is_date=True)
            scopes[scope] = _channel(doc["web"]) & dated
            s = len(scopes) - 1
            order_sums[f"total{s}"] = F.sum(F.when(scopes[scope], F.col("sales")))
            order_sums[f"lines{s}"] = F.count(F.when(scopes[scope], 1))
            member_sums[f"orders{s}"] = F.count_if(F.col(f"lines{s}") > 0)
            member_sums[f"sales{s}"] = F.sum(f"total{s}")
        s = list(scopes).index(scope)
        orders, sales, value = F.col(f"orders{s}"), F.col(f"sales{s}"), doc["value"]
        count, cost = _options(doc.get("more_option"))
        if doc["tag"] in EVERY_ORDER:
            passed = F.when(F.col(f"lines{s}") > 0, cmp_predicate(F.col(f"total{s}"), **cost))
            member_sums[f"every{i}"] = F.bool_and(passed)
            test = F.col(f"every{i}")
            if doc["tag"] == BUYERS:
                test = test & cmp_predicate(orders, **count)
        elif doc["tag"] == "累計消費金額":
            test = _amount_test(sales, value)
        elif doc["tag"] == "平均客單價":
            test = _amount_test(sales / F.nullif(orders, F.lit(0)), value)
        else:
            test = _amount_test(orders, value)
        tests.append((orders > 0) & test)
    bought = ctx.tables("purchase").where(F.col("member_id").isNotNull())
    inside = reduce(lambda a, b: a | b, scopes.values())
    per_order = bought.where(inside).groupBy("member_id", "order_id").agg(
        *[c.alias(n) for n, c in order_sums.items()]
    )
    totals = per_order.groupBy("member_id").agg(*[c.alias(n) for n, c in member_sums.items()])
    key = F.col("member_id").cast("string")
    return [Filtered("purchase totals", totals, test, key) for test in tests]


def product_totals(ctx: SegmentContext, docs: Sequence[Mapping]) -> list[Filtered]:
    """One test per product rule on a shared table of per-member order counts.

    All rules read the purchases of any wanted product once. A product listed
    twice in the brand table changes nothing: orders are counted, and "every
    line" does not mind repeats.
    """
    brand, sums, members, tests, wanted, dates = ctx.tables("brand"), {}, {}, [], [], []
    for i, doc in enumerate(docs):
        start, end = resolve_range((doc.get("more_option") or {}).get("time_range"), ctx.as_of)
        count, cost = _options(doc.get("more_option"))
        product = among(F.col(PRODUCT_COLUMNS[doc["tag"]]), doc["value"])
        scope = _channel(doc["web"]) & between_times(F.col("date"), start, end, is_date=True)
        line = product & scope
        sums[f"lines{i}"] = F.count_if(line)
        sums[f"every{i}"] = F.bool_and(F.when(line, cmp_predicate(F.col("sales"), **cost)))
        members[f"orders{i}"] = F.count_if(F.col(f"lines{i}") > 0)
        members[f"every{i}"] = F.bool_and(f"every{i}")
        orders = F.col(f"orders{i}")
        tests.append((orders > 0) & F.col(f"every{i}") & cmp_predicate(orders, **count))
        wanted.append(product)
        dates.append(scope)

    def any_of(conditions: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a | b, conditions)

    bought = ctx.tables("purchase").where(F.col("member_id").isNotNull() & any_of(dates))
    lines = bought.join(brand.where(any_of(wanted)), "product_id")
    per_order = lines.groupBy("member_id", "order_id").agg(*[c.alias(n) for n, c in sums.items()])
    totals = per_order.groupBy("member_id").agg(*[c.alias(n) for n, c in members.items()])
    key = F.col("member_id").cast("string")
    return [Filtered("product totals", totals, test, key) for test in tests]


def _channel(web: str) -> Column:
    if web not in CHANNELS:
        raise ValueError(f"unknown channel {web!r}")
    return F.col("online").isin(*CHANNELS[web])


def purchase_behavior(ctx: SegmentContext, tag: str, value=(), web=None, more=None) -> Ids:
    if tag in GRADE_COLUMNS:
        labels = ctx.tables("member_label")
        return rows_of("member_label", labels, among(F.col(GRADE_COLUMNS[tag]), value), unique=True)
    online = _channel(web)
    doc = {"tag": tag, "value": value, "web": web, "more_option": more}
    if tag in TOTALS:
        return Ids(member_totals(ctx, [doc])[0], unique=True)
    if tag in PRODUCT_COLUMNS:
        return Ids(product_totals(ctx, [doc])[0], unique=True)

    start, end = resolve_range((more or {}).get("time_range"), ctx.as_of)

    def dated(df: DataFrame, col: str = "date") -> DataFrame:
        return df.where(between_times(F.col(col), start, end, is_date=True))

    bought = ctx.tables("purchase").where(F.col("member_id").isNotNull())
    if tag == "未購買的人":
        members = ctx.tables("member").where(online).select("member_id")
        # buyers are not restricted to the channel
        buyers = dated(bought).select("member_id").distinct()
        return as_ids(members.join(buyers, "member_id", "left_anti"), unique=True)
    if tag == FIRST_BUYERS:
        joined = dated(ctx.tables("member").where(online), "join_date").select(
            F.col("member_id").cast("string")
        )
        every = member_totals(ctx, [doc])[0].ids("member_id")
        return as_ids(joined.join(every, "member_id", "left_semi"), unique=True)
    if tag == "距離上次購買天數區隔":
        last = bought.where(online).groupBy("member_id").agg(F.max("date").alias("last"))
        days = F.date_diff(F.lit(end.date()), F.col("last"))
        return as_ids(last.where(days.between(value["low"], value["high"])), unique=True)
    raise ValueError(f"unknown tag {tag!r}")
