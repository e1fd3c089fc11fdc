"""Behaviour of web visitors, on the site and off it, mapped to members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import between_times, cmp_predicate, resolve_range
from ..operators.joins import strict_translate
from ..operators.sets import Filtered
from .context import Ids, SegmentContext, among, as_ids

# Tag -> product attribute / session test / utm column.
PRODUCT_COLUMNS = {"造訪商品類別": "category_name", "造訪品牌名稱": "brand_name"}
UTM_COLUMNS = {
    "utm campaign source": "source",
    "utm campaign medium": "medium",
    "utm campaign name": "campaign",
}
OFF_SITE_TABLES = {"興趣標籤": "interest_prefer", "關注媒體類型標籤": "media_prefer"}
# Page types that are their own genre.
PLAIN_GENRES = ("menu", "首頁", "banner")
# Tags decided by counting one log per visitor, and the log's clock.
COUNTED = {
    "造訪商品名稱": "view_log",
    "有造訪過網站": "web_session",
    "有登入過": "web_session",
    "平均瀏覽時長": "web_session",
    "有加入購物車但未結": "cart_buy",
    "有轉換過": "cart_buy",
    "utm campaign source": "utm",
    "utm campaign medium": "utm",
    "utm campaign name": "utm",
}
CLOCKS = {"view_log": "date", "web_session": "start_time", "cart_buy": "date", "utm": "date"}


def to_members(ctx: SegmentContext, visitors: DataFrame, unique: bool, member: bool) -> Ids:
    """Visitor ids (column cid) to member ids; unmapped visitors are dropped."""
    if not member:
        return as_ids(visitors, unique, col="cid")
    mapped = visitors.join(ctx.tables("cid_map").select("cid", "member_id"), "cid")
    # several visitor ids may belong to one member
    return as_ids(mapped, unique=False)


def off_site(ctx: SegmentContext, tag: str, value=(), web=None, more=None, member=True) -> Ids:
    if tag not in OFF_SITE_TABLES:
        raise ValueError(f"unknown tag {tag!r}")
    start, end = resolve_range((more or {}).get("time_range"), ctx.as_of)
    seen = ctx.tables(OFF_SITE_TABLES[tag]).where(
        among(F.col("value"), value) & between_times(F.col("date"), start, end, is_date=True)
    )
    return to_members(ctx, seen.select(F.col("ga_id").alias("cid")).distinct(), True, member)


def _titles(ctx: SegmentContext, web: str, value: Mapping) -> DataFrame:
    """All titles of a page type's genre (genres holding a 0 excepted)."""
    page_type = next(iter(value))
    refer = ctx.site_table("refer", web).where(~F.col("genre").contains("0"))
    if page_type in PLAIN_GENRES:
        found = refer.where(F.col("genre") == page_type)
    else:
        genre = strict_translate([page_type], ctx.tables("name_map"), "name", "type")
        found = refer.join(genre.select(F.col("type").alias("genre")), "genre", "left_semi")
    return found.select(F.col("title").alias("item"))


def visitor_totals(
    ctx: SegmentContext, docs: Sequence[Mapping], table: str, web: str, member: bool = True
) -> list[Filtered]:
    """One test per rule on a shared table of per-visitor counts of one log.

    Rules differ in period, values and limits; their counts are conditional
    aggregates of a single pass, and visitors are mapped to members once.
    """
    rows, sums, tests = [], {}, []
    for i, doc in enumerate(docs):
        tag, value, more = doc["tag"], doc["value"], doc.get("more_option") or {}
        start, end = resolve_range(more.get("time_range"), ctx.as_of)
        clock = CLOCKS[table]
        row = between_times(F.col(clock), start, end, is_date=clock == "date")
        n, limits = F.col(f"n{i}"), more.get("count") or {}
        enough = cmp_predicate(n, op=limits.get("moreOrless"), value=limits.get("count"))
        test = (n > 0) & enough
        if table == "view_log":
            listed = value if tag == "造訪商品名稱" else next(iter(value.values()))
            row = row & among(F.col("item"), list(listed))
        elif tag == "有登入過":
            row = row & (F.col("login") == 1)
        elif tag == "平均瀏覽時長":
            length = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
            sums[f"minutes{i}"] = F.avg(F.when(row, length)) / 60
            test = F.col(f"minutes{i}").between(value["low"], value["high"])
        elif tag in UTM_COLUMNS:
            row = row & among(F.col(UTM_COLUMNS[tag]), value)
            test = n > 0
        elif table == "cart_buy":
            sums[f"buys{i}"] = F.count_if(row & (F.col("type") == "conversion"))
            test = F.col(f"buys{i}") > 0
            if tag == "有加入購物車但未結":
                sums[f"carts{i}"] = F.count_if(row & (F.col("type") == "cart"))
                test = (F.col(f"carts{i}") > 0) & (F.col(f"buys{i}") == 0)
        sums[f"n{i}"] = F.count_if(row)
        rows.append(row)
        tests.append(test)
    log = ctx.site_table(table, web).where(reduce(lambda a, b: a | b, rows))
    totals = log.groupBy("cid").agg(*[c.alias(n) for n, c in sums.items()])
    key = "cid"
    if member:
        totals, key = totals.join(ctx.tables("cid_map").select("cid", "member_id"), "cid"), "member_id"
    name = f"{table} totals {web}"
    known = F.col(key).isNotNull()
    return [Filtered(name, totals, known & test, F.col(key).cast("string")) for test in tests]


def counted_table(tag: str, value) -> str | None:
    """The log whose per-visitor counts decide the rule, if nothing else is needed."""
    if tag == "造訪頁面類別":
        return "view_log" if next(iter(value.values())) else None
    return COUNTED.get(tag)


def on_site(ctx: SegmentContext, tag: str, value=(), web="main", more=None, member=True) -> Ids:
    table = counted_table(tag, value)
    if table is not None:
        doc = {"tag": tag, "value": value, "more_option": more}
        return Ids(visitor_totals(ctx, [doc], table, web, member)[0], unique=False)

    start, end = resolve_range((more or {}).get("time_range"), ctx.as_of)
    limits = (more or {}).get("count") or {}
    views = ctx.site_table("view_log", web).where(
        between_times(F.col("date"), start, end, is_date=True)
    )
    if tag in PRODUCT_COLUMNS:
        wanted = ctx.tables("brand").where(among(F.col(PRODUCT_COLUMNS[tag]), value))
        items = wanted.select(F.col("product_name").alias("item"))
    elif tag == "造訪頁面類別":
        items = _titles(ctx, web, value)
    else:
        raise ValueError(f"unknown tag {tag!r}")
    # counted per (visitor, item) first, so that the join sees one row per pair
    pairs = views.groupBy("cid", "item").agg(F.count("item").alias("n"))
    counts = pairs.join(items.distinct(), "item", "left_semi").groupBy("cid").agg(F.sum("n").alias("n"))
    enough = cmp_predicate(F.col("n"), op=limits.get("moreOrless"), value=limits.get("count"))
    return to_members(ctx, counts.where(enough), True, member)
