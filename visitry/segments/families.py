"""Dispatch from a rule's type to its predicate family."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from ..operators.sets import Filtered

from .attributes import ai_label, basic, value_label
from .context import Ids, SegmentContext
from .online import counted_table, off_site, on_site, visitor_totals
from .purchases import (
    PRODUCT_COLUMNS,
    TOTALS,
    member_totals,
    product_totals,
    purchase_behavior,
)
from .remarketing import remarketing

# Rule types.
FAMILIES = {
    "基本屬性": basic,
    "價值分群": value_label,
    "渠道再行銷": remarketing,
    "AI顧客分群": ai_label,
    "消費行為": purchase_behavior,
    "網站行為": on_site,
    "CF站外瀏覽": off_site,
}


def rule_ids(ctx: SegmentContext, doc: Mapping) -> Ids:
    kind = doc["type"]
    family = FAMILIES.get(kind) or ctx.custom.get(kind.split("_")[0])
    if family is None:
        raise ValueError(f"unknown rule type {kind!r}")
    return family(ctx, doc["tag"], doc["value"], doc.get("web"), doc.get("more_option"))


def rule_sources(ctx: SegmentContext, docs: Sequence[Mapping]) -> list[DataFrame | Filtered]:
    """What to fold for each rule; rules on totals of one table share one pass over it."""
    sources: list = [None] * len(docs)
    shared: dict[tuple, list[int]] = {}
    for i, doc in enumerate(docs):
        how = _shared_pass(doc)
        if how is None:
            sources[i] = rule_ids(ctx, doc).source
        else:
            shared.setdefault(how, []).append(i)
    for (totals, *args), places in shared.items():
        for i, source in zip(places, totals(ctx, [docs[p] for p in places], *args)):
            sources[i] = source
    return sources


def _shared_pass(doc: Mapping) -> tuple | None:
    """Function (with arguments) evaluating the rule together with others like it."""
    if doc["type"] == "消費行為" and doc["tag"] in TOTALS:
        return (member_totals,)
    if doc["type"] == "消費行為" and doc["tag"] in PRODUCT_COLUMNS:
        return (product_totals,)
    if doc["type"] == "網站行為":
        table = counted_table(doc["tag"], doc["value"])
        return (visitor_totals, table, doc["web"]) if table else None
    return None


def predicate(ctx: SegmentContext, doc: Mapping) -> DataFrame:
    """Distinct member ids (strings) satisfying one rule."""
    return rule_ids(ctx, doc).distinct()
