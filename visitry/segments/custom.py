"""Predicates a tenant can register under its own rule-type prefix.

``SegmentContext.custom`` maps the prefix (the part of a rule's type before the
first underscore) to one of these or to any function of the same shape.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.joins import join_or_keys
from .context import Ids, SegmentContext, among, as_ids


def _line_members(ctx: SegmentContext, rows) -> Ids:
    found = join_or_keys(
        ctx.tables("member"), rows.select("line_id"), "member_id", ("line_id", "line_id2")
    )
    return as_ids(found, unique=True)


def line_value(ctx: SegmentContext, tag: str, value=(), web=None, more=None) -> Ids:
    """Members by either messenger id, of the type named after the last ``_`` in ``web``."""
    rows = ctx.tables("line_custom").where(
        (F.col("type") == web.split("_")[-1]) & among(F.col("value"), value)
    )
    return _line_members(ctx, rows)


def line_tag_value(ctx: SegmentContext, tag: str, value=(), web=None, more=None) -> Ids:
    """As ``line_value``, and the tag must match too."""
    rows = ctx.tables("line_custom").where(
        (F.col("type") == web.split("_")[-1]) & (F.col("tag") == tag) & among(F.col("value"), value)
    )
    return _line_members(ctx, rows)
