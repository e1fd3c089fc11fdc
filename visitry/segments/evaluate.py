"""Evaluators: rule lists and label lists folded to member ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import parse_json_column, value_map
from ..operators.sets import Filtered, fold_membership
from .context import SegmentContext, as_ids, no_ids, rows_of
from .families import rule_sources
from .index import indexed_members

# How a rule combines with those before it; other modes do nothing.
MODES = {"初": "or", "或": "or", "且": "and"}


def segment_content(ctx: SegmentContext, rules: Sequence[Mapping]) -> DataFrame:
    """Distinct member ids of a rule list, folded left to right in one shuffle."""
    steps = _folds(ctx, {"": rules}).get("")
    return fold_membership(steps, "member_id") if steps else no_ids(ctx).df


def _folds(ctx: SegmentContext, contents: Mapping[str, Sequence[Mapping]]) -> dict[str, list]:
    """Steps per label, rules without effect left out. Sources are shared across labels."""
    docs = [(label, r) for label, rules in contents.items() for r in rules if r["mode"] in MODES]
    folds: dict[str, list] = {}
    for (label, r), source in zip(docs, rule_sources(ctx, [r for _, r in docs])):
        folds.setdefault(label, []).append((source, MODES[r["mode"]]))
    return folds


def segment_all(ctx: SegmentContext) -> DataFrame:
    return as_ids(ctx.tables("member"), unique=True).df


def segment_test(ctx: SegmentContext, label: str, kind: str = "email") -> DataFrame:
    """Contacts of a test list: JSON arrays of mail addresses and of phone numbers."""
    if kind not in ("email", "phone"):
        raise ValueError(f"unknown kind {kind!r}")
    rows = ctx.tables("test_list").where(F.col("label_id") == label)
    return rows.select(F.explode(parse_json_column(F.col(kind))).alias("member_id"))


def segment_list(ctx: SegmentContext, label: str) -> DataFrame:
    """Distinct members of a stored list, or all others where it is marked as excluding.

    The list is ``{"content": [...]}``. Its include flag is compared inside the
    plan, so nothing is read while building it; listed and existing members meet
    in one shuffle, whichever side is wanted.
    """
    rows = ctx.tables("stored_list").where(F.col("label_id") == label)
    content = parse_json_column(F.get_json_object("list", "$.content"))
    listed = rows.select(F.explode(content).alias("member_id"), F.lit(True).alias("_listed"))
    everyone = segment_all(ctx).withColumn("_listed", F.lit(False))
    flag = rows.agg(F.min("include")).scalar()
    merged = listed.unionByName(everyone).groupBy("member_id").agg(F.bool_or("_listed").alias("_listed"))
    return merged.where(F.col("_listed") == (flag == 1)).select("member_id")


def segment_upload(ctx: SegmentContext, label: str) -> DataFrame:
    rows = ctx.tables("upload_list").where(F.col("label_id") == label)
    return rows.select(F.explode(F.col("members").cast("array<string>")).alias("member_id"))


def _is_content(label: str) -> bool:
    return label.startswith(("C_", "X"))


def _label_source(
    ctx: SegmentContext, label: str, kind: str, contents: DataFrame | None
) -> DataFrame | Filtered:
    if _is_content(label):
        return Filtered("contents", contents, F.col("labelId") == label, F.col("member_id"))
    if label.startswith("ALL"):
        return rows_of("member", ctx.tables("member"), F.lit(True)).source
    if label.startswith("T_"):
        return segment_test(ctx, label, kind)
    if label.startswith("SS_"):
        return segment_list(ctx, label)
    if label.startswith("U_"):
        return segment_upload(ctx, label)
    return no_ids(ctx).df


def segment_include_exclude(
    ctx: SegmentContext, rows: Sequence[tuple[str, int]], kind: str = "email"
) -> DataFrame:
    """Fold of (label, include) rows: add the label's members, or take them away.

    All labels given by rules are folded together first, then the rows.
    """
    if not rows:
        return no_ids(ctx).df
    ruled = list(dict.fromkeys(label for label, _ in rows if _is_content(label)))
    contents = _content_members(ctx, ruled) if ruled else None
    steps = [
        (_label_source(ctx, label, kind, contents), "or" if include else "not")
        for label, include in rows
    ]
    return fold_membership(steps, "member_id")


def _content_members(ctx: SegmentContext, labels: Sequence[str]) -> DataFrame:
    """(member_id, labelId) of labels given by rules, looked up in an index of all their rules.

    A label without rules (deleted, say) has no members.
    """
    folds = {label: [(r, MODES[r["mode"]]) for r in ctx.contents.get(label, ()) if r["mode"] in MODES] for label in labels}
    return indexed_members(ctx, folds)


def label_catalog(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("label_id").alias("labelId"), F.col("name").alias("label"))


def label_membership(ctx: SegmentContext, labels: Mapping[str, str]) -> DataFrame:
    """(member_id, labelId, label) of all given labels (``{id: name}``), in one shuffle."""
    found = _content_members(ctx, list(labels))
    return found.withColumn("label", value_map(F.col("labelId"), labels, keep_unknown=True))
