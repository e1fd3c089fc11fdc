"""Audience segments: rule documents evaluated to member ids."""

from .context import SegmentContext, rule
from .evaluate import (
    label_catalog,
    label_membership,
    segment_all,
    segment_content,
    segment_include_exclude,
    segment_list,
    segment_test,
    segment_upload,
)
from .families import FAMILIES, predicate

__all__ = [
    "FAMILIES", "SegmentContext", "label_catalog", "label_membership", "predicate", "rule",
    "segment_all", "segment_content", "segment_include_exclude", "segment_list", "segment_test",
    "segment_upload",
]
