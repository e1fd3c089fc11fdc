"""What predicates need: tables by logical name, the clock, tenant settings."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sets import Filtered


@dataclass(frozen=True)
class SegmentContext:
    """``tables`` gives a DataFrame by logical name (see README for their columns).

    ``sites`` maps a site's title to the suffix of its tables, ``custom`` a
    rule-type prefix to the tenant's own predicate, ``contents`` a label id to
    its rule list.
    """

    tables: Callable[[str], DataFrame]
    as_of: datetime | date
    sites: Mapping[str, str] = field(default_factory=lambda: {"main": ""})
    custom: Mapping[str, Callable] = field(default_factory=dict)
    contents: Mapping[str, Sequence[Mapping]] = field(default_factory=dict)

    def site_table(self, name: str, web: str) -> DataFrame:
        if web not in self.sites:
            raise ValueError(f"unknown site {web!r}")
        return self.tables(name + self.sites[web])


@dataclass(frozen=True)
class Ids:
    """Member ids of one predicate, and whether they are already distinct.

    ``source`` is what a fold reads: a row test on a table where the predicate
    is one (so that several share a scan), else the ids themselves.
    """

    source: DataFrame | Filtered
    unique: bool = False

    @property
    def df(self) -> DataFrame:
        """The ids as a table, possibly repeated."""
        return self.source.ids("member_id") if isinstance(self.source, Filtered) else self.source

    def distinct(self) -> DataFrame:
        return self.df if self.unique else self.df.distinct()


def as_ids(df: DataFrame, unique: bool = False, col: str = "member_id") -> Ids:
    found = df.select(F.col(col).cast("string").alias("member_id"))
    return Ids(found.where(F.col("member_id").isNotNull()), unique)


def rows_of(name: str, base: DataFrame, test: Column, unique: bool = False) -> Ids:
    """Ids of the rows of table ``name`` that pass a test."""
    known = test & F.col("member_id").isNotNull()
    return Ids(Filtered(name, base, known, F.col("member_id").cast("string")), unique)


def no_ids(ctx: SegmentContext) -> Ids:
    return as_ids(ctx.tables("member").where(F.lit(False)), unique=True)


def among(c: Column, values: Sequence) -> Column:
    """IN a rule's value list; an empty list selects nothing."""
    return c.isin(*values) if values else F.lit(False)


def rule(kind: str, tag: str, value=(), web=None, more=None, mode: str = "初") -> dict:
    """A rule document."""
    return {"type": kind, "tag": tag, "value": value, "web": web, "more_option": more, "mode": mode}
