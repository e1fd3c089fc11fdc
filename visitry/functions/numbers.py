"""Numeric expressions: buckets, scores, comparisons, durations, rounding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, functions as F

# Right-closed age bands (lower edge exclusive), label for the rest.
AGE_SCHEMES = {
    "bands8": (
        [0, 10, 20, 25, 30, 40, 50, 60],
        ["0~10", "11~20", "21~25", "26~30", "31~40", "41~50", "51~60"],
        "60up",
    ),
    "bands4": ([0, 25, 35, 45], ["25歲以下", "26-35歲", "36-45歲"], "46歲以上"),
    "ordinal5": ([0, 20, 40, 60, 80, 100], [1, 2, 3, 4, 5], 0),
}

# Score cuts for recency (days), frequency (orders), money.
RFM_CUTS = {"r": (60, 120), "f": (1, 2), "m": (1000, 2000)}

# Comparison words of the rule documents. The two money words
# read "more than" / "less than" but compare inclusively.
COMPARISONS = {
    "-": "=",
    "以上(含)": ">=",
    "以下(含)": "<=",
    "大於": ">=",
    "小於": "<=",
}


def bucket(c: Column, edges: Sequence, labels: Sequence, otherwise=None) -> Column:
    """Label of the right-closed interval ``(edges[i], edges[i+1]]`` holding c.

    ``None`` as first or last edge leaves that end open. Values in no interval,
    and null, get ``otherwise``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels):
        inside = F.lit(True)
        if low is not None:
            inside = c > low
        if high is not None:
            inside = (c <= high) if low is None else inside & (c <= high)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def age_bucket(c: Column, scheme: str) -> Column:
    edges, labels, rest = AGE_SCHEMES[scheme]
    return bucket(c, edges, labels, rest)


def rfm_score(
    r: Column, f: Column, m: Column, cuts: Mapping[str, tuple] = RFM_CUTS
) -> tuple[Column, Column, Column]:
    """Scores 1..3 per axis (3 = best); null stays null."""
    def axis(c, pair, labels):
        return F.when(c.isNotNull(), bucket(c, [None, *pair, None], labels))

    return (
        axis(r, cuts["r"], [3, 2, 1]),
        axis(f, cuts["f"], [1, 2, 3]),
        axis(m, cuts["m"], [1, 2, 3]),
    )


def _number(value) -> Column:
    # floats as decimals, so that money columns compare exactly
    return F.lit(Decimal(str(value)) if isinstance(value, float) else value)


def cmp_predicate(c: Column, op: str | None = None, value=None, low=None, high=None) -> Column:
    """Comparison from a rule document; without usable parts it means ``c > 0``."""
    if op is not None and op not in COMPARISONS:
        raise ValueError(f"unknown comparison word {op!r}")
    if op and value:
        sign = COMPARISONS[op]
        return {"=": c == _number(value), ">=": c >= _number(value), "<=": c <= _number(value)}[sign]
    if op and low is not None and high is not None:
        return c.between(_number(low), _number(high))
    return c > 0


def round_half_even(c: Column, places: int = 0) -> Column:
    """Round a double the way array libraries do: scale, ties to even, unscale."""
    scale = float(10**places)
    c = c.cast("double")
    return F.rint(c) if places == 0 else F.rint(c * scale) / scale


def cap_duration(c: Column, cap) -> Column:
    """At most ``cap``; null stays null (``least`` would turn it into the cap)."""
    return F.when(c > cap, F.lit(cap).cast("double")).otherwise(c)


def duration_minutes(seconds: Column, null_as: float | None = None) -> Column:
    minutes = round_half_even(seconds / 60, 2)
    return minutes if null_as is None else F.coalesce(minutes, F.lit(float(null_as)))
