"""Ranking, numbering and dwell time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cap_duration
from .ordered import next_in_order


def dwell_time(
    df: DataFrame,
    session_keys: Sequence[str],
    ts: str,
    tie: str,
    cap_s: float,
    out: str = "stay_time",
    bucket_s: int | None = None,
) -> DataFrame:
    """Seconds to the session's next event, at most ``cap_s``; the last has none.

    A session may hold any share of the rows, and all of them in one second:
    events are dealt by range of (session, time, tie-break), looked ahead inside
    their task, and only the first event of each task is told to the one before.
    Events without a session get null; they are dealt by time and tie-break too.
    The dealt events are written once, when this is called. ``bucket_s`` was the
    length of the pieces that sessions used to be cut in; it has no effect now.
    """
    keys = list(session_keys)
    orphan = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    paired = next_in_order(df, keys, [ts, tie], ts, "_next")
    gap = F.timestamp_diff("MICROSECOND", F.col(ts), F.col("_next")) / 1_000_000
    stay = F.when(~orphan, cap_duration(gap, cap_s))
    return paired.withColumn(out, stay).select(*df.columns, out)


def topn_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """First ``n`` rows per group. Each task keeps only its own best n before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def top_bottom_per_group(
    df: DataFrame, by: Sequence[str], measure: str, tie: str, n: int
) -> DataFrame:
    """The n greatest and the n least per group, tagged ``top`` / ``buttom`` in ``TB``."""
    best = topn_per_group(df, by, [F.desc(measure), F.asc(tie)], n)
    worst = topn_per_group(df, by, [F.asc(measure), F.desc(tie)], n)
    return best.withColumn("TB", F.lit("top")).unionByName(worst.withColumn("TB", F.lit("buttom")))


def topk_global(
    df: DataFrame, order: Sequence[Column], k: int, item: str | None = None, blocked: Sequence = ()
) -> DataFrame:
    """First k rows overall; blocked items are removed after the cut, so fewer may remain."""
    best = df.orderBy(*order).limit(k)
    return best.where(~F.col(item).isin(*blocked)) if blocked else best


def number_rows(
    df: DataFrame, keys: Sequence[str], out: str, start: int = 1, digits: int = 3
) -> DataFrame:
    """Consecutive numbers for the distinct key values in ``keys``, without one big sort.

    Rows are placed in 16**digits slots (4096 by default) by a digest of their
    key and numbered inside their slot; the slot's offset is the running count
    of the slots before it (a row per slot, so it may be broadcast). The same
    keys always get the same numbers. ``keys`` must identify a row.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    slotted = df.withColumn("_slot", F.substring(F.md5(text), 1, digits))
    sizes = slotted.groupBy("_slot").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(F.lit(0)).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_slot").orderBy(*keys))
    return (
        slotted.withColumn("_in_slot", within)
        .join(F.broadcast(offsets), "_slot")
        .withColumn(out, (F.col("_before") + F.col("_in_slot") + (start - 1)).cast("bigint"))
        .select(*df.columns, out)
    )


def cohort_id(df: DataFrame, cols: Sequence[str], out: str = "cohort") -> DataFrame:
    """Dense id per combination of attribute values (only combinations that occur).

    The columns must be non-null (fill them first), as they are joined back on.
    """
    combos = number_rows(df.select(*cols).distinct(), cols, out)
    return df.join(combos, list(cols), "inner")
