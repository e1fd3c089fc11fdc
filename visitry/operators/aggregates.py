"""Grouped aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import round_half_even
from .ordered import stored

# Relations that decide a whole group's label, strongest first.
RELATION_ORDER = ("家庭", "情侶", "朋友")


def most_frequent(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Most frequent non-null value per group, the smallest on a tie.

    Counts per (group, value) first, so a large group is spread over its values
    and only one row per value reaches the group's reducer.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v")))
    return counts.groupBy(*by).agg(best["v"].alias(col))


def precedence_group(
    df: DataFrame,
    key: str,
    col: str,
    out: str,
    order: Sequence[str] = RELATION_ORDER,
    blank: str | None = "",
) -> DataFrame:
    """One label per group: the first of ``order`` present, else the most frequent.

    Groups without any value get ``blank``; rows without a group are ignored.
    """
    counts = (
        df.where(F.col(key).isNotNull())
        .groupBy(key, col)
        .agg(F.count("*").alias("_n"))
    )
    present = [F.bool_or(F.col(col) == value).alias(f"_p{i}") for i, value in enumerate(order)]
    ranked = F.min(
        F.when(F.col(col).isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v")))
    )
    grouped = counts.groupBy(key).agg(*present, ranked["v"].alias("_mode"))
    label = F.coalesce(F.col("_mode"), F.lit(blank))
    for i, value in reversed(list(enumerate(order))):
        label = F.when(F.col(f"_p{i}"), F.lit(value)).otherwise(label)
    return grouped.select(key, label.alias(out))


def having_every(df: DataFrame, by: Sequence[str], condition: Column) -> DataFrame:
    """Groups all of whose rows satisfy the condition (null tests are ignored)."""
    return df.groupBy(*by).agg(F.bool_and(condition).alias("_every")).where("_every").drop("_every")


def two_level_agg(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str], col: str, count_of: str
) -> DataFrame:
    """Sum per inner key, then per outer key: distinct ``count_of`` and mean of the sums.

    Columns ``groups`` and ``mean_<col>``; outer rows with a null key are dropped.
    Where the inner key is the outer one and ``count_of``, its groups are distinct
    as they stand, and are not grouped once more to be counted.
    """
    distinct = F.count if set(inner) == {*outer, count_of} else F.countDistinct
    sums = df.groupBy(*inner).agg(F.coalesce(F.sum(col), F.lit(0.0)).alias("_sum"))
    return (
        sums.dropna(subset=list(outer))
        .groupBy(*outer)
        .agg(
            distinct(count_of).alias("groups"),
            round_half_even(F.avg("_sum"), 2).alias(f"mean_{col}"),
        )
    )


def share_of_total(df: DataFrame, by: Sequence[str], within: Sequence[str], out: str) -> DataFrame:
    """Rows per ``by`` as percent of the rows per ``within`` (columns ``count``, ``out``).

    The window runs on the aggregated counts, never on the rows.
    """
    counts = df.dropna(subset=list(by)).groupBy(*by).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(*[F.col(c) for c in within] or [F.lit(0)]))
    return counts.withColumn(out, F.lit(100.0) * F.col("count") / total)


def value_counts(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return (
        df.dropna(subset=[*by, col])
        .groupBy(*by, col)
        .agg(F.count("*").alias("count"))
        .orderBy(*by, F.desc("count"), col)
    )


def grouping_total(
    df: DataFrame, key: str, sub: str, measures: Sequence[Column], total_label: str = "全"
) -> DataFrame:
    """Measures per (key, sub) and, in the same pass, per key under ``total_label``."""
    grouped = df.groupingSets([[key, sub], [key]], key, sub).agg(
        F.grouping(sub).alias("_total"), *measures
    )
    label = F.when(F.col("_total") == 1, F.lit(total_label)).otherwise(F.col(sub))
    return grouped.withColumn(sub, label).dropna(subset=[key, sub]).drop("_total")


def pivot_onehot(
    df: DataFrame, key: str, col: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Count matrix key x value, zero-filled: one column per value.

    Without ``values`` the domain may be of any size and is never looked at as a
    whole: the counts of a key are then one map ``counts``, without zeros.
    """
    if values is None:
        cells = df.where(F.col(key).isNotNull()).groupBy(key, col).agg(F.count("*").alias("n"))
        entry = F.when(F.col(col).isNotNull(), F.struct(F.col(col).cast("string"), "n"))
        return cells.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("counts"))
    cells = [F.count(F.when(F.col(col) == v, 1)).alias(str(v)) for v in values]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*cells)


def quantile_cuts(df: DataFrame, col: str, percents: Sequence[int] = (20, 40, 60, 80)) -> DataFrame:
    """One row ``q<percent>``: the smallest value covering that percent of the rows.

    Exact at any size, in two levels: a histogram (one row per distinct value,
    combined before the shuffle) is dealt by range and summed by part, a row for
    each part; the sums tell which part holds a cut, and only there values are
    accumulated. No task sees the histogram as a whole. It is written once, when
    this is called. Nulls do not count; without values all cuts are null.
    """
    histogram = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n"))
    dealt = stored(histogram.repartitionByRange("v").withColumn("part", F.spark_partition_id()), "histogram")
    order = Window.partitionBy(F.lit(0)).orderBy("part")  # a row for each part
    sums = dealt.groupBy("part").agg(F.sum("n").alias("inside"))
    before = F.coalesce(F.sum("inside").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("inside").over(Window.partitionBy(F.lit(0)))
    sums = sums.select("part", "inside", before.alias("before"), total.alias("total"))
    cuts = F.explode(F.array(*[F.lit(p) for p in percents])).alias("p")
    wanted = sums.select("part", "before", "inside", "total", cuts)
    reached = (F.col("before") * 100 < F.col("total") * F.col("p")) & ((F.col("before") + F.col("inside")) * 100 >= F.col("total") * F.col("p"))
    holding = F.broadcast(wanted.where(reached).select("part", "before", "total", "p"))  # a row for each cut
    # the values of a part are counted up to each in turn, for a part's first cut only once
    running = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = dealt.join(holding.select("part").distinct(), "part", "left_semi").withColumn("upto", F.sum("n").over(running))
    found = held.join(holding, "part").where((F.col("before") + F.col("upto")) * 100 >= F.col("total") * F.col("p"))
    return found.agg(*[F.min(F.when(F.col("p") == p, F.col("v"))).alias(f"q{p}") for p in percents])


def quintile_rating(
    df: DataFrame, col: str, out: str = "rating", percents: Sequence[int] = (20, 40, 60, 80)
) -> DataFrame:
    """Rating 1.. by the value's place among its own quantiles (edges inclusive)."""
    # stored, as the cuts and the ratings both need the rows; one scalar subquery holds all cuts, so the histogram is built once
    df = stored(df, "rated")
    cuts = quantile_cuts(df, col, percents).select(F.struct("*")).scalar()
    rating = F.lit(1)
    for p in percents:
        rating = rating + F.when(F.col(col) > cuts[f"q{p}"], 1).otherwise(0)
    return df.withColumn(out, rating.cast("int"))


def period_growth(
    df: DataFrame, day: Column, first: date, last: date, metrics: Mapping[str, tuple[str, Column]]
) -> DataFrame:
    """Each metric over [first, last] and over the same number of days just before.

    ``metrics`` maps a name to (kind, column), kind one of count, nunique, mean.
    One pass; returns one row with ``cur_<name>`` and ``prev_<name>``.
    """
    days = (last - first).days + 1
    before = first - timedelta(days=days)
    scoped = df.where(day.between(F.lit(before), F.lit(last)))
    aggregates = []
    for prefix, inside in (("cur", day >= F.lit(first)), ("prev", day < F.lit(first))):
        for name, (kind, column) in metrics.items():
            value = F.when(inside, column)
            made = {
                "count": F.count(value),
                "nunique": F.countDistinct(value),
                "mean": F.avg(value),
            }[kind]
            aggregates.append(made.cast("double").alias(f"{prefix}_{name}"))
    return scoped.agg(*aggregates)


def growth_percent(current: Column, previous: Column) -> Column:
    return round_half_even((current - previous) * 100 / F.nullif(previous, F.lit(0.0)), 0)
