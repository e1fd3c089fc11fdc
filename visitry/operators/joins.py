"""Enrichment, lookup and keyed-change joins.

No side is broadcast by hint here: table sizes are unknown, so the choice is
left to the size checks of Catalyst and adaptive execution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

def enrich_left(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join where rows with a null key are kept but never match.

    Null keys would all meet in one shuffle partition; a digest of the row's
    other columns spreads them over any number. ``dim`` rows with a null key are dropped.
    """
    on = list(on)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    plain = [name for name, kind in df.dtypes if name not in on and "map" not in kind]
    spread = F.xxhash64(*plain) if plain else F.lit(1).cast("bigint")
    left = df.withColumn("_salt", F.when(missing, spread).otherwise(0))
    # always 0, but not a literal: a literal would be folded away and with it the
    # salt's part in the shuffle
    right = dim.where(present).withColumn("_salt", F.pmod(F.xxhash64(*on), F.lit(1)))
    return left.join(right, [*on, "_salt"], "left").drop("_salt")


def join_lookup(
    df: DataFrame, dim: DataFrame, key: str, value: str, strict: bool = False
) -> DataFrame:
    """Add ``dim.value`` by ``key``; unmapped rows are dropped, or fail if strict.

    ``dim`` holds one row per key. The strict form raises inside the plan, so
    the check runs with the join and needs no extra pass.
    """
    pairs = dim.select(key, value)
    if not strict:
        return df.join(pairs, key, "inner")
    found = pairs.withColumn("_found", F.lit(True))
    error = F.raise_error(F.concat(F.lit(f"no {value} for {key} "), F.col(key).cast("string")))
    joined = df.join(found, key, "left")
    return joined.withColumn(
        value, F.when(F.col("_found"), F.col(value)).otherwise(error)
    ).drop("_found")


def join_or_keys(
    member: DataFrame, keys: DataFrame, out: str, either: Sequence[str]
) -> DataFrame:
    """Distinct ``out`` of rows for which any of the ``either`` columns is in ``keys``.

    The alternatives become rows, so the OR is one equi semi join instead of a
    nested loop or one join per alternative. ``keys`` has a single column; a key
    that fills much of it is flattened before the join.
    """
    (key,) = keys.columns
    return (
        member.select(out, F.explode(F.array(*either)).alias("_key"))
        .join(keys.withColumnRenamed(key, "_key").distinct(), "_key", "left_semi")
        .select(out)
        .distinct()
    )


def below_limits(df: DataFrame, limit_row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows strictly below a one-row table of limits, compared as scalar subqueries."""
    tests = [F.col(c) < limit_row.select(c).scalar() for c in columns]
    return df.where(reduce(lambda a, b: a & b, tests))


def keyed_update(df: DataFrame, updates: DataFrame, key: str, col: str) -> DataFrame:
    """Set ``col`` where ``updates`` has the key; other rows keep their value.

    Several updates of one key resolve to the greatest value, so that the
    result does not depend on row order.
    """
    latest = updates.groupBy(key).agg(F.max(col).alias("_new")).withColumn("_hit", F.lit(True))
    joined = enrich_left(df, latest, [key])
    kept = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(col))
    return joined.withColumn(col, kept).select(*df.columns)


def keyed_delete(
    df: DataFrame,
    ids: DataFrame,
    key: str,
    children: DataFrame | None = None,
    child_key: str | None = None,
    child_of: str | None = None,
    child_prefix: str = "SS_",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Rows whose key is not in ``ids``.

    With ``children``: also drop the child rows named (``child_of`` column,
    prefix ``child_prefix``) by the rows being deleted; returns both tables.
    """
    ids = ids.select(key).distinct()
    kept = df.join(ids, key, "left_anti").select(*df.columns)
    if children is None:
        return kept
    doomed = (
        df.join(ids, key, "left_semi")
        .where(F.col(child_of).startswith(child_prefix))
        .select(F.col(child_of).alias(child_key))
        .distinct()
    )
    return kept, children.join(doomed, child_key, "left_anti").select(*children.columns)


def densify(
    df: DataFrame, grid: DataFrame, keys: Sequence[str], fill: Mapping, extra: bool = False
) -> DataFrame:
    """Every grid cell once, measures filled where the data has none.

    ``extra`` also keeps data cells outside the grid.
    """
    joined = grid.join(df, list(keys), "full" if extra else "left")
    return joined.na.fill(dict(fill))


def cross_grid(df: DataFrame, **domains: Sequence) -> DataFrame:
    """Combine each row with every value of fixed domains, without a cross join."""
    for name, values in domains.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def strict_translate(names: Sequence[str], dim: DataFrame, name: str, value: str) -> DataFrame:
    """Ids of a short list of names; a name the table lacks is an error."""
    wanted = dim.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names]).cast("array<string>")).alias(name)
    )
    return join_lookup(wanted, dim.select(name, value).distinct(), name, value, strict=True)
