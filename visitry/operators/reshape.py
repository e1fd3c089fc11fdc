"""Nested events to columns, wide to long, rows to documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import param_value


def param_column(name: str) -> Column:
    """Value of one event parameter as text, null where the event lacks it.

    Position lookup instead of a lambda: it stays inside generated code, and
    the first of repeated keys wins.
    """
    place = F.array_position(F.col("event_params.key"), name).cast("int")
    return param_value(F.get(F.col("event_params"), place - 1)["value"])


def flatten_params(
    df: DataFrame,
    keys: Sequence[str],
    keep_empty: bool = True,
    dedup: bool = False,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """One column per allow-listed event parameter, null where an event lacks it.

    Row-local (no explode, no shuffle). The first of repeated keys wins.
    ``keep_empty=False`` drops events without any listed key; ``dedup`` drops
    repeated output rows; ``names`` renames columns.
    """
    if not keep_empty:
        wanted = F.array(*[F.lit(k) for k in keys])
        df = df.where(F.arrays_overlap(F.col("event_params.key"), wanted))
    names = names or {}
    flat = df.select(
        *[c for c in df.columns if c != "event_params"],
        *[param_column(k).alias(names.get(k, k)) for k in keys],
    )
    return flat.dropDuplicates() if dedup else flat


def explode_params(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form (event columns, key, value) of the allow-listed parameters."""
    rest = [c for c in df.columns if c != "event_params"]
    long = df.select(*rest, F.explode("event_params").alias("_p"))
    return long.where(F.col("_p.key").isin(*keys)).select(
        *rest, F.col("_p.key").alias("key"), param_value(F.col("_p.value")).alias("value")
    )


def pivot_params(df: DataFrame, by: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Long (key, value) rows to one column per fixed key."""
    cells = [F.min(F.when(F.col("key") == k, F.col("value"))).alias(k) for k in keys]
    return df.groupBy(*by).agg(*cells)


def project_nested(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Select nested fields under flat names (``{name: path}``)."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def split_explode(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    """One row per entry of a separated list; null lists vanish, entries are not trimmed."""
    entries = F.split(F.col(col), sep)
    return df.select(*[c for c in df.columns if c != col], F.explode(entries).alias(out))


def melt_wide(
    df: DataFrame, ids: Sequence[str], pairs: Sequence[Sequence[str]], names: Sequence[str], rank: str
) -> DataFrame:
    """Parallel column groups to rows: pair i of columns becomes (rank i+1, *names)."""
    rows = [
        F.struct(F.lit(i).alias(rank), *[F.col(c).alias(n) for c, n in zip(cols, names)])
        for i, cols in enumerate(pairs, start=1)
    ]
    return df.select(*ids, F.inline(F.array(*rows)))


def array_to_columns(df: DataFrame, col: str, n: int, prefix: str) -> DataFrame:
    """First n array entries as ``prefix1..prefixn``, null past the end."""
    spread = {f"{prefix}{i + 1}": F.get(F.col(col), F.lit(i)) for i in range(n)}
    return df.withColumns(spread).drop(col)


def ranks_to_columns(
    df: DataFrame, by: Sequence[str], rank: str, n: int, columns: Mapping[str, str]
) -> DataFrame:
    """Ranked rows to wide columns (``{source column: prefix}``), one aggregate, fixed width."""
    cells = [
        F.max(F.when(F.col(rank) == i, F.col(source))).alias(f"{prefix}{i}")
        for i in range(1, n + 1)
        for source, prefix in columns.items()
    ]
    return df.groupBy(*by).agg(*cells)


def collect_ranked(df: DataFrame, by: Sequence[str], rank: str, col: str, out: str) -> DataFrame:
    """List per key in rank order. The caller bounds the ranks (top-n) beforehand."""
    entries = F.sort_array(F.collect_list(F.struct(rank, col)))
    return df.groupBy(*by).agg(F.transform(entries, lambda e: e[col]).alias(out))


def nest_json(df: DataFrame, levels: Sequence[str], leaf_cols: Sequence[str], out: str = "doc") -> DataFrame:
    """Nested documents ``{level1: {level2: {column: [values]}}}`` as JSON.

    For report results (already aggregated). The first level stays a row each,
    so documents are built in parallel; entries are ordered by their columns.
    """
    first, *inner = levels
    ordered = F.sort_array(F.collect_list(F.struct(*leaf_cols)))
    # a field of an array of structs is the array of that field
    lists = F.struct(*[F.col("_rows").getField(c).alias(c) for c in leaf_cols])
    docs = df.groupBy(*levels).agg(ordered.alias("_rows")).select(*levels, lists.alias("_node"))
    for depth in range(len(inner), 0, -1):
        level = levels[depth]
        # maps cannot be ordered, so entries are compared by their key alone
        entries = F.map_from_entries(
            F.array_sort(
                F.collect_list(F.struct(level, "_node")),
                lambda a, b: F.when(a[level] < b[level], -1).otherwise(1),
            )
        )
        docs = docs.groupBy(*levels[:depth]).agg(entries.alias("_node"))
    return docs.select(first, F.to_json("_node").alias(out))


def cast_columns(df: DataFrame, kind: str) -> DataFrame:
    """Every column as ``kind``, unparsable values as null."""
    return df.select(*[F.col(c).try_cast(kind).alias(c) for c in df.columns])


def fill_defaults(
    df: DataFrame, strings: str | None = None, numbers: float | None = None, per_column: Mapping | None = None
) -> DataFrame:
    """Fill nulls by column first, then by type."""
    if per_column:
        df = df.na.fill(dict(per_column))
    if strings is not None:
        df = df.na.fill(strings)
    return df if numbers is None else df.na.fill(numbers)


def literal_columns(df: DataFrame, **values) -> DataFrame:
    return reduce(lambda d, kv: d.withColumn(kv[0], F.lit(kv[1])), values.items(), df)
