"""Readers. Filters and column lists are left in the plan, where Spark pushes
them into the parquet scan or the database query."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def jdbc_options(
    url: str, table: str, partition: tuple[str, object, object, int] | None = None, **more: str
) -> dict[str, str]:
    """Options of a JDBC read; ``partition`` = (column, lower, upper, n) splits it into n queries."""
    options = {"url": url, "dbtable": table, **more}
    if partition:
        column, lower, upper, n = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(n),
        }
    return options


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    where: Column | str | None = None,
    *,
    root: str | None = None,
    schema: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table by name: parquet below ``root``, a database table, or a catalog table."""
    if root is not None:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(f"{root}/{name}.parquet")
    elif jdbc is not None:
        df = spark.read.format("jdbc").options(**jdbc).load()
    else:
        df = spark.table(name)
    if where is not None:
        df = df.where(where)
    return df if columns is None else df.select(*columns)


def read_docs(
    spark: SparkSession, name: str, where: Column | str, fields: Sequence[str], **source
) -> DataFrame:
    """Range-filtered documents with a field list; nested fields stay typed."""
    return read_table(spark, name, list(fields), where, **source)


def read_day(spark: SparkSession, root: str, day: date, schema: str | None = None) -> DataFrame:
    """One day of an event table partitioned by ``event_date``; only that folder is read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root).where(F.col("event_date") == F.lit(day))


def next_day_slice(src: DataFrame, sink: DataFrame, ts_col: str) -> DataFrame:
    """Rows of the day after the last loaded one (none if the sink is empty).

    The high-water mark is a scalar subquery: one plan, and on a table
    partitioned by the filtered column only the wanted day is read. Test
    ``isEmpty()`` of the result to skip a load.
    """
    kind = dict(src.dtypes)[ts_col]
    mark = sink.agg(F.date_add(F.max(F.to_date(ts_col)), 1).alias("day")).scalar()
    if kind == "date":
        return src.where(F.col(ts_col) == mark)
    start = mark.cast(kind)
    # bounds on the bare column, so that row groups can be skipped
    end = F.date_add(mark, 1).cast(kind)
    return src.where((F.col(ts_col) >= start) & (F.col(ts_col) < end))
