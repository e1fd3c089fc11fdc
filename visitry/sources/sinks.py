"""Writers. Rerunning a write after a failure gives the same table, but for plain appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, functions as F


def _laid_out(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one folder together, so that tasks do not each write a file per folder.

    The rebalance hint lets adaptive execution split a large folder over tasks
    and put small ones together.
    """
    return df.hint("rebalance", *by) if by else df


def sink_append(df: DataFrame, path: str, by: Sequence[str] = ()) -> bool:
    """Add rows, unless there are none; tells whether rows were written.

    With ``by`` the folders of ``df`` (a day is loaded whole) are replaced, so a
    rerun gives the same table. Without it rows are appended, and a rerun after
    success would double them: use it for tables that are made anew anyway.
    """
    if df.isEmpty():
        return False
    if by:
        _replace_folders(df, path, by)
    else:
        df.write.mode("append").parquet(path)
    return True


def sink_replace(df: DataFrame, path: str) -> None:
    """Replace the whole table (never a partition of it, whatever the session says)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def _replace_folders(df: DataFrame, path: str, by: Sequence[str]) -> None:
    (
        _laid_out(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def replace_partition(df: DataFrame, path: str, col: str, values: Sequence[str] = ()) -> None:
    """Replace the partitions of ``col`` present in ``df``; others stay.

    ``values`` that ``df`` has no row of lose their partition: a period that was
    computed anew and came out empty leaves nothing behind.
    """
    _replace_folders(df, path, [col])
    if not values:
        return
    filled = {str(r[0]) for r in df.where(F.col(col).isin(list(values))).select(col).distinct().collect()}
    spark = df.sparkSession
    for value in set(map(str, values)) - filled:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{col}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def sink_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", truncate: bool = False,
    batch_rows: int = 10_000, connections: int = 8, **more: str,
) -> DataFrameWriter:
    """A writer to a database table; ``.save()`` runs it.

    ``overwrite`` with ``truncate`` keeps the table's definition. Rows go in
    batches, over at most ``connections`` connections.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if truncate and mode != "overwrite":
        raise ValueError("only an overwrite can truncate")
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(connections), **more}
    if truncate:
        options["truncate"] = "true"
    return df.write.format("jdbc").mode(mode).options(**options)
