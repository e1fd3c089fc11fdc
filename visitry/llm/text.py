"""Whole texts to words and rows: what the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from visitry.session import scratch_path

#: A word is a run of anything but these. bytes.split() without an argument splits at the same six characters.
SPACES = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Words with A-Z, and no other letter, in lower case."""
    return text.encode().lower().split() if text else []


def ascii_lower(column):
    return F.translate(column, UPPER, UPPER.lower())


def map_lists(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable]) -> DataFrame:
    """One Python pass over `columns`, in Arrow batches.

    make() is called once per task and returns a function from the lists of a batch to the lists of the output.
    """
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)

    def run(batches):
        step = make()
        for batch in batches:
            lists = step(*(batch.column(i).to_pylist() for i in range(len(columns))))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(lists, arrow, strict=True)], schema=arrow)

    return df.select(*columns).mapInArrow(run, fields)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str = "stage", compression: str = "snappy") -> DataFrame:
    """The same rows, computed once and written to the folder that all executors share; cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
