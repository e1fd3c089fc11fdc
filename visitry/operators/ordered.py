"""Ordered exchange: look-ahead, numbering and running aggregates inside keys of any size.

Rows are dealt by range of (keys, order), so a key that fills a third of a table is spread over a third of the tasks.
What crosses a border between two tasks is one row for each task: the key it begins and ends with, and counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and written below the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_starts(batch: pa.RecordBatch, keys: Sequence[str], last: list | None) -> np.ndarray:
    """True where a row's keys differ from those of the row before; last: the keys of the row before the batch."""
    new = np.zeros(batch.num_rows, dtype=bool)
    for key in keys:
        column = batch.column(batch.schema.get_field_index(key))
        if len(column) > 1:
            differs = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), False)
            nulls = column.is_null().to_numpy(zero_copy_only=False)
            new[1:] |= differs.to_numpy(zero_copy_only=False) | (nulls[1:] != nulls[:-1])
    new[0] = last is None or last != last_keys(batch.slice(0, 1), keys)
    return new


def last_keys(batch: pa.RecordBatch, keys: Sequence[str]) -> list:
    return [batch.column(batch.schema.get_field_index(k))[batch.num_rows - 1].as_py() for k in keys]


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str], run: Callable, extra: Sequence[T.StructField], name: str) -> DataFrame:
    """df by range of (keys, order), sorted in each task, passed through run; stored, as a second run would cut elsewhere."""
    by = [F.col(c) for c in (*keys, *order)]
    schema = T.StructType([*df.schema.fields, T.StructField("_piece", T.IntegerType()), T.StructField("_seq", T.LongType()), *extra])
    return stored(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), name)


def _with(batch: pa.RecordBatch, seq: int, more: Mapping[str, pa.Array]) -> pa.RecordBatch:
    n = batch.num_rows
    piece = pa.array(np.full(n, TaskContext.get().partitionId(), dtype=np.int32))
    return pa.RecordBatch.from_arrays([*batch.columns, piece, pa.array(np.arange(seq, seq + n)), *more.values()], names=[*batch.schema.names, "_piece", "_seq", *more])


def number_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "place") -> DataFrame:
    """0, 1, ... in each key's rows by `order` (ascending, nulls first); a null key is a key like any other.

    No task holds a key: rows are counted inside their task, and a key that began in an earlier task goes on
    counting from there. Rows equal in keys and order are numbered in any order among themselves.
    """

    def run(batches):
        last, seq, count, first_key = None, 0, 0, True
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = key_starts(batch, keys, last)
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            local = np.where(start >= 0, at - start, at + count)
            again = new if last is not None else np.concatenate([[False], new[1:]])
            head = first_key & ~np.logical_or.accumulate(again)
            first_key = bool(head[-1])
            count, last = int(local[-1]) + 1, last_keys(batch, keys)
            yield _with(batch, seq, {"_local": pa.array(local.astype(np.int64)), "_head": pa.array(head)})
            seq += n

    rows = _dealt(df, keys, order, run, [T.StructField("_local", T.LongType()), T.StructField("_head", T.BooleanType())], "numbered")
    key = F.struct(*keys)
    pieces = rows.groupBy("_piece").agg(F.min_by(key, "_seq").alias("first"), F.max_by(key, "_seq").alias("last"), F.max_by("_local", "_seq").alias("local"), F.max("_seq").alias("seq"))
    offsets, before, carried = [], None, 0
    for p in sorted(pieces.collect(), key=lambda r: r["_piece"]):  # a row for each task
        offset = carried if before is not None and p["first"] == before else 0
        offsets.append((p["_piece"], offset))
        carried = p["local"] + 1 + (offset if p["local"] == p["seq"] else 0)
        before = p["last"]
    shift = df.sparkSession.createDataFrame(offsets, "_piece int, _offset long")
    place = F.col("_local") + F.when(F.col("_head"), F.col("_offset")).otherwise(0)
    return rows.join(F.broadcast(shift), "_piece").select(*(F.col(f"`{c}`") for c in df.columns), place.alias(out))


def next_in_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "next") -> DataFrame:
    """`value` of the following row of the same key by `order`, null for a key's last row; a null key is a key too.

    A piece is what a task got by range of (keys, order); its rows are looked ahead in a window of the piece, and the
    last of them takes its follower from the first row of the next piece, of which there is one row for each piece.
    """
    by = [F.col(c) for c in (*keys, *order)]
    key = F.struct(*keys)
    # stored, as a second run would cut elsewhere
    rows = stored(df.repartitionByRange(*by).withColumn("_piece", F.spark_partition_id()), "ahead")
    heads = rows.groupBy("_piece").agg(F.min_by(F.struct(key.alias("key"), F.col(value).alias("value")), F.struct(*by)).alias("head"))
    following = F.lead("head").over(Window.partitionBy(F.lit(0)).orderBy("_piece"))  # a row for each piece
    heads = F.broadcast(heads.select("_piece", following.alias("_head")))
    piece = Window.partitionBy("_piece").orderBy(*by)
    inside = F.lead(F.struct(key.alias("key"), F.col(value).alias("value"))).over(piece)
    # dealt by range of the piece: a task has one, or neighbours
    paired = rows.repartitionByRange("_piece").withColumn("_next", inside).join(heads, "_piece", "left")
    follower = F.coalesce("_next", "_head")
    same = follower["key"].eqNullSafe(key)
    return paired.select(*(F.col(f"`{c}`") for c in df.columns), F.when(same, follower["value"]).alias(out))


def running(df: DataFrame, keys: Sequence[str], place: str, made: Mapping[str, tuple[Callable[[Column], Column], str]], block: int = 4096) -> DataFrame:
    """Aggregates of a key's earlier rows, by whole number `place` from 0 or 1 on; null before a key's first.

    made: output name -> (aggregate, column), the aggregate being one that may be applied to its own results (sum, max,
    min, bit_xor). Keys with more than `block` rows are summed in blocks first, and only block totals meet in one
    group. df is read three times: store it if it is not a table.
    """
    cut = df.withColumn("_block", F.floor(F.col(place) / block))
    by = [*keys, "_block"]
    inside = Window.partitionBy(*by).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.select(*(F.col(f"`{c}`") for c in df.columns), "_block", *(f(F.col(c)).over(inside).alias(f"_in_{o}") for o, (f, c) in made.items()))
    # only keys that reach a second block have a row at any place from `block` on
    long = cut.where(F.col(place) >= block).select(*keys).distinct()
    totals = cut.join(long, list(keys), "left_semi").groupBy(*by).agg(*(f(F.col(c)).alias(f"_of_{o}") for o, (f, c) in made.items()))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*by, *(f(F.col(f"_of_{o}")).over(earlier).alias(f"_of_{o}") for o, (f, _) in made.items()))
    both = local.join(before.where(F.col("_block") > 0), by, "left")

    def combined(o: str, f: Callable) -> Column:
        a, b = F.col(f"_of_{o}"), F.col(f"_in_{o}")
        name = getattr(f, "__name__", "")
        if name == "sum":
            return F.coalesce(a + b, a, b)
        if name == "bit_xor":
            return F.coalesce(a.bitwiseXOR(b), a, b)
        return {"max": F.greatest, "min": F.least}[name](a, b)

    return both.select(*(F.col(f"`{c}`") for c in df.columns), *(combined(o, f).alias(o) for o, (f, _) in made.items()))
