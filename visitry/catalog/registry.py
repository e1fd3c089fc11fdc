"""Where queries and their check SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .bindings import Tables, with_bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``; ``sql`` may name any bound table."""

    def register(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} registered twice")
        QUERIES[key] = lambda spark, sf_dir: portable(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[key] = with_bindings(sql)
        return fn

    return register


def portable(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles: types every client reads alike."""
    shown = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith(("date", "timestamp")):
            c = c.cast("string").alias(name)
        elif kind.startswith("decimal"):
            c = c.cast("double").alias(name)
        shown.append(c)
    return df.select(*shown)


def rnd(x: str, places: int = 0) -> str:
    """SQL for half-even rounding of a double, as ``round_half_even`` does it."""
    if places == 0:
        return f"round_even(CAST({x} AS DOUBLE), 0)"
    return f"(round_even(CAST({x} AS DOUBLE) * 1e{places}, 0) / 1e{places})"
