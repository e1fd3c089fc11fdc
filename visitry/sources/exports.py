"""Campaign list export: sender lookup, batches, CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.joins import join_lookup
from ..operators.sets import union_all
from ..operators.windows import number_rows

# Rows per campaign file, and the sender of rules without a schedule.
BATCH_ROWS = 20_000
NO_SENDER = "None"
KINDS = {
    "email": ("vice", "trigger", "trigger-system"),
    "sms": ("vice", "trigger", "trigger-system", "type_type"),
}


def sender_lookup(primary: DataFrame, cross: DataFrame) -> DataFrame:
    """(name, sender) of the channel's own schedules and the other channel's.

    A name with several senders keeps the least, so that it maps to one.
    """
    both = union_all(primary.select("name", "sender"), cross.select("name", "sender"))
    return both.groupBy("name").agg(F.min("sender").alias("sender"))


def number_batches(
    df: DataFrame, senders: DataFrame | None, channel: str, kind: str, config: str | None = None,
    chunk: int = BATCH_ROWS,
) -> DataFrame:
    """Rows with sender, template, configuration and a batch number of at most ``chunk`` rows.

    ``df`` has ``member_id`` and ``rule_id`` (together unique). A rule without
    sender is an error. ``senders`` is not used by kind ``type_type``.
    """
    if kind not in KINDS.get(channel, ()):
        raise ValueError(f"unknown export {channel}/{kind}")
    out = df.withColumn("template", F.col("rule_id"))
    if channel == "email":
        out = out.withColumn("configuration_set", F.lit(config))
    if kind == "type_type":
        out = out.withColumn("sender", F.lit(NO_SENDER))
    else:
        named = senders.select(F.col("name").alias("rule_id"), "sender")
        out = join_lookup(out, named, "rule_id", "sender", strict=True)
    numbered = number_rows(out, ["member_id", "rule_id"], "_row", start=0)
    return numbered.withColumn("batch", F.floor(F.col("_row") / chunk) + 1).drop("_row")


def export_batches(
    df: DataFrame, senders: DataFrame | None, path: str, channel: str, kind: str,
    config: str | None = None, chunk: int = BATCH_ROWS, immediate: bool = False, run: str | None = None,
) -> None:
    """Write one CSV file per batch below ``path``; no rows, no files.

    Each ``run`` has a folder of its own, which a rerun replaces.

    Batches are the unit of work: each is written by one task, all in parallel.
    """
    folder = "send-immediate" if immediate else "wait-send"
    folder = f"{path}/{folder}/{channel}_{kind}" + (f"/run={run}" if run else "")
    (
        number_batches(df, senders, channel, kind, config, chunk)
        .repartition("batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", chunk)
        .option("header", True)
        .partitionBy("batch")
        .csv(folder)
    )
