"""Tables in and out: scans, incremental slices, sinks, campaign exports."""

from .exports import export_batches, number_batches, sender_lookup
from .scans import jdbc_options, next_day_slice, read_day, read_docs, read_table
from .sinks import replace_partition, sink_append, sink_jdbc, sink_replace

__all__ = [
    "export_batches", "jdbc_options", "next_day_slice", "number_batches", "read_day",
    "read_docs", "read_table", "replace_partition", "sender_lookup", "sink_append", "sink_jdbc",
    "sink_replace",
]
