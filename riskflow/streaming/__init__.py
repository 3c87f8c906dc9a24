"""Structured Streaming: decode messages, land files, join, count and deduplicate streams, run queries."""

from riskflow.streaming.batches import read_batches, start_batches
from riskflow.streaming.decode import decode_messages, with_event_time
from riskflow.streaming.landing import land_files, land_lines, stream_files, stream_lines, sync_files
from riskflow.streaming.lists import start_with_list
from riskflow.streaming.queries import start_console, start_memory, start_table
from riskflow.streaming.stateful import dedupe_stream, fast_credit_stream, window_counts

__all__ = [
    "decode_messages",
    "dedupe_stream",
    "fast_credit_stream",
    "land_files",
    "land_lines",
    "read_batches",
    "start_batches",
    "start_console",
    "start_memory",
    "start_table",
    "start_with_list",
    "stream_files",
    "stream_lines",
    "sync_files",
    "window_counts",
    "with_event_time",
]
