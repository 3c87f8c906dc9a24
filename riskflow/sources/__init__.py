"""Where rows come from."""

from riskflow.sources.kafka import kafka_options, read_kafka_stream
from riskflow.sources.tables import read_table
from riskflow.sources.text import (
    file_headers,
    list_files,
    parse_header,
    parse_lines,
    ragged_rows,
    read_dated_lines,
    read_delimited,
    read_header,
    read_lines,
    well_formed_rows,
    with_source_date,
)

__all__ = [
    "file_headers",
    "kafka_options",
    "list_files",
    "parse_header",
    "parse_lines",
    "ragged_rows",
    "read_dated_lines",
    "read_delimited",
    "read_header",
    "read_kafka_stream",
    "read_lines",
    "read_table",
    "well_formed_rows",
    "with_source_date",
]
