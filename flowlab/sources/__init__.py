"""Sources (S1-S4, driver tables) and sinks."""

from flowlab.sources.tables import load_table, table_stream, TABLES
from flowlab.sources.text import read_lines, line_stream, sequence
from flowlab.sources.sinks import (write_delimited, write_tuples, stream_to_files,
                                   stream_to_console)

__all__ = ["load_table", "table_stream", "TABLES", "read_lines", "line_stream", "sequence",
           "write_delimited", "write_tuples", "stream_to_files", "stream_to_console"]
