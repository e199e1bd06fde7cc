"""Column-level helpers: parsing, fills, money in cents, tuple rendering."""

from flowlab.functions.exprs import cents, tuple_text, fill_missing, event_time
from flowlab.functions.parse import parse_fields, RECORD_KINDS

__all__ = ["cents", "tuple_text", "fill_missing", "event_time", "parse_fields", "RECORD_KINDS"]
