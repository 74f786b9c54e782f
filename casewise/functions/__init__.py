"""Column-to-column functions; all built-in expressions, no Python workers."""

from .codes import code_flag, decode
from .dates import compact_date, date_precision, parse_partial_date
from .keys import canonical_json, content_key, row_checksum
from .money import estimate_cost
from .text import blank_to_null, first_element, format_general, normalize_term, safe_size
from .text import render_case

__all__ = [
    "blank_to_null",
    "canonical_json",
    "code_flag",
    "compact_date",
    "content_key",
    "date_precision",
    "decode",
    "estimate_cost",
    "first_element",
    "format_general",
    "normalize_term",
    "parse_partial_date",
    "render_case",
    "row_checksum",
    "safe_size",
]
