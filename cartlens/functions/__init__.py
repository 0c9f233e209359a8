"""Column-level functions: cleaning, parsing and null-safe predicates."""

from cartlens.functions.nulls import eq, is_member, is_true, ne, not_member
from cartlens.functions.parse import (na_to_null, parse_boolean, parse_double, parse_integer,
                                      parse_ts_coerce, parse_ts_strict)
from cartlens.functions.text import (canonical_sex, clean_review_text, clean_str,
                                     is_invalid_json, normalize_label, normalize_whitespace,
                                     parse_list_string, strip, text_length)

__all__ = [
    "eq", "is_member", "is_true", "ne", "not_member",
    "na_to_null", "parse_boolean", "parse_double", "parse_integer", "parse_ts_coerce",
    "parse_ts_strict", "canonical_sex", "clean_review_text", "clean_str", "is_invalid_json",
    "normalize_label", "normalize_whitespace", "parse_list_string", "strip", "text_length",
]
