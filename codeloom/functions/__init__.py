"""Column-expression helpers (JVM-side, no Python UDFs)."""

from codeloom.functions.classify import CODE_CLASS_RULES, classify, rank_of
from codeloom.functions.ranges import expand_ranges, range_bounds
from codeloom.functions.text import (
    LIST_SEPARATOR,
    WHITE_SPACE_CLASS,
    digits_only,
    is_digits,
    null_if_empty,
    pad_left,
    pad_right_digits,
    split_list,
    strip_code_suffix,
    strip_trailing,
    trim_ws,
)

__all__ = [
    "CODE_CLASS_RULES", "LIST_SEPARATOR", "WHITE_SPACE_CLASS", "classify", "digits_only",
    "expand_ranges", "is_digits", "null_if_empty", "pad_left", "pad_right_digits",
    "range_bounds", "rank_of", "split_list", "strip_code_suffix", "strip_trailing", "trim_ws",
]
