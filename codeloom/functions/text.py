"""String column expressions with the semantics the crosswalk rules need.

All helpers return ``Column`` expressions built from ``pyspark.sql.functions``
so they stay JVM-side and inside whole-stage codegen.  Each accepts a column
name or a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space code points, which is what a
# Unicode-aware trim strips (Spark's own ``trim`` only strips ASCII space).
# Written as a regex class that both Java regex and RE2 accept.
WHITE_SPACE_CLASS = (
    r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# The same code points as a plain character set, for Spark's native
# ``trim(BOTH chars FROM s)`` (no regex per row).
WHITE_SPACE_CHARS = ("\t\n\x0b\x0c\r \x85\xa0\u1680"
                     + "".join(chr(c) for c in range(0x2000, 0x200B))
                     + "\u2028\u2029\u202f\u205f\u3000")

# Fixed value: list separator of the dictionary cells, a comma plus any
# following white space.
LIST_SEPARATOR = "," + WHITE_SPACE_CLASS + "*"


# Fixed value: the code suffix removed to get a code's numeric prefix (one
# capital letter plus any digits, at the end).
SUFFIX_PATTERN = "[A-Z][0-9]*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trim_ws(col) -> Column:
    """Trim Unicode white space from both ends (T2: plain ``F.trim`` only strips spaces).

    Spark's character-set trim, so no regex runs per row.
    """
    return F.trim(_c(col), F.lit(WHITE_SPACE_CHARS))


def is_digits(col) -> Column:
    """True when the string is one or more ASCII digits (NULL stays NULL)."""
    return _c(col).rlike("^[0-9]+$")


def pad_right_digits(col, width: int = 6, fill: str = "0") -> Column:
    """Right-pad purely numeric strings shorter than ``width``; others unchanged.

    ``rpad`` alone truncates longer strings (T1), hence the length guard.
    """
    c = _c(col)
    return F.when(is_digits(c) & (F.length(c) < width), F.rpad(c, width, fill)).otherwise(c)


def pad_left(col, width: int, fill: str = "0", digits_only: bool = False) -> Column:
    """Left-pad to ``width`` without ever shortening.

    With ``digits_only`` only purely numeric strings are padded.
    """
    c = _c(col)
    cond = F.length(c) < width
    if digits_only:
        cond = is_digits(c) & cond
    return F.when(cond, F.lpad(c, width, fill)).otherwise(c)


def digits_only(col) -> Column:
    """Remove every non-digit character."""
    return F.regexp_replace(_c(col), "[^0-9]", "")


def strip_code_suffix(col) -> Column:
    """Remove one trailing capital letter plus the digits after it.

    ``92811P1`` -> ``92811``, ``9211MP`` -> ``9211M``, ``3MS`` -> ``3M``.
    """
    return F.regexp_replace(_c(col), SUFFIX_PATTERN, "")


def strip_trailing(col, char: str = "X") -> Column:
    """Remove a trailing run of ``char`` (wildcard digits)."""
    return F.regexp_replace(_c(col), f"{char}+$", "")


def split_list(col, separator: str = LIST_SEPARATOR) -> Column:
    """Split on a regex, keeping trailing empty tokens (limit -1)."""
    return F.split(_c(col), separator, -1)


def null_if_empty(col) -> Column:
    """Empty string -> NULL (JS truthiness of strings)."""
    c = _c(col)
    return F.when(c != "", c)
