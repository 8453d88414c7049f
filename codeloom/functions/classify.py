"""Ordered rule classification of codes (first matching rule wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code-class rules of the survey pipeline, in order.
# Each is (regex searched anywhere in the code, class name).
CODE_CLASS_RULES: tuple[tuple[str, str], ...] = (
    ("^[0-9]+$", "numeric"),
    ("Z$", "Z_suffix"),
    ("M[0-9]*$", "M_suffix"),
    ("P[0-9]*$", "P_suffix"),
    ("S$", "S_suffix"),
)
DEFAULT_CLASS = "other"


def classify(col, rules: Sequence[tuple[str, str]] = CODE_CLASS_RULES,
             default: str = DEFAULT_CLASS) -> Column:
    """``CASE WHEN rlike(r1) THEN c1 ... ELSE default`` (NULL tests count as false)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for pattern, name in rules:
        cond = c.rlike(pattern)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def rank_of(col, ranks: dict[str, int]) -> Column:
    """Map a label column to an integer rank (unknown labels -> NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for name, r in ranks.items():
        expr = F.when(c == name, F.lit(r)) if expr is None else expr.when(c == name, F.lit(r))
    return expr if expr is not None else F.lit(None).cast("int")
