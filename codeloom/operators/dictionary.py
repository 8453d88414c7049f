"""Dictionary normalization: compact code cells -> one row per (target, code).

A cell such as ``"11113-6, 1119*"`` lists codes in compact notation.  The
pipeline (E2): drop missing and sentinel cells, flag starred cells (the flag
is per *cell*: one ``*`` marks every token of it, D4), remove stars, split on
``,\\s*`` keeping empty tokens (T11), trim Unicode white space, expand
ranges, right-pad numeric codes to the key width, distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.functions.ranges import expand_ranges, range_blocks
from codeloom.functions.text import pad_right_digits, split_list, trim_ws

# Fixed value: the "not available" sentinel of dictionary cells.
SENTINEL = "n.a."


def filter_sentinels(df: DataFrame, target: str = "target", raw: str = "raw",
                     sentinel: str = SENTINEL) -> DataFrame:
    """Keep rows with both columns present and a non-sentinel cell.

    The conjunction is three-valued: a NULL predicate drops the row.
    """
    return df.where(F.col(target).isNotNull() & F.col(raw).isNotNull()
                    & (trim_ws(raw) != sentinel))


def explode_tokens(df: DataFrame, raw: str = "raw", flag: str = "multi_io",
                   token: str = "token") -> DataFrame:
    """Star flag per cell, stars removed, split (keeping empties), trimmed tokens."""
    keep = [F.col(f"`{c}`") for c in df.columns]
    split = df.select(*keep, F.col(raw).contains("*").alias(flag),
                      F.explode(split_list(F.regexp_replace(F.col(raw), r"\*", ""))).alias("__tok"))
    return split.select(*keep, flag, trim_ws("__tok").alias(token))


def normalize_dictionary(df: DataFrame, target: str = "target", raw: str = "raw",
                         key: str = "key6", flag: str = "multi_io", width: int = 6,
                         sentinel: str = SENTINEL, literal_ranges: bool = False, distinct: bool = True) -> DataFrame:
    """``(target, key6, multi_io)``, distinct (unless the reader doesn't mind repeated rows).

    ``literal_ranges`` expands a range whose suffix is longer than its base too
    (T5); ``functions.ranges.malformed_ranges`` counts what passes through.

    The dictionary is small (industries x codes), so the final ``distinct``
    is a cheap shuffle; nothing here scales with the fact tables.
    """
    d = _tokens(df, target, raw, flag, sentinel)
    d = expand_ranges(d, "__token", "__expanded", literal_ranges)
    d = d.select(F.col("__t").alias(target), pad_right_digits("__expanded", width).alias(key), flag)
    return d.distinct() if distinct else d


def _tokens(df: DataFrame, target: str, raw: str, flag: str, sentinel: str) -> DataFrame:
    d = filter_sentinels(df.select(F.col(target).alias("__t"), F.col(raw).alias("__raw")),
                         "__t", "__raw", sentinel)
    return explode_tokens(d, "__raw", flag, "__token").select("__t", flag, "__token")


def compact_dictionary(df: DataFrame, target: str = "target", raw: str = "raw",
                       key: str = "key6", flag: str = "multi_io", width: int = 6,
                       sentinel: str = SENTINEL, literal_ranges: bool = False) -> DataFrame:
    """E2 with ranges as digit blocks: ``(target, key6, multi_io, digits)``, distinct.

    A row without ``digits`` is a code as in ``normalize_dictionary``; with ``digits`` the key is a
    prefix that stands for all integers of so many digits which begin with it.  ``match.nested_keys``
    reads both, so a range of a billion codes costs a few rows and is never emitted.
    """
    d = range_blocks(_tokens(df, target, raw, flag, sentinel), "__token", "__block", "digits", literal_ranges)
    code = F.when(F.col("digits").isNull(), pad_right_digits("__block", width)).otherwise(F.col("__block"))
    return d.select(F.col("__t").alias(target), code.alias(key), flag, "digits").distinct()
