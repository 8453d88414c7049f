"""Fact-side code preparation, tariff normalization, labels and sheet helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.functions.classify import CODE_CLASS_RULES, DEFAULT_CLASS, classify
from codeloom.functions.text import (
    digits_only,
    is_digits,
    pad_left,
    pad_right_digits,
    strip_code_suffix,
    trim_ws,
)
from codeloom.operators.broadcast import sized_broadcast

# Fixed value: the code that marks a record as "not employed" (no industry).
NOT_EMPLOYED = "0"


def rename_by_position(df: DataFrame, positions: Mapping[int, str]) -> DataFrame:
    """B1: rename columns by 1-based position, keep only those, in the given order."""
    cols = df.columns
    return df.select(*[F.col(f"`{cols[i - 1]}`").alias(name) for i, name in positions.items()])


def add_code_columns(df: DataFrame, code: str = "code", width: int = 6,
                     rules=CODE_CLASS_RULES) -> DataFrame:
    """Sequential columns, each seeing the previous ones.

    ``code_type`` (E3) from ``code``, ``code_prefix`` (E4: one capital letter
    plus digits removed from the end) and ``code_6d`` (numeric codes padded
    right to ``width``, NULL otherwise).  Chained ``withColumn`` calls, since
    a single ``withColumns`` cannot see its own new columns.
    """
    return (
        df.withColumn("code_type", classify(code, rules))
        .withColumn("code_prefix", strip_code_suffix(code))
        .withColumn("code_6d", F.when(F.col("code_type") == "numeric",
                                      pad_right_digits(code, width)))
    )


def prepare_codes(df: DataFrame, code: str = "code", out: str = "code_str",
                  not_employed: str | None = NOT_EMPLOYED) -> DataFrame:
    """Trim (Unicode) into ``out``, drop the not-employed code (C4), add class columns.

    The raw column is kept.  Rows whose trimmed code is NULL are dropped too,
    as a NULL comparison is (a NULL predicate drops the row).
    """
    d = df.withColumn(out, trim_ws(F.col(code).cast("string")))
    if not_employed is not None:
        d = d.where(F.col(out) != not_employed)
    return add_code_columns(d, out)


def distinct_codes(facts: DataFrame, code: str = "code_str") -> DataFrame:
    """Distinct codes with their class columns.

    Grouping is on the code alone (class columns are functions of it and are
    derived after the aggregate).  The aggregate is partial on the map side,
    so one code holding a third of all rows still shuffles one row per task.
    Per-record API; pipelines use ``code_map`` + ``codes_from_map``, whose
    distinct leaves the codes hash-partitioned for the matcher's per-code
    aggregate (no further exchange).
    """
    return add_code_columns(facts.select(F.col(code).alias("code")).distinct(), "code")


def code_map(facts: DataFrame, code: str = "code", out: str = "code_str",
             not_employed: str | None = NOT_EMPLOYED, already_distinct: bool = False) -> DataFrame:
    """Distinct raw codes -> cleaned code, class columns and a ``keep`` flag.

    Cleaning (trim, class regexes) runs once per *distinct* raw value, never
    per record; records meet the result through one hash join on the raw
    code.  ``keep`` is false for NULL and the not-employed code (C4).
    ``already_distinct``: the input has one row per code (e.g. ``code_stats``).
    """
    m = facts.select(F.col(code).cast("string").alias("code_raw"))
    if not already_distinct:
        m = m.distinct()
    m = m.withColumn(out, trim_ws("code_raw"))
    keep = F.coalesce(F.col(out) != not_employed, F.lit(False)) if not_employed is not None \
        else F.col(out).isNotNull()
    return add_code_columns(m.withColumn("keep", keep), out)


def unclassified_rows(code: str = "code_raw", rows: str = "n_rows", not_employed: str | None = NOT_EMPLOYED,
                      other: str = DEFAULT_CLASS, rules=CODE_CLASS_RULES):
    """R8 as an aggregate over per-code stats: the records whose kept code has no class.

    To be observed by the write of the stats (``broadcast.materialize``), which costs no job of its own.
    """
    c = trim_ws(code)
    keep = c != not_employed if not_employed is not None else c.isNotNull()
    return F.sum(F.when(keep & (classify(c, rules) == other), F.col(rows)).otherwise(0))


def codes_from_map(cmap: DataFrame, code: str = "code_str") -> DataFrame:
    """H10 from a ``code_map``: distinct kept codes with their class columns."""
    return (cmap.where("keep")
            .select(F.col(code).alias("code"), "code_type", "code_prefix", "code_6d").distinct())


def drop_codes_filter(df: DataFrame, codes: Sequence[str], code: str = "code") -> DataFrame:
    """C5 with T6: ``!x %in% list`` keeps NULL codes, plain ``~isin`` would drop them."""
    return df.where(F.col(code).isNull() | ~F.col(code).isin(list(codes)))


def decode_value_labels(values: DataFrame, labels: DataFrame, value: str,
                        label_value: str = "value", label: str = "label",
                        out: str = "value_str", max_label_rows: int = 1_000_000) -> DataFrame:
    """Label where one exists, else the value as text; trimmed.

    The label dimension is counted (up to ``max_label_rows + 1`` rows) and
    broadcast when within the bound: one value may hold a third of all rows,
    and a broadcast join never routes a value's rows to a single task.
    """
    lab = labels.select(F.col(label_value).alias("__lv"), F.col(label).alias("__lab"))
    j = values.join(sized_broadcast(lab, max_label_rows, count_unknown=True),
                    F.col(value) == F.col("__lv"), "left")
    return j.withColumn(out, trim_ws(F.coalesce(F.col("__lab"), F.col(value).cast("string")))) \
        .drop("__lv", "__lab")


def normalize_tariff(df: DataFrame, hts: str = "hts_raw", code: str = "code",
                     hts_width: int = 10, code_width: int = 6,
                     wildcard: str = "X", distinct: bool = True) -> DataFrame:
    """``(hts10, naics, naics_ambiguous)``, distinct.

    Ambiguous when the code holds the wildcard anywhere; tariff code reduced
    to digits and left-padded to 10; numeric codes left-padded to 6 (T10:
    left here, right on the dictionary side).  Padding never shortens (T1).
    ``distinct=False`` skips the full-table dedupe where the consumer is
    insensitive to duplicate rows (the deduplicated concordance).
    """
    # the cleaned columns are null where the raw ones are: what is tested needs no cleaning
    d = df.where(F.col(hts).isNotNull() & F.col(code).isNotNull()).select(
        pad_left(digits_only(hts), hts_width).alias("hts10"),
        F.when(is_digits(code), pad_left(code, code_width)).otherwise(F.col(code)).alias("naics"),
        F.col(code).contains(wildcard).alias("naics_ambiguous"),
    )
    return d.distinct() if distinct else d
