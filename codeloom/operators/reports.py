"""Coverage and review reports, returned as DataFrames (the caller shows them).

Every report is an aggregate over the concordance or the inputs; nothing is
collected to the driver.  Percentages are computed in integer arithmetic
(tenths, rounded half up) and returned as numbers (T9), so they do not depend
on float rounding quirks of any engine.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.operators.broadcast import observed


def percent_1dp(num: str, den: str) -> F.Column:
    """``round(100 * num / den, 1)`` with exact half-up rounding; NULL if den is 0.

    Integer division on tenths: ``(2000 * num + den) div (2 * den)``.
    """
    tenths = F.expr(f"case when {den} > 0 then (cast({num} as bigint) * 2000 + {den}) div (cast({den} as bigint) * 2) end")
    return tenths / F.lit(10.0)


def percent_label(col: str) -> F.Column:
    """Display text ``12.3%`` of an already rounded percentage (T9: a double,
    never a decimal, goes into ``format_string``)."""
    return F.format_string("%.1f%%", F.col(col).cast("double"))


def coverage(total_keys: DataFrame, matched_keys: DataFrame, key: str, label: str) -> DataFrame:
    """One row ``(pipeline, n_matched, n_total, pct)``.

    Both key sets are tagged, unioned and counted in one global aggregate
    (distinct counts shuffle by key; no join of the two sides).
    """
    u = total_keys.select(F.col(key).alias("__k"), F.lit(False).alias("__m")).unionByName(
        matched_keys.select(F.col(key).alias("__k"), F.lit(True).alias("__m")))
    agg = u.agg(F.count_distinct(F.when(F.col("__m"), F.col("__k"))).alias("n_matched"),
                F.count_distinct(F.when(~F.col("__m"), F.col("__k"))).alias("n_total"))
    return (agg.select(F.lit(label).alias("pipeline"), "n_matched", "n_total",
                       percent_1dp("n_matched", "n_total").alias("pct"))
            .withColumn("pct_label", percent_label("pct")))


def count_by(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """H3: row count per value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def distinct_count_by(df: DataFrame, key: str, col: str, out: str = "n_codes") -> DataFrame:
    """Distinct (key, col) pairs, then a count per value of ``col``."""
    return df.select(key, col).distinct().groupBy(col).agg(F.count(F.lit(1)).alias(out))


def count_by_entry(lists: DataFrame, field: str, matches: str = "matches", out: str = "n_codes") -> DataFrame:
    """H4/R3/R6 from ``allocate.graded_lists``: codes per value of an entry's ``field``.

    A code is one row, so its distinct values are found within it: the counts are summed before
    the one shuffle, and no (code, value) pair is sent.
    """
    each = lists.select(F.explode(F.array_distinct(F.transform(matches, lambda x: x[field]))).alias(field))
    return count_by(each, field, out)


def fanout_histogram(fan: DataFrame, n: str = "n_targets", out: str = "n_codes") -> DataFrame:
    """How many codes have each fan-out."""
    return fan.groupBy(n).agg(F.count(F.lit(1)).alias(out))


def target_lists(conc: DataFrame, code: str = "code", target: str = "target",
                 out: str = "target_list", sep: str = ", ") -> DataFrame:
    """H8: sorted distinct targets per code joined to text.

    ``collect_set`` per code is bounded by the number of targets (fan-out),
    never by the fact table.
    """
    return conc.groupBy(code).agg(
        F.array_join(F.array_sort(F.collect_set(target)), sep).alias(out))


def high_fanout_review(conc: DataFrame, threshold: int = 2, code: str = "code",
                       target: str = "target", n: str = "n_targets",
                       out: str = "target_list", sep: str = ", ") -> DataFrame:
    """Codes with more than ``threshold`` targets, their list, descending.

    Fan-out and list come from one ``collect_set`` per code (bounded by the
    number of targets), so the concordance is aggregated once, not joined
    with its own aggregate.
    """
    per = conc.groupBy(code).agg(F.array_sort(F.collect_set(target)).alias("__s"))
    return _review(per.select(code, F.size("__s").cast("long").alias(n), "__s"), threshold, code, n, out, sep)


def _review(per: DataFrame, threshold: int, code: str, n: str, out: str, sep: str) -> DataFrame:
    return per.where(F.col(n) > threshold).select(code, n, F.array_join("__s", sep).alias(out)).orderBy(F.desc(n), code)


def review_from_lists(lists: DataFrame, threshold: int = 2, code: str = "code", n: str = "n_targets",
                      out: str = "target_list", sep: str = ", ") -> DataFrame:
    """R5 from ``allocate.graded_lists``: fan-out and targets (unique and sorted) are there already,
    so the report filters and sorts, without an aggregate by code."""
    return _review(lists.select(code, n, F.transform("matches", lambda x: x["target"]).alias("__s")), threshold, code, n, out, sep)


def targets_from_lists(lists: DataFrame, code: str = "code", out: str = "target_list", sep: str = ", ") -> DataFrame:
    """H8 from ``allocate.graded_lists``."""
    return lists.select(code, F.array_join(F.transform("matches", lambda x: x["target"]), sep).alias(out))


def rows_with_prefix(df: DataFrame, col: str, prefixes: Sequence[str],
                     out: str = "n_dropped") -> DataFrame:
    """R2: one row, the number of rows whose ``col`` starts with any prefix.

    Filter, then a global count (always one row): the predicate is pushed
    below an upstream ``distinct`` on ``col``, so only the matching family
    is shuffled, not the whole table.
    """
    cond = F.lit(False)
    for p in prefixes:
        cond = cond | F.col(col).startswith(p)
    return df.where(cond).agg(F.count(F.lit(1)).alias(out))


def over_threshold_count(fan: DataFrame, threshold: int = 1, n: str = "n_targets",
                         out: str = "n_codes") -> DataFrame:
    """One row, the number of keys whose fan-out exceeds ``threshold``."""
    return fan.agg(F.count_if(F.col(n) > threshold).alias(out))


def warn_observed(stats: DataFrame, metric: str = "n_unclassified") -> int:
    """R8 from a metric that the write of the code stats has observed (``codes.unclassified_rows``):
    warns like :func:`warn_unclassified`, without a job."""
    n = int(observed(stats).get(metric) or 0)
    if n > 0:
        warnings.warn(f"{n} rows have unclassified codes; inspect them before proceeding "
                      f"(see the count_unclassified report)", stacklevel=2)
    return n


def warn_unclassified(per_code: DataFrame, code_type: str = "code_type", rows: str = "n_rows",
                      other: str = "other") -> int:
    """R8 as a runtime check: warn when records carry unclassified codes; return their count.

    ``per_code`` has one row per code (e.g. code stats joined to the code
    map), so only one scalar reaches the driver.
    """
    n = per_code.where(F.col(code_type) == other).agg(F.sum(rows)).first()[0] or 0
    if n > 0:
        warnings.warn(f"{n} rows have unclassified codes; inspect them before proceeding "
                      f"(see the count_unclassified report)", stacklevel=2)
    return int(n)
