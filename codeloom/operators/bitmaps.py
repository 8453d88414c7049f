"""Exact distinct counts as bitmaps, mergeable over tasks, tables and rounds.

Values are numbered once (``numbered``); a group's distinct values are then bits.  Bits are set
on the map side, so a task ships one bitmap (4 kB) per group and 32,768 numbers however many rows
it read, and bitmaps of several rounds are or-ed.  This pays where groups are few and values many
(codes per tier, coverage); for many small groups a set per group is shorter.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeloom.operators.broadcast import materialize

#: Bits of Spark's bitmaps.
BITS = 15


def numbered(values: DataFrame, value: str, number: str = "id") -> DataFrame:
    """``(value, number)`` of the distinct non-null values, written once so that numbers stay.

    Numbers are consecutive within a file of the table: bitmaps are full but for one per file.
    """
    distinct = values.select(value).where(F.col(value).isNotNull()).distinct()
    return materialize(distinct.withColumn(number, F.monotonically_increasing_id()), "numbered")


def distinct_state(rows: DataFrame, group: Sequence[str], number: str = "id") -> DataFrame:
    """``(*group, bucket, bits)``: the distinct ``number`` values of each group (null ones are left out)."""
    rows = rows.where(F.col(number).isNotNull()).withColumn("bucket", F.shiftright(number, BITS))
    return rows.groupBy(*group, "bucket").agg(F.bitmap_construct_agg(F.col(number).bitwiseAND(F.lit((1 << BITS) - 1))).alias("bits"))


def merged_states(states: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    """One state from those of several rounds, partitions or tables."""
    every = reduce(lambda x, y: x.unionByName(y), states)
    return every.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(state: DataFrame, group: Sequence[str], out: str = "n_codes") -> DataFrame:
    """``(*group, out)``; without ``group`` one row."""
    return state.groupBy(*group).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(out))
