"""Lookups with one row per key and an array of entries.

A join with a many-to-many lookup writes the key's columns once for every
entry, and a hot key that is salted replicates every entry's row.  With the
entries nested, the join finds one row per key, and a generator fans out
above it: the lookup holds no key twice, and what is replicated is one array.

An array is bounded: by what the caller knows of its groups, else a key's
entries are dealt into rows of about ``CHUNK`` entries by their hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1000


def nested(rows: DataFrame, keys: Sequence[str], entries: str = "entries", bounded: bool = False, chunk: int = CHUNK) -> DataFrame:
    """``(*keys, entries)``: the other columns of ``rows`` as an array of structs per key.

    ``bounded``: a key has few rows (e.g. one per target).  Without it, a key of more than
    ``chunk`` rows gets several rows of the result; a join meets each entry once all the same.
    """
    rest = [c for c in rows.columns if c not in keys]
    entry = F.collect_list(F.struct(*[F.col(f"`{c}`") for c in rest])).alias(entries)
    if bounded:
        return rows.groupBy(*keys).agg(entry)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > chunk)
    parts = F.coalesce(F.ceil(F.col("__n") / chunk), F.lit(1))
    dealt = rows.join(counts, list(keys), "left").withColumn("__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rest]), parts))
    return dealt.groupBy(*keys, "__part").agg(entry).drop("__part")


def first_per(df: DataFrame, entries: str, field: str) -> DataFrame:
    """``df`` with only the first entry of each ``field`` in the sorted array column ``entries``."""
    last = lambda i: F.get(F.col(entries), i - 1)[field]   # noqa: E731  null before the first
    return df.withColumn(entries, F.filter(F.col(entries), lambda x, i: (i == 0) | (x[field] != last(i))))


def fanned_out(df: DataFrame, entries: str = "entries", outer: bool = False) -> DataFrame:
    """A row per entry, its fields as columns; ``outer`` keeps rows without entries, with nulls."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != entries], (F.inline_outer if outer else F.inline)(entries))
