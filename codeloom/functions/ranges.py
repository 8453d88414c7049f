"""Range notation ``base-suffix`` expanded into one row per code.

``11113-6`` means 11113..11116: the suffix replaces the last ``len(suffix)``
digits of the base.  Tokens that are not ``digits-digits``, that overflow a
32-bit integer, whose end is below the start, or whose suffix is longer than
the base (T5, a deliberate difference: we never guess) pass through as they
are; ``literal=True`` takes a longer suffix as the whole end of the range.
Expanded codes go through an integer, so leading zeros are lost.

``range_blocks`` writes a range as digit blocks instead: a block is a prefix
that stands for all integers of ``digits`` digits which begin with it, and a
range of any width is at most 18 blocks for each of its digits.

Expansion is two generators deep: first the chunk starts of the range, then
the codes inside each chunk.  No row ever builds an array larger than
``CHUNK`` elements, however wide the range, and no range is capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a range token is digits, a dash, digits.
RANGE_PATTERN = "^[0-9]+-[0-9]+$"
CHUNK = 4096


def range_bounds(col, literal: bool = False) -> tuple[Column, Column, Column]:
    """(valid, start, end) for a token column; start/end are 0 when not valid."""
    tok = F.col(col) if isinstance(col, str) else col
    base = F.substring_index(tok, "-", 1)
    suffix = F.substring_index(tok, "-", -1)
    keep = F.length(base) - F.length(suffix)
    prefix = F.when((keep >= 0) | F.lit(literal), F.substring(base, F.lit(1), F.greatest(keep, F.lit(0))))
    start = base.try_cast("int")
    end = F.concat(prefix, suffix).try_cast("int")
    valid = (tok.rlike(RANGE_PATTERN) & ((keep >= 0) | F.lit(literal)) & start.isNotNull()
             & end.isNotNull() & (end >= start))
    valid = F.coalesce(valid, F.lit(False))
    # Guarded bounds: safe even where the range branch is not taken.
    lo = F.when(valid, start).otherwise(F.lit(0)).cast("long")
    hi = F.when(valid, end).otherwise(F.lit(0)).cast("long")
    return valid, lo, hi


def malformed_ranges(df: DataFrame, col: str, literal: bool = False, out: str = "n_rows") -> DataFrame:
    """``(col, out)``: tokens that look like a range but pass through unexpanded, with their rows."""
    valid, _, _ = range_bounds(col, literal)
    return df.where(F.col(col).rlike(RANGE_PATTERN) & ~valid).groupBy(col).agg(F.count(F.lit(1)).alias(out))


def expand_ranges(df: DataFrame, col: str, out: str, literal: bool = False) -> DataFrame:
    """Add ``out``: one row per expanded code (others pass ``col`` through).

    A literal reading can make one token enormous: its chunks are then spread
    over the partitions before they expand.
    """
    valid, lo, hi = range_bounds(col, literal)
    v, lo_c, hi_c, ch = "__rng_valid", "__rng_lo", "__rng_hi", "__rng_chunk"
    keep = [F.col(f"`{c}`") for c in df.columns]
    step = F.lit(CHUNK).cast("long")
    chunked = df.select(
        *keep, valid.alias(v), lo.alias(lo_c), hi.alias(hi_c),
        F.explode(F.when(valid, F.sequence(lo, hi, step))
                  .otherwise(F.array(F.lit(None).cast("long")))).alias(ch))
    if literal:
        chunked = chunked.repartition(ch, col)
    inner = F.sequence(F.col(ch), F.least(F.col(ch) + (CHUNK - 1), F.col(hi_c)))
    return chunked.select(
        *keep,
        F.explode(F.when(F.col(v), F.transform(inner, lambda x: x.cast("string")))
                  .otherwise(F.array(F.col(col)))).alias(out))


_POWERS = [10 ** i for i in range(11)]   # a 32-bit integer has ten digits at most


def _power(i: Column) -> Column:
    return F.get(F.array(*[F.lit(p).cast("long") for p in _POWERS]), i)


def _up(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _blocks_of_length(lo: Column, hi: Column, d: Column) -> Column:
    """Blocks of the integers from ``lo`` to ``hi`` that have ``d`` digits.

    The blocks with ``i`` free digits are the whole multiples of ``10^i`` in the range that lie in
    no whole multiple of ``10^(i+1)``: a few left of the wider blocks and a few right of them.
    """
    low = F.greatest(lo, F.when(d == 1, F.lit(0).cast("long")).otherwise(_power(d - 1)))
    high = F.least(hi, _power(d) - 1)

    def free(i: Column) -> Column:
        step, wide = _power(i), _power(i + 1)
        a, b = _up(low + step - 1, step), _up(high + 1, step)
        wide_a, wide_b = _up(low + wide - 1, wide), _up(high + 1, wide)
        inner = (i < d - 1) & (wide_a < wide_b)
        run = lambda x, y: F.when(x < y, F.sequence(x, F.greatest(x, y - 1))).otherwise(F.array().cast("array<bigint>"))
        starts = F.concat(run(a, F.when(inner, F.least(wide_a * 10, b)).otherwise(b)),
                          F.when(inner, run(F.greatest(wide_b * 10, a), b)).otherwise(F.array().cast("array<bigint>")))
        return F.transform(starts, lambda x: F.struct(x.cast("string").alias("block"), d.alias("digits")))

    return F.flatten(F.transform(F.sequence(F.lit(0), d - 1), free))


def range_blocks(df: DataFrame, col: str, out: str = "block", digits: str = "digits", literal: bool = False) -> DataFrame:
    """Add ``out`` and ``digits``: a row per digit block of a range, however wide; other tokens pass through.

    ``digits`` is null for a block without free digits (``out`` is the code) and for tokens.  The
    codes of the blocks are exactly those of ``expand_ranges``, each in one block.
    """
    valid, lo, hi = range_bounds(col, literal)
    keep = [F.col(f"`{c}`") for c in df.columns]
    bounded = df.select(*keep, valid.alias("__rng_valid"), lo.alias("__rng_lo"), hi.alias("__rng_hi"))
    low, high = F.col("__rng_lo"), F.col("__rng_hi")
    lengths = F.sequence(F.length(low.cast("string")), F.length(high.cast("string")))
    every = F.flatten(F.transform(lengths, lambda d: _blocks_of_length(low, high, d)))
    token = F.array(F.struct(F.col(col).alias("block"), F.lit(None).cast("int").alias("digits")))
    rows = bounded.select(*keep, F.explode(F.when(F.col("__rng_valid"), every).otherwise(token)).alias("__blk"))
    open_digits = F.when(F.col("__blk.digits") > F.length("__blk.block"), F.col("__blk.digits"))
    return rows.select(*keep, F.col("__blk.block").alias(out), open_digits.alias(digits))
