"""Broadcast only what is proven small; materialize small derived tables once.

``materialize`` writes a small derived table (dictionary, code map,
concordance) as parquet into the cluster's shared ``spark.checkpoint.dir``
and reads it back: lineage is cut, executor loss only re-reads files, and
the row count is observed *during* the write (``DataFrame.observe``), so
knowing the size costs no extra job.  The count travels with the returned
DataFrame as a row bound.

``sized_broadcast`` adds the broadcast hint only when rows and bytes are
within bounds: the rows from a known bound when the caller has one (a table
derived from a materialized one by a bounded fan-out), else counted with
``limit(max_rows + 1)``; the bytes observed during ``materialize``, else
estimated from the rows and the column types.  Above a bound the join is left
to Catalyst and AQE: a shuffle join whose skewed partitions AQE splits at run
time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.session import scratch_path

DEFAULT_MAX_ROWS = 2_000_000
CONF_MAX_ROWS = "spark.codeloom.broadcast.maxRows"
DEFAULT_MAX_BYTES = 128 << 20
CONF_MAX_BYTES = "spark.codeloom.broadcast.maxBytes"
_ROWS_ATTR = "_codeloom_rows"
_BYTES_ATTR = "_codeloom_bytes"
_METRICS_ATTR = "_codeloom_metrics"


def max_broadcast_rows(df: DataFrame, default: int = DEFAULT_MAX_ROWS) -> int:
    v = df.sparkSession.conf.get(CONF_MAX_ROWS, None)
    return int(v) if v else default


def max_broadcast_bytes(df: DataFrame, default: int = DEFAULT_MAX_BYTES) -> int:
    v = df.sparkSession.conf.get(CONF_MAX_BYTES, None)
    return int(v) if v else default


def _type_bytes(kind: T.DataType) -> int:
    """Bytes that a value inside an array or map is taken to have."""
    if isinstance(kind, T.StructType):
        return 8 + sum(_type_bytes(f.dataType) for f in kind.fields)
    return 32 if isinstance(kind, (T.StringType, T.BinaryType)) else 64 if isinstance(kind, (T.ArrayType, T.MapType)) else 8


def _value_bytes(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * _type_bytes(kind.elementType) + 16
    if isinstance(kind, T.MapType):
        return F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0)) * (_type_bytes(kind.keyType) + _type_bytes(kind.valueType)) + 16
    if isinstance(kind, T.StructType):
        return reduce(lambda x, y: x + y, [_value_bytes(c.getField(f.name), f.dataType) for f in kind.fields], F.lit(8))
    return F.lit(8)


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: the length of strings and binaries, the elements of arrays and maps, 8 for other columns."""
    return reduce(lambda x, y: x + y, [_value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields], F.lit(0))


def _bytes_of(df: DataFrame, rows: int) -> int:
    """Observed bytes, else an estimate from rows and column types."""
    known = getattr(df, _BYTES_ATTR, None)
    if known is not None:
        return known
    return rows * sum(32 if isinstance(f.dataType, T.StringType) else 8 if isinstance(f.dataType, T.NumericType) else 64
                      for f in df.schema.fields)


def known_rows(df: DataFrame) -> int | None:
    """Exact row count of a materialized DataFrame, else None."""
    return getattr(df, _ROWS_ATTR, None)


def with_row_bound(df: DataFrame, rows: int | None) -> DataFrame:
    if rows is not None:
        setattr(df, _ROWS_ATTR, int(rows))
    return df


def with_size(df: DataFrame, rows: int, size: int) -> DataFrame:
    """``df`` with a proven bound on its rows and their bytes."""
    setattr(df, _BYTES_ATTR, int(size))
    return with_row_bound(df, rows)


def like(df: DataFrame, other: DataFrame) -> DataFrame:
    """``other`` with the bounds that are known of ``df``, from which it has the same rows."""
    setattr(other, _BYTES_ATTR, getattr(df, _BYTES_ATTR, None))
    return with_row_bound(other, known_rows(df))


def bound_from(df: DataFrame, factor: int = 1) -> int | None:
    """Upper bound for a table derived from ``df`` with at most ``factor`` rows per row."""
    n = known_rows(df)
    return None if n is None else n * factor


def observed(df: DataFrame) -> dict[str, Any]:
    """The ``metrics`` that were asked for when ``df`` was materialized."""
    return getattr(df, _METRICS_ATTR, {})


def materialize(df: DataFrame, name: str = "table", metrics: dict[str, Column] | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder, read it back, keep its row count.

    ``metrics``: named aggregates over ``df`` that the same write observes (:func:`observed`).

    The count is observed in the write's result stage, so each task's
    contribution is applied once even when tasks are retried; it only ever
    licenses a broadcast, so an estimate that erred high would merely
    forgo one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"codeloom_{name}_{uuid.uuid4().hex[:12]}")   # unique: jobs may run concurrently
    asked = [c.alias(f"metric_{k}") for k, c in (metrics or {}).items()]
    df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes"), *asked).write.mode("errorifexists").parquet(path)
    seen = obs.get
    out = with_row_bound(spark.read.parquet(path), seen["rows"])
    setattr(out, _BYTES_ATTR, int(seen["bytes"] or 0))
    setattr(out, _METRICS_ATTR, {k: seen[f"metric_{k}"] for k in metrics or {}})
    return out


def concurrently(**jobs: Callable[[], Any]) -> dict[str, Any]:
    """Run independent Spark actions from separate threads; return their results by name.

    Spark schedules jobs of one application concurrently when they are
    submitted from different threads, so small independent jobs (a
    dictionary, a distinct-code list) overlap instead of queueing.
    """
    if len(jobs) <= 1:
        return {k: f() for k, f in jobs.items()}
    # The caller's job group, tags and scheduler pool hold in the threads too.
    spark = SparkSession.getActiveSession()
    inherit = inheritable_thread_target(spark) if spark else lambda f: f
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {k: pool.submit(inherit(f)) for k, f in jobs.items()}
        return {k: f.result() for k, f in futures.items()}


def fits(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def sized_broadcast(df: DataFrame, max_rows: int | None = None, bound: int | None = None,
                    materialize_first: bool = False, count_unknown: bool = False) -> DataFrame:
    """``F.broadcast(df)`` when its row count is provably within ``max_rows``.

    ``bound``: a proven upper bound on the rows (e.g. derived from a
    materialized input).  ``materialize_first``: write ``df`` to the shared
    folder first, which yields the exact count.  ``count_unknown``: count
    (up to ``max_rows + 1``) when no bound is known.  Without a proven bound
    no hint is added: Catalyst's size estimate and AQE's run-time sizes pick
    the join (broadcast under ``spark.sql.autoBroadcastJoinThreshold``, else
    a shuffle join with skew splitting).
    """
    if materialize_first:
        df = materialize(df)
    limit = max_rows if max_rows is not None else max_broadcast_rows(df)
    if bound is None:
        bound = known_rows(df)
    if bound is not None:
        ok = bound <= limit and _bytes_of(df, bound) <= max_broadcast_bytes(df)
    elif count_unknown:
        ok = fits(df, limit)
    else:
        return df
    if not ok:
        return df
    out = with_row_bound(F.broadcast(df), known_rows(df))
    out._codeloom_broadcast = True
    return out


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def hot_salts(stats: DataFrame, keys: Sequence[str], rows: str, partitions: int, hot_share: float | None = None, spread: float = 2.0) -> DataFrame:
    """``(*keys, __salts)`` of the keys with more than ``hot_share`` of the rows (half a partition's share
    by default): at most ``1 / hot_share`` rows.  So many salts leave a bucket half a partition's fair share."""
    total = stats.agg(F.sum(rows)).first()[0] or 0   # one scalar
    share = F.col(rows) / F.lit(max(total, 1))
    return stats.where(share > (1.0 / (2 * partitions) if hot_share is None else hot_share)).select(
        *keys, F.ceil(share * partitions * spread).cast("int").alias("__salts"))


def skew_safe_join(facts: DataFrame, lookup: DataFrame, fact_keys: str | Sequence[str],
                   lookup_keys: str | Sequence[str], stats: DataFrame | None = None,
                   stats_keys: str | Sequence[str] | None = None, stats_rows: str = "n_rows",
                   hot_share: float | None = None, spread: float = 2.0,
                   salt_columns: Sequence[str] = ()) -> DataFrame:
    """Inner equi-join of large ``facts`` with ``lookup`` that no hot key can stall.

    Returns the fact columns plus the lookup's non-key columns.  A broadcast
    ``lookup`` (hinted by ``sized_broadcast``) needs nothing more: the facts
    are not shuffled.  Otherwise keys holding more than ``hot_share`` of the
    records (from per-key ``stats``; at most ``1/hot_share`` keys qualify,
    so that list is provably small and is broadcast) are salted.  A key gets
    ``share * shuffle partitions * spread`` buckets, so each bucket holds
    about half a partition's fair share, however large the key and the cluster;
    its lookup rows are replicated once per bucket.  Records spread by a hash of
    ``salt_columns`` (that identify a record), else by their row number in the
    partition: then ``facts`` must come from files, where a partition that is
    computed again has the same order.
    Exact: every record meets every lookup row of its key exactly once.
    """
    fk, lk = _names(fact_keys), _names(lookup_keys)
    sk = fk if stats_keys is None else _names(stats_keys)
    ren = {c: f"__lk{i}" for i, c in enumerate(lk)}
    small = lookup.select(*[F.col(f"`{c}`").alias(ren[c]) if c in ren else F.col(f"`{c}`")
                            for c in lookup.columns])

    def on(a: DataFrame, b: DataFrame):
        return reduce(lambda x, y: x & y, [a[f] == b[ren[k]] for f, k in zip(fk, lk)])

    if stats is None or getattr(lookup, "_codeloom_broadcast", False):
        return facts.join(small, on(facts, small), "inner").drop(*ren.values())
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    hk = [f"__hk{i}" for i in range(len(sk))]
    salts = hot_salts(stats, sk, stats_rows, partitions, hot_share, spread)
    hot = F.broadcast(salts.select(*[F.col(c).alias(h) for c, h in zip(sk, hk)], "__salts"))
    f = (facts.withColumn("__row", F.xxhash64(*salt_columns) if salt_columns else F.monotonically_increasing_id())
         .join(hot, reduce(lambda x, y: x & y, [F.col(c) == F.col(h) for c, h in zip(fk, hk)]), "left")
         .withColumn("__salt", F.coalesce(F.pmod(F.col("__row"), F.col("__salts")).cast("int"), F.lit(0)))
         .drop(*hk, "__salts", "__row"))
    sm = (small.join(hot, reduce(lambda x, y: x & y, [F.col(ren[c]) == F.col(h) for c, h in zip(lk, hk)]), "left")
          .withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1)))
          .drop(*hk, "__salts"))
    return (f.join(sm, on(f, sm) & (f["__salt"] == sm["__salt"]), "inner")
            .drop("__salt", *ren.values()))
