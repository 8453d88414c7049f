"""Sinks: delimited text, parquet, and the analysis file (work columns dropped).

All writes are parallel (one file per task) and go to a caller-given path,
normally under the cluster's shared folder; a path is never overwritten.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.operators.broadcast import hot_salts
from codeloom.session import scratch_path
from codeloom.sources.sheets import CSV_OPTIONS


def write_csv(df: DataFrame, path: str) -> None:
    """A5: header line, no row names, NULL written as ``NA``, white space kept."""
    df.write.mode("errorifexists").options(**CSV_OPTIONS).option("header", "true").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a ``write_csv`` output with an explicit schema (no inference)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("header", "true").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None) -> None:
    """Native columnar sink."""
    w = df.write.mode("errorifexists").options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


#: Files that a task of a partitioned write keeps open at once.
OPEN_FILES = 8
CONF_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


#: Rows of a page (20,000 by default) where most columns repeat: such a page has a few KB, and a cost
#: for each page is most of what it costs.  A page still ends at its size in bytes.
FLAT_PAGES = {"parquet.page.row.count.limit": "200000"}


#: Bytes of shuffled rows that a task of a fanned-out write takes (64 MB by default): each makes many
#: rows, and a few long tasks leave cores idle at the end.
TASK_BYTES = 16 << 20
CONF_TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def _open_files(spark: SparkSession, files: int = OPEN_FILES, task_bytes: int = TASK_BYTES) -> Iterator[None]:
    """Partitioned writes keep up to ``files`` files open, and sort rows by partition only beyond them;
    a task after a shuffle takes ``task_bytes``.

    A setting of the session's own is left as it is.
    """
    ours = {} if int(spark.conf.get(CONF_OPEN_FILES, "0")) > 0 else {CONF_OPEN_FILES: str(files)}
    if spark.conf.get(CONF_TASK_BYTES, None) is None:
        ours[CONF_TASK_BYTES] = str(task_bytes)
    try:
        for k, v in ours.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def analysis_file(merged: DataFrame, path: str,
                  work_columns: Sequence[str] = ("code_str", "code_type", "code_prefix", "code_6d"),
                  partition_by: Sequence[str] = ("match_quality",)) -> None:
    """Drop the work columns, keep every other column, write partitioned parquet.

    Partitioning by the quality tier lets a downstream sample restriction
    (E13) prune whole folders.  The tiers are few, so a task writes them side by
    side: the fanned-out rows are not sorted by tier.
    """
    with _open_files(merged.sparkSession):
        write_parquet(merged.drop(*work_columns), path, partition_by, FLAT_PAGES)


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, table: str | None = None, path: str | None = None) -> str:
    """A6 for repeated merges: a table in ``buckets`` by ``keys``, sorted; returns its name.

    One file per bucket: the rows are dealt by the same hash before the write.  Two tables
    with equal buckets join on the keys without a shuffle, now and in every later merge.
    """
    table = table or f"codeloom_{uuid.uuid4().hex[:12]}"
    path = path or scratch_path(df.sparkSession, table)
    df.repartition(buckets, *keys).write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)
    return table


def write_bucketed_pair(facts: DataFrame, lookup: DataFrame, code: str, lookup_code: str, stats: DataFrame,
                        record_key: Sequence[str], buckets: int, stats_code: str = "code_raw", stats_rows: str = "n_rows") -> tuple[str, str]:
    """Records and their lookup as co-located tables: bucketed by ``(code, salt)``.

    A code with more than half a bucket's share of the records (from per-code ``stats``) is dealt over
    salts by a hash of ``record_key``, and its lookup row stands once per salt, so no bucket holds a
    hot code whole.  :func:`read_bucketed_pair` joins them without a shuffle.
    """
    hot = F.broadcast(hot_salts(stats, [stats_code], stats_rows, buckets).withColumnRenamed(stats_code, "__hot"))
    salts = F.coalesce("__salts", F.lit(1))
    f = facts.join(hot, facts[code] == hot["__hot"], "left").withColumn("__salt", F.pmod(F.xxhash64(*record_key), salts).cast("int"))
    k = lookup.join(hot, lookup[lookup_code] == hot["__hot"], "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    drop = ["__hot", "__salts"]
    return write_bucketed(f.drop(*drop), [code, "__salt"], buckets), write_bucketed(k.drop(*drop), [lookup_code, "__salt"], buckets)


def read_bucketed_pair(spark: SparkSession, facts: str, lookup: str, code: str, lookup_code: str) -> DataFrame:
    """The inner join of a :func:`write_bucketed_pair`, bucket by bucket."""
    f, k = spark.table(facts), spark.table(lookup).withColumnRenamed(lookup_code, "__lk").withColumnRenamed("__salt", "__lsalt")
    return f.join(k.hint("merge"), (f[code] == k["__lk"]) & (f["__salt"] == k["__lsalt"])).drop("__salt", "__lsalt", "__lk")
