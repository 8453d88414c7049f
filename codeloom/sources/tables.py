"""Readers for the driver's parquet tables (explicit column selection)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if its scan has fewer splits than there are cores, else ``df`` as it is.

    For small inputs of rows that fan out: a file of one row group is one task, however large the
    cluster.  A table that fills the cluster has more splits than that and isn't shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; naming the columns keeps ReadSchema to what is used."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
