"""Sheet-like delimited text: preamble rows, a header, then data.

Spreadsheet exports carry a few title rows before the header.  Spark's CSV
reader only knows "first line is a header", so ``read_sheet`` reads lines as
text, numbers them within each file from the scan itself, drops the first
``skip + header`` lines of every file and parses the rest with ``from_csv``
against an explicit schema (no type guessing, A2).

Only the split that starts at byte 0 of a file holds its preamble
(``_metadata``).  The scan is planned with one split per task, so the row
number in the task (the lower bits of ``monotonically_increasing_id``) is the
line number in the split: lines are dropped in the same pass that reads them,
and nothing is looked up.  Cells must not contain line breaks.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A cost of opening a file above any split's size: no second split fits into a task's share.
_ALONE = 1 << 50

CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "NA",
}


def all_text_schema(columns: list[str]) -> T.StructType:
    """A2: every column as string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_sheet(spark: SparkSession, path: str, schema: T.StructType, skip: int = 0,
               header: bool = True, options: dict[str, str] | None = None) -> DataFrame:
    """A1: skip ``skip`` preamble lines (+ header) per file; parse with ``schema``."""
    opts = {**CSV_OPTIONS, **(options or {})}
    drop_n = skip + (1 if header else 0)
    if drop_n:
        lines = _one_split_a_task(spark).read.text(path).select(
            "value", F.col("_metadata.file_block_start").alias("__b"), _row_in_task().alias("__n"))
        lines = lines.where((F.col("__b") != 0) | (F.col("__n") >= drop_n)).select("value")
        # the union's empty side vanishes in planning; it makes the result one of the caller's session
        lines = spark.sql("SELECT '' AS value WHERE false").unionByName(lines)
    else:
        lines = spark.read.text(path)
    return lines.select(F.from_csv("value", _ddl(schema), opts).alias("__r")).select("__r.*")


def _one_split_a_task(spark: SparkSession) -> SparkSession:
    """A session on the same context, with the caller's split size, whose scans put no two splits into one task."""
    own = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"):
        value = spark.conf.get(key, None)
        if value is not None:
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.openCostInBytes", str(_ALONE))
    return own


def _row_in_task() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def write_sheet(df: DataFrame, path: str, preamble: list[str], header: bool = True,
                options: dict[str, str] | None = None) -> None:
    """Write ``df`` as delimited text, each output file opening with ``preamble`` + header.

    Rows become CSV lines with ``to_csv``; the first row of each partition
    (row number 0 in the lower 33 bits of its id) brings the opening lines, so
    the write stays parallel and in the JVM.  Header names are quoted where
    they need it.  A partition without rows makes a file without lines.
    """
    opts = {**CSV_OPTIONS, **(options or {})}
    head = io.StringIO()
    csv.writer(head, lineterminator="", delimiter=opts.get("sep", ",")).writerow(df.columns)
    lead = "".join(x + "\n" for x in [*preamble, *([head.getvalue()] if header else [])])
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), opts)
    first = _row_in_task() == 0
    lines = df.select(F.concat(F.when(first, F.lit(lead)).otherwise(""), line).alias("value"))
    lines.write.mode("errorifexists").text(path)
