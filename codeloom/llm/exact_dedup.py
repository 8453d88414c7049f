"""Operator 3: exact duplicates by a sort of the whole texts.

Sampled splitters range-partition the rows by a bounded prefix and a hash of the normalised
text, then by identifier, so that a group of copies, however large, spreads over partitions.
Each partition is sorted externally by the normalised bytes; equal texts are neighbours, and
full comparisons of neighbours make runs.  A run keeps its smallest identifier.  Only the first
and last run of a partition can go on in another one: their texts (two a partition at most)
are grouped, which joins the parts of one group.

Defined results: null text counts as empty; texts are equal when identical after each
``[\\x20\\x09-\\x0D]+`` became one space; of rows that share text and identifier one stays; a null
identifier sorts last; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.operators.broadcast import materialize

#: Characters of the normalised text in a splitter.
SPLITTER_CHARS = 24
#: What a run's rows carry beside the columns asked for.
RUN = T.StructType([T.StructField("head", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("first", T.BooleanType()), T.StructField("sha", T.StringType()), T.StructField("part", T.LongType()), T.StructField("border", T.StringType())])


def normalised(text: str) -> Column:
    """The text with each run of white space as one space; null is empty.

    The pattern leaves single spaces alone, which most matches would be.
    """
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def runs(docs: DataFrame, columns: list[str], text: str = "text", doc_id: str = "doc_id", heads_only: bool = False) -> DataFrame:
    """``row``, a struct of each row's ``columns``, and ``run``, its run of equal texts in a sorted partition.

    ``head`` is the run's smallest identifier, ``rows`` its size, ``first`` marks one row of it,
    ``border`` has the text on the first row of a run that may go on in another partition.
    ``heads_only`` gives the first rows only.
    """
    arrays.bounded_batches(docs.sparkSession)
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("long").alias("id"))
    d = d.withColumn("norm", normalised("text"))
    d = d.withColumns({"prefix": F.substring("norm", 1, SPLITTER_CHARS), "hash": F.xxhash64("norm")}).drop("text")
    d = d.repartitionByRange(F.col("prefix"), F.col("hash"), F.col("id").asc_nulls_last())
    d = d.sortWithinPartitions("prefix", "hash", "norm", F.col("id").asc_nulls_last())
    d = d.select("row", "id", "norm", F.sha2("norm", 256).alias("sha"))
    schema = T.StructType([d.schema["row"], T.StructField("run", RUN)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, state = TaskContext.get().partitionId(), None
        n_runs = 0

        def out(last: bool) -> pa.RecordBatch:
            held, head, sha, norm, rows = state
            border = norm if last or n_runs == 0 else None
            kept = [held[0].slice(0, 1)] if heads_only else held
            table = pa.Table.from_batches(kept).combine_chunks()
            n = table.num_rows
            first = np.zeros(n, bool)
            first[0] = True
            info = [pa.array([head] * n, pa.int64()), pa.array(np.full(n, rows)), pa.array(first), pa.array([sha] * n, pa.string()), pa.array(np.full(n, part, np.int64)), pa.array([border] + [None] * (n - 1), pa.string())]
            return pa.RecordBatch.from_arrays([table.column("row").chunk(0), pa.StructArray.from_arrays(info, names=RUN.names)], names=schema.names)

        def many(batch: pa.RecordBatch, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
            """Runs that lie in one batch and are neither a first nor a last one."""
            ids, sha = batch.column("id"), batch.column("sha")
            rows = np.arange(starts[0], ends[-1])
            size = ends - starts
            head = np.repeat(starts, size)
            take = starts if heads_only else rows
            at = starts if heads_only else head
            n = size if heads_only else np.repeat(size, size)
            info = [ids.take(pa.array(at)), pa.array(n), pa.array(take == at), sha.take(pa.array(take)), pa.array(np.full(len(take), part, np.int64)), pa.nulls(len(take), pa.string())]
            return pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(take)), pa.StructArray.from_arrays(info, names=RUN.names)], names=schema.names)

        for batch in batches:
            if not batch.num_rows:
                continue
            norm = batch.column("norm")
            new = np.concatenate([[state is None or state[3] != norm[0].as_py()], pc.not_equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)])
            slim = batch.select(["row"])
            starts = np.flatnonzero(new)
            to = int(starts[0]) if len(starts) else batch.num_rows
            if to:   # the run before goes on
                if not heads_only:
                    state[0].append(slim.slice(0, to))
                state[4] += to
            if not len(starts):
                continue
            if state:
                yield out(False)
                n_runs += 1
            done = 0
            if n_runs == 0 and len(starts) > 1:   # the first run of the partition
                a, b = int(starts[0]), int(starts[1])
                state = [[slim.slice(a, b - a)], batch.column("id")[a].as_py(), batch.column("sha")[a].as_py(), norm[a].as_py(), b - a]
                yield out(False)
                n_runs, done = 1, 1
            if len(starts) - 1 > done:
                yield many(batch, starts[done:-1], starts[done + 1:])
                n_runs += len(starts) - 1 - done
            a = int(starts[-1])
            state = [[slim.slice(a)], batch.column("id")[a].as_py(), batch.column("sha")[a].as_py(), norm[a].as_py(), batch.num_rows - a]
        if state:
            yield out(True)

    return d.mapInArrow(arrays.released(scan), schema)


def joined_borders(found: DataFrame) -> DataFrame:
    """Groups whose runs lie in several partitions: the runs' key and the group's values.

    At most two rows a partition go in, grouped by the whole text.
    """
    r = F.col("run")
    border = found.where(r["border"].isNotNull()).select(r["border"].alias("text"), r["sha"].alias("sha"), r["head"].alias("head"), r["part"].alias("part"), r["rows"].alias("rows"))
    last = F.lit((1 << 63) - 1)
    group = border.groupBy("text").agg(F.min("head").alias("keep"), F.sum("rows").alias("size"), F.count(F.lit(1)).alias("n"), F.min(F.struct(F.coalesce("head", last), "part")).alias("least"))
    group = group.where("n > 1").select("text", "keep", "size", F.col("least.part").alias("first_part"))
    runs_of = border.join(group, "text").select("sha", "part", "keep", "size", "first_part")
    return runs_of.dropDuplicates(["sha", "part"])


def with_groups(found: DataFrame) -> DataFrame:
    """``found`` (of :func:`runs`, materialised) with ``keep_id``, ``group_size`` and ``kept``."""
    b = F.broadcast(joined_borders(found))   # two rows a partition at most
    r = F.col("run")
    j = found.join(b, (r["sha"] == b["sha"]) & (r["part"] == b["part"]), "left")
    other = F.col("first_part").isNotNull()
    return j.select("row", F.when(other, F.col("keep")).otherwise(r["head"]).alias("keep_id"),
                    F.when(other, F.col("size")).otherwise(r["rows"]).alias("group_size"),
                    (r["first"] & F.coalesce(F.col("first_part") == r["part"], F.lit(True))).alias("kept"), r["sha"].alias("text_sha256"))


def duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = materialize(runs(docs, [doc_id], text, doc_id), "exact_runs")
    return with_groups(found).select(F.col("row")[doc_id].alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    found = materialize(runs(docs, docs.columns, text, doc_id, heads_only=True), "exact_heads")
    return with_groups(found).where("kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
