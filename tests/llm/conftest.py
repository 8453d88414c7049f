import pytest
from pyspark.sql import types as T

#: Columns whose names the operators use for themselves or for their results.
CLASHES = ["kept", "keep_id", "row", "words", "kind", "norm", "n_words", "score", "length", "rep", "__row"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents (doc_id, text) with null doc_ids where given and columns of clashing names."""
    def make(rows, partitions=3):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), *[T.StructField(c, T.StringType()) for c in CLASHES]])
        return spark.createDataFrame([(i, t, None, *CLASHES) for i, t in rows], schema).repartition(partitions)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 997}x{i // 997}" for i in range(30_000))
    return [(1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "one"), (5, "one"), (6, "ONE"), (7, long), (8, long), (None, "one"), (None, None), (9, "!!! ..."), (10, "été Ünïcode ñandú 日本語"), (11, "a\tb\nc"), (12, "a b c"), (13, "a  b   c")]
