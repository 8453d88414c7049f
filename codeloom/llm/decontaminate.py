"""Operator 1: benchmark decontamination, with DataFrame operations only.

The benchmark's windows of ``n`` words are a hash set that is broadcast when its rows and bytes
are within bounds, and joined by a shuffle beyond them.  A document window of L words contains
at least one whole block of ``(L + 1) // 2`` words that begins at a multiple of that length, so
only these aligned blocks of a document are hashed and looked up among the benchmark's blocks at
all offsets; the windows around a block that was found are then compared word by word with the
benchmark's windows.  Beyond the broadcast bounds only the blocks' hashes are shuffled, and of the
texts those that hold a block that was found.  No occurrence can be missed, and a document without a match costs one
lookup for every (L + 1) // 2 words.

Words are lower-cased (A-Z only) runs ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text.  An item
of fewer than ``n`` words, but not none, is one window.

Defined results: a null or empty text has no words and no hits; an item without words has no
window; repeated items count by their distinct item_id (a null item_id is no item);
each row of ``docs`` is judged by itself, repeated rows and null identifiers too; an empty
benchmark hits nothing; result columns replace input columns of the same name in ``judge``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.operators.broadcast import known_rows, materialize, sized_broadcast

WINDOW = 13
#: A document is contaminated when at least one word in twenty is hit.
SHARE = 20
#: Bounds of a broadcast: rows, and bytes of their texts.
MAX_ROWS, MAX_BYTES = 500_000, 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text; null has none."""
    t = F.coalesce(text, F.lit(""))
    lower = F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))
    return F.array_remove(F.split(lower, GAP), "")


def window_text(words: Column, start: Column, length: Column) -> Column:
    """``length`` words from ``start`` (from 0), by spaces: words hold none, so equal texts are equal words."""
    return F.array_join(F.slice(words, start + 1, length), " ")


def item_windows(items: DataFrame, text: str = "text", item_id: str = "item_id", n: int = WINDOW) -> DataFrame:
    """(length, window, items): each distinct window and the sorted item_ids, as text, that have it."""
    w = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words_of(F.col(f"`{text}`")).alias("words")).where("item is not null and size(words) > 0")
    w = w.withColumn("length", F.least(F.lit(n), F.size("words")))
    w = w.select("item", "words", "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("start"))
    w = w.select("item", "length", window_text(F.col("words"), F.col("start"), F.col("length")).alias("window"))
    return w.groupBy("length", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))


def block_length(length: int) -> int:
    return (length + 1) // 2


def _block(words: Column, start: Column, length: int) -> Column:
    return F.xxhash64(F.slice(words, start + 1, F.lit(length)))


def _small(df: DataFrame, size: Column) -> DataFrame:
    """``df``, with a broadcast hint when its rows and bytes are within the bounds."""
    if (known_rows(df) or 0) > MAX_ROWS:
        return df
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= MAX_BYTES else df


def hits(docs: DataFrame, items: DataFrame, text: str = "text", keys: list[str] | None = None, n: int = WINDOW, item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """``keys``, ``__row``, ``n_words`` and ``spans``, one row per document.

    ``spans``: the distinct (start, end, items) of benchmark windows, in words.  ``__row`` numbers
    the rows of ``docs``.
    """
    keys = keys or []
    windows = materialize(item_windows(items, item_text, item_id, n), "windows")
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())   # at most n values
    d = docs.select(*[F.col(f"`{k}`") for k in keys], F.monotonically_increasing_id().alias("__row"), words_of(F.col(f"`{text}`")).alias("__words"))
    count = F.size("__words")
    spans_of = "array<struct<start:int,end:int,items:array<string>>>"
    if not lengths:
        return d.select(*keys, "__row", count.alias("n_words"), F.array().cast(spans_of).alias("spans"))

    def blocks(length: int) -> Column:
        k = block_length(length)
        each = F.transform(F.sequence(F.lit(0), F.floor(count / k).cast("int") - 1),
                           lambda i: F.struct(F.lit(length).alias("length"), (i * k).alias("at"), _block(F.col("__words"), i * k, k).alias("block")))
        return F.when(count >= length, each)

    listed = [F.coalesce(blocks(x), F.array().cast("array<struct<length:int,at:int,block:bigint>>")) for x in lengths]

    def window_blocks(length: int) -> DataFrame:
        k = block_length(length)
        offsets = F.sequence(F.lit(0), F.lit(length - k))
        each = F.transform(offsets, lambda i: _block(F.split("window", " "), i, k))
        return windows.where(F.col("length") == length).select("length", F.explode(each).alias("block"))

    seeds = reduce(DataFrame.unionByName, map(window_blocks, lengths)).distinct().withColumn("seed", F.lit(True))
    seeds = materialize(seeds, "seeds")
    if (known_rows(seeds) or 0) > MAX_ROWS:
        return _hits_by_shuffle(docs, keys, text, reduce(F.concat, listed), seeds, windows)
    seeds = _small(seeds, F.lit(16))
    one = F.struct(F.lit(0).alias("length"), F.lit(0).alias("at"), F.lit(None).cast("long").alias("block"))   # keeps the document
    d = d.withColumn("__b", F.explode(reduce(F.concat, listed, F.array(one))))
    d = d.select(*keys, "__row", "__words", F.col("__b.length").alias("length"), F.col("__b.at").alias("at"), F.col("__b.block").alias("block"))
    near = d.join(seeds, ["length", "block"], "left").where(F.col("seed") | (F.col("length") == 0))
    near = near.withColumn("n_words", F.size("__words"))
    near = near.select(*keys, "__row", "n_words", "length", F.explode_outer(F.when(F.col("seed"), _windows_around())).alias("w"))
    near = near.select(*keys, "__row", "n_words", "length", F.col("w.start").alias("start"), F.col("w.window").alias("window"))
    exact = near.join(_small(windows, F.length("window") + F.size("items") * 16), ["length", "window"], "left")
    exact = exact.where(F.col("items").isNotNull() | (F.col("length") == 0))
    span = F.when(F.col("items").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end"), "items"))
    return exact.groupBy("__row", *keys).agg(F.max("n_words").alias("n_words"), F.array_sort(F.collect_set(span)).alias("spans"))


def _windows_around() -> Column:
    """The windows (start, window) of ``length`` words that hold the block ``at`` a place of ``__words``, null without any."""
    first = F.greatest(F.lit(0), F.col("at") + F.floor((F.col("length") + 1) / 2).cast("int") - F.col("length"))
    last = F.least(F.col("at"), F.col("n_words") - F.col("length"))
    return F.when(first <= last, F.transform(F.sequence(first, last), lambda s: F.struct(
        s.alias("start"), window_text(F.col("__words"), s, F.col("length")).alias("window"))))


def _hits_by_shuffle(docs: DataFrame, keys: list[str], text: str, listed: Column, seeds: DataFrame, windows: DataFrame) -> DataFrame:
    """:func:`hits` with seeds beyond the broadcast bounds.

    The documents are numbered in a written table.  What meets the seeds is (row, length, place,
    block), one for each block of words, and Spark can split the rows of a frequent block, as both
    sides are plain tables.  Only the documents with a found block come back for comparison, by
    their numbers: these are broadcast if they are few, and else the texts are shuffled once.
    """
    d = docs.select(*[F.col(f"`{k}`") for k in keys], F.monotonically_increasing_id().alias("__row"), F.col(f"`{text}`").alias("__text"))
    d = materialize(d, "numbered")
    blocks = d.select("__row", words_of(F.col("__text")).alias("__words")).select("__row", F.explode(listed).alias("__b"))
    blocks = blocks.select("__row", F.col("__b.length").alias("length"), F.col("__b.at").alias("at"), F.col("__b.block").alias("block"))
    found = materialize(blocks.join(seeds.drop("seed"), ["length", "block"]).select("__row", "length", "at"), "found_blocks")
    places = found.groupBy("__row").agg(F.collect_set(F.struct("length", "at")).alias("__places"))     # of one document, so bounded by its text
    near = d.select("__row", "__text").join(sized_broadcast(places, bound=known_rows(found)), "__row")
    near = near.select("__row", words_of(F.col("__text")).alias("__words"), F.explode("__places").alias("p"))
    near = near.select("__row", "__words", F.size("__words").alias("n_words"), F.col("p.length").alias("length"), F.col("p.at").alias("at"))
    near = near.select("__row", "length", F.explode(_windows_around()).alias("w")).select("__row", "length", F.col("w.start").alias("start"), F.col("w.window").alias("window"))
    exact = near.join(windows, ["length", "window"])
    spans = exact.groupBy("__row").agg(F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("length")).alias("end"), "items"))).alias("spans"))
    every = d.select("__row", *keys, F.size(words_of(F.col("__text"))).alias("n_words")).join(spans, "__row", "left")
    return every.withColumn("spans", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)))


def judge(found: DataFrame, share: int = SHARE) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated from ``spans``."""
    zero = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto"))
    covered = F.aggregate("spans", zero, lambda a, x: F.struct(
        (a["covered"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["upto"]))).alias("covered"),
        F.greatest(a["upto"], x["end"]).alias("upto")))["covered"]
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda x: x["items"]))))
    return found.withColumns({"n_words": F.col("n_words").cast("long"), "n_hit": covered.cast("long"), "__items": ids}).withColumns({
        "n_items": F.size("__items").cast("long"), "items_sha256": F.sha2(F.array_join("__items", ","), 256),
        "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))}).drop("__items")


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans: one row per document."""
    found = hits(docs, items, text, [doc_id], **how).withColumnRenamed(doc_id, "doc_id")
    return judge(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that aren't contaminated, with all their columns.  A doc_id with one contaminated
    row loses all its rows; a row without doc_id stays."""
    bad = contamination(docs, items, text, doc_id).where("contaminated and doc_id is not null").select(F.col("doc_id").alias("__bad")).distinct()
    bad = materialize(bad, "contaminated")
    return docs.join(bad, docs[doc_id] == bad["__bad"], "left_anti")
