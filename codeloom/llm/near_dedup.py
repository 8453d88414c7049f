"""Operator 4: near-duplicate classes by improved consistent weighted sampling (ICWS).

1. Shingles of five words, with a weight: (1 + ln term frequency) times an inverse document
   frequency, in sixteenths.  The document frequency comes from a count-min sketch of fixed size
   over all documents.  A shingle in less than ``COMMON`` of them weighs 1, as only ubiquitous
   shingles should lose weight: else the copies within one large group would drift apart.  A
   group of copies may hold a third of all documents, so ``COMMON`` lies above that.
2. ICWS draws ``BANDS * ROWS`` samples a document; two documents share a sample with the
   probability of their weighted Jaccard similarity.  Equal word sequences are one node from
   here on.  The samples of a band make its bucket key.
3. In a bucket each node is compared with the bucket's hub; where that leaves several components in
   a bucket of ``SMALL`` nodes at most, also with all nodes of other components, in a larger one with
   those among the ``NEIGHBOURS`` nodes before it.  So pairs grow as the nodes.  The nodes of buckets draw ``MORE_SAMPLES`` further samples: pairs whose total weights
   or these samples rule out the threshold go, the rest is verified by weighted Jaccard similarity
   over the whole texts.
4. Verified links are joined to components.  In buckets too large for step 3 to have tested
   all pairs, nodes of other components are compared with the node that has most links, again
   and again until no new link is found.  This only joins large groups cheaply.
5. The nodes of all such buckets that still hold several components meet by a prefix filter, which
   leaves out no pair at the threshold: shingles are ordered by the number of these nodes they are
   in, and two nodes above the threshold share one before either has passed a fifth of its weight.
   Neighbours in a shingle's list, ordered by the samples, are compared first, in turns, so that a large
   group is joined by pairs that grow as its nodes.  Then all pairs that meet and are of different
   components follow, sifted where they meet and the likeliest (in ``TIERS``) verified first.
6. A class is a component with all copies of its nodes; the smallest doc_id stays.

Defined results: words are lower-cased A-Z runs of ASCII letters, digits and all non-ASCII
characters; a text of fewer than five words, but not none, has one shingle; a text without
words (null and empty too) is a class of its own, as is a row with a null doc_id, which has a
null class; equal word sequences are one class; of repeated rows each has the same class; rows
of one doc_id are judged by their own texts, and the doc_id stays if it stays for one of them;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.llm.components import connected_components
from codeloom.operators.broadcast import known_rows, materialize, sized_broadcast

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 8, 2
#: Share of documents above which a shingle loses weight, and the least inverse frequency.
COMMON, LEAST_IDF = 0.4, 0.25
#: Rows of the sketch and bits of its columns.
SKETCH_ROWS, SKETCH_BITS = 2, 17
SLICES = 256
#: Tasks whose sketches are added up at once.
ADDED = 512
#: Bits of a shingle within a piece of text; the others number the piece's texts.
ID_BITS = 44
#: Further samples by which pairs are sifted, and the least number in common; a pair at 0.8 has fewer once in 200,000 times.
MORE_SAMPLES, LEAST_MORE = 64, 36
#: Samples in common from which on pairs of step 5 are verified, in turn.
TIERS = (52, 45, LEAST_MORE)
#: Nodes of a bucket that are compared with one another.
SMALL, NEIGHBOURS = 6, 4
#: Nodes of a large bucket or list that are ordered in one task, about.
SPLIT = 128
#: Neighbours are compared in further turns while a turn links one in so many nodes of step 5.
FEW = 100
#: Rows of two integers that may be broadcast.
MOST_BROADCAST = 1_000_000
PIECE = 1 << 18
ONE = 16


def text_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text (sorted), their counts, per text the first one's index,
    and a hash of each text's word sequence (0 without words)."""
    hashes, _, firsts = arrays.words(data, offsets)
    sequence = np.where(np.diff(firsts) > 0, arrays.span_hashes(hashes, firsts[:-1], firsts[1:]), np.uint64(0))
    windows, first_window = arrays.shingles(hashes, firsts, WORDS)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint64), np.diff(first_window))
    key = np.sort(text << np.uint64(ID_BITS) | windows >> np.uint64(64 - ID_BITS))
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(begins, len(key)))
    own = key[begins]
    at = np.searchsorted(own, np.arange(len(offsets), dtype=np.uint64) << np.uint64(ID_BITS))
    return own & np.uint64((1 << ID_BITS) - 1), counts, at, sequence


def sketch_columns(ids: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    return [(ids >> np.uint64(ID_BITS - (i + 1) * SKETCH_BITS) & mask).astype(np.int64) for i in range(SKETCH_ROWS)]


def frequency_sketch(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Count-min sketch of the documents each shingle is in, and the number of documents.

    Tasks send the sketch in slices, which are added up slice by slice, first over ``ADDED`` tasks
    and then over these sums, so that no group is large; the result has a fixed size (2 MB).
    """
    width = SKETCH_ROWS << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int64), 0
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            for a, b in arrays.pieces(offsets, PIECE):
                ids, _, at, _ = text_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                n += int((np.diff(at) > 0).sum())
                for row, columns in enumerate(sketch_columns(ids)):
                    total[row] += np.bincount(columns, minlength=1 << SKETCH_BITS)
        if n:
            parts = [p.tobytes() for p in total.reshape(SLICES, width // SLICES)]
            part = TaskContext.get().partitionId() // ADDED
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([part] * SLICES, pa.int32()), pa.array(parts, pa.binary()), pa.array([n if i == 0 else 0 for i in range(SLICES)], pa.int64())], names=["slice", "part", "counts", "n"])

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width // SLICES, np.int64)
        for p in parts["counts"]:
            total += np.frombuffer(p, np.int64)
        return pd.DataFrame({"slice": [parts["slice"].iloc[0]], "part": [parts["part"].iloc[0]], "counts": [total.tobytes()], "n": [parts["n"].sum()]})

    schema = "slice int, part int, counts binary, n long"
    rows = docs.select("text").mapInArrow(arrays.released(count), schema)
    rows = rows.groupBy("slice", "part").applyInPandas(add, schema).groupBy("slice").applyInPandas(add, schema).collect()
    total = np.zeros((SLICES, width // SLICES), np.int64)
    for r in rows:
        total[r["slice"]] = np.frombuffer(r["counts"], np.int64)
    return total.reshape(SKETCH_ROWS, -1), sum(r["n"] for r in rows)


def idf_table(sketch: np.ndarray, n: int) -> np.ndarray:
    """The sketch's cells as inverse document frequencies, less the mean of what collides."""
    share = np.maximum(sketch - sketch.mean(axis=1, keepdims=True), 0) / max(n, 1)
    idf = np.log(1 / np.clip(share, 1e-12, 1)) / np.log(1 / COMMON)
    return np.clip(idf, LEAST_IDF, 1).astype(np.float32)


def weights(ids: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Whole sixteenths, from 1 to 255."""
    own = np.maximum.reduce([idf[row][columns] for row, columns in enumerate(sketch_columns(ids))])
    return np.clip(np.rint(ONE * own * (1 + np.log(counts))), 1, 255).astype(np.int64)


def _uniform(bits: np.ndarray, shift: int) -> np.ndarray:
    u = (bits >> np.uint64(shift) & np.uint64(0x7FFFFF)).astype(np.float32)
    u += np.float32(0.5)
    u *= np.float32(2.0 ** -23)
    return u


def icws(ids: np.ndarray, weight: np.ndarray, starts: np.ndarray, samples: int, first: int = 0) -> np.ndarray:
    """Samples ``first`` to ``first + samples - 1`` of each text (texts x samples, 64-bit); ``starts``:
    each text's first shingle, none empty."""
    log_weight = np.log(weight.astype(np.float32) / np.float32(ONE))
    lengths = np.diff(np.append(starts, len(ids)))
    text = np.repeat(np.arange(len(starts)), lengths)
    out = np.empty((len(starts), samples), np.uint64)
    for i, k in enumerate(range(first, first + samples)):
        bits = (ids + np.uint64(k + 1)) * np.uint64(arrays.BASE + 2 * (k * 0x51ED2701 + 1) & (1 << 64) - 1 | 1)
        bits ^= bits >> np.uint64(32)
        bits *= np.uint64(0xD6E8FEB86659FD93)
        bits ^= bits >> np.uint64(32)
        more = bits * np.uint64(0xBF58476D1CE4E5B9)
        more ^= more >> np.uint64(29)
        r = _uniform(bits, 41)
        r *= _uniform(bits, 18)
        np.log(r, out=r)
        np.negative(r, out=r)                      # Gamma(2, 1)
        c = _uniform(more, 41)
        c *= _uniform(more, 18)
        np.log(c, out=c)
        np.negative(c, out=c)                      # Gamma(2, 1)
        np.log(c, out=c)
        beta = (more & np.uint64(0x3FFFF)).astype(np.float32) * np.float32(2.0 ** -18)
        t = np.floor(log_weight / r + beta)
        c -= r * (t - beta + 1)                    # ln a
        least = np.minimum.reduceat(c, starts)
        hit = np.flatnonzero(c == np.repeat(least, lengths))
        hit = hit[np.concatenate([[True], text[hit[1:]] != text[hit[:-1]]])]
        out[:, i] = arrays.mix(ids[hit] * np.uint64(arrays.INVERSE) + t[hit].astype(np.int64).astype(np.uint64))
    return out


SIGNATURE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("node", T.LongType()), T.StructField("total", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """A row per document; node is null and the arrays are empty without words."""
    held = docs.sparkSession.sparkContext.broadcast(idf)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            for a, b in arrays.pieces(offsets, PIECE):
                ids, counts, at, sequence = text_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                has = np.flatnonzero(np.diff(at) > 0)
                weight = weights(ids, counts, table)
                total = np.concatenate([[0], np.cumsum(weight)])
                drawn = icws(ids, weight, at[has], BANDS * ROWS) if len(has) else np.zeros((0, BANDS * ROWS), np.uint64)
                band = arrays.span_hashes(drawn.reshape(-1), np.arange(0, drawn.size, ROWS), np.arange(ROWS, drawn.size + 1, ROWS)).reshape(-1, BANDS) if len(has) else np.zeros((0, BANDS), np.uint64)
                band = arrays.mix(band + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                full = np.zeros(b - a, bool)
                full[has] = True
                upto = np.concatenate([[0], np.cumsum(full)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(a, b - a),
                    pa.array(sequence.view(np.int64), mask=~full), pa.array(total[at[1:]] - total[at[:-1]]),
                    pa.ListArray.from_arrays(pa.array(upto * BANDS), pa.array(band.reshape(-1)))], names=SIGNATURE.names)

    return docs.mapInArrow(arrays.released(sign), SIGNATURE)


MORE = T.StructType([T.StructField("node", T.LongType()), T.StructField("more", T.BinaryType())])


def more_samples(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """``rows`` (text, node): ``MORE_SAMPLES`` samples (a byte each) of each text whose word sequence is that of its node."""
    held = rows.sparkSession.sparkContext.broadcast(idf)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            node = batch.column("node").to_numpy()
            for a, b in arrays.pieces(offsets, PIECE):
                ids, counts, at, sequence = text_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                has = np.flatnonzero(np.diff(at) > 0)
                if not len(has):
                    continue
                drawn = (icws(ids, weights(ids, counts, table), at[has], MORE_SAMPLES, BANDS * ROWS) >> np.uint64(56)).astype(np.uint8)
                own = np.flatnonzero(sequence.view(np.int64)[has] == node[a:b][has])
                yield pa.RecordBatch.from_arrays([pa.array(node[a:b][has[own]]), pa.array([drawn[i].tobytes() for i in own], pa.binary())], names=MORE.names)

    return rows.select("text", "node").mapInArrow(arrays.released(draw), MORE)


def _in_common(pairs: DataFrame) -> DataFrame:
    """(a, b, equal) of the ``pairs`` (a, b, more_a, more_b) that the samples in common don't rule out."""
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MORE_SAMPLES) for c in ("more_a", "more_b"))
            equal = (u == v).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(equal.astype(np.int32))], names=["a", "b", "equal"]).filter(pa.array(equal >= LEAST_MORE))

    return pairs.select("a", "b", "more_a", "more_b").mapInArrow(arrays.released(sift), "a long, b long, equal int")


def sifted(pairs: DataFrame, drawn: DataFrame, similarity: float) -> DataFrame:
    """(a, b, equal) of the ``pairs`` (a, b) that neither the total weights nor the samples in
    common rule out; ``drawn``: (node, total, more)."""
    x = drawn.select(F.col("node").alias("a"), F.col("total").alias("total_a"), F.col("more").alias("more_a"))
    y = drawn.select(F.col("node").alias("b"), F.col("total").alias("total_b"), F.col("more").alias("more_b"))
    near = F.least("total_a", "total_b") >= similarity * F.greatest("total_a", "total_b")
    return materialize(_in_common(pairs.join(x, "a").join(y, "b").where(near)), "pairs")


SETS = T.StructType([T.StructField("node", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("weights", T.BinaryType())])


def shingle_sets(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """``rows`` (text, node): the sorted shingles (32 bits each) and weights of each text whose
    word sequence is that of its node."""
    held = rows.sparkSession.sparkContext.broadcast(idf)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            node = batch.column("node").to_numpy()
            for a, b in arrays.pieces(offsets, PIECE):
                ids, counts, at, sequence = text_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                weight = weights(ids, counts, table).astype(np.uint8)
                ids = (ids >> np.uint64(ID_BITS - 32)).astype("<u4")
                own = np.flatnonzero(sequence.view(np.int64) == node[a:b])
                yield pa.RecordBatch.from_arrays([
                    pa.array(node[a:b][own]), pa.array([ids[at[i]:at[i + 1]].tobytes() for i in own], pa.binary()),
                    pa.array([weight[at[i]:at[i + 1]].tobytes() for i in own], pa.binary())], names=SETS.names)

    return rows.select("text", "node").mapInArrow(arrays.released(sets), SETS)


def weighted_jaccard(a_ids: bytes, a_weights: bytes, b_ids: bytes, b_weights: bytes) -> float:
    """Sum of minima by sum of maxima."""
    x, y = np.frombuffer(a_ids, "<u4"), np.frombuffer(b_ids, "<u4")
    p, q = np.frombuffer(a_weights, np.uint8).astype(np.int64), np.frombuffer(b_weights, np.uint8).astype(np.int64)
    if not len(x) or not len(y):
        return 0.0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = np.flatnonzero(y[at] == x)
    low = int(np.minimum(p[same], q[at[same]]).sum())
    return low / (int(p.sum()) + int(q.sum()) - low)


def verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The materialized pairs (a, b) of nodes whose weighted Jaccard similarity reaches ``similarity``."""
    if not known_rows(pairs):
        return pairs.select("a", "b")
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "rep"), "node")
    used = sized_broadcast(materialize(used, "nodes_used"), MOST_BROADCAST)   # two integers a row; beyond the bound the texts are shuffled
    sets = materialize(shingle_sets(docs.join(used, docs["doc_id"] == used["rep"]), idf).dropDuplicates(["node"]), "shingle_sets")
    a = sets.select(F.col("node").alias("a"), F.col("ids").alias("ids_a"), F.col("weights").alias("weights_a"))
    b = sets.select(F.col("node").alias("b"), F.col("ids").alias("ids_b"), F.col("weights").alias("weights_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("ids_a", "weights_a", "ids_b", "weights_b")]
            good = np.array([weighted_jaccard(*(c[i].as_py() for c in columns)) >= similarity for i in range(batch.num_rows)], dtype=bool)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    return materialize(both.mapInArrow(arrays.released(compare), "a long, b long"), "verified")


def verified_in_turn(pairs: DataFrame, links: DataFrame, parts: DataFrame, nodes: DataFrame, docs: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The components of ``links`` and those of ``pairs`` (a, b, equal) that reach ``similarity``: pairs
    whose nodes meanwhile are in one component (``parts`` at first) aren't verified."""
    upto = MORE_SAMPLES + 1
    for least in TIERS:
        now = pairs.where((F.col("equal") >= least) & (F.col("equal") < upto)).select("a", "b")
        for side in ("a", "b"):
            own = parts.select(F.col("node").alias(side), F.col("component").alias(f"component_{side}"))
            now = now.join(own, side, "left").withColumn(f"component_{side}", F.coalesce(f"component_{side}", side))
        now = materialize(now.where("component_a != component_b").select("a", "b"), "pairs_in_turn")
        found = verified(now, nodes, docs, idf, similarity)
        if known_rows(now) and known_rows(found):
            links = materialize(links.unionByName(found), "links")
            parts = connected_components(links)
        upto = least
    return parts


ENTRY = T.StructType([T.StructField("id", T.LongType()), T.StructField("node", T.LongType()), T.StructField("weight", T.ShortType()), T.StructField("total", T.LongType())])


def shingle_rows(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """``rows`` (text, node): a row per distinct shingle of each text whose word sequence is that of its node."""
    held = rows.sparkSession.sparkContext.broadcast(idf)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            data, offsets = arrays.utf8(batch.column("text"))
            node = batch.column("node").to_numpy()
            for a, b in arrays.pieces(offsets, PIECE):
                ids, counts, at, sequence = text_shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                weight = weights(ids, counts, table)
                sums = np.concatenate([[0], np.cumsum(weight)])
                text = np.repeat(np.arange(b - a), np.diff(at))
                own = (sequence.view(np.int64) == node[a:b])[text]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[own].view(np.int64)), pa.array(node[a:b][text[own]]), pa.array(weight[own].astype(np.int16)),
                    pa.array((sums[at[1:]] - sums[at[:-1]])[text[own]])], names=ENTRY.names)

    return rows.select("text", "node").mapInArrow(arrays.released(entries), ENTRY)


def prefixes(open_nodes: DataFrame, docs: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """Rows (id, node, total, rest, early, more) of the shingles under which ``open_nodes`` (node, rep, more) meet.

    ``rest`` is a node's weight from a shingle on, rarest first.  From the first common shingle on
    both nodes must hold the common weight, ``similarity / (1 + similarity)`` of both totals: so the
    lighter node has ``least`` of its weight left there (``early``), and the heavier one ``similarity`` of its own.
    """
    least = 2 * similarity / (1 + similarity) - 1e-9
    reps = sized_broadcast(open_nodes.select("node", "rep"), MOST_BROADCAST, bound=known_rows(open_nodes))
    rows = materialize(shingle_rows(docs.join(reps, docs["doc_id"] == reps["rep"]), idf).dropDuplicates(["id", "node"]), "shingles")
    shared = materialize(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared_shingles")
    after = Window.partitionBy("node").orderBy(F.desc("n"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0)
    prefix = rows.join(shared, "id").withColumn("rest", F.sum("weight").over(after)).where(F.col("rest") >= (similarity - 1e-9) * F.col("total"))
    return materialize(prefix.join(open_nodes.select("node", "more"), "node").select("id", "node", "total", "rest", (F.col("rest") >= least * F.col("total")).alias("early"), "more"), "prefixes")


def _lists(prefix: DataFrame, parts: DataFrame) -> DataFrame:
    """``prefix`` without the shingles whose nodes cannot pair, with ``component`` (of ``parts``), the number of
    a shingle's nodes (``size``) and whether a node is ``outside`` of the component that holds most of them."""
    prefix = prefix.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = prefix.groupBy("id", "component").agg(F.count(F.lit(1)).alias("n"), F.max("early").alias("early"))
    lists = held.groupBy("id").agg(F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"), F.max("early").alias("early"), F.sum("n").alias("size"))
    lists = materialize(lists.where("parts > 1 and early").select("id", "size", F.col("main.component").alias("main")), "prefix_lists")
    return materialize(prefix.join(lists, "id").withColumn("outside", F.col("component") != F.col("main")).drop("main"), "prefixes")


def _sifted_once(pairs: DataFrame, similarity: float) -> DataFrame:
    """(a, b, equal) of the pairs (``node_x``, ``total_x``, ``more_x`` and ``_y``), each once, that are left by total weights and samples."""
    near = F.least("total_x", "total_y") >= similarity * F.greatest("total_x", "total_y")
    first = F.col("node_x") < F.col("node_y")
    pairs = pairs.where(near).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"),
                                     F.when(first, F.col("more_x")).otherwise(F.col("more_y")).alias("more_a"), F.when(first, F.col("more_y")).otherwise(F.col("more_x")).alias("more_b"))
    return _in_common(pairs.groupBy("a", "b").agg(F.first("more_a").alias("more_a"), F.first("more_b").alias("more_b")))   # a pair meets under several shingles


def beside_pairs(lists: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Sifted pairs (a, b, equal) of different components that lie side by side in a shingle's list: nodes are
    ordered by their samples, beginning with another one for each shingle and ``turn``, so that alike nodes
    are neighbours.  At most ``NEIGHBOURS`` pairs a row, so they grow as the rows of ``lists``."""
    begin = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(MORE_SAMPLES)).cast("int")
    order = F.concat(F.expr("substring(more, begin + 1)"), F.expr("substring(more, 1, begin)"))
    rows = lists.withColumn("begin", begin).withColumn("order", order).withColumn("part", F.pmod(F.xxhash64("node", "id", F.lit(turn)), F.ceil(F.col("size") / SPLIT)))
    near = Window.partitionBy("id", "part").orderBy("order", "node")
    before = F.array(*[F.lag(F.struct("node", "total", "more", "component"), i).over(near) for i in range(1, NEIGHBOURS + 1)])
    rows = rows.withColumn("before", before)
    rows = rows.select("node", "total", "more", F.explode(F.filter("before", lambda y: y["component"] != F.col("component"))).alias("y"))
    sides = [F.col(c).alias(f"{c}_x") for c in ("node", "total", "more")] + [F.col(f"y.{c}").alias(f"{c}_y") for c in ("node", "total", "more")]
    return _sifted_once(rows.select(*sides), similarity)


def prefix_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b, equal) of different components, sifted where they meet; the filter itself leaves
    out no pair whose weighted Jaccard similarity reaches ``similarity`` (see :func:`prefixes`)."""
    half = similarity / (1 + similarity) - 1e-9

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = (f.select("id", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "total", "rest", "more", "component")]) for f, side in ((x, "x"), (y, "y")))
        return x.join(y, "id").where((F.col("component_x") != F.col("component_y")) & (F.least("rest_x", "rest_y") >= half * (F.col("total_x") + F.col("total_y"))))

    return _sifted_once(met(lists.where("early and outside"), lists).unionByName(met(lists.where("early and not outside"), lists.where("outside"))), similarity)


def prefix_components(open_nodes: DataFrame, tested: DataFrame, links: DataFrame, parts: DataFrame, nodes: DataFrame, docs: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """The components (``parts`` at first) of ``links`` and all links among ``open_nodes`` (node, rep, more).

    Neighbours in the shingles' lists are compared first, in turns that join what is alike while the turns
    find much; all pairs that meet in a list and are of different components then still follow.
    """
    prefix = prefixes(open_nodes, docs, idf, similarity)
    turn = 0
    while True:
        lists = _lists(prefix, parts)
        pairs = materialize(beside_pairs(lists, similarity, turn).join(tested, ["a", "b"], "left_anti"), "pairs_beside")
        found = verified(pairs, nodes, docs, idf, similarity)
        if not known_rows(pairs) or not known_rows(found):
            break
        tested = materialize(tested.unionByName(pairs.select("a", "b")), "tested")
        links = materialize(links.unionByName(found), "links")
        parts = connected_components(links)
        if known_rows(found) * FEW < known_rows(open_nodes):
            lists = _lists(prefix, parts)
            break
        turn += 1
    rest = materialize(prefix_pairs(lists, similarity).join(tested, ["a", "b"], "left_anti"), "rest_pairs")
    return verified_in_turn(rest, links, parts, nodes, docs, idf, similarity) if known_rows(rest) else parts


def _several(state: DataFrame) -> DataFrame:
    """The buckets of ``state`` (key, component) that hold several components."""
    return state.groupBy("key").agg(F.min("component").alias("first"), F.max("component").alias("last")).where("first != last").select("key")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of the class), class_size, kept."""
    arrays.bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    idf = idf_table(*frequency_sketch(docs))
    signed = materialize(signatures(docs, idf), "signatures")
    nodes = signed.where("node is not null and doc_id is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("total").alias("total"),
        F.first("bands").alias("bands"))
    nodes = materialize(nodes, "nodes")
    in_bucket = materialize(nodes.select("node", F.explode("bands").alias("key")), "buckets")
    sizes = materialize(in_bucket.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub")).where("size > 1"), "bucket_sizes")
    members = in_bucket.join(sizes, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SPLIT)))
    members = materialize(members, "members")
    ends = [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")]
    tested = materialize(members.withColumn("other", F.col("hub")).where("other != node").select(*ends).distinct(), "tested")
    reps = members.select("node").distinct().join(nodes.select("node", "rep", "total"), "node")
    reps = sized_broadcast(materialize(reps, "nodes_in_buckets"), MOST_BROADCAST)
    drawn = more_samples(docs.join(reps, docs["doc_id"] == reps["rep"]), idf).dropDuplicates(["node"]).join(reps.select("node", "total"), "node")
    drawn = materialize(drawn, "more_samples")
    links = verified(sifted(tested, drawn, similarity), nodes, docs, idf, similarity)
    state = materialize(members.drop("hub").join(connected_components(links), "node", "left").withColumn("component", F.coalesce("component", "node")), "bucket_state")
    state = state.join(materialize(_several(state), "open_buckets"), "key", "left_semi")
    small = state.where(F.col("size") <= SMALL).groupBy("key").agg(F.collect_list(F.struct("node", "component")).alias("all"))
    more = small.select("all", F.explode("all").alias("x")).select("x.node", "x.component", F.explode("all").alias("y")).where("node < y.node AND component != y.component")
    near = Window.partitionBy("key", "part").orderBy("node")
    before = F.array(*[F.lag(F.struct("node", "component"), i).over(near) for i in range(1, NEIGHBOURS + 1)])
    beside = state.where(F.col("size") > SMALL).select("node", "component", before.alias("before"))
    beside = beside.select("node", "component", F.explode("before").alias("y")).where("component != y.component")
    more = more.unionByName(beside).withColumn("other", F.col("y.node")).select(*ends).distinct()
    more = materialize(more.join(tested, ["a", "b"], "left_anti"), "more_pairs")
    if known_rows(more):
        links = materialize(links.unionByName(verified(sifted(more, drawn, similarity), nodes, docs, idf, similarity)), "links")
        tested = materialize(tested.unionByName(more), "tested")
    large = members.where(F.col("size") > SMALL).select("key", "node")
    while True:
        parts = connected_components(links)
        degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
        state = materialize(large.join(degree, "node", "left").join(parts, "node", "left")
                            .select("key", "node", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("component", "node").alias("component")), "bucket_state")
        hubs = materialize(state.groupBy("key").agg(F.max(F.struct("degree", "node", "component")).alias("hub")), "hubs")
        more = state.join(hubs, "key").where("component != hub.component").select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()
        more = materialize(more.join(tested, ["a", "b"], "left_anti"), "more_pairs")
        if not known_rows(more):
            break
        pairs = sifted(more, drawn, similarity)
        found = verified(pairs, nodes, docs, idf, similarity)
        if not known_rows(pairs) or not known_rows(found):
            break
        tested = materialize(tested.unionByName(more), "tested")
        links = materialize(links.unionByName(found), "links")
    open_nodes = state.join(materialize(_several(state), "open_buckets"), "key", "left_semi").select("node").distinct()
    open_nodes = materialize(open_nodes.join(drawn.select("node", "more"), "node").join(nodes.select("node", "rep"), "node"), "open_nodes")
    if known_rows(open_nodes):
        parts = prefix_components(open_nodes, tested, links, parts, nodes, docs, idf, similarity)
    whole = nodes.select("node", "rep", "n").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = whole.groupBy("component").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size")).where("class_size > 1")
    named = materialize(whole.select("node", "component").join(groups, "component").select("node", "class_id", "class_size"), "classes")
    alone = F.col("class_id").isNull()
    known = F.col("doc_id").isNotNull()
    return signed.select("doc_id", "node").join(named, "node", "left").select(
        "doc_id", F.when(known & alone, F.col("doc_id")).when(known, F.col("class_id")).alias("class_id"),
        F.when(known & ~alone, F.col("class_size")).otherwise(F.lit(1)).alias("class_size"),
        (~known | alone | (F.col("doc_id") == F.col("class_id"))).alias("kept"))


def deduplicated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of documents that stay, one of each class, with all their columns."""
    judged = materialize(classes(docs, text, doc_id, similarity), "judged").where("doc_id is not null")
    dropped = judged.groupBy(F.col("doc_id").alias("__dropped")).agg(F.max("kept").alias("__kept")).where("not __kept").select("__dropped")
    dropped = materialize(dropped, "dropped")
    return docs.join(dropped, docs[doc_id].cast("long") == dropped["__dropped"], "left_anti")
