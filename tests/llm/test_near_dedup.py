import os
import random

import numpy as np
import pyarrow as pa

from codeloom.llm import arrays, near_dedup as nd
from codeloom.llm.components import connected_components


def text(rng, n, prefix="w"):
    return " ".join(f"{prefix}{rng.randrange(5000)}" for _ in range(n))


def changed(rng, t, n):
    w = t.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def jaccard(a, b, idf):
    sets = []
    for t in (a, b):
        ids, counts, _, _ = nd.text_shingles(*arrays.utf8(pa.array([t])))
        sets.append(dict(zip(ids.tolist(), nd.weights(ids, counts, idf).tolist())))
    x, y = sets
    return sum(min(x.get(k, 0), y.get(k, 0)) for k in {*x, *y}) / max(1, sum(max(x.get(k, 0), y.get(k, 0)) for k in {*x, *y}))


def brute_classes(rows, idf):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if arrays.words(*arrays.utf8(pa.array([rows[i][1]])))[0].size and jaccard(rows[i][1], rows[j][1], idf) >= nd.SIMILARITY:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return {i: (min(g), len(g)) for g in groups.values() for i in g}


def test_classes_against_all_pairs(spark, make_docs):
    rng = random.Random(5)
    rows = []
    for g in range(12):
        base = text(rng, rng.choice([6, 40, 200]))
        rows += [(len(rows), base), (len(rows) + 1, changed(rng, base, 1)), (len(rows) + 2, changed(rng, base, 8)), (len(rows) + 3, base.upper() + "!")]
    shared = text(rng, 60, "s")
    rows += [(100 + i, text(rng, 300) + " " + shared) for i in range(15)]   # share a passage only
    hub = text(rng, 300)
    rows += [(200 + i, changed(rng, hub, 3)) for i in range(40)]            # a large group
    docs = make_docs(rows)
    idf = nd.idf_table(*nd.frequency_sketch(docs.select("doc_id", "text")))
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in nd.classes(docs).collect()}
    assert got == brute_classes(rows, idf)
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for c, _ in got.values()}


def test_small_groups_inside_a_template_family(spark, make_docs):
    rng = random.Random(8)
    template, rows = text(rng, 370, "t"), []
    for i in range(600):
        own = text(rng, 12, f"p{i}x")
        rows.append((len(rows), template + " " + own))
        if i % 4 == 0:
            rows.append((len(rows), changed(rng, template, 1) + " " + own))
    docs = make_docs(rows)
    idf = nd.idf_table(*nd.frequency_sketch(docs.select("doc_id", "text")))
    sets = []
    for _, t in rows:
        ids, counts, _, _ = nd.text_shingles(*arrays.utf8(pa.array([t])))
        sets.append(((ids >> np.uint64(nd.ID_BITS - 32)).astype("<u4").tobytes(), nd.weights(ids, counts, idf).astype(np.uint8).tobytes()))
    owner = list(range(len(rows)))

    def find(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if nd.weighted_jaccard(*sets[i], *sets[j]) >= nd.SIMILARITY:
                a, b = sorted((find(i), find(j)))
                owner[b] = a
    want = {i: find(i) for i in range(len(rows))}
    assert 600 <= len(set(want.values())) < len(rows)   # the family itself is no class
    assert {r["doc_id"]: r["class_id"] for r in nd.classes(docs).collect()} == want


def test_pairs_of_a_drifting_family_are_few(spark, make_docs, monkeypatch):
    """Neighbours join the components of a large group before all of a list's other components are paired."""
    rng = random.Random(3)
    family = [text(rng, 120)]
    for _ in range(599):
        family.append(changed(rng, rng.choice(family[-40:]), rng.choice([1, 2, 2, 3])))
    rows = list(enumerate(family)) + [(1000 + i, text(rng, 100)) for i in range(900)]
    made, plain = {}, nd.materialize

    def counted(df, name="table", metrics=None):
        out = plain(df, name, metrics)
        made[name] = made.get(name, 0) + nd.known_rows(out)
        return out

    monkeypatch.setattr(nd, "materialize", counted)
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(make_docs(rows)).collect()}
    assert len(set(got.values())) == 1041 and all(got[i] == i for i in got if i >= 1000)
    assert made["open_nodes"] > 500 and made["rest_pairs"] <= 20


def test_edges(make_docs, odd_rows):
    got = sorted((tuple(r) for r in nd.classes(make_docs(odd_rows)).collect()), key=repr)
    one = (4, 4, True), (5, 4, False), (6, 4, False)
    assert [r for r in got if r[0] == 4] == [(4, 4, 4, True)]
    assert [r for r in got if r[0] == 5] == [(5, 4, 4, False)] * 2 and one
    assert [r for r in got if r[0] == 8] == [(8, 7, 2, False)]
    assert [r for r in got if r[0] in (1, 2, 3, 9)] == [(i, i, 1, True) for i in (1, 2, 3, 9)]
    assert [r for r in got if r[0] is None] == [(None, None, 1, True)] * 2
    assert [r[1] for r in got if r[0] in (11, 12, 13)] == [11, 11, 11]
    assert nd.classes(make_docs([])).count() == 0


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    ids = np.sort(rng.choice(1 << nd.ID_BITS, 900, replace=False)).astype(np.uint64)
    w = rng.integers(4, 60, 900)
    a, b = slice(0, 700), slice(200, 900)
    wa, wb = w[a], np.where(rng.random(700) < 0.3, w[b] * 2, w[b])
    low = np.minimum(wa[200:], wb[:500]).sum()
    true = low / (wa.sum() + wb.sum() - low)
    drawn = nd.icws(np.concatenate([ids[a], ids[b]]), np.concatenate([wa, wb]), np.array([0, 700]), 600)
    assert abs((drawn[0] == drawn[1]).mean() - true) < 0.06


def test_components_against_union_find(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 200)] + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(200)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def links_by_all_pairs(texts, idf):
    """Every pair (i, j) of texts whose weighted Jaccard similarity reaches the threshold.

    All pairs are looked at: with weights summed into 256 places, the sum of the places' minima is never
    less than that of the shingles, so a pair that fails there fails; the rest is compared in full.
    """
    ids, counts, at, _ = nd.text_shingles(*arrays.utf8(pa.array(texts, pa.string())))
    w = nd.weights(ids, counts, idf)
    text = np.repeat(np.arange(len(texts)), np.diff(at))
    places = np.zeros((len(texts), 256), np.int32)
    np.add.at(places, (text, (ids % np.uint64(251)).astype(np.int64)), w)
    total = places.sum(axis=1)
    short, small = (ids >> np.uint64(nd.ID_BITS - 32)).astype("<u4"), w.astype(np.uint8)
    sets = [(short[a:b].tobytes(), small[a:b].tobytes()) for a, b in zip(at, at[1:])]
    order = np.argsort(total, kind="stable")
    order = order[total[order] > 0]
    upto = np.searchsorted(total[order], total[order] / nd.SIMILARITY + 1e-9, side="right")
    found, compared = [], 0
    for n, i in enumerate(order.tolist()):
        near = order[n + 1:upto[n]]
        low = np.minimum(places[i], places[near]).sum(axis=1)
        for j in near[low >= nd.SIMILARITY * (total[i] + total[near] - low) - 1e-6].tolist():
            compared += 1
            if nd.weighted_jaccard(*sets[i], *sets[j]) >= nd.SIMILARITY:
                found.append((i, j))
    return found, compared


def test_recall_on_the_given_tables(spark):
    """Of all links in the given documents (NEAR_RECALL_DIR to change them), the share whose ends are in one class; and no class is too large."""
    d = os.environ.get("NEAR_RECALL_DIR", "/root/testdata/sf0.01")
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    idf = nd.idf_table(*nd.frequency_sketch(docs))
    rows = docs.orderBy("doc_id").collect()
    got = {r["doc_id"]: r["class_id"] for r in nd.classes(docs).collect()}
    first, texts = {}, []
    for r in rows:
        key = tuple(arrays.words(*arrays.utf8(pa.array([r["text"]], pa.string())))[0].tolist())
        if key not in first:
            first[key] = len(texts)
            texts.append(r)
        assert not key or got[r["doc_id"]] == got[texts[first[key]]["doc_id"]]
    links, _ = links_by_all_pairs([r["text"] for r in texts], idf)
    owner = list(range(len(texts)))

    def find(i):
        while owner[i] != i:
            owner[i] = owner[owner[i]]
            i = owner[i]
        return i

    held = 0
    for i, j in links:
        held += got[texts[i]["doc_id"]] == got[texts[j]["doc_id"]]
        a, b = sorted((find(i), find(j)))
        owner[b] = a
    print(f"{len(links)} links between {len(texts)} different texts, {held} within classes")
    assert held >= 0.99 * len(links) and len(links) > 3
    members = {}
    for i, r in enumerate(texts):
        members.setdefault(got[r["doc_id"]], set()).add(find(i))
    assert all(len(m) == 1 for m in members.values())        # no class holds more than links join
