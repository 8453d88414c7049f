import hashlib
import random
import re

from codeloom.llm import exact_dedup as ed

LAST = 1 << 62


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        out.append((i, min(ids, key=lambda x: LAST if x is None else x), len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return out


def compare(docs, rows):
    got = ed.duplicates(docs).collect()
    assert sorted(map(repr, ((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got))) == sorted(map(repr, brute(rows)))
    groups = {}
    for r in got:
        groups.setdefault(r["text_sha256"], []).append(r)
    for g in groups.values():   # one row of each group stays, and it has the smallest doc_id
        assert [r["doc_id"] for r in g if r["kept"]] == [g[0]["keep_id"]]


def test_edges(make_docs, odd_rows):
    compare(make_docs(odd_rows), odd_rows)
    compare(make_docs([]), [])


def test_groups_over_several_partitions(spark, make_docs):
    rng = random.Random(1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, rng.choice(["hot text", "hot text", "hot  text", "b" * 30 + rng.choice("xy"), f"own {i % 150}"])) for i in range(1500)]
        rng.shuffle(rows)
        compare(make_docs(rows, 5), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rows_that_stay_keep_their_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    got = ed.deduplicated(docs)
    assert got.schema.names == docs.schema.names
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in odd_rows]
    rows = got.collect()
    assert len(rows) == len(set(texts))
    assert {(r["doc_id"], r["kept"]) for r in rows} >= {(1, "kept"), (4, "kept"), (7, "kept"), (11, "kept")}
