import hashlib
import random
import re

from codeloom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(text, items, n=13):
    w, hit, ids = words(text), set(), set()
    for i, t in items:
        x = words(t)
        size = min(n, len(x))
        windows = {tuple(x[k:k + size]) for k in range(len(x) - size + 1)} if x and i is not None else set()
        for k in range(len(w) - size + 1):
            if size and tuple(w[k:k + size]) in windows:
                hit |= set(range(k, k + size))
                ids.add(str(i))
    return (len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))


def compare(spark, make_docs, rows, items):
    docs, bench = make_docs(rows), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(repr, (tuple(r)[:6] for r in dc.contamination(docs, bench).collect())))
    assert got == sorted(map(repr, ((i, *brute(t, items)) for i, t in rows)))


def test_random_texts_against_brute_force(spark, make_docs):
    rng = random.Random(3)
    text = lambda n, v: " ".join(rng.choice("abcdefghÉ"[:v]) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 5, 8, 12, 13, 14, 20, 40]), rng.choice([2, 9]))) for i in range(25)] + [(25, None), (None, "a b"), (3, "zz yy"), (2**40, "q " * 13)]
    rows = [(i, text(rng.randint(0, 80), rng.choice([2, 9]))) for i in range(60)]
    for i in range(40):   # passages at every offset of the blocks
        x = words(rng.choice(items)[1])
        at = rng.randint(0, 30)
        rows.append((100 + i, text(at, 9) + " " + " ".join(x).upper() + " " + text(rng.randint(0, 30), 9)))
    compare(spark, make_docs, rows, items)


def test_edges(spark, make_docs, odd_rows):
    long = odd_rows[7][1]
    compare(spark, make_docs, odd_rows, [(1, "one"), (2, " ".join(long.split()[500:540])), (3, None), (4, "!!!"), (5, "été ünïcode ÑANDÚ 日本語")])
    compare(spark, make_docs, odd_rows, [])
    compare(spark, make_docs, [], [(1, "one")])


def test_contaminated_documents_go(spark, make_docs):
    item = " ".join(f"w{i}" for i in range(20))
    docs = make_docs([(1, item), (2, "clean text"), (None, item), (3, None)])
    got = dc.decontaminated(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 2, 3]


def test_shuffle_join_beyond_the_broadcast_bound(spark, make_docs, monkeypatch):
    monkeypatch.setattr(dc, "MAX_ROWS", 0)
    item = " ".join(f"w{i}" for i in range(30))
    compare(spark, make_docs, [(1, "x y z " + item), (2, item[:40]), (3, None)], [(1, item), (2, "w3")])


def test_shuffle_join_of_long_and_many_texts(spark, make_docs, monkeypatch):
    """Beyond the bounds and without any broadcast: hot blocks, 40,000-word texts, repeated and null rows."""
    monkeypatch.setattr(dc, "MAX_ROWS", 0)
    monkeypatch.setattr(dc, "MAX_BYTES", 0)
    rng = random.Random(11)
    text = lambda n, v: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    hot = text(40, 500)
    items = [(0, hot), (1, text(200, 3000)), (2, "w3"), (3, None), (None, hot), (4, "w1 w2"), (5, hot)]
    long = text(20_000, 3000) + " " + items[1][1] + " " + text(20_000, 3000)
    rows = [(1, long), (2, long), (2, long), (3, None), (None, hot), (4, ""), *[(10 + i, f"x{i} " + hot + f" y{i}") for i in range(60)]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.codeloom.broadcast.maxRows", "0")
    try:
        compare(spark, make_docs, rows, items)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.codeloom.broadcast.maxRows")


def test_only_hashes_meet_the_seeds(spark, make_docs, monkeypatch):
    monkeypatch.setattr(dc, "MAX_ROWS", 0)
    written = {}
    real = dc.materialize
    monkeypatch.setattr(dc, "materialize", lambda df, name: written.setdefault(name, real(df, name)))
    docs = make_docs([(i, " ".join(f"a{i}b{j}" for j in range(200))) for i in range(30)] + [(99, "w " * 13)])
    dc.contamination(docs, spark.createDataFrame([(1, "w " * 13)], "item_id long, text string")).collect()
    assert written["found_blocks"].columns == ["__row", "length", "at"] and written["found_blocks"].count() == 1
