"""Nested lookups, range blocks, bitmaps, SQL functions, bucketed tables: each against its plain form."""

import random
import re
import warnings

import pytest
from pyspark.sql import functions as F

from codeloom.functions import sql_functions
from codeloom.functions.ranges import expand_ranges, range_blocks
from codeloom.operators import allocate as al
from codeloom.operators import bitmaps as bm
from codeloom.operators import codes as cd
from codeloom.operators import dictionary as dc
from codeloom.operators import match as mt
from codeloom.operators import reports as rp
from codeloom.operators.broadcast import _bytes_of, materialize, observed, skew_safe_join
from codeloom.operators.nested import fanned_out, nested
from codeloom.plans.pipelines import PersonPipeline, TariffPipeline
from codeloom.sources import sinks
from codeloom.sources.tables import spread

from test_match import DICT_SCHEMA, TRADE_SCHEMA, _codes, _random_world


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- nested lookups
def test_a_large_group_is_dealt_into_bounded_arrays(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    lookup = nested(rows, ["k"], chunk=100)
    sizes = [r["n"] for r in lookup.where("k = 'hot'").select(F.size("entries").alias("n")).collect()]
    assert sum(sizes) == 4000 and max(sizes) < 200 and len(sizes) > 30
    assert _rows(fanned_out(lookup)) == _rows(rows)
    assert nested(rows, ["k"], bounded=True).count() == 1001


@pytest.mark.parametrize("seed", [31, 32, 33, 34])
def test_graded_lists_equal_grouped_rows(spark, seed):
    d, codes = _random_world(spark, seed)
    rnd = random.Random(seed)
    some = [r.code for r in codes.collect()]
    own = [(rnd.choice(some + ["nowhere"]), f"T{rnd.randrange(8)}", rnd.random() < 0.5, mt.MANUAL) for _ in range(30)]
    overrides = spark.createDataFrame(own, mt.MATCH_SCHEMA)
    drop = tuple(some[:3])
    want = al.best_graded(cd.drop_codes_filter(mt.person_matches(codes, d, overrides), drop))
    lists = al.graded_lists(codes, mt.nested_keys(d), overrides, drop)
    assert _rows(al.graded_rows(lists)) == _rows(want)
    assert lists.count() == want.select("code").distinct().count()
    assert _rows(al.graded_rows(al.as_lists(want))) == _rows(want)
    assert _rows(al.graded_rows(al.graded_lists(codes, mt.nested_keys(d), None, ()))) == _rows(al.best_graded(mt.person_matches(codes, d, None)))
    review = rp.review_from_lists(lists, 1)
    assert [tuple(r) for r in review.collect()] == [tuple(r) for r in rp.high_fanout_review(want, 1).collect()]
    assert _rows(rp.targets_from_lists(lists)) == _rows(rp.target_lists(want))
    for field in ("match_type", "match_quality"):
        assert _rows(rp.count_by_entry(lists, field)) == _rows(rp.distinct_count_by(want, "code", field))
    assert _rows(al.graded_rows(al.sample_lists(lists))) == _rows(al.quality_sample(want))
    assert _rows(al.graded_rows(al.sample_lists(lists, None, True))) == _rows(al.quality_sample(want, None, True))


@pytest.mark.parametrize("seed,rows,size", [(41, None, None), (42, 1, None), (43, None, 1), (44, 40, None)])
def test_allocation_by_key_equals_allocation_by_code(spark, seed, rows, size):
    """With entries broadcast by key, with nothing broadcast, with entries too large for it, with some keys in bounds."""
    d, codes = _random_world(spark, seed)
    rnd = random.Random(seed)
    some = [r.code for r in codes.collect()]
    own = [(rnd.choice(some + ["nowhere"]), f"T{rnd.randrange(8)}", rnd.random() < 0.5, mt.MANUAL) for _ in range(20)]
    overrides, drop = spark.createDataFrame(own, mt.MATCH_SCHEMA), tuple(some[:3])
    raw = [*some, *(f" {c}\u00a0" for c in some[:20]), "0", "QQQQ", "", None, *some[:5] * 9]
    facts = spark.createDataFrame([(i, c, float(i % 7)) for i, c in enumerate(raw)], "id long, code string, wt double")
    stats = materialize(al.code_stats(facts), "code_stats")
    cmap = cd.code_map(stats, "code_raw", already_distinct=True)
    keys = materialize(mt.nested_keys(d), "keys", al.key_sizes())
    conf = {"spark.codeloom.broadcast.maxRows": rows, "spark.codeloom.broadcast.maxBytes": size}
    want = al.allocate(facts, cmap, al.graded_lists(cd.codes_from_map(cmap), mt.nested_keys(d), overrides, drop), drop_codes=drop)
    want = _rows(want)
    try:
        for k, v in conf.items():
            if v is not None:
                spark.conf.set(k, str(v))
        named = cd.codes_from_map(cmap).join(overrides.select("code"), "code", "left_semi")
        got = al.allocate_by_key(facts, cmap, keys, al.graded_rows(al.graded_lists(named, keys, overrides, drop)), drop_codes=drop, stats=stats, record_key=("id",))
        assert _rows(got) == want
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_key_sizes_are_those_of_the_rows(spark):
    d, _ = _random_world(spark, 45)
    keys = materialize(mt.nested_keys(d), "keys", al.key_sizes())
    got, full = observed(keys), keys.where("L = 6").count()
    assert (got["exact_rows"], got["prefix_rows"]) == (full, keys.count() - full - 1)
    entries = keys.where("L between 1 and 5").agg(F.sum(F.size("entries"))).first()[0]
    assert got["prefix_bytes"] >= entries * 40 + got["prefix_rows"] * 112


def test_entries_of_a_prefix_are_not_written_for_each_code(spark, tmp_path, monkeypatch):
    """Many codes share a prefix with many targets: its entries are kept once, not with each code."""
    from codeloom.operators import broadcast as bc
    d, written, write = str(tmp_path), [], bc.materialize
    spark.createDataFrame([(1_230_000 + 10 * i, f"Brand#{i % 25}") for i in range(60)], "p_partkey long, p_brand string").write.parquet(f"{d}/part.parquet")
    # a tail that no dictionary code has: each code differs and has only the prefix in common
    lines = [(1, 1_230_000 + i, 4, 1.0) for i in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(f"{d}/lineitem.parquet")
    monkeypatch.setattr(bc, "materialize", lambda df, *a: written.append(write(df, *a)) or written[-1])
    p = PersonPipeline(spark, d)
    rows = p.merged().count()
    lookup = written[-1]
    arrays = [f.name for f in lookup.schema.fields if f.dataType.typeName() == "array"]
    assert lookup.count() == 400 and rows >= 4000
    assert lookup.agg(F.sum(F.coalesce(F.size(arrays[0]), F.lit(0)))).first()[0] < 400


def test_lists_of_an_empty_dictionary(spark):
    d, codes = spark.createDataFrame([], DICT_SCHEMA), _codes(spark, ["1111", "92MP"])
    lists = al.graded_lists(codes, mt.nested_keys(d), mt.override_table(spark))
    assert [(r.code, r.n_targets) for r in lists.collect()] == [("92MP", 1)]


def test_concordance_needs_no_shuffle_by_code_and_target(spark, sf_dir):
    """Above the record stats only the codes' own aggregates shuffle; the report adds its sort and nothing by code."""
    p = PersonPipeline(spark, sf_dir)
    lists, review = _plan(p.lists), _plan(rp.review_from_lists(p.lists, 2))
    keys = lambda plan: [re.sub(r"#\d+L?", "", k) for k in re.findall(r"hashpartitioning\(([^)]*)", plan)]
    assert not any("target" in k for k in keys(lists))
    assert sorted(keys(review)) == sorted(keys(lists)) and "rangepartitioning" in review


def test_merge_fans_out_above_the_join(spark, sf_dir):
    plan = _plan(PersonPipeline(spark, sf_dir).merged())
    join, fan = plan.index("BroadcastHashJoin"), plan.index("Generate inline")
    assert fan < join and "hashpartitioning" not in plan     # printed from the top


def test_small_scans_are_spread_and_large_ones_are_not(spark):
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == cores
    many = spark.range(0, 100, 1, cores + 1)
    assert spread(many) is many


# ---------------------------------------------------------------- tiers in two steps
@pytest.mark.parametrize("seed", [41, 42])
def test_tiers_without_ties_keep_one_key_per_target(spark, seed):
    rnd = random.Random(seed)
    d = spark.createDataFrame([(f"T{rnd.randrange(3)}", f"{rnd.randrange(2000):06d}"[:rnd.choice([6, 6, 5])], rnd.random() < 0.5) for _ in range(300)], DICT_SCHEMA).distinct()
    t = spark.createDataFrame([(str(i % 60), *rnd.choice([(f"{rnd.randrange(2000):06d}", False), (f"{rnd.randrange(200):05d}X", True), (f"{rnd.randrange(20):04d}XX", True)])) for i in range(200)], TRADE_SCHEMA)
    for tiers in (lambda **k: mt.tariff_exact(d, t, **k), lambda **k: mt.match_wildcards(t, d, ["0001"], ["0012"], **k), lambda **k: mt.fallback_5d(d, t, **k)):
        every, least = tiers(), tiers(ties=False)
        best = {}
        for r in every.collect():
            k = (r.target, r.hts10)
            best[k] = min(best.get(k, ("~",)), (r.key6, r.multi_io))
        got = {}
        for r in least.collect():
            k = (r.target, r.hts10)
            got[k] = min(got.get(k, ("~",)), (r.key6, r.multi_io))
        assert got == best
        assert least.count() <= every.count()
    keys = ["target", "hts10"]
    one, two = (mt.best_match(mt.tariff_tiers(d, t, ties=x), keys, mt.TARIFF_RANKS, ["key6", "multi_io"]) for x in (True, False))
    assert _rows(one) == _rows(two) == _rows(mt.two_sided_concordance(d, t))


def test_a_family_costs_rows_times_targets(spark):
    """400 trade rows of one wildcard and 500 dictionary keys of two targets: 800 rows, and 200,000 only when ties are asked for."""
    d = spark.range(500).select(F.concat(F.lit("T"), (F.col("id") % 2).cast("string")).alias("target"), F.concat(F.lit("31123"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("key6"), F.lit(False).alias("multi_io"))
    t = spark.range(400).select(F.col("id").cast("string").alias("hts10"), F.lit("31123X").alias("naics"), F.lit(True).alias("naics_ambiguous"))
    assert mt.match_wildcards(t, d, ties=False).count() == 800
    assert mt.match_wildcards(t, d).count() == 200_000


def test_fanout_from_matches_with_one_shuffle(spark, sf_dir):
    t = TariffPipeline(spark, sf_dir)
    assert _rows(t.fanout) == _rows(al.fanout(t.concordance, "hts10"))
    above = _plan(t.fanout).split("BroadcastHashJoin")[0]
    assert above.count("Exchange hashpartitioning(hts10") == 1 and above.count("Exchange") == 1


# ---------------------------------------------------------------- ranges as blocks
def _brute_blocks(lo, hi):
    """Blocks by walking: from each number the widest block that begins there and fits."""
    out, x = [], lo
    while x <= hi:
        i = 0
        while x > 0 and x % 10 ** (i + 1) == 0 and x + 10 ** (i + 1) - 1 <= hi and len(str(x)) > i + 1:
            i += 1
        out.append((str(x // 10 ** i), len(str(x)) if i else None))
        x += 10 ** i
    return out


def test_blocks_against_walking(spark):
    rnd = random.Random(5)
    cases = {(0, 0), (0, 9), (0, 10), (1, 1), (9, 10), (99, 100), (1, 2147483647), (100, 999), (123456789, 1123456788), (1000000000, 1999999999), (0, 2147483647)}
    for _ in range(150):
        a, b = sorted(rnd.randrange(10 ** rnd.randint(1, 9)) for _ in range(2))
        cases.add((a, b))
    tokens = [f"{'0' * max(0, len(str(b)) - len(str(a)))}{a}-{b}" for a, b in sorted(cases)]
    got = {}
    for r in range_blocks(spark.createDataFrame([(t,) for t in tokens], "token string"), "token").collect():
        got.setdefault(r.token, []).append((r.block, r.digits))
    for (a, b), token in zip(sorted(cases), tokens):
        assert sorted(got[token], key=str) == sorted(_brute_blocks(a, b), key=str), token
    assert max(map(len, got.values())) < 200


def test_blocks_hold_exactly_the_expanded_codes(spark):
    odd = ["", None, "12", "12-", "-12", "5-3", "12-345", "1a-3", "99999999999-9", "11113-6", "007-9", "10-20", "95-105", "2147483640-7", "2147483640-9"]
    df = spark.createDataFrame([(t,) for t in odd], "token string")
    want = {}
    for r in expand_ranges(df, "token", "code").collect():
        want.setdefault(r.token, []).append(r.code)
    got = {}
    for r in range_blocks(df, "token").collect():
        if r.digits is None:
            got.setdefault(r.token, []).append(r.block)
        else:
            free = r.digits - len(r.block)
            got.setdefault(r.token, []).extend(f"{r.block}{i:0{free}d}" for i in range(10 ** free))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}


def _awkward_codes(rnd, n):
    out = set()
    for _ in range(n):
        c = str(rnd.randrange(10 ** rnd.randint(1, 8))) + rnd.choice(["", "", "0", "00", "000"])
        out.add(rnd.choice(["", "0", ""]) + c + rnd.choice(["", "", "", "Z", "MP", "M1", "S", "x"]))
    return sorted(out | {"10", "100000", "1000000", "9", "90", "99", "000001", "12x45", "1~", "2147483647"})


@pytest.mark.parametrize("seed", [51, 52, 53])
def test_compact_concordance_equals_the_expanded_one(spark, seed):
    rnd = random.Random(seed)
    cells = []
    for i in range(40):
        a = rnd.randrange(10 ** rnd.randint(1, 7))
        width = min(len(str(a)), rnd.randint(1, 5))
        token = f"{a}-{rnd.randrange(10 ** width):0{width}d}" if rnd.random() < 0.7 else rnd.choice([str(a), f"{a}A00", "11113-6"])
        cells.append((f"T{rnd.randrange(7)}", token + rnd.choice(["", "*", ", 12", ","])))
    raw = spark.createDataFrame(cells, "target string, raw string")
    codes = _codes(spark, _awkward_codes(rnd, 300))
    wide, compact = dc.normalize_dictionary(raw), dc.compact_dictionary(raw)
    assert compact.count() < wide.count()
    want = al.graded_lists(codes, mt.nested_keys(wide), mt.override_table(spark))
    got = al.graded_lists(codes, mt.nested_keys(compact), mt.override_table(spark), blocks=True)
    assert _rows(al.graded_rows(got)) == _rows(al.graded_rows(want)) and want.count() > 50


def test_a_range_of_a_billion_codes_is_matched(spark):
    raw = spark.createDataFrame([("A", "1000000000-999999999"), ("B", "123456789-987654321"), ("C", "11-99")], "target string, raw string")
    d = dc.compact_dictionary(raw)
    assert d.count() < 200
    codes = _codes(spark, ["1234567890", "1999999999", "2000000000", "123456788", "987654321", "55", "55S", "100000", "19999MP"])
    lists = al.graded_lists(codes, mt.nested_keys(d), None, (), blocks=True)
    got = {r.code: [(m.target, m.match_type) for m in r.matches] for r in lists.collect()}
    assert got["1234567890"] == got["1999999999"] == [("A", "exact_6d")] and got["987654321"] == [("B", "exact_6d")]
    assert got["55"] == [("C", "exact_6d")] and got["55S"] == [("B", "prefix_2d"), ("C", "prefix_2d")]
    assert got["123456788"] == [("A", "prefix_5d"), ("B", "prefix_5d")]
    assert got["19999MP"] == [("A", "prefix_5d"), ("B", "prefix_5d")] and "100000" in got


# ---------------------------------------------------------------- bitmaps
def test_bitmaps_count_distinct_values_over_rounds(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice("abc"), f"v{rnd.randrange(900)}" if rnd.random() < 0.95 else None) for _ in range(5000)] + [("d", None)]
    df = spark.createDataFrame(rows, "g string, v string").repartition(7)
    ids = bm.numbered(df, "v")
    with_ids = df.join(ids, "v", "left")
    want = {(r.g, r.n) for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect() if r.n}
    state = bm.distinct_state(with_ids, ["g"])
    assert {(r.g, r.n_codes) for r in bm.distinct_counts(state, ["g"]).collect()} == want
    first, second = with_ids.where("g < 'b' or id % 3 = 0"), with_ids.where("g >= 'b'")
    both = bm.merged_states([bm.distinct_state(first, ["g"]), bm.distinct_state(second, ["g"]), state.limit(0)], ["g"])
    assert {(r.g, r.n_codes) for r in bm.distinct_counts(both, ["g"]).collect()} == want
    assert bm.distinct_counts(bm.distinct_state(with_ids, []), []).first().n_codes == df.agg(F.count_distinct("v")).first()[0]
    assert bm.distinct_counts(bm.distinct_state(with_ids.limit(0), []), []).first().n_codes == 0
    many = spark.range(100_000).select(F.lit("x").alias("g"), F.col("id").cast("string").alias("v"))
    state = bm.distinct_state(many.join(bm.numbered(many, "v"), "v"), ["g"])
    assert bm.distinct_counts(state, ["g"]).first().n_codes == 100_000 and state.count() < 40


# ---------------------------------------------------------------- SQL functions
def test_sql_functions_equal_the_column_forms(spark):
    from codeloom.functions.classify import classify
    from codeloom.functions.text import pad_right_digits, strip_code_suffix

    assert "expand_range" in sql_functions.register(spark)
    tokens = ["", "12", "11113-6", "100-9000", "5-3", "12-345", "92811P1", "9211MP", "3MS", "12Z", "1S", "n.a.", "2147483640-9", None]
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    df.createOrReplaceTempView("sql_tokens")
    got = spark.sql("SELECT t.token, e.code FROM sql_tokens t, LATERAL expand_range(t.token) e")
    assert _rows(got) == _rows(expand_ranges(df, "token", "code"))
    one = spark.sql("SELECT token, code_class(token) AS a, code_prefix(token) AS b, pad_code(token, 6) AS c FROM sql_tokens")
    assert _rows(one) == _rows(df.select("token", classify("token").alias("a"), strip_code_suffix("token").alias("b"), pad_right_digits("token", 6).alias("c")))
    assert [r[0] for r in spark.sql("SELECT range_chunk_count('100-9000'), range_chunk_count('x')").collect()] == [1]
    assert "Python" not in _plan(got)


# ---------------------------------------------------------------- bucketed tables
def test_bucketed_pair_joins_without_a_shuffle(spark):
    rnd = random.Random(2)
    codes = ["hot"] * 400 + [f"c{rnd.randrange(80)}" for _ in range(800)] + [None] * 5
    facts = spark.createDataFrame([(i, c, float(i)) for i, c in enumerate(codes)], "id long, code string, wt double")
    lookup = spark.createDataFrame([(f"c{i}", i) for i in range(60)] + [("hot", -1)], "lk string, v int")
    stats = al.code_stats(facts)
    names = sinks.write_bucketed_pair(facts, lookup, "code", "lk", stats, ["id"], 8)
    joined = sinks.read_bucketed_pair(spark, *names, "code", "lk")
    assert "Exchange" not in _plan(joined) and "SortMergeJoin" in _plan(joined)
    assert _rows(joined) == _rows(facts.join(lookup, facts.code == lookup.lk).drop("lk"))
    salts = spark.table(names[0]).where("code = 'hot'").groupBy("__salt").count().collect()
    assert len(salts) >= 4 and max(r["count"] for r in salts) < 200
    for name in names:
        spark.sql(f"DROP TABLE {name}")


# ---------------------------------------------------------------- observation, sizes, salts
def test_the_warning_costs_no_job(spark):
    facts = spark.createDataFrame([("12", 1.0), (" x9x ", 1.0), ("x9x", 2.0), ("0", 1.0), (None, 1.0)], "code string, wt double")
    stats = materialize(al.code_stats(facts), "stats", {"n_unclassified": cd.unclassified_rows()})
    spark.sparkContext.setJobGroup("warned", "no job")
    try:
        with pytest.warns(UserWarning, match="2 rows"):
            assert rp.warn_observed(stats) == 2
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("warned")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    per_code = stats.join(cd.code_map(stats, "code_raw", already_distinct=True).where("keep"), "code_raw")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert rp.warn_unclassified(per_code) == observed(stats)["n_unclassified"]


def test_bytes_of_arrays_are_counted(spark):
    flat = materialize(spark.range(10).select("id"))
    arrays = materialize(spark.range(10).select("id", F.array_repeat(F.struct("id", F.lit("abc").alias("s")), 1000).alias("a"),
                                                F.create_map(F.lit("k"), F.col("id")).alias("m"), F.lit(None).cast("array<int>").alias("n")))
    assert _bytes_of(flat, 10) == 80 and 10 * 1000 * 30 < _bytes_of(arrays, 10) < 10 * 1000 * 80


def test_salts_by_the_records_own_columns(spark):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    lookup = facts.select(F.col("k").alias("lk"), F.length("k").alias("v")).distinct()
    stats = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
    j = skew_safe_join(facts, lookup, "k", "lk", stats, salt_columns=["id"])
    assert "monotonically_increasing_id" not in _plan(j) and "xxhash64" in _plan(j)
    assert _rows(j) == _rows(facts.join(lookup, facts.k == lookup.lk).drop("lk"))
