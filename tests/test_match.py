"""Matching, dedupe, grading and allocation: hand-made cases, D1-D5, T4, properties."""

import random

import pytest
from pyspark.sql import functions as F

from codeloom.operators import allocate as al
from codeloom.operators import codes as cd
from codeloom.operators import match as mt

DICT_SCHEMA = "target string, key6 string, multi_io boolean"
TRADE_SCHEMA = "hts10 string, naics string, naics_ambiguous boolean"


def _codes(spark, codes):
    facts = spark.createDataFrame([(c,) for c in codes], "code string")
    return cd.codes_from_map(cd.code_map(facts, "code", "code_str"))


def literal_tiers(codes, dictionary, lengths=(5, 4, 3, 2)):
    """The rule in plain Python: a code's exact matches, else those of its longest matching prefix."""
    rows = [(r.target, r.key6, r.multi_io) for r in dictionary.collect()]
    out = []
    for c in codes.collect():
        tiers = [("exact_6d", [r for r in rows if c.code_type == "numeric" and r[1] == c.code_6d])]
        for n in lengths:
            prefix = (c.code_prefix or "")[:n]
            tiers.append((f"prefix_{n}d", [r for r in rows if len(prefix) == n and r[1] is not None and r[1][:n] == prefix]))
        match_type, best = next((t for t in tiers if t[1]), ("", []))
        out += [(c.code, match_type, multi, target) for target, _, multi in best]
    return sorted(out)


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_wildcards_as_coded_d1(spark):
    d = spark.createDataFrame([("1121A0", "112110", False), ("112300", "112300", False),
                               ("311810", "311810", False), ("336310", "336310", False),
                               ("311300", "311300", False)], DICT_SCHEMA)
    codes = ["11211X", "31181X", "33631X", "1123XX", "31131X", "31135X", "31511X"]
    t = spark.createDataFrame([(f"{i:010d}", c, True) for i, c in enumerate(codes)], TRADE_SCHEMA)
    got = mt.match_wildcards(t, d, drop_prefixes=["31511"], prefix_overrides=["3113"])
    matched = {r.hts10: r.target for r in got.collect()}
    by_code = {codes[int(h)]: tg for h, tg in matched.items()}
    assert by_code == {"11211X": "1121A0", "31181X": "311810", "33631X": "336310"}
    # opt-in: family override on both sides resolves the 3113 family too
    both = mt.match_wildcards(t, d, ["31511"], ["3113"], overrides_both_sides=True)
    by_code2 = {codes[int(r.hts10)]: r.target for r in both.collect()}
    assert by_code2["31131X"] == "311300" and by_code2["31135X"] == "311300"
    assert "1123XX" not in by_code2 and "31511X" not in by_code2


def test_d2_suffix_strip_falls_to_four(spark):
    d = spark.createDataFrame([("A", "921100", False)], DICT_SCHEMA)
    m = mt.match_longest_prefix(_codes(spark, ["9211MP"]), d).collect()
    assert [(r.code, r.target, r.match_type) for r in m] == [("9211MP", "A", "prefix_4d")]


def test_d5_override_and_prefix_both_kept(spark):
    d = spark.createDataFrame([("B", "921000", False)], DICT_SCHEMA)
    codes = _codes(spark, ["92MP"])
    ov = mt.override_table(spark)
    conc = mt.person_concordance(codes, d, ov)
    got = sorted((r.target, r.match_type) for r in conc.collect())
    assert got == [("928110", "manual_govt"), ("B", "prefix_2d")]
    graded = {r.target: (r.n_targets, r.match_quality) for r in al.grade_matches(conc).collect()}
    assert graded == {"928110": (2, "clean"), "B": (2, "acceptable")}


def test_grades(spark):
    rows = ([("E", f"t{i}", False, "exact_6d") for i in range(20)]
            + [("P4", f"t{i}", False, "prefix_3d") for i in range(4)]
            + [("P5", f"t{i}", False, "prefix_3d") for i in range(5)]
            + [("P15", f"t{i}", False, "prefix_2d") for i in range(15)]
            + [("P16", f"t{i}", False, "prefix_2d") for i in range(16)])
    conc = spark.createDataFrame(rows, "code string, target string, multi_io boolean, match_type string")
    got = {r.code: r.match_quality for r in al.grade_matches(conc).select("code", "match_quality").distinct().collect()}
    assert got == {"E": "clean", "P4": "acceptable", "P5": "coarse", "P15": "coarse", "P16": "unusable"}


def test_allocation_split_and_unmatched(spark):
    d = spark.createDataFrame([("A", "111100", False), ("B", "111100", False), ("C", "111100", False)],
                              DICT_SCHEMA)
    facts = spark.createDataFrame([(1, "1111", 90.0), (2, "7777", 50.0), (3, "0", 10.0),
                                   (4, None, 5.0), (5, "999920", 8.0)], "id long, code string, wt double")
    cmap = cd.code_map(facts, "code", "code_str")
    conc = al.grade_matches(mt.person_concordance(cd.codes_from_map(cmap), d, None))
    merged = al.allocate(facts, cmap, conc)
    got = sorted((r.id, r.target, r.wt_adj) for r in merged.collect())
    assert got == [(1, "A", 30.0), (1, "B", 30.0), (1, "C", 30.0), (2, None, None)]
    tot = {(r.target, r.n_targets): (r.n_rows, r.wt_sum, r.wt_adj)
           for r in al.allocate_totals(facts, cmap, conc).collect()}
    assert tot[("A", 3)] == (1, 90.0, 30.0)
    assert tot[(None, None)] == (1, 50.0, None)


def _random_world(spark, seed):
    rnd = random.Random(seed)
    digits = "0123456789"
    keys = {"".join(rnd.choice(digits[:4]) for _ in range(6)) for _ in range(40)}
    drows = [(f"T{rnd.randrange(6)}", k, rnd.random() < 0.3) for k in keys]
    drows += [(f"T{rnd.randrange(6)}", k, not m) for (_, k, m) in drows[:5]]
    suffixes = ["", "", "Z", "M1", "P2", "S", "MP", "x"]
    codes = set()
    for _ in range(80):
        n = rnd.randrange(2, 7)
        codes.add("".join(rnd.choice(digits[:4]) for _ in range(n)) + rnd.choice(suffixes))
    return spark.createDataFrame(drows, DICT_SCHEMA), _codes(spark, sorted(codes))


@pytest.mark.parametrize("seed", [1, 2, 3, 4, 5, 6])
def test_cascade_equals_literal_tier_loop(spark, seed):
    d, codes = _random_world(spark, seed)
    assert _rows(mt.match_longest_prefix(codes, d)) == literal_tiers(codes, d)
    for n in (5, 4, 3, 2):
        want = [r for r in literal_tiers(codes, d) if r[1] == f"prefix_{n}d"]
        assert _rows(mt.prefix_tier(codes, d, n)) == want


@pytest.mark.parametrize("seed", [7, 8])
def test_dedupe_unique_idempotent_and_order_free(spark, seed):
    d, codes = _random_world(spark, seed)
    conc = mt.person_concordance(codes, d, mt.override_table(spark))
    assert conc.count() == conc.select("code", "target").distinct().count()
    again = mt.best_match(conc, ["code", "target"], mt.PERSON_RANKS, ["match_type", "multi_io"])
    assert _rows(again) == _rows(conc)
    shuffled = mt.person_concordance(codes.repartition(7).orderBy(F.rand(seed)),
                                     d.repartition(3).orderBy(F.rand(seed + 1)), mt.override_table(spark))
    assert _rows(shuffled) == _rows(conc)


@pytest.mark.parametrize("seed", [9, 10])
def test_matched_and_unmatched_partition_the_codes(spark, seed):
    d, codes = _random_world(spark, seed)
    conc = mt.person_concordance(codes, d, None, drop_codes=())
    matched = {r.code for r in conc.select("code").distinct().collect()}
    unmatched = {r.code for r in codes.join(conc.select("code"), "code", "left_anti").collect()}
    allc = {r.code for r in codes.collect()}
    assert matched | unmatched == allc and not (matched & unmatched)


@pytest.mark.parametrize("seed", [11, 12])
def test_mass_is_conserved(spark, seed):
    d, codes = _random_world(spark, seed)
    rnd = random.Random(seed)
    code_list = [r.code for r in codes.collect()]
    facts = spark.createDataFrame([(i, rnd.choice(code_list), float(rnd.randrange(1, 60)))
                                   for i in range(400)], "id long, code string, wt double")
    cmap = cd.code_map(facts, "code", "code_str")
    graded = al.grade_matches(mt.person_concordance(cd.codes_from_map(cmap), d, None))
    merged = al.allocate(facts, cmap, graded)
    m = merged.where(F.col("target").isNotNull())
    adj = m.agg(F.sum("wt_adj")).first()[0] or 0.0
    raw = m.select("id", "wt").distinct().agg(F.sum("wt")).first()[0] or 0.0
    assert adj == pytest.approx(raw, rel=1e-12)
    # every record appears: matched ones k times, unmatched once
    assert merged.select("id").distinct().count() == 400


@pytest.mark.parametrize("seed", [13, 14])
def test_fused_tariff_join_equals_three_joins(spark, seed):
    rnd = random.Random(seed)
    d, _ = _random_world(spark, seed)
    rows = []
    for i in range(150):
        base = "".join(rnd.choice("0123") for _ in range(6))
        kind = rnd.randrange(4)
        code = base if kind < 2 else base[:rnd.randrange(3, 6)] + "X" * 3
        code = code[:6] if kind < 2 else code
        rows.append((f"{i:010d}", code, "X" in code))
    t = spark.createDataFrame(rows, TRADE_SCHEMA)
    fused = mt.tariff_matches(d, t, ["000"], ["001"])
    three = mt.tariff_tiers(d, t, ["000"], ["001"])
    assert _rows(fused) == _rows(three)


def test_salted_fallback_equals_broadcast_join(spark):
    """Beyond the broadcast bound the salted shuffle join gives the same rows."""
    rnd = random.Random(21)
    d = spark.createDataFrame([(f"T{i % 4}", f"{k:04d}00", False) for i, k in enumerate(range(0, 40))],
                              DICT_SCHEMA)
    # one hot code with a third of all records
    codes = ["0001"] * 300 + [f"{rnd.randrange(0, 60):04d}" for _ in range(600)]
    facts = spark.createDataFrame([(i, c, float(i % 7 + 1)) for i, c in enumerate(codes)],
                                  "id long, code string, wt double")
    stats = al.code_stats(facts)
    cmap = cd.code_map(stats, "code_raw", "code_str")
    graded = al.grade_matches(mt.person_concordance(cd.codes_from_map(cmap), d, None))
    bc = al.allocate(facts, cmap, graded, stats=stats)
    salted = al.allocate(facts, cmap, graded, max_broadcast_rows=0, stats=stats)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "monotonically_increasing_id" in plan and "NestedLoop" not in plan
    assert _rows(salted) == _rows(bc)


@pytest.mark.parametrize("seed", [15, 16, 17])
def test_fused_best_graded_equals_dedupe_then_grade(spark, seed):
    d, codes = _random_world(spark, seed)
    m = mt.person_matches(codes, d, mt.override_table(spark))
    two_step = al.grade_matches(mt.best_match(m, ["code", "target"], mt.PERSON_RANKS,
                                              ["match_type", "multi_io"]))
    assert _rows(al.best_graded(m)) == _rows(two_step)


def test_concordance_ignores_duplicate_trade_rows(spark, sf_dir):
    from codeloom.plans.pipelines import TariffPipeline

    t = TariffPipeline(spark, sf_dir)
    dup = mt.two_sided_concordance(t.dictionary, t.trade_rows.unionByName(t.trade_rows),
                                   t.drop_prefixes, t.prefix_overrides)
    assert _rows(dup) == _rows(mt.two_sided_concordance(t.dictionary, t.trade, t.drop_prefixes,
                                                        t.prefix_overrides))


def test_tariff_salted_fallback_equals_broadcast(spark, sf_dir):
    """With no broadcast allowed, the two-sided join salts hot keys and gives the same rows."""
    from codeloom.plans.pipelines import TariffPipeline

    want = _rows(TariffPipeline(spark, sf_dir).concordance)
    spark.conf.set("spark.codeloom.broadcast.maxRows", "0")
    try:
        t = TariffPipeline(spark, sf_dir)
        conc = t.concordance
        plan = conc._jdf.queryExecution().executedPlan().toString()
        assert "monotonically_increasing_id" in plan and "NestedLoop" not in plan
        assert _rows(conc) == want
    finally:
        spark.conf.unset("spark.codeloom.broadcast.maxRows")


def test_groups_are_bounded_by_targets(spark):
    """200,000 dictionary keys of three targets under one prefix: a code meets three rows, not 200,000."""
    d = spark.range(200_000).select(F.concat(F.lit("T"), (F.col("id") % 3).cast("string")).alias("target"),
                                    F.concat(F.lit("31"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("key6"),
                                    (F.col("id") % 2 == 0).alias("multi_io"))
    codes = _codes(spark, ["31S", "31MP"])
    m = mt.person_matches(codes, d, None, reduced=True)
    assert m.count() == 6
    assert _rows(al.best_graded(m)) == _rows(al.best_graded(mt.person_matches(codes, d, None)))
    assert {r.n_targets for r in al.best_graded(m).collect()} == {3}
    t = spark.createDataFrame([("1", "31000X", True), ("2", "31000X", True)], TRADE_SCHEMA)
    assert mt.tariff_matches(d, t, reduced=True).count() == 6


def test_a_hot_key_spreads_by_its_share(spark):
    from codeloom.operators.broadcast import skew_safe_join

    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(0, 9000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"))
        lookup = facts.distinct().select(F.col("k").alias("lk"), F.length("k").alias("v"))
        stats = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = skew_safe_join(facts, lookup, "k", "lk", stats)
        assert j.count() == 9000
        parts = j.where("k = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(parts) >= 8 and max(r["count"] for r in parts) <= 3000 / 4
    finally:
        for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_broadcast_needs_few_rows_and_few_bytes(spark):
    from codeloom.operators.broadcast import materialize, sized_broadcast

    t = materialize(spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s")))
    hinted = lambda df: getattr(df, "_codeloom_broadcast", False)
    assert hinted(sized_broadcast(t))
    assert not hinted(sized_broadcast(t, max_rows=99))
    spark.conf.set("spark.codeloom.broadcast.maxBytes", "50000")
    try:
        assert not hinted(sized_broadcast(t))
    finally:
        spark.conf.unset("spark.codeloom.broadcast.maxBytes")


def test_code_space_grows_and_the_shuffle_path_agrees(spark):
    """At sf0.1 stems have five digits; without any broadcast the concordance is the same."""
    from codeloom.plans.pipelines import PersonPipeline, TariffPipeline

    small, large = (PersonPipeline(spark, f"/root/testdata/sf{x}") for x in ("0.01", "0.1"))
    assert large.code_stats.count() > 5 * small.code_stats.count()
    assert large.dictionary.count() > 5 * small.dictionary.count()
    want = TariffPipeline(spark, "/root/testdata/sf0.1").concordance.count()
    spark.conf.set("spark.codeloom.broadcast.maxRows", "0")
    try:
        assert TariffPipeline(spark, "/root/testdata/sf0.1").concordance.count() == want
    finally:
        spark.conf.unset("spark.codeloom.broadcast.maxRows")


def test_small_tables_are_made_only_when_needed(spark, sf_dir):
    from codeloom.plans.pipelines import PersonPipeline

    p = PersonPipeline(spark, sf_dir)
    p.codes.count()
    assert "code_stats" in p.__dict__ and "dictionary" not in p.__dict__
