"""Column functions: the hand-made cases and traps T1-T3, T5, T11, T13."""

from pyspark.sql import functions as F

from codeloom.functions.classify import classify
from codeloom.functions.ranges import expand_ranges
from codeloom.functions.text import (
    pad_left,
    pad_right_digits,
    split_list,
    strip_code_suffix,
    trim_ws,
)

RANGE_CASES = {
    "11113-6": ["11113", "11114", "11115", "11116"],
    "1111": ["1111"],
    "112A00": ["112A00"],
    "11116-3": ["11116-3"],           # end < start
    "3361-112": ["3361-112"],         # end 3112 < 3361
    "5411-9": [str(x) for x in range(5411, 5420)],
    "12-34": [str(x) for x in range(12, 35)],   # suffix as long as base
    "99999999999-9": ["99999999999-9"],         # overflow
    "0111-3": ["111", "112", "113"],            # leading zero lost
    "11-2-3": ["11-2-3"],
    "": [""],
    "1-234": ["1-234"],               # T5: suffix longer than base passes through
}


def test_expand_ranges_table(spark):
    df = spark.createDataFrame([(k,) for k in RANGE_CASES], "tok string")
    rows = expand_ranges(df, "tok", "out").collect()
    got: dict[str, list[str]] = {}
    for r in rows:
        got.setdefault(r.tok, []).append(r.out)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in RANGE_CASES.items()}


def test_expand_wide_range_is_chunked_and_whole(spark):
    # a range wider than one chunk expands completely, no cap
    df = spark.createDataFrame([("100000-110000",)], "tok string")
    out = expand_ranges(df, "tok", "out")
    assert out.count() == 10001
    assert out.agg(F.min(F.col("out").cast("int")), F.max(F.col("out").cast("int"))).first() == (100000, 110000)


def test_strip_suffix_cases(spark):
    cases = {"92811P1": "92811", "33641M1": "33641", "9211MP": "9211M", "3MS": "3M", "1234": "1234"}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r.c: r.p for r in df.select("c", strip_code_suffix("c").alias("p")).collect()}
    assert got == cases


def test_classes(spark):
    cases = {"5241": "numeric", "3118Z": "Z_suffix", "92M1": "M_suffix", "9281P": "P_suffix",
             "3MS": "S_suffix", "9211MP": "P_suffix", "x1x": "other"}
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "c string")
    got = {r.c: r.t for r in df.select("c", classify("c").alias("t")).collect()}
    assert got.pop(None) == "other"   # NA tests count as false
    assert got == cases


def test_t1_padding_never_shortens(spark):
    df = spark.createDataFrame([("12345678901",), ("123",), ("12A",)], "c string")
    r = {x.c: (x.l, x.r) for x in df.select(
        "c", pad_left("c", 10).alias("l"), pad_right_digits("c", 6).alias("r")).collect()}
    assert r["12345678901"] == ("12345678901", "12345678901")
    assert r["123"] == ("0000000123", "123000")
    assert r["12A"] == ("000000012A", "12A")      # right pad only for digits


def test_t2_unicode_trim(spark):
    df = spark.createDataFrame([("  92113\t　",), (" x y ",), ("",)], "c string")
    got = [r.t for r in df.select(trim_ws("c").alias("t")).collect()]
    assert got == ["92113", "x y", ""]


def test_t3_overflow_is_null_not_error(spark):
    df = spark.createDataFrame([("99999999999",)], "c string")
    assert df.select(F.col("c").try_cast("int").alias("v")).first().v is None


def test_t11_split_keeps_empty_tokens(spark):
    df = spark.createDataFrame([("1234, 1235,",), ("",)], "c string")
    got = [r.t for r in df.select(split_list("c").alias("t")).collect()]
    assert got == [["1234", "1235", ""], [""]]


def test_t6_drop_filter_keeps_null(spark):
    from codeloom.operators.codes import drop_codes_filter

    df = spark.createDataFrame([("999920",), (None,), ("3MS",), ("1234",)], "code string")
    got = sorted((r.code or "") for r in drop_codes_filter(df, ["999920", "3MS", "4MS"]).collect())
    assert got == ["", "1234"]


def test_t9_percent_is_exact_half_up(spark):
    from codeloom.operators.reports import percent_1dp

    df = spark.createDataFrame([(1, 8), (49, 400), (1, 3), (2, 3), (0, 5), (3, 0)], "m long, t long")
    got = [r.p for r in df.select(percent_1dp("m", "t").alias("p")).collect()]
    assert got == [12.5, 12.3, 33.3, 66.7, 0.0, None]


def test_d4_star_flags_the_whole_cell(spark):
    from codeloom.operators.dictionary import normalize_dictionary

    df = spark.createDataFrame([("A", "1111*, 2222"), ("B", "3333")], "target string, raw string")
    got = sorted((r.target, r.key6, r.multi_io) for r in normalize_dictionary(df).collect())
    assert got == [("A", "111100", True), ("A", "222200", True), ("B", "333300", False)]


def test_d3_analysis_file_keeps_all_but_work_columns(spark):
    from codeloom.session import scratch_path
    from codeloom.sources.sinks import analysis_file

    df = spark.createDataFrame([(1, "a", "x", "t", "p", "6", "clean", 2.0)],
                               "id long, keepme string, code_str string, code_type string, "
                               "code_prefix string, code_6d string, match_quality string, wt double")
    path = scratch_path(spark, "test_analysis")
    analysis_file(df, path)
    back = spark.read.parquet(path)
    assert sorted(back.columns) == ["id", "keepme", "match_quality", "wt"]


def test_t5_literal_ranges_and_their_report(spark):
    from codeloom.functions.ranges import expand_ranges, malformed_ranges

    df = spark.createDataFrame([("7-12",), ("11-3",), ("113-6",), ("9-99999999999",), ("x",), ("7-12",)], "t string")
    assert {(r.t, r.n_rows) for r in malformed_ranges(df, "t").collect()} == {("7-12", 2), ("9-99999999999", 1)}
    got = sorted(r.o for r in expand_ranges(df, "t", "o", literal=True).collect())
    assert got == sorted(2 * [str(i) for i in range(7, 13)] + ["11", "12", "13", "113", "114", "115", "116", "9-99999999999", "x"])


def test_totals_of_decimal_weights_are_exact(spark):
    from codeloom.operators import allocate as al
    from codeloom.operators import codes as cd
    from codeloom.operators import match as mt

    facts = spark.createDataFrame([("1111", 0.1)] * 1000 + [("1111", 1e9)], "code string, wt double")
    d = spark.createDataFrame([("A", "111100", False), ("B", "111100", False)], "target string, key6 string, multi_io boolean")
    cmap = cd.code_map(facts, "code", "code_str")
    graded = al.grade_matches(mt.person_concordance(cd.codes_from_map(cmap), d, None))
    got = al.allocate_totals(facts, cmap, graded, exact="decimal(28,6)").collect()
    assert {(r.target, str(r.wt_sum), float(r.wt_adj)) for r in got} == {(t, "1000000100.000000", 500000050.0) for t in "AB"}
