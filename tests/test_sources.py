"""Sheet reader/writer, CSV and parquet round trips."""

from pyspark.sql import types as T

from codeloom.session import scratch_path
from codeloom.sources import sheets, sinks


def test_sheet_roundtrip_skips_preamble_per_file(spark):
    rows = [(i, f" v{i} ", None if i % 5 == 0 else f"a,b {i}") for i in range(200)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("t", T.StringType())])
    df = spark.createDataFrame(rows, schema).repartition(4)
    path = scratch_path(spark, "test_sheet")
    sheets.write_sheet(df, path, ["title", "", "note, with comma", "x"])
    back = sheets.read_sheet(spark, path, schema, skip=4, header=True)
    assert sorted(back.collect()) == sorted(df.collect())


def test_all_text_scan_keeps_leading_zeros(spark):
    df = spark.createDataFrame([("0012.34", "000100"), ("7", "11211X")], "hts string, code string")
    path = scratch_path(spark, "test_csv")
    sinks.write_csv(df, path)
    back = sinks.read_csv(spark, path, sheets.all_text_schema(["hts", "code"]))
    assert sorted(back.collect()) == sorted(df.collect())


def test_sheet_reader_with_files_split_across_tasks(spark):
    """Only the split starting at byte 0 holds the preamble; later splits keep every line."""
    rows = [(i, f"value {i}", "x" * (i % 13)) for i in range(3000)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType()),
                           T.StructField("t", T.StringType())])
    df = spark.createDataFrame(rows, schema).repartition(3)
    path = scratch_path(spark, "test_sheet_split")
    sheets.write_sheet(df, path, ["a", "b", "c", "d"])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        back = sheets.read_sheet(spark, path, schema, skip=4, header=True)
        assert back.rdd.getNumPartitions() > 3
        assert sorted(back.collect()) == sorted(df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sheet_header_names_are_quoted(spark):
    import csv

    df = spark.createDataFrame([(1, "x")], "`b,c` int, `d\"e` string").coalesce(1)
    path = scratch_path(spark, "test_sheet_header")
    sheets.write_sheet(df, path, ["t"])
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0] == "t" and next(csv.reader([lines[1]])) == df.columns


def test_all_text_scan_of_a_late_filled_column(spark):
    rows = [(f"{i:05d}", None if i < 3000 else f"0{i}") for i in range(3100)]
    df = spark.createDataFrame(rows, "hts string, code string").coalesce(1)
    path = scratch_path(spark, "test_late")
    sinks.write_csv(df, path)
    back = sinks.read_csv(spark, path, sheets.all_text_schema(["hts", "code"]))
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_cleanup_deletes_this_applications_scratch_tables(spark, monkeypatch, tmp_path):
    from codeloom import session
    from codeloom.operators.broadcast import materialize

    monkeypatch.setattr(session, "shared_dir", lambda spark: str(tmp_path))
    (tmp_path / "other").mkdir()
    assert materialize(spark.range(3)).count() == 3
    assert (tmp_path / "codeloom-scratch").exists()
    session.cleanup(spark)
    assert not list((tmp_path / "codeloom-scratch").iterdir()) and (tmp_path / "other").exists()


def test_sheet_is_scanned_once(spark):
    """Lines are dropped by the scan that reads them; many small files stay apart although they would fit into one task."""
    rows = [(i, f"v{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s string").repartition(12)
    path = scratch_path(spark, "test_sheet_once")
    sheets.write_sheet(df, path, ["a", "b"])
    back = sheets.read_sheet(spark, path, df.schema, skip=2)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "Join" not in plan and "Exchange" not in plan and "Python" not in plan
    assert back.rdd.getNumPartitions() == 12
    assert sorted(back.collect()) == sorted(df.collect())
    back.createOrReplaceTempView("sheet_rows")
    assert spark.sql("select count(*) from sheet_rows").first()[0] == 60
    spark.catalog.dropTempView("sheet_rows")


def test_analysis_file_writes_its_tiers_side_by_side(spark, tmp_path, monkeypatch):
    """The fanned-out rows are not sorted by tier for the write; the session's setting stays as it was."""
    from codeloom.sources import sinks
    conf, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda *a: (seen.append(int(spark.conf.get(conf))), write(*a)))
    before = spark.conf.get(conf)
    rows = [(i, "s", "clean" if i % 2 else None) for i in range(20)]
    path = str(tmp_path / "analysis")
    sinks.analysis_file(spark.createDataFrame(rows, "id int, code_str string, match_quality string").coalesce(1), path)
    assert seen[0] > 1 and spark.conf.get(conf) == before
    assert sorted((r.id, r.match_quality) for r in spark.read.parquet(path).collect()) == [(i, q) for i, _, q in rows]


def test_analysis_file_takes_small_tasks_and_wide_pages(spark, tmp_path, monkeypatch):
    """Shuffled rows that fan out are dealt into tasks of 16 MB, unless the session says otherwise."""
    from codeloom.sources import sinks
    conf, seen = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    write = sinks.write_parquet
    monkeypatch.setattr(sinks, "write_parquet", lambda *a: (seen.append((spark.conf.get(conf), a[3])), write(*a)))
    df = spark.createDataFrame([(i, "clean") for i in range(9)], "id int, match_quality string")
    before = spark.conf.get(conf, None)
    try:
        sinks.analysis_file(df, str(tmp_path / "a"))
        assert spark.conf.get(conf, None) == before
        spark.conf.set(conf, "32m")
        sinks.analysis_file(df, str(tmp_path / "b"))
        assert spark.conf.get(conf) == "32m"
    finally:
        spark.conf.unset(conf)
    assert [int(seen[0][0]), seen[1][0]] == [16 << 20, "32m"]
    assert all(int(o["parquet.page.row.count.limit"]) > 20_000 for _, o in seen)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 9


def test_record_codes_compute_their_key_a_few_times_only(spark, tmp_path):
    """A scan expression that repeats the key for every class of codes is too large to be compiled."""
    from codeloom.sources import fixtures as fx
    rows = [(97 * 3 if n == 8 else 1, p, n, 1.0) for p in (1, 12345, None) for n in (1, 2, 3, 4, 5, 6, 7, 8, None)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    df = fx.src_codes(spark, str(tmp_path))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Relation")[0].count("l_partkey") <= 16
    got = {(r.l_linenumber, r.code) for r in df.where("wt = 1").collect() if r.code is not None}
    tails = {1: "", 2: "Z", 3: "M1", 4: "P2", 5: "S", 6: "MP", 7: "5", None: "5"}
    cut = {2: 1, 3: 1, 5: 2, 6: 2}
    want = {(n, k[:len(k) - cut.get(n, 0)] + t) for k in ("0001", "12345") for n, t in tails.items()}
    assert got == want | {(8, "x0001x"), (8, "x12345x")}


def test_trade_codes_by_class(spark, tmp_path):
    from codeloom.sources import fixtures as fx
    rows = [(o, c) for o in (4, 5, 2, 6, 7, None) for c in (7, 123456, None)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    df = fx.trade_raw(spark, str(tmp_path))
    got = {r.code for r in df.collect()}
    assert got == {None, "000700", "12345600", "0007XX", "123456XX", "000XXX", "123XXX", "00070X", "12345X", "000703", "12345603"}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.split("Relation")[0].count("o_custkey") <= 6


def test_union_tiers_scans_the_trade_table_once(spark, tmp_path):
    """Its three tiers read the distinct trade rows as written, not the trade table three times."""
    from codeloom.plans.queries import REGISTRY
    d = str(tmp_path)
    spark.createDataFrame([(k, f"Brand#{k % 3}") for k in range(1, 60)], "p_partkey long, p_brand string").write.parquet(f"{d}/part.parquet")
    spark.createDataFrame([(o, o % 60) for o in range(1, 90)] * 2, "o_orderkey long, o_custkey long").write.parquet(f"{d}/orders.parquet")
    df = REGISTRY["union_tiers"](spark, d)
    assert not [f for f in df.inputFiles() if "orders.parquet" in f]
    rows = df.collect()
    assert {"ambiguous_prefix"} <= {r.match_type for r in rows}
