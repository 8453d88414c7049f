"""The README's usage example, end to end on files written from the driver tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.operators import allocate as al
from codeloom.operators import codes as cd
from codeloom.operators import dictionary as dc
from codeloom.operators import match as mt
from codeloom.operators import reports as rp
from codeloom.session import scratch_path
from codeloom.sources import fixtures as fx
from codeloom.sources import sheets, sinks


def test_readme_usage(spark, sf_dir):
    # inputs as a user would have them: a dictionary sheet export and a record table
    sheet_path = scratch_path(spark, "usage_sheet")
    sheets.write_sheet(fx.dict_sheet(spark, sf_dir), sheet_path, ["title", "", "", "notes"])
    records_path = scratch_path(spark, "usage_records")
    sinks.write_parquet(fx.src_codes(spark, sf_dir).withColumnRenamed("code", "indnaics")
                        .withColumnRenamed("wt", "perwt")
                        .withColumn("person_id", F.monotonically_increasing_id()), records_path)

    # --- README example ---
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, 8)])
    sheet = sheets.read_sheet(spark, sheet_path, schema, skip=4, header=True)
    dictionary = dc.normalize_dictionary(cd.rename_by_position(sheet, {4: "target", 7: "raw"}))

    persons = spark.read.parquet(records_path)
    stats = al.code_stats(persons, code="indnaics", weight="perwt")
    cmap = cd.code_map(stats, "code_raw", "code_str", already_distinct=True)
    codes = cd.codes_from_map(cmap)
    matches = mt.person_matches(codes, dictionary, mt.override_table(spark))
    graded = al.best_graded(cd.drop_codes_filter(matches, mt.DROP_CODES))

    merged = al.allocate(persons, cmap, graded, code="indnaics", weight="perwt", stats=stats)
    totals = al.allocate_totals_from_stats(stats, cmap, graded)
    report = rp.coverage(codes, graded, "code", "persons")
    # --- end ---

    m = merged.where(F.col("target").isNotNull())
    adj = m.agg(F.sum("wt_adj")).first()[0]
    raw = m.select("person_id", "perwt").distinct().agg(F.sum("perwt")).first()[0]
    assert abs(adj - raw) < 1e-9 * raw                       # mass conserved per record
    tot = totals.where(F.col("target").isNotNull()).agg(F.sum("wt_adj")).first()[0]
    assert abs(tot - raw) < 1e-3 * totals.count()            # totals are rounded to 4 places
    assert persons.count() >= merged.select("person_id").distinct().count()
    r = report.first()
    assert 0 < r.n_matched <= r.n_total
