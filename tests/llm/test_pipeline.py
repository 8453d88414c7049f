import corpus_pipeline as cp

from codeloom.llm import registry


def test_stages_on_the_smallest_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.schema.names == docs.schema.names, name
        rows = out.toPandas()
        ids = set(rows.doc_id)
        assert before is None or ids <= before, name
        assert len(rows) == len(ids)
        if name == "exact_dedup":
            assert rows.text.str.replace(r"[\x20\t-\r]+", " ", regex=True).is_unique
        if name == "decontamination":
            again = registry.decontaminate.contamination(out, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).toPandas()
            assert not again.contaminated.any()
        docs, before = spark.createDataFrame(rows, docs.schema), ids
    packed = cp.STAGES[-1][1](spark, docs, sf_dir).toPandas()
    assert set(packed.doc_id) == before
    assert (packed.groupby("sequence_id").length.sum() <= 4096).all()


def test_run(spark, sf_dir):
    got = cp.run(spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert 0 < got.select("doc_id").distinct().count() <= spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_stages_on_odd_documents(spark, make_docs, odd_rows, sf_dir):
    for rows in (odd_rows, []):
        docs = make_docs(rows)
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
        kept = docs.count()
        assert cp.STAGES[-1][1](spark, docs, sf_dir).where("piece = 0").count() == kept
