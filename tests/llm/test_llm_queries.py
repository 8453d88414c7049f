"""Every corpus query at sf0.001: against its DuckDB SQL, its contract's columns, and native plans."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from codeloom.llm import registry

CONTRACT = {
    1: "doc_id n_words n_hit n_items items_sha256 contaminated",
    2: "page_id payload_bytes payload_digest record_type refers_to",
    3: "doc_id keep_id group_size kept text_sha256",
    4: "doc_id class_id class_size kept",
    5: "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    6: "doc_id piece start length ids_crc32 sequence_id offset",
    7: "doc_id n_words n_tokens",
    8: "doc_id held_out lang_pred score",
    9: "doc_id held_out score predicted",
    10: "page_id host path rule verdict",
    11: "doc_id held_out score predicted",
    12: "lang rank phrase a l r n score",
    13: "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
}
NATIVE = (1, 5, 10)
NUMBER = {int(n[2:].split("_")[0]): n for n in registry.REGISTRY}


def norm(v):
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return None
    return v.item() if hasattr(v, "item") else v


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(repr, (tuple(norm(v) for v in r) for r in df.astype(object).itertuples(index=False, name=None))))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in "documents pages benchmark labels".split():
        con.execute(f"create view {t} as select * from read_parquet('{Path(sf_dir) / t}.parquet')")
    return con


def test_all_are_registered():
    assert sorted(NUMBER) == list(range(1, 14))
    assert set(registry.REGISTRY) | {"pipeline"} <= set(entry.queries())
    assert set(registry.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("n", range(1, 14))
def test_query(spark, sf_dir, duck, n):
    name = NUMBER[n]
    df = registry.REGISTRY[name](spark, sf_dir)
    assert df.columns == CONTRACT[n].split()
    got = df.toPandas()
    if n != 12:
        table, key = ("pages", "page_id") if n in (2, 10) else ("documents", "doc_id")
        assert sorted(set(got[key])) == sorted(r[0] for r in duck.execute(f"select {key} from {table}").fetchall())
    if name in registry.ORACLE:
        assert rows(got) == rows(duck.execute(registry.ORACLE[name]).df())
    if n in NATIVE:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
