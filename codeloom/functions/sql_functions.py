"""The crosswalk rules as Spark SQL functions, for queries without Python.

``register`` makes temporary functions of the session; their bodies are SQL over the same fixed
values as the column expressions.

* ``code_class(code)``, ``code_prefix(code)``, ``pad_code(code, width)``: scalars;
* ``expand_range(token)``: a table of codes, ``FROM tokens, LATERAL expand_range(token)``;
* ``range_chunk_count(token)``: how many rows of ``CHUNK`` codes that takes.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from codeloom.functions.classify import CODE_CLASS_RULES, DEFAULT_CLASS
from codeloom.functions.ranges import CHUNK, RANGE_PATTERN
from codeloom.functions.text import SUFFIX_PATTERN


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _bounds_sql() -> tuple[str, str, str]:
    base, suffix = "substring_index(token, '-', 1)", "substring_index(token, '-', -1)"
    start = f"try_cast({base} AS INT)"
    end = f"CASE WHEN length({base}) >= length({suffix}) THEN try_cast(concat(substring({base}, 1, length({base}) - length({suffix})), {suffix}) AS INT) END"
    valid = f"coalesce(token RLIKE {_quoted(RANGE_PATTERN)} AND {end} >= {start}, false)"
    return valid, f"CAST(CASE WHEN {valid} THEN {start} ELSE 0 END AS BIGINT)", f"CAST(CASE WHEN {valid} THEN {end} ELSE 0 END AS BIGINT)"


def _definitions() -> dict[str, str]:
    valid, lo, hi = _bounds_sql()
    arms = " ".join(f"WHEN code RLIKE {_quoted(p)} THEN {_quoted(c)}" for p, c in CODE_CLASS_RULES)
    codes = f"transform(sequence(c.c, least(c.c + {CHUNK - 1}, c.hi)), x -> CAST(x AS STRING))"
    return {
        "code_class(code STRING) RETURNS STRING": f"CASE {arms} ELSE {_quoted(DEFAULT_CLASS)} END",
        "code_prefix(code STRING) RETURNS STRING": f"regexp_replace(code, {_quoted(SUFFIX_PATTERN)}, '')",
        "pad_code(code STRING, width INT) RETURNS STRING": "CASE WHEN code RLIKE '^[0-9]+$' AND length(code) < width THEN rpad(code, width, '0') ELSE code END",
        "range_chunk_count(token STRING) RETURNS BIGINT": f"CASE WHEN {valid} THEN ({hi} - {lo}) div {CHUNK} + 1 ELSE 1 END",
        "expand_range(token STRING) RETURNS TABLE(code STRING)":
            f"SELECT e.code FROM (SELECT {valid} AS ok, explode(CASE WHEN {valid} THEN sequence({lo}, {hi}, CAST({CHUNK} AS BIGINT)) ELSE array(CAST(NULL AS BIGINT)) END) AS c, {hi} AS hi, token AS whole) AS c "
            f"LATERAL VIEW explode(CASE WHEN c.ok THEN {codes} ELSE array(c.whole) END) e AS code",
    }


def register(spark: SparkSession) -> list[str]:
    """Create (or replace) the session's temporary functions; returns their names."""
    names = []
    for head, body in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
        names.append(head.split("(")[0])
    return names
