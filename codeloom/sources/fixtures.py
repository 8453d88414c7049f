"""Stand-in inputs for the crosswalk pipelines, derived from the driver tables.

The crosswalk pipelines read an industry dictionary sheet, person microdata
and a trade concordance sheet.  Each view below derives a stand-in for one
of them from a whole driver table (no row subsets): every row of
the source table yields a row, and ``CASE`` shapes give the code variety
the pipelines need (stars, ranges, lists, sentinels, suffix classes, white
space, wildcards).

Each view exists twice: a DataFrame builder for Spark and the same view as
DuckDB SQL (``FIXTURE_SQL``) for the independent oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.text import pad_left
from codeloom.sources.tables import read_table

NBSP = "\u00a0"
TAB = "\t"


def _stem(col: str | Column, plus: int = 0) -> Column:
    """An integer key as text, zero-padded to four characters and never shortened."""
    c = F.col(col) if isinstance(col, str) else col
    return pad_left((c + plus if plus else c).cast("string"), 4)


def _left(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def _but_last(c: Column, n: int) -> Column:
    """All but the last ``n`` characters."""
    return F.substring(c, F.lit(1), F.length(c) - n)


def _stem_sql(expr: str) -> str:
    text = f"cast({expr} as varchar)"
    return f"(case when length({text}) < 4 then lpad({text}, 4, '0') else {text} end)"


def _but_last_sql(stem: str, n: int) -> str:
    return f"substr({stem}, 1, length({stem}) - {n})"


PART, NEXT_PART, LINE_PART, CUSTOMER, ORDER = (
    _stem_sql(e) for e in ("p_partkey", "p_partkey + 1", "l_partkey", "o_custkey", "o_orderkey"))


# --------------------------------------------------------------------------
# dictionary cells: target industry + raw code list
# --------------------------------------------------------------------------
def _raw_cell() -> Column:
    k = _stem("p_partkey")
    s = F.col("p_partkey") % 10
    return (
        F.when(s == 0, F.concat(k, F.lit("*")))
        .when(s == 1, F.concat(_but_last(k, 1), F.lit("2-6")))
        .when(s == 2, F.concat(k, F.lit(", "), _stem("p_partkey", 1), F.lit(",")))
        .when(s == 3, F.concat(_but_last(k, 1), F.lit("A00")))
        .when(s == 4, F.concat(k, F.lit("-1, "), k, F.lit("51")))
        .when(s == 5, F.lit(" n.a."))
        .when(s == 6, F.lit(None).cast("string"))
        .when(s == 7, F.concat(_but_last(k, 1), F.lit("0-9*, "), k))
        .when(s == 8, F.concat(F.lit(NBSP), k, F.lit("0" + TAB)))
        .otherwise(F.concat(k, F.lit("-"), k))
    )


def _target() -> Column:
    return F.when(F.col("p_partkey") % 20 == 13, F.lit(None).cast("string")).otherwise(F.col("p_brand"))


def dict_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand"])
    return p.select(_target().alias("target"), F.col("p_partkey").alias("src_ord"), _raw_cell().alias("raw"))


DICT_RAW_SQL = f"""
select case when p_partkey % 20 = 13 then null else p_brand end as target,
  p_partkey as src_ord,
  case p_partkey % 10
    when 0 then {PART}||'*'
    when 1 then {_but_last_sql(PART, 1)}||'2-6'
    when 2 then {PART}||', '||{NEXT_PART}||','
    when 3 then {_but_last_sql(PART, 1)}||'A00'
    when 4 then {PART}||'-1, '||{PART}||'51'
    when 5 then ' n.a.'
    when 6 then null
    when 7 then {_but_last_sql(PART, 1)}||'0-9*, '||{PART}
    when 8 then chr(160)||{PART}||'0'||chr(9)
    else {PART}||'-'||{PART}
  end as raw
from part
"""


def dict_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary as a wide sheet: target in column 4, raw codes in column 7."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size", "p_retailprice", "p_brand"])
    return p.select("p_partkey", "p_name", "p_type", _target().alias("target"), "p_size", "p_retailprice", _raw_cell().alias("raw"))


DICT_SHEET_SQL = """
select p.p_partkey, p.p_name, p.p_type, d.target, p.p_size, p.p_retailprice, d.raw
from part p join dict_raw d on p.p_partkey = d.src_ord
"""


# --------------------------------------------------------------------------
# weighted records ("persons"): one per lineitem, code of every suffix class
# --------------------------------------------------------------------------
def src_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
    k = _stem("l_partkey")
    o = F.col("l_orderkey")
    n = F.col("l_linenumber")
    # characters off the end and a tail by line: the key stands in the expression once, which keeps the
    # generated code of a scan small enough to be compiled
    cut = F.when(n.isin(2, 3), F.lit(1)).when(n.isin(5, 6), F.lit(2)).otherwise(F.lit(0))
    tail = (F.when(n == 1, F.lit("")).when(n == 2, F.lit("Z")).when(n == 3, F.lit("M1")).when(n == 4, F.lit("P2"))
            .when(n == 5, F.lit("S")).when(n == 6, F.lit("MP")).otherwise(F.lit("5")))
    by_line = F.concat(F.substring(k, F.lit(1), F.length(k) - cut), tail)
    code = (
        F.when(o % 89 == 0, F.lit("0"))
        .when(o % 101 == 0, F.lit("999920"))
        .when(o % 97 == 0, F.concat(F.lit("x"), k, F.lit("x")))
        .when(o % 83 == 0, F.lit(" 92113 "))
        .when(o % 79 == 0, F.lit(NBSP + "92MP" + TAB))
        .otherwise(by_line)
    )
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("wt"), code.alias("code"))


SRC_CODES_SQL = f"""
select l_orderkey, l_linenumber, l_quantity as wt,
  case when l_orderkey % 89 = 0 then '0'
    when l_orderkey % 101 = 0 then '999920'
    when l_orderkey % 97 = 0 then 'x'||{LINE_PART}||'x'
    when l_orderkey % 83 = 0 then ' 92113 '
    when l_orderkey % 79 = 0 then chr(160)||'92MP'||chr(9)
    else case l_linenumber
      when 1 then {LINE_PART}
      when 2 then {_but_last_sql(LINE_PART, 1)}||'Z'
      when 3 then {_but_last_sql(LINE_PART, 1)}||'M1'
      when 4 then {LINE_PART}||'P2'
      when 5 then {_but_last_sql(LINE_PART, 2)}||'S'
      when 6 then {_but_last_sql(LINE_PART, 2)}||'MP'
      else {LINE_PART}||'5' end end as code
from lineitem
"""


# --------------------------------------------------------------------------
# trade concordance sheet: tariff code (dotted or plain) + industry code
# --------------------------------------------------------------------------
def trade_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    ok = F.col("o_orderkey")
    ck = _stem("o_custkey")
    hts = F.when(ok % 2 == 0, F.concat(_left(_stem("o_orderkey"), 2), F.lit("."), ok.cast("string"))) \
        .otherwise(ok.cast("string"))
    # as in src_codes, the key stands in the expression once
    short, wild = ok % 12 == 2, ok % 4 == 2
    body = F.concat(ck, F.when(ok % 4 == 0, F.lit("00")).when(ok % 4 == 1, F.lit("XX")).when(wild, F.lit("00")).otherwise(F.lit("03")))
    keep = F.when(short, F.lit(3)).when(wild, F.lit(5)).otherwise(F.lit(64))
    tail = F.when(short, F.lit("XXX")).when(wild, F.lit("X")).otherwise(F.lit(""))
    code = F.concat(F.substring(body, F.lit(1), keep), tail)
    return o.select(hts.alias("hts_raw"), code.alias("code"))


TRADE_RAW_SQL = f"""
select case when o_orderkey % 2 = 0
    then substr({ORDER}, 1, 2)||'.'||cast(o_orderkey as varchar)
    else cast(o_orderkey as varchar) end as hts_raw,
  case o_orderkey % 4
    when 0 then {CUSTOMER}||'00'
    when 1 then {CUSTOMER}||'XX'
    when 2 then case when o_orderkey % 12 = 2
      then substr({CUSTOMER}, 1, 3)||'XXX'
      else substr({CUSTOMER}||'00', 1, 5)||'X' end
    else {CUSTOMER}||'03' end as code
from orders
"""

# Parameters of the two-sided pipeline for this fixture: a dropped code family
# and a family keyed on a shorter prefix.
TRADE_DROP_PREFIXES = ("000",)
TRADE_PREFIX_OVERRIDES = ("001",)


# --------------------------------------------------------------------------
# labelled values: customer nation keys with a partial label dimension
# --------------------------------------------------------------------------
def labelled_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])


def value_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label row per nation; nations of the fifth region carry no label (NULL)."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    label = F.when(F.col("n_regionkey") < 4, F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")))
    return n.select(F.col("n_nationkey").alias("value"), label.alias("label"))


VALUE_LABELS_SQL = """
select n_nationkey as value, case when n_regionkey < 4 then ' '||n_name||' ' end as label from nation
"""


# --------------------------------------------------------------------------
# page log: awkward query strings and link markup, by page_id
# --------------------------------------------------------------------------
QUERY_STRINGS = ("utm_source=a|b", "utm_source=news&utm_campaign={cid}", "utm_source=s&utm_campaign=50%off", "utm_source=a^b",
                 "utm_source=%zz", "utm_source=a b", "q=`x`&utm_source=z", "utm_source=x&utm_source=y", "utm%5Fsource=enc&utm_campaign",
                 "utm_source&utm_campaign=c+d%C3%A9", "Utm_source=no&utm_source=", "utm_campaign=only#utm_source=late")
LINK_MARKUP = ('<A HREF="{}"', "<a href='{}'", "<a href={}", '<a class=x href = "{}"', '<a data-href="x/the" href="{}"',
               """<a title='href="x/the"' href="{}&amp;z" """, '<!-- <a href="/the"> --><a href="{}"')


def awkward_pages(pages: DataFrame) -> DataFrame:
    """Page rows of which most get one of the query strings and one of the link forms."""
    url = F.regexp_replace("url", "[?#].*$", "")
    u = html = F
    for i, q in enumerate(QUERY_STRINGS):
        u = u.when(F.col("page_id") % (len(QUERY_STRINGS) + 1) == i + 1, F.concat(url, F.lit("?" + q)))
    for i, m in enumerate(LINK_MARKUP):
        html = html.when(F.col("page_id") % (len(LINK_MARKUP) + 1) == i + 1, F.regexp_replace("html", '<a href="([^"]*)"', m.replace("{}", "$1")))
    return pages.select("page_id", u.otherwise(F.col("url")).alias("url"), html.otherwise(F.col("html")).alias("html"))


def _case_sql(arms: list[str], otherwise: str) -> str:
    return "case " + " ".join(f"when page_id % {len(arms) + 1} = {i + 1} then {a}" for i, a in enumerate(arms)) + f" else {otherwise} end"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_URL_ARMS = ["regexp_replace(url, '[?#].*$', '') || " + _quoted("?" + q) for q in QUERY_STRINGS]
_HTML_ARMS = ["regexp_replace(html, '<a href=\"([^\"]*)\"', " + _quoted(m.replace("{}", "\\1")) + ", 'g')" for m in LINK_MARKUP]
PAGES_SQL = f"""
select page_id, {_case_sql(_URL_ARMS, 'url')} as url, {_case_sql(_HTML_ARMS, 'html')} as html from pages
"""


FIXTURE_SQL: dict[str, str] = {
    "dict_raw": DICT_RAW_SQL,
    "dict_sheet": DICT_SHEET_SQL,
    "src_codes": SRC_CODES_SQL,
    "trade_raw": TRADE_RAW_SQL,
    "value_labels": VALUE_LABELS_SQL,
    "pages_awkward": PAGES_SQL,
}
