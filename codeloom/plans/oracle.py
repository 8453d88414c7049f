"""Independent DuckDB SQL for every registered query.

Written straight from the pipeline rules, not from the Spark plans: the
prefix cascade here is the literal tier-by-tier loop (exact, then 5, 4, 3, 2
with an anti join of everything matched so far), the dedupe is
``row_number() ... = 1`` and fan-out is a joined aggregate.  Views are CTEs
over the pre-registered driver tables; ``sql(body)`` prepends exactly the
CTEs the body needs.
"""

from __future__ import annotations

import re

from codeloom.functions.text import LIST_SEPARATOR, WHITE_SPACE_CLASS
from codeloom.operators.match import (
    DROP_CODES,
    FEDERAL_CODES,
    FEDERAL_TARGET,
    STATE_CODES,
    STATE_TARGET,
)
from codeloom.sources.fixtures import FIXTURE_SQL, TRADE_DROP_PREFIXES, TRADE_PREFIX_OVERRIDES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


WS = WHITE_SPACE_CLASS


def trim_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def classify_sql(x: str) -> str:
    return (f"case when regexp_matches({x}, '^[0-9]+$') then 'numeric' "
            f"when regexp_matches({x}, 'Z$') then 'Z_suffix' "
            f"when regexp_matches({x}, 'M[0-9]*$') then 'M_suffix' "
            f"when regexp_matches({x}, 'P[0-9]*$') then 'P_suffix' "
            f"when regexp_matches({x}, 'S$') then 'S_suffix' else 'other' end")


_OVERRIDE_VALUES = ", ".join(
    [f"({_q(c)}, {_q(FEDERAL_TARGET)})" for c in FEDERAL_CODES]
    + [f"({_q(c)}, {_q(STATE_TARGET)})" for c in STATE_CODES])

_DROP = _in_list(DROP_CODES)
_TRADE_DROP = " and ".join(f"not starts_with(naics, {_q(p)})" for p in TRADE_DROP_PREFIXES) or "true"
_FAMILY_DICT = "case " + " ".join(
    f"when starts_with(key6, {_q(o)}) then {_q(o)}" for o in TRADE_PREFIX_OVERRIDES) + \
    " else substr(key6, 1, 5) end"

_FAMILY_TRADE = "case " + " ".join(
    f"when starts_with(pfx0, {_q(o)}) then {_q(o)}" for o in TRADE_PREFIX_OVERRIDES) + \
    " else pfx0 end"

# Ordered CTE library: (name, body).  Later CTEs may use earlier ones.
CTES: list[tuple[str, str]] = [
    ("dict_raw", FIXTURE_SQL["dict_raw"]),
    ("dict_sheet", FIXTURE_SQL["dict_sheet"]),
    ("src_codes", FIXTURE_SQL["src_codes"]),
    ("trade_raw", FIXTURE_SQL["trade_raw"]),
    ("value_labels", FIXTURE_SQL["value_labels"]),
    ("pages_awkward", FIXTURE_SQL["pages_awkward"]),
    # ---------------- dictionary normalization
    ("dict_f", f"""
select target, src_ord, raw from dict_raw
where target is not null and raw is not null and {trim_sql('raw')} <> 'n.a.'"""),
    ("dict_tok", f"""
select target, src_ord, multi_io, {trim_sql('tok')} as token from (
  select target, src_ord, contains(raw, '*') as multi_io,
         unnest(string_split_regex(replace(raw, '*', ''), '{LIST_SEPARATOR}')) as tok
  from dict_f)"""),
    ("dict_rng", """
select target, src_ord, multi_io, token,
  regexp_matches(token, '^[0-9]+-[0-9]+$') as is_rng,
  split_part(token, '-', 1) as base, split_part(token, '-', 2) as suf
from dict_tok"""),
    ("dict_bnd", """
select *, try_cast(base as integer) as r_start,
  try_cast(case when length(base) >= length(suf)
                then substr(base, 1, length(base) - length(suf)) || suf end as integer) as r_end
from dict_rng"""),
    ("dict_exp", """
select target, src_ord, multi_io, token,
  unnest(case when is_rng and r_start is not null and r_end is not null and r_end >= r_start
              then cast(generate_series(r_start, r_end) as varchar[])
              else [token] end) as expanded
from dict_bnd"""),
    ("dict_long", """
select distinct target,
  case when regexp_matches(expanded, '^[0-9]+$') and length(expanded) < 6
       then rpad(expanded, 6, '0') else expanded end as key6,
  multi_io
from dict_exp"""),
    # ---------------- facts and distinct codes
    ("facts_t", f"""
select l_orderkey, l_linenumber, wt, code, {trim_sql('code')} as code_str from src_codes"""),
    ("facts", f"""
select l_orderkey, l_linenumber, wt, code, code_str,
  {classify_sql('code_str')} as code_type,
  regexp_replace(code_str, '[A-Z][0-9]*$', '') as code_prefix,
  case when regexp_matches(code_str, '^[0-9]+$') and length(code_str) < 6 then rpad(code_str, 6, '0')
       when regexp_matches(code_str, '^[0-9]+$') then code_str end as code_6d
from facts_t where code_str <> '0'"""),
    ("codes", """
select distinct code_str as code, code_type, code_prefix, code_6d from facts"""),
    # ---------------- tiers, literally one after the other
    ("t_exact", """
select c.code, d.target, d.multi_io, 'exact_6d' as match_type
from codes c join dict_long d on c.code_6d = d.key6
where c.code_type = 'numeric' and c.code_6d is not null"""),
    ("pool", """
select * from codes where code_type <> 'numeric' or code not in (select code from t_exact)"""),
    ("t_5", """
select p.code, d.target, d.multi_io, 'prefix_5d' as match_type
from pool p join dict_long d on substr(d.key6, 1, 5) = substr(p.code_prefix, 1, 5)
where length(substr(p.code_prefix, 1, 5)) = 5
  and p.code not in (select code from t_exact)"""),
    ("t_4", """
select p.code, d.target, d.multi_io, 'prefix_4d' as match_type
from pool p join dict_long d on substr(d.key6, 1, 4) = substr(p.code_prefix, 1, 4)
where length(substr(p.code_prefix, 1, 4)) = 4
  and p.code not in (select code from t_exact union all select code from t_5)"""),
    ("t_3", """
select p.code, d.target, d.multi_io, 'prefix_3d' as match_type
from pool p join dict_long d on substr(d.key6, 1, 3) = substr(p.code_prefix, 1, 3)
where length(substr(p.code_prefix, 1, 3)) = 3
  and p.code not in (select code from t_exact union all select code from t_5
                     union all select code from t_4)"""),
    ("t_2", """
select p.code, d.target, d.multi_io, 'prefix_2d' as match_type
from pool p join dict_long d on substr(d.key6, 1, 2) = substr(p.code_prefix, 1, 2)
where length(substr(p.code_prefix, 1, 2)) = 2
  and p.code not in (select code from t_exact union all select code from t_5
                     union all select code from t_4 union all select code from t_3)"""),
    ("cascade", """
select * from t_exact union all select * from t_5 union all select * from t_4
union all select * from t_3 union all select * from t_2"""),
    ("ovr", f"""
select code, target, false as multi_io, 'manual_govt' as match_type
from (values {_OVERRIDE_VALUES}) v(code, target)"""),
    ("govt", """
select * from ovr where code in (select code from codes)"""),
    ("p_tiers", """
select * from cascade union all select * from govt"""),
    ("p_conc", f"""
select code, target, multi_io, match_type from (
  select *, row_number() over (
      partition by code, target
      order by case match_type when 'exact_6d' then 1 when 'manual_govt' then 1
               when 'prefix_5d' then 2 when 'prefix_4d' then 3 when 'prefix_3d' then 4
               when 'prefix_2d' then 5 end, match_type, multi_io) as rn
  from p_tiers where code not in {_DROP})
where rn = 1"""),
    ("p_fan", """
select code, count(distinct target) as n_targets from p_conc group by code"""),
    ("p_graded", """
select c.code, c.target, c.multi_io, c.match_type, f.n_targets,
  case when c.match_type in ('exact_6d', 'manual_govt') then 'clean'
       when f.n_targets <= 4 then 'acceptable'
       when f.n_targets <= 15 then 'coarse' else 'unusable' end as match_quality
from p_conc c left join p_fan f on c.code = f.code"""),
    ("p_merged", f"""
select x.*, g.target, g.multi_io, g.match_type, g.n_targets, g.match_quality,
  x.wt / g.n_targets as wt_adj
from (select * from facts where code_str is null or code_str not in {_DROP}) x
left join p_graded g on x.code_str = g.code"""),
    # ---------------- two-sided (tariff) pipeline
    ("trade", """
select distinct hts10, naics, naics_ambiguous from (
  select case when length(regexp_replace(hts_raw, '[^0-9]', '', 'g')) < 10
              then lpad(regexp_replace(hts_raw, '[^0-9]', '', 'g'), 10, '0')
              else regexp_replace(hts_raw, '[^0-9]', '', 'g') end as hts10,
         case when regexp_matches(code, '^[0-9]+$') and length(code) < 6
              then lpad(code, 6, '0') else code end as naics,
         contains(code, 'X') as naics_ambiguous
  from trade_raw)
where hts10 is not null and naics is not null"""),
    ("x_exact", """
select d.target, d.key6, t.hts10, 'exact_6d' as match_type, d.multi_io
from dict_long d join trade t on d.key6 = t.naics where not t.naics_ambiguous"""),
    ("x_wild", f"""
select d.target, d.key6, t.hts10, 'ambiguous_prefix' as match_type, d.multi_io
from (select *, regexp_replace(naics, 'X+$', '') as pfx from trade
      where naics_ambiguous and {_TRADE_DROP}) t
join (select *, {_FAMILY_DICT} as pfx from dict_long) d on t.pfx = d.pfx"""),
    ("x_unmatched", """
select * from dict_long d
where not exists (select 1 from x_exact e where e.target = d.target and e.key6 = d.key6)"""),
    ("x_fallback", """
select d.target, d.key6, t.hts10, 'fallback_5d' as match_type, d.multi_io
from x_unmatched d join trade t on substr(d.key6, 1, 5) = substr(t.naics, 1, 5)
where not t.naics_ambiguous"""),
    ("x_tiers", """
select * from x_exact union all select * from x_wild union all select * from x_fallback"""),
    ("x_conc", """
select target, key6, hts10, match_type, multi_io from (
  select *, row_number() over (
      partition by target, hts10
      order by case match_type when 'exact_6d' then 1 when 'ambiguous_prefix' then 2
               when 'fallback_5d' then 3 end, key6, multi_io) as rn
  from x_tiers)
where rn = 1"""),
    ("x_wild_i", f"""
select d.target, d.key6, t.hts10, 'ambiguous_prefix' as match_type, d.multi_io
from (select *, {_FAMILY_TRADE} as pfx from (
        select *, regexp_replace(naics, 'X+$', '') as pfx0 from trade
        where naics_ambiguous and {_TRADE_DROP})) t
join (select *, {_FAMILY_DICT} as pfx from dict_long) d on t.pfx = d.pfx"""),
    ("x_conc_i", """
select target, key6, hts10, match_type, multi_io from (
  select *, row_number() over (
      partition by target, hts10
      order by case match_type when 'exact_6d' then 1 when 'ambiguous_prefix' then 2
               when 'fallback_5d' then 3 end, key6, multi_io) as rn
  from (select * from x_exact union all select * from x_wild_i union all select * from x_fallback))
where rn = 1"""),
    ("x_fan", """
select hts10, count(distinct target) as n_targets from x_conc group by hts10"""),
]

_CTE_NAMES = [n for n, _ in CTES]
_CTE_BODY = dict(CTES)


def _refs(text: str) -> set[str]:
    return {n for n in _CTE_NAMES if re.search(rf"\b{n}\b", text)}


def sql(body: str) -> str:
    """``WITH <needed CTEs> <body>`` with CTEs in definition order."""
    need: set[str] = set()
    frontier = _refs(body)
    while frontier:
        n = frontier.pop()
        if n in need:
            continue
        need.add(n)
        frontier |= _refs(_CTE_BODY[n]) - need - {n}
    parts = [f"{n} as ({_CTE_BODY[n].strip()})" for n in _CTE_NAMES if n in need]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body.strip()
