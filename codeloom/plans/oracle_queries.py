"""DuckDB SQL per registered query (same output column names as the Spark side)."""

from __future__ import annotations

from codeloom.plans.oracle import _in_list, _q, classify_sql, sql, trim_sql
from codeloom.plans.queries import LINK_NEEDLE
from codeloom.sources.fixtures import TRADE_DROP_PREFIXES

# The rules' constants, written out here: the oracle takes none from the operators.
DROP_CODES = ("999920", "3MS", "4MS")
BANNER_COUNTRIES = ("AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR",
                    "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK",
                    "SI", "ES", "SE")

_DROP = _in_list(DROP_CODES)
_TRADE_DROP_ANY = " or ".join(f"starts_with(naics, {_q(p)})" for p in TRADE_DROP_PREFIXES) or "false"


def _decoded(x: str) -> str:
    """url_decode leaves a percent sign without two hexadecimal digits as it is."""
    return f"url_decode(replace({x}, '+', ' '))"


def _param(key: str) -> str:
    """The first of the query's fields with this name."""
    name, value = _decoded("split_part(f, '=', 1)"), _decoded("case when contains(f, '=') then substr(f, strpos(f, '=') + 1) else '' end")
    fields = r"string_split(regexp_extract(split_part(url, '#', 1), '\?(.*)$', 1), '&')"
    return f"list_transform(list_filter({fields}, lambda f: {name} = '{key}'), lambda f: {value})[1]"


_PAGES = f"""(select page_id, url, html, {_param('utm_source')} as utm_source,
  {_param('utm_campaign')} as utm_campaign from pages_awkward)"""

_ATTR = r"""\s([^\s=>"''/]+)\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)"""
_LINKS = f"""(select page_id, utm_source, replace(trim(regexp_extract(attr, '{_ATTR}', 2), '"'''), '&amp;', '&') as href from (
  select page_id, utm_source, list_filter(regexp_extract_all(tag, '{_ATTR}'), lambda x: lower(regexp_extract(x, '{_ATTR}', 1)) = 'href')[1] as attr from (
    select page_id, utm_source, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
      '(?i)<a\\s(?:[^>"'']|"[^"]*"|''[^'']*'')*>')) as tag from {_PAGES})))"""


def _totals(where: str = "") -> str:
    return f"""
select target, match_quality, n_targets, count(*) as n_rows, sum(wt) as wt_sum,
  round(sum(wt) / n_targets, 4) as wt_adj
from p_merged {where}
group by target, match_quality, n_targets"""


def _pct(m: str, t: str) -> str:
    return f"case when {t} > 0 then ((cast({m} as bigint) * 2000 + {t}) // (cast({t} as bigint) * 2)) / 10.0 end"


BODIES: dict[str, str] = {
    # A
    "scan_dictionary": "select * from dict_sheet",
    "scan_all_text": "select hts_raw, code from trade_raw",
    "scan_microdata": "select * from src_codes",
    "literal_override_table": """
select o.code, o.target, o.multi_io, o.match_type, coalesce(n.n_rows, 0) as n_rows
from ovr o left join (select code_str as code, count(*) as n_rows from facts group by code_str) n
  on o.code = n.code""",
    "sink_csv_roundtrip": "select * from p_graded",
    "sink_parquet_roundtrip": "select * from x_conc",
    "analysis_file": """
select l_orderkey, l_linenumber, wt, code, target, multi_io, match_type, n_targets,
  match_quality, wt_adj from p_merged""",
    # B
    "rename_by_position": "select target, raw from dict_sheet",
    "mutate_sequential": "select * from facts",
    "decode_value_labels": f"""
select c.c_custkey, c.c_nationkey,
  {trim_sql('coalesce(l.label, cast(c.c_nationkey as varchar))')} as value_str
from customer c left join value_labels l on c.c_nationkey = l.value""",
    # C
    "filter_sentinels": "select * from dict_f",
    "filter_not_employed": """
select l_orderkey, l_linenumber, wt, code, code_str from facts_t where code_str <> '0'""",
    "filter_drop_codes": f"""
select l_orderkey, l_linenumber, code_str from facts
where code_str is null or code_str not in {_DROP}""",
    "filter_not_prefix": f"select * from trade where not ({_TRADE_DROP_ANY})",
    "needs_prefix_pool": "select * from pool",
    # G
    "join_exact_code": "select * from t_exact",
    "prefix_join_3d": "select * from t_3",
    "longest_prefix_match": "select * from cascade",
    "unmatched_codes": "select code, code_type from codes where code not in (select code from p_conc)",
    "unmatched_dictionary": "select * from x_unmatched",
    "overrides_present": "select * from govt",
    "attach_fanout": "select c.*, f.n_targets from p_conc c left join p_fan f on c.code = f.code",
    "merge_persons": "select * from p_merged",
    "merge_persons_bucketed": "select * from p_merged",
    "wildcard_match": "select * from x_wild",
    "fallback_5d": "select * from x_fallback",
    # H
    "fanout": "select * from p_fan",
    "count_by_match_type": "select match_type, count(*) as n_rows from x_conc group by match_type",
    "match_type_breakdown": """
select match_type, count(*) as n_codes from (select distinct code, match_type from p_conc)
group by match_type""",
    "distinct_codes_merged": "select match_type, count(distinct code) as n_codes from p_tiers group by match_type",
    "count_unclassified": """
select code_str, count(*) as n_rows from facts where code_type = 'other' group by rollup (code_str)""",
    "fanout_histogram": "select n_targets, count(*) as n_codes from p_fan group by n_targets",
    "target_list_per_code": """
select code, string_agg(distinct target, ', ' order by target) as target_list from p_conc group by code""",
    "distinct_rows": "select distinct code_str, wt from facts",
    "distinct_codes": "select * from codes",
    # I
    "best_match_dedupe": "select * from p_conc",
    "sorted_breakdown": """
select n_targets, count(*) as n_codes from x_fan group by n_targets order by n_targets""",
    # K
    "union_tiers": "select * from x_tiers",
    # S
    "classify_codes": "select code, code_type from codes",
    "trim_unicode": "select l_orderkey, l_linenumber, code, code_str from facts_t",
    "strip_suffix": "select code, code_prefix from codes",
    "digits_only": "select hts_raw, regexp_replace(hts_raw, '[^0-9]', '', 'g') as hts_digits from trade_raw",
    "explode_tokens": "select target, src_ord, multi_io, token from dict_tok",
    "expand_ranges": "select target, src_ord, token, expanded from dict_exp",
    "sql_functions": f"""
select target, src_ord, token, expanded, {classify_sql('expanded')} as code_class,
  regexp_replace(expanded, '[A-Z][0-9]*$', '') as code_prefix,
  case when regexp_matches(expanded, '^[0-9]+$') and length(expanded) < 6 then rpad(expanded, 6, '0') else expanded end as key6
from dict_exp""",
    "pad_right": """
select target, src_ord, expanded, key6, cast(length(key6) as bigint) as key_len from (
  select *, case when regexp_matches(expanded, '^[0-9]+$') and length(expanded) < 6
                 then rpad(expanded, 6, '0') else expanded end as key6
  from dict_exp)""",
    "pad_left": """
select hts_raw, code,
  case when length(dg) < 10 then lpad(dg, 10, '0') else dg end as hts10,
  case when regexp_matches(code, '^[0-9]+$') and length(code) < 6 then lpad(code, 6, '0')
       else code end as naics
from (select *, regexp_replace(hts_raw, '[^0-9]', '', 'g') as dg from trade_raw)""",
    # E
    "normalize_dictionary": "select * from dict_long",
    "apply_overrides": "select * from p_tiers",
    "grade_matches": "select * from p_graded",
    "compact_concordance": "select * from p_graded",
    "range_blocks": """
select target, src_ord, token, cast(sum(n) as bigint) as n_codes, cast(sum(b) as bigint) as n_blocks from (
  select target, src_ord, token, coalesce(r_end - r_start + 1, 1) as n,
    case when is_rng and r_start is not null and r_end is not null and r_end >= r_start then
      len(list_distinct(list_transform(generate_series(r_start, r_end), lambda x: list_max(list_transform(generate_series(0, length(cast(x as varchar)) - 1), lambda i:
        case when x - x % cast(pow(10, i) as bigint) >= r_start and x - x % cast(pow(10, i) as bigint) + cast(pow(10, i) as bigint) - 1 <= r_end
              and length(cast(x - x % cast(pow(10, i) as bigint) as varchar)) = length(cast(x as varchar)) and (x = 0 or x >= cast(pow(10, i) as bigint))
             then i * 100000000000 + x // cast(pow(10, i) as bigint) end))))) else 1 end as b
  from (select target, src_ord, token, is_rng, case when is_rng and r_end >= r_start then r_start end as r_start, case when is_rng and r_end >= r_start then r_end end as r_end from dict_bnd))
group by target, src_ord, token""",
    "allocate_weights": _totals(),
    "normalize_tariff": "select * from trade",
    "two_sided_concordance": "select * from x_conc",
    "two_sided_concordance_intent": "select * from x_conc_i",
    "clean_sample_totals": _totals("where match_quality in ('clean', 'acceptable')"),
    "single_target_totals": _totals("where n_targets = 1 and match_quality is not null"),
    # R
    "coverage": f"""
select *, printf('%.1f%%', pct) as pct_label from (
select 'persons' as pipeline, m as n_matched, t as n_total, {_pct('m', 't')} as pct
from (select (select count(distinct code) from p_conc) as m, (select count(distinct code) from codes) as t)
union all
select 'tariff' as pipeline, m as n_matched, t as n_total, {_pct('m', 't')} as pct
from (select (select count(distinct target) from x_conc) as m,
             (select count(distinct target) from dict_long) as t))""",
    "dropped_rows": f"select count(*) filter (where {_TRADE_DROP_ANY}) as n_dropped from trade",
    "dropped_codes": f"""
select d.code, coalesce(n.n_rows, 0) as n_rows
from (select unnest([{', '.join(_q(c) for c in DROP_CODES)}]) as code) d
left join (select code_str, count(*) as n_rows from facts group by code_str) n on d.code = n.code_str""",
    "high_fanout_review": """
select f.code, f.n_targets, l.target_list
from p_fan f left join (select code, string_agg(distinct target, ', ' order by target) as target_list
                        from p_conc group by code) l on f.code = l.code
where f.n_targets > 2
order by f.n_targets desc, f.code""",
    "quality_breakdown": """
select match_quality, count(*) as n_codes from (select distinct code, match_quality from p_graded)
group by match_quality""",
    "fanout_over_threshold": "select count(*) filter (where n_targets > 1) as n_codes from x_fan",
    # V
    "utm_extract": f"select page_id, url, utm_source, utm_campaign from {_PAGES}",
    "source_visits": f"""
select page_id, 'source_visit' as event_name, 'traffic_source' as event_category,
  nullif(utm_source, '') || coalesce(' | ' || nullif(utm_campaign, ''), '') as event_label
from {_PAGES} where nullif(utm_source, '') is not null""",
    "link_clicks": f"""
select page_id, href, 'resume_click' as event_name, 'engagement' as event_category,
  coalesce(nullif(utm_source, ''), 'direct') as event_label
from {_LINKS}
where contains(href, {_q(LINK_NEEDLE)})""",
    "source_visits_stream": f"""
select page_id, 'source_visit' as event_name, 'traffic_source' as event_category,
  nullif(utm_source, '') || coalesce(' | ' || nullif(utm_campaign, ''), '') as event_label
from {_PAGES} where nullif(utm_source, '') is not null""",
    "link_clicks_stream": f"""
select page_id, href, 'resume_click' as event_name, 'engagement' as event_category,
  coalesce(nullif(utm_source, ''), 'direct') as event_label
from {_LINKS}
where contains(href, {_q(LINK_NEEDLE)})""",
    "consent_gate": f"""
select doc_id, country, consent,
  case when nullif(consent, '') is not null then 'none'
       when country in {_in_list(BANNER_COUNTRIES)} then 'banner' else 'track' end as action
from (select doc_id, upper(lang) as country,
        case source when 'src1' then 'accepted' when 'src2' then 'rejected' end as consent
      from documents)""",
    "consent_gate_stream": f"""
select doc_id, country, consent,
  case when nullif(consent, '') is not null then 'none'
       when country in {_in_list(BANNER_COUNTRIES)} then 'banner' else 'track' end as action
from (select doc_id, upper(lang) as country,
        case source when 'src1' then 'accepted' when 'src2' then 'rejected' end as consent
      from documents)""",
    "json_field": """
select event_id, event_type, try_cast(json_extract_string(props, '$.k') as integer) as k from events""",
}


def oracle_sql() -> dict[str, str]:
    return {k: sql(v) for k, v in BODIES.items()}
