"""DuckDB oracle SQL for every registered query that SQL can express."""

from __future__ import annotations

from . import oracle_sql as O

LEVEL_NAME = "case level when 2 then 'A' when 1 then 'B' else 'none' end"

NORM_CODE_CTE = f"""
select domain, tech_name_raw, patent_id, cast(pos - 1 as integer) as pos, code_raw,
       {O.norm('code_raw')} as code_norm
from (select domain, tech_name_raw, patent_id, unnest(inferred_codes) as code_raw,
             generate_subscripts(inferred_codes, 1) as pos from inf) x"""

DIRECT = """
select domain, tech_name_raw, string_split(codes_piped, '|') as expected_codes
from expected_direct"""

LEVEL_OF_X = (
    "case when x = '' then 0 "
    "when len(list_filter(pats, lambda p: x = p or (contains(p, '/') and starts_with(x, p)))) > 0 then 2 "
    f"when {O.mgroup('x')} <> '' and list_contains(groups, {O.mgroup('x')}) then 1 else 0 end")


def _validate_ctes() -> str:
    return O.base_ctes(("validated", O.validate_sql()))


ORACLES: dict[str, str] = {}

ORACLES["norm_code"] = O.with_views("inferred", extra=[("inf", O.INFERRED_LISTS)]) + NORM_CODE_CTE

ORACLES["main_group"] = O.with_views("inferred", extra=[("inf", O.INFERRED_LISTS), ("nc", NORM_CODE_CTE)]) + f"""
select domain, tech_name_raw, patent_id, pos, code_norm, {O.mgroup('code_norm')} as main_group from nc"""

ORACLES["pattern_split"] = O.with_views("expected_direct", extra=[("d", DIRECT)]) + f"""
select domain, tech_name_raw, cast(pos - 1 as integer) as pos, code_raw,
       {O.pattern(O.norm('code_raw'))} as pattern, ends_with({O.norm('code_raw')}, '*') as has_star
from (select domain, tech_name_raw, unnest(expected_codes) as code_raw,
             generate_subscripts(expected_codes, 1) as pos from d) x"""

ORACLES["match_level"] = O.with_views("inferred", "expected_direct", extra=[
    ("inf", O.INFERRED_LISTS), ("nc", NORM_CODE_CTE), ("d", DIRECT),
    ("arr", f"""
select domain, tech_name_raw,
       list_transform(list_transform(expected_codes, lambda e: {O.norm('e')}), lambda e: {O.pattern('e')}) as pats,
       list_transform(list_transform(expected_codes, lambda e: {O.norm('e')}), lambda e: {O.mgroup('e')}) as groups
from d""")]) + f"""
select nc.domain, nc.tech_name_raw, nc.patent_id, nc.pos, nc.code_norm,
       case (select {LEVEL_OF_X} from (select nc.code_norm as x) z) when 2 then 'A' when 1 then 'B' else 'none' end as level
from nc join arr on nc.domain = arr.domain and nc.tech_name_raw = arr.tech_name_raw"""

ORACLES["mapping_tokenise"] = O.with_views("mapping_raw") + f"""
select domain, cast(ord as bigint) as ord, array_to_string({O.tokenise('code_cell')}, ';') as tokens
from mapping_raw"""

ORACLES["safe_name"] = f"""
select doc_id,
       regexp_replace(lang, '{O.UNSAFE}', '_', 'g') || '__' || regexp_replace(source, '{O.UNSAFE}', '_', 'g') || '.csv' as file_name,
       regexp_replace(split_part(text, chr(10), 1), '{O.UNSAFE}', '_', 'g') as safe_title
from documents"""


def _tok(x: str) -> str:
    return (f"(case when length(coalesce({x}, '')) = 0 then cast(0 as bigint) "
            f"else greatest(cast(1 as bigint), cast(floor(length({x}) / 3.5) as bigint)) end)")


ORACLES["token_estimate"] = O.with_views("patents") + f"""
select domain, tech_name_raw, patent_id, {_tok('title')} as title_tokens,
       {_tok('abstract')} as abstract_tokens, {_tok('title')} + {_tok('abstract')} + 12 as item_tokens
from patents"""

ORACLES["mapping_items"] = O.with_views("mapping_raw", extra=[("items", O.ITEMS)]) + """
select domain, ord, tech_name, array_to_string(codes, ';') as codes from items"""

ORACLES["resolve_expected"] = O.with_views("tech", "mapping_raw", extra=[
    ("items", O.ITEMS), ("res", O.RESOLVED)]) + """
select domain, tech_name_raw, item_ord, resolution_tier,
       array_to_string(expected_codes, ';') as expected_codes from res"""

ORACLES["match_patent"] = O.base_ctes() + f"""
select domain, tech_name_raw, patent_id, ord, {LEVEL_NAME} as code_match_level from graded"""

ORACLES["match_patent_direct"] = O.with_views("inferred", "expected_direct", extra=[
    ("inf", O.INFERRED_LISTS), ("d", DIRECT), ("g", O.graded_sql("inf", "d"))]) + f"""
select domain, tech_name_raw, patent_id, ord, {LEVEL_NAME} as code_match_level from g"""

ORACLES["validate_tech"] = _validate_ctes() + "select * from validated"

ORACLES["evidence_topk"] = O.base_ctes() + f"""
select domain, tech_name_raw, rank, patent_id, {LEVEL_NAME} as code_match_level,
       array_to_string(inferred_codes, ';') as inferred_codes, '{O.REASONING}' as reasoning
from (select *, cast(row_number() over (partition by domain, tech_name_raw order by ord) as bigint) as rank
      from graded) x
where rank <= 5"""

_ROLLUP_AGGS = """count(*) as techs_total,
       count(*) filter (where verdict = 'supported') as n_supported,
       count(*) filter (where verdict = 'partially_supported') as n_partially_supported,
       count(*) filter (where verdict = 'not_supported') as n_not_supported"""

ORACLES["verdict_rollup"] = _validate_ctes() + f"""
select array_to_string(list_sort(list_distinct(list(domain))), ';') as domains, {_ROLLUP_AGGS}
from validated"""

ORACLES["verdict_rollup_domain"] = _validate_ctes() + f"""
select domain, {_ROLLUP_AGGS} from validated group by domain"""

# ------------------------------------------------------------ patents ---

_NULLS = "(" + ", ".join("'" + t.replace("'", "''") + "'" for t in O.NULL_TOKENS) + ")"


def _nt(x: str) -> str:
    return f"coalesce(case when {x} in {_NULLS} then null else {x} end, '')"


CLEANED = f"""
select domain, tech_name_raw, cast(ord as bigint) as ord,
       coalesce(case when patent_id in {_NULLS} then null else patent_id end, 'nan') as patent_id,
       {_nt('title')} as title, {_nt('abstract')} as abstract
from patents_raw
where {_nt('title')} <> '' or {_nt('abstract')} <> ''"""

ORACLES["clean_patents"] = O.with_views("patents_raw", extra=[("c", CLEANED)]) + """
select domain, tech_name_raw, ord, patent_id, title, length(abstract) as abstract_chars,
       md5(abstract) as abstract_md5 from c"""

ORACLES["synthetic_ids"] = O.with_views("patents_raw", extra=[("c", CLEANED)]) + """
select domain, tech_name_raw, ord,
       tech_name_raw || '-' || cast(row_number() over (partition by domain, tech_name_raw order by ord) - 1 as varchar) as patent_id
from c"""

ORACLES["truncate_text"] = O.with_views("patents_raw", extra=[("c", CLEANED)]) + """
select domain, tech_name_raw, patent_id,
       length(substring(title, 1, 2000)) as title_chars, md5(substring(title, 1, 2000)) as title_md5,
       length(substring(abstract, 1, 6000)) as abstract_chars, md5(substring(abstract, 1, 6000)) as abstract_md5
from c"""

# ------------------------------------------------------------ batching ---


def _auto(context: int = 32000, cap: int = 60) -> str:
    budget = f"(cast(floor({context} * 0.55) as bigint) - 1150)"
    tok = _tok
    return f"""
select t.domain, t.tech_name_raw, coalesce(s.n_sample, 0) as n_sample, s.avg_item_tokens,
       case when {budget} <= 0 or s.n_sample is null then cast(5 as bigint)
            else greatest(cast(5 as bigint), least(cast({cap} as bigint),
                          cast(floor({budget}::double / s.avg_item_tokens) as bigint))) end as batch_size
from tech t left join (
  select domain, tech_name_raw, count(*) as n_sample,
         greatest(cast(1 as bigint), cast(floor(sum(tk) / count(*)) as bigint)) as avg_item_tokens
  from (select domain, tech_name_raw,
               {tok('substring(title, 1, 2000)')} + {tok('substring(abstract, 1, 6000)')} + 12 as tk,
               row_number() over (partition by domain, tech_name_raw order by ord) as rn
        from patents) x
  where rn <= 50 group by domain, tech_name_raw) s
on t.domain = s.domain and t.tech_name_raw = s.tech_name_raw"""


ASSIGNED_AUTO = """
select p.*, a.batch_size, cast(floor(p.pos / a.batch_size) as bigint) + 1 as batch_idx
from (select *, row_number() over (partition by domain, tech_name_raw order by ord) - 1 as pos
      from patents) p
join auto a on p.domain = a.domain and p.tech_name_raw = a.tech_name_raw"""

ORACLES["auto_batch_size"] = O.with_views("tech", "patents", extra=[("auto", _auto())]) + \
    "select * from auto"

ORACLES["assign_batches"] = O.with_views("patents") + """
select domain, tech_name_raw, patent_id, ord, pos, cast(floor(pos / 30) as bigint) + 1 as batch_idx
from (select *, row_number() over (partition by domain, tech_name_raw order by ord) - 1 as pos
      from patents) p"""

ORACLES["assign_batches_auto"] = O.with_views("tech", "patents", extra=[
    ("auto", _auto()), ("asg", ASSIGNED_AUTO)]) + """
select domain, tech_name_raw, patent_id, ord, pos, batch_idx from asg"""

ORACLES["batch_payload"] = O.with_views("tech", "patents", extra=[
    ("auto", _auto()), ("asg", ASSIGNED_AUTO)]) + """
select domain, tech_name_raw, batch_idx, count(*) as n_items,
       string_agg(patent_id, ';' order by pos) as patent_ids,
       sum(length(substring(title, 1, 2000))) as title_chars,
       sum(length(substring(abstract, 1, 6000))) as abstract_chars
from asg group by domain, tech_name_raw, batch_idx"""

# the request JSON (keys in sorted order, compact, non-ASCII kept) and its
# MD5; DuckDB's to_json writes the same bytes as Spark's for these structs
ORACLES["payload_key"] = O.with_views("tech", "patents", extra=[
    ("auto", _auto()), ("asg", ASSIGNED_AUTO),
    ("pl", """select domain, tech_name_raw, batch_idx,
                '{"patent_batches":[' || to_json({'domain': domain,
                    'patents': list({'abstract': substring(abstract, 1, 6000), 'patent_id': patent_id,
                                     'title': substring(title, 1, 2000)} order by pos),
                    'tech_name_raw': tech_name_raw})
                || '],"techset_hierarchy":{"domains":[],"items":[]}}' as payload
              from asg group by domain, tech_name_raw, batch_idx""")]) + """
select domain, tech_name_raw, batch_idx, md5(payload) as cache_key,
       cast(length(payload) as bigint) as payload_chars
from pl"""

# I2-I4 with the deterministic stand-in (prose-wrapped answers): one call per
# request, first attempt; the answer lists every patent with the two codes of
# the ``inferred`` view, written as Python's json.dumps writes them
_FAKE_ITEM = """'{"patent_id": "' || patent_id || '", "inferred_codes": ' ||
    case when cast(patent_id as bigint) % 17 = 0 then '[]'
         else '["G0' || cast(cast(patent_id as bigint) % 7 as varchar) || 'S' ||
              case when cast(patent_id as bigint) % 3 = 0 then '/89' else '' end ||
              '", " h0' || cast(cast(patent_id as bigint) % 11 as varchar) || 'W 4/02"]' end || '}'"""

ORACLES["batch_infer"] = O.with_views("tech", "patents", extra=[
        ("auto", _auto()), ("asg", ASSIGNED_AUTO),
        ("pl", f"""select domain, tech_name_raw, batch_idx, count(*) as n_items,
                    '{{"patent_batches":[' || to_json({{'domain': domain,
                        'patents': list({{'abstract': substring(abstract, 1, 6000), 'patent_id': patent_id,
                                         'title': substring(title, 1, 2000)}} order by pos),
                        'tech_name_raw': tech_name_raw}})
                    || '],"techset_hierarchy":{{"domains":[],"items":[]}}}}' as payload,
                    'Result follows:' || chr(10) || '{{"patent_batches": [{{"domain": "' || domain ||
                    '", "tech_name_raw": "' || tech_name_raw || '", "patents": [' ||
                    string_agg({_FAKE_ITEM}, ', ' order by pos) || ']}}]}}' || chr(10) || 'End.' as answer
                  from asg group by domain, tech_name_raw, batch_idx""")]) + """
select domain, tech_name_raw, batch_idx, n_items, md5(payload) as cache_key, 1 as attempts,
       cast(length(answer) as bigint) as response_chars, cast(null as varchar) as error
from pl"""

# ----------------------------------------------------------- responses ---

PARSED = r"""
select domain, tech_name_raw, ord, j from (
  select *, case when json_valid(s) and json_type(s::json) = 'OBJECT' then s::json
                 when strpos(s, '{') > 0
                      and json_valid(substring(s, strpos(s, '{'), length(s) - strpos(reverse(s), '}') - strpos(s, '{') + 2))
                   then substring(s, strpos(s, '{'), length(s) - strpos(reverse(s), '}') - strpos(s, '{') + 2)::json
            end as j
  from (select *, regexp_replace(trim(raw_text), '^```(json)?\s*|\s*```$', '', 'gi') as s from responses) x) y
where json_type(j) = 'OBJECT' and json_type(j, '$.patent_batches') = 'ARRAY'"""

MERGED = """
select b.domain, b.tech_name_raw, b.ord as batch_idx, cast(b.bpos - 1 as integer) as bpos,
       cast(generate_subscripts(cast(json_extract(b.bj, '$.patents') as json[]), 1) - 1 as integer) as ppos,
       unnest(cast(json_extract(b.bj, '$.patents') as json[])) as pj
from (select domain, tech_name_raw, ord,
             unnest(cast(json_extract(j, '$.patent_batches') as json[])) as bj,
             generate_subscripts(cast(json_extract(j, '$.patent_batches') as json[]), 1) as bpos
      from parsed) b
where json_type(b.bj, '$.domain') = 'VARCHAR' and json_extract_string(b.bj, '$.domain') = b.domain
  and json_type(b.bj, '$.tech_name_raw') = 'VARCHAR'
  and json_extract_string(b.bj, '$.tech_name_raw') = b.tech_name_raw"""

MERGED_LISTS = """
select domain, tech_name_raw, batch_idx, bpos, ppos,
       case when json_type(pj, '$.patent_id') is null then ''
            when json_type(pj, '$.patent_id') = 'NULL' then 'None'
            else json_extract_string(pj, '$.patent_id') end as patent_id,
       case when json_type(pj, '$.inferred_codes') = 'ARRAY'
            then list_transform(cast(json_extract(pj, '$.inferred_codes') as json[]),
                                lambda c: case when json_type(c) = 'VARCHAR' then json_extract_string(c, '$') end)
            else cast([] as varchar[]) end as inferred_codes
from merged"""

ORACLES["merge_responses"] = O.with_views("responses", extra=[
    ("parsed", PARSED), ("merged", MERGED), ("ml", MERGED_LISTS)]) + """
select domain, tech_name_raw, batch_idx, bpos, ppos, patent_id,
       array_to_string(list_transform(inferred_codes, lambda c: coalesce(c, '')), ';') as inferred_codes
from ml"""

ORACLES["validate_responses"] = O.with_views("tech", "mapping_raw", "responses", extra=[
    ("items", O.ITEMS), ("res", O.RESOLVED), ("parsed", PARSED), ("merged", MERGED),
    ("ml", MERGED_LISTS), ("graded", O.graded_sql("ml", "res")),
    ("validated", O.validate_sql())]) + "select * from validated"

# ------------------------------------------------------ sources and job ---

ORACLES["read_mapping"] = O.with_views("mapping_raw", extra=[("items", O.ITEMS)]) + """
select domain, tech_name, array_to_string(codes, ';') as codes from items"""

ORACLES["read_patents"] = O.with_views("patents_raw") + """
select domain, tech_name_raw, nullif(patent_id, '') as patent_id, nullif(title, '') as title,
       md5(nullif(abstract, '')) as abstract_md5, length(nullif(abstract, '')) as abstract_chars
from patents_raw"""

ORACLES["checkpoint_skip"] = O.with_views("tech", "checkpoints") + """
select t.domain, t.tech_name_raw from tech t
where not exists (select 1 from checkpoints c where c.status = 'done'
                  and c.domain = t.domain and c.tech_name_raw = t.tech_name_raw)"""

ORACLES["cache_lookup"] = O.with_views("tech", "patents", extra=[
    ("auto", _auto()), ("asg", ASSIGNED_AUTO),
    ("b", """select domain, tech_name_raw, batch_idx,
                    md5(concat_ws('|', domain, tech_name_raw, string_agg(patent_id, ';' order by pos))) as cache_key
             from asg group by domain, tech_name_raw, batch_idx""")]) + """
select b.domain, b.tech_name_raw, b.batch_idx, b.cache_key,
       exists (select 1 from b c where c.batch_idx % 2 = 0 and c.cache_key = b.cache_key) as cache_hit
from b"""

# A request fails when it holds a document id = 7 (mod 50); a failed batch
# is cut into parts of max(10, n // 2), a failed part of more than 10 items into
# parts of max(5, n // 2), and a failed part of at most 10 items (after the
# first round) is given up. The split tree is unrolled by a recursive CTE.
_SPLIT_REQ = """
select c.*, exists (select 1 from poison p
                    where p.domain = c.domain and p.tech_name_raw = c.tech_name_raw
                      and p.batch_idx = c.batch_idx and p.ipos >= c.sub_start
                      and p.ipos < c.sub_start + c.n_items) as bad
from ({body}) c"""

ORACLES["split_failed"] = "with recursive" + O.with_views("tech", "patents", extra=[
    ("auto", _auto()), ("asg", ASSIGNED_AUTO),
    ("poison", """select domain, tech_name_raw, batch_idx, ipos from (
                    select *, row_number() over (partition by domain, tech_name_raw, batch_idx
                                                 order by pos) - 1 as ipos
                    from asg) x
                  where cast(patent_id as bigint) % 50 = 7"""),
    ("req(domain, tech_name_raw, batch_idx, sub_start, n_items, rnd, bs, bad)",
     _SPLIT_REQ.format(body="""
        select domain, tech_name_raw, batch_idx, cast(0 as bigint) as sub_start,
               count(*) as n_items, 0 as rnd, max(batch_size) as bs
        from asg group by domain, tech_name_raw, batch_idx""") + "\nunion all" +
     _SPLIT_REQ.format(body="""
        select domain, tech_name_raw, batch_idx, sub_start + k * sz as sub_start,
               least(sz, n_items - k * sz) as n_items, rnd + 1 as rnd, bs
        from (select *, unnest(range(0, (n_items + sz - 1) // sz)) as k
              from (select *, case when rnd = 0 then greatest(10, bs // 2)
                                   else greatest(5, n_items // 2) end as sz
                    from req where bad and not (n_items <= 10 and rnd > 0)) a) b"""))])[len("with"):] + """
select domain, tech_name_raw, batch_idx, sub_start, n_items,
       case when bad then 'given_up' else 'answered' end as outcome
from req where not bad or (n_items <= 10 and rnd > 0)"""

# S1 on the exported hierarchy: domains in file order (sorted when exported),
# one row per technology listed under its domain
ORACLES["read_techset"] = O.with_views("domains", "tech") + """
select d.domain_pos, d.domain, t.tech_name_raw as technology
from domains d left join tech t on d.domain = t.domain"""

# S2 on the exported mapping folder: one logical file <domain>.csv per domain
# that has mapping rows; a domain without a file has no row
ORACLES["detect_mapping"] = O.with_views("mapping_raw") + """
select distinct domain, domain || '.csv' as name from mapping_raw"""

# the job on exported files: every cleaned patent answered with the fixture codes
_JOB_CTES = O.with_views("tech", "mapping_raw", "patents_raw", "inferred", extra=[
    ("items", O.ITEMS), ("res", O.RESOLVED), ("inf", O.INFERRED_LISTS), ("c", CLEANED),
    ("answered", """select c.domain, c.tech_name_raw, c.patent_id, i.inferred_codes
                    from c join inf i on c.patent_id = i.patent_id"""),
    ("graded", O.graded_sql("answered", "res")), ("validated", O.validate_sql())])

ORACLES["summary_per_tech"] = _JOB_CTES + "select * from validated"

ORACLES["summary_all"] = _JOB_CTES + """
select domain, tech_name_raw, tech_name_expected, n_patents, rate_A, rate_B, rate_C,
       rate_none, verdict, confidence from validated"""

# K3 of the job run: batches of 30 cleaned patents in file order, each request
# carrying the exported hierarchy, answered on the first attempt by the stand-in
ORACLES["raw_responses"] = O.with_views("tech", "patents_raw", extra=[
    ("c", CLEANED),
    ("hier", """select to_json({'domains': list(domain order by domain),
                                'items': list({'domain': domain, 'technologies': techs} order by domain)}) as h
                from (select domain, list(tech_name_raw order by tech_name_raw) as techs
                      from tech group by domain) x"""),
    ("b", """select *, cast(floor(pos / 30) as bigint) + 1 as batch_idx
             from (select *, row_number() over (partition by domain, tech_name_raw order by ord) - 1 as pos
                   from c) x"""),
    ("pl", f"""select domain, tech_name_raw, batch_idx, count(*) as n_items,
                '{{"patent_batches":[' || to_json({{'domain': domain,
                    'patents': list({{'abstract': substring(abstract, 1, 6000), 'patent_id': patent_id,
                                     'title': substring(title, 1, 2000)}} order by pos),
                    'tech_name_raw': tech_name_raw}})
                || '],"techset_hierarchy":' || (select h from hier) || '}}' as payload,
                '{{"patent_batches": [{{"domain": "' || domain || '", "tech_name_raw": "' || tech_name_raw ||
                '", "patents": [' || string_agg({_FAKE_ITEM}, ', ' order by pos) || ']}}]}}' as answer
              from b group by domain, tech_name_raw, batch_idx""")]) + """
select domain, tech_name_raw, batch_idx, cast(0 as bigint) as sub_start, n_items,
       md5(payload) as cache_key, 1 as attempts, cast(length(answer) as bigint) as response_chars
from pl"""

# ------------------------------------------------------------ streaming ---

ORACLES["validate_stream"] = ORACLES["validate_tech"]

_RUNNING_COUNTS = O.base_ctes() + """
select domain, tech_name_raw, count(*) as n_patents,
       count(*) filter (where level = 2) as hits_a,
       count(*) filter (where level = 1) as hits_b,
       count(*) filter (where level = 0) as hits_none
from graded group by domain, tech_name_raw"""

ORACLES["running_rates"] = f"""
select c.*, v.rate_A, v.rate_B, v.rate_none, v.verdict, v.confidence
from ({_RUNNING_COUNTS}) c
join ({ORACLES["validate_tech"]}) v on v.domain = c.domain and v.tech_name_raw = c.tech_name_raw"""

ORACLES["parse_responses"] = O.with_views("responses", extra=[("p", r"""
select domain, tech_name_raw, ord,
       case when j is null then 'error'
            when json_type(j) = 'OBJECT' and json_exists(j, '$.patent_batches') then 'ok'
            else 'no_batches' end as parse_status,
       case when json_type(j, '$.patent_batches') = 'ARRAY'
            then cast(json_array_length(j, '$.patent_batches') as integer) end as n_batches
from (select *, case when json_valid(s) then s::json
                     when strpos(s, '{') > 0
                          and json_valid(substring(s, strpos(s, '{'), length(s) - strpos(reverse(s), '}') - strpos(s, '{') + 2))
                       then substring(s, strpos(s, '{'), length(s) - strpos(reverse(s), '}') - strpos(s, '{') + 2)::json
                end as j
      from (select *, regexp_replace(trim(raw_text), '^```(json)?\s*|\s*```$', '', 'gi') as s from responses) x) y""")]) + \
    "select * from p"

# ------------------------------------------- readback, coverage, streams ---

ORACLES["missing_domains"] = "select distinct lang || '_x' as domain from documents"

ORACLES["match_patent_large"] = ORACLES["match_patent_direct"]

ORACLES["retry_infer"] = ORACLES["batch_infer"].replace("1 as attempts", "3 as attempts")

ORACLES["resumed_summary"] = ORACLES["summary_all"]

ORACLES["coverage_report"] = O.with_views("tech", "patents_raw", "responses", extra=[
    ("c", CLEANED), ("m", ORACLES["merge_responses"]),
    ("back", "select domain, tech_name_raw, patent_id from m union all "
             "select domain, tech_name_raw, patent_id from m where batch_idx % 7 = 0"),
    ("ids", """select domain, tech_name_raw, patent_id, cast(sum(s) as bigint) as s, cast(sum(r) as bigint) as r
               from (select domain, tech_name_raw, patent_id, 1 as s, 0 as r from c
                     union all select domain, tech_name_raw, patent_id, 0, 1 from back) x
               group by domain, tech_name_raw, patent_id""")]) + """
select t.domain, t.tech_name_raw,
       cast(coalesce(sum(s), 0) as bigint) as sent, cast(coalesce(sum(r), 0) as bigint) as returned,
       count(*) filter (where s > 0 and r = 0) as missing_ids,
       cast(coalesce(sum(r) filter (where s = 0), 0) as bigint) as unknown_ids,
       cast(coalesce(sum(r - s) filter (where s > 0 and r > s), 0) as bigint) as duplicates
from tech t left join ids i on t.domain = i.domain and t.tech_name_raw = i.tech_name_raw
group by t.domain, t.tech_name_raw"""

ORACLES["job_coverage"] = O.with_views("tech", "patents_raw", extra=[("c", CLEANED)]) + """
select t.domain, t.tech_name_raw, count(c.patent_id) as sent, count(c.patent_id) as returned,
       cast(0 as bigint) as missing_ids, cast(0 as bigint) as unknown_ids, cast(0 as bigint) as duplicates
from tech t left join c on t.domain = c.domain and t.tech_name_raw = c.tech_name_raw
group by t.domain, t.tech_name_raw"""

ORACLES["evidence_stream"] = ORACLES["evidence_topk"]

ORACLES["technology_stream"] = ORACLES["summary_per_tech"]
