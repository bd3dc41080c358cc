"""DuckDB restatements of each operator, used as the correctness oracle.

Each function returns SQL text that DuckDB runs over the driver tables (the
fixture views are inlined as CTEs). The SQL restates the rules directly and
shares no code with the Spark operators beyond the fixed values.
"""

from __future__ import annotations

from ..config import (CELL_SEPARATOR_REGEX, EVIDENCE_REASONING, NULL_TOKENS, PY_WHITESPACE,
                      UNSAFE_NAME_REGEX)
from .fixtures import VIEWS

WS = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def norm(x: str) -> str:
    return "coalesce(" + strip(f"replace(upper({x}), ' ', '')") + ", '')"


def mgroup(x: str) -> str:
    return f"split_part({x}, '/', 1)"


def pattern(x: str) -> str:
    return f"(case when ends_with({x}, '*') then left({x}, length({x}) - 1) else {x} end)"


def tokenise(cell: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array(coalesce({cell}, ''), "
            f"'{CELL_SEPARATOR_REGEX}'), lambda p: replace({strip('upper(p)')}, ' ', '')), "
            f"lambda t: t <> '')")


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} as ({VIEWS[n]}\n)" for n in names]
    parts += [f"{n} as ({body}\n)" for n, body in (extra or [])]
    return "with " + ",\n".join(parts) + "\n"


ITEMS = f"""
select domain, ord, tech_name, codes from (
  select domain, cast(ord as bigint) as ord, {strip('tech_name')} as tech_name,
         list_sort(list_distinct({tokenise('code_cell')})) as codes
  from mapping_raw) x
where tech_name is not null and tech_name <> '' and lower(tech_name) <> 'nan' and len(codes) > 0"""

RESOLVED = f"""
select t.domain, t.tech_name_raw, c.item_ord, c.resolution_tier,
       coalesce(c.codes, cast([] as varchar[])) as expected_codes
from tech t left join (
  select domain, tech_name_raw,
         arg_min(ord, tier * 1000000000000 + ord) as item_ord,
         cast(min(tier) as integer) as resolution_tier,
         arg_min(codes, tier * 1000000000000 + ord) as codes
  from (select t.domain, t.tech_name_raw, i.ord, i.codes,
               case when {strip('t.tech_name_raw')} = i.tech_name then 0
                    when contains(t.tech_name_raw, i.tech_name)
                      or contains(i.tech_name, t.tech_name_raw) then 1
                    else 2 end as tier
        from tech t join items i on t.domain = i.domain) p
  group by domain, tech_name_raw) c
on t.domain = c.domain and t.tech_name_raw = c.tech_name_raw"""

INFERRED_LISTS = """
select domain, tech_name_raw, ord, patent_id,
       case when codes_piped = '' then cast([] as varchar[])
            else string_split(codes_piped, '|') end as inferred_codes
from inferred"""


def graded_sql(inferred: str = "inf", resolved: str = "res") -> str:
    """Level per inferred row against the technology's expected list."""
    normed = f"list_transform(coalesce(r.expected_codes, cast([] as varchar[])), lambda e: {norm('e')})"
    level = (f"coalesce(list_max(list_transform("
             f"list_transform(coalesce(g.inferred_codes, cast([] as varchar[])), lambda c: {norm('c')}), "
             f"lambda x: case when x = '' then 0 "
             f"when len(list_filter(pats, lambda p: x = p or (contains(p, '/') and starts_with(x, p)))) > 0 then 2 "
             f"when {mgroup('x')} <> '' and list_contains(groups, {mgroup('x')}) then 1 else 0 end)), 0)")
    return f"""
select g.*, {level} as level
from (select f.*,
             list_transform({normed}, lambda e: {pattern('e')}) as pats,
             list_transform({normed}, lambda e: {mgroup('e')}) as groups
      from {inferred} f left join {resolved} r
        on f.domain = r.domain and f.tech_name_raw = r.tech_name_raw) g"""


def py_round(x: str, d: int) -> str:
    return f"cast(printf('%.{d}f', {x}) as double)"


def validate_sql(graded: str = "graded", tau_strong: float = 0.35, tau_min: float = 0.15) -> str:
    return f"""
select t.domain, t.tech_name_raw, t.tech_name_raw as tech_name_expected,
       cast(coalesce(c.n, 0) as bigint) as n_patents,
       {py_round('ra', 4)} as rate_A, {py_round('rb', 4)} as rate_B,
       0.0::double as rate_C, {py_round('rn', 4)} as rate_none,
       case when ra + rb >= {tau_strong}::double then 'supported'
            when ra + rb >= {tau_min}::double then 'partially_supported'
            else 'not_supported' end as verdict,
       {py_round('0.7::double + 0.2::double * (ra + rb)', 3)} as confidence,
       array_to_string(r.expected_codes, ';') as expected_codes,
       r.resolution_tier
from tech t
left join (select domain, tech_name_raw, count(*) as n,
                  count(*) filter (where level = 2) as a,
                  count(*) filter (where level = 1) as b,
                  count(*) filter (where level = 0) as z
           from {graded} group by domain, tech_name_raw) c
  on t.domain = c.domain and t.tech_name_raw = c.tech_name_raw
left join res r on t.domain = r.domain and t.tech_name_raw = r.tech_name_raw,
lateral (select case when coalesce(c.n, 0) > 0 then c.a / c.n else 0.0::double end as ra,
                case when coalesce(c.n, 0) > 0 then c.b / c.n else 0.0::double end as rb,
                case when coalesce(c.n, 0) > 0 then c.z / c.n else 0.0::double end as rn) q"""


def base_ctes(*more: tuple[str, str]) -> str:
    """tech, mapping_raw, inferred views + items, res, inf, graded."""
    return with_views("tech", "mapping_raw", "inferred", extra=[
        ("items", ITEMS), ("res", RESOLVED), ("inf", INFERRED_LISTS),
        ("graded", graded_sql()), *more])


REASONING = EVIDENCE_REASONING
UNSAFE = UNSAFE_NAME_REGEX
NULL_TOKENS = NULL_TOKENS
