"""Classification-code expressions (all JVM-side, codegen friendly).

norm_code      F1  upper, drop ASCII spaces, strip Python whitespace at both ends
main_group     F2  text before the first "/" of the normalised code
pattern_of     F3  normalised code without one trailing "*", and the star flag
level_of       F4  2 (A), 1 (B) or 0 (none) of one normalised code against
                   precomputed pattern arrays of an expected list
best_level     A1  best level over an array of inferred codes
tokenise_cell  F5  split a mapping cell into upper-case, stripped tokens
safe_name      K6  runs of file-unsafe characters become one "_"
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (CELL_SEPARATOR_REGEX, LEVEL_A, LEVEL_B, LEVEL_NONE,
                      PY_WHITESPACE, UNSAFE_NAME_REGEX)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.trim(_c(col), F.lit(PY_WHITESPACE))


def norm_code(col) -> Column:
    """F1. Null stays null here; callers treat null as ''."""
    return py_strip(F.replace(F.upper(_c(col)), F.lit(" "), F.lit("")))


def main_group(normed) -> Column:
    """F2 on an already normalised code."""
    return F.substring_index(_c(normed), "/", 1)


def pattern_of(normed) -> Column:
    """F3 on an already normalised code: drop one trailing '*'."""
    c = _c(normed)
    return F.when(c.endswith("*"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def star_of(normed) -> Column:
    return _c(normed).endswith("*")


# The same rules as SQL text, for expressions built in one call (lambdas
# written in Python cost several round trips to the JVM each).

def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def norm_sql(x: str) -> str:
    """F1 as SQL on expression text ``x``."""
    return f"trim(BOTH '{PY_WHITESPACE}' FROM replace(upper({x}), ' ', ''))"


def pattern_sql(n: str) -> str:
    """F3 as SQL on a normalised code: drop one trailing '*'."""
    return f"CASE WHEN endswith({n}, '*') THEN substr({n}, 1, length({n}) - 1) ELSE {n} END"


def prefixes_sql(i: str) -> str:
    """Every prefix of a code, the empty one first."""
    return f"transform(sequence(0, length({i})), k -> substr({i}, 1, k))"


def expected_arrays(expected_codes: str) -> dict[str, Column]:
    """Precompute, once per expected list (a column name), what matching needs.

    pats    patterns (star removed) that may match by equality
    slashed patterns containing '/', which also match as prefixes
    groups  main groups of the normalised expected codes (star kept)
    stars   patterns whose star had no '/', for the opt-in star prefix rule
    """
    normed = f"transform({_q(expected_codes)}, e -> coalesce({norm_sql('e')}, ''))"
    pats = f"transform({normed}, e -> {pattern_sql('e')})"
    return {
        "exp_pats": F.expr(pats),
        "exp_slashed": F.expr(f"filter({pats}, p -> instr(p, '/') > 0)"),
        "exp_groups": F.expr(f"transform({normed}, e -> substring_index(e, '/', 1))"),
        "exp_stars": F.expr(f"transform(filter({normed}, e -> endswith(e, '*') AND instr(e, '/') = 0), "
                            f"e -> {pattern_sql('e')})"),
    }


def level_of(code, pats="exp_pats", slashed="exp_slashed", groups="exp_groups",
             stars="exp_stars", star_prefix: bool = False) -> Column:
    """F4 for one normalised code; returns 2 / 1 / 0."""
    i = _c(code)
    is_a = F.array_contains(_c(pats), i) | F.exists(_c(slashed), lambda p: i.startswith(p))
    if star_prefix:
        is_a = is_a | F.exists(_c(stars), lambda p: i.startswith(p))
    g = main_group(i)
    return (F.when(i.isNull() | (i == ""), F.lit(0))
             .when(is_a, F.lit(2))
             .when((g != "") & F.array_contains(_c(groups), g), F.lit(1))
             .otherwise(F.lit(0)))


def normalise_codes(codes) -> Column:
    """Normalised inferred codes; a null element (non-string) becomes ''."""
    return F.transform(_c(codes), lambda c: F.coalesce(norm_code(c), F.lit("")))


def best_level(normed_codes, star_prefix: bool = False, **arrays) -> Column:
    """A1. Highest level over the (normalised) codes; empty or null gives 0."""
    return F.coalesce(
        F.array_max(F.transform(_c(normed_codes),
                                lambda x: level_of(x, star_prefix=star_prefix, **arrays))),
        F.lit(0))


# Pattern lists at least this long are matched by prefix lookup (see below).
PREFIX_LOOKUP_AT = 16


def with_best_level(df, codes: str, out: str = "level", star_prefix: bool = False,
                    pats="exp_pats", slashed="exp_slashed", groups="exp_groups",
                    stars="exp_stars", prefix_lookup_at: int = PREFIX_LOOKUP_AT):
    """A1 over a raw code list with set overlaps instead of per-pattern lambdas.

    Staged (lateral aliases of one projection, each computed once): the
    normalised non-empty codes, their non-empty main groups; then equality
    with a pattern and main-group equality are ``arrays_overlap`` (hash
    based). Only technologies with '/' patterns (prefix rule), or the opt-in
    star rule, test prefixes: short pattern lists element-wise, long ones
    (``prefix_lookup_at`` or more) by looking the code's own prefixes up in the
    pattern list (a code starts with a pattern exactly when the pattern is one
    of its prefixes), so the cost per code grows with the code's length, not
    with the list's. Same result as ``best_level`` (an empty code never
    matches; A over the whole list wins over B). Built as SQL text in one call.
    """
    icn, grp = "_tg_icn", "_tg_grp"

    def starts_with_any(plist: str) -> str:
        pairwise = f"exists({icn}, i -> exists({plist}, p -> startswith(i, p)))"
        lookup = f"exists({icn}, i -> arrays_overlap({prefixes_sql('i')}, {plist}))"
        return (f"(size({plist}) > 0 AND CASE WHEN size({plist}) >= {int(prefix_lookup_at)} "
                f"THEN {lookup} ELSE {pairwise} END)")

    is_a = f"arrays_overlap({icn}, {_q(pats)}) OR {starts_with_any(_q(slashed))}"
    if star_prefix:
        is_a = f"{is_a} OR {starts_with_any(_q(stars))}"
    level = (f"CASE WHEN coalesce({is_a}, false) THEN 2 "
             f"WHEN coalesce(arrays_overlap({grp}, {_q(groups)}), false) THEN 1 ELSE 0 END")
    return df.selectExpr(
        "*",
        f"array_remove(transform({_q(codes)}, c -> coalesce({norm_sql('c')}, '')), '') AS {icn}",
        f"array_remove(transform({icn}, c -> substring_index(c, '/', 1)), '') AS {grp}",
        f"{level} AS {_q(out)}").drop(icn, grp)


def level_name(level) -> Column:
    lv = _c(level)
    return (F.when(lv == 2, F.lit(LEVEL_A))
             .when(lv == 1, F.lit(LEVEL_B))
             .otherwise(F.lit(LEVEL_NONE)))


def tokenise_cell(cell) -> Column:
    """F5. A null cell gives an empty array."""
    parts = F.split(F.coalesce(_c(cell), F.lit("")), CELL_SEPARATOR_REGEX)
    toks = F.transform(parts, lambda p: F.replace(py_strip(F.upper(p)), F.lit(" "), F.lit("")))
    return F.filter(toks, lambda t: t != "")


def safe_name(col) -> Column:
    """K6 / F11."""
    return F.regexp_replace(_c(col), UNSAFE_NAME_REGEX, "_")
