"""Numeric helpers: token estimates (F6, F7) and exact rounding.

Python's ``round(x, d)`` is correctly rounded on the exact binary value of the
double; Spark's ``round``/``bround``, ``format_string`` and the cast to decimal
(which goes through the shortest decimal string) are not, and they disagree
with it on hundreds of rates a/n. ``with_py_round`` reproduces it with
built-in arithmetic (see there), so the rounding stays inside whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CHARS_PER_TOKEN, ITEM_OVERHEAD_TOKENS


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def text_tokens(text) -> Column:
    """F6. 0 for empty text, else max(1, int(len / 3.5)) on code points."""
    n = F.length(F.coalesce(_c(text), F.lit("")))
    return (F.when(n == 0, F.lit(0).cast("long"))
             .otherwise(F.greatest(F.lit(1).cast("long"),
                                   F.floor(n / F.lit(CHARS_PER_TOKEN)).cast("long"))))


def item_tokens(title, abstract) -> Column:
    """F7. title tokens + abstract tokens + JSON overhead."""
    return text_tokens(title) + text_tokens(abstract) + F.lit(ITEM_OVERHEAD_TOKENS)


# Veltkamp's splitting constant for doubles: 2^27 + 1.
_SPLIT = 134217729.0


def with_py_round(df: DataFrame, spec: dict[str, tuple[str, int]]) -> DataFrame:
    """Add ``out`` = Python ``round(src, digits)`` for each ``out: (src, digits)``
    (digits 3 or 4; src in [0, 1], NULL outside), with built-in arithmetic.

    Python rounds the exact binary value of x half-to-even. With
    k = floor(x * 10^d), the answer is k or k + 1 depending on the side of the
    midpoint m = (2k+1) / (2 * 10^d) that x lies on. Comparing x with the
    double nearest to m settles it (a different double lies on the side its
    comparison says; an off-by-one k from the inexact product only moves the
    comparison to the neighbouring midpoint, with the same answer), except when
    x is that double. Then the exact side of m decides: the double is split
    into a high part of at most 26 bits and the rest (Veltkamp), so both
    products with the denominator are exact; (2k+1) minus the high product is
    exact (the two are within a factor of 2), and the last subtraction may
    round but keeps its sign. A double on m is a true tie (half to even). The
    result k / 10^d is correctly rounded, as Python returns it.

    The steps are lateral column aliases of one projection, which Spark plans
    as separate projections and keeps apart (a value used more than once is
    not inlined), so every intermediate is computed once per row; they are
    written as SQL expressions, so the whole step is one call.
    """
    exprs, temps = [], []
    for i, (out, (src, digits)) in enumerate(spec.items()):
        if digits not in (3, 4):
            raise ValueError("only 3 or 4 digits are used")
        scale, den = float(10 ** digits), float(2 * 10 ** digits)
        x, t = f"`{src}`", f"_pr{i}_"
        k, j, near, c, hi, side = (t + n for n in ("k", "j", "near", "c", "hi", "side"))
        exprs += [
            f"floor({x} * {scale!r}D) AS {k}",
            f"cast({k} * 2 + 1 AS double) AS {j}",
            f"{j} / {den!r}D AS {near}",
            f"{near} * {_SPLIT!r}D AS {c}",
            f"{c} - ({c} - {near}) AS {hi}",
            f"signum(({j} - {hi} * {den!r}D) - ({near} - {hi}) * {den!r}D) AS {side}",
            f"CASE WHEN {x} >= 0 AND {x} <= 1 THEN cast(CASE WHEN "
            f"CASE WHEN {x} > {near} THEN true WHEN {x} < {near} THEN false "
            f"WHEN {side} < 0 THEN true WHEN {side} > 0 THEN false ELSE {k} % 2 = 1 END "
            f"THEN {k} + 1 ELSE {k} END AS double) / {scale!r}D END AS `{out}`"]
        temps += [k, j, near, c, hi, side]
    return df.selectExpr("*", *exprs).drop(*temps)
