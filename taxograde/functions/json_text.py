"""find the first JSON object in free text.

``first_json_text`` serves the inference call, inside its task; ``first_object`` is the
same scan in built-in expressions, for tables of answers.
Deviation, on purpose: quoted strings are skipped as a whole, so a brace
inside a string value does not end the candidate early.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FENCE_PATTERN

_FENCE = re.compile(FENCE_PATTERN, re.IGNORECASE)
_PIECE = re.compile(r'"(?:[^"\\]|\\.)*"|[{}]', re.DOTALL)


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def balanced_objects(text: str) -> Iterator[str]:
    """The outermost ``{...}`` runs of ``text`` whose braces balance, left to right."""
    at = text.find("{")
    while at >= 0:
        level = 0
        for piece in _PIECE.finditer(text, at):
            level += {"{": 1, "}": -1}.get(piece[0], 0)
            if level == 0:
                yield text[at:piece.end()]
                at = text.find("{", piece.end())
                break
        else:
            return


def first_json_text(text: str | None) -> str | None:
    """Fence-stripped text if it is JSON, else the first balanced {...} that parses."""
    bare = _FENCE.sub("", (text or "").strip())
    if not bare or _is_json(bare):
        return bare or None
    return next(filter(_is_json, balanced_objects(bare)), None)


#: Pieces of a text: an escaped character, a quote or brace, a run of others, a last backslash.
_TOKENS = r"(?s)\\.|[\"{}]|[^\"{}\\]+|\\"


def first_object(text: str) -> Column:
    """The first outermost balanced ``{...}`` of the column ``text`` that parses, in built-in expressions.

    A fold over the text's pieces: the place, the number of open braces, whether a
    string is open, where the object began, and the first object that parsed.
    A quote that is never closed inside an object ends the scan.
    """
    char = "CASE WHEN length(_piece) = 2 AND startswith(_piece, '\\\\') THEN right(_piece, 1) ELSE _piece END"
    piece = f"substring({text}, _s.start, _s.pos + length(_piece) - _s.start)"
    step = f"""(_s, _piece) -> named_struct(
      'pos', _s.pos + length(_piece),
      'level', CASE WHEN _s.quoted THEN _s.level WHEN {char} = '{{' THEN _s.level + 1
                    WHEN {char} = '}}' AND _s.level > 0 THEN _s.level - 1 ELSE _s.level END,
      'quoted', CASE WHEN _s.level = 0 THEN false WHEN _s.quoted THEN _piece <> '"' ELSE {char} = '"' END,
      'start', CASE WHEN _s.level = 0 AND {char} = '{{' THEN _s.pos + length(_piece) - 1 ELSE _s.start END,
      'got', CASE WHEN _s.got IS NULL AND NOT _s.quoted AND _s.level = 1 AND {char} = '}}'
                       AND try_parse_json({piece}) IS NOT NULL THEN {piece} ELSE _s.got END)"""
    zero = "named_struct('pos', 1, 'level', 0, 'quoted', false, 'start', 0, 'got', cast(null AS string))"
    tokens = f"regexp_extract_all({text}, r'{_TOKENS}', 0)"
    return F.expr(f"aggregate({tokens}, {zero}, {step}, _s -> _s.got)")
