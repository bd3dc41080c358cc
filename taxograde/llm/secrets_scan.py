"""Operator 10: secrets by fixed patterns and by token efficiency.

Base spans come from three patterns (assignments of passwords and tokens, access
key ids, long lower-case hexadecimal runs). The token-efficiency test adds runs
of key-like characters on which a byte-pair vocabulary does badly: a run of at
least ``MIN_RUN`` characters that mixes letters and digits (or, of letters only, changes
to capitals MIN_TURNS times inside its words), and of which a token covers fewer than
``MAX_CHARS_PER_TOKEN`` characters on average. Ordinary words
in a run do not hide a key behind them: a run that passes as a whole is tested
again in its stretches of pieces between separators that each do badly, and what
base spans leave of a run is tested like a run. Known digests
(hexadecimal of a usual digest length), UUIDs, dates and what a base span covers
are left out, as are identifiers: words joined by ``_``, ``-`` or ``/``, with digits
only at the ends of words, if the words themselves are token-efficient. Letters of
one case are not told from rare words by this test, so a random string of only
small (or only capital) letters is no span.

Spans are code point offsets, end exclusive. The kinds, in the order in which
spans of one start are listed: assign, access, hex, random.

Nulls and edges: a null text has no span; texts are scanned whole; repeated rows
and null ids are kept row by row; extra columns are ignored; an empty table
gives an empty result. A run of any length is one span.
"""

from __future__ import annotations

import base64
import functools
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shingles as S
from .common import prepared, table

VOCABULARY = "byte_bpe_50k.tiktoken"
MIN_RUN = 16
MAX_CHARS_PER_TOKEN = 2.0
MIN_TURNS = 3
#: A word of an identifier of so many letters must do well by itself.
LONG_WORD = 8
KINDS = ("assign", "access", "hex", "random")
MASK = "[secret]"
RESULT = "doc_id long, spans array<struct<kind:string,start:int,end:int>>"

#: The base patterns and the least lengths of what they match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_HINT = re.compile(r"passw|secret|token|api_?key", re.A | re.I)
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I)
_UUID = re.compile(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.I)
_DATE = re.compile(r"\d{4}-\d\d-\d\d(?:[T_-]?\d{2,6})*Z?")
_IDENTIFIER = re.compile(r"(?:\d*[A-Za-z]{3,}\d{0,4}|[A-Za-z]{1,2}|\d{1,4})(?:[_/-]+(?:\d*[A-Za-z]{3,}\d{0,4}|[A-Za-z]{1,2}|\d{1,4}))*[_/=-]*")
_WORD = re.compile(r"[A-Za-z]{2,}")
_TURN = re.compile(r"(?<=[a-z])[A-Z]")
_PIECE = re.compile(rf"(?P<plain>(?<![A-Za-z0-9+])(?:(?i:{_UUID.pattern}|{_DIGEST.pattern})|{_DATE.pattern})(?![A-Za-z0-9+]))|[A-Za-z0-9+]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns, leftmost and non-overlapping for each kind."""
    out = []
    if _HINT.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


@functools.lru_cache(maxsize=1)
def _encoding(path: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def known(run: str, path: str) -> bool:
    """A digest, UUID, date or identifier: not taken for a secret."""
    return bool(_DIGEST.fullmatch(run) or _UUID.fullmatch(run) or _DATE.fullmatch(run) or _identifier(run, path))


def _identifier(run: str, path: str) -> bool:
    """Words with digits at their ends only, of which a token covers enough characters."""
    if not _IDENTIFIER.fullmatch(run):
        return False
    words = [(len(w), MAX_CHARS_PER_TOKEN * len(_encoding(path).encode_ordinary(w))) for w in _WORD.findall(run)]
    return sum(n for n, _ in words) >= sum(t for _, t in words) and all(n >= t for n, t in words if n >= LONG_WORD)


def _mixed(run: str) -> bool:
    """Letters and digits, or letters that turn to capitals again and again."""
    if any(c.isdigit() for c in run):
        return any(c.isalpha() for c in run)
    return len(_TURN.findall(run)) >= MIN_TURNS


def random_spans(text: str, base: list[tuple[str, int, int]], path: str) -> list[tuple[str, int, int]]:
    """Runs outside ``base``, or stretches of them, with few characters per token."""
    out = []
    for m in _RUN.finditer(text):
        at = m.start()
        for a, z in sorted((a, z) for _, a, z in base if a < m.end() and m.start() < z) + [(m.end(), m.end())]:
            if a - at >= MIN_RUN:
                out += [("random", at + x, at + y) for x, y in _stretches(text[at:a], path)]
            at = max(at, z)
    return out


def _dense(run: str, path: str) -> bool:
    return len(run) < MAX_CHARS_PER_TOKEN * len(_encoding(path).encode_ordinary(run))


def _random(run: str, path: str) -> bool:
    return len(run) >= MIN_RUN and _mixed(run) and not known(run, path) and _dense(run, path)


def _stretches(run: str, path: str) -> list[tuple[int, int]]:
    """The whole run, or else its stretches of pieces with few characters per token."""
    if not _mixed(run) or known(run, path):
        return []
    if _dense(run, path):
        return [(0, len(run))]
    out = []
    group: list[tuple[int, int]] = []
    for a, z, plain in [*_pieces(run), (len(run), len(run), True)]:
        if not plain and _dense(run[a:z], path):
            group.append((a, z))
            continue
        if group and _random(run[group[0][0]:group[-1][1]], path):
            out.append((group[0][0], group[-1][1]))
        else:
            out += [(x, y) for x, y in group if _random(run[x:y], path)]
        group = []
    return out


def _pieces(run: str):
    """(start, end, plain) of what stands between separators; UUIDs, dates and digests are whole and plain."""
    for m in _PIECE.finditer(run):
        yield m.start(), m.end(), m.lastgroup == "plain"


def spans_of(text: str | None, path: str) -> list[tuple[str, int, int]]:
    if not text:
        return []
    base = base_spans(text)
    return ordered(base + random_spans(text, base, path))


def _scan(path: str):
    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for lo, n in S.chunks(batch.column(1)):
                part = batch.slice(lo, n)
                found = [[dict(zip(("kind", "start", "end"), s)) for s in spans_of(t, path)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])
    return run


def find_secrets(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, spans) of each row."""
    prepared(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return texts.mapInArrow(_scan(path or public_tokenizers.path(VOCABULARY)), RESULT)


def redact(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by a mask; all other columns as they are.

    The text passes through the task once; overlapping spans are masked as one.
    """
    prepared(docs.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for lo, n in S.chunks(batch.column(at)):
                part = batch.slice(lo, n)
                texts = pa.array([masked(t, spans_of(t, path)) for t in part.column(at).to_pylist()], batch.schema.field(at).type)
                yield part.set_column(at, batch.schema.field(at), texts)
    return docs.mapInArrow(run, docs.schema)


def masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    if not spans:
        return text
    out, end = [], 0
    for _, a, z in spans:
        if a >= end:
            out += [text[end:a], MASK]
        end = max(end, z)
    return "".join(out) + text[end:]


def op10_token_efficiency(spark, sf_dir: str) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every document."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "random")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS if k != "random"], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count("random"))
