"""Defaults and fixed values.

Everything in the "fixed values" block below must stay equal to the behaviour
being reproduced (keyword lists, separators, thresholds, budget arithmetic);
changing any of them changes results.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values (must match the original tool's behaviour exactly)
# ---------------------------------------------------------------------------

# Default domains used when the hierarchy file has no "domains" key.
DEFAULT_DOMAINS = ["环境感知", "决策规划", "控制执行", "支撑体系"]

# Header keywords that pick the technology-name column of a mapping table,
# tried keyword by keyword (case-insensitive containment).
NAME_KEYWORDS = ["名称", "技术", "tech", "技术名称", "小类", "类别", "子类"]

# Header keywords that mark code columns of a mapping table.
CODE_KEYWORDS = ["code", "ipc", "cpc", "分类号", "分类代码"]

# Separators inside one mapping cell: , ， ; ； / space |
CELL_SEPARATOR_REGEX = "[,，;；/ |]+"

# Characters replaced (as runs) by one "_" in file-safe names.
UNSAFE_NAME_REGEX = r'[\\/:*?"<>|]+'

# Cells read as missing by the original CSV reader.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Code fence around an answer (case-insensitive).
FENCE_PATTERN = r"^```(?:json)?\s*|\s*```$"

# Characters that Python's str.strip() removes (str.isspace()).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Match levels and verdicts.
LEVEL_A, LEVEL_B, LEVEL_C, LEVEL_NONE = "A", "B", "C", "none"
SUPPORTED = "supported"
PARTIALLY_SUPPORTED = "partially_supported"
NOT_SUPPORTED = "not_supported"

# Constant text attached to every evidence sample.
EVIDENCE_REASONING = (
    "Local validation: Scored based on exact/prefix/main-group relationship "
    "between inferred codes and the lookup table"
)

# Confidence = round(CONF_BASE + CONF_SLOPE * (rate_A + rate_B), 3).
CONF_BASE = 0.7
CONF_SLOPE = 0.2

# Text truncation before a request (code points).
MAX_TITLE_CHARS = 2000
MAX_ABSTRACT_CHARS = 6000

# Token estimate: 3.5 characters per token, 12 tokens of JSON per item.
CHARS_PER_TOKEN = 3.5
ITEM_OVERHEAD_TOKENS = 12

# Automatic batch size: sample, budget and bounds.
AUTO_BATCH_SAMPLE = 50
SAFETY_RATIO = 0.55
SYSTEM_OVERHEAD_TOKENS = 800
PER_BATCH_OVERHEAD_TOKENS = 350
MIN_AUTO_BATCH = 5

# Retries of one request, exponential wait bounded 1..20 s.
RETRY_ATTEMPTS = 6
RETRY_WAIT_MIN = 1.0
RETRY_WAIT_MAX = 20.0

# Failed-batch splitting: first split to max(10, size // 2); a failing
# sub-batch of at most 10 items is given up; halves never go below 5.
SPLIT_MIN_FIRST = 10
SPLIT_GIVE_UP_AT = 10
SPLIT_MIN_HALF = 5

# ---------------------------------------------------------------------------
# User-facing options (defaults as in the original command line)
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Options:
    id_col: str = "patent id"
    title_col: str = "title"
    abstract_col: str = "abstract"
    tau_strong: float = 0.35
    tau_min: float = 0.15
    max_evidence: int = 5
    batch_size: int = 30
    auto_batch: bool = False
    context_limit: int = 128_000
    auto_batch_cap: int = 60
    # Extension: a star on a pattern without "/" also means "prefix".
    star_prefix: bool = False
    # Extension: part of the cache key, '' gives the original behaviour.
    model_id: str = ""
    # Technologies processed, written and marked as done together.
    wave_technologies: int = 512
