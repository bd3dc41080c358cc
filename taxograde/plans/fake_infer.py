"""Deterministic stand-ins for the inference function (queries and tests).

``FixtureInfer`` answers every request from its payload alone: each patent
gets the two codes the ``inferred`` fixture view gives the same document id,
so an end-to-end run must reproduce ``validate_tech`` exactly. It can be told
to fail on batches holding certain ids, to wrap its answer in prose, or to
fail a number of times before answering.
"""

from __future__ import annotations

import json
from collections.abc import Callable


def fixture_codes(patent_id: str) -> list[str]:
    """The codes of the ``inferred`` view for a numeric id (none otherwise)."""
    try:
        d = int(patent_id)
    except (TypeError, ValueError):
        return []
    if d % 17 == 0:
        return []
    first = f"G0{d % 7}S" + ("/89" if d % 3 == 0 else "")
    return [first, f" h0{d % 11}W 4/02"]


class FixtureInfer:
    def __init__(self, poison: Callable[[str], bool] | None = None, prose: bool = False,
                 flaky: int = 0):
        self.poison = poison
        self.prose = prose
        self.flaky = flaky
        self._calls: dict[str, int] = {}

    def __call__(self, payload: str) -> str:
        req = json.loads(payload)
        out = []
        for b in req["patent_batches"]:
            ids = [p["patent_id"] for p in b["patents"]]
            if self.poison and any(self.poison(i) for i in ids):
                raise TimeoutError("simulated timeout")
            if self.flaky:
                k = self._calls.get(payload, 0)
                self._calls[payload] = k + 1
                if k < self.flaky:
                    raise ConnectionError("simulated connection reset")
            out.append({"domain": b["domain"], "tech_name_raw": b["tech_name_raw"],
                        "patents": [{"patent_id": i, "inferred_codes": fixture_codes(i)}
                                    for i in ids]})
        text = json.dumps({"patent_batches": out}, ensure_ascii=False)
        return f"Result follows:\n{text}\nEnd." if self.prose else text


def poison_every(n: int, rest: int) -> Callable[[str], bool]:
    def hit(pid: str) -> bool:
        try:
            return int(pid) % n == rest
        except ValueError:
            return False
    return hit


class TalkingInfer:
    """Fails ``failures`` times for a request, then talks without giving any JSON."""

    def __init__(self, failures: int):
        self.failures = failures
        self._calls: dict[str, int] = {}

    def __call__(self, payload: str) -> str:
        k = self._calls[payload] = self._calls.get(payload, 0) + 1
        if k <= self.failures:
            raise ConnectionError("simulated connection reset")
        return "I shall look into these patents."


def refuse_to_infer(payload: str) -> str:
    raise AssertionError("finished technologies must be skipped")
