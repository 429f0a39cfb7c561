"""Token headers in very long runs: the same spans as the pattern alone, in time that grows with the text."""

import random
import time

from textloom.llm import secret_scan as scan


def _by_pattern(text):
    """Leftmost non-overlapping matches of the token pattern."""
    return [(m.start(), m.end()) for m in scan.PATTERNS["jwt"].finditer(text)]


def test_spans_of_tokens_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(scan, "VALID", {k: v for k, v in scan.VALID.items() if k != "jwt"})
    rng = random.Random(4)
    parts = ["eyJ", "EYJ", "eyj", "a", "-_", ".", "..", " ", "Z9", "\n", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 40)))
        found = [(a, b) for a, kind, b in scan.scan(text) if scan.KINDS[kind] == "jwt"]
        assert found == _by_pattern(text), text


def test_long_runs_take_time_in_proportion():
    for text in ("eyJ" * 400_000, "eyJa." + "eyJ" * 400_000, "eyJa.eyJb!" * 100_000, "EYJ" * 400_000):
        start = time.perf_counter()
        scan.scan(text)
        assert time.perf_counter() - start < 20
